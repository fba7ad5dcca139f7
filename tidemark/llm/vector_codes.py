"""Product codes of vectors in integers, assigned through the Walsh-Hadamard transform.

A component x becomes floor(``SCALE`` * x); a vector is cut into ``PARTS`` equal
parts, each with a codebook of up to ``ENTRIES`` entries: at first that part of
the vectors of smallest id, then ``ROUNDS`` times the componentwise floored mean
of the parts that are nearest to the entry.

Parts and entries are padded with zeros to a power of two, d, and transformed by
the integer Walsh-Hadamard matrix, which multiplies every squared distance by d.
Squared differences are added coefficient by coefficient in sequency order
(fewest sign changes first).  The entry that is nearest in the first coefficient
gives a bound; an entry leaves as soon as what is added up exceeds it.  All sums
are 64-bit integers, so the result is exact, with ties to the lower index.

A round sends sums and counts of each codebook entry, added up in every task: at
most ``PARTS`` * ``ENTRIES`` rows a task, and as many come to the driver, which
divides; codebooks travel with the tasks.

Edge cases: rows without a vector, with a null or non-finite component, with
one of ``LIMIT`` or more in size (sums would leave 64 bits), or of another length
than the vector of smallest id are dropped; that length must be a multiple of
``PARTS`` of at most ``PARTS`` * 64; null ids come after all others; rows of
equal id go by their vectors; repeated rows count each; fewer rows than
``ENTRIES`` give fewer entries; a null label is a label; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

SCALE, PARTS, ENTRIES, ROUNDS, LIMIT = 256, 16, 64, 2, 65536
_AT_ONCE = 2048


def sequency(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((np.diff(rows, axis=1) != 0).sum(1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Coefficients of rows of integers, in sequency order."""
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    return parts @ sequency(size)[:, : parts.shape[1]].T  # padding adds nothing


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """Indexes of the nearest entries and squared distances, and how many coefficient differences it took."""
    places, errors, work = [], [], 0
    book = transformed(entries)
    size = book.shape[1]
    for lo in range(0, len(parts), _AT_ONCE):
        rows = transformed(parts[lo : lo + _AT_ONCE])
        first = (rows[:, :1] - book[:, 0]) ** 2
        near = first.argmin(1)
        bound = ((rows - book[near]) ** 2).sum(1)
        row, entry = np.nonzero(first <= bound[:, None])
        total = first[row, entry]
        work += first.size + rows.size
        for k in range(1, size):
            total = total + (rows[row, k] - book[entry, k]) ** 2
            work += len(row)
            left = total <= bound[row]
            row, entry, total = row[left], entry[left], total[left]
        starts = np.flatnonzero(np.diff(row, prepend=-1))  # entries of a row stand in order
        least = np.minimum.reduceat(total, starts) if len(starts) else total
        hit = np.flatnonzero(total == np.repeat(least, np.diff(starts, append=len(row))))
        lowest = hit[np.flatnonzero(np.diff(row[hit], prepend=-1))]
        places.append(entry[lowest])
        errors.append(total[lowest] // size)
    none = [np.zeros(0, np.int64)]
    return (np.concatenate(places or none), np.concatenate(errors or none)), work


def kept(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and integer ``parts`` (all components in order)."""
    x = F.col("embedding")
    whole = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= LIMIT))
    scaled = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("int"))
    return vectors.where(whole).select("vec_id", "label", scaled.alias("parts"))


def first_entries(rows: DataFrame) -> list[list[int]]:
    """Vectors of the ``ENTRIES`` smallest ids that are as long as the first one."""
    order = (F.col("vec_id").asc_nulls_last(), "parts")
    first = rows.orderBy(*order).select("parts").first()
    if first is None:
        return []
    size = len(first["parts"])
    if size == 0 or size % PARTS or size > 64 * PARTS:
        raise ValueError(f"vectors of {size} components: not a multiple of {PARTS} up to {64 * PARTS}")
    return [r["parts"] for r in rows.where(F.size("parts") == size).orderBy(*order).limit(ENTRIES).select("parts").collect()]


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows x parts x components."""
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), PARTS, -1)


def codebooks(rows: DataFrame) -> np.ndarray:
    """Parts x entries x components; ``rows`` must be stored."""
    found = first_entries(rows)
    books = np.array(found, np.int64).reshape(len(found), PARTS, -1).swapaxes(0, 1) if found else np.zeros((PARTS, 0, 0), np.int64)
    for _ in range(ROUNDS if found else 0):
        books = books.copy()
        for r in sums(rows, books).collect():  # a row for each entry in use at most
            books[r["part"], r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``part``, ``entry``, ``n`` and componentwise ``sums`` of the parts nearest to it."""
    width = books.shape[2]

    def run(batches):
        totals = np.zeros((*books.shape[:2], width + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                for part, (mine, book) in enumerate(zip(_matrix(batch.column("parts")).swapaxes(0, 1), books)):
                    (entry, _), _ = nearest(mine, book)
                    np.add.at(totals[part], entry, np.hstack([mine, np.ones((len(mine), 1), np.int64)]))
        part, entry = np.nonzero(totals[:, :, -1])
        found = totals[part, entry]
        offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * width)
        lists = pa.ListArray.from_arrays(offsets, pa.array(found[:, :-1].ravel()))
        columns = [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(found[:, -1]), lists]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    usable = rows.where(F.size("parts") == PARTS * width).select("parts")
    local = usable.mapInArrow(run, "part int, entry int, n long, sums array<long>")
    return local.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (an entry's index for each part) and ``error`` (squared distance) of every row."""
    width = books.shape[2]

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            entries, error = [], np.zeros(batch.num_rows, np.int64)
            for mine, book in zip(_matrix(batch.column("parts")).swapaxes(0, 1), books):
                (entry, distance), _ = nearest(mine, book)
                entries.append(entry)
                error += distance
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * PARTS)
            code = pa.ListArray.from_arrays(offsets, pa.array(np.array(entries, np.int32).T.ravel()))
            return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), code, pa.array(error)], ["vec_id", "label", "code", "error"])

        return each

    kinds = dict(rows.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code array<int>, error long"
    return base.map_batches(rows.where(F.size("parts") == PARTS * width), make, schema)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def query(spark, folder: str) -> DataFrame:
    rows = base.stored(kept(base.read(spark, folder, "embeddings")), "vectors")
    books = codebooks(rows)
    found = base.stored(coded(rows, books), "vector-codes")
    labels = found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    hexes = F.array_join(F.transform("code", lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")
    return found.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", hexes.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


def _assigned(rows: str, books: str) -> str:
    """The nearest entry of every part, ties to the lower index."""
    return (
        f"SELECT v, part, p, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT x.v, x.part, x.p, b.entry,"
        f" list_sum(list_transform(list_zip(x.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d"
        f" FROM {rows} x JOIN {books} b USING (part)) GROUP BY v, part, p"
    )


def _next(assigned: str, books: str) -> str:
    means = (
        f"SELECT part, entry, list(m ORDER BY k) AS p FROM (SELECT part, entry, k, CAST((sum(p[k]) - ((sum(p[k]) % count(*) + count(*)) % count(*))) // count(*) AS BIGINT) AS m"
        f" FROM {assigned}, (SELECT unnest(generate_series(1, (SELECT max(len(p)) FROM parts))) AS k) GROUP BY part, entry, k) GROUP BY part, entry"
    )
    return f"SELECT b.part, b.entry, coalesce(m.p, b.p) AS p FROM {books} b LEFT JOIN ({means}) m USING (part, entry)"


#: DuckDB twin, for rows of distinct id and equal length.
ORACLE = f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {SCALE}) AS BIGINT)) AS c
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, c) AS v FROM kept),
parts AS MATERIALIZED (
    SELECT v, part, c[part * (len(c) // {PARTS}) + 1 : (part + 1) * (len(c) // {PARTS})] AS p
    FROM numbered, (SELECT unnest(range({PARTS})) AS part)),
book0 AS MATERIALIZED (SELECT part, v - 1 AS entry, p FROM parts WHERE v <= {ENTRIES}),
near0 AS MATERIALIZED ({_assigned("parts", "book0")}),
book1 AS MATERIALIZED ({_next("near0", "book0")}),
near1 AS MATERIALIZED ({_assigned("parts", "book1")}),
book2 AS MATERIALIZED ({_next("near1", "book1")}),
near2 AS MATERIALIZED ({_assigned("parts", "book2")}),
coded AS (
    SELECT v, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near2 GROUP BY v),
named AS (SELECT n.vec_id, n.label, c.code, c.error FROM numbered n JOIN coded c USING (v)),
digest AS (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM named, digest
"""
