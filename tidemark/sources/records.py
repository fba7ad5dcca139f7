"""CSV records from text files that may be split between tasks.

Capture fields hold commas, doubled quotes and line breaks, NULL and '' must
stay apart, and a record's number within its file is part of its identity, so
Spark's own CSV reader does not fit.  Files are read as lines (a split per
task).  A line without quote or inner carriage return outside a quoted field is
a record that a plain cut at commas gives, done in the JVM; a standard CSV
reader turns the others into records.

A split may begin inside a quoted field.  For files above one split a first
pass reports, for both possible beginnings, how each split ends and how many
records it starts; a window over those small rows settles how every split
really begins.  Records cut by a split edge are put together from their pieces.
"""

from __future__ import annotations

import csv
import functools
import io
import itertools
import re
import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.session import work_folder

# The parser travels to the workers by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGES = "source_file string, start long, ends_if_outside boolean, ends_if_inside boolean, n_if_outside long, n_if_inside long"
PARSED = "source_file string, line long, fields array<string>, piece string, raw string, start long, bad_text boolean"
RECORDS = ("source_file", "line", "fields", "bad_text", "too_long")
_FIELD_LIMIT = 2**31 - 1  # widths are judged later, with a reason
# Twice what the widest legal record takes with every character quoted twice: a
# record cut by split edges is not put together beyond it.
MAX_RECORD = 64 * contract.SOURCE_WIDTH
# Splits smaller than this share a task: starting one costs more than reading a few kilobytes.
TASK_BYTES = 1 << 25
# Splits reported together by the first pass.
EDGE_ROWS = 1000


class _Feed:
    """Hands text to a CSV reader and remembers what a record consumed."""

    def __init__(self, text: str, inside: bool):
        self._pieces = iter(io.StringIO(text, newline=""))
        self._prefix = '"' if inside else ""
        self.taken: list[str] = []
        self.drained = False

    def __iter__(self) -> Iterator[str]:
        return self

    def __next__(self) -> str:
        try:
            piece = next(self._pieces)
        except StopIteration:
            self.drained = True
            raise
        self.taken.append(piece)
        prefix, self._prefix = self._prefix, ""
        return prefix + piece


def _records(text: str, inside: bool) -> Iterator[tuple[list[str], str, bool]]:
    """fields, raw text, and whether the record is still open at the end of ``text``."""
    feed = _Feed(text, inside)
    for fields in csv.reader(feed):
        # The reader asks for more text within a record only when a quoted
        # field is open, so running dry there means the record continues.
        yield fields, "".join(feed.taken), feed.drained
        feed.taken = []


def _after_line(line: str, inside: bool) -> tuple[bool, int]:
    """State after one line with a quote, and how many records it started."""
    count, still_open = 0, False
    for _, _, still_open in _records(line + "\n", inside):
        count += 1
    return still_open, count - inside


def _splits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array, list[int]]]:
    """Runs of lines of one split, and which of them need more than a plain cut.

    Special are lines with a quote, a carriage return before their end, or
    broken text; everything else is one record, or the inside of a field.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        names, starts = batch.column("source_file"), batch.column("start")
        moved = pc.or_(pc.not_equal(starts[1:], starts[:-1]), pc.not_equal(names[1:], names[:-1]))
        cuts = [0, *(i + 1 for i in pc.indices_nonzero(moved).to_pylist()), batch.num_rows]
        for begin, end in itertools.pairwise(cuts):
            run = batch.slice(begin, end - begin)
            values = run.column("value")
            special = pc.match_substring_regex(values, '"|\\r(?s:.)')
            if "bad_text" in run.schema.names:
                special = pc.or_(special, run.column("bad_text"))
            yield run, values, pc.indices_nonzero(special).to_pylist()


def _find_edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(_FIELD_LIMIT)
    names = ["source_file", "start", "ends_if_outside", "ends_if_inside", "n_if_outside", "n_if_inside"]
    rows: list[tuple] = []  # of splits that have ended

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(values) for values in zip(*rows)], names=names)
        rows.clear()
        return made

    current, states, counts = None, [False, True], [0, 0]
    for run, values, special in _splits(batches):
        key = (run.column("source_file")[0].as_py(), run.column("start")[0].as_py())
        if key != current:
            if current is not None:
                rows.append((*current, *states, *counts))
                if len(rows) == EDGE_ROWS:
                    yield batch()
            current, states, counts = key, [False, True], [0, 0]
        at = 0
        for index in (*special, len(values)):
            for guess in (0, 1):
                if not states[guess]:
                    counts[guess] += index - at
                if index < len(values):
                    states[guess], started = _after_line(values[index].as_py(), states[guess])
                    counts[guess] += started
            at = index + 1
    if current is not None:
        rows.append((*current, *states, *counts))
        yield batch()


class _Split:
    """Turns the lines of one split into records, and its cut ends into pieces."""

    def __init__(self, source: str, start: int, inside: bool, line: int, split: bool, null: str | None):
        self.source, self.start, self.line = source, start, line
        self.split, self.null = split, null
        self.open: list[str] | None = [] if inside else None
        self.continued = inside
        self.open_bad = False
        self.rows: list[tuple] = []  # line, fields, piece, bad

    def add(self, values: pa.Array, special: list[int], bad: set[int]) -> pa.RecordBatch | None:
        """Takes a run of lines; returns those that are records as they stand."""
        at, places, lines = 0, [], []
        for index in (*special, len(values)):
            if self.open is not None:
                self.open += [v + "\n" for v in values[at:index].to_pylist()]
            elif index > at:
                places.append(np.arange(at, index))
                lines.append(np.arange(self.line + 1, self.line + 1 + index - at))
                self.line += index - at
            if index < len(values):
                self._special(values[index].as_py(), index in bad)
            at = index + 1
        if not places:
            return None
        raw, line = values.take(pa.array(np.concatenate(places))), pa.array(np.concatenate(lines))
        filled = pc.invert(pc.is_in(raw, value_set=pa.array(["", "\r"])))  # blank lines count but give no row
        raw, line = raw.filter(filled), line.filter(filled)
        none = pa.nulls(len(raw), pa.list_(pa.string())), pa.nulls(len(raw), pa.string())
        return _batch(self.source, self.start, line, *none, pa.array(np.zeros(len(raw), bool)), raw) if len(raw) else None

    def _special(self, line: str, bad: bool) -> None:
        text = line + "\n"
        bad |= self.open_bad
        if self.open is not None:
            still_open, started = _after_line(line, True)
            if still_open and not started:
                self.open.append(text)
                self.open_bad = bad
                return
            text = "".join(self.open) + text
        self._take(text, bad)

    def _take(self, text: str, bad: bool) -> None:
        self.open, self.open_bad = None, False
        for fields, raw, still_open in _records(text, self.continued):
            if still_open:
                self.open, self.open_bad = [raw], bad
                return
            self._emit(fields, raw, bad)

    def _emit(self, fields: list[str], raw: str, bad: bool, cut: bool = False) -> None:
        # A leading continuation belongs to the record opened before this split.
        if not self.continued:
            self.line += 1
        if self.split and (self.continued or cut):
            # Too long is too long: the rest need not travel.
            self.rows.append((self.line, None, raw[: MAX_RECORD + 1], bad))
        elif fields:
            self.rows.append((self.line, fields, None, bad))
        self.continued = False

    def finish(self) -> None:
        if self.open is not None:
            text = "".join(self.open)
            fields = next(csv.reader(io.StringIO(text, newline="")), [])
            self._emit(fields, text, self.open_bad, cut=True)
            self.open = None

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        lines, fields, pieces, bad = zip(*rows)
        fields = [_decoded(f, self.null) for f in fields]
        return _batch(self.source, self.start, lines, fields, pieces, bad)


def _decoded(fields: list[str] | None, null: str | None) -> list[str | None] | None:
    """NULL for the token the capture writes; an empty string stays one."""
    if fields is None or null is None or null not in fields:
        return fields
    return [None if value == null else value for value in fields]


def _batch(source: str, start: int, lines, fields, pieces, bad, raw=None) -> pa.RecordBatch:
    columns = {
        "source_file": pa.repeat(pa.scalar(source, pa.string()), len(lines)),
        "line": pa.array(lines, pa.int64()),
        "fields": pa.array(fields, pa.list_(pa.string())),
        "piece": pa.array(pieces, pa.string()),
        "raw": pa.nulls(len(lines), pa.string()) if raw is None else raw,
        "start": pa.repeat(pa.scalar(start, pa.int64()), len(lines)),
        "bad_text": pa.array(bad, pa.bool_()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _parse(
    batches: Iterable[pa.RecordBatch], split: bool = True, null: str | None = None
) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(_FIELD_LIMIT)
    current: _Split | None = None
    for run, values, special in _splits(batches):
        first = {n: run.column(n)[0].as_py() for n in ("source_file", "start", "inside", "base")}
        if current is None or (current.source, current.start) != (first["source_file"], first["start"]):
            if current is not None:
                current.finish()
                if current.rows:
                    yield current.batch()
            current = _Split(*first.values(), split, null)
        bad = set(pc.indices_nonzero(run.column("bad_text")).to_pylist())
        plain = current.add(values, special, bad)
        if plain is not None:
            yield plain
        if current.rows:
            yield current.batch()
    if current is not None:
        current.finish()
        if current.rows:
            yield current.batch()


def _parse_pieces(batches: Iterable[pa.RecordBatch], null: str | None = None) -> Iterator[pa.RecordBatch]:
    csv.field_size_limit(_FIELD_LIMIT)
    for batch in batches:
        for row in batch.to_pylist():
            fields = _decoded(next(csv.reader(io.StringIO(row["text"], newline="")), []), null)
            yield _batch(row["source_file"], 0, [row["line"]], [fields], [None], [row["bad_text"]])


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", path) for path in paths]  # names, not patterns
    text = spark.read.text(literal, lineSep="\n")
    # The scan reports paths percent-encoded, listings report them plain.
    encoded = F.col("_metadata.file_path")
    plain = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return text.select(
        F.when(encoded.contains("%"), plain).otherwise(encoded).alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.make_valid_utf8("value").alias("value"),
        (~F.is_valid_utf8("value")).alias("bad_text"),
    )


def _true_starts(edges: DataFrame) -> DataFrame:
    """How each split really begins: inside a quoted field?  after how many records?

    A split keeps, flips or fixes the state.  The state before a split is what
    the last fixing split left, flipped once per flipping split since then.
    One short row per split, so a file's rows fit one task whatever its size.
    """
    before = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    flips = F.col("ends_if_outside") & ~F.col("ends_if_inside")
    fixes = F.col("ends_if_outside") == F.col("ends_if_inside")
    upto = Window.partitionBy("source_file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    counted = edges.withColumn("_flips", F.sum(flips.cast("int")).over(upto))
    fixed = F.when(fixes, F.struct(F.col("ends_if_outside").cast("int").alias("to"), F.col("_flips").alias("at")))
    settled = (
        counted.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(before))
        .withColumn("_seen", F.coalesce(F.last("_flips").over(before), F.lit(0)))
        .withColumn(
            "inside",
            F.coalesce((F.col("_fixed.to") + F.col("_seen") - F.col("_fixed.at")) % 2, F.col("_seen") % 2) == 1,
        )
        .withColumn("_n", F.when(F.col("inside"), F.col("n_if_inside")).otherwise(F.col("n_if_outside")))
    )
    base = F.coalesce(F.sum("_n").over(before), F.lit(0))
    ends = F.when(F.col("inside"), F.col("ends_if_inside")).otherwise(F.col("ends_if_outside"))
    return settled.select("source_file", "start", "inside", ends.alias("open"), base.alias("base"))


def _records_of(parsed: DataFrame, null: str | None) -> DataFrame:
    """Parsed rows that are whole records, plain ones cut at their commas."""
    # Such lines hold a carriage return at their end only.
    bare = F.when(F.endswith("raw", F.lit("\r")), F.substring("raw", F.lit(1), F.length("raw") - 1)).otherwise(F.col("raw"))
    cut = F.split(bare, ",", -1)
    if null is not None:
        # A function over array elements is not compiled: only lines that hold the token pay for it.
        decoded = F.transform(cut, lambda value: F.nullif(value, F.lit(null)))
        cut = F.when(F.contains("raw", F.lit(null)), decoded).otherwise(cut)
    fields = F.when(F.col("raw").isNotNull(), cut).otherwise(F.col("fields")).alias("fields")
    return parsed.select("source_file", "line", fields, "bad_text", F.lit(False).alias("too_long"))


def _joined_pieces(pieces: DataFrame, null: str | None) -> DataFrame:
    """Records cut by split edges: one or two pieces each, rarely more.

    A stray quote can make the rest of a file one record of any number of
    pieces; those are counted, not gathered, and marked too long.
    """
    record = ("source_file", "line")
    sizes = pieces.groupBy(*record).agg(F.sum(F.length("piece")).alias("_size"), F.bool_or("bad_text").alias("_bad"))
    fit = pieces.join(sizes.filter(F.col("_size") <= MAX_RECORD).select(*record), [*record], "left_semi")
    ordered = F.array_sort(F.collect_list(F.struct("start", "piece")))
    whole = fit.groupBy(*record).agg(
        F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("text"),
        F.bool_or("bad_text").alias("bad_text"),
    )
    joined = whole.mapInArrow(functools.partial(_parse_pieces, null=null), PARSED)
    long = sizes.filter(F.col("_size") > MAX_RECORD)
    nothing = F.array().cast("array<string>").alias("fields")
    marked = long.select(*record, nothing, F.col("_bad").alias("bad_text"), F.lit(True).alias("too_long"))
    return joined.withColumn("too_long", F.lit(False)).select(*RECORDS).unionByName(marked)


def pin_splits(spark: SparkSession) -> None:
    """Keep file splits the same between two readings, however many executors join meanwhile."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        # A few splits for each core, so that cores end together.
        spark.conf.set("spark.sql.files.minPartitionNum", str(3 * spark.sparkContext.defaultParallelism))


def read_split_records(
    spark: SparkSession, paths: Sequence[str], null: str | None = None, size: int | None = None
) -> DataFrame:
    """Records of files of any size, ``size`` bytes together where known; see the module text."""
    pin_splits(spark)
    lines = read_lines(spark, paths)
    tasks = None if size is None else max(4 * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    if tasks is not None:
        # Each split stays whole, with its own edges; only tasks are fewer.
        lines = lines.coalesce(tasks)
    edges = lines.select("source_file", "start", "value").mapInArrow(_find_edges, EDGES)
    # A hundred bytes per split (1e-6 of the text), kept as a table so that the
    # first pass runs once.
    folder = work_folder(spark, "splits")
    found = _true_starts(edges).select(
        F.col("source_file").alias("_file"), F.col("start").alias("_start"), "inside", "open", "base"
    )
    found.write.parquet(folder)
    starts = spark.read.schema(found.schema).parquet(folder)
    # A broadcast join leaves each split's lines in order.
    at = (F.col("source_file") == F.col("_file")) & (F.col("start") == F.col("_start"))
    placed = lines.join(F.broadcast(starts), at, "left")
    known = F.when(F.col("base").isNull(), F.raise_error(F.lit("file splits changed while reading; run again")))
    placed = placed.withColumn("base", known.otherwise(F.col("base")))
    columns = ("source_file", "start", "inside", "base", "value", "bad_text")
    parse = functools.partial(_parse, split=True, null=null)
    parsed = placed.select(*columns).mapInArrow(parse, PARSED)
    cut = starts.filter("inside or open")
    if cut.isEmpty():
        # No split begins or ends inside a field.
        return _records_of(parsed, null)
    # Pieces come from the few splits that begin or end inside a field: those are
    # parsed once more and only their pieces written, not the text of all files.
    folder = work_folder(spark, "pieces")
    pieces = lines.join(F.broadcast(cut), at).select(*columns).mapInArrow(parse, PARSED).filter(F.col("piece").isNotNull())
    pieces.write.parquet(folder)
    pieces = spark.read.schema(PARSED).parquet(folder)
    if tasks is not None:
        pieces = pieces.coalesce(tasks)
    complete = parsed.filter(F.col("piece").isNull())
    return _records_of(complete, null).unionByName(_joined_pieces(pieces, null))


def read_whole_records(spark: SparkSession, paths: Sequence[str], null: str | None = None) -> DataFrame:
    """Records of files small enough never to be split."""
    lines = read_lines(spark, paths)
    outside: Column = F.lit(False)
    placed = lines.select(
        "source_file", "start", outside.alias("inside"), F.lit(0).cast("long").alias("base"), "value", "bad_text"
    )
    # Nothing is cut: an open quote at the end of a file ends its last record.
    parsed = placed.mapInArrow(functools.partial(_parse, split=False, null=null), PARSED)
    return _records_of(parsed, null)


def single_split_bytes(spark: SparkSession) -> int:
    """Files up to this size are never split, whatever else is read with them."""

    def size(name: str, default: str) -> int:
        text = spark.conf.get(name, default).lower().removesuffix("b")
        units = {"k": 10, "m": 20, "g": 30}
        shift = units.get(text[-1:], 0)
        return int(text[:-1] if shift else text) << shift

    return min(
        size("spark.sql.files.openCostInBytes", "4194304"),
        size("spark.sql.files.maxPartitionBytes", "134217728"),
    )


def read_records(
    spark: SparkSession, files: Sequence[tuple[str, int]], null: str | None = None
) -> DataFrame:
    """``source_file, line, fields, bad_text, too_long`` of the given (path, size) files.

    Fields equal to ``null`` become NULL.  ``line`` counts records from 1, blank
    ones included, but blank records yield no row.  A record that is too long to
    be legal and is cut by splits has no fields and says so.
    """
    limit = single_split_bytes(spark)
    small = [path for path, size in files if size <= limit]
    large = [f for f in files if f[1] > limit]
    parts = []
    if small:
        parts.append(read_whole_records(spark, small, null))
    if large:
        parts.append(read_split_records(spark, [path for path, _ in large], null, sum(size for _, size in large)))
    if not parts:
        raise ValueError("no files to read")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
