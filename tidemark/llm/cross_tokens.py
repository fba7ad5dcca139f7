"""Alignment of two tokenizers' ids over the same text.

Both encode a space and the text: A by a byte-level BPE file, B by a
SentencePiece model that puts the space itself.  The ends of A's and of B's
tokens, in bytes, become two dictionaries from end to index; the ends that both
hold, sorted, cut both id lists into groups, and every A token of a group is
linked with every B token of it.

Neither tokenizer's merges reach over the edge of a chunk (``memo.CHUNKS``), so
a worker aligns a chunk once and remembers it; new chunks are joined and go
through the libraries and the dictionaries together.  The memory is bounded.

``pair_counts`` counts, for each linked pair of ids, the rows that hold it:
pairs are numbered within blocks of rows, so one row a pair and block is
shuffled, not one a pair and document; counts go back to the blocks in the same
way.  A block holds the rows of one task up to ``BLOCK_CHARS``.

Edge cases: null and empty texts and texts that either tokenizer does not spell
byte for byte (a U+2581 in it) have no tokens: zeros, and '' for the digest;
equal ids and repeated rows are a document each; special tokens' strings are
plain text; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base
from tidemark.llm.memo import CHUNKS, Memo, Ragged

BLOCK_CHARS = 16 << 20
_CACHE_CHUNKS, _TOGETHER = 250_000, 1000
#: Longer chunks are aligned each time they occur.
_LONG = 200


def files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


def cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group, how many A and how many B tokens end with it or before."""
    a_at = {end: n for n, end in enumerate(a_ends.tolist(), 1)}
    b_at = {end: n for n, end in enumerate(b_ends.tolist(), 1)}
    common = sorted(a_at.keys() & b_at.keys())
    return tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (a_at, b_at))


def expanded(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the A and B token of every link of the groups."""
    links = a_sizes * b_sizes
    first = np.cumsum(links) - links
    n = np.arange(int(links.sum())) - np.repeat(first, links)
    wide = np.repeat(b_sizes, links)
    a_first, b_first = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    return np.repeat(a_first, links) + n // wide, np.repeat(b_first, links) + n % wide


class Aligner:
    #: Columns of the memory of chunks.
    A, B, A_SIZES, B_SIZES, PAIRS = range(5)

    def __init__(self, a_path: str, b_path: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.lead = self.b.encode("\n")  # the model's own space, and the line feed that no piece holds
        if any(b"\n" in x and len(x) > 1 for x in self.b_bytes):
            raise ValueError("a piece reaches over a line feed")
        self.a_size = np.fromiter(map(len, self.a_bytes), np.int64)
        self.b_size = np.fromiter(map(len, self.b_bytes), np.int64)
        self.a_text, self.b_text = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))
        self.texts: list[str | None] = []
        self.pairs: dict[int, int] = {}  # numbers of linked pairs, a << 32 | b
        self.memo = Memo(self._chunks, 5, _CACHE_CHUNKS, self._cleared)

    def _cleared(self) -> None:
        self.texts = []

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both tokenizers' ids, or None where one does not spell the text."""
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode("\n" + text)
        if b[: len(self.lead)] != self.lead:
            return None
        b, plain = b[len(self.lead) :], text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != plain or b"".join(map(self.b_bytes.__getitem__, b)) != plain:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def _together(self, chunks: list[str], held: list[Ragged], texts: list[str | None]) -> None:
        """Adds chunks that may stand one after another: A ids, B ids, group sizes of both, links; no tokens where they are not spelt."""
        got = self.ids("".join(chunks))
        if got is None and len(chunks) > 1:
            half = len(chunks) // 2
            self._together(chunks[:half], held, texts)
            return self._together(chunks[half:], held, texts)
        if got is None:
            for column in held:
                column.add(np.zeros(1, np.int64), np.zeros(0, np.int64))
            return texts.append(None)
        a, b = got
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_cut, b_cut = cuts(a_ends, b_ends)
        ends = np.cumsum([len(c.encode()) for c in chunks])
        last = np.searchsorted(a_ends[a_cut - 1], ends) + 1  # groups up to the end of each chunk
        if (a_ends[a_cut[last - 1] - 1] != ends).any():
            raise ValueError("a token reaches over a chunk")
        a_sizes, b_sizes = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
        at_a, at_b = expanded(a_sizes, b_sizes)
        keys, where = np.unique(a[at_a] << 32 | b[at_b], return_inverse=True)
        numbers = np.fromiter((self.pairs.setdefault(k, len(self.pairs)) for k in keys.tolist()), np.int64, len(keys))
        links = np.cumsum(a_sizes * b_sizes)
        bounds = [a_cut[last - 1], b_cut[last - 1], last, last, links[last - 1]]
        for column, values, bound in zip(held, (a, b, a_sizes, b_sizes, numbers[where]), bounds):
            column.add(np.diff(bound, prepend=0), values)
        groups, lo = self.shown(a, b, a_sizes, b_sizes), 0
        for hi in last.tolist():
            texts.append(";".join(groups[lo:hi]))
            lo = hi

    def _chunks(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        held: list[Ragged] = [Ragged() for _ in range(5)]
        texts: list[str | None] = []
        joint = [c[0] in " \n" and len(c) <= _LONG and not c[-1].isspace() for c in chunks]
        order = [c for c, x in zip(chunks, joint) if x]
        for lo in range(0, len(order), _TOGETHER):
            self._together(order[lo : lo + _TOGETHER], held, texts)
        for c, x in zip(chunks, joint):
            if not x:
                self._together([c], held, texts)
        joint = np.array(joint)
        place = np.where(joint, np.cumsum(joint) - 1, len(order) + np.cumsum(~joint) - 1)
        self.texts += map(texts.__getitem__, place.tolist())
        return [column.take(place)[::-1] for column in held]

    def shown(self, a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> list[str]:
        """Each group in decimal, ``a1,a2|b1``."""
        a, b = [self.a_text[i] for i in a.tolist()], [self.b_text[i] for i in b.tolist()]
        places = zip((np.cumsum(a_sizes) - a_sizes).tolist(), (np.cumsum(b_sizes) - b_sizes).tolist(), a_sizes.tolist(), b_sizes.tolist())
        return [a[i] + "|" + b[j] if n == m == 1 else ",".join(a[i : i + n]) + "|" + ",".join(b[j : j + m]) for i, j, n, m in places]

    def align(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each memory column: values of all texts' tokens and how many each text has; the last entry is of their shown groups."""
        lists = [CHUNKS.findall(" " + t) if t else [] for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        numbers = self.memo.numbers(list(chain.from_iterable(lists)))
        shown, ends, at = [], np.cumsum(counts), numbers.tolist()
        for lo, hi in zip((ends - counts).tolist(), ends.tolist()):
            groups = [self.texts[i] for i in at[lo:hi]]
            shown.append("" if None in groups else ";".join(groups))
        spelt = np.fromiter(map(bool, shown), bool, len(shown))
        numbers, counts = numbers[np.repeat(spelt, counts)], np.where(spelt, counts, 0)
        out = []
        for column in range(5):
            values, many = self.memo.take(column, numbers)
            bounds = np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(counts)])]
            out.append((values, np.diff(bounds)))
        return [*out, shown]


def _aligner(paths: tuple[str, str]) -> Aligner:
    return base.per_worker(("cross tokens", *paths), lambda: Aligner(*paths))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id``, ids of both tokenizers (``a``, ``b``) and how many of either each group has (``a_sizes``, ``b_sizes``)."""
    paths = paths or files()
    names = ["a", "b", "a_sizes", "b_sizes"]

    def make():
        aligner = _aligner(paths)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = aligner.align(batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(_lists(*x) for x in found[:4])], ["doc_id", *names])

        return each

    return base.map_batches(docs.select("doc_id", "text"), make, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


def blocks(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """A row of each document, with its distinct pairs by their place in its block's list (``at``) and their ``times``;
    and a row of each block with that list (``pairs``, a << 32 | b) and how many documents hold each (``rows``)."""
    paths = paths or files()
    schema = (
        "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, shown string,"
        " at array<int>, times array<int>, pairs array<long>, rows array<int>"
    )
    names = [x.split()[0] for x in schema.split(", ") for x in x.split(",")]

    def run(batches):
        aligner = _aligner(paths)
        task, block = TaskContext.get().partitionId(), 0
        place, pairs, rows, held = np.zeros(0, np.int64), [], [], 0

        def row(number: int, columns: dict, count: int) -> pa.RecordBatch:
            columns = columns | {"block": pa.array(np.full(count, task << 24 | number))}
            kinds = {"shown": pa.string(), "at": pa.list_(pa.int32()), "times": pa.list_(pa.int32()), "pairs": pa.list_(pa.int64()), "rows": pa.list_(pa.int32())}
            return pa.RecordBatch.from_arrays([columns[n] if n in columns else pa.nulls(count, kinds.get(n, pa.int64())) for n in names], names)

        def dictionary(number: int) -> pa.RecordBatch:
            keys = np.fromiter(aligner.pairs, np.int64, len(aligner.pairs))[np.concatenate(pairs)]
            counts = np.concatenate(rows).astype(np.int32)
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
            return row(number, {"pairs": one(keys), "rows": one(counts)}, 1)

        for batch in batches:
            for lo in range(0, batch.num_rows, base.ROWS):
                part = batch.slice(lo, base.ROWS)
                texts = part.column("text").to_pylist()
                (_, n_a), (_, n_b), (_, n_groups), _, (numbers, n_links), shown = aligner.align(texts)
                doc = np.repeat(np.arange(len(texts)), n_links)
                found, times = np.unique(doc << 32 | numbers, return_counts=True)
                doc, numbers = found >> 32, found & 0xFFFFFFFF
                if len(place) < len(aligner.pairs):
                    place = np.concatenate([place, np.full(len(aligner.pairs) - len(place), -1)])
                met = np.unique(numbers)
                new = met[place[met] < 0]
                count = sum(map(len, pairs))
                place[new] = count + np.arange(len(new))
                pairs.append(new)
                total = np.concatenate([*rows, np.zeros(len(new), np.int64)])
                rows = [total + np.bincount(place[numbers], minlength=len(total))]
                sizes = np.bincount(doc, minlength=len(texts))
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
                    "shown": pa.array(shown, pa.string()), "at": _lists(place[numbers], sizes), "times": _lists(times, sizes),
                }
                yield row(block, columns, len(texts))
                held += sum(len(t or "") for t in texts)
                if held >= BLOCK_CHARS:
                    yield dictionary(block)
                    place, pairs, rows, held, block = np.full(len(aligner.pairs), -1), [], [], 0, block + 1
                    if len(aligner.pairs) > 2_000_000:
                        aligner.pairs.clear()
                        aligner.memo.most, most = -1, aligner.memo.most
                        aligner.memo.numbers([])
                        aligner.memo.most, place = most, np.zeros(0, np.int64)
        if pairs:
            yield dictionary(block)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(made: DataFrame) -> DataFrame:
    """``pair``, ``docs`` (rows that hold it linked) and ``best`` (no pair of its A id has more)."""
    posted = made.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "rows")).alias("p"))
    counts = posted.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.rows").alias("docs"))
    counts = base.stored(counts, "pair-counts")
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a_id")).agg(F.max("docs").alias("most"))
    # A row for each id of A at most: the size of its vocabulary.
    return counts.join(F.broadcast(most), a == F.col("a_id")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def scored(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """A row of each document with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    digest = F.when(F.col("shown") != "", F.sha2("shown", 256)).otherwise("")
    made = blocks(docs, paths).withColumn("groups_sha256", digest).drop("shown")
    made = base.stored(made, "aligned-blocks")
    posted = made.where("pairs is not null").select(F.col("block").alias("owner"), F.posexplode("pairs").alias("place", "pair"))
    known = posted.join(pair_counts(made), "pair").select("owner", "place", "docs", "best")
    rows = made.where("pairs is null").drop("pairs", "rows")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def judged(_, rows: pa.Table, known: pa.Table) -> pa.Table:
        place = known["place"].to_numpy()
        counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        counts[place], best[place] = known["docs"].to_numpy(), known["best"].to_numpy()
        at, times = (rows[n].combine_chunks() for n in ("at", "times"))
        sizes = at.value_lengths().to_numpy()
        at, times = at.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        ends = np.cumsum(sizes)
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (times * best[at], times * counts[at])]
        n_best, count_sum = (x[ends] - x[ends - sizes] for x in sums)
        return pa.table({**{c: rows[c] for c in kept}, "n_best": n_best, "count_sum": count_sum, "groups_sha256": rows["groups_sha256"]})

    schema = ", ".join(f"{c} long" for c in [*kept, "n_best", "count_sum"]) + ", groups_sha256 string"
    return rows.groupBy("block").cogroup(known.groupBy("owner")).applyInArrow(judged, schema)


def query(spark, folder: str) -> DataFrame:
    return scored(base.read(spark, folder))
