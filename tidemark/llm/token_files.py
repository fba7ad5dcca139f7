"""Token ids in ORC files.

Documents are dealt by runs of adjacent ids (shards), tokenized, and written in
ascending id order: a folder per shard, ORC with integer run-length encoding of
ids, a row index every ``ROW_INDEX`` rows and Bloom filters on ``doc_id``.
Stripes are the unit of parallel reading; a reader that wants a few documents
skips shards, stripes and row groups by their statistics and filters
(``lookup``).

The tokenizer treats what white space separates independently, so a worker
encodes a chunk of characters once and keeps its ids: texts are put together
from chunks.

Edge cases: a null or blank text has the end id alone; rows without id come
first; rows of equal id follow each other by text; extra columns are ignored; an
empty table writes no rows.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import base
from tidemark.session import work_folder

END_ID = 1
SHARD_IDS, MAX_SHARDS = 1024, 100_000
STRIPE_BYTES, ROW_INDEX = 16 << 20, 1000
_SPECIAL = "<|endoftext|>"
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_CACHE_CHUNKS = 1_000_000


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Numbers(dict):
    """Numbers chunks as they are first asked for, and lists the new ones."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


def encoder(path: str):
    """Texts (UTF-8) to id arrays, equal to encoding each text whole."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    mark = tokenizer.token_to_id(_SPECIAL)
    last = np.zeros(tokenizer.get_vocab_size(), bool)  # ids that end a word
    for token, i in tokenizer.get_vocab().items():
        last[i] = token.endswith("</w>")
    known = _Numbers()
    # By number: where a chunk's ids begin in ``flat``, and how many they are.  All three grow by doubling.
    flat, starts, sizes, used = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0

    def library(chunks: list[bytes], numbers: np.ndarray) -> None:
        """Holds the ids of numbered chunks; many share one call."""
        texts = b"\n".join(chunks).decode().split("\n")  # chunks hold no line feed
        alpha = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        marked = np.fromiter(("<|" in t for t in texts), bool, len(texts))  # may hold an added token
        plain = np.flatnonzero(alpha)  # one word each, so its last id tells
        other = np.flatnonzero(~alpha & ~marked)  # an added token between them tells
        for group, words in ((plain, True), (other, False)):
            for lo in range(0, len(group), 2000):
                at = group[lo : lo + 2000]
                some = [texts[i] for i in at.tolist()]
                if words:
                    ids = np.array(tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.int32)
                    found = np.diff(np.flatnonzero(last[ids]), prepend=-1)
                if not words or len(found) != len(some):  # lower case gave one of them another word
                    ids = np.array(tokenizer.encode(_SPECIAL.join(some), add_special_tokens=False).ids, np.int32)
                    found = np.diff(np.flatnonzero(ids == mark), prepend=-1, append=len(ids)) - 1
                    ids = ids[ids != mark]
                hold(numbers[at], found, ids)
        for i in np.flatnonzero(marked).tolist():
            ids = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids, np.int32)
            hold(numbers[i : i + 1], np.array([len(ids)]), ids)

    def gathered(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered chunks one after another, and how many each has."""
        many = sizes[at]
        ends = np.cumsum(many)
        n = int(ends[-1]) if len(ends) else 0
        return flat[np.repeat(starts[at] - (ends - many), many) + np.arange(n)], many

    def hold(numbers: np.ndarray, many: np.ndarray, ids: np.ndarray) -> None:
        nonlocal flat, used
        while used + len(ids) > len(flat):
            flat = np.concatenate([flat, np.zeros_like(flat)])
        starts[numbers], sizes[numbers] = used + np.cumsum(many) - many, many
        flat[used : used + len(ids)] = ids
        used += len(ids)

    def learn() -> None:
        """A run of marks after an ASCII letter or digit is a word of its own: such chunks are put together from two."""
        nonlocal starts, sizes
        new, met = known.new, len(known.new)
        first = len(known) - met  # new chunks are numbered on from here
        single, joint, parts = [], [], []
        for i in range(met):
            c = new[i]
            stem = c.rstrip(_MARKS)
            if stem and len(stem) < len(c) and stem[-1] < 128 and b"<|" not in c:
                joint.append(i)
                parts.append(known[stem])
                parts.append(known[c[len(stem) :]])
            else:
                single.append(i)
        single += range(met, len(new))  # stems and marks met first here
        while len(known) > len(starts):
            starts, sizes = np.append(starts, np.zeros_like(starts)), np.append(sizes, np.zeros_like(sizes))
        if single:
            library([new[i] for i in single], first + np.array(single))
        if joint:
            ids, many = gathered(np.array(parts))
            hold(first + np.array(joint), many.reshape(-1, 2).sum(1), ids)
        new.clear()

    def encode(texts: list[bytes | None]) -> list[np.ndarray]:
        nonlocal used
        # The tokenizer lower-cases; an added token is one only as it is written.
        lists = [((t if b"<|" in t else t.lower()) if t else b"").split() for t in texts]
        if len(known) > _CACHE_CHUNKS:
            known.clear()
            used = 0
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(lists)), np.int64, int(counts.sum()))
        if known.new:
            learn()
        ids, many = gathered(at)
        ends = np.concatenate([[0], np.cumsum(many)])[np.cumsum(counts)]
        return np.split(np.insert(ids, ends, END_ID), (ends + np.arange(1, len(ends) + 1))[:-1])

    return encode


def encoded(rows: DataFrame, path: str) -> DataFrame:
    """``shard``, ``doc_id`` and ``ids`` in the rows' order."""

    def make():
        encode = base.per_worker(("token ids", path), lambda: encoder(path))

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            texts = batch.column("text").to_pylist()
            for lo in range(0, len(texts), 256):
                found += encode(texts[lo : lo + 256])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            return pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("doc_id"), ids], ["shard", "doc_id", "ids"])

        return each

    return base.map_batches(rows, make, "shard long, doc_id long, ids array<int>")


def write(docs: DataFrame, target: str, path: str | None = None) -> None:
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = max(SHARD_IDS, -(-((high or 0) - (low or 0) + 1) // MAX_SHARDS))
    # Rows without id form the lowest shard.
    shard = F.coalesce(F.floor(F.col("doc_id") / F.lit(width).cast("decimal(20,0)")).cast("long"), F.lit(-(1 << 62)))
    rows = docs.select(shard.alias("shard"), "doc_id", F.col("text").cast("binary").alias("text"))
    rows = rows.repartition("shard").sortWithinPartitions("shard", "doc_id", "text")
    writer = encoded(rows, path or vocabulary()).sortWithinPartitions("shard", "doc_id").write.partitionBy("shard")
    writer.option("orc.compress", "ZSTD").option("orc.stripe.size", str(STRIPE_BYTES)).option(
        "orc.row.index.stride", str(ROW_INDEX)
    ).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(target)


def read(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema("doc_id long, ids array<int>, shard long").orc(target)


def lookup(spark: SparkSession, target: str, ids: list[int]) -> DataFrame:
    """Documents by id; the predicate reaches the files' statistics and Bloom filters."""
    return read(spark, target).where(F.col("doc_id").isin(list(ids))).select("doc_id", "ids")


def summary(spark: SparkSession, target: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document in the files."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column("ids")
            values, offsets = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            columns = [batch.column("shard"), batch.column("doc_id"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "n_tokens", "ids_crc32"])

        return each

    sizes = base.stored(base.map_batches(read(spark, target), make, "shard long, doc_id long, n_tokens long, ids_crc32 long"), "token-sizes")
    # A row per shard, at most MAX_SHARDS.
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("all"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard").orderBy("doc_id", "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    joined = placed.join(F.broadcast(starts), "shard")
    return joined.select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def query(spark, folder: str) -> DataFrame:
    target = work_folder(spark, "token-files")
    write(base.read(spark, folder), target)
    return summary(spark, target)
