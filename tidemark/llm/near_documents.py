"""SimHash near-duplicates by an inverted index of positional bytes.

A document's fingerprint holds the majority bits of the XXH64 of its word
shingles.  Two fingerprints within ``RADIUS`` bits differ in at most ``RADIUS``
of their eight bytes, so they share at least four bytes at the same positions.
A posting list of one positional byte would hold a 256th of all documents, so
the index posts triples of positional bytes: the 20 triples are chosen such that
any four positions hold one of them.  Pairs that meet tally their shared
positional bytes, those below the guaranteed minimum go, the rest are verified
by their differing bits.

Exact copies of a fingerprint are one entry of the index.  Dense groups of near
copies are compared in blocks that return spanning forests, never all pairs.

Edge cases: a null, empty or blank text has fingerprint zero and links like any
other; equal ids and repeated rows are fine (a row each); a row without id has
neither component nor influence, and the stage keeps it; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, hamming
from tidemark.llm.components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
_PART = 1 << 16


def fingerprint(text: bytes | None) -> int:
    """Unsigned 64-bit majority of the shingle hashes; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    n = max(1, len(words) - SHINGLE + 1)
    lo, hi = starts[:n].tolist(), (starts + sizes)[min(SHINGLE, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _PART):
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(lo[at : at + _PART], hi[at : at + _PART])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (as a signed long) of every row."""

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

        return each

    return base.map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), make, "doc_id long, fp long")


def index_masks() -> list[int]:
    """Bit masks of the 20 byte triples.

    The positions are dealt to three groups in a ring; a triple lies within a
    group, or has two in a group and one in the next.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]

    def taken(triple) -> bool:
        in_group = sorted(triple, key=lambda i: group[i])
        counts = [sum(group[i] == g for i in in_group) for g in range(3)]
        return any(counts[g] == 3 or (counts[g] == 2 and counts[(g + 1) % 3] == 1) for g in range(3))

    return [sum(0xFF << (8 * i) for i in triple) for triple in combinations(range(8), 3) if taken(triple)]


def near(differ: Column) -> Column:
    """Count filter on shared positional bytes, then verification."""
    shared = sum(F.when(differ.bitwiseAND(F.lit(hamming.signed(0xFF << (8 * i)))) == 0, 1).otherwise(0) for i in range(8))
    return (shared >= 8 - RADIUS) & (F.bit_count(differ) <= RADIUS)


def grouped(fps: DataFrame) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` of every row of ``fps`` (``doc_id``, ``fp``), which must be stored."""
    known = fps.where("doc_id is not null")
    entries = known.groupBy("fp").agg(F.min("doc_id").alias("first"))
    masks = index_masks()
    members = base.stored(hamming.linked(hamming.posted(entries.select("fp"), masks), masks, near), "near-members")
    edges = hamming.forest(hamming.in_blocks(members.withColumn("node", F.col("fp"))), masks, RADIUS, "long")
    roots = components(edges)
    joined = roots.join(entries, roots["node"] == entries["fp"]).select("node", "root", "first")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    moved = joined.join(least, "root").select("node", "least")
    # A fingerprint outside every link is its own component: its first id.
    named = entries.join(moved, entries["fp"] == moved["node"], "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    with_id = fps.join(named, "fp", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return with_id.select("doc_id", "fp", "component_id")


def query(spark, folder: str) -> DataFrame:
    found = grouped(base.stored(fingerprints(base.read(spark, folder)), "fingerprints"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each component, that of its least id; rows without id stay."""
    found = grouped(base.stored(fingerprints(docs), "fingerprints"))
    keep = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies"))
    rows = docs.select(*base.DOCUMENT)
    kept = rows.join(keep, "doc_id")
    # Rows that repeat an id: the least by text, source and language stays.
    repeated = kept.where("copies > 1").groupBy("doc_id").agg(F.min(F.struct(*base.DOCUMENT[1:])).alias("least"))
    single = kept.where("copies = 1").select(*base.DOCUMENT)
    return single.union(repeated.select("doc_id", "least.*")).union(rows.where("doc_id is null"))
