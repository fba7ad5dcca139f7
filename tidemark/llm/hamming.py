"""Links between distinct 64-bit fingerprints, without forming all pairs of a group.

A table is a bit mask: two fingerprints meet in it when they agree on its bits.
The caller's masks must be such that any two fingerprints within the radius meet
in at least one.  Only fingerprints that have a true neighbour in a table go on;
there, each table value's members are compared in blocks of bounded size, and a
block gives a spanning forest of its links, so a group of n gives fewer than n
links for each block instead of n * n / 2.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def keys(masks: list[int]) -> list[Column]:
    """The key of each table; its low bits hold the table's number."""
    assert len(masks) <= 32
    return [
        F.shiftleft(F.xxhash64(F.col("fp").bitwiseAND(F.lit(signed(m)))), 5).bitwiseOR(F.lit(t).cast("long"))
        for t, m in enumerate(masks)
    ]


def posted(prints: DataFrame, masks: list[int]) -> DataFrame:
    """A row (``fp``, ``key``) for each table, in the order that lets a self-join share one exchange."""
    return prints.select("fp", F.explode(F.array(*keys(masks))).alias("key"))


def first_table(differ: Column, masks: list[int]) -> Column:
    """The first table in which two fingerprints of this xor meet, else null."""
    found = F.when(F.lit(False), 0)
    for table, mask in enumerate(masks):
        found = found.when(differ.bitwiseAND(F.lit(signed(mask))) == 0, table)
    return found


def linked(postings: DataFrame, masks: list[int], near: Callable[[Column], Column]) -> DataFrame:
    """Postings of distinct fingerprints that have a neighbour whom they first meet there; ``near`` judges the xor of two."""
    a, b = postings.alias("a"), postings.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    met = F.col("a.key").bitwiseAND(F.lit(31)) == first_table(differ, masks)
    return a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") != F.col("b.fp")) & near(differ) & met, "left_semi")


def in_blocks(members: DataFrame) -> DataFrame:
    """Members dealt to pairs of blocks: any two of a key share exactly one or are in one block together."""
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return paired.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).drop("blocks", "own", "other")


def forest(members: DataFrame, masks: list[int], radius: int, node_type: str, verify: Callable[[str, str], bool] | None = None) -> DataFrame:
    """Edges (``a``, ``b``) that span the links of ``in_blocks`` rows; with ``verify`` a link must pass it on the rows' ``text``.

    A pair is judged only under the first table in which it meets, so no pair
    is verified twice however many tables it shares.
    """
    table = np.array(masks, np.uint64)
    columns = ["key", "lo", "hi", "node", "fp", *(["text"] if verify else [])]

    def spanning(fps: np.ndarray, own: int, nodes: list, texts: list | None, out: list) -> None:
        left = np.arange(len(fps))
        while len(left) > 1:
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                one = queue.pop()
                close = np.bitwise_count(fps[left] ^ fps[one]) <= radius
                if close.any():
                    at = left[close]
                    shared = ((fps[at] ^ fps[one])[:, None] & table) == 0
                    close[close] = shared.argmax(1) == own
                    at = left[close]
                    if texts is not None and len(at):
                        good = np.array([verify(texts[one], texts[i]) for i in at])
                        close[close] = good
                        at = at[good]
                    out += [(nodes[one], nodes[i]) for i in at]
                    queue += at.tolist()
                    left = left[~close]

    def run(batches):
        rest = None
        for batch in chain(batches, [None]):
            held = [b for b in (rest, batch) if b is not None and b.num_rows]
            if not held:
                continue
            part = pa.Table.from_batches(held).combine_chunks()
            ids = np.stack([part[c].to_numpy() for c in ("key", "lo", "hi")])
            starts = np.flatnonzero(np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(0)]))
            bounds = [*starts.tolist(), part.num_rows]
            if batch is not None:  # the last group may go on
                rest = part.slice(bounds[-2]).to_batches()[0]
                bounds.pop()
            fps, tables = part["fp"].to_numpy().view(np.uint64), ids[0] & 31
            nodes, texts = part["node"].to_pylist(), part["text"].to_pylist() if verify else None
            out: list = []
            for lo, hi in zip(bounds, bounds[1:]):
                if hi - lo > 1:
                    spanning(fps[lo:hi], tables[lo], nodes[lo:hi], texts[lo:hi] if verify else None, out)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(side) for side in zip(*out)], ["a", "b"])

    dealt = members.select(*columns).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return dealt.mapInArrow(run, f"a {node_type}, b {node_type}")
