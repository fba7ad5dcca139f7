"""Document fingerprints: SimHash of weighted terms and a search by permuted block tables.

Terms are pairs of adjacent lower-cased words (ASCII white space separates
words, the ends of a text count as empty words), weighted by their length.  Each
term's hash votes with its weight for or against each of 64 bits.  Votes are
summed in two lanes of 32 bits a long: 32 sums count all bits, for texts of less
than 4 billion characters.

Texts are dealt once, by runs of adjacent ids, so that a text meets the next one
in descending order of ids; the last one of a run gets a copy of the next run's
first.  Everything up to the likenesses happens in that one dealing.

The search cuts fingerprints into six blocks; two within three bits agree in at
least three of them, so 20 tables, each with three blocks as its leading key,
find every neighbour, and a pair counts in the first table where it meets.

Edge cases: a null, empty or blank text has fingerprint 0; rows without id
follow all others, repeated ids follow each other by text; a table of one row is
its own next; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import base, hamming
from tidemark.llm.quality_rules import bound, words

RADIUS = 3
_SIZES = (11, 11, 11, 11, 10, 10)
_BLOCKS = [(1 << n) - 1 << sum(_SIZES[:i]) for i, n in enumerate(_SIZES)]
MASKS = [sum(three) for three in combinations(_BLOCKS, 3)]
#: Ids of one run; more where the id range would need more than so many runs.
RUN_IDS, MAX_RUNS = 512, 100_000
_LAST = -(1 << 63)


def pairs(before: Column, words: Column) -> Column:
    """Adjacent words (``0``, ``1``) of a text's ``words`` that follow the word ``before`` (null: they open it)."""
    lead = F.concat(F.array(before), words)
    return F.when(F.size(words) > 0, F.arrays_zip(lead.alias("0"), words.alias("1")))


def weighted(*keys: str) -> list[Column]:
    """Hash ``h`` and weight ``w`` of the pair ``t``, beside ``keys``; no pair has neither."""
    a, b = F.col("t")["0"], F.col("t")["1"]
    size = F.coalesce(F.char_length(a), F.lit(0)) + F.coalesce(F.char_length(b), F.lit(0))
    some = F.col("t").isNotNull()
    return [*keys, F.when(some, F.xxhash64(a, b, F.lit(0))).alias("h"), F.when(some, size.cast("long")).alias("w")]


def voted() -> list[Column]:
    """Sums over rows with ``h`` and ``w``: all weights, and two bits' votes in each pair of lanes."""
    lanes = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(0x1_0000_0001)) * F.col("w")).alias(f"v{i}") for i in range(32)]
    return [F.sum("w").alias("all"), *lanes]


def majority() -> Column:
    found = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"v{i}", 32)
        for at, votes in ((i, low), (i + 32, high)):
            won = F.when(2 * votes > F.col("all"), F.lit(hamming.signed(1 << at)))
            found = found.bitwiseOR(won.otherwise(F.lit(0).cast("long")))
    return found


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` of every row; ids must be unique here."""
    split = words(F.lower(F.coalesce(text, F.lit(""))))
    each = docs.select("doc_id", F.explode_outer(bound(split, lambda w: pairs(F.lit(None).cast("string"), w))).alias("t"))
    return each.select(weighted("doc_id")).groupBy("doc_id").agg(*voted()).select("doc_id", majority().alias("fp"))


def in_runs(docs: DataFrame) -> DataFrame:
    """Rows with ``run``, ``at`` (order), ``edge``: each run ends with a copy of the next row's text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_LAST)).alias("at"))
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = max(RUN_IDS, -(-((high or 0) - (low or 0) + 1) // MAX_RUNS))
    rows = rows.withColumn("run", F.when(F.col("doc_id").isNull(), F.lit(_LAST)).otherwise(F.floor(F.col("at") / F.lit(width).cast("decimal(20,0)")).cast("long")))
    # At most MAX_RUNS + 1 rows.
    tops = rows.groupBy("run").agg(F.max("at").alias("at"))
    order = Window.orderBy(F.desc("run"))
    whole = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    to = tops.select("at", F.coalesce(F.lag("run").over(order), F.last("run").over(whole)).alias("to"))
    edges = rows.select("at", "text").join(F.broadcast(to), "at").groupBy("to", "at").agg(F.min("text").alias("text"))
    main = rows.select("run", "at", "doc_id", "text", F.lit(0).alias("edge"))
    return main.union(edges.select(F.col("to").alias("run"), "at", F.lit(None).cast("long"), "text", F.lit(1)))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likenesses.

    The edited text is the text with its last third (rounded down, in code
    points) replaced by as many first code points of the next text.
    """
    order = Window.partitionBy("run").orderBy("edge", F.desc("at"), "text")
    rows = in_runs(docs).select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    kept, rest = F.substring("text", F.lit(1), n - third), F.substring("text", n - third + 1, third)
    inserted = F.substring(F.coalesce("next", F.lit("")), F.lit(1), third)
    rows = rows.select("run", "place", "doc_id", "edge", n.cast("long").alias("n_chars"), kept.alias("kept"), rest.alias("rest"), inserted.alias("inserted"))
    rows = rows.withColumn("digest", F.sha2(F.concat("kept", "inserted"), 256))
    rows = rows.select("run", "place", "doc_id", "edge", "n_chars", "digest", F.explode(_sides()).alias("p")).where("edge = 0 or p.side = 0")
    digest = F.when(F.col("p.side") == 1, F.col("digest")).alias("sha")
    rows = rows.select("run", "place", "doc_id", "edge", "n_chars", "p.side", digest, F.explode_outer("p.pairs").alias("t"))
    # Runs are whole in their partition, so these groups need no exchange.
    keys = ("run", "place", "side", "doc_id", "edge", "n_chars", "sha")
    found = rows.select(weighted(*keys)).groupBy(*keys).agg(*voted()).select(*keys, majority().alias("fp"))
    by = Window.partitionBy("run").orderBy("place", "side")
    found = found.select(
        "*",
        F.lead("sha").over(by).alias("edited_sha256"),
        F.lead("fp").over(by).alias("edited_fp"),
        F.lead("fp", 2).over(by).alias("next_fp"),
    )
    return found.where("edge = 0 and side = 0").select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")


def _sides() -> Column:
    """Pairs of the text (side 0) and of the edited text (1).

    Both texts begin with ``kept``; its words but the last, which either text
    may continue, are the same in both and are split once.
    """
    gap = F.when(F.col("kept").rlike("[ \\t-\\r]$"), F.lit(" ")).otherwise(F.lit(""))

    def of(w: Column) -> Column:
        shared = F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0)))
        last = F.coalesce(F.get(w, F.size(w) - 1), F.lit(""))

        def whole(text: str) -> Column:
            return bound(F.concat(shared, words(F.concat(last, gap, F.lower(text)))), lambda x: pairs(F.lit(None).cast("string"), x))

        return F.array(*(F.struct(F.lit(side).alias("side"), whole(text).alias("pairs")) for side, text in ((0, "rest"), (1, "inserted"))))

    return bound(words(F.lower("kept")), of)


def likeness(a: str, b: str) -> Column:
    return 1 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / F.lit(64.0)


def neighbours(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs (``query``, ``fp``) of distinct fingerprints (column ``fp`` of both) within ``RADIUS`` bits, each once; ``rows`` is carried."""
    q = hamming.posted(queries, MASKS).select("key", F.col("fp").alias("query"))
    e = hamming.posted(entries, MASKS)
    differ = F.col("query").bitwiseXOR(F.col("fp"))
    pairs = q.join(e, (q["key"] == e["key"]) & (F.bit_count(differ) <= RADIUS) & (q["key"].bitwiseAND(F.lit(31)) == hamming.first_table(differ, MASKS)))
    return pairs.select("query", "fp").join(entries, "fp")


def shown(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def query(spark, folder: str) -> DataFrame:
    """Every row; ``n_near``, for ids divisible by 100, is how many rows lie within the radius, itself included."""
    rows = base.stored(compared(base.read(spark, folder)), "document-fingerprints")
    entries = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("rows"))
    asked = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False))
    pairs = neighbours(rows.where(asked).select("fp").distinct(), entries)
    near = pairs.groupBy("query").agg(F.sum("rows").alias("found"))
    # Rows that ask nothing take no part in the join.
    answered = rows.where(asked).join(near, F.col("fp") == F.col("query")).select(*rows.columns, "found")
    joined = answered.union(rows.where(~asked).select("*", F.lit(None).cast("long").alias("found")))
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown("fp").alias("fingerprint"),
        shown("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
        F.col("found").alias("n_near"),
    )
