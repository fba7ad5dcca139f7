"""Mixing sources to target weights by Poisson replication.

A source of n rows whose target share of the total is w has the mean repetition
rate total * w / n.  Each row draws its number of copies by inverting the
Poisson distribution function of its source's rate at a number in [0, 1) taken
from the MD5 of seed and id, so a rerun on any cluster gives the same copies.
Copies are dealt to partitions and sorted there by an MD5 of seed, id and copy
number, which is a uniform global shuffle without sampled ranges.

Without weights given, the target share of a source is its row count to the
power ``POWER``, normalised, which flattens large sources.

The table of rates has a row per source.  It is broadcast where its counted rows
and the distribution's terms are few, otherwise joined by shuffle, where the
engine splits a source that holds many rows.

Edge cases: a null source is a source of its own; sources without a weight, or
with weight 0, get no copies; a null id draws by the MD5 of its text; rows equal
in id draw alike; extra columns are dropped; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import base

SEED, POWER = 20240229, 0.5
BROADCAST_SOURCES, BROADCAST_RATE = 10_000, 1_000.0


def rates(docs: DataFrame, weights: dict[str | None, float] | None, total: int | None, power: float) -> DataFrame:
    """``source`` and its mean number of copies of a row, ``rate``."""
    sizes = base.stored(docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows")), "source-sizes")
    if weights is None:
        shares = sizes.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(power)))
    else:
        given = docs.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "name string, weight double")
        shares = sizes.join(given, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    # Two numbers come here; a row per source stays in its table.
    weighed = shares.agg(F.sum("weight")).first()[0]
    wanted = float(total if total is not None else sizes.agg(F.sum("rows")).first()[0] or 0)
    if not weighed:
        return shares.select("source", F.lit(0.0).alias("rate")).where("rate > 0")
    return shares.select("source", (F.lit(wanted) * F.col("weight") / F.lit(weighed) / F.col("rows")).alias("rate")).where("rate > 0")


def distributions(rated: DataFrame) -> DataFrame:
    """``source`` and ``below``: the Poisson distribution function at 0, 1, ... until nothing is left in double precision."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 24).cast("int")
    steps = rated.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    order = Window.partitionBy("source", "rate").orderBy("k")
    log_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(order)
    terms = steps.withColumn("p", F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial))
    summed = terms.withColumn("upto", F.sum("p").over(order))
    return summed.groupBy("source").agg(F.array_sort(F.collect_list("upto")).alias("below"))


def drawn(text: Column) -> Column:
    """A number in [0, 1) with 52 bits."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mixed(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    total: int | None = None,
    power: float = POWER,
    seed: int = SEED,
) -> DataFrame:
    """Copies of rows in random order: the columns of documents, ``copy`` from 1, ``copies`` and ``shuffle_key``."""
    rows = docs.select(*base.DOCUMENT)
    rated = base.stored(rates(rows, weights, total, power), "rates")
    n, most = rated.agg(F.count(F.lit(1)), F.max("rate")).first()
    table = distributions(rated).withColumnRenamed("source", "_source")
    if n <= BROADCAST_SOURCES and (most or 0) <= BROADCAST_RATE:
        table = F.broadcast(table)  # counted: at most so many rows of about BROADCAST_RATE numbers
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    at = drawn(F.concat_ws("|", F.lit(str(seed)), key))
    joined = rows.join(table, F.col("source").eqNullSafe(F.col("_source")))
    counted = joined.withColumn("_at", at).withColumn("copies", F.size(F.filter("below", lambda x: x <= F.col("_at"))))
    each = counted.where("copies > 0").select(*base.DOCUMENT, "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    keyed = each.withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("order"), key, F.col("copy").cast("string"))))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def query(spark, folder: str) -> DataFrame:
    return mixed(base.read(spark, folder))


def stage(spark, docs: DataFrame, folder: str) -> DataFrame:
    return mixed(docs).select(*base.DOCUMENT)


ORACLE = f"""
with sizes as (
  select source, count(*) as n, pow(cast(count(*) as double), {POWER}) as weight from documents group by source
), rated as (
  select source, (select sum(n) from sizes) * weight / (select sum(weight) from sizes) / n as rate from sizes
), steps as (
  select source, rate, unnest(range(0, cast(ceil(rate + 12 * sqrt(rate) + 25) as bigint))) as k from rated
), terms as (
  select source, k, exp(k * ln(rate) - rate - sum(ln(greatest(k, 1))) over (partition by source order by k)) as p from steps
), summed as (
  select source, sum(p) over (partition by source order by k) as upto from terms
), keyed as (
  select *, coalesce(cast(doc_id as varchar), md5(coalesce(text, ''))) as key from documents
), placed as (
  select *, cast(cast('0x' || substr(md5('{SEED}|' || key), 1, 13) as bigint) as double) / 4503599627370496.0 as at from keyed
), counted as (
  select p.doc_id, text, lang, p.source, n_chars, key,
         (select count(*) from summed s where s.source is not distinct from p.source and s.upto <= p.at) as copies
  from placed p
), each as (
  select *, unnest(range(1, copies + 1)) as copy from counted where copies > 0
)
select doc_id, text, lang, source, n_chars, cast(copies as integer) as copies, cast(copy as integer) as copy,
       md5('{SEED}|order|' || key || '|' || copy) as shuffle_key
from each
"""
