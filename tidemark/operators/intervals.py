"""Containment of commits in the intervals of loads, by time bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_SECONDS = 3600


def _bin(moment: str, seconds: int) -> Column:
    return F.floor(F.col(moment).cast("timestamp").cast("double") / seconds).cast("long")


def commits_inside_loads(commits: DataFrame, loads: DataFrame, bin_seconds: int = BIN_SECONDS) -> DataFrame:
    """Commits with ``inside_load``: start < before <= after < end of any load of their table.

    ``commits``: source_table, before_commit, after_commit, ...; ``loads``:
    source_table, load_start, load_end, any number of them per table, which may
    overlap and repeat.  A load is put into every bin of ``bin_seconds`` that it
    touches and a commit into the bin of its beginning, so both meet by
    equality on (table, bin): no nested loop, and a commit meets only loads of
    its own hour.  Each commit gives one row, however many loads hold it.  Give
    loads of years wider bins: a load is one row per bin.
    """
    known = loads.select("source_table", "load_start", "load_end").distinct().where("load_start < load_end")
    bins = F.sequence(_bin("load_start", bin_seconds), _bin("load_end", bin_seconds))
    placed = known.select(F.col("source_table").alias("_load_table"), "load_start", "load_end", F.explode(bins).alias("_load_bin"))
    dated = commits.withColumn("_bin", _bin("before_commit", bin_seconds))
    inside = (
        (F.col("source_table") == F.col("_load_table"))
        & (F.col("_bin") == F.col("_load_bin"))
        & (F.col("load_start") < F.col("before_commit"))
        & (F.col("before_commit") <= F.col("after_commit"))
        & (F.col("after_commit") < F.col("load_end"))
    )
    held = dated.join(placed, inside, "left_semi").withColumn("inside_load", F.lit(True))
    rest = dated.join(placed, inside, "left_anti").withColumn("inside_load", F.lit(False))
    return held.unionByName(rest).drop("_bin")
