"""What filters removed: aggregates over logs of (record, reason, filtered)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def short_reason(reason: Column) -> Column:
    """The reason up to its first comma, without a prefix that ends in a colon."""
    return F.element_at(F.split(F.element_at(F.split(reason, ","), 1), ": "), -1)


def per_record(log: DataFrame) -> DataFrame:
    return log.groupBy("record", short_reason(F.col("reason")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def by_reason(log: DataFrame, skip_first: str | None = None) -> DataFrame:
    """Filters, lines and records by reason, a total row, and shares of the totals rounded half-even to four places.

    skip_first leaves one record out of the sums, as older reports did with the first record of a log.
    """
    if skip_first is not None:
        log = log.where(F.col("record") != skip_first)
    rows = log.select("record", short_reason(F.col("reason")).alias("reason"), F.size(F.split("filtered", "\n")).alias("lines"))
    out = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("filters"), F.sum("lines").alias("lines"))
    total = out.agg(F.lit("total").alias("reason"), F.sum("filters").alias("filters"), F.sum("lines").alias("lines"))
    # The totals are one row, which every row of the result is held against.
    all_ = total.select(F.lit(1).alias("one"), F.col("filters").alias("f"), F.col("lines").alias("l"))
    return out.unionByName(total).withColumn("one", F.lit(1)).join(F.broadcast(all_), "one").select("reason", "filters", "lines", F.bround(F.col("filters") / F.col("f"), 4).alias("filter_share"), F.bround(F.col("lines") / F.col("l"), 4).alias("line_share"))
