"""Crawl frontiers over a known link table: url and status (0 new, 1 done, -1 failed).

Defined results: null addresses and targets are never reached; repeated links and seeds count once; an empty table of seeds gives
an empty result, an empty link table failed seeds; further columns are ignored, but content_marks keeps them.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import materialised

STATES = "url string, status int"


def step(states: DataFrame, links: DataFrame) -> DataFrame:
    """New addresses are visited: done where the table has them, else failed; the targets not seen before are new."""
    new = states.where("status = 0")
    pages = links.select("url").distinct()
    visited = new.select("url").join(pages.withColumn("there", F.lit(True)), "url", "left").select("url", F.when(F.col("there"), 1).otherwise(-1).alias("status"))
    targets = new.select("url").join(links, "url").select(F.col("target").alias("url")).distinct().join(states.select("url"), "url", "left_anti").select("url", F.lit(0).alias("status"))
    return states.where("status <> 0").unionByName(visited).unionByName(targets)


def crawl(seeds: DataFrame, links: DataFrame, rounds: int | None = None, stage=materialised) -> DataFrame:
    """Rounds until nothing is new, or so many if they are given."""
    states = seeds.select("url", F.lit(0).alias("status")).distinct()
    for _ in itertools.count() if rounds is None else range(rounds):
        states = stage(step(states, links))
        if states.where("status = 0").isEmpty():
            break
    return states


def progress(states: DataFrame) -> DataFrame:
    return states.agg(F.count(F.lit(1)).alias("known"), F.count_if(F.col("status") != 0).alias("visited"), F.count_if(F.col("status") < 0).alias("failed"))


def content_marks(content: DataFrame) -> DataFrame:
    """hash and is_duplicate: of equal contents the one with the smallest id is no duplicate. Null contents are equal to one another and have a null hash."""
    rows = content.withColumn("hash", F.md5("content"))
    first = rows.groupBy(F.col("hash").alias("_hash")).agg(F.min("id").alias("_first"))
    return rows.join(first, F.col("hash").eqNullSafe(F.col("_hash"))).withColumn("is_duplicate", (F.col("id") > F.col("_first")).cast("int")).drop("_first", "_hash")


def highest_number(names: DataFrame, name: str, extension: str = "json") -> DataFrame:
    """The highest number of files that are named by numbers; one row, NULL without any."""
    return names.agg(F.max(F.nullif(F.regexp_extract(name, rf"^(\d+)\.{extension}$", 1), F.lit("")).try_cast("bigint")).alias("highest"))
