"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

Each normalised text is cut behind windows of four bytes whose low half-bytes match a fixed rule (about one window in 240
does), at least 32 bytes apart. A cut depends on the bytes around it alone, so equal stretches give equal chunks wherever
they stand, and after an insertion the old cuts come back at once. A chunk travels as a weak 64-bit hash and its SHA-256,
never as text. The chunk dictionary verifies weak hashes: two chunks under one weak hash whose digests differ get different
ordinals, and a chunk's identifier is (weak hash, ordinal). Documents are then grouped by their ordered identifier lists and
by nothing else; text_sha256 is a column of the row that stays.

Defined results: null text counts as empty and all empty texts are equal; a null doc_id sorts after all others; of
repeated rows one stays; an empty table gives an empty result; further columns are ignored. A text without cuts (one letter
repeated) is cut every most_chunk bytes. A hot chunk or group is combined map-side before each shuffle, and the joins back
have two plain sides, which adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, staged, text_of

#: A cut falls behind four bytes, written in hexadecimal, whose low halves are in these classes.
WINDOW = ".[4-7].[0-3].[89AB].[C-F]"
WINDOW_BYTES = 4


def chunk_pattern(least: int, most: int) -> str:
    """Chunks of a text in hexadecimal: up to the first window behind the least length, else the most bytes."""
    return rf"(?:..){{{max(0, least - WINDOW_BYTES)},{most - WINDOW_BYTES}}}?{WINDOW}|(?:..){{1,{most}}}"


def exact_dedup(docs: DataFrame, least_chunk: int = 32, most_chunk: int = 8192, weak: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_chunks for each row of docs(doc_id, text).

    Texts are equal when identical without white space. The row with the most code points, then the smallest doc_id stays.
    weak: the 64-bit hash that the chunk dictionary is built on; a bad one costs time, not right results.
    """
    norm = docs.select("doc_id", F.length(text_of("text")).alias("points"), F.regexp_replace(text_of("text"), SPACE_CLASS + "+", "").alias("norm"))
    chunks = F.transform(
        F.regexp_extract_all(F.hex(F.col("norm").cast("binary")), F.lit(chunk_pattern(least_chunk, most_chunk)), F.lit(0)),
        lambda c: F.struct(weak(c).cast("long").alias("weak"), F.unhex(F.sha2(c, 256)).alias("strong")),
    )
    meta = staged(
        norm.select("doc_id", "points", F.sha2("norm", 256).alias("sha"), chunks.alias("chunks")).withColumn("uid", F.monotonically_increasing_id()),
        "dedup-chunks",
    )
    placed = meta.select("uid", F.posexplode_outer("chunks").alias("pos", "chunk")).select("uid", "pos", "chunk.weak", "chunk.strong")
    verified = (
        placed.where("pos is not null").groupBy("weak", "strong").agg(F.count(F.lit(1)).alias("uses"))
        .select("weak", "strong", F.row_number().over(Window.partitionBy("weak").orderBy("strong")).alias("ordinal"))
    )
    recipes = (
        placed.join(verified, ["weak", "strong"], "left").groupBy("uid")
        .agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "weak", "ordinal")))).alias("placed"))
        .select("uid", F.transform("placed", lambda p: F.struct(p["weak"].alias("weak"), p["ordinal"].alias("ordinal"))).alias("recipe"))
    )
    rows = staged(meta.select("uid", "doc_id", "points", "sha").join(recipes, "uid"), "dedup-recipes")
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("last"), "doc_id", "uid", "sha"))
    # Written first: joined as they come from the aggregation, they would bind the rows of a hot group to one task.
    groups = staged(rows.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    return rows.drop("sha").join(groups, "recipe").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.uid")).alias("kept"),
        F.col("best.sha").alias("text_sha256"), F.size("recipe").cast("long").alias("n_chunks"),
    )


#: For DuckDB; n_chunks is left to the query's own columns.
ORACLE = r"""
with n as (
  select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents
), h as (select doc_id, points, sha256(norm) as text_sha256 from n)
select doc_id,
  first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id rows between unbounded preceding and unbounded following) as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  row_number() over (partition by text_sha256 order by points desc, doc_id) = 1 as kept,
  text_sha256
from h
"""
