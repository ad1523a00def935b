"""Multi-language blocks: paragraphs of one record that alignments connect, whatever the languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.staging import materialised


def member_edges(alignments: DataFrame, key: str = "record") -> DataFrame:
    """Alignment rows to edges between nodes lang:index; the first source member is the hub of each row."""
    side = lambda k: F.split(F.element_at(F.split("clean_para_index_set_pair", r"\|"), k), ",")
    named = lambda lang, k: F.transform(side(k), lambda i: F.concat(F.col(lang), F.lit(":"), i))
    return alignments.select(key, F.concat(named("src", 1), named("dst", 2)).alias("nodes")).select(key, F.get("nodes", F.lit(0)).alias("u"), F.explode("nodes").alias("v"))


def components(edges: DataFrame, key: str = "record", stage=materialised) -> DataFrame:
    """key, node, block: the smallest node that it is connected with, by labels that pass along edges and jump to labels' labels."""
    both = edges.select(key, "u", "v").union(edges.select(key, F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    labels = stage(both.groupBy(key, "u").agg(F.min(F.least("u", "v")).alias("label")).withColumnRenamed("u", "node"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), [key, "v"]).groupBy(key, F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, [key, "node"]).select(key, "node", F.least("label", "near").alias("label"))
        jump = labels.select(key, F.col("node").alias("label"), F.col("label").alias("further"))
        fresh = stage(lower.join(jump, [key, "label"], "left").select(key, "node", F.least("label", F.coalesce("further", "label")).alias("label")))
        if fresh.join(labels.withColumnRenamed("label", "old"), [key, "node"]).where("label <> old").isEmpty():
            return fresh.withColumnRenamed("label", "block")
        labels = fresh


def assemble(members: DataFrame, paragraphs: DataFrame, langs: list[str], key: str = "record") -> DataFrame:
    """One row for each block: its paragraphs of one language joined by a blank line, and an empty text for a language without.

    members: key, node (lang:index), block. paragraphs: key, lang, idx, text.
    """
    nodes = members.select(key, "block", F.split("node", ":")[0].alias("lang"), F.split("node", ":")[1].cast("int").alias("idx"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), "\n\n")
    wide = nodes.join(paragraphs, [key, "lang", "idx"]).groupBy(key, "block").pivot("lang", langs).agg(joined)
    return wide.select(key, "block", *[F.coalesce(F.col(x), F.lit("")).alias(f"{x}_text") for x in langs])


def block_numbers(blocks: DataFrame, key: str = "record", stretch: int = 1024) -> DataFrame:
    """A running number from 0 over all blocks in order of a whole-number key and of block.

    Stretches of keys are counted first; only one count for each stretch meets in one place, never the blocks.
    """
    part = F.floor(F.col(key) / stretch)
    sizes = blocks.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(key, "block")) - 1
    return blocks.withColumn("part", part).withColumn("inside", inside).join(before, "part").withColumn("行号", (F.col("inside") + F.col("before")).cast("long")).drop("part", "inside", "before")
