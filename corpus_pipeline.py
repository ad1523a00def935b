"""From raw documents to packed sequences: quality rules, exact dedup, near-dedup, secret redaction, packing.

Each stage is a function (spark, docs, sf_dir) that keeps the columns of docs (but for the last, which returns pieces), is
written as Parquet and read again as the next one's docs.

Defined results, for all stages: a null text counts as empty; null and repeated doc_ids are told apart by what else the row
holds; wholly equal rows are judged alike, and from exact dedup on one of them stays; further columns of any name pass through
and are ignored; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyweave.llm import exact_dedup, near_dedup, packing, quality, secrets
from polyweave.llm.common import staged
from polyweave.llm.queries import TOKENIZER_FILE


def _prints(docs: DataFrame) -> list:
    others = [F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]
    return [F.xxhash64(F.lit(k), "doc_id", F.col("doc_id").isNull(), *others).alias(f"print{k}") for k in (1, 2)]


def _marked(docs: DataFrame) -> DataFrame:
    """docs whose doc_id is a key of the row: the old one, null after all others, and two hashes of all that the row holds."""
    return docs.withColumn("doc_id", F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", *_prints(docs)))


def _kept(docs: DataFrame, verdicts: DataFrame, single: bool) -> DataFrame:
    """The rows of docs whose keys the verdicts keep. single: of wholly equal rows one stays."""
    keys = verdicts.where("kept").select("doc_id.print1", "doc_id.print2").distinct()
    # The row is one column meanwhile, so that its columns may have any names.
    rows = docs.select(F.struct("*").alias("row"), *_prints(docs)).join(keys, ["print1", "print2"], "left_semi")
    return (rows.dropDuplicates(["print1", "print2"]) if single else rows).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, quality.host_rules(_marked(docs)), single=False)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, exact_dedup.exact_dedup(_marked(docs)), single=True)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _kept(docs, near_dedup.near_duplicates(_marked(docs)), single=True)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(docs, TOKENIZER_FILE))


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact), ("near_dedup", near), ("secret_scans", secret_scan), ("packing", pack)]

#: SQL expresses neither the sampled near-duplicates nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
