"""Writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def jsonl_sorted_keys(df: DataFrame, path: str, group: str, order: str, mode: str = "overwrite") -> None:
    """JSON lines with keys in code-point order; a group's rows lie together and in order in a file."""
    columns = sorted(df.columns)
    df.repartitionByRange(F.col(group), F.col(order)).sortWithinPartitions(group, order).select(*columns).write.mode(mode).option("ignoreNullFields", False).json(path)


def jsonl_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def json_by(df: DataFrame, path: str, *keys: str) -> None:
    df.write.mode("overwrite").partitionBy(*keys).json(path)


def text_by(df: DataFrame, path: str, key: str, text: Column) -> None:
    """A text for each key, in a folder of that key."""
    df.select(key, text.alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def states(df: DataFrame, path: str) -> None:
    df.select("url", "status").write.mode("overwrite").option("sep", "\t").csv(path)


def dump(title: Column, body: Column, width: int = 40) -> Column:
    """A banner over a body, for reading."""
    rule = F.lit("=" * width)
    return F.concat_ws("\n", rule, title, rule, body)


def missing(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed job has still to do."""
    return df.join(done.select(key).distinct(), key, "left_anti")
