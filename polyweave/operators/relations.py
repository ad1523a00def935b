"""Joins, set operations and folds that the corpus scripts spell out as loops.

Defined results: null keys join with nothing, so their rows stay in left joins and go in others; repeated rows on the side that
is looked up multiply, but in already_done, difference and the drop side of reworked; empty tables give empty results, or all of
the other side; further columns pass through, and those of our own begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_labels(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """df with its labels; a row without any is an error."""
    out = df.join(labels.withColumn("_there", F.lit(True)), key, "left")
    return out.where(F.coalesce(F.col("_there"), F.raise_error(F.concat(F.lit("no label for "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean"))).drop("_there")


def with_all(df: DataFrame, *texts: str) -> DataFrame:
    """Rows in which none of the texts is empty or null."""
    for t in texts:
        df = df.where(F.coalesce(F.col(t), F.lit("")) != "")
    return df


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in order; give a position as the last key, so that equal ones keep it."""
    return df.orderBy(*keys)


def at_positions(df: DataFrame, shards: DataFrame, row: str = "row_id") -> DataFrame:
    """Source rows with the translated rows of the same stored number."""
    return df.join(shards, row)


def reworked(df: DataFrame, rework: DataFrame, drop: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of the drop table go; rows of the rework table get its value."""
    fixed = rework.select(*keys, F.col(value).alias("_value"))
    return df.join(drop.select(*keys).distinct(), keys, "left_anti").join(fixed, keys, "left").withColumn(value, F.coalesce("_value", F.col(value))).drop("_value")


def inverted(df: DataFrame, key: str, mapping: str) -> DataFrame:
    """A map of each row as rows (value, key, map key): looking up by value is then a join."""
    return df.select(key, F.explode(mapping).alias("name", "value")).select("value", key, "name")


def already_done(names: DataFrame, done: list[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in any of the tables."""
    keys = done[0].select(key)
    for other in done[1:]:
        keys = keys.unionByName(other.select(key))
    return names.join(keys.distinct(), key, "left_semi")


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only: + left, - right."""
    a, b = left.select(key).distinct().withColumn("_a", F.lit(True)), right.select(key).distinct().withColumn("_b", F.lit(True))
    return a.join(b, key, "full").where("_a is null or _b is null").select(key, F.when(F.col("_b").isNull(), "+").otherwise("-").alias("side"))


def folded_breaks(log: DataFrame, record: str = "record", breaks: str = "br") -> DataFrame:
    """All break indices of each record's batches, once each and in order."""
    return log.select(record, F.explode(breaks).alias("i")).groupBy(record).agg(F.array_sort(F.collect_set("i")).alias(breaks))


def resume_at(log: DataFrame, record: str = "record", right: str = "r") -> DataFrame:
    """Where each record goes on: one behind its last finished line."""
    return log.groupBy(record).agg((F.max(right) + 1).alias("next"))


def unfinished(pages: DataFrame, window: str, total: str, size: int = 20) -> DataFrame:
    """Search windows with fewer rows fetched than there are: full pages before the last, and what the last one has."""
    last = F.max(F.struct("page", "rows"))
    seen = pages.groupBy(window).agg(last.alias("last"), F.max(total).alias(total))
    return seen.where((F.col("last.page") - 1) * size + F.col("last.rows") < F.col(total)).select(window, (F.col("last.page") + 1).alias("next_page"))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of each key's rows the one that came last."""
    others = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(F.max(F.struct(order, *others)).alias("_l")).select(key, *[F.col(f"_l.{c}").alias(c) for c in [order, *others]])


def looked_up(values: dict, key: Column, default: str | None = None) -> Column:
    """A small constant map."""
    found = F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key)
    return found if default is None else F.coalesce(found, F.lit(default))


#: Names of the six languages as links write them, and in Chinese (fixed values).
LANGUAGE_NAMES = {"Chinese": "中文", "Arabic": "阿拉伯文", "French": "法文", "English": "英文", "Spanish": "西班牙文", "Russian": "俄文"}


def translated(df: DataFrame, key: str, lines: str, translate) -> DataFrame:
    """The boundary to an outside translator, a function from a list of texts to a list; texts without Latin letters pass by it."""
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for own in b[lines]:
                own = list(own) if own is not None else []
                asked = [i for i, x in enumerate(own) if any(c.isascii() and c.isalpha() for c in x)]
                for i, x in zip(asked, translate([own[i] for i in asked]) if asked else []):
                    own[i] = x
                out.append(own)
            yield pd.DataFrame({key: b[key], lines: out})

    return df.select(key, lines).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, `{lines}` array<string>")
