"""Paragraph records: the corpus normaliser.

A record has a file name, a position in its file and one text for each language. Nothing here gathers a file in one task: first
occurrences are found by aggregation, and row numbers by counting stretches of positions first.

Defined results: a null file name counts as an empty one, null texts as empty; repeated rows are one; an empty table gives an
empty result; columns beside those of the format are dropped by normalise and kept by numbered, whose own begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import py_strip

#: The nineteen languages of the published format, in its order (fixed values).
LANGS = "it zh en ar nl de eo fr he ja pt ru es sv ko th id cht vi".split()
LANG_FIELDS = [f"{x}_text" for x in LANGS]
#: The published format's fields, in its order (fixed values).
FIELDS = ["文件名", "是否待查文件", "是否重复文件", "段落数", "去重段落数", "低质量段落数", "行号", "是否重复", "是否跨文件重复", *LANG_FIELDS, "扩展字段", "时间", "zh_text_md5"]
LEGACY_KEPT = ["行号", "是否重复", "是否跨文件重复", *LANG_FIELDS, "扩展字段", "时间", "zh_text_md5"]


def canonical_extension(x: Column) -> Column:
    """The extension field with sorted keys and no white space; an object without members where it is missing or empty, NULL where it is broken."""
    return F.when(F.coalesce(x, F.lit("")) == "", F.lit("{}")).otherwise(F.to_json(F.try_parse_json(x)))


def extension_column(names: list[str], of=F.col) -> Column:
    """The extension field under its name or, where that is null or missing, under the misspelt one that some files have."""
    found = [of(c) for c in ("扩展字段", "拓展字段") if c in names]
    return F.coalesce(*found, F.lit("{}")) if found else F.lit("{}")


def salvaged_json(x: Column) -> Column:
    """JSON whose first brace was lost gets it back; sorted keys, NULL where that doesn't help."""
    # Parsers stop behind a first value, so what doesn't begin like an object or a list is no JSON here.
    return F.to_json(F.coalesce(F.when(x.rlike(r"^\s*[\[{]"), F.try_parse_json(x)), F.try_parse_json(F.concat(F.lit("{"), x))))


def fixed_fields(records: DataFrame) -> DataFrame:
    """The published format's fields in its order; ValueError that names those missing."""
    if missing := [f for f in FIELDS if f not in records.columns]:
        raise ValueError(f"fields are missing: {', '.join(missing)}")
    return records.select(*FIELDS)


def rejected_paragraphs(files: DataFrame) -> DataFrame:
    """File, position and reason of each nested paragraph that the format forbids: broken extension fields, and texts in fields for languages that must be named."""
    inside = files.schema["段落"].dataType.elementType.names
    p = files.select("文件名", F.posexplode("段落").alias("pos", "p"))
    broken = [F.when(canonical_extension(extension_column(inside, lambda c: F.col(f"p.{c}"))).isNull(), F.lit("broken extension"))]
    unnamed = [F.when(F.coalesce(F.col(f"p.{c}"), F.lit("")) != "", F.lit(f"{c} is not empty")) for c in ("other1_text", "other2_text") if c in inside]
    return p.select("文件名", "pos", F.explode(F.filter(F.array(*broken, *unnamed), lambda r: r.isNotNull())).alias("reason"))


def unknown_extension_keys(records: DataFrame, known: tuple[str, ...] = ("other_texts", "k")) -> DataFrame:
    """File name and unknown key, once each."""
    keys = F.explode(F.json_object_keys("扩展字段")).alias("key")
    return records.select("文件名", keys).where(~F.col("key").isin(*known)).distinct()


def bad_other_languages(ext: Column) -> Column:
    """Keys of other_texts that are no two small letters."""
    return F.filter(F.coalesce(F.json_object_keys(F.get_json_object(ext, "$.other_texts")), F.array().cast("array<string>")), lambda k: ~k.rlike("^[a-z]{2}$"))


def explode_legacy(files: DataFrame) -> DataFrame:
    """One row for each paragraph of files with nested ones: the date is inherited where a paragraph has none, missing languages are empty.

    Of a paragraph's fields those in LEGACY_KEPT stay, where it has them. Broken extension fields are NULL; rejected_paragraphs lists them.
    """
    p = files.select("文件名", F.col("时间").alias("file_date"), F.posexplode("段落").alias("pos", "p"))
    inside = files.schema["段落"].dataType.elementType.names
    texts = [F.coalesce(F.col(f"p.{f}") if f in inside else F.lit(None).cast("string"), F.lit("")).alias(f) for f in LANG_FIELDS]
    ext = extension_column(inside, lambda c: F.col(f"p.{c}"))
    own_date = F.col("p.时间") if "时间" in inside else F.lit(None).cast("string")
    kept = [F.col(f"p.{c}").alias(c) for c in LEGACY_KEPT if c in inside and c not in (*LANG_FIELDS, "扩展字段", "时间")]
    return p.select("文件名", "pos", *kept, *texts, canonical_extension(ext).alias("扩展字段"), F.coalesce(F.nullif(own_date, F.lit("")), F.col("file_date"), F.lit("")).alias("时间"))


def numbered(df: DataFrame, key: str, order: list[str], stretch: Column, name: str) -> DataFrame:
    """Row numbers from 1 within key by order. stretch rises with the order, so each stretch is sorted alone and starts where the ones before it end."""
    rows = df.withColumn("_stretch", stretch)
    sizes = rows.groupBy(key, "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(key, "_stretch").orderBy(*order))
    before = before.select(F.col(key).alias("_key"), F.col("_stretch").alias("_of"), "_before")
    out = rows.withColumn("_inside", inside).join(before, F.col(key).eqNullSafe(F.col("_key")) & F.col("_stretch").eqNullSafe(F.col("_of"))).drop("_key", "_of")
    return out.withColumn(name, (F.col("_inside") + F.col("_before")).cast("long")).drop("_stretch", "_inside", "_before")


def is_redundant(langs: list[str]) -> Column:
    """At most one different text that isn't empty: identical texts, one language only, or none."""
    return F.size(F.array_distinct(F.filter(F.array(*langs), lambda x: x != ""))) <= 1


def first_of_equal(df: DataFrame, keys: list[str], pos: list[str]) -> DataFrame:
    """Of rows with equal keys the one of the smallest position, with its other columns."""
    # Keys can be long texts: groups are formed by two hashes of them, and a row moves once.
    hashes = [F.xxhash64(F.lit(k), *[x for c in keys for x in (F.col(c).isNull(), F.col(c))]).alias(f"_h{k}") for k in (1, 2)]
    rest = [c for c in df.columns if c not in pos]
    best = F.min(F.struct(*pos, *rest)).alias("_best")
    return df.groupBy(*hashes).agg(best).select("_best.*")


def normalise(records: DataFrame, langs: list[str], pos: list[str], stretch: Column) -> DataFrame:
    """Strips, drops redundant rows, keeps the first of equal ones per file, numbers and flags the rest, counts per file.

    records: 文件名, position columns, language columns (others of the nineteen become empty), 扩展字段, 时间.
    去重段落数 holds the number of repeated paragraphs, as published data does.
    """
    named = {"文件名": F.coalesce("文件名", F.lit(""))}
    rows = records.withColumns(named | {f: py_strip(F.coalesce(F.col(f), F.lit(""))) for f in langs}).where(~is_redundant(langs))
    rows = first_of_equal(rows, ["文件名", "扩展字段", *langs], pos)
    rows = rows.withColumn("zh_text_md5", F.md5("zh_text"))
    firsts = rows.groupBy("文件名", "zh_text_md5").agg(F.min(F.struct(*pos)).alias("_first"))
    rows = rows.join(firsts, ["文件名", "zh_text_md5"]).withColumn("是否重复", F.struct(*pos) > F.col("_first")).drop("_first")
    rows = numbered(rows, "文件名", pos, stretch, "行号")
    files = rows.groupBy("文件名").agg(
        F.count(F.lit(1)).alias("段落数"), F.count_if("是否重复").alias("去重段落数"), F.count_if((F.col("zh_text") == "") | (F.col("en_text") == "")).alias("低质量段落数")
    )
    constant = {"是否待查文件": F.lit(False), "是否重复文件": F.lit(False), "是否跨文件重复": F.lit(False), **{f: F.lit("") for f in LANG_FIELDS if f not in langs}}
    return rows.join(files, "文件名").withColumns(constant).select(*FIELDS)
