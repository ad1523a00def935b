"""Readers: each gives a DataFrame, with the file a row came from where that matters."""

from __future__ import annotations

import gzip
import html.parser
import importlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.records import LANG_FIELDS

_TYPES = {"文件名": "string", "是否待查文件": "boolean", "是否重复文件": "boolean", "段落数": "bigint", "去重段落数": "bigint", "低质量段落数": "bigint", "行号": "bigint", "是否重复": "boolean", "是否跨文件重复": "boolean"}
RECORD_SCHEMA = ", ".join([*[f"`{k}` {v}" for k, v in _TYPES.items()], *[f"{f} string" for f in LANG_FIELDS], "`扩展字段` string", "`时间` string", "zh_text_md5 string"])


def jsonl(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Strict: a line that is no JSON ends the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "*.jsonl").json(path)


def jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that could not be read, with their files."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    rows = raw.withColumn("row", F.from_json("value", schema, {"mode": "PERMISSIVE"})).withColumn("ok", F.try_parse_json("value").isNotNull())
    return rows.where("ok").select("row.*"), rows.where("not ok and trim(value) <> ''").select("file", "value")


def json_arrays(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of files that each hold one JSON array, in folders of any depth; and the files that hold none."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    rows = text.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", f"array<struct<{schema}>>").alias("rows"), F.try_parse_json("value").alias("json"))
    ok = F.col("json").isNotNull() & F.coalesce(F.schema_of_variant("json").startswith("ARRAY"), F.lit(False))
    return rows.where(ok).select(F.explode("rows").alias("row")).select("row.*"), rows.where(~ok).select("file")


def comma_lines(spark: SparkSession, path: str, containing: str, names: list[str]) -> DataFrame:
    """Lines of text files that hold a mark, split at commas into named columns; missing ones are null, the last takes what is left."""
    parts = F.split(F.col("value"), ",", len(names))
    return spark.read.text(path).where(F.contains("value", F.lit(containing))).select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("url string, status int").option("sep", "\t").csv(path)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_id, line of whole text files."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\n")).alias("line_id", "line"))


def language_folders(spark: SparkSession, path: str, langs: list[str]) -> DataFrame:
    """Folders of records with files like EN-name.txt: one wide row for each record, '' for what is missing."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    file = F.col("_metadata.file_path")
    long = whole.select(F.url_decode(F.element_at(F.split(file, "/"), -2)).alias("record"), F.lower(F.regexp_extract(file, r"/([A-Za-z]+)-[^/]*$", 1)).alias("lang"), "value")
    return pivot_languages(long, "record", "lang", "value", langs)


def pivot_languages(long: DataFrame, key: str, lang: str, text: str, langs: list[str]) -> DataFrame:
    """The languages as columns; of several texts the greatest, so that the result doesn't depend on the order of rows."""
    wide = long.groupBy(key).pivot(lang, langs).agg(F.max(text))
    return wide.select(key, *[F.coalesce(F.col(x), F.lit("")).alias(x) for x in langs])


def sitemap_locations(xml: Column) -> Column:
    return F.xpath(xml, F.lit("//loc/text()"))


def sitemaps(files: DataFrame) -> DataFrame:
    """path, url of files(path, content), plain or gzip, as spark.read.format('binaryFile') gives them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "xml": [(gzip.decompress(c) if c[:2] == b"\x1f\x8b" else c).decode("utf-8", "replace") for c in b["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, xml string").select("path", F.explode(sitemap_locations(F.col("xml"))).alias("url"))


#: Magic numbers of files (fixed values): hexadecimal prefix, kind.
MAGIC = (("D0CF11E0A1B11AE1", "doc"), ("504B0304", "docx"), ("25504446", "pdf"), ("FF575043", "wpf"), ("7B5C727466", "rtf"), ("3C", "html"))


def file_kind(content: Column) -> Column:
    head = F.hex(F.substring(content, 1, 8))
    return F.coalesce(*[F.when(head.startswith(k), F.lit(v)) for k, v in MAGIC], F.lit("unknown"))


class _Text(html.parser.HTMLParser):
    """Text inside the elements that a simple selector names: tag, .class, #id or tag.class."""

    VOID = {"br", "img", "hr", "input", "meta", "link"}

    def __init__(self, selector: str):
        super().__init__(convert_charrefs=True)
        tag, kind, name = re.match(r"^([a-z0-9]*)(?:([.#])([\w-]+))?$", selector, re.IGNORECASE).groups()
        self.tag, self.attribute, self.name, self.depth, self.out = tag, {".": "class", "#": "id"}.get(kind), name, 0, []

    def handle_starttag(self, tag, attrs):
        hit = (not self.tag or tag == self.tag) and (not self.attribute or self.name in (dict(attrs).get(self.attribute) or "").split())
        if tag in self.VOID:
            self.out += ["\n"] * (self.depth > 0 and tag == "br")
        elif self.depth or hit:
            if not self.depth:
                self.out.append("\n")
            self.depth += 1

    def handle_endtag(self, tag):
        self.depth -= self.depth > 0 and tag not in self.VOID

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)


def select_text(markup: str, selector: str) -> str:
    parser = _Text(selector)
    parser.feed(markup)
    return re.sub(r"\s*\n\s*", "\n", "".join(parser.out)).strip()


def page_text(pages: DataFrame, key: str, markup: str, selector: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "text": [select_text(m or "", selector) for m in b[markup]]})

    return pages.select(key, markup).mapInPandas(run, f"`{key}` {pages.schema[key].dataType.simpleString()}, text string")


def week_ranges(dates: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar weeks from Monday, cut to [start, end): week_start and week_end (last day)."""
    days = F.sequence(F.date_trunc("week", F.col(start)).cast("date"), F.date_sub(F.col(end).cast("date"), 1), F.expr("interval 7 days"))
    weeks = dates.where(F.col(end).cast("date") > F.col(start).cast("date")).select("*", F.explode(days).alias("monday"))
    return weeks.select(F.greatest("monday", F.col(start).cast("date")).alias("week_start"), F.least(F.date_add("monday", 6), F.col(end).cast("date")).alias("week_end"))


def seven_day_buckets(dates: DataFrame, start: str, end: str) -> DataFrame:
    """Seven days each from start on; a last bucket that isn't whole is left out."""
    n = F.floor((F.datediff(F.col(end), F.col(start)) + 1) / 7).cast("int")
    rows = dates.withColumn("n", n).where("n > 0").select(F.col(start).cast("date").alias("d"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("bucket"))
    return rows.select("bucket", F.date_add("d", F.col("bucket") * 7).alias("first_day"), F.date_add("d", F.col("bucket") * 7 + 6).alias("last_day"))


class GeneratorSource(DataSource):
    """A generator as a source. Options: 'generator' (module:function, called with a task's number and the number of tasks), 'partitions'.

    spark.dataSource.register(GeneratorSource); spark.read.format("polyweave_generator").schema(...).option(...).load(). Rows are
    tuples in the order of the schema. A task that is repeated calls the generator again, which has to give the same rows.
    """

    @classmethod
    def name(cls) -> str:
        return "polyweave_generator"

    def schema(self) -> str:
        return "row_id bigint, text string"

    def reader(self, schema) -> DataSourceReader:
        return _GeneratorReader(self.options.get("generator", f"{__name__}:numbered_rows"), int(self.options.get("partitions", 2)), dict(self.options))


def numbered_rows(task: int, tasks: int, options: dict) -> Iterator[tuple]:
    """As many numbered rows as the option 'rows' says."""
    for i in range(task, int(options.get("rows", 10)), tasks):
        yield i, f"row {i}"


class _GeneratorReader(DataSourceReader):
    def __init__(self, generator: str, parts: int, options: dict):
        self.generator, self.parts, self.options = generator, parts, options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, function = self.generator.partition(":")
        yield from getattr(importlib.import_module(module), function)(partition.value, self.parts, self.options)


class RowsSource(GeneratorSource):
    """numbered_rows under a name of its own."""

    @classmethod
    def name(cls) -> str:
        return "polyweave_rows"
