"""Secret scans with corpus-wide ownership frequency.

Candidates are found in each text, their values leave the scan as SHA-256 digests, and digests are counted by distinct
owners and distinct repositories over the whole corpus. A value that stands in many repositories of several owners is a
widely copied example; one of a single owner, in few repositories, that looks random is owner-specific and live-looking. Both
verdicts are added as spans of their own kinds.

Defined results: null text counts as empty and has no spans; a null owner or repository is one of its own; repeated rows
are each scanned and count once as owners; null doc_id passes through; an empty table gives an empty result; further columns
are ignored. A hot value is counted after distinct owners are combined map-side; a text's own spans are one row throughout.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_of

#: Kinds in the order of the contract, then those the method adds.
KINDS = ("assign", "access", "hex", "live", "example")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
#: What placeholder values contain (fixed values).
PLACEHOLDER = re.compile(r"example|sample|changeme|placeholder|dummy|your|xxxx|test|1234567", re.IGNORECASE)
#: Texts in which the JVM finds none of these have no base span.
MAY_HAVE = r"""AKIA[A-Z0-9]{16}|[0-9a-f]{24}|(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""


def find(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start of the value, its end) of every base span, in the contract's order."""
    out = [(m.start(), m.end(), "assign", m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        out += [(*m.span(), kind, *m.span()) for m in pattern.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def looks_random(value: str) -> bool:
    if len(value) < 12 or PLACEHOLDER.search(value):
        return False
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values()) >= 2.5


def scan(docs: DataFrame, owner: str, repository: Column) -> DataFrame:
    """doc_id, owner, repository and base spans with digests of their values; the values themselves stay behind."""
    span = T.StructType([*[T.StructField(c, T.IntegerType()) for c in ("start", "end")], T.StructField("kind", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("from", "to")], T.StructField("value", T.BinaryType()), T.StructField("random", T.BooleanType())])
    schema = T.StructType([docs.schema["doc_id"], T.StructField("owner", T.StringType()), T.StructField("repository", T.StringType()), T.StructField("found", T.ArrayType(span))])
    fields = ("start", "end", "kind", "from", "to", "value", "random")
    kinds = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32()), ("value", pa.binary()), ("random", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, may in zip(batch.column("text").to_pylist(), batch.column("may").to_pylist()):
                own = find(text) if may else []
                found.append([dict(zip(fields, (*s, hashlib.sha256(text[s[3] : s[4]].encode()).digest(), looks_random(text[s[3] : s[4]])))) for s in own])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "owner", "repository")], pa.array(found, kinds)], names=schema.names)

    text = F.col("text")
    rows = docs.select("doc_id", F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), text_of("text").alias("text"))
    # Only texts that may have a span go to Python.
    return rows.select("doc_id", "owner", "repository", F.when(text.rlike(MAY_HAVE), text).otherwise("").alias("text")).withColumn("may", text != "").mapInArrow(run, schema)


def secrets(docs: DataFrame, owner: str = "source", repository: Column | None = None, widely: int = 5, several: int = 2) -> DataFrame:
    """doc_id and spans (start, end, kind, value, owners, repositories, from, to), base and added ones, in order; from and to bound the value.

    A value in widely many repositories or more, of several owners or more, is an example. One of a single owner in fewer
    repositories that looks random is live; of other values nothing is said.
    """
    repository = F.concat_ws("/", F.col("source").cast("string"), F.col("lang").cast("string")) if repository is None else repository
    rows = staged(scan(docs, owner, repository).withColumn("uid", F.monotonically_increasing_id()), "secret-scan")
    each = rows.select("uid", "owner", "repository", F.explode("found").alias("s")).select("uid", "owner", "repository", "s.*")
    owned = each.select("value", "owner", "repository").distinct()
    owners = owned.select("value", "owner").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("owners"))
    counts = owned.select("value", "repository").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("repositories")).join(owners, "value")
    wide = F.col("repositories") >= widely
    verdict = F.when(wide & (F.col("owners") >= several), F.lit("example")).when(~wide & (F.col("owners") == 1) & F.col("random"), F.lit("live"))
    of = lambda start, end, kind: F.struct(F.col(start).alias("start"), F.col(end).alias("end"), kind.alias("kind"), "value", "owners", "repositories", "from", "to")
    judged = each.join(counts, "value").select("uid", of("start", "end", F.col("kind")).alias("base"), F.when(verdict.isNotNull(), of("from", "to", verdict)).alias("added"))
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    ordered = lambda a: F.transform(F.array_sort(F.transform(a, lambda s: F.struct(s["start"].alias("at"), rank(s).alias("rank"), s["end"].alias("end"), s.alias("s")))), lambda x: x["s"])
    spans = judged.groupBy("uid").agg(F.collect_list("base").alias("base"), F.collect_set("added").alias("added")).select("uid", ordered(F.concat("base", "added")).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return rows.select("uid", "doc_id").join(spans, "uid", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    is_base = lambda s: s["kind"].isin(*KINDS[:3])
    written = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(written(F.filter("spans", is_base)), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"), *[count(k).alias(f"n_{k}") for k in KINDS[3:]],
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]", **settings) -> DataFrame:
    """docs with the values of all secrets but widely copied examples replaced; n_chars follows the text where there is one.

    Only the values go: what names them stays. Overlapping values are one mark. Texts without candidates pass by; the others
    are written once with a number of their own, so columns may have any names and doc_id may be null or repeated.
    """
    may = text_of("text").rlike(MAY_HAVE)
    suspects = staged(docs.where(may).select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")), "suspects")
    row = lambda c: F.col("row")[c]
    given = suspects.select(F.col("uid").alias("doc_id"), *[row(c).alias(c) for c in docs.columns if c != "doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    examples = F.transform(F.filter("spans", lambda s: s["kind"] == "example"), lambda s: s["value"])
    gone = F.filter(base, lambda s: ~F.array_contains(examples, s["value"]))
    values = secrets(given, **settings).select(F.col("doc_id").alias("uid"), F.explode(gone).alias("s")).select("uid", "s.from", "s.to")
    # Overlapping values become one: a value starts anew where none before it reaches.
    order = Window.partitionBy("uid").orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = values.withColumn("new", (reach.isNull() | (F.col("from") >= reach)).cast("int")).withColumn("island", F.sum("new").over(order))
    cuts = islands.groupBy("uid", "island").agg(F.min("from").alias("from"), F.max("to").alias("to")).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("cut"))
    text = row("text")
    before = lambda i: F.coalesce(F.get("cut", i - 1)["to"], F.lit(0))
    parts = F.transform("cut", lambda s, i: F.concat(F.substring(text, before(i) + 1, s["from"] - before(i)), F.lit(mark)))
    clean = F.concat(F.array_join(parts, ""), F.substring(text, before(F.size("cut")) + 1, F.length(text)))
    new = {"text": clean, "n_chars": F.length(clean)}
    column = lambda c: F.when(F.col("cut").isNotNull(), new[c].cast(docs.schema[c].dataType)).otherwise(row(c)) if c in new else row(c)
    done = suspects.join(cuts, "uid", "left").select(*[column(c).alias(c) for c in docs.columns])
    return docs.where(~may).union(done)
