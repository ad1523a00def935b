"""Page headers and footers: statistics over pages, and removal.

Pages are rows (record, lang, page_id, page). Counting is done by aggregation; removal works on one page with the counts joined
to its first lines, so no record is gathered.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import line_digest, py_split

#: Characters at the start of a page that can hold a header.
HEAD = 100
CUT = "__________"


def to_pages(docs: DataFrame, key: str, text: str, lines: int) -> DataFrame:
    """Pages of so many lines, for texts without page marks."""
    rows = docs.select(key, F.split(text, "\n").alias("l"))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("l") - 1) / lines).cast("int")), lambda p: F.array_join(F.slice("l", p * lines + 1, lines), "\n"))
    return rows.select(key, F.posexplode(cut).alias("page_id", "page"))


def split_pages(docs: DataFrame, key: str, langs: list[str], mark: str = "\n----\n") -> DataFrame:
    """Wide documents, one column of marked pages for each language, as long rows."""
    long = docs.unpivot(key, langs, "lang", "text")
    return long.select(key, "lang", F.posexplode(F.split("text", mark)).alias("page_id", "page"))


def head_tokens(pages: DataFrame, key: list[str]) -> DataFrame:
    return pages.select(*key, F.explode(py_split(F.substring("page", 1, HEAD))).alias("token")).groupBy(*key, "token").agg(F.count(F.lit(1)).alias("n"))


def frequent_tokens(pages: DataFrame, key: list[str]) -> DataFrame:
    """Tokens of heads that occur three times or more, and not more often than there are pages."""
    counts = pages.groupBy(*key).agg(F.count(F.lit(1)).alias("pages"))
    return head_tokens(pages, key).where("n >= 3").join(counts, key).where("n <= pages").drop("pages")


def head_digests(pages: DataFrame, key: list[str]) -> DataFrame:
    """How often each first line occurs, white space aside."""
    lines = F.explode(F.split(F.substring("page", 1, HEAD), "\n"))
    return pages.select(*key, lines.alias("line")).select(*key, line_digest(F.col("line")).alias("digest")).where("digest <> ''").groupBy(*key, "digest").agg(F.count(F.lit(1)).alias("n"))


def page_offset(pages: DataFrame, key: list[str], reach: tuple[int, int] = (-9, 2)) -> DataFrame:
    """The offset by which printed page numbers differ from ours: that with the most pages whose head holds page_id + offset.

    The smallest of equals; NULL where no page agrees or fewer than half of them do.
    """
    printed = F.filter(F.regexp_extract_all(F.substring("page", 1, HEAD), F.lit(r"(\d+)"), F.lit(1)), lambda x: x.rlike("^(?:0|[1-9][0-9]*)$"))  # 007 is no page 7
    numbers = F.array_distinct(F.filter(F.transform(printed, lambda x: x.try_cast("int")), lambda x: x.isNotNull()))
    hits = pages.select(*key, "page_id", F.explode(numbers).alias("number")).select(*key, "page_id", (F.col("number") - F.col("page_id")).alias("offset")).where(F.col("offset").between(*reach))
    per = hits.distinct().groupBy(*key, "offset").agg(F.count(F.lit(1)).alias("hits"))
    best = per.groupBy(*key).agg(F.max(F.struct("hits", (-F.col("offset")).alias("o"))).alias("best"))
    total = pages.groupBy(*key).agg(F.count(F.lit(1)).alias("pages"))
    good = F.col("best.hits") >= F.floor(F.col("pages") / 2)
    return total.join(best, key, "left").select(*key, "pages", F.when(good, -F.col("best.o")).cast("int").alias("offset"))


def is_frequent(n: Column, pages: Column) -> Column:
    return ((pages >= 3) & (n >= pages - 1)) | ((pages >= 5) & (n > 0.666 * pages))


def similar_sums(digests: list[str], others: list[str], counts: list[int], least: float) -> list[int]:
    """For each digest the counts of all others of a Ratcliff-Obershelp similarity over least. The two upper bounds (lengths, letters in common) are taken for all digests at once."""
    at = {c: i for i, c in enumerate(set().union(*digests, *others))}

    def letters(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(at)), np.int32)
        for i, x in enumerate(texts):
            for c in x:
                out[i, at[c]] += 1
        return out

    sums, own, theirs = [0] * len(digests), letters(digests), letters(others)
    sizes = own.sum(1)
    m = difflib.SequenceMatcher(autojunk=False)
    for k, (other, n) in enumerate(zip(others, counts)):
        both = sizes + len(other)
        near = np.flatnonzero(2.0 * np.minimum(sizes, len(other)) / both > least)
        near = near[2.0 * np.minimum(own[near], theirs[k]).sum(1) / both[near] > least]
        m.set_seq2(other)
        for i in near:
            m.set_seq1(digests[i])
            if m.ratio() > least:
                sums[i] += n
    return sums


def similar_digest_counts(pages: DataFrame, key: list[str], least: float = 0.72, block: int = 256, single: bool = True) -> DataFrame:
    """key, digest, n: occurrences of all digests of the key that resemble it, itself included.

    Every digest is paired with every one of its key, once-only ones too: a header that differs by page occurs once in each
    form. Without single, only digests that occur twice or more are summed. Pairs are compared in blocks of about so many
    digests a side, so that a key with many is spread and no pair is a row.
    """
    digests = head_digests(pages, key)
    sizes = digests.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    dealt = digests.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")))
    lists = dealt.groupBy(*key, "block").agg(F.collect_list(F.struct("digest", "n")).alias("own"))
    summed = F.col("own") if single else F.filter("own", lambda x: x["n"] > 1)
    others = lists.select(*key, summed.alias("o")).select(*key, F.col("o.digest").alias("others"), F.col("o.n").alias("counts"))
    pairs = lists.select(*key, F.col("own.digest").alias("digests")).join(others, key)

    @F.pandas_udf("array<long>")
    def sums(digests: pd.Series, others: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([similar_sums(list(d), list(o), [int(n) for n in c], least) for d, o, c in zip(digests, others, counts)])

    found = pairs.select(*key, F.explode(F.arrays_zip(F.col("digests").alias("digest"), sums("digests", "others", "counts").alias("n"))).alias("x"))
    return found.groupBy(*key, F.col("x.digest").alias("digest")).agg(F.sum("x.n").alias("n"))


def noisy_tokens(pages: DataFrame, key: list[str], record: list[str]) -> DataFrame:
    """key, token: tokens of heads that occur more often than half the record's pages in all languages, and more than once, or that are frequent in the key itself."""
    total = pages.groupBy(*record).agg(F.count(F.lit(1)).alias("all_pages"))
    everywhere = head_tokens(pages, record).join(total, record).where((F.col("n") > F.floor(F.col("all_pages") / 2)) & (F.col("n") > 1)).select(*record, "token")
    counts = pages.groupBy(*key).agg(F.count(F.lit(1)).alias("pages"))
    own = frequent_tokens(pages, key).join(counts, key).where(is_frequent(F.col("n"), F.col("pages"))).select(*key, "token")
    return counts.select(*key).join(everywhere, record).select(*key, "token").unionByName(own).distinct()


def remove_headers(pages: DataFrame, key: list[str], single: bool = False, record: list[str] | None = None) -> DataFrame:
    """Pages without repeated first lines and without page numbers at the start of the others, cut at the footnote rule and stripped.

    single: first lines that occur once each but resemble one another are repeated ones too, as in the published script. Text
    at the start of pages that is alike on nearly all of them goes with them.
    record: the part of the key that a document's languages share (the key itself where there is one only). Where it is given,
    frequent tokens at the start of first lines go too, up to the first good one.
    """
    stats = page_offset(pages, key)
    lines = pages.select(*key, "page_id", F.posexplode(F.split(F.substring("page", 1, HEAD), "\n")).alias("at", "line"))
    counted = lines.withColumn("digest", line_digest(F.col("line"))).join(similar_digest_counts(pages, key, single=single), [*key, "digest"], "left").join(stats, key)
    drop = F.coalesce(is_frequent(F.col("n"), F.col("pages")), F.lit(False)) & (F.col("digest") != "")
    # Of each line the tokens from the first good one on. Empty lines stay, and so does white space where the head ends inside a line.
    tokens = counted.where(~drop).select(*key, "page_id", "offset", "at", F.posexplode_outer(py_split(F.col("line"))).alias("i", "token"))
    number = F.col("token").rlike(r"^\d+(?:$|/\d+)") & F.array_contains(F.regexp_extract_all("token", F.lit(r"(\d+)"), F.lit(1)), (F.col("page_id") + F.col("offset")).cast("string"))
    judged = tokens.withColumn("noisy", F.lit(False)) if record is None else tokens.join(noisy_tokens(pages, key, record).withColumn("noisy", F.lit(True)), [*key, "token"], "left")
    judged = judged.withColumn("good", ~(F.coalesce(F.col("noisy"), F.lit(False)) | F.coalesce(number, F.lit(False))))
    line = F.struct("at", F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("i", "token", "good")))).alias("tokens"))
    kept = judged.groupBy(*key, "page_id", "at").agg(line.alias("x"))
    first = lambda ts: F.coalesce(F.array_min(F.transform(F.filter(ts, lambda t: t["good"]), lambda t: t["i"])), F.lit(HEAD))
    text = lambda ts: F.array_join(F.transform(F.slice(ts, first(ts) + 1, HEAD), lambda t: t["token"]), " ")
    heads = kept.groupBy(*key, "page_id").agg(F.array_sort(F.collect_list("x")).alias("lines"))
    head = F.coalesce(F.array_join(F.transform("lines", lambda x: text(x["tokens"])), "\n"), F.lit(""))
    gap = F.when(F.substring("page", 1, HEAD).rlike(r"[^\S\n]\z"), F.lit(" ")).otherwise(F.lit(""))
    whole = F.concat(head, gap, F.substring("page", HEAD + 1, F.length("page")))
    clean = F.trim(F.regexp_replace(F.element_at(F.split(whole, CUT), 1), r"^\s+|\s+$", ""))
    return pages.join(heads, [*key, "page_id"], "left").select(*key, "page_id", clean.alias("page"))


def index_titles(lines: Iterator[str]) -> list[str]:
    """Titles of a contents page: lines of dots after at least four of them, with up to three lines before each that belong to it."""
    lines = list(lines)
    dotted = [i for i, x in enumerate(lines) if "..." in x]
    if len(dotted) < 4:
        return []
    out = []
    for i in dotted:
        title = lines[i].split("...")[0].strip()
        for back in range(1, 4):
            if i - back < 0 or "..." in lines[i - back] or 0 <= title.find(".") < 6:
                break
            title = f"{lines[i - back].strip()} {title}"
        out.append(title)
    return out
