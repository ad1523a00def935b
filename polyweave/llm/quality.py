"""Host-level quality rules, with DataFrame functions only.

Each document is measured once, the measures are staged, each rule's failures are added up by host, the failure rates are
shrunk with a beta prior for each rule, fitted to all hosts by the method of moments, and the hosts' verdicts are joined back
to the documents: a host fails when the shrunk rate of any rule, or of failures by any rule, is over that rule's limit.

Defined results: null text has no words and fails; a null host is a host of its own; an empty table gives an empty
result; repeated rows are each judged; further columns are ignored. Three-word windows are compared by 64-bit hashes
within one document only. A document with many repeated windows takes the sorting path, so the work stays n log n.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, SPACE_CLASS, let, staged, text_of

#: Up to so many different repeated windows are looked up one by one.
FEW_REPEATS = 12


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def _covered(flagged: Column) -> Column:
    """How many words the three-word windows that start at the sorted positions cover."""
    return let(flagged, lambda f: F.aggregate(F.transform(f, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(f, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x))


def repeated_words(words: Column) -> Column:
    def of_windows(t: Column) -> Column:
        def by_lookup(repeats: Column) -> Column:
            return F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: F.array_contains(repeats, F.get(t, i)))

        def by_sorting(z: Column) -> Column:
            alike = F.filter(z, lambda x, i: F.coalesce(F.get(z, i + 1)["h"] == x["h"], F.lit(False)) | F.coalesce((i > 0) & (F.get(z, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]), F.lit(False)))
            return F.sort_array(F.transform(alike, lambda x: x["p"]))

        repeats = let(F.sort_array(t), lambda s: F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, F.greatest(i - 1, F.lit(0)))))))
        pairs = F.sort_array(F.transform(t, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return let(
            repeats,
            lambda r: F.when(F.size(r) == 0, F.lit(0)).when(F.size(r) <= FEW_REPEATS, _covered(by_lookup(r))).otherwise(_covered(let(pairs, by_sorting))),
        )

    windows = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(windows(w), of_windows)))


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    text = text_of("text")
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    words = words_of(text)
    return (
        docs.select(
            "doc_id", F.col(host).cast("string").alias("host"),
            let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))).alias("m"),
            F.length(F.regexp_replace(text, SPACE_CLASS + "+", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            lines.cast("long").alias("n_dup_lines"),
        )
        .select("doc_id", "host", "m.n_words", "word_chars", "n_symbols", "n_dup_lines", "m.n_repeat_words")
        .withColumn("too_short", F.col("n_words") < 50)
        .withColumn("too_repetitive", F.expr("100 * n_repeat_words > 50 * n_words"))
        .withColumn("base_failed", F.col("too_short") | F.col("too_repetitive"))
    )


#: The highest shrunk rates that a host may have: of documents that are too short, too repetitive, and either.
MOST = {"too_short": 0.5, "too_repetitive": 0.4, "base_failed": 0.5}


def host_rules(docs: DataFrame, host: str = "source", most: dict[str, float] = MOST) -> DataFrame:
    """One row per row of docs(doc_id, text, host): measures, base_failed, the host's shrunk rates, and kept.

    kept is false where the document itself fails or its host does.
    """
    rows = staged(measures(docs, host), "quality-measures")
    kinds = tuple(most)
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(k).alias(k) for k in kinds])
    # One row of totals, whatever the number of hosts.
    prior = hosts.agg(*[x for k in kinds for x in (F.avg(F.col(k) / F.col("n")).alias(f"{k}_m"), F.var_samp(F.col(k) / F.col("n")).alias(f"{k}_v"))]).first()

    def shrunk(k: str) -> Column:
        m, v = prior[f"{k}_m"], prior[f"{k}_v"]
        a, b = (1.0, 1.0) if m is None or not v or v >= m * (1 - m) else (m * (m * (1 - m) / v - 1), (1 - m) * (m * (1 - m) / v - 1))
        return (F.col(k) + F.lit(a)) / (F.col("n") + F.lit(a + b))

    verdicts = hosts.select(F.col("host").alias("of_host"), F.col("n").alias("host_docs"), *[shrunk(k).alias(f"host_{k}_rate") for k in kinds])
    return (
        rows.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")), "left")
        .withColumn("host_failed", functools.reduce(lambda a, b: a | b, [F.coalesce(F.col(f"host_{k}_rate") > limit, F.lit(False)) for k, limit in most.items()]))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
        .drop("of_host", "host", "too_short", "too_repetitive")
    )


ORACLE = r"""
with d as (
  select doc_id, source, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents
), g as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from d where len(words) >= 3)
), f as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, gram) as c from g) where c > 1
), r as (
  select doc_id, sum(least(3, coalesce(nxt - i, 3))) as n_repeat_words
  from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from f) group by doc_id
), m as (
  select d.doc_id, d.source, len(words) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) as n_dup_lines,
    coalesce(r.n_repeat_words, 0)::bigint as n_repeat_words
  from d left join r on d.doc_id = r.doc_id
), b as (
  select *, n_words < 50 as short, 100 * n_repeat_words > 50 * n_words as repetitive, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m
), h as (
  select source, count(*) as n, count(*) filter (short) as ks, count(*) filter (repetitive) as kr, count(*) filter (base_failed) as kb from b group by source
), x as (
  select source, 'short' as rule, 0.5 as most, n, ks as k from h union all select source, 'repetitive', 0.4, n, kr from h union all select source, 'both', 0.5, n, kb from h
), p as (select rule, avg(k / n) as m, var_samp(k / n) as v from x group by rule
), q as (
  select rule, case when m is null or v is null or v = 0 or v >= m * (1 - m) then 1.0 else m * (m * (1 - m) / v - 1) end as a,
    case when m is null or v is null or v = 0 or v >= m * (1 - m) then 1.0 else (1 - m) * (m * (1 - m) / v - 1) end as b from p
), verdicts as (
  select source, bool_or((x.k + q.a) / (x.n + q.a + q.b) > x.most) as host_failed from x join q using (rule) group by source
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words, base_failed, not base_failed and not host_failed as kept
from b join verdicts on b.source is not distinct from verdicts.source
"""
