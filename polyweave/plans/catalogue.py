"""Queries over the corpus operators, by name, on the driver's tables, and the same in SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numerals, text as X, urls as U
from ..operators import align, audit, blocks, charset, detectors, evaluate, frontier, headers, joiners, lines as L, records as R, relations
from ..sources import readers, writers

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as paragraph records of two languages, by source; the second is the line without its first word."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("source").alias("文件名"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line_id", "zh_text"))
    return rows.withColumns({"en_text": F.regexp_replace("zh_text", r"^\S+ ?", ""), "扩展字段": F.lit("{}"), "时间": F.lit("20240101")})


#: The same in SQL.
PARAGRAPHS = r"""
p as (
  select "文件名", doc_id, line_id, regexp_replace(zh_text, '^\s+|\s+$', '', 'g') as zh_text, regexp_replace(regexp_replace(zh_text, '^\S+ ?', ''), '^\s+|\s+$', '', 'g') as en_text
  from (select source as "文件名", doc_id, unnest(string_split(text, chr(10))) as zh_text, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_id from documents)
)
"""
_NORMAL = rf"""
with {PARAGRAPHS}, r as (select * from p where zh_text <> '' and en_text <> '' and zh_text <> en_text),
d as (select * from r qualify row_number() over (partition by "文件名", zh_text, en_text order by doc_id, line_id) = 1),
n as (
  select *, row_number() over (partition by "文件名" order by doc_id, line_id) as "行号", row_number() over (partition by "文件名", zh_text order by doc_id, line_id) > 1 as "是否重复",
    count(*) over (partition by "文件名") as "段落数"
  from d
)
select "文件名", "行号", "是否重复", "段落数", count(*) filter ("是否重复") over (partition by "文件名") as "去重段落数", 0::bigint as "低质量段落数",
  zh_text, en_text, md5(zh_text) as zh_text_md5, '{{}}' as "扩展字段", '20240101' as "时间" from n
"""


@query(_NORMAL)
def normalise_corpus(spark, sf_dir):
    """FLT-01/02, SET-02, WIN-01/02, AGG-01..04, STR-01/17."""
    rows = R.normalise(paragraphs(spark, sf_dir), ["zh_text", "en_text"], ["doc_id", "line_id"], F.floor(F.col("doc_id") / 256))
    return rows.select("文件名", "行号", "是否重复", "段落数", "去重段落数", "低质量段落数", "zh_text", "en_text", "zh_text_md5", "扩展字段", "时间")


@query(r"""
select source || '#' || doc_id as "文件名", pos::int as pos, pos::bigint as "行号", line as en_text, case when pos % 2 = 0 then '20230506' else '20240101' end as "时间", case pos % 3 when 0 then '{"a":1,"k":"v"}' when 1 then '{}' end as "扩展字段"
from (select source, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)
""")
def legacy_explode(spark, sf_dir):
    """ARR-01, ARR-08, JSN-01, FLT-03: a file for each document with its lines as nested paragraphs, inherited dates, canonical extension."""
    return R.explode_legacy(_legacy_files(spark, sf_dir)).select("文件名", "pos", "行号", "en_text", "时间", "扩展字段")


def _legacy_files(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ext = lambda i: F.when(i % 3 == 0, '{ "k": "v", "a": 1}').when(i % 3 == 1, "").otherwise('{"k": ')
    paragraph = lambda x, i: F.struct(
        i.cast("bigint").alias("行号"), x.alias("en_text"), ext(i).alias("扩展字段"), F.when(i % 2 == 0, "20230506").otherwise("").alias("时间"),
        F.when(i % 5 == 4, x).otherwise("").alias("other1_text"), F.lit("").alias("other2_text"), F.lit("gone").alias("备注"),
    )
    return docs.select(F.concat_ws("#", "source", "doc_id").alias("文件名"), F.lit("20240101").alias("时间"), F.transform(F.split("text", "\n"), paragraph).alias("段落"))


@query(r"""
with p as (select source || '#' || doc_id as "文件名", unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as pos from documents)
select "文件名", pos::int as pos, 'broken extension' as reason from p where pos % 3 = 2 union all select "文件名", pos::int, 'other1_text is not empty' from p where pos % 5 = 4 and line <> ''
""")
def rejected_paragraphs(spark, sf_dir):
    """JSN-01, ARR-02: what the format forbids, by place and reason."""
    return R.rejected_paragraphs(_legacy_files(spark, sf_dir))


@query("""select json_extract_string(props, '$.k') as k, count(*) as n from events group by 1""")
def extension_values(spark, sf_dir):
    """JSN-01/02, MAP-01: a field of JSON strings."""
    return table(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("""select k as key, count(*) as n from (select unnest(json_keys(props)) as k from events) group by k""")
def extension_keys(spark, sf_dir):
    """JSN-02: which keys occur."""
    return table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


_LINES = "l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_id from documents)"
_WRAP = rf"""
{_LINES}, w as (
  select doc_id, line_id, list_filter(regexp_split_to_array(line, '[ \t\x0b\f\r]+'), lambda x: x <> '') as ws from l
), cc as (
  select doc_id, line_id, i, array_to_string(ws[i * 8 + 1 : i * 8 + 8], ' ') as piece, i = (len(ws) - 1) // 8 as hard
  from (select *, unnest(range(0, (len(ws) - 1) // 8 + 1)) as i from w where len(ws) > 0)
), v as (select doc_id, row_number() over (partition by doc_id order by line_id, i) - 1 as n, piece, hard from cc)
"""


def wrapped(spark, sf_dir) -> DataFrame:
    return L.rewrap(table(spark, sf_dir, "documents"), 8)


@query(rf"with {_WRAP} select doc_id, n as line_id, piece as line, hard from v")
def rewrap_lines(spark, sf_dir):
    """Lines: lines with known hard and soft breaks (the last break of a document is hard)."""
    rows = wrapped(spark, sf_dir)
    return rows.select("doc_id", F.posexplode("lines").alias("line_id", "line"), "hard").select("doc_id", F.col("line_id").cast("bigint").alias("line_id"), "line", F.coalesce(F.get("hard", F.col("line_id")), F.lit(True)).alias("hard"))


_DETECT = rf"with {_WRAP}, f as (select doc_id, n, piece, hard, lead(piece) over (partition by doc_id order by n) as nxt from v)"
_CAPITAL = r"piece like '%.' or piece like '%;' or regexp_matches(nxt, '^\p{Lu}') or nxt like '–%'"


@query(rf"{_DETECT} select doc_id, n as line_id, ({_CAPITAL}) as detected from f where nxt is not null")
def break_punctuation_capital(spark, sf_dir):
    """WIN-03, UDF-01/02."""
    return detectors.detector({"name": "punctuation_capital"})(wrapped(spark, sf_dir)).select("doc_id", F.posexplode("detected").alias("line_id", "detected")).withColumn("line_id", F.col("line_id").cast("bigint"))


@query(rf"{_DETECT} select doc_id, count(*) filter (nxt like '–%') as n from f where nxt is not null group by doc_id")
def break_dash(spark, sf_dir):
    """WIN-04."""
    found = detectors.detector({"name": "dash"})(wrapped(spark, sf_dir)).where("size(detected) > 0")
    return found.select("doc_id", F.size(F.filter("detected", lambda x: x)).cast("bigint").alias("n"))


_CONFUSION = rf"""{_DETECT}, x as (select doc_id, hard as t, ({_CAPITAL}) as p from f where nxt is not null),
c as (select doc_id, count(*) filter (t and p) as "TP", count(*) filter (t and not p) as "FN", count(*) filter (not t and p) as "FP", count(*) filter (not t and not p) as "TN" from x group by doc_id)
"""


@query(rf"""{_CONFUSION} select *, ("TP" + "TN") / ("TP" + "FN" + "FP" + "TN") as accuracy from c""")
def confusion_by_document(spark, sf_dir):
    """AGG-11, SEQ-10."""
    return detectors.evaluate(wrapped(spark, sf_dir).where("size(lines) > 1"), {"name": "punctuation_capital"})


@query(rf"""{_CONFUSION}, s as (select sum("TP") a, sum("FN") b, sum("FP") c, sum("TN") d from c),
k as (select 'hard' as label, a / (a + c) as precision, a / (a + b) as recall, a + b as support from s union all select 'soft', d / (d + b), d / (d + c), d + c from s),
k2 as (select label, precision, recall, 2 * precision * recall / (precision + recall) as f1, support::double as support from k)
select * from k2 union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from k2
union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) from k2
union all select 'accuracy', (a + d) / (a + b + c + d), (a + d) / (a + b + c + d), (a + d) / (a + b + c + d), a + b + c + d from s""")
def classification_report(spark, sf_dir):
    """AGG-12."""
    return evaluate.report(detectors.evaluate(wrapped(spark, sf_dir), {"name": "punctuation_capital"}))


@query(r"""
with d as (select doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: array_to_string(list_filter(regexp_split_to_array(x, '[ \t\x0b\f\r]+'), lambda w: w <> ''), ' ')), lambda x: x <> '') as ls from documents)
select doc_id, (i - 1)::bigint as paragraph, ls[i] as text from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as i from d)
""")
def join_soft_lines(spark, sf_dir):
    """WIN-08: joining at the true soft breaks gives the original lines."""
    rows = wrapped(spark, sf_dir).select("doc_id", F.posexplode(L.join_soft(F.col("lines"), F.col("hard"))).alias("paragraph", "text"))
    return rows.withColumn("paragraph", F.col("paragraph").cast("bigint"))


@query(rf"""
with {_LINES}, m as (select doc_id, line_id, (line_id // 3 % 5 + 1) as c from l where line_id % 3 = 0),
r as (select doc_id, line_id, c, lag(line_id) over w as prev, lag(c) over w as pc from m window w as (partition by doc_id order by line_id))
select doc_id, unnest(range(prev, line_id - 1)) as line_id from r where c = pc + 1 and line_id - 2 >= prev
""")
def all_list_marker_runs(spark, sf_dir):
    """STR-18/19, WIN-05: numbered lines are made of every third line, with counters that follow only sometimes."""
    return _marker_runs(table(spark, sf_dir, "documents"), F.lit(True))


def _marker_runs(docs: DataFrame, marked) -> DataFrame:
    rows = L.to_lines(docs)
    made = rows.withColumn("line", F.when((F.col("line_id") % 3 == 0) & marked, F.concat((F.floor(F.col("line_id") / 3) % 5 + 1).cast("string"), F.lit(". "), "line")).otherwise(F.concat(F.lit("x"), "line")))
    return L.list_runs(made).withColumn("line_id", F.col("line_id").cast("bigint"))


@query()
def greedy_batches(spark, sf_dir):
    """SEQ-01/02: batches of at most 200 estimated tokens with a line of overlap."""
    return wrapped(spark, sf_dir).select("doc_id", F.posexplode(L.greedy_batches(F.col("lines"), 200)).alias("batch", "members"))


@query()
def near_break_match(spark, sf_dir):
    """SEQ-03: the true hard breaks against the same ones shifted by one."""
    rows = wrapped(spark, sf_dir).select("doc_id", F.transform(F.filter(F.transform("hard", lambda h, i: F.when(h, i)), lambda i: i.isNotNull()), lambda i: i.cast("int")).alias("true"))
    return rows.select("doc_id", L.near_matches(F.col("true"), F.transform("true", lambda t: t + 1), 5).alias("matched"))


@query(r"""
with d as (select doc_id, lang, case lang when 'fr' then '[À-Ÿ]' when 'es' then '[áéíóúñÁÉÍÓÚÑüÜ]' when 'de' then '[ÄäÖöÜüß]' end as own, text from documents),
o as (select doc_id, lang, length(regexp_replace(text, '[^!-/:-@\[-`{-~\s\p{L}\p{N}_]', '', 'g')) / (length(text) + 1e-3) as rate from d)
select doc_id, lang, round(rate, 9) as rate, rate < 0.8 as suspect from o
""")
def charset_occupancy(spark, sf_dir):
    """AGG-19, MTH-01."""
    return charset.occupancy(table(spark, sf_dir, "documents")).select("doc_id", "lang", F.round("rate", 9).alias("rate"), "suspect")


@query(r"""
with d as (select doc_id, lang, length(text) + 1e-3 as n, length(regexp_replace(text, '[^À-Ÿ]', '', 'g')) as fr, length(regexp_replace(text, '[^áéíóúñÁÉÍÓÚÑüÜ]', '', 'g')) as es, length(regexp_replace(text, '[^ÄäÖöÜüß]', '', 'g')) as de from documents),
h as (select doc_id, lang, case when lang <> 'fr' and fr / n > 0.1 then 'fr' when lang <> 'es' and es / n > 0.1 then 'es' when lang <> 'de' and de / n > 0.1 then 'de' end as detected_lang, fr / n as f, es / n as e, de / n as g from d)
select doc_id, lang, detected_lang, round(case detected_lang when 'fr' then f when 'es' then e else g end, 9) as rate from h where detected_lang is not null
""")
def foreign_script(spark, sf_dir):
    """AGG-20."""
    return charset.foreign(table(spark, sf_dir, "documents")).select("doc_id", "lang", "detected_lang", F.round("rate", 9).alias("rate"))


def event_log(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("r"), F.col("user_id").cast("string")).alias("record"), F.concat(F.lit("filter: "), "event_type", F.lit(", more")).alias("reason"), F.regexp_replace("props", ",", "\n").alias("filtered"))


_LOG = "g as (select 'r' || user_id as record, event_type as reason, len(string_split(props, ',')) as lines from events)"


@query(f"with {_LOG} select record, reason, count(*) as n from g group by all")
def audit_by_record(spark, sf_dir):
    """AGG-05."""
    return audit.per_record(event_log(spark, sf_dir))


@query(f"""with {_LOG}, r as (select reason, count(*) as filters, sum(lines)::bigint as lines from g group by reason), t as (select sum(filters)::bigint as f, sum(lines)::bigint as l from r)
select reason, filters, lines, round_even(filters / f, 4) as filter_share, round_even(lines / l, 4) as line_share from (select * from r union all select 'total', f, l from t) cross join t""")
def audit_by_reason(spark, sf_dir):
    """AGG-06/07/08, JOIN-02."""
    return audit.by_reason(event_log(spark, sf_dir))


@query(f"with {_LOG} select count(distinct record) as records, count(*) as entries from g")
def audit_records(spark, sf_dir):
    """AGG-09."""
    return event_log(spark, sf_dir).agg(F.count_distinct("record").alias("records"), F.count(F.lit(1)).alias("entries"))


def pages_of(spark, sf_dir) -> DataFrame:
    """Documents in pages of five lines, each with a fixed first line, its number and its text."""
    paged = headers.to_pages(table(spark, sf_dir, "documents"), "doc_id", "text", 5)
    return paged.withColumn("page", F.concat(F.lit("General Report\n"), (F.col("page_id") + 2).cast("string"), F.lit("\n"), "page"))


_PAGES = r"""
a as (select doc_id, string_split(text, chr(10)) as ls from documents),
b as (select doc_id, p::int as page_id, 'General Report' || chr(10) || (p + 2) || chr(10) || array_to_string(ls[p * 5 + 1 : p * 5 + 5], chr(10)) as page from (select doc_id, ls, unnest(range(0, (len(ls) - 1) // 5 + 1)) as p from a))
"""


@query(rf"with {_PAGES}, t as (select doc_id, unnest(list_filter(regexp_split_to_array(substr(page, 1, 100), '\s+'), lambda x: x <> '')) as token from b) select doc_id, token, count(*) as n from t group by all")
def header_tokens(spark, sf_dir):
    """AGG-13."""
    return headers.head_tokens(pages_of(spark, sf_dir), ["doc_id"])


@query(rf"with {_PAGES}, t as (select doc_id, unnest(list_filter(regexp_split_to_array(substr(page, 1, 100), '\s+'), lambda x: x <> '')) as token from b), c as (select doc_id, count(*) as pages from b group by doc_id) select doc_id, token, count(*) as n from t join c using (doc_id) group by doc_id, token, pages having count(*) between 3 and pages")
def frequent_header_tokens(spark, sf_dir):
    """AGG-14."""
    return headers.frequent_tokens(pages_of(spark, sf_dir), ["doc_id"])


@query(rf"with {_PAGES}, t as (select doc_id, regexp_replace(unnest(string_split(substr(page, 1, 100), chr(10))), '\s+', '', 'g') as digest from b) select doc_id, digest, count(*) as n from t where digest <> '' group by all")
def header_digests(spark, sf_dir):
    """AGG-15."""
    return headers.head_digests(pages_of(spark, sf_dir), ["doc_id"])


@query(rf"""with {_PAGES}, n as (select doc_id, page_id, try_cast(v as int) as x from (select doc_id, page_id, unnest(regexp_extract_all(substr(page, 1, 100), '(\d+)', 1)) as v from b) where regexp_full_match(v, '0|[1-9][0-9]*')),
h as (select distinct doc_id, page_id, x - page_id as o from n where x - page_id between -9 and 2), c as (select doc_id, o, count(*) as hits from h group by all),
z as (select doc_id, max(hits) as hits, arg_min(o, (-hits, o)) as o from c group by doc_id), t as (select doc_id, count(*) as pages from b group by doc_id)
select t.doc_id, pages, case when z.hits >= pages // 2 then z.o end::int as "offset" from t left join z using (doc_id)""")
def page_offset(spark, sf_dir):
    """AGG-16, AGG-17."""
    return headers.page_offset(pages_of(spark, sf_dir), ["doc_id"])


@query()
def header_removal(spark, sf_dir):
    """SEQ-08, JOIN-13, STR-13, SNK-07, AGG-13/14: four documents in a row stand for the languages of a record."""
    pages = pages_of(spark, sf_dir).withColumn("record", F.floor(F.col("doc_id") / 4))
    return headers.remove_headers(pages, ["record", "doc_id"], single=True, record=["record"]).drop("record")


@query(rf"""
with a as (select conv_id, turn as i, list_distinct(string_split(lower(text), ' ')) as ws from conversations),
s as (select x.conv_id, x.i, y.i as k, len(list_intersect(x.ws, y.ws)) / len(list_distinct(list_concat(x.ws, y.ws))) as score from a x join a y on x.conv_id = y.conv_id and y.i between x.i - 5 and x.i + 4 and y.i <> x.i)
select conv_id, i, k, score from s qualify row_number() over (partition by conv_id, i order by score desc, k) = 1
""")
def jaccard_band_best(spark, sf_dir):
    """JOIN-10, SET-07, SRT-06: for each turn the most similar other one near it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("i"), F.array_distinct(F.split(F.lower("text"), " ")).alias("tokens"))
    return evaluate.band_best(rows, rows, "conv_id", 5, itself=False)


@query("""
with t as (select distinct p_name from part), s as (select p_name, length(p_name) as n from t)
select a.p_name as line, count(*) as likely from s a join s b on abs(a.n - b.n) <= 3 and levenshtein(a.p_name, b.p_name) <= 3 group by a.p_name
""")
def fuzzy_titles(spark, sf_dir):
    """JOIN-12, STR-12: names within three edits. Each name is cut in four parts, of which three edits leave one whole, so candidates share a part near its place."""
    names = table(spark, sf_dir, "part").select("p_name").distinct().withColumn("n", F.length("p_name"))
    return _within_three(names)


def _within_three(names: DataFrame) -> DataFrame:
    """Pigeonhole on four parts: name b has a part of a at a place shifted by at most three; then the edit distance itself."""
    size = F.floor(F.col("n") / 4)
    parts = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(k.alias("k"), (k * size).cast("int").alias("at"), F.when(k == 3, F.col("n") - 3 * size).otherwise(size).cast("int").alias("m")))
    a = names.select("p_name", "n", F.explode(parts).alias("q")).select("p_name", "n", "q.k", "q.at", "q.m", F.substring(F.col("p_name"), F.col("q.at") + 1, F.col("q.m")).alias("part"))
    lengths = F.explode(F.sequence(F.greatest(F.col("n") - 3, F.lit(0)), F.col("n") + 3)).alias("of_n")
    b = names.select(F.col("p_name").alias("other"), "n", lengths)
    step = F.floor(F.col("of_n") / 4)
    spots = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.transform(F.sequence(F.greatest(k * step - 3, F.lit(0)), k * step + 3), lambda s: F.struct(k.alias("k"), F.substring(F.col("other"), (s + 1).cast("int"), F.when(k == 3, F.col("of_n") - 3 * step).otherwise(step).cast("int")).alias("part")))))
    b = b.select("other", "of_n", F.explode(F.array_distinct(spots)).alias("q")).select("other", F.col("of_n").alias("n"), "q.k", "q.part")
    pairs = a.join(b, ["n", "k", "part"]).where(F.levenshtein("p_name", "other", 3) >= 0).select("p_name", "other").distinct()
    return pairs.groupBy(F.col("p_name").alias("line")).agg(F.count(F.lit(1)).alias("likely"))


@query(r"""select page_id, unnest(l) as link, (generate_subscripts(l, 1) - 1)::int as pos from (select page_id, list_distinct_ordered as l from (
  select page_id, list_filter(x, lambda v, i: list_position(x, v) = i) as list_distinct_ordered from (select page_id, regexp_extract_all(html, '<a\s[^>]*?href="([^"#]+)"', 1) as x from pages)))""")
def page_links(spark, sf_dir):
    """SRC-14, STR-21, SET-04."""
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(U.links(F.col("html"))).alias("pos", "link"))


@query(r"""
with a as (select page_id, url, regexp_replace(regexp_replace(regexp_replace(url, '^http://\s*', 'https://'), '\r?\n', '', 'g'), '\s*#.*', '', 'g') as u from pages),
b as (select page_id, url, regexp_replace(regexp_replace(regexp_replace(u, '(\.pdf)&.*', '\1', 'g'), '(asp)\?.*', '\1', 'g'), '\.un\.org/../', '.un.org/', 'g') as u from a)
select page_id, regexp_replace(regexp_replace(regexp_replace(u, '/[^./]*?/../', '/', 'g'), '\s*[|/?]$', '', 'g'), ' ', '%20', 'g') as clean, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host,
  list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1), '/'), lambda x: x <> '') as parts from b
""")
def clean_urls(spark, sf_dir):
    """STR-20/22."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.clean_url(url).alias("clean"), U.host(url).alias("host"), U.path_parts(url).alias("parts"))


@query(r"""
with recursive l as (select 'p' || page_id as url, 'p' || unnest([page_id * 2 + 1, page_id * 2 + 2, page_id // 2]) as target from pages),
s as (select 'p0' as url union select l.target from s join l on s.url = l.url)
select url, case when exists (select 1 from l where l.url = s.url) then 1 else -1 end::int as status from s
""")
def whole_crawl(spark, sf_dir):
    """GRA-03: from one page until no address is new. Each page links to two behind it and one before it, so all are reached, and those behind the last fail."""
    to = F.explode(F.array(F.col("page_id") * 2 + 1, F.col("page_id") * 2 + 2, F.floor(F.col("page_id") / 2)))
    links = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), "page_id").alias("url"), to.alias("to")).select("url", F.concat(F.lit("p"), "to").alias("target"))
    return frontier.crawl(spark.createDataFrame([("p0",)], "url string"), links)


@query("select doc_id as id, md5(text) as hash, (doc_id > min(doc_id) over (partition by md5(text)))::int as is_duplicate from documents")
def content_hash_marks(spark, sf_dir):
    """SET-03, STR-17, T14."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return frontier.content_marks(docs).select("id", "hash", "is_duplicate")


@query("""select record, coalesce(max(text) filter (lang = 'en'), '') as en, coalesce(max(text) filter (lang = 'fr'), '') as fr, coalesce(max(text) filter (lang = 'de'), '') as de, coalesce(max(text) filter (lang = 'es'), '') as es
from (select doc_id // 4 as record, lang, text from documents) group by record""")
def pivot_languages(spark, sf_dir):
    """AGG-22, SRC-10, T5."""
    long = table(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 4).alias("record"), "lang", "text")
    return readers.pivot_languages(long, "record", "lang", "text", ["en", "fr", "de", "es"])


@query("select lang, count(*) as docs, sum(len(string_split(text, chr(10))))::bigint as lines from documents where doc_id in (select doc_id from labels) group by lang")
def semi_lines(spark, sf_dir):
    """JOIN-03, FLT-09, AGG-10."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.size(F.split("text", "\n"))).alias("lines"))


@query("select lang, count(*) as docs from documents where doc_id not in (select doc_id from labels) group by lang")
def anti_labels(spark, sf_dir):
    """FLT-10, SET-05, SNK-11: what a resumed job has still to do."""
    return writers.missing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))


@query("""select coalesce(d.doc_id, l.doc_id) as doc_id, case when l.doc_id is null then '+' else '-' end as side from (select distinct doc_id from documents) d full join (select distinct doc_id from labels) l on d.doc_id = l.doc_id where d.doc_id is null or l.doc_id is null""")
def document_label_difference(spark, sf_dir):
    """JOIN-08: + documents without a label, - labels without a document."""
    return relations.difference(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("""with u as (select page_id, regexp_matches(url, '/(en|fr|de|es)/') as ok, url from pages), w as (select page_id, min(ok::int) over z as good, count(*) over z as n, list(url) over z as urls from u window z as (order by page_id rows between current row and 5 following))
select page_id, urls from w where n = 6 and good = 1""")
def six_link_window(spark, sf_dir):
    """WIN-07: six addresses in a row that all name a language. Rows are numbered and cut into stretches, each with the next stretch's first five rows, so that no window holds all rows."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.col("url").rlike("/(en|fr|de|es)/").alias("ok"))
    size = 4096
    p = R.numbered(p.withColumn("all", F.lit(0)), "all", ["page_id"], F.floor(F.col("page_id") / size), "row").drop("all")
    part = F.floor((F.col("row") - 1) / size)
    # The first five rows of a stretch also go to the one before it, which needs them.
    spread = p.withColumn("part", F.explode(F.array_distinct(F.array(part, F.floor((F.col("row") - 6) / size)))))
    w = Window.partitionBy("part").orderBy("page_id").rowsBetween(0, 5)
    out = spread.withColumns({"good": F.min(F.col("ok").cast("int")).over(w), "urls": F.collect_list("url").over(w)})
    return out.where((part == F.col("part")) & (F.size("urls") == 6) & (F.col("good") == 1)).select("page_id", "urls")


@query("""with r as (select min(o_orderdate)::date as a, max(o_orderdate)::date as b from orders), w as (select unnest(generate_series(date_trunc('week', a), b - interval 1 day, interval 7 day))::date as m, a, b from r)
select greatest(m, a) as week_start, least((m + interval 6 day)::date, b) as week_end from w""")
def week_ranges(spark, sf_dir):
    """SRC-19, DAT-01."""
    dates = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return readers.week_ranges(dates, "a", "b")


@query("""with r as (select min(o_orderdate)::date as a, max(o_orderdate)::date as b from orders), w as (select unnest(range(0, (b - a + 1) // 7))::int as bucket, a from r)
select bucket, a + bucket * 7 as first_day, a + bucket * 7 + 6 as last_day from w""")
def seven_day_buckets(spark, sf_dir):
    """SRC-20."""
    dates = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    return readers.seven_day_buckets(dates, "a", "b")


@query("""with w as (select unnest(string_split(lower(text), ' ')) as word, generate_subscripts(string_split(lower(text), ' '), 1) as i, doc_id from documents), p as (select doc_id, word, lag(word) over (partition by doc_id order by i) as prev from w)
select prev, word, count(*) as n from p where prev is not null group by all""")
def all_word_pairs(spark, sf_dir):
    """AGG-18: neighbours within a document, from the first occurrence on."""
    return joiners.pair_counts(table(spark, sf_dir, "documents").select(F.split(F.lower("text"), " ").alias("words")))


@query("select doc_id, round(length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text), 9) as rate, len(string_split(text, chr(10))) > 2 as long_enough from documents")
def letter_rate_filter(spark, sf_dir):
    """The shares that FLT-05/06 filter by."""
    return table(spark, sf_dir, "documents").select("doc_id", F.round(X.latin_share(F.col("text")), 9).alias("rate"), (F.size(F.split("text", "\n")) > 2).alias("long_enough"))


@query("select doc_id, unnest(list_transform(range(0, length(text), 768), lambda i: substr(text, i + 1, 768))) as chunk, unnest(range(0, (length(text) + 767) // 768))::int as pos from documents where length(text) > 0")
def text_chunks(spark, sf_dir):
    """STR-16."""
    return table(spark, sf_dir, "documents").where("length(text) > 0").select("doc_id", F.posexplode(X.chunks(F.col("text"), 768)).alias("pos", "chunk"))


@query("select role, count(*) as n, count(distinct conv_id) as convs, max(turn) as last from conversations group by role")
def role_counts(spark, sf_dir):
    """Rows, conversations and last turn by role."""
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("conv_id").alias("convs"), F.max("turn").alias("last"))


@query("select conv_id, arg_max(text, turn) as text, max(turn) as turn from conversations group by conv_id")
def last_value_wins(spark, sf_dir):
    """AGG-23."""
    return relations.last_wins(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")


@query("select doc_id, lang, source, n_chars from documents where doc_id between 100 and 199")
def row_range(spark, sf_dir):
    """SRC-21/22: a range of a stored row number reaches the scan as a pushed filter."""
    return table(spark, sf_dir, "documents").where(F.col("doc_id").between(100, 199)).select("doc_id", "lang", "source", "n_chars")


@query("""select 'en' as split, count(*) as n from documents where lang = 'en' union all select 'fr', count(*) from documents where lang = 'fr' union all select 'de', count(*) from documents where lang = 'de'""")
def union_splits(spark, sf_dir):
    """SET-01."""
    d = table(spark, sf_dir, "documents").select("lang")
    parts = [d.where(F.col("lang") == x).agg(F.lit(x).alias("split"), F.count(F.lit(1)).alias("n")) for x in ("en", "fr", "de")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""with p as (select page_id, unnest(['doc', 'pdf']) as type, unnest(['EN', 'FR']) as language, url from pages) select page_id, language, type, url from p where type = 'doc'""")
def link_tree_unnest(spark, sf_dir):
    """ARR-03, FLT-14, T15: two levels of nested links."""
    leaf = lambda t: F.array(F.struct(F.lit(t).alias("type"), "url"))
    tree = F.array(F.struct(F.lit("EN").alias("language"), leaf("doc").alias("file_links")), F.struct(F.lit("FR").alias("language"), leaf("pdf").alias("file_links")))
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(tree).alias("l")).select("page_id", "l.language", F.explode("l.file_links").alias("f"))
    return rows.select("page_id", "language", "f.type", "f.url").where("type = 'doc'")


def _two_sides(spark, sf_dir) -> DataFrame:
    """Original lines and re-wrapped ones of each document; both come from one row, so nothing is joined."""
    olines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", olines.alias("olines")).alias("k"), "text")
    return L.rewrap(docs, 8, key="k").select("k.doc_id", "k.olines", "lines")


@query()
def align_n_to_m(spark, sf_dir):
    """ALN-01..08, GRA-02: original lines against re-wrapped ones."""
    return align.align_rows(_two_sides(spark, sf_dir), "doc_id", "olines", "lines")


@query()
def unmatched_paragraphs(spark, sf_dir):
    """SET-08: lines of both sides that no alignment of their document holds."""
    sides = _two_sides(spark, sf_dir)
    return align.unmatched_rows(sides, align.align_rows(sides, "doc_id", "olines", "lines"), "doc_id", "olines", "lines")


@query()
def language_blocks(spark, sf_dir):
    """GRA-01, ARR-06/07, JOIN-01, WIN-09, SRT-03/04: two alignments of a record share a pivot, and blocks follow from both."""
    base = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record"), F.posexplode(F.split("text", "\n")).alias("i", "text"))
    pair = lambda src, k: base.select("record", F.concat_ws("|", F.col("i").cast("string"), F.floor(F.col("i") / k).cast("string")).alias("clean_para_index_set_pair"), F.lit(src).alias("src"), F.lit("en").alias("dst"))
    members = blocks.components(blocks.member_edges(pair("fr", 2).union(pair("de", 3))))
    text = lambda lang: base.select("record", F.lit(lang).alias("lang"), F.col("i").alias("idx"), "text")
    return blocks.block_numbers(blocks.assemble(members, text("fr").union(text("de")).union(text("en")), ["en", "fr", "de"]))


@query()
def rule_based_breaks(spark, sf_dir):
    """WIN-06, STR-13, UDF-08's rules: the score detector, by document."""
    return detectors.evaluate(wrapped(spark, sf_dir).where("size(lines) > 1"), {"name": "rule_based"})


@query()
def line_numerals(spark, sf_dir):
    """STR-18: every line of the documents as a Roman and as a Chinese numeral."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_id", "line"))
    return lines.select("doc_id", "line_id", numerals.roman(F.col("line")).alias("roman"), numerals.chinese(F.col("line")).alias("chinese"))


@query("""select event_type, date_trunc('day', ts)::timestamp as day, count(*) as n, round(sum(value), 4) as total from events group by all""")
def daily_events(spark, sf_dir):
    """Events by day and type."""
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("select user_id as record, list_sort(list_distinct(flatten(list([event_id % 10, event_id % 7])))) as br from events group by user_id")
def folded_breaks(spark, sf_dir):
    """AGG-21, SET-06: break indices of all batches of a record."""
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("record"), F.array(F.col("event_id") % 10, F.col("event_id") % 7).alias("br"))
    return relations.folded_breaks(log)


@query("select conv_id as record, max(turn) + 1 as next from conversations group by conv_id")
def resume_positions(spark, sf_dir):
    """WIN-10."""
    return relations.resume_at(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("record"), F.col("turn").alias("r")))


@query("""with p as (select conv_id as w, turn + 1 as page, (turn * 7 + conv_id) % 20 + 1 as rows from conversations), l as (select w, max(page) as page, arg_max(rows, page) as rows from p group by w)
select w, page + 1 as next_page from l where (page - 1) * 20 + rows < 60""")
def unfinished_windows(spark, sf_dir):
    """FLT-24."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("w"), (F.col("turn") + 1).alias("page"), ((F.col("turn") * 7 + F.col("conv_id")) % 20 + 1).alias("rows"), F.lit(60).alias("total"))
    return relations.unfinished(pages, "w", "total")


@query("""select d.doc_id, case when l.doc_id is not null and l.quality = 1 then 'fixed' else d.lang end as lang from documents d left join labels l on d.doc_id = l.doc_id where not exists (select 1 from labels x where x.doc_id = d.doc_id and x.quality = 0)""")
def reworked_rows(spark, sf_dir):
    """JOIN-06, FLT-23: rows of a drop table go, rows of a rework table get its value."""
    labels = table(spark, sf_dir, "labels")
    rework = labels.where("quality = 1").select("doc_id", F.lit("fixed").alias("lang")).dropDuplicates(["doc_id"])
    return relations.reworked(table(spark, sf_dir, "documents").select("doc_id", "lang"), rework, labels.where("quality = 0"), ["doc_id"], "lang")


@query("""select c_custkey as value, 'c' as name, n_name as key from customer join nation on c_nationkey = n_nationkey union all select c_custkey, 'd', n_name from customer join nation on c_nationkey = n_nationkey""")
def all_inverted_maps(spark, sf_dir):
    """JOIN-07, MAP-01: maps of rows as rows to look up in."""
    return _inverted(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))


def _inverted(customers: DataFrame, nations: DataFrame) -> DataFrame:
    rows = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("n_name").alias("key"), F.create_map(F.lit("c"), "c_custkey", F.lit("d"), "c_custkey").alias("m"))
    return relations.inverted(rows, "key", "m")


@query("select doc_id, regexp_replace(lang || '-' || right('https://x/' || source || '/' || doc_id || '.doc', 12), '[/]', '_', 'g') as name, '.doc' as ext from documents")
def document_names(spark, sf_dir):
    """STR-23, STR-25, FLT-15."""
    url = F.concat(F.lit("https://x/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".doc"))
    return table(spark, sf_dir, "documents").select("doc_id", U.document_name(F.col("lang"), url).alias("name"), U.extension(url).alias("ext"))


@query("select doc_id, list_transform(list_filter(list_transform(range(0, length(text)), lambda i: case when substr(text, i + 1, 1) = '.' then i end), lambda x: x is not null), lambda x: x::int) as stops from documents")
def stop_positions(spark, sf_dir):
    """STR-14."""
    return table(spark, sf_dir, "documents").select("doc_id", X.positions_of(F.col("text"), ".").alias("stops"))


@query(r"select doc_id, regexp_replace(regexp_replace(replace(text, chr(160), ''), '\n+', chr(10), 'g'), '^\s+|\s+$', '', 'g') as clean from documents")
def cleaned_articles(spark, sf_dir):
    """STR-10."""
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_article(F.col("text")).alias("clean"))
