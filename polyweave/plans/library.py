"""Queries over the functions and operators that the catalogue's do not run, with the same in SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X, urls as U
from ..operators import align, detectors, evaluate, frontier, headers, joiners, lines as L, records as R, relations
from ..sources import readers, writers
from ..streaming import events as E
from .catalogue import _CAPITAL, _DETECT, _LINES, _WRAP, _two_sides, query, table, wrapped


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


# text


@query("""select doc_id, translate(text, '，（）？：；“”‘’！', ',()?:;""''''!') as ascii from documents""")
def ascii_punctuation(spark, sf_dir):
    """STR-04: Chinese punctuation, put in first, becomes ASCII again."""
    made = F.translate("text", ",()?:;!", "，（）？：；！")
    return documents(spark, sf_dir).select("doc_id", X.ascii_punctuation(made).alias("ascii"))


@query("select doc_id, replace(text, chr(65534), '-') as hyphens from documents")
def lost_hyphens(spark, sf_dir):
    """STR-05: hyphens that a converter turned into U+FFFE."""
    return documents(spark, sf_dir).select("doc_id", X.noncharacter_to_hyphen(F.translate("text", "-", "￾")).alias("hyphens"))


@query(r"select doc_id, regexp_replace(regexp_replace(replace(text, '. ', '.' || chr(10) || ' ' || chr(9) || chr(10)), '\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g') as collapsed from documents")
def collapsed_blank_lines(spark, sf_dir):
    """STR-03: blank lines, put in behind sentences, go."""
    return documents(spark, sf_dir).select("doc_id", X.collapse_blank_lines(F.replace("text", F.lit(". "), F.lit(".\n \t\n"))).alias("collapsed"))


@query(r"""
with m as (select doc_id, replace(replace(text, ' a', ' ' || chr(9) || ' a'), chr(10), ' ' || chr(10) || ' ' || chr(10)) as t from documents),
n as (select doc_id, regexp_replace(regexp_replace(t, '[ \t]+\n', chr(10), 'g'), '\n[ \t]+', chr(10), 'g') as t from m)
select doc_id, regexp_replace(t, '[ \t]+([ \t])', '\1', 'g') as squeezed from n
""")
def squeezed_spaces(spark, sf_dir):
    """STR-03: of a run of white space its line feeds stay, or its last character."""
    made = F.replace(F.replace("text", F.lit(" a"), F.lit(" \t a")), F.lit("\n"), F.lit(" \n \n"))
    return documents(spark, sf_dir).select("doc_id", X.squeeze_spaces(made).alias("squeezed"))


@query(r"""
with p as (select doc_id, string_split(replace(text || chr(10), chr(13) || chr(10), chr(10)), chr(10)) as ls from documents), q as (select doc_id, case when ls[len(ls)] = '' then ls[1 : len(ls) - 1] else ls end as ls from p)
select doc_id, unnest(ls) as line, (generate_subscripts(ls, 1) - 1)::int as pos from q
""")
def split_lines(spark, sf_dir):
    """STR-02, ARR-04: lines of any kind of line end; the one at the end starts no line."""
    made = F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\n"))
    return documents(spark, sf_dir).select("doc_id", F.posexplode(X.py_splitlines(made)).alias("pos", "line"))


@query("select doc_id, round(length(regexp_replace(text, '[^e中]', '', 'g')) / length(text), 9) as share from documents where length(text) > 0")
def han_shares(spark, sf_dir):
    """STR-09: every e is made a Chinese character."""
    return documents(spark, sf_dir).where("length(text) > 0").select("doc_id", F.round(X.han_share(F.translate("text", "e", "中")), 9).alias("share"))


@query(rf"with {_LINES} select doc_id, count(*) as n, count(*) filter (line <> '' and not regexp_matches(regexp_replace(line, '[a-zA-Z0-9]', '', 'g'), '[\p{{L}}\p{{M}}\p{{Nd}}\p{{Nl}}\p{{Pc}}]')) as english from l group by doc_id")
def english_lines(spark, sf_dir):
    """STR-11: how many lines have ASCII letters only."""
    return L.to_lines(documents(spark, sf_dir)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(X.is_english_line(F.col("line"))).alias("english"))


_FURNITURE = ("A/CN.9/WG.VI/WP.22", "12/3 45 /6", "(Part IV)", "Article IX", "*12345*", "12-34567 (E)", "see A/CN.9/55 and")
_STRIP = lambda x: rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
_EDGED = _STRIP("line")
for _pattern in X.EDGE:
    _EDGED = _STRIP(f"regexp_replace({_EDGED}, '{_pattern}', '', 'g')")
_ANYWHERE = f"case when at_edge then {_EDGED} else {_STRIP('line')} end"
for _pattern in X.ANYWHERE:
    _ANYWHERE = f"regexp_replace({_ANYWHERE}, '{_pattern}', '', 'g')"


@query(rf"""with {_LINES}, m as (
  select doc_id, line_id, case when line_id % 3 = 0 then ' ' || ([{', '.join(repr(x) for x in _FURNITURE)}])[(line_id // 3 + doc_id) % 7 + 1] else line end as line,
    line_id < 4 or count(*) over (partition by doc_id) - line_id < 3 as at_edge from l
) select doc_id, line_id::int as line_id, {_ANYWHERE} as line from m""")
def lines_without_furniture(spark, sf_dir):
    """STR-06, FLT-22: file codes, page numbers and printing marks, put in at every third line, go at the edges of a page or anywhere."""
    made = F.element_at(F.array(*map(F.lit, _FURNITURE)), ((F.floor(F.col("line_id") / 3) + F.col("doc_id")) % 7 + 1).cast("int"))
    rows = documents(spark, sf_dir).select("doc_id", F.split("text", "\n").alias("ls")).select("doc_id", F.size("ls").alias("n"), F.posexplode("ls").alias("line_id", "line"))
    line = F.when(F.col("line_id") % 3 == 0, F.concat(F.lit(" "), made)).otherwise(F.col("line"))
    return rows.select("doc_id", "line_id", X.without_furniture(line, X.at_page_edge(F.col("line_id"), F.col("n"))).alias("line"))


@query(r"""select doc_id from documents where length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / length(text) >= 0.2 and len(string_split(text, chr(10))) > 2""")
def long_clean_documents(spark, sf_dir):
    """FLT-05/06: documents of three pages or more and enough Latin letters; a line stands for a page."""
    paged = F.replace("text", F.lit("\n"), F.lit("\n----\n"))
    return documents(spark, sf_dir).where(~X.is_short_or_garbled(paged)).select("doc_id")


@query(r"""with m as (select doc_id, case doc_id % 5 when 0 then '[ ] ' || chr(10) when 1 then '' when 2 then 'Http Status Code: 404' || chr(10) || chr(10) || 'Reason: File not found or unable to read file' || chr(10) else text end as t from documents)
select doc_id from m where regexp_matches(t, '[^\[\]\s]') and doc_id % 5 <> 2""")
def documents_without_garbage(spark, sf_dir):
    """FLT-20: texts of brackets and the note of a missing file, put in for three of five documents, go."""
    k = F.col("doc_id") % 5
    made = F.when(k == 0, "[ ] \n").when(k == 1, "").when(k == 2, X.MISSING_FILE + "\n").otherwise(F.col("text"))
    return documents(spark, sf_dir).where(~X.is_garbage(made)).select("doc_id")


@query("select doc_id, lang || chr(10) as banner from documents where false union all select doc_id, repeat('=', 40) || chr(10) || source || chr(10) || repeat('=', 40) || chr(10) || text from documents")
def dumped_documents(spark, sf_dir):
    """SNK-08: texts under banners, for reading."""
    return documents(spark, sf_dir).select("doc_id", writers.dump(F.col("source"), F.col("text")).alias("banner"))


# lines and breaks


@query(rf"""with {_WRAP}, f as (select doc_id, n, hard, max(n) over (partition by doc_id) as last from v)
select doc_id, coalesce(list(n::int order by n) filter (not hard and n < last), []) as soft, true as same from f group by doc_id""")
def breaks_as_indices(spark, sf_dir):
    """ARR-05: flags of hard breaks as indices of soft ones, and back."""
    soft = L.indices_of_flags(F.col("hard"))
    rows = wrapped(spark, sf_dir).withColumn("soft", soft)
    return rows.select("doc_id", F.transform("soft", lambda i: i.cast("int")).alias("soft"), (L.flags_of_indices(F.col("soft"), F.size("lines")) == F.col("hard")).alias("same"))


@query(rf"""with {_WRAP}, g as (select *, coalesce(lag(hard) over (partition by doc_id order by n), false) as new from v), p as (select *, sum(new::int) over (partition by doc_id order by n) as paragraph from g)
select doc_id, paragraph::bigint as paragraph, string_agg(piece, ' ' order by n) as text from p group by doc_id, paragraph""")
def soft_lines_as_rows(spark, sf_dir):
    """WIN-08, SNK-07: rows of lines to rows of paragraphs, as gaps and islands."""
    rows = wrapped(spark, sf_dir).select("doc_id", "hard", F.posexplode("lines").alias("line_id", "line"))
    return L.joined_rows(rows.withColumn("hard_before", F.when(F.col("line_id") > 0, F.get("hard", F.col("line_id") - 1))))


@query(rf"with {_WRAP} select doc_id, list(hard order by n)[1 : -2] as hard from v group by doc_id")
def compared_breaks(spark, sf_dir):
    """STR-15: a text with all its breaks against the same with blanks for the soft ones."""
    raw, joined = F.array_join("lines", "\n"), F.array_join(L.join_soft(F.col("lines"), F.col("hard")), "\n")
    return wrapped(spark, sf_dir).select("doc_id", L.compare_breaks(raw, joined).alias("hard"))


@query()
def near_break_flags(spark, sf_dir):
    """SEQ-03: which hard breaks are matched, and which of the shifted ones are used for it; every third of them is too far off."""
    true = F.filter(F.transform("hard", lambda h, i: F.when(h, i.cast("int"))), lambda i: i.isNotNull())
    rows = wrapped(spark, sf_dir).select("doc_id", true.alias("true")).withColumn("pred", F.transform("true", lambda t, i: t + F.when(i % 3 == 2, 9).otherwise(1)))
    return rows.select("doc_id", "true", "pred", L.near_match_flags(F.col("true"), F.col("pred"), 5).alias("m")).select("doc_id", "true", "pred", "m.*")


@query(r"""
with d as (select doc_id, string_split(case when doc_id % 3 = 0 then 'United Nations' || chr(10) || '12 May 2020' || chr(10) || 'Original: English' || chr(10) || (case when doc_id % 2 = 0 then 'Agenda item 4' || chr(10) else '' end) else '' end || text, chr(10)) as ls from documents),
h as (select doc_id, ls[1:12] as head from d),
n as (select doc_id, list_position(list_transform(head, lambda x: contains(lower(x), 'agenda')), true) as agenda,
  list_position(list_transform(head, lambda x: contains(x, 'Economic and Social Council Distr.:') or contains('Economic and Social Council Distr.:', x) or contains(x, 'United Nations') or contains('United Nations', x)
    or regexp_matches(x, '\d{1,2} [a-zA-Z]+ \d{4}') or regexp_matches(x, 'Original: [a-zA-Z]+') or length(x) * 0.5 > length(regexp_replace(x, '[^a-zA-Z]', '', 'g')) or length(x) < 40), false) as body from h)
select doc_id, case when coalesce(agenda, 0) > 0 then agenda when coalesce(body, 0) > 0 then body - 1 else 12 end::int as start from n
""")
def text_starts(spark, sf_dir):
    """FLT-21: where the text starts; every third document gets a heading, half of these an agenda."""
    heading = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("United Nations\n12 May 2020\nOriginal: English\n"), F.when(F.col("doc_id") % 2 == 0, "Agenda item 4\n").otherwise(""))).otherwise("")
    return documents(spark, sf_dir).select("doc_id", L.text_start(F.split(F.concat(heading, "text"), "\n")).alias("start"))


def _words(text: str) -> int:
    return len(text.split())


@query()
def token_batches(spark, sf_dir):
    """SEQ-02, FLT-25: batches under 64 tokens, counted by an outside function (words, here); short tails are marked."""
    return L.token_batches(wrapped(spark, sf_dir), "doc_id", "lines", _words, 64, 20)


@query()
def joined_paragraphs(spark, sf_dir):
    """UDF-03, WIN-08: English pages joined line by line, by a plain function over rows."""
    return joiners.map_lines(wrapped(spark, sf_dir), "doc_id", "lines", joiners.join_lines)


@query()
def model_chunks(spark, sf_dir):
    """SEQ-09: paragraphs in chunks of 64 tokens at most, where a word has a token for each three letters begun."""
    return joiners.map_lines(documents(spark, sf_dir).select("doc_id", X.py_split(F.col("text")).alias("words")), "doc_id", "words", _chunked)


def _chunked(words: list[str]) -> list[str]:
    return joiners.back_off_chunks(words, lambda s: sum(-(-len(w) // 3) for w in s.split()), 64)


@query()
def contents_titles(spark, sf_dir):
    """SEQ-05: a contents page made of each document's first lines, and its titles marked in the text."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 8)
    dotted = F.transform(F.slice(lines, 1, 6), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), F.substring(x, 1, 30), F.lit(" ..... "), i.cast("string")))
    body = F.transform(lines, lambda x, i: F.when(i < 6, F.concat((i + 1).cast("string"), F.lit(". "), F.substring(x, 1, 30))).otherwise(x))
    return joiners.marked_titles(documents(spark, sf_dir).select("doc_id", dotted.alias("contents"), body.alias("lines")), "doc_id", "contents", "lines")


@query(rf"""{_DETECT}, h as (select doc_id, n, piece, case when nxt is null then false else hard end as t, case when nxt is null then false else coalesce({_CAPITAL}, false) end as p from f),
b as (select doc_id, n, t, p, piece, regexp_extract(piece, '(\S*)$', 1) as word from h),
c as (select doc_id, n, piece, word, case when t and p then 'green' when t then 'red' when p then 'blue' end as colour from b)
select doc_id, string_agg(case when colour is null then piece else left(piece, length(piece) - length(word)) || '<span style="color:' || colour || '">' || word || '</span>' end, '<br>' order by n) as html from c group by doc_id""")
def error_views(spark, sf_dir):
    """SNK-09: found, missed and wrong breaks in colours."""
    found = detectors.detector({"name": "punctuation_capital"})(wrapped(spark, sf_dir))
    return found.select("doc_id", evaluate.error_view(F.col("lines"), F.col("hard"), F.col("detected")).alias("html"))


@query(rf"""{_DETECT}, x as (select doc_id, hard as t, ({_CAPITAL}) as p from f where nxt is not null), a as (select doc_id, count(*) filter (t = p) / count(*) as accuracy from x group by doc_id)
select least(floor(accuracy * 10), 9)::int as bucket, count(*) as n from a group by 1""")
def accuracy_histogram(spark, sf_dir):
    """AGG-24: how the documents' accuracies are spread."""
    return evaluate.histogram(detectors.evaluate(wrapped(spark, sf_dir).where("size(lines) > 1"), {"name": "punctuation_capital"}), "accuracy")


@query(rf"""{_DETECT}, s as (select doc_id, sum(len(string_split(piece, ' '))) as words from f group by doc_id), x as (select doc_id, hard as t, ({_CAPITAL}) as p from f join s using (doc_id) where nxt is not null and words <= 200)
select count(distinct doc_id) as documents, count(*) filter (t = p) as right from x""")
def short_documents_only(spark, sf_dir):
    """FLT-07: long documents are left out of an evaluation."""
    # Words of lines joined by line feeds are counted at blanks, so a line's end is no gap between words.
    found = detectors.evaluate(wrapped(spark, sf_dir).withColumn("lines", F.transform("lines", lambda x: F.concat(x, F.lit(" "))))
        .withColumn("lines", F.transform("lines", lambda x: F.rtrim(x))).where("size(lines) > 1 and size(split(array_join(lines, ' '), ' ')) <= 200"), {"name": "punctuation_capital"}, most_words=200)
    return found.agg(F.count_distinct("doc_id").alias("documents"), F.sum(F.col("TP") + F.col("TN")).alias("right"))


# alignment and headers


@query()
def interval_alignment(spark, sf_dir):
    """ALN-05, ALN-07: one re-wrapped line to its original ones, tokens cut by an outside function; pairs, dropped lines and a view."""
    return align.align_intervals(_two_sides(spark, sf_dir), "doc_id", "lines", "olines", tokenizer=_lower_words, glue=" ")


def _lower_words(text: str) -> list[str]:
    return text.lower().split()


@query("""
with w as (select doc_id // 4 as record, lang, max(text) as text from documents where lang in ('en', 'fr', 'de', 'es') group by all), r as (select distinct doc_id // 4 as record from documents),
x as (select r.record, l.lang, coalesce(w.text, '') as text from r cross join (select unnest(['en', 'fr', 'de', 'es']) as lang) l left join w on w.record = r.record and w.lang = l.lang)
select record, lang, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::int as page_id, unnest(string_split(text, chr(10))) as page from x
""")
def split_pages(spark, sf_dir):
    """T6: wide documents of marked pages as one row for each page; a line stands for a page."""
    long = documents(spark, sf_dir).select(F.floor(F.col("doc_id") / 4).alias("record"), "lang", F.replace("text", F.lit("\n"), F.lit("\n----\n")).alias("text"))
    return headers.split_pages(readers.pivot_languages(long, "record", "lang", "text", ["en", "fr", "de", "es"]), "record", ["en", "fr", "de", "es"])


# addresses and names


@query("""select doc_id, case when doc_id % 2 = 0 and lang <> '' then lang end as language, replace(source, '.', '_') || '.docx' as name, case when doc_id % 3 = 0 then 'recovered' end as state from documents""")
def title_languages(spark, sf_dir):
    """STR-24/25: languages out of link titles, and names with another extension."""
    title = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Open"), "lang", F.lit("WordDocument"))).otherwise("Open it")
    name = U.swap_extension(F.concat(F.replace("source", F.lit("."), F.lit("_")), F.lit(".doc")), ".docx")
    return documents(spark, sf_dir).select("doc_id", U.language_of_title(title).alias("language"), name.alias("name"), F.when(F.col("doc_id") % 3 == 0, "recovered").alias("state"))


@query("""select page_id, page_id % 2 = 0 and contains(lower(html), '<html>') and contains(lower(html), '<head>') as masked from pages""")
def masked_pages(spark, sf_dir):
    """FLT-16: pages where documents should be."""
    made = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<!DOCTYPE HTML PUBLIC "x">'), "html")).otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", U.masquerades_as_document(made).alias("masked"))


@query("""select doc_id from documents where doc_id % 4 <> 0 and doc_id % 3 <> 2""")
def convertible_documents(spark, sf_dir):
    """FLT-15: numbered documents in formats that can be converted."""
    k = F.col("doc_id") % 3
    url = F.concat(F.lit("https://h.x/a.b/"), "source", F.when(k == 0, ".DOC").when(k == 1, ".wpf").otherwise(".pdf"))
    return documents(spark, sf_dir).where(U.is_document(F.when(F.col("doc_id") % 4 != 0, F.col("doc_id")), url)).select("doc_id")


@query("""select page_id from pages where regexp_matches(url, '^https?://[^/]+/fr/')""")
def french_pages(spark, sf_dir):
    """FLT-18: addresses of one language's folder."""
    return table(spark, sf_dir, "pages").where(U.in_language(F.col("url"), "fr")).select("page_id")


@query("""select conv_id, turn from conversations where coalesce(text, '') <> '' and (turn % 3 <> 1) and coalesce(role, '') <> ''""")
def rows_with_both_texts(spark, sf_dir):
    """FLT-19: rows in which neither text is empty; every third turn's is made so."""
    other = F.when(F.col("turn") % 3 == 1, "").otherwise(F.col("text"))
    return relations.with_all(table(spark, sf_dir, "conversations").withColumn("other", other), "text", "other", "role").select("conv_id", "turn")


@query(r"""
with l as (select page_id, url, regexp_extract_all(html, '<a\s[^>]*?href="([^"#]+)"', 1) as x from pages), k as (select page_id, url, unnest(list_filter(x, lambda v, i: list_position(x, v) = i)) as link from l),
m as (select page_id, url, link, case when length(link) % 3 = 0 then link || '.PNG' else link end as made from k), r as (select *, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) as root, regexp_replace(url, '[?#].*$', '') as bare from m)
select page_id, link, contains(made, '.') and strpos(made, '.') > 1 and list_contains(['avi','wmv','mpeg','mp4','mov','mkv','flv','f4v','m4v','rmvb','rm','3gp','dat','ts','mts','vob','bmp','jpg','png','tiff','gif','pcx','tga','exif','fpx','svg','psd','cdr','pcd','dxf','ufo','eps','ai','raw','wmf','mp3','aiff','aac'], lower(regexp_replace(made, '^.*\.', ''))) as media,
  contains(made, 'search?') or contains(made, 'download?') or contains(made, 'subscribe?') or contains(made, 'system/403?') or contains(made, 'sustainabledevelopment.un.org/') or contains(made, 'https://www.un.org/unispal/documents/?') as excluded,
  case when regexp_matches(link, '^[a-z]+://') then link when starts_with(link, '//') then regexp_extract(url, '^([a-z]+:)', 1) || link when starts_with(link, '/') then root || link
    else case when length(regexp_replace(bare, '^[a-z]+://', '')) > 0 and contains(regexp_replace(bare, '^[a-z]+://', ''), '/') then regexp_replace(bare, '/[^/]*$', '') else bare end || '/' || link end as address
from r
""")
def page_addresses(spark, sf_dir):
    """FLT-17, STR-21: links of pages as whole addresses, and which are media files or excluded."""
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.explode(U.links(F.col("html"))).alias("link"))
    made = F.when(F.length("link") % 3 == 0, F.concat("link", F.lit(".PNG"))).otherwise(F.col("link"))
    return rows.select("page_id", "link", U.is_media(made).alias("media"), U.is_excluded(made).alias("excluded"), U.absolute(F.col("link"), F.col("url")).alias("address"))


@query("""select page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(url || '?"a*|', '?', '_QMARK_'), ':', '_COLON_'), '|', '_PIPE_'), '/', '_SLASH_'), '*', '_STAR_'), '"', '_QT_'), chr(92), '_BS_'), '<', '_LT_'), '>', '_GT_') as name from pages""")
def escaped_names(spark, sf_dir):
    """STR-25: addresses as file names."""
    return table(spark, sf_dir, "pages").select("page_id", U.escape_name(F.concat("url", F.lit('?"a*|'))).alias("name"))


@query("""select doc_id, case doc_id % 7 when 0 then 'doc' when 1 then 'docx' when 2 then 'pdf' when 3 then 'wpf' when 4 then 'rtf' when 5 then 'html' else 'unknown' end as kind from documents""")
def file_kinds(spark, sf_dir):
    """SRC-15: kinds of files by their first bytes."""
    marks = F.array(*[F.lit(k) for k, _ in readers.MAGIC], F.lit("00"))
    content = F.concat(F.unhex(F.element_at(marks, (F.col("doc_id") % 7 + 1).cast("int"))), F.col("text").cast("binary"))
    return documents(spark, sf_dir).select("doc_id", readers.file_kind(content).alias("kind"))


# records


@query("""select distinct event_type as "文件名", case event_id % 3 when 1 then 'x' else 'y' end as key from events where event_id % 3 <> 0""")
def unknown_extension_keys(spark, sf_dir):
    """JSN-02: keys that the format doesn't define, once for each file; two of three rows have one."""
    k = F.col("event_id") % 3
    ext = F.when(k == 0, F.col("props")).when(k == 1, '{"x": 1, "k": 2}').otherwise('{"y": {"k": 1}, "other_texts": {}}')
    return R.unknown_extension_keys(table(spark, sf_dir, "events").select(F.col("event_type").alias("文件名"), ext.alias("扩展字段")))


@query("""select doc_id, case doc_id % 3 when 0 then ['deu', 'X'] when 1 then [] else [] end::varchar[] as bad from documents""")
def bad_other_languages(spark, sf_dir):
    """JSN-02: keys of other texts that are no language codes."""
    k = F.col("doc_id") % 3
    ext = F.when(k == 0, '{"other_texts":{"fr":"a","deu":"b","X":"c"}}').when(k == 1, '{"other_texts":{"fr":"a"}}').otherwise("{}")
    return documents(spark, sf_dir).select("doc_id", R.bad_other_languages(ext).alias("bad"))


@query("""select event_id, json_extract_string(props, '$.k') as k, true as whole from events""")
def salvaged_json(spark, sf_dir):
    """JSN-04: objects that lost their first brace, as every other one here."""
    x = R.salvaged_json(F.when(F.col("event_id") % 2 == 0, F.expr("substring(props, 2)")).otherwise(F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(x, "$.k").alias("k"), (R.salvaged_json(F.lit('{"a"')).isNull() & x.isNotNull()).alias("whole"))


@query(r"""
with p as (select source, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents),
m as (select source, doc_id, i, case when i % 3 = 0 then '' else regexp_replace(line, '^\s+|\s+$', '', 'g') end as zh, regexp_replace(regexp_replace(line, '^\S+ ?', ''), '^\s+|\s+$', '', 'g') as en,
  regexp_replace('fr ' || line, '^\s+|\s+$', '', 'g') as fr from p),
k as (select * from m where len(list_distinct(list_filter([zh, en, fr], lambda x: x <> ''))) > 1 qualify row_number() over (partition by source, zh, en, fr order by doc_id, i) = 1),
n as (select *, row_number() over (partition by source, zh order by doc_id, i) > 1 as again from k)
select source as "文件名", count(*) as "段落数", count(*) filter (again) as "去重段落数", count(*) filter (zh = '' or en = '') as "低质量段落数" from n group by source
""")
def file_counts(spark, sf_dir):
    """AGG-01..04, FLT-01: counts of files in three languages, of which every third paragraph lacks the first."""
    rows = L.to_lines(documents(spark, sf_dir).select(F.struct("source", "doc_id").alias("k"), "text"), key="k").select(F.col("k.source").alias("文件名"), "k.doc_id", "line_id", "line")
    texts = {"zh_text": F.when(F.col("line_id") % 3 == 0, "").otherwise(F.col("line")), "en_text": F.regexp_replace("line", r"^\S+ ?", ""), "fr_text": F.concat(F.lit("fr "), "line")}
    rows = rows.withColumns(texts | {"扩展字段": F.lit("{}"), "时间": F.lit("")}).drop("line")
    return R.normalise(rows, list(texts), ["doc_id", "line_id"], F.floor(F.col("doc_id") / 256)).select("文件名", "段落数", "去重段落数", "低质量段落数").distinct()


# relations


@query("""select doc_id, lang, l.quality, l.toxic from documents d join (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id) l using (doc_id)""")
def labelled_documents(spark, sf_dir):
    """JOIN-04: documents with their labels; one without would be an error."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    docs = documents(spark, sf_dir).select("doc_id", "lang").join(labels.select("doc_id"), "doc_id", "left_semi")
    return relations.with_labels(docs, labels, "doc_id")


@query("select d.doc_id as row_id, d.lang, upper(d.source) as translated from documents d where doc_id % 5 < 3")
def rows_of_shards(spark, sf_dir):
    """JOIN-05: source rows with the translated rows of the same stored number."""
    rows = documents(spark, sf_dir).select(F.col("doc_id").alias("row_id"), "lang", "source")
    shards = rows.where("row_id % 5 < 3").select("row_id", F.upper("source").alias("translated"))
    return relations.at_positions(rows.drop("source"), shards)


@query("""select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F') or c_custkey in (select c_custkey from customer where c_acctbal < 0)""")
def done_customers(spark, sf_dir):
    """JOIN-09: rows whose key is in any of several tables."""
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return relations.already_done(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), [done, table(spark, sf_dir, "customer").where("c_acctbal < 0")], "c_custkey")


@query("""select doc_id, case doc_id % 7 when 0 then '中文' when 1 then '阿拉伯文' when 2 then '法文' when 3 then '英文' when 4 then '西班牙文' when 5 then '俄文' else 'none' end as name from documents""")
def language_names(spark, sf_dir):
    """JOIN-11: a small constant map."""
    key = F.element_at(F.array(*map(F.lit, [*relations.LANGUAGE_NAMES, "Latin"])), (F.element_at(F.array(*map(F.lit, (1, 2, 3, 4, 5, 6, 7))), (F.col("doc_id") % 7 + 1).cast("int"))))
    return documents(spark, sf_dir).select("doc_id", relations.looked_up(relations.LANGUAGE_NAMES, key, "none").alias("name"))


@query("""select count(*) as known, count(*) filter (page_id % 3 <> 0) as visited, count(*) filter (page_id % 3 = 2) as failed from pages""")
def crawl_progress(spark, sf_dir):
    """AGG-27: how many addresses are known, visited and failed."""
    status = F.when(F.col("page_id") % 3 == 0, 0).when(F.col("page_id") % 3 == 1, 1).otherwise(-1)
    return frontier.progress(table(spark, sf_dir, "pages").select("url", status.alias("status")))


@query("""select max(doc_id) as highest from documents where doc_id % 3 = 1""")
def highest_numbered_file(spark, sf_dir):
    """AGG-25: the file to go on behind; names of other forms don't count."""
    k = F.col("doc_id") % 3
    name = F.concat(F.when(k == 2, "x").otherwise(""), F.col("doc_id").cast("string"), F.when(k == 0, ".json.bak").otherwise(".json"))
    return frontier.highest_number(documents(spark, sf_dir).select(name.alias("name")), "name")


@query("""select year(o_orderdate)::int as year_time, o_orderkey from orders order by 1, 2""")
def orders_by_year(spark, sf_dir):
    """SRT-01: by year, in order of position where years are equal."""
    return relations.in_order(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year_time"), "o_orderkey"), "year_time", "o_orderkey")


@query("""select 'r' || user_id as record, event_type as reason, count(*) as n from events where user_id = 7 group by all order by reason""")
def reasons_of_a_record(spark, sf_dir):
    """SRT-02: one record's filters in order of their reasons."""
    from ..operators import audit
    from .catalogue import event_log

    return relations.in_order(audit.per_record(event_log(spark, sf_dir)).where("record = 'r7'"), "reason")


# events


@query("""select event_type, time_bucket(interval 1 day, ts, timestamp '1970-01-01')::timestamp as window_start, count(*) as n, round(sum(value), 4) as total from events group by 1, 2""")
def event_tumbling(spark, sf_dir):
    """STM-00: a day's events, by the stream's own function over a batch."""
    return E.tumbling(_events(spark, sf_dir)).select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("total", 4).alias("total"))


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("""with w as (select time_bucket(interval 6 hour, ts, timestamp '1970-01-01') - unnest([0, 1, 2, 3]) * interval 6 hour as s from events) select s::timestamp as window_start, count(*) as n from w group by 1""")
def event_sliding(spark, sf_dir):
    """STM-00: days that begin every six hours."""
    return E.sliding(_events(spark, sf_dir)).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("""with g as (select user_id, ts, coalesce(ts > lag(ts) over w + interval 30 minute, true) as new from events window w as (partition by user_id order by ts)), s as (select *, sum(new::int) over (partition by user_id order by ts) as k from g)
select user_id, min(ts)::timestamp as session_start, (max(ts) + interval 30 minute)::timestamp as session_end, count(*) as n from s group by user_id, k""")
def event_sessions(spark, sf_dir):
    """STM-00: a user's events with gaps under half an hour."""
    s = E.sessions(_events(spark, sf_dir))
    return s.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


@query("""with t as (select event_id, case when event_id % 2 = 0 then 'leased' else 'done' end as state, ts from events) select event_id, case when state = 'leased' and ts < (select max(ts) from events) - interval 3600 second then 'queued' else state end as state from t""")
def expired_leases(spark, sf_dir):
    """STM-02: leases that are over go back to the queue."""
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts")).first()[0]
    return E.expired_leases(e.select("event_id", F.when(F.col("event_id") % 2 == 0, "leased").otherwise("done").alias("state"), F.col("ts").alias("leased_at")), now, 3600).select("event_id", "state")
