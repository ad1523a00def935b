"""Golden values and brute force for the corpus operators."""

import datetime
import difflib
import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from polyweave.functions import text as X
from polyweave.functions import urls as U
from polyweave.operators import align, blocks, charset, detectors, evaluate, frontier, headers, lines, records
from polyweave.sources import readers, writers


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize("value", ["", "  a b ", "\x1ca\x1f", "a\r\nb\n", "a\x0bb\x85c ", "\n", "  x　", "a\n\n b \t c"])
def test_python_text_functions(spark, value):
    assert one(spark, value, X.py_strip(F.col("x"))) == value.strip()
    assert one(spark, value, X.py_split(F.col("x"))) == value.split()
    assert one(spark, value, X.py_splitlines(F.col("x"))) == value.splitlines()


@pytest.mark.parametrize("value, expected", [("a  \n b", "a\nb"), ("a \t b", "a b"), ("a\t\tb", "a\tb"), (" a ", " a "), ("a\n \nb", "a\n\nb"), ("a \t", "a\t")])
def test_squeeze_spaces(spark, value, expected):
    assert one(spark, value, X.squeeze_spaces(F.col("x"))) == expected


@pytest.mark.parametrize("value, expected", [("a\nb", "a b"), ("x\n+--+--+\n| a | b |\n| c | d |\n+--+--+\ny", "x\nac\tbd y"), ("", "")])
def test_clean_paragraph(spark, value, expected):
    assert one(spark, value, X.clean_paragraph(F.col("x"))) == expected


def test_md5_of_published_rows(spark):
    for value, md5 in (("正在生成海洋沙", "b656579704c6ca5acc29f2aa36159ce2"), ("就在这里过夜吧。", "59bbf0b5cef5cd943cd0ba59acd1e7c4"), ("我来生火。", "552f113da3617f26fa2c6ca9dfa21836")):
        assert one(spark, value, F.md5("x")) == md5


def test_likely_same(spark):
    rows = spark.createDataFrame([("kit", "sitting", False), ("flaw", "lawn", True)], "a string, b string, y boolean")
    assert all(r.got == r.y for r in rows.select("y", X.likely_same(F.col("a"), F.col("b")).alias("got")).collect())


def test_near_matches(spark):
    row = spark.createDataFrame([([1, 100, 200, 300, 400, 500], [101, 301, 402])], "t array<int>, p array<int>").select(lines.near_matches(F.col("t"), F.col("p"), 5).alias("m")).first()
    assert row.m == [100, 300, 400]


def brute_batches(ls, limit):
    out, batch, load = [], [], 0.0
    for i, x in enumerate(ls):
        w = len(x.split()) * (100 / 75)
        if load + w > limit:
            if batch:
                out.append([*batch, i])
            batch, load = [i], w
        else:
            batch.append(i)
            load += w
    return out + ([batch] if batch else [])


def test_greedy_batches(spark):
    rng = random.Random(3)
    rows = [[" ".join("w" * rng.randrange(0, 9)) for _ in range(rng.randrange(0, 30))] for _ in range(40)]
    got = spark.createDataFrame([(r,) for r in rows], "x array<string>").select("x", lines.greedy_batches(F.col("x"), 12).alias("y")).collect()
    assert all(r.y == brute_batches(r.x, 12) for r in got)


def test_markers_and_dash(spark):
    from polyweave.functions.numerals import marker

    rows = spark.createDataFrame([("12. a", "number_dot", 12), ("(c) x", "letter_parens", 2), ("IV. x", "roman_dot", 4), ("3.2 x", "dotted", 2), ("二十一、甲", "chinese_comma", 21), ("plain", None, None)], "x string, r string, c int")
    assert all((r.m and (r.m.rule, r.m.counter)) == (r.r and (r.r, r.c)) for r in rows.select("r", "c", marker(F.col("x")).alias("m")).collect())
    assert one(spark, ["a", "b", "– c", "d"], lines.pairs(F.col("x"), lines.dash_flag), "array<string>") == [False, True, False]


def test_subsequence_is_longest_and_rising():
    rng = random.Random(5)
    for _ in range(200):
        a, b = [[rng.choice("abcd") for _ in range(rng.randrange(0, 14))] for _ in range(2)]
        pairs = align.common_subsequence(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(pairs) == best[-1][-1]


def test_alignment_components_of_rewrapped_lines():
    whole = ["one two three four five", "six seven", "eight nine ten"]
    cut = ["one two", "three four", "five", "six seven", "eight nine", "ten"]
    found = align.Alignment(cut, whole)
    assert found.sets(0.5) == {0: [0, 1, 2], 1: [3], 2: [4, 5]} and found.intervals(0.5) == {0: (0, 2), 1: (3, 3), 2: (4, 5)}
    assert [(c["source"], c["target"]) for c in found.components()] == [([0, 1, 2], [0]), ([3], [1]), ([4, 5], [2])]
    assert align.Alignment(["a", "b"], ["x"]).segments() == [(0, 0), (1, 1)]


def test_blocks(spark):
    rows = [(1, "0|0", "fr", "en"), (1, "0|0,1", "de", "en"), (1, "5|7", "fr", "en"), (2, "0|0", "fr", "en")]
    found = blocks.components(blocks.member_edges(spark.createDataFrame(rows, "record bigint, clean_para_index_set_pair string, src string, dst string")))
    got = {}
    for r in found.collect():
        got.setdefault((r.record, r.block), set()).add(r.node)
    assert sorted(map(sorted, got.values())) == [["de:0", "en:0", "en:1", "fr:0"], ["en:0", "fr:0"], ["en:7", "fr:5"]]


def test_detector_registry(spark):
    with pytest.raises(ValueError):
        detectors.detector({"name": "none"})
    rows = spark.createDataFrame([(1, ["a b", "c d", "Next one", "goes on"])], "doc_id bigint, lines array<string>")
    answer = detectors.detector({"name": "batch", "complete": lambda text: "a b c d\nNext one goes on"})(rows).first()
    assert answer.detected == [False, True, False]
    known = spark.createDataFrame([(1, [True, False, True])], "doc_id bigint, is_hard_linebreak array<boolean>")
    assert detectors.detector({"name": "offline", "labels": known, "key": "doc_id"})(rows).first().detected == [True, False, True]


def test_confusion_and_report(spark):
    rows = spark.createDataFrame([(1, [True, True, False, False], [True, False, True, False]), (2, [], [])], "k bigint, t array<boolean>, p array<boolean>")
    found = evaluate.confusion(rows, "k", "t", "p")
    assert [tuple(r) for r in found.orderBy("k").collect()] == [(1, 1, 1, 1, 1, 0.5), (2, 0, 0, 0, 0, 0.0)]
    assert {r.label for r in evaluate.report(found).collect()} == {"hard", "soft", "macro avg", "weighted avg", "accuracy"}


def test_headers_go_and_text_stays(spark):
    pages = spark.createDataFrame([(1, i, f"United Nations\n{i + 2}\ntext of page number {'x' * i} ends") for i in range(6)], "doc bigint, page_id int, page string")
    got = [r.page for r in headers.remove_headers(pages, ["doc"]).orderBy("page_id").collect()]
    assert all(p.startswith("text of page") for p in got) and len(got) == 6


def brute_similar(pages):
    """Occurrences of all similar digests of the page heads, as the published script sums them."""
    counts = Counter("".join(x.split()) for p in pages for x in p[: headers.HEAD].splitlines())
    counts.pop("", None)
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
    return {a: sum(n for b, n in counts.items() if ratio(a, b) > 0.72) for a in counts}


def test_headers_that_differ_by_page_go(spark):
    words = "amber birch cedar delta ember frost grove haven inlet joker".split()
    texts = [f"A/CN.9/WG.VI/WP.22 Page {i + 2}\n{' '.join(words[i:] + words[:i])} {w * 9}\nend" for i, w in enumerate(words)]
    rows = spark.createDataFrame([(1, i, x) for i, x in enumerate(texts)] + [(2, 0, "A/CN.9/WG.VI/WP.22 Page 9\nalone")], "doc bigint, page_id int, page string")
    for block in (256, 3):
        got = {(r.doc, r.digest): r.n for r in headers.similar_digest_counts(rows, ["doc"], block=block).collect()}
        assert got == {(1, d): n for d, n in brute_similar(texts).items()} | {(2, d): n for d, n in brute_similar(["A/CN.9/WG.VI/WP.22 Page 9\nalone"]).items()}
    clean = {(r.doc, r.page_id): r.page for r in headers.remove_headers(rows, ["doc"], single=True).collect()}
    assert not any("WG.VI" in page for (doc, _), page in clean.items() if doc == 1) and "WG.VI" in clean[2, 0] and len(clean) == 11


def brute_tokens(record):
    """The published script's pages of a record (lang to pages), where all of its first lines are too different to go whole."""
    everywhere = Counter(t for pages in record.values() for p in pages for t in p[: headers.HEAD].split())
    half = sum(map(len, record.values())) // 2
    out = {}
    for lang, pages in record.items():
        n = len(pages)
        own = Counter(t for p in pages for t in p[: headers.HEAD].split())
        frequent = {t for t, c in own.items() if 3 <= c <= n and (c >= n - 1 or n >= 5 and c > n * 0.666)}
        for i, p in enumerate(pages):
            lines = [x.split() for x in p[: headers.HEAD].splitlines()]
            kept = [" ".join(itertools.dropwhile(lambda t: everywhere[t] > half or t in frequent, x)) for x in lines]
            out[lang, i] = ("\n".join(kept) + p[headers.HEAD :]).strip()
    return out


def test_frequent_tokens_go_up_to_the_first_good_one(spark):
    words = "amber birch cedar delta ember frost grove haven inlet joker kayak lemon".split()
    page = lambda i, mark: f"A/1 {mark} {words[i] * 5} A/1 {words[-i - 1] * 4}\n{words[i - 3] * 20} A/1\nbody {words[i] * 20} end"
    record = {"en": [page(i, "May") for i in range(6)], "fr": [page(i + 6, "mai") for i in range(5)], "de": ["A/1 Mai"]}
    rows = spark.createDataFrame([(1, lang, i, p) for lang, pages in record.items() for i, p in enumerate(pages)] + [(2, "en", 0, "A/1 alone")], "record bigint, lang string, page_id int, page string")
    got = {(r.record, r.lang, r.page_id): r.page for r in headers.remove_headers(rows, ["record", "lang"], single=True, record=["record"]).collect()}
    assert got == {(1, *k): v for k, v in brute_tokens(record).items()} | {(2, "en", 0): "A/1 alone"}
    assert got[1, "en", 0].startswith("amber") and got[1, "de", 0] == "Mai"


def test_normaliser_is_a_fixpoint(spark):
    rows = [("f", 0, 0, "甲", "a"), ("f", 0, 1, " 甲 ", "a"), ("f", 0, 2, "甲", "b"), ("f", 1, 0, "乙", ""), ("f", 1, 1, "乙", "乙"), ("g", 2, 0, "", "c"), ("g", 2, 1, "丙", "d")]
    df = spark.createDataFrame(rows, "`文件名` string, doc_id bigint, line_id bigint, zh_text string, en_text string").withColumns({"扩展字段": F.lit("{}"), "时间": F.lit("")})
    once = records.normalise(df, ["zh_text", "en_text"], ["doc_id", "line_id"], F.col("doc_id"))
    assert once.columns == records.FIELDS
    got = [(r["文件名"], r["行号"], r["zh_text"], r["en_text"], r["是否重复"], r["段落数"], r["去重段落数"]) for r in once.orderBy("文件名", "行号").collect()]
    assert got == [("f", 1, "甲", "a", False, 2, 1), ("f", 2, "甲", "b", True, 2, 1), ("g", 1, "丙", "d", False, 1, 0)]
    again = records.normalise(once.select("文件名", F.col("行号").alias("doc_id"), F.lit(0).alias("line_id"), "zh_text", "en_text", "扩展字段", "时间"), ["zh_text", "en_text"], ["doc_id", "line_id"], F.col("doc_id"))
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_urls(spark):
    assert one(spark, "http://www.un.org/a.pdf&x=1#y", U.clean_url(F.col("x"))) == "https://www.un.org/a.pdf"
    assert one(spark, "https://h/x.MP4", U.is_media(F.col("x"))) is True and one(spark, "https://h/search?q", U.is_excluded(F.col("x"))) is True
    assert one(spark, 'a?b:c/"d"', U.escape_name(F.col("x"))) == "a_QMARK_b_COLON_c_SLASH__QT_d_QT_"
    assert one(spark, "/en/x", U.absolute(F.col("x"), F.lit("https://a.org/b/c"))) == "https://a.org/en/x"


def test_frontier(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "a")], "url string, target string")
    got = {r.url: r.status for r in frontier.crawl(spark.createDataFrame([("a",)], "url string"), links, 9).collect()}
    assert got == {"a": 1, "b": 1, "c": -1}


def test_charset(spark):
    rows = spark.createDataFrame([("fr", "привет мир")], "lang string, text string")
    assert charset.foreign(rows).first().detected_lang == "ru"


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"a": 1}\nbroken\n{"a": 2}\n')
    good, bad = readers.jsonl_tolerant(spark, str(tmp_path / "in"), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and [r.value for r in bad.collect()] == ["broken"]
    (tmp_path / "r/rec1").mkdir(parents=True)
    (tmp_path / "r/rec1/EN-x.txt").write_text("hello")
    (tmp_path / "r/rec1/FR-x.txt").write_text("bonjour")
    assert tuple(readers.language_folders(spark, str(tmp_path / "r"), ["en", "fr", "de"]).first()) == ("rec1", "hello", "bonjour", "")
    df = spark.createDataFrame([("f", 2, "b"), ("f", 1, "a")], "g string, i int, t string")
    writers.jsonl_sorted_keys(df, str(tmp_path / "out"), "g", "i")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text == '{"g":"f","i":1,"t":"a"}\n{"g":"f","i":2,"t":"b"}\n'
    writers.csv(spark.createDataFrame([('say "x"', "1\n2")], "a string, b string"), str(tmp_path / "c"))
    assert tuple(readers.csv(spark, str(tmp_path / "c")).first()) == ('say "x"', "1\n2")


def test_source_of_rows(spark):
    spark.dataSource.register(readers.RowsSource)
    got = spark.read.format("polyweave_rows").option("rows", 7).option("partitions", 3).load()
    assert sorted(r.row_id for r in got.collect()) == list(range(7))


def test_html_and_sitemaps(spark):
    assert readers.select_text('<div class="a b">x<br>y<p>z</p></div><div>n</div>', ".a") == "x\nyz"
    files = spark.createDataFrame([("p", b"<urlset><url><loc>u1</loc></url><url><loc>u2</loc></url></urlset>")], "path string, content binary")
    assert [r.url for r in readers.sitemaps(files).collect()] == ["u1", "u2"]


def test_dates(spark):
    d = spark.createDataFrame([(datetime.date(2024, 1, 3), datetime.date(2024, 1, 17))], "a date, b date")
    assert [(str(r.week_start), str(r.week_end)) for r in readers.week_ranges(d, "a", "b").orderBy("week_start").collect()] == [("2024-01-03", "2024-01-07"), ("2024-01-08", "2024-01-14"), ("2024-01-15", "2024-01-17")]
    assert readers.seven_day_buckets(d, "a", "b").count() == 2


def test_streams(spark, sf, tmp_path):
    from polyweave.streaming import events as E

    (tmp_path / "in").mkdir()
    (tmp_path / "in/events.parquet").symlink_to(f"{sf}/events.parquet")
    counts = E.tumbling(E.read(spark, str(tmp_path / "in")), late="0 seconds")
    q = counts.writeStream.format("memory").queryName("tumbling").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("tumbling").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{sf}/events.parquet").count()
