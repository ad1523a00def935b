"""The library's queries without SQL against brute force, hostile rows of the operators, and round trips of files and streams."""

import collections
import difflib
import itertools
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from polyweave.operators import align, blocks, detectors, frontier, joiners, lines, records, relations
from polyweave.plans import catalogue, library
from polyweave.sources import readers, writers
from polyweave.streaming import events as E

DOCS = ["One two three. Four\nfive six seven eight nine ten eleven twelve thirteen\n\nend", "", "single", "a b\n" * 40, "1. First part\nSecond line of it is long enough\n\nThird. Yes\nno"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("made"))
    spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(DOCS)], "doc_id bigint, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return folder


def rows(spark, made, name):
    return catalogue.QUERIES[name](spark, made).collect()


def brute_flags(true, pred, margin):
    matched, used, drift = [False] * len(true), [False] * len(pred), 0
    for j, p in enumerate(pred):
        near = [(abs(t - p - drift), t, i) for i, t in enumerate(true) if abs(t - p - drift) <= margin]
        if near:
            _, t, i = min(near)
            matched[i] = used[j] = True
            drift = t - p
    return matched, used


def test_near_match_flags(spark, made):
    df = spark.createDataFrame([([1, 100, 200, 300, 400, 500], [101, 301, 402])], "t array<int>, p array<int>")
    got = df.select(lines.near_match_flags(F.col("t"), F.col("p"), 5).alias("m")).first().m
    assert (got.is_match_true, got.is_match_pred) == ([False, True, False, True, True, False], [True, True, True])
    for r in rows(spark, made, "near_break_flags"):
        assert (r.is_match_true, r.is_match_pred) == brute_flags(r.true, r.pred, 5)


def wrapped_lines(spark, made):
    return {r.doc_id: (r.lines, r.hard) for r in catalogue.wrapped(spark, made).collect()}


def test_token_batches(spark, made):
    given, got = wrapped_lines(spark, made), {}
    for r in rows(spark, made, "token_batches"):
        got.setdefault(r.doc_id, []).append((r.batch, r["first"], r["last"], r.tokens, r.skipped))
    for i, (ls, _) in given.items():
        want, at = [], 0
        while at < len(ls):
            end = at
            while end + 1 < len(ls) and len(" ".join(ls[at : end + 2]).split()) < 64:
                end += 1
            n = len(" ".join(ls[at : end + 1]).split())
            want.append((len(want), at, end, n, end + 1 == len(ls) and n < 20))
            at = end + 1
        assert sorted(got[i]) == want


def test_joined_paragraphs_chunks_and_titles(spark, made):
    given = wrapped_lines(spark, made)
    assert {r.doc_id: r.lines for r in rows(spark, made, "joined_paragraphs")} == {i: joiners.join_lines(ls) for i, (ls, _) in given.items()}
    for r in rows(spark, made, "model_chunks"):
        assert " ".join(r.lines) == " ".join(DOCS[r.doc_id].split()) and all(sum(-(-len(w) // 3) for w in c.split()) <= 64 for c in r.lines)
    with pytest.raises(ValueError):
        joiners.back_off_chunks(["abc"], len, 2)
    for r in rows(spark, made, "contents_titles"):
        long = [x for x in DOCS[r.doc_id].split("\n") if len(x) > 8]
        titles = [f"{i + 1}. {x[:30]}".strip() for i, x in enumerate(long[:6])] if len(long[:6]) >= 4 else []
        assert r.titles == titles and sum(x.startswith("\n====") for x in r.lines) == len(titles)


def test_titles_are_marked_as_often_as_they_occur():
    found = joiners.mark_titles(["x", "Programme of", "works", "y", "Programme of work"], ["Programme of work"])
    assert found == ["x", "\n====Programme of work====\n", "y", "\n====Programme of work====\n"]
    assert joiners.join_lines(["goes", "on", "", "Next"], keep_blank=True) == ["goes on", "", "Next"]


def test_interval_alignment(spark, made):
    given = wrapped_lines(spark, made)
    for r in rows(spark, made, "interval_alignment"):
        ls, hard = given[r.doc_id]
        groups, at = [], 0
        for i in range(len(ls)):
            if i == len(ls) - 1 or hard[i]:
                groups.append((at, i))
                at = i + 1
        assert r.aligned == [f"{j}:{a},{b}" for j, (a, b) in enumerate(groups)] and r.dropped == []
        assert [p.other for p in r.pairs] == [" ".join(ls[a : b + 1]) for a, b in groups]
    aligned, dropped, view, pairs = align.interval_view(["one two", "three", "zzz", "four five"], ["one two three", "qqq", "four five"], ["A", "B", "C"], glue=" ")
    assert (aligned, dropped, pairs) == (["0:0,1", "2:3,3"], ["0:1", "1:2"], [("A", "one two three"), ("C", "four five")]) and "zzz" in view and "B" in view


def earliest_subsequence(a, b):
    """By the rule as it is stated: the shortest beginning of a that holds a common subsequence of each length, by rows of b."""
    ends, tails = [], []
    for j, y in enumerate(b):
        for i in reversed([i for i, x in enumerate(a) if x == y]):
            k = sum(e < i for e in ends)
            node = (i, j, tails[k - 1] if k else None)
            if k == len(ends):
                ends.append(i)
                tails.append(node)
            elif i < ends[k]:
                ends[k], tails[k] = i, node
    out, node = [], tails[-1] if tails else None
    while node:
        out.append(node[:2])
        node = node[2]
    return out[::-1]


def test_subsequence_is_the_earliest():
    rng = random.Random(8)
    for n in [8] * 300 + [150] * 20:
        a, b = [[rng.choice("abcdefgh"[: rng.randrange(1, 9)]) for _ in range(rng.randrange(0, n))] for _ in range(2)]
        assert align.common_subsequence(a, b) == earliest_subsequence(a, b)
    words = [f"w{rng.randrange(900)}" for _ in range(20_000)]
    other = [w for w in words if rng.random() > 0.05]
    began = time.process_time()
    assert len(align.common_subsequence(["x", *words], other)) == len(other) and time.process_time() - began < 20


def groups_of(ls, hard):
    ends = [i for i in range(len(ls)) if i == len(ls) - 1 or hard[i]]
    return [list(range(a + 1, b + 1)) for a, b in zip([-1, *ends], ends)]


def test_alignment_queries(spark, made):
    given, got = wrapped_lines(spark, made), {}
    for r in rows(spark, made, "align_n_to_m"):
        got.setdefault(r.doc_id, []).append((r.clean_para_index_set_pair, r.src_text, r.dst_text))
        assert r.src_rate > 0.99 and r.dst_rate > 0.99
    for i, (ls, hard) in given.items():
        lines_ = [x for x in DOCS[i].split("\n") if x.strip()]
        assert sorted(got[i]) == sorted((f"{k}|{','.join(map(str, g))}", lines_[k], "\n".join(ls[j] for j in g)) for k, g in enumerate(groups_of(ls, hard)))
    assert all((r.source_unmatched, r.target_unmatched) == ([], []) for r in rows(spark, made, "unmatched_paragraphs"))


def test_batches_and_matches(spark, made):
    given, got = wrapped_lines(spark, made), {}
    for r in rows(spark, made, "greedy_batches"):
        got.setdefault(r.doc_id, {})[r.batch] = r.members
    for i, (ls, _) in given.items():
        out, open_, load = [], [], 0.0
        for k, x in enumerate(ls):
            w = len(x.split()) * (100 / 75)
            if load + w > 200:
                if open_:
                    out.append([*open_, k])
                open_, load = [k], w
            else:
                open_, load = [*open_, k], load + w
        assert list(got[i].values()) == out + ([open_] if open_ else [])
    for r in rows(spark, made, "near_break_match"):
        true, drift, want = [i for i, h in enumerate(given[r.doc_id][1]) if h], 0, []
        for p in (t + 1 for t in true):
            near = [(abs(t - p - drift), t) for t in true if abs(t - p - drift) <= 5]
            want.append(min(near)[1] if near else None)
            drift = want[-1] - p if near else drift
        assert r.matched == want


def brute_headers(documents):
    """The rule of header removal over documents by record: doc to its pages' texts."""
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b, autojunk=False).ratio()
    frequent = lambda n, pages: pages >= 3 and n >= pages - 1 or pages >= 5 and n > 0.666 * pages
    out = {}
    for record in {i // 4 for i in documents}:
        own = {i: p for i, p in documents.items() if i // 4 == record}
        tokens = {i: collections.Counter(t for p in pages for t in p[:100].split()) for i, pages in own.items()}
        total, count = sum(tokens.values(), collections.Counter()), sum(map(len, own.values()))
        everywhere = {t for t, n in total.items() if n > count // 2 and n > 1}
        for i, pages in own.items():
            n = len(pages)
            noisy = everywhere | {t for t, c in tokens[i].items() if 3 <= c <= n and frequent(c, n)}
            digests = collections.Counter(d for p in pages for x in p[:100].split("\n") if (d := "".join(x.split())))
            similar = {d: sum(c for e, c in digests.items() if ratio(d, e) > 0.72) for d in digests}
            offsets = collections.Counter(o for k, p in enumerate(pages) for o in {int(x) - k for x in re.findall(r"\d+", p[:100]) if str(int(x)) == x} if -9 <= o <= 2)
            best = min(offsets, key=lambda o: (-offsets[o], o), default=None)
            offset = best if best is not None and offsets[best] >= n // 2 else None
            for k, p in enumerate(pages):
                kept = []
                for x in p[:100].split("\n"):
                    d = "".join(x.split())
                    if d and frequent(similar[d], n):
                        continue
                    good = lambda t: t not in noisy and not (offset is not None and re.match(r"^\d+(?:$|/\d+)", t) and str(k + offset) in re.findall(r"\d+", t))  # noqa: B023, E731
                    kept.append(" ".join(itertools.dropwhile(lambda t: not good(t), x.split())))
                gap = " " if re.search(r"[^\S\n]\Z", p[:100]) else ""
                out[i, k] = ("\n".join(kept) + gap + p[100:]).split("__________")[0].strip()
    return out


def test_header_removal_query(spark, made):
    pages = {}
    for r in catalogue.pages_of(spark, made).orderBy("page_id").collect():
        pages.setdefault(r.doc_id, []).append(r.page)
    assert {(r.doc_id, r.page_id): r.page for r in rows(spark, made, "header_removal")} == brute_headers(pages)


def test_rule_based_query(spark, made):
    def score(a, b):
        if not a.strip() or not b.strip():
            return 1
        if re.match(r"^\d{1,3}\. ", b.strip()):
            return -1
        simple = (-44 if a[-1] in ".?!;" else 81 if a[-1] == "," else 0) + min(60, len(a)) - 32 + (83 if b[0].islower() else 0)
        found = detectors.split_sentences(f"{a[-100:]} {b[:100]}")
        if len(found) <= 1:
            return simple + 200
        return simple - int((max(difflib.SequenceMatcher(lambda c: c == " ", s, b[:100]).ratio() for s in found) - 0.6) * 666.7)

    given = {i: x for i, x in wrapped_lines(spark, made).items() if len(x[0]) > 1}
    got = {r.doc_id: (r.TP, r.FN, r.FP, r.TN) for r in rows(spark, made, "rule_based_breaks")}
    assert set(got) == set(given)
    for i, (ls, hard) in given.items():
        found = [score(a, b) <= 0 for a, b in itertools.pairwise(ls)]
        assert got[i] == tuple(sum(t == x and f == y for t, f in zip(hard, found)) for x, y in ((True, True), (True, False), (False, True), (False, False)))


def test_asking_again():
    told = []

    def complete(text):
        told.append(text)
        if len(told) < 3:
            raise detectors.AnswerError("busy")
        return "" if len(told) == 3 else text.upper()

    ask = detectors.asked(complete, 5, lambda text, answer: bool(answer))
    assert ask("a") == "A" and ask("a") == "A" and len(told) == 4
    with pytest.raises(detectors.NoAnswer):
        detectors.asked(lambda text: "", 2, lambda text, answer: bool(answer))("a")
    with pytest.raises(ZeroDivisionError):
        detectors.asked(lambda text: 1 / 0, 2)("a")


def test_language_blocks_by_reachability(spark, made):
    got = {}
    for r in rows(spark, made, "language_blocks"):
        got.setdefault(r.record, []).append((r["行号"], r.en_text, r.fr_text, r.de_text))
    number, want = 0, {}
    for record, text in enumerate(DOCS):
        ls = text.split("\n")
        near = {}
        for i in range(len(ls)):
            for node, pivot in (((("fr", i)), ("en", i // 2)), ((("de", i)), ("en", i // 3))):
                near.setdefault(node, set()).add(pivot)
                near.setdefault(pivot, set()).add(node)
        seen, own = set(), []
        for start in near:
            if start in seen:
                continue
            todo, group = [start], {start}
            while todo:
                for x in near[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            seen |= group
            own.append(tuple("\n\n".join(ls[i] for k, i in sorted(group) if k == lang) for lang in ("en", "fr", "de")))
        want[record] = own
        number += len(own)
    assert {k: sorted(x[1:] for x in v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert sorted(x[0] for v in got.values() for x in v) == list(range(number))


def test_null_contents_and_file_names_stay(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "id int, content string")
    assert sorted((r.id, r.is_duplicate) for r in frontier.content_marks(df).collect()) == [(1, 0), (2, 0), (3, 1), (4, 1)]
    assert frontier.content_marks(df.limit(0)).count() == 0
    given = spark.createDataFrame([(None, 0, 0, "甲", "a"), (None, 0, 1, "甲", "b"), ("f", 1, 0, "甲", "a")], "`文件名` string, doc_id bigint, line_id bigint, zh_text string, en_text string").withColumns({"扩展字段": F.lit("{}"), "时间": F.lit("")})
    got = records.normalise(given, ["zh_text", "en_text"], ["doc_id", "line_id"], F.col("doc_id")).collect()
    assert sorted((r["文件名"], r["行号"], r["是否重复"]) for r in got) == [("", 1, False), ("", 2, True), ("f", 1, False)]
    numbered = records.numbered(spark.createDataFrame([(None, 1), (None, 2), ("k", 5)], "k string, i int"), "k", ["i"], F.floor(F.col("i") / 2), "n")
    assert sorted((r.k or "", r.i, r.n) for r in numbered.collect()) == [("", 1, 1), ("", 2, 2), ("k", 5, 1)]


def test_extension_fields(spark):
    one = lambda x, column: spark.createDataFrame([(x,)], "x string").select(column(F.col("x")).alias("y")).first().y
    for x, y in ((None, "{}"), ("", "{}"), ('{"b": 1, "a": [1, 2]}', '{"a":[1,2],"b":1}'), ('{"a": ', None)):
        assert one(x, records.canonical_extension) == y
    for x, y in (('"a": 1}', '{"a":1}'), ('{"a": 1}', '{"a":1}'), ("nothing", None), (None, None)):
        assert one(x, records.salvaged_json) == y
    p = "array<struct<`行号`:bigint,en_text:string,other1_text:string,`拓展字段`:string,`是否重复`:boolean,`备注`:string>>"
    files = spark.createDataFrame([("f", "2024", [(1, "a", "", '{"k": 1}', True, "n"), (2, "b", "x", "broken", None, None)]), ("g", None, [])], f"`文件名` string, `时间` string, `段落` {p}")
    got = records.explode_legacy(files).orderBy("pos").collect()
    assert [(r["行号"], r["是否重复"], r["扩展字段"], r["时间"], r.en_text) for r in got] == [(1, True, '{"k":1}', "2024", "a"), (2, None, None, "2024", "b")] and "备注" not in got[0]
    assert sorted((r.pos, r.reason) for r in records.rejected_paragraphs(files).collect()) == [(1, "broken extension"), (1, "other1_text is not empty")]
    with pytest.raises(ValueError, match="zh_text_md5"):
        records.fixed_fields(files)


def test_relations_of_odd_rows(spark):
    a = spark.createDataFrame([(1, "a"), (None, "n"), (2, "b"), (2, "b")], "k int, v string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "k int, l int")
    with pytest.raises(Exception, match="no label for"):
        relations.with_labels(a.union(spark.createDataFrame([(3, "c")], a.schema)), labels, "k").collect()
    assert sorted((r.k, r.l) for r in relations.with_labels(a.where("k is not null"), labels, "k").collect()) == [(1, 1), (2, 0), (2, 0)]
    assert relations.already_done(a, [labels, labels], "k").count() == 3 and relations.last_wins(a, "k", "v").count() == 3
    assert relations.difference(a.limit(0), labels, "k").count() == 2 and relations.with_all(spark.createDataFrame([("a", None), ("a", "b"), ("", "c")], "x string, y string"), "x", "y").count() == 1
    assert blocks.components(spark.createDataFrame([], "record bigint, u string, v string")).count() == 0


def test_files(spark, tmp_path):
    put = lambda name, text: ((tmp_path / name).parent.mkdir(parents=True, exist_ok=True), (tmp_path / name).write_text(text))
    put("strict/a.jsonl", '{"文件名": "f", "行号": 3, "zh_text": "甲"}\n')
    assert readers.jsonl(spark, str(tmp_path / "strict")).first()["行号"] == 3
    put("strict/b.jsonl", "broken\n")
    with pytest.raises(Exception):
        readers.jsonl(spark, str(tmp_path / "strict")).collect()
    put("arrays/x/a.json", '[{"a": 1}, {"a": 2}]')
    put("arrays/b.json", '[{"a": ')
    put("arrays/c.json", '{"a": 1}')
    good, bad = readers.json_arrays(spark, str(tmp_path / "arrays"), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2] and sorted(r.file[-6:] for r in bad.collect()) == ["b.json", "c.json"]
    put("results/r.txt", "id1,fr,https://h/a,b\nnoise\nid2\n")
    assert [tuple(r) for r in readers.comma_lines(spark, str(tmp_path / "results"), "id", ["id", "lang", "url"]).orderBy("id").collect()] == [("id1", "fr", "https://h/a,b"), ("id2", None, None)]
    put("texts/t.txt", "one\n\nthree")
    assert [(r.line_id, r.line) for r in readers.lines(spark, str(tmp_path / "texts")).orderBy("line_id").collect()] == [(0, "one"), (1, ""), (2, "three")]
    states = spark.createDataFrame([("u\t1", 0), ("v", -1)], "url string, status int")
    writers.states(states, str(tmp_path / "states"))
    assert sorted(map(tuple, readers.states(spark, str(tmp_path / "states")).collect())) == [("u\t1", 0), ("v", -1)]
    df = spark.createDataFrame([("en", "a b", None), ("fr", "c", 1)], "lang string, text string, n int")
    writers.text_by(df, str(tmp_path / "by"), "lang", F.upper("text"))
    assert (tmp_path / "by/lang=en").exists() and sorted(r.value for r in spark.read.text(str(tmp_path / "by")).collect()) == ["A B", "C"]
    writers.json_by(df, str(tmp_path / "jby"), "lang")
    assert spark.read.json(str(tmp_path / "jby")).where("lang = 'fr'").first().n == 1
    writers.jsonl_append(df, str(tmp_path / "app"))
    writers.jsonl_append(df, str(tmp_path / "app"))
    text = "".join(p.read_text() for p in (tmp_path / "app").glob("part-*"))
    assert len(text.splitlines()) == 4 and json.loads(text.splitlines()[0]).keys() == {"lang", "text", "n"}
    assert writers.missing(df, df.where("lang = 'en'"), "lang").first().lang == "fr"
    pages = spark.createDataFrame([(1, '<div id="m">x<br>y</div>'), (2, None)], "k int, html string")
    assert {r.k: r.text for r in readers.page_text(pages, "k", "html", "#m").collect()} == {1: "x\ny", 2: ""}


def test_generators_are_sources(spark):
    spark.dataSource.register(readers.GeneratorSource)
    made = spark.read.format("polyweave_generator").option("generator", "polyweave.sources.readers:numbered_rows").option("rows", 5).option("partitions", 3).load()
    assert sorted(map(tuple, made.collect())) == [(i, f"row {i}") for i in range(5)]


def test_event_streams(spark, sf, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/events.parquet").symlink_to(f"{sf}/events.parquet")
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    stream = E.read(spark, str(tmp_path / "in"))
    E.start_files(E.distinct_events(stream).select("event_id", "user_id"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == n
    E.start_files(E.distinct_events(stream).select("event_id", "user_id"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == n  # the checkpoint knows what is done
    for name, made in (("sliding", E.sliding(stream)), ("sessions", E.sessions(stream))):
        made.writeStream.format("memory").queryName(name).outputMode("complete" if name == "sliding" else "append").trigger(availableNow=True).start().awaitTermination(120)
    batch = {(r.window_start, r.n) for r in E.sliding(library._events(spark, sf)).collect()}
    assert {(r.window_start, r.n) for r in spark.table("sliding").collect()} == batch
    whole = {(r.user_id, r.session_start, r.n) for r in E.sessions(library._events(spark, sf)).collect()}
    ended = {(r.user_id, r.session_start, r.n) for r in spark.table("sessions").collect()}
    assert ended <= whole  # sessions that the watermark hasn't passed are still open


def test_numbers_with_leading_zeros_are_no_page_numbers(spark):
    from polyweave.operators import headers

    pages = spark.createDataFrame([(1, i, f"00{i + 2} text") for i in range(5)] + [(2, i, f"{i + 2} text") for i in range(5)], "doc int, page_id int, page string")
    assert {r.doc: r.offset for r in headers.page_offset(pages, ["doc"]).collect()} == {1: None, 2: 2}
