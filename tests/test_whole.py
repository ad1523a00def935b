"""Whole jobs of the catalogue on small fixtures, against brute force."""

from polyweave.functions import numerals
from polyweave.operators import align, frontier
from polyweave.plans import catalogue


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_crawl_goes_on_until_nothing_is_new(spark, tmp_path):
    put(spark, tmp_path, "pages", [(i,) for i in range(100)], "page_id bigint")
    got = {r.url: r.status for r in catalogue.QUERIES["whole_crawl"](spark, str(tmp_path)).collect()}
    assert got == {f"p{i}": 1 if i < 100 else -1 for i in range(201)}
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(7)] + [("6", "2")], "url string, target string")
    assert {r.url: r.status for r in frontier.crawl(spark.createDataFrame([("0",)], "url string"), chain).collect()} == {str(i): 1 if i < 7 else -1 for i in range(8)}


def test_list_runs_behind_line_sixty(spark, tmp_path):
    put(spark, tmp_path, "documents", [(1, "\n".join("abc" for _ in range(200)))], "doc_id bigint, text string")
    got = sorted(r.line_id for r in catalogue.QUERIES["all_list_marker_runs"](spark, str(tmp_path)).collect())
    assert got == [j for i in range(3, 200, 3) if i // 3 % 5 for j in range(i - 3, i - 1)]


def test_six_links_over_gaps_and_boundaries(spark, tmp_path):
    ids = [i * 100 for i in range(200)] + [30_000 + i for i in range(9_000)] + [4096 * 20 - 2, 4096 * 20 - 1, *range(4096 * 20 + 64, 4096 * 20 + 74)]
    rows = [(i, f"https://h/{'xx' if k % 11 == 5 else 'en'}/{i}") for k, i in enumerate(ids)]
    put(spark, tmp_path, "pages", rows, "page_id bigint, url string")
    brute = {rows[k][0]: [u for _, u in rows[k : k + 6]] for k in range(len(rows) - 5) if all("/en/" in u for _, u in rows[k : k + 6])}
    got = catalogue.QUERIES["six_link_window"](spark, str(tmp_path)).collect()
    assert {r.page_id: r.urls for r in got} == brute and len(got) == len(brute)


def test_unmatched_lines_of_both_sides(spark):
    rows = [(1, ["one two three", "zzz", "four five"], ["one two", "three", "qqq www", "four five"]), (2, ["a b"], ["c d"]), (3, [], ["x"])]
    df = spark.createDataFrame(rows, "k bigint, s array<string>, t array<string>")
    aligned = align.align_rows(df, "k", "s", "t")
    held = {}
    for r in aligned.collect():
        for side, part in enumerate(r.clean_para_index_set_pair.split("|")):
            held.setdefault((r.k, side), []).extend(map(int, part.split(",")))
    brute = {k: tuple(align.unmatched(len(x), held.get((k, i), [])) for i, x in enumerate((s, t))) for k, s, t in rows}
    got = {r.k: (r.source_unmatched, r.target_unmatched) for r in align.unmatched_rows(df, aligned, "k", "s", "t").collect()}
    assert got == brute == {1: ([1], [2]), 2: ([0], [0]), 3: ([], [0])}


def brute_roman(text):
    total = last = 0
    for v in (numerals.ROMAN[c] for c in reversed(text) if c in numerals.ROMAN):
        total += -v if v < last else v
        last = v
    return total


def test_numerals_of_lines(spark, tmp_path):
    put(spark, tmp_path, "documents", [(1, "XIV. Item\n\nMCMXCIV"), (2, "二十一、甲\n三百零四")], "doc_id bigint, text string")
    got = {(r.doc_id, r.line_id): (r.roman, r.chinese) for r in catalogue.QUERIES["line_numerals"](spark, str(tmp_path)).collect()}
    assert got == {(1, 0): (brute_roman("XIV. Item"), 0), (1, 1): (0, 0), (1, 2): (1994, 0), (2, 0): (0, 21), (2, 1): (0, 304)}
