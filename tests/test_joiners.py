from collections import Counter
from itertools import pairwise

from pyspark.sql import functions as F

from polyweave.operators import joiners, relations
from polyweave.plans import catalogue


def test_join_lines():
    assert joiners.join_lines(["Everything seemed to be", "alright.", "", "1. Next item is", "short,", "and ends."]) == ["Everything seemed to be alright.", "1. Next item is short, and ends."]


def test_mark_titles():
    assert joiners.mark_titles(["x", "Programme of", "works", "y"], ["Programme of work"]) == ["x", "\n====Programme of work====\n", "y"]


def test_chinese():
    assert joiners.merge_chinese_lines([["我", "们"], ["来"], ["一、", "生火"]], {("们", "来"): 2, ("来", "一、"): 1}) == ["我们来", "一、生火"]
    assert joiners.merge_chinese_segments(["我", "来", "abc", "生"]) == ["我来", "abc", "生"]


def test_word_pairs_count_from_the_first(spark, tmp_path):
    texts = ["A b a b c", "single", "", "c a b", "x  y"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    brute = Counter(p for t in texts for p in pairwise(t.lower().split(" ")))
    assert {(r.prev, r.word): r.n for r in catalogue.QUERIES["all_word_pairs"](spark, str(tmp_path)).collect()} == brute
    assert brute["a", "b"] == 3 and brute["c", "a"] == 1


def test_info_pages(spark):
    text = "United Nations\nNew York\nCorrections will be issued after the end of the session in a consolidated corrigendum.\nText"
    assert spark.createDataFrame([(text,)], "x string").select(joiners.without_info_pages(F.col("x")).alias("y")).first().y == "\nText"


def test_relations(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    b = spark.createDataFrame([(2, "B"), (4, "D")], "k int, v string")
    assert sorted((r.k, r.side) for r in relations.difference(a, b, "k").collect()) == [(1, "+"), (3, "+"), (4, "-")]
    assert sorted((r.k, r.v) for r in relations.reworked(a, b, a.where("k = 3"), ["k"], "v").collect()) == [(1, "a"), (2, "B")]
    log = spark.createDataFrame([("r", [3, 1], 4), ("r", [1, 7], 9)], "record string, br array<int>, r int")
    assert relations.folded_breaks(log).first().br == [1, 3, 7] and relations.resume_at(log).first().next == 10
    pages = spark.createDataFrame([("w", 1, 20, 45), ("w", 2, 20, 45), ("z", 1, 5, 5)], "w string, page int, rows int, total int")
    assert [tuple(r) for r in relations.unfinished(pages, "w", "total").collect()] == [("w", 3)]
    assert relations.already_done(a, [b, a.where("k = 1")], "k").count() == 2
    lines = spark.createDataFrame([(1, ["abc", "中"])], "k int, x array<string>")
    assert relations.translated(lines, "k", "x", lambda xs: [x.upper() for x in xs]).first().x == ["ABC", "中"]


def test_whole_tables_are_inverted_and_compared(spark, tmp_path):
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    put("documents", [(i,) for i in (0, 1, 2, 3, 6)], "doc_id bigint")
    put("labels", [(i,) for i in (1, 3, 4, 9)], "doc_id bigint")
    put("customer", [(1, 7), (2, 7), (3, 8)], "c_custkey bigint, c_nationkey bigint")
    put("nation", [(7, "x"), (8, "y")], "n_nationkey bigint, n_name string")
    got = sorted((r.doc_id, r.side) for r in catalogue.QUERIES["document_label_difference"](spark, str(tmp_path)).collect())
    assert got == [(0, "+"), (2, "+"), (4, "-"), (6, "+"), (9, "-")]
    got = sorted((r.value, r.name, r.key) for r in catalogue.QUERIES["all_inverted_maps"](spark, str(tmp_path)).collect())
    assert got == [(i, n, k) for i, k in ((1, "x"), (2, "x"), (3, "y")) for n in "cd"]
