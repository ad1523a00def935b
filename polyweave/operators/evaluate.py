"""Scores of break detectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let


def confusion(df: DataFrame, key: str, truth: str, predicted: str) -> DataFrame:
    """Four counts and the accuracy for each row; both arrays are cut to the shorter."""
    n = F.least(F.size(truth), F.size(predicted))
    both = F.arrays_zip(F.slice(truth, 1, n).alias("t"), F.slice(predicted, 1, n).alias("p"))
    count = lambda z, t, p: F.size(F.filter(z, lambda x: (x["t"] == t) & (x["p"] == p))).cast("long")
    cells = (("TP", True, True), ("FN", True, False), ("FP", False, True), ("TN", False, False))
    out = df.select(key, let(both, lambda z: F.struct(*[count(z, t, p).alias(name) for name, t, p in cells])).alias("c")).select(key, "c.*")
    return out.withColumn("accuracy", (F.col("TP") + F.col("TN")) / F.greatest(F.expr("TP + FN + FP + TN"), F.lit(1)))


def report(confusions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes, their plain and weighted means, and the accuracy, from micro totals."""
    t = confusions.agg(*[F.sum(c).alias(c) for c in ("TP", "FN", "FP", "TN")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def of(name: str, hit: str, missed: str, wrong: str) -> Column:
        p, r = ratio(F.col(hit), F.col(hit) + F.col(wrong)), ratio(F.col(hit), F.col(hit) + F.col(missed))
        return F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"), (F.col(hit) + F.col(missed)).cast("double").alias("support"))

    classes = t.select("*", of("hard", "TP", "FN", "FP").alias("h"), of("soft", "TN", "FP", "FN").alias("s"))
    n = F.col("h.support") + F.col("s.support")
    mean = lambda name, wh, ws: F.struct(F.lit(name).alias("label"), *[(F.col(f"h.{c}") * wh + F.col(f"s.{c}") * ws).alias(c) for c in ("precision", "recall", "f1")], n.alias("support"))
    right = ratio(F.col("TP") + F.col("TN"), n)
    accuracy = F.struct(F.lit("accuracy").alias("label"), *[right.alias(c) for c in ("precision", "recall", "f1")], n.alias("support"))
    rows = F.array("h", "s", mean("macro avg", F.lit(0.5), F.lit(0.5)), mean("weighted avg", ratio(F.col("h.support"), n), ratio(F.col("s.support"), n)), accuracy)
    return classes.select(F.inline(rows))


def histogram(scores: DataFrame, score: str, buckets: int = 10) -> DataFrame:
    """bucket (from 0), n: scores from 0 to 1 in so many equal buckets, 1 in the last; nulls aside."""
    bucket = F.least(F.floor(F.col(score) * buckets), F.lit(buckets - 1)).cast("int")
    return scores.where(F.col(score).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def error_view(lines: Column, truth: Column, predicted: Column) -> Column:
    """HTML in which the last word before each hard break is green (found), red (missed) or blue (wrong)."""
    def one(line: Column, i: Column) -> Column:
        t, p = F.coalesce(F.get(truth, i), F.lit(False)), F.coalesce(F.get(predicted, i), F.lit(False))
        colour = F.when(t & p, "green").when(t, "red").when(p, "blue")
        head, last = F.regexp_extract(line, r"(?s)^(.*?)(\S*)$", 1), F.regexp_extract(line, r"(?s)^(.*?)(\S*)$", 2)
        return F.when(colour.isNull(), line).otherwise(F.concat(head, F.lit('<span style="color:'), colour, F.lit('">'), last, F.lit("</span>")))

    return F.array_join(F.transform(lines, one), "<br>")


def band_best(left: DataFrame, right: DataFrame, key: str, reach: int = 5, itself: bool = True) -> DataFrame:
    """For each left row (key, i, tokens) the right row with i - reach <= k < i + reach of highest Jaccard similarity; ties go to the smallest k.

    itself: the row at the same position is a candidate too.

    An equi-join on stretches of 2 * reach positions, of which each left row looks at two or three, keeps the band join linear.
    """
    width = 2 * reach
    stretch = F.explode(F.sequence(F.floor((F.col("i") - reach) / width), F.floor((F.col("i") + reach - 1) / width)))
    a = left.select(key, "i", F.col("tokens").alias("a"), stretch.alias("s"))
    b = right.select(key, F.col("i").alias("k"), F.col("tokens").alias("b"), F.floor(F.col("i") / width).alias("s"))
    both = F.size(F.array_union("a", "b"))
    score = F.when(both > 0, F.size(F.array_intersect("a", "b")) / both).otherwise(F.lit(0.0))
    near = a.join(b, [key, "s"]).where(F.col("k").between(F.col("i") - reach, F.col("i") + reach - 1) & (F.lit(itself) | (F.col("k") != F.col("i"))))
    return near.groupBy(key, "i").agg(F.max(F.struct(score.alias("score"), (-F.col("k")).alias("k"))).alias("best")).select(key, "i", (-F.col("best.k")).alias("k"), "best.score")
