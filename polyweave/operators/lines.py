"""Documents as lines, and line breaks as flags."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.numerals import marker
from ..functions.text import positions_of, py_split


def to_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line_id (from 0), line, by line feeds only."""
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_id", "line"))


def rewrap(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines cut after so many words: key, lines, and hard (for each break but the last: was it there before).

    Breaks with a known truth, for measuring detectors.
    """
    of_line = lambda x: F.filter(F.split(x, r"[ \t\x0b\f\r]+"), lambda w: w != "")
    starts = lambda ws: F.sequence(F.lit(0), F.greatest((F.size(ws) - 1) / words, F.lit(0)).cast("int"))
    cut = lambda ws: F.transform(starts(ws), lambda i: F.array_join(F.slice(ws, i * words + 1, words), " "))
    tag = lambda p: F.transform(p, lambda x, i: F.struct(x.alias("line"), (i == F.size(p) - 1).alias("hard")))
    pieces = F.flatten(F.transform(F.filter(F.transform(F.split(text, "\n"), of_line), lambda ws: F.size(ws) > 0), lambda ws: let(cut(ws), tag)))
    both = let(pieces, lambda t: F.struct(F.transform(t, lambda x: x["line"]).alias("lines"), F.transform(F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))), lambda x: x["hard"]).alias("hard")))
    return docs.select(key, both.alias("b")).select(key, "b.lines", "b.hard").where("size(lines) > 0")


def in_document(key: str) -> Window:
    return Window.partitionBy(key).orderBy("line_id")


def dash_flag(line: Column, following: Column) -> Column:
    """A break is hard before a line that starts with an en dash."""
    return following.startswith("–")


def punctuation_flag(line: Column, following: Column) -> Column:
    """A break is hard after a full stop or semicolon, and before a capital or an en dash."""
    return line.endswith(".") | line.endswith(";") | following.rlike(r"^\p{IsUppercase}") | following.startswith("–")


def simple_score(line: Column, following: Column) -> Column:
    """How likely the next line goes on: sentence marks, commas, length, small letters."""
    return (
        F.when(line.rlike(r"[.?!;]$"), -44).when(line.endswith(","), 81).otherwise(0)
        + F.least(F.lit(60), F.length(line)) - 32 + F.when(following.rlike(r"^\p{IsLowercase}"), 83).otherwise(0)
    )


def pairs(lines: Column, body) -> Column:
    """body(line, next line) for each break of an array of lines."""
    return let(lines, lambda ls: F.transform(F.slice(ls, 1, F.greatest(F.size(ls) - 1, F.lit(0))), lambda x, i: body(x, F.get(ls, i + 1))))


def list_runs(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """Soft breaks inside list items: between two markers of one rule whose counters follow, all breaks but the last. Returns key, line_id of the break."""
    marked = lines.withColumn("m", marker(F.col("line"))).where("m is not null").select(key, "line_id", "m.rule", "m.counter")
    w = in_document(key)
    runs = marked.withColumns({"from": F.lag("line_id").over(w), "before": F.lag("rule").over(w), "number": F.lag("counter").over(w)})
    follows = (F.col("before") == F.col("rule")) & ((F.col("counter") == F.col("number") + 1) | (F.col("rule") == "bullet"))
    return runs.where(follows & (F.col("line_id") - 2 >= F.col("from"))).select(key, F.explode(F.sequence("from", F.col("line_id") - 2)).alias("line_id"))


def join_soft(lines: Column, hard: Column, glue: str = " ") -> Column:
    """Paragraphs: lines joined where the break between them is soft."""
    def whole(ls: Column, fs: Column) -> Column:
        """Where paragraphs start, and each one's lines up to the next start."""
        starts = F.filter(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: (i == 0) | F.coalesce(F.get(fs, F.greatest(i - 1, F.lit(0))), F.lit(True)))
        return let(starts, lambda st: F.transform(st, lambda s, k: F.array_join(F.slice(ls, s + 1, F.coalesce(F.get(st, k + 1), F.size(ls)) - s), glue)))

    return let(lines, lambda ls: let(hard, lambda fs: F.when(F.size(ls) > 0, whole(ls, fs)).otherwise(F.array().cast("array<string>"))))


def joined_rows(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """The same over rows (key, line_id, line, hard_before), as gaps and islands."""
    numbered = rows.withColumn("paragraph", F.sum(F.coalesce(F.col("hard_before"), F.lit(False)).cast("int")).over(in_document(key)))
    parts = F.array_sort(F.collect_list(F.struct("line_id", "line")))
    return numbered.groupBy(key, "paragraph").agg(parts.alias("parts")).select(key, "paragraph", F.array_join(F.transform("parts", lambda p: p["line"]), " ").alias("text"))


def flags_of_indices(indices: Column, n_lines: Column) -> Column:
    """Soft-break indices to hard-break flags."""
    return F.when(n_lines > 1, F.transform(F.sequence(F.lit(0), n_lines - 2), lambda i: ~F.array_contains(indices, i))).otherwise(F.array().cast("array<boolean>"))


def indices_of_flags(flags: Column) -> Column:
    return F.filter(F.transform(flags, lambda f, i: F.when(~f, i)), lambda i: i.isNotNull())


def greedy_batches(lines: Column, limit: int) -> Column:
    """Arrays of line numbers: the line that would bring a batch over the limit closes it and opens the next one too.

    A line weighs its words times 100 / 75.
    """
    weight = lambda x: F.size(py_split(x)) * F.lit(100 / 75)
    start = F.struct(F.array().cast("array<array<int>>").alias("done"), F.array().cast("array<int>").alias("open"), F.lit(0.0).alias("load"))

    def step(acc: Column, x: Column) -> Column:
        over = acc["load"] + x["w"] > limit
        longer = F.concat(acc["open"], F.array(x["i"]))
        return F.struct(
            F.when(over & (F.size(acc["open"]) > 0), F.concat(acc["done"], F.array(longer))).otherwise(acc["done"]).alias("done"),
            F.when(over, F.array(x["i"])).otherwise(longer).alias("open"), F.when(over, x["w"]).otherwise(acc["load"] + x["w"]).alias("load"),
        )

    weighed = F.transform(lines, lambda x, i: F.struct(i.alias("i"), weight(x).alias("w")))
    return F.aggregate(weighed, start, step, lambda acc: F.when(F.size(acc["open"]) > 0, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]))


def near_matches(true: Column, predicted: Column, margin: int) -> Column:
    """For each predicted index the true one nearest to it after drift correction, or NULL: ties go left, and each match sets the drift."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("drift"))

    def step(acc: Column, p: Column) -> Column:
        at = p + acc["drift"]
        near = F.array_sort(F.transform(F.filter(true, lambda t: F.abs(t - at) <= margin), lambda t: F.struct(F.abs(t - at).alias("d"), t.alias("t"))))
        hit = F.get(near, F.lit(0))["t"]
        return F.struct(F.concat(acc["out"], F.array(hit)).alias("out"), F.coalesce(hit - p, acc["drift"]).alias("drift"))

    return F.aggregate(predicted, start, step, lambda acc: acc["out"])


def near_match_flags(true: Column, predicted: Column, margin: int) -> Column:
    """struct(is_match_true, is_match_pred): which indices of either list near_matches pairs."""
    both = lambda found: F.struct(
        F.transform(true, lambda t: F.array_contains(F.filter(found, lambda x: x.isNotNull()), t)).alias("is_match_true"), F.transform(found, lambda x: x.isNotNull()).alias("is_match_pred")
    )
    return let(near_matches(true, predicted, margin), both)


def compare_breaks(raw: Column, joined: Column) -> Column:
    """For each line feed of raw whether joined, a text of the same length, has it too; NULL where the lengths differ."""
    other = F.split(joined, "")
    flags = let(other, lambda cs: F.transform(positions_of(raw, "\n"), lambda p: F.get(cs, p) == "\n"))
    return F.when(F.length(raw) == F.length(joined), flags)


def token_batches(df: DataFrame, key: str, lines: str, count: Callable[[str], int], limit: int = 512, least: int = 20) -> DataFrame:
    """key, batch, first, last (line numbers), tokens, skipped: as many lines as stay under the limit, counted on the joined lines by an outside function.

    A line that reaches the limit by itself is a batch of its own. A last batch of fewer than the least tokens is marked as skipped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, ls in zip(b[key], b[lines]):
                ls, first, n = list(ls) if ls is not None else [], 0, 0
                while first < len(ls):
                    last, tokens = first, count(ls[first])
                    while last + 1 < len(ls) and (more := count("\n".join(ls[first : last + 2]))) < limit:
                        last, tokens = last + 1, more
                    rows.append((k, n, first, last, tokens, last + 1 == len(ls) and tokens < least))
                    first, n = last + 1, n + 1
            yield pd.DataFrame(rows, columns=[key, "batch", "first", "last", "tokens", "skipped"])

    return df.select(key, lines).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, batch int, first int, last int, tokens int, skipped boolean")


def text_start(lines: Column, scan: int = 12, short: int = 40) -> Column:
    """The line where a first page's text starts: behind the first line that says agenda, else the first that no rule takes for noise.

    Noise: holds or is part of a fixed heading, has a date or an original language, is under half letters, or is short.
    """
    headings = ("Economic and Social Council Distr.:", "United Nations")
    head = F.slice(lines, 1, scan)
    agenda = F.array_position(F.transform(head, lambda x: F.contains(F.lower(x), F.lit("agenda"))), True)

    def noise(x: Column) -> Column:
        fixed = F.lit(False)
        for h in headings:
            fixed = fixed | F.contains(x, F.lit(h)) | F.contains(F.lit(h), x)
        return fixed | x.rlike(r"\d{1,2} [a-zA-Z]+ \d{4}") | x.rlike(r"Original: [a-zA-Z]+") | (F.length(x) * 0.5 > F.regexp_count(x, F.lit("[a-zA-Z]"))) | (F.length(x) < short)

    text = F.array_position(F.transform(head, noise), False)
    return F.when(agenda > 0, agenda).when(text > 0, text - 1).otherwise(F.lit(scan)).cast("int")
