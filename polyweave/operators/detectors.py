"""Detectors of hard line breaks: (rows of key and lines) to (key, hard), by name."""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.staging import materialised
from . import align, lines as L

Detector = Callable[[DataFrame], DataFrame]
_REGISTRY: dict[str, Callable[..., Detector]] = {}


def register(name: str):
    def put(make):
        _REGISTRY[name] = make
        return make

    return put


def detector(config: dict) -> Detector:
    """From {"name": ..., further settings}; ValueError for a name that isn't registered."""
    config = dict(config)
    name = config.pop("name", None)
    if name not in _REGISTRY:
        raise ValueError(f"no detector is called {name!r}; there are {', '.join(sorted(_REGISTRY))}")
    return _REGISTRY[name](**config)


def _by_pairs(body) -> Detector:
    return lambda df: df.withColumn("detected", L.pairs(F.col("lines"), body))


@register("dash")
def dash() -> Detector:
    return _by_pairs(L.dash_flag)


@register("punctuation_capital")
def punctuation_capital() -> Detector:
    return _by_pairs(L.punctuation_flag)


def split_sentences(text: str) -> list[str]:
    """A plain splitter: after sentence marks before a capital. Others can be given in its place."""
    return [s for s in re.split(r"(?<=[.?!])\s+(?=[A-ZÀ-Þ\"'(])", text.strip()) if s]


@register("rule_based")
def rule_based(sentences: Callable[[str], list[str]] = split_sentences) -> Detector:
    """Scores each pair of lines; over 0 the break is soft. Empty neighbours make it soft, a list marker on the next line hard;
    breaks inside the items of a numbered list are soft, but the one before the next item."""

    @F.pandas_udf("array<int>")
    def one_sentence(rows: pd.Series) -> pd.Series:
        def score(a: str, b: str) -> int:
            found = sentences(f"{a[-100:]} {b[:100]}")
            if len(found) <= 1:
                return 200
            # How much the sentence most like the next line is like it, blanks aside: 0.6 scores 0, 0.9 scores -200.
            best = max(difflib.SequenceMatcher(lambda c: c == " ", s, b[:100]).ratio() for s in found)
            return -int((best - 0.6) * 666.7)

        return pd.Series([[score(a, b) for a, b in zip(ls, ls[1:])] for ls in rows])

    def run(df: DataFrame) -> DataFrame:
        simple = L.pairs(F.col("lines"), lambda a, b: L.simple_score(a, b))
        special = L.pairs(F.col("lines"), lambda a, b: F.when((F.trim(a) == "") | (F.trim(b) == ""), 1).when(L.marker(b).isNotNull(), -1).otherwise(0))
        scored = df.withColumns({"_s": simple, "_x": special, "_n": one_sentence("lines")})
        flags = F.transform(F.arrays_zip("_s", "_x", "_n"), lambda z: F.when(z["_x"] > 0, F.lit(False)).when(z["_x"] < 0, F.lit(True)).otherwise(z["_s"] + z["_n"] <= 0))
        scored = scored.withColumn("detected", flags).drop("_s", "_x", "_n")
        # Written first: two branches read the rows' own number, which a repeated task might deal out otherwise.
        keyed = materialised(scored.withColumn("_id", F.monotonically_increasing_id()))
        rows = keyed.select("_id", F.posexplode("lines").alias("line_id", "line"))
        soft = L.list_runs(rows, "_id").groupBy("_id").agg(F.collect_set("line_id").alias("_soft"))
        out = keyed.join(soft, "_id", "left")
        return out.withColumn("detected", F.transform("detected", lambda f, i: f & ~F.coalesce(F.array_contains("_soft", i), F.lit(False)))).drop("_id", "_soft")

    return run


@register("offline")
def offline(labels: DataFrame, key: str = "record") -> Detector:
    """Flags that are known; a record without them is an error."""

    def run(df: DataFrame) -> DataFrame:
        known = labels.select(key, F.col("is_hard_linebreak").alias("detected"))
        out = df.join(known, key, "left")
        return out.withColumn("detected", F.coalesce("detected", F.raise_error(F.concat(F.lit("no labels for record "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("array<boolean>")))

    return run


class AnswerError(Exception):
    """What an outside function raises where asking again may help; other exceptions end the job."""


class NoAnswer(Exception):
    """An outside function failed as often as it may be asked."""


def asked(complete: Callable[[str], str], attempts: int, good: Callable[[str, str], bool] = lambda text, answer: True) -> Callable[[str], str]:
    """complete, asked again where it raises AnswerError or gives no good answer; answers are kept, so a text is paid for once in a task."""
    known: dict[str, str] = {}

    def ask(text: str) -> str:
        for _ in range(attempts if text not in known else 0):
            try:
                answer = complete(text)
            except AnswerError:
                continue
            if good(text, answer):
                known[text] = answer
                break
        if text not in known:
            raise NoAnswer(f"no good answer in {attempts} attempts to a text that begins with {text[:60]!r}")
        return known[text]

    return ask


@register("batch")
def batch(complete: Callable[[str], str], limit: int = 256, least: float = 0.6, attempts: int = 1, good: Callable[[str, str], bool] = lambda text, answer: True) -> Detector:
    """Asks an outside function to join the lines of one batch after another, and aligns its answer with the lines.

    The next batch starts where the answer's last whole paragraph ended. A line over the limit is a batch of its own. attempts and
    good are those of asked.
    """

    def flags(ls: list[str], complete: Callable[[str], str]) -> list[bool]:
        hard, at = [True] * max(0, len(ls) - 1), 0
        while at < len(ls):
            end, load = at, 0
            while end < len(ls) and (end == at or load + len(ls[end].split()) < limit):
                load += len(ls[end].split())
                end += 1
            answer = [x for x in complete("\n".join(ls[at:end])).split("\n") if x.strip()]
            parts = align.Alignment(ls[at:end], answer).segments(least, drop_last=end < len(ls))
            done = at
            for left, right in parts:
                for i in range(at + left, at + right):
                    hard[i] = False
                done = max(done, at + right + 1)
            at = done if done > at else end
        return hard

    def run(df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c != "detected"]

        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ask = asked(complete, attempts, good)
            for b in batches:
                yield b.assign(detected=[flags(list(x), ask) for x in b["lines"]])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema) + ", detected array<boolean>"
        return df.select(*kept).mapInPandas(rows, schema)

    return run


def evaluate(df: DataFrame, config: dict, key: str = "doc_id", most_words: int | None = None) -> DataFrame:
    """Confusions of a detector on rows of key, lines and hard; long documents can be left out."""
    from .evaluate import confusion

    if most_words is not None:
        df = df.where(F.size(F.split(F.array_join("lines", "\n"), " ")) <= most_words)
    return confusion(detector(config)(df), key, "hard", "detected")


