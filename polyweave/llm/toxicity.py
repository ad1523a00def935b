"""Toxicity by a weighted lexicon, matched by Aho-Corasick after folding.

Folding maps homoglyphs, compatibility forms, digits and signs that stand for letters to plain small letters; what is no
letter separates words. Texts are composed first (NFC), so a letter and its accent score alike in either form. The lexicon (whole words and beginnings of words) and its weights are learned from a bounded sample
of labelled rows, as is the logistic curve over three features: the matched weight, the same by length, and the largest.
In a word only its heaviest entry counts; hits inside an exception phrase don't.

Defined results: null text counts as empty and gets the curve's value at no match; without usable labels every score is the
prior, 0; null doc_id is not held out and has no label; of several labels for one document the highest counts; repeated rows
are each scored, and of several texts with one labelled doc_id the curve is fitted to the one that matches most; an empty table
gives an empty result; further columns are ignored. What the driver gathers: at most SAMPLE labels, MOST_ENTRIES entries, and
three numbers for each sampled label.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_of

#: Labelled rows to learn from, those of the smallest hashes; entries of the lexicon; fewest toxic documents for an entry.
SAMPLE, MOST_ENTRIES, LEAST_SUPPORT = 12_000, 3_000, 6
PREFIXES = range(4, 9)
#: Letters of other scripts that look like Latin ones, and signs and digits that stand for letters (fixed values).
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Phrases whose words are not meant as insults (fixed values).
EXCEPTIONS = (
    "trash can", "trash bag", "trash bin", "trash day", "clown fish", "class clown", "pond scum", "garbage collector", "garbage truck", "garbage collection", "killer whale", "kill switch",
    "dumb waiter", "pig iron", "rat race", "idiot proof", "sucker punch", "worm gear",
)


@functools.cache
def fold_table() -> np.ndarray:
    """Code point to folded code point; what is no letter becomes a space, a combining mark nothing (0)."""
    out = np.full(0x110000, 0x20, dtype=np.uint32)
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x33480), *range(0xE0000, 0xE0200)]):  # all planes with letters or marks
        kind = unicodedata.category(c)
        if kind[0] == "M" or kind == "Cf":
            out[ord(c)] = 0
        elif kind[0] in "LN" or c in SUBSTITUTIONS:
            plain = unicodedata.normalize("NFKC", c).lower()
            plain = HOMOGLYPHS.get(plain, SUBSTITUTIONS.get(plain, plain))
            if plain[:1].isalpha():
                out[ord(c)] = ord(plain[0])
    return out


def fold(text: str) -> str:
    """The folded words, each with one or more spaces around it."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    points = fold_table()[np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), dtype=np.uint32)]
    return points[points > 0].tobytes().decode("utf-32-le")


class Lexicon:
    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.weights, self.exceptions = weights, exceptions

    @functools.cached_property
    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            out.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            out.add_word(f" {phrase} ", (len(phrase) + 2, None))
        out.make_automaton()
        return out

    def features(self, text: str) -> tuple[float, float, float]:
        """Matched weight (its logarithm), the same for each square root of a word, and the largest weight."""
        folded = " ".join(["", *fold(text).split(), ""])
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if len(self.automaton):
            for end, (length, weight) in self.automaton.iter(folded):
                start = end - length + 1
                if weight is None:
                    spared.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        hits = [w for s, w in best.items() if not any(a <= s < b for a, b in spared)] if spared else list(best.values())
        total = sum(hits)
        return float(np.log1p(total)), total / max(folded.count(" ") - 1, 1) ** 0.5, max(hits, default=0.0)


class Model:
    def __init__(self, lexicon: Lexicon, curve: np.ndarray | None):
        self.lexicon, self.curve = lexicon, curve

    def score(self, text: str) -> float:
        if self.curve is None:
            return 0.0
        z = float(np.dot(self.curve, [1.0, *self.lexicon.features(text)]))
        return 1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))


def fit_curve(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * features.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), x.T @ (labels - p) - penalty @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _entries(folded: str) -> set[str]:
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) >= n}


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """From the documents of a bounded sample of the labels whose rows aren't held out."""
    spark = docs.sparkSession
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect()
    if not 0 < sum(r.toxic for r in sample) < len(sample):
        return Model(Lexicon({}), None)
    chosen = F.broadcast(spark.createDataFrame(sample, usable.schema))
    # At most SAMPLE documents, read by a broadcast join: no text is shuffled.
    labelled = docs.select("doc_id", text_of("text").alias("text")).join(chosen, "doc_id").select("doc_id", "text", "toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter(), Counter()
        docs_seen = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found[toxic].update(_entries(fold(text)))
                docs_seen[toxic] += 1
        # Entries without toxic documents of this task are sent as well: others may have some.
        keys = ["", *(found[0].keys() | found[1].keys())]
        yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array([docs_seen[t], *[found[t][k] for k in keys[1:]]], pa.int64()) for t in (1, 0)]], names=["entry", "toxic", "clean"])

    counts = labelled.mapInArrow(count, "entry string, toxic bigint, clean bigint").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # The entry "" holds the rows seen of either label: repeated documents count in it as often as in the entries.
    counts = staged(counts.where((F.col("entry") == "") | (F.col("toxic") >= LEAST_SUPPORT)), "toxic-entries")
    seen = counts.where("entry = ''").first()
    if seen is None or not seen.toxic or not seen.clean:
        return Model(Lexicon({}), None)
    log_odds = lambda c, n: F.log((F.col(c) + 0.5) / (n - F.col(c) + 0.5))
    weight = log_odds("toxic", seen.toxic + 1.0) - log_odds("clean", seen.clean + 1.0)
    z = weight / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = counts.where("entry <> ''").select("entry", weight.alias("weight"), z.alias("z")).where("z > 3 and weight > 2")
    lexicon = Lexicon({r.entry: r.weight for r in best.orderBy(F.col("z").desc(), "entry").limit(MOST_ENTRIES).collect()})
    shared = spark.sparkContext.broadcast(lexicon)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [shared.value.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *[pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]], names=["doc_id", "toxic", "a", "b", "c"])

    measured = labelled.mapInArrow(features, T.StructType([docs.schema["doc_id"], T.StructField("toxic", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in "abc"]]))
    # One row for each label, however many rows have its doc_id; the one with the most matches.
    rows = measured.groupBy("doc_id").agg(F.max(F.struct("toxic", "a", "b", "c")).alias("m")).select("m.*").collect()
    if len({r[0] for r in rows}) < 2:
        return Model(lexicon, None)
    table = np.array(sorted(map(tuple, rows)), dtype=float)
    return Model(lexicon, fit_curve(table[:, 1:], table[:, 0]))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs(doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], names=schema.names)

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of("text").alias("text")).mapInArrow(run, schema)
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
