"""Alignment of two segmentations of a text: longest common subsequence over tokens, then intervals or n:m components of lines.

The subsequence is found bit-parallel: whole numbers as rows, 64 cells a machine word. Of equally long ones it is the one whose
every beginning ends as early as possible in the input.

Defined results: null and empty arrays of lines align with nothing; null keys and repeated rows pass through; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tokenizer = Callable[[str], list[str]]
TOKENIZERS: dict[str, Tokenizer] = {"words": str.split, "characters": lambda s: [c for c in s if not c.isspace()]}


def common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs, rising in both.

    A row of the table is one whole number, whose zero bits are the places of a where the length grows. Every so many rows one
    is kept, and the rows between are computed again on the way back, so memory is a.length * sqrt(b.length) / 4 bytes.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    out = [(i, i) for i in range(start)]
    places: dict = {}
    for i in range(start, len(a)):
        places[a[i]] = places.get(a[i], 0) | 1 << (i - start)
    rows, full = b[start:], (1 << (len(a) - start)) - 1
    if not places or not rows:
        return out

    def below(row: int, y) -> int:
        m = places.get(y)
        if m is None:
            return row
        u = row & m
        return ((row + u) | (row - u)) & full

    step = max(32, math.isqrt(len(rows)))
    kept, row = [full], full
    for j, y in enumerate(rows, 1):
        row = below(row, y)
        if j % step == 0:
            kept.append(row)
    length = (full ^ row).bit_length() and (full ^ row).bit_count()
    pairs, at, block, base = [], (full ^ row).bit_length() - 1, None, 0
    j = len(rows)
    while length:
        # Back to the first row that has the length at this place; the pair is there, and the rest lies in the row before.
        while True:
            if block is None or j - 1 < base:
                base = (j - 1) // step * step
                block = [kept[base // step]]
                for y in rows[base : base + step]:
                    block.append(below(block[-1], y))
            zeros = full ^ block[j - 1 - base]
            if zeros >> at & 1 and (zeros & ((1 << at) - 1)).bit_count() == length - 1:
                j -= 1
                continue
            break
        pairs.append((at + start, j - 1 + start))
        at, length, j = (zeros & ((1 << at) - 1)).bit_length() - 1, length - 1, j - 1
    return out + pairs[::-1]


class Alignment:
    def __init__(self, source: list[str], target: list[str], tokenizer: Tokenizer = str.split, smooth: float = 1e-3):
        self.source, self.target = source, target
        sides = [[(n, t) for n, line in enumerate(lines) for t in tokenizer(line)] for lines in (source, target)]
        pairs = common_subsequence([t for _, t in sides[0]], [t for _, t in sides[1]])
        # Characters in common for each pair of lines.
        shared: dict[tuple[int, int], int] = defaultdict(int)
        for i, j in pairs:
            line, token = sides[0][i]
            shared[line, sides[1][j][0]] += len(token)
        self.hits = [(i, j, n) for (i, j), n in shared.items()]
        sizes = [[0] * len(lines) for lines in (source, target)]
        for side, size in zip(sides, sizes):
            for n, t in side:
                size[n] += len(t)
        found = [[0] * len(lines) for lines in (source, target)]
        for i, j, n in self.hits:
            found[0][i] += n
            found[1][j] += n
        self.sizes, self.found = sizes, found
        self.rates = [[f / (s + smooth) if s + smooth else 0.0 for f, s in zip(*x)] for x in zip(found, sizes)]

    def sets(self, least: float) -> dict[int, list[int]]:
        """Target line to the source lines it has tokens of, for target lines of that hit rate at least."""
        out = defaultdict(set)
        for i, j, _ in self.hits:
            if self.rates[1][j] >= least:
                out[j].add(i)
        return {j: sorted(x) for j, x in sorted(out.items())}

    def intervals(self, least: float) -> dict[int, tuple[int, int]]:
        return {j: (x[0], x[-1]) for j, x in self.sets(least).items()}

    def segments(self, least: float = 0.6, drop_last: bool = True) -> list[tuple[int, int]]:
        """Source intervals that cover all lines up to the last aligned one; every line by itself where nothing aligns."""
        found = self.intervals(0.0)
        if drop_last and len(found) > 1:
            found.pop(max(found))
        found = {j: x for j, x in found.items() if self.rates[1][j] >= least}
        if not found:
            return [(i, i) for i in range(len(self.source))]
        out, at = [], 0
        for left, right in found.values():
            left = max(left, at)
            out += [(i, i) for i in range(at, left)]
            if right >= left:
                out.append((left, right))
                at = right + 1
        return out

    def components(self, least: float = 0.2) -> list[dict]:
        """Connected components of lines whose pairs both have that hit rate, by first target line, with their own rates."""
        parent: dict[tuple[int, int], tuple[int, int]] = {}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        kept = [(i, j, n) for i, j, n in self.hits if self.rates[0][i] >= least and self.rates[1][j] >= least]
        for i, j, _ in kept:
            a, b = (0, i), (1, j)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            parent[max(root(a), root(b))] = min(root(a), root(b))
        groups, hits = defaultdict(lambda: ([], [])), defaultdict(int)
        for x in sorted(parent):
            groups[root(x)][x[0]].append(x[1])
        for i, _, n in kept:
            hits[root((0, i))] += n
        rate = lambda g, side, h: h / (1e-3 + sum(self.sizes[side][k] for k in g[side]))
        out = [{"source": g[0], "target": g[1], "source_rate": rate(g, 0, hits[r]), "target_rate": rate(g, 1, hits[r])} for r, g in groups.items()]
        return sorted(out, key=lambda c: c["target"][0])


ROWS = "clean_para_index_set_pair string, src string, dst string, src_text string, dst_text string, src_rate float, dst_rate float"


def _tokenizer(given: str | Tokenizer) -> Tokenizer:
    return TOKENIZERS[given] if isinstance(given, str) else given


def interval_view(source: list[str], target: list[str], shown: list[str], least: float = 0.2, tokenizer: Tokenizer = str.split, glue: str = "") -> tuple[list[str], list[str], str, list[tuple[str, str]]]:
    """Pairs target:first,last, dropped lines (0:target and 1:source), a view for reading, and the pairs' texts. shown: what stands for each target line."""
    found = Alignment(source, target, tokenizer).intervals(least)
    held = {i for a, b in found.values() for i in range(a, b + 1)}
    aligned, dropped, view, pairs, at = [], [], [], [], 0
    for j, text in enumerate(shown):
        if j not in found:
            view += ["", text, ""]
            dropped.append(f"0:{j}")
            continue
        a, b = found[j]
        for i in range(at, a):
            if i not in held:
                view += ["", source[i], ""]
                dropped.append(f"1:{i}")
        at = max(at, a)
        whole = glue.join(source[a : b + 1])
        view += ["", whole, "~" * 20, text, ""]
        aligned.append(f"{j}:{a},{b}")
        pairs.append((text, whole))
    return aligned, dropped + [f"1:{i}" for i in range(at, len(source)) if i not in held], "\n".join(view), pairs


def align_intervals(df: DataFrame, key: str, source: str, target: str, shown: str | None = None, tokenizer: str | Tokenizer = "words", least: float = 0.2, glue: str = "") -> DataFrame:
    """One row for each document: aligned, dropped, preview and pairs of interval_view. shown: the column whose lines stand for the target's, such as the originals of translations."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, aligned array<string>, dropped array<string>, preview string, pairs array<struct<main:string,other:string>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            listed = lambda x: list(x) if x is not None else []
            rows = [(k, *interval_view(listed(s), listed(t), listed(v), least, _tokenizer(tokenizer), glue)) for k, s, t, v in zip(b[key], b[source], b[target], b[shown or target])]
            yield pd.DataFrame([(*r[:4], [{"main": m, "other": o} for m, o in r[4]]) for r in rows], columns=[key, "aligned", "dropped", "preview", "pairs"])

    return df.select(key, *dict.fromkeys([source, target, shown or target])).mapInPandas(run, schema)


def align_rows(df: DataFrame, key: str, source: str, target: str, tokenizer: str | Tokenizer = "words", least: float = 0.2, names: tuple[str, str] = ("xx", "en")) -> DataFrame:
    """One row for each component of each document: df holds two arrays of lines, a document is one row and is aligned alone."""
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, {ROWS}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, a, b in zip(batch[key], batch[source], batch[target]):
                a, b = list(a if a is not None else ()), list(b if b is not None else ())
                for c in Alignment(a, b, _tokenizer(tokenizer)).components(least) if a and b else ():
                    pair = "|".join(",".join(map(str, c[s])) for s in ("source", "target"))
                    rows.append((k, pair, *names, "\n".join(a[i] for i in c["source"]), "\n".join(b[j] for j in c["target"]), c["source_rate"], c["target_rate"]))
            yield pd.DataFrame(rows, columns=[key, *[x.split()[0] for x in ROWS.split(", ")]])

    return df.select(key, source, target).mapInPandas(run, schema)


def unmatched(n_lines: int, matched: list[int]) -> list[int]:
    return sorted(set(range(n_lines)) - set(matched))


def unmatched_rows(df: DataFrame, aligned: DataFrame, key: str, source: str, target: str) -> DataFrame:
    """Places of the lines of both sides that no row of align_rows holds; all of them where a document has none."""
    side = lambda k: F.flatten(F.collect_list(F.split(F.split_part("clean_para_index_set_pair", F.lit("|"), F.lit(k)), ",").cast("array<int>")))
    matched = aligned.groupBy(key).agg(side(1).alias("_s"), side(2).alias("_t"))
    none = F.array().cast("array<int>")
    left = lambda lines, found: F.array_except(F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(none), F.coalesce(F.col(found), none))
    return df.select(key, source, target).join(matched, key, "left").select(key, left(source, "_s").alias("source_unmatched"), left(target, "_t").alias("target_unmatched"))
