"""Joining lines of one document where each decision depends on what was joined before: plain functions, mapped over rows.

Splitters of sentences and words are given by the caller; the ones here are plain defaults.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .detectors import split_sentences

#: First pages of meeting records, from their heading to the note on corrections (fixed values).
INFO_PAGES = (
    r"(?ms)United Nations\s.*?Corrections will be issued after the end of the session in a consolidated corrigendum\.",
    r"(?ms)United Nations\s.*?Corrected records will be reissued electronically on the Official Document System of the United Nations \(http://documents\.un\.org\)\.",
    r"(?ms)This record contains the text of speeches delivered in English.*?Corrected records will be reissued electronically on the Official Document System of the United Nations \(http://documents\.un\.org\)\.",
)


def without_info_pages(text: Column) -> Column:
    for pattern in INFO_PAGES:
        text = F.regexp_replace(text, pattern, "")
    return text


#: What a line may start with that never continues another: a numbered paragraph, a bullet, a speaker (fixed values).
NEW_PARAGRAPH = re.compile(r"^(?:[0-9]{1,3}\. [A-Z]|•|(?:Mr|Mrs|Ms)\. )")


#: Weights of the score, and what the length is held against (fixed values): full stop, comma, length at most, length that
#: says nothing, small letter, one sentence or two, new paragraph.
STOP, COMMA, LONG, EVEN, SMALL, SENTENCES, NEW = 44.0, 81.0, 60, 32, 83.0, 200, 999.0


def join_score(before: str, line: str, following: str, sentences: Callable[[str], list[str]]) -> float:
    """Over 0: the next line goes on. before: the paragraph as joined so far; line: its last line alone."""
    parts = sentences(f"{before} {following}")
    score = -STOP * before.endswith(".") + COMMA * before.endswith(",") + min(LONG, len(line)) - EVEN + SMALL * following[:1].islower()
    if len(parts) == 1:
        score += SENTENCES
    elif len(parts) == 2 and parts[0].strip() == before.strip() and parts[1].strip() == following.strip():
        score -= SENTENCES
    return score - NEW * bool(NEW_PARAGRAPH.match(following))


def join_lines(lines: list[str], sentences: Callable[[str], list[str]] = split_sentences, keep_blank: bool = False) -> list[str]:
    """Paragraphs of an English page: the left side grows with each line that it takes in.

    keep_blank: blank lines stay and nothing is joined over them, as in the published script; without, they are left out.
    """
    out: list[str] = []
    last = ""
    for line in (x.strip() for x in lines):
        if not line:
            if keep_blank:
                out.append(line)
                last = line
            continue
        if out and out[-1] and join_score(out[-1], last, line, sentences) > 0:
            out[-1] += f" {line}"
        else:
            out.append(line)
        last = line
    return out


def mark_titles(lines: list[str], titles: list[str], most: int = 3) -> list[str]:
    """Lines, or pairs of lines, that are a title up to so many edits become ====title====, as often as they occur.

    Titles are tried in their order, each with the line alone first and then with the line before it, where that is still open.
    """

    def distance(a: str, b: str) -> int:
        if abs(len(a) - len(b)) > most or max(sum((Counter(a) - Counter(b)).values()), sum((Counter(b) - Counter(a)).values())) > most:
            return most + 1
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            diagonal, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
        return row[-1]

    out, waiting = [], None
    for line in lines:
        hit = None
        for t in titles:
            if distance(line, t) <= most:
                hit, before = t, waiting
            elif waiting is not None and distance(f"{waiting} {line}", t) <= most:
                hit, before = t, None
            if hit is not None:
                break
        if waiting is not None and (hit is None or before is not None):
            out.append(waiting)
        waiting = line if hit is None else None
        if hit is not None:
            out.append(f"\n===={hit}====\n")
    return out if waiting is None else [*out, waiting]


CLOSING = re.compile(r"[。！？；：:;.!?”’）)]$")
NUMBER = re.compile(r"^[0-9一二三四五六七八九十]+[、.．]")


def pair_counts(lines: DataFrame, words: str = "words") -> DataFrame:
    """How often a word ends a line whose next one starts with another: prev, word, n over rows (doc_id, line_id, words) of all documents."""
    pairs = F.arrays_zip(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))).alias("prev"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("word"))
    return lines.select(F.explode(pairs).alias("p")).groupBy("p.prev", "p.word").agg(F.count(F.lit(1)).alias("n"))


def merge_chinese_lines(lines: list[list[str]], known: dict[tuple[str, str], int]) -> list[str]:
    """Lines of words are joined where the corpus knows the last and the next first word as neighbours; never after a closing mark or before a number."""
    out: list[list[str]] = []
    for words in lines:
        if not words:
            continue
        if out and not CLOSING.search("".join(out[-1])) and not NUMBER.match("".join(words)) and known.get((out[-1][-1], words[0]), 0) >= 1:
            out[-1] = out[-1] + words
        else:
            out.append(list(words))
    return ["".join(x) for x in out]


def merge_chinese_segments(segments: list[str], han: Callable[[str], bool] = lambda c: "一" <= c <= "鿿") -> list[str]:
    """White space between Chinese characters goes: segments are stacked, and the top grows while both sides of the gap are Chinese."""
    stack: list[str] = []
    for s in segments:
        if stack and s and stack[-1] and han(stack[-1][-1]) and han(s[0]) and not NUMBER.match(s):
            stack[-1] += s
        else:
            stack.append(s)
    return stack


def back_off_chunks(words: list[str], count: Callable[[str], int], limit: int = 512) -> list[str]:
    """Words in chunks of limit tokens at most: as many words as the limit, halved until they fit. ValueError for a word that never does."""
    out, at = [], 0
    while at < len(words):
        take = min(len(words) - at, limit)
        while count(" ".join(words[at : at + take])) > limit:
            if take == 1:
                raise ValueError(f"one word is over {limit} tokens")
            take = (1 + take) // 2
        out.append(" ".join(words[at : at + take]))
        at += take
    return out


def marked_titles(pages: DataFrame, key: str, contents: str, lines: str) -> DataFrame:
    """key, titles, lines: titles are read from the lines of each row's contents page and marked in its lines."""
    from .headers import index_titles

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            titles = [index_titles(list(x) if x is not None else []) for x in b[contents]]
            yield pd.DataFrame({key: b[key], "titles": titles, "lines": [mark_titles([y.strip() for y in x] if x is not None else [], t) for t, x in zip(titles, b[lines])]})

    return pages.select(key, contents, lines).mapInPandas(run, f"`{key}` {pages.schema[key].dataType.simpleString()}, titles array<string>, lines array<string>")


def map_lines(df: DataFrame, key: str, lines: str, body: Callable[[list[str]], list[str]]) -> DataFrame:
    """body over each row's lines, in batches: key, lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "lines": [body(list(x) if x is not None else []) for x in b[lines]]})

    return df.select(key, lines).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, lines array<string>")
