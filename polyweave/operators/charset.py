"""Which scripts fill which language's column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Chinese characters in a class (fixed values).
_HAN = r"\x{3006}\x{3007}\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2ebef}\x{30000}-\x{3134f}"
_PUNCTUATION = r"!-/:-@\[-`{-~"
#: What fills a language's column beside punctuation, white space and word characters, and the least share of it all (fixed values).
LETTERS = {"ar": r"\x{0600}-\x{06ff}", "zh": _HAN, "fr": "À-Ÿ", "es": "áéíóúñÁÉÍÓÚÑüÜ", "ru": "А-Яа-яЁёъь", "en": "", "de": "ÄäÖöÜüß"}
LEAST = {"ar": 0.6, "zh": 0.6, "fr": 0.8, "es": 0.8, "ru": 0.8, "en": 0.8, "de": 0.8}
#: Letters that mark a language, in the order of the tests, and the share of them that is too much elsewhere (fixed values).
MARKS = {"ar": r"[\x{0600}-\x{06ff}]", "zh": f"[{_HAN}]", "fr": "[À-Ÿ]", "es": "[áéíóúñÁÉÍÓÚÑüÜ]", "ru": "[А-Яа-яЁёъь]", "de": "[ÄäÖöÜüß]"}
MOST = {"ar": 0.2, "zh": 0.2, "fr": 0.1, "es": 0.1, "ru": 0.2, "de": 0.1}


def share(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern)) / (F.length(x) + 1e-3)


def occupancy(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """rate of each row's own letters, and whether it is under its language's least share."""
    own = F.coalesce(*[F.when(F.col(lang) == k, share(F.col(text), rf"(?U)[{_PUNCTUATION}\s\w{p}]")) for k, p in LETTERS.items()])
    least = F.coalesce(*[F.when(F.col(lang) == k, F.lit(v)) for k, v in LEAST.items()])
    return rows.withColumn("rate", own).withColumn("suspect", own < least)


def foreign(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """The first other language, in the order of the list, whose letters fill more of the text than allowed."""
    hit = F.coalesce(*[F.when((F.col(lang) != k) & (share(F.col(text), p) > MOST[k]), F.struct(F.lit(k).alias("detected_lang"), share(F.col(text), p).alias("rate"))) for k, p in MARKS.items()])
    return rows.withColumn("hit", hit).where("hit is not null").select("*", "hit.detected_lang", "hit.rate").drop("hit")
