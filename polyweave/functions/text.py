"""Text functions with Python's notion of white space, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.strip() strips: Unicode white space and the four separators U+001C to U+001F.
PY_SPACE = r"[\s\x1c-\x1f]"
#: Where str.splitlines() splits.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def py_strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)^{PY_SPACE}+|{PY_SPACE}+$", "")


def py_split(x: Column) -> Column:
    """str.split(): no empty parts, none at all for a blank text."""
    return F.filter(F.split(x, rf"(?U){PY_SPACE}+"), lambda w: w != "")


def py_splitlines(x: Column) -> Column:
    """str.splitlines(): one empty part at the end is dropped."""
    parts = F.split(x, LINE_END)
    last_empty = F.element_at(parts, -1) == ""
    return F.when(x == "", F.array().cast("array<string>")).when(last_empty, F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)


def collapse_blank_lines(x: Column) -> Column:
    """A line end and the white space behind it become one line end; the ends are stripped."""
    return py_strip(F.regexp_replace(x, rf"(?U)\n{PY_SPACE}*", "\n"))


def squeeze_spaces(x: Column) -> Column:
    """A run of white space becomes its line feeds if it has any, else its last character."""
    with_lines = F.regexp_replace(F.regexp_replace(x, rf"(?U)(?<=\n)(?:(?!\n){PY_SPACE})+", ""), rf"(?U)(?:(?!\n){PY_SPACE})+(?=\n)", "")
    return F.regexp_replace(with_lines, rf"(?U){PY_SPACE}+(?<!\n)(?=$|\P{{IsWhite_Space}})(?<=({PY_SPACE}))", "$1")


#: Chinese punctuation and its ASCII counterparts (fixed values); the full stop stays.
ZH_PUNCTUATION, ASCII_PUNCTUATION = "，（）？：；“”‘’！", ",()?:;\"\"''!"


def ascii_punctuation(x: Column) -> Column:
    return F.translate(x, ZH_PUNCTUATION, ASCII_PUNCTUATION)


def noncharacter_to_hyphen(x: Column) -> Column:
    """U+FFFE, which PDF conversion leaves in place of soft hyphens."""
    return F.replace(x, F.lit("￾"), F.lit("-"))


def clean_article(x: Column) -> Column:
    """No-break spaces go, runs of line ends become one, the ends are stripped."""
    return py_strip(F.regexp_replace(F.replace(x, F.lit("\xa0"), F.lit("")), r"\n+", "\n"))


#: Chinese characters (fixed values).
HAN = r"[\x{3006}\x{3007}\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}\x{20000}-\x{2a6df}\x{2a700}-\x{2ebef}\x{30000}-\x{3134f}]"


def share_of(x: Column, pattern: str) -> Column:
    """Matches for each character; 0 for an empty text."""
    return F.when(F.length(x) > 0, F.regexp_count(x, F.lit(pattern)) / F.length(x)).otherwise(F.lit(0.0))


def han_share(x: Column) -> Column:
    return share_of(x, HAN)


def latin_share(x: Column) -> Column:
    return share_of(x, "[a-zA-Z]")


def is_english_line(x: Column) -> Column:
    """Only ASCII letters, digits, white space and what is no word character."""
    return x.rlike(r"(?U)^[a-zA-Z0-9\s\W]+$")


def likely_same(a: Column, b: Column, most: int = 3) -> Column:
    """Edit distance of most at most; the lengths are compared first."""
    return (F.abs(F.length(a) - F.length(b)) <= most) & (F.levenshtein(a, b, most) >= 0)


def positions_of(x: Column, char: str) -> Column:
    """0-based places of a character."""
    return F.filter(F.transform(F.split(x, ""), lambda c, i: F.when(c == char, i)), lambda i: i.isNotNull())


def chunks(x: Column, size: int) -> Column:
    """The text in pieces of so many characters; none of an empty text."""
    starts = F.when(F.length(x) > 0, F.sequence(F.lit(0), F.length(x) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.substring(x, s + 1, F.lit(size)))


def line_digest(x: Column) -> Column:
    """The line without white space."""
    return F.regexp_replace(x, rf"(?U){PY_SPACE}+", "")


#: What the converter writes in place of a missing file (fixed value).
MISSING_FILE = "Http Status Code: 404\n\nReason: File not found or unable to read file"


def is_garbage(x: Column) -> Column:
    """Nothing but brackets and white space, or the note of a missing file; null too."""
    return F.coalesce(~x.rlike(r"[^\[\]\s]") | (py_strip(x) == MISSING_FILE), F.lit(True))


def is_short_or_garbled(x: Column, mark: str = "\n----\n", least: float = 0.2) -> Column:
    """Fewer than three pages, or fewer Latin letters than the least share."""
    return (latin_share(x) < least) | (F.size(F.split(x, mark)) <= 2)


#: Page furniture, in the order in which it goes (fixed values). EDGE holds near the top and bottom of a page only: file
#: codes, page numbers, parts and volumes, articles. ANYWHERE: numbers between asterisks, printing marks.
EDGE = (
    r"([a-zA-Z0-9\.]{1,13}/){2,5}[A-Za-z0-9\.]{1,13}", r"^([0-9/]{1,8} ){0,1}[0-9-]{1,8}( [/0-9]{1,8}){0,1}$",
    r"^(\([PartVol\.]{1,4} [IVX]{1,4}\)\*?)$", r"^Article [IVX]{1,4}$",
)
ANYWHERE = (r"^\*[0-9]+\*$", r"^[0-9]+-[0-9]+ \(E\)$")


def at_page_edge(line_id: Column, lines: Column) -> Column:
    """Among the first four or last two lines of a page."""
    return (line_id < 4) | (lines - line_id < 3)


def without_furniture(line: Column, at_edge: Column) -> Column:
    """at_edge: one of the first four or last two lines of its page."""
    edge = py_strip(line)
    for pattern in EDGE:
        edge = py_strip(F.regexp_replace(edge, pattern, ""))
    out = F.when(at_edge, edge).otherwise(py_strip(line))
    for pattern in ANYWHERE:
        out = F.regexp_replace(out, pattern, "")
    return out


def clean_paragraph(x: Column) -> Column:
    """Plain-text tables and wrapped lines: rules go and end a table row, whose cells (wrapped ones joined) are joined by tabs; other lines are joined by blanks.

    A fold over the lines, with what is written so far and the open row's cells.
    """
    cells = lambda s: F.transform(F.split(F.regexp_replace(s, r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    none = F.array().cast("array<string>")
    written = lambda acc: F.when(F.size(acc["row"]) > 0, F.concat(acc["out"], F.array_join(acc["row"], "\t"))).otherwise(acc["out"])
    ended = lambda out: F.when(out.endswith("\n"), out).otherwise(F.concat(out, F.lit("\n")))
    wrapped = lambda a, b: F.when(F.size(a) == 0, b).otherwise(F.zip_with(a, b, lambda p, q: F.concat(F.coalesce(p, F.lit("")), F.coalesce(q, F.lit("")))))
    state = lambda out, row: F.struct(out.alias("out"), row.alias("row"))

    def step(acc: Column, line: Column) -> Column:
        ruled = state(written(F.struct(ended(acc["out"]).alias("out"), acc["row"].alias("row"))), none)
        return (
            F.when(line.rlike(r"^(?:\+[-=+]+\+|-+|=+|_+)$"), ruled)
            .when(line.rlike(r"^\|( +\|)+$"), state(F.concat(written(acc), F.lit(" ")), none))
            .when(line.rlike(r"^\|([^|]+\|)+$"), state(acc["out"], wrapped(acc["row"], cells(line))))
            .otherwise(state(F.concat(acc["out"], F.lit(" "), line), acc["row"]))
        )

    last = lambda acc: F.when(F.size(acc["row"]) > 0, F.concat(ended(acc["out"]), F.array_join(acc["row"], "\t"))).otherwise(acc["out"])
    folded = F.aggregate(F.transform(F.split(x, "\n"), py_strip), state(F.lit(""), none), step, last)
    return py_strip(F.regexp_replace(F.regexp_replace(folded, r"\n{2,}", "\n"), r"[ \t]{2,}", " "))
