"""Near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

1. Two passes over the texts: one adds every document's shingles (five words) to a count-mean-min sketch of document
   frequencies, whose size is fixed whatever the corpus (a shingle that does not stand out from its cells' noise counts as
   rare, so the idf keeps telling common shingles from the others as the corpus grows); the other takes each document's consistent weighted samples,
   with weights (1 + ln tf) * (1 + strength * normalised idf) on a fixed grid, and hashes them by bands.
2. Texts with the same words are one class from the start; only one of them goes on.
3. In a bucket of a band, all are compared with one leader, not with each other: exact weighted Jaccard on the texts.
   Then small buckets are compared whole, and the members of larger ones with a second leader, drawn anew in each band,
   as far as no leader has joined them yet.
4. Large buckets whose members are in more than one class by then are settled exactly: buckets that share texts are one
   group, and all texts outside a group's largest class are compared with all of the group, block by block, as products of
   matrices. A block gives no more links than it has texts. A group of more than Settings.split texts is split first, by
   prefixes: of each text the rarest shingles that a partner at the threshold has to share one of, and texts are compared
   only within the groups of such a shingle. So every pair that shares a bucket is compared, in one class, or known to be
   under the threshold, and no bucket emits its square. Classes are the connected components of all pairs at the threshold
   or above.

The strength of the idf is moderate on purpose: in a group of copies that holds a third of all rows, full idf would weigh the
few edited shingles many times the common ones, and pairs at 0.8 or more of plain overlap would be missed.

Defined results: null text counts as empty; texts without words are one class; a text of fewer than five words is one
shingle; a null doc_id sorts after all others; repeated rows are copies; an empty table gives an empty result; further
columns are ignored. A text's class is named by the smallest doc_id in it.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import in_runs
from .common import SPACE_CHARS, dropped, staged, text_of

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64
#: Sketch of document frequencies: rows times cells of 64-bit counts, 4 MB.
SKETCH_ROWS, SKETCH_CELLS = 2, 1 << 18
SKETCH_PART, SKETCH_SLOTS = 1 << 14, 64
#: A cell's count stands out from so many robust deviations of its row's cells on.
STANDS_OUT = 3.0
#: The grid of weights: idf steps times classes of tf (1, 2, 3-4, 5-8, 9 or more), and their weights at strength 1.
IDF_STEPS = 4
TF_BOUNDS = np.array([2, 3, 5, 9])
TF_WEIGHTS = 1 + np.log(np.array([1.0, 2.0, 3.5, 6.5, 12.0]))


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    bands: int = 16
    rows: int = 4
    strength: float = 0.25
    #: Buckets of up to so many texts are compared whole; larger ones in blocks of about so many texts and bytes a side.
    whole_bucket: int = 8
    block: int = 256
    block_bytes: int = 8 << 20
    #: Groups of more texts are split by prefixes before blocks are made.
    split: int = 4096
    #: Variates are drawn for so many classes of shingles; a sample still names the very shingle.
    variate_classes: int = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACE_CHARS]] = True


@functools.cache
def _coefficients(bits: int) -> np.ndarray:
    """Random 64-bit coefficients for the places of bytes in words; a longer table begins as a shorter one does."""
    return np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, 1 << bits, dtype=np.uint64) | _U(1)


def raw_texts(column: pa.Array) -> list[np.ndarray]:
    """The UTF-8 bytes of a column of strings without nulls, as views of its buffer: a batch of texts isn't held twice."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return []
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    chars = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return [chars[a:b] for a, b in zip(ends[:-1], ends[1:])]


def word_hashes(text: str | np.ndarray) -> np.ndarray:
    """A 64-bit multilinear hash of each word's UTF-8 bytes, in order."""
    raw = text if isinstance(text, np.ndarray) else np.frombuffer(text.encode(), dtype=np.uint8)
    inside = ~_IS_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    chars = raw[inside].astype(np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(chars)) - np.repeat(first, lengths)
    terms = _coefficients(max(10, int(lengths.max()).bit_length()))[place] * (chars + _U(1))
    return _mix(np.add.reduceat(terms, first))


def shingles(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingles' hashes in order, and how often each occurs."""
    if not len(words):
        return words, np.zeros(0, dtype=np.int64)
    k = min(n, len(words))
    h = np.zeros(len(words) - k + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h = (h ^ words[i : len(words) - k + 1 + i]) * _GOLD
            h ^= h >> _U(29)
        h = _mix(h)
    return np.unique(h, return_counts=True)


def _cells(h: np.ndarray, row: int) -> np.ndarray:
    return ((h >> _U(18 * row)) & _U(SKETCH_CELLS - 1)).astype(np.intp)


def frequency_sketch(docs: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Counts of documents by cell, and the number of documents. What comes to the driver is the sketch itself, 4 MB."""
    parts = SKETCH_ROWS * SKETCH_CELLS // SKETCH_PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((SKETCH_ROWS, SKETCH_CELLS), dtype=np.int64), 0
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            n += len(texts)
            for a, b in in_runs(texts):
                h = np.concatenate([shingles(word_hashes(t), settings.words)[0] for t in texts[a:b]])
                for r in range(SKETCH_ROWS):
                    counts[r] += np.bincount(_cells(h, r), minlength=SKETCH_CELLS)
        if n:
            yield _parts([*range(parts), -1], [*counts.reshape(parts, -1), np.array([n])])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                own = counts.values.to_numpy()
                total[part] = total[part] + own if part in total else own.copy()
        yield _parts(list(total), list(total.values()))

    # Sketches are added up in two steps: first in SLOTS slots for each part, so that no task reads those of all tasks.
    schema = "part int, counts array<bigint>"
    own = docs.select(text_of("text").alias("text")).mapInArrow(run, schema).withColumn("slot", F.spark_partition_id() % SKETCH_SLOTS)
    rows = own.repartition("part", "slot").drop("slot").mapInArrow(add, schema).repartition("part").mapInArrow(add, schema).collect()
    out, n = np.zeros((parts, SKETCH_PART), dtype=np.int64), 0
    for part, counts in rows:
        if part < 0:
            n += counts[0]
        else:
            out[part] += np.array(counts)
    return out.reshape(SKETCH_ROWS, SKETCH_CELLS), n


def _parts(numbers: list[int], counts: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *map(len, counts)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), lists], names=["part", "counts"])


class Weights:
    """Shingles' grid numbers and weights from the sketch."""

    def __init__(self, sketch: np.ndarray, documents: int, settings: Settings):
        self.settings = settings
        noise = (sketch.sum(axis=1, keepdims=True) - sketch) / (SKETCH_CELLS - 1)
        middle = np.median(sketch, axis=1, keepdims=True)
        deviation = 1.4826 * np.median(np.abs(sketch - middle), axis=1, keepdims=True)
        self.clean = np.where(sketch - noise > STANDS_OUT * deviation, np.maximum(sketch - noise, 1.0), 1.0)
        self.documents = max(documents, 1)
        steps = 1 + settings.strength * np.arange(IDF_STEPS) / (IDF_STEPS - 1)
        self.grid = (steps[:, None] * TF_WEIGHTS[None, :]).ravel()

    def frequencies(self, h: np.ndarray) -> np.ndarray:
        return np.minimum.reduce([self.clean[r][_cells(h, r)] for r in range(SKETCH_ROWS)]) if len(h) else np.zeros(0)

    def of(self, h: np.ndarray, tf: np.ndarray) -> np.ndarray:
        idf = np.log((1 + self.documents) / (1 + np.minimum(self.frequencies(h), self.documents))) / np.log(1 + self.documents)
        return np.rint(idf * (IDF_STEPS - 1)).astype(np.intp) * len(TF_WEIGHTS) + np.searchsorted(TF_BOUNDS, tf, side="right")

    def vector(self, text: str | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, tf = shingles(word_hashes(text), self.settings.words)
        return h, self.grid[self.of(h, tf)]

    def prefix(self, text: str | np.ndarray) -> np.ndarray:
        """The rarest shingles, up to where the others weigh less than the threshold's share of all.

        Two texts at the threshold have that share of either one's weight in common, so the first shingle that both have, in
        this order of all shingles, is in both prefixes.
        """
        h, w = self.vector(text)
        order = np.lexsort((h, self.frequencies(h)))
        behind = w.sum() - np.cumsum(w[order])
        return h[order[: 1 + int((behind >= (self.settings.threshold - 1e-6) * w.sum()).sum())]]

    @functools.cached_property
    def variates(self) -> np.ndarray:
        """The samples' keys ln a of improved consistent weighted sampling, as sortable integers in the upper 32 bits: [grid number, class, sample]."""
        s = self.settings
        rng = np.random.Generator(np.random.PCG64(20240101))
        shape = (s.variate_classes, s.bands * s.rows)
        r, c, beta = rng.gamma(2.0, 1.0, shape), rng.gamma(2.0, 1.0, shape), rng.random(shape)
        out = np.empty((len(self.grid), *shape), dtype=np.uint64)
        for g, w in enumerate(self.grid):
            t = np.floor(np.log(w) / r + beta)
            key = (np.log(c) - r * (t - beta) - r).astype(np.float32).view(np.int32).astype(np.int64)
            key = np.where(key >= 0, key + 0x80000000, 0xFFFFFFFF - (key & 0xFFFFFFFF))
            out[g] = key.astype(np.uint64) << _U(32)
        return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    common = np.minimum(wa[i], wb[j]).sum()
    return float(common / (wa.sum() + wb.sum() - common))


def common_weights(left: list, right: list, columns: int = 4096) -> np.ndarray:
    """For each text of left and each of right, the summed minima of the weights of their common shingles.

    A text is (shingles, weights). A shingle's minimum is the sum over the weights' levels that both reach, so the minima of
    all pairs are a product of matrices; columns of them are dense at a time, and memory doesn't grow with the texts.
    """
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    sides = []
    for texts in (left, right):
        row = np.repeat(np.arange(len(texts)), [len(h) for h, _ in texts])
        sides.append((row, np.concatenate([h for h, _ in texts]), np.concatenate([w for _, w in texts])))
    (lr, lh, lw), (rr, rh, rw) = sides
    both = np.intersect1d(lh, rh)
    if not len(both):
        return out

    def known(row, h, w):
        at = np.searchsorted(both, h)
        at[at == len(both)] = 0
        yes = both[at] == h
        order = np.argsort(at[yes], kind="stable")
        return row[yes][order], at[yes][order], w[yes][order]

    (lr, la, lw), (rr, ra, rw) = known(lr, lh, lw), known(rr, rh, rw)
    # A shingle of one text on either side is one number; most shingles of edited copies are.
    single = (np.bincount(la, minlength=len(both)) == 1) & (np.bincount(ra, minlength=len(both)) == 1)
    np.add.at(out, (lr[single[la]], rr[single[ra]]), np.minimum(lw[single[la]], rw[single[ra]]))
    place, count = np.cumsum(~single) - 1, int((~single).sum())
    (lr, la, lw), (rr, ra, rw) = ((row[~single[at]], place[at[~single[at]]], w[~single[at]]) for row, at, w in ((lr, la, lw), (rr, ra, rw)))
    for low in range(0, count, columns):
        l, r = (slice(*np.searchsorted(at, (low, low + columns))) for at in (la, ra))
        level = 0.0
        for top in np.unique(np.concatenate([lw[l], rw[r]])):
            x = np.zeros((len(left), min(columns, count - low)), dtype=np.float32)
            y = np.zeros((len(right), x.shape[1]), dtype=np.float32)
            for m, row, at, w, part in ((x, lr, la, lw, l), (y, rr, ra, rw, r)):
                reach = w[part] >= top
                m[row[part][reach], at[part][reach] - low] = 1
            some = x.any(axis=0) & y.any(axis=0)
            if some.any():
                out += (top - level) * (x[:, some] @ y[:, some].T)
            level = top
    return out


def _joining(left, right, common: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float]]:
    """Of all pairs at the threshold or above, those that join classes which are not joined yet. A side is (uids, classes, vectors)."""
    (lu, lc, lv), (ru, rc, rv) = left, right
    lw, rw = (np.array([w.sum() for _, w in v]) for v in (lv, rv))
    # The product's rounding is of no account here: what it finds near the threshold is measured again.
    near = common >= (threshold - 1e-6) * (lw[:, None] + rw[None, :] - common)
    near &= np.asarray(lc)[:, None] != np.asarray(rc)[None, :]
    head: dict[int, int] = {}

    def root(c: int) -> int:
        while head.get(c, c) != c:
            head[c] = head.get(head[c], head[c])
            c = head[c]
        return c

    for i, j in zip(*np.nonzero(near)):
        a, b = root(lc[i]), root(rc[j])
        if a != b and (s := weighted_jaccard(lv[i], rv[j])) >= threshold:
            head[max(a, b)] = min(a, b)
            yield lu[i], ru[j], s


def split_groups(members: DataFrame, texts: DataFrame, weights, settings: Settings) -> DataFrame:
    """members(group, uid, class) of large groups, each text in the group of every shingle of its prefix that several classes have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        for batch in batches:
            found = [own.prefix(t).view(np.int64) for t in raw_texts(batch.column("text"))]
            at = np.repeat(np.arange(len(found)), list(map(len, found)))
            columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("group", "uid", "class")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))], names=["group", "uid", "class", "shingle"])

    given = members.join(texts, "uid").select("group", "uid", "class", "text")
    spread = staged(given.mapInArrow(run, "group bigint, uid bigint, class bigint, shingle bigint").withColumn("group", F.xxhash64("group", "shingle")).drop("shingle"), "prefixes")
    mixed = spread.groupBy("group").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("group")
    return spread.join(staged(mixed, "mixed-prefixes"), "group")


def block_links(members: DataFrame, texts: DataFrame, weights, settings: Settings) -> DataFrame:
    """Links (a, b, similarity) between classes in groups: members(group, uid, class).

    Each text outside its group's largest class meets every text of the group in one block; blocks are hashed slots of about
    settings.block texts and at most about settings.block_bytes a side, each a row group of its own, so a hot group is spread
    over tasks.
    """
    counts = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    if (counts.agg(F.max("n")).first()[0] or 0) > settings.split:
        large = staged(counts.where(F.col("n") > settings.split).select("group"), "large-groups")
        members = members.join(large, "group", "left_anti").unionByName(split_groups(members.join(large, "group", "left_semi"), texts, weights, settings))
    members = staged(members.join(texts.select("uid", F.octet_length("text").alias("bytes")), "uid"), "block-members")
    by_class = members.groupBy("group", "class").agg(F.count(F.lit(1)).alias("k"), F.sum("bytes").alias("bytes"))
    sums = by_class.groupBy("group").agg(F.sum("k").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("k", "class", "bytes")).alias("most"))
    slots = lambda n, size: F.greatest(F.ceil(n / settings.block), F.ceil(size / settings.block_bytes)).cast("int")
    columns, rows = slots(F.col("n"), F.col("bytes")), slots(F.col("n") - F.col("most.k"), F.col("bytes") - F.col("most.bytes"))
    sizes = staged(sums.where("n > most.k").select("group", F.col("most.class").alias("main"), columns.alias("columns"), rows.alias("rows")), "block-sizes")
    sized = members.drop("bytes").join(sizes, "group")
    sized = sized.join(texts, "uid").select("group", "uid", "class", "text", (F.col("class") != F.col("main")).alias("outside"), "rows", "columns")
    slot = lambda n, k: F.pmod(F.xxhash64("uid", F.lit(k)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.where("outside").select("group", slot("rows", 1).alias("r"), every("columns").alias("c"), F.lit(True).alias("is_row"), "uid", "class", "text")
    right = sized.select("group", every("rows").alias("r"), slot("columns", 2).alias("c"), F.lit(False).alias("is_row"), "uid", "class", "text")

    def run(table: pa.Table) -> pa.Table:
        own = weights.value
        is_row = np.array(table.column("is_row").to_pylist(), dtype=bool)
        sides = []
        for mask in (is_row, ~is_row):
            part = table.filter(pa.array(mask))
            sides.append((part.column("uid").to_pylist(), part.column("class").to_pylist(), [own.vector(t) for chunk in part.column("text").chunks for t in raw_texts(chunk)]))
        found = list(_joining(*sides, common_weights(sides[0][2], sides[1][2]), settings.threshold)) if all(s[0] for s in sides) else []
        columns = list(zip(*found)) if found else [(), (), ()]
        a, b = np.array(columns[0], dtype=np.int64), np.array(columns[1], dtype=np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "similarity": np.array(columns[2], dtype=np.float64)})

    return left.unionByName(right).groupBy("group", "r", "c").applyInArrow(run, "a bigint, b bigint, similarity double")


def signatures(docs: DataFrame, weights, settings: Settings) -> DataFrame:
    """doc_id, prints, words (128-bit hash of the word list) and bands (one 64-bit hash each) for each row of docs."""
    kept = [docs.schema[c] for c in ("doc_id", "print1", "print2")]
    schema = T.StructType([*kept, T.StructField("words", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        table = own.variates
        flat = table.reshape(-1, table.shape[2])
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            for a, b in in_runs(texts, 4_000_000):
                names, bands = [], []
                for text in texts[a:b]:
                    w = word_hashes(text)
                    names.append(hashlib.blake2b(w.tobytes(), digest_size=16).digest())
                    h, tf = shingles(w, settings.words)
                    if not len(h):
                        bands.append([])
                        continue
                    at = own.of(h, tf) * settings.variate_classes + (h % _U(settings.variate_classes)).astype(np.intp)
                    low = h >> _U(32)
                    best = None
                    for k in range(0, len(h), 256):
                        part = flat[at[k : k + 256]]
                        part |= low[k : k + 256, None]
                        least = np.minimum.reduce(part, axis=0)
                        best = least if best is None else np.minimum(best, least)
                    with np.errstate(over="ignore"):
                        s = best.reshape(settings.bands, settings.rows)
                        acc = np.arange(1, settings.bands + 1, dtype=np.uint64) * _GOLD
                        for c in range(settings.rows):
                            acc = _mix(acc ^ s[:, c]) * _GOLD
                    bands.append(acc.view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name).slice(a, b - a) for f in kept], pa.array(names, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=schema.names)

    return docs.mapInArrow(run, schema)


def verified(pairs: DataFrame, texts: DataFrame, weights, settings: Settings) -> DataFrame:
    """pairs(a, b) with their exact similarity; a text travels once for each pair it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last = weights.value, (None, None)
        for batch in batches:
            out = []
            for a, x, y in zip(batch.column("a").to_pylist(), raw_texts(batch.column("x")), raw_texts(batch.column("y"))):
                if last[0] != a:
                    last = a, own.vector(x)
                out.append(weighted_jaccard(last[1], own.vector(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])

    x, y = texts.select(F.col("uid").alias("a"), F.col("text").alias("x")), texts.select(F.col("uid").alias("b"), F.col("text").alias("y"))
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, similarity double")


def components(links: DataFrame) -> DataFrame:
    """uid, class: the smallest uid that links(a, b) connect it with. Links are drawn to ever smaller neighbours until only stars are left."""
    links = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def stars() -> bool:
        """Has every node either one smaller neighbour that has none itself, or none? Then the smaller ones are the classes."""
        ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e")).select("e.*")
        nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
        return nodes.where("ups > 1 or (ups = 1 and least = 0)").count() == 0

    while not stars():
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large-least")
        large = staged(both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        # small star: smaller neighbours, and the node itself, go to the smallest of them
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "small-least")
        fresh = staged(large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "small-star")
        dropped(links, nearest, large, least)
        links = fresh
    return links.select(F.col("u").alias("uid"), F.col("v").alias("class"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), class_size, kept (one row of each class) for each row of docs(doc_id, text)."""
    spark = docs.sparkSession
    source = docs.select("doc_id", text_of("text").alias("text"))
    sketch, n = frequency_sketch(source, settings)
    weights = spark.sparkContext.broadcast(Weights(sketch, n, settings))
    # A row's number is fixed when the signatures are written. Its text is found again by two hashes of the row, not by
    # the number, which another scan might deal out otherwise.
    prints = [F.xxhash64("doc_id", "text").alias("print1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("print2")]
    signed = signatures(source.select("doc_id", "text", *prints), weights, settings).withColumn("uid", F.monotonically_increasing_id())
    signed = staged(signed, "signatures")
    # What is joined back to the rows it was counted from is written first here and below: as it comes from the aggregation,
    # it would bind the rows of a hot key to one task.
    firsts = staged(signed.groupBy("words").agg(F.min("uid").alias("rep")), "first-of-words")
    rows = staged(signed.select("uid", "doc_id", "words", "print1", "print2").join(firsts, "words").drop("words"), "same-words")

    places = signed.join(rows.where("uid = rep").select("uid"), "uid", "left_semi").select("uid", F.posexplode("bands").alias("band", "hash")).select("uid", F.xxhash64("band", "hash").alias("bucket"))
    sizes = staged(places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("first"), F.min(F.struct(F.xxhash64("uid", "bucket").alias("o"), "uid")).alias("other")).where("n > 1"), "bucket-sizes")
    members = staged(places.join(sizes, "bucket").select("bucket", "uid", "n", "first", F.col("other.uid").alias("other")), "buckets")
    wanted = rows.join(members.select("uid").distinct(), "uid", "left_semi").select("uid", "print1", "print2")
    texts = source.select("text", *prints).join(wanted, ["print1", "print2"]).groupBy("uid").agg(F.first("text").alias("text"))
    texts = staged(texts, "candidate-texts")

    def sorted_pairs(rows: DataFrame, leader: str) -> DataFrame:
        return rows.where(F.col("uid") != F.col(leader)).select(F.least(leader, "uid").alias("a"), F.greatest(leader, "uid").alias("b"))

    # First round: everyone with the smallest of the bucket, which is the same one in all bands of a group.
    first = staged(verified(sorted_pairs(members, "first").distinct(), texts, weights, settings), "compared")
    linked = F.col("similarity") >= settings.threshold
    labels = first.where(linked).groupBy(F.col("b").alias("uid")).agg(F.min("a").alias("label"))
    # Second round, for texts that have no leader in common yet: all pairs of small buckets; in larger ones, one leader
    # drawn for each bucket, so that a text meets another one in every band.
    small = members.where(F.col("n").between(3, settings.whole_bucket)).select("bucket", "uid")
    inside = small.select("bucket", F.col("uid").alias("a")).join(small.select("bucket", F.col("uid").alias("b")), "bucket").where("a < b").select("a", "b")
    pairs = inside.unionByName(sorted_pairs(members.where(F.col("n") > settings.whole_bucket), "other")).distinct()
    of = lambda c: labels.select(F.col("uid").alias(c), F.col("label").alias(f"label_{c}"))
    pairs = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where("coalesce(label_a, a) <> coalesce(label_b, b)").select("a", "b")
    second = staged(verified(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"), texts, weights, settings), "compared-again")
    links = first.unionByName(second).where(linked).select("a", "b")
    classes = components(links)
    # Third round: large buckets that still hold several classes.
    inside = staged(members.where(F.col("n") > settings.whole_bucket).select("bucket", "uid").join(classes, "uid", "left").select("bucket", "uid", F.coalesce("class", "uid").alias("class")), "inside")
    mixed = inside.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min("uid").alias("first")).where("low <> high").select("bucket", "first")
    mixed = staged(inside.join(mixed, "bucket").select("uid", "class", "first").distinct(), "mixed")
    if not mixed.isEmpty():
        groups = components(mixed.select(F.col("first").alias("a"), F.col("uid").alias("b"))).select("uid", F.col("class").alias("group"))
        third = staged(block_links(mixed.select("uid", "class").distinct().join(groups, "uid", "left").withColumn("group", F.coalesce("group", "uid")), texts, weights, settings), "block-links")
        if not third.isEmpty():
            classes = components(links.unionByName(third.select("a", "b")))
    out = rows.join(classes.withColumnRenamed("uid", "rep"), "rep", "left").select("uid", "doc_id", F.coalesce("class", "rep").alias("class"))
    best = staged(out.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "uid")).alias("best"), F.count(F.lit(1)).alias("class_size")), "classes")
    return out.join(best, "class").select("doc_id", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("uid") == F.col("best.uid")).alias("kept"))

