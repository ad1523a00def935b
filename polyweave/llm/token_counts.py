"""Edit-aware token counts.

For each document a segment tree over blocks of pre-tokens holds characters and tokens. Trees are kept: plant writes each as a
row (text, characters and tokens of every pre-token), and edit takes such rows with a batch of edits and gives the rows of the
edited documents, so a later batch starts from there and nothing is encoded twice. An edit re-encodes only the pre-tokens it
touches plus boundary context, and updates the sums on the paths of the blocks it changed. Pre-tokens that end two characters or
more before an edit can't change; behind it, the old pre-tokens hold again as soon as a new boundary falls on an old one. The
edits of one round, one for each document of a batch, are re-encoded together.

Defined results: null text counts as empty, null edits as none; an edit's place is cut to the text as it is then; null in an
edit counts as 0 or the empty string; null doc_id and repeated rows pass through; an empty table gives an empty result;
further columns are ignored. A document and its own edits are one row, so nothing is gathered by key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import staged, text_of

BLOCK = 64
#: Characters of context behind an edit at first; doubled until boundaries meet again.
AHEAD = 24


class Tree:
    """Pre-tokens in blocks under a binary tree of (characters, tokens)."""

    def __init__(self, pieces: list[str], counts: list[int]):
        self._build(pieces, counts)

    def _build(self, pieces: list[str], counts: list[int]) -> None:
        starts = range(0, len(pieces), BLOCK) or [0]
        self.blocks, self.counts = [pieces[i : i + BLOCK] for i in starts], [counts[i : i + BLOCK] for i in starts]
        self.width = 1 << (len(self.blocks) - 1).bit_length()
        self.chars, self.tokens = [0] * 2 * self.width, [0] * 2 * self.width
        for k, own in enumerate(self.blocks):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(map(len, own)), sum(self.counts[k])
        for k in range(self.width - 1, 0, -1):
            self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    def leaves(self) -> tuple[list[str], list[int]]:
        return [p for block in self.blocks for p in block], [n for block in self.counts for n in block]

    def find(self, at: int) -> tuple[int, int, int]:
        """The block and index of the pre-token with character number at, and where it starts."""
        k, start = 1, 0
        while k < self.width:
            k *= 2
            if start + self.chars[k] <= at:
                start += self.chars[k]
                k += 1
        block = k - self.width
        for i, p in enumerate(self.blocks[block]):
            if at < start + len(p):
                return block, i, start
            start += len(p)
        return block, max(0, len(self.blocks[block]) - 1), start - len(self.blocks[block][-1]) if self.blocks[block] else start

    def from_(self, block: int, index: int) -> Iterator[tuple[int, int, str]]:
        for b in range(block, len(self.blocks)):
            for i in range(index if b == block else 0, len(self.blocks[b])):
                yield b, i, self.blocks[b][i]

    def splice(self, a: int, i: int, b: int, j: int, new: list[str], counts: list[int]) -> None:
        """Put new, with its counts, in place of the pre-tokens from (a, i) up to before (b, j)."""
        own, numbers = self.blocks[a][:i] + new + self.blocks[b][j:], self.counts[a][:i] + counts + self.counts[b][j:]
        changed = range(a, b + 1)
        for k in changed:
            self.blocks[k], self.counts[k] = (own, numbers) if k == a else ([], [])
        if len(own) > 8 * BLOCK:
            self._build(*self.leaves())
            return
        for k in changed:
            chars, tokens = sum(map(len, self.blocks[k])), sum(self.counts[k])
            k += self.width
            chars, tokens = chars - self.chars[k], tokens - self.tokens[k]
            while k and (chars or tokens):
                self.chars[k] += chars
                self.tokens[k] += tokens
                k //= 2


def edit_all(trees: list[Tree], edits: list[tuple[int, int, str]], codec: bpe.Codec) -> list[int]:
    """Applies one edit to each tree; returns how many characters each re-encoded."""
    todo, done = [], [0] * len(trees)
    for n, (tree, (start, length, put)) in enumerate(zip(trees, edits)):
        start = min(max(start, 0), tree.chars[1])
        end = start + min(max(length, 0), tree.chars[1] - start)
        if end > start or put:
            todo.append((n, start, end, put, AHEAD + len(put)))
    while todo:
        windows = []
        for n, start, end, put, ahead in todo:
            a, i, left = trees[n].find(max(0, start - 2))
            taken, right = [], left
            last = (a, i)
            for b, j, p in trees[n].from_(a, i):
                if right >= end + ahead:
                    break
                taken.append(p)
                right += len(p)
                last = (b, j + 1)
            old = "".join(taken)
            windows.append((a, i, left, last, taken, right, old[: start - left] + put + old[end - left :]))
        again = []
        for item, (a, i, left, last, taken, right, text), (new, _) in zip(todo, windows, list(codec.pieces([w[-1] for w in windows]))):
            n, start, end, put, ahead = item
            tree = trees[n]
            whole = right == tree.chars[1]
            shift = len(put) - (end - start)
            bounds, at = {}, left
            for k, (b, j, p) in enumerate(tree.from_(a, i)):
                if k == len(taken):
                    break
                if at >= end:
                    bounds[at + shift] = (b, j)
                at += len(p)
            at, meet = left, None
            for k, p in enumerate(new):
                if at in bounds and at >= start + len(put):
                    meet = k, bounds[at]
                    break
                at += len(p)
                if not whole and at + 2 > left + len(text):
                    break
            if meet is None and not whole:
                again.append((n, start, end, put, 2 * ahead + 64))
                continue
            kept, (b, j) = meet if meet else (len(new), last)
            done[n] += sum(map(len, new[:kept]))
            tree.splice(a, i, b, j, new[:kept], [len(codec.merged[p]) >> 2 for p in new[:kept]])
        todo = again
    return done


EDITS = "array<struct<start:int,length:int,put:string>>"


def plant(docs: DataFrame, rank_file: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """A tree for each row of docs(doc_id, text): doc_id, text, and the characters and tokens of each pre-token (little-endian 32-bit numbers). Columns in keep pass through."""
    kept = ["doc_id", *keep, "text"]
    rows = docs.select("doc_id", *keep, text_of("text").alias("text"))
    schema = T.StructType([*rows.schema, *[T.StructField(c, T.BinaryType()) for c in ("piece_chars", "piece_tokens")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(rank_file)
        merged = codec.merged
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in bpe.in_runs(texts):
                chars, tokens = [], []
                for pieces, _ in codec.pieces(texts[a:b]):
                    chars.append(_packed(list(map(len, pieces))))
                    tokens.append(_packed([len(merged[p]) >> 2 for p in pieces]))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in kept], pa.array(chars, pa.binary()), pa.array(tokens, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _packed(numbers: list[int]) -> bytes:
    return np.array(numbers, dtype="<u4").tobytes()


def tree_of(text: str, chars: bytes, tokens: bytes) -> Tree:
    ends = np.cumsum(np.frombuffer(chars, dtype="<u4"), dtype=np.int64).tolist()
    return Tree([text[a:b] for a, b in zip([0, *ends], ends)], np.frombuffer(tokens, dtype="<u4").tolist())


COUNTS = ("tokens_before", "n_edits", "n_tokens", "n_chars", "reencoded_chars")


def edit(trees: DataFrame, rank_file: str, with_trees: bool = True) -> DataFrame:
    """Of trees as plant or this function gives them, with edits (array<struct<start, length, put>>): doc_id, tokens before and after the edits, one after another, and the edited trees."""
    kinds = [T.StructField("text", T.StringType()), T.StructField("piece_chars", T.BinaryType()), T.StructField("piece_tokens", T.BinaryType())] if with_trees else []
    schema = T.StructType([trees.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in COUNTS], *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(rank_file)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in bpe.in_runs(texts):
                edits, chars, tokens = (batch.column(c).slice(a, b - a).to_pylist() for c in ("edits", "piece_chars", "piece_tokens"))
                edits = [[((e["start"] or 0), (e["length"] or 0), (e["put"] or "")) for e in own or () if e] for own in edits]
                own = [tree_of(*x) for x in zip(texts[a:b], chars, tokens)]
                before, again = [t.tokens[1] for t in own], [0] * len(own)
                for r in range(max(map(len, edits))):
                    now = [n for n, todo in enumerate(edits) if r < len(todo)]
                    for n, done in zip(now, edit_all([own[n] for n in now], [edits[n][r] for n in now], codec)):
                        again[n] += done
                numbers = [before, list(map(len, edits)), [t.tokens[1] for t in own], [t.chars[1] for t in own], again]
                columns = [batch.column("doc_id").slice(a, b - a), *[pa.array(x, pa.int64()) for x in numbers]]
                if with_trees:
                    leaves = [t.leaves() for t in own]
                    columns += [pa.array(["".join(p) for p, _ in leaves]), *[pa.array(x, pa.binary()) for x in ([_packed(list(map(len, p))) for p, _ in leaves], [_packed(n) for _, n in leaves])]]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    given = trees.select("doc_id", text_of("text").alias("text"), *[F.coalesce(c, F.lit(b"")).alias(c) for c in ("piece_chars", "piece_tokens")], F.col("edits").cast(EDITS).alias("edits"))
    return given.mapInArrow(run, schema)


def edited_counts(docs: DataFrame, rank_file: str) -> DataFrame:
    """Of docs(doc_id, text, edits array<struct<start, length, put>>): tokens before and after the edits, counted on trees that are written first."""
    trees = staged(plant(docs.withColumn("edits", F.col("edits").cast(EDITS)), rank_file, keep=("edits",)), "token-trees", "zstd")
    return edit(trees, rank_file, with_trees=False)
