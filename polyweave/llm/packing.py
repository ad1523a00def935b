"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

Every task packs the documents it reads, block by block, so no shuffle is needed and a lost executor repeats its own blocks
only. In a block, documents longer than a sequence, which have to be cut anyway, are cut into full sequences and a rest, and
some of those sequences are left in their rests (SPARE of the shorter documents' tokens). The tokens of the shorter documents
and the rests decide how many further sequences there are: as many full ones as they fill, and sequences of powers of two for
what is left, so nothing is padded. The shorter documents, in descending order, go to the sequence of lowest estimated cost
(linear plus quadratic attention cost of each piece) that has room. The rests, in descending order, follow and fill the gaps;
they are cut where they fit nowhere whole, and a shorter document only where no gap is left that holds it.

Defined results: null text counts as empty and has one token, the closing id; null doc_id and repeated rows are packed like
others; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import text_of

#: Estimated cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Tokens of long documents held back to fill gaps, for each token of shorter ones.
SPARE = 0.25
CLOSING = struct.pack("<I", 0)


def capacities(tokens: int, size: int) -> list[int]:
    rest = tokens % size
    return [size] * (tokens // size) + [1 << b for b in range(size.bit_length(), -1, -1) if rest >> b & 1]


def plan(lengths: list[int], size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for each piece; sequences are numbered from 0."""
    sequence, rests = 0, []
    spare = SPARE * sum(n for n in lengths if n <= size)
    for d, n in enumerate(lengths):
        full = n // size * size if n > size else 0
        while full and n - full < spare:
            spare -= size
            full -= size
        for start in range(0, full, size):
            yield d, start, size, sequence, 0
            sequence += 1
        if n > full:
            spare -= n - full if n > size else 0
            rests.append((n > size, n - full, d, full))
    rests.sort(key=lambda x: (x[0], -x[1], x[2]))
    rests = [x[1:] for x in rests]
    room = np.array(capacities(sum(n for n, _, _ in rests), size), dtype=np.int64)
    whole, cost = room.copy(), np.zeros(len(room))
    for n, d, start in rests:
        while n:
            fits = room >= n
            if not fits.any():
                fits = room > 0
            k = int(np.where(fits, cost, np.inf).argmin())
            put = min(n, int(room[k]))
            yield d, start, put, sequence + k, int(whole[k] - room[k])
            room[k] -= put
            cost[k] += LINEAR * put + QUADRATIC * put * put
            n, start = n - put, start + put


def pack(docs: DataFrame, tokenizer_file: str, size: int = 1024, block_tokens: int = 1_000_000) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit) for each piece."""
    long = T.LongType()
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, long) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(tokenizer_file, "tokenizers")
        sequence = TaskContext.get().partitionId() << 36
        keys, ids, tokens = [], [], 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence, tokens
            lengths = [len(x) // 4 for x in ids]
            rows = list(plan(lengths, size))
            d, start, length, of, offset = (list(c) for c in zip(*rows))
            columns = [pa.array([keys[i] for i in d], key_type), pa.array(start), pa.array(length), pa.array([lengths[i] for i in d]), pa.array([sequence + s for s in of]), pa.array(offset)]
            columns.append(pa.array([ids[i][4 * a : 4 * (a + n)] for i, a, n, _, _ in rows], pa.binary()))
            sequence += max(of) + 1
            keys.clear(), ids.clear()
            tokens = 0
            return pa.RecordBatch.from_arrays([c.cast(pa.int64()) if 0 < i < 6 else c for i, c in enumerate(columns)], names=schema.names)

        for batch in batches:
            key_type = batch.column("doc_id").type
            texts, own = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for a, b in bpe.in_runs(texts):
                for key, x in zip(own[a:b], codec.encode_plain(texts[a:b])):
                    keys.append(key)
                    ids.append(x + CLOSING)
                    tokens += len(x) // 4 + 1
                    if tokens >= block_tokens:
                        yield packed()
        if ids:
            yield packed()

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(run, schema)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
