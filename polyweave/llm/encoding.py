"""Documents to token ids and back.

Defined results: null text counts as empty and has no ids; ids decode to the text's very bytes; null doc_id and repeated
rows pass through; an empty table gives an empty result; further columns are ignored. Batches are cut into stretches of
a quarter million characters, and a stretch's texts become strings when its turn comes, so memory follows the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import bpe
from .common import text_of

#: Characters of a stretch, and pieces that a worker's cache holds: several workers share an executor's memory.
STRETCH, KEPT = 250_000, 250_000


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)))


def encode_documents(docs: DataFrame, rank_file: str) -> DataFrame:
    """doc_id, ids, piece_starts (code points at which the pre-tokens start) and decoded (the bytes that the ids give)."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("piece_starts", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.codec(rank_file, own=True, kept=KEPT)
        for batch in batches:
            texts = batch.column("text")
            for a, b in bpe.runs_of(pc.utf8_length(texts).to_pylist(), STRETCH):
                packed, starts = zip(*codec.encode(texts.slice(a, b - a).to_pylist()))
                ids = [np.frombuffer(p, dtype=np.uint32) for p in packed]
                columns = [batch.column("doc_id").slice(a, b - a), _lists(ids), _lists(list(starts)), pa.array([codec.decode(i) for i in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "piece_starts", "decoded"])

    return docs.select("doc_id", text_of("text").alias("text")).mapInArrow(run, schema)
