"""SentencePiece encoding and decoding through a distinct-chunk table (see chunks.py).

Nulls count as empty texts; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.chunks import by_text, piece_bpe
from marquetry.llm.common import slices

SLICE = 4_000_000
ENCODED = "doc_id long, ids array<int>, decoded string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _encoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[tuple[list, list[np.ndarray], list[str]]]:
    """(doc ids, ids with begin and end, decoded texts) of each slice."""
    sp = piece_bpe(model)
    begin, end = sp.library.bos_id(), sp.library.eos_id()
    for batch in slices(batches, "text", SLICE):
        ids, counts = sp.encode(batch.column("text"))
        whole = [np.concatenate([[begin], x, [end]]).astype("<u4") for x in by_text(ids, counts)]
        yield batch.column("doc_id"), whole, [sp.library.decode(x.tolist()) for x in whole]


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (with begin and end), decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, decoded in _encoded(batches, model):
            lists = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([doc, lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return _source(docs).mapInArrow(run, ENCODED)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encode_decode gives, hashed where it is made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, decoded in _encoded(batches, model):
            yield pa.RecordBatch.from_arrays(
                [
                    doc,
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _source(docs).mapInArrow(run, DIGESTS)
