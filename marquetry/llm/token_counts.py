"""Exact token counts; huge documents are encoded in overlapping chunks that are spliced again.

Both encodings of an overlap must have a token boundary at the same place, and the place must be
proven stable: a space after a visible ASCII character, which ends every pre-token (chunks.py says
why), so nothing before it depends on what follows and nothing after it on what precedes. Where an
overlap holds no such place it is widened, at last to the rest of the document.

Nulls count as empty texts; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.chunks import SPACE, ChunkTokenizer, byte_bpe
from marquetry.llm.common import slices

SLICE = 8_000_000
#: A text of more bytes is encoded in chunks of so many, with such an overlap.
CHUNK_BYTES = 65_536
OVERLAP_BYTES = 512
LIMIT = 1024
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _down(data: bytes, at: int) -> int:
    """The start of the character that holds byte `at`."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _boundaries(bpe: ChunkTokenizer, data: bytes, begin: int, end: int) -> np.ndarray:
    """Byte positions where the tokens of data[begin:end] end."""
    return begin + np.cumsum(bpe.widths[bpe.encode_one(data[begin:end].decode())])


def _stable(data: bytes, places: np.ndarray) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    places = places[places < len(data)]
    before, here = raw[places - 1], raw[places]
    return places[(here == SPACE) & (before > SPACE) & (before < 0x7F)]


def count_spliced(bpe: ChunkTokenizer, data: bytes, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> int:
    """The number of tokens of one document's UTF-8 text."""
    total, begin = 0, 0
    end = _down(data, chunk)
    left = _boundaries(bpe, data, begin, end)
    while end < len(data):
        wide, size = overlap, chunk
        while True:
            start = _down(data, max(begin + 1, end - wide))
            stop = _down(data, min(len(data), end + size))
            right = _boundaries(bpe, data, start, stop)
            common = np.intersect1d(left[(left > start) & (left < end)], right, assume_unique=True)
            if len(common := _stable(data, common)):
                cut = int(common[len(common) // 2])
                total += int(np.searchsorted(left, cut, side="right"))
                left, begin, end = right[np.searchsorted(right, cut, side="right") :], cut, stop
                break
            if start <= begin + 1:  # the overlap is all that is left of the chunk: make the chunk itself longer
                end = _down(data, min(len(data), end + size))
                size *= 2
                left = _boundaries(bpe, data, begin, end)
                if end == len(data):
                    break
            wide *= 4
    return total + len(left)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in slices(batches, "text", SLICE):
            texts = pa.compute.fill_null(batch.column("text"), "")
            size = pa.compute.binary_length(texts).to_numpy().astype(np.int64)
            huge = size > chunk
            n = np.zeros(len(size), np.int64)
            n[~huge] = bpe.count(texts.filter(pa.array(~huge)))
            for k in np.flatnonzero(huge).tolist():
                n[k] = count_spliced(bpe, texts[k].as_py().encode(), chunk, overlap)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, COUNTS)
