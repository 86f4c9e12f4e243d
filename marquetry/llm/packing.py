"""Packing: concatenate and cut.

Pass one tokenizes each document once and writes its ids with the task's number and the running
token count inside the task. The totals of the tasks (one number each) give, as prefix sums, every
task's place in one endless sequence. Pass two cuts that sequence at multiples of the length and
returns one boundary record for each piece. Nothing is shuffled and no document is held whole
with another; the order of documents is that of the written table, so it is fixed once written.

Nulls and empty texts are packed as their end id alone; repeated rows are packed each on its own;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.chunks import byte_bpe
from marquetry.llm.common import slices, stored

LENGTH = 2048
END_ID = 1
#: Text bytes tokenized at once; larger slices repeat more of their words.
SLICE = 8_000_000
TOKENS = "doc_id long, task int, begin long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long"


def _arrow(**columns: np.ndarray | list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Ids of each document (little-endian, 16 bits where all ids fit) and its place inside its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task, done = byte_bpe(tokenizer), TaskContext.get().partitionId(), 0
        kind = _id_type(tokenizer)
        for batch in slices(batches, "text", SLICE):
            ids, counts = bpe.encode(batch.column("text"))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype(kind)
            counts = counts + 1
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends * ids.itemsize]).astype(np.int32)
            blob = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            yield _arrow(doc_id=batch.column("doc_id"), task=np.full(len(counts), task, np.int32), begin=done + ends - counts, n=counts, ids=blob)
            done += int(counts.sum())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TOKENS)


def _id_type(tokenizer: str) -> str:
    return "<u2" if len(byte_bpe(tokenizer).widths) <= 1 << 16 else "<u4"


def _padded(total: int, length: int) -> int:
    """A last sequence that fills a power of two stays as it is."""
    return total if total & (total - 1) == 0 else length


def cut(tokens: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces of the written token table."""
    totals = tokens.groupBy("task").agg(F.sum("n").alias("n")).collect()  # one row for each task of pass one
    order = sorted((r["task"], r["n"]) for r in totals)
    ends = np.cumsum([n for _, n in order]) if order else np.zeros(0, np.int64)
    base = {task: int(e) - n for (task, n), e in zip(order, ends, strict=True)}
    total = int(ends[-1]) if len(ends) else 0
    shared = tokens.sparkSession.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, at = _id_type(tokenizer), shared.value
        for batch in batches:
            out: list[list[int]] = [[] for _ in range(8)]
            for doc, task, begin, n, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "task", "begin", "n", "ids")), strict=True):
                raw = np.frombuffer(blob, kind).astype("<u4")
                place = at[task] + begin
                start = 0
                while start < n:
                    sequence, offset = divmod(place + start, length)
                    size = min(n - start, length - offset)
                    filled = min(length, total - sequence * length)
                    record = (doc, start, size, zlib.crc32(raw[start : start + size]), n, sequence, offset, length if filled == length else _padded(filled, length))
                    for column, value in zip(out, record, strict=True):
                        column.append(value)
                    start += size
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield _arrow(**{c: pa.array(x, pa.int64()) for c, x in zip(names, out, strict=True)})

    return tokens.mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length."""
    return cut(stored(tokenized(docs, tokenizer, end_id)), tokenizer, length)
