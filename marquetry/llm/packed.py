"""Texts as compressed bytes, so that shuffles of them take less disk: the raw size in four bytes, then zstd."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from marquetry.llm.common import SLICE_BYTES, give_back, slices

_CODEC = "zstd"


def pack(texts: pa.Array) -> pa.Array:
    """Packed texts; null counts as empty."""
    codec, out = pa.Codec(_CODEC, 1), []
    for text in texts.to_pylist():
        raw = (text or "").encode()
        out.append(len(raw).to_bytes(4, "little") + codec.compress(raw, asbytes=True))
    return pa.array(out, pa.binary())


def unpack(packed: pa.Array) -> pa.Array:
    codec = pa.Codec(_CODEC)
    raw = [codec.decompress(x[4:], int.from_bytes(x[:4], "little"), asbytes=True) if any(x[:4]) else b"" for x in packed.to_pylist()]
    return pa.array(raw, pa.large_binary()).cast(pa.large_string())


def opened(batches: Iterator[pa.RecordBatch], columns: list[str], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches with about `limit` bytes of the first column's texts (or one row), packed columns being unpacked."""
    for batch in batches:
        if not pa.types.is_binary(batch.schema.field(columns[0]).type):
            yield from slices(iter([batch]), columns[0], limit)
            continue
        sizes = np.cumsum([int.from_bytes(x[:4], "little") for x in batch.column(columns[0]).to_pylist()])
        begin = 0
        while begin < batch.num_rows:
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + limit, side="right")))
            part = batch.slice(begin, end - begin)
            arrays = [unpack(part.column(n)) if n in columns else part.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)
            give_back()
            begin = end
