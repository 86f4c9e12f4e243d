"""Distinct-chunk tables: each distinct marked word of a slice is segmented once, and documents gather its ids by position.

A text is cut before white space that follows a character known not to be white. For both
tokenizer families used here no piece reaches across such a place, so chunks are segmented alone:

* byte-level BPE: every alternative of the pre-tokenising pattern either takes at most one
  leading space and then only non-white characters, or white characters only. A match that holds
  a non-white character never goes on into white space, so a pre-token always ends there.
* SentencePiece with pieces split by white space: no piece has another character before a marker,
  and none holds a line feed (both are checked when the model is read).

Not cutting is always allowed, so characters whose class is in doubt count as white. The table
lives for one slice of texts: its size is bounded by the slice, and no result depends on it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa

from marquetry.llm.common import utf8

#: The pre-tokenising pattern of the byte-level vocabulary (a fixed value).
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class every Unicode version agrees; other chunks go to the reference library.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]*")
SPACE, LINE = 0x20, 0x0A


def surely_dark(data: np.ndarray) -> np.ndarray:
    """For each byte: it ends a character that no Unicode version calls white.

    These are visible ASCII, characters of two bytes from U+00C0 on, and of three from U+4000 on.
    """
    dark = (data > 0x20) & (data < 0x7F)
    tail = (data & 0xC0) == 0x80
    two = np.zeros(len(data), bool)
    two[1:] = tail[1:] & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    three = np.zeros(len(data), bool)
    three[2:] = tail[2:] & (data[:-2] >= 0xE4) & (data[:-2] <= 0xEE)
    return dark | two | three


#: Marks end a run of letters or digits, whichever pre-token that run is in.
_MARKS = np.isin(np.arange(256), list(b".,;:!?"))
_ALNUM = np.array([chr(b).isalnum() and b < 0x80 for b in range(256)])


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Adjacent spans of UTF-8 data as a string array, without copying."""
    offsets = np.concatenate([starts, ends[-1:]]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data))


class ChunkTokenizer:
    """Tokenizes slices of texts. `cuts` and `segment` are a tokenizer family's own."""

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Where a chunk may begin, as a mask over bytes; each such chunk begins with white space."""
        raise NotImplementedError

    def segment(self, chunks: pa.Array, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these chunks in order, and the number of each. first: they open their texts."""
        raise NotImplementedError

    def look_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of the distinct chunks, ids of each such chunk, row of each chunk of the texts, chunks of each text)."""
        data, offsets = utf8(texts)
        nothing = np.zeros(0, np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), nothing, nothing, np.zeros(len(texts), np.int64)
        begins = self.cuts(data)
        opens = np.zeros(len(data), bool)
        opens[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins | opens)
        ends = np.append(starts[1:], len(data))
        is_first = opens[starts]
        everything = strings(data, starts, ends)
        inner = everything.filter(pa.array(~is_first)).dictionary_encode()
        lead = everything.filter(pa.array(is_first)).dictionary_encode()
        ids, count = self.segment(inner.dictionary, False)
        lead_ids, lead_count = self.segment(lead.dictionary, True)
        rows = np.empty(len(starts), np.int64)
        rows[~is_first] = inner.indices.to_numpy()
        rows[is_first] = lead.indices.to_numpy() + len(count)
        sizes = np.diff(np.searchsorted(starts, offsets))
        return np.concatenate([ids, lead_ids]), np.concatenate([count, lead_count]), rows, sizes

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        _, count, rows, sizes = self.look_up(texts)
        return self._per_text(count[rows], sizes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        ids, count, rows, sizes = self.look_up(texts)
        begin = np.cumsum(count) - count
        many = count[rows]
        ends = np.cumsum(many)
        where = np.repeat(begin[rows] - (ends - many), many)
        where += np.arange(len(where))
        return ids[where], self._per_text(many, sizes)

    def encode_one(self, text: str) -> np.ndarray:
        return self.encode(pa.array([text]))[0]

    @staticmethod
    def _per_text(many: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(many)])
        stops = np.cumsum(sizes)
        return ends[stops] - ends[stops - sizes]


def _counts(ids: np.ndarray, widths: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many ids make up each chunk, given where chunks end as sums of widths."""
    reach = np.cumsum(widths[ids])
    stops = np.searchsorted(reach, ends, side="left") + 1
    if len(ends) and not np.array_equal(reach[stops - 1], ends):
        raise ValueError("a piece crosses a chunk boundary")
    return np.diff(stops, prepend=0)


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Put (chunk numbers, ids, counts) of several parts into chunk order."""
    count = np.zeros(total, np.int64)
    for where, _, n in parts:
        count[where] = n
    begin = np.cumsum(count) - count
    ids = np.zeros(int(count.sum()), np.uint32)
    for where, x, n in parts:
        to = np.repeat(begin[where] - (np.cumsum(n) - n), n) + np.arange(len(x))
        ids[to] = x
    return ids, count


class ByteBpe(ChunkTokenizer):
    """Ids as `tokenizers` gives them for a byte-level BPE file, special strings taken as special."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [x["content"] for x in spec["added_tokens"]]
        flags = any(x.get(f) for x in spec["added_tokens"] for f in ("lstrip", "rstrip", "single_word", "normalized"))
        if flags or any(x.isspace() for s in self.special for x in s) or any(re.search(r"[A-Za-z0-9][.,;:!?]", s) for s in self.special):
            raise ValueError("special strings that a chunk's end could cut, or that take white space with them, are not supported")
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        ranks = {bytes(map(_byte_of().__getitem__, piece)): k for piece, k in spec["model"]["vocab"].items() if piece not in self.special}
        self.fast = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(self.library.get_vocab_size(), np.int64)
        for piece, k in ranks.items():
            self.widths[k] = len(piece)
        for x in spec["added_tokens"]:
            self.widths[x["id"]] = len(x["content"].encode())

    def cuts(self, data: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data), bool)
        cut[1:] = ((data[1:] == SPACE) | (data[1:] == LINE)) & surely_dark(data)[:-1]
        cut[1:] |= _MARKS[data[1:]] & _ALNUM[data[:-1]]
        return cut

    def segment(self, chunks: pa.Array, first: bool) -> tuple[np.ndarray, np.ndarray]:
        if not len(chunks):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        parts, apart = [], np.arange(len(chunks))
        if not first:
            data, offsets = utf8(chunks)
            # A chunk that begins with a mark may only follow a letter or digit, so it is not joined to others.
            fine = surely_dark(data)[offsets[1:] - 1] & (data[offsets[:-1]] <= SPACE)
            text = data.tobytes().decode()
            if not PLAIN.fullmatch(text) or any(x in text for x in self.special):
                fine &= np.fromiter((bool(PLAIN.fullmatch(x)) and not any(s in x for s in self.special) for x in chunks.to_pylist()), bool, len(chunks))
            apart = np.flatnonzero(~fine)
            if fine.any():
                joined = chunks.filter(pa.array(fine)) if len(apart) else chunks
                data, offsets = utf8(joined)
                ids = np.array(self.fast.encode_ordinary(data.tobytes().decode()), dtype=np.uint32)
                parts.append((np.flatnonzero(fine), ids, _counts(ids, self.widths, offsets[1:])))
        if len(apart):
            found = [x.ids for x in self.library.encode_batch(chunks.take(pa.array(apart)).to_pylist(), add_special_tokens=False)]
            parts.append((apart, np.array([i for x in found for i in x], dtype=np.uint32), np.array([len(x) for x in found], np.int64)))
        return _merge(parts, len(chunks)) if len(parts) != 1 else parts[0][1:]


@lru_cache(1)
def _byte_of() -> dict[str, int]:
    """Byte-level alphabets print visible bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PieceBpe(ChunkTokenizer):
    """Ids as `sentencepiece` gives them, without begin and end."""

    MARK = "▁"
    #: Stands before a chunk so that it is not a text's first; it is one piece of its own.
    LEAD = "a"

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(k) for k in range(self.library.get_piece_size())]
        inner = [p for k, p in enumerate(pieces) if not self.library.is_control(k)]
        lead = self.library.encode(self.LEAD)
        if any(self.MARK in p.lstrip(self.MARK) or "\n" in p for p in inner) or len(lead) != 1 or self.library.encode("a a") != lead * 2:
            raise ValueError("pieces of this model cross white space; its chunks cannot be segmented alone")

    def cuts(self, data: np.ndarray) -> np.ndarray:
        mark = np.zeros(len(data), bool)
        mark[2:] = (data[2:] == 0x81) & (data[1:-1] == 0x96) & (data[:-2] == 0xE2)
        cut = np.zeros(len(data), bool)
        cut[1:] = (data[1:] == LINE) | (data[1:] == SPACE) & ~((data == SPACE) | mark)[:-1]
        return cut

    def segment(self, chunks: pa.Array, first: bool) -> tuple[np.ndarray, np.ndarray]:
        if not len(chunks):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = chunks.to_pylist()
        # One call for each chunk's text: the library's time grows faster than a text's length.
        found = self.library.encode(texts) if first else [x[1:] for x in self.library.encode([self.LEAD + t for t in texts])]
        return np.array([i for x in found for i in x], dtype=np.uint32), np.fromiter(map(len, found), np.int64, len(found))


@lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    """One tokenizer for each worker process."""
    return ByteBpe(path)


@lru_cache(2)
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)


def by_text(ids: np.ndarray, counts: Sequence[int]) -> list[np.ndarray]:
    ends = np.cumsum(counts)
    return [ids[e - n : e] for e, n in zip(ends.tolist(), counts, strict=True)]
