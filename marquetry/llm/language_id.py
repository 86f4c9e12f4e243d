"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to four bytes inside words holds how often which byte
followed. A byte's probability in its longest context is count / (total + kinds); a byte not seen
there escapes, at kinds / (total + kinds), to the context one byte shorter, and at last to one in
256. The statistics are frozen after training, so a text's code length under a language is exact
and is the sum over its words; each distinct word of a slice is scored once. The language with the
shortest code wins; the score is its posterior share among the languages.

Words are runs of ASCII letters and bytes above 127, lower-cased in ASCII and Latin-1. Training takes
at most SAMPLE documents of each language, in order of a hash of doc_id; that bound is a parameter.

Texts that are null or hold no letter are `und` with score 0, as is everything where nothing could be
learned. Repeated rows give repeated results; extra columns pass through `predict` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquetry.llm.chunks import strings
from marquetry.llm.common import slices, utf8

ORDER = 4
#: Labelled documents that are learned from, for each language.
SAMPLE = 600
#: Rows of two values that are sent to all tasks at most; with more of them (labels of over a thousand languages) the texts are shuffled.
SENT_ROWS = 1_000_000
NONE = "und"
SLICE = 2_000_000
SPACE = 0x20
_ASCII = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_INSIDE = _ASCII | (np.arange(256) >= 0x80)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words in order, each ended by a space; the number of words and of ASCII letters of each text."""
    data, offsets = utf8(texts)
    if not len(data):
        none = np.zeros(len(texts), np.int64)
        return pa.array([], pa.large_string()), none, none
    inside = _INSIDE[data]
    low = _LOWER[data]
    upper = np.zeros(len(data), bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[upper] += 32
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    first = inside & np.concatenate([[True], ~inside[:-1] | opens[1:-1]])
    last = inside & np.concatenate([~inside[1:] | opens[1:-1], [True]])
    # Every word's bytes, and a space after its last one.
    many = inside.astype(np.int64) + last
    ends = np.cumsum(many)
    out = np.full(int(ends[-1]), SPACE, np.uint8)
    out[(ends - many)[inside]] = low[inside]
    starts = (ends - many)[first]
    letters = np.concatenate([[0], np.cumsum(_ASCII[data])])
    words = strings(out, starts, np.append(starts[1:], len(out))) if len(starts) else pa.array([], pa.large_string())
    return words, np.diff(np.searchsorted(np.flatnonzero(first), offsets)), letters[offsets[1:]] - letters[offsets[:-1]]


class Model:
    """Frozen context trees of all languages, as sorted arrays for each order."""

    def __init__(self, counts: dict[str, dict[str, int]], order: int = ORDER):
        """counts: for each language its words (as `words_of` gives them) and how often they stood."""
        self.order, self.languages = order, sorted(counts)
        seen = [self._grams(list(counts[lang]), np.fromiter(counts[lang].values(), np.int64)) for lang in self.languages]
        self.grams, self.logs, self.contexts, self.escapes = [], [], [], []
        for k in range(order + 1 if seen else 0):
            grams = np.unique(np.concatenate([s[k][0] for s in seen]))
            contexts = np.unique(grams >> np.uint64(8))
            logs, escapes = np.zeros((len(grams), len(seen))), np.zeros((len(contexts), len(seen)))
            shorter = self._score(grams, k - 1)
            for j, s in enumerate(seen):
                n = np.zeros(len(grams))
                n[np.searchsorted(grams, s[k][0])] = s[k][1]
                of = np.searchsorted(contexts, grams >> np.uint64(8))
                total, kinds = np.bincount(of, n, len(contexts)), np.bincount(of, n > 0, len(contexts))
                known = total > 0
                escapes[known, j] = np.log(kinds[known] / (total + kinds)[known])
                with np.errstate(divide="ignore", invalid="ignore"):
                    logs[:, j] = np.where(n > 0, np.log(n) - np.log((total + kinds)[of]), escapes[of, j] + shorter[:, j])
            self.grams.append(grams)
            self.logs.append(logs)
            self.contexts.append(contexts)
            self.escapes.append(escapes)

    def _keys(self, joined: np.ndarray, k: int) -> np.ndarray:
        """For each byte but the opening one, that byte and the k before it as one number."""
        keys = np.zeros(len(joined) - 1, np.uint64)
        for j in range(k + 1):
            keys[max(j - 1, 0) :] |= joined[1 if j == 0 else 0 : len(joined) - j].astype(np.uint64) << np.uint64(8 * j)
        return keys

    @staticmethod
    def _joined(words: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all words behind an opening space, each word's end, and each byte's place in its word from 1 on."""
        data, offsets = utf8(pa.array(words, pa.large_string()) if isinstance(words, list) else words)
        size = np.diff(offsets)
        place = np.arange(len(data)) - np.repeat(offsets[:-1], size) + 1
        return np.concatenate([np.array([SPACE], np.uint8), data]), offsets, place

    def _grams(self, words: list[str], times: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        joined, offsets, place = self._joined(words)
        times = np.repeat(times, np.diff(offsets))
        out = []
        for k in range(self.order + 1):
            deep = place >= k
            grams, of = np.unique(self._keys(joined, k)[deep], return_inverse=True)
            out.append((grams, np.bincount(of, times[deep], len(grams))))
        return out

    def _score(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Log probabilities of the last byte of each key in its context of k bytes, for each language."""
        total = np.zeros((len(keys), len(self.languages)))
        todo = np.arange(len(keys))
        while k >= 0 and len(todo):
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            here = keys[todo] & mask
            at = np.minimum(np.searchsorted(self.grams[k], here), len(self.grams[k]) - 1)
            hit = self.grams[k][at] == here
            total[todo[hit]] += self.logs[k][at[hit]]
            todo, context = todo[~hit], here[~hit] >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            hit = self.contexts[k][at] == context
            total[todo[hit]] += self.escapes[k][at[hit]]
            k -= 1
        total[todo] -= np.log(256)
        return total

    def word_scores(self, words: pa.Array) -> np.ndarray:
        """Log probability of each word under each language."""
        joined, offsets, place = self._joined(words)
        keys, total = self._keys(joined, self.order), np.empty((len(place), len(self.languages)))
        for k in range(self.order + 1):
            here = place == k if k < self.order else place >= k
            total[here] = self._score(keys[here], k)
        return np.add.reduceat(total, offsets[:-1]) if len(offsets) > 1 else total[:0]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, sizes, letters = words_of(texts)
        best, score = np.full(len(texts), NONE, object), np.zeros(len(texts))
        if not len(self.languages) or not len(words):
            return best.tolist(), score
        coded = words.dictionary_encode()
        by_word = self.word_scores(coded.dictionary)[coded.indices.to_numpy()]
        full = np.flatnonzero(sizes)
        logs = np.add.reduceat(by_word, (np.cumsum(sizes) - sizes)[full])
        share = np.exp(logs - logs.max(axis=1, keepdims=True))
        best[full] = np.array(self.languages, object)[logs.argmax(axis=1)]
        score[full] = 1 / share.sum(axis=1)
        for k in np.flatnonzero((sizes > 0) & (letters == 0)).tolist():
            if not any(map(str.isalpha, texts[k].as_py())):
                best[k], score[k] = NONE, 0.0
        return best.tolist(), score


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, order: int = ORDER) -> Model:
    """Learn from documents that are not held out: at most `sample` of each language.

    Their distinct words and counts (bounded by that sample) come to the driver.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).filter("lang is not null and doc_id is not null").filter(~held_out())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("doc_id", "lang").distinct().withColumn("k", rank).filter(F.col("k") <= sample).select("doc_id", "lang").toArrow()  # `sample` rows for each language
    sent = docs.sparkSession.createDataFrame(chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, sizes, _ = words_of(batch.column("text"))
            of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            lang = batch.column("lang").take(of)
            counted = pa.table([lang, words.cast(pa.string())], names=["lang", "word"]).group_by(["lang", "word"]).aggregate([([], "count_all")])
            yield from counted.rename_columns({"count_all": "n"}).select(["lang", "word", "n"]).to_batches()

    counted = known.join(F.broadcast(sent) if chosen.num_rows <= SENT_ROWS else sent, ["doc_id", "lang"]).select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    counts: dict[str, dict[str, int]] = {}
    for lang, word, n in zip(*counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toArrow().to_pydict().values(), strict=True):
        counts.setdefault(lang, {})[word] = n
    return Model(counts, order)


def predict(docs: DataFrame, model: Model, prediction: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with two more columns; docs must have neither of them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    schema = T.StructType([*docs.schema.fields, T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            best, share = shared.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(share)], names=[*batch.schema.names, prediction, score])

    return docs.mapInArrow(run, schema)


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    model = train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return predict(rows, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
