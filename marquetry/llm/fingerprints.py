"""Document fingerprints: MinHash signatures over shingles, banded joins with Jaccard confirmed, and edit probes.

A fingerprint holds, for each of 128 universal hash permutations, 16 bits of the least hash among a
text's shingles of five words; the share of equal places estimates the Jaccard likeness of two
texts. A text without words has the fingerprint of all ones, which is like itself only.

`neighbours` gives for each document its own fingerprint and that of its text edited with the next
document's. The order is by doc_id, then hash of the text: rows are dealt by range and walked in
order; what a task lacks is the first document of the next non-empty one, so each task hands out its
first and last document and those few pairs are made afterwards.

Null texts are empty; null doc_ids come first; repeated rows follow each other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.common import scoped, shuffle_partitions, slices, stored
from marquetry.llm.near_dedup import link, node, nodes
from marquetry.llm.packed import opened, pack
from marquetry.llm.shingles import shingle_hashes, signatures

PERMUTATIONS, WORDS, PERCENT = 128, 5, 80
#: 32 bands of 4 places: a pair of likeness 0.8 shares none once in twenty million.
BANDS, ROWS = 32, 4
#: Such a pair agrees on 102 of 128 places, and on fewer than LEAST once in a million; ALIKE is what a likeness of 0.25 gives.
LEAST, ALIKE = 80, 32
PROBED = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, h long"


def fingerprint(texts: pa.Array, words: int = WORDS) -> np.ndarray:
    """One row of 16-bit places for each text."""
    hashes, sizes = shingle_hashes(texts, words)
    return signatures(hashes, sizes, PERMUTATIONS, seed=5).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    blank_a, blank_b = ((x == 0xFFFF).all(axis=1) for x in (a, b))
    return np.where(blank_a | blank_b, blank_a & blank_b, (a == b).mean(axis=1))


def _blobs(rows: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes() for x in rows], pa.binary())


def _probe(ids: list, texts: list[str], hashes: list[int], following: list[str]) -> list[pa.Array]:
    """The columns of PROBED for documents and the texts that follow them."""
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, following, strict=True)]
    own, changed, other = (fingerprint(pa.array(x, pa.large_string())) for x in (texts, edited, following))
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        _blobs(own),
        _blobs(changed),
        pa.array(likeness(own, changed)),
        pa.array(likeness(own, other)),
        pa.array(hashes, pa.int64()),
    ]


def _packed(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text, h) with packed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pack(batch.column("text")), batch.column("h")], names=["doc_id", "text", "h"])

    return rows.mapInArrow(run, "doc_id long, text binary, h long")


_NAMES = [c.split()[0] for c in PROBED.split(", ")]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Probe all documents of a task but the last; hand out the first and the last."""
    part = TaskContext.get().partitionId()
    held: tuple | None = None

    def edge(kind: int, doc: int | None, text: str, h: int) -> pa.RecordBatch:
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
        columns = [pa.array([doc], pa.int64()), *blank, pa.array([h], pa.int64()), pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "kind", "part", "text"])

    for batch in opened(batches, ["text"]):
        rows = [batch.column(c).to_pylist() for c in ("doc_id", "text", "h")]
        if held is None:
            yield edge(1, *(r[0] for r in rows))
        else:
            rows = [[x, *r] for x, r in zip(held, rows, strict=True)]
        held = tuple(r[-1] for r in rows)
        ids, texts, hashes = rows
        n = len(ids) - 1
        if n:
            more = [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.string())]
            yield pa.RecordBatch.from_arrays([*_probe(ids[:-1], texts[:-1], hashes[:-1], texts[1:]), *more], names=[*_NAMES, "kind", "part", "text"])
    if held is not None:
        yield edge(2, *held)


def neighbours(docs: DataFrame) -> DataFrame:
    """The columns of PROBED, fingerprints as bytes; one row for each row of docs."""
    spark = docs.sparkSession
    rows = _packed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h")))
    order = ["doc_id", "h"]
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    with scoped(spark):
        walked = stored(dealt.mapInArrow(_walk, f"{PROBED}, kind int, part int, text string"), keep=True)
    full = sorted(r["part"] for r in walked.filter("kind = 2").select("part").collect())  # one number for each task
    after = spark.createDataFrame(list(zip(full, full[1:] + full[:1], strict=True)), "part int, next_part int")
    lasts = walked.filter("kind = 2").select("part", "doc_id", "text", "h").join(after, "part")
    heads = walked.filter("kind = 1").select(F.col("part").alias("next_part"), F.col("text").alias("following"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(_probe(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "h", "following"))), names=_NAMES)

    seams = lasts.join(heads, "next_part").select("doc_id", "text", "h", "following").mapInArrow(pairs, PROBED)
    return walked.filter("kind = 0").select(*_NAMES).union(seams)


def _keyed(prints: DataFrame) -> DataFrame:
    """With 128 bits that stand for the fingerprint."""
    return prints.withColumn("h1", F.xxhash64("fingerprint")).withColumn("h2", F.xxhash64(F.lit(1), F.col("fingerprint")))


def _classes(prints: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """h1, h2, class_id of the fingerprints of texts with words."""
    own = ["h1", "h2"]
    texts, repeated = nodes(docs)
    blank = F.lit(bytes([255] * 2 * PERMUTATIONS))
    rows = _keyed(prints.filter(F.col("doc_id").isNotNull() & (F.col("fingerprint") != blank)).select("doc_id", node(repeated, F.col("h")).alias("node"), "fingerprint"))
    one = stored(rows.groupBy(*own).agg(F.min("doc_id").alias("least_id"), F.min("node").alias("doc_id"), F.first("fingerprint").alias("fingerprint")))
    bands = F.expr(f"explode(transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(fingerprint, b * {2 * ROWS} + 1, {2 * ROWS}))))")
    posted = one.select("doc_id", bands.alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    met = stored(posted.join(shared, "key").select("doc_id", "key", "df"))
    postings = stored(met.join(met.groupBy("doc_id").agg(F.sum("df").alias("weight")), "doc_id").select("doc_id", "key", "weight"))
    places = F.expr(f"transform(sequence(0, {PERMUTATIONS - 1}), k -> cast(conv(hex(substring(fingerprint, 2 * k + 1, 2)), 16, 10) as int))")
    held = one.join(postings.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.lit(1).alias("n_shingles"), places.alias("signature"))
    state = link(postings, held, texts, words, percent, LEAST, ALIKE)
    placed = one.join(state, F.col("doc_id") == F.col("u"), "left").select(*own, "least_id", F.coalesce("v", "doc_id").alias("root"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("class_id"))
    return stored(placed.join(least, "root").select(*own, "class_id"), keep=True)


def classed(prints: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """prints with class_id: the least doc_id reachable over links that share a band and whose full sets are confirmed.

    Equal fingerprints are joined as one node first. Rows without words or without a doc_id are alone.
    """
    with scoped(docs.sparkSession):
        found = _classes(prints, docs, words, percent)
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return _keyed(prints).join(found, ["h1", "h2"], "left").select(*prints.columns, class_id.alias("class_id"))


def near_classes(prints: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """prints (doc_id, fingerprint, h) -> doc_id, class_id, as `classed` gives it."""
    return classed(prints, docs, words, percent).select("doc_id", "class_id")
