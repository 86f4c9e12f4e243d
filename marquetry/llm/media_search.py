"""Media columns: local image descriptors find cropped or edited copies.

An image column holds portable grey or pixel maps (P5, P6). Each image is read at scales half an octave
apart; corners are local maxima of the structure tensor's response, placed between pixels, each turned to
the direction of its patch's intensity centroid and described by 256 binary tests of the smoothed patch at exact places.
Chosen bits of a descriptor are its key in each of three Hamming tables. Images post all their keys; a
query probes with those of eight scales an octave, up to twice enlarged, so that one of them lies close to a scale of its source.
Query and image meet if keys agree at two places of the image at least. They are then compared in full: descriptors
are matched by Hamming distance and the matches must agree on one rotation, scale and shift.

Equal pictures are one class, posted once. Images that share the least of their keys are bundled
under one of them and post each key once, so that a group of near copies makes no more rows than one image;
a query that meets a bundle is compared with all of it.

Descriptors that differ from a plain ramp in few tests stand for edges and shading that many pictures have; they
have no keys but count in comparisons. Null or unreadable images have no corners and match nothing; images without texture likewise.
Rows whose id is null are left out. Repeated rows are in one class; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquetry.llm.common import scoped, shuffle_partitions, slices, stored
from marquetry.llm.shingles import mix

#: Levels in an octave of images and of queries; a level's shorter side is more than LEAST_SIDE; queries are enlarged up to so many octaves.
OCTAVE, QUERY_OCTAVE, LEAST_SIDE, ENLARGED = 2, 8, 24, 1
#: A comparison takes so many scales an octave of a query.
COMPARED = 4
RADIUS, BITS = 9, 256
TABLES, KEY_BITS = 3, 96
#: A patch that differs from a plain ramp in fewer tests has no key.
LEAST_DETAIL = 72
#: Places of this many pixels count as one, when shared keys are counted and when matches agree.
PLACE = 4
#: An image is bundled under a head with which it shares SHARED of its SKETCH least keys.
SKETCH, SHARED = 8, 3
#: A match is this close at most; so many must agree, within so many pixels, for a copy.
NEAR_BITS, INLIERS, PIXELS = 24, 8, 2.5
#: Rows of two numbers that are sent to all tasks at most (64 MB); a larger side is shuffled.
SENT_ROWS = 4_000_000
#: So many images meet one copy of a query's descriptors.
GROUP = 64
KEYPOINT = np.dtype([("x", "<f4"), ("y", "<f4"), ("scale", "<f4"), ("angle", "<f4"), ("bits", "<u8", BITS // 64)])
DESCRIBED = "image_id long, sha binary, keypoints binary, keys array<long>"
FOUND = "query_id long, image_id long, inliers long, matches long, scale double, angle double"


def read_image(media: bytes | None) -> np.ndarray | None:
    """Grey values as float32, or None."""
    head = re.match(rb"P([56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s", media or b"")
    if not head:
        return None
    kind, width, height, most = map(int, head.groups())
    depth = 1 if kind == 5 else 3
    raw = np.frombuffer(media, np.uint8, offset=head.end())
    if not 0 < most < 256 or min(width, height) < 1 or len(raw) < width * height * depth:
        return None
    image = raw[: width * height * depth].reshape(height, width, depth).astype(np.float32)
    return image.mean(axis=2)


def write_image(grey: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % grey.shape[::-1] + np.clip(np.rint(grey), 0, 255).astype(np.uint8).tobytes()


def resize(stack: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned; over images in the first axis."""
    for axis, size in ((1, height), (2, width)):
        n = stack.shape[axis]
        at = np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
        low = np.minimum(at.astype(int), max(n - 2, 0))
        part = (at - low).astype(np.float32)
        shape = [1, 1, 1]
        shape[axis] = size
        part = part.reshape(shape)
        stack = stack.take(low, axis) * (1 - part) + stack.take(np.minimum(low + 1, n - 1), axis) * part
    return stack


def _blur(stack: np.ndarray, times: int = 1) -> np.ndarray:
    for _ in range(times):
        for axis in (1, 2):
            pad = [(0, 0)] * 3
            pad[axis] = (1, 1)
            wide = np.pad(stack, pad, mode="edge")
            n = stack.shape[axis]
            stack = (wide.take(range(n), axis) + 2 * stack + wide.take(range(2, n + 2), axis)) / 4
    return stack


@lru_cache(1)
def _spots() -> np.ndarray:
    return np.clip(np.random.default_rng(17).normal(0, RADIUS / 2, (2 * BITS, 2)), -RADIUS / 1.5, RADIUS / 1.5).astype(np.float32)


@lru_cache(1)
def _disc() -> np.ndarray:
    y, x = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
    return np.stack([x, y], axis=2)[x * x + y * y <= RADIUS * RADIUS].astype(np.float32)


def _sampled(wide: np.ndarray, image: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bilinear values of images at places between pixels."""
    left, top = np.floor(x).astype(np.int32), np.floor(y).astype(np.int32)
    across, down = x - left, y - top
    flat, row = wide.reshape(-1), wide.shape[2]
    at = (image[:, None] * wide.shape[1] + top) * row + left
    upper = flat[at] * (1 - across) + flat[at + 1] * across
    return upper * (1 - down) + (flat[at + row] * (1 - across) + flat[at + row + 1] * across) * down


def _corners(smooth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Image numbers and places (x, y) of the corners, between pixels by a parabola through the response."""
    gy, gx = np.gradient(smooth, axis=(1, 2))
    a, b, c = (_blur(p, 3) for p in (gx * gx, gy * gy, gx * gy))
    response = a * b - c * c - 0.05 * (a + b) ** 2
    inner = np.pad(response, ((0, 0), (1, 1), (1, 1)), constant_values=-np.inf)
    h, w = response.shape[1:]
    top = response > np.maximum(0.05 * response.max(axis=(1, 2), keepdims=True), 1e-3)
    for dy, dx in ((0, 1), (1, 0), (1, 1), (1, -1)):
        top &= (response > inner[:, 1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]) & (response >= inner[:, 1 - dy : 1 - dy + h, 1 - dx : 1 - dx + w])
    margin = RADIUS // 2
    top[:, :margin] = top[:, h - margin :] = False
    top[:, :, :margin] = top[:, :, w - margin :] = False
    image, y, x = np.nonzero(top)
    here = response[image, y, x]

    def between(before: np.ndarray, after: np.ndarray) -> np.ndarray:
        return np.clip(0.5 * (before - after) / np.minimum(before - 2 * here + after, -1e-9), -0.5, 0.5)

    return image, x + between(response[image, y, x - 1], response[image, y, x + 1]), y + between(response[image, y - 1, x], response[image, y + 1, x])


def _level(stack: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(image numbers, keypoints) of one scale of equally large images."""
    smooth = _blur(stack, 2)
    image, x, y = _corners(smooth)
    out = np.zeros(len(image), KEYPOINT)
    # Places are those of the full-size image.
    out["x"], out["y"], out["scale"] = (x + 0.5) * scale - 0.5, (y + 0.5) * scale - 0.5, scale
    pad = RADIUS + 3
    wide = np.pad(smooth, ((0, 0), (pad, pad), (pad, pad)), mode="reflect").astype(np.float32)
    disc, spots = _disc(), _spots()
    for at in range(0, len(image), 1000):  # bounds the memory of large images
        part = slice(at, at + 1000)
        i, px, py = image[part], (x[part] + pad).astype(np.float32)[:, None], (y[part] + pad).astype(np.float32)[:, None]
        patch = _sampled(wide, i, px + disc[:, 0], py + disc[:, 1])
        angle = np.arctan2(patch @ disc[:, 1], patch @ disc[:, 0])
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        values = _sampled(wide, i, px + c * spots[:, 0] - s * spots[:, 1], py + s * spots[:, 0] + c * spots[:, 1])
        out["angle"][part] = angle
        out["bits"][part] = np.packbits(values[:, :BITS] < values[:, BITS:], axis=1).view("<u8")
    return image, out


def keypoints_of(stack: np.ndarray, octave: int = OCTAVE, enlarged: int = 0) -> list[np.ndarray]:
    """Keypoints of each of equally large images, at so many scales an octave, from so many octaves above full size on."""
    found, k = [], -octave * enlarged
    while True:
        scale = 2 ** (k / octave)
        height, width = round(stack.shape[1] / scale), round(stack.shape[2] / scale)
        if min(height, width) <= LEAST_SIDE:
            break
        softened = _blur(stack, round(max(4 * np.log2(scale), scale * scale / 2))) if scale > 1 else stack
        found.append(_level(stack if k == 0 else resize(softened, height, width), scale))
        k += 1
    images = np.concatenate([i for i, _ in found] or [np.zeros(0, int)])
    points = np.concatenate([p for _, p in found] or [np.zeros(0, KEYPOINT)])
    order = np.argsort(images, kind="stable")
    return np.split(points[order], np.searchsorted(images[order], np.arange(1, len(stack))))


@lru_cache(1)
def _tables() -> np.ndarray:
    rng = np.random.default_rng(23)
    return np.stack([rng.choice(BITS, KEY_BITS, replace=False) for _ in range(TABLES)])


def keys_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of the detailed descriptors in all tables, and the place of each one's first descriptor."""
    ramp = np.packbits(_spots()[:BITS, 0] < _spots()[BITS:, 0]).view("<u8")
    points = points[np.bitwise_count(points["bits"] ^ ramp).sum(axis=1) >= LEAST_DETAIL]
    bits = np.unpackbits(np.ascontiguousarray(points["bits"]).view(np.uint8).reshape(len(points), BITS // 8), axis=1)
    words = np.packbits(bits[:, _tables()], axis=2).reshape(len(points), TABLES, KEY_BITS // 8).view("<u4").astype(np.uint64)
    keys = mix(mix(words[..., 0] | words[..., 1] << np.uint64(32)) ^ words[..., 2]) + np.arange(TABLES, dtype=np.uint64)
    places = (points["y"] // PLACE).astype(np.int32) * 65536 + (points["x"] // PLACE).astype(np.int32)
    values, first = np.unique(keys, return_index=True)
    return values.view(np.int64), np.repeat(places, TABLES)[first]


def describe(images: DataFrame, queries: bool = False) -> DataFrame:
    """images (image_id, media) -> the columns of DESCRIBED. Keys are those that a query probes with, or an image's SKETCH least ones."""
    octave, enlarged = (QUERY_OCTAVE, ENLARGED) if queries else (OCTAVE, 0)
    kept = np.array([2 ** (k / octave) for k in range(-octave * enlarged, 16 * octave, octave // COMPARED if queries else 1)], np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 30_000 if queries else 300_000):
            media = batch.column("media").to_pylist()
            grey = [read_image(x) for x in media]
            points: list = [np.zeros(0, KEYPOINT)] * len(grey)
            for shape in {g.shape for g in grey if g is not None}:
                same = [k for k, g in enumerate(grey) if g is not None and g.shape == shape]
                for k, p in zip(same, keypoints_of(np.stack([grey[k] for k in same]), octave, enlarged), strict=True):
                    points[k] = p
            keys = [keys_of(p)[0] for p in points]
            if not queries:
                keys = [np.sort(mix(k.view(np.uint64)))[:SKETCH].view(np.int64) for k in keys]
            columns = [
                pa.array([hashlib.sha256(m or b"").digest() for m in media], pa.binary()),
                pa.array([p[np.isin(p["scale"], kept)].tobytes() for p in points], pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("image_id"), *columns], names=[c.split()[0] for c in DESCRIBED.split(", ")])

    rows = images.select(F.col("image_id").cast("long").alias("image_id"), F.col("media").cast("binary").alias("media"))
    return rows.filter("image_id is not null").mapInArrow(run, DESCRIBED)


def postings(held: DataFrame) -> DataFrame:
    """image_id, key, place of every key of described images."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "keypoints", 300_000):
            found = [keys_of(np.frombuffer(p, KEYPOINT)) for p in batch.column("keypoints").to_pylist()]
            ids = batch.column("image_id").take(pa.array(np.repeat(np.arange(len(found)), [len(k) for k, _ in found])))
            keys, places = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.int64()), pa.array(places, pa.int32())], names=["image_id", "key", "place"])

    return held.select("image_id", "keypoints").mapInArrow(run, "image_id long, key long, place int")


#: Cells of a comparison's matrix that are held at once.
CELLS = 1_000_000


def _nearest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each descriptor the nearest one of the other side, and how many bits differ."""
    best, far = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    step = max(1, CELLS // len(right))
    for at in range(0, len(left), step):
        bits = sum(np.bitwise_count(left["bits"][at : at + step, None, k] ^ right["bits"][None, :, k]).astype(np.int16) for k in range(BITS // 64))
        best[at : at + step] = bits.argmin(axis=1)
        far[at : at + step] = bits.min(axis=1)
    return best, far


def agree(left: np.ndarray, right: np.ndarray) -> tuple[int, int, float, float]:
    """(inliers, matches, scale, angle) of the best similarity that takes left's keypoints to right's."""
    if not len(left) or not len(right):
        return 0, 0, 1.0, 0.0
    best, far = _nearest(left, right)
    good = np.flatnonzero(far <= NEAR_BITS)
    if not len(good):
        return 0, 0, 1.0, 0.0
    a, b = left[good], right[best[good]]
    p, q = a["x"] + 1j * a["y"], b["x"] + 1j * b["y"]
    factors = b["scale"] / a["scale"] * np.exp(1j * (b["angle"] - a["angle"]))
    within = PIXELS * np.maximum(a["scale"], b["scale"])
    # Each match proposes a transform; the one that most others fit is then fitted to all of those.
    fitting, step = np.zeros(len(good), np.int64), max(1, CELLS // len(good))

    def fits(of: slice) -> np.ndarray:
        return np.abs(factors[of, None] * (p[None] - p[of, None]) + q[of, None] - q[None]) <= 2 * within[None]

    for at in range(0, len(good), step):
        fitting[at : at + step] = fits(slice(at, at + step)).sum(axis=1)
    top = int(fitting.argmax())
    chosen, factor = fits(slice(top, top + 1))[0], factors[top]
    for _ in range(3):
        if chosen.sum() < 2:
            break
        x, y = p[chosen] - p[chosen].mean(), q[chosen] - q[chosen].mean()
        if not (np.abs(x) ** 2).sum():
            break
        factor = (np.conj(x) * y).sum() / (np.abs(x) ** 2).sum()
        shift = q[chosen].mean() - factor * p[chosen].mean()
        chosen = np.abs(factor * p + shift - q) <= within
    # Several scales may describe one place: places count once.
    places = {(round(float(z.real) / PLACE), round(float(z.imag) / PLACE)) for z in q[chosen]}
    return len(places), len(good), float(abs(factor)), float(np.angle(factor))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def _classes(described: DataFrame) -> DataFrame:
    """image_id, class_id: the least id of equal pictures."""
    ids = described.select("image_id", "sha")
    return ids.join(ids.groupBy("sha").agg(F.min("image_id").alias("class_id")), "sha").select("image_id", "class_id").distinct()


def _heads(described: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each class."""
    others = stored(classes.filter("image_id <> class_id").select("image_id").distinct())
    return described.join(_few(others), "image_id", "left_anti").dropDuplicates(["image_id"]) if not others.isEmpty() else described


def _bundles(held: DataFrame) -> DataFrame:
    """image_id, bundle, of the images that are bundled with others: each goes to the head of most of its least keys."""
    sketched = held.select("image_id", F.explode("keys").alias("key"))
    shared = sketched.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    met = stored(sketched.join(shared, "key"))
    ranked = met.join(met.groupBy("image_id").agg(F.sum("m").alias("weight")), "image_id")
    heads = ranked.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), F.col("image_id").alias("head"))).alias("h"))
    votes = met.join(heads, "key").groupBy("image_id", F.col("h.head").alias("head")).agg(F.count("*").alias("votes")).filter(F.col("votes") >= SHARED)
    chosen = votes.groupBy("image_id").agg(F.max(F.struct("votes", (-F.col("head")).alias("low"))).alias("v")).select("image_id", (-F.col("v.low")).alias("bundle"))
    chosen = stored(chosen)
    return chosen.join(chosen.groupBy("bundle").agg(F.count("*").alias("m")).filter("m > 1").select("bundle"), "bundle").select("image_id", "bundle")


def _met(asked: DataFrame, held: DataFrame) -> DataFrame:
    """(a: a query, b: an image) that agree on keys at two places of the image, or of its bundle."""
    probes = stored(asked.select(F.col("image_id").alias("a"), F.explode("keys").alias("key")))
    bundles = stored(_bundles(held))
    sent, posted = _few(probes), postings(held)
    # An image alone is met if two of its places are; a bundle posts each key once, with the least and the greatest of its places.
    alone = posted.join(_few(bundles.select("image_id")), "image_id", "left_anti").join(sent, "key").groupBy("a", F.col("image_id").alias("b"))
    alone = alone.agg(F.min("place").alias("low"), F.max("place").alias("high")).filter("low < high").select("a", "b")
    together = posted.join(_few(bundles), "image_id").groupBy("key", "bundle").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    together = together.join(sent, "key").groupBy("a", "bundle").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high")
    return alone.union(together.join(bundles, "bundle").select("a", F.col("image_id").alias("b")))


def search(queries: DataFrame, images: DataFrame, least: int = INLIERS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """queries, images (image_id, media) -> the columns of FOUND for every pair of classes with `least` agreeing places, and image_id, class_id of queries and of images."""
    spark = images.sparkSession
    with scoped(spark):
        every_query, every_image = stored(describe(queries, True)), stored(describe(images))
        query_classes, image_classes = stored(_classes(every_query), keep=True), stored(_classes(every_image), keep=True)
        asked, held = _heads(every_query, query_classes), _heads(every_image, image_classes)
        pairs = stored(_met(asked, held))
        counted = stored(pairs.groupBy("a").agg(F.count("*").alias("m")))
        right = pairs.join(_few(counted), "a").select(F.col("a").alias("query_id"), F.expr(f"pmod(xxhash64(b), ceil(m / {GROUP}))").alias("salt"), F.col("b").alias("image_id"))
        left = counted.select(F.col("a").alias("query_id"), F.expr(f"explode(sequence(0L, cast(ceil(m / {GROUP}) as bigint) - 1))").alias("salt"))
        left = asked.select(F.col("image_id").alias("query_id"), "keypoints").join(_few(stored(left)), "query_id").select("query_id", "salt", F.lit(0).alias("kind"), F.col("query_id").alias("image_id"), "keypoints")
        right = held.select("image_id", "keypoints").join(_few(stored(right)), "image_id").select("query_id", "salt", F.lit(1).alias("kind"), "image_id", "keypoints")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query, own = None, None
            for batch in batches:
                out = []
                for a, kind, b, points in zip(*(batch.column(c).to_pylist() for c in ("query_id", "kind", "image_id", "keypoints")), strict=True):
                    points = np.frombuffer(points, KEYPOINT)
                    if kind == 0:
                        query, own = a, points
                    elif a == query and (told := agree(own, points))[0] >= least:
                        out.append((a, b, *told))
                kinds = (pa.int64(),) * 4 + (pa.float64(),) * 2
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], names=[c.split()[0] for c in FOUND.split(", ")])

        dealt = left.union(right).repartition(shuffle_partitions(spark), "query_id", "salt").sortWithinPartitions("query_id", "salt", "kind")
        found = stored(dealt.mapInArrow(run, FOUND), keep=True)
    return found, query_classes, image_classes


# The tables hold no pictures: these make them from the vectors of `embeddings`.

SIDE, GRID = 96, 18
#: The edits of the queries: parts cut off, light changed, resized by any factor, turned, and noise.
EDITS = ["crop", "brighten", "shrink 17/24", "crop and fade", "shrink 0.9", "shrink 0.75", "shrink 0.6", "shrink 0.4", "enlarge 1.5", "turn 10", "turn 30", "turn 90", "small crop", "noise"]


@lru_cache(4)
def _mixing(n: int) -> np.ndarray:
    return np.random.default_rng(29).normal(0, 1, (GRID * GRID, n)).astype(np.float32)


def picture(vector: list[float] | None) -> np.ndarray | None:
    """A smooth grey picture whose control points are fixed mixtures of a vector's values: near vectors look alike."""
    values = np.array([x or 0.0 for x in vector or []], np.float32)
    if not len(values):
        return None
    points = _mixing(len(values)) @ values / max(float(np.linalg.norm(values)), 1e-9)
    return np.clip(resize(points.reshape(1, GRID, GRID), SIDE, SIDE)[0] * 55 + 128, 0, 255)


def turned(grey: np.ndarray, degrees: float, cut: int) -> np.ndarray:
    """Turned about its centre; `cut` pixels are cut off on each side."""
    h, w = grey.shape
    y, x = (p - c for p, c in zip(np.mgrid[cut : h - cut, cut : w - cut], ((h - 1) / 2, (w - 1) / 2), strict=True))
    c, s = np.cos(np.deg2rad(degrees)), np.sin(np.deg2rad(degrees))
    x, y = np.clip(c * x + s * y + (w - 1) / 2, 0, w - 1.001), np.clip(c * y - s * x + (h - 1) / 2, 0, h - 1.001)
    shape = x.shape
    return _sampled(grey[None].astype(np.float32), np.zeros(1, int), x.reshape(1, -1), y.reshape(1, -1)).reshape(shape)


def edited(grey: np.ndarray, kind: str, seed: int = 0) -> np.ndarray:
    h, w = grey.shape
    name, *value = kind.rsplit(" ", 1)
    if name in ("shrink", "enlarge"):
        top, _, bottom = value[0].partition("/")
        factor = float(top) / float(bottom or 1)
        return resize(grey[None], round(h * factor), round(w * factor))[0]
    if name == "turn":
        return np.rot90(grey) if value == ["90"] else turned(grey, float(value[0]), h // 9 if value == ["10"] else h * 3 // 16)
    if kind == "noise":
        return grey + np.random.default_rng(seed).normal(0, 6, grey.shape)
    if kind == "brighten":
        return grey * 1.1 + 12
    if kind == "small crop":
        return grey[h // 3 : h // 3 + h // 2, w // 5 : w // 5 + w // 2]
    cut = grey[h // 6 : h - h // 8, w // 8 : w - w // 6]
    return cut if kind == "crop" else cut * 0.8 + 20


def pictures(vectors: DataFrame, edit: bool = False) -> DataFrame:
    """vectors (vec_id, embedding) -> image_id, media; edited by turns of vec_id div 50 if asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                grey = [picture(v) for v in part.column("embedding").to_pylist()]
                if edit:
                    grey = [g if g is None else edited(g, EDITS[i // 50 % len(EDITS)], i & 0xFFFFFFFF) for g, i in zip(grey, part.column("vec_id").to_pylist(), strict=True)]
                media = [None if g is None else write_image(g) for g in grey]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(media, pa.binary())], names=["image_id", "media"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).filter("vec_id is not null")
    return rows.mapInArrow(run, "image_id long, media binary")


def copies(vectors: DataFrame) -> DataFrame:
    """Edited pictures of the rows whose vec_id is divisible by 50, searched among the pictures of all rows.

    kind, id, class_id, edit, inliers, scale, angle. `image` rows give every vec_id's class, the least vec_id of equal
    pictures, and `query` rows that of every query; `match` rows are pairs of a query class (id) and a class of images that it matches.
    """
    found, query_classes, image_classes = search(pictures(vectors.filter("vec_id % 50 = 0"), True), pictures(vectors))
    edit = F.element_at(F.array(*map(F.lit, EDITS)), (F.floor(F.col("id") / 50) % len(EDITS) + 1).cast("int"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("inliers", "long"), ("scale", "double"), ("angle", "double"))]
    members = lambda df, kind: df.select(F.lit(kind).alias("kind"), F.col("image_id").alias("id"), "class_id", *none)
    matches = found.select(F.lit("match").alias("kind"), F.col("query_id").alias("id"), F.col("image_id").alias("class_id"), "inliers", "scale", "angle")
    rows = members(image_classes, "image").union(members(query_classes, "query")).union(matches)
    return rows.withColumn("edit", F.when(F.col("kind") != "image", edit)).select("kind", "id", "class_id", "edit", "inliers", "scale", "angle")
