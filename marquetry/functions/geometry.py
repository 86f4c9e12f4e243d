"""Frame sampling, sizes, paths and tolerances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRAMES = 8


def uniform_frames(n: Column, count: int = FRAMES) -> Column:
    """`count` frame numbers from 0 to n - 1, both ends in; null where there are fewer frames."""
    if count == 1:
        return F.when(n >= 1, F.array(F.lit(0).cast("bigint")))
    steps = F.sequence(F.lit(0), F.lit(count - 1))
    return F.when(n >= count, F.transform(steps, lambda p: F.bround(p * (n - 1) / F.lit(float(count - 1))).cast("bigint")))


def timestamps(frames: Column, fps: Column) -> Column:
    return F.transform(frames, lambda f: f / fps)


def resized(height: Column, width: Column, long_edge: int) -> Column:
    """(height, width) with the longer side at most long_edge; never larger than before, never below 1."""
    scale = F.least(F.lit(1.0), F.lit(float(long_edge)) / F.greatest(height, width))
    side = lambda x: F.greatest(F.lit(1), F.bround(x * scale).cast("int"))
    return F.struct(side(height).alias("height"), side(width).alias("width"))


def padding(size: Column, modulo: int) -> Column:
    """What is missing to the next multiple."""
    return F.pmod(-size, F.lit(modulo))


def view_name(key: Column) -> Column:
    return F.substring_index(key, ".", -1)


def video_path(template: Column, key: Column, index: Column, chunk: Column) -> Column:
    """A template's {video_key}, {episode_chunk:03d} and {episode_index:06d}, with plain forms as well."""
    out = F.replace(template, F.lit("{video_key}"), key)
    for name, value in (("episode_chunk", F.expr("0") + F.floor(index / chunk)), ("episode_index", index)):
        text = value.cast("bigint").cast("string")
        out = F.replace(out, F.lit(f"{{{name}}}"), text)
        for digits in (3, 6):
            padded = F.when(F.length(text) < digits, F.lpad(text, digits, "0")).otherwise(text)
            out = F.replace(out, F.lit(f"{{{name}:0{digits}d}}"), padded)
    return out


def stays_inside(path: Column) -> Column:
    """Relative, with no step that leaves its root."""
    parts = F.filter(F.split(path, "/"), lambda x: ~x.isin("", "."))
    depth = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("low")),
        lambda a, x: F.struct(
            (a["at"] + F.when(x == "..", -1).otherwise(1)).alias("at"),
            F.least(a["low"], a["at"] + F.when(x == "..", -1).otherwise(1)).alias("low"),
        ),
    )
    return ~F.startswith(path, F.lit("/")) & (path != "") & (depth["low"] >= 0)


def close_to(a: Column, b: Column, relative: float = 1e-9) -> Column:
    """Equal up to a share of the larger; two infinities of one sign are equal, NaN never is."""
    finite = ~F.isnan(a) & ~F.isnan(b) & (F.abs(a) < float("inf")) & (F.abs(b) < float("inf"))
    return F.when(finite, F.abs(a - b) <= relative * F.greatest(F.abs(a), F.abs(b))).otherwise((a == b) & ~F.isnan(a))


def near_to(a: Column, b: Column, relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    """Equal up to a share of the second and a constant, as areas of decoded masks are compared."""
    known = finite(a) & finite(b)
    return F.when(known, F.abs(a - b) <= absolute + relative * F.abs(b)).otherwise((a == b) & ~F.isnan(a))


def unique(items: Column) -> Column:
    """A list without repeats."""
    return F.size(F.array_distinct(items)) == F.size(items)


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < float("inf"))
