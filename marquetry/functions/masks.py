"""Binary masks in two forms: arrays of 0 and 1 in row order as columns, and numpy rasters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def area(mask: Column) -> Column:
    return F.aggregate(mask, F.lit(0), lambda a, x: a + x)


def area_fraction(mask: Column) -> Column:
    return area(mask) / F.size(mask)


def bbox(mask: Column, width: int) -> Column:
    """(x0, y0, x1, y1), ends exclusive; null if the mask is empty."""
    places = F.filter(F.transform(mask, lambda x, k: F.when(x == 1, k)), lambda k: k.isNotNull())
    columns = F.transform(places, lambda k: k % width)
    rows = F.transform(places, lambda k: F.floor(k / width).cast("int"))
    box = F.array(F.array_min(columns), F.array_min(rows), F.array_max(columns) + 1, F.array_max(rows) + 1)
    return F.when(F.size(places) > 0, box)


def binary_values(mask: Column) -> Column:
    """Only 0, 1 and 255 stand in a mask file."""
    return F.forall(mask, lambda x: x.isin(0, 1, 255))


def mask_broken(mask: Column, height: Column, width: Column) -> Column:
    """Why an array is no removal mask of a picture of this size; null if it is one."""
    return F.when(F.coalesce(F.size(mask) != height * width, F.lit(True)), "shape").when(~binary_values(mask), "values").when(~F.exists(mask, lambda x: x > 0), "empty")


def prediction_broken(mask: Column, box: Column, height: int, width: int) -> Column:
    """Why a predicted mask with its box is not usable: size, an empty mask, a box outside the picture, or one that is not tight."""
    inside = (box[0] >= 0) & (box[1] >= 0) & (box[0] < box[2]) & (box[1] < box[3]) & (box[2] <= width) & (box[3] <= height)
    tight = bbox(mask, width)
    return (
        F.when(F.coalesce(F.size(mask) != height * width, F.lit(True)), "size")
        .when(tight.isNull(), "empty")
        .when(~F.coalesce(inside, F.lit(False)), "box outside")
        .when(box != tight, "box not tight")
    )


def confidence(logits: Column) -> Column:
    """The mean probability over positive logits, clipped at 20; null if there is none."""
    positive = F.filter(logits, lambda x: x > 0)
    total = F.aggregate(positive, F.lit(0.0), lambda a, x: a + 1 / (1 + F.exp(-F.least(x.cast("double"), F.lit(20.0)))))
    return F.when(F.size(positive) > 0, total / F.size(positive))


def mask_hash(mask: Column) -> Column:
    """SHA-256 of the mask's bytes."""
    return F.sha2(F.unhex(F.array_join(F.transform(mask, lambda x: F.lpad(F.hex(x), 2, "0")), "")), 256)


def ellipse(size: int) -> np.ndarray:
    """A filled ellipse in a square of odd size, each row's half width rounded, as image libraries draw it; size 1 is one pixel."""
    r = size // 2
    y, x = np.mgrid[-r : r + 1, -r : r + 1]
    return np.abs(x) <= np.rint(np.sqrt(r * r - y * y)) if r else np.ones((1, 1), bool)


def offsets(size: int) -> list[tuple[int, int]]:
    y, x = np.nonzero(ellipse(size))
    return [(int(b) - size // 2, int(a) - size // 2) for a, b in zip(y, x, strict=True)]


def dilate(mask: np.ndarray, size: int) -> np.ndarray:
    """Every pixel within the ellipse of a set pixel."""
    out = np.zeros_like(mask)
    h, w = mask.shape
    for dx, dy in offsets(size):
        out[max(dy, 0) : h + min(dy, 0), max(dx, 0) : w + min(dx, 0)] |= mask[max(-dy, 0) : h + min(-dy, 0), max(-dx, 0) : w + min(-dx, 0)]
    return out


def erode(mask: np.ndarray, size: int) -> np.ndarray:
    """Pixels whose ellipse holds set pixels only; what lies outside the raster counts as set."""
    return 1 - dilate(1 - mask, size)


def close(mask: np.ndarray, size: int) -> np.ndarray:
    return erode(dilate(mask, size), size)


def removal_mask(masks: list[np.ndarray], close_kernel: int, dilation: int) -> np.ndarray:
    """The union of masks, closed, then dilated; kernel 1 and dilation 0 change nothing."""
    union = np.bitwise_or.reduce([(m > 0).astype(np.uint8) for m in masks])
    return dilate(close(union, close_kernel), 2 * dilation + 1)


def tight_box(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    y, x = np.nonzero(mask)
    return (int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1) if len(x) else None


def composite(source: np.ndarray, generated: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The generated picture inside the mask, the source elsewhere."""
    return np.where(mask[..., None] > 0, generated, source)


#: Channel differences up to this are no change (a fixed value).
CHANGE = 2


def changed_fraction(source: np.ndarray, result: np.ndarray, mask: np.ndarray) -> float:
    inside = mask > 0
    if not inside.any():
        return 0.0
    difference = np.abs(source.astype(np.int16) - result.astype(np.int16)).max(axis=2)
    return float((difference[inside] > CHANGE).mean())
