"""Mask algebra over columns; the vectors of `embeddings` stand in for 8 by 8 rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions import masks as K
from marquetry.plans.tables import table

SIDE, ABOVE = 8, 0.2
#: Neighbours that the 3 by 3 ellipse holds.
CROSS = K.offsets(3)


def _masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.when(x > ABOVE, 1).otherwise(0)).alias("mask"))


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set pixels of the union of four rasters each."""
    rows = _masks(spark, sf_dir).select(F.floor(F.col("vec_id") / 4).cast("bigint").alias("sample"), F.posexplode("mask").alias("p", "on"))
    union = rows.groupBy("sample", "p").agg(F.bit_or("on").alias("on"))
    return union.filter("on = 1").select("sample", (F.col("p") % SIDE).alias("x"), F.floor(F.col("p") / SIDE).cast("int").alias("y"))


def _grown(pixels: DataFrame) -> DataFrame:
    moves = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in CROSS))
    moved = pixels.withColumn("m", F.explode(moves)).select("sample", (F.col("x") + F.col("m.dx")).alias("x"), (F.col("y") + F.col("m.dy")).alias("y"))
    return moved.filter(f"x between 0 and {SIDE - 1} and y between 0 and {SIDE - 1}").distinct()


def mask_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masks(spark, sf_dir).select("vec_id", K.area(F.col("mask")).alias("area"), K.area_fraction(F.col("mask")).alias("fraction"))


def mask_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = K.bbox(F.col("mask"), SIDE)
    return _masks(spark, sf_dir).select("vec_id", *(box[k].alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


def mask_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _masks(spark, sf_dir).select("vec_id", K.mask_hash(F.col("mask")).alias("sha256"))


def mask_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(spark, sf_dir).groupBy("sample").agg(F.count("*").alias("area"), F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"))


def mask_dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grown(_pixels(spark, sf_dir))


def mask_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grown, then kept where every neighbour inside the raster is set."""
    grown = _grown(_pixels(spark, sf_dir))
    moves = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in CROSS))
    votes = grown.withColumn("m", F.explode(moves)).select("sample", (F.col("x") + F.col("m.dx")).alias("x"), (F.col("y") + F.col("m.dy")).alias("y"))
    votes = votes.filter(f"x between 0 and {SIDE - 1} and y between 0 and {SIDE - 1}").groupBy("sample", "x", "y").agg(F.count("*").alias("n"))
    inside = sum((F.when((F.col("x") + dx).between(0, SIDE - 1) & (F.col("y") + dy).between(0, SIDE - 1), 1).otherwise(0) for dx, dy in CROSS), F.lit(0))
    return votes.filter(F.col("n") == inside).select("sample", "x", "y")


def mask_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    fraction = F.col("area") / float(SIDE * SIDE)
    reason = F.when(fraction < 0.2, "small").when(fraction > 0.28, "large").otherwise("ok")
    return mask_union(spark, sf_dir).select("sample", "area", reason.alias("gate"))


def composite_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inside the mask the next vector's pixels, outside the own ones; the share of mask pixels that changed by more than the threshold."""
    grey = lambda c: F.transform(c, lambda x: F.floor(x * 100 + 128).cast("int"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", grey(F.col("embedding")).alias("source"), F.transform("embedding", lambda x: F.when(x > ABOVE, 1).otherwise(0)).alias("mask"))
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("source").alias("generated"))
    met = rows.join(other, "vec_id").select("vec_id", F.arrays_zip("source", "generated", "mask").alias("px"))
    result = F.transform("px", lambda p: F.struct(F.when(p["mask"] == 1, p["generated"]).otherwise(p["source"]).alias("out"), p["source"].alias("source"), p["mask"].alias("mask")))
    count = lambda test: F.size(F.filter("r", test)).cast("bigint")
    return met.select("vec_id", result.alias("r")).select(
        "vec_id",
        count(lambda p: p["mask"] == 1).alias("mask_pixels"),
        count(lambda p: (p["mask"] == 1) & (F.abs(p["out"] - p["source"]) > K.CHANGE)).alias("changed"),
        count(lambda p: (p["mask"] == 0) & (p["out"] != p["source"])).alias("outside_changed"),
    )


def residual_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change and residual gates on each composite: too little change, too much left, or published."""
    left = F.col("mask_pixels") / 64.0
    changed = F.col("changed") / F.greatest("mask_pixels", F.lit(1))
    gate = F.when(F.col("mask_pixels") == 0, "no mask").when(changed < 0.9, "unchanged").when(left > 0.05, "residual").otherwise("ok")
    return composite_change(spark, sf_dir).groupBy(gate.alias("gate")).agg(F.count("*").alias("n"))


def reference_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules that a published row breaks, in order, from a struct with planted faults."""
    k = F.col("vec_id") % 9
    area = K.area_fraction(F.col("mask"))
    row = _masks(spark, sf_dir).select(
        "vec_id",
        F.when(k == 1, 1).otherwise(0).alias("frame"),
        F.when(k == 2, "object").otherwise("environment").alias("scope"),
        F.when(k == 3, F.concat(F.lit("x"), F.substring(K.mask_hash(F.col("mask")), 2, 63))).otherwise(K.mask_hash(F.col("mask"))).alias("mask_sha"),
        F.when(k == 4, area + 0.01).otherwise(area).alias("told"),
        area.alias("area"),
        F.when(k == 5, F.lit(0.5)).otherwise(F.lit(0.001)).alias("residual"),
        F.when(k == 6, F.lit(False)).otherwise(F.lit(True)).alias("passed"),
        K.mask_hash(F.col("mask")).alias("sha"),
    )
    rules = [
        (F.col("frame") != 0, "frame"), (F.col("scope") != "environment", "scope"), (F.col("mask_sha") != F.col("sha"), "mask digest"), (F.abs(F.col("told") - F.col("area")) > 1e-9, "mask area"),
        ((F.col("area") <= 0) | (F.col("area") >= 1), "area range"), ((F.col("residual") <= 0.002) != F.col("passed"), "pass flag"), (~F.col("passed") | (F.col("residual") > 0.002), "residual"),
    ]
    broken = F.array_compact(F.array(*(F.when(test, F.lit(name)) for test, name in rules)))
    return row.select("vec_id", F.array_join(broken, ", ").alias("violations"), F.try_element_at(broken, F.lit(1)).alias("first"))


QUERIES = {f.__name__: f for f in (mask_area, mask_bbox, mask_hash, mask_union, mask_dilate, mask_close, mask_gate, composite_change, residual_gate, reference_rules)}
_PX = f"""with px as (
  select vec_id, i - 1 as p, case when embedding[i] > {ABOVE}::float::double then 1 else 0 end as on_ from (select vec_id, embedding, unnest(range(1, 65)) as i from embeddings)
), pixels as (select distinct vec_id // 4 as sample, (p % 8)::int as x, (p // 8)::int as y from px where on_ = 1)
, moves as (select * from (values {", ".join(f"({dx}, {dy})" for dx, dy in CROSS)}) m(dx, dy))
, grown as (select distinct sample, x + dx as x, y + dy as y from pixels, moves where x + dx between 0 and 7 and y + dy between 0 and 7)
, sums as (select vec_id, sum(on_)::int as area, min(case when on_ = 1 then p % 8 end)::int as x0, min(case when on_ = 1 then p // 8 end)::int as y0, max(case when on_ = 1 then p % 8 end)::int + 1 as x1,
  max(case when on_ = 1 then p // 8 end)::int + 1 as y1, sha256(from_hex(string_agg(case when on_ = 1 then '01' else '00' end, '' order by p))) as sha from px group by vec_id)
, unions as (select sample, count(*) as area, min(x) as x0, min(y) as y0, max(x) + 1 as x1, max(y) + 1 as y1 from pixels group by 1)
, grey as (select e.vec_id, i, floor(e.embedding[i]::float * 100::float + 128::float)::int as s, floor(n.embedding[i]::float * 100::float + 128::float)::int as g, case when e.embedding[i] > {ABOVE}::float::double then 1 else 0 end as m
  from embeddings e join embeddings n on n.vec_id = e.vec_id + 1, (select unnest(range(1, 65)) as i))
, change as (select vec_id, sum(m)::bigint as mask_pixels, count(*) filter (m = 1 and abs(g - s) > {K.CHANGE}) as changed, 0::bigint as outside_changed from grey group by 1)
"""
ORACLES = {
    "mask_area": _PX + "select vec_id, area, area / 64.0::double as fraction from sums",
    "mask_bbox": _PX + "select vec_id, x0, y0, x1, y1 from sums",
    "mask_hash": _PX + "select vec_id, sha as sha256 from sums",
    "mask_union": _PX + "select * from unions",
    "mask_dilate": _PX + "select * from grown",
    "mask_close": _PX + """select c.sample, c.x, c.y from (select distinct sample, x, y from grown) c where not exists (
  select 1 from moves where c.x + dx between 0 and 7 and c.y + dy between 0 and 7 and not exists (select 1 from grown g where g.sample = c.sample and g.x = c.x + dx and g.y = c.y + dy))""",
    "mask_gate": _PX + "select sample, area, case when area / 64.0::double < 0.2 then 'small' when area / 64.0::double > 0.28 then 'large' else 'ok' end as gate from unions",
    "composite_change": _PX + "select * from change",
    "residual_gate": _PX + """select case when mask_pixels = 0 then 'no mask' when changed / greatest(mask_pixels, 1) < 0.9 then 'unchanged' when mask_pixels / 64.0 > 0.05 then 'residual' else 'ok' end as gate, count(*) as n from change group by 1""",
    "reference_rules": _PX + """, broken as (
  select vec_id, list_filter([case when vec_id % 9 = 1 then 'frame' end, case when vec_id % 9 = 2 then 'scope' end, case when vec_id % 9 = 3 then 'mask digest' end, case when vec_id % 9 = 4 then 'mask area' end,
    case when area = 0 then 'area range' end, case when vec_id % 9 in (5, 6) then 'pass flag' end, case when vec_id % 9 in (5, 6) then 'residual' end], lambda x: x is not null) as v from sums)
select vec_id, array_to_string(v, ', ') as violations, v[1] as first from broken""",
}
