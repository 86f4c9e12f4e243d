"""Publishing: merge two manifests of a data set under a marker, and audit what is published.

Order for each data set: marker, rows of failed episodes out, images in, reference manifest, prompt
manifest, marker away. A marker left behind says that the data set is incomplete; the next publication
must cover its samples. Selected episodes without product lose their rows and images. Data sets are published side by side.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions import rules as R
from marquetry.functions import text as X
from marquetry.functions.geometry import unique
from marquetry.operators.manifests import duplicates, first_of, merge, orphans
from marquetry.sources import files as IO

PROMPTS, REFERENCES, MARKER = "meta/episodes_prompt.jsonl", "meta/reference_images.jsonl", "meta/.publishing.json"
PROMPT_ROW = "episode_index bigint, prompt string, reference_ids array<string>"
#: Data sets that are published at once.
SIDE_BY_SIDE = 8
SUFFIX = {"raw": "raw", "jpeg": "jpg"}


def picture_path(index: Column, image_format: str) -> Column:
    return F.format_string(f"Reference/episode_%06d/reference_00.{SUFFIX[image_format]}", index)


def items(product: DataFrame, image_format: str) -> DataFrame:
    """product with `item`, the published JSON of its picture."""
    item = F.struct(
        F.col("height").cast("int").alias("height"), F.col("mask_area").alias("mask_area_fraction"), F.col("mask_sha256"), F.parse_json("provenance").alias("provenance"), F.concat(F.lit("sha256:"), "sha256").alias("reference_id"),
        F.lit(R.KIND).alias("reference_kind"), picture_path(F.col("episode_index"), image_format).alias("reference_path"), F.lit(R.SCOPE).alias("scope"), F.col("sha256"), F.lit(0).alias("source_frame_index"),
        F.col("source_sha256").alias("source_frame_sha256"), F.col("real_view").alias("source_view"), F.col("width").cast("int").alias("width"),
    )
    return product.withColumn("item", F.to_json(item, {"ignoreNullFields": "false"}))


def checked(records: DataFrame, scened: DataFrame, image_format: str) -> DataFrame:
    """scened with every ok row that breaks a rule on fresh results turned into a rejected one."""
    wide = scened.join(records.select("sample_id", "episode_index", "real_view", "real_frame_height", "real_frame_width"), "sample_id")
    raw = image_format == "raw"
    size = F.col("width") * F.col("height") * 3
    decodable = (F.length("image") == size) if raw else F.col("image").startswith(F.lit(bytes([0xFF, 0xD8]))) & F.col("image").endswith(F.lit(bytes([0xFF, 0xD9])))
    height = F.when(decodable, F.col("real_frame_height")).otherwise(-1)
    sha = F.sha2("image", 256)
    broken = R.first_broken(F.parse_json("item"), F.col("masks"), sha, height, F.col("real_frame_width"))
    judged = items(wide, image_format).withColumn("_broken", F.when(F.col("status") == "ok", broken))
    bad = F.col("_broken").isNotNull()
    changed = {"status": F.when(bad, "rejected").otherwise(F.col("status")), "error_type": F.when(bad, "Unusable").otherwise(F.col("error_type")), "message": F.when(bad, F.col("_broken")).otherwise(F.col("message"))}
    return judged.select(*(changed.get(c, F.col(c)).alias(c) for c in scened.columns))


def products(records: DataFrame, prompted: DataFrame, scened: DataFrame, image_format: str = "raw") -> DataFrame:
    """Samples for which both branches succeeded, with all that publishing needs."""
    good = lambda df: df.filter("status = 'ok'")
    scenes = good(scened).select("sample_id", "image", "sha256", "source_sha256", "mask_sha256", "mask_area", "residual_area", "masks", "provenance", "width", "height")
    return items(records.join(good(prompted).select("sample_id", "prompt"), "sample_id").join(scenes, "sample_id"), image_format)


def _rows(product: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two manifests' new lines, as JSON."""
    prompts = F.to_json(F.struct("episode_index", "prompt", F.array(F.concat(F.lit("sha256:"), "sha256")).alias("reference_ids")))
    references = F.concat(F.lit('{"episode_index":'), F.col("episode_index").cast("string"), F.lit(',"references":['), F.col("item"), F.lit('],"schema_version":3}'))
    return product.select("episode_index", prompts.alias("text")), product.select("episode_index", references.alias("text"))


def _image_writer(root: str, suffix: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index, image in zip(batch.column("episode_index").to_pylist(), batch.column("image").to_pylist(), strict=True):
                folder = Path(root) / f"Reference/episode_{index:06d}"
                if image is None:
                    _clean(folder, "")
                else:
                    IO.atomic_write(folder / f"reference_00.{suffix}", image)
                    _clean(folder, f"reference_00.{suffix}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return write


def _written(df: DataFrame, path: Path) -> None:
    """A manifest's lines in order of episodes, streamed to its file."""
    ordered = df.orderBy("episode_index").select("text")
    IO.atomic_lines(path, (IO.canonical_text(r["text"]) for r in ordered.toLocalIterator()))


def marker_ids(path: Path) -> list[str]:
    """The samples of an interrupted publication; ValueError if its marker is not version 1 with a list of distinct ids."""
    value = IO.read_object(path)
    ids = value.get("sample_ids")
    if set(value) != {"version", "sample_ids"} or value["version"] != 1 or not isinstance(ids, list) or not all(isinstance(i, str) for i in ids) or len(set(ids)) != len(ids):
        raise ValueError(f"{path} is no valid marker")
    return ids


def _published(spark: SparkSession, root: str, records: DataFrame, product: DataFrame, image_format: str) -> int:
    top = Path(root)
    with IO.locked(top / "meta/.lock"):
        chosen = records.filter(F.col("dataset_root") == root).select("sample_id", "episode_index")
        own = product.filter(F.col("dataset_root") == root)
        marker = top / MARKER
        if marker.exists():
            before = spark.createDataFrame([(s,) for s in marker_ids(marker)], "sample_id string")
            if before.join(chosen, "sample_id", "left_anti").limit(1).count():
                raise ValueError(f"{root}: an interrupted publication must be covered")
        ids = sorted(r["sample_id"] for r in chosen.select("sample_id").collect())  # the marker lists this run's samples of one data set
        IO.atomic_write(marker, IO.canonical_line({"version": 1, "sample_ids": ids}))
        new_prompts, new_references = _rows(own)
        old_prompts = IO.json_lines(spark, {"p": str(top / PROMPTS)}, PROMPT_ROW).select("episode_index", "text").cache()
        old_references = IO.json_lines(spark, {"r": str(top / REFERENCES)}, "episode_index bigint").select("episode_index", "text").cache()
        for name, old in ((PROMPTS, old_prompts), (REFERENCES, old_references)):  # read before the files are replaced
            if again := duplicates(old, "episode_index").first():
                raise ValueError(f"{top / name}: several rows for episode {again['episode_index']}")
            old.count()
        # Rows of failed episodes go before their pictures do; then the new pictures come in.
        failed = chosen.join(own, "sample_id", "left_anti").select("sample_id", "episode_index")
        none = failed.limit(0).select("episode_index", F.lit(None).cast("string").alias("text"))
        if not failed.isEmpty():
            _written(merge(old_prompts, failed, none), top / PROMPTS)
            _written(merge(old_references, failed, none), top / REFERENCES)
        files = own.select("episode_index", "image").unionByName(failed.select("episode_index", F.lit(None).cast("binary").alias("image")))
        files.mapInArrow(_image_writer(root, SUFFIX[image_format]), "n long").agg(F.sum("n")).collect()
        _written(merge(old_references, chosen, new_references), top / REFERENCES)
        _written(merge(old_prompts, chosen, new_prompts), top / PROMPTS)
        old_prompts.unpersist(), old_references.unpersist()
        episodes = own.count()
        os.unlink(marker)
    return episodes


def publish(spark: SparkSession, records: DataFrame, product: DataFrame, image_format: str = "raw") -> dict[str, int]:
    """Publish all data sets; gives the numbers of data sets and episodes."""
    if bad := duplicates(product, "dataset_root", "episode_index").first():
        raise ValueError(f"several products for one episode: {bad}")
    roots = [r["dataset_root"] for r in records.select("dataset_root").distinct().orderBy("dataset_root").collect()]
    with ThreadPoolExecutor(max(1, min(SIDE_BY_SIDE, len(roots)))) as pool:
        counts = list(pool.map(lambda root: _published(spark, root, records, product, image_format), roots))
    return {"datasets": len(roots), "episodes": sum(counts)}


def _clean(folder: Path, kept: str) -> None:
    """Take out numbered reference files but the one kept; other files stay."""
    if folder.is_dir():
        for path in folder.iterdir():
            if re.fullmatch(r"reference_\d{2}\.(raw|jpg)", path.name) and path.name != kept:
                path.unlink()


def _pictures(spark: SparkSession, roots: list[str], image_format: str) -> DataFrame:
    """path, found (digest), head (two bytes), picture_height, picture_width (-1: not decodable) and size of every numbered file."""
    known = "path string, content binary"
    folders = [f"{root}/Reference" for root in roots if (Path(root) / "Reference").is_dir()]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"reference_*.{SUFFIX[image_format]}")
    every = files.load(folders).select("path", "content") if folders else spark.createDataFrame([], known)

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from marquetry.functions import images as G

        for batch in batches:
            shapes = []
            for content in batch.column("content").to_pylist():
                try:
                    shapes.append(G.decode(content).shape[:2])
                except ValueError:
                    shapes.append((-1, -1))
            h, w = (np.array([s[k] for s in shapes], np.int32) for k in (0, 1))
            content = batch.column("content")
            yield pa.RecordBatch.from_arrays([batch.column("path"), content, pa.array(h), pa.array(w)], names=["path", "content", "picture_height", "picture_width"])

    if image_format == "raw":
        every = every.withColumns({"picture_height": F.lit(-1), "picture_width": F.lit(-1)})
    else:
        every = every.mapInArrow(size, f"{known}, picture_height int, picture_width int")
    return every.select(IO.plain_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("found"), F.substring("content", 1, 2).alias("head"), "picture_height", "picture_width", F.length("content").alias("size"))


def audit(spark: SparkSession, records: DataFrame, whole: bool, show: int = 20, image_format: str = "raw") -> dict[str, Any]:
    """Check published rows against the records and the bytes on disk; every violation is collected.

    whole: the records are all of their data sets, so that rows of other episodes are errors as well.
    """
    roots = [r["dataset_root"] for r in records.select("dataset_root").distinct().orderBy("dataset_root").collect()]
    with reduce(_both, (IO.locked(Path(r) / "meta/.lock", shared=True) for r in roots)):
        return _audited(spark, roots, records, whole, show, image_format)


class _both:
    """Two contexts as one."""

    def __init__(self, a, b):
        self.a, self.b = a, b

    def __enter__(self):
        self.a.__enter__()
        try:
            self.b.__enter__()
        except BaseException as error:
            self.a.__exit__(type(error), error, error.__traceback__)
            raise

    def __exit__(self, *error):
        self.b.__exit__(*error)
        self.a.__exit__(*error)


def _audited(spark: SparkSession, roots: list[str], records: DataFrame, whole: bool, show: int, image_format: str) -> dict[str, Any]:
    errors = spark.createDataFrame([(r, None, "marker: a publication was interrupted") for r in roots if (Path(r) / MARKER).exists()], "root string, episode_index bigint, message string")
    prompts = IO.json_lines(spark, {r: f"{r}/{PROMPTS}" for r in roots}, PROMPT_ROW, strict=False)
    references = IO.json_lines(spark, {r: f"{r}/{REFERENCES}" for r in roots}, "schema_version int, episode_index bigint", strict=False)
    expected = records.select(F.col("dataset_root").alias("key"), "episode_index", "real_view", "real_frame_height", "real_frame_width")
    for name, rows in (("prompt", prompts), ("reference", references)):
        told = lambda df, message: df.select(F.col("key").alias("root"), "episode_index", F.lit(message).alias("message"))
        if whole:
            errors = errors.unionAll(told(rows.filter("not valid"), f"{name}: malformed row"))
            errors = errors.unionAll(told(rows.filter("valid").join(expected, ["key", "episode_index"], "left_anti"), f"{name}: unknown episode"))
        errors = errors.unionAll(told(duplicates(rows.filter("valid").join(expected.select("key", "episode_index"), ["key", "episode_index"]), "key", "episode_index"), f"{name}: several rows"))
    p = first_of(prompts.filter("valid"), ["key", "episode_index"], "line").select("key", "episode_index", "prompt", "reference_ids")
    r = first_of(references.filter("valid"), ["key", "episode_index"], "line").select("key", "episode_index", "schema_version", F.try_parse_json("text").alias("row"))
    sided = lambda df: df.withColumn("id", F.concat_ws("\x1f", "key", "episode_index"))
    if whole:
        alone = orphans(sided(p), sided(r), "id").select(F.substring_index("id", "\x1f", 1).alias("root"), F.substring_index("id", "\x1f", -1).cast("bigint").alias("episode_index"), F.concat(F.lit("orphan: only in the "), F.when(F.col("side") == "left", "prompt").otherwise("reference"), F.lit(" manifest")).alias("message"))
        errors = errors.unionAll(alone)
    met = expected.join(p, ["key", "episode_index"], "left").join(r, ["key", "episode_index"], "left")
    listed = F.try_variant_get("row", "$.references", "array<variant>")
    met = met.withColumn("listed", listed).withColumn("item", F.try_element_at("listed", F.lit(1)))
    hashed = _pictures(spark, roots, image_format)
    told_path = R.text(F.col("item"), "reference_path")
    met = met.withColumn("path", F.concat_ws("/", "key", told_path)).join(hashed, "path", "left")
    path = picture_path(F.col("episode_index"), image_format)
    has = F.col("row").isNotNull()
    one = F.coalesce(F.size("listed") == 1, F.lit(False))
    clean = F.col("prompt").eqNullSafe(X.normalize_prompt(F.col("prompt"))) & X.prompt_reason(F.col("prompt")).isNull()
    rows = [
        ("missing prompt row", F.col("prompt").isNull()),
        ("prompt not normal", F.col("prompt").isNotNull() & ~clean),
        ("reference ids", F.col("prompt").isNotNull() & ~F.coalesce((F.size("reference_ids") == 1) & unique(F.col("reference_ids")) & (F.trim(F.col("reference_ids")[0]) != ""), F.lit(False))),
        ("missing reference row", ~has),
        ("schema version", has & ~F.col("schema_version").eqNullSafe(3)),
        ("row fields", has & ~R.keys(F.col("row")).eqNullSafe(F.array(*map(F.lit, ["episode_index", "references", "schema_version"])))),
        ("exactly one reference", has & ~one),
        ("reference ids differ", has & one & F.col("prompt").isNotNull() & ~F.col("reference_ids").eqNullSafe(F.array(R.text(F.col("item"), "reference_id")))),
    ]
    if image_format == "raw":
        size = R.whole(F.col("item"), "width") * R.whole(F.col("item"), "height") * 3
        pictures = [("unreadable image", F.col("found").isNull()), ("image digest", F.col("found").isNotNull() & ~F.col("found").eqNullSafe(R.text(F.col("item"), "sha256"))), ("image size", F.col("found").isNotNull() & ~F.coalesce(F.col("size") == size, F.lit(False)))]
        picture = R.collected(pictures)
    else:
        picture = R.picture_rules(F.col("item"), F.col("found"), F.col("head"), F.col("picture_height"), F.col("picture_width"))
    item = R.published(F.col("item"), F.col("real_view"), F.col("real_frame_width"), F.col("real_frame_height"), path, picture)
    broken = F.concat(R.collected(rows), F.when(has & one, item).otherwise(F.array().cast("array<string>")))
    judged = met.select(F.col("key").alias("root"), "episode_index", broken.alias("broken"))
    errors = errors.unionAll(judged.select("root", "episode_index", F.explode("broken").alias("message")))
    stale = hashed.filter(~F.col("path").endswith(f"/reference_00.{SUFFIX[image_format]}")).select(F.element_at(F.split("path", "/Reference/"), 1).alias("root"), F.regexp_extract("path", r"episode_(\d+)/", 1).cast("bigint").alias("episode_index"), F.concat(F.lit("stale file "), F.substring_index("path", "/", -1)).alias("message"))
    errors = errors.unionAll(stale.join(records.select(F.col("dataset_root").alias("root"), "episode_index"), ["root", "episode_index"], "left_semi"))
    n = errors.count()
    first = [f"{e['root']}:{e['episode_index']}: {e['message']}" for e in errors.orderBy("root", "episode_index", "message").limit(show).collect()]
    counts = judged.agg(F.count("*").alias("all"), F.count_if(F.size("broken") == 0).alias("good")).first()
    return {"status": "complete" if not n else "incomplete", "error_count": n, "errors": first, "errors_truncated": n - len(first), "complete_episodes": counts["good"], "incomplete_episodes": counts["all"] - counts["good"]}
