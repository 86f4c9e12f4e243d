"""Discovery: data sets' metadata, checked as relations, to one record for each episode."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.config import Config
from marquetry.functions import geometry as G
from marquetry.functions import identity as I
from marquetry.functions import text as X
from marquetry.operators import splits as S
from marquetry.operators.manifests import duplicates
from marquetry.sources import files as IO

EPISODE = "episode_index bigint, length bigint, tasks array<string>, split string"
DEFAULT_TEMPLATE = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"


class DiscoveryError(ValueError):
    """The metadata breaks a rule; the first violations are in the message."""


@dataclass
class Discovered:
    sources: DataFrame
    records: DataFrame


def _demand(violations: DataFrame, rule: str) -> None:
    """Fail closed: an action on the violations themselves, as an unused check column would be pruned."""
    found = violations.limit(5).collect()
    if found:
        raise DiscoveryError(f"{rule}: " + "; ".join(str(r.asDict()) for r in found))


def _source(root: str, view: str) -> dict[str, Any]:
    """One data set's checked info file."""
    info = IO.read_object(Path(root) / "meta/info.json")
    for name in ("source_id", "domain"):
        value = info.get(name)
        if not isinstance(value, str) or not value or value != value.strip():
            raise DiscoveryError(f"{root}: {name} must be trimmed text")
    features = info.get("features")
    if not isinstance(features, dict):
        raise DiscoveryError(f"{root}: features must be an object")
    keys = [k for k, f in features.items() if isinstance(f, dict) and f.get("dtype") == "video" and not k.endswith("_sim") and (k == view or k.rsplit(".", 1)[-1] == view)]
    if len(keys) != 1:
        raise DiscoveryError(f"{root}: view {view} is {'ambiguous' if keys else 'unavailable'}")
    paired = features.get(keys[0] + "_sim")
    if not isinstance(paired, dict) or paired.get("dtype") != "video":
        raise DiscoveryError(f"{root}: the paired view of {keys[0]} is unavailable")
    shape = features[keys[0]].get("shape")
    if not (isinstance(shape, list) and len(shape) == 3 and all(type(x) is int and x > 0 for x in shape) and shape[2] == 3):
        raise DiscoveryError(f"{root}: the shape of {keys[0]} must be [height, width, 3]")
    chunks, fps = info.get("chunks_size", 1000), info.get("fps")
    if type(chunks) is not int or chunks < 1 or type(fps) not in (int, float) or not 0 < fps < float("inf"):
        raise DiscoveryError(f"{root}: chunks_size and fps must be positive")
    robot = info.get("robot_type")
    robot = robot.strip() or None if isinstance(robot, str) else None
    return {
        "root": root, "source_id": info["source_id"], "dataset_name": Path(root).name, "domain": info["domain"], "robot_type": robot, "fps": float(fps), "chunks_size": chunks, "video_key": keys[0],
        "real_view": view, "real_frame_height": shape[0], "real_frame_width": shape[1], "video_path": info.get("video_path") or DEFAULT_TEMPLATE, "splits": info.get("splits") or {},
    }


_SOURCE = "root string, source_id string, dataset_name string, domain string, robot_type string, fps double, chunks_size int, video_key string, real_view string, real_frame_height int, real_frame_width int, video_path string"


def _selectors(sources: list[dict]) -> list[tuple[str, str, str]]:
    out = []
    for s in sources:
        for name in set(s["splits"]) & set(S.SPLITS):
            value = s["splits"][name]
            if isinstance(value, list) and all(type(x) is int and x >= 0 for x in value):
                value = ",".join(map(str, value))
            if not isinstance(value, str):
                raise DiscoveryError(f"{s['root']}: info.splits.{name} must be a selector or a list of indices")
            if value:
                out.append((s["source_id"], name, value))
    return out


#: Says in a record's metadata that nothing was known beside the data set's own fields (a fixed key).
EVIDENCE = "metadata_evidence"


def prompt_metadata() -> F.Column:
    """What a request tells of an episode beside its task: robot type, subtasks and supplemental metadata, each only where there is some."""
    supplemental = F.when(F.col("supplemental") != "{}", F.col("supplemental"))
    parts = [("robot_type", F.to_json(F.array("robot_type"))), ("subtasks", F.when(F.col("subtasks") != "[]", F.col("subtasks"))), ("supplemental_metadata", supplemental)]
    shown = []
    for name, value in parts:
        value = F.regexp_replace(value, r"^\[|\]$", "") if name == "robot_type" else value
        there = F.col("robot_type").isNotNull() if name == "robot_type" else value.isNotNull()
        shown.append(F.when(there, F.concat(F.lit(f'"{name}":'), value)))
    return F.concat(F.lit("{"), F.concat_ws(",", *shown), F.lit("}"))


def _manifest(path: str | None, kind: str, only: bool = False) -> list[dict]:
    """A manifest's rows: JSON lines, a list, one object, or an object with the rows under `kind`; with `only`, JSON lines or an object of exactly that key."""
    import json

    if path is None:
        return []
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".jsonl"):
        rows = [json.loads(x) for x in text.splitlines() if x.strip()]
    else:
        value = json.loads(text)
        if only and not (isinstance(value, dict) and set(value) == {kind} and isinstance(value[kind], list)):
            raise DiscoveryError(f"{path}: must be an object of exactly {kind}")
        rows = value if isinstance(value, list) else value[kind] if isinstance(value, dict) and kind in value else [value]
    if not all(isinstance(r, dict) for r in rows):
        raise DiscoveryError(f"{path}: rows must be objects")
    return rows


def discover(spark: SparkSession, config: Config, episodes: str | None = None, limit: int | None = None) -> Discovered:
    """Records of the selected episodes, in order of data set and file; every rule on all rows is checked first."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or more")
    infos = [_source(r, config.dataset.real_view.strip()) for r in IO.dataset_roots(config.dataset.root, config.dataset.dataset_glob)]
    ids = [s["source_id"] for s in infos]
    if len(set(ids)) != len(ids):
        raise DiscoveryError("source_id must be unique among data sets")
    names = [c.split()[0] for c in _SOURCE.split(", ")]
    sources = spark.createDataFrame([tuple(s[n] for n in names) for s in infos], _SOURCE)

    rows = IO.json_lines(spark, {s["source_id"]: f"{s['root']}/meta/episodes.jsonl" for s in infos}, EPISODE).withColumnRenamed("key", "source_id")
    empty = sources.join(rows, "source_id", "left_anti").select("root")
    _demand(empty, "a data set without episodes")
    _demand(rows.filter("episode_index is null or episode_index < 0").select("source_id", "line"), "episode_index must be a whole number from 0")
    _demand(rows.filter(F.col("length").isNull() | (F.col("length") < config.dataset.min_episode_frames)).select("source_id", "line", "length"), "an episode that is too short")
    _demand(duplicates(rows, "source_id", "episode_index"), "episode_index must be unique in its data set")

    intervals = S.selector_intervals(spark.createDataFrame(_selectors(infos), "source_id string, split string, selector string"))
    _demand(intervals.filter("not valid").select("source_id", "split", "part"), "info.splits has a malformed component")
    assigned = _manifest(config.dataset.split_manifest, "assignments", True)
    if config.dataset.split_manifest and (not assigned or any(set(a) != {"domain", "split"} or a["split"] not in S.SPLITS for a in assigned)):
        raise DiscoveryError("split assignments must be rows of exactly domain and split")
    external = spark.createDataFrame([(a["domain"], a["split"]) for a in assigned], "domain string, external string")
    _demand(duplicates(external, "domain"), "a domain with several assignments")
    _demand(external.join(sources, "domain", "left_anti").select("domain"), "an assigned domain without data set")

    held = S.splits_by_interval(rows, intervals).join(F.broadcast(sources), "source_id").join(F.broadcast(external), "domain", "left")
    split, problem = S.resolve(F.col("split"), F.col("info_splits"), F.col("external"))
    placed = held.withColumn("problem", problem).withColumn("split", split)
    _demand(placed.filter("problem is not null").select("source_id", "line", "problem"), "an episode whose split is not one")
    _demand(placed.groupBy("domain").agg(F.countDistinct("split").alias("n")).filter("n > 1"), "a domain that mixes splits")

    chosen = S.selected(placed, episodes)
    if limit is not None:
        chosen = chosen.orderBy("root", "line").limit(limit)
    task = X.clean_text(F.try_element_at("tasks", F.lit(1)))
    chosen = chosen.withColumn("task", task)
    _demand(chosen.filter("task is null or task = ''").select("source_id", "line"), "an episode without task")
    path = G.video_path(F.col("video_path"), F.col("video_key"), F.col("episode_index"), F.col("chunks_size"))
    chosen = chosen.withColumn("relative", path)
    _demand(chosen.filter(~G.stays_inside(F.col("relative"))).select("source_id", "relative"), "a video path that leaves its data set")

    extra = _manifest(config.dataset.metadata_manifest, "samples")
    if any("split" in r or not isinstance(r.get("sample_id"), str) for r in extra):
        raise DiscoveryError("metadata rows need a sample_id and must not set split")
    free = lambda r, *but: I.canonical({k: v for k, v in r.items() if k not in ("sample_id", *but)})
    metadata = spark.createDataFrame([(r["sample_id"], free(r), free(r, EVIDENCE)) for r in extra], "sample_id string, metadata string, supplemental string")
    _demand(duplicates(metadata, "sample_id"), "a sample with several metadata rows")
    labels = _labels(spark, infos)
    records = (
        chosen.withColumn("sample_id", I.sample_id(F.col("source_id"), F.col("episode_index")))
        .join(metadata, "sample_id", "left")
        .join(labels, ["source_id", "episode_index"], "left")
        .select(
            "sample_id", "source_id", "dataset_name", "domain", F.col("root").alias("dataset_root"), "line", "episode_index", F.col("length").alias("episode_length"), "split", "fps", "robot_type", "task",
            F.coalesce("subtasks", F.lit("[]")).alias("subtasks"), "real_view", "real_frame_height", "real_frame_width", F.concat_ws("/", "root", "relative").alias("real_video"), "metadata", F.coalesce("supplemental", F.lit("{}")).alias("supplemental"),
        )
    )
    absent = records.select("sample_id", "real_video").mapInArrow(_absent, "sample_id string, real_video string")
    _demand(absent, "a video that is not there")
    if episodes is None and limit is None:
        _demand(metadata.join(records, "sample_id", "left_anti").select("sample_id"), "metadata for an unknown sample")
    return Discovered(sources, records)


def _absent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose video file does not exist, or lies outside its data set behind a link."""
    for batch in batches:
        there = pa.array([Path(v).is_file() for v in batch.column("real_video").to_pylist()], pa.bool_())
        yield batch.filter(pa.compute.invert(there))


def _labels(spark: SparkSession, infos: list[dict]) -> DataFrame:
    """Subtasks of each episode as JSON; the last entry wins, malformed ones are skipped, the file is optional."""
    paths = {s["source_id"]: f"{s['root']}/labels/labels.json" for s in infos}
    whole = IO.whole_files(spark, paths).select(F.col("key").alias("source_id"), F.try_parse_json("value").alias("v"))
    entries = whole.select("source_id", F.posexplode(F.try_variant_get("v", "$.labels", "array<variant>")).alias("pos", "e"))
    index = F.when(F.schema_of_variant(F.try_variant_get("e", "$.episode_index", "variant")) == "BIGINT", F.try_variant_get("e", "$.episode_index", "bigint"))
    out = entries.select("source_id", "pos", index.alias("episode_index"), F.to_json(F.try_variant_get("e", "$.subtasks", "variant")).alias("subtasks"))
    good = out.filter("episode_index is not null and subtasks like '[%'")
    return good.groupBy("source_id", "episode_index").agg(F.max_by("subtasks", "pos").alias("subtasks"))


def inspect(found: Discovered, show: int = 5) -> dict[str, Any]:
    """Counts by data set, domain and split in one pass, and the first records."""
    sets = found.records.groupingSets([["dataset_name"], ["domain"], ["split"], []], "dataset_name", "domain", "split").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).collect()
    pick = lambda name, bit: {r[name]: r["n"] for r in sets if r["g"] == bit}
    first = found.records.orderBy("dataset_root", "line").limit(show).select("sample_id", "split", "task").collect()
    return {"episodes": next((r["n"] for r in sets if r["g"] == 7), 0), "datasets": pick("dataset_name", 3), "domains": pick("domain", 5), "splits": {s: 0 for s in S.SPLITS} | pick("split", 6), "first": [r.asDict() for r in first]}
