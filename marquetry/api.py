"""The engine's three operations: inspect, run, audit."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.config import Config, load_config, overridden
from marquetry.functions import geometry as G
from marquetry.functions import identity as I
from marquetry.functions import text as X
from marquetry.operators import branches as B
from marquetry.operators import caching as C
from marquetry.operators import publish as P
from marquetry.operators.discover import discover, inspect, prompt_metadata
from marquetry.sources import files as IO
from marquetry.sources import video as V

#: The answer budget that older keys were made with, beside the configured one (a fixed value).
BUDGET_BEFORE = 1024
#: Rows of the run report's list of errors; the failures' folder has all.
SHOWN = 100


class RunFailed(RuntimeError):
    """The first failure of a run with fail_fast."""


class Engine:
    """generator, scener: picklable factories of the adapters; decode: an opener of Containers or (video) -> all frames, by default of raw blobs."""

    def __init__(self, spark: SparkSession, config: Config | str | Path, generator: Callable[[], B.Generator] | None = None, scener: Callable[[], B.Scener] | None = None, decode: Callable[[str], Any] = V.RawVideo, names: tuple[str, str] = ("injected", "injected"), **changes: Any):
        self.spark, self.generator, self.scener, self.names = spark, generator, scener, names
        self.config = overridden(config if isinstance(config, Config) else load_config(config), **changes)
        self.open = _opener(decode)

    def inspect(self, episodes: str | None = None, limit: int | None = None, show: int = 5) -> dict[str, Any]:
        return inspect(discover(self.spark, self.config, episodes, limit), show)

    def audit(self, episodes: str | None = None, limit: int | None = None, show: int = 20) -> dict[str, Any]:
        records = discover(self.spark, self.config, episodes, limit).records
        if records.isEmpty():
            raise ValueError("no episode is selected")
        return P.audit(self.spark, records, episodes is None and limit is None, show, self.config.reference.image_format)

    def _generator_identity(self, budget: int) -> str:
        c = self.config.prompt
        return I.identity({"system": c.system_prompt, "model": c.model, "provider": c.provider, "temperature": c.temperature, "max_tokens": budget, "strict": c.strict_schema, "adapter": self.names[0]})

    def _extractor_identity(self) -> str:
        return I.identity({k: v for k, v in vars(self.config.reference).items() if k != "batch_size"} | {"adapter": self.names[1]})

    def _keyed(self, records: DataFrame) -> DataFrame:
        """Both branches' cache keys; neither depends on the other's settings. A video that is not there leaves them null, with the reason."""
        c = self.config
        found = records.select("sample_id", "real_video").mapInArrow(_stat, "sample_id string, video_identity string, key_error string, key_message string")
        settings = I.identity({"frames": G.FRAMES, "resize": c.prompt.resize_long_edge, "quality": c.prompt.jpeg_quality})
        there = lambda key: F.when(F.col("video_identity").isNotNull(), key)
        budgets = dict.fromkeys([c.prompt.max_tokens, BUDGET_BEFORE])
        before = [I.prompt_key(self._generator_identity(b), settings, I.PROMPT_SCHEMA_BEFORE) for b in budgets]
        keyed = records.join(found, "sample_id").withColumn("prompt_metadata", prompt_metadata())
        keyed = keyed.withColumn("prompt_key", there(I.prompt_key(self._generator_identity(c.prompt.max_tokens), settings))).withColumn("prompt_keys_before", there(F.array(*before)))
        return keyed.withColumn("reference_key", there(I.reference_key(self._extractor_identity()))).withColumn("frames", G.uniform_frames(F.col("episode_length")))

    def _held(self, name: str, schema: str) -> DataFrame:
        path = Path(self.config.output.root) / name
        schema = f"{schema}, written long"
        return self.spark.read.schema(schema).parquet(str(path)) if path.exists() else self.spark.createDataFrame([], schema)

    def _done(self, name: str, schema: str, keyed: DataFrame, before: Column | None, force: bool) -> DataFrame:
        """Outcomes held under a sample's key, or under an older one of it; these are written again under the new key.

        Successes and final rejections count; a success whose picture does not have its digest is a miss.
        """
        columns = [c.split()[0] for c in schema.split(", ")]
        if force:
            return self.spark.createDataFrame([], schema)
        held = self._held(name, schema).filter("status in ('ok', 'rejected')")
        if "sha256" in columns:
            held = held.filter("status = 'rejected' or (sha2(image, 256) = sha256 and provenance is not null)")
        key = F.col("prompt_key" if name == "prompts" else "reference_key")
        keys = F.array(key) if before is None else F.concat(F.array(key), before)
        candidates = keyed.filter(key.isNotNull()).select("sample_id", F.posexplode(keys).alias("priority", "cache_key"))
        payload = held.groupBy("sample_id", "cache_key").agg(F.max_by(F.struct(*columns), F.coalesce("written", F.lit(0))).alias("payload"))  # the last outcome holds
        found = C.look_up(keyed.select("sample_id", key.alias("current")), candidates, payload).filter("payload is not null")
        moved = {"cache_key": F.col("current")}
        hits = found.select("migrate", *(moved.get(c, F.col(f"payload.{c}")).alias(c) for c in columns))
        if before is not None:
            again = hits.filter("migrate and status = 'ok'").select(*columns)
            if not again.isEmpty():
                self._append(name, again, schema)
        return hits.select(*columns)

    def _append(self, name: str, rows: DataFrame, schema: str) -> DataFrame:
        """Rows written once beside the checkpoints, then among them; all later reads are of the written table."""
        path = str(Path(self.config.output.root) / name)
        now = time.time_ns()
        batch = f"{path}-{now}"
        rows.write.parquet(batch)
        fresh = self.spark.read.schema(schema).parquet(batch)
        fresh.withColumn("written", F.lit(now)).write.mode("append").parquet(path)
        return fresh

    def _failing(self, fresh: DataFrame, branch: str) -> None:
        if self.config.runtime.fail_fast and (bad := fresh.filter("status <> 'ok'").orderBy("sample_id").first()):
            raise RunFailed(f"{bad['sample_id']}: {bad['step'] or branch}: {bad['error_type']}: {bad['message']}")

    def run(self, episodes: str | None = None, limit: int | None = None, force: bool = False, audit: bool = True) -> dict[str, Any]:
        began = time.monotonic()
        c = self.config
        found = discover(self.spark, c, episodes, limit)
        keyed = self._keyed(found.records).cache()
        n = keyed.count()
        if not n:
            raise ValueError("no episode is selected")
        force = force or not c.runtime.resume
        Path(c.output.root).mkdir(parents=True, exist_ok=True)
        with IO.locked(Path(c.output.root) / ".lock"):  # one run writes these checkpoints at a time
            return self._run(keyed, n, force, audit, episodes is None and limit is None, began)

    def _branches(self, keyed: DataFrame, force: bool) -> tuple[DataFrame, int, DataFrame, int]:
        """Outcomes of both branches for all records, and how many were held. What is held is never cached: an append to its folder would refresh that."""
        c = self.config
        done_prompts = self._done("prompts", B.PROMPTED, keyed, F.col("prompt_keys_before"), force)
        done_scenes = self._done("references", B.SCENED, keyed, None, force)
        hits = done_prompts.count(), done_scenes.count()
        for_prompt = keyed.join(done_prompts.select("sample_id"), "sample_id", "left_anti").select("sample_id", F.lit(True).alias("for_prompt"))
        for_scene = keyed.join(done_scenes.select("sample_id"), "sample_id", "left_anti").select("sample_id", F.lit(True).alias("for_reference"))
        wanted = for_prompt.join(for_scene, "sample_id", "full_outer").na.fill(False, ["for_prompt", "for_reference"])
        work = keyed.filter("video_identity is not null").join(wanted, "sample_id")
        lost = keyed.filter("video_identity is null")
        asked = {r["b"]: r["n"] for r in work.select(F.explode(F.array(F.when(F.col("for_prompt"), "prompt"), F.when(F.col("for_reference"), "reference"))).alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect()}
        not_ready = {branch: B.preflight(self.spark, make) if asked.get(branch) else None for branch, make in (("prompt", self.generator), ("reference", self.scener))}
        for branch, error in not_ready.items():
            if error is not None and c.runtime.fail_fast:
                raise RunFailed(f"{branch}-preflight: {type(error).__name__}: {error}")
        decode = work.withColumn("for_prompt", F.col("for_prompt") & F.lit(not_ready["prompt"] is None)).withColumn("for_reference", F.col("for_reference") & F.lit(not_ready["reference"] is None)).filter("for_prompt or for_reference")
        path = Path(c.output.root) / f"decoded-{time.time_ns()}"
        B.decoded(decode, self.open, c).write.parquet(str(path))  # one opening for both branches
        frames = self.spark.read.schema(B.DECODED).parquet(str(path))
        jobs = work.drop("frames").join(frames, "sample_id", "left")
        generator, extractor = self._generator_identity(c.prompt.max_tokens), self._extractor_identity()
        told = I.prompt_fingerprint(generator, F.col("task"), F.col("prompt_metadata"), F.col("frames"))
        prompt_jobs = jobs.filter("for_prompt").withColumn("cache_key", F.col("prompt_key")).withColumn("input_fingerprint", F.when(F.col("frames").isNotNull(), told))
        told = I.scene_fingerprint(extractor, F.col("sample_id"), F.col("real_view"), F.col("real_frame_height"), F.col("real_frame_width"), F.col("first"))
        scene_jobs = jobs.filter("for_reference").withColumn("cache_key", F.col("reference_key")).withColumn("input_fingerprint", told)

        def work_on(branch: str, name: str, schema: str, todo: DataFrame, run: Callable[[DataFrame], DataFrame], done: DataFrame) -> DataFrame:
            error = not_ready[branch]
            fresh = run(todo) if error is None else B.refused(todo, error, f"{branch}-preflight", schema)
            told = lost.select("sample_id", F.col("key_error").alias("error_type"), F.col("key_message").alias("message"))
            gone = B.refused(lost.withColumn("cache_key", F.lit(None)), RuntimeError(), f"{branch}-cache-key", schema).drop("error_type", "message").join(told, "sample_id")
            columns = [c.split()[0] for c in schema.split(", ")]
            fresh = self._append(name, fresh.unionByName(gone.select(*columns)) if not lost.isEmpty() else fresh, schema)
            self._failing(fresh, branch)
            return done.select(*columns).unionByName(fresh.select(*columns))

        with ThreadPoolExecutor(2) as both:
            a = both.submit(work_on, "prompt", "prompts", B.PROMPTED, prompt_jobs, lambda jobs: B.prompts(jobs, self.generator, c), done_prompts)
            b = both.submit(work_on, "reference", "references", B.SCENED, scene_jobs, lambda jobs: B.references(jobs, self.scener, c), done_scenes)
            prompted, scened = a.result(), b.result()
        IO.remove_folder(path)
        return prompted, hits[0], scened, hits[1]

    def _run(self, keyed: DataFrame, n: int, force: bool, audit: bool, whole: bool, began: float) -> dict[str, Any]:
        c = self.config
        prompted, prompt_hits, scened, reference_hits = self._branches(keyed, force)
        scened = P.checked(keyed, scened, c.reference.image_format)
        sentence = X.normalize_prompt(F.col("prompt"))
        reason = X.prompt_reason(sentence)
        valid = (F.col("status") == "ok") & reason.isNull()
        prompted = prompted.withColumn("message", F.when((F.col("status") == "ok") & reason.isNotNull(), reason).otherwise(F.col("message"))).withColumn("status", F.when(valid, "ok").otherwise(F.when(F.col("status") == "ok", "rejected").otherwise(F.col("status")))).withColumn("prompt", F.when(valid, sentence))
        published = P.publish(self.spark, keyed, P.products(keyed, prompted, scened, c.reference.image_format), c.reference.image_format)
        failure = lambda df, branch: df.filter("status <> 'ok'").select("sample_id", F.lit(branch).alias("stage"), F.coalesce("step", F.lit(branch)).alias("step"), "error_type", "message")
        failed = failure(prompted, "prompt").unionAll(failure(scened, "reference"))
        failures = str(Path(c.output.root) / "failures")
        failed.write.mode("overwrite").json(failures)  # all of them; the report lists the first
        failed = self.spark.read.schema("sample_id string, stage string, step string, error_type string, message string").json(failures)
        errors = [r.asDict() for r in failed.orderBy("sample_id", "stage").limit(SHOWN).collect()]
        counts = {r["branch"]: r.asDict() for r in B.accounts(prompted, scened).collect()}
        report = {
            "selected": n, "published": published["episodes"], "datasets": published["datasets"], "prompt_cache_hits": prompt_hits, "reference_cache_hits": reference_hits, "branches": counts,
            "failed_samples": failed.select("sample_id").distinct().count(), "errors": errors, "error_count": failed.count(), "failures": failures, "elapsed_seconds": round(time.monotonic() - began, 3),
        }
        rates = c.runtime.input_cost_per_million, c.runtime.output_cost_per_million
        if None not in rates and "prompt" in counts:
            report["estimated_cost"] = round(counts["prompt"]["input_tokens"] * rates[0] / 1e6 + counts["prompt"]["output_tokens"] * rates[1] / 1e6, 6)
        if audit:
            report["audit"] = P.audit(self.spark, keyed, whole, image_format=c.reference.image_format)
        complete = not errors and published["episodes"] == n and (not audit or report["audit"]["status"] == "complete")
        report["status"] = "complete" if complete else "partial"
        report["annotations_ready"] = complete and whole
        IO.atomic_write(Path(c.output.root) / os.environ.get("MARQUETRY_RUN_REPORT", "run_report.json"), json.dumps(report, indent=2, sort_keys=True).encode())
        keyed.unpersist()
        return report


def _opener(decode: Callable[[str], Any]) -> V.Opener:
    """Containers as they are; a decoder's array of all frames becomes one."""

    def open_(path: str) -> V.Container:
        found = decode(path)
        return V.ArrayVideo(found) if isinstance(found, np.ndarray) else found

    return open_


def _stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The identity of each video file: path, size, times, device and inode; where it is not there, the error."""
    for batch in batches:
        out: list[list] = [[], [], []]
        for path in batch.column("real_video").to_pylist():
            try:
                s = Path(path).stat()
                row = I.identity([path, s.st_size, s.st_mtime_ns, s.st_ctime_ns, s.st_dev, s.st_ino]), None, None
            except OSError as error:
                row = None, type(error).__name__, str(error)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column("sample_id"), *(pa.array(c, pa.string()) for c in out)], names=["sample_id", "video_identity", "key_error", "key_message"])
