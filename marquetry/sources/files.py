"""Dataset folders, JSON and JSON lines as DataFrames; single files written atomically."""

from __future__ import annotations

import contextlib
import fnmatch
import json
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dataset_roots(root: str, patterns: str) -> list[str]:
    """The root itself if it is a data set, else its folders that match any of the comma-separated patterns, in order."""
    top = Path(root)
    if (top / "meta/info.json").is_file():
        return [str(top)]
    wanted = [p.strip() for p in patterns.split(",") if p.strip()]
    found = [d for d in sorted(top.iterdir()) if (d / "meta/info.json").is_file() and any(fnmatch.fnmatch(d.name, p) for p in wanted)]
    if not found:
        raise FileNotFoundError(f"no data set in {root} matches {patterns}")
    return [str(d) for d in found]


def read_object(path: str | Path) -> dict[str, Any]:
    value = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise ValueError(f"{path} must hold a JSON object")
    return value


def plain_path(c: Column) -> Column:
    """A local file's path from the address that Spark gives it."""
    return F.url_decode(F.replace(F.regexp_replace(c, "^file:/*", "/"), F.lit("+"), F.lit("%2B")))


def whole_files(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """files: key -> path. (key, value: the text) of those that exist, in one scan."""
    there = [(key, os.path.realpath(path)) for key, path in files.items() if os.path.exists(path)]
    if not there:
        return spark.createDataFrame([], "key string, value string")
    keys = F.broadcast(spark.createDataFrame(there, "key string, path string"))  # one row for each data set
    found = spark.read.text(sorted({path for _, path in there}), wholetext=True)
    return found.select("value", plain_path(F.col("_metadata.file_path")).alias("path")).join(keys, "path").select("key", "value")


def lines(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """files: key -> path. (key, line: counted from 1, text) of every line that is not blank; missing files have none."""
    whole = whole_files(spark, files).select("key", F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    return whole.filter(F.trim("text") != "").select("key", (F.col("line") + 1).alias("line"), "text")


def json_lines(spark: SparkSession, files: dict[str, str], schema: str, strict: bool = True) -> DataFrame:
    """(key, line, the fields of schema, text, valid). A typed reading: neither booleans nor fractions pass as whole numbers.

    strict: the first bad line of a file raises ValueError; else it is kept with valid = false.
    """
    rows = lines(spark, files)
    fields = T.StructType.fromDDL(schema).fields
    full = T.StructType([*fields, T.StructField("_bad", T.StringType())])
    parsed = rows.withColumn("_p", F.from_json("text", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    valid = F.col("_p").isNotNull() & F.col("_p._bad").isNull() & F.try_parse_json("text").isNotNull()
    out = parsed.select("key", "line", *(F.col(f"_p.{f.name}").alias(f.name) for f in fields), "text", F.coalesce(valid, F.lit(False)).alias("valid"))
    if strict and (bad := out.filter("not valid").orderBy("key", "line").first()):
        raise ValueError(f"{files[bad['key']]}:{bad['line']}: not a valid row")
    return out


def atomic_write(path: str | Path, payload: bytes) -> None:
    """Write beside the target, flush to disk, then replace it; nothing is left behind on failure."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(prefix=f".{path.name}.", dir=path.parent)
    try:
        with os.fdopen(handle, "wb") as file:
            file.write(payload)
            file.flush()
            os.fsync(file.fileno())
        if path.exists():
            os.chmod(temporary, path.stat().st_mode & 0o777)
        os.replace(temporary, path)
    except BaseException:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(temporary)
        raise


def atomic_lines(path: str | Path, lines_: Iterator[bytes]) -> None:
    """atomic_write of lines that are never held together."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(prefix=f".{path.name}.", dir=path.parent)
    try:
        with os.fdopen(handle, "wb") as file:
            for line in lines_:
                file.write(line)
            file.flush()
            os.fsync(file.fileno())
        os.chmod(temporary, path.stat().st_mode & 0o777 if path.exists() else 0o644)
        os.replace(temporary, path)
    except BaseException:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(temporary)
        raise


def remove_folder(path: str | Path) -> None:
    """A folder of the engine's own, with all in it."""
    shutil.rmtree(path, ignore_errors=True)


def canonical_text(text: str) -> bytes:
    """A line of JSON in canonical form."""
    return canonical_line(json.loads(text))


def canonical_line(value: Any) -> bytes:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode() + b"\n"


@contextlib.contextmanager
def locked(path: str | Path, shared: bool = False) -> Iterator[None]:
    """Hold a lock file; readers share it."""
    import fcntl

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a") as file:
        fcntl.flock(file, fcntl.LOCK_SH if shared else fcntl.LOCK_EX)
        try:
            yield
        finally:
            fcntl.flock(file, fcntl.LOCK_UN)


def resolve_inside(root: str | Path, relative: str) -> Path:
    """A path below root, links followed; ValueError if it leads out."""
    base = Path(root).resolve()
    path = (base / relative).resolve()
    if Path(relative).is_absolute() or not path.is_relative_to(base):
        raise ValueError(f"{relative} leads out of {root}")
    return path
