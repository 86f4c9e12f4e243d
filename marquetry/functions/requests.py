"""What is sent to the model that writes sentences, and what comes back.

A request is one header with the task and the robot's metadata, the answer's schema, and eight pictures with their
captions, in order. Functions on columns stand beside those that a Python worker uses.
"""

from __future__ import annotations

import base64
import json
import re
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquetry.functions.text import unfenced

#: The answer's only field, and its length at most (fixed values).
FIELD, MOST = "prompt", 800
SCHEMA = {"additionalProperties": False, "properties": {FIELD: {"maxLength": MOST, "minLength": 1, "type": "string"}}, "required": [FIELD], "type": "object"}
HEADER = "TASK AND ROBOT METADATA (authoritative):\n"
FOOTER = "\n\nThe eight frames below, in order, show how it is carried out; use them for nothing else. Answer with one sentence in the schema asked for."


def compact(value: Any) -> str:
    """JSON with sorted keys and no spaces; values that JSON lacks become text."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


def schema_text() -> str:
    return "Answer with one JSON object of this schema and nothing around it:\n" + compact(SCHEMA)


def header(task: str, metadata: dict[str, Any]) -> str:
    return f"{HEADER}{compact({'robot_metadata': metadata, 'task_description': task})}{FOOTER}\n\n{schema_text()}"


def caption(position: int, frames: int, index: int, seconds: float) -> str:
    return f"FRAME {position + 1}/{frames}: index={index}, time={seconds:.3f}s"


def data_url(jpeg: bytes) -> str:
    return f"data:image/jpeg;base64,{base64.b64encode(jpeg).decode()}"


def parts(task: str, metadata: dict[str, Any], frames: list[tuple[int, float, bytes]]) -> list[dict[str, Any]]:
    """The header, then a caption and a picture for each (index, seconds, jpeg)."""
    if not task.strip():
        raise ValueError("a request needs a task")
    if reason := frame_list_reason([i for i, _, _ in frames]):
        raise ValueError(f"the frames are not usable: {reason}")
    out: list[dict[str, Any]] = [{"type": "text", "text": header(task.strip(), metadata)}]
    for position, (index, seconds, jpeg) in enumerate(frames):
        out.append({"type": "text", "text": caption(position, len(frames), index, seconds)})
        out.append({"type": "image_url", "image_url": {"url": data_url(jpeg)}})
    return out


def response_format(stage: str, strict: bool) -> dict[str, Any]:
    """strict: the schema goes with the request, under a name of plain characters."""
    if not strict:
        return {"type": "json_object"}
    return {"type": "json_schema", "json_schema": {"name": re.sub(r"[^A-Za-z0-9_-]", "_", stage)[:64] or "response", "strict": True, "schema": SCHEMA}}


class Unparsable(ValueError):
    """An answer that is not of the schema; `truncated` if it was cut off."""

    def __init__(self, message: str, raw: str, truncated: bool):
        super().__init__(message)
        self.raw, self.truncated = raw, truncated


def payload(raw: str, finish_reason: str | None = None) -> str:
    """The sentence in an answer, without a Markdown fence around it."""
    body = raw.strip()
    if fence := re.fullmatch(r"```(?:json)?\s*(.*?)\s*```", body, re.S | re.I):
        body = fence[1].strip()
    try:
        found = json.loads(body)
    except json.JSONDecodeError as error:
        at_end = error.pos >= len(body) or error.msg.startswith("Unterminated string")
        raise Unparsable(f"not JSON: {error}", raw, finish_reason == "length" or at_end) from error
    if not isinstance(found, dict) or set(found) != {FIELD} or not isinstance(found[FIELD], str) or not 1 <= len(found[FIELD].strip()) <= MOST:
        raise Unparsable("the answer is not of the schema", raw, finish_reason == "length")
    return found[FIELD].strip()


def payload_status(raw: Column) -> Column:
    """`ok`, `json` or `schema`, as payload judges an answer."""
    body = unfenced(raw)
    v = F.try_parse_json(body)
    value = F.try_variant_get(v, f"$.{FIELD}", "variant")
    size = F.length(F.trim(F.try_variant_get(v, f"$.{FIELD}", "string")))
    shaped = (F.json_object_keys(body) == F.array(F.lit(FIELD))) & (F.schema_of_variant(value) == "STRING") & size.between(1, MOST)
    return F.when(v.isNull(), "json").when(F.coalesce(shaped, F.lit(False)), "ok").otherwise("schema")


def header_text(task: Column, metadata_json: Column) -> Column:
    """header on columns; metadata_json is compact JSON with sorted keys."""
    quoted = F.to_json(F.struct(task.alias("task_description")))
    body = F.concat(F.lit('{"robot_metadata":'), metadata_json, F.lit(","), F.substring(quoted, 2, 2_000_000_000))
    return F.concat(F.lit(HEADER), body, F.lit(f"{FOOTER}\n\n{schema_text()}"))


def captions(frames: Column, fps: Column) -> Column:
    n = F.size(frames)
    return F.transform(frames, lambda f, k: F.format_string("FRAME %d/%d: index=%d, time=%.3fs", k + 1, n, f, f / fps))


def frame_list_reason(frames: list[int], total: int | None = None, count: int = 8) -> str | None:
    """Why a list of frame numbers cannot be used; None if it can."""
    if len(frames) != count:
        return "count"
    if frames != sorted(set(frames)):
        return "order"
    if frames[0] != 0:
        return "first"
    return "last" if total is not None and frames[-1] >= total else None


def frame_list_broken(frames: Column, total: Column, count: int = 8) -> Column:
    """frame_list_reason on columns."""
    return (
        F.when(F.coalesce(F.size(frames) != count, F.lit(True)), "count")
        .when(frames != F.array_sort(F.array_distinct(frames)), "order")
        .when(frames[0] != 0, "first")
        .when(F.element_at(frames, -1) >= total, "last")
    )
