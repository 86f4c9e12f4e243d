"""Rules on published scene pictures, as violations of a VARIANT column.

`published` collects every rule that a manifest's item breaks; `first_broken` gives the first of the ordered
rules that a fresh result breaks. Both read JSON strictly: booleans are no numbers, and numbers must be finite.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquetry.functions.geometry import close_to, finite
from marquetry.functions.identity import is_digest

#: The fields of a published item and of its residual check, each complete and closed (fixed values).
FIELDS = ["height", "mask_area_fraction", "mask_sha256", "provenance", "reference_id", "reference_kind", "reference_path", "scope", "sha256", "source_frame_index", "source_frame_sha256", "source_view", "width"]
RESIDUAL = ["area_fraction", "detector", "enabled", "pass", "queries", "threshold"]
#: What a scene picture is (fixed values).
SCOPE, KIND, OPERATION = "environment", "robot_removed_scene", "robot_removal_inpainting"

Rules = list[tuple[str, Column]]


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("VOID"))


def get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, f"$.{path}", "variant")


def text(v: Column, path: str) -> Column:
    found = get(v, path)
    return F.when(_kind(found) == "STRING", F.try_variant_get(found, "$", "string"))


def number(v: Column, path: str) -> Column:
    """A finite number; null for anything else."""
    found = get(v, path)
    value = F.try_variant_get(found, "$", "double")
    return F.when(_kind(found).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & finite(value), value)


def whole(v: Column, path: str) -> Column:
    found = get(v, path)
    return F.when(_kind(found) == "BIGINT", F.try_variant_get(found, "$", "bigint"))


def flag(v: Column, path: str) -> Column:
    found = get(v, path)
    return F.when(_kind(found) == "BOOLEAN", F.try_variant_get(found, "$", "boolean"))


def _object(v: Column, path: str) -> Column:
    """An object with fields."""
    return F.coalesce(_kind(get(v, path)).startswith("OBJECT<") & (_kind(get(v, path)) != "OBJECT<>"), F.lit(False))


def keys(v: Column) -> Column:
    return F.array_sort(F.json_object_keys(F.to_json(v)))


def _broken(test: Column) -> Column:
    """A rule whose test is unknown is broken."""
    return ~F.coalesce(test, F.lit(False))


def _queries_valid(v: Column) -> Column:
    items = F.try_variant_get(v, "$.provenance.residual_qa.queries", "array<variant>")
    return (F.size(items) > 0) & F.forall(items, lambda q: (_kind(q) == "STRING") & (F.trim(F.try_variant_get(q, "$", "string")) != ""))


def _provenance(v: Column) -> Rules:
    """The rules on how a picture came about, in order."""
    p, qa, qc = "provenance", "provenance.residual_qa", "provenance.quality_control"
    area, threshold, passed = number(v, f"{qa}.area_fraction"), number(v, f"{qa}.threshold"), flag(v, f"{qa}.pass")
    enabled, detector = flag(v, f"{qa}.enabled"), _kind(get(v, f"{qa}.detector"))
    metrics = area.between(0, 1) & (threshold >= 0) & (threshold < 1) & passed.isNotNull()
    own_area, own_threshold = number(v, f"{qc}.residual_mask_area_fraction"), number(v, f"{qc}.max_residual_area_fraction")
    mirrored = (flag(v, f"{qc}.residual_check_enabled") == enabled) & own_area.between(0, 1) & close_to(own_area, area) & (own_threshold >= 0) & (own_threshold < 1) & close_to(own_threshold, threshold)
    closed = keys(get(v, qa)) == F.array(*map(F.lit, RESIDUAL))
    has = _object(v, p)
    checked = has & _object(v, qa)
    inside = lambda test: checked & closed & _broken(test)
    return [
        ("provenance", ~has),
        ("operation", has & _broken(text(v, f"{p}.operation") == OPERATION)),
        ("segmenter", has & ~_object(v, f"{p}.segmenter")),
        ("inpainter", has & ~_object(v, f"{p}.inpainter")),
        ("final mask", has & ~_object(v, f"{p}.final_mask")),
        ("final mask differs", has & _object(v, f"{p}.final_mask") & _broken((text(v, f"{p}.final_mask.sha256") == text(v, "mask_sha256")) & close_to(number(v, f"{p}.final_mask.area_fraction"), number(v, "mask_area_fraction")))),
        ("outside changed", has & _broken(flag(v, f"{qc}.outside_mask_unchanged"))),
        ("residual check", has & ~_object(v, qa)),
        ("residual fields", checked & _broken(closed)),
        ("residual enabled", inside(enabled.isNotNull())),
        ("residual detector", inside(F.when(enabled.isNull(), True).when(enabled, _object(v, f"{qa}.detector")).otherwise(detector == "VOID"))),
        ("residual queries", inside(_queries_valid(v))),
        ("residual metrics", inside(metrics)),
        ("residual failed", inside(F.when(metrics, passed & (area <= threshold)).otherwise(True))),
        ("residual differs", inside(F.when(metrics, mirrored).otherwise(True))),
    ]


def collected(rules: Rules) -> Column:
    """The names of all broken rules; a rule that is unknown is broken."""
    return F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules)))


def item_rules(v: Column, view: Column, width: Column, height: Column, path: Column) -> Rules:
    """A published item against its episode, but for the picture's bytes."""
    w, h, area = whole(v, "width"), whole(v, "height"), number(v, "mask_area_fraction")
    return [
        ("extra fields", F.size(F.array_except(keys(v), F.array(*map(F.lit, FIELDS)))) > 0),
        ("sha256", _broken(is_digest(text(v, "sha256")))),
        ("id is not the digest", _broken(text(v, "reference_id") == F.concat(F.lit("sha256:"), text(v, "sha256")))),
        ("source frame", _broken(whole(v, "source_frame_index") == 0)),
        ("view", _broken(text(v, "source_view") == view)),
        ("scope", _broken(text(v, "scope") == SCOPE)),
        ("kind", _broken(text(v, "reference_kind") == KIND)),
        ("source_frame_sha256", _broken(is_digest(text(v, "source_frame_sha256")))),
        ("mask_sha256", _broken(is_digest(text(v, "mask_sha256")))),
        ("width", _broken(w >= 1)),
        ("height", _broken(h >= 1)),
        ("geometry", _broken((w == width) & (h == height))),
        ("mask area", _broken((area > 0) & (area < 1))),
        *_provenance(v),
        ("path", _broken(text(v, "reference_path") == path)),
    ]


def published(v: Column, view: Column, width: Column, height: Column, path: Column, pictures: Column) -> Column:
    """Names of all rules that an item and its picture (see picture_rules) break; an item with missing fields has that fault (and extra ones) only."""
    missing = F.size(F.array_except(F.array(*map(F.lit, FIELDS)), keys(v))) > 0
    rules = item_rules(v, view, width, height, path)
    lacking = collected([rules[0], ("missing fields", F.lit(True))])
    return F.when(F.coalesce(missing, F.lit(True)), lacking).otherwise(F.concat(collected(rules), pictures))


def picture_rules(v: Column, found_sha: Column, head: Column, picture_height: Column, picture_width: Column) -> Column:
    """Names of the rules that the picture's bytes break: they are read, have the digest, are a JPEG, and decode to the told size (-1: not decodable)."""
    there = found_sha.isNotNull()
    decoded = there & (picture_height > 0)
    rules = [
        ("unreadable image", ~there),
        ("image digest", there & _broken(found_sha == text(v, "sha256"))),
        ("not a JPEG", there & _broken(head == F.lit(bytes([0xFF, 0xD8])))),
        ("not decodable", there & _broken(picture_height > 0)),
        ("image size", decoded & whole(v, "height").isNotNull() & whole(v, "width").isNotNull() & ~((picture_height == whole(v, "height")) & (picture_width == whole(v, "width")))),
    ]
    return collected(rules)


def first_broken(v: Column, masks: Column, found_sha: Column, picture_height: Column, picture_width: Column) -> Column:
    """The first rule that a fresh result breaks, in order; null if none. masks: how many robot masks prove it."""
    rules = [
        ("source frame", _broken(whole(v, "source_frame_index") == 0)),
        ("scope", _broken(text(v, "scope") == SCOPE)),
        ("kind", _broken(text(v, "reference_kind") == KIND)),
        ("no masks", _broken(masks > 0)),
        *_provenance(v),
        ("identity", _broken((found_sha == text(v, "sha256")) & (text(v, "reference_id") == F.concat(F.lit("sha256:"), found_sha)))),
        ("not decodable", _broken(picture_height > 0)),
        ("image size", _broken((picture_height == whole(v, "height")) & (picture_width == whole(v, "width")))),
    ]
    return F.coalesce(*(F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules))
