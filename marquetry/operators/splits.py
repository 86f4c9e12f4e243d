"""Split selectors as interval tables, and the resolution of an episode's split from its candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPLITS = ["train", "validation"]
#: One component of a selector: a half-open range or a single index.
COMPONENT = r"\A\s*([0-9]+)(?::([0-9]+))?\s*\z"


def selector_intervals(selectors: DataFrame) -> DataFrame:
    """(source_id, split, selector) -> source_id, split, pos, start, stop, valid; splits of other names are not read.

    A selector is a comma-separated list of `a:b` (half-open) and single indices. Every component is
    checked, also behind a match; `valid` is false for those that are malformed or run backwards.
    """
    known = selectors.filter(F.col("split").isin(SPLITS))
    parts = known.select("source_id", "split", F.posexplode(F.split("selector", ",")).alias("pos", "part"))
    part = F.col("part")
    start = F.expr(r"try_cast(nullif(regexp_extract(part, '\\A\\s*([0-9]+)(?::([0-9]+))?\\s*\\z', 1), '') as bigint)")
    stop = F.expr(r"try_cast(nullif(regexp_extract(part, '\\A\\s*([0-9]+)(?::([0-9]+))?\\s*\\z', 2), '') as bigint)")
    built = parts.select("source_id", "split", "pos", part, start.alias("start"), F.coalesce(stop, start + 1).alias("stop"))
    return built.withColumn("valid", F.coalesce(F.col("start") <= F.col("stop"), F.lit(False)))


def splits_by_interval(episodes: DataFrame, intervals: DataFrame) -> DataFrame:
    """episodes (source_id, episode_index) with the array `info_splits` of every split whose interval holds the index.

    A range join on the source; intervals of one source and split are merged by the distinct set.
    """
    i = intervals.filter("valid and start < stop").alias("i")
    e = episodes.alias("e")
    hits = e.join(i, F.expr("e.source_id = i.source_id and i.start <= e.episode_index and e.episode_index < i.stop")).select("e.source_id", "e.episode_index", "i.split")
    found = hits.groupBy("source_id", "episode_index").agg(F.sort_array(F.collect_set("split")).alias("info_splits"))
    return episodes.join(found, ["source_id", "episode_index"], "left").withColumn("info_splits", F.coalesce("info_splits", F.array().cast("array<string>")))


def resolve(row_split: F.Column, info_splits: F.Column, external: F.Column) -> tuple[F.Column, F.Column]:
    """(split, problem): problem is `row` for an unknown row value, `info` for several intervals' splits, `conflict`, or `none`."""
    candidates = F.array_distinct(F.array_compact(F.concat(F.array(row_split), info_splits, F.array(external))))
    problem = (
        F.when(row_split.isNotNull() & ~row_split.isin(SPLITS), "row")
        .when(F.size(info_splits) > 1, "info")
        .when(F.size(candidates) > 1, "conflict")
        .when(F.size(candidates) == 0, "none")
    )
    return F.when(problem.isNull(), F.try_element_at(candidates, F.lit(1))), problem


def selected(episodes: DataFrame, chosen: str | None) -> DataFrame:
    """Episodes whose index is in a list such as `0,2,5-9` (inclusive ranges, blanks skipped); all of them without one."""
    wanted = parse_episodes(chosen)
    if wanted is None:
        return episodes
    index = F.col("episode_index")
    test = F.lit(False)
    for low, high in wanted:
        test = test | index.between(low, high)
    return episodes.filter(test)


def parse_episodes(value: str | None) -> list[tuple[int, int]] | None:
    """Inclusive ranges of a selection, or None for all; ValueError if it is malformed."""
    if value is None:
        return None
    out = []
    for part in filter(None, (x.strip() for x in value.split(","))):
        low, dash, high = (x.strip() for x in part.partition("-"))
        if not low.isdigit() or dash and not high.isdigit():
            raise ValueError(f"not an episode or range of episodes: {part!r}")
        ends = int(low), int(high) if dash else int(low)
        if ends[1] < ends[0]:
            raise ValueError(f"a range that runs backwards: {part!r}")
        out.append(ends)
    if not out:
        raise ValueError("the selection of episodes is empty")
    return out
