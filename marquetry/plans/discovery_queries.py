"""Identities, splits, selection and inspection of episodes; documents stand in for episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions import geometry as G
from marquetry.functions import identity as I
from marquetry.operators import manifests as M
from marquetry.operators import splits as S
from marquetry.plans.tables import episodes, table

#: Selectors of some sources: plain, listed, overlapping, of another name, and malformed ones.
SELECTORS = [
    ("src0", "train", "0:400"),
    ("src0", "validation", "400:100000000"),
    ("src1", "train", "1:300,461, 500:700"),
    ("src1", "validation", "301:461"),
    ("src2", "train", "0:600"),
    ("src2", "validation", "500:900"),
    ("src3", "holdout", "not read"),
    ("src4", "train", "0-2"),
    ("src5", "train", "9:3"),
    ("src6", "validation", "6:6,26"),
    ("src7", "train", "0:2,"),
]
#: Splits given from outside for some domains.
ASSIGNED = [("de", "train"), ("fr", "validation"), ("xx", "train"), ("yy", "validation")]

_VALUES = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in SELECTORS)
_ASSIGNED = ", ".join(f"('{a}', '{b}')" for a, b in ASSIGNED)
_SPLITS = f"""
with selectors(source_id, split, selector) as (values {_VALUES}),
listed as (
  select source_id, split, string_split(selector, ',') as p from selectors where split in ('train', 'validation')
), parts as (
  select source_id, split, i - 1 as pos, trim(p[i]) as part from (select *, unnest(range(1, len(p) + 1)) as i from listed)
), intervals as (
  select source_id, split, cast(pos as int) as pos,
    try_cast(nullif(regexp_extract(part, '^([0-9]+)(?::([0-9]+))?$', 1), '') as bigint) as start,
    try_cast(nullif(regexp_extract(part, '^([0-9]+)(?::([0-9]+))?$', 2), '') as bigint) as stop0 from parts
), bounded as (
  select source_id, split, pos, start, coalesce(stop0, start + 1) as stop, coalesce(start <= coalesce(stop0, start + 1), false) as valid from intervals
), episodes as (
  select source as source_id, doc_id as episode_index, n_chars as length, lang as domain,
    case when doc_id % 17 = 0 then 'train' when doc_id % 19 = 0 then 'test' end as row_split from documents
), held as (
  select e.*, coalesce((select list_sort(list(distinct b.split)) from bounded b where b.valid and b.source_id = e.source_id and b.start <= e.episode_index and e.episode_index < b.stop), []) as info_splits
  from episodes e
), joined as (
  select h.*, a.split as external from held h left join (values {_ASSIGNED}) a(domain, split) on a.domain = h.domain
), candidates as (
  select *, list_distinct(list_filter(list_concat(list_concat([row_split], info_splits), [external]), lambda x: x is not null)) as c from joined
), resolved as (
  select source_id, episode_index, case when row_split is not null and row_split not in ('train', 'validation') then 'row'
    when len(info_splits) > 1 then 'info' when len(c) > 1 then 'conflict' when len(c) = 0 then 'none' end as problem, c[1] as split0 from candidates
)
"""


def _selectors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SELECTORS, "source_id string, split string, selector string")


def _assigned(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASSIGNED, "domain string, split string")


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.col("episode_index")
    rows = episodes(spark, sf_dir).withColumn("row_split", F.when(index % 17 == 0, "train").when(index % 19 == 0, "test"))
    held = S.splits_by_interval(rows, S.selector_intervals(_selectors(spark)))
    joined = held.join(_assigned(spark).withColumnRenamed("split", "external"), "domain", "left")
    split, problem = S.resolve(F.col("row_split"), F.col("info_splits"), F.col("external"))
    return joined.select("source_id", "episode_index", split.alias("split"), problem.alias("problem"))


def canonical_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes(spark, sf_dir).select("episode_index", I.sample_id(F.col("source_id"), F.col("episode_index")).alias("sample_id"), I.valid_source(F.col("source_id")).alias("valid"))


def artifact_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = I.sample_id(F.col("source_id"), F.col("episode_index"))
    return episodes(spark, sf_dir).select("episode_index", I.artifact_stem(sample).alias("stem"), I.artifact_shard(sample).alias("shard"))


def uniform_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episodes(spark, sf_dir).filter("length >= 81").select("episode_index", F.posexplode(G.uniform_frames(F.col("length"))).alias("k", "frame"))


def frame_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = episodes(spark, sf_dir).filter("length >= 81").select("episode_index", G.uniform_frames(F.col("length")).alias("frames"))
    fps = F.lit(10.0) + F.col("episode_index") % 21
    return rows.select("episode_index", F.posexplode(F.arrays_zip("frames", G.timestamps(F.col("frames"), fps).alias("seconds"))).alias("k", "f")).select("episode_index", "k", F.round("f.seconds", 9).alias("seconds"))


def view_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", G.view_name(F.col("url")).alias("view"))


def video_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = F.lit("videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4")
    key = F.concat(F.lit("observation.images."), F.col("source_id"))
    path = G.video_path(template, key, F.col("episode_index"), F.lit(100))
    escaped = F.when(F.col("episode_index") % 10 == 3, F.concat(F.lit("../"), path)).when(F.col("episode_index") % 10 == 4, F.concat(F.lit("/"), path)).when(F.col("episode_index") % 10 == 5, F.concat(F.lit("a/../"), path)).otherwise(path)
    return episodes(spark, sf_dir).select("episode_index", escaped.alias("path"), G.stays_inside(escaped).alias("inside"))


def view_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each source's features, the one video feature that is, or ends in, the wanted view and has a paired one."""
    k = F.col("event_id")
    features = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("source"),
        F.concat_ws(".", F.lit("observation.images"), "event_type").alias("key"),
        F.when(k % 9 == 0, "float32").otherwise("video").alias("dtype"),
        F.when(k % 5 == 0, F.array(F.lit(48), F.lit(64))).when(k % 7 == 0, F.array(F.lit(0), F.lit(64), F.lit(3))).otherwise(F.array(F.lit(48), F.lit(64), F.lit(3))).alias("shape"),
    ).distinct()
    fits = (F.col("dtype") == "video") & (G.view_name(F.col("key")) == "view")
    shaped = (F.size("shape") == 3) & (F.element_at("shape", 1) >= 1) & (F.try_element_at("shape", F.lit(2)) >= 1) & (F.try_element_at("shape", F.lit(3)) == 3)
    found = features.groupBy("source").agg(F.count(F.when(fits, 1)).alias("n"), F.count(F.when(fits & shaped, 1)).alias("n_shaped"))
    return found.select("source", F.when(F.col("n") == 0, "missing").when(F.col("n") > 1, "ambiguous").when(F.col("n_shaped") == 0, "shape").otherwise("ok").alias("status"))


def split_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.selector_intervals(_selectors(spark)).select("source_id", "split", "pos", "start", "stop", "valid")


def split_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = S.splits_by_interval(episodes(spark, sf_dir), S.selector_intervals(_selectors(spark)))
    return held.select("source_id", "episode_index", F.array_join("info_splits", ",").alias("splits"))


def split_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).filter("problem is null").select("source_id", "episode_index", "split")


def split_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).filter("problem is not null").groupBy("source_id", "problem").agg(F.count("*").alias("n"), F.min("episode_index").alias("first"))


def domain_purity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains whose episodes lie in several splits; one made-up grouping is pure, the other not."""
    rows = _resolved(spark, sf_dir).filter("problem is null").join(episodes(spark, sf_dir).select("episode_index", "domain"), "episode_index")
    both = rows.select(F.explode(F.array(F.col("domain"), F.concat("domain", F.lit("/"), "split"))).alias("domain"), "split")
    return both.groupBy("domain").agg(F.min("split").alias("low"), F.max("split").alias("high")).select("domain", (F.col("low") == F.col("high")).alias("pure"))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.duplicates(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key")), "key")


def row_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes that are too short, and rows whose index is negative, by source."""
    rows = episodes(spark, sf_dir).withColumn("index", F.when(F.col("episode_index") % 101 == 7, -F.col("episode_index")).otherwise(F.col("episode_index")))
    rule = F.when(F.col("index") < 0, "index").when(F.col("length") < 81, "length")
    return rows.withColumn("rule", rule).filter("rule is not null").groupBy("source_id", "rule").agg(F.count("*").alias("n"))


def inspect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes by data set, by domain and by split, in one pass."""
    rows = _resolved(spark, sf_dir).join(episodes(spark, sf_dir).select("episode_index", "domain"), "episode_index").withColumn("split", F.coalesce("split", F.lit("unresolved")))
    sets = rows.groupingSets([["source_id"], ["domain"], ["split"]], "source_id", "domain", "split").agg(F.count("*").alias("episodes"))
    kind = F.when(F.col("source_id").isNotNull(), "dataset").when(F.col("domain").isNotNull(), "domain").otherwise("split")
    return sets.select(kind.alias("kind"), F.coalesce("source_id", "domain", "split").alias("name"), "episodes")


def preflight_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, and the count of every split, zero where it has no episode."""
    total = episodes(spark, sf_dir).agg(F.count("*").alias("episodes"), F.countDistinct("source_id").alias("sources"), F.countDistinct("domain").alias("domains"))
    found = _resolved(spark, sf_dir).filter("problem is null").groupBy("split").agg(F.count("*").alias("n"))
    splits = spark.createDataFrame([(s,) for s in [*S.SPLITS, "unused"]], "split string")
    return splits.join(found, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n")).join(F.broadcast(total))


def unmatched_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark).join(episodes(spark, sf_dir).select("domain").distinct(), "domain", "left_anti").select("domain")


def unmatched_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts stand in for listed samples: the numbers that no document has."""
    listed = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("episode_index"))
    return listed.join(episodes(spark, sf_dir), "episode_index", "left_anti")


def episode_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.selected(episodes(spark, sf_dir), "0,2, 5-9,,40-120,700").select("source_id", "episode_index")


def limit_discovery_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first twenty selected episodes, by source, then place in it."""
    chosen = S.selected(episodes(spark, sf_dir), "5-900")
    return chosen.orderBy("source_id", "episode_index").limit(20).select("source_id", "episode_index")


def subtask_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each episode's labels: none where they are missing, the last entry where there are several."""
    entries = table(spark, sf_dir, "events").select((F.col("event_id") % 300).alias("episode_index"), F.col("event_id").alias("pos"), F.col("props").alias("subtask"))
    last = M.first_of(entries, ["episode_index"], "pos", last=True).select("episode_index", "subtask")
    return episodes(spark, sf_dir).join(last, "episode_index", "left").select("episode_index", F.coalesce("subtask", F.lit("[]")).alias("subtask"))


QUERIES = {
    f.__name__: f
    for f in (
        canonical_id, artifact_shard, uniform_frames, frame_timestamps, view_name, video_path, view_selection, split_intervals, split_interval_join, split_resolve, split_conflicts,
        domain_purity, duplicate_keys, row_validity, inspect_counts, preflight_counts, unmatched_domains, unmatched_metadata, episode_selection, limit_discovery_order, subtask_labels,
    )
}
_ID = "length(source) || ':' || source || ':' || doc_id"
_PATH = "'videos/chunk-' || case when doc_id // 100 < 1000 then lpad(cast(doc_id // 100 as varchar), 3, '0') else cast(doc_id // 100 as varchar) end || '/observation.images.' || source || '/episode_' || case when doc_id < 1000000 then lpad(cast(doc_id as varchar), 6, '0') else cast(doc_id as varchar) end || '.mp4'"
ORACLES = {
    "canonical_id": f"select doc_id as episode_index, {_ID} as sample_id, trim(source) = source and source <> '' as valid from documents",
    "artifact_shard": f"select doc_id as episode_index, sha256({_ID}) as stem, left(sha256({_ID}), 2) as shard from documents",
    "uniform_frames": "select doc_id as episode_index, cast(k as int) as k, cast(round_even(k * (n_chars - 1) / 7.0, 0) as bigint) as frame from documents, (select unnest(range(8)) as k) where n_chars >= 81",
    "frame_timestamps": "select doc_id as episode_index, cast(k as int) as k, round(round_even(k * (n_chars - 1) / 7.0, 0) / cast(10 + doc_id % 21 as double), 9) as seconds from documents, (select unnest(range(8)) as k) where n_chars >= 81",
    "view_name": "select page_id, string_split(url, '.')[-1] as view from pages",
    "video_path": f"""
select doc_id as episode_index, case doc_id % 10 when 3 then '../' when 4 then '/' when 5 then 'a/../' else '' end || {_PATH} as path, doc_id % 10 not in (3, 4) as inside from documents""",
    "view_selection": """
with features as (
  select distinct user_id as source, event_type as view, case when event_id % 9 = 0 then 'float32' else 'video' end as dtype,
    case when event_id % 5 = 0 then [48, 64] when event_id % 7 = 0 then [0, 64, 3] else [48, 64, 3] end as shape from events
), counted as (
  select source, count(*) filter (dtype = 'video' and view = 'view') as n, count(*) filter (dtype = 'video' and view = 'view' and shape = [48, 64, 3]) as good from features group by source
)
select source, case when n = 0 then 'missing' when n > 1 then 'ambiguous' when good = 0 then 'shape' else 'ok' end as status from counted""",
    "split_intervals": _SPLITS + "select * from bounded",
    "split_interval_join": _SPLITS + "select source_id, episode_index, array_to_string(info_splits, ',') as splits from held",
    "split_resolve": _SPLITS + "select source_id, episode_index, split0 as split from resolved where problem is null",
    "split_conflicts": _SPLITS + "select source_id, problem, count(*) as n, min(episode_index) as first from resolved where problem is not null group by all",
    "domain_purity": _SPLITS + """select domain, count(distinct split0) = 1 as pure from (
  select e.domain, r.split0 from resolved r join episodes e using (episode_index) where problem is null
  union all select e.domain || '/' || r.split0, r.split0 from resolved r join episodes e using (episode_index) where problem is null) group by domain""",
    "duplicate_keys": "select sha256(text) as key, count(*) as n from documents group by text having count(*) > 1",
    "row_validity": """
select source as source_id, case when doc_id % 101 = 7 and doc_id > 0 then 'index' when n_chars < 81 then 'length' end as rule, count(*) as n
from documents where (doc_id % 101 = 7 and doc_id > 0) or n_chars < 81 group by all""",
    "inspect_counts": _SPLITS + """, all_rows as (
  select e.source_id, e.domain, coalesce(case when problem is null then split0 end, 'unresolved') as split from resolved r join episodes e using (episode_index)
) select 'dataset' as kind, source_id as name, count(*) as episodes from all_rows group by 2
  union all select 'domain', domain, count(*) from all_rows group by 2 union all select 'split', split, count(*) from all_rows group by 2""",
    "preflight_counts": _SPLITS + """, found as (select split0 as split, count(*) as n from resolved where problem is null group by 1)
select s.split, coalesce(n, 0) as n, t.* from (values ('train'), ('validation'), ('unused')) s(split) left join found using (split),
  (select count(*) as episodes, count(distinct source_id) as sources, count(distinct domain) as domains from episodes) t""",
    "unmatched_domains": f"select domain from (values {_ASSIGNED}) a(domain, split) where domain not in (select lang from documents where lang is not null)",
    "unmatched_metadata": "select p_partkey as episode_index from part where p_partkey not in (select doc_id from documents)",
    "episode_selection": "select source as source_id, doc_id as episode_index from documents where doc_id in (0, 2, 700) or doc_id between 5 and 9 or doc_id between 40 and 120",
    "limit_discovery_order": "select source as source_id, doc_id as episode_index from documents where doc_id between 5 and 900 order by 1, 2 limit 20",
    "subtask_labels": """
select d.doc_id as episode_index, coalesce(l.subtask, '[]') as subtask from documents d
left join (select event_id % 300 as e, arg_max(props, event_id) as subtask from events group by 1) l on l.e = d.doc_id""",
}
