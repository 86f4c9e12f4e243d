"""Caching, manifests, audits and run accounts; documents, labels and conversations stand in for products and attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions import geometry as G
from marquetry.functions.identity import is_digest
from marquetry.operators import caching as C
from marquetry.operators import manifests as M
from marquetry.plans.tables import table


def _keyed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Samples with three candidate keys each, and checkpoints under some key of some samples."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"))
    candidates = docs.select("sample_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("priority")).withColumn("cache_key", F.sha2(F.concat_ws(":", "sample_id", "priority"), 256))
    labels = table(spark, sf_dir, "labels")
    held = labels.select(F.col("doc_id").alias("sample_id"), F.explode(F.array(F.col("doc_id") % 4, F.col("doc_id") % 3)).alias("p"), F.concat(F.lit("q"), "quality").alias("q"))
    checkpoints = held.select("sample_id", F.sha2(F.concat_ws(":", "sample_id", "p"), 256).alias("cache_key"), F.concat("q", F.lit("/"), "p").alias("payload")).distinct()
    return candidates, checkpoints


_KEYED = """
with candidates as (
  select doc_id as sample_id, cast(p as int) as priority, sha256(doc_id || ':' || p) as cache_key from documents, (select unnest(range(3)) as p)
), checkpoints as (
  select distinct doc_id as sample_id, sha256(doc_id || ':' || p) as cache_key, 'q' || quality || '/' || p as payload
  from (select doc_id, quality, unnest([doc_id % 4, doc_id % 3]) as p from labels)
), hits as (select * from candidates join checkpoints using (sample_id, cache_key)
), best as (select *, row_number() over (partition by sample_id order by priority, payload) as k from hits)
"""


def cache_lookup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates, checkpoints = _keyed(spark, sf_dir)
    return C.look_up(candidates.select("sample_id").distinct(), candidates, checkpoints)


def work_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates, checkpoints = _keyed(spark, sf_dir)
    return C.work_set(candidates.filter("priority = 0").select("sample_id", "cache_key"), checkpoints)


def negative_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the reference branch: the product wins over a recorded failure; both count only under their key."""
    candidates, checkpoints = _keyed(spark, sf_dir)
    first = candidates.filter("priority = 0").select("sample_id", "cache_key")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("sample_id"))
    failures = first.join(toxic, "sample_id", "left_semi")
    return C.reference_state(first, checkpoints, failures).groupBy("state").agg(F.count("*").alias("n"))


def success_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand in for sentences, labels that are not toxic for scenes that came out well."""
    prompts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"), F.sha2("text", 256).alias("prompt_hash"))
    references = table(spark, sf_dir, "labels").filter("toxic = 0").select(F.col("doc_id").alias("sample_id"), "quality")
    return M.success_join(prompts, references)


def manifest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows of chosen episodes (those with a label) give way to new ones (of good quality), or go."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    old = docs.select(F.col("doc_id").alias("episode_index"), F.lit("old").alias("state"), "lang")
    chosen = labels.select(F.col("doc_id").alias("episode_index"))
    new = labels.filter("quality = 1").join(docs, "doc_id").select(F.col("doc_id").alias("episode_index"), F.lit("new").alias("state"), "lang")
    return M.merge(old, chosen, new)


def manifest_audit_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and parts stand in for two manifests."""
    left = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("episode_index"))
    return M.orphans(left, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("episode_index")), "episode_index").groupBy("side").agg(F.count("*").alias("n"), F.min("episode_index").alias("first"), F.max("episode_index").alias("last"))


def exact_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two manifests hold the same episodes: one pair does, the other does not."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("e"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("e"))
    out = None
    for name, right in (("same", docs), ("labels", labels)):
        n = M.orphans(docs, right, "e").agg(F.count("*").alias("n")).select(F.lit(name).alias("pair"), (F.col("n") == 0).alias("equal"), "n")
        out = n if out is None else out.unionAll(n)
    return out


def first_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last event of each user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    first = M.first_of(events, ["user_id"], "event_id").select("user_id", F.col("event_id").alias("first"), F.col("event_type").alias("first_type"))
    last = M.first_of(events, ["user_id"], "event_id", last=True).select("user_id", F.col("event_id").alias("last"), F.col("event_type").alias("last_type"))
    return first.join(last, "user_id")


def _json_variants() -> F.Column:
    """By a rule on the key: as it is, with a further key, without the key, a boolean, a fraction, cut off."""
    k, props = F.col("event_id"), F.col("props")
    inner = F.substring_index(props, "}", 1)
    return (
        F.when(k % 6 == 1, F.concat(inner, F.lit(', "extra": 1}')))
        .when(k % 6 == 2, F.lit("{}"))
        .when(k % 6 == 3, F.lit('{"k": true}'))
        .when(k % 6 == 4, F.lit('{"k": 2.5}'))
        .when(k % 6 == 5, inner)
        .otherwise(props)
    )


_VARIANT = """case event_id % 6 when 1 then string_split(props, '}')[1] || ', "extra": 1}' when 2 then '{}' when 3 then '{"k": true}' when 4 then '{"k": 2.5}'
  when 5 then string_split(props, '}')[1] else props end"""


def closed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that hold exactly the field `k`."""
    rows = table(spark, sf_dir, "events").select("event_id", F.try_parse_json(_json_variants()).alias("v"), F.json_object_keys(_json_variants()).alias("keys"))
    status = F.when(F.col("v").isNull(), "invalid_json").when(F.array_sort("keys") == F.array(F.lit("k")), "ok").otherwise("fields")
    return rows.select("event_id", status.alias("status"))


def json_strict_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers only: neither booleans nor fractions pass as one."""
    v = F.try_parse_json(_json_variants())
    kind = F.schema_of_variant(F.try_variant_get(v, "$.k", "variant"))
    value = F.when(kind == "BIGINT", F.try_variant_get(v, "$.k", "bigint"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


def error_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's summary: all errors counted, the first ten shown, the rest told."""
    errors = table(spark, sf_dir, "documents").filter("n_chars < 600").select(F.concat_ws("", F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lit(": too short")).alias("message"))
    first = errors.orderBy("message").limit(10).agg(F.array_join(F.sort_array(F.collect_list("message")), "; ").alias("shown"), F.count("*").alias("n_shown"))
    return errors.agg(F.count("*").alias("error_count")).join(F.broadcast(first)).select("error_count", "shown", (F.col("error_count") - F.col("n_shown")).alias("truncated"))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as attempts: tokens by text length, missing for some; some fail."""
    k = F.col("conv_id") + F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("sample_id"), "turn", F.when(k % 6 == 0, "failed").when(k % 6 == 1, "cached").otherwise("ok").alias("status"),
        F.when(k % 7 != 0, F.length("text")).alias("input_tokens"), F.when(k % 5 != 0, F.length("role")).alias("output_tokens"),
    )


_ATTEMPTS = """with attempts as (
  select conv_id as sample_id, turn, case when (conv_id + turn) % 6 = 0 then 'failed' when (conv_id + turn) % 6 = 1 then 'cached' else 'ok' end as status,
    case when (conv_id + turn) % 7 <> 0 then length(text) end as input_tokens, case when (conv_id + turn) % 5 <> 0 then length(role) end as output_tokens from conversations)
"""


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("status") == "ok"
    return _attempts(spark, sf_dir).agg(
        F.count("*").alias("requests"), F.count_if(ok).alias("succeeded"), F.count_if(F.col("status") == "cached").alias("cache_hits"), F.count_if(F.col("status") == "failed").alias("failures"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
    )


def failed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _attempts(spark, sf_dir).filter("status = 'failed'")
    status = F.when(F.count("*") == 0, "complete").otherwise("partial")
    return failed.agg(F.countDistinct("sample_id").alias("failed_samples"), status.alias("status"))


def cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.coalesce(F.sum("input_tokens"), F.lit(0)) * 0.4 / 1e6 + F.coalesce(F.sum("output_tokens"), F.lit(0)) * 1.2 / 1e6
    return _attempts(spark, sf_dir).groupBy("status").agg(F.bround(cost, 6).alias("cost"))


def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wait before each attempt: doubled each time, up to thirty seconds."""
    return _attempts(spark, sf_dir).select("sample_id", "turn", F.least(F.lit(30.0), F.pow(F.lit(2.0), F.col("turn"))).alias("wait"))


def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer's budget after a cut-off: doubled, 1024 at least, 4096 at most."""
    start = F.lit(64) + F.col("input_tokens")
    return _attempts(spark, sf_dir).filter("input_tokens is not null").select("sample_id", "turn", F.least(F.lit(4096), F.greatest(start * 2, F.lit(1024))).alias("budget"))


def retryable_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("event_id") % 3 == 0, F.lit(400) + F.col("event_id") % 40).otherwise(F.lit(480) + F.col("event_id") % 50)
    rows = table(spark, sf_dir, "events").select(code.cast("int").alias("code"))
    return rows.groupBy("code").agg(F.count("*").alias("n")).withColumn("retryable", F.col("code").isin(408, 409, 429) | (F.col("code") >= 500))


def digest_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    sha = F.sha2("text", 256)
    k = F.col("doc_id") % 5
    value = F.when(k == 1, F.upper(sha)).when(k == 2, F.substring(sha, 1, 63)).when(k == 3, F.concat(sha, F.lit("\n"))).when(k == 4, F.lit(None)).otherwise(sha)
    return table(spark, sf_dir, "documents").select("doc_id", is_digest(value).alias("ok"))


def resize_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 2000 + 1).cast("int").alias("height"), (F.col("p_size") * 37 + 5).cast("int").alias("width"))
    return rows.select("p_partkey", G.resized(F.col("height"), F.col("width"), 512).alias("r")).select("p_partkey", F.col("r.height").alias("height"), F.col("r.width").alias("width"))


def pad_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", G.padding(F.col("p_partkey"), 8).alias("pad8"), G.padding(F.col("p_size").cast("bigint"), 64).alias("pad64"))


def close_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality up to one in 10^9, and finiteness, of values nudged by a rule."""
    x = F.col("p_retailprice")
    k = F.col("p_partkey") % 5
    y = F.when(k == 1, x * 1.0000000001).when(k == 2, x * 1.00000001).when(k == 3, F.lit(float("nan"))).when(k == 4, F.lit(float("inf"))).otherwise(x)
    return table(spark, sf_dir, "part").select("p_partkey", G.close_to(x, y).alias("close"), G.finite(y).alias("finite"))


QUERIES = {
    f.__name__: f
    for f in (
        cache_lookup_priority, work_set, negative_cache, success_join, manifest_merge, manifest_audit_outer, exact_set, first_last_rows, closed_schema, json_strict_int, error_topn, run_counters,
        failed_distinct, cost_estimate, retry_schedule, token_budget, retryable_errors, digest_format, resize_dims, pad_dims, close_values,
    )
}
_HW = "select p_partkey, cast(p_partkey % 2000 + 1 as int) as h, cast(p_size * 37 + 5 as int) as w from part"
ORACLES = {
    "cache_lookup_priority": _KEYED + "select d.doc_id as sample_id, b.cache_key, b.payload, coalesce(b.priority > 0, false) as migrate from documents d left join best b on b.sample_id = d.doc_id and b.k = 1",
    "work_set": _KEYED + "select sample_id, cache_key from candidates c where priority = 0 and not exists (select 1 from checkpoints k where k.sample_id = c.sample_id and k.cache_key = c.cache_key)",
    "negative_cache": _KEYED + """select case when exists (select 1 from checkpoints k where k.sample_id = c.sample_id and k.cache_key = c.cache_key) then 'hit'
  when sample_id in (select doc_id from labels where toxic = 1) then 'failed' else 'miss' end as state, count(*) as n from candidates c where priority = 0 group by 1""",
    "success_join": "select d.doc_id as sample_id, sha256(d.text) as prompt_hash, l.quality from documents d join labels l using (doc_id) where l.toxic = 0",
    "manifest_merge": """select doc_id as episode_index, 'old' as state, lang from documents where doc_id not in (select doc_id from labels)
  union all select doc_id, 'new', lang from labels join documents using (doc_id) where quality = 1""",
    "manifest_audit_outer": """select case when p.p_partkey is null then 'left' else 'right' end as side, count(*) as n, min(coalesce(p.p_partkey, l.doc_id)) as first, max(coalesce(p.p_partkey, l.doc_id)) as last
  from labels l full join part p on l.doc_id = p.p_partkey where l.doc_id is null or p.p_partkey is null group by 1""",
    "exact_set": "select 'same' as pair, true as equal, 0::bigint as n union all select 'labels', count(*) = 0, count(*) from documents where doc_id not in (select doc_id from labels)",
    "first_last_rows": "select user_id, min(event_id) as first, arg_min(event_type, event_id) as first_type, max(event_id) as last, arg_max(event_type, event_id) as last_type from events group by 1",
    "closed_schema": f"""select event_id, case when not json_valid(v) then 'invalid_json' when json_keys(v) = ['k'] then 'ok' else 'fields' end as status from (select event_id, {_VARIANT} as v from events)""",
    "json_strict_int": f"""select event_id, case when json_valid(v) and json_type(case when json_valid(v) then v end, '$.k') in ('BIGINT', 'UBIGINT') then cast(json_extract_string(case when json_valid(v) then v end, '$.k') as bigint) end as value
  from (select event_id, {_VARIANT} as v from events)""",
    "error_topn": """with e as (select lpad(cast(doc_id as varchar), 12, '0') || ': too short' as m from documents where n_chars < 600)
  select (select count(*) from e) as error_count, (select string_agg(m, '; ' order by m) from (select m from e order by m limit 10)) as shown, greatest((select count(*) from e) - 10, 0) as truncated""",
    "run_counters": _ATTEMPTS + """select count(*) as requests, count(*) filter (status = 'ok') as succeeded, count(*) filter (status = 'cached') as cache_hits, count(*) filter (status = 'failed') as failures,
  coalesce(sum(input_tokens), 0)::bigint as input_tokens, coalesce(sum(output_tokens), 0)::bigint as output_tokens from attempts""",
    "failed_distinct": _ATTEMPTS + "select count(distinct sample_id) as failed_samples, case when count(*) = 0 then 'complete' else 'partial' end as status from attempts where status = 'failed'",
    "cost_estimate": _ATTEMPTS + "select status, round_even(coalesce(sum(input_tokens), 0)::bigint * 0.4::double / 1e6::double + coalesce(sum(output_tokens), 0)::bigint * 1.2::double / 1e6::double, 6) as cost from attempts group by 1",
    "retry_schedule": _ATTEMPTS + "select sample_id, turn, least(30.0::double, pow(2.0::double, turn)) as wait from attempts",
    "token_budget": _ATTEMPTS + "select sample_id, turn, least(4096, greatest(2 * (64 + input_tokens), 1024))::int as budget from attempts where input_tokens is not null",
    "retryable_errors": """select code, count(*) as n, code in (408, 409, 429) or code >= 500 as retryable
  from (select cast(case when event_id % 3 = 0 then 400 + event_id % 40 else 480 + event_id % 50 end as int) as code from events) group by 1""",
    "digest_format": "select doc_id, doc_id % 5 = 0 as ok from documents",
    "resize_dims": f"select p_partkey, greatest(1, round_even(h * least(1.0::double, 512.0::double / greatest(h, w)), 0)::int) as height, greatest(1, round_even(w * least(1.0::double, 512.0::double / greatest(h, w)), 0)::int) as width from ({_HW})",
    "pad_dims": "select p_partkey, ((8 - p_partkey % 8) % 8)::bigint as pad8, ((64 - p_size % 64) % 64)::bigint as pad64 from part",
    "close_values": "select p_partkey, p_partkey % 5 in (0, 1) as close, p_partkey % 5 not in (3, 4) as finite from part",
}
