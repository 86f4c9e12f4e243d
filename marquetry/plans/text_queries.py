"""Annotation text: cleaning, counting, validating."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.functions import text as T
from marquetry.plans.tables import table

_PHRASES = ", ".join(f"'{p}'" for p in T.FORBIDDEN)


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and documents as raw sentences; by a rule on the key some get phrases or characters that the tables lack."""
    key = F.col("key")
    phrase = F.element_at(F.array(*map(F.lit, T.FORBIDDEN)), (key % len(T.FORBIDDEN) + 1).cast("int"))
    raw = (
        F.when(key % 5 == 1, F.concat("body", F.lit(" "), phrase))
        .when(key % 7 == 2, F.replace(F.col("body"), F.lit(" "), F.lit("\x1c ")))
        .when(key % 11 == 3, F.concat(F.lit("ſegmentation Maſk "), F.col("body")))
        .when(key % 13 == 4, F.lit(" \t　"))
        .otherwise(F.col("body"))
    )
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), F.col("text").alias("body"))
    docs = table(spark, sf_dir, "documents").select((F.lit(1_000_000_000) + F.col("doc_id")).alias("key"), F.col("text").alias("body"))
    return turns.unionAll(docs).select("key", raw.alias("raw"))


_SPOKEN = f"""
with bodies as (
  select conv_id * 1000 + turn as key, text as body from conversations
  union all select 1000000000 + doc_id, text from documents
), spoken as (
  select key, case when key % 5 = 1 then body || ' ' || ([{_PHRASES}])[key % {len(T.FORBIDDEN)} + 1]
    when key % 7 = 2 then replace(body, ' ', chr(28) || ' ')
    when key % 11 = 3 then 'ſegmentation Maſk ' || body
    when key % 13 = 4 then ' ' || chr(9) || chr(12288) else body end as raw from bodies
), cleaned as (
  select key, trim(regexp_replace(replace(raw, chr(0), ' '), '{T.WHITE}+', ' ', 'g')) as c from spoken
), normal as (
  select key, case when c = '' or right(c, 1) in ('.', '!', '?') then c else c || '.' end as prompt from cleaned
), counted as (
  select key, prompt, cast(len(regexp_extract_all(prompt, '{T.WORD.replace("'", "''")}')) as int) as words,
    cast(len(regexp_extract_all(prompt, '[.!?]+(?:{T.WHITE}|\\z)')) as int) as sentences from normal
), judged as (
  select *, case when prompt = '' then 'empty' when length(prompt) > {T.MAX_CHARACTERS} then 'characters' when words > {T.MAX_WORDS} then 'words'
    when sentences <> 1 then 'sentences'
    {" ".join(f"when contains(replace(lower(prompt), 'ſ', 's'), '{p}') then 'forbidden: {p}'" for p in T.FORBIDDEN)} end as reason from counted
)
"""


def prompt_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spoken(spark, sf_dir).select("key", T.normalize_prompt(F.col("raw")).alias("prompt"))


def prompt_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prompt_normalize(spark, sf_dir)
    return rows.select("key", F.length("prompt").alias("characters"), T.word_count(F.col("prompt")).alias("words"), T.sentence_count(F.col("prompt")).alias("sentences"))


def prompt_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_normalize(spark, sf_dir).select("key", T.prompt_reason(F.col("prompt")).alias("reason"))


def prompt_reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.coalesce("reason", F.lit("accepted"))
    return prompt_validate(spark, sf_dir).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def prompt_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results that pass, in normalised form."""
    return prompt_normalize(spark, sf_dir).filter(T.prompt_reason(F.col("prompt")).isNull())


def query_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector queries of each speaker: cleaned, without repeats in any case, the first spelling kept."""
    parts = table(spark, sf_dir, "conversations").select("role", "conv_id", "turn", F.posexplode(F.split("text", ",")).alias("pos", "part"))
    cleaned = parts.select("role", "conv_id", "turn", "pos", T.clean_query(F.col("part")).alias("query")).filter("query <> ''")
    first = cleaned.withColumn("folded", T.casefold(F.col("query"))).groupBy("role", "folded").agg(F.min(F.struct("conv_id", "turn", "pos", "query")).alias("first"))
    return first.select("role", "folded", "first.query", F.col("first.conv_id").alias("conv_id"), F.col("first.turn").alias("turn"), F.col("first.pos").alias("pos"))


def response_unfenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with and without a fence give the same JSON."""
    fence = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("```\n"), F.col("props"), F.lit("```"))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", T.unfenced(fence).alias("answer"))


QUERIES = {f.__name__: f for f in (prompt_normalize, prompt_counts, prompt_validate, prompt_reject_histogram, prompt_accepted, query_dedupe, response_unfenced)}
ORACLES = {
    "prompt_normalize": _SPOKEN + "select key, prompt from normal",
    "prompt_counts": _SPOKEN + "select key, cast(length(prompt) as int) as characters, words, sentences from counted",
    "prompt_validate": _SPOKEN + "select key, reason from judged",
    "prompt_reject_histogram": _SPOKEN + "select coalesce(reason, 'accepted') as reason, count(*) as n from judged group by 1",
    "prompt_accepted": _SPOKEN + "select key, prompt from judged where reason is null",
    "query_dedupe": f"""
with parts as (
  select role, conv_id, turn, string_split(text, ',') as p from conversations
), cleaned as (
  select role, conv_id, turn, i - 1 as pos, trim(regexp_replace(p[i], '{T.WHITE}+', ' ', 'g'), ' ,.;:') as query
  from (select *, unnest(range(1, len(p) + 1)) as i from parts)
), ranked as (
  select *, replace(lower(query), 'ſ', 's') as folded, row_number() over (partition by role, replace(lower(query), 'ſ', 's') order by conv_id, turn, pos) as k
  from cleaned where query <> ''
)
select role, folded, query, conv_id, turn, cast(pos as int) as pos from ranked where k = 1""",
    "response_unfenced": "select event_id, trim(props) as answer from events",
}
