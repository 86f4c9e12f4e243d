"""Secret scans: base spans by pattern, and weak parts that count only next to their complement.

DataFrame and SQL functions only. Spans are code points, end exclusive.

Base kinds are `assign`, `access` and `hex`. The method adds `login`, `key` and `endpoint`: parts
too weak to report alone (a user name, a random-looking string, an address of a service). They are
found by an interval join: every part, widened by the reach of its scope, meets the parts of the
other families in buckets of that width. Inside a bucket only the lowest start and the highest
end of a family are needed to decide whether a part lies within reach, so a bucket never holds
more than one row for each family, however many parts crowd it, and no pairs are made.

A weak secret (`key`) is reported when an identifier or an endpoint lies within reach, a weak
identifier or an endpoint when a secret does.

Null and empty texts have no spans; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquetry.llm.common import stored

#: The order of kinds in the span lists (fixed values).
KINDS = ["assign", "access", "hex", "login", "key", "endpoint"]
#: Patterns; base ones come first. Runs are maximal, so a least length inside the pattern finds the same runs as a later test.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LOGIN = r"""(?i:\b(?:user(?:_?name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
KEY = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"""(?i:\b(?:https?|ftps?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)://)[^\s"'<>]+"""
#: Which families make a part of this family worth reporting.
FAMILY = {"assign": "secret", "hex": "secret", "key": "secret", "access": "id", "login": "id", "endpoint": "endpoint"}
#: Code points between two parts of one credential at most.
REACH = 240
_BLOCK = 128
_SPANS = "array<struct<s: bigint, e: bigint>>"
_NO_SPANS = f"cast(array() as {_SPANS})"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _located(matches: str, gaps: str) -> str:
    """Spans of matches, as prefix sums over the lengths of what lies between them, in blocks so that many matches stay cheap."""
    steps = f"transform({matches}, (x, i) -> cast(length({gaps}[i]) + length(x) as bigint))"
    total = "aggregate({0}, 0L, (a, y) -> a + y)"
    blocks = f"sequence(0, (size({matches}) - 1) div {_BLOCK})"
    sums = f"transform({blocks}, b -> {total.format(f'slice({steps}, b * {_BLOCK} + 1, {_BLOCK})')})"
    inner = (
        f"transform(slice({matches}, b * {_BLOCK} + 1, {_BLOCK}), (x, k) -> named_struct('x', x, 's', "
        f"base + {total.format('slice(part, 1, k)')} + length({gaps}[b * {_BLOCK} + k])))"
    )
    inner = f"transform(array(slice({steps}, b * {_BLOCK} + 1, {_BLOCK})), part -> {inner})[0]"
    inner = f"transform(array({total.format('slice(sums, 1, b)')}), base -> {inner})[0]"
    found = f"transform(array({sums}), sums -> flatten(transform({blocks}, b -> {inner})))[0]"
    return f"transform({found}, m -> named_struct('s', m.s, 'e', m.s + length(m.x)))"


def _with_spans(df: DataFrame, kind: str, pattern: str, when: str, keep: str | None = None) -> DataFrame:
    """Add column `kind`: its spans. when: a cheap condition without which there are none. keep: a test of a match `v`."""
    p = _quoted(pattern)
    group = 2 if kind == "assign" else 0
    df = df.withColumn("_m", F.expr(f"case when {when} then regexp_extract_all(text, {p}, 0) else array() end"))
    df = df.withColumn("_g", F.expr(f"case when size(_m) > 0 then split(text, {p}, -1) end"))
    if keep:
        df = df.withColumn("_v", F.expr(f"case when size(_m) > 0 then regexp_extract_all(text, {p}, {group}) end"))
    spans = _located("_m", "_g")
    if keep:
        spans = f"filter({spans}, (m, i) -> exists(array(_v[i]), v -> {keep}))"
    return df.withColumn(kind, F.expr(f"case when size(_m) > 0 then {spans} else {_NO_SPANS} end")).drop("_m", "_g", "_v")


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text; tells rows of one doc_id apart), and spans of every kind; weak ones are not linked yet."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = df.withColumn("h", F.xxhash64("text"))
    some = "(instr(text, '=') > 0 or instr(text, ':') > 0)"
    df = _with_spans(df, "assign", ASSIGN, some, "length(v) >= 6")
    df = _with_spans(df, "access", ACCESS, "instr(text, 'AKIA') > 0")
    df = _with_spans(df, "hex", HEX, "true")
    df = _with_spans(df, "login", LOGIN, some)
    df = _with_spans(df, "endpoint", ENDPOINT, "instr(text, '://') > 0")
    df = _with_spans(df, "key", KEY, "size(access) + size(login) + size(endpoint) > 0", "v rlike '[0-9]' and v rlike '[a-z]' and v rlike '[A-Z]'")
    return df.select("doc_id", "h", *KINDS)


def _listed(kinds: list[str]) -> Column:
    """All spans of these kinds by start, then kind, as kind:start:end, comma-joined."""
    tagged = ", ".join(f"transform({k}, x -> named_struct('s', x.s, 'k', {KINDS.index(k)}, 'e', x.e))" for k in kinds)
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform(array_sort(concat({tagged})), x -> concat_ws(':', array({names})[x.k], x.s, x.e)), ',')")


def link(found: DataFrame, reach: int = REACH) -> DataFrame:
    """From `parts`: doc_id, h, and the weak spans that have a complement within reach."""
    some = F.expr("size(login) + size(key) + size(endpoint) > 0 and size(assign) + size(hex) + size(key) > 0 and size(access) + size(login) + size(endpoint) > 0")
    tagged = ", ".join(f"transform({k}, x -> named_struct('kind', '{k}', 'family', '{FAMILY[k]}', 's', x.s, 'e', x.e))" for k in KINDS)
    all_parts = found.filter(some).select("doc_id", "h", F.expr(f"inline(concat({tagged}))"))
    near = (
        all_parts.select("doc_id", "h", "family", "s", "e", F.expr(f"explode(sequence(s div {reach}, e div {reach}))").alias("bucket"))
        .groupBy("doc_id", "h", "bucket", "family")
        .agg(F.min("s").alias("low"), F.max("e").alias("high"))
    )
    weak = (
        all_parts.filter(F.col("kind").isin("login", "key", "endpoint"))
        .distinct()
        .withColumn("bucket", F.expr(f"explode(sequence(greatest(s - {reach}, 0L) div {reach}, (e + {reach}) div {reach}))"))
        .alias("w")
    )
    meets = F.expr(
        f"w.doc_id <=> n.doc_id and w.h = n.h and w.bucket = n.bucket and n.low <= w.e + {reach} and n.high >= w.s - {reach} "
        "and case w.family when 'secret' then n.family in ('id', 'endpoint') else n.family = 'secret' end"
    )
    linked = weak.join(near.alias("n"), meets, "left_semi").select("doc_id", "h", "kind", "s", "e").distinct()
    spans = [F.expr(f"array_sort(collect_list(case when kind = '{k}' then named_struct('s', s, 'e', e) end))").alias(k) for k in ("login", "key", "endpoint")]
    return linked.groupBy("doc_id", "h").agg(*spans)


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, h and the spans of every kind, the weak ones linked; one row for each row of docs."""
    found = stored(parts(docs))
    linked = link(found, reach).alias("l")
    joined = found.alias("f").join(linked, F.expr("f.doc_id <=> l.doc_id and f.h = l.h"), "left")
    kept = [F.coalesce(F.col(f"l.{k}"), F.expr(_NO_SPANS)).alias(k) for k in ("login", "key", "endpoint")]
    return joined.select("f.doc_id", "f.h", "f.assign", "f.access", "f.hex", *kept)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked (weak spans reported)."""
    return scan(docs).select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
        F.expr("cast(size(login) + size(key) + size(endpoint) as bigint)").alias("n_linked"),
    )


def _replaced(label: str) -> str:
    """The text with every one of `_cuts` replaced; in blocks of cuts, so that many of them stay cheap."""
    last, total = "size(_cuts)", "length(text)"
    end_before = "case when i = 0 then 0 else _cuts[i - 1].e end"
    gap = f"substring(part, cast({end_before} - base + 1 as int), cast((case when i = {last} then {total} else _cuts[i].s end) - {end_before} as int))"
    inner = f"transform(sequence(b * {_BLOCK}, least((b + 1) * {_BLOCK} - 1, {last})), i -> {gap})"
    stop = f"case when (b + 1) * {_BLOCK} > {last} then {total} else _cuts[(b + 1) * {_BLOCK} - 1].s end"
    inner = f"transform(array(substring(text, cast(base + 1 as int), cast({stop} - base as int))), part -> {inner})[0]"
    inner = f"transform(array(case when b = 0 then 0L else _cuts[b * {_BLOCK} - 1].e end), base -> {inner})[0]"
    return f"array_join(flatten(transform(sequence(0, {last} div {_BLOCK}), b -> {inner})), '{label}')"


def redact(docs: DataFrame, label: str = "[SECRET]") -> DataFrame:
    """docs with every reported secret replaced by `label` and n_chars set anew; all columns and rows stay.

    Overlapping spans are merged first. Identifiers and endpoints stay, as they open nothing alone.
    """
    found = scan(docs).filter("size(assign) + size(access) + size(hex) + size(key) > 0").dropDuplicates(["doc_id", "h"])
    spans = found.select(F.col("doc_id").alias("_doc"), F.col("h").alias("_h"), F.expr("inline(array_distinct(concat(assign, access, hex, key)))"))
    # A span begins a piece unless an earlier one reaches it.
    ordered = Window.partitionBy("_doc", "_h").orderBy("s", "e")
    before = F.coalesce(F.max("e").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    begun = spans.withColumn("begins", (before < F.col("s")).cast("int"))
    pieces = begun.withColumn("piece", F.sum("begins").over(ordered.rowsBetween(Window.unboundedPreceding, 0))).groupBy("_doc", "_h", "piece").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    cuts = pieces.groupBy("_doc", "_h").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("_cuts"))  # of one text
    joined = docs.withColumn("_t", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))).join(cuts, F.expr("doc_id <=> _doc and _t = _h"), "left")
    joined = joined.withColumn("text", F.expr(f"case when _cuts is null then text else {_replaced(label)} end"))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("_cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return joined.select(*docs.columns)


def _sql() -> str:
    """`digests` over the table `documents` in DuckDB's SQL. A run of KEY's characters is matched whole, so its look-behind is not needed there."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "login": LOGIN, "key": KEY.partition(")")[2], "endpoint": ENDPOINT}
    found = " union all ".join(
        f"select r, doc_id, '{kind}' as kind, {KINDS.index(kind)} as k, '{FAMILY[kind]}' as family, regexp_extract_all(x, {quoted(p)}, 0) as m, "
        f"regexp_extract_all(x, {quoted(p)}, {2 if kind == 'assign' else 0}) as v, string_split_regex(x, {quoted(p)}) as gaps from texts"
        for kind, p in patterns.items()
    )
    return f"""with texts as (select row_number() over () as r, doc_id, coalesce(text, '') as x from documents), found as ({found})
, listed as (select r, kind, k, family, i, m[i] as m, v[i] as g, length(gaps[i]) as gap from (select *, unnest(range(1, len(m) + 1)) as i from found))
, spans as (select r, kind, k, family, cast(sum(gap + length(m)) over (partition by r, kind order by i) as bigint) as e, length(m) as size, g from listed)
, sound as (
  select r, kind, k, family, e - size as s, e from spans
  where case kind when 'assign' then length(g) >= 6 when 'key' then regexp_matches(g, '[0-9]') and regexp_matches(g, '[a-z]') and regexp_matches(g, '[A-Z]') else true end
), used as (select * from sound p where kind <> 'key' or exists (select 1 from sound o where o.r = p.r and o.kind in ('access', 'login', 'endpoint')))
, reported as (
  select * from used w where k <= 2 or exists (
    select 1 from used n where n.r = w.r and n.s <= w.e + {REACH} and n.e >= w.s - {REACH} and case w.family when 'secret' then n.family in ('id', 'endpoint') else n.family = 'secret' end)
), told as (
  select r, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex, count(*) filter (k > 2) as n_linked,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, k) filter (k <= 2) as base, string_agg(kind || ':' || s || ':' || e, ',' order by s, k) as spans
  from reported group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_linked, 0) as n_linked
from texts left join told using (r)"""


ORACLE = _sql()
