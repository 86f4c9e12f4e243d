"""MinHash near-dedup by a signature-coordinate inverted join.

1. Each text becomes its set of shingles; texts of equal sets form a class, held by its least id.
2. A signature has 32 coordinates, each made of the least values of two hash permutations, so that two
   sets of Jaccard likeness j agree on one with probability j * j. Such coordinates stay selective
   where a large corpus has used up its word pairs and single values are shared by everything.
3. Each class is posted under each (coordinate, value). Values of one class only tell nothing and go;
   a class needs `least` shared ones to have any partner. Its values are put in order of frequency: two classes that agree on
   `least` of them share one among each one's rarest (its own count - least + 1). Only that prefix is
   joined, the rest is skipped and looked up in the signatures, which give the count of agreements.
4. Pairs that agree on `least` coordinates or more are confirmed on the full sets.

Long postings are never expanded into all pairs. Each posting has a head, the member whose coordinates
are the most frequent. A class refers to the most frequent head that it met and is somewhat like, its hub, and is
known by its edits: the shingles that it or the hub has alone. For two classes
with one hub, edit counts s and sizes n, the sets differ in s + s' - 2 * (edits in common) shingles and
may differ in a fixed share of n + n'. So without any common edit they link only if s and s' are
small enough together, and then both link with the class of the hub for which s is least against n;
any other link has so many common edits that one is among each one's rarest. Edits are therefore joined by
that prefix, as coordinates are, and copies of one text with edits of their own never meet. Classes with
different hubs meet in their postings; where that would make more than WIDE pairs in one posting, its members are also known by
their edits of its head instead. Every pair that meets and is not yet connected is compared, first the likest of each
two components, then what is still apart, so no link between different texts is lost.

`least` is 6 of 32: a pair at the threshold of 0.8 agrees on 20 of 32, and on fewer than 6 once in forty million.

Null and empty texts have empty sets and link with nothing; rows with a null doc_id are returned
with no component and are kept; repeated rows link as equal texts; where a doc_id stands on several
rows, each text is a node of its own and the component is the least doc_id in it; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.llm.common import scoped, shuffle_partitions, slices, stored
from marquetry.llm.components import components
from marquetry.llm.packed import opened, pack
from marquetry.llm.shingles import mix, shingle_sets, signatures

COORDINATES, LEAST = 32, 6
#: So many agreements make a class known by its edits of a head (a likeness of about 0.25).
ALIKE = 2
#: A posting makes so many pairs at most; the members of wider ones are compared by their edits of its head.
WIDE = 4096
#: So many texts meet one copy of their hub's text.
GROUP = 256
#: Up to so many rows of four numbers (32 MB) are sent to all tasks; more of them meet the texts in a shuffled join.
SENT_IDS = 1_000_000
SETS = "doc_id long, n_shingles long, h1 long, h2 long, signature array<int>"


def sets_of(docs: DataFrame, words: int, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, 128 bits that stand for the set, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, sizes = shingle_sets(batch.column("text"), words)
            ends = np.cumsum(sizes)
            sums = np.zeros((2, len(hashes) + 1), np.uint64)
            np.cumsum(mix(hashes + np.uint64(1)), out=sums[0, 1:])
            np.cumsum(mix(hashes ^ np.uint64(0x5555555555555555)), out=sums[1, 1:])
            h1, h2 = ((s[ends] - s[ends - sizes]).view(np.int64) for s in sums)
            least = signatures(hashes, sizes, 2 * coordinates)
            values = (mix(least[:, ::2]) ^ least[:, 1::2]).astype(np.uint32).view(np.int32).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * coordinates), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(h1), pa.array(h2), lists], names=[c.split()[0] for c in SETS.split(", ")])

    return docs.mapInArrow(run, SETS)


def _few(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row: sent to all tasks if it is small."""
    return F.broadcast(df) if df.count() <= SENT_IDS else df


_TAGGED = "hub long, salt long, kind int, b long, text binary"


def beside(pairs: DataFrame, texts: DataFrame, words: int, judge: Callable[[np.ndarray, np.ndarray], tuple | None], columns: dict[str, pa.DataType]) -> DataFrame:
    """a, b and what judge(set of a, set of b) gives as `columns`, for every pair (a, b) but those for which it gives None.

    pairs: a written table. texts: doc_id, text; ids occur once. The text of b goes to a's, of which every GROUP
    pairs have a copy, so that any share of all pairs may have one a. Texts travel packed.
    """
    spark = pairs.sparkSession
    counted = stored(pairs.groupBy("a").agg(F.count("*").alias("m")))
    sized = pairs.join(_few(counted), "a").select(F.col("a").alias("hub"), F.expr(f"pmod(xxhash64(b), ceil(m / {GROUP}))").alias("salt"), "b")
    left = counted.select(F.col("a").alias("hub"), F.expr(f"explode(sequence(0L, cast(ceil(m / {GROUP}) as bigint) - 1))").alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("b"))
    asked = stored(left.unionByName(sized.withColumn("kind", F.lit(1))))
    found = texts.join(_few(asked), texts["doc_id"] == asked["b"]).select("hub", "salt", "kind", "b", "text")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pack(batch.column("text"))], names=batch.schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, head = None, None
        for batch in opened(batches, ["text"], 1_000_000):
            hashes, sizes = shingle_sets(batch.column("text"), words)
            sets = np.split(hashes, np.cumsum(sizes)[:-1])
            out: list[tuple] = []
            for group, kind, b, found in zip(batch.column("hub").to_pylist(), batch.column("kind").to_pylist(), batch.column("b").to_pylist(), sets, strict=True):
                if kind == 0:
                    hub, head = group, found
                elif group == hub and (told := judge(head, found)) is not None:
                    out.append((group, b, *told))
            values = list(zip(*out, strict=True)) or [()] * (2 + len(columns))
            kinds = [pa.int64(), pa.int64(), *columns.values()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=["a", "b", *columns])

    told = {pa.int64(): "long", pa.list_(pa.int64()): "array<long>"}
    dealt = found.mapInArrow(packed, _TAGGED).repartition(shuffle_partitions(spark), "hub", "salt").sortWithinPartitions("hub", "salt", "kind")
    return dealt.mapInArrow(run, ", ".join(["a long", "b long", *(f"{c} {told[t]}" for c, t in columns.items())]))


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def judge(x: np.ndarray, y: np.ndarray) -> tuple | None:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return () if 100 * both >= percent * (len(x) + len(y) - both) else None

    return beside(pairs, texts, words, judge, {})


def edits(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """pairs (a: a hub, b) -> hub, doc_id, n_hub, n, s, edits (hashes of the shingles that one of both has alone)."""

    def judge(x: np.ndarray, y: np.ndarray) -> tuple:
        alone = np.setxor1d(x, y, assume_unique=True).view(np.int64)
        return len(x), len(y), len(alone), alone

    kinds = {"n_hub": pa.int64(), "n": pa.int64(), "s": pa.int64(), "edits": pa.list_(pa.int64())}
    return beside(pairs, texts, words, judge, kinds).withColumnsRenamed({"a": "hub", "b": "doc_id"})


def postings_of(classes: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, key, weight: the prefix under which each class that may have a partner is posted, and the frequency of all its coordinates."""
    posted = classes.select("doc_id", F.posexplode("signature").alias("k", "value")).select("doc_id", F.expr("shiftleft(cast(k as bigint), 32) | (cast(value as bigint) & 4294967295)").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = posted.join(shared, "key").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("keys"), F.sum("df").alias("weight"))
    return ordered.filter(F.size("keys") >= least).select("doc_id", F.expr(f"explode(slice(keys, 1, size(keys) - {least} + 1).key)").alias("key"), "weight")


def _agreeing(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with `same`, on how many coordinates they agree; `sized` and `alike`: whether their sizes allow a link, and a likeness of 0.25."""
    a = held.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    b = held.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    same = F.expr("size(filter(zip_with(s_a, s_b, (x, y) -> x = y), same -> same))")
    sized = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return pairs.join(a, "a").join(b, "b").select(*pairs.columns, same.alias("same"), sized.alias("sized"), F.expr("4 * least(n_a, n_b) >= greatest(n_a, n_b)").alias("alike"))


def _hubs(met: DataFrame, held: DataFrame, percent: int, alike: int) -> DataFrame:
    """doc_id, hub: the first of the heads that a class met and is like, or itself; the very first is tried before all others."""
    first = met.groupBy("doc_id").agg(F.min("head").alias("head"))

    def liked(pairs: DataFrame) -> DataFrame:
        near = _agreeing(pairs.select(F.col("head.d").alias("a"), F.col("doc_id").alias("b"), "head"), held, percent)
        return near.filter(F.col("alike") & (F.col("same") >= alike)).select(F.col("b").alias("doc_id"), "head")

    once = stored(liked(first))
    others = met.join(once, "doc_id", "left_anti").select("doc_id", "head").distinct()
    later = liked(others).groupBy("doc_id").agg(F.min("head").alias("head"))
    found = once.union(later).select("doc_id", F.col("head.d").alias("hub"))
    return held.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("hub", "doc_id").alias("hub"))


def link(postings: DataFrame, held: DataFrame, texts: DataFrame, words: int, percent: int, least: int, alike: int) -> DataFrame:
    """Components, as `components` gives them, of the links among rows that share a posting.

    postings: doc_id, key, weight. held: doc_id, n_shingles, signature. texts: doc_id, text; ids occur once in both.
    """
    rank = F.struct((-F.col("weight")).alias("w"), F.col("doc_id").alias("d"))
    heads = postings.groupBy("key").agg(F.min(rank).alias("head"), F.count("*").alias("m")).filter("m > 1").select("key", "head")
    met = stored(postings.join(heads, "key").select("doc_id", "key", "head"))
    held = stored(held.join(met.select("doc_id").distinct(), "doc_id", "left_semi"))
    refers = stored(_hubs(met, held, percent, alike))
    wide = stored(_wide(met, refers))
    also = met.join(wide, "key", "left_semi").join(refers, "doc_id").filter("head.d <> hub and head.d <> doc_id").select(F.col("head.d").alias("a"), F.col("doc_id").alias("b")).distinct()
    asked = stored(refers.filter("hub <> doc_id").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).union(also))
    known = stored(edits(asked, texts, words))
    # margin: edits less what a row may differ in for its own size, times 100 + percent.
    margin = F.expr(f"{100 + percent} * s - {100 - percent} * n")
    near = known.withColumn("margin", margin)
    own = known.select("hub", F.col("hub").alias("doc_id"), F.expr(f"-{100 - percent} * n_hub").alias("margin")).distinct()
    both = near.select("hub", "doc_id", "margin").union(own)
    best = both.groupBy("hub").agg(F.min(F.struct("margin", "doc_id")).alias("best"), F.min(F.when(F.col("doc_id") != F.col("hub"), F.col("margin"))).alias("low_other"))
    best = stored(best.select("hub", F.col("best.margin").alias("low"), F.col("best.doc_id").alias("nearest"), "low_other"))
    linked = known.filter(f"100 * (n_hub + n - s) >= {percent} * (n_hub + n + s)").select(F.col("hub").alias("u"), F.col("doc_id").alias("v"))
    nearest = both.join(best, "hub").filter("margin + low <= 0 and doc_id <> nearest").select(F.col("doc_id").alias("u"), F.col("nearest").alias("v"))
    state = components(linked.union(nearest))
    at = stored(_placed(refers, state))
    rest = _by_edits(near, best, at, percent).union(_across(met.join(wide, "key", "left_anti"), at)).distinct()
    open_pairs = stored(_agreeing(rest, held, percent).filter(F.col("sized") & (F.col("same") >= least)).select("a", "b", "same"))
    # The likest pair of each two components first: most of the others are then in one component.
    for likest in (True, False):
        apart = _apart(open_pairs, state)
        if likest:
            apart = apart.groupBy("c_a", "c_b").agg(F.max(F.struct("same", "a", "b")).alias("p")).select("p.a", "p.b")
        chosen = stored(apart.select("a", "b"))
        if chosen.isEmpty():
            break
        more = stored(confirm(chosen, texts, words, percent).select(F.col("a").alias("u"), F.col("b").alias("v")))
        if not more.isEmpty():
            state = components(state.union(more))
    return state


def _placed(refers: DataFrame, state: DataFrame) -> DataFrame:
    """With c, the component so far."""
    placed = state.select(F.col("u").alias("doc_id"), F.col("v").alias("c"))
    return refers.join(placed, "doc_id", "left").select(*refers.columns, F.coalesce("c", "doc_id").alias("c"))


def _apart(pairs: DataFrame, state: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components, with these (c_a < c_b)."""
    for end in ("a", "b"):
        pairs = pairs.join(state.select(F.col("u").alias(end), F.col("v").alias(f"c_{end}")), end, "left").withColumn(f"c_{end}", F.coalesce(f"c_{end}", end))
    low, high = F.least("c_a", "c_b").alias("c_a"), F.greatest("c_a", "c_b").alias("c_b")
    return pairs.filter("c_a <> c_b").select("a", "b", "same", low, high)


def _wide(met: DataFrame, refers: DataFrame) -> DataFrame:
    """Keys under which the members of several hubs would make too many pairs."""
    hubs = met.join(refers, "doc_id").groupBy("key", "hub").agg(F.count("*").alias("m"))
    return hubs.groupBy("key").agg(F.sum("m").alias("m"), F.max("m").alias("top")).filter(f"(m - top) * m > {WIDE}").select("key")


def _by_edits(near: DataFrame, best: DataFrame, at: DataFrame, percent: int) -> DataFrame:
    """Pairs of one hub and different components that share an edit among each one's rarest."""
    known = near.join(at.select("doc_id", "c"), "doc_id")
    several = known.groupBy("hub").agg(F.min("c").alias("low_c"), F.max("c").alias("high_c")).filter("low_c < high_c").select("hub")
    rows = stored(known.join(several, "hub", "left_semi").join(best.select("hub", "low_other"), "hub").select("hub", "doc_id", "c", "margin", "low_other", "edits"))
    posted = rows.select("hub", "doc_id", F.explode("edits").alias("edit"))
    shared = posted.groupBy("hub", "edit").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = posted.join(shared, ["hub", "edit"]).groupBy("hub", "doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "edit"))).alias("shared"))
    # So many common edits are needed at least, whoever the partner is; the hub itself was compared with all.
    need = F.expr(f"greatest(1L, cast(ceil((margin + low_other) / {2.0 * (100 + percent)}) as bigint))")
    rare = rows.select("hub", "doc_id", "c", "margin", need.alias("need")).join(ordered, ["hub", "doc_id"]).withColumn("size", F.size("shared")).filter("size >= need")
    prefix = stored(rare.select("hub", "doc_id", "c", "margin", "size", F.expr("posexplode(slice(shared, 1, cast(size - need + 1 as int)).edit)").alias("pos", "edit")))
    # With this very partner more may be needed; the first common edit then stands further up in both lists.
    pair_need = f"greatest(1L, cast(ceil((s.margin + m.x_margin) / {2.0 * (100 + percent)}) as bigint))"
    return _pairs(prefix, ["hub", "edit"], ["c"], ["margin", "size", "pos"], f"s.pos + {pair_need} <= s.size and m.x_pos + {pair_need} <= m.x_size")


def _across(met: DataFrame, at: DataFrame) -> DataFrame:
    """Pairs that share a posting and have neither hub nor component in common."""
    members = met.select("doc_id", "key").join(at, "doc_id")
    return _pairs(members, ["key"], ["c", "hub"])


def _pairs(members: DataFrame, keys: list[str], apart: list[str], more: list[str] = [], where: str = "true") -> DataFrame:  # noqa: B006
    """Pairs under one key that differ in all of `apart` and satisfy `where`, which may use `more`; keys whose members agree in one of them are left out first.

    Members that have the key's commonest value do not meet each other, so a key of one large group is not expanded.
    """
    one = apart[-1]
    kinds = members.groupBy(*keys, one).agg(F.count("*").alias("m")).groupBy(*keys).agg(F.max(F.struct("m", F.col(one).alias("top"))).alias("top"), F.count("*").alias("kinds"))
    several = members.join(kinds.filter("kinds > 1").select(*keys, F.col("top.top").alias("top")), keys)
    minor = several.filter(F.col(one) != F.col("top")).select(*keys, F.col("doc_id").alias("x"), *(F.col(k).alias(f"x_{k}") for k in [*apart, *more]))
    differ = " and ".join([*(f"s.{k} = m.{k}" for k in keys), *(f"s.{k} <> m.x_{k}" for k in apart)])
    met = several.alias("s").join(minor.alias("m"), F.expr(f"{differ} and (s.{one} = s.top or s.doc_id < m.x) and {where}"))
    return met.select(F.least("doc_id", "x").alias("a"), F.greatest("doc_id", "x").alias("b")).distinct()


def nodes(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(doc_id, text without null ids; whether doc_ids repeat). Repeated ones give way to a hash of doc_id and text, so that every id stands on one text."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    if plain.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return plain, False
    return stored(plain.select(node(True).alias("doc_id"), "text").dropDuplicates(["doc_id"])), True


def node(repeated: bool, text_hash: Column | None = None) -> Column:
    """The id of `nodes`; text_hash: xxhash64 of the text, null as empty."""
    h = F.xxhash64(F.coalesce("text", F.lit(""))) if text_hash is None else text_hash
    return F.xxhash64("doc_id", h) if repeated else F.col("doc_id")


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = COORDINATES, least: int = LEAST, alike: int = ALIKE) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable over links), kept; a row for each row of docs."""
    own = ["h1", "h2", "n_shingles"]
    with scoped(docs.sparkSession):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        texts, repeated = nodes(rows)
        found = stored(sets_of(rows, words, coordinates), keep=True)
        sets = found if not repeated else stored(sets_of(texts, words, coordinates))
        classes = stored(sets.filter("n_shingles > 0 and doc_id is not null").groupBy(*own).agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature")))
        state = link(stored(postings_of(classes, least)), classes.select("doc_id", "n_shingles", "signature"), texts, words, percent, least, alike)
        placed = classes.join(state, classes["doc_id"] == state["u"], "left").select(*own, F.coalesce("v", classes["doc_id"]).alias("component"))
        if repeated:  # from nodes back to the least doc_id
            ids = found.filter("n_shingles > 0 and doc_id is not null").join(placed, own).groupBy("component").agg(F.min("doc_id").alias("least_id"))
            placed = placed.join(ids, "component").select(*own, F.col("least_id").alias("component"))
        placed = stored(placed, keep=True)
    joined = found.drop("signature").join(placed, own, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


#: near_groups with two words over the table `documents`, in DuckDB's SQL, by counting common shingles of all pairs.
ORACLE = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), sets as (
  select doc_id, case when len(w) < 2 then w else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from words
), items as (select doc_id, unnest(s) as x from sets)
, shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from items a join items b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shared join sets p on p.doc_id = a join sets q on q.doc_id = b where 100 * n >= 80 * (len(p.s) + len(q.s) - n)
), both_ways as (select a as u, b as v from links union all select b, a from links)
, reached(u, v) as (
  select doc_id, doc_id from sets union select r.u, l.v from reached r join both_ways l on l.u = r.v
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, c.v as component_id, s.doc_id = c.v as kept from sets s join (select u, min(v) as v from reached group by 1) c on c.u = s.doc_id
"""
