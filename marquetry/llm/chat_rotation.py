"""Chat formatting: every participant of a dialogue in turn is the assistant, the others are named users.

DataFrame functions only. For each participant (any speaker but `system`) of each conversation the
result holds the rendered turns in order, each with its place in that rendering and, where the
participant speaks, the span that a training loss covers (the words and the end mark). A rendering
is the concatenation of its segments; it is never gathered into one value, as a conversation may
hold any share of the rows. Places are prefix sums in two levels, first inside blocks of turns,
then over the blocks, so that a long conversation is spread over many tasks.

A null speaker is the participant `unknown`, a null text is empty, null turns come first. Turns of
equal number stand in order of speaker, then text; repeated rows are all kept. Marks inside texts
and names are broken up, so that no text can forge a turn. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Turns with numbers in one range of this size form a block.
BLOCK = 1024
#: The marks of the format (fixed values).
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def rotate(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """turns (conv_id, turn, role, text) -> conv_id, perspective, seq, turn, segment, begin, end, loss_begin, loss_end.

    seq counts a rendering's segments from 1; places are code points, ends exclusive; the loss span
    is null where another speaks.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", F.expr(f"coalesce(floor(turn / {block}), -9223372036854775808)").cast("long"))
    safe = lambda c: F.replace(c, F.lit("<|im_"), F.lit("< |im_"))
    people = rows.filter(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    blocks = rows.select("conv_id", "block").distinct()
    # Each block meets the participants of its conversation, so a long conversation meets them in many places.
    views = blocks.alias("b").join(people.alias("p"), F.expr("b.conv_id <=> p.conv_id")).select("b.conv_id", "b.block", "p.perspective")
    seen = rows.alias("r").join(views.alias("v"), F.expr("r.conv_id <=> v.conv_id and r.block = v.block")).select("r.*", "v.perspective")
    own = F.col("speaker") == F.col("perspective")
    head = (
        F.when(F.col("speaker") == SYSTEM, F.lit(f"{OPEN}system\n"))
        .when(own, F.lit(f"{OPEN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), safe(F.col("speaker")), F.lit("\n")))
    )
    seen = seen.withColumn("head", head).withColumn("segment", F.concat("head", safe(F.col("text")), F.lit(f"{CLOSE}\n")))
    seen = seen.withColumn("size", F.length("segment").cast("long"))
    view = ["conv_id", "perspective"]
    sums = seen.groupBy(*view, "block").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    before = Window.partitionBy(*view).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *view,
        "block",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_n"),
    )
    inside = Window.partitionBy(*view, "block").orderBy("turn", "speaker", "text")
    placed = seen.select(
        "*",
        F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("reach"),
        F.row_number().over(inside).alias("k"),
    )
    joined = placed.alias("s").join(bases.alias("t"), F.expr("s.conv_id <=> t.conv_id and s.perspective = t.perspective and s.block = t.block"))
    end = F.col("base") + F.col("reach")
    loss = (F.col("s.speaker") != SYSTEM) & (F.col("s.speaker") == F.col("s.perspective"))
    begin = end - F.col("s.size")
    return joined.select(
        "s.conv_id",
        "s.perspective",
        (F.col("base_n") + F.col("k")).alias("seq"),
        "s.turn",
        "segment",
        begin.alias("begin"),
        end.alias("end"),
        F.when(loss, begin + F.length("head")).alias("loss_begin"),
        F.when(loss, end - 1).alias("loss_end"),
    )


#: The same over the table `conversations`, in DuckDB's SQL.
ORACLE = """
with rows as (
  select conv_id, turn, coalesce(role, 'unknown') as speaker, coalesce(text, '') as text from conversations
), people as (
  select distinct conv_id, speaker as perspective from rows where speaker <> 'system'
), seen as (
  select r.*, p.perspective,
    case when speaker = 'system' then '<|im_start|>system' || chr(10)
         when speaker = perspective then '<|im_start|>assistant' || chr(10)
         else '<|im_start|>user name=' || replace(speaker, '<|im_', '< |im_') || chr(10) end as head
  from rows r join people p on r.conv_id is not distinct from p.conv_id
), built as (
  select *, head || replace(text, '<|im_', '< |im_') || '<|im_end|>' || chr(10) as segment from seen
), placed as (
  select *, sum(length(segment)) over w as reach, row_number() over w as seq from built
  window w as (partition by conv_id, perspective order by turn nulls first, speaker, text rows unbounded preceding)
)
select conv_id, perspective, cast(seq as bigint) as seq, turn, segment,
  cast(reach - length(segment) as bigint) as "begin", cast(reach as bigint) as "end",
  cast(case when speaker = perspective then reach - length(segment) + length(head) end as bigint) as loss_begin,
  cast(case when speaker = perspective then reach - 1 end as bigint) as loss_end
from placed
"""
