"""Chat formatting by perspective: every participant of a dialogue in turn is the assistant.

For each participant the whole dialogue is rendered with that speaker as ``assistant``, all others
as users by name, and system turns as they are; the mask covers what the speaker said and the
mark that ends it, which is what a model trained on this rendering must write.

Turns are numbered by one distributed sort, and rendered in parts of ``PART`` turns: a dialogue of
any length is many rows, none longer than its part. Offsets count code points within a part.

Defined results: turns are ordered by number (missing last), then speaker, then text; repeated
rows are turns of their own; a missing role is the speaker ``unknown``, a missing text is empty;
``<|`` in a text or role is written ``< |`` and line ends in a role are a blank, so that neither can
forge a mark (roles that become alike by that are one speaker); system is no participant,
so a dialogue of system turns only gives no rows; a missing conv_id is a dialogue like any other;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.common import ranked

PART = 256
START, END = "<|im_start|>", "<|im_end|>"   # fixed values
SYSTEM, UNKNOWN = "system", "unknown"


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Dialogue, number within it, speaker and body of every turn."""
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.regexp_replace(F.replace(F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(UNKNOWN)),
                                   F.lit("<|"), F.lit("< |")), r"[\r\n]+", " ").alias("speaker"),
        F.replace(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit("<|"),
                  F.lit("< |")).alias("body"))
    order = [F.col("conv_id"), F.col("turn").isNull(), F.col("turn"), F.col("speaker"), F.col("body")]
    placed = ranked(rows, order, "_rank", "chat-turns")
    firsts = placed.groupBy("conv_id").agg(F.min("_rank").alias("_first"))
    first = F.col("p.conv_id").eqNullSafe(F.col("f.conv_id"))
    return placed.alias("p").join(firsts.alias("f"), first).select(
        "p.conv_id", (F.col("_rank") - F.col("_first")).alias("number"), "speaker", "body")


def _header(speaker: Column, me: Column) -> Column:
    name = F.when(speaker == SYSTEM, SYSTEM).when(speaker == me, "assistant").otherwise(
        F.concat(F.lit("user name="), speaker))
    return F.concat(F.lit(START), name, F.lit("\n"))


def perspectives(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", part: int = PART) -> DataFrame:
    """``conv_id, perspective, part, n_turns, n_trained, rendered, spans``.

    ``spans`` holds start:end of each trained run within ``rendered``, comma-joined.
    """
    placed = _turns(turns, conv, turn, role, text)
    speakers = placed.where(F.col("speaker") != SYSTEM).groupBy(
        "conv_id", F.col("speaker").alias("me")).agg(F.count(F.lit(1)).alias("_said"))
    # At most ``part`` turns in a row.
    parts = (placed.groupBy("conv_id", F.floor(F.col("number") / part).cast("int").alias("part"))
             .agg(F.array_sort(F.collect_list(F.struct("number", "speaker", "body"))).alias("turns")))
    same = F.col("d.conv_id").eqNullSafe(F.col("s.conv_id"))
    rows = parts.alias("d").join(speakers.alias("s"), same).select("d.*", "me")
    pieces = F.transform("turns", lambda t: F.struct(
        _header(t.speaker, F.col("me")).alias("head"),
        F.concat(t.body, F.lit(END)).alias("said"), (t.speaker == F.col("me")).alias("own")))
    rows = rows.select("conv_id", F.col("me").alias("perspective"), "part", pieces.alias("pieces"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        start = state.at + F.char_length(piece.head)
        stop = start + F.char_length(piece.said)
        span = F.concat_ws(":", start.cast("string"), stop.cast("string"))
        return F.struct((stop + 1).alias("at"), F.when(
            piece.own, F.array_append(state.spans, span)).otherwise(state.spans).alias("spans"))

    spans = F.aggregate("pieces", begin, step, lambda s: F.array_join(s.spans, ","))
    rendered = F.array_join(F.transform(
        "pieces", lambda p: F.concat(p.head, p.said, F.lit("\n"))), "")
    return rows.select("conv_id", "perspective", "part",
                       F.size("pieces").alias("n_turns"),
                       F.size(F.filter("pieces", lambda p: p.own)).alias("n_trained"),
                       rendered.alias("rendered"), spans.alias("spans"))


def check_sql(part: int = PART) -> str:
    """The same rows in the check engine's SQL."""
    return f"""
with base as (
  select conv_id, turn, regexp_replace(replace(coalesce(role, '{UNKNOWN}'), '<|', '< |'),
                                       '[\r\n]+', ' ', 'g') as speaker,
         replace(coalesce(text, ''), '<|', '< |') as body
  from conversations),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls last, speaker, body) - 1 as number
  from base),
speakers as (select distinct conv_id, speaker as me from placed where speaker <> '{SYSTEM}'),
pieces as (
  select p.conv_id, me, number // {part} as part, number, speaker = me as own,
         '{START}' || case when speaker = '{SYSTEM}' then speaker when speaker = me then 'assistant'
                           else 'user name=' || speaker end || chr(10) as head,
         body || '{END}' as said
  from placed p join speakers s on p.conv_id is not distinct from s.conv_id),
counted as (
  select *, sum(length(head) + length(said) + 1) over (partition by conv_id, me, part order by number)
            - length(said) - 1 as start
  from pieces)
select conv_id, me as perspective, part::int as part, count(*)::int as n_turns,
       count(*) filter (own)::int as n_trained,
       string_agg(head || said || chr(10), '' order by number) as rendered,
       coalesce(string_agg(start::bigint || ':' || (start + length(said))::bigint, ',' order by number)
                filter (own), '') as spans
from counted group by conv_id, me, part"""
