"""Chat formatting with cumulative-snapshot collapse.

Chat logs often hold every state of a growing conversation. Each turn gets a rolling hash
of all turns up to it. A conversation whose last hash is the hash of an inner turn of
another one is a prefix of that one: an anti-join leaves the maximal conversations, and of
equal ones the smallest id stays. Only these are rendered.

Only DataFrame operations. The rolling hash is a running sum of hashes of (position,
turn), kept as four 32-bit lanes of a SHA-256 digest. Running sums are taken inside blocks
of ``BLOCK`` turns and shifted by the blocks before, so a conversation with very many
turns is no single task. Turns are counted before they are shuffled, so a common opening
is one row per task. Text is shuffled once, for the conversations that are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import prepare, read_table, stored

BLOCK = 1024
_LANES = ["_s0", "_s1", "_s2", "_s3"]


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role = F.coalesce(F.col(role_col), F.lit("unknown"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("_turn"),
        role.alias("_role"),
        text.alias("_text"),
        F.sha2(F.concat(role, F.lit("\0"), text), 256).alias("_digest"),
    )


def _before(totals: DataFrame, columns: list[str]) -> DataFrame:
    """For each block of a conversation, the sums over the blocks before it."""
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_block")).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "conv_id", "_block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns]
    )


def _shifted(rows: DataFrame, totals: DataFrame, columns: list[str]) -> DataFrame:
    on = [F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("conv_id", "_block")]
    both = rows.alias("r").join(_before(totals, columns).alias("b"), on)
    kept = [F.col(f"r.`{c}`") for c in rows.columns if c not in columns]
    return both.select(*kept, *[(F.col(f"r.{c}") + F.col(f"b.{c}_before")).alias(c) for c in columns])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, _k`` (1 for the first turn) and the lanes of the hash of the first k turns."""
    rows = turns.select("conv_id", "_turn", "_digest").distinct()
    rows = rows.withColumn("_block", F.floor(F.col("_turn") / BLOCK))
    order = Window.partitionBy("conv_id", "_block").orderBy(F.asc_nulls_first("_turn"), "_digest")
    block = ["conv_id", "_block"]
    sizes = rows.groupBy(*block).agg(F.count("*").alias("_k"))
    rows = stored(_shifted(rows.withColumn("_k", F.row_number().over(order).cast("long")), sizes, ["_k"]), "turn-positions")
    mixed = F.sha2(F.concat_ws(":", F.col("_k"), F.col("_digest")), 256)
    lanes = [F.conv(F.substring(mixed, 8 * i + 1, 8), 16, 10).cast("long").alias(name) for i, name in enumerate(_LANES)]
    rows = rows.select(*block, "_k", *lanes)
    sums = rows.groupBy(*block).agg(*[F.sum(c).alias(c) for c in _LANES])
    running = Window.partitionBy(*block).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*block, "_k", *[F.sum(c).over(running).alias(c) for c in _LANES])
    return _shifted(rows, sums, _LANES)


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, copies`` of those that no longer conversation begins with."""
    hashes = stored(prefix_hashes(turns), "prefix-hashes")
    state = ["_k", *_LANES]
    ends = stored(hashes.groupBy("conv_id").agg(F.max("_k").alias("_k")), "conversation-ends")
    on = F.col("h.conv_id").eqNullSafe(F.col("e.conv_id"))
    joined = hashes.alias("h").join(ends.alias("e"), on)
    last = joined.filter("h._k = e._k").select(*[F.col(f"h.{c}") for c in ("conv_id", *state)])
    inner = joined.filter("h._k < e._k").select(*[F.col(f"h.{c}") for c in state]).distinct()
    heads = last.groupBy(*state).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    return heads.join(inner, state, "left_anti").select("conv_id", F.col("_k").alias("n_turns"), "copies")


def _rendered(turn: Column) -> Column:
    """One turn between the template's marks; the marks are broken where a text holds them."""
    safe = [F.replace(turn[c], F.lit("<|im_"), F.lit("<| im_")) for c in ("_role", "_text")]
    return F.concat(F.lit("<|im_start|>"), safe[0], F.lit("\n"), safe[1], F.lit("<|im_end|>\n"))


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per maximal conversation: ``conv_id, n_turns, copies, text``.

    Turns are in the order of the turn number, a null number first, ties by the digest of
    role and text. Repeated rows count once. A null role is ``unknown``, a null text empty.
    Rows without a conversation id are one conversation. ``copies`` counts equal
    conversations, the one that stays included. An empty table gives an empty result; other
    columns are ignored. A rendered conversation is one value, so it has to fit in a task.
    """
    prepare(rows.sparkSession)
    turns = _turns(rows, conv_col, turn_col, role_col, text_col)
    kept = stored(maximal_conversations(turns), "maximal")
    on = F.col("t.conv_id").eqNullSafe(F.col("m.conv_id"))
    told = turns.alias("t").join(kept.select("conv_id").alias("m"), on, "left_semi")
    told = told.groupBy("conv_id").agg(F.collect_set(F.struct("_turn", "_digest", "_role", "_text")).alias("_all"))
    told = told.select("conv_id", F.array_join(F.transform(F.sort_array("_all"), _rendered), "").alias("text"))
    on = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    return told.alias("a").join(kept.alias("b"), on).select("a.conv_id", "b.n_turns", "b.copies", "a.text")


def op10_chat_formatting(spark, sf_dir: str) -> DataFrame:
    return format_conversations(read_table(spark, sf_dir, "conversations"))


SQL = {
    "op10_chat_formatting": """
        with t as (
            select distinct conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations
        ), o as (
            select *, row_number() over (partition by conv_id order by turn nulls first, sha256(role || chr(0) || text)) as k,
                   count(*) over (partition by conv_id) as n
            from t
        ), p as (
            select *, list(role || chr(0) || text) over (partition by conv_id order by k) as prefix from o
        ), heads as (
            select prefix, min(conv_id) as conv_id, max(n) as n_turns, count(*) as copies from p where k = n group by prefix
        ), kept as (
            select * from heads where prefix not in (select prefix from p where k < n)
        ), told as (
            select conv_id,
                   string_agg('<|im_start|>' || replace(role, '<|im_', '<| im_') || chr(10)
                              || replace(text, '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' order by k) as text
            from o group by conv_id
        )
        select kept.conv_id, n_turns, copies, told.text from kept join told using (conv_id)"""
}
