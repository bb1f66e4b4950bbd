"""Chat logs: cumulative snapshots are collapsed, then what remains is rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_START, _END = "<|im_start|>", "<|im_end|>"


def turn_lists(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and its sorted ``turns``.

    Rows that agree in conversation, turn, role and text count once.  Turns sort
    by number, then role, then text, nulls first.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text")
    )
    return turns.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.array_sort(F.collect_set(turn)).alias("turns")
    )


def prefix_hashes(turns: Column) -> Column:
    """Rolling hashes: the k-th is that of the first k turns' roles and texts.

    Each turn is hashed with the hash before it; null differs from empty.
    """

    def step(hashes: Column, turn: Column) -> Column:
        fields = [F.coalesce(F.concat(F.lit("="), turn[name]), F.lit("-")) for name in ("role", "text")]
        before = F.coalesce(F.try_element_at(hashes, F.lit(-1)), F.lit(""))
        # The role's length keeps (role, text) apart from other splits of the same characters.
        size = F.coalesce(F.length(turn["role"]), F.lit(0)).cast("string")
        return F.concat(hashes, F.array(F.sha2(F.concat(before, size, *fields).cast("binary"), 256)))

    return F.when(F.size(turns) == 0, F.array().cast("array<string>")).otherwise(
        F.aggregate(turns, F.array().cast("array<string>"), step)
    )


def rendered(turns: Column) -> Column:
    """Turns in ChatML, one after the other; null role or text is empty.

    Markers inside a role or text lose their bars, so they cannot end a turn.
    """

    def clean(value: Column) -> Column:
        for marker in (_START, _END):
            value = F.replace(value, F.lit(marker), F.lit(marker.replace("|", "")))
        return F.coalesce(value, F.lit(""))

    def one(turn: Column) -> Column:
        return F.concat(
            F.lit(_START), clean(turn["role"]), F.lit("\n"), clean(turn["text"]), F.lit(_END + "\n")
        )

    return F.array_join(F.transform(turns, one), "")


def collapse_snapshots(turns: DataFrame) -> DataFrame:
    """Maximal conversations, rendered.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns are
    ignored.  A conversation whose turns are the first turns of a longer one is a
    snapshot of it and goes.  Of conversations with the same turns the smallest id
    stays (null only if there is no other), and ``copies`` tells how many there
    were.  Turn numbers only order the turns; they are not compared.  Rows with a
    null id are one conversation.  An empty table gives an empty result.

    A conversation is put together in one row because its rendering is one value.
    Only hashes are compared: copies meet after partial aggregation, and prefix
    hashes are distinct before the anti-join, so a very common first turn costs a
    row per task.
    """
    lists = turn_lists(turns)
    hashed = lists.select("conv_id", prefix_hashes(F.col("turns")).alias("_hashes"))
    whole = hashed.groupBy(F.element_at("_hashes", -1).alias("_hash")).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies")
    )
    prefixes = hashed.select(
        F.explode(F.expr("slice(_hashes, 1, size(_hashes) - 1)")).alias("_hash")
    ).distinct()
    kept = whole.join(prefixes, "_hash", "left_anti").select(F.col("conv_id").alias("_kept"), "copies")
    return lists.join(kept, F.col("conv_id").eqNullSafe(F.col("_kept"))).select(
        "conv_id",
        F.size("turns").alias("n_turns"),
        "copies",
        rendered(F.col("turns")).alias("rendered"),
    )


COLLAPSE_SQL = f"""
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
lists AS (
  SELECT conv_id, list(struct_pack(role := role, text := text)
    ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l
  FROM rows GROUP BY conv_id),
whole AS (SELECT l, MIN(conv_id) AS conv_id, COUNT(*) AS copies FROM lists GROUP BY l),
prefixes AS (
  SELECT DISTINCT l[1:k] AS p
  FROM (SELECT l, UNNEST(range(1, len(l))) AS k FROM whole))
SELECT conv_id, CAST(len(l) AS INTEGER) AS n_turns, copies,
  array_to_string(list_transform(l, lambda x: '{_START}'
    || replace(replace(coalesce(x.role, ''), '{_START}', '<im_start>'), '{_END}', '<im_end>') || chr(10)
    || replace(replace(coalesce(x.text, ''), '{_START}', '<im_start>'), '{_END}', '<im_end>')
    || '{_END}' || chr(10)), '') AS rendered
FROM whole WHERE NOT EXISTS (SELECT 1 FROM prefixes WHERE p = l)
"""
