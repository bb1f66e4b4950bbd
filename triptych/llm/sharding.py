"""Sharding by vector bin packing: bytes, tokens and rows are balanced together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.llm.store import Store, rank_within
from triptych.llm.words import WORD_PATTERN

_DIMENSIONS = ("bytes", "tokens", "rows")


def place_items(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every item; ``items`` has a row of (bytes, tokens, rows) each.

    Large items go first, each to the shard whose residual capacity has the
    highest dot product with it; capacities are equal shares of the totals, and
    every dimension counts in units of its capacity.  Ties go to the first shard.
    """
    scaled = items / np.maximum(items.sum(axis=0) / shards, 1e-300)
    residual = np.ones((shards, items.shape[1]))
    placed = np.zeros(len(items), np.int64)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        placed[i] = np.argmax(residual @ scaled[i])
        residual[placed[i]] -= scaled[i]
    return placed


def shard(
    docs: DataFrame,
    *,
    shards: int = 24,
    bundles_per_shard: int = 256,
    split_share: float = 1 / 32,
) -> DataFrame:
    """Every row's shard and its slot there (gapless from 0).

    Rows with equal text form a group.  Groups are items of the packing: small
    ones are first bundled by a hash of their text into ``shards *
    bundles_per_shard`` bundles, so the packing on the driver is bounded whatever
    the number of groups.  A group that holds more than ``split_share`` of a
    shard's bytes, tokens or rows is an item of its own: at most three times
    ``shards / split_share`` groups.  It stays whole if it fits a shard; a larger
    one is cut into as few even parts as fit one each.

    Result: ``doc_id``, ``size`` (UTF-8 bytes and 8), ``text_crc32`` (null text:
    that of no bytes), ``tokens``, ``law`` (``bytes``), ``shard``, ``slot``, and
    ``grown_shard`` (null).  Repeated rows and null ids are rows like others; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    store = Store(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = store.save(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 8).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint").alias("tokens"),
            F.xxhash64(text).alias("_group"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "rows",
    )
    measures = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    totals = rows.agg(*measures).first()
    if not totals["rows"]:
        return _result(rows.withColumn("_item", F.lit(0)), spark, [], 0)

    # A group's size: its largest share of a shard in any dimension.
    share = F.greatest(*[F.col(name) / F.lit(max(totals[name], 1) / shards) for name in _DIMENSIONS])
    large = store.save(
        rows.groupBy("_group").agg(*measures).select("_group", "rows", share.alias("_share")).filter(
            F.col("_share") > split_share
        ),
        "large",
    )
    count = shards * bundles_per_shard
    parts = F.ceil(F.col("_share") - F.lit(1e-9)).alias("_parts")
    joined = rows.join(F.broadcast(large.select("_group", parts)), "_group", "left")
    # Large groups get ids beyond those of the bundles; a clash of two only joins two items.
    own = F.lit(count) + F.pmod(F.xxhash64("_group", F.coalesce("_part", F.lit(0))), F.lit(1 << 40))
    item = F.when(F.col("_parts").isNull(), F.pmod("_group", F.lit(count))).otherwise(own).alias("_item")
    names = [*rows.columns, item]
    is_cut = F.coalesce(F.col("_parts") > 1, F.lit(False))
    keyed = joined.filter(~is_cut).withColumn("_part", F.lit(0).cast("bigint")).select(*names)
    rows_cut = large.filter(F.col("_share") > 1 + 1e-9).agg(F.sum("rows")).first()[0]
    if rows_cut:
        # By rank, as parts by a hash differ in size and some would not fit.
        ranked = rank_within(joined.filter(is_cut), ["_group"], ["_row"], rows_cut)
        keyed = keyed.unionAll(ranked.withColumn("_part", F.pmod("rank", F.col("_parts"))).select(*names))
    keyed = store.save(keyed, "items")
    found = keyed.groupBy("_item").agg(*measures).orderBy("_item").collect()
    vectors = np.array([[row[name] for name in _DIMENSIONS] for row in found], float)
    placed = place_items(vectors, shards)
    plan = [(row["_item"], int(at)) for row, at in zip(found, placed, strict=True)]
    return _result(keyed, spark, plan, totals["rows"])


def _result(keyed: DataFrame, spark, plan: list[tuple[int, int]], rows: int) -> DataFrame:
    plan_table = spark.createDataFrame(plan, "_item bigint, shard int")
    placed = keyed.join(F.broadcast(plan_table), "_item")
    ranked = rank_within(placed, ["shard"], ["doc_id", "_row"], rows, rank="slot")
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )
