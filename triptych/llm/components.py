"""Connected components of a stored table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.llm.store import Store

_ROWS_PER_FILE = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, store: Store, name: str) -> DataFrame:
    """(node, root) of every node that a link joins to a smaller one.

    ``links`` has bigint columns ``a`` and ``b`` in any order; nodes without links
    and the roots themselves are left out.  The number of rounds grows with the
    logarithm of the longest chain; each round is stored, so nothing is computed
    twice and no lineage grows.  Only counts reach the driver.
    """
    edges = store.save(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{name}0",
    )
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    seen, step = None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)), mark).first()
        if state == seen or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, step = state, step + 1
        # Tables shrink as chains close: few files for few rows.
        files = 1 + state[0] // _ROWS_PER_FILE
        edges = store.save(_small_star(_large_star(edges)).coalesce(files), f"{name}{step}")
        store.drop(f"{name}{step - 1}")
