"""Exact deduplication with a stateful stream.

The rows are stored once, as the content that a locator points to, and arrive in the
stream in several batches.  The stream keeps one state entry per digest, in RocksDB on
the executors' disks and without expiry: the digest, the best identifier, the content
locator of the first arrival, and a count.  A batch's rows whose digest was met, in this
batch or an earlier one, are compared with the located content byte by byte before
the next batch arrives; a digest that two different texts share is split again.
Only the texts compared ever move: the others stay in the buckets they were stored in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triptych.llm.store import Store, chosen_rows, other_rows, with_numbers

_STREAMING = "spark.sql.streaming.stateStore"
_STATE_SETTINGS = {
    f"{_STREAMING}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Every partition has a database; files reserved in advance would outweigh small ones.
    f"{_STREAMING}.rocksdb.allowFAllocate": "false",
    # All databases of an executor share this much memory, and are closed soon after a batch.
    f"{_STREAMING}.rocksdb.boundedMemoryUsage": "true",
    f"{_STREAMING}.rocksdb.maxMemoryUsageMB": "128",
    f"{_STREAMING}.maintenanceInterval": "5s",
}

#: Copies compared with one copy of the located text at a time.
_COMPARED_TOGETHER = 500
#: Batches in which the rows arrive.
_BATCHES = 3


def _text() -> Column:
    return F.coalesce(F.col("_doc.text"), F.lit(""))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in _STATE_SETTINGS}
    for key, value in _STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _best(name: str = "best") -> Column:
    """Largest id, then largest row number; a null id counts as the smallest."""
    return F.max(F.struct(F.col("_id").alias("id"), F.col("_row").alias("row"))).alias(name)


class DigestStream:
    """The stream over digests, and what it has kept so far."""

    def __init__(self, store: Store) -> None:
        self.store, self.spark = store, store.spark
        self.batches: list[int] = []

    def _changes(self, batches: list[int]) -> DataFrame:
        schema = "_digest binary, best struct<id:bigint,row:bigint>, first struct<arrival:int,row:bigint>, n bigint"
        paths = [self.store.path(f"changes/batch={number}") for number in batches]
        return self.spark.read.schema(schema).parquet(*paths)

    def arrive(self, rows: DataFrame) -> DataFrame | None:
        """Let rows (_digest, _id, _row, _arrival) arrive; the state of all digests they have.

        The stream goes on from its checkpoint, so digests of earlier batches are met.  Rows
        are combined per task before they meet the state: a digest that a third of all
        rows share sends one row per task.  A batch writes what it changed under its own
        number: repeated after a failure it replaces itself.  None if no rows arrived.
        """
        store, arrived = self.store, self.store.path("arrivals")
        rows.write.mode("append").parquet(arrived)
        seen = (
            self.spark.readStream.schema(rows.schema)
            .parquet(arrived)
            .groupBy("_digest")
            .agg(
                _best(),
                F.min(F.struct(F.col("_arrival").alias("arrival"), F.col("_row").alias("row"))).alias("first"),
                F.count(F.lit(1)).alias("n"),
            )
        )
        numbers = []

        def keep(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(store.path(f"changes/batch={number}"))
            numbers.append(number)

        with _state_on_disk(self.spark):
            query = (
                seen.writeStream.outputMode("update")
                .foreachBatch(keep)
                .option("checkpointLocation", store.path("stream"))
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        new = sorted(set(numbers))
        self.batches += new
        return self._changes(new) if new else None

    def state(self) -> DataFrame:
        """The last state of every digest: counts only grow, so the largest is the last."""
        found = self._changes(self.batches)
        return found.groupBy("_digest").agg(F.max_by("best", "n").alias("best"), F.max("n").alias("n"))


def _differing(content: DataFrame, arrival: int, changed: DataFrame, store: Store) -> DataFrame:
    """Digests of which an arrived row's text is not that of the located row, byte by byte.

    Both sides are picked out where they are stored.  The copies of a text are dealt to
    shares of about 500, each of which meets its own copy of the located text.
    """
    hits = changed.filter("n > 1").select("_digest", F.col("first.row").alias("_located"), "n")
    arrived = content.filter(F.col("_arrival") == arrival)
    # From 1: the logarithm of the number of shares.
    power = F.greatest(F.ceil(F.log2(F.col("n") / _COMPARED_TOGETHER)), F.lit(0)).cast("int") + 1
    met = arrived.select("_digest", "_row").join(hits.select("_digest", "_located", power.alias("_power")), "_digest")
    suspects = store.save(met.filter("_row != _located"), f"suspects{arrival}")
    located = suspects.groupBy(F.col("_located").alias("_row")).agg(F.max("_power").alias("_power"))
    columns = ["_row", "_chunk", "_digest", _text().alias("_text")]
    shares = F.expr("shiftleft(1, _power - 1)")
    copies = (
        with_numbers(arrived.select(*columns), suspects, "_power", bits=5)
        .filter("_power > 0")
        .withColumn("_share", F.pmod(F.xxhash64("_row"), shares).cast("int"))
    )
    earlier = content.filter(F.col("_arrival") <= arrival).select(*columns)
    originals = (
        with_numbers(earlier, located, "_power", bits=5)
        .filter("_power > 0")
        .select("_digest", F.col("_text").alias("_original"), F.explode(F.sequence(F.lit(0), shares - 1)).alias("_share"))
    )
    compared = copies.join(originals, ["_digest", "_share"])
    return store.save(compared.filter("_text != _original").select("_digest").distinct(), f"differing{arrival}")


def deduplicate(
    docs: DataFrame,
    *,
    digest: Callable[[Column], Column] = sha256,
    batches: int = _BATCHES,
) -> tuple[DataFrame, DataFrame]:
    """(the stored rows, the groups of rows whose text is not unique).

    The first has the row itself as ``_doc``, ``_row`` (a number of its own),
    ``_id`` and ``_digest``.  The second has one row per group of at least two
    equal texts: ``_digest``, ``_text`` (null, or the text where different texts
    share the digest), ``keep_id``, ``keep_row`` and ``group_size``.

    Equal means the same bytes; null counts as empty.  The row with the largest
    ``doc_id`` stays, a null id only in a group without others; of repeated rows
    the one with the largest row number.

    The partitions of ``docs`` are dealt to ``batches`` arrivals, one after the other.
    """
    store = Store(docs.sparkSession)
    content = store.save_rows(
        docs.select(
            F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc"),
            F.col("doc_id").cast("bigint").alias("_id"),
            digest(F.coalesce(F.col("text"), F.lit(""))).alias("_digest"),
            F.pmod(F.spark_partition_id(), F.lit(batches)).alias("_arrival"),
        ),
        "content",
    )
    if content.isEmpty():  # a stream over no rows writes no state
        nothing = content.limit(0).select("_digest", _text().alias("_text"), F.col("_id").alias("keep_id"))
        return content, nothing.withColumns({"keep_row": F.lit(0), "group_size": F.lit(0)})
    stream = DigestStream(store)
    differing = []
    for arrival in range(batches):
        arrived = content.filter(F.col("_arrival") == arrival).select("_digest", "_id", "_row", "_arrival")
        changed = stream.arrive(arrived)
        if changed is not None:
            differing.append(_differing(content, arrival, changed, store))
            store.release()
    hits = store.save(stream.state().filter("n > 1").select("_digest", "best", "n"), "hits")
    differing = store.save(reduce(DataFrame.unionAll, differing).distinct(), "differing")
    same = hits.join(differing, "_digest", "left_anti").select(
        "_digest", F.lit(None).cast("string").alias("_text"), "best", "n"
    )
    if not differing.isEmpty():
        # A digest of several texts: whole texts are the keys.
        colliding = content.select("_digest", "_row").join(differing, "_digest", "left_semi")
        split = (
            chosen_rows(content, colliding)
            .groupBy("_digest", _text().alias("_text"))
            .agg(_best(), F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
        )
        same = same.unionAll(split.select("_digest", "_text", "best", "n"))
    groups = store.save(
        same.select(
            "_digest",
            "_text",
            F.col("best.id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
            F.col("n").alias("group_size"),
        ),
        "groups",
    )
    store.drop("arrivals", "changes", "stream", *[f"suspects{i}" for i in range(batches)])
    store.release()
    return content, groups


def _with_groups(content: DataFrame, groups: DataFrame, columns: list[str]) -> DataFrame:
    """Join a content row to its group, if it has one."""
    renamed = groups.withColumnsRenamed({"_digest": "_group_digest", "_text": "_group_text"})
    match = (F.col("_digest") == F.col("_group_digest")) & (
        F.col("_group_text").isNull() | (F.col("_group_text") == F.col("_text"))
    )
    return content.select(*columns).join(renamed, match, "left")


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    A text that occurs once keeps itself with group size 1.  Exactly one row of a
    group is kept, also if ids repeat or are null.  An empty table gives an empty
    result; other columns of ``docs`` are ignored.
    """
    content, groups = deduplicate(docs.select("doc_id", "text"), **options)
    hashed = content.withColumns({"_sha": F.sha2(_text().cast("binary"), 256), "_text": _text()})
    if options.get("digest", sha256) is sha256 and groups.filter("_text is not null").isEmpty():
        # The stored digests are the result, and no text is needed to tell groups apart.
        hashed = content.withColumns({"_sha": F.lower(F.hex("_digest")), "_text": F.lit(None).cast("string")})
    joined = _with_groups(hashed, groups, ["_row", "_id", "_digest", "_text", "_sha"])
    alone = F.col("keep_row").isNull()
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.when(alone, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("_row") == F.col("keep_row"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each text, all columns kept; only row numbers are shuffled."""
    content, groups = deduplicate(docs, **options)
    # Without a collision the groups need no text, and the optimizer leaves it out.
    collided = not groups.filter("_text is not null").isEmpty()
    text = _text() if collided else F.lit(None).cast("string")
    rows = content.withColumn("_text", text)
    dropped = _with_groups(rows, groups, ["_row", "_digest", "_text"]).filter("_row != keep_row")
    return other_rows(content, dropped).select("_doc.*")


DEDUP_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
"""
