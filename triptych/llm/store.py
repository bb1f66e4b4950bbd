"""Intermediate tables in the shared folder, and ranks without a large group in one task."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triptych.session import scratch_dir

#: Rows of a chunk of neighbours, as many as a bitmap of Spark has bits.
_CHUNK_BITS = 15


_opened: ContextVar[list[Store] | None] = ContextVar("stores opened by the caller's run", default=None)


@contextmanager
def stores_of_run() -> Iterator[list[Store]]:
    """Collects the stores opened inside, for the run that owns them to drop later.

    Only stores opened by this thread inside this block count, so runs side by side or
    one after the other never see each other's.
    """
    opened: list[Store] = []
    token = _opened.set(opened)
    try:
        yield opened
    finally:
        _opened.reset(token)


class Store:
    """Tables of one run below ``spark.checkpoint.dir``.

    A stored table is written once and read as often as needed: a lost executor
    costs its running tasks, and what was assigned to a row (a row number) stays.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.base = scratch_dir(spark)
        self._bucketed: list[str] = []
        if (opened := _opened.get()) is not None:
            opened.append(self)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_rows(self, df: DataFrame, name: str) -> DataFrame:
        """Store rows with a number, ``_row``, in buckets of neighbours, ``_chunk``.

        ``with_numbers`` finds rows of such a table again without moving it.  There are as
        many buckets as shuffles have partitions.
        """
        row = F.monotonically_increasing_id()
        numbered = df.withColumn("_row", row).withColumn("_chunk", F.shiftright("_row", _CHUNK_BITS))
        table = f"rows_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = numbered.write.format("parquet").option("compression", "zstd").option("path", self.path(name))
        writer.bucketBy(buckets, "_chunk").saveAsTable(table)
        self._bucketed.append(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        """Remove tables of this run that no later step reads; without names all of them."""
        if not names:
            while self._bucketed:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucketed.pop()}")
        jvm = self.spark.sparkContext._jvm
        for place in [self.path(name) for name in names] or [self.base]:
            path = jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark remove the shuffle files of jobs whose tables are stored.

        Spark drops them when the driver's JVM collects its garbage; with a large
        heap that can be long after the job.  Just after a job its plan is still
        held by the events about it, hence more than one round.
        """
        for _ in range(3):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.3)


@contextmanager
def few_records_a_batch(spark: SparkSession, records: int) -> Iterator[None]:
    """Inside, tables are saved with this many rows at a time in Python: for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, records)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bit(bitmap: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, place.bitwiseAND(F.lit(7))).cast("int"), F.lit(0))


def with_numbers(rows: DataFrame, numbers: DataFrame, column: str, *, bits: int = 1) -> DataFrame:
    """``rows`` of ``Store.save_rows`` with a small whole number each: 0 unless ``numbers`` has the row.

    ``numbers`` has ``_row`` (each once) and ``column``, below 2 to the power of ``bits``.  It
    is packed into one bitmap per chunk of 32,768 rows and bit, and only these bitmaps
    are shuffled: to the buckets of ``rows``, which are read where they lie.
    """
    place = F.col("_row").bitwiseAND(F.lit((1 << _CHUNK_BITS) - 1)).cast("int")
    planes = [f"_bits{i}" for i in range(bits)]

    def plane(i: int) -> Column:
        chosen = F.when(F.getbit(F.col(column).cast("int"), F.lit(i)) == 1, place.cast("bigint"))
        return F.bitmap_construct_agg(chosen).alias(planes[i])

    packed = numbers.groupBy(F.shiftright("_row", _CHUNK_BITS).alias("_chunk")).agg(*map(plane, range(bits)))
    number = sum((F.shiftleft(_bit(F.col(name), place), i) for i, name in enumerate(planes)), F.lit(0))
    joined = rows.join(packed.hint("shuffle_hash"), "_chunk", "left")
    return joined.select(*rows.columns, number.alias(column))


def chosen_rows(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``Store.save_rows`` whose ``_row`` is in ``chosen`` (each once), read where they lie."""
    return with_numbers(rows, chosen.select("_row", F.lit(1).alias("_chosen")), "_chosen").filter("_chosen = 1").drop("_chosen")


def other_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``Store.save_rows`` whose ``_row`` is not in ``dropped`` (each once)."""
    return with_numbers(rows, dropped.select("_row", F.lit(1).alias("_dropped")), "_dropped").filter("_dropped = 0").drop("_dropped")


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows: int,
    *,
    rank: str = "rank",
    rows_per_chunk: int = 10_000,
) -> DataFrame:
    """Add a gapless rank from 0 within ``keys``; ``df`` must be a stored table.

    ``rows`` is its row count.  The rows of a key are spread over chunks by a hash
    of ``order``; a chunk's rows are numbered in one task, and start where the
    chunks before it end.  A key that holds all rows is thus numbered by many
    tasks.  The keys must not be null.  Rows that agree in all of ``order`` get
    their ranks in any order.
    """
    chunks = max(1, -(-rows // rows_per_chunk))
    chunked = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunked.groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (
        chunked.join(starts, [*keys, "_chunk"])
        .withColumn(rank, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_chunk", "_start")
    )
