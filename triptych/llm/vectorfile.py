"""Exact top-k search by inner product with a vector-approximation file.

Every component of a vector is approximated by a cell of a grid, one byte each.  A
scan over the cells gives bounds of every score: the score of the cells' centres,
more or less the query's length times the distance of the vector from its centres.
What cannot be among the best k is never read again; exact vectors of the others
are read in the order of their bounds until the kth result is certain.

The scan is a loop over blocks: parts of the approximation file against parts of the
queries, both of bounded size, multiplied as matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triptych.llm.store import Store, few_records_a_batch

_ROWS_PER_BLOCK = 4096
_QUERIES_PER_BLOCK = 1024
_BLOCKS_PER_BATCH = 16
#: Candidates a task holds before it hands them on.
_HELD = 2_000_000
_LARGEST_SQUARE = 2.0**62


def _binaries(matrix: np.ndarray) -> pa.Array:
    """Every row of a matrix as one binary value."""
    matrix = np.ascontiguousarray(matrix)
    width = matrix.shape[1] * matrix.itemsize
    offsets = np.arange(len(matrix) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix.tobytes())]
    ).cast(pa.binary())


def _matrix(cells: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), np.int32).reshape(-1, dims)


def _whole_vectors(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id, asked, _row and the vector's components in whole steps, padded with zeros.

    Vectors with a null or non-finite component are left out.
    """
    names = ["vec_id", "asked", "_row", "vector"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # nulls are not finite either
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            good = np.bincount(owner[~np.isfinite(flat)], minlength=len(sizes)) == 0
            steps = np.zeros((len(sizes), dims))
            with np.errstate(invalid="ignore", over="ignore"):
                steps[owner, place] = np.floor(flat * scale)
            steps = steps[good]
            if len(steps) and not np.square(steps).sum(axis=1).max() < _LARGEST_SQUARE:
                raise ValueError("a vector is so long that scores would pass 64 bits")
            whole = steps.astype(np.int64)
            if np.any(whole != whole.astype(np.int32)):
                raise ValueError("a component passes 32 bits")
            kept = batch.filter(pa.array(good))
            columns = [kept.column(i) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, _binaries(whole.astype(np.int32))], names=names)

    return rows.select("vec_id", "asked", "_row", "embedding").mapInArrow(
        build, "vec_id bigint, asked boolean, _row bigint, vector binary"
    )


@dataclass(frozen=True)
class Grid:
    """Equal cells per dimension; values beyond the first or last cell count to it."""

    low: np.ndarray
    width: np.ndarray
    cells: int

    @classmethod
    def over(cls, vectors: DataFrame, dims: int, bits: int) -> Grid:
        """Cells over the range of all vectors, but at most four deviations from the mean.

        Every vector is seen; per dimension one row of sums reaches the driver.
        """

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total, square = 0, np.zeros(dims), np.zeros(dims)
            low, high = np.full(dims, np.inf), np.full(dims, -np.inf)
            for batch in batches:
                if batch.num_rows:
                    values = _matrix(batch.column(0), dims).astype(np.float64)
                    n += len(values)
                    total, square = total + values.sum(axis=0), square + np.square(values).sum(axis=0)
                    low, high = np.minimum(low, values.min(axis=0)), np.maximum(high, values.max(axis=0))
            if n:
                columns = [np.arange(dims), np.full(dims, float(n)), total, square, low, high]
                names = ["dim", "n", "total", "square", "low", "high"]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=names)

        schema = "dim bigint, n double, total double, square double, low double, high double"
        sums = [F.sum(x).alias(x) for x in ("n", "total", "square")]
        found = (
            vectors.select("vector")
            .mapInArrow(summed, schema)
            .groupBy("dim")
            .agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"))
            .orderBy("dim")
            .collect()
        )
        if not found:
            return cls(np.zeros(dims), np.ones(dims), 1 << bits)
        n, total, square, low, high = (np.array([row[x] for row in found]) for x in found[0].asDict() if x != "dim")
        mean = total / n
        apart = 4 * np.sqrt(np.maximum(square / n - np.square(mean), 0))
        low, high = np.maximum(low, np.floor(mean - apart)), np.minimum(high, np.ceil(mean + apart))
        return cls(low, np.maximum((high - low + 1) / (1 << bits), 1.0), 1 << bits)

    def approximate(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells, and how far each vector is from the centres of its cells, rounded up."""
        cells = np.clip(np.floor((vectors - self.low) / self.width), 0, self.cells - 1)
        radius = np.sqrt(np.square(vectors - self.centre(cells)).sum(axis=1)) * (1 + 1e-6)
        return cells.astype(np.uint8), np.nextafter(radius.astype(np.float32), np.float32(np.inf))

    def centre(self, cells: np.ndarray) -> np.ndarray:
        return self.low + (cells + 0.5) * self.width - 0.5


def _cell_blocks(vectors: DataFrame, grid: Grid) -> DataFrame:
    """The approximation file: block, ids, cells and radii of some thousand vectors a row."""
    dims = len(grid.low)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS_PER_BLOCK):
                own = batch.slice(first, _ROWS_PER_BLOCK)
                cells, radii = grid.approximate(_matrix(own.column(1), dims).astype(np.float64))
                data = [own.column(0).to_numpy().tobytes(), cells.tobytes(), radii.tobytes()]
                columns = [pa.array([block]), *(pa.array([x], pa.binary()) for x in data)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "cells", "radii"])
                block += 1

    return vectors.select("v", "vector").mapInArrow(build, "block bigint, ids binary, cells binary, radii binary")


def _query_blocks(asked: DataFrame, dims: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, _QUERIES_PER_BLOCK):
                own = batch.slice(first, _QUERIES_PER_BLOCK)
                data = [own.column(0).to_numpy().tobytes(), _matrix(own.column(1), dims).tobytes()]
                columns = [pa.array([block]), *(pa.array([x], pa.binary()) for x in data)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "ids", "vectors"])
                block += 1

    return asked.select("q", "vector").mapInArrow(build, "block bigint, ids binary, vectors binary")


class Scan:
    """Bounds of the scores of some queries, and what may be among each one's best ``most``.

    An upper bound is one product of rows that carry, beside scaled query and cells,
    the query's length and the vector's radius.  Rounding in single precision is
    covered by a margin; no vector that belongs to the result is lost.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, grid: Grid, most: int) -> None:
        vectors = vectors.astype(np.float64)
        self.ids, self.most = ids, most
        self.length = np.sqrt(np.square(vectors).sum(axis=1)) * (1 + 1e-6)
        shift = vectors @ grid.centre(np.zeros(len(grid.low)))
        self.rows = np.column_stack([vectors * grid.width, self.length, shift]).astype(np.float32)
        self.scale = np.sqrt(np.square(self.rows.astype(np.float64)).sum(axis=1))
        self.lowers = np.full((len(ids), most), -np.inf)
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def meet(self, ids: np.ndarray, cells: np.ndarray, radii: np.ndarray) -> None:
        columns = np.column_stack([cells, radii, np.ones(len(ids))]).astype(np.float32)
        largest = float(np.sqrt(np.square(columns.astype(np.float64)).sum(axis=1)).max())
        margin = (columns.shape[1] + 4) * 2.0**-22 * self.scale * largest
        for first in range(0, len(self.ids), _QUERIES_PER_BLOCK):
            own = slice(first, first + _QUERIES_PER_BLOCK)
            upper = self.rows[own] @ columns.T
            least = self.lowers[own, 0]
            if len(ids) >= self.most and np.isneginf(least).any():
                lower = upper - 2 * self.length[own, None].astype(np.float32) * radii
                place = len(ids) - self.most
                least = np.maximum(least, np.partition(lower, place, axis=1)[:, place] - 3 * margin[own])
            q, v = np.nonzero(upper >= np.nextafter((least - 2 * margin[own]).astype(np.float32), -np.inf)[:, None])
            high = upper[q, v] + margin[own][q]
            low = high - 2 * self.length[own][q] * radii[v].astype(np.float64) - 2 * margin[own][q]
            self._keep(q + first, ids[v], low, high)

    def _keep(self, q: np.ndarray, v: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        if not len(q):
            return
        self.found.append((q, v, low, high))
        self.held += len(q)
        touched = np.unique(q)
        of = np.concatenate([np.repeat(touched, self.most), q])
        values = np.concatenate([self.lowers[touched].ravel(), low])
        order = np.lexsort((values, of))
        ends = np.searchsorted(of[order], touched, "right")
        self.lowers[touched] = values[order][ends[:, None] + np.arange(-self.most, 0)]

    def flush(self) -> pa.RecordBatch | None:
        """What may still be among the best; earlier bounds go on counting."""
        if not self.found:
            return None
        q, v, low, high = (np.concatenate(x) for x in zip(*self.found, strict=True))
        self.found, self.held = [], 0
        good = high >= self.lowers[q, 0]
        columns = [self.ids[q[good]], v[good], low[good], high[good]]
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["q", "v", "lower", "upper"])


def _scanned(cells: DataFrame, queries: DataFrame, grid: Grid, most: int, sizes: tuple[int, int], memory: int) -> DataFrame:
    """(q, v, lower, upper) of all that the bounds leave, of each part apart.

    Query parts are as large as fit ``memory``, so the cells are sent as seldom as
    possible; every part of the cells receives all queries of its part, hence there are
    no more such parts than make both sides move about equally many bytes.
    """
    vectors, n_queries = sizes
    dims = len(grid.low)
    query_parts = max(1, -(-n_queries * dims * 16 // memory))
    balanced = -(-2 * query_parts * vectors // (4 * max(n_queries, 1)))
    cell_parts = max(1, min(balanced, -(-vectors // _ROWS_PER_BLOCK)))
    nothing = F.lit(None).cast("binary")

    def among(column: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    asking = queries.select("ids", F.col("vectors").alias("data"), nothing.alias("radii"), F.lit(0).alias("kind"), among("block", query_parts).alias("h"), each(cell_parts).alias("g"))
    stored = cells.select("ids", F.col("cells").alias("data"), "radii", F.lit(1).alias("kind"), each(query_parts).alias("h"), among("block", cell_parts).alias("g"))
    part = F.col("g") * query_parts + F.col("h")
    together = (
        asking.unionByName(stored)
        .repartitionById(cell_parts * query_parts, part)
        .sortWithinPartitions("kind")
        .select("kind", "ids", "data", "radii")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[tuple[np.ndarray, np.ndarray]] = []
        running: Scan | None = None
        for batch in batches:
            for kind, ids, data, radii in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                ids = np.frombuffer(ids, np.int64)
                if kind == 0:
                    asked.append((ids, np.frombuffer(data, np.int32).reshape(-1, dims)))
                    continue
                if not asked and running is None:
                    continue
                if running is None:
                    running = Scan(*(np.concatenate(x) for x in zip(*asked, strict=True)), grid, most)
                    asked = []
                running.meet(ids, np.frombuffer(data, np.uint8).reshape(-1, dims), np.frombuffer(radii, np.float32))
                if running.held > _HELD and (found := running.flush()):
                    yield found
        if running is not None and (found := running.flush()):
            yield found

    return together.mapInArrow(scan, "q bigint, v bigint, lower double, upper double")


def _scored(pairs: DataFrame, vectors: DataFrame, asked: DataFrame, dims: int) -> DataFrame:
    """(q, v, members, score): the exact score of the pairs (q, v)."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS_PER_BLOCK):
                own = batch.slice(first, _ROWS_PER_BLOCK)
                x, y = (_matrix(own.column(i), dims).astype(np.int64) for i in (3, 4))
                score = pa.array(np.einsum("nd,nd->n", x, y))
                columns = [own.column(i) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, score], names=["q", "v", "members", "score"])

    joined = (
        pairs.join(vectors.select("v", "members", "vector"), "v")
        .join(asked.select("q", F.col("vector").alias("asked")), "q")
        .select("q", "v", "members", "vector", "asked")
    )
    schema = "q bigint, v bigint, members array<struct<vec_id:bigint,_row:bigint>>, score bigint"
    return joined.mapInArrow(multiply, schema)


def _certain(scores: DataFrame, name: str, most: int) -> DataFrame:
    """(q, floor): the ``most``-th largest value of each query; null if it has fewer."""
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc(name)))
    best = scores.select("q", name).withColumn("_place", place).filter(F.col("_place") <= most)
    return best.groupBy("q").agg(F.when(F.count(F.lit(1)) == most, F.min(name)).alias("floor"))


def top_products(
    rows: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    scale: int = 256,
    bits: int = 6,
    query_memory: int = 128 << 20,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` largest inner products.

    ``rows`` has vec_id and embedding; a component x counts as floor(scale * x), taken
    as a double.  Queries are the rows that ``is_query`` selects, candidates all rows
    but the query's own.  Ties go to the smaller vec_id, then to an earlier row; with
    fewer than k candidates all are returned.  Scores are exact 64-bit integers.

    Rows without a vec_id, and vectors that are null or hold a null, a NaN or an
    infinity, take no part.  Shorter vectors are padded with zeros; an empty one scores
    0 with all.  A vector of which scores could pass 64 bits is an error.  Repeated rows
    are rows of their own: a copy of the query under its own id is a candidate.  An
    empty table gives an empty result; other columns are ignored.

    Equal vectors are searched as one, which keeps its k + 1 smallest ids: enough for
    any query, also for one that must leave out itself.  ``bits`` per cell (8 at most)
    decide how many exact vectors are read, never the result.
    """
    if not 1 <= bits <= 8:
        raise ValueError("a cell has 1 to 8 bits")
    spark = rows.sparkSession
    store = Store(spark)
    most = k + 1
    rows = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
        F.monotonically_increasing_id().alias("_row"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    dims = max(rows.agg(F.max(F.size("embedding"))).first()[0] or 0, 1)
    whole = store.save(_whole_vectors(rows, dims, scale), "whole")

    copy = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "_row"))
    distinct = (
        whole.select("vector", "vec_id", "_row")
        .withColumn("_copy", copy)
        .filter(F.col("_copy") <= most)
        .groupBy("vector")
        .agg(F.collect_list(F.struct("vec_id", "_row")).alias("members"))
    )
    vectors = store.save(distinct.withColumn("v", F.monotonically_increasing_id()), "vectors")
    queries = whole.filter("asked").select("vec_id", "_row", "vector")
    asked = store.save(
        queries.groupBy("vector").agg(F.lit(0)).select("vector", F.monotonically_increasing_id().alias("q")), "asked"
    )
    grid = Grid.over(vectors, dims, bits)
    cells = store.save(_cell_blocks(vectors, grid), "cells")
    sizes = (vectors.count(), asked.count())
    store.release()
    with few_records_a_batch(spark, _BLOCKS_PER_BATCH):
        scanned = _scanned(cells, _query_blocks(asked, dims), grid, most, sizes, query_memory)
        candidates = store.save(scanned, "candidates")
    store.release()

    in_order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("upper"), "v"))
    ordered = store.save(
        candidates.join(_certain(candidates, "lower", most), "q")
        .filter("floor IS NULL OR upper >= floor")
        .select("q", "v", "upper", in_order.alias("place")),
        "ordered",
    )
    read, low, high = None, 0, 2 * most
    while True:
        pairs = ordered.filter((F.col("place") > low) & (F.col("place") <= high))
        if read is not None:
            pairs = pairs.join(_certain(read, "score", most), "q").filter("floor IS NULL OR upper >= floor")
        scored = store.save(_scored(pairs.select("q", "v"), vectors, asked, dims), f"exact{low}")
        store.release()
        # Bounds fall with the place: where none of these can matter, no later one can.
        if scored.isEmpty():
            break
        read = scored if read is None else read.unionAll(scored)
        low, high = high, 8 * high
    if read is None:
        read = scored

    best = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "_row"))
    hits = (
        read.select("q", "score", F.inline("members"))
        .withColumn("_place", best)
        .filter(F.col("_place") <= most)
        .groupBy("q")
        .agg(F.array_sort(F.collect_list(F.struct("_place", "vec_id", "_row", "score"))).alias("hits"))
    )
    others = F.slice(F.filter("hits", lambda hit: hit["_row"] != F.col("_row")), 1, k)
    per_query = (
        queries.join(asked, "vector")
        .join(hits, "q")
        .select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("_at", "_hit"))
    )
    return per_query.select(
        "query_id",
        (F.col("_at") + 1).cast("int").alias("rank"),
        F.col("_hit.vec_id").alias("vec_id"),
        F.col("_hit.score").alias("score"),
    )


TOP_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), products AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM products
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
