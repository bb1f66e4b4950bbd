"""Approximate nearest neighbours with balanced posting lists.

Centroids come from a bounded sample.  Every vector is written to the list of its
nearest centroid, and to those of others about as near (it lies on a boundary).
Centroids are searched through a graph in memory.  A query reads the lists whose
centroid is within a ratio of the nearest one's distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from triptych.llm.store import Store


@dataclass(frozen=True)
class CentroidGraph:
    """Centroids on the unit sphere, each linked to its nearest ones."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray

    @classmethod
    def build(cls, centroids: np.ndarray, degree: int = 24, entries: int = 16) -> CentroidGraph:
        k = len(centroids)
        degree = min(degree, k - 1)
        links = np.zeros((k, max(degree, 1)), np.int64)
        for at in range(0, k, 256):
            near = centroids[at : at + 256] @ centroids.T
            near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
            if degree:
                links[at : at + 256] = np.argsort(-near, axis=1, kind="stable")[:, :degree]
        # Every other link leads far away, so that the search leaves a local best.
        far = (np.arange(k)[:, None] * 31 + np.arange(1, 5)[None, :] * (k // 5 + 1)) % k
        return cls(centroids, np.hstack([links, far]), np.unique(np.linspace(0, k - 1, entries).astype(int)))

    def search(self, vectors: np.ndarray, beam: int, *, together: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances) of about the ``beam`` nearest, nearest first.

        Best-first search for all vectors at once.  Each has a beam of centroids, the best
        met so far; every round opens the ``together`` nearest that are not open yet and
        lets their links into the beam, until all of it is open.  What a vector holds is
        its beam, and what it costs depends on the beam and the links, not on the number
        of centroids.
        """
        n, k = len(vectors), len(self.centroids)
        beam = min(beam, k)
        width = max(beam, len(self.entries))
        ids = np.full((n, width), -1, np.int32)
        similarity = np.full((n, width), -np.inf, np.float32)
        opened = np.zeros((n, width), bool)
        ids[:, : len(self.entries)] = self.entries
        similarity[:, : len(self.entries)] = vectors @ self.centroids[self.entries].T
        ids, similarity, opened = _best_of(ids, similarity, opened, beam)
        active = np.arange(n)
        while len(active):
            waiting = np.where(opened[active] | (ids[active] < 0), -np.inf, similarity[active])
            at = np.argsort(-waiting, axis=1)[:, :together]
            goes = np.isfinite(np.take_along_axis(waiting, at, axis=1))
            going = goes.any(axis=1)
            active, at, goes = active[going], at[going], goes[going]
            if not len(active):
                break
            own, known = ids[active], opened[active]
            np.put_along_axis(known, at, np.take_along_axis(known, at, axis=1) | goes, axis=1)
            to = np.where(goes[:, :, None], self.links[np.take_along_axis(own, at, axis=1)], -1).reshape(len(active), -1)
            # Each centroid once, and none that is in the beam.
            to = np.sort(to, axis=1)
            to[:, 1:][to[:, 1:] == to[:, :-1]] = -1
            # A row's numbers follow those of the row before, so one sorted array holds all beams.
            row = np.arange(len(own))[:, None] * (k + 1) + 1
            in_beam, wanted = (np.sort(own, axis=1) + row).ravel(), to + row
            place = np.minimum(np.searchsorted(in_beam, wanted), len(in_beam) - 1)
            old = (to < 0) | (in_beam[place] == wanted)
            products = np.einsum("nd,nld->nl", vectors[active], self.centroids[np.maximum(to, 0)])
            new = np.where(old, -np.inf, products)
            ids[active], similarity[active], opened[active] = _best_of(
                np.hstack([own, to]),
                np.hstack([similarity[active], new.astype(np.float32)]),
                np.hstack([known, np.zeros(to.shape, bool)]),
                beam,
            )
        order = np.argsort(-similarity, axis=1, kind="stable")
        found = np.take_along_axis(similarity, order, axis=1)
        return np.take_along_axis(ids, order, axis=1).astype(np.int64), np.sqrt(np.maximum(2 - 2 * found, 0))


def _best_of(ids: np.ndarray, similarity: np.ndarray, opened: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """The ``n`` columns of every row with the largest similarity."""
    if similarity.shape[1] <= n:
        return ids, similarity, opened
    best = np.argpartition(-similarity, n - 1, axis=1)[:, :n]
    return tuple(np.take_along_axis(x, best, axis=1) for x in (ids, similarity, opened))


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def train_centroids(sample: np.ndarray, k: int, *, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Spherical k-means with a penalty on large clusters, so that lists come out even."""
    random = np.random.default_rng(seed)
    sample = np.unique(sample, axis=0)
    k = min(k, len(sample))
    centroids = sample[random.permutation(len(sample))[:k]].copy()
    sizes = np.full(k, len(sample) / k)
    for _ in range(rounds):
        penalty = 0.05 * (sizes * k / len(sample) - 1)
        assigned = np.concatenate(
            [
                (sample[at : at + 256] @ centroids.T - penalty).argmax(axis=1)
                for at in range(0, len(sample), 256)
            ]
        )
        sums = np.zeros_like(centroids, np.float64)
        np.add.at(sums, assigned, sample)
        sizes = np.bincount(assigned, minlength=k).astype(float)
        empty = sizes == 0
        sums[empty] = sample[random.integers(len(sample), size=int(empty.sum()))]
        centroids = unit(sums)
    return centroids


def usable(embedding: Column) -> Column:
    """Not null, not zero, and every component a finite number."""
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dimensions)


def exact_cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors get equal values wherever they stand."""
    dots = (vectors * queries).sum(axis=1)
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((queries * queries).sum(axis=-1))
    return dots / norms


def _at_least(near: np.ndarray, n: int, chunks: int = 64) -> np.ndarray:
    """Per row a value that at least ``n`` columns reach; close to the n-th largest."""
    width = near.shape[1] // chunks
    if n <= chunks and width > 1:
        # The best of each chunk are so many columns, and far fewer to select from.
        near = near[:, : chunks * width].reshape(len(near), chunks, width).max(axis=2)
    return np.partition(near, -n, axis=1)[:, -n] if near.shape[1] > n else np.full(len(near), -2.0)


def _top(
    queries: np.ndarray,
    own_rows: np.ndarray,
    floors: np.ndarray,
    vectors: np.ndarray,
    rows: np.ndarray,
    ids: np.ndarray,
    n: int,
    together: int = 256,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(queries, vectors, exact scores) of the ``n`` nearest of the block; ties to the smaller id.

    What scores below a query's floor is left out.
    """
    scaled, rough = unit(vectors), unit(queries)
    for at in range(0, len(queries), together):
        near = rough[at : at + together] @ scaled.T
        near[own_rows[at : at + together, None] == rows] = -np.inf
        # float32 errors stay far below the margin, so ties at the border all come along.
        border = np.maximum(np.maximum(_at_least(near, n), floors[at : at + together]), -2.0) - 1e-5
        asker, close = np.nonzero(near >= border[:, None])
        asker += at
        scores = np.empty(len(asker))
        for pairs in (slice(i, i + 16_384) for i in range(0, len(asker), 16_384)):
            scores[pairs] = exact_cosines(queries[asker[pairs]], vectors[close[pairs]])
        enough = scores >= floors[asker]
        asker, close, scores = asker[enough], close[enough], scores[enough]
        order = np.lexsort((rows[close], ids[close], -scores, asker))
        asker = asker[order]
        best = np.arange(len(asker)) - np.searchsorted(asker, asker) < n
        yield asker[best], close[order][best], scores[order][best]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    neighbours: int = 5,
    list_size: int = 400,
    max_centroids: int = 8192,
    max_sample: int = 50_000,
    replicas: int = 4,
    boundary_ratio: float = 1.10,
    beam: int = 96,
    search_ratio: float = 1.6,
    block: int = 4096,
    rows_per_round: int = 200_000,
    max_rounds: int = 8,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's nearest found.

    ``vectors`` has vec_id and embedding; a query's own row is no candidate.  Rows
    whose embedding is null or zero, or holds null or non-finite components, take
    no part, nor do those with fewer or more components than the first usable row
    in the order of vec_id.  Repeated rows are candidates of their own; null ids
    sort first.  Fewer candidates than ``neighbours`` are all returned; an empty
    table gives an empty result.  Other columns are ignored.

    Every usable row is indexed.  Centroids are trained on ``max_sample`` rows at
    most, about one per ``list_size`` rows and ``max_centroids`` at most: beyond some
    three million rows lists grow with the table unless that is raised, and it can be
    raised to the size of the sample.  A row is
    in up to ``replicas`` lists whose centroid is at most ``boundary_ratio`` times
    as far as the nearest; a query reads the lists up to ``search_ratio``, among
    the ``beam`` nearest.  Lists and their queries are cut into blocks of ``block``
    rows, so a list that many equal vectors share is searched by many tasks.

    Vectors are stored once, with the numbers of their lists.  They are copied to the
    lists when these are searched, some of the lists in each of up to ``max_rounds``
    rounds, about one per ``rows_per_round`` rows: so only a part of the copies is on
    disk at a time.  A later round returns what can still be among a query's nearest.
    """
    spark = vectors.sparkSession
    store = Store(spark)
    result = "query_id bigint, rank int, vec_id bigint, score double"
    # Floats stay floats in tables and shuffles; sums are of doubles.
    element = getattr(vectors.schema["embedding"].dataType, "elementType", None)
    kind = "array<float>" if isinstance(element, FloatType) else "array<double>"
    rows = store.save(
        vectors.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("embedding").cast(kind).alias("v"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        )
        .filter(usable(F.col("v")))
        .withColumn("row", F.monotonically_increasing_id()),
        "rows",
    )
    first = rows.orderBy(F.asc_nulls_first("vec_id"), "row").select(F.size("v").alias("d")).first()
    if first is None:
        return spark.createDataFrame([], result)
    dimensions = first["d"]
    rows = rows.filter(F.size("v") == dimensions)
    n = rows.count()
    drawn = F.pmod(F.xxhash64("vec_id", F.col("v").cast("array<double>")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = rows.filter(drawn < max_sample * 0.9 / n).select("v").limit(max_sample).toArrow()
    if not sample.num_rows:
        sample = rows.select("v").limit(1).toArrow()
    sampled = unit(_matrix(sample["v"].combine_chunks(), dimensions))
    k = int(np.clip(n // list_size, 1, max_centroids))
    shared = spark.sparkContext.broadcast(CentroidGraph.build(train_centroids(sampled, k)))

    def place(batches: Iterator[pa.RecordBatch], width: int, ratio: float) -> Iterator[pa.RecordBatch]:
        graph = shared.value
        for batch in batches:
            v = unit(_matrix(batch.column("v"), dimensions))
            found = [graph.search(v[at : at + 512], max(width, 16)) for at in range(0, len(v), 512)]
            if not found:
                continue
            lists = np.concatenate([x[0] for x in found])[:, :width]
            far = np.concatenate([x[1] for x in found])[:, :width]
            # The floor keeps the ratio meaningful for a vector that is a centroid.
            near = far <= np.maximum(far[:, :1], 1e-3) * ratio
            ends = np.concatenate([[0], near.sum(axis=1).cumsum()])
            own = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lists[near], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=[*batch.schema.names, "lists"])

    schema = f"vec_id bigint, v {kind}, row bigint, lists array<int>"
    slim = ("vec_id", "v", "row")
    postings = store.save(
        rows.select(*slim).mapInArrow(lambda batches: place(batches, replicas, boundary_ratio), schema), "postings"
    )
    wanted = store.save(
        rows.filter("is_query").select(*slim).mapInArrow(lambda batches: place(batches, beam, search_ratio), schema),
        "wanted",
    )
    store.drop("rows")
    rounds = int(np.clip(-(-n // rows_per_round), 1, max_rounds))
    top = spark.createDataFrame([], "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double, rank int")
    top = _search_lists(store, postings, wanted, top, neighbours, block, dimensions, rounds, "top")

    # Few rows near a query: it reads all lists.
    most = min(neighbours, n - 1)
    enough = top.groupBy("query_row").count().filter(F.col("count") >= most).select(F.col("query_row").alias("row"))
    short = store.save(wanted.join(enough, "row", "left_anti").select(*slim), "short")
    if not short.isEmpty():
        everywhere = short.withColumn("lists", F.sequence(F.lit(0), F.lit(k - 1)))
        top = _search_lists(store, postings, everywhere, top, neighbours, block, dimensions, rounds, "more")
    store.drop("postings", "wanted", "short")
    return top.select("query_id", "rank", "vec_id", "score")


def _search_lists(
    store: Store,
    postings: DataFrame,
    wanted: DataFrame,
    top: DataFrame,
    neighbours: int,
    block: int,
    dimensions: int,
    rounds: int,
    name: str,
) -> DataFrame:
    """``top`` with the best of each query's lists, searched in rounds over the lists."""
    lists = _lists_in_blocks(store, postings, wanted, block, f"{name}_lists")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "row")
    for i in range(rounds):
        of_round = F.broadcast(lists.filter(F.col("list") % rounds == i))
        floors = (
            top.filter(F.col("rank") == neighbours).select(F.col("query_row").alias("row"), F.col("score").alias("floor"))
        )
        found = _search_blocks(
            _copies(postings, rounds, i), _copies(wanted.join(floors, "row", "left"), rounds, i), of_round, neighbours, dimensions
        )
        top = store.save(
            found.unionAll(top.drop("rank"))
            .repartition("query_row")
            .dropDuplicates(["query_row", "row"])
            .withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= neighbours),
            f"{name}{i}",
        )
        if i:
            store.drop(f"{name}{i - 1}")
        if rounds > 1:
            del found
            store.release()
    return top


def _copies(vectors: DataFrame, rounds: int, i: int) -> DataFrame:
    """A copy of each vector for each of its lists that the round searches."""
    own = F.filter("lists", lambda x: x % rounds == i) if rounds > 1 else F.col("lists")
    return vectors.withColumn("list", F.explode(own)).drop("lists")


def _lists_in_blocks(store: Store, postings: DataFrame, wanted: DataFrame, block: int, name: str) -> DataFrame:
    """list, and the numbers of blocks and asks it and its queries are cut into: a row per centroid at most."""

    def cut(side: DataFrame, number: str) -> DataFrame:
        counts = side.select(F.explode("lists").alias("list")).groupBy("list").count()
        return counts.select("list", F.ceil(F.col("count") / block).alias(number))

    return store.save(cut(postings, "blocks").join(cut(wanted, "asks"), "list"), name)


def _search_blocks(
    postings: DataFrame, wanted: DataFrame, lists: DataFrame, neighbours: int, dimensions: int
) -> DataFrame:
    """Every query against every block of its lists; the best of each block."""
    spread = F.pmod(F.xxhash64("row"), F.col("blocks"))
    asks = F.pmod(F.xxhash64("row"), F.col("asks"))
    candidates = (
        postings.join(lists, "list")
        .withColumn("block", spread)
        .withColumn("ask", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("asks") - 1)))
        .select("list", "block", "ask", "row", "vec_id", "v")
    )
    queries = (
        wanted.join(lists, "list")
        .withColumn("ask", asks)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("list", "block", "ask", "row", "vec_id", "v", "floor")
    )

    names = ["query_row", "query_id", "row", "vec_id", "score"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if len(left) and len(right):
            left, right = left.combine_chunks(), right.combine_chunks()
            vectors, queries = (_matrix(side["v"].chunk(0), dimensions) for side in (left, right))
            rows, ids = left["row"].to_numpy(), left["vec_id"]
            order = ids.fill_null(-(2**63)).to_numpy()
            floors = right["floor"].fill_null(-np.inf).to_numpy()
            parts = list(_top(queries, right["row"].to_numpy(), floors, vectors, rows, order, neighbours))
        if not parts:
            return pa.table({name: pa.array([], kind) for name, kind in zip(names, [*[pa.int64()] * 4, pa.float64()], strict=True)})
        asker, best, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        columns = [right["row"].take(asker), right["vec_id"].take(asker), left["row"].take(best), ids.take(best)]
        return pa.table([*columns, pa.array(scores)], names=names)

    keys = ["list", "block", "ask"]
    return (
        candidates.groupBy(*keys)
        .cogroup(queries.groupBy(*keys))
        .applyInArrow(search, "query_row bigint, query_id bigint, row bigint, vec_id bigint, score double")
    )
