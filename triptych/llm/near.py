"""Jaccard join of documents on word shingles, with parity sketches.

A shingle flips bits of a sketch.  Two sets that differ in d shingles have sketches
that differ in d bits at most, so a Hamming distance is a lower bound.  Divided into
d + 1 bands by the shingle's hash, two such sets agree in one whole band at least
(pigeonhole).  Documents meet by equal bands within size classes; every
candidate is verified on the sets themselves, so the join is exact.

Sketches have a fixed part and, for larger sets, one as wide as the set: a sketch much
narrower than the difference of two sets is half full and tells nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triptych.llm.components import components
from triptych.llm.store import Store, chosen_rows, few_records_a_batch, other_rows
from triptych.llm.words import keep_none, mix, text_slices, word_hashes

_SKETCH_WORDS = 8
#: Larger sets also have a wide sketch, of a power of two of words with 2 to 4 bits a shingle.
_WIDE_FROM = 512
_MOST_NEEDED = 4
_KEYS_TOGETHER = 500_000
#: Texts, and pairs of whole sets, that a task holds at a time.
_TEXTS_TOGETHER = 500
_PAIRS_TOGETHER = 200


@dataclass(frozen=True)
class Likeness:
    """Sets are alike when ``denominator * intersection >= numerator * union``."""

    width: int = 5
    numerator: int = 80
    denominator: int = 100

    def apart(self, total: Column | int) -> Column | int:
        """Most shingles by which two like sets of ``total`` shingles together differ."""
        gap, whole = self.denominator - self.numerator, self.denominator + self.numerator
        return F.floor(total * gap / whole) if isinstance(total, Column) else total * gap // whole

    @cached_property
    def classes(self) -> np.ndarray:
        """First size of every size class, up to any possible size.

        The lower the likeness, the narrower the classes: a band should hold a few
        shingles of the smallest sets in its class too.
        """
        growth = (self.denominator + self.numerator) / (8 * max(self.denominator - self.numerator, 1))
        growth = min(max(growth, 1.1), 1.43)
        sizes = [1]
        while sizes[-1] < 1 << 40:
            sizes.append(max(sizes[-1] + 1, int(sizes[-1] * growth)))
        return np.array(sizes)

    def most_apart(self, scheme: int) -> int:
        """``apart`` of the largest pair whose smaller set is in class ``scheme``."""
        small = int(self.classes[scheme + 1]) - 1
        return int(self.apart(small + small * self.denominator // self.numerator))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, ascending per text, and where each text starts.

    A text of fewer words has its whole sequence as its only shingle; without
    words it has none.
    """
    words, first = word_hashes(data, offsets)
    texts = len(offsets) - 1
    lengths = np.diff(first)
    owner = np.repeat(np.arange(texts), lengths)
    n = max(len(words) - width + 1, 0)
    values = np.full(n, width, np.uint64)
    for i in range(width):
        values = mix(values + words[i : i + n])
    whole = owner[:n] == owner[width - 1 : width - 1 + n]
    values, owner = values[whole], owner[:n][whole]
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    if len(short):
        only = []
        for text in short:
            value = np.full(1, lengths[text], np.uint64)
            for word in words[first[text] : first[text + 1]]:
                value = mix(value + word)
            only.append(value[0])
        values, owner = np.append(values, np.array(only, np.uint64)), np.append(owner, short)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.searchsorted(owner[new], np.arange(texts + 1))


def band_keys(values: np.ndarray, starts: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of all bands: a band's key is the XOR of its shingles' hashes.

    A text takes part in the scheme of its own size class, and in those of smaller
    classes that can hold a like set.

    There are somewhat more bands than like sets have differences, and of two like
    sets more bands are equal than that surplus.  A text leaves out the bands of
    fewest shingles, which unrelated texts share by chance, as long as more bands
    remain than there can be differences: an equal band that is large enough for
    the text then exists, and it is as large in the other.  Each text takes the
    largest such limit; where limits differ, the one with the lower limit has that
    band too.
    """
    sizes = np.diff(starts)
    of_size = np.searchsorted(like.classes, sizes, "right") - 1
    texts, keys = [], []
    scheme, members = of_size, np.flatnonzero(sizes > 0)
    while len(members):
        apart = np.array([like.most_apart(s) for s in range(int(scheme[members].max()) + 1)])[scheme[members]]
        nb = apart + 1 + apart // 6
        at = np.concatenate([[0], np.cumsum(nb)])
        counts = sizes[members]
        own = np.repeat(np.arange(len(members)), counts)
        inside = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
        mine = values[np.repeat(starts[members], counts) + inside]
        band = ((mine >> np.uint64(32)) * nb[own].astype(np.uint64)) >> np.uint64(32)
        place = at[own] + band.astype(np.int64)
        heads = np.flatnonzero(np.diff(place, prepend=-1))
        parity = np.zeros(at[-1], np.uint64)
        parity[place[heads]] = np.bitwise_xor.reduceat(mine, heads)
        held = np.bincount(place, minlength=at[-1])
        limit = np.zeros(len(members), np.int64)
        for least in range(1, _MOST_NEEDED + 1):
            limit[np.add.reduceat((held >= least).astype(np.int64), at[:-1]) > apart] = least
        taken = held >= np.repeat(limit, nb)
        text = np.repeat(members, nb)
        index = (np.arange(at[-1]) - np.repeat(at[:-1], nb)).astype(np.uint64)
        name = mix((np.repeat(scheme[members], nb).astype(np.uint64) << np.uint64(40)) + index)
        texts.append(text[taken])
        keys.append(mix(parity ^ name)[taken])
        # The next smaller class takes part while it has a size that can be like.
        scheme = scheme - 1
        smallest = -(-sizes[members] * like.numerator // like.denominator)
        goes_on = scheme[members] >= 0
        goes_on &= like.classes[np.maximum(scheme[members] + 1, 0)] - 1 >= smallest
        members = members[goes_on]
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(texts), np.concatenate(keys)


def _wide_sketch(values: np.ndarray) -> np.ndarray | None:
    """Parities of a larger set in bits of their own; None for a small set.

    A bit's place are the low bits of a hash, so a sketch of twice the width turns
    into one of this width when its halves are put together by XOR.
    """
    if len(values) <= _WIDE_FROM:
        return None
    words = 1 << (len(values) // 32 - 1).bit_length()
    place = (values >> np.uint64(8)) & np.uint64(64 * words - 1)
    odd = np.bincount(place.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _describe(texts: DataFrame, like: Likeness) -> DataFrame:
    """_row, text and _id to _row, _id, n, a 128-bit digest of the set, its sketches and number of bands."""
    names = ["_row", "_id", "n", "d1", "d2", *[f"s{i}" for i in range(_SKETCH_WORDS)], "wide", "bands"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                values, starts = shingle_sets(data, offsets, like.width)
                sizes = np.diff(starts)
                sums = np.zeros((3, len(values) + 1), np.uint64)
                np.bitwise_xor.accumulate(values, out=sums[0, 1:])
                np.cumsum(mix(values), out=sums[1, 1:])
                d1 = sums[0, starts[1:]] ^ sums[0, starts[:-1]]
                d2 = sums[1, starts[1:]] - sums[1, starts[:-1]]
                word = values >> np.uint64(65 - _SKETCH_WORDS.bit_length())
                bit = np.uint64(1) << ((values >> np.uint64(50)) & np.uint64(63))
                sketch = []
                for i in range(_SKETCH_WORDS):
                    np.bitwise_xor.accumulate(np.where(word == i, bit, np.uint64(0)), out=sums[2, 1:])
                    sketch.append(sums[2, starts[1:]] ^ sums[2, starts[:-1]])
                wide = [_wide_sketch(values[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                text, _ = band_keys(values, starts, like)
                bands = np.bincount(text, minlength=end - first)
                columns = [batch.column(i).slice(first, end - first) for i in (0, 2)]
                columns.append(pa.array(sizes, pa.int64()))
                columns += [pa.array(x.view(np.int64)) for x in (d1, d2, *sketch)]
                columns += [pa.array(wide, pa.list_(pa.int64())), pa.array(bands, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    types = {"wide": "array<bigint>"}
    return texts.mapInArrow(describe, ", ".join(f"{name} {types.get(name, 'bigint')}" for name in names))


def _planes(values: np.ndarray) -> bytes:
    """Bytes by place, so that the equal high bytes compress away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a sorted array: where its runs start, each place's run, and if that has others."""
    heads = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))
    lengths = np.diff(np.append(heads, len(key)))
    group = np.repeat(np.arange(len(heads)), lengths)
    return heads, group, lengths[group] > 1


def _band_blocks(texts: DataFrame, like: Likeness, buckets: int) -> DataFrame:
    """Bands of all rows, packed by bucket: many rows of a task in one value.

    Rows of a task that share a band are listed as its members right away, and
    only the first goes on to the bucket: a band that a third of all rows share
    reaches its bucket once per block.
    """
    schema = "bucket int, keys binary, rows binary, member_keys binary, members binary, heads binary"

    def flush(rows: list[np.ndarray], keys: list[np.ndarray]) -> pa.RecordBatch:
        row, key = np.concatenate(rows), np.concatenate(keys)
        # The bucket's number and 32 bits: a chance equality only costs a comparison.
        bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        key = (bucket << np.uint64(32)) | (key & np.uint64(0xFFFFFFFF))
        order = np.lexsort((row, key))
        row, key = row[order], key[order]
        heads, group, shared = _runs(key)
        edges = np.searchsorted(key, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        head_edges = np.searchsorted(heads, edges)
        out: list[list] = [[] for _ in range(6)]
        for b in np.flatnonzero(np.diff(edges)):
            first = heads[head_edges[b] : head_edges[b + 1]]
            with_others = np.flatnonzero(shared[edges[b] : edges[b + 1]]) + edges[b]
            cells = (
                b,
                key[first].astype("<u4").tobytes(),
                _planes(row[first]),
                _planes(key[with_others]),
                _planes(row[with_others]),
                _planes(row[heads[group[with_others]]]),
            )
            for column, cell in zip(out, cells, strict=True):
                column.append(cell)
        types = [pa.int32()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types, strict=True)],
            names=["bucket", "keys", "rows", "member_keys", "members", "heads"],
        )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        rows, keys, held = [], [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy().astype(np.uint64)
            for first, _, data, offsets in text_slices(batch.column(1)):
                text, key = band_keys(*shingle_sets(data, offsets, like.width), like)
                rows.append(ids[first + text])
                keys.append(key)
                held += len(key)
                if held >= _KEYS_TOGETHER:
                    yield flush(rows, keys)
                    rows, keys, held = [], [], 0
        if held:
            yield flush(rows, keys)

    return texts.mapInArrow(pack, schema)


def _member_rows(key: np.ndarray, row: np.ndarray, head: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(x.astype(np.uint64).view(np.int64)) for x in (key, row, head)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "row", "head"])


def _members(blocks: DataFrame) -> DataFrame:
    """(key, row, head) of every band that several rows share; the head is one of them."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        for batch in batches:
            for cells in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                key, row, head = (_from_planes(cell) for cell in cells)
                yield _member_rows(key, row, head)

    def across(table: pa.Table) -> pa.Table:
        # One bucket at a time: Spark sorts the parts by bucket and hands them over
        # group by group, so no task holds more than one bucket's keys in memory.
        keep_none()
        bucket = table.column(0)[0].as_py()
        key = np.concatenate([np.frombuffer(cell, "<u4") for cell in table.column(1).to_pylist()])
        key = key.astype(np.uint64) | np.uint64(bucket << 32)
        row = np.concatenate([_from_planes(cell) for cell in table.column(2).to_pylist()])
        order = np.lexsort((row, key))
        key, row = key[order], row[order]
        heads, group, shared = _runs(key)
        return pa.Table.from_batches([_member_rows(key[shared], row[shared], row[heads][group][shared])])

    schema = "key bigint, row bigint, head bigint"
    inside = blocks.filter(F.length("members") > 0).select("member_keys", "members", "heads")
    across_buckets = blocks.select("bucket", "keys", "rows").groupBy("bucket").applyInArrow(across, schema)
    return inside.mapInArrow(local, schema).unionAll(across_buckets)


def _verified(pairs: DataFrame, sets: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose sets are alike; ``sets`` has rid and values."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = like.denominator * both >= like.numerator * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(good))

    with_sets = (
        pairs.join(sets.select(F.col("rid").alias("a"), F.col("values").alias("x")), "a")
        .join(sets.select(F.col("rid").alias("b"), F.col("values").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return with_sets.mapInArrow(check, "a bigint, b bigint")


def _sets(texts: DataFrame, like: Likeness) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                values, starts = shingle_sets(data, offsets, like.width)
                cells = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                rows = batch.column(0).slice(first, end - first)
                yield pa.RecordBatch.from_arrays([rows, pa.array(cells, pa.binary())], names=["rid", "values"])

    return texts.mapInArrow(build, "rid bigint, values binary")


_SKETCH = tuple(f"s{i}" for i in range(_SKETCH_WORDS))


def _apart(x: Column, y: Column) -> Column:
    """Bits in which two wide sketches differ; the wider one is folded to the other's width."""

    def halved(sketch: Column) -> Column:
        half = (F.size(sketch) / 2).cast("int")
        return F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda a, b: a.bitwiseXOR(b))

    # Like sets differ by less than a factor of two in size, and so do their sketches.
    x, y = F.when(F.size(x) > F.size(y), halved(x)).otherwise(x), F.when(F.size(y) > F.size(x), halved(y)).otherwise(y)
    bits = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def _may_be_alike(like: Likeness, left: str, right: str) -> Column:
    """Sizes near enough, and sketches within the bound; never false for like sets."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    near = F.least(n, m) * like.denominator >= F.greatest(n, m) * like.numerator
    distance = sum(F.bit_count(F.col(f"{left}.{s}").bitwiseXOR(F.col(f"{right}.{s}"))) for s in _SKETCH)
    bound = like.apart(n + m)
    x, y = F.col(f"{left}.wide"), F.col(f"{right}.wide")
    either_is_small = x.isNull() | y.isNull() | (F.greatest(n, m) >= 2 * F.least(n, m))
    return near & (distance <= bound) & (either_is_small | (_apart(x, y) <= bound))


def _compatible(pairs: DataFrame, sketches: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) that size and sketches do not rule out."""
    both = pairs.join(sketches.withColumnRenamed("rid", "a").alias("x"), "a").join(
        sketches.withColumnRenamed("rid", "b").alias("y"), "b"
    )
    return both.filter(_may_be_alike(like, "x", "y")).select("a", "b")


class _Linker:
    """Links found so far, and the components they make."""

    def __init__(self, sets: DataFrame, like: Likeness, store: Store) -> None:
        self.sets, self.like, self.store = sets, like, store
        self.links: DataFrame | None = None
        self.root: DataFrame | None = None
        self.rounds = 0

    def verify(self, pairs: DataFrame) -> None:
        """Add the pairs that are alike; pairs are (a, b) with a above b, each once."""
        name = f"{self.rounds}"
        self.rounds += 1
        with few_records_a_batch(self.store.spark, _PAIRS_TOGETHER):
            new = self.store.save(_verified(pairs, self.sets, self.like), f"links{name}")
        self.store.release()
        if self.links is not None and new.isEmpty():
            return
        self.links = new if self.links is None else self.links.unionAll(new)
        self.root = components(self.links, self.store, f"roots{name}_")
        self.store.release()

    def with_roots(self, rows: DataFrame, column: str, name: str) -> DataFrame:
        root = self.root.select(F.col("node").alias(column), F.col("root").alias(name))
        return rows.join(root, column, "left").withColumn(name, F.coalesce(name, column))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that no links connect yet."""
        placed = self.with_roots(self.with_roots(pairs, "a", "_of_a"), "b", "_of_b")
        return placed.filter("_of_a != _of_b").drop("_of_a", "_of_b")


def near_duplicates(rows: DataFrame, like: Likeness, store: Store) -> DataFrame:
    """Groups of ``rows`` (``_doc`` with doc_id and text), a table of ``Store.save_rows``.

    Returns _row, _id, n (shingles), ``root`` (a number that names the group) and
    ``component``, the smallest _id that links reach, itself included.  A null text is empty; rows without words are linked
    with nothing; rows with equal sets are one node.  A null id never names a
    component unless all ids of it are null.  An empty table gives an empty result.

    Only the first row of equal sets goes on.  Rows that share a band are told apart in
    packed blocks: each is paired with the first row of its band.

    1. Every row is compared with the one it shares most bands with.
    2. Of the other pairs, those that no link connects yet are compared.
    3. In bands whose rows are still in several components, every row is compared
       with the band's most central one, which meets most others in all its bands:
       of near copies, the one with the fewest changes.
    4. Where that leaves several components, the rows outside a band's largest one
       are compared with rows of other components, as far as sizes and sketches leave a
       doubt.  After this no like pair is left untested or unconnected.

    One large group of near copies is thus connected by about as many comparisons as it
    has rows; pairs within a component are never listed.
    """
    texts = rows.select("_row", "_chunk", F.col("_doc.text").alias("text"), F.col("_doc.doc_id").cast("bigint").alias("_id"))
    with few_records_a_batch(store.spark, _TEXTS_TOGETHER):
        described = store.save(_describe(texts.select("_row", "text", "_id"), like), "described")
    digest = ["d1", "d2", "n"]
    with_words = described.filter("n > 0")
    kept = [*_SKETCH, "wide", "bands"]
    nodes = store.save(
        with_words.groupBy(*digest).agg(F.min_by(F.struct("_row", *kept), "_row").alias("first")).select(*digest, "first.*"),
        "nodes",
    )
    total = nodes.agg(F.sum("bands")).first()[0] or 0
    sketches = nodes.select(F.col("_row").alias("rid"), "n", *_SKETCH, "wide")
    first_rows = chosen_rows(texts, nodes).select("_row", "text")
    with few_records_a_batch(store.spark, _TEXTS_TOGETHER):
        blocks = store.save(_band_blocks(first_rows, like, max(1, total * 2 // _KEYS_TOGETHER)), "blocks")
    store.release()
    with few_records_a_batch(store.spark, 4):
        members = store.save(
            _members(blocks).select("key", F.col("row").alias("rid"), F.col("head").alias("hid")).filter("rid != hid"),
            "members",
        )
    store.drop("blocks")
    star = store.save(
        members.groupBy(F.greatest("rid", "hid").alias("a"), F.least("rid", "hid").alias("b")).agg(
            F.count(F.lit(1)).alias("shared")
        ),
        "star",
    )
    wanted = star.select(F.explode(F.array("a", "b")).alias("_row")).distinct()
    with few_records_a_batch(store.spark, _TEXTS_TOGETHER):
        sets = store.save(_sets(chosen_rows(texts, wanted).select("_row", "text"), like), "sets")
    store.release()

    linker = _Linker(sets, like, store)
    best = star.groupBy("a").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))
    linker.verify(best)
    rest = linker.apart(star.select("a", "b").join(best, ["a", "b"], "left_anti"))
    linker.verify(store.save(_compatible(rest, sketches, like), "tried2"))

    # A band has rows in several components only if one of its pairs has.
    crossing = store.save(linker.apart(star.select("a", "b")), "crossing")
    if not crossing.isEmpty():
        of_band = members.select("key", F.greatest("rid", "hid").alias("a"), F.least("rid", "hid").alias("b"))
        keys = of_band.join(crossing, ["a", "b"], "left_semi").select("key").distinct()
        open_rows = store.save(
            members.join(keys, "key", "left_semi").select("key", F.explode(F.array("rid", "hid")).alias("rid")).distinct(),
            "open",
        )
        _connect_open(linker, open_rows, star.select("a", "b"), sketches, like, store)

    node_of = with_words.select("_row", "_id", *digest).join(
        nodes.select(*digest, F.col("_row").alias("rid")), digest
    )
    in_group = store.save(linker.with_roots(node_of, "rid", "root").select("_row", "_id", "n", "root"), "in_group")
    named = in_group.groupBy("root").agg(F.min("_id").alias("component"))
    alone = described.filter("n = 0").select("_row", "_id", "n", F.lit(None).cast("bigint").alias("root"), F.col("_id").alias("component"))
    return in_group.join(named, "root").select("_row", "_id", "n", "root", "component").unionAll(alone)


def _connect_open(
    linker: _Linker, open_rows: DataFrame, tried: DataFrame, sketches: DataFrame, like: Likeness, store: Store
) -> None:
    """Steps 3 and 4 of ``near_duplicates``: (key, rid) of bands with several components."""

    def pair(x: str, y: str) -> list[Column]:
        return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]

    degree = open_rows.groupBy("rid").agg(F.count(F.lit(1)).alias("degree"))
    placed = linker.with_roots(open_rows, "rid", "root").join(degree, "rid")
    centre = F.max_by(F.struct("rid", "root"), F.struct("degree", "rid")).alias("c")
    central = placed.join(placed.groupBy("key").agg(centre), "key").filter("root != c.root").select(*pair("rid", "c.rid")).distinct()
    central = store.save(_compatible(central, sketches, like).join(tried, ["a", "b"], "left_anti"), "tried3")
    linker.verify(central)

    placed = store.save(linker.with_roots(open_rows, "rid", "root"), "placed")
    largest = (
        placed.groupBy("key", "root")
        .count()
        .groupBy("key")
        .agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
        .filter("roots > 1")
    )
    mixed = store.save(placed.join(largest.select("key", "main"), "key").join(sketches, "rid"), "mixed")
    rest = (
        mixed.filter("root != main")
        .alias("x")
        .join(
            mixed.alias("y"),
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.root") != F.col("y.root"))
            & ((F.col("y.root") == F.col("y.main")) | (F.col("x.rid") > F.col("y.rid")))
            & _may_be_alike(like, "x", "y"),
        )
        .select(*pair("x.rid", "y.rid"))
        .distinct()
    )
    linker.verify(store.save(rest.join(tried.unionAll(central), ["a", "b"], "left_anti"), "tried4"))


def near_report(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``; see ``near_duplicates``."""
    store = Store(docs.sparkSession)
    rows = store.save_rows(docs.select(F.struct("doc_id", "text").alias("_doc")), "rows")
    return near_duplicates(rows, like, store).select(
        F.col("_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )


def distinct_documents(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``docs`` with one row of each group, all columns kept.

    The row with the smallest doc_id stays (of repeated ids the one with the
    smallest row number, a null id last); rows without words all stay.
    """
    store = Store(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc")
    rows = store.save_rows(docs.select(whole), "rows")
    grouped = near_duplicates(rows, like, store).filter("root IS NOT NULL")
    first = F.min(F.struct(F.col("_id").isNull().alias("late"), "_id", "_row"))
    stays = grouped.groupBy("root").agg(first.alias("s")).select("root", F.col("s._row").alias("_stays"))
    dropped = store.save(grouped.join(stays, "root").filter("_row != _stays").select("_row"), "dropped")
    store.drop("sets", "described", "nodes", "members", "star", "open", "placed", "mixed", "in_group")
    store.release()
    return other_rows(rows, dropped).select("_doc.*")
