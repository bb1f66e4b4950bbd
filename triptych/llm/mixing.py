"""Mixing sources to target weights by pivotal dependent rounding.

Each row of a source is to be taken a fractional number of times.  The whole part
is certain; the fractional parts are rounded together: two rows' probabilities are
played against each other, mass moving at random from one to the other until one
is 0 or 1, and the other goes on to the next row.  Mass counts in units of size,
so a source's taken size hits its target but for one last row.

So that this row is a small one, the few rows that hold more than a thousandth of their
source each play first, against all smaller rows of the source as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triptych.llm.store import Store, with_numbers
from triptych.llm.words import WORD_PATTERN

_NEAR = 1e-9
#: A row above one part of so many of its source is large; there are fewer of these per source.
_LARGE_PARTS = 1000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, most: float
) -> DataFrame:
    """Per ``source`` its ``source_size`` and ``target``; ``sizes`` has source and size.

    Sources in code-point order, null last, take the weights in turn.  They share
    ``share`` times all sizes by weight.  No target exceeds ``most`` times its
    source's size; what is above goes to the others by weight.  The fixed point of
    that: sources reach their limit in the order of limit / weight, so running sums
    in this order give the level of the rest.  Needs ``share <= most``.
    """
    if not 0 <= share <= most:
        raise ValueError("the share of all sizes must not exceed the limit of each source")
    turn = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    limits = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, map(float, weights))), turn + 1))
        .withColumn("_limit", F.col("source_size") * float(most))
        .withColumn("_reach", F.col("_limit") / F.col("_weight"))
    )
    everything = Window.partitionBy()
    in_order = Window.orderBy("_reach", F.asc_nulls_last("source"))
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)

    def rest(name: str) -> Column:
        return F.sum(name).over(everything) - F.coalesce(F.sum(name).over(before), F.lit(0.0))

    total = F.sum("source_size").over(everything) * float(share)
    level = (total - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / rest("_weight")
    # The first source whose level stays below its reach, and all after it, share that level.
    fits = F.when(F.col("_level") <= F.col("_reach"), F.col("_at"))
    return (
        limits.withColumns({"_level": level, "_at": F.row_number().over(in_order)})
        .withColumn("_level", F.min_by("_level", fits).over(everything))
        .select(
            "source",
            "source_size",
            F.least(F.col("_limit"), F.coalesce(F.col("_level") * F.col("_weight"), F.col("_limit"))).alias("target"),
        )
    )


def _play(state: Column, row: Column, seed: int) -> Column:
    """One step of the fold: the pending row meets the next one.

    Expected values and the sum of probability times size stay the same; after the
    step at least one of the two is decided.
    """
    pending = state["pending"]
    p, q, s, t = pending["p"], row["p"], pending["size"], row["size"]
    # Up: the pending row gains a and the other loses a * s / t.  Down: the reverse.
    up = F.least(F.lit(1.0) - p, q * t / s)
    down = F.least(p, (F.lit(1.0) - q) * t / s)
    draw = F.pmod(F.xxhash64(pending["key"], row["key"], F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    change = F.when(draw * (up + down) < down, up).otherwise(-down)
    new_p, new_q = p + change, q - change * s / t

    def snapped(value: Column) -> Column:
        return F.when(value < _NEAR, 0.0).when(value > 1 - _NEAR, 1.0).otherwise(value)

    def with_p(unit: Column, value: Column) -> Column:
        return F.struct(
            unit["row"].alias("row"), unit["key"].alias("key"), unit["size"].alias("size"), value.alias("p")
        )

    first, second = with_p(pending, snapped(new_p)), with_p(row, snapped(new_q))

    def is_done(unit: Column) -> Column:
        return unit["p"].isin(0.0, 1.0)

    nobody = F.lit(None).cast("struct<row:bigint,key:bigint,size:double,p:double>")
    both = F.array(first, second)
    played = F.struct(
        F.concat(state["done"], F.filter(both, is_done)).alias("done"),
        F.coalesce(F.try_element_at(F.filter(both, lambda unit: ~is_done(unit)), F.lit(1)), nobody).alias("pending"),
    )
    waiting = F.struct(state["done"].alias("done"), row.alias("pending"))
    return F.when(pending.isNull(), waiting).otherwise(played)


def _fold(units: DataFrame, seed: int) -> DataFrame:
    """Decide all units of a (source, bucket) but one at most, in the order of their keys."""
    unit_type = "struct<row:bigint,key:bigint,size:double,p:double>"
    start = F.struct(
        F.array().cast(f"array<{unit_type}>").alias("done"), F.lit(None).cast(unit_type).alias("pending")
    )
    unit = F.struct("key", "row", "size", "p")
    ordered = F.transform(
        F.array_sort(F.collect_list(unit)),
        lambda x: F.struct(x["row"].alias("row"), x["key"].alias("key"), x["size"].alias("size"), x["p"].alias("p")),
    )
    grouped = units.groupBy("source", "bucket").agg(ordered.alias("_units"))
    return grouped.select(
        "source", F.aggregate("_units", start, lambda state, row: _play(state, row, seed)).alias("s")
    ).select("source", "s.done", "s.pending")


def _play_rest(state: Column, row: Column, seed: int) -> Column:
    """One step of the fold over large rows: a row plays against all smaller ones together.

    The rest of the source has one probability, ``q``, in all its rows, so its mass is a
    number.  The row wins or loses what it needs to be decided, at random, so that its
    expected value and the sum of probability times size stay the same.  Where the rest
    can give or take enough for one way only, that way it goes; where for neither, it goes
    as near to a decision as it can, and is rounded.
    """
    q, size, rest = state["q"], row["size"], F.greatest(state["rest"] - row["size"], F.lit(0.0))
    held, room = q * rest, (F.lit(1.0) - q) * rest
    up = F.least(F.lit(1.0) - q, held / size)
    down = F.least(q, room / size)
    draw = F.pmod(F.xxhash64(row["key"], F.lit(seed), F.lit("large")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    wins, loses = up >= F.lit(1.0 - _NEAR) - q, down >= q - _NEAR

    def left(p: Column) -> Column:
        return F.least(p, F.lit(1.0) - p)

    rises = (
        F.when(wins & loses, draw * (up + down) < down)
        .when(wins, True)
        .when(loses, False)
        .otherwise(left(q + up) < left(q - down))
    )
    p = F.when(rises, q + up).otherwise(q - down)
    new_q = (
        F.when(rises & (held > 0), q * (F.lit(1.0) - up * size / held))
        .when(~rises & (room > 0), F.lit(1.0) - (F.lit(1.0) - q) * (F.lit(1.0) - down * size / room))
        .otherwise(q)
    )
    done = F.struct(row["row"].alias("row"), F.when(p >= 0.5, 1.0).otherwise(0.0).alias("p"))
    return F.struct(
        F.least(F.greatest(new_q, F.lit(0.0)), F.lit(1.0)).alias("q"),
        rest.alias("rest"),
        F.concat(state["done"], F.array(done)).alias("done"),
    )


def _decide_large(units: DataFrame, seed: int) -> DataFrame:
    """source, q and done (row, p): the large rows of every source, and what is left for the others.

    ``units`` are the rows above a thousandth of their source's ``unit_size``, so there are
    fewer than a thousand per source.  A row that all smaller ones together cannot
    decide is rounded to the nearest: no choice of the others comes closer.
    """
    start = F.struct(
        F.first("p").alias("q"),
        F.first("unit_size").alias("rest"),
        F.array().cast("array<struct<row:bigint,p:double>>").alias("done"),
    )
    # Falling sizes; equal ones by key.
    large = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("falling"), "key", "row", "size")))
    return (
        units.groupBy("source")
        .agg(large.alias("_large"), start.alias("_start"))
        .select("source", F.aggregate("_large", F.col("_start"), lambda state, row: _play_rest(state, row, seed)).alias("s"))
        .select("source", "s.q", "s.done")
    )


def copies(
    rows: DataFrame,
    *,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    per_bucket: int = 32,
) -> DataFrame:
    """How often each row is taken: ``rows`` with ``source_size``, ``target``, ``copies``.

    ``rows`` is a stored table of ``_row`` (unique), ``doc_id``, ``source`` and
    ``size``.  The rows of a source are dealt by a hash into buckets of about
    ``per_bucket``; each bucket is rounded down to one undecided row, and these
    rows go to the next level of the tree until one is left per source.  A source
    with a third of all rows thus has a third of the buckets.  Before that, rows above a
    thousandth of their source play against all smaller ones together.  The last row of
    a source has nobody to pass its mass to and is rounded to the nearest: taken sizes
    miss the target by at most half a thousandth of the source, or half of a row that is
    larger than all smaller ones together can make up for.

    Draws are hashes of the row's id and the seed, so reruns agree; rows without
    an id, or with a repeated one, also draw by ``_row``.  Rows of size 0 are taken
    as often as the whole part says.  No row is taken more than ``most`` times
    rounded up.
    """
    spark = rows.sparkSession
    store = Store(spark)
    targets = store.save(source_targets(rows, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    rated = (
        rows.join(targets.withColumnRenamed("source", "_source"), same_source)
        .drop("_source")
        .withColumn("_whole", F.floor(rate + _NEAR))
        .withColumn("p", F.greatest(rate - F.col("_whole"), F.lit(0.0)))
    )
    # Rows of one id would share their buckets at every level.
    known_id = F.coalesce("doc_id", "_row")
    repeated = rows.groupBy(known_id.alias("_id")).count().filter("count > 1").select("_id", F.lit(True).alias("_repeated"))
    key = F.when(F.col("_repeated"), F.xxhash64(known_id, "_row", F.lit(seed))).otherwise(F.xxhash64(known_id, F.lit(seed)))
    units = store.save(
        rated.withColumn("_id", known_id)
        .join(repeated, "_id", "left")
        .filter((F.col("p") > _NEAR) & (F.col("size") > 0))
        .select("source", F.col("_row").alias("row"), key.alias("key"), F.col("size").cast("double").alias("size"), "p"),
        "units",
    )
    masses = units.groupBy(F.col("source").alias("_source")).agg(F.sum("size").alias("unit_size"))
    sized = units.join(masses, same_source).drop("_source")
    is_large = F.col("size") * _LARGE_PARTS > F.col("unit_size")
    large = store.save(_decide_large(sized.filter(is_large), seed), "large")
    left = large.select(F.col("source").alias("_source"), "q")
    units = (
        sized.filter(~is_large)
        .join(left, same_source, "left")
        .select("source", "row", "key", "size", F.coalesce("q", "p").alias("p"))
    )
    settled = units.filter(~F.col("p").between(_NEAR, 1 - _NEAR)).select("row", F.round("p").alias("p"))
    units = units.filter(F.col("p").between(_NEAR, 1 - _NEAR))
    most_rows = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0

    decided, level = [], 0
    certain = large.select(F.inline("done")).unionAll(settled)
    while most_rows > 0:
        buckets = -(-most_rows // per_bucket)
        # All sources get buckets in proportion: a small source then fills only some of them.
        dealt = units.withColumn("bucket", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(buckets)))
        folded = store.save(_fold(dealt, seed + level), f"level{level}")
        decided.append(folded.select(F.inline("done")))
        left = folded.filter("pending is not null")
        units = left.select("source", "pending.*")
        most_rows, level = (buckets if buckets > 1 else 0), level + 1
    if decided:
        # What is still pending is the last row of each source.
        nearest = F.when(F.col("p") >= 0.5, 1.0).otherwise(0.0)
        decided.append(units.select("row", "key", "size", nearest.alias("p")))
    played = reduce(DataFrame.unionAll, [x.select("row", "p") for x in decided], certain)
    taken = played.filter("p = 1.0").select(F.col("row").alias("_row"), F.lit(1).alias("_extra"))
    rated = rated.join(taken, "_row", "left")
    count = (F.col("_whole") + F.coalesce("_extra", F.lit(0))).cast("bigint")
    return rated.select(*rows.columns, "source_size", "target", count.alias("copies"))


def sized_rows(docs: DataFrame) -> DataFrame:
    """The slim rows that ``copies`` takes: size is the number of words, null text 0."""
    return docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "source",
        word_count(F.col("text")).alias("size"),
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and taken (copies times size).

    Other columns are ignored; an empty table gives an empty result.
    """
    rows = Store(docs.sparkSession).save(sized_rows(docs), "rows")
    counted = copies(rows, **options)
    return counted.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "source",
        "copies",
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs``, with all its columns, as often as it is taken.

    Rows stay where they are stored; the numbers of copies are brought to them.
    """
    store = Store(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc")
    stored = store.save_rows(docs.select(whole), "stored")
    rows = stored.select(
        "_row",
        F.col("_doc.doc_id").cast("bigint").alias("doc_id"),
        F.col("_doc.source").alias("source"),
        word_count(F.col("_doc.text")).alias("size"),
    )
    counted = copies(store.save(rows, "rows"), **options).filter("copies > 0").select("_row", "copies")
    counted = store.save(counted, "counted")
    most = counted.agg(F.max("copies")).first()[0] or 1
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    taken = with_numbers(stored, counted, "copies", bits=int(most).bit_length()).filter("copies > 0")
    return taken.withColumn("_copy", times).select("_doc.*")
