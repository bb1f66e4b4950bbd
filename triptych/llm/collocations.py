"""Collocations: phrases whose words occur together more often than apart.

Words get numbers by falling frequency.  A pair of neighbours is then a cell of a
table that is split into square tiles: the tiles of frequent words are full and are
counted by direct address (one dense array, one ``bincount``), the others are sorted
lists of cells.  Frequent pairs are numbered by frequency again and take the place of
words, so that two overlapping pairs make a phrase of three words, and so on.

Blocks of whole texts count their own words and cells and send them, packed, to buckets;
from these they learn the numbers of the ones that are frequent in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triptych.llm.blocks import answer_columns, gathered
from triptych.llm.katz import packed, unpacked
from triptych.llm.store import Store
from triptych.llm.words import _BYTE_VALUE, _powers_up_to, mix, text_slices

#: Characters that end a piece of text, and those between words of a piece.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
UNKNOWN_LANGUAGE = "und"

_TILE = 512
#: A tile is counted by direct address when it has a pair for every so many cells.
_CELLS_PER_PAIR = 16
#: Pairs of neighbours in the corpus for each bucket that their totals are counted in.
_PAIRS_PER_BUCKET = 1_000_000
_WORDS_PER_BUCKET = 500_000
#: Between language and word; no word contains it.
_BETWEEN = "\t"


def _bytes_in(characters: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters.encode())] = True
    return found


_ENDS = _bytes_in(PIECE_ENDS)
_INSIDE = ~(_ENDS | _bytes_in(BLANKS))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words: hash, first byte, end, text, and a number of the piece they are in."""
    if not len(data):
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(4)))
    inside = _INSIDE[data]
    edges = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(data))]
    follows = np.zeros(len(data) + 1, bool)
    follows[1:-1] = inside[:-1] & inside[1:]
    follows[edges] = False
    starts = np.flatnonzero(inside & ~follows[:-1])
    ends = np.flatnonzero(inside & ~follows[1:]) + 1
    powers, inverses = _powers_up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverses[starts] ^ (ends - starts).astype(np.uint64))
    owner = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(_ENDS[data])[starts] + owner
    return hashes, starts, ends, owner, piece


def count_pairs(left: np.ndarray, right: np.ndarray, size: int, tile: int = _TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers below ``size``, and how often each occurs.

    Small numbers are frequent ones, so the first tiles are dense: those are counted by
    direct address, a cell per pair of numbers.  All others are counted as a sorted
    list of cells.
    """
    across = -(-size // tile)
    of = (left // tile) * across + right // tile
    cell = (left % tile) * tile + right % tile
    tiles, place, filled = np.unique(of, return_inverse=True, return_counts=True)
    is_dense = filled * _CELLS_PER_PAIR >= tile * tile
    codes, counts = [], []
    for i in np.flatnonzero(is_dense):
        table = np.bincount(cell[place == i], minlength=tile * tile)
        used = np.flatnonzero(table)
        codes.append(tiles[i] * tile * tile + used)
        counts.append(table[used])
    sparse = ~is_dense[place]
    code, n = np.unique(of[sparse] * tile * tile + cell[sparse], return_counts=True)
    codes, counts = np.concatenate([*codes, code]), np.concatenate([*counts, n])
    of, cell = np.divmod(codes, tile * tile)
    return of // across * tile + cell // tile, of % across * tile + cell % tile, counts


# --- blocks -----------------------------------------------------------------------


def _blocks(rows: DataFrame, block_words: int) -> DataFrame:
    """lang and text to blocks of whole texts.

    ``tokens`` are places in the block's own list of words, most frequent first, from
    1; a 0 stands between pieces of text.  ``keys`` are language and word, ``sizes`` the
    words of each language.
    """
    names = ["block", "tokens", "keys", "counts", "langs", "sizes"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def flush(parts: list[tuple], langs: list[str]) -> pa.RecordBatch:
            keys, words, lang_of, tokens, piece_ends = zip(*parts, strict=True)
            sizes = [len(x) for x in keys]
            shift = np.repeat(np.cumsum([0, *sizes[:-1]]), [len(x) for x in tokens])
            keys, first, own = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            token = own[np.concatenate(tokens) + shift]
            counts = np.bincount(token, minlength=len(keys))
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(1, len(order) + 1)
            ends = np.flatnonzero(np.concatenate(piece_ends)) + 1
            first = first[order]
            lang_of = np.concatenate(lang_of)[first]
            names_of = pa.array(langs).take(pa.array(lang_of))
            words = pa.concat_arrays(words).take(pa.array(first))
            sizes_of = np.bincount(lang_of, counts[order], len(langs)).astype(np.int64)
            columns = [
                pa.array([number], pa.int64()),
                pa.array([packed(np.insert(place[token], ends, 0))], pa.binary()),
                pa.array([pc.binary_join_element_wise(names_of, words, _BETWEEN).to_pylist()], pa.list_(pa.string())),
                pa.array([counts[order]], pa.list_(pa.int64())),
                pa.array([langs], pa.list_(pa.string())),
                pa.array([sizes_of], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        parts: list[tuple] = []
        langs: dict[str, int] = {}
        held = 0
        for batch in batches:
            lang = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], np.int64)
            for first, _, data, offsets in text_slices(batch.column(1)):
                hashes, starts, ends, owner, piece = text_words(data, offsets)
                if not len(hashes):
                    continue
                lang_of = lang[first + owner]
                keys = mix(hashes ^ mix(lang_of.astype(np.uint64)))
                keys, at, token = np.unique(keys, return_index=True, return_inverse=True)
                text = _LOWER[data].tobytes()
                words = [text[i:j].decode() for i, j in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                piece_end = np.append(piece[1:] != piece[:-1], True)
                parts.append((keys, pa.array(words, pa.string()), lang_of[at], token, piece_end))
                held += len(hashes)
                if held >= block_words:
                    yield flush(parts, list(langs))
                    parts, held, number = [], 0, number + 1
        if parts:
            yield flush(parts, list(langs))

    schema = "block bigint, tokens binary, keys array<string>, counts array<bigint>, langs array<string>, sizes array<bigint>"
    return rows.mapInArrow(build, schema)


def _asked_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, places, lengths, keys): per block and bucket its words and their counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts in zip(*batch.columns, strict=True):
                keys, counts = keys.values, counts.values.to_numpy()
                data, offsets = next((d, o) for _, _, d, o in text_slices(keys, 1 << 62))
                bucket = _of_buckets(_text_hashes(data, offsets), buckets)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(edges))
                lengths, ordered = np.diff(offsets)[order], keys.take(pa.array(order))
                ends = np.concatenate([[0], np.cumsum(lengths)])
                text = ordered.buffers()[2].to_pybytes()
                numbers, texts = [], []
                for b in used:
                    i, j = edges[b], edges[b + 1]
                    numbers.append(packed(order[i:j], lengths[i:j], counts[order[i:j]]))
                    texts.append(zstandard.compress(text[ends[i] : ends[j]], 1))
                columns = [pa.array(used), pa.array(np.full(len(used), block.as_py()))]
                columns += [pa.array(x, pa.binary()) for x in (numbers, texts)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "numbers", "keys"])

    schema = "bucket bigint, block bigint, numbers binary, keys binary"
    return blocks.select("block", "keys", "counts").mapInArrow(ask, schema)


def _text_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    powers, inverses = _powers_up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) * inverses[offsets[:-1]])


def _of_buckets(key: np.ndarray, buckets: int) -> np.ndarray:
    return (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _counted_words(asked: DataFrame, min_count: int) -> DataFrame:
    """Per bucket its frequent words and their counts, and per block which of them it has, at which places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, parts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                numbers = [unpacked(part["numbers"], 3).astype(np.int64) for part in parts]
                _, lengths, n = np.concatenate(numbers, axis=1)
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                text = b"".join(zstandard.decompress(part["keys"]) for part in parts)
                keys = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(text))
                keys = keys.dictionary_encode()
                word = keys.indices.to_numpy()
                counts = np.bincount(word, n).astype(np.int64)
                frequent = counts >= min_count
                index = np.cumsum(frequent) - 1
                has, at = [], 0
                for part, (place, *_) in zip(parts, numbers, strict=True):
                    own = word[at : at + len(place)]
                    at += len(place)
                    hit = frequent[own]
                    if hit.any():
                        has.append({"block": part["block"], "has": packed(place[hit], index[own[hit]])})
                columns = [
                    pa.array([bucket], pa.int64()),
                    pa.array([keys.dictionary.filter(pa.array(frequent)).to_pylist()], pa.list_(pa.string())),
                    pa.array([counts[frequent]], pa.list_(pa.int64())),
                    pa.array([has], _HAS),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "counts", "blocks"])

    return (
        asked.groupBy("bucket")
        .agg(F.collect_list(F.struct("block", "numbers", "keys")).alias("parts"))
        .mapInArrow(
            count,
            "bucket bigint, keys array<string>, counts array<bigint>, blocks array<struct<block:bigint,has:binary>>",
        )
    )


_HAS = pa.list_(pa.struct([("block", pa.int64()), ("has", pa.binary())]))


def _frequent_words(counted: DataFrame) -> DataFrame:
    """(bucket, place, lang, words, a, firsts, rests) of all frequent words."""
    none = F.array().cast("array<bigint>")
    key = F.col("w.keys")
    word = F.substring_index(key, _BETWEEN, -1)  # no word has the separator
    return counted.select(
        "bucket", F.posexplode(F.arrays_zip("keys", "counts")).alias("place", "w")
    ).select(
        "bucket",
        F.col("place").cast("bigint").alias("place"),
        F.substr(key, F.lit(1), F.length(key) - F.length(word) - 1).alias("lang"),
        F.array(word).alias("words"),
        F.col("w.counts").alias("a"),
        none.alias("firsts"),
        none.alias("rests"),
    )


def _named(blocks: DataFrame, counted: DataFrame, numbered: DataFrame) -> DataFrame:
    """Blocks from words to their numbers; none for rare words and between pieces."""
    ids = gathered(numbered.select(F.col("bucket").alias("block"), "place", "id"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owners, found in zip(*batch.columns, strict=True):
                index, number = answer_columns(found, 2)
                numbers = number[np.argsort(index)]
                block, data = [], []
                for part in owners.as_py():
                    place, own = unpacked(part["has"], 2).astype(np.int64)
                    block.append(part["block"])
                    data.append(packed(place + 1, numbers[own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["block", "data"]
                )

    per_bucket = counted.select("bucket", "blocks").join(ids.withColumnRenamed("block", "bucket"), "bucket")
    answered = per_bucket.select("blocks", "answers").mapInArrow(answer, "block bigint, data binary")
    answers = answered.groupBy("block").agg(F.collect_list("data").alias("answers"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, tokens, found in zip(*batch.columns, strict=True):
                tokens = unpacked(tokens.as_py(), 1)[0].astype(np.int64)
                place, number = answer_columns(found, 2)
                table = np.full(int(tokens.max()) + 1, -1)
                table[place] = number
                yield _gram_row(block.as_py(), table[tokens] + 1)

    return blocks.select("block", "tokens").join(answers, "block").mapInArrow(apply, _GRAMS)


_GRAMS = "block bigint, grams binary, pairs bigint"


def _gram_row(block: int, grams: np.ndarray) -> pa.RecordBatch:
    """Numbers from 1, 0 for none, and how many neighbours both have one."""
    pairs = int(((grams[:-1] > 0) & (grams[1:] > 0)).sum())
    columns = [pa.array([block]), pa.array([packed(grams)], pa.binary()), pa.array([pairs])]
    return pa.RecordBatch.from_arrays(columns, names=["block", "grams", "pairs"])


def _pairs_of(grams: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places with a number that the next place has too, the numbers in use, and both as ranks in them."""
    grams = unpacked(grams, 1)[0].astype(np.int64) - 1
    at = np.flatnonzero((grams[:-1] >= 0) & (grams[1:] >= 0))
    numbers, rank = np.unique(np.concatenate([grams[at], grams[at + 1]]), return_inverse=True)
    return at, numbers, rank[: len(at)], rank[len(at) :]


def _bucket(prefix: np.ndarray, suffix: np.ndarray, buckets: int) -> np.ndarray:
    return _of_buckets(mix(mix(prefix.astype(np.uint64)) ^ suffix.astype(np.uint64)), buckets)


def _asked(grams: DataFrame, buckets: int) -> DataFrame:
    """(bucket, block, data): per block and bucket its pairs of neighbouring numbers and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own in zip(*batch.columns, strict=True):
                _, numbers, left, right = _pairs_of(own.as_py())
                if not len(left):
                    continue
                left, right, n = count_pairs(left, right, len(numbers))
                prefix, suffix = numbers[left], numbers[right]
                bucket = _bucket(prefix, suffix, buckets)
                order = np.lexsort((suffix, prefix, bucket))
                columns = [x[order] for x in (prefix, suffix, n)]
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                used = np.flatnonzero(np.diff(edges))
                data = [packed(*(x[edges[b] : edges[b + 1]] for x in columns)) for b in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used), pa.array(np.full(len(used), block.as_py())), pa.array(data, pa.binary())],
                    names=["bucket", "block", "data"],
                )

    return grams.select("block", "grams").mapInArrow(count, "bucket bigint, block bigint, data binary")


def _counted(asked: DataFrame, min_count: int) -> DataFrame:
    """Per bucket its frequent pairs (prefix, suffix, count), and per block which of them it has."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, parts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                arrays = [unpacked(part["data"], 3).astype(np.int64) for part in parts]
                prefix, suffix, n = np.concatenate(arrays, axis=1)
                order = np.lexsort((suffix, prefix))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(prefix[order]) != 0) | (np.diff(suffix[order]) != 0)
                pair = np.empty(len(order), np.int64)
                pair[order] = np.cumsum(new) - 1
                counts = np.zeros(int(new.sum()), np.int64)
                np.add.at(counts, pair, n)
                frequent = counts >= min_count
                first, place = order[new][frequent], np.cumsum(frequent) - 1
                has, at = [], 0
                for part, array in zip(parts, arrays, strict=True):
                    own = pair[at : at + array.shape[1]]
                    at += array.shape[1]
                    own = place[own[frequent[own]]]
                    if len(own):
                        has.append({"block": part["block"], "has": packed(own)})
                columns = [
                    pa.array([bucket], pa.int64()),
                    pa.array([packed(prefix[first], suffix[first], counts[frequent])], pa.binary()),
                    pa.array([has], _HAS),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "pairs", "blocks"])

    return (
        asked.groupBy("bucket")
        .agg(F.collect_list(F.struct("block", "data")).alias("parts"))
        .mapInArrow(count, "bucket bigint, pairs binary, blocks array<struct<block:bigint,has:binary>>")
    )


def _frequent(counted: DataFrame) -> DataFrame:
    """(bucket, place, prefix, suffix, a) of all frequent pairs."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, pairs in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                columns = unpacked(pairs, 3).astype(np.int64)
                place = np.arange(columns.shape[1])
                columns = [np.full(len(place), bucket), place, *columns]
                yield pa.RecordBatch.from_arrays(
                    list(map(pa.array, columns)), names=["bucket", "place", "prefix", "suffix", "a"]
                )

    schema = "bucket bigint, place bigint, prefix bigint, suffix bigint, a bigint"
    return counted.select("bucket", "pairs").mapInArrow(unfold, schema)


def _answers(counted: DataFrame, numbered: DataFrame) -> DataFrame:
    """(block, answers): prefix, suffix and new number of the frequent pairs of every block."""
    ids = gathered(numbered.select(F.col("bucket").alias("block"), "place", "id"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, blocks, found in zip(*batch.columns, strict=True):
                prefix, suffix, _ = unpacked(pairs.as_py(), 3)
                place, number = answer_columns(found, 2)
                numbers = number[np.argsort(place)]
                block, data = [], []
                for part in blocks.as_py():
                    own = unpacked(part["has"], 1)[0].astype(np.int64)
                    block.append(part["block"])
                    data.append(packed(prefix[own], suffix[own], numbers[own]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["block", "data"]
                )

    per_bucket = counted.join(ids.withColumnRenamed("block", "bucket"), "bucket").select("pairs", "blocks", "answers")
    answered = per_bucket.mapInArrow(answer, "block bigint, data binary")
    return answered.groupBy("block").agg(F.collect_list("data").alias("answers"))


def _joined(grams: DataFrame, answers: DataFrame) -> DataFrame:
    """Blocks with the numbers of the longer phrases, where they are frequent."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, own, answer in zip(*batch.columns, strict=True):
                own = own.as_py()
                at, numbers, left, right = _pairs_of(own)
                prefix, suffix, number = answer_columns(answer, 3)
                known = np.searchsorted(numbers, prefix) * len(numbers) + np.searchsorted(numbers, suffix)
                order = np.argsort(known)
                known, number = known[order], number[order]
                code = left * len(numbers) + right
                place = np.minimum(np.searchsorted(known, code), len(known) - 1)
                hit = known[place] == code
                longer = np.zeros(len(unpacked(own, 1)[0]), np.int64)
                longer[at[hit]] = number[place[hit]] + 1
                yield _gram_row(block.as_py(), longer)

    return grams.select("block", "grams").join(answers, "block").mapInArrow(apply, _GRAMS)


# --- phrases ----------------------------------------------------------------------


def _numbered(phrases: DataFrame, store: Store, name: str) -> DataFrame:
    """``phrases`` with ``id``: 0 for the most frequent, without gaps.

    Rows are sorted in parts by ranges; a part's numbers start where those before end.
    """
    part, place = F.shiftright("_sorted", 33), F.col("_sorted").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = store.save(
        phrases.orderBy(F.desc("a"), "lang", "words").withColumn("_sorted", F.monotonically_increasing_id()),
        f"ordered{name}",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = (
        ordered.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    numbered = ordered.withColumn("_part", part).join(starts, "_part").withColumn("id", F.col("_start") + place)
    return store.save(numbered.drop("_part", "_sorted", "_start"), f"phrases{name}")


def _longer(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases from pairs of overlapping shorter ones: their words, and counts of their parts.

    ``firsts`` are the counts of the first word, the first two and so on, ``rests`` those of
    what follows them.
    """
    first = shorter.select(
        F.col("id").alias("prefix"), "lang", F.col("words").alias("_words"), F.col("a").alias("_first"), "firsts"
    )
    rest = shorter.select(
        F.col("id").alias("suffix"), F.element_at("words", -1).alias("_last"), F.col("a").alias("_rest"), "rests"
    )
    return (
        found.join(first, "prefix")
        .join(rest, "suffix")
        .select(
            "lang",
            F.concat("_words", F.array("_last")).alias("words"),
            "a",
            F.concat("firsts", F.array("_first")).alias("firsts"),
            F.concat(F.array("_rest"), "rests").alias("rests"),
            "prefix",
            "suffix",
            "bucket",
            "place",
        )
    )


def _not_inside_longer(phrases: DataFrame, longer: DataFrame, share: int) -> DataFrame:
    """Drop phrases of which a longer one has at least ``share`` percent of the count.

    A phrase is no more frequent than any part of it, so among all longer phrases
    around one those with one more word are the most frequent.
    """
    around = longer.select(F.explode(F.array("prefix", "suffix")).alias("id"), F.col("a").alias("_longer"))
    most = around.groupBy("id").agg(F.max("_longer").alias("_longer"))
    inside = F.coalesce(F.col("_longer") * 100 >= F.col("a") * share, F.lit(False))
    return phrases.join(most, "id", "left").filter(~inside).drop("_longer")


def _weakest_cut(scale: int) -> Column:
    """score, place, l and r of the lowest-scoring cut, in exact decimals."""
    return F.expr(
        f"""array_min(transform(arrays_zip(firsts, rests), (c, i) -> struct(
            (CAST({scale} AS DECIMAL(8, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(n AS DECIMAL(15, 0)))
              div (CAST(c.firsts AS DECIMAL(19, 0)) * CAST(c.rests AS DECIMAL(19, 0))) AS score,
            i AS place, c.firsts AS l, c.rests AS r)))"""
    )


def collocations(
    docs: DataFrame,
    *,
    min_count: int = 100,
    max_words: int = 5,
    per_language: int = 2000,
    absorbed_at: int = 100,
    scale: int = 1000,
    block_words: int = 1_000_000,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the strongest collocations of every language.

    ``docs`` has lang and text.  Texts, A-Z lower-cased, are cut at ``PIECE_ENDS`` into
    pieces and those at blanks and tabs into words.  A phrase has 2 to ``max_words``
    words of one piece and occurs ``a >= min_count`` times in its language, overlaps
    included; ``n`` counts the language's words.  Cut in two parts that occur l and r
    times it scores floor(scale * a * n / (l * r)); its weakest cut counts, ties to the
    shorter first part.  Phrases inside a longer one with ``absorbed_at`` percent of their
    count are dropped.  Each language's best ``per_language`` are returned, by score, a
    and phrase.

    A null language is ``und``, a null or empty text has no words.  Repeated rows count
    as often as they occur.  An empty table, or one without frequent phrases, gives an
    empty result; other columns are ignored.  Texts are never cut short.  Words of a
    block are told apart by 64-bit hashes, those of the corpus by their letters.
    """
    store = Store(docs.sparkSession)
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANGUAGE)).alias("lang"), "text")
    blocks = store.save(_blocks(rows, block_words), "blocks")
    listed = blocks.select(F.inline(F.arrays_zip("langs", "sizes")))
    sizes = store.save(listed.groupBy(F.col("langs").alias("lang")).agg(F.sum("sizes").alias("n")), "sizes")
    asked = blocks.agg(F.sum(F.size("keys"))).first()[0] or 0
    counted = store.save(_counted_words(_asked_words(blocks, max(1, asked // _WORDS_PER_BUCKET)), min_count), "counted1")
    store.release()
    levels = [_numbered(_frequent_words(counted), store, "1")]
    grams = store.save(_named(blocks, counted, levels[0]), "grams1")
    store.drop("blocks", "counted1", "ordered1")
    store.release()
    for length in range(2, max_words + 1):
        pairs = grams.agg(F.sum("pairs")).first()[0] or 0
        asked = _asked(grams, max(1, pairs // _PAIRS_PER_BUCKET))
        counted = store.save(_counted(asked, min_count), f"counted{length}")
        store.release()
        levels.append(_numbered(_longer(_frequent(counted), levels[-1]), store, str(length)))
        if length < max_words:
            grams = store.save(_joined(grams, _answers(counted, levels[-1])), f"grams{length}")
        store.drop(f"counted{length}", f"grams{length - 1}", f"ordered{length}")
        store.release()

    kept = [_not_inside_longer(own, longer, absorbed_at) for own, longer in zip(levels[1:-1], levels[2:], strict=True)]
    fields = ("lang", "words", "a", "firsts", "rests")
    phrases = reduce(DataFrame.unionAll, [x.select(*fields) for x in [*kept, *levels[1:][-1:]]])
    scored = phrases.join(sizes, "lang").withColumn("c", _weakest_cut(scale))
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("phrase", F.array_join("words", " ")).withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= per_language).select(
        "lang", F.col("_rank").cast("bigint").alias("rank"), "phrase", "a", "c.l", "c.r", "n", "c.score"
    )


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), sequences AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces
), starts AS (
  SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
  FROM sequences CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS k)
), f AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM starts GROUP BY ALL
), sizes AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS words, a FROM f WHERE k > 1 AND a >= 100
), cuts AS (
  SELECT lang, phrase, a, k, j, array_to_string(words[1:j], ' ') AS first, array_to_string(words[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, x.a AS l, y.a AS r, n,
    CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score, j
  FROM cuts c JOIN sizes USING (lang)
    JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
  SELECT * FROM weakest w WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = w.lang AND c.k > w.k AND c.a >= w.a
      AND contains(' ' || c.phrase || ' ', ' ' || w.phrase || ' '))
)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score FROM kept
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY row_number() OVER w <= 2000
"""
