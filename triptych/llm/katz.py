"""A Katz backoff model, trained on one part of a corpus and scoring all of it.

P(w | h) = d(c) c(h, w) / c(h) if the n-gram was seen, else a(h) P(w | h'), where h' is h
without its first word; P(w) = d'(c) c(w) / N if the word was seen, else the mass that
discounting left.  The discounts d of each length are Good-Turing's; a(h) makes every
P(. | h) sum to one over the words seen and one unknown word.

A join of every token with the n-gram tables would move the corpus several times.
Instead blocks of about half a million tokens exchange with the tables, length by
length: each asks once for every distinct n-gram of its own and gets its count, and
a weight only where the n-gram was not seen.  Questions and answers travel as packed
arrays.  Of the n-grams of a length, those of a context meet in one bucket; a frequent
context has several, as many as its count demands, and its sums are put together
from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.llm.store import Store
from triptych.llm.words import mix, text_slices, word_hashes

#: Good-Turing discounts apply to counts up to this one (Katz's k).
TRUSTED_COUNT = 5

_GATHERED = 300_000
_START, _UNKNOWN, _FIRST_ID = 0, 1, 2
_END_OF_TEXT = mix(np.full(1, 0xE0D, np.uint64))[0]


def packed(*arrays: np.ndarray) -> bytes:
    """Equally long arrays of whole numbers: bytes by place, then compressed."""
    rows = np.stack([np.ascontiguousarray(a, "<u8") for a in arrays])
    planes = rows.view(np.uint8).reshape(len(arrays), -1, 8).transpose(0, 2, 1)
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(data: bytes, arrays: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(arrays, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u8").reshape(arrays, -1)


@dataclass(frozen=True)
class Discounts:
    """Factors of counts 1 to k (index 0 unused); larger counts keep all."""

    factors: np.ndarray

    @classmethod
    def good_turing(cls, counts_of_counts: list[int]) -> Discounts:
        """From n1 to n(k+1): how many n-grams occur once, twice and so on.

        d(r) = (r*/r - m) / (1 - m) with r* = (r + 1) n(r+1) / n(r) and
        m = (k + 1) n(k+1) / n1.  Copies of texts can lift a count of counts so far
        that a factor would not lie between 0 and 1.  Then k is the largest smaller
        one, 2 at least, whose factors all do; without such a k, the counts of
        counts are smoothed by a log-linear fit and k stays.  Only if the fit fails
        too is the absolute discount n1 / (n1 + 2 n2) taken off each count up to k,
        or one half without counts of one or two.
        """
        n = np.array([0, *counts_of_counts], float)
        largest = len(counts_of_counts) - 1
        for k in range(largest, 1, -1):
            factors = cls._factors(n, k)
            if factors is not None:
                return cls(factors)
        factors = cls._factors(cls._smoothed(n), largest)
        if factors is not None:
            return cls(factors)
        r = np.arange(1, largest + 1)
        off = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return cls(np.append(1.0, (r - off) / r))

    @staticmethod
    def _factors(n: np.ndarray, k: int) -> np.ndarray | None:
        """Good-Turing factors of counts 1 to k from n1 to n(k+1), if all lie between 0 and 1."""
        if (n[1 : k + 2] <= 0).any() or (k + 1) * n[k + 1] >= n[1]:
            return None
        r = np.arange(1, k + 1)
        m = (k + 1) * n[k + 1] / n[1]
        factors = ((r + 1) * n[r + 1] / n[r] / r - m) / (1 - m)
        return np.append(1.0, factors) if ((factors > 0) & (factors < 1)).all() else None

    @staticmethod
    def _smoothed(n: np.ndarray) -> np.ndarray:
        """n(r) on the line through the logarithms of r and of the counts of counts above 0."""
        r = np.flatnonzero(n)
        if len(r) < 2:
            return np.zeros(len(n))
        slope, level = np.polyfit(np.log(r), np.log(n[r]), 1)
        return np.append(0.0, np.exp(level + slope * np.log(np.arange(1, len(n)))))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        small = np.where(counts < len(self.factors), counts, 0)
        return self.factors[small.astype(np.int64)]


@dataclass(frozen=True)
class Unigrams:
    """P(w) from a word's count; what is not given to seen words is the unknown word's."""

    total: int
    discounts: Discounts
    unknown: float

    @classmethod
    def of(cls, total: int, counts_of_counts: list[int]) -> Unigrams:
        discounts = Discounts.good_turing(counts_of_counts)
        r = np.arange(1, len(counts_of_counts) + 1)
        left = ((1 - discounts(r)) * r * np.array(counts_of_counts)).sum()
        # Nothing left (no word is rare): one more token stands for the unknown word.
        return cls(total, discounts, left / total if left > 0 else 1 / (total + 1))

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(float)
        seen = self.discounts(counts) * counts / max(self.total, 1)
        if self.unknown == 1 / (self.total + 1):
            seen = seen * self.total / (self.total + 1)
        return np.where(counts > 0, seen, self.unknown)


# --- blocks -----------------------------------------------------------------------

_BLOCK_SCHEMA = (
    "block bigint, ids array<bigint>, held array<boolean>, sizes array<int>, "
    "tokens binary, words binary, n_words int, trained binary"
)


def _blocks(rows: DataFrame, block_tokens: int) -> DataFrame:
    """doc_id, held and text to blocks of whole texts; tokens are places in the block's words.

    Words are listed by frequency, so that the tokens compress well.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def flush(parts: list[tuple]) -> pa.RecordBatch:
            ids = pa.concat_arrays([x[0] for x in parts])
            held = pa.concat_arrays([x[1] for x in parts])
            sizes = np.concatenate([x[2] for x in parts])
            words, token, counts = np.unique(
                np.concatenate([x[3] for x in parts]), return_inverse=True, return_counts=True
            )
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            token = place[token]
            learn = np.repeat(~np.asarray(held.to_numpy(zero_copy_only=False), bool), sizes)
            trained = np.bincount(token[learn], minlength=len(words))
            columns = [
                pa.array([number], pa.int64()),
                pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                pa.array([sizes.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([packed(token)], pa.binary()),
                pa.array([words[order].tobytes()], pa.binary()),
                pa.array([len(words)], pa.int32()),
                pa.array([packed(trained)], pa.binary()),
            ]
            names = ["block", "ids", "held", "sizes", "tokens", "words", "n_words", "trained"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        parts: list[tuple] = []
        n_tokens = 0
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(2)):
                hashes, starts = word_hashes(data, offsets)
                hashes = np.insert(hashes, starts[1:], _END_OF_TEXT)
                own = [batch.column(i).slice(first, end - first) for i in (0, 1)]
                parts.append((*own, np.diff(starts) + 1, hashes))
                n_tokens += len(hashes)
                if n_tokens >= block_tokens:
                    yield flush(parts)
                    parts, n_tokens, number = [], 0, number + 1
        if parts:
            yield flush(parts)

    return rows.mapInArrow(build, _BLOCK_SCHEMA)


def _block_words(blocks: DataFrame) -> DataFrame:
    """(block, place, word, trained) of all words of all blocks."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, trained in zip(*(batch.column(i) for i in range(3)), strict=True):
                words = np.frombuffer(words.as_py(), np.int64)
                columns = [
                    pa.array(np.full(len(words), block.as_py())),
                    pa.array(np.arange(len(words))),
                    pa.array(words),
                    pa.array(unpacked(trained.as_py(), 1)[0].astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "place", "word", "trained"])

    schema = "block bigint, place bigint, word bigint, trained bigint"
    return blocks.select("block", "words", "trained").mapInArrow(unfold, schema)


def _encoded(blocks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Blocks with the vocabulary's id and count of each of their words."""
    asked = _block_words(blocks).select("block", "place", "word")
    found = asked.join(vocabulary, "word", "left").select(
        "block",
        "place",
        F.coalesce("id", F.lit(_UNKNOWN)).alias("id"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            block, *rest = np.concatenate(held, axis=1)
            order = np.lexsort((rest[0], block))
            block = block[order]
            edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
            data = [packed(*(x[order[i:j]] for x in rest)) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(block[edges[:-1]]), pa.array(data, pa.binary())], names=["block", "data"]
            )

        for batch in batches:
            held.append(np.stack([column.to_numpy() for column in batch.columns]))
            if sum(x.shape[1] for x in held) >= _GATHERED:
                yield flush()
                held = []
        if held:
            yield flush()

    answers = (
        found.mapInArrow(gather, "block bigint, data binary")
        .groupBy("block")
        .agg(F.collect_list("data").alias("answers"))
    )
    names = ["block", "ids", "held", "sizes", "tokens", "known"]

    def attach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = []
            for answer in batch.column(5):
                parts = [unpacked(part.as_py(), 3) for part in answer.values]
                place, ids, count = np.concatenate(parts, axis=1)
                order = np.argsort(place)
                known.append(packed(ids[order], count[order]))
            columns = [batch.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(known, pa.binary())], names=names)

    schema = "block bigint, ids array<bigint>, held array<boolean>, sizes array<int>, tokens binary, known binary"
    joined = blocks.select("block", "ids", "held", "sizes", "tokens").join(answers, "block")
    return joined.mapInArrow(attach, schema)


def _rows_of(batch: pa.RecordBatch) -> Iterator[list]:
    yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


# --- n-grams of a block -----------------------------------------------------------


@dataclass(frozen=True)
class Buckets:
    """Where n-grams are counted: a context that occurs ``share`` times or more has several buckets."""

    number: int
    share: int

    def of(self, words: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Bucket of n-grams (a row per place) from their context, and from the last word if it has several."""
        key = np.zeros(words.shape[1], np.uint64)
        for word in words[:-1]:
            key = mix(key + word)
        key = mix(key + mix(words[-1]) % shares.astype(np.uint64))
        return (((key >> np.uint64(32)) * np.uint64(self.number)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Grams:
    """The distinct n-grams of a block, sorted by bucket and words.

    ``context`` and ``suffix`` are the places of an n-gram without its last and without
    its first word among the shorter ones; ``of_token`` is that of the n-gram which a
    token ends, -1 where the text has begun too late.  ``total`` is the count of the
    context; ``counts``, ``aside`` and ``p`` come with the answers.
    """

    words: np.ndarray
    context: np.ndarray
    suffix: np.ndarray
    of_token: np.ndarray
    trained: np.ndarray
    total: np.ndarray
    shares: np.ndarray
    edges: np.ndarray
    counts: np.ndarray
    aside: np.ndarray
    p: np.ndarray

    @classmethod
    def single(cls, token: np.ndarray, known: bytes, starts: int, unigrams: Unigrams) -> Grams:
        """The words of a block; the last place is the start of a text, a context only."""
        ids, counts = unpacked(known, 2)
        counts = counts.astype(np.int64)
        none = np.zeros(len(ids) + 1, np.int64)
        return cls(
            words=np.append(ids, np.uint64(_START))[None, :],
            context=none,
            suffix=none,
            of_token=token,
            trained=none,
            total=none,
            shares=none,
            edges=none,
            counts=np.append(counts, starts),
            aside=none.astype(bool),
            p=np.append(unigrams(counts), 1.0),
        )

    def longer(self, texts: Texts, buckets: Buckets) -> Grams:
        """The n-grams of one more word; their answers are still to come."""
        size = self.words.shape[1]
        before = np.empty_like(self.of_token)
        before[1:] = self.of_token[:-1]
        before[texts.first] = size - 1 if len(self.words) == 1 else -1
        whole = (before >= 0) & (self.of_token >= 0)
        code, inverse = np.unique(before[whole] * size + self.of_token[whole], return_inverse=True)
        trained = np.bincount(inverse[texts.learn[whole]], minlength=len(code))
        context, suffix = np.divmod(code, size)
        words = np.vstack([self.words[:, context], self.words[-1:, suffix]])
        total = self.counts[context]
        shares = 1 + total // buckets.share
        bucket = buckets.of(words, shares)
        order = np.lexsort((*words[::-1], bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        of_token = np.full(len(self.of_token), -1)
        of_token[whole] = place[inverse]
        none = np.zeros(len(order), np.int64)
        return Grams(
            words=words[:, order],
            context=context[order],
            suffix=suffix[order],
            of_token=of_token,
            trained=trained[order],
            total=total[order],
            shares=shares[order],
            edges=np.searchsorted(bucket[order], np.arange(buckets.number + 1)),
            counts=none,
            aside=none.astype(bool),
            p=none.astype(float),
        )

    def learn(self, found: list[dict] | None, shorter: Grams, discounts: Discounts) -> None:
        """Take the answers in: the recursion's step from the shorter n-grams' probabilities."""
        weight = np.ones(len(self.p))
        for part in found or []:
            own = slice(self.edges[part["bucket"]], self.edges[part["bucket"] + 1])
            answer = unpacked(part["counts"], 1)[0].astype(np.int64)
            self.counts[own], self.aside[own] = answer >> 1, answer & 1
            unseen = np.flatnonzero(self.counts[own] == 0) + own.start
            weight[unseen] = np.frombuffer(zstandard.decompress(part["weights"]))
        seen = seen_probability(self.counts, self.total, self.aside, discounts)
        self.p = np.where(self.counts > 0, seen, weight * shorter.p[self.suffix])


def seen_probability(counts: np.ndarray, total: np.ndarray, aside: np.ndarray, discounts: Discounts) -> np.ndarray:
    """P(w | h) of seen n-grams; ``aside`` contexts have set one more occurrence aside."""
    return discounts(counts) * counts / np.maximum(total + aside, 1)


@dataclass(frozen=True)
class Texts:
    """Tokens that begin a text, and those of texts learned from."""

    first: np.ndarray
    learn: np.ndarray

    @classmethod
    def of(cls, sizes: list[int], held: list[bool]) -> Texts:
        sizes = np.array(sizes)
        return cls(np.cumsum(sizes) - sizes, np.repeat(~np.array(held, bool), sizes))


@dataclass(frozen=True)
class Model:
    """What tasks need to know of the corpus; its size does not depend on the corpus."""

    starts: int
    unigrams: Unigrams
    discounts: dict[int, Discounts]
    buckets: dict[int, Buckets]

    def grams(self, row: dict, length: int) -> tuple[Grams, Grams]:
        """A block's n-grams of ``length``, not yet answered, and the shorter ones."""
        texts = Texts.of(row["sizes"], row["held"])
        token = unpacked(row["tokens"], 1)[0].astype(np.int64)
        grams = Grams.single(token, row["known"], self.starts, self.unigrams)
        for n in range(2, length + 1):
            shorter, grams = grams, grams.longer(texts, self.buckets[n])
            if n < length:
                grams.learn(row[f"found{n}"], shorter, self.discounts[n])
        return grams, shorter


def _state_columns(length: int) -> list[str]:
    return ["block", "sizes", "held", "tokens", "known", *[f"found{n}" for n in range(2, length)]]


# --- counting ---------------------------------------------------------------------


def _counted(state: DataFrame, length: int, model: Model) -> DataFrame:
    """The seen n-grams per bucket, and what each block asked, in its order.

    ``model``: context (a place in the bucket), count, and what gives the shorter
    n-gram's probability, of every seen n-gram.  ``hot``: keys of contexts with several
    buckets, and their places.  ``parts``: per block the counts and contexts of its n-grams.
    """
    columns = _state_columns(length)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in _rows_of(batch):
                row = dict(zip(columns, values, strict=True))
                grams, shorter = model.grams(row, length)
                learned = grams.trained > 0
                # A seen n-gram's shorter one is seen: its count and that of its context tell its P.
                total = np.where(learned, 2 * shorter.total[grams.suffix] + shorter.aside[grams.suffix], 0)
                count = np.where(learned, shorter.counts[grams.suffix], 0)
                arrays = [*grams.words, 2 * grams.trained + (grams.shares > 1), count, total]
                used = np.flatnonzero(np.diff(grams.edges))
                data = [packed(*(x[grams.edges[b] : grams.edges[b + 1]] for x in arrays)) for b in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([row["block"]] * len(used), pa.int64()), pa.array(data, pa.binary())],
                    names=["bucket", "block", "data"],
                )

    part_type = pa.struct([("block", pa.int64()), ("counts", pa.binary()), ("contexts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, parts in _rows_of(batch):
                arrays = [unpacked(part["data"], length + 3) for part in parts]
                *words, trained, lower_count, lower_total = np.concatenate(arrays, axis=1)
                order = np.lexsort(words[::-1])
                new_context, new = np.zeros(len(order), bool), np.zeros(len(order), bool)
                new[:1] = new_context[:1] = True
                for word in words[:-1]:
                    new_context[1:] |= np.diff(word[order]) != 0
                new[1:] = new_context[1:] | (np.diff(words[-1][order]) != 0)
                gram, context = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
                gram[order], context[order] = np.cumsum(new) - 1, np.cumsum(new_context) - 1
                counts = np.bincount(gram, (trained >> np.uint64(1)).astype(float)).astype(np.int64)
                first = order[new]
                lower = np.zeros((2, len(first)), np.uint64)
                for into, values in zip(lower, (lower_count, lower_total), strict=True):
                    np.maximum.at(into, gram, values)
                seen = counts > 0
                heads = order[new_context]
                hot = np.flatnonzero(trained[heads] & np.uint64(1))
                key = np.zeros(len(hot), np.uint64)
                for word in words[:-1]:
                    key = mix(key + word[heads[hot]])
                answers, at = [], 0
                for part, array in zip(parts, arrays, strict=True):
                    own = slice(at, at + array.shape[1])
                    at = own.stop
                    steps = np.diff(context[own], prepend=0)
                    answers.append({"block": part["block"], "counts": packed(counts[gram[own]]), "contexts": packed(steps)})
                rare = [int((counts == r).sum()) for r in range(1, TRUSTED_COUNT + 2)]
                cells = [
                    (bucket, pa.int32()),
                    (len(heads), pa.int64()),
                    (packed(context[first][seen], counts[seen], *lower[:, seen]), pa.binary()),
                    (packed(key, hot), pa.binary()),
                    (rare, pa.list_(pa.int64())),
                    (answers, pa.list_(part_type)),
                ]
                names = ["bucket", "contexts", "model", "hot", "rare", "parts"]
                yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in cells], names=names)

    asked = state.select(*columns).mapInArrow(ask, "bucket int, block bigint, data binary")
    return asked.groupBy("bucket").agg(F.collect_list(F.struct("block", "data")).alias("parts")).mapInArrow(
        count,
        "bucket int, contexts bigint, model binary, hot binary, rare array<bigint>, "
        "parts array<struct<block:bigint,counts:binary,contexts:binary>>",
    )


def _masses(contexts: int, data: bytes, length: int, model: Model) -> tuple[np.ndarray, ...]:
    """Per context of a bucket: its count here, what discounting takes, and the shorter ones' P of its words."""
    context, count, lower_count, lower_total = unpacked(data, 4).astype(np.int64)
    if length == 2:
        lower = model.unigrams(lower_count)
    else:
        lower = seen_probability(lower_count, lower_total >> 1, lower_total & 1, model.discounts[length - 1])
    taken = (1 - model.discounts[length](count)) * count
    return tuple(np.bincount(context, x, contexts) for x in (count.astype(float), taken, lower))


def _backoff(total: np.ndarray, taken: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight of the shorter n-grams, whether one more occurrence is set aside) of contexts.

    A context without training n-grams leaves all to the shorter ones.  One whose
    n-grams are all frequent leaves nothing: one more occurrence is then set aside.
    """
    aside = (taken <= 0) & (total > 0)
    total_ = np.maximum(total, 1)
    left = np.where(aside, 1 / (total_ + 1), np.where(total > 0, taken / total_, 1.0))
    return left / np.maximum(1 - lower, 1e-300), aside


def _hot_masses(counted: DataFrame, length: int, model: Model) -> DataFrame:
    """(bucket, places, masses): of contexts with several buckets, the sums over all of these.

    There are as many rows as such contexts have buckets, in proportion to their tokens.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, contexts, data, hot in _rows_of(batch):
                key, place = unpacked(hot, 2)
                place = place.astype(np.int64)
                masses = [m[place] for m in _masses(contexts, data, length, model)]
                columns = [np.full(len(place), bucket, np.int32), key.view(np.int64), place, *masses]
                yield pa.RecordBatch.from_arrays(
                    list(map(pa.array, columns)), names=["bucket", "key", "place", "total", "taken", "lower"]
                )

    schema = "bucket int, key bigint, place bigint, total double, taken double, lower double"
    parts = counted.select("bucket", "contexts", "model", "hot").mapInArrow(part, schema)
    masses = [F.sum(name).alias(name) for name in ("total", "taken", "lower")]
    whole = parts.groupBy("key").agg(*masses)
    return (
        parts.select("bucket", "key", "place")
        .join(whole, "key")
        .groupBy("bucket")
        .agg(F.collect_list(F.struct("place", "total", "taken", "lower")).alias("masses"))
    )


def _answers(counted: DataFrame, hot: DataFrame, length: int, model: Model) -> DataFrame:
    """(block, found): per bucket the counts of a block's n-grams, and weights of those not seen."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, contexts, data, parts, masses in _rows_of(batch):
                sums = _masses(contexts, data, length, model)
                if masses:
                    place = np.array([m["place"] for m in masses])
                    for own, name in zip(sums, ("total", "taken", "lower"), strict=True):
                        own[place] = [m[name] for m in masses]
                weight, aside = _backoff(*sums)
                out = [[], [], [], []]
                for part in parts:
                    counts = unpacked(part["counts"], 1)[0].astype(np.int64)
                    context = np.cumsum(unpacked(part["contexts"], 1)[0].astype(np.int64))
                    weights = zstandard.compress(weight[context[counts == 0]].tobytes(), 1)
                    cells = (part["block"], bucket, packed(2 * counts + aside[context]), weights)
                    for column, cell in zip(out, cells, strict=True):
                        column.append(cell)
                types = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["block", "bucket", "counts", "weights"]
                )

    per_bucket = counted.join(hot, "bucket", "left").select("bucket", "contexts", "model", "parts", "masses")
    answered = per_bucket.mapInArrow(answer, "block bigint, bucket int, counts binary, weights binary")
    found = F.collect_list(F.struct("bucket", "counts", "weights"))
    return answered.groupBy("block").agg(found.alias(f"found{length}"))


# --- scores -----------------------------------------------------------------------


def _scores(state: DataFrame, order: int, model: Model, vocabulary: int) -> DataFrame:
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    columns = ["ids", *_state_columns(order + 1)]
    total = model.unigrams.total

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in _rows_of(batch):
                row = dict(zip(columns, values, strict=True))
                texts = Texts.of(row["sizes"], row["held"])
                token = unpacked(row["tokens"], 1)[0].astype(np.int64)
                grams = Grams.single(token, row["known"], model.starts, model.unigrams)
                count = grams.counts[token].astype(float)
                p = np.zeros(len(token))
                for n in range(2, order + 1):
                    shorter, grams = grams, grams.longer(texts, model.buckets[n])
                    grams.learn(row[f"found{n}"], shorter, model.discounts[n])
                    whole = grams.of_token >= 0
                    p[whole] = grams.p[grams.of_token[whole]]
                base = np.log10((count + 0.1) / (total + 0.1 * (vocabulary + 1)))
                sizes = np.array(row["sizes"])
                per_text = [np.add.reduceat(x, texts.first) for x in (base, np.log10(p), count > 0)]
                cells = [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(row["held"], pa.bool_()),
                    pa.array(sizes, pa.int64()),
                    pa.array(per_text[2], pa.int64()),
                    pa.array(np.full(len(sizes), total), pa.int64()),
                    pa.array(per_text[0], pa.float64()),
                    pa.array(per_text[1], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(cells, names=names)

    return state.select(*columns).mapInArrow(
        score,
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double",
    )


def _counts_of_counts(row: dict | None) -> list[int]:
    return [int((row or {}).get(f"n{r}") or 0) for r in range(1, TRUSTED_COUNT + 2)]


def score_documents(docs: DataFrame, *, order: int = 3, block_tokens: int = 500_000) -> DataFrame:
    """Scores of all texts of ``docs`` (doc_id, text), learned from those not held out.

    A text is held out when the crc32 of its id as text is divisible by 10, or its
    id is null.  Words are runs without white space, A-Z lower-cased; every text
    ends with one more token.  A null text is empty and has that token only.
    ``base_score`` is the additive unigram score, ``score`` the log10 probability of a
    model of n-grams up to ``order`` words; both sum over all tokens.  Repeated rows are
    scored, and learned from, as often as they occur.  An empty table gives an empty
    result, and other columns are ignored.  Words are told apart by 64-bit hashes.

    What is gathered on the driver does not grow with the corpus: sums, and counts of
    rare counts.
    """
    if order < 2:
        raise ValueError("a backoff model has n-grams of two words at least")
    store = Store(docs.sparkSession)
    doc_id = F.col("doc_id").cast("bigint")
    held = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(True))
    rows = docs.select(doc_id.alias("doc_id"), held.alias("held"), "text")
    blocks = store.save(_blocks(rows, block_tokens), "blocks")

    words = (
        _block_words(blocks).filter("trained > 0").groupBy("word").agg(F.sum("trained").alias("count"))
    )
    counted = store.save(words, "counted")
    store.release()
    # Frequent words get small numbers, which keeps the n-grams short.
    vocabulary = store.save(
        counted.orderBy(F.desc("count"), "word").withColumn(
            "id", F.monotonically_increasing_id() + _FIRST_ID
        ),
        "vocabulary",
    )
    store.release()
    rare = [F.count_if(F.col("count") == r).alias(f"n{r}") for r in range(1, TRUSTED_COUNT + 2)]
    summary = vocabulary.agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("n"), *rare).first().asDict()
    unigrams = Unigrams.of(int(summary["total"] or 0), _counts_of_counts(summary))
    sizes = blocks.select(
        F.aggregate("sizes", F.lit(0).cast("bigint"), lambda x, y: x + y).alias("tokens"),
        F.size(F.filter("held", lambda x: ~x)).alias("learned"),
    ).agg(F.sum("tokens").alias("tokens"), F.sum("learned").alias("learned")).first()
    number = max(1, (sizes["tokens"] or 0) // (4 * block_tokens))
    buckets = Buckets(number, max(block_tokens, 1))
    model = Model(int(sizes["learned"] or 0), unigrams, {}, {n: buckets for n in range(2, order + 1)})

    state = store.save(_encoded(blocks, vocabulary.select("word", "id", "count")), "state1")
    store.drop("blocks", "counted")
    store.release()
    for length in range(2, order + 1):
        counted = store.save(_counted(state, length, model), f"counted{length}")
        store.release()
        found = counted.agg(
            *[F.sum(F.get("rare", F.lit(r))).alias(f"n{r + 1}") for r in range(TRUSTED_COUNT + 1)]
        ).first()
        model.discounts[length] = Discounts.good_turing(_counts_of_counts(found.asDict()))
        answers = _answers(counted, _hot_masses(counted, length, model), length, model)
        state = state.join(answers, "block", "left")
        if length < order:
            state = store.save(state, f"state{length}")
            store.drop(f"state{length - 1}", f"counted{length}")
            store.release()
    return _scores(state, order, model, summary["n"])
