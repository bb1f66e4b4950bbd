"""Best-fit packing planned on the histogram of lengths.

The number of distinct lengths is bounded by the sequence capacity, so best-fit
runs over counts, on the driver, in a table whose size depends on the capacity
alone.  Pieces then take the planned slots by their rank within their length.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.llm.store import Store, rank_within
from triptych.llm.words import keep_one

#: Plans up to this many rows (about 5 MB) are broadcast, longer ones joined by shuffle.
BROADCAST_PLAN_ROWS = 100_000

# White space by Unicode, which the tokenizers' normalizer turns into blanks.
_TEXT_WORD = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_CACHED_WORDS = 500_000


class WordTokenizer:
    """Token ids of whole texts, with the ids of up to a million recent words kept.

    For tokenizers that drop white space before they split: no token then crosses
    it, and a text's ids are those of its words in turn.  Texts that may hold a
    special token go through the tokenizer as a whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def open(cls, path: str) -> WordTokenizer:
        """One per Python worker, so that its words stay from task to task."""
        return keep_one((cls, path), lambda: cls(path))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x)}I", *x.ids) for x in found]

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "<|" in text:
            return self._encode([text])[0]
        words = _TEXT_WORD.findall(text)
        new = set(words).difference(self.words)
        if len(self.words) + len(new) > _CACHED_WORDS:
            # Words still in use come back from the older ones, the others go next time.
            self.words, self.older = {}, self.words
            new = set(words)
        known = [word for word in new if word in self.older]
        self.words.update((word, self.older.pop(word)) for word in known)
        new = list(new.difference(known))
        if new:
            self.words.update(zip(new, self._encode(new), strict=True))
        return b"".join(map(self.words.__getitem__, words))


def tokenized_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Cut every text into pieces of ``capacity`` ids; one row per piece.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored.  A text's ids
    are followed by ``end_id``, so a null or empty text is one piece of length 1.
    Only the last piece of a text may be shorter.  Repeated rows and null ids give
    pieces of their own.  ``with_ids`` adds the ids themselves.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer.open(tokenizer)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py() or "") + last
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    cells = [doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)]
                    if with_ids:
                        cells.append(np.frombuffer(own, "<u4").astype(np.int32))
                    for column, cell in zip(rows, cells, strict=True):
                        column.append(cell)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, types, strict=False)], names=names
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing over a histogram of lengths.

    Rows of the plan are (length, first rank, end rank, pieces per sequence, first
    sequence, offset): a run of pieces of one length that fills consecutive
    sequences alike.  Sequences with equal room are handled as one run, so the
    number of rows depends on the capacity, not on the number of pieces.
    """
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, how many)
    rooms: list[int] = []
    plan: list[tuple[int, ...]] = []
    sequences = 0

    def put(room: int, first: int, n: int) -> None:
        if room not in open_runs:
            open_runs[room] = []
            insort(rooms, room)
        open_runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room]
                    rooms.pop(at)
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            each = min(room // length, left)
            used = min(n, left // each)
            plan.append((length, rank, rank + used * each, each, first, capacity - room))
            if room > each * length:
                put(room - each * length, first, used)
            if used < n:
                put(room, first + used, n - used)
            rank += used * each
            left -= used * each
    return plan


def pack(pieces: DataFrame, *, capacity: int = 4096, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: where each piece lies among the sequences.

    ``pieces`` is a stored table with ``length`` from 1 to ``capacity``.  Pieces of
    a sequence lie one after the other without a gap from offset 0.  Pieces of
    equal length are interchangeable, so ties and repeated rows need no rule.
    An empty table gives an empty result.
    """
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan_schema = (
        "length bigint, _first bigint, _end bigint, _each bigint, _sequence bigint, _offset bigint"
    )
    plan_rows = best_fit_plan(counts, capacity)
    plan = pieces.sparkSession.createDataFrame(plan_rows, plan_schema)
    if len(plan_rows) <= BROADCAST_PLAN_ROWS:
        plan = F.broadcast(plan)
    ranked = rank_within(pieces, ["length"], order, sum(counts.values()), rank="_rank")
    slot = F.col("_rank") - F.col("_first")
    return (
        ranked.join(plan, "length")
        .filter("_rank >= _first AND _rank < _end")
        .withColumn("sequence_id", F.col("_sequence") + F.floor(slot / F.col("_each")))
        .withColumn("offset", F.col("_offset") + slot % F.col("_each") * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all texts with their places; see ``tokenized_pieces`` and ``pack``.

    The pieces are stored first: tokenizing is the costly part, and both the
    histogram and the slots must see the same pieces.
    """
    pieces = tokenized_pieces(docs, tokenizer, capacity=capacity, end_id=end_id)
    stored = Store(docs.sparkSession).save(pieces, "pieces")
    return pack(stored, capacity=capacity)
