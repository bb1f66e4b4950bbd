"""Alignment of two tokenizers over the same bytes, by sparse matrix products.

A tokenizer's incidence matrix has a row per token and a column per byte of the
text.  The product of one with the other's transpose has an entry wherever two
tokens share bytes: the overlap links, each with the number of shared bytes.  Bytes
between places where tokens of both end are a group; the product of the incidence
matrices of tokens and groups links all tokens of a group.  The matrices are in
compressed rows, multiplied row by row (Gustavson), with arrays built here.

How many documents link two ids is counted over the corpus.  A join of every link
with these counts would move the corpus several times, so blocks of whole documents
ask once for each distinct pair of their own.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.llm.katz import packed, unpacked
from triptych.llm.store import Store
from triptych.llm.words import keep_one

_META_SPACE = "▁"
#: A blank between printable ASCII or letters and digits, and a text that such can enclose.
_BORDER = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
_IS_WORD = re.compile(r"[\w!-~](\S*[\w!-~])?\Z")
_KEPT_WORDS = 200_000
_SLICE_BYTES = 1 << 19
_PRODUCT_TERMS = 1 << 22
_ANSWERS_TOGETHER = 200_000


# --- sparse matrices --------------------------------------------------------------


@dataclass(frozen=True)
class Rows:
    """A matrix in compressed rows: the columns of row i are ``columns[starts[i]:starts[i + 1]]``.

    Without ``values`` all entries are 1.
    """

    starts: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        counts = np.bincount(self.columns, minlength=self.width)
        values = None if self.values is None else self.values[order]
        return Rows(np.concatenate([[0], np.cumsum(counts)]), self.row_of_entries()[order], self.height, values)


def byte_incidence(lengths: np.ndarray) -> Rows:
    """Tokens by bytes: tokens of these lengths, one after the other."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    return Rows(starts, np.arange(starts[-1]), int(starts[-1]))


def group_incidence(group: np.ndarray, groups: int) -> Rows:
    """Tokens by groups: every token is in one."""
    return Rows(np.arange(len(group) + 1), group, groups)


def product_sizes(left: Rows, right: Rows) -> np.ndarray:
    """Terms of each row of ``left @ right``, before equal columns are added up."""
    terms = np.concatenate([[0], np.cumsum(np.diff(right.starts)[left.columns])])
    return np.diff(terms[left.starts])


def product(left: Rows, right: Rows) -> Iterator[tuple[int, Rows]]:
    """(first row, rows) of ``left @ right`` in turn, by Gustavson's row products.

    A row of the product is the sum of the rows of ``right`` that its entries select.
    Rows come in runs of about four million terms, so memory is bounded unless one
    row alone has more.
    """
    edges = np.concatenate([[0], np.cumsum(product_sizes(left, right))])
    first = 0
    while first < left.height:
        end = int(np.searchsorted(edges, edges[first] + _PRODUCT_TERMS, "right")) - 1
        end = min(max(end, first + 1), left.height)
        entries = slice(left.starts[first], left.starts[end])
        chosen = left.columns[entries]
        sizes = right.starts[chosen + 1] - right.starts[chosen]
        at = np.repeat(right.starts[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        row = np.repeat(np.repeat(np.arange(end - first), np.diff(left.starts[first : end + 1])), sizes)
        key = row * right.width + right.columns[at]
        term = np.ones(len(key), np.int64) if right.values is None else right.values[at]
        if left.values is not None:
            term = term * np.repeat(left.values[entries], sizes)
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, term = key[order], term[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        values = np.add.reduceat(term, heads) if len(heads) else term
        row, column = key[heads] // right.width, key[heads] % right.width
        starts = np.searchsorted(row, np.arange(end - first + 1))
        yield first, Rows(starts, column, right.width, values)
        first = end


# --- the two tokenizers -----------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


class TokenizerPair:
    """A byte-level tokenizer A and a piece tokenizer B with the bytes of all their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        entries = self.a.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(letters[x] for x in entry) if all(x in letters for x in entry) else entry.encode()
        self.b_bytes = [self._piece_bytes(i) for i in range(self.b.get_piece_size())]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << 16:
            raise ValueError("ids above 65,535 do not fit a packed pair")
        # A's pattern never joins a blank to what stands before it; B's pieces might.
        pieces = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.cuts_at_blanks = not any(_META_SPACE in piece.lstrip(_META_SPACE) for piece in pieces)
        self.a_of: dict[str, bytes] = {}
        self.b_of: dict[str, bytes] = {}
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.differing: set[str] = set()

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(_META_SPACE, " ").encode()

    @classmethod
    def open(cls, a_path: str, b_path: str) -> TokenizerPair:
        """One per Python worker."""
        return keep_one((cls, a_path, b_path), lambda: cls(a_path, b_path))

    @cached_property
    def a_lengths(self) -> np.ndarray:
        return np.array([len(x) for x in self.a_bytes])

    @cached_property
    def b_lengths(self) -> np.ndarray:
        return np.array([len(x) for x in self.b_bytes])

    @cached_property
    def texts(self) -> np.ndarray:
        """Decimal ids with what may follow them: A then ',' or '|', B then ',' or ';'."""
        a, b = range(len(self.a_bytes)), range(len(self.b_bytes))
        followed = [f"{i},".encode() for i in a] + [f"{i}|".encode() for i in a]
        followed += [f"{i},".encode() for i in b] + [f"{i};".encode() for i in b]
        return np.array(followed, object)

    def _encode_parts(self, parts: list[str]) -> None:
        """Learn the ids of parts; each stands for a blank and its text."""
        found = self.a.encode_batch_fast([f" {part}" for part in parts], add_special_tokens=False)
        wanted = [f" {part}".encode() for part in parts]
        for ids, of, table, lengths in (
            ([x.ids for x in found], self.a_of, self.a_bytes, self.a_lengths),
            (self.b.encode(parts, num_threads=1), self.b_of, self.b_bytes, self.b_lengths),
        ):
            every = list(chain.from_iterable(ids))
            ends = np.cumsum([len(x) for x in ids])
            flat = np.array(every, "<u2")
            data, edges = flat.tobytes(), [0, *(2 * ends).tolist()]
            of.update((part, data[x:y]) for part, x, y in zip(parts, edges[:-1], edges[1:], strict=True))
            # All parts at once: the same bytes, and as many in each part.
            sums = np.concatenate([[0], np.cumsum(lengths[flat])])[ends]
            as_long = np.array_equal(sums, np.cumsum([len(x) for x in wanted]))
            if not (as_long and b"".join(map(table.__getitem__, every)) == b"".join(wanted)):
                self.differing.update(
                    part
                    for part, x, own in zip(parts, ids, wanted, strict=True)
                    if b"".join(map(table.__getitem__, x)) != own
                )

    def _parts(self, text: str) -> list[str]:
        """``text`` cut at blanks that no token crosses; parts that are not known yet may be new."""
        if not self.cuts_at_blanks:
            return [text]
        parts = text.split(" ")
        new = set(parts).difference(self.a_of)
        return parts if all(map(_IS_WORD.match, new)) else _BORDER.split(text)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A's and B's ids of every text; none where joined bytes differ from blank and text.

        Neither tokenizer joins what stands on both sides of a blank between two
        printable characters, so the ids of a text are those of its parts in turn.  The
        ids of recent words are kept.
        """
        if len(self.a_of) > _KEPT_WORDS:
            # Words still in use come back from the older ones, the others go next time.
            self.older, self.a_of, self.b_of = (self.a_of, self.b_of), {}, {}
            self.differing &= self.older[0].keys()
        parts = [self._parts(text) for text in texts]
        new = set().union(*parts).difference(self.a_of)
        known = [part for part in new if part in self.older[0] and part not in self.differing]
        self.a_of.update((part, self.older[0][part]) for part in known)
        self.b_of.update((part, self.older[1][part]) for part in known)
        new = list(new.difference(known))
        if new:
            self._encode_parts(new)
        ids = []
        for of in (self.a_of, self.b_of):
            ids.append([np.frombuffer(b"".join(map(of.__getitem__, own)), "<u2").astype(np.int64) for own in parts])
        for i, (text, own) in enumerate(zip(texts, parts, strict=True)):
            if not text or not (self.differing.isdisjoint(own) or self._is_rebuilt(text, ids[0][i], ids[1][i])):
                ids[0][i] = ids[1][i] = np.zeros(0, np.int64)
        # Only words are kept: other parts may depend on what stands beside them.
        for part in new:
            if not _IS_WORD.match(part):
                del self.a_of[part], self.b_of[part]
                self.differing.discard(part)
        return ids[0], ids[1]

    def _is_rebuilt(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        data = f" {text}".encode()
        return all(
            b"".join(map(table.__getitem__, ids.tolist())) == data
            for table, ids in ((self.a_bytes, a), (self.b_bytes, b))
        )


@dataclass
class Alignment:
    """Tokens of several documents on one line of bytes; a document's end is a common end."""

    a: np.ndarray
    b: np.ndarray
    a_counts: np.ndarray
    b_counts: np.ndarray
    pair: TokenizerPair

    @classmethod
    def of(cls, texts: list[str], pair: TokenizerPair) -> Alignment:
        a, b = pair.encode(texts)
        counts = [np.array([len(x) for x in ids], np.int64) for ids in (a, b)]
        return cls(np.concatenate(a), np.concatenate(b), *counts, pair)

    @cached_property
    def a_bytes(self) -> Rows:
        return byte_incidence(self.pair.a_lengths[self.a])

    @cached_property
    def b_bytes(self) -> Rows:
        return byte_incidence(self.pair.b_lengths[self.b])

    @cached_property
    def common_ends(self) -> np.ndarray:
        return np.intersect1d(self.a_bytes.starts[1:], self.b_bytes.starts[1:], assume_unique=True)

    @cached_property
    def a_groups(self) -> Rows:
        return group_incidence(np.searchsorted(self.common_ends, self.a_bytes.starts[1:]), len(self.common_ends))

    @cached_property
    def b_groups(self) -> Rows:
        return group_incidence(np.searchsorted(self.common_ends, self.b_bytes.starts[1:]), len(self.common_ends))

    @cached_property
    def a_owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.a_counts)), self.a_counts)

    @cached_property
    def group_owner(self) -> np.ndarray:
        owner = np.zeros(len(self.common_ends), np.int64)
        owner[self.a_groups.columns] = self.a_owner
        return owner

    def overlap_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places of A tokens, of B tokens, shared bytes) of all overlapping tokens."""
        for first, rows in product(self.a_bytes, self.b_bytes.transposed()):
            yield first + rows.row_of_entries(), rows.columns, rows.values

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places of A tokens, of B tokens, 1) of all tokens that share a group."""
        for first, rows in product(self.a_groups, self.b_groups.transposed()):
            yield first + rows.row_of_entries(), rows.columns, rows.values

    def group_link_counts(self) -> np.ndarray:
        """How many links ``group_links`` has per document, without listing them."""
        sizes = product_sizes(self.a_groups, self.b_groups.transposed())
        return np.bincount(self.a_owner, sizes, len(self.a_counts)).astype(np.int64)

    def groups_as_text(self) -> list[bytes]:
        """Per document ``a1,a2|b1;a3|b2,b3``: the ids of every group in order."""
        n_a, n_b = len(self.pair.a_bytes), len(self.pair.b_bytes)

        def last_in_group(groups: Rows) -> np.ndarray:
            return np.diff(groups.columns, append=-1) != 0

        index = np.concatenate(
            [
                self.a + n_a * last_in_group(self.a_groups),
                2 * n_a + self.b + n_b * last_in_group(self.b_groups),
            ]
        )
        group = np.concatenate([self.a_groups.columns, self.b_groups.columns])
        order = np.argsort(group, kind="stable")  # A's tokens come first, each in its order
        parts = self.pair.texts[index[order]].tolist()
        edges = np.concatenate([[0], np.cumsum(self.a_counts + self.b_counts)])
        return [b"".join(parts[i:j])[:-1] for i, j in zip(edges[:-1], edges[1:], strict=True)]


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about half a million characters; null is empty."""
    first, own, held = 0, [], 0
    for i, text in enumerate(texts):
        value = text.as_py() or ""
        if own and held + len(value) > _SLICE_BYTES:
            yield first, own
            first, own, held = i, [], 0
        own.append(value)
        held += len(value)
    if own:
        yield first, own


# --- links as rows ----------------------------------------------------------------


def aligned_links(docs: DataFrame, a_path: str, b_path: str, *, within_groups: bool = False) -> DataFrame:
    """One row per link: doc_id, a_place, b_place (from 0 in the document), a_id, b_id, weight.

    The weight is the number of shared bytes; with ``within_groups`` links join all
    tokens of a group instead and weigh 1, whose number is the product of both sides
    of a group.  ``docs`` has doc_id and text.  A text that is null, empty, or not
    rebuilt by both tokenizers has no links; repeated rows have links of their own.
    """
    names = ["doc_id", "a_place", "b_place", "a_id", "b_id", "weight"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = TokenizerPair.open(a_path, b_path)
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                found = Alignment.of(texts, pair)
                a_starts, b_starts = (np.cumsum(n) - n for n in (found.a_counts, found.b_counts))
                links = found.group_links() if within_groups else found.overlap_links()
                for a, b, weight in links:
                    owner = found.a_owner[a]
                    columns = [batch.column(0).take(pa.array(first + owner))]
                    columns += [pa.array(x) for x in (a - a_starts[owner], b - b_starts[owner])]
                    columns += [pa.array(x) for x in (found.a[a], found.b[b], weight)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(build, ", ".join(f"{name} bigint" for name in names))


# --- counts of linked ids ---------------------------------------------------------

_BLOCK_COLUMNS = {
    "block": pa.int64(),
    "doc_ids": pa.list_(pa.int64()),
    "digests": pa.list_(pa.string()),
    "numbers": pa.binary(),
    "pairs": pa.binary(),
    "found_in": pa.binary(),
    "distinct": pa.binary(),
    "entries": pa.binary(),
}
_BLOCK_SCHEMA = (
    "block bigint, doc_ids array<bigint>, digests array<string>, numbers binary,"
    " pairs binary, found_in binary, distinct binary, entries binary"
)
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def _blocks(rows: DataFrame, a_path: str, b_path: str, block_chars: int) -> DataFrame:
    """Blocks of whole documents with a matrix of documents by linked id pairs.

    ``pairs`` are the block's distinct pairs (A's id times 65,536 plus B's), in
    order, and ``found_in`` how many of its documents have each.  ``entries`` are the
    matrix's columns (each row's first, then the steps to the next) and its values,
    the links of a pair in a document; ``distinct`` the entries per document.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = TokenizerPair.open(a_path, b_path)
        number = TaskContext.get().partitionId() << 32

        def flush(parts: list[tuple]) -> pa.RecordBatch:
            ids, digests, numbers, distinct, keys, times = zip(*parts, strict=True)
            pairs, column, found_in = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            distinct = np.concatenate(distinct)
            heads = (np.cumsum(distinct) - distinct)[distinct > 0]
            steps = np.diff(column, prepend=0)
            steps[heads] = column[heads]
            cells = [
                number,
                pa.concat_arrays(ids).to_pylist(),
                [x for part in digests for x in part],
                packed(*np.concatenate(numbers, axis=1)),
                packed(np.diff(pairs, prepend=0)),
                packed(found_in),
                packed(distinct),
                packed(steps, np.concatenate(times)),
            ]
            columns = [pa.array([x], kind) for x, kind in zip(cells, _BLOCK_COLUMNS.values(), strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=list(_BLOCK_COLUMNS))

        parts, held = [], 0
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                found = Alignment.of(texts, pair)
                n = len(texts)
                links = [
                    (found.a_owner[a] << 32) | (found.a[a] << 16) | found.b[b] for a, b, _ in found.overlap_links()
                ]
                links = np.concatenate(links) if links else np.zeros(0, np.int64)
                entry, times = np.unique(links, return_counts=True)
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in found.groups_as_text()]
                numbers = [
                    found.a_counts,
                    found.b_counts,
                    np.bincount(found.group_owner, minlength=n),
                    np.bincount(links >> 32, minlength=n),
                    found.group_link_counts(),
                ]
                ids = batch.column(0).slice(first, n)
                distinct = np.bincount(entry >> 32, minlength=n)
                parts.append((ids, digests, np.stack(numbers), distinct, entry & 0xFFFFFFFF, times))
                held += sum(map(len, texts))
                if held >= block_chars:
                    yield flush(parts)
                    parts, held, number = [], 0, number + 1
        if parts:
            yield flush(parts)

    return rows.mapInArrow(build, _BLOCK_SCHEMA)


def _ordered(steps: bytes) -> np.ndarray:
    return np.cumsum(unpacked(steps, 1)[0].astype(np.int64))


def _asked(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): how many documents of a block have a pair, for all its pairs."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, found_in in zip(*batch.columns, strict=True):
                pairs = _ordered(pairs.as_py())
                n = unpacked(found_in.as_py(), 1)[0].astype(np.int64)
                columns = [np.full(len(pairs), block.as_py()), pairs, n]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["block", "pair", "n"])

    return blocks.select("block", "pairs", "found_in").mapInArrow(unfold, "block bigint, pair bigint, n bigint")


def pair_counts(asked: DataFrame) -> DataFrame:
    """(pair, count, best): documents with each pair, and if no pair of its A id has more.

    There are no more rows per A id than B has ids, and no more A ids than A has.
    """
    counted = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    a_id = F.shiftright("pair", 16)
    most = counted.groupBy(a_id.alias("a_id")).agg(F.max("count").alias("most"))
    return counted.join(most, a_id == F.col("a_id")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _gathered(answers: DataFrame) -> DataFrame:
    """The answers of a task as one row per block, packed."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            block, pair, answer = np.concatenate(held, axis=1)
            order = np.lexsort((pair, block))
            block, pair, answer = block[order], pair[order], answer[order]
            edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
            data = [
                packed(np.diff(pair[i:j], prepend=0), answer[i:j]) for i, j in zip(edges[:-1], edges[1:], strict=True)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(block[edges[:-1]]), pa.array(data, pa.binary())], names=["block", "data"]
            )

        rows = 0
        for batch in batches:
            held.append(np.stack([column.to_numpy() for column in batch.columns]))
            rows += batch.num_rows
            if rows >= _ANSWERS_TOGETHER:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()

    packed_answer = (F.col("count") * 2 + F.col("best").cast("bigint")).alias("answer")
    parts = answers.select("block", "pair", packed_answer).mapInArrow(gather, "block bigint, data binary")
    return parts.groupBy("block").agg(F.collect_list("data").alias("answers"))


def _judged(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per document: its numbers, and its links weighed by the corpus's counts."""
    names = ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, digests, numbers, distinct, entries, parts in zip(*batch.columns, strict=True):
                steps, times = unpacked(entries.as_py(), 2).astype(np.int64)
                distinct = unpacked(distinct.as_py(), 1)[0].astype(np.int64)
                n = len(distinct)
                n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
                if len(steps):
                    # Parts are sorted runs of the block's pairs; in order their answers match its columns.
                    pair, answer = zip(*(unpacked(x.as_py(), 2).astype(np.int64) for x in parts.values), strict=True)
                    pair = np.concatenate([np.cumsum(x) for x in pair])
                    answer = np.concatenate(answer)[np.argsort(pair, kind="stable")]
                    edges = np.concatenate([[0], np.cumsum(distinct)])
                    filled = np.flatnonzero(distinct)
                    # Undo the steps: each document starts anew.
                    total = np.cumsum(steps)
                    before = np.concatenate([[0], total])[edges[filled]]
                    column = total - np.repeat(before, distinct[filled])
                    count_sum[filled] = np.add.reduceat(times * (answer[column] >> 1), edges[filled])
                    n_best[filled] = np.add.reduceat(times * (answer[column] & 1), edges[filled])
                columns = [ids.values, *(pa.array(x.astype(np.int64)) for x in unpacked(numbers.as_py(), len(_NUMBERS)))]
                columns += [pa.array(n_best), pa.array(count_sum), digests.values]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = blocks.join(answers, "block", "left").select(
        "doc_ids", "digests", "numbers", "distinct", "entries", "answers"
    )
    longs = ", ".join(f"{name} bigint" for name in names[:-1])
    return joined.mapInArrow(judge, f"{longs}, groups_sha256 string")


def alignment_report(docs: DataFrame, a_path: str, b_path: str, *, block_chars: int = 4_000_000) -> DataFrame:
    """How the tokens of both tokenizers align in each text of ``docs`` (doc_id, text).

    Tokenizer A reads a blank and the text, B the text, to which it adds the blank.
    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (overlaps), n_group_links
    (pairs within groups), n_best (links whose id pair is in as many documents of the
    corpus as any pair of its A id), count_sum (those numbers over all links) and
    groups_sha256 of the groups' ids.

    A text that is null, empty, or that either tokenizer does not give back byte by
    byte counts as without tokens: zeros and an empty digest.  Repeated rows are
    documents of their own, also for the counts; null ids stay null.  An empty table
    gives an empty result; other columns are ignored.  Texts are never cut.
    """
    store = Store(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = store.save(_blocks(rows, a_path, b_path, block_chars), "blocks")
    asked = store.save(_asked(blocks), "asked")
    counts = store.save(pair_counts(asked), "counts")
    store.release()
    answers = _gathered(asked.join(counts, "pair"))
    needed = blocks.select("block", "doc_ids", "digests", "numbers", "distinct", "entries")
    return _judged(needed, answers)
