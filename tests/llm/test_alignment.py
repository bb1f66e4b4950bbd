"""Alignment of two tokenizers against a plain loop over all tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from triptych.llm import alignment

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string, pair string, block string, count int"


def texts():
    words = "straße naïve 北京 привет hello-world don't 12345 x=y; 😀 tokenization".split()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 40)))) for i in range(25)]
    rows += [(30, None), (31, ""), (32, " "), (33, "two  blanks\t\n\x00tab"), (34, "a▁b"), (None, "hello hello")]
    rows += [(35, "<|endoftext|> <s> <0x41> </s>"), (36, "same"), (36, "same"), (None, None), (37, "ﬁ ＡＢ é é")]
    rows.append((38, " ".join(rng.choice(words, 20_000))))
    rows.append((39, "x" * 30_000))
    return rows


def spans(pieces):
    at, out = 0, []
    for piece in pieces:
        out.append((at, at + len(piece)))
        at += len(piece)
    return out


def plain(rows):
    """The report by loops over tokens and bytes."""
    pair = alignment.TokenizerPair(A_PATH, B_PATH)
    letters = alignment.byte_letters()
    names = {i: x for x, i in pair.a.get_vocab().items()}
    docs, found_in = [], Counter()
    for doc_id, text in rows:
        wanted = (" " + (text or "")).encode()
        a = pair.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pair.b.encode(text or "")
        a_bytes = [bytes(letters[x] for x in names[i]) for i in a]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if pair.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, pair.b.id_to_piece(i)) for i in b)
        ]
        if not text or b"".join(a_bytes) != wanted or b"".join(b_bytes) != wanted:
            docs.append((doc_id, [], [], [], []))
            continue
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        links, start = [], 0
        for i, (low, high) in enumerate(a_spans):
            while b_spans[start][1] <= low:
                start += 1
            j = start
            while j < len(b) and b_spans[j][0] < high:
                links.append((i, j))
                j += 1
        ends = sorted({x for _, x in a_spans} & {x for _, x in b_spans})
        docs.append((doc_id, a, b, links, group_ids(ends, a, a_spans, b, b_spans)))
        found_in.update({(a[i], b[j]) for i, j in links})
    most = Counter()
    for (x, _), n in found_in.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, a, b, links, groups in docs:
        counts = [found_in[a[i], b[j]] for i, j in links]
        best = sum(n == most[a[i]] for n, (i, _) in zip(counts, links))
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        inside = sum(len(x) * len(y) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), inside, best, sum(counts), digest))
    return out


def group_ids(ends, a, a_spans, b, b_spans):
    groups = [([], []) for _ in ends]
    for side, ids, own in ((0, a, a_spans), (1, b, b_spans)):
        at = 0
        for i, (_, high) in zip(ids, own):
            groups[at][side].append(i)
            at += high == ends[at]
    return groups


def key(row):
    return tuple((x is None, x or 0) for x in row)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, "clash", "clash", 7) for row in texts()], DOCS).repartition(3)


@pytest.mark.parametrize("block_chars", [300, 4_000_000])
def test_report_equals_loops_over_tokens(docs, block_chars):
    found = alignment.alignment_report(docs, A_PATH, B_PATH, block_chars=block_chars)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == names
    actual = sorted(map(tuple, found.collect()), key=lambda r: key(r[:-1]) + (r[-1],))
    assert actual == sorted(plain(texts()), key=lambda r: key(r[:-1]) + (r[-1],))
    by_id = {row[0]: row for row in actual}
    assert by_id[31][1:] == (0,) * 7 + ("",) == by_id[30][1:]
    assert by_id[34][1] == 0  # a literal sign for the blank is not given back
    assert by_id[35][1] > 10  # strings of special tokens are plain text


def test_parts_give_the_ids_of_whole_texts(spark, monkeypatch):
    """Also with few words kept, and where a blank has something unusual beside it."""
    monkeypatch.setattr(alignment, "_KEPT_WORDS", 300)
    pair = alignment.TokenizerPair(A_PATH, B_PATH)
    assert pair.cuts_at_blanks
    odd = ["a  b", " a", "a ", "a \u0301b", "x\u00a0 y z", "“a” “b” c", "it 's don 't", "1 ２ ٣", "😀 😀", "a\n b", "▁ a b", "a \x1c b", "a \u200b b", "a b\x85 c"]
    real = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for texts in (odd, real[:60], odd + real[60:], odd):
        a, b = pair.encode(texts)
        for text, x, y in zip(texts, a, b):
            whole = [pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)]
            if len(x):
                assert [x.tolist(), y.tolist()] == whole
            else:
                tables = zip((pair.a_bytes, pair.b_bytes), whole)
                assert not text or any(b"".join(t[i] for i in ids) != (" " + text).encode() for t, ids in tables)


def test_long_documents_are_aligned_whole(docs):
    rows = {r.doc_id: r for r in alignment.alignment_report(docs, A_PATH, B_PATH).filter("doc_id >= 38").collect()}
    pair = alignment.TokenizerPair.open(A_PATH, B_PATH)
    assert rows[38].n_b == len(pair.b.encode(dict(texts()[-2:])[38]))
    assert rows[39].n_links == rows[39].n_a + rows[39].n_b - rows[39].n_groups


@pytest.mark.parametrize("within_groups", [False, True])
def test_links_as_rows_agree_with_the_report(docs, within_groups):
    some = docs.filter("doc_id < 36")
    links = alignment.aligned_links(some, A_PATH, B_PATH, within_groups=within_groups)
    report = alignment.alignment_report(some, A_PATH, B_PATH)
    counted = {r.doc_id: r["count"] for r in links.groupBy("doc_id").count().collect()}
    column = "n_group_links" if within_groups else "n_links"
    assert counted == {r.doc_id: r[column] for r in report.collect() if r[column]}
    pair = alignment.TokenizerPair.open(A_PATH, B_PATH)
    shared = {r.doc_id: r.w for r in links.selectExpr("doc_id", "weight").groupBy("doc_id").agg({"weight": "sum"}).toDF("doc_id", "w").collect()}
    if not within_groups:  # every byte is in one token of each
        sizes = {i: len((" " + t).encode()) for i, t in texts() if i in shared}
        assert shared == sizes
    row = links.filter("doc_id = 0").orderBy("a_place", "b_place").first()
    assert (row.a_place, row.b_place) == (0, 0)
    assert pair.a_bytes[row.a_id][:1] == pair.b_bytes[row.b_id][:1] == b" "


def test_products_of_sparse_rows_equal_dense_ones(monkeypatch):
    rng = np.random.default_rng(1)

    def sparse(dense):
        starts = np.concatenate([[0], np.cumsum((dense != 0).sum(axis=1))])
        row, column = np.nonzero(dense)
        return alignment.Rows(starts, column, dense.shape[1], dense[row, column])

    left, right = rng.integers(0, 3, (13, 9)), rng.integers(0, 3, (9, 17))
    left[4], right[2] = 0, 0
    for terms in (5, 1 << 22):
        monkeypatch.setattr(alignment, "_PRODUCT_TERMS", terms)
        dense = np.zeros((13, 17), int)
        for first, rows in alignment.product(sparse(left), sparse(right)):
            dense[first + rows.row_of_entries(), rows.columns] += rows.values
        assert (dense == left @ right).all()
    back = sparse(left).transposed()
    dense = np.zeros((9, 13), int)
    dense[back.row_of_entries(), back.columns] = back.values
    assert (dense == left.T).all()


def test_empty_table(docs):
    assert alignment.alignment_report(docs.limit(0), A_PATH, B_PATH).collect() == []
    assert alignment.aligned_links(docs.limit(0), A_PATH, B_PATH).collect() == []
