"""The pipeline and its stages on small tables of awkward rows, against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from triptych.llm.queries import TOKENIZER
from triptych.llm.store import Store

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, _row string, _doc int, size int, p double"


def corpus():
    """Clean texts, copies, near copies, nulls, repeated rows, one very long text."""
    rng = random.Random(21)
    vocabulary = {
        lang: ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(300)]
        for lang, letters in (("en", "abcdefghimnorst"), ("xx", "ΑΒΓΔΕΖΗΘλμνξο"))
    }
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "xx"
        rows.append((i, " ".join(rng.choices(vocabulary[lang], k=rng.randint(1, 120))), lang, f"s{i % 4}"))
    base = rng.choices(vocabulary["en"], k=150)
    for i in range(120, 140):
        own = list(base)
        for _ in range(rng.randint(1, 3)):
            own[rng.randrange(150)] = "changed"
        rows.append((i, " ".join(own), "en", "s0"))
    rows += [(200 + i, rows[i][1], None, None) for i in range(15)]
    rows += [(300, None, None, None), (301, "", "en", "s1"), (302, "12 34 ..", "en", "s1"), (None, "a lonely text", "en", "s2")]
    rows += [(303, "the same row twice", "en", "s2")] * 2 + [(None, None, None, None)]
    rows.append((304, " ".join(rng.choices(vocabulary["en"], k=9000)), "en", "s3"))
    return rows


def table(spark, rows):
    full = [(i, t, lang, s, None if t is None else len(t), "clash", 1, 2, 0.5) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(4, "text")


def fields(df):
    assert df.columns == list(pipeline.COLUMNS)
    return Counter((r.doc_id, r.text) for r in df.collect())


def shingles(text):
    words = WORD.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def without_near_copies(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return Counter(rows[min(own, key=lambda i: (rows[i][0] is None, rows[i][0] or 0))] for own in groups.values())


def expected_stages(rows):
    rows = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    yield Counter(rows)
    best = {}
    for row in rows:
        if row[1] not in best or (row[0] is not None and (best[row[1]][0] is None or row[0] > best[row[1]][0])):
            best[row[1]] = row
    yield Counter(best.values())
    yield without_near_copies(list(best.values()))


def test_stages_equal_brute_force(spark):
    rows = corpus()
    docs = table(spark, rows)
    store = Store(spark)
    sources = {(i, t): s for i, t, _, s in rows}
    stages = dict(pipeline.STAGES)
    for (name, stage), expected in zip(pipeline.STAGES, expected_stages(rows), strict=False):
        docs = store.save(stage(spark, docs, ""), name)
        assert fields(docs) == expected, name
    mixed = store.save(stages["mixing"](spark, docs, ""), "mixing")
    taken = fields(mixed)
    assert taken.keys() <= expected.keys() and max(taken.values()) <= 2
    size = {row: len(WORD.findall(row[1])) for row in expected}
    whole, got = Counter(), Counter()
    for row in expected:
        whole[sources[row]] += size[row]
        got[sources[row]] += size[row] * taken[row]
    # The one very long text outweighs all others of its source: half of it can be missed.
    assert abs(sum(got.values()) / sum(whole.values()) - 1.5) < 0.3 * max(size.values()) / sum(whole.values())

    packed = stages["packing"](spark, mixed, "").collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokens = sum((len(tokenizer.encode(text, add_special_tokens=False).ids) + 1) * n for (_, text), n in taken.items())
    assert sum(r.length for r in packed) == tokens
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-tokens // 4096) + 1


@pytest.mark.parametrize("name", [name for name, _ in pipeline.STAGES])
def test_stages_take_an_empty_table(spark, name):
    empty = table(spark, corpus()).limit(0)
    assert dict(pipeline.STAGES)[name](spark, empty, "").collect() == []


def test_texts_stay_when_no_language_can_be_learned(spark):
    rows = [(i, t, None, s) for i, t, _, s in corpus()]
    kept = pipeline.identify_language(spark, table(spark, rows), "")
    assert fields(kept) == next(expected_stages(rows))


def test_two_runs_leave_each_other_alone(spark, tmp_path):
    """Results of one run can be read while, and after, another run goes through its stages."""
    for name, n in (("one", 90), ("two", 60)):
        table(spark, corpus()[:n]).select(*pipeline.COLUMNS).write.parquet(f"{tmp_path}/{name}/documents.parquet")
    first = pipeline.Run(spark, f"{tmp_path}/one")
    one = first.result()
    docs = spark.read.parquet(f"{tmp_path}/two/documents.parquet")
    lazy = pipeline.drop_copies(spark, docs, "")
    second = pipeline.Run(spark, f"{tmp_path}/two")
    two = second.result()
    assert lazy.count() == docs.select("text").distinct().count()
    again = pipeline.run(spark, f"{tmp_path}/one")
    key = ["doc_id", "piece", "length", "ids_crc32"]
    assert one.select(*key).exceptAll(again.select(*key)).isEmpty()
    second.drop()
    assert one.count() == again.count() > 0
    with pytest.raises(Exception):
        two.count()


def test_repeated_ids_and_rows_are_rows_of_their_own(spark):
    rows = [(1, "one two three", "en", "s")] * 3 + [(1, "another text", "en", "s"), (None, "one two three", "en", "s")]
    docs = table(spark, rows)
    assert fields(pipeline.drop_copies(spark, docs, "")) == {(1, "one two three"): 1, (1, "another text"): 1}
    near = pipeline.drop_near_copies(spark, docs, "")
    assert fields(near) == {(1, "one two three"): 1, (1, "another text"): 1}
    pieces = pipeline.pack_sequences(spark, docs, "")
    assert pieces.count() == 5 and pieces.select("sequence_id", "offset").distinct().count() == 5
    assert pieces.select(F.sum("length")).first()[0] > 5
