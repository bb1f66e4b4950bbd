"""Collocations against counting every phrase in a dictionary."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from triptych.llm import collocations as c

DOCS = "doc_id bigint, text string, lang string, words string, a int, n int, id int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("aeiorstÜß京", k=rng.randint(1, 5))) for _ in range(60)]
    rows = []
    for i in range(160):
        words = rng.choices(vocabulary, weights=[1 / (j + 1) for j in range(60)], k=rng.randint(0, 60))
        if i % 3 == 0:
            at = rng.randint(0, len(words))
            words[at:at] = "New York City Council meeting".split()
        if i % 4 == 0:
            words += ["no", "no", "no", "no"]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", ":\x0b"]) for w in words)
        rows.append((i, text, rng.choice(["en", "de", None, "und"])))
    rows += [(200, None, "en"), (201, "", "en"), (202, " \t ,.;", "fr"), (None, "new york city", "en")]
    rows += [(203, "york city council", "en")] * 3 + [(204, "Ünï new york " * 4000, "de")]
    return rows


def plain(rows, min_count, max_words=5, per_language=2000, share=100, scale=1000):
    f, sizes = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    rows_of = {}
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= share * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((scale * a * sizes[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows_of.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, found in rows_of.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:per_language], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, "clash", 1, 2, 3) for row in texts()], DOCS).repartition(3)


@pytest.mark.parametrize(
    "options",
    [
        {"min_count": 5, "block_words": 500},
        {"min_count": 20, "max_words": 3, "absorbed_at": 60},
        {"min_count": 3, "per_language": 7, "max_words": 2},
    ],
)
def test_collocations_equal_counting_all_phrases(docs, options):
    found = c.collocations(docs, **options)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found.columns == names
    assert {kind for name, kind in found.dtypes if name not in ("lang", "phrase")} == {"bigint"}
    expected = plain(texts(), options["min_count"], options.get("max_words", 5), options.get("per_language", 2000), options.get("absorbed_at", 100))
    assert sorted(map(tuple, found.collect())) == expected
    assert expected


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame(
        [(10**13, 10**14, [10**13, 10**14], [10**14, 10**13 + 1])],
        "a bigint, n bigint, firsts array<bigint>, rests array<bigint>",
    ).select(c._weakest_cut(1000).alias("c")).first().c
    scores = [1000 * 10**13 * 10**14 // (10**13 * 10**14), 1000 * 10**13 * 10**14 // (10**14 * (10**13 + 1))]
    assert (row.score, row.place) == min((s, i) for i, s in enumerate(scores))


@pytest.mark.parametrize("tile", [1, 4, 64])
def test_tiles_count_all_pairs(tile):
    rng = np.random.default_rng(4)
    left, right = np.minimum(rng.geometric(0.05, (2, 5000)), 150)
    a, b, n = c.count_pairs(left, right, 151, tile)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == Counter(zip(left.tolist(), right.tolist()))
    assert len(a) == len(set(zip(a.tolist(), b.tolist())))


def test_nothing_frequent_and_empty_table(docs):
    assert c.collocations(docs, min_count=10**6).collect() == []
    assert c.collocations(docs.limit(0)).collect() == []
