"""Every operator against a brute-force version, on small tables of awkward rows."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from triptych.llm import chat, dedup, katz, language, mixing, near, neighbours, packing, sharding, urls
from triptych.llm.queries import TOKENIZER, URL_RULES
from triptych.llm.store import Store, chosen_rows, other_rows, with_numbers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(urls.UPPER, urls.LOWER)
DOCS = "doc_id bigint, text string, lang string, source string, _row string, n string, rank int, length int"


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def corpus():
    """Ids, texts, languages and sources: copies, near copies, nulls, repeated rows, a long text."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeimnrst", k=rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 90))), "en", f"s{i % 3}"))
    base = rng.choices(vocabulary, k=80)
    for i in range(60, 90):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(80)] = rng.choice(vocabulary)
        rows.append((i, " ".join(own), "de", "s0"))
    rows += [(90 + i, rows[i][1], None, None) for i in range(12)]
    rows += [(110, None, None, None), (111, "", "en", "s1"), (112, " \t\n", None, "s1"), (None, "x Y z", "en", None)]
    rows += [(113, "Ünï 123 $$$", "fr", "s2"), (113, "Ünï 123 $$$", "fr", "s2"), (None, None, None, None)]
    rows.append((114, " ".join(rng.choices(vocabulary, k=6000)), "en", "s2"))
    rows.append((115, "1234 $$ 99", "en", "s2"))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    table = spark.createDataFrame([(*row, "clash", None, 1, 2) for row in rows], DOCS)
    return table.repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def fields(df, *names):
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)


# --- packing ------------------------------------------------------------------------


def test_plan_fills_sequences_without_gaps_or_overlap():
    rng = random.Random(1)
    counts = Counter(rng.randint(1, 64) for _ in range(3000))
    slots, ranks = defaultdict(list), defaultdict(list)
    for length, first, end, each, sequence, offset in packing.best_fit_plan(counts, 64):
        ranks[length] += range(first, end)
        for k in range(end - first):
            slots[sequence + k // each].append((offset + k % each * length, length))
    assert {length: sorted(r) for length, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for placed in slots.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    rooms = []  # best-fit decreasing, piece by piece
    for length in sorted(counts.elements(), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        best = min(fitting, key=rooms.__getitem__, default=len(rooms))
        rooms[best:] = [rooms[best] - length, *rooms[best + 1 :]] if fitting else [64 - length]
    assert len(slots) == len(rooms)


def test_pieces_have_the_tokenizers_ids(docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = []
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            own = np.array(ids[at : at + 64], "<u4")
            expected.append((doc_id, piece, at, len(own), zlib.crc32(own.tobytes())))
    packed = packing.pack_documents(docs, TOKENIZER, capacity=64)
    assert fields(packed, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(expected, key=repr)
    by_sequence = defaultdict(list)
    for row in packed.collect():
        by_sequence[row.sequence_id].append((row.offset, row.length))
    for placed in by_sequence.values():
        placed.sort()
        assert [o for o, _ in placed] == list(np.cumsum([0] + [n for _, n in placed])[:-1])
        assert sum(n for _, n in placed) <= 64


def test_words_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(TOKENIZER), packing.WordTokenizer(TOKENIZER)
    rng = random.Random(3)
    alphabet = "aZé'sß1\x1c\x85\u2003\u3000\u0301İΣ<|>-_ \n\t.終"
    texts = ["".join(rng.choices(alphabet, k=40)) for _ in range(300)]
    for text in [*texts, "a <|endoftext|> b", "it's we'll", ""]:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == expected


# --- language model -------------------------------------------------------------------


def discounts_by_hand(n):
    """Good-Turing factors from counts of counts, where all of some k lie between 0 and 1."""
    for k in range(5, 1, -1):
        if all(n[r] for r in range(1, k + 2)):
            m = (k + 1) * n[k + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / n[r] / r - m) / (1 - m) for r in range(1, k + 1)} if m < 1 else {}
            if d and all(0 < x < 1 for x in d.values()):
                return d
    return None


@pytest.mark.parametrize(("order", "block_tokens"), [(2, 40), (2, 500_000), (3, 40), (3, 500_000), (4, 300)])
def test_katz_scores_equal_a_direct_recursion(spark, docs, rows, order, block_tokens):
    held = {i: i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows}
    counts = defaultdict(Counter)  # length -> n-gram -> count
    for doc_id, text, *_ in rows:
        if not held[doc_id]:
            tokens = ["<s>", *words_of(text), None]
            counts[1].update((w,) for w in tokens[1:])
            for n in range(2, order + 1):
                counts[n].update(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))
    total = sum(counts[1].values())
    contexts = Counter()
    for n in range(2, order + 1):
        for gram, c in counts[n].items():
            contexts[gram[:-1]] += c
    d = {}
    for n in counts:
        rare = Counter(counts[n].values())
        by_hand = discounts_by_hand(rare)
        from_code = katz.Discounts.good_turing([rare[r] for r in range(1, 7)])
        d[n] = lambda c, factors=from_code: float(factors(np.array([c]))[0])
        if by_hand:
            assert {r: d[n](r) for r in by_hand} == pytest.approx(by_hand)
    # What discounting takes from the words is the unknown word's, and all sums to one.
    left = sum((1 - d[1](c)) * c for c in counts[1].values()) / total
    assert left > 0

    def p1(word):
        c = counts[1][(word,)]
        return d[1](c) * c / total if c else left

    assert sum(p1(w) for (w,) in counts[1]) + left == pytest.approx(1)
    followers = defaultdict(list)
    for n in range(2, order + 1):
        for gram, c in counts[n].items():
            followers[gram[:-1]].append((gram[-1], c))
    weights = {}

    def p(word, context):
        if not context:
            return p1(word)
        if context not in followers:
            return p(word, context[1:])
        n, all_of = len(context) + 1, contexts[context]
        taken = sum((1 - d[n](c)) * c for _, c in followers[context])
        aside = taken <= 0
        c = counts[n][(*context, word)]
        if c:
            return (1 if not aside else all_of / (all_of + 1)) * d[n](c) * c / all_of
        if context not in weights:
            share = taken / all_of if not aside else 1 / (all_of + 1)
            weights[context] = share / (1 - sum(p(w, context[1:]) for w, _ in followers[context]))
        return weights[context] * p(word, context[1:])

    for context in random.Random(3).sample(sorted(followers, key=repr), 25):
        seen = [w for (w,) in counts[1]]
        assert sum(p(w, context) for w in seen) + p("never seen", context) == pytest.approx(1)

    expected = Counter()
    for doc_id, text, *_ in rows:
        tokens = [*words_of(text), None]
        base = sum(math.log10((counts[1][(w,)] + 0.1) / (total + 0.1 * (len(counts[1]) + 1))) for w in tokens)
        padded = ("<s>", *tokens)
        score = sum(math.log10(p(w, padded[max(i + 2 - order, 0) : i + 1])) for i, w in enumerate(tokens))
        known = sum(counts[1][(w,)] > 0 for w in tokens)
        expected[doc_id, held[doc_id], len(tokens), known, total, round(base, 6), round(score, 6)] += 1
    found = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
        for r in katz.score_documents(docs, order=order, block_tokens=block_tokens).collect()
    )
    assert found == expected


def test_hot_contexts_are_spread_over_buckets():
    """A context of many words has as many buckets as its count demands, a rare one has one."""
    buckets = katz.Buckets(50, 100)
    words = np.array([[7] * 900 + [8] * 90, [*range(900), *range(90)]], np.uint64)
    shares = 1 + np.array([900] * 900 + [90] * 90) // 100
    found = buckets.of(words, shares)
    assert 5 <= len(set(found[:900].tolist())) <= 10 and len(set(found[900:].tolist())) == 1


def test_discounts_without_enough_counts_stay_between_0_and_1():
    for counts in ([0] * 6, [3, 0, 0, 0, 0, 0], [1, 9, 9, 9, 9, 99], [50, 20, 10, 5, 3, 2]):
        factors = katz.Discounts.good_turing(counts).factors[1:]
        assert ((factors > 0) & (factors < 1)).all()


def test_discounts_stay_good_turings_where_copies_lift_a_count():
    # Counts of counts of the pairs of sf0.1: with k = 5 the factor of 4 would be 1.08.
    n = [1653178, 262539, 56436, 23327, 20064, 8191]
    m = 4 * n[3] / n[0]
    expected = [((r + 1) * n[r] / n[r - 1] / r - m) / (1 - m) for r in (1, 2, 3)]
    discounts = katz.Discounts.good_turing(n)
    assert discounts(np.arange(1, 8)) == pytest.approx([*expected, 1, 1, 1, 1])
    assert [round(d, 2) for d in expected] == [0.28, 0.28, 0.52]
    # All five are valid: k stays 5.
    n = [5000, 1600, 760, 440, 280, 190]
    m = 6 * n[5] / n[0]
    expected = [((r + 1) * n[r] / n[r - 1] / r - m) / (1 - m) for r in range(1, 6)]
    assert katz.Discounts.good_turing(n)(np.arange(1, 7)) == pytest.approx([*expected, 1])
    # No k is valid: (r + 1)* / r of the line through the logarithms.
    n = [100, 20, 30, 10, 0, 5]
    x, y = [math.log(r) for r in (1, 2, 3, 4, 6)], [math.log(c) for c in n if c]
    slope = sum((a - sum(x) / 5) * b for a, b in zip(x, y, strict=True)) / sum((a - sum(x) / 5) ** 2 for a in x)
    m = 6 ** (slope + 1)
    expected = [((1 + 1 / r) ** (slope + 1) - m) / (1 - m) for r in range(1, 6)]
    assert all(0 < d < 1 for d in expected)
    assert katz.Discounts.good_turing(n)(np.arange(1, 7)) == pytest.approx([*expected, 1])


# --- exact dedup ----------------------------------------------------------------------


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            out.append((i, max(known) if known else None, len(ids)))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("digest", [dedup.sha256, lambda text: F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 1))])
def test_dedup_also_with_colliding_digests(docs, rows, digest):
    expected, groups = expected_groups(rows)
    report = dedup.dedup_report(docs, digest=digest, batches=2).cache()
    assert fields(report, "doc_id", "keep_id", "group_size") == expected
    assert report.filter("kept").count() == groups
    assert report.filter("kept and not (doc_id <=> keep_id)").count() == 0
    kept = dedup.distinct_documents(docs, digest=digest)
    assert kept.columns == docs.columns and kept.count() == groups
    assert kept.select(F.coalesce("text", F.lit(""))).distinct().count() == groups
    assert kept.filter("_row = 'clash'").count() == groups


def test_digests_of_earlier_batches_are_met(spark, monkeypatch):
    """Every batch meets the state that earlier ones left, and compares bytes before the next."""
    texts = ["a", "b", "c", "a", "b", "d", "a", "e", "b", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartitionByRange(5, "doc_id")
    met, arrive, compare = [], dedup.DigestStream.arrive, dedup._differing

    def watched(self, rows):
        changed = arrive(self, rows)
        new = rows.groupBy("_digest").count()
        earlier = changed.join(new, "_digest").filter("n > count").count()
        met.append(("arrived", earlier))
        return changed

    def compared(content, arrival, changed, store):
        found = compare(content, arrival, changed, store)
        suspects = store.spark.read.parquet(store.path(f"suspects{arrival}")).count()
        met.append(("compared", suspects))
        return found

    monkeypatch.setattr(dedup.DigestStream, "arrive", watched)
    monkeypatch.setattr(dedup, "_differing", compared)
    report = dedup.dedup_report(docs)
    expected, _ = expected_groups([(i, t) for i, t in enumerate(texts)])
    assert fields(report, "doc_id", "keep_id", "group_size") == expected
    assert [kind for kind, _ in met] == ["arrived", "compared"] * dedup._BATCHES
    assert sum(n for kind, n in met if kind == "arrived") >= 2
    assert sum(n for kind, n in met if kind == "compared") == len(texts) - len(set(texts))


def test_a_batch_compares_with_rows_of_earlier_batches(spark):
    """Different texts of one digest are told apart although they arrive in different batches."""
    rows = [(i, f"text {i % 3}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartitionByRange(6, "doc_id")
    report = dedup.dedup_report(docs, digest=lambda text: F.lit(b"x"))
    assert fields(report, "doc_id", "keep_id", "group_size") == expected_groups(rows)[0]


# --- rows that stay where they are stored ---------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows_", [0, 5, 100_000])
def test_numbers_reach_stored_rows_without_moving_them(spark, rows_):
    store = Store(spark)
    stored = store.save_rows(spark.range(rows_).selectExpr("id", "repeat('x', 20) AS text").repartition(3), "rows")
    numbers = stored.filter("id % 7 < 3 AND id > 2").select("_row", (F.col("id") % 7 + 1).cast("int").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = with_numbers(stored, store.save(numbers, "numbers"), "n", bits=3)
        assert {(r.id, r.n) for r in found.collect()} == {
            (i, i % 7 + 1 if i % 7 < 3 and i > 2 else 0) for i in range(rows_)
        }
        kept = chosen_rows(stored, numbers)
        assert kept.columns == stored.columns
        assert kept.count() + other_rows(stored, numbers).count() == rows_
        plan = plan_of(found).split("Initial Plan")[0]
        assert "Bucketed: true" in plan[plan.index("ShuffledHashJoin") :]
        # Only the bitmaps are exchanged, never the text.
        assert plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    store.drop()
    assert not spark.catalog.tableExists(store._bucketed[0]) if store._bucketed else True


# --- chat -----------------------------------------------------------------------------


def test_snapshots_collapse_like_the_sql(spark):
    rng = random.Random(9)
    turns = []
    for conv in range(80):
        own = [(rng.choice(["user", None]), rng.choice(["a", "b", None, ""])) for _ in range(rng.randint(1, 4))]
        turns += [(conv, 10 * i, role, text, "x") for i, (role, text) in enumerate(own)]
    turns += [(None, 1, "user", "<|im_end|>", "x"), (3, None, "user", "late", "x"), turns[0], turns[0]]
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, turns string")
    connection = duckdb.connect()
    conversations = table.drop("turns").toArrow()  # noqa: F841  read by name
    expected = connection.execute(chat.COLLAPSE_SQL).fetchall()
    found = chat.collapse_snapshots(table)
    assert fields(found, "conv_id", "n_turns", "copies", "rendered") == sorted(expected, key=repr)
    assert chat.collapse_snapshots(table.limit(0)).count() == 0


# --- mixing ---------------------------------------------------------------------------


def water_fill(sizes, weights, share, most):
    """The excess over the limits goes round by weight until no target is above."""
    left, targets, free = share * sum(sizes), {}, set(range(len(sizes)))
    while free:
        level = left / sum(weights[i] for i in free)
        above = [i for i in free if level * weights[i] > most * sizes[i]]
        if not above:
            return [targets.get(i, level * weights[i]) for i in range(len(sizes))]
        for i in above:
            targets[i] = most * sizes[i]
            left -= targets[i]
            free.remove(i)
    return [targets[i] for i in range(len(sizes))]


def test_mix_hits_its_targets(docs, rows):
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words_of(text))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = [(5, 2, 1)[i % 3] for i in range(len(order))]
    targets = dict(zip(order, water_fill([sizes[s] for s in order], weights, 1.5, 2), strict=True))
    report = mixing.mix_report(docs).collect()
    assert len(report) == len(rows)
    taken = Counter()
    for row in report:
        assert row.target == pytest.approx(targets[row.source]) and row.source_size == sizes[row.source]
        assert 0 <= row.taken <= 2 * row.size
        taken[row.source] += row.taken
    for source in order:
        own = sorted((row["size"] for row in report if row.source == source), reverse=True)
        # A row larger than all smaller ones together can leave half of the difference.
        unavoidable = max((x - sum(own[i + 1 :])) / 2 for i, x in enumerate(own))
        assert abs(taken[source] - targets[source]) <= max(0.01 * targets[source], unavoidable + 1)
    again = mixing.mix_report(docs).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, report))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(row.copies for row in report)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_mix_comes_near_targets_with_rows_of_all_sizes(spark, seed):
    """Few huge rows among many small ones: within a hundredth, and unbiased over the rows."""
    rng = random.Random(seed)
    rows = [(i, "w " * min(int(rng.paretovariate(0.7)), 6000), f"s{i % 5}") for i in range(1500)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    report = mixing.mix_report(table, seed=seed).collect()
    for source in {row.source for row in report}:
        own = [row for row in report if row.source == source]
        assert abs(sum(row.taken for row in own) - own[0].target) <= 0.002 * own[0].target + 1


def test_large_rows_are_taken_as_often_as_their_rate_says(spark):
    rows = spark.range(400).selectExpr("id AS _row", "id AS doc_id", "'s' AS source", "IF(id < 2, 90L, 1L) AS size")
    rows = Store(spark).save(rows, "rows")
    taken = [
        sum(row.copies for row in mixing.copies(rows, share=0.5, seed=seed).filter("_row < 2").collect())
        for seed in range(6)
    ]
    assert 1 <= sum(taken) <= 11 and len(set(taken)) > 1


def test_rows_of_one_id_are_dealt_to_many_buckets(spark, monkeypatch):
    table = spark.createDataFrame(
        [(7 if i % 3 == 0 else i, "a b c", "s0") for i in range(3000)], "doc_id bigint, text string, source string"
    )
    longest, fold = [], mixing._fold

    def watched(units, seed):
        longest.append(units.groupBy("source", "bucket").count().agg(F.max("count")).first()[0] or 0)
        return fold(units, seed)

    monkeypatch.setattr(mixing, "_fold", watched)
    report = mixing.mix_report(table, share=0.5).collect()
    assert len(report) == 3000 and abs(sum(row.taken for row in report) - 4500) <= 2.5
    assert longest and max(longest) < 4 * 32


# --- near duplicates --------------------------------------------------------------------


@pytest.mark.parametrize("like", [near.Likeness(3, 90, 100), near.Likeness(5, 80, 100), near.Likeness(1, 50, 100)])
def test_parity_join_links_every_like_pair(docs, rows, like):
    sets = []
    for _, text, *_ in rows:
        words, w = words_of(text), like.width
        sets.append({tuple(words[i : i + w]) for i in range(len(words) - w + 1)} or ({tuple(words)} if words else set()))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and like.denominator * both >= like.numerator * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, row in enumerate(rows):
        ids[find(i)].append(row[0])
    expected = []
    for i, row in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        expected.append((row[0], len(sets[i]), min(known) if known else None))
    found = near.near_report(docs, like)
    assert fields(found, "doc_id", "n_shingles", "component_id") == sorted(expected, key=repr)
    if like == near.Likeness():
        kept = near.distinct_documents(docs, like)
        assert kept.columns == docs.columns and kept.count() == len(ids)


def near_copies(n, groups, seed, length=700):
    """Groups of texts that share most words: some linked, some just not."""
    rng = random.Random(seed)
    rows = []
    for group in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(n // groups):
            own = list(base)
            for _ in range(rng.choice([1, 5, 10, 20, 30])):
                own[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    return rows


def test_large_groups_are_linked_with_few_comparisons(spark, monkeypatch):
    """Groups of hundreds: the pairs compared grow with the rows, not with their square."""
    compared = []
    verify = near._verified

    def counted(pairs, sets, like):
        compared.append(pairs.count())
        return verify(pairs, sets, like)

    monkeypatch.setattr(near, "_verified", counted)
    like = near.Likeness()
    rows = near_copies(600, 2, seed=4)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in near.near_report(table, like).collect()}
    sets = []
    for _, text in rows:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    assert [found[i] for i in range(len(rows))] == root
    assert 1 < len(set(root)) < 400
    pairs = sum(300 * 299 for _ in range(2)) // 2
    assert sum(compared) < pairs / 10


def test_wide_sketches_bound_the_difference(spark):
    """Whatever the sizes: the distance is a lower bound, also between different widths."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 2500).astype(np.uint64)
    sets = [np.unique(base[:n]) for n in (513, 700, 1023, 1025, 1100, 1300, 2100, 2500)]
    rows = [(i, near._wide_sketch(x).tolist()) for i, x in enumerate(sets)]
    assert near._wide_sketch(base[:512]) is None
    table = spark.createDataFrame(rows, "i int, wide array<bigint>")
    pairs = table.alias("x").join(table.alias("y"), F.col("x.i") < F.col("y.i"))
    found = pairs.select("x.i", F.col("y.i").alias("j"), near._apart(F.col("x.wide"), F.col("y.wide")).alias("d"))
    checked = 0
    for row in found.collect():
        n, m = len(sets[row.i]), len(sets[row.j])
        if m < 2 * n:
            assert 0.4 * (m - n) <= row.d <= m - n
            checked += 1
    assert checked > 10


def test_all_words_of_a_sketch_are_used(docs):
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), "text", F.col("doc_id").alias("_id"))
    found = near._describe(texts, near.Likeness())
    used = found.agg(*[F.bit_or(f"s{i}") for i in range(near._SKETCH_WORDS)]).first()
    assert all(used)


# --- nearest neighbours -------------------------------------------------------------------


def test_neighbours_agree_with_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12))
    vectors = centres[rng.integers(8, size=1500)] + rng.normal(scale=0.5, size=(1500, 12))
    vectors[300:700] = vectors[0]
    data = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate(vectors)]
    data += [(2000, None, 1), (2050, [0.0] * 12, 1), (2100, [float("nan")] + [1.0] * 11, 1), (2150, [None] + [1.0] * 11, 1)]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, row int")
    found = neighbours.nearest_neighbours(table, F.col("vec_id") % 50 == 0, list_size=60, block=100)
    by_query = defaultdict(dict)
    for row in found.collect():
        by_query[row.query_id][row["rank"]] = (row.vec_id, row.score)
    assert sorted(by_query) == list(range(0, 1500, 50))
    v = np.array([d[1] for d in data[:1500]])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for q, ranked in by_query.items():
        assert sorted(ranked) == [1, 2, 3, 4, 5]
        scores = np.array([round(s, 12) for s in unit @ unit[q]])
        scores[q] = -2
        best = np.lexsort((np.arange(1500), -scores))[:5]
        hits += len({x for x, _ in ranked.values()} & set(best.tolist()))
        if q == 0 or 300 <= q < 700:
            assert [ranked[r][0] for r in range(1, 6)] == best.tolist()
    assert hits >= 0.95 * 5 * len(by_query)
    few = neighbours.nearest_neighbours(table.filter("vec_id in (0, 1, 7)"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert neighbours.nearest_neighbours(table.limit(0), F.lit(True)).count() == 0


def test_the_graph_finds_what_a_scan_of_all_centroids_finds():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 24))
    centroids = neighbours.unit(centres[rng.integers(40, size=1800)] + rng.normal(size=(1800, 24)) * 0.6)
    vectors = neighbours.unit(centres[rng.integers(40, size=300)] + rng.normal(size=(300, 24)) * 0.6)
    graph = neighbours.CentroidGraph.build(centroids)
    for beam in (16, 96):
        ids, far = graph.search(vectors, beam)
        assert ids.shape == far.shape == (300, beam)
        assert (np.diff(far, axis=1) >= 0).all()
        exact = np.argsort(-(vectors @ centroids.T), axis=1)[:, :4]
        assert (ids[:, 0] == exact[:, 0]).mean() > 0.95
        assert np.mean([len(set(a) & set(b[:16])) / 4 for a, b in zip(exact.tolist(), ids.tolist())]) > 0.9
        known = far[0] < np.inf
        assert far[0][known] == pytest.approx(np.linalg.norm(vectors[0] - centroids[ids[0][known]], axis=1), abs=1e-3)
        assert all(len(set(own)) == len(own) for own in (ids[i][far[i] < np.inf].tolist() for i in range(300)))
    few = neighbours.CentroidGraph.build(centroids[:3])
    ids, far = few.search(vectors[:5], 16)
    assert (np.sort(ids, axis=1) == [0, 1, 2]).all() and np.isfinite(far).all()
    one = neighbours.CentroidGraph.build(centroids[:1]).search(vectors[:5], 4)[0]
    assert (one == 0).all()


def test_a_search_holds_its_beam_only(monkeypatch):
    """No array has a place for every centroid."""
    rng = np.random.default_rng(3)
    graph = neighbours.CentroidGraph.build(neighbours.unit(rng.normal(size=(3000, 8))))
    widest = []
    best = neighbours._best_of
    monkeypatch.setattr(neighbours, "_best_of", lambda ids, *rest: widest.append(ids.shape[1]) or best(ids, *rest))
    graph.search(neighbours.unit(rng.normal(size=(50, 8))), 16)
    assert max(widest) <= 16 + 4 * graph.links.shape[1]


def test_vectors_are_stored_once_and_lists_searched_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(900, 6)).astype(np.float32)
    vectors[200:260] = vectors[3]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<float>").repartition(4)
    stored, save = {}, neighbours.Store.save

    def counted(self, df, name):
        kept = save(self, df, name)
        if "v" in kept.columns:
            stored[name] = (kept.count(), kept.schema["v"].dataType.elementType.typeName())
        return kept

    monkeypatch.setattr(neighbours.Store, "save", counted)
    is_query = F.col("vec_id") % 30 == 0
    whole = neighbours.nearest_neighbours(table, is_query, list_size=30, block=50).collect()
    assert stored["postings"] == (900, "float")
    assert sum(rows for rows, _ in stored.values()) <= 2 * 900 + 2 * 30
    rounds = neighbours.nearest_neighbours(table, is_query, list_size=30, block=50, rows_per_round=300).collect()
    assert len(whole) == 150 and sorted(rounds) == sorted(whole)
    doubles = table.withColumn("embedding", F.col("embedding").cast("array<double>"))
    found = neighbours.nearest_neighbours(doubles, is_query, list_size=30, block=50, rows_per_round=100).collect()
    assert stored["postings"] == (900, "double")
    copies = {(r.query_id, r["rank"]): r.vec_id for r in found if 200 <= r.query_id < 260}
    assert copies == {(q, rank): v for q in (210, 240) for rank, v in enumerate([3, 200, 201, 202, 203], 1)}


def test_the_nearest_of_a_block_are_those_of_a_scan():
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(700, 8))
    vectors[40:600:7] = vectors[5]
    rows = rng.permutation(700)
    ids = rng.permutation(700) // 2
    asked = np.arange(0, 700, 3)
    for n in (1, 5, 100, 800):
        exact = np.stack([neighbours.exact_cosines(vectors[q], vectors) for q in asked])
        exact[np.arange(len(asked)), asked] = -np.inf
        for floors in (np.full(len(asked), -np.inf), np.sort(exact, axis=1)[:, -3].copy()):
            parts = list(neighbours._top(vectors[asked], rows[asked], floors, vectors, rows, ids, n, together=100))
            asker, best, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
            for i in range(len(asked)):
                order = np.lexsort((rows, ids, -exact[i]))
                order = order[(exact[i][order] >= floors[i]) & (exact[i][order] > -np.inf)][:n]
                assert best[asker == i].tolist() == order.tolist()
                assert scores[asker == i].tolist() == exact[i][order].tolist()


def test_training_holds_few_products_at_a_time():
    sample = neighbours.unit(np.random.default_rng(4).normal(size=(5000, 8)))
    tracemalloc.start()
    try:
        centroids = neighbours.train_centroids(sample, 4000, rounds=1)
        neighbours.CentroidGraph.build(centroids)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(centroids) == 4000
    assert peak < 60e6


# --- urls -------------------------------------------------------------------------------


def test_urls_are_parsed_and_ruled(spark):
    cases = [
        ("https://A.Example.com/en/x?q", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/#t", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://net/es/", "net", "/es/", "net/es/", "block"),
        ("x://b.com", "b.com", "", None, None),
        ("x://h?a/b://c", "h", "", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)], "page_id bigint, url string, rule string")
    found = {row.page_id: row for row in urls.judge_urls(pages, URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == verdict if verdict else found[i].verdict in ("allow", "block")
    alone = urls.judge_urls(pages.filter("page_id in (3, 4)"), URL_RULES).collect()
    assert {row.verdict for row in alone} == {"block"}
    assert {row.verdict for row in urls.judge_urls(pages.filter("page_id > 3"), URL_RULES).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0), URL_RULES).count() == 0


def generated_urls(n):
    rng = random.Random(6)
    kinds = [("{}.example.com/en/{}", 3), ("www.{}.com/{}", 4), ("{}.net/es/{}", 2), ("{}.net/fr/{}", 1), ("{}.net/it/{}", 2), ("www.{}.community/{}", 2)]
    out = []
    for kind in rng.choices([k for k, _ in kinds], [w for _, w in kinds], k=n):
        host, page = ("".join(rng.choices("abcdefgh", k=rng.randint(3, 9))) for _ in range(2))
        out.append("https://" + kind.format(host, page))
    return out


def test_the_url_model_equals_a_plain_fit(spark):
    """The verdicts of urls without a rule, from a regression fitted with numpy."""
    given = generated_urls(400) + [None, "x", "https://a.net/it/" + "long/" * 3000]
    given += given[:5]  # repeated rows
    pages = spark.createDataFrame(list(enumerate(given)), "page_id bigint, url string").repartition(3)
    features = 1 << 10
    found = urls.judge_urls(pages, URL_RULES, features=features, iterations=300).collect()
    assert len(found) == len(given)
    labelled = sorted({(r.host, r.path, r.verdict == "block") for r in found if r.rule})

    def vectors(pairs):
        grams = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, host string, path string")
        grams = grams.withColumn("_grams", urls.char_ngrams(F.col("host"), F.col("path"), (3, 4)))
        hashed = urls.HashingTF(inputCol="_grams", outputCol="features", numFeatures=features, binary=True).transform(grams)
        return np.array([row.features.toArray() for row in hashed.orderBy("i").collect()])

    x, y = vectors([(h, p) for h, p, _ in labelled]), np.array([b for *_, b in labelled])
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    x1, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(features + 1)
    penalty = np.append(np.full(features, urls._PENALTY), 0)
    for _ in range(60):  # Newton's method
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = x1.T @ (weight * (p - y)) + penalty * beta
        hessian = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-12)
        beta -= np.linalg.solve(hessian, gradient)
    free = sorted({(r.host, r.path) for r in found if not r.rule})
    margin = np.column_stack([vectors(free), np.ones(len(free))]) @ beta
    expected = {pair: "block" if m > 0 else "allow" for pair, m in zip(free, margin) if abs(m) > 0.02}
    assert len(expected) > 0.9 * len(free) and len(set(expected.values())) == 2
    for row in found:
        if not row.rule and (row.host, row.path) in expected:
            assert row.verdict == expected[row.host, row.path]


def test_held_out_urls_are_judged_right(spark):
    pages = spark.createDataFrame(list(enumerate(generated_urls(1500))), "page_id bigint, url string")
    found = {row.label: row.right / row.n for row in urls.held_out_accuracy(pages, URL_RULES).collect()}
    assert found.keys() == {"allow", "block"} and min(found.values()) > 0.9


# --- language -----------------------------------------------------------------------------


def test_language_of_held_out_texts(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language.identify(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    right = sum(row.lang_pred == row.lang for row in found)
    assert right >= 0.95 * len(found) > 20
    assert all(0 <= row.score <= 1 for row in found)


def test_training_texts_are_not_shuffled(spark, docs, monkeypatch):
    plans = []
    collect = type(docs).collect

    def watched(df):
        plans.append(plan_of(df))
        return collect(df)

    monkeypatch.setattr(type(docs), "collect", watched)
    language.train_prototypes(docs.select("doc_id", "text", "lang"), max_per_language=20)
    (learned,) = [plan for plan in plans if "MapInArrow" in plan]
    below = learned[learned.index("MapInArrow") :]
    assert "Exchange hashpartitioning" not in below.split("InMemoryTableScan")[0] and "Join" not in below


def test_language_of_awkward_rows(docs, rows, empty):
    found = {row.doc_id: row for row in language.identify(docs).collect()}
    assert {found[i].lang_pred for i in (110, 111, 112, 115)} == {"und"}
    assert {found[i].score for i in (110, 111, 112, 115)} == {0.0}
    assert language.identify(docs).count() == len(rows)
    nothing_learned = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {row.lang_pred for row in nothing_learned.collect()} == {"und"}


def test_a_texts_vector_is_the_same_at_any_place_of_a_batch():
    texts = ["hello", "hello", "終", "", " 終 ", "42", "Hello!", "a b  c", "a b c ", "終", "hello"]
    vectors, has_letter = language.text_vectors(texts, 256)
    for text, vector, known in zip(texts, vectors, has_letter, strict=True):
        alone, letter = language.text_vectors([text], 256)
        assert (vector == alone[0]).all() and known == letter[0]
        assert bool(vector.any()) == known
    expected = np.zeros(256)
    padded = [ord(c) if c != " " else 0 for c in " hello "]
    for gram in zip(padded, padded[1:], padded[2:], strict=False):
        a, b, c = language.letter_vectors(np.array(gram), 256)
        expected += np.roll(a, 2) * np.roll(b, 1) * c
    assert vectors[1] == pytest.approx(expected / np.linalg.norm(expected), abs=1e-6)


def test_repeated_rows_and_one_letter_texts_have_one_language(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "終", "x"] * 150
    langs = ["en", "de", "zh", None] * 150
    table = spark.createDataFrame(
        list(zip(range(600), texts, langs, strict=True)), "doc_id bigint, text string, lang string"
    )
    found = language.identify(table.repartition(3)).join(table.select("doc_id", "text"), "doc_id")
    scores = defaultdict(set)
    for row in found.collect():
        scores[row.text].add((row.lang_pred, row.score))
    assert all(len(own) == 1 for own in scores.values())
    (lang, score), = scores["終"]
    assert lang == "zh" and score == pytest.approx(1)


# --- sharding -----------------------------------------------------------------------------


def test_shards_are_balanced_and_slots_gapless(spark, docs, rows):
    placed = sharding.shard(docs, shards=4).collect()
    assert fields(sharding.shard(docs, shards=4), "doc_id", "size", "text_crc32") == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr
    )
    slots = defaultdict(list)
    for row in placed:
        slots[row.shard].append(row.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())

    # A third of all rows is one text; the rest are groups of three.
    many = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 9))).alias("text"),
    )
    result = sharding.shard(many, shards=4)
    loads = [row["b"] for row in result.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 4 and max(loads) <= 1.02 * min(loads)
    groups = result.join(many, "doc_id").filter("text != 'hot text'").groupBy("text")
    assert groups.agg(F.count_distinct("shard").alias("n")).filter("n > 1").count() == 0


@pytest.mark.parametrize("n", [240, 6000])
def test_groups_that_fit_a_shard_stay_whole(spark, n):
    """Of four shards one text fills one and a half, others a half, a fifth and a tenth; the rest are pairs."""
    edges = [3 * n // 8, n // 8, n // 20, n // 40]
    texts = [name for name, size in zip(["hot ", "half", "fifth", "tenth"], edges, strict=True) for _ in range(size)]
    texts += [f"p{i // 2:04}" for i in range(n - len(texts))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = sharding.shard(table, shards=4).join(table, "doc_id").collect()
    shards = defaultdict(Counter)
    for row in found:
        shards[row.text][row.shard] += 1
    assert {text for text, own in shards.items() if len(own) > 1} == {"hot "}
    assert sorted(shards["hot "].values()) == [edges[0] // 2] * 2
    loads = Counter(row.shard for row in found)
    assert len(loads) == 4 and max(loads.values()) <= 1.1 * n / 4


# --- empty tables ---------------------------------------------------------------------------


def test_empty_tables_give_empty_results(empty):
    results = [
        packing.pack_documents(empty, TOKENIZER),
        katz.score_documents(empty),
        dedup.dedup_report(empty),
        dedup.distinct_documents(empty),
        mixing.mix_report(empty),
        mixing.mix(empty),
        near.near_report(empty, near.Likeness()),
        near.distinct_documents(empty),
        language.identify(empty),
        sharding.shard(empty),
    ]
    assert [result.count() for result in results] == [0] * len(results)


def test_bucket_members_come_one_bucket_at_a_time(spark):
    """Buckets are not gathered into lists: a task never holds many whole buckets on the heap."""
    rng = random.Random(7)
    cells, expected = [], set()
    for bucket in range(5):
        by_key = defaultdict(list)
        for _ in range(3):
            keys = [rng.randrange(40) for _ in range(30)]
            rows = [rng.randrange(1, 10**12) for _ in keys]
            for k, r in zip(keys, rows):
                by_key[(bucket << 32) | k].append(r)
            keys_u4 = np.array(keys, "<u4").tobytes()
            cells.append((bucket, keys_u4, near._planes(np.array(rows, np.uint64)), b"", b"", b""))
        for key, rows in by_key.items():
            if len(rows) > 1:
                head = min(rows)
                expected |= {(key, r, head) for r in rows}
    schema = "bucket int, keys binary, rows binary, member_keys binary, members binary, heads binary"
    members = near._members(spark.createDataFrame(cells, schema).repartition(3))
    assert "ObjectHashAggregate" not in plan_of(members)
    assert Counter(tuple(r) for r in members.collect()) == Counter(expected)
