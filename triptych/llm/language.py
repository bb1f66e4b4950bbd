"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram's vector binds those of
its letters, permuted by their place, by multiplication.  A text's vector bundles
(adds) its trigrams' vectors; a language's prototype bundles its texts' vectors,
scaled to length one.  A text has the language whose prototype has the largest
cosine with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triptych.llm.words import keep_none, mix

UNDETERMINED = "und"

_is_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters, by Unicode."""
    global _is_letter
    if _is_letter is None:
        _is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _is_letter


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """The fixed random vectors of code points: signs from a hash of code and place."""
    places = np.arange(dimensions, dtype=np.uint64)
    bits = mix(mix(codes.astype(np.uint64))[:, None] ^ places[None, :]) >> np.uint64(63)
    return bits.astype(np.float32) * 2 - 1


def text_vectors(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and which texts have a letter.

    Texts are lower-cased; every run of other characters counts as one blank.
    The vectors of the trigrams that occur are built once for all texts, and
    weighed by a matrix of counts; both are cut into blocks of bounded size.
    """
    joined = "".join(f"  {text.lower()} " for text in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(text.lower()) + 3 for text in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), sizes)
    codes = np.where(_letters()[codes], codes, 0)
    # One blank of a run stays, also where the text before ends in a blank.
    run = np.ones(len(codes), bool)
    run[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (owner[1:] != owner[:-1])
    codes, owner = codes[run], owner[run]
    has_letter = np.bincount(owner, codes != 0, len(texts)) > 0

    used = np.flatnonzero(np.bincount(codes))
    index = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
    index[used] = np.arange(len(used))
    letter, size = index[codes], len(used)
    same = owner[2:] == owner[:-2]
    grams = ((letter[:-2] * size + letter[1:-1]) * size + letter[2:])[same]
    of = owner[2:][same]
    distinct, gram = np.unique(grams, return_inverse=True)
    base = letter_vectors(used, dimensions)
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    vectors = np.zeros((len(texts), dimensions), np.float32)
    block = 4096
    order = np.argsort(gram, kind="stable") if len(distinct) > block else None
    for at in range(0, len(distinct), block):
        own = distinct[at : at + block]
        bound = first[own // (size * size)] * second[own // size % size] * base[own % size]
        if order is None:
            g, o = gram, of
        else:
            lo, hi = np.searchsorted(gram, [at, at + block], sorter=order)
            g, o = gram[order[lo:hi]] - at, of[order[lo:hi]]
        counts = np.bincount(o * len(own) + g, minlength=len(texts) * len(own))
        vectors += counts.reshape(len(texts), len(own)).astype(np.float32) @ bound
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.maximum(norms, 1e-12), has_letter


def _groups(texts: pa.Array, max_chars: int = 500_000, max_texts: int = 256) -> Iterator[tuple[int, list[str]]]:
    first, own, chars = 0, [], 0
    for i, text in enumerate(texts):
        value = text.as_py() or ""
        if own and (chars + len(value) > max_chars or len(own) == max_texts):
            yield first, own
            first, own, chars = i, [], 0
        own.append(value)
        chars += len(value)
    if own:
        yield first, own


def train_prototypes(
    labelled: DataFrame, *, dimensions: int = 1024, max_per_language: int = 5_000
) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their prototypes, from rows of doc_id, text, lang.

    Of a language with more than ``max_per_language`` texts about that many are
    used, chosen by a hash of their ids.  Rows without a language or a letter teach
    nothing.  What reaches the driver is a count and a vector per language; texts are
    sampled and bundled where they are read.
    """
    labelled = labelled.filter(F.col("lang").isNotNull())
    counts = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    # One rate per language goes into the scan, so no text is shuffled.
    rates = [F.lit(x) for lang, n in counts.items() for x in (lang, max_per_language / n)]
    rate = F.create_map(*rates)[F.col("lang")] if rates else F.lit(0.0)
    sample = labelled.filter(drawn < rate).select("text", "lang")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for first, texts in _groups(batch.column(0)):
                vectors, has_letter = text_vectors(texts, dimensions)
                own = langs[first : first + len(texts)]
                for lang in set(own[has_letter]):
                    part = vectors[(own == lang) & has_letter].sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + part
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.string()),
                pa.array([v.tobytes() for v in sums.values()], pa.binary()),
            ],
            names=["lang", "vector"],
        )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v) for v in sorted(group["vector"]))
        return pd.DataFrame({"lang": [group["lang"].iloc[0]], "vector": [total.tobytes()]})

    schema = "lang string, vector binary"
    rows = sample.mapInArrow(bundle, schema).groupBy("lang").applyInPandas(add, schema).collect()
    rows.sort(key=lambda row: row["lang"])
    vectors = [np.frombuffer(row["vector"]) for row in rows]
    scaled = [v / max(np.linalg.norm(v), 1e-12) for v in vectors]
    return [row["lang"] for row in rows], np.array(scaled, np.float32).reshape(len(rows), dimensions)


def predict(
    docs: DataFrame, languages: list[str], prototypes: np.ndarray, *, keep: Sequence[str]
) -> DataFrame:
    """The columns ``keep`` of ``docs``, with lang_pred and score of its ``text``.

    The score is the largest cosine, 0 if negative.  Texts that are null or have
    no letter, and all texts if no language was learned, get ``und`` and 0.
    """
    dimensions = prototypes.shape[1]
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    names = np.array([*languages, UNDETERMINED], object)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_none()
        for batch in batches:
            best = np.full(batch.num_rows, len(languages))
            score = np.zeros(batch.num_rows)
            for first, texts in _groups(batch.column(len(keep))):
                if not languages:
                    break
                vectors, has_letter = text_vectors(texts, dimensions)
                # Not a matrix product: its last digits depend on the number of rows.
                cosines = np.clip(np.einsum("td,ld->tl", vectors, prototypes), 0, 1)
                own = slice(first, first + len(texts))
                best[own] = np.where(has_letter, cosines.argmax(axis=1), len(languages))
                score[own] = np.where(has_letter, cosines.max(axis=1), 0)
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(names[best], pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(judge, schema)


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 modulo 4; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``.

    ``docs`` has doc_id, text and lang; lang is only read for learning, from rows
    that are not held out.  Repeated rows are rows of their own; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").withColumn(
        "held_out", held_out(F.col("doc_id"))
    )
    learned = train_prototypes(rows.filter(~F.col("held_out")), **options)
    return predict(rows, *learned, keep=["doc_id", "held_out"])
