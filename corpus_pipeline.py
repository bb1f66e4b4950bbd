"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (session, docs, folder of the tables) that returns a
DataFrame; it is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.

Every stage takes rows with null or repeated ids, null, empty or very long texts, null
languages and sources, and repeated rows, each of which is a row of its own.  Other
columns of ``docs`` are left out, whatever their names.  An empty table gives an empty
result.  What a stage does with such rows is in its docstring.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triptych.llm import dedup, language, mixing, near, packing
from triptych.llm.queries import TOKENIZER
from triptych.llm.store import Store, stores_of_run

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without any letter, and those with nothing in common with any language.

    The languages are learned from ``docs`` itself, as in the query of that operator.
    Null and empty texts have no letter and go.  Equal texts share their fate, whatever
    their ids, languages and sources are.  Where no language can be learned, because all
    ``lang`` are null or all rows are held out, every text with a letter stays.
    """
    rows = docs.select(*COLUMNS)
    languages, prototypes = language.train_prototypes(rows.filter(~language.held_out(F.col("doc_id"))))
    if not languages:
        return rows.filter(F.regexp_like("text", F.lit(r"\p{L}")))
    judged = language.predict(rows, languages, prototypes, keep=COLUMNS)
    return judged.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") > 0)).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    A null text counts as empty.  A null id stays only in a group without others; of rows
    that also share the id, one stays.
    """
    return dedup.distinct_documents(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 or more on five words one stays.

    It is the one with the smallest doc_id, a null id last.  Null texts and those without
    words are linked with nothing and stay.
    """
    return near.distinct_documents(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: rows are dropped or repeated.

    A null source is one of its own, the last.  Rows without words have size 0: they are
    taken as often as the whole part of their source's rate says.
    """
    return mixing.mix(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts, with their places in sequences of 4096 tokens.

    A null or empty text is a piece of one token, the end; long texts have several pieces.
    """
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, _Stage]] = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Near copies, random rounding and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


class Run:
    """One run of the stages; owns the intermediate tables of its stages.

    A stage's result is read from its tables, so they go when that result is stored, and
    the stored result when that of the next stage is.  The tables of the last stage, whose
    result is returned as it is, stay until ``drop``.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.store = Store(spark)
        self.last: list[Store] = []

    def result(self) -> DataFrame:
        docs = self.spark.read.parquet(f"{self.sf_dir}/documents.parquet")
        *stages, (_, last) = STAGES
        earlier = None
        for name, stage in stages:
            with stores_of_run() as opened:
                docs = self.store.save(stage(self.spark, docs, self.sf_dir), name)
            for store in opened:
                store.drop()
            self.store.release()
            if earlier:
                self.store.drop(earlier)
            earlier = name
        with stores_of_run() as self.last:
            return last(self.spark, docs, self.sf_dir)

    def drop(self) -> None:
        """Remove what the result is read from, once nobody needs it."""
        for store in [*self.last, self.store]:
            store.drop()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    return Run(spark, sf_dir).result()
