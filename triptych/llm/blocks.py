"""Blocks of documents that exchange with tables: answers for a block travel packed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.llm.katz import packed, unpacked

_GATHERED = 300_000


def gathered(answers: DataFrame) -> DataFrame:
    """Rows of ``block`` and other bigint columns to one row per block: block, answers.

    The rows of a task are packed per block before they are shuffled; a block gets no
    more rows than it asked for.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def flush() -> pa.RecordBatch:
            block, *rest = np.concatenate(held, axis=1)
            order = np.lexsort((rest[0], block))
            block, rest = block[order], [x[order] for x in rest]
            edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
            data = [packed(*(x[i:j] for x in rest)) for i, j in zip(edges[:-1], edges[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(block[edges[:-1]]), pa.array(data, pa.binary())], names=["block", "data"]
            )

        for batch in batches:
            held.append(np.stack([column.to_numpy() for column in batch.columns]))
            rows += batch.num_rows
            if rows >= _GATHERED:
                yield flush()
                held, rows = [], 0
        if rows:
            yield flush()

    parts = answers.mapInArrow(gather, "block bigint, data binary")
    return parts.groupBy("block").agg(F.collect_list("data").alias("answers"))


def answer_columns(answers: pa.ListScalar, columns: int) -> np.ndarray:
    """The columns that ``gathered`` packed, in any order of rows; none for a null."""
    if not answers.is_valid:
        return np.zeros((columns, 0), np.int64)
    return np.concatenate([unpacked(part.as_py(), columns) for part in answers.values], axis=1).astype(np.int64)
