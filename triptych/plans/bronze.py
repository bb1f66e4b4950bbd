"""Bronze: the source as it came, plus audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triptych.operators import count_with_distinct


def with_audit(source: DataFrame, source_file: str | None = None) -> DataFrame:
    """Add when and from where each row came.

    Without ``source_file`` the path of the file that held the row is used; that
    needs ``source`` to come straight from a file reader.
    """
    origin = F.col("_metadata.file_path") if source_file is None else F.lit(source_file)
    return source.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        origin.alias("source_file"),
    )


def stats(bronze: DataFrame, id_column: str = "id", *, dense: bool | None = None) -> DataFrame:
    """Rows, distinct ids and first ingestion time, in one row; see ``count_with_distinct``."""
    return count_with_distinct(
        bronze,
        id_column,
        "Unique_Patients",
        rows="Total_Records",
        minima={"Ingestion_Time": "ingestion_timestamp"},
        dense=dense,
    )
