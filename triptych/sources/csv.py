"""CSV source and sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triptych.config import SOURCE_SCHEMA
from triptych.functions import to_type

# Fixed values.  Quotes inside a value are doubled, blanks at its ends belong to
# it, and timestamps keep their microseconds and offset.
_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSx",
    "timeZone": "UTC",
}

#: Columns that lenient reading can add: the text of a line with too few or too many
#: fields, and the texts of values that became null, by column.
MALFORMED = "_malformed_line"
LOST = "_lost_values"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = SOURCE_SCHEMA,
    *,
    sep: str = ",",
    infer_schema: bool = False,
    on_error: str = "raise",
    multiline: bool = False,
    with_rejects: bool = False,
) -> DataFrame:
    """Read CSV files that have a header line.

    Columns are matched to ``schema`` by name, whatever their order and letter case
    in the file; columns the schema does not know are kept as text.  Only the header is read
    to find the order, so the data is scanned once.  ``infer_schema`` takes all
    types from the data instead, at the price of a second scan.  Either way the
    headers of several files must agree.

    Numbers and booleans are scanned as text and then cast: ``233.0`` is a whole
    number, blanks around it do not matter, and ``1`` and ``0`` are booleans.

    ``on_error="null"`` reads an unreadable value as null instead of failing, fields that
    a line lacks as null, and leaves surplus fields out.  ``with_rejects`` then adds the
    columns ``MALFORMED`` (the line, if its number of fields or an uncast value is wrong)
    and ``LOST`` (column to text, empty if all values could be read).
    ``multiline`` allows line breaks inside quotes; files then cannot be split,
    so keep it for small files.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    reader = (
        spark.read.options(**_FORMAT)
        .option("sep", sep)
        .option("multiLine", multiline)
        .option("mode", "FAILFAST" if on_error == "raise" else "PERMISSIVE")
    )
    with_rejects = with_rejects and on_error == "null"
    if with_rejects:
        # All fields have to be parsed to tell which lines are malformed.
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)

    def scan(types: list[T.StructField]) -> DataFrame:
        extra = [T.StructField(MALFORMED, T.StringType())] if with_rejects else []
        # enforceSchema=False makes every file's header agree with the first one's.
        return reader.schema(T.StructType([*types, *extra])).option("enforceSchema", False).csv(path)

    if infer_schema:
        inferred = reader.option("inferSchema", True).option("enforceSchema", False).csv(path)
        if not with_rejects:
            return inferred
        return scan(inferred.schema.fields).withColumn(LOST, _lost_values({}))

    header = reader.csv(path).columns
    known = {field.name.lower(): field.dataType for field in schema.fields}
    missing = known.keys() - {name.lower() for name in header}
    if missing:
        raise ValueError(f"columns missing from {path}: {', '.join(sorted(missing))}")
    text = T.StringType()
    types = {name: known.get(name.lower(), text) for name in header}
    rows = scan([T.StructField(name, text if _is_cast(kind) else kind) for name, kind in types.items()])
    cast = {
        name: to_type(F.col(f"`{name}`"), text, kind.simpleString(), on_error)
        for name, kind in types.items()
        if _is_cast(kind)
    }
    columns = [cast[name].alias(name) if name in cast else F.col(f"`{name}`") for name in types]
    return rows.select(*columns, *([MALFORMED, _lost_values(cast).alias(LOST)] if with_rejects else []))


def _lost_values(cast: dict[str, Column]) -> Column:
    """The texts of the columns that their cast turned into null."""
    if not cast:
        return F.create_map().cast("map<string,string>")
    texts = []
    for name, value in cast.items():
        texts += [F.lit(name), F.when(value.isNull(), F.col(f"`{name}`"))]
    return F.map_filter(F.create_map(*texts), lambda _, kept: kept.isNotNull())


def _is_cast(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def write_csv(df: DataFrame, path: str, *, sep: str = ",") -> None:
    """Write a folder of CSV files, each with a header.

    The files of sorted rows are numbered in their order: read by name they are sorted.
    """
    df.write.mode("overwrite").options(**_FORMAT).option("sep", sep).csv(path)
