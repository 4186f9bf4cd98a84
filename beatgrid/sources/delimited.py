"""CSV files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
#: How a null is written; an empty text is written as two quotes.
NULL = "\\N"
#: A quote inside a quoted text is doubled.
QUOTE = '"'


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Scan CSV files; without a schema the types are inferred, at the cost of one more pass.

    A header that disagrees with the schema is an error; columns are never matched by position alone. Texts with
    line breaks need ``multi_line``, which reads each file in one piece.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, nullValue=NULL, escape=QUOTE)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_well_formed_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Scan CSV files and leave out every malformed line, whichever columns are used afterwards.

    The plain DROPMALFORMED mode judges a line by the columns a query happens to need, so counts and projections
    disagree. Here all columns go through a one-row generator, so every line is parsed whole, and once. Each
    file's header is checked as in :func:`read_csv`.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.options(header=True, multiLine=multi_line, nullValue=NULL, escape=QUOTE, enforceSchema=False)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .schema(marked)
        .csv(path)
    )
    whole = lines.select(F.inline(F.array(F.struct(*(F.col(f"`{name}`") for name in marked.fieldNames())))))
    return whole.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False) -> None:
    """Write CSV files with a header; refuses an existing path unless ``mode`` says otherwise.

    A null and an empty text are written differently, so both come back. ``single_file`` sends all rows to one
    writing task after they are computed, and is meant for small exports only.
    """
    rows = df.repartition(1) if single_file else df
    rows.write.mode(mode).options(header=True, nullValue=NULL, escape=QUOTE).csv(path)
