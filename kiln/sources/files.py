"""Readers and writers (S1-S6, S9, S10): delimited files with declared
schemas, folders of per-key files, row literals, predictions and models.

Readers never infer a schema (inference costs a pass over the data) and keep
malformed rows countable in ``_corrupt_record`` instead of dropping them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True,
                   sep: str = ",", multiline: bool = False) -> DataFrame:
    """CSV (plain or gzip) with a declared schema; quoted commas
    and doubled quotes handled, blanks around values trimmed, a leading
    byte-order mark ignored. Gzip files are one split each, so callers
    repartition after reading large ones."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    r = (spark.read.schema(_with_corrupt(schema)).option("header", header).option("sep", sep)
         .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT)
         .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
         .option("multiLine", multiline).option("encoding", "UTF-8"))
    return r.csv(path)


def read_multiline_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                       columns: Sequence[str] | None = None) -> DataFrame:
    """S3: CSV whose quoted fields contain line breaks; only ``columns`` kept."""
    df = read_delimited(spark, path, schema, multiline=True)
    return df.select(*columns) if columns else df


def read_symbol_folder(spark: SparkSession, path: str, schema: T.StructType | str, name: str = "name",
                       pattern: str = r"([^/]+?)(?:_data)?\.csv$") -> DataFrame:
    """A folder of per-key files as one table (each file's header
    dropped), with the key taken from the file name."""
    df = read_delimited(spark, path, schema)
    return df.withColumn(name, F.regexp_extract(F.input_file_name(), pattern, 1))


def from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A table from row tuples or dicts and a schema."""
    return spark.createDataFrame(list(rows), schema)


ROWS_PER_FILE = 50_000


def write_predictions(df: DataFrame, path: str, fmt: str = "csv", rows_per_file: int = ROWS_PER_FILE) -> None:
    """A table with a header (csv) or as parquet; replaces the folder. A
    file holds at most ``rows_per_file`` rows: a file with line breaks in
    quotes, or one that is compressed, is read in one piece.
    CSV quotes with doubled quotes, as ``read_delimited`` expects (Spark's
    writer would otherwise escape quotes with a backslash), so any text,
    commas and line breaks included, reads back unchanged."""
    w = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        (w.option("header", True).option("quote", '"').option("escape", '"')
         .option("encoding", "UTF-8").csv(path))
    else:
        w.parquet(path)


def save_model(model, path: str) -> None:
    """Persist a fitted model (replacing an older one)."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:  # a model of ours, which replaces its own parts
        model.save(path)


def load_model(cls, path: str):
    """Reload with the model's class, e.g. ``ALSModel``."""
    return cls.load(path)


def register_view(df: DataFrame, name: str) -> None:
    """Make a table known to ``spark.sql`` under a name."""
    df.createOrReplaceTempView(name)
