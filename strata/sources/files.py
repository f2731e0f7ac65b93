"""Raw file sources and sinks (bronze ingestion, A1-A4, A8, A9, A11).

All readers take an explicit schema: no inference pass over the data, and a
stable plan whether a folder holds one file or a million.  Only JSON documents that are kept
whole (schema on read) take a pass for their fields' names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas as sc


def read_pos_csv(spark: SparkSession, path: str, schema: T.StructType = sc.POS_RAW,
                 quote: str = "", sep: str = ",") -> DataFrame:
    """Comma-separated POS files with one header line, columns by position.

    No enclosure character is declared by the reference, so quotes stay
    literal by default (``quote=""``); pass ``quote='"'`` for quoted files.
    Rows that do not parse raise (``FAILFAST``), like the strict load.
    """
    return (spark.read.schema(schema)
                 .option("header", True).option("sep", sep).option("quote", quote)
                 .option("mode", "FAILFAST").option("enforceSchema", True)
                 .csv(path))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    column: str = "row_col", fields: T.StructType | None = None) -> DataFrame:
    """Files that each hold one JSON array; every element becomes a row.

    With ``schema`` the elements are parsed into typed columns.  Without it each element is
    kept whole as one VARIANT column ``column`` (schema on read): a first pass over all files finds
    the names of the top-level fields (unless ``fields`` gives them), and the reader splits the array into
    rows whose fields are VARIANT, so no file is parsed as one value.  It is still one task per
    file: producers should keep files to some hundred MB.
    """
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        return reader.schema(schema).json(path)
    return as_variant(reader.schema(fields or variant_fields(spark, path)).json(path), column)


def variant_fields(spark: SparkSession, path: str) -> T.StructType:
    """Every top-level field of the documents of ``path`` as VARIANT; those of a sensor document, if there is none."""
    try:
        names = spark.read.option("multiLine", True).option("mode", "FAILFAST").option("samplingRatio", 1.0) \
            .json(path).schema.names
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        names = []
    return T.StructType([T.StructField(n, T.VariantType()) for n in names or sc.IOT_VARIANT.names])


def as_variant(docs: DataFrame, column: str = "row_col") -> DataFrame:
    """Documents whose fields are columns, as one VARIANT column."""
    return docs.select(F.to_variant_object(F.struct(*docs.columns)).alias(column))


def read_parquet_raw(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet rows as written by the source system (typed columns)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table folder (Parquet, possibly partitioned)."""
    return spark.read.parquet(path)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``INSERT INTO ... SELECT``: add the rows of ``df`` to a table folder."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "gzip") -> None:
    """Write POS-style CSV (header line, comma separated), compressed as deliveries are; a reader takes a file whole."""
    w = df.write.mode("overwrite").option("header", True).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


__all__ = ["read_pos_csv", "read_json_array", "as_variant", "variant_fields", "read_parquet_raw", "read_table", "append",
           "write_csv"]
