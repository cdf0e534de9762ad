"""The one-step cleaner: raw file to a clean table, without layers or quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_tolerant
from ..sources.delimited import export_csv, read_text_columns, well_formed
from ..sources.layers import write_table


def clean_file(
    spark: SparkSession, raw_csv: str, parquet_path: str, csv_path: str | None = None,
    damage_copies: bool = False, multi_line: bool | None = None,
) -> DataFrame:
    """Clean a raw file into Parquet and, when asked, a delimited copy."""
    lines = read_text_columns(spark, raw_csv, multi_line)
    cleaned = clean_tolerant(well_formed(lines), damage_copies)
    write_table(cleaned, parquet_path, "overwrite")
    stored = spark.read.parquet(parquet_path)
    if csv_path is not None:
        export_csv(stored, csv_path)
    return stored
