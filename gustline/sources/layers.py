"""Where each layer lives and how it is written and read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import contract as K
from ..session import SCAN_BYTES, freed_shuffles
from .delimited import CORRUPT, file_name, malformed, read_text_columns, well_formed

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
EVENTS, QUARANTINE, REJECTED_LINES = "outage_events", "quarantine", "rejected_lines"
FEATURES, STATE_SUMMARY = "utility_features", "state_risk_summary"


def batch_path(data_dir: str, layer: str, table: str, batch_id: str) -> str:
    return f"{data_dir.rstrip('/')}/{layer}/{table}/batch_id={batch_id}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: A reader's task takes whole row groups; the usual 128 MB of them are millions of events.
ROW_GROUP_BYTES = SCAN_BYTES // 2


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    with freed_shuffles(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return path


def read_batch(
    spark: SparkSession, data_dir: str, layer: str, table: str, batch_id: str
) -> DataFrame:
    return spark.read.parquet(batch_path(data_dir, layer, table, batch_id))


def silver_contract(silver: DataFrame) -> DataFrame:
    """Silver without the order key and copy count that ride along in storage."""
    return silver.select(*[K.ident(c) for c in K.SILVER_COLUMNS])


SOURCE = "_source_file"


def with_lineage(raw: DataFrame, batch_id: str, ingested_at: str) -> DataFrame:
    """Add batch id, ingestion time, source file (unless ``raw`` names it already) and a unique row id."""
    rows = raw if SOURCE in raw.columns else raw.withColumn(SOURCE, file_name(F.col("_metadata.file_path")))
    return rows.select(
        *[F.col(K.ident(c)) for c in raw.columns if c != SOURCE],
        F.lit(batch_id).alias("_batch_id"),
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at"),
        SOURCE,
        F.monotonically_increasing_id().alias(K.ROW_ID),
    )


def land_bronze(
    spark: SparkSession,
    raw_csv: str,
    data_dir: str,
    batch_id: str,
    ingested_at: str,
    limit: int | None = None,
    multi_line: bool | None = None,
) -> dict:
    """Land a delimited file as text columns with lineage; a batch is written once only.

    One pass over the file writes the good lines and counts the bad ones; the bad lines
    are read again and kept only when there are any. ``limit``, for development, keeps that many
    good lines (in one task, after one more read) and changes nothing else: all bad lines are
    counted and kept. Line breaks inside quotes are found unless ``multi_line`` says whether
    there are any.
    """
    path = batch_path(data_dir, BRONZE, EVENTS, batch_id)
    if path_exists(spark, path):
        raise FileExistsError(f"batch {batch_id} has landed before, its Bronze rows stay as they are: {path}")
    lines = read_text_columns(spark, raw_csv, multi_line, source=SOURCE)
    bad = Observation()
    count_bad = F.count(F.when(F.col(CORRUPT).isNotNull(), F.lit(1))).alias("lines")
    landed = with_lineage(lines, batch_id, ingested_at)
    if limit is None:
        write_table(well_formed(landed.observe(bad, count_bad)), path)
        skipped = bad.get["lines"]
    else:  # a limited read stops early, so the bad lines are counted on their own
        write_table(well_formed(landed).limit(limit), path)
        # Spark refuses to read the line text alone, so another column is counted with it
        skipped = lines.agg(count_bad, F.count(K.ident(lines.columns[0]))).first()["lines"]
    if skipped:
        rejects = batch_path(data_dir, BRONZE, REJECTED_LINES, batch_id)
        write_table(malformed(lines.drop(SOURCE)), rejects)
    rows = spark.read.parquet(path).count()
    return {"path": path, "rows": rows, "malformed_lines_skipped": skipped}


def existing_tables(
    spark: SparkSession, data_dir: str, batch_id: str
) -> Iterable[tuple[str, str, DataFrame]]:
    """(layer, table, rows) of every table that exists for a batch."""
    for layer, table in (
        (BRONZE, EVENTS), (SILVER, EVENTS), (SILVER, QUARANTINE),
        (GOLD, FEATURES), (GOLD, STATE_SUMMARY),
    ):
        if not path_exists(spark, batch_path(data_dir, layer, table, batch_id)):
            continue
        df = read_batch(spark, data_dir, layer, table, batch_id)
        yield layer, table, silver_contract(df) if (layer, table) == (SILVER, EVENTS) else df
