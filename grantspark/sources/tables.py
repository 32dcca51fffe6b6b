"""Column-pruned, typed scans."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows that one task works on: a row's text rules take far longer than reading it, and a file split of compressed rows holds millions.
TASK_ROWS = 50_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal an input out to as many tasks as its rows need, at least one per core.

    Text work per row outweighs the one shuffle of short rows. Splits of a file are made by bytes: with short rows they are few, and
    those of a file of few row groups uneven. An input with enough splits is left alone. ``rows`` is the number of rows where known.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((df.count() if rows is None else rows) / TASK_ROWS))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # the count of a stored table comes from the files' footers
    return spread(spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"))


#: Schemas of the stored snapshots' columns that summaries read.
SCHEMAS = {
    "notices": "id long, fonte string, numero string, valor_bolsa string, perfil_execucao string",
    "attachments": "id long, edital_id long, file_id string, caminho_storage string, is_processed boolean",
    "catalogue": "id long, fonte string, titulo string, valor_projeto string, validado_em date",
}


def scan_table(spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read with a fixed schema, only the named columns; a column the files lack reads as NULL."""
    df = spark.read.schema(schema).parquet(path)
    return df.select(*columns) if columns else df


def scan_tables(spark: SparkSession, paths: dict[str, str], schemas: dict[str, T.StructType | str],
                columns: dict[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    return {k: scan_table(spark, p, schemas[k], (columns or {}).get(k)) for k, p in paths.items()}


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    """Crawled pages: parquet with url and html, else a folder of whole HTML files."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path).select("page_id", "url", "html")
    return spark.read.text(path, wholetext=True).select(
        F.xxhash64(F.input_file_name()).alias("page_id"), F.input_file_name().alias("url"), F.col("value").alias("html")
    )
