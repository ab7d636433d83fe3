"""Tables of other systems, read for enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_files(spark: SparkSession, path: str, file_format: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(file_format).options(**options).load(path)


def jdbc_options(
    url: str,
    table: str,
    *,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options. With a split column the table is read by many tasks, not by one."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if split_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("a split column needs lower, upper and partitions")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return {**options, **extra}


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
