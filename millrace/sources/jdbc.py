"""Parallel reading from and writing to a database through JDBC.

The driver jar comes with the session (spark.jars). These calls need a database
that every executor reaches; the tests cover the options and bounds only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that split a read into ranges of a numeric column.

    The bounds shape the ranges and drop no row: the first range is open below
    and the last one above.
    """
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    dbtable: str,
    driver: str,
    column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable).option("driver", driver)
    reader = reader.option("fetchsize", fetch_size).options(**options)
    if column is not None:
        reader = reader.options(**partition_options(column, lower, upper, partitions))
    return reader.load()


def write_jdbc(df: DataFrame, url: str, dbtable: str, driver: str, connections: int = 8, mode: str = "append", batch_size: int = 10_000) -> None:
    """Write with at most `connections` open connections; Spark lowers the partition count to that."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=dbtable, driver=driver)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .mode(mode)
        .save()
    )
