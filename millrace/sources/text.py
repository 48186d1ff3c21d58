"""Reading trees of text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import setting

# Spark lists each crowded folder with up to 10,000 tasks, and weighs an opened file like 4 MB of content, 32 files to a task.
LISTING_CONF, OPENING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"


def _listed(spark: SparkSession, reader: DataFrameReader, path: str) -> DataFrame:
    """The files below a folder, listed by a few tasks a core: listing many folders costs their number and not that of tasks."""
    with setting(spark, LISTING_CONF, str(4 * spark.sparkContext.defaultParallelism)):
        return reader.option("recursiveFileLookup", "true").load(path)


def small_files(spark: SparkSession):
    """A block in which what runs reads about 2,000 small files in a task."""
    return setting(spark, OPENING_CONF, "65536")


def _local_part(uri: Column) -> Column:
    """A file address without scheme, host and percent encoding."""
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, r"^[^:/]+:(//[^/]*)?", "")


def scan_text_tree(spark: SparkSession, path: str, glob: str = "*.md", exclude: Sequence[str] = ()) -> DataFrame:
    """Whole text files below a folder as (path, value), lines ending in a newline.

    Files below an excluded folder are filtered on their metadata, before their
    text is used. Rows have no order; reports sort by path.
    """
    files = _listed(spark, spark.read.format("text").option("wholetext", "true").option("pathGlobFilter", glob), path)
    named = files.select(_local_part(F.col("_metadata.file_path")).alias("path"), "value")
    kept = named.where(~T.has_part(F.col("path"), exclude))
    return kept.select("path", T.normalize_newlines(F.col("value")).alias("value"))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder as (path, length). Their content is not read."""
    files = _listed(spark, spark.read.format("binaryFile"), path)
    return files.select(_local_part(F.col("_metadata.file_path")).alias("path"), "length")
