"""Typed reading of row and column formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

CORRUPT = "_corrupt_record"
# JSON text drops below milliseconds unless told otherwise.
MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _schema(schema: S.StructType | str) -> S.StructType:
    return S.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(spark: SparkSession, path: str, schema: S.StructType | str, mode: str = "PERMISSIVE", header: bool = True) -> DataFrame:
    """CSV with a fixed schema. In PERMISSIVE mode a bad row keeps its text in _corrupt_record."""
    wanted = _schema(schema)
    if mode.upper() == "PERMISSIVE" and CORRUPT not in wanted.fieldNames():
        wanted = S.StructType([*wanted.fields, S.StructField(CORRUPT, S.StringType())])
    return (
        spark.read.schema(wanted)
        .option("header", header)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", "false" if header else "true")
        .csv(path)
    )


def infer_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """(position, column, type) as Spark infers them; a look at raw data, not a way to load it."""
    fields = (
        spark.read.option("header", True).option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path).schema
    )
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "position int, column string, type string")


def read_json(spark: SparkSession, path: str, schema: S.StructType | str, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON lines with a fixed schema; bad lines stay in _corrupt_record."""
    wanted = _schema(schema)
    if mode.upper() == "PERMISSIVE" and CORRUPT not in wanted.fieldNames():
        wanted = S.StructType([*wanted.fields, S.StructField(CORRUPT, S.StringType())])
    return spark.read.schema(wanted).option("mode", mode).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_orc(spark: SparkSession, path: str, schema: S.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(_schema(schema))
    return reader.orc(path)


def decode_envelope(records: DataFrame, schema: S.StructType | str, payload: str = "value") -> DataFrame:
    """Message-bus records (key, value, topic, partition, offset, timestamp) to typed rows.

    Key and value are bytes with a JSON payload. The same call works on a
    stream. A payload that is no JSON object gives null fields and malformed = true.
    """
    text = F.col(payload).cast("string")
    body = F.from_json(text, _schema(schema), {"mode": "PERMISSIVE"})
    opened = records.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("bus_time"),
        F.get_json_object(text, "$").isNull().alias("malformed"),
        body.alias("body"),
    )
    return opened.select("key", "topic", "partition", "offset", "bus_time", "malformed", "body.*")


def to_envelope(rows: DataFrame, topic: str, key: Column, partition: Column, offset: Column, timestamp: Column) -> DataFrame:
    """Rows as message-bus records, the shape that decode_envelope reads."""
    return rows.select(
        key.cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*rows.columns), MICROS).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.alias("timestamp"),
    )
