"""Analysis of web access logs in the common log format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_LINE = r'^(\S+) \S+ \S+ \[([^\]]+)\] "([A-Z]+) (\S+) [^"]*" (\d{3}) (\d+|-)$'
_CUT = "\u0001"


def parse_access_log(lines: DataFrame, column: str = "line") -> DataFrame:
    """Lines to (ip, ts, method, path, status, bytes, malformed).

    Each line is matched once: the pattern rewrites it with a separator between
    the fields. A line that does not match keeps its row, with nulls.
    """
    template = _CUT.join(f"${i}" for i in range(1, 7))
    fields = lines.select(F.split(F.regexp_replace(column, LOG_LINE, template), _CUT).alias("f"))
    good = F.size("f") == 6

    def field(i: int):
        return F.when(good, F.get("f", i))

    return fields.select(
        field(0).alias("ip"),
        F.try_to_timestamp(field(1), F.lit("dd/MMM/yyyy:HH:mm:ss Z")).alias("ts"),
        field(2).alias("method"),
        field(3).alias("path"),
        field(4).cast("int").alias("status"),
        F.when(field(5) != "-", field(5)).cast("long").alias("bytes"),
        (~good).alias("malformed"),
    )


def top_ips(log: DataFrame, n: int) -> DataFrame:
    counts = log.where("ip is not null").groupBy("ip").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "ip").limit(n)


def status_counts(log: DataFrame) -> DataFrame:
    """Rows per status; malformed lines are counted under a null status."""
    return log.groupBy("status").agg(F.count("*").alias("n"))


def mean_length(log: DataFrame) -> DataFrame:
    return log.agg(F.round(F.avg("bytes"), 4).alias("mean_bytes"), F.count("bytes").alias("n"))
