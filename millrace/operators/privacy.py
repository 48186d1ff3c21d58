"""Operations on personal data and evidence about data sets."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from millrace.operators.evidence import row_digest
from millrace.session import settle
from millrace.sources.sinks import balanced

PSEUDONYM_KEY_CONF = "spark.millrace.pseudonym.key"


def pseudonym_key(spark: SparkSession) -> str:
    """The secret key from the session's configuration; there is no default."""
    key = spark.conf.get(PSEUDONYM_KEY_CONF, None)
    if not key:
        raise ValueError(f"set {PSEUDONYM_KEY_CONF}")
    return key


def pseudonymize(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Replace columns by their HMAC-SHA256. Equal values stay equal, so joins survive; nulls stay null."""
    block = key.encode()
    block = (hashlib.sha256(block).digest() if len(block) > 64 else block).ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(b ^ pad for b in block)) for pad in (0x36, 0x5C))

    def keyed(value: Column) -> Column:
        digest = F.unhex(F.sha2(F.concat(inner, F.encode(value.cast("string"), "utf-8")), 256))
        return F.sha2(F.concat(outer, digest), 256)

    return df.withColumns({c: keyed(F.col(c)) for c in columns})


def anonymize(df: DataFrame, quasi: Mapping[str, Column], k: int) -> DataFrame:
    """Generalise the quasi-identifiers and suppress rows whose group has fewer than k members."""
    general = df.withColumns(dict(quasi))
    names = list(quasi)
    groups = general.groupBy(*names).agg(F.count("*").alias("_n")).where(F.col("_n") >= k)
    groups = groups.select(*[F.col(c).alias(f"_{c}") for c in names])
    match = F.lit(True)
    for c in names:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return general.join(groups, match, "left_semi")


@dataclass(frozen=True)
class Linked:
    """A table of a subject: its key column, or the parent table it hangs on."""

    df: DataFrame
    column: str
    parent: str | None = None
    parent_key: str | None = None


def erase_subjects(tables: Mapping[str, Linked], ids: DataFrame, id_column: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write all linked tables without the subjects' rows; parents stand before their children.

    Gives the written tables and a proof (table, rows_before, rows_erased, rows_left_of_subjects). Rows
    erased and rows left are counted in what was written, read back: the former against the table as it
    was, the latter by the keys to erase. The keys of a level are written once and serve all its children.
    """
    keys_of: dict[tuple, DataFrame] = {}
    kept: dict[str, DataFrame] = {}
    counts = []

    def doomed(parent: str | None, column: str) -> DataFrame:
        if (parent, column) not in keys_of:
            if parent is None:
                found = ids.select(F.col(column).alias("_k"))
            else:
                above = tables[parent]
                mine = doomed(above.parent, id_column if above.parent is None else above.parent_key)
                found = above.df.join(mine, F.col(above.column) == F.col("_k"), "left_semi").select(F.col(column).alias("_k"))
            keys_of[parent, column] = settle(found.where("_k is not null").distinct(), f"erased-keys-{len(keys_of)}")
        return keys_of[parent, column]

    for name, t in tables.items():
        keys = doomed(t.parent, id_column if t.parent is None else t.parent_key)
        same = F.col(t.column) == F.col("_k")
        kept[name] = settle(t.df.join(keys, same, "left_anti"), f"erased-{name}")
        for df, before, written, left in (
            (t.df, 1, 0, 0), (kept[name], 0, 1, 0), (kept[name].join(keys, same, "left_semi"), 0, 0, 1),
        ):
            n = F.count("*")
            counts.append(df.agg(F.lit(name).alias("table"), (n * before).alias("before"), (n * written).alias("written"), (n * left).alias("left")))
    proof = reduce(DataFrame.unionByName, counts).groupBy("table").agg(*[F.sum(c).alias(c) for c in ("before", "written", "left")])
    return kept, proof.select(
        "table", F.col("before").alias("rows_before"), (F.col("before") - F.col("written")).alias("rows_erased"),
        F.col("left").alias("rows_left_of_subjects"),
    )


def rewrite_affected(df: DataFrame, column: str, ids: DataFrame, id_column: str, partition: str, path: str) -> DataFrame:
    """Write the remaining rows of the partitions that hold a subject, and only of those.

    Gives (partition, rows_before, rows_after), the latter counted in the written
    files, so that the caller swaps these folders in and drops the ones with no row left.
    """
    keys = ids.select(F.col(id_column).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    flagged = df.join(keys, F.col(column) == F.col("_k"), "left").drop("_k")
    affected = settle(
        flagged.groupBy(partition).agg(F.count("*").alias("rows_before"), F.count("_hit").alias("_hits")).where("_hits > 0").drop("_hits"),
        "affected",
    )
    kept = flagged.where("_hit is null").drop("_hit").join(affected.select(partition), partition, "left_semi")
    balanced(kept, [partition]).write.partitionBy(partition).parquet(path)
    written = df.sparkSession.read.schema(kept.schema).parquet(path).groupBy(partition).agg(F.count("*").alias("rows_after"))
    return affected.join(written, partition, "left").na.fill(0, ["rows_after"])


def consent_filter(df: DataFrame, subject: str, at: str, consents: DataFrame) -> DataFrame:
    """Rows whose subject had a consent in force at the row's time (valid_from <= at < valid_to).

    Overlapping or repeated consents never double a row.
    """
    c = consents.select(F.col("subject").alias("_s"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")).distinct()
    in_force = (F.col(subject) == F.col("_s")) & (F.col(at) >= F.col("_from"))
    in_force = in_force & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    return df.join(c, in_force, "left_semi")


@dataclass(frozen=True)
class Policy:
    """What a role sees: masked text columns, hidden columns and the column its rows are chosen by."""

    masked: Sequence[str] = field(default_factory=tuple)
    hidden: Sequence[str] = field(default_factory=tuple)
    row_key: str | None = None


def role_view(df: DataFrame, role: str, policy: Policy, grants: DataFrame) -> DataFrame:
    """The rows and columns a role may see. `grants` has (role, key): the row keys each role is granted."""
    if policy.row_key is not None:
        allowed = grants.where(F.col("role") == role).select(F.col("key").alias("_key"))
        df = df.join(allowed, F.col(policy.row_key) == F.col("_key"), "left_semi")
    for c in policy.masked:
        df = df.withColumn(c, F.mask(F.col(c)))
    for c in policy.hidden:
        df = df.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    return df


def fingerprint(df: DataFrame) -> DataFrame:
    """(n_rows, sum_a, sum_b): a digest of the rows that does not depend on their order.

    Rows are hashed over their columns in name order, each with its name and type, nulls apart
    from empty text; two 60-bit slices of each hash are summed.
    """

    hashed = df.select(row_digest(df).alias("h"))

    def slice_sum(start: int) -> Column:
        number = F.conv(F.substring("h", start, 15), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)").cast("string")

    return hashed.agg(F.count("*").alias("n_rows"), slice_sum(1).alias("sum_a"), slice_sum(16).alias("sum_b"))


def audit_log(df: DataFrame, path: str, run_id: str, actor: str, purpose: str) -> DataFrame:
    """Append one row on a read or a prediction run: who, why, when, how many rows, which data."""
    entry = fingerprint(df).select(
        F.lit(run_id).alias("run_id"),
        F.lit(actor).alias("actor"),
        F.lit(purpose).alias("purpose"),
        F.current_timestamp().alias("logged_at"),
        "n_rows",
        F.concat_ws(":", "sum_a", "sum_b").alias("fingerprint"),
    )
    entry.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(AUDIT_SCHEMA).parquet(path)


AUDIT_SCHEMA = S.StructType(
    [S.StructField(c, S.StringType()) for c in ("run_id", "actor", "purpose")]
    + [S.StructField("logged_at", S.TimestampType()), S.StructField("n_rows", S.LongType()), S.StructField("fingerprint", S.StringType())]
)

# What is redacted, in this order, and the mark that replaces it.
REDACTIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+",
    "ipv4": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "number": r"\b[0-9]{13,19}\b",
    "secret": r"(?i)\b(?:token|secret|password|api[_-]?key)\b\s*[:=]\s*[^\s]+",
}


def redact_text(df: DataFrame, column: str) -> DataFrame:
    """Replace personal data and secrets by marks, over the whole text, and count the hits of each kind."""
    text, out = F.col(column), {}
    for kind, pattern in REDACTIONS.items():
        out[f"n_{kind}"] = F.regexp_count(text, F.lit(pattern)).cast("long")
        text = F.regexp_replace(text, pattern, f"[{kind}]")
    return df.select("*", *[c.alias(n) for n, c in out.items()], text.alias("_t")).withColumn(column, F.col("_t")).drop("_t")


def synth_rows(keys: DataFrame, key: str, seed: int) -> DataFrame:
    """Synthetic customers for a relation of keys: every value is a hash of (seed, column, key).

    Equal seeds give equal rows on any cluster, in any partitioning. `large` is
    a planted label that depends on balance and age.
    """

    def draw(column: str, n: int) -> Column:
        text = F.md5(F.concat_ws("/", F.lit(str(seed)), F.lit(column), F.col(key).cast("string")))
        return F.conv(F.substring(text, 1, 12), 16, 10).cast("long") % n

    rows = keys.select(
        F.col(key).cast("long").alias("id"),
        (draw("age", 73) + 18).alias("age"),
        (draw("balance", 1_000_000) / 100).alias("balance"),
        F.element_at(F.array(*[F.lit(s) for s in ("north", "south", "east", "west")]), (draw("area", 4) + 1).cast("int")).alias("area"),
    )
    return rows.withColumn("large", (F.col("balance") + 50 * F.col("age") > 7500).cast("int"))
