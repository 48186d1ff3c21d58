import glob
import time

import pytest
from pyspark.sql import functions as F

from millrace.session import CHECKPOINT_CONF, CLEANUP_CONF, scratch_dir, scratch_root, settle
from millrace.sources import jdbc, sinks, tabular, text


def test_scratch_is_the_shared_folder(spark):
    assert scratch_root(spark) == spark.conf.get(CHECKPOINT_CONF)
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


def test_settle_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("part", F.spark_partition_id())
    kept = settle(df, "t")
    assert kept.columns == df.columns and kept.count() == 10


def test_settle_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for d in disk.localDirsString() for x in glob.glob(f"{d}/*/shuffle_*")}
    before = shuffled()
    sums = spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).count()
    settled = settle(sums.join(spark.range(5_000).withColumnRenamed("id", "k").repartition(3, "k"), "k"), "sums")
    for _ in range(50):  # executors remove them after the write
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert settled.count() == 5_000 and spark.conf.get(CLEANUP_CONF) == "false"


def test_csv_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,day,name\n1,2024-01-02,"x, y"\nbad,2024-01-03,z\n3,not a day,\n')
    rows = tabular.read_csv(spark, str(tmp_path), "id long, day date, name string").orderBy("_corrupt_record").collect()
    assert [r["_corrupt_record"] for r in rows] == [None, "3,not a day,", "bad,2024-01-03,z"]
    assert rows[0]["name"] == "x, y" and rows[2]["id"] is None and rows[2]["name"] == "z"
    dropped = tabular.read_csv(spark, str(tmp_path), "id long, day date, name string", "DROPMALFORMED")
    assert [r["id"] for r in dropped.collect()] == [1]


def test_inferred_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,price,name\n1,2.5,x\n2,3,y\n")
    got = tabular.infer_csv_schema(spark, str(tmp_path)).orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in got] == [("id", "int"), ("price", "double"), ("name", "string")]


def test_json_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\nnot json\n')
    rows = tabular.read_json(spark, str(tmp_path), "id long").collect()
    assert sorted((r["id"] or 0, r["_corrupt_record"] or "") for r in rows) == [(0, "not json"), (1, "")]


def test_envelope_with_a_bad_payload(spark):
    rows = spark.createDataFrame([(b"k", b'{"id": 7}', "t", 0, 1), (b"k", b"oops", "t", 0, 2)], "key binary, value binary, topic string, partition int, offset long")
    got = tabular.decode_envelope(rows.withColumn("timestamp", F.current_timestamp()), "id long").orderBy("offset").collect()
    assert [(r["id"], r["malformed"]) for r in got] == [(7, False), (None, True)]


def test_partitioned_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, y int"), path, ["y"])
    sinks.write_partitioned(spark.createDataFrame([(9, 2021)], "v int, y int"), path, ["y"])
    assert sorted((r["v"], r["y"]) for r in spark.read.parquet(path).collect()) == [(1, 2020), (9, 2021)]


def test_jdbc_ranges():
    assert jdbc.partition_options("id", 1, 100, 8) == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.partition_options("id", 5, 1, 8)


def test_trees_of_many_folders_are_listed_and_read_by_few_tasks(spark, tmp_path):
    for i in range(600):
        (tmp_path / f"doc_id={i}").mkdir()
        (tmp_path / f"doc_id={i}" / "part.txt").write_text(f"text {i}")
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    sc.setJobGroup("listing", "listing")
    try:
        files, held = text.scan_text_tree(spark, str(tmp_path), "*.txt"), text.file_inventory(spark, str(tmp_path))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and all(s.numTasks <= 4 * sc.defaultParallelism for s in stages if s)
    with text.small_files(spark):
        assert files.rdd.getNumPartitions() <= sc.defaultParallelism + 1
        assert sorted(r["value"] for r in files.collect()) == sorted(f"text {i}" for i in range(600))
    assert held.where("length between 6 and 8").count() == 600


def test_folders_of_text_are_those_of_spark(spark, tmp_path):
    rows = [("a b", 1, "one\n\u00e9"), ("a b", 2, ""), ("x/y=%1:[z]", 3, None), (None, 4, "four"), ("", 5, "five"), ("a b", None, "six"), ("a b", 1, "one\n\u00e9")]
    df = spark.createDataFrame(rows, "source string, doc_id long, value string").repartition(3, "source", "doc_id")
    sinks.write_text_folders(df, f"file://{tmp_path}/ours", ["source", "doc_id"], "\0")
    df.write.partitionBy("source", "doc_id").option("lineSep", "\0").text(f"{tmp_path}/spark")
    ours, theirs = (sorted((str(f.parent.relative_to(tmp_path / t)), f.read_bytes()) for f in (tmp_path / t).rglob("*=*/part-*.txt")) for t in ("ours", "spark"))
    assert ours == theirs and len(ours) == 6
    assert not [f for f in (tmp_path / "ours").rglob(".*") if f.is_file()]
    sinks.write_text_folders(df.where("false"), f"{tmp_path}/none", ["source", "doc_id"], "\0")
    assert text.scan_text_tree(spark, f"{tmp_path}/none", "*.txt").count() == 0


def test_many_folders_of_text_start_no_process_each(spark, tmp_path):
    def started():
        with open("/proc/stat") as f:
            return int(next(line for line in f if line.startswith("processes")).split()[1])

    df = spark.range(2000).select(F.lit("s").alias("source"), F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("value"))
    before = started()
    sinks.write_text_folders(df, str(tmp_path / "t"), ["source", "doc_id"], "\0")
    assert started() - before < 2000
    assert text.file_inventory(spark, str(tmp_path / "t")).count() == 2000
