"""The registered queries of the subpackage and the stages of the pipeline."""

import check
import corpus_pipeline
import pytest

from millrace.llm import ngram_join, secret_scan
from millrace.llm.queries import ORACLES, QUERIES
from millrace.session import settle, table


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sf_dir, name):
    _, _, verdict = check.compare(spark, check.twin_connection(sf_dir), sf_dir, name, QUERIES[name], ORACLES[name])
    assert verdict == "ok"


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    odd = [(None, "no id here at all", "en", "src0", 17), (10**6, None, "en", "src0", None), (10**6 + 1, "12 | 34", None, None, 7), (10**6 + 2, 'token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72"', "en", "src0", 50)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.limit(5))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, docs, sf_dir), "stage")
        kept.append(docs.count())
        if name != "packing":
            assert docs.columns == before.columns
    first, second, third, fourth, _ = kept
    # The two without letters go; the net of so small a table may be unsure of the short ones.
    assert before_rows(spark, sf_dir) + 5 <= first <= before_rows(spark, sf_dir) + 7 and second <= first and third == fourth == second


def before_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").count()


def test_groups_and_secrets_are_gone(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    single = settle(corpus_pipeline.one_of_each_group(spark, docs, sf_dir), "single")
    groups = ngram_join.similar_documents(docs)
    assert single.count() == groups.select("component_id").distinct().count()
    assert ngram_join.similar_documents(single).where("doc_id <> component_id").count() == 0
    clean = corpus_pipeline.without_secrets(spark, docs, sf_dir)
    found = secret_scan.scan_documents(clean)
    assert found.where("n_assign + n_access + n_hex + n_literal > 0").count() == 0 and clean.count() == docs.count()


def test_empty_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir), "empty")
        assert docs.count() == 0


def test_one_row_of_each_group_whatever_the_ids(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(60)) for k in "abcd")
    near = a.rsplit(" ", 1)[0] + " other"
    rows = [
        (1, a, 1), (2, a, 2), (None, a, 3), (None, near, 4),  # one group with ids
        (None, b, 5), (None, b, 6), (None, b + " more", 7),  # one without
        (1, c, 8), (3, c, 9), (1, d, 10), (1, d, 11),  # ids that lead several groups
        (4, None, 12), (4, None, 13), (5, "", 14), (None, None, 15),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key long").repartition(3)
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, (r["text"] or "")[:1]) for r in got.collect())
    assert kept == [(0, ""), (0, "b"), (1, "a"), (1, "c"), (1, "d"), (4, ""), (5, "")]
