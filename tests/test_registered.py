"""Every registered query at the smallest scale, next to its SQL twin."""

import check
import pytest

from millrace.plans import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()
# These learn from 70 rows at this scale, too few to promise more than chance.
SMALL = {"m2_logistic", "m3_forest", "m4_boosted_trees", "m8_text_classifier", "m5_forest_regression", "m19_language_classifier"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.twin_connection(sf_dir)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    if name in SMALL:
        row = QUERIES[name](spark, sf_dir).first()
        assert (row["n_train"], row["n_test"]) == con.sql(ORACLES[name]).fetchall()[0][:2]
        return
    _, rows, verdict = check.compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
    assert verdict.split()[0] in ("ok", "rows"), verdict
