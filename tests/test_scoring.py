"""Naive Bayes, measures, clusters, folds, splits and drift beside plain restatements, with hot groups, ties and nulls."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.ml import drift, insight, lloyd, metrics, models, naive_bayes, relations, ridge, splits


def close(a, b, tolerance=1e-9):
    return (a is None and b is None) or math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)


# Naive Bayes


@pytest.fixture(scope="module")
def messages(spark):
    r = random.Random(5)
    words = {"a": ["red", "blue", "sky", "the"], "b": ["one", "two", "three", "the"], "c": ["cat", "dog", "the", "sky"]}
    rows = [(i, label := r.choice("aaaaab" if i % 3 else "c"), " ".join(r.choice(words[label]) for _ in range(r.randint(0, 6))).title()) for i in range(400)]
    rows += [(900, None, "red red"), (901, "a", None), (902, "b", ""), (903, None, "never seen"), (904, None, None)]
    return spark.createDataFrame(rows, "id long, label string, text string").repartition(5)


def bayes_brute(rows):
    counts, sizes = defaultdict(Counter), Counter()
    for r in rows:
        if r["label"] is not None and r["text"] is not None:
            sizes[r["label"]] += 1
            counts[r["label"]].update(w for w in r["text"].lower().split())
    vocabulary = set().union(*counts.values())
    unit = lambda x: round(math.log(x) * 10**9)
    out = {}
    for r in rows:
        words = [w for w in (r["text"] or "").lower().split() if w in vocabulary]
        scores = []
        for c in sizes:
            unseen = -unit(sum(counts[c].values()) + len(vocabulary))
            scores.append((-(unit(sizes[c]) - unit(sum(sizes.values())) + len(words) * unseen + sum(unit(counts[c][w] + 1) for w in words)), c))
        scores.sort()
        most = min(sizes, key=lambda c: (-sizes[c], c))
        out[r["id"]] = (scores[0][1], scores[1][0] - scores[0][0]) if words else (most, None)
    return out


def test_naive_bayes_is_brute_force(messages):
    model = naive_bayes.fit(messages, "label", "text")
    got = {r["id"]: (r["predicted"], r["margin"]) for r in naive_bayes.predict(messages, ["id"], "text", model).collect()}
    want = bayes_brute(messages.collect())
    assert got.keys() == want.keys() and all(g[0] == want[i][0] and close(g[1], want[i][1], 1e-6) for i, g in got.items())


def test_words_that_speak_for_a_class(messages):
    model = naive_bayes.fit(messages, "label", "text")
    tf = naive_bayes.term_counts(messages, ["id"], "text")
    found = naive_bayes.predict(messages, ["id"], "text", model)
    words = naive_bayes.word_contributions(tf, ["id"], found, model, 2).where("place = 1 and contribution > 0").collect()
    own = {"a": {"red", "blue", "sky"}, "b": {"one", "two", "three"}, "c": {"cat", "dog", "sky"}}
    # A text of shared words only has nothing better to show.
    assert len(words) > 200 and sum(r["term"] in own[r["predicted"]] for r in words) > 0.9 * len(words)


def test_naive_bayes_without_rows(messages):
    model = naive_bayes.fit(messages.where("label is null"), "label", "text")
    assert all(r["predicted"] is None for r in naive_bayes.predict(messages, ["id"], "text", model).collect())


# Measures


@pytest.fixture(scope="module")
def scored(spark):
    r = random.Random(2)
    rows = [("hot" if i % 4 else r.choice("xyz"), r.choice([0, 0.25, 0.5, 0.5, 0.5, round(r.random(), 2), 1]), int(r.random() < 0.4)) for i in range(1500)]
    rows += [("one", 0.5, 1), ("one", 0.7, 1), ("hot", None, 1), ("hot", 0.3, None), (None, 0.2, 1), (None, 0.1, 0)]
    return spark.createDataFrame([(g, None if s is None else float(s), y) for g, s, y in rows], "g string, score double, y int").repartition(6)


def test_ranking_is_all_pairs(scored):
    groups = defaultdict(list)
    for r in scored.collect():
        if r["score"] is not None and r["y"] is not None:
            groups[r["g"]].append((r["score"], r["y"]))
    got = {r["g"]: r for r in metrics.binary_metrics(scored, ["g"], "score", "y").collect()}
    assert got.keys() == groups.keys()
    for g, rows in groups.items():
        pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
        area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)) if pos and neg else None
        tp, fp = sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)
        r = got[g]
        assert close(r["auc"], area) and r["n"] == len(rows) and r["positives"] == len(pos)
        assert close(r["precision"], tp / (tp + fp) if tp + fp else None) and close(r["recall"], tp / len(pos)) and close(r["f1"], 2 * tp / (tp + fp + len(pos)))
        clip = lambda p: min(max(p, 1e-15), 1 - 1e-15)
        assert close(r["log_loss"], -sum(math.log(clip(s) if y else 1 - clip(s)) for s, y in rows) / len(rows))
        assert close(r["brier"], sum((s - y) ** 2 for s, y in rows) / len(rows))
        at = sorted({s for s, _ in rows}, reverse=True)
        precision = sum(sum(y for s2, y in rows if s2 == s) * sum(y for s2, y in rows if s2 >= s) / sum(s2 >= s for s2, _ in rows) for s in at) / len(pos)
        assert close(r["average_precision"], precision)


def test_measures_of_everything_and_nothing(scored):
    whole = metrics.binary_metrics(scored, [], "score", "y").collect()
    assert len(whole) == 1 and "_all" not in whole[0].asDict()
    assert metrics.binary_metrics(scored.where("false"), [], "score", "y").count() == 0


def test_a_frequent_score_is_one_row_before_the_sort(spark):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 200_000).alias("score"), (F.col("id") % 2).alias("y"))
    counts = metrics.score_counts(rows, [], "score", "y").where("score = 0.5").collect()
    assert len(counts) == 1 and counts[0]["pos"] + counts[0]["neg"] >= 66_000
    assert close(metrics.binary_metrics(rows, [], "score", "y").first()["auc"], 0.5, 1e-2)


def test_regression_and_class_measures(spark):
    r = random.Random(8)
    rows = [(g := r.choice("aab"), x := r.uniform(0, 9), 3 * x + r.uniform(-1, 1) + 1e6) for _ in range(300)]
    got = {m["g"]: m for m in metrics.regression_metrics(spark.createDataFrame([(g, 3 * x + 1e6, y) for g, x, y in rows], "g string, v double, y double"), ["g"], "v", "y").collect()}
    for g in "ab":
        own = np.array([(3 * x + 1e6, y) for h, x, y in rows if h == g])
        error = own[:, 1] - own[:, 0]
        assert close(got[g]["rmse"], np.sqrt((error**2).mean()), 1e-6) and close(got[g]["mae"], np.abs(error).mean(), 1e-6)
        assert close(got[g]["r2"], 1 - (error**2).sum() / ((own[:, 1] - own[:, 1].mean()) ** 2).sum(), 1e-6)
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] + [(None, "a")]
    m = metrics.class_metrics(spark.createDataFrame(pairs, "l string, p string"), "l", "p").first()
    f1 = {"a": 10 / 13, "b": 6 / 8, "c": 0}
    chance = (7 * 6 + 3 * 5 + 1 * 0) / 121
    assert m["n"] == 11 and close(m["accuracy"], 8 / 11) and close(m["macro_f1"], sum(f1.values()) / 3)
    assert close(m["weighted_f1"], (7 * f1["a"] + 3 * f1["b"]) / 11) and close(m["kappa"], (8 / 11 - chance) / (1 - chance))


# Clusters


def test_lloyd_finds_planted_clusters(spark):
    r = random.Random(3)
    centres = [(0, 0), (1000, 0), (0, 1000)]
    rows = [(i, [c + r.randint(-60, 60) for c in centres[0 if i % 3 else r.randint(0, 2)]]) for i in range(600)]
    df = spark.createDataFrame([*rows, (9999, None)], "id long, x array<long>").repartition(7)
    found = lloyd.lloyd(df, "id", [2, 3, 4], 8)
    again = lloyd.lloyd(df.repartition(3).orderBy(F.desc("id")), "id", [2, 3, 4], 8)
    assert sorted(map(tuple, found.select("k", "number", F.col("at").cast("string")).collect())) == sorted(map(tuple, again.select("k", "number", F.col("at").cast("string")).collect()))
    moments = {m["k"]: m for m in lloyd.cluster_moments(df, "id", found, [2, 3, 4]).collect()}
    assert max(moments, key=lambda k: moments[k]["silhouette"]) == 3 and moments[3]["n"] == 600
    at = {c["number"]: c["at"] for c in found.where("k = 3").collect()}
    want = sum(min(sum((p - q) ** 2 for p, q in zip(x, c, strict=True)) for c in at.values()) for _, x in rows)
    assert moments[3]["cost"] == want


def test_clusters_of_few_and_equal_rows(spark):
    same = spark.createDataFrame([(i, [5, 5]) for i in range(20)], "id long, x array<long>")
    found = lloyd.lloyd(same, "id", [3], 2)
    m = lloyd.cluster_moments(same, "id", found, [3]).first()
    assert (m["n"], m["cost"], m["silhouette"], m["largest"]) == (20, 0, 0.0, 20)
    assert lloyd.far_rows(same, "id", found, 3, 2.0).count() == 0
    two = spark.createDataFrame([(1, [0, 0]), (2, [9, 9])], "id long, x array<long>")
    assert lloyd.lloyd(two, "id", [5], 2).count() == 2


def test_whole_vectors(spark):
    df = spark.createDataFrame([(1, 0, 7), (2, 50, 7), (3, 99, 7), (4, None, 7)], "id long, a long, b long")
    got = {r["id"]: r["x"] for r in lloyd.whole_vectors(df, "id", ["a", "b"], 100).collect()}
    assert got == {1: [0, 0], 2: [50, 0], 3: [100, 0], 4: None}


# Ridge


def test_ridge_folds_are_separate_fits(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(500, 3)) * [1, 10, 0.1] + [5, 1000, 0]
    y = x @ [2, -1, 30] + r.normal(size=500) + 7
    rows = [(int(i % 4), *map(float, x[i]), 1.0, float(y[i])) for i in range(500)] + [(0, None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "f int, a double, b double, c double, flat double, y double").repartition(5)
    grid = {(g["fold"], g["penalty"]): g for g in ridge.ridge_grid(df, F.col("f"), ["a", "b", "c", "flat"], "y", [0.0, 0.5]).collect()}
    assert len(grid) == 8
    for (fold, penalty), g in grid.items():
        held = np.arange(500) % 4 == fold
        train, mean, spread = x[~held], x[~held].mean(0), x[~held].std(0)
        z = (train - mean) / spread
        w = np.linalg.solve(z.T @ z / len(z) + penalty * np.eye(3), z.T @ (y[~held] - y[~held].mean()) / len(z)) / spread
        b = y[~held].mean() - w @ mean
        assert np.allclose(g["weights"][:3], w, rtol=1e-5) and g["weights"][3] == 0 and g["n_test"] == held.sum()
        assert close(g["mse"], ((y[held] - x[held] @ w - b) ** 2).mean(), 1e-4)
    assert ridge.best_penalty(spark.createDataFrame(list(grid.values()))).first()["penalty"] == 0.0


# Splits


def test_best_splits_are_all_tried(spark):
    r = random.Random(6)
    rows = [(i % 2, r.choice([1, 1, 1, 2, 3, 7]), r.random(), r.choice(["u", "v", "w"])) for i in range(500)]
    rows = [(g, a, b, "u" if b > 0.6 else y, 4) for g, a, b, y in rows] + [(0, None, 0.5, "u", 4), (1, 1, None, "v", 4), (1, 1, 0.2, "other", 4)]
    df = spark.createDataFrame(rows, "g int, a int, b double, y string, flat int").repartition(4)

    def impurity(ys):
        return 1 - sum((n / len(ys)) ** 2 for n in Counter(ys).values())

    got = {(s["g"], s["feature"]): s for s in splits.best_splits(df, ["a", "b", "flat"], "y", ["u", "v", "w"], ["g"]).collect()}
    assert set(got) == {(g, f) for g in (0, 1) for f in ("a", "b")}
    for (g, f), s in got.items():
        own = [((row[1] if f == "a" else row[2]), row[3]) for row in rows if row[0] == g and row[3] != "other" and (row[1] if f == "a" else row[2]) is not None]
        best = None
        for v in sorted({x for x, _ in own})[:-1]:
            left, right = [y for x, y in own if x <= v], [y for x, y in own if x > v]
            gain = impurity([y for _, y in own]) - (len(left) * impurity(left) + len(right) * impurity(right)) / len(own)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, v, len(left), len(right))
        assert close(s["gain"], best[0], 1e-8) and (s["value"], s["n_left"], s["n_right"]) == best[1:]
    assert got[0, "b"]["place"] == 1


def test_splits_agree_with_a_forest(spark):
    from millrace.operators.privacy import synth_rows

    rows = synth_rows(spark.range(2000), "id", 3).withColumn("label", F.col("large").cast("double"))
    first = splits.best_splits(rows, ["age", "balance"], "large", [0, 1]).where("place = 1").first()["feature"]
    model = models.fit(rows, models.feature_stages([], ["age", "balance"], scale=False), models.forest(numTrees=5))
    weights = insight.weights(model, ["age", "balance"]).orderBy(F.desc("weight")).first()
    assert first == weights["feature"] == "balance"


# Drift


def test_drift_with_bins_of_the_data(spark):
    r = random.Random(1)
    a = [(r.choice([0.0, 0.0, 0.0, r.gauss(5, 2)]), 1) for _ in range(900)] + [(None, 1)] * 5
    b = [(r.gauss(7, 2), 1) for _ in range(700)]
    ref, cur = (spark.createDataFrame(rows, "v double, one int").repartition(3) for rows in (a, b))
    values = sorted(v for v, _ in a if v is not None)
    edges = sorted({values[(len(values) - 1) * i // 10] for i in range(1, 10)})
    found = {(d["feature"], d["bin"]): d for d in drift.numeric_drift(ref, cur, ["v", "one"]).collect()}
    for side, name in ((a, "n_ref"), (b, "n_cur")):
        counts = Counter(-1 if v is None else sum(e < v for e in edges) for v, _ in side)
        assert {k[1]: d[name] for k, d in found.items() if k[0] == "v" and d[name]} == counts
    assert [d["psi_part"] for k, d in found.items() if k[0] == "one"] == [0.0]
    merged = sorted({v for v, _ in a + b if v is not None})
    x, y = np.array(values), np.array(sorted(v for v, _ in b))
    gaps = [abs((x <= v).mean() - (y <= v).mean()) for v in merged]
    ks = {d["feature"]: d for d in drift.ks_distance(ref, cur, ["v", "one"]).collect()}
    assert close(ks["v"]["distance"], max(gaps)) and ks["v"]["at"] == merged[int(np.argmax(np.round(gaps, 12)))] and ks["one"]["distance"] == 0
    assert drift.ks_distance(ref.where("false"), cur.where("false"), ["v"]).count() == 0


# Explanations of sparse models


@pytest.mark.parametrize("classes", [2, 3])
def test_sparse_contributions_add_up(spark, classes):
    r = random.Random(classes)
    words = [["red", "blue", "sky"], ["one", "two", "six"], ["cat", "dog", "cow"]]
    rows = [(i, c := i % classes, " ".join(r.choice(words[c] + ["the"]) for _ in range(8))) for i in range(200)]
    df = spark.createDataFrame([(i, float(c), t) for i, c, t in rows] + [(900, 0.0, "")], "id long, label double, text string")
    model = models.fit(df, models.text_stages("text", 1 << 10), models.logistic(regParam=0.1, maxIter=10))
    pred = model.transform(df)
    both = insight.explained_margins(pred, model.stages[-1], "id").collect()
    assert len(both) == 201 * classes and all(close(b["explained"], b["margin"], 1e-8) for b in both)
    slots = insight.class_contributions(pred, model.stages[-1], "id")
    assert slots.where("value = 0").count() == 0 and slots.groupBy("id").count().agg(F.max("count")).first()[0] <= 8 * classes


def test_documents_are_counted_while_their_words_are(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "b"), (3, ""), (4, None), (5, "9 9")], "id long, text string")
    got = {(r["id"], r["term"]): r["tfidf"] for r in relations.tfidf(docs, "id", "text").collect()}
    assert got.keys() == {(1, "a"), (1, "b"), (2, "b")} and close(got[1, "b"], 2 * math.log(6 / 3)) and close(got[1, "a"], math.log(6 / 2))


# Slots of vectors


def test_slots_of_any_vector(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as S

    r = random.Random(4)
    rows, want = [(-1, None), (-2, Vectors.sparse(5, [], [])), (-3, Vectors.dense([0.0, 2.5, 0.0, -1.0])), (-4, Vectors.sparse(9, [2, 7], [0.0, 3.0]))], []
    want += [(-3, 1, 2.5), (-3, 3, -1.0), (-4, 7, 3.0)]
    for i in range(3000):
        cells = {r.randrange(50): float(r.randint(-2, 2)) for _ in range(r.randrange(6))}
        rows.append((i, Vectors.sparse(50, cells) if i % 3 else Vectors.dense([cells.get(k, 0.0) for k in range(50)])))
        want += [(i, k, v) for k, v in cells.items() if v]
    df = spark.createDataFrame(rows, S.StructType([S.StructField("id", S.LongType()), S.StructField("x", VectorUDT())])).coalesce(1)
    found = insight.sparse_slots(df, "id", "x")
    assert found.columns == ["id", "slot", "value"]
    assert sorted(tuple(x) for x in found.collect()) == sorted(want)


def test_slots_need_little_memory():
    import tracemalloc

    import pyarrow as pa

    n, width = 10_000, 100
    ends = pa.array(np.arange(0, n * width + 1, width, dtype="i4"))
    cells = {"type": pa.array(np.zeros(n, "i1")), "size": pa.array(np.full(n, 4096, "i4"))}
    cells |= {"indices": pa.ListArray.from_arrays(ends, pa.array(np.arange(n * width, dtype="i4") % 4096)), "values": pa.ListArray.from_arrays(ends, pa.array(np.ones(n * width)))}
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.StructArray.from_arrays(list(cells.values()), names=list(cells))], names=["id", "x"])
    tracemalloc.start()
    try:
        assert sum(len(out) for out in insight._slots(iter([batch]))) == n * width
        assert tracemalloc.get_traced_memory()[1] < 20 << 20  # one object for each slot took over 100 MB
    finally:
        tracemalloc.stop()
