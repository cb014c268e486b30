"""Boosted trees: cuts against brute force, gaps, categories, flags and joint classes."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.scoring import proba_normalize
from tidemark.models import boosting
from tidemark.models.boosting import FLAG, NOMINAL, NUMBER, Slot
from tidemark.models.mllib import assembler
from tidemark.models.registry import fit_model
from tidemark.operators.encode import categorical_features

SLOTS = [Slot(0, NUMBER, [1.0, 2.0], 4), Slot(1, NOMINAL, [], 5), Slot(2, FLAG, [], 2)]


def gain(g, h, all_g, all_h):
    if min(h, all_h - h) < boosting.LEAST_WEIGHT:
        return -math.inf
    part = lambda a, b: a * a / (b + boosting.PENALTY)
    return part(g, h) + part(all_g - g, all_h - h) - part(all_g, all_h)


@pytest.mark.parametrize("seed", range(12))
def test_cuts_equal_brute_force(seed):
    """Every cut of numbers with the gap on either side, every set of categories, the flag."""
    rng = np.random.default_rng(seed)
    n = 40
    bins = np.stack([rng.integers(seed % 2, 4, n), rng.integers(1, 5, n), rng.integers(0, 2, n)], 1)
    g, h = rng.normal(size=n), np.ones(n)
    rows = [(0, 1, s, b, g[bins[:, s] == b].sum(), float((bins[:, s] == b).sum())) for s in (0, 1) for b in set(bins[:, s])]
    rows += [(0, 1, 2, 1, g[bins[:, 2] == 1].sum(), float((bins[:, 2] == 1).sum())), (0, 1, 3, 0, g.sum(), float(n))]
    sums = pa.table(dict(zip(("output", "node", "slot", "bin", "g", "h"), map(list, zip(*rows)), strict=True)))
    ways = [(0, bins[:, 0] <= c) for c in range(4)] + [(0, (bins[:, 0] <= c) & (bins[:, 0] > 0)) for c in range(4)]
    ways += [(1, np.isin(bins[:, 1], part)) for k in (1, 2, 3) for part in itertools.combinations(range(1, 5), k)]
    ways.append((2, bins[:, 2] == 0))
    best = max(gain(g[left].sum(), float(left.sum()), g.sum(), float(n)) for _, left in ways)
    (found,) = boosting.search(sums, SLOTS)
    row = dict(zip((c.split()[0] for c in boosting.CUT.split(", ")), found, strict=True))
    assert row["gain"] == pytest.approx(best)
    left = np.array(boosting._side(SLOTS[row["slot"]], row))[bins[:, row["slot"]]]
    assert (g[left].sum(), left.sum()) == (pytest.approx(row["g"]), pytest.approx(row["h"]))


@pytest.mark.parametrize("high", [True, False])
def test_a_rule_that_hangs_on_the_gap_alone(spark, high):
    """One cut tells rows with a missing number from the others, with the gaps among low or high values."""
    rows = spark.range(400).select("id", F.when(F.col("id") % 4 > 0, F.rand(1)).alias("x"))
    rows = rows.withColumn("y", F.when(F.col("x").isNull() == high, 5.0).otherwise(1.0))
    fitted = fit_model("xgboost_regression", rows, ["x"], "y", n_estimators=60, max_depth=1, learning_rate=0.5)
    assert all(len(cuts) == 1 for _, cuts, _ in fitted.meta["trees"])
    assert fitted.score(rows).agg(F.max(F.abs(F.col("prediction") - F.col("y"))).alias("off")).first()["off"] < 0.05


def test_a_gap_goes_with_the_values_it_behaves_like(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") % 3 > 0, F.col("id") / 600).alias("x"))
    rows = rows.withColumn("y", F.when(F.col("x").isNull() | (F.col("x") > 0.5), 1.0).otherwise(0.0))
    fitted = fit_model("xgboost_regression", rows, ["x"], "y", n_estimators=1, learning_rate=1.0, max_depth=1)
    (cut,) = fitted.meta["trees"][0][1].values()
    assert cut[1][0] == 0 and cut[1][1] == 1 and cut[1][-1] == 0  # missing and high right, low left


def test_categories_as_flags_and_as_nominal_values(spark):
    """A value tells the label; null and unseen values follow the rows without the value."""
    rows = spark.range(300).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), F.col("id") % 5)).alias("s"), F.array(F.concat(F.lit("t"), F.col("id") % 3)).alias("tags"))
    rows = rows.withColumn("y", F.when(F.col("s").isin("c1", "c3"), 9.0).otherwise(0.0) + F.when(F.array_contains("tags", "t2"), 1.0).otherwise(0.0))
    for features, limit in ((["s", "tags"], 0.05), (categorical_features(rows, ["s"]), 0.3)):
        fitted = fit_model("xgboost_regression", rows, features, "y", n_estimators=30, learning_rate=0.5)
        error = fitted.score(rows).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)).alias("e")).first()["e"]
        assert error < limit, features
    unseen = rows.limit(1).withColumn("s", F.lit("new"))
    assert fitted.score(unseen).first()["prediction"] < 2


def overlapping(spark):
    draw = F.rand(5) + 0.8 * F.rand(6)
    rows = spark.range(900).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), draw.alias("d"))
    return rows.withColumn("c", F.when(F.col("a") + 0.5 * F.col("d") < 0.8, "low").when(F.col("b") + 0.5 * F.col("d") < 1.0, "mid").otherwise("top"))


def test_joint_classes_beat_one_against_the_rest(spark):
    """At 10 steps of 0.3; at 15 steps of 0.1 they do not (0.621 against 0.563)."""
    rows = overlapping(spark)
    train, test = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    fitted = fit_model("xgboost_classification", train, ["a", "b"], "c", n_estimators=10, learning_rate=0.3)
    place = F.array_position(F.lit(fitted.meta["classes"]), F.col("c")).cast("int") - 1
    own = lambda scored: scored.agg(F.avg(-F.ln(F.greatest(F.get("prediction", place), F.lit(1e-15)))).alias("l")).first()["l"]
    joint = fitted.score(test)
    total = F.aggregate("prediction", F.lit(0.0), lambda s, x: s + x)
    assert joint.agg(F.max(F.abs(total - 1)).alias("off")).first()["off"] < 1e-12
    trees = OneVsRest(classifier=GBTClassifier(labelCol="k", maxIter=10, maxDepth=3, stepSize=0.3, maxBins=64), labelCol="k")
    other = Pipeline(stages=[assembler(["a", "b"]), trees]).fit(train.withColumn("k", place.cast("double"))).transform(test)
    shares = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    assert own(joint) < own(other.select("c", proba_normalize(shares).alias("prediction")))
    names = fit_model("xgboost_classification", train, ["a", "b"], "c", n_estimators=2, output="class").score(test)
    assert names.filter("prediction = c").count() > 180


def test_edges(spark):
    rows = spark.createDataFrame([(1.0, 2.0, None), (1.0, 2.0, 3.0), (1.0, 4.0, 3.0)], "x double, y double, gone double")
    constant = fit_model("xgboost_regression", rows, ["x"], "y", n_estimators=3)
    assert constant.meta["trees"] == [] and [r.prediction for r in constant.score(rows).collect()] == [pytest.approx(8 / 3)] * 3
    labelled = fit_model("xgboost_regression", rows, ["x"], "gone", n_estimators=3)
    assert labelled.score(rows).first()["prediction"] == 3.0
    assert constant.score(rows.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no rows"):
        fit_model("xgboost_regression", rows.limit(0), ["x"], "y")


@pytest.mark.parametrize("classes", [0, 3])
def test_rows_of_equal_bins_are_one_with_a_weight(spark, monkeypatch, classes):
    """What the rounds read does not grow with the table; the trees are those of all rows."""
    rows = spark.range(900).selectExpr("double(id % 4) AS a", "IF(id % 3 = 0, NULL, double(id % 3)) AS b", f"double({'pmod(hash(id % 12, id % 7), 3)' if classes else 'hash(id % 12) % 97 + (id % 10) / 7'}) AS y")
    head = Pipeline(stages=[assembler(["a", "b"], "keep")])
    sizes, written = [], boosting.written
    monkeypatch.setattr(boosting, "written", lambda df, label: (kept := written(df, label), sizes.append(kept.count()))[0])
    params = {"n_estimators": 4, "max_depth": 2}
    _, made = boosting.fit_trees(head, rows, "y", classes, params)
    assert max(sizes) <= 12 * max(1, classes)
    monkeypatch.setattr(boosting, "_weighted", lambda binned, classes, base: binned.withColumns({"weight": F.lit(1.0), "margin": F.array(*[F.lit(float(b)) for b in base])}))
    _, plain = boosting.fit_trees(head, rows, "y", classes, params)
    assert 900 in sizes and [t[:2] for t in made["trees"]] == [t[:2] for t in plain["trees"]]
    for one, two in zip(made["trees"], plain["trees"], strict=True):
        assert one[2] == pytest.approx(two[2])
