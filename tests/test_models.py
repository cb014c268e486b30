"""Models, losses, lifetime numerics, lifecycle."""

import math
import uuid

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions.scoring import classification_output, log_loss, loss_value, proba_normalize, rescale_probability
from tidemark.models import clusters, forest, mllib
from tidemark.models.base import load_fitted
from tidemark.models.lifetime import (
    expected_visits,
    fit_bgnbd_summary,
    fit_gammagamma_summary,
    hypergeometric,
    log_gamma,
    rfm_summary,
)
from tidemark.models.mllib import class_index
from tidemark.models.registry import MODELS, fit_model
from tidemark.operators.embedding import embed_cached, hashing_embedder
from tidemark.operators.encode import categorical_features
from tidemark.operators.preparation import label_classes
from tidemark.operators.profile import ProfileOptions
from tidemark.operators.silhouette import silhouette
from tidemark.plans.scoring import prediction_records
from tidemark.plans.training import (
    PREPARE_CATEGORICAL,
    PREPARE_NOTHING,
    ModelStore,
    TrainConfig,
    load_configuration,
    run_submodel,
    run_submodels,
    should_promote,
    train,
)
from tidemark.session import new_location
from tidemark.sources.warehouse import Warehouse

PROFILE = ProfileOptions(max_cat_ratio=0.05, low_info_thresh=1)


@pytest.fixture(scope="module")
def points(spark):
    """Three clear groups, with a class and a value."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(600):
        g = i % 3
        x, y = rng.normal(g * 10, 1), rng.normal(-g * 5, 1)
        rows.append((i, float(x), float(y), "abc"[g], float(3 * x - y + 1)))
    return spark.createDataFrame(rows, "id int, x double, y double, group string, value double").cache()


# ---- numerics -------------------------------------------------------------------


def test_log_gamma():
    z = np.array([1e-3, 0.1, 0.5, 1.0, 2.5, 10.0, 1e4, 1e8])
    assert np.allclose(log_gamma(z), [math.lgamma(v) for v in z], rtol=1e-11, atol=1e-11)


def test_hypergeometric_closed_forms():
    z = np.array([0.0, 0.1, 0.5, 0.9, 0.99])
    one = np.ones_like(z)
    # 2F1(a, b; b; z) = (1 - z)^-a and 2F1(1, 1; 2; z) = -ln(1 - z) / z
    assert np.allclose(hypergeometric(2.5 * one, 3 * one, 3 * one, z), (1 - z) ** -2.5)
    assert np.allclose(hypergeometric(one, one, 2 * one, z)[1:], -np.log1p(-z[1:]) / z[1:])


# ---- lifetime -------------------------------------------------------------------


def test_rfm_by_hand(spark):
    rows = [
        ("a", "2024-01-01 10:00:00", 5.0), ("a", "2024-01-01 20:00:00", 5.0),
        ("a", "2024-01-03 00:00:00", 7.0), ("a", "2024-01-08 00:00:00", 9.0),
        ("b", "2024-01-05 00:00:00", 1.0), ("c", "2024-01-11 12:00:00", 2.0),
    ]
    df = spark.createDataFrame(rows, "c string, t string, m double").withColumn("t", F.col("t").cast("timestamp"))
    found = {r["c"]: tuple(r)[1:] for r in rfm_summary(df, "c", "t", "m").collect()}
    assert found == {"a": (2, 7.0, 10.0, 8.0), "b": (0, 0.0, 6.0, 0.0), "c": (0, 0.0, 0.0, 0.0)}
    assert {r["T"] for r in rfm_summary(df, "c", "t", max_t=30).collect()} == {30.0}
    weekly = {r["c"]: (r["frequency"], r["recency"], r["T"]) for r in rfm_summary(df, "c", "t", freq="W").collect()}
    assert weekly == {"a": (1, 1.0, 1.0), "b": (0, 0.0, 1.0), "c": (0, 0.0, 0.0)}


def test_bgnbd_recovers_parameters(spark):
    rng = np.random.default_rng(5)
    r, alpha, a, b = 0.8, 6.0, 0.9, 2.5
    rows = []
    for _ in range(6000):
        rate, leave, age = rng.gamma(r, 1 / alpha), rng.beta(a, b), 60.0
        now, last, count, alive = 0.0, 0.0, 0, True
        while alive:
            now += rng.exponential(1 / rate)
            if now > age:
                break
            last, count = now, count + 1
            alive = rng.random() > leave
        rows.append((count, last, age))
    summary = spark.createDataFrame(rows, "frequency int, recency double, T double")
    found = fit_bgnbd_summary(summary).meta["params"]
    assert found["r"] == pytest.approx(r, rel=0.15) and found["alpha"] == pytest.approx(alpha, rel=0.2)
    assert found["a"] / (found["a"] + found["b"]) == pytest.approx(a / (a + b), rel=0.15)


def test_gammagamma_recovers_parameters(spark):
    rng = np.random.default_rng(6)
    p, q, v = 6.0, 4.0, 15.0
    x = rng.integers(1, 20, 6000)
    scale = rng.gamma(q, 1 / v, 6000)
    spend = rng.gamma(p * x, 1 / (scale * x))
    summary = spark.createDataFrame([(int(n), float(m)) for n, m in zip(x, spend)], "frequency int, monetary_value double")
    found = fit_gammagamma_summary(summary).meta["params"]
    assert found["q"] == pytest.approx(q, rel=0.15)
    assert found["p"] * found["v"] / (found["q"] - 1) == pytest.approx(p * v / (q - 1), rel=0.1)


def test_expected_visits_matches_simulation(spark):
    """A new customer's expected visits equal the simulated mean."""
    rng = np.random.default_rng(7)
    params = {"r": 2.0, "alpha": 8.0, "a": 1.5, "b": 4.0}
    total, people, window = 0, 40_000, 20.0
    rates, leaves = rng.gamma(2.0, 1 / 8.0, people), rng.beta(1.5, 4.0, people)
    for rate, leave in zip(rates, leaves):
        now = rng.exponential(1 / rate)
        while now <= window:
            total += 1
            if rng.random() < leave:
                break
            now += rng.exponential(1 / rate)
    zero = F.lit(0.0)
    value = spark.range(1).select(expected_visits(params, F.lit(window), zero, zero, zero)).first()[0]
    assert value == pytest.approx(total / people, rel=0.03)


# ---- MLlib models ---------------------------------------------------------------

CLASSIFIERS = {
    "random_forest_classification": {"trees": 10},
    "tree_classification": {},
    "neural_network_classification": {"nodes": [8, 6]},
    "logistic_regression": {"max_iter": 20},
    "xgboost_classification": {"n_estimators": 3},
}
REGRESSORS = {
    "random_forest_regression": {"trees": 10},
    "tree_regression": {},
    "xgboost_regression": {"n_estimators": 30},
    "linear_regression": {},
}


@pytest.mark.parametrize("name", CLASSIFIERS)
def test_classifiers(points, name):
    fitted = fit_model(name, points, ["x", "y"], "group", **CLASSIFIERS[name])
    assert fitted.meta["classes"] == ["a", "b", "c"]
    scored = fitted.score(points)
    assert set(scored.columns) == {*points.columns, "prediction"}
    total = F.aggregate("prediction", F.lit(0.0), lambda a, b: a + b)
    best = F.array_position("prediction", F.array_max("prediction"))
    truth = F.array_position(F.lit(["a", "b", "c"]), F.col("group"))
    row = scored.agg(F.max(F.abs(total - 1)).alias("off"), F.avg((best == truth).cast("int")).alias("hit")).first()
    assert row["off"] < 1e-9 and row["hit"] > 0.95


@pytest.mark.parametrize("name", REGRESSORS)
def test_regressors_beat_the_mean(points, name):
    fitted = fit_model(name, points, ["x", "y"], "value", **REGRESSORS[name])
    scored = fitted.score(points)
    error = loss_value(scored, "mse", F.col("value"), F.col("prediction"))
    assert error < 0.1 * scored.agg(F.var_pop("value").alias("v")).first()["v"]


def test_class_outputs(points):
    names = fit_model("tree_classification", points, ["x", "y"], "group", output="class")
    assert names.score(points).filter("prediction = group").count() > 570
    logs = fit_model("tree_classification", points, ["x", "y"], "group", output="log_proba")
    assert logs.score(points).agg(F.max(F.array_max("prediction")).alias("m")).first()["m"] <= 0


def test_kmeans_and_silhouette(points):
    fitted = fit_model("kmeans_clustering", points, ["x", "y"], n_clusters=3, n_init=2)
    scored = fitted.score(points)
    assert scored.groupBy("group", "prediction").count().count() == 3
    with_array = scored.withColumn("v", F.array("x", "y"))
    assert silhouette(with_array, "id", "v", "prediction") > 0.7


def test_kmeans_starts_share_their_passes(spark, monkeypatch):
    """Ten starts one after another took ten chains of jobs."""
    def refuse(*_):
        raise AssertionError("a chain of jobs for each start")

    monkeypatch.setattr(mllib.KMeans, "_fit", refuse)
    passes = []
    means = clusters._Rows.means
    monkeypatch.setattr(clusters._Rows, "means", lambda self, starts: (passes.append(len(starts)), means(self, starts))[1])
    rows = spark.range(9000).selectExpr("id", "1e6 + (id % 3) * 40 + hash(id) % 1000 / 500D AS x", "(id % 3) * (id % 3) * 15 + hash(id, 7) % 1000 / 500D AS y").repartition(5)
    fitted = fit_model("kmeans_clustering", rows, ["x", "y"], n_clusters=3)
    assert passes[0] == 10 and len(passes) < 50
    path = new_location(spark, "clusters")
    fitted.save(spark, path)
    scored = load_fitted(spark, path).score(rows)
    assert scored.columns == ["id", "x", "y", "prediction"] and scored.schema["prediction"].dataType.simpleString() == "int"
    found = scored.groupBy("prediction").agg(F.count_distinct(F.col("id") % 3).alias("groups"), (F.var_pop("x") + F.var_pop("y")).alias("v"), F.count("id").alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y")).collect()
    assert len(found) == 3 and all(r["groups"] == 1 and r["n"] == 3000 for r in found)
    assert sum(r["v"] * r["n"] for r in found) == pytest.approx(fitted.meta["cost"], rel=1e-6)
    assert all(fitted.meta["centers"][r["prediction"]] == pytest.approx([r["x"], r["y"]], rel=1e-9) for r in found)


def test_kmeans_of_few_different_rows(spark):
    rows = spark.range(50).selectExpr("double(id % 3) AS x", "1D AS y")
    fitted = fit_model("kmeans_clustering", rows, ["x", "y"], n_clusters=5)
    assert fitted.meta["clusters"] == 3 and fitted.meta["cost"] < 1e-20
    assert fitted.score(rows).select("x", "prediction").distinct().count() == 3
    assert fitted.score(rows.limit(0)).isEmpty()


def test_dot_embedding_fits_better_than_the_mean(spark):
    rows = [(u, i, float((u % 3 + 1) * (i % 4 + 1))) for u in range(30) for i in range(20)]
    df = spark.createDataFrame(rows, "u int, i int, y double")
    fitted = fit_model("dot_embedding", df, ["u", "i"], "y", embedding_size=3, reg=0.01)
    scored = fitted.score(df)
    error = loss_value(scored, "mse", F.col("y"), F.col("prediction"))
    assert error < 0.1 * df.agg(F.var_pop("y").alias("v")).first()["v"]


def test_registry_errors(points):
    with pytest.raises(ValueError, match="unknown model"):
        fit_model("nothing", points)
    with pytest.raises(ValueError, match="label"):
        fit_model("linear_regression", points, ["x"])
    assert {n for n, m in MODELS.items() if not m.supervised} == {"kmeans_clustering", "beta_geometric", "gamma_gamma"}


@pytest.mark.parametrize("name", ["logistic_regression", "xgboost_classification"])
def test_saved_model_scores_the_same(spark, points, name):
    fitted = fit_model(name, points, ["x", "y"], "group", **CLASSIFIERS[name])
    path = new_location(spark, "model")
    fitted.save(spark, path)
    again = load_fitted(spark, path)
    assert again.meta == fitted.meta
    assert fitted.score(points).select("id", "prediction").exceptAll(
        again.score(points).select("id", "prediction")
    ).isEmpty()


# ---- losses and records ---------------------------------------------------------


def test_losses(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, p double")
    assert loss_value(df, "squared_error", F.col("y"), F.col("p")) == 2.5
    assert loss_value(df, "mae", F.col("y"), F.col("p")) == 1.5
    assert loss_value(df, None, F.col("y"), F.col("p")) is None
    with pytest.raises(ValueError):
        loss_value(df, "hinge", F.col("y"), F.col("p"))
    sure = spark.createDataFrame([(0, [0.0, 1.0]), (1, [0.0, 1.0])], "y int, p array<double>")
    value = sure.agg(log_loss(F.col("y"), F.col("p")).alias("l")).first()["l"]
    assert value == pytest.approx(-math.log(2.220446049250313e-16) / 2)


def test_rescaling_at_the_training_share_gives_the_true_share(spark):
    row = spark.range(1).select(
        rescale_probability(F.array(F.lit(0.7), F.lit(0.3)), 0.05, 0.3).alias("p"),
        rescale_probability(F.array(F.lit(0.7), F.lit(0.3)), None, 0.3).alias("same"),
        proba_normalize(F.array(F.lit(1.0), F.lit(3.0))).alias("n"),
    ).first()
    assert row["p"][1] == pytest.approx(0.05) and row["same"] == [0.7, 0.3] and row["n"] == [0.25, 0.75]


def test_records_need_a_known_purpose(points):
    with pytest.raises(ValueError):
        prediction_records(points.withColumn("prediction", F.lit(1.0)), "ranking", "id", "m", "s", 1)


# ---- lifecycle ------------------------------------------------------------------


@pytest.mark.parametrize(
    "new, old, comparable, promoted",
    [
        (1.0, None, False, True), (5.0, 1.0, False, True), (1.0, 2.0, True, True),
        (2.0, 1.0, True, False), (1.0, 1.0, True, False), (9.0, -1.0, True, True),
        (None, 1.0, True, False),
    ],
)
def test_promotion(new, old, comparable, promoted):
    assert should_promote(new, old, comparable) is promoted


def config(**changes):
    base = dict(
        type="linear_regression", purpose="regression", keys=("id",), label="value", loss="mse",
        profile=PROFILE,
    )
    return TrainConfig(**{**base, **changes})


def test_champion_keeps_its_place(spark, points):
    store = ModelStore(spark, new_location(spark, "store"))
    first = run_submodel(points, config(), store, "m", "s")
    worse = run_submodel(points, config(params={"alpha": 1e9}), store, "m", "s")
    assert first["promoted"] and not worse["promoted"]
    assert worse["production_loss"] == pytest.approx(first["loss"])
    assert store.production("m", "s")["version"] == 1 and store.runs().count() == 2
    assert store.production("m", "other") is None


def test_broken_champion_is_replaced(spark, points):
    store = ModelStore(spark, new_location(spark, "store"))
    run_submodel(points, config(skip_preprocessing=PREPARE_CATEGORICAL), store, "m", "s")
    renamed = points.withColumnRenamed("x", "other")
    again = run_submodel(renamed, config(), store, "m", "s")
    assert again["production_loss"] == -1 and again["promoted"]


@pytest.mark.parametrize("skip", [PREPARE_CATEGORICAL, PREPARE_NOTHING])
def test_other_preparations(points, skip):
    rows = points if skip == PREPARE_CATEGORICAL else points.drop("group")
    trained = train(rows, config(type="tree_regression", skip_preprocessing=skip))
    assert trained.spec is None and trained.statistics["loss"] < 20


def test_components_are_applied_when_scoring(spark, points):
    store = ModelStore(spark, new_location(spark, "store"))
    outcome = run_submodel(points, config(primary_components=2), store, "m", "s")
    again = run_submodel(points, config(primary_components=2), store, "m", "s")
    assert again["production_loss"] == pytest.approx(outcome["loss"])


def test_clustering_run(points):
    trained = train(
        points.select("id", "x", "y"),
        config(type="kmeans_clustering", purpose="clustering", label=None, loss="silhouette_score",
               params={"n_clusters": 3, "n_init": 2}),
    )
    assert trained.statistics["loss"] > 0.8


def test_embedding_run(spark):
    rows = [(u * 100 + i, f"u{u}", f"i{i}", float(u + i)) for u in range(12) for i in range(9)]
    df = spark.createDataFrame([*rows, (5000, "only", "once", 1.0)], "id int, u string, i string, y double")
    store, house = ModelStore(spark, new_location(spark, "store")), Warehouse(spark, f"tm_{uuid.uuid4().hex}", new_location(spark, "warehouse"))
    settings = config(
        type="dot_embedding", purpose="embedding", label="y", params={"subject": "u", "item": "i", "embedding_size": 3, "reg": 0.01}
    )
    outcome = run_submodel(df, settings, store, "m", "s 1", house)
    run = store.production("m", "s 1")
    assert outcome["loss"] < 5 and run["test_rows"] > 5 and run["train_rows"] + run["test_rows"] in (108, 109)
    stored = house.table("m_s_1_items")
    assert {r.i for r in stored.collect()} >= {f"i{k}" for k in range(9)}
    assert {len(r.embedding) for r in stored.collect()} == {3}
    items = stored.count()
    run_submodel(df, settings, store, "m", "s 1", house)
    assert house.table("m_s_1_items").count() == items


def test_a_run_stores_the_rows_its_model_was_made_from(spark, points):
    store = ModelStore(spark, new_location(spark, "store"))
    outcome = run_submodel(points, config(), store, "m", "s")
    stored = spark.read.parquet(f"{store.path('m', 's', outcome['version'])}/training_data")
    assert stored.count() == 600 and set(stored.columns) == {"id", "x", "y", "group", "value"}


def test_configuration_names_of_embedding_and_scoring_runs(tmp_path):
    import json

    settings = {"type": "dot_embedding", "purpose": "embedding", "key_list": ["id"], "label_column": "y", "subject_input_name": "u", "item_input_name": "i", "pred_key": "id", "pred_destination_table": "t", "bq_write_method": "merge", "target_column_name": "y"}
    (tmp_path / "model_config_global.json").write_text(json.dumps(settings))
    (tmp_path / "submodel_params.json").write_text(json.dumps({"all": {}}))
    found, _ = load_configuration(str(tmp_path))
    assert found.label == "y" and found.params == {"subject": "u", "item": "i", "key": "id", "table": "t", "method": "merge", "target": "y"}


def test_submodels_do_not_share_overrides(spark):
    seen = {}

    def run(name, settings):
        seen[name] = (settings.train_pct, settings.params)
        settings.params["leak"] = True
        if name == "b":
            raise RuntimeError("broken")
        return {"loss": 1.0, "promoted": True}

    base = config(params={"alpha": 1.0})
    submodels = {"a": {"train_pct": 0.5, "params": {"alpha": 2.0}}, "b": {}, "c": {}}
    done = {r["submodel_name"]: r for r in run_submodels(spark, base, submodels, run).collect()}
    assert [done[k]["status"] for k in "abc"] == ["done", "failed", "done"]
    assert "broken" in done["b"]["error"]
    assert seen["a"][0] == 0.5 and seen["c"] == (0.8, {"alpha": 1.0, "leak": True})
    assert base.params == {"alpha": 1.0}
    assert run_submodels(spark, base, submodels, run, only=["c"]).count() == 1


# ---- text embeddings ------------------------------------------------------------


def test_cache_embeds_each_text_once(spark):
    calls = spark.sparkContext.accumulator(0)
    inner = hashing_embedder(8)
    import pandas as pd

    def embed(texts: pd.Series) -> pd.Series:
        calls.add(len(texts))
        return inner(texts)

    df = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c"), (4, None)], "id int, text string")
    path = new_location(spark, "cache")
    first, added = embed_cached(df, "text", "m", path, embed)
    assert added == 2 and calls.value == 2
    more = df.union(spark.createDataFrame([(5, "new")], "id int, text string"))
    again, added = embed_cached(more, "text", "m", path, embed)
    assert added == 1 and calls.value == 3
    found = {r["id"]: r["embedding"] for r in again.collect()}
    assert found[1] == found[2] and found[4] is None and len(found[5]) == 8
    _, other_model = embed_cached(df, "text", "m2", path, embed)
    assert other_model == 2


def test_configuration_files(tmp_path):
    import json

    (tmp_path / "model_config_global.json").write_text(json.dumps({
        "type": "xgboost_regression", "purpose": "regression", "key_list": ["id"],
        "label_column": "value", "loss_function": "mse", "low_info_thresh": 0.9, "max_depth": 4,
    }))
    (tmp_path / "submodel_params.json").write_text(json.dumps({
        "mx": {"country": "MX", "rank": 1, "max_depth": 2}, "es": {"country": "ES", "train_pct": 0.5},
    }))
    from tidemark.plans.training import load_configuration

    base, submodels = load_configuration(str(tmp_path))
    assert (base.keys, base.label, base.loss) == (("id",), "value", "mse")
    assert base.profile.low_info_thresh == 0.9 and base.params == {"max_depth": 4}
    mexico = base.overridden(submodels["mx"])
    assert mexico.params == {"max_depth": 2, "country": "MX", "rank": 1}
    assert base.overridden(submodels["es"]).train_pct == 0.5
    assert list(load_configuration(str(tmp_path), only=["es"])[1]) == ["es"]


def grid_rows(spark):
    return spark.range(20_000).selectExpr("id % 50 AS a", "IF(id % 40 = 3, NULL, double(hash(id) % 1000)) AS b", "1.5 AS c", "(id % 50) * 3 + hash(id, 1) % 10 + (hash(id) % 1000) / 100D AS y")


def test_a_tree_of_the_grid_is_the_tree_of_all_rows(spark, monkeypatch):
    rows = grid_rows(spark)
    tree = fit_model("tree_regression", rows, ["a", "b", "c"], "y", max_bins=16 * 4)
    monkeypatch.setattr(mllib, "MOST_LEAVES", 0)
    one = fit_model("random_forest_regression", rows, ["a", "b", "c"], "y", trees=1)
    assert len(one.meta["cells"]) <= 50 * 64 * 2
    both = one.score(tree.score(rows).withColumnRenamed("prediction", "p"))
    assert both.filter("p IS NULL OR prediction IS NULL").isEmpty() and both.count() == 20_000
    off = both.agg(F.avg(F.abs(F.col("p") - F.col("prediction"))).alias("o"), F.stddev("p").alias("s")).first()
    assert off["o"] < 0.02 * off["s"]


def test_a_large_forest_is_grown_in_tasks(spark, monkeypatch):
    """100 trees of 30 levels are too much for the driver."""
    def refuse(*_):
        raise AssertionError("the driver would hold all leaves")

    monkeypatch.setattr(mllib.RandomForestRegressor, "_fit", refuse)
    rows = grid_rows(spark)
    fitted = fit_model("random_forest_regression", rows, ["a", "b"], "y", trees=300, min_samples_leaf=5)
    path = new_location(spark, "forest")
    fitted.save(spark, path)
    scored = load_fitted(spark, path).score(rows)
    assert scored.columns == [*rows.columns, "prediction"]
    row = scored.agg(F.count("prediction").alias("n"), F.avg((F.col("y") - F.col("prediction")) ** 2).alias("e"), F.var_pop("y").alias("v"), F.avg("y").alias("y"), F.avg("prediction").alias("p")).first()
    assert row["n"] == 20_000 and row["e"] < 0.3 * row["v"] and row["p"] == pytest.approx(row["y"], rel=1e-9)
    with pytest.raises(ValueError, match="without a number"):
        fit_model("random_forest_regression", rows.withColumn("y", F.when(F.col("a") > 0, F.col("y"))), ["a", "b"], "y", trees=300, min_samples_leaf=5)


def test_leaves_of_the_grid_have_enough_rows():
    weight, total = np.array([5.0, 0, 30, 4, 9, 40]), np.array([50.0, 0, 0, 4, 9, 400])
    said = forest.grow([2, 3], weight, total, leaf=10, depth=30, features=2, seed=0)
    assert np.allclose(said, [50 / 35, 50 / 35, 50 / 35, 1, 1, 10])


def class_rows(spark):
    return spark.range(6000).selectExpr("id", "id % 50 AS a", "IF(id % 40 = 3, NULL, double(hash(id) % 20)) AS b", "double(hash(id, 5) % 30) AS c").selectExpr(
        "*", "array('x', 'y', 'z')[IF(hash(id, 2) % 5 = 0, pmod(hash(id, 3), 3), pmod(hash(int(a / 10), int(c / 10)), 3))] AS kind"
    )


def test_a_class_forest_is_grown_in_tasks(spark, monkeypatch):
    """MLlib passes over all rows for some thousand nodes at a time, and the driver holds them all."""
    def refuse(*_):
        raise AssertionError("level by level over all rows")

    monkeypatch.setattr(mllib.RandomForestClassifier, "_fit", refuse)
    rows = class_rows(spark)
    fitted = fit_model("random_forest_classification", rows, ["a", "b", "c"], "kind", trees=20)
    path = new_location(spark, "forest")
    fitted.save(spark, path)
    again = load_fitted(spark, path)
    scored = again.score(rows)
    assert scored.columns == [*rows.columns, "prediction"] and len(again.parts) == 20
    assert sorted(scored.collect()) == sorted(fitted.score(rows).collect())
    best = F.array_position("prediction", F.array_max("prediction")) == F.array_position(F.lit(["x", "y", "z"]), F.col("kind"))
    total = F.aggregate("prediction", F.lit(0.0), lambda a, b: a + b)
    row = scored.agg(F.count("prediction").alias("n"), F.avg(best.cast("int")).alias("hit"), F.max(F.abs(total - 1)).alias("off")).first()
    assert row["n"] == 6000 and row["hit"] > 0.8 and row["off"] < 1e-9
    assert again.score(rows.limit(0)).isEmpty()
    named = fit_model("random_forest_classification", rows, ["a", "b", "c"], "kind", trees=3, output="class")
    assert named.score(rows).filter("prediction = kind").count() > 4800


def test_a_class_tree_of_a_task_is_the_tree_of_mllib(spark, monkeypatch):
    rows = class_rows(spark)
    made = fit_model("random_forest_classification", rows, ["a", "b", "c"], "kind", trees=1)
    assert made.parts is not None
    monkeypatch.setattr(forest, "MOST_BYTES", 0)
    plain = fit_model("random_forest_classification", rows, ["a", "b", "c"], "kind", trees=1)
    assert plain.parts is None  # too large for a task
    one, two = (sorted(f.score(rows).select("id", "prediction").collect()) for f in (made, plain))
    assert len({tuple(r["prediction"]) for r in one}) > 6
    assert sum(np.allclose(r["prediction"], s["prediction"]) for r, s in zip(one, two, strict=True)) > 5900  # equal gains apart


def test_leaves_of_class_trees():
    codes, y = np.repeat(np.arange(4, dtype=np.uint8), 10)[:, None], np.repeat([0, 1, 1], [10, 10, 20])
    y[25] = 0
    tree = forest.grow_classes(codes, y, 4, 2, leaf=10, depth=30, features=1, seed=0)
    assert tree.counts.tolist() == [[10, 0], [1, 29]]  # leaves that name the same class are one
    assert forest.class_counts(tree, np.array([[0], [1], [3]], np.uint8)).tolist() == [[10, 0], [1, 29], [1, 29]]
    assert forest.grow_classes(codes, y, 4, 2, leaf=21, depth=30, features=1, seed=0).counts.tolist() == [[11, 29]]
    assert forest.grow_classes(codes, y, 4, 2, leaf=1, depth=0, features=1, seed=0).counts.tolist() == [[11, 29]]


# ---- rows a training run must take ----------------------------------------------


def with_text(spark, n=600, values=None):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal()), f"t{i % (values or 3)}", "ab"[i % 2], "x,y,z"[: 2 * (i % 3) + 1], float(i % 3 * 10)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, x double, t string, flag string, tags string, value double")


def test_text_columns_of_any_size_train_and_score(spark):
    rows = with_text(spark, 30_000, 30_000)
    trained = train(rows, config(params={"reg_type": "Ridge", "alpha": 1e-3}))
    assert trained.fitted.pipeline.stages[-1].numFeatures > 20_000
    assert [s.type for s in trained.spec.columns] == ["regular", "text", "text", "labels"]
    assert trained.statistics["loss"] < 1


def test_spec_of_a_training_run_is_stored(spark):
    store = ModelStore(spark, new_location(spark, "store"))
    rows = with_text(spark)
    one = run_submodel(rows, config(), store, "m", "s")
    again = run_submodel(rows.withColumn("t", F.lit(None).cast("string")), config(), store, "m", "s")
    assert one["promoted"] and again["production_loss"] is not None and again["production_loss"] >= 0


def test_a_label_of_many_classes(spark):
    rows = spark.range(20_000).select("id", (F.col("id") % 5000).cast("string").alias("value"), (F.col("id") % 5000).cast("double").alias("x"))
    assert len(label_classes(rows, "value")) == 5000
    position = class_index("value", label_classes(rows, "value"))
    assert rows.select(F.count_distinct(position), F.max(position)).first() == (5000, 4999.0)


def test_training_without_keys_holds_rows_out(points):
    rows = points.drop("id")
    trained = train(rows, config(keys=()))
    assert 60 < trained.statistics["test_rows"] < 180 and trained.statistics["loss"] is not None


def test_keyless_champion_is_compared(spark, points):
    store = ModelStore(spark, new_location(spark, "store"))
    run_submodel(points.drop("id"), config(keys=()), store, "m", "s")
    worse = run_submodel(points.drop("id"), config(keys=(), params={"alpha": 1e9}), store, "m", "s")
    assert not worse["promoted"] and worse["production_loss"] < worse["loss"]


def test_nothing_held_out_compares_on_the_training_rows(spark, points):
    store = ModelStore(spark, new_location(spark, "store"))
    run_submodel(points, config(train_pct=1), store, "m", "s")
    worse = run_submodel(points, config(train_pct=1, params={"alpha": 1e9}), store, "m", "s")
    assert not worse["promoted"]


@pytest.mark.parametrize("name", sorted({**CLASSIFIERS, **REGRESSORS}))
def test_gaps_in_numbers(points, name):
    gone = F.when(F.col("id") % 7 > 0, F.col("x"))
    rows = points.withColumns({"x": gone, "y": F.when(F.col("id") % 11 > 0, F.col("y")).otherwise(F.lit(float("nan")))})
    label = "group" if name in CLASSIFIERS else "value"
    scored = fit_model(name, rows, ["x", "y"], label, **{**CLASSIFIERS, **REGRESSORS}[name]).score(rows)
    assert scored.filter("prediction IS NULL").isEmpty() and scored.columns == [*rows.columns, "prediction"]


def test_categories_of_any_number_in_categorical_mode(spark):
    rows = with_text(spark, 2000, 200)
    for kind in ("tree_regression", "random_forest_regression", "xgboost_regression"):
        trained = train(rows, config(type=kind, skip_preprocessing=PREPARE_CATEGORICAL, params={"trees": 5, "n_estimators": 5}))
        assert trained.statistics["loss"] < 100


def test_numbers_with_few_values_are_categories_in_categorical_mode(spark):
    rows = spark.range(60_000).select("id", (F.col("id") % 4).alias("few"), F.rand(1).alias("many"))
    fitted = categorical_features(rows, ["few", "many"]).fit(rows)
    attributes = fitted.transform(rows).schema["features"].metadata["ml_attr"]["attrs"]
    assert len(attributes["nominal"]) == 1 and len(attributes["numeric"]) == 1


def test_network_stops_by_held_out_rows(spark):
    """Labels that no feature tells: training gains for ever, the held-out loss does not."""
    rows = spark.range(300).select(*[F.rand(i).alias(f"x{i}") for i in range(6)], (F.rand(99) > 0.5).cast("int").alias("y"))
    fitted = fit_model("neural_network_classification", rows, [f"x{i}" for i in range(6)], "y", nodes=[24, 24], epochs=400)
    losses = fitted.meta["held_out_losses"]
    assert 2 < len(losses) < 80 and min(losses[-2:]) > min(losses) - 1e-4
    held = F.pmod(F.xxhash64(F.array(*[F.col(f"x{i}") for i in range(6)]), F.lit(0)), F.lit(5)) == 0
    scored = fitted.score(rows.filter(held))
    loss = scored.agg(F.avg(-F.ln(F.greatest(F.get("prediction", F.col("y")), F.lit(1e-15)))).alias("l")).first()["l"]
    assert loss == pytest.approx(min(losses), rel=1e-6)  # the best weights are the ones kept


def test_euclidean_silhouette_of_a_sample(spark, points):
    from tidemark.operators.silhouette import euclidean_silhouette

    rows = points.select(F.array("x", "y").alias("v"), F.when(F.col("group") == "a", 0).when(F.col("group") == "b", 1).otherwise(2).alias("c"))
    whole, some = euclidean_silhouette(rows, "v", "c"), euclidean_silhouette(rows, "v", "c", sample=150, seed=3)
    assert whole.points == rows.count() and 90 < some.points < 220
    assert abs(whole.value - some.value) < 5 * some.error + 0.02 and some.error > whole.error > 0
    assert euclidean_silhouette(rows, "v", "c", sample=150, seed=3) == some
    with pytest.raises(ValueError):
        euclidean_silhouette(rows.filter("c = 0"), "v", "c")


def test_network_in_categorical_mode(points):
    trained = train(
        points.drop("value"),
        config(type="neural_network_classification", purpose="classification", label="group", loss="log_loss", skip_preprocessing=PREPARE_CATEGORICAL, params={"nodes": (4, 4)}),
    )
    assert trained.statistics["loss"] < 0.5


def test_unknown_class_costs_as_much_as_a_score_of_zero(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (None, [1.0, 0.0])], "y int, p array<double>")
    value = rows.agg(log_loss(F.col("y"), F.col("p")).alias("l")).first()["l"]
    assert value == pytest.approx(-math.log(2.220446049250313e-16) / 2)


def test_balanced_models_are_measured_on_rescaled_scores(spark):
    rows = spark.range(4000).select("id", F.randn(3).alias("x"), F.when(F.col("id") % 20 == 0, "yes").otherwise("no").alias("y"))
    settings = config(type="logistic_regression", purpose="classification", label="y", loss="log_loss")
    balanced = train(rows, settings.overridden({"balance_ratio": 1.0}))
    plain = train(rows, settings)
    assert balanced.statistics["mu"] == pytest.approx(0.5) and balanced.statistics["loss"] == pytest.approx(plain.statistics["loss"], abs=0.03)


def test_scores_are_written_in_plain_digits(spark):
    row = spark.range(1).select(classification_output(F.array(F.lit(0.0001), F.lit(1.0), F.lit(1e-9), F.lit(0.25))).alias("v")).first()
    assert [x["value"] for x in row["v"]] == ["0.0001", "1.0", "0.000000001", "0.25"]


def test_a_doubled_cache_row_leaves_the_rows_as_they_are(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, t string")
    cache = new_location(spark, "cache")
    embed_cached(rows, "t", "m", cache, hashing_embedder(8))
    spark.read.parquet(cache).write.mode("append").parquet(cache + "-twice")
    spark.read.parquet(cache).write.mode("append").parquet(cache + "-twice")
    again, added = embed_cached(rows, "t", "m", cache + "-twice", hashing_embedder(8))
    assert again.count() == 4 and added == 0


def test_series_that_does_not_settle():
    with pytest.raises(ArithmeticError):
        hypergeometric(np.array([1.0]), np.array([1.0]), np.array([1.0]), np.array([0.9999999]))


@pytest.mark.parametrize("kind", ["tree_regression", "random_forest_regression", "tree_classification", "random_forest_classification"])
def test_trees_fit_rows_of_equal_bins_once(spark, monkeypatch, kind):
    """The rows an estimator sees do not grow with the table, and the model is the one of all rows."""
    rows = spark.range(4000).selectExpr("id % 7 AS a", "IF(id % 5 = 0, NULL, double(id % 5)) AS b", "(id % 7) * 3 + (id % 5) + (id % 11) / 100D AS y", "int(id % 7 > 3) AS kind")
    label, params = ("kind" if "class" in kind else "y"), {"trees": 3, "min_samples_leaf": 40, "max_depth": 6}
    seen = []
    for estimator in (mllib.DecisionTreeRegressor, mllib.RandomForestRegressor, mllib.DecisionTreeClassifier, mllib.RandomForestClassifier):
        monkeypatch.setattr(estimator, "_fit", lambda self, data, fit=estimator._fit: (seen.append(data.count()), fit(self, data))[1])
    made = fit_model(kind, rows, ["a", "b"], label, **params)
    assert seen == [35]
    monkeypatch.setattr(mllib, "_fit_trees", mllib._fit)
    plain = mllib._fit_classes if label == "kind" else None
    if plain:
        monkeypatch.setattr(mllib, "_fit_classes", lambda *args: plain(*args[:6]))
    whole = fit_model(kind, rows, ["a", "b"], label, **params)
    assert seen == [35, 4000]
    one, two = (sorted(f.score(rows).select("a", "b", "prediction").distinct().toPandas().itertuples(index=False), key=repr) for f in (made, whole))
    assert len(one) == len(two) == 35
    for r, s in zip(one, two, strict=True):  # forests draw the places of their nodes: equal gains may be told apart by rounding
        assert np.allclose(r.prediction, s.prediction, **({} if kind.startswith("tree") else {"rtol": 0.1, "atol": 0.5}))


def test_a_forest_on_combinations_scores_after_an_observed_query(spark):
    """The summary of its training holds the session, which tasks cannot take once it has observed a query."""
    spark.range(5).observe(Observation("rows"), F.count(F.lit(1)).alias("n")).collect()
    rows = spark.range(2000).selectExpr("id % 7 AS a", "id % 5 AS b", "int(id % 7 > 3) AS kind")
    fitted = fit_model("random_forest_classification", rows, ["a", "b"], "kind", trees=3)
    assert fitted.parts is None and fitted.score(rows).select("a", "prediction").distinct().count() >= 7


def test_tree_on_bins_keeps_leaves_of_enough_rows(spark):
    rows = spark.range(30_000).selectExpr("double(hash(id) % 100000) AS x", "double(hash(id) % 100000) * 2 AS y")
    fitted = fit_model("tree_regression", rows, ["x"], "y", min_samples_leaf=100)
    leaves = fitted.score(rows).groupBy("prediction").agg(F.count("y").alias("n"), F.avg("y").alias("mean")).collect()
    assert 30 < len(leaves) <= 64 and min(r["n"] for r in leaves) >= 100
    assert all(abs(r["mean"] - r["prediction"]) < 1e-6 * max(1, abs(r["mean"])) for r in leaves)
