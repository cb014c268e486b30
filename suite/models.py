"""Models, losses, scoring output, model lifecycle and text embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from suite.sources import new_warehouse
from suite.preparation import component_facts
from suite.tables import Check, Tables, check, key_number, money
from tidemark.functions.scoring import (
    classification_output,
    log_loss,
    mae,
    mse,
    proba_normalize,
    rescale_probability,
)
from tidemark.models.lifetime import (
    bgnbd_log_likelihood,
    fit_bgnbd_summary,
    fit_gammagamma_summary,
    gammagamma_log_likelihood,
    mean_likelihoods,
    rfm_summary,
)
from tidemark.models.mllib import item_vectors
from tidemark.models.registry import fit_model
from tidemark.models.base import Fitted
from tidemark.operators.embedding import (
    embed_cached,
    embedding_records,
    hashing_embedder,
    projection_2d,
    write_embedding_records,
)
from tidemark.operators.encode import apply_encoder, fit_encoder
from tidemark.operators.preparation import fit_spec
from tidemark.operators.profile import ProfileOptions
from tidemark.operators.silhouette import euclidean_point_silhouettes, point_silhouettes, squared_silhouette
from tidemark.plans.scoring import predict_submodel, prediction_records
from tidemark.plans.training import (
    ModelStore,
    TrainConfig,
    run_submodel,
    run_submodels,
    save_training_data,
)
from tidemark.session import new_location

DIMENSIONS = [f"e{i}" for i in range(64)]
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(
        "vec_id", "label",
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(DIMENSIONS)],
    )


def text_numbers(t: Tables) -> DataFrame:
    """Quality label with simple numbers of each document."""
    text = F.col("text")
    return t.labels.join(t.documents, "doc_id").select(
        "doc_id", "quality",
        F.col("n_chars").cast("double").alias("chars"),
        F.size(F.split(text, r"\s+")).cast("double").alias("words"),
        F.length(F.regexp_replace(text, r"[^0-9]", "")).cast("double").alias("digits"),
        F.length(F.regexp_replace(text, r"[^.,;:!?]", "")).cast("double").alias("marks"),
    )


TEXT_FEATURES = ["chars", "words", "digits", "marks"]


def _by_class(fitted: Fitted, rows: DataFrame, key: str, label: str) -> DataFrame:
    """Per class: rows, whether scores are shares, and whether they tell more than the class sizes do."""
    classes = fitted.meta["classes"]
    total = F.aggregate("prediction", F.lit(0.0), lambda a, x: a + x)
    scored = fitted.score(rows).withColumns(
        {"share": total, "own": F.get("prediction", F.array_position(F.lit(classes), F.col(label)).cast("int") - 1)}
    )
    per_class = scored.groupBy(F.col(label).cast("long").alias("class")).agg(
        F.count_distinct(key).alias("n"), F.max(F.abs(F.col("share") - 1) < 1e-6).alias("sums_to_one"),
        F.sum(-F.ln(F.greatest("own", F.lit(1e-15)))).alias("cost"),
    )
    everything = Window.partitionBy()  # one row per class
    size = F.sum("n").over(everything)
    constant = F.sum(-F.col("n") * F.ln(F.col("n") / size)).over(everything)
    return per_class.select("class", "n", "sums_to_one", (F.sum("cost").over(everything) < constant).alias("tells_more"))


_CLASSES = "SELECT CAST({label} AS BIGINT) AS class, count(*) AS n, TRUE AS sums_to_one, TRUE AS tells_more FROM {rows} GROUP BY 1"
_VECTOR_CLASSES = _CLASSES.format(label="label", rows="embeddings")
_QUALITY_CLASSES = _CLASSES.format(label="quality", rows="labels JOIN documents USING (doc_id)")
_LINES_EXPLAINED = """SELECT count(*) AS n, count(*) AS keys, TRUE AS explains_half, TRUE AS unbiased, TRUE AS varies FROM lineitem"""


def charges(t: Tables) -> DataFrame:
    """Lines with what they cost in the end."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.select(*LINE_KEYS, *LINE_FEATURES, "l_returnflag", "l_extendedprice", charge.cast("double").alias("l_charge"))


def _regression(name: str, **params):
    def build(t: Tables) -> DataFrame:
        rows = charges(t)
        fitted = fit_model(name, rows, [*LINE_FEATURES, "l_extendedprice"], "l_charge", **params)
        y, p = F.col("l_charge"), F.col("prediction")
        return fitted.score(rows).agg(
            F.count("prediction").alias("n"), F.count(F.struct(*LINE_KEYS)).alias("keys"),
            (F.avg((y - p) * (y - p)) < 0.5 * F.var_pop(y)).alias("explains_half"),
            (F.abs(F.avg(y - p)) < 0.02 * F.avg(y)).alias("unbiased"), (F.count_distinct("prediction") > 10).alias("varies"),
        )

    return build


def _vector_classes(name: str, **params):
    def build(t: Tables) -> DataFrame:
        rows = vectors(t)
        return _by_class(fit_model(name, rows, DIMENSIONS, "label", **params), rows, "vec_id", "label")

    return build


def _quality_classes(name: str, **params):
    def build(t: Tables) -> DataFrame:
        rows = text_numbers(t)
        return _by_class(fit_model(name, rows, TEXT_FEATURES, "quality", **params), rows, "doc_id", "quality")

    return build


def linear_fit(t: Tables) -> DataFrame:
    fitted = fit_model(
        "linear_regression", t.lineitem, ["l_quantity"], "l_extendedprice", reg_type="Ridge", alpha=1e-9
    )
    rows = t.lineitem.select("l_quantity").distinct()
    return fitted.score(rows).select("l_quantity", F.round("prediction", 2).alias("prediction"))


def kmeans(t: Tables) -> DataFrame:
    rows = vectors(t)
    fitted = fit_model("kmeans_clustering", rows, DIMENSIONS, n_clusters=10)
    scored = fitted.score(rows)
    spread = sum((F.var_pop(c) * F.count(F.lit(1)) for c in DIMENSIONS), F.lit(0.0))
    sizes = scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), spread.alias("inside"))
    whole = rows.agg(spread.alias("s")).first()["s"]
    return sizes.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"), (F.sum("inside") < whole).alias("tighter"),
        (F.abs(F.sum("inside") / fitted.meta["cost"] - 1) < 1e-6).alias("cost_is_spread"),
    )


def user_items(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", key_number().alias("k")).agg(
        F.avg("value").alias("value")
    )


def _dot(t: Tables):
    rows = user_items(t)
    users, items = fit_encoder(rows, "user_id"), fit_encoder(rows, "k")
    coded = apply_encoder(apply_encoder(rows, "user_id", users), "k", items)
    fitted = fit_model(
        "dot_embedding", coded, ["user_id_code", "k_code"], "value", embedding_size=6
    )
    return fitted, coded, items


def dot_embedding(t: Tables) -> DataFrame:
    fitted, coded, _ = _dot(t)
    error = F.col("value") - F.col("prediction")
    return fitted.score(coded).agg(
        F.count("prediction").alias("n"), F.count_distinct("user_id").alias("users"), F.count_distinct("k").alias("items"),
        (F.avg(error * error) < F.avg(F.col("value") * F.col("value"))).alias("fits"),
    )


def embedding_export(t: Tables) -> DataFrame:
    fitted, _, items = _dot(t)
    vectors = item_vectors(fitted, items, "k").select("k", F.inline("embedding"))
    return vectors.select("k", "dim", (F.abs("value") < 1e6).alias("finite"))


# ---- lifetime -------------------------------------------------------------------


def summary(t: Tables) -> DataFrame:
    return rfm_summary(
        t.orders.withColumn("amount", money("o_totalprice")), "o_custkey", "o_orderdate", "amount", "D"
    )


def weekly_summary(t: Tables) -> DataFrame:
    """Events give short gaps, so that customers differ in recency."""
    return rfm_summary(t.events.withColumn("amount", money("value")), "user_id", "ts", "amount")


def peak_row(summary_rows: DataFrame, fitted: Fitted, likelihood, columns: list[str]) -> DataFrame:
    """Customers, and whether moving any parameter by 5 % either way makes the data less likely."""
    found = np.array(list(fitted.meta["params"].values()))
    near = [found * np.where(np.arange(len(found)) == i, f, 1.0) for i in range(len(found)) for f in (0.95, 1.05)]
    merged = summary_rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("weight"))
    means = mean_likelihoods(merged, columns, likelihood, np.array([found, *near]))
    return summary_rows.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(bool((found > 0).all())).alias("positive"), F.lit(bool((means[0] >= means[1:] - 1e-6).all())).alias("peak")
    )


def bgnbd_peak(t: Tables) -> DataFrame:
    rows = weekly_summary(t)
    return peak_row(rows, fit_bgnbd_summary(rows), bgnbd_log_likelihood, ["frequency", "recency", "T"])


def gammagamma_peak(t: Tables) -> DataFrame:
    rows = summary(t).filter("frequency > 0")
    return peak_row(rows, fit_gammagamma_summary(rows, 0.0), gammagamma_log_likelihood, ["frequency", "monetary_value"])


BG = {"r": 0.25, "alpha": 4.5, "a": 0.8, "b": 2.4}
GG = {"p": 6.25, "q": 3.75, "v": 15.5}


def visits(t: Tables) -> DataFrame:
    fitted = Fitted("beta_geometric", None, {"params": BG})
    rows = weekly_summary(t).withColumn("prediction_window", F.lit(7))
    found = fitted.score(rows).select("frequency", F.inline("prediction").alias("measure", "value"))
    value = F.col("value").cast("double")
    share = F.col("measure") != "visits"
    return found.groupBy("measure").agg(
        F.count("value").alias("n"), F.min(F.when(share, value.between(0, 1)).otherwise(value >= 0)).alias("in_range"),
        F.count_if((F.col("frequency") == 0) & (F.col("measure") == "p_alive_global") & (value == 1)).alias("surely_alive"),
    )


def alive_now(t: Tables) -> DataFrame:
    fitted = Fitted("beta_geometric", None, {"params": BG})
    rows = weekly_summary(t).withColumn("prediction_window", F.lit(7))
    named = F.filter("prediction", lambda p: p["measure"] == "p_alive_global")[0]["value"]
    return fitted.score(rows).select("user_id", named.cast("double").alias("p_alive_global"))


def profits(t: Tables) -> DataFrame:
    fitted = Fitted("gamma_gamma", None, {"params": GG})
    return fitted.score(summary(t)).select(
        "o_custkey", F.round(F.col("prediction")[0]["value"], 4).alias("avg_profit")
    )


# ---- evaluation -----------------------------------------------------------------


def _price_rule(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.5).alias("p")
    )


def quality_scores(t: Tables) -> DataFrame:
    p = 0.1 + 0.8 * (F.col("doc_id") % 10) / 10
    return t.labels.select("doc_id", "quality", F.array(1 - p, p).alias("proba"))


def silhouettes(t: Tables) -> DataFrame:
    points = point_silhouettes(t.embeddings, "vec_id", "embedding", "label")
    return points.select("vec_id", F.round("silhouette", 6).alias("silhouette"))


def euclidean_silhouettes(t: Tables) -> DataFrame:
    """On a sample of 10,000 points at most; of smaller tables on all."""
    points = euclidean_point_silhouettes(t.embeddings, "vec_id", "embedding", "label")
    return points.select("vec_id", F.round("silhouette", 6).alias("silhouette"))


def type_shares(t: Tables) -> DataFrame:
    kinds = ["click", "error", "purchase", "signup", "view"]
    sums = t.events.groupBy("user_id").agg(
        *[
            F.sum(F.when(F.col("event_type") == k, money("value")).otherwise(0)).cast("double").alias(k)
            for k in kinds
        ]
    )
    shares = proba_normalize(F.array(*[F.col(k) for k in kinds]))
    return sums.select("user_id", F.posexplode(shares).alias("place", "share")).select(
        "user_id", "place", F.round("share", 6).alias("share")
    )


def rescaled(t: Tables) -> DataFrame:
    p = rescale_probability(F.col("proba"), 0.85, 0.5)
    return quality_scores(t).select(
        "doc_id", F.round(p[0], 6).alias("p0"), F.round(p[1], 6).alias("p1")
    )


def class_records(t: Tables) -> DataFrame:
    values = classification_output(rescale_probability(F.col("proba"), 0.85, 0.5))
    rows = quality_scores(t).select("doc_id", F.inline(values))
    return rows.select("doc_id", "class", F.round(F.col("value").cast("double"), 6).alias("value"))


def records(t: Tables) -> DataFrame:
    """All three purposes, flattened."""
    base = t.customer.withColumn(
        "target", F.when(F.col("c_custkey") % 5 > 0, F.col("c_acctbal"))
    )
    share = (F.col("c_custkey") % 10) / 10
    common = {"key": "c_custkey", "submodel_name": "all", "execution_id": 1700000000,
              "rank": 3, "target": "target"}
    plain = prediction_records(
        base.withColumn("prediction", F.col("c_acctbal") * 2), "regression", model_name="spend", **common
    ).withColumn("part", F.lit(0)).withColumn("name", F.lit(None).cast("string"))
    classes = prediction_records(
        base.withColumn("prediction", F.array(1 - share, share)), "classification",
        model_name="churn", **common,
    ).select("*", F.inline("model_value").alias("v", "part")).drop("model_value")
    classes = classes.withColumnRenamed("v", "model_value").withColumn("name", F.lit(None).cast("string"))
    measures = F.array(
        F.struct(F.lit("visits").alias("measure"), F.col("c_acctbal").cast("string").alias("value"))
    )
    lasting = prediction_records(
        base.withColumn("prediction", measures), "survival", model_name="lifetime", **common
    ).select("*", F.inline("model_value").alias("name", "v")).drop("model_value")
    lasting = lasting.withColumnRenamed("v", "model_value").withColumn("part", F.lit(0))
    return plain.unionByName(classes).unionByName(lasting).withColumn(
        "model_value", F.round("model_value", 6)
    )


# ---- lifecycle ------------------------------------------------------------------


def line_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(*LINE_KEYS, *LINE_FEATURES, "l_returnflag", "l_extendedprice")


LINEAR = TrainConfig(
    type="linear_regression", purpose="regression", keys=tuple(LINE_KEYS),
    label="l_extendedprice", loss="mae", profile=ProfileOptions(max_cat_ratio=0, low_info_thresh=1),
)


def champions(t: Tables) -> DataFrame:
    """A weak model, a better one that replaces it, and the weak one again, refused."""
    store = ModelStore(t.spark, new_location(t.spark, "store"))
    rows = charges(t)
    good = LINEAR.overridden({"label": "l_charge"})
    weak = good.overridden({"params": {"alpha": 1e6}})
    for config in (weak, good, weak):
        run_submodel(rows, config, store, "price", "all")
    runs = store.runs()
    best = F.col("loss") < F.col("production_loss")
    return runs.select(
        "version", "promoted", (F.col("train_rows") + F.col("test_rows")).alias("n"), F.coalesce(best, F.lit(True)).alias("better"),
        (F.abs(F.col("train_rows") / (F.col("train_rows") + F.col("test_rows")) - 0.8) < 0.05).alias("four_fifths"),
    )


def statistics(t: Tables) -> DataFrame:
    """Log of one balanced classification run."""
    store = ModelStore(t.spark, new_location(t.spark, "store"))
    config = TrainConfig(
        type="logistic_regression", purpose="classification", keys=("doc_id",), label="quality",
        loss="log_loss", balance_ratio=1, profile=ProfileOptions(max_cat_ratio=0, low_info_thresh=1),
    )
    run_submodel(text_numbers(t), config, store, "quality", "all")
    return store.runs().select(
        "model_name", "submodel_name", "version", "promoted", "columns",
        (F.abs(F.col("mu") - 0.5) < 1e-9).alias("balanced"), F.col("pi").between(0.01, 0.99).alias("share_known"),
        F.col("production_loss").isNull().alias("first"), ((F.col("loss") > 0) & (F.col("loss") < 36)).alias("measured"),
    )


def submodels(t: Tables) -> DataFrame:
    """One model per region, and one submodel that must fail."""
    store = ModelStore(t.spark, new_location(t.spark, "store"))
    lines = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_totalprice", "c_acctbal", "n_regionkey")
    )
    config = TrainConfig(
        type="linear_regression", purpose="regression", keys=("o_orderkey",), label="o_totalprice",
        loss="mse", profile=ProfileOptions(max_cat_ratio=0, low_info_thresh=1),
    )

    def run(name: str, settings: TrainConfig) -> dict:
        part = lines.filter(F.col("n_regionkey") == int(name.split()[1])).drop("n_regionkey")
        return run_submodel(part, settings, store, "price", name)

    choices = {f"region {i}": {} for i in range(5)} | {"region 9": {}}
    done = run_submodels(t.spark, config, choices, run)
    sizes = store.runs().select("submodel_name", (F.col("train_rows") + F.col("test_rows")).alias("n"))
    return done.join(sizes, "submodel_name", "left").select("submodel_name", "status", "n")


def scoring_run(t: Tables) -> DataFrame:
    """Train, promote, score every row and store the records."""
    store = ModelStore(t.spark, new_location(t.spark, "store"))
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    config = TrainConfig(
        type="linear_regression", purpose="regression", keys=("c_custkey",), label="c_acctbal",
        loss="mse", profile=ProfileOptions(max_cat_ratio=0.5, low_info_thresh=1),
    )
    run_submodel(rows, config, store, "balance", "all")
    house = new_warehouse(t)
    stored = predict_submodel(
        house, store, rows, "balance", "all", "regression", "c_custkey", 1700000000, target="c_acctbal"
    )
    error = F.col("model_value") - F.col("target_column_current_value")
    return stored.groupBy("ts", "model_name", "submodel_name").agg(
        F.count_distinct("id").alias("n"), F.count("model_value").alias("scored"), F.round(F.sum("target_column_current_value"), 2).alias("target"),
        (F.abs(F.avg(error)) < 0.1 * F.stddev("target_column_current_value")).alias("unbiased"),
    )


def training_data(t: Tables) -> DataFrame:
    rows = line_rows(t)
    spec = fit_spec(rows, [*LINE_FEATURES, "l_returnflag"], LINEAR.profile)
    path = new_location(t.spark, "training-data")
    save_training_data(rows, spec, LINE_KEYS, "l_extendedprice", path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("l_returnflag_A", "l_returnflag_N", "l_returnflag_R").agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("l_extendedprice")).alias("price")
    )


# ---- text embeddings ------------------------------------------------------------


def embedded_twice(t: Tables) -> DataFrame:
    cache = new_location(t.spark, "cache")
    embedder = hashing_embedder(32)
    first, added_first = embed_cached(t.documents.select("doc_id", "text"), "text", "hash32", cache, embedder)
    again, added_again = embed_cached(t.documents.select("doc_id", "text"), "text", "hash32", cache, embedder)
    return again.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("embedding").alias("embedded"),
        F.min(F.size("embedding")).alias("dimensions"),
    ).select("*", F.lit(added_first).alias("added_first"), F.lit(added_again).alias("added_again"))


def records_round_trip(t: Tables) -> DataFrame:
    path = new_location(t.spark, "embedding-json")
    rows = t.embeddings.withColumn("name", F.concat(F.lit("vec "), F.col("vec_id").cast("string")))
    write_embedding_records(embedding_records(rows, "name"), path)
    schema = "file_name string, text_embedding array<struct<embed: double, code: int>>"
    back = t.spark.read.schema(schema).json(path)
    return back.select("file_name", F.inline("text_embedding")).select(
        "file_name", "code", F.round("embed", 6).alias("embed")
    )


def squared(t: Tables) -> DataFrame:
    rows = t.embeddings.select(array_to_vector("embedding").alias("x"), F.col("label").cast("double").alias("c"))
    value = squared_silhouette(rows, "x", "c")
    return t.embeddings.agg(F.count(F.lit(1)).alias("n")).withColumn("silhouette", F.round(F.lit(value), 6))


_P = "(0.1 + 0.8 * (doc_id % 10) / 10)"
_RESCALED = f"((0.85 * 0.5 * {_P}) / ((0.85 - 0.5) * {_P} + 0.5 * 0.15))"
_RFM = """WITH p AS (
  SELECT {customer} AS customer, date_trunc('day', {moment}) AS d,
    sum(CAST({amount} AS DECIMAL(18,2))) AS total FROM {table} GROUP BY 1, 2),
 s AS (SELECT customer, count(*) - 1 AS frequency, min(d) AS first, max(d) AS last,
    CAST(sum(total) - arg_min(total, d) AS DOUBLE) AS later FROM p GROUP BY 1),
 rfm AS (SELECT customer, frequency, CAST(date_diff('day', first, last) AS DOUBLE) AS recency,
    CAST(date_diff('day', first, (SELECT max(d) FROM p)) AS DOUBLE) AS t,
    CASE WHEN frequency > 0 THEN later / frequency ELSE 0 END AS monetary FROM s)
"""
_ORDERS_RFM = _RFM.format(
    customer="o_custkey", moment="o_orderdate", amount="o_totalprice", table="orders"
)
_EVENTS_RFM = _RFM.format(customer="user_id", moment="ts", amount="value", table="events")
_RECORD = """CAST(1700000000 AS BIGINT) AS ts, CASE WHEN c_custkey % 5 > 0 THEN c_acctbal ELSE 0 END
  AS target_column_current_value, {value} AS model_value, '{model}' AS model_name,
  'all' AS submodel_name, c_custkey AS id, CAST(3 AS BIGINT) AS submodel_rank,
  CAST({part} AS BIGINT) AS part, {name} AS name"""

CHECKS: dict[str, Check] = {
    "rf_regression": check(_regression("random_forest_regression"), _LINES_EXPLAINED),
    "rf_classification": check(_vector_classes("random_forest_classification"), _VECTOR_CLASSES),
    "tree_regression": check(_regression("tree_regression"), _LINES_EXPLAINED),
    "tree_classification": check(_vector_classes("tree_classification"), _VECTOR_CLASSES),
    "nn_classification": check(_vector_classes("neural_network_classification", nodes=(32, 16)), _VECTOR_CLASSES),
    "linear_regression": check(
        linear_fit,
        """SELECT DISTINCT l_quantity, round(
          (SELECT regr_intercept(l_extendedprice, l_quantity) FROM lineitem)
          + (SELECT regr_slope(l_extendedprice, l_quantity) FROM lineitem) * l_quantity, 2) AS prediction
        FROM lineitem""",
    ),
    "logistic_regression": check(_quality_classes("logistic_regression"), _QUALITY_CLASSES),
    "kmeans": check(kmeans, "SELECT count(*) AS n, CAST(10 AS BIGINT) AS clusters, TRUE AS tighter, TRUE AS cost_is_spread FROM embeddings"),
    "gbt_classification": check(_quality_classes("xgboost_classification"), _QUALITY_CLASSES),
    "gbt_regression": check(_regression("xgboost_regression"), _LINES_EXPLAINED),
    "dot_embedding": check(
        dot_embedding,
        """WITH p AS (SELECT DISTINCT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
        SELECT count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT k) AS items, TRUE AS fits FROM p""",
    ),
    "embedding_export": check(
        embedding_export,
        """WITH p AS (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
        SELECT k, CAST(dim AS BIGINT) AS dim, TRUE AS finite FROM p, (SELECT unnest(range(6)) AS dim)""",
    ),
    "rfm_summary": check(
        lambda t: summary(t).withColumn("monetary_value", F.round("monetary_value", 6)),
        _ORDERS_RFM
        + """SELECT customer AS o_custkey, frequency, recency, t AS "T",
        round(monetary, 6) AS monetary_value FROM rfm""",
    ),
    "bgnbd_fit": check(bgnbd_peak, "SELECT count(DISTINCT user_id) AS n, TRUE AS positive, TRUE AS peak FROM events"),
    "bgnbd_predict": check(
        visits,
        _EVENTS_RFM
        + """SELECT measure, count(*) AS n, TRUE AS in_range,
        count(*) FILTER (frequency = 0 AND measure = 'p_alive_global') AS surely_alive
        FROM rfm, (VALUES ('visits'), ('p_alive'), ('p_alive_global')) v(measure) GROUP BY 1""",
    ),
    "bgnbd_p_alive": check(
        alive_now,
        _EVENTS_RFM
        + f"""SELECT customer AS user_id, round(CASE WHEN frequency = 0 THEN 1 ELSE
        1 / (1 + {BG['a']} / ({BG['b']} + frequency - 1)
          * pow(({BG['alpha']} + t) / ({BG['alpha']} + recency), {BG['r']} + frequency)) END, 4)
        AS p_alive_global FROM rfm""",
    ),
    "gammagamma_fit": check(
        gammagamma_peak, _ORDERS_RFM + "SELECT count(*) AS n, TRUE AS positive, TRUE AS peak FROM rfm WHERE frequency > 0"
    ),
    "gammagamma_predict": check(
        profits,
        _ORDERS_RFM
        + f"""SELECT customer AS o_custkey, round(
          ({GG['q']} - 1) / ({GG['p']} * frequency + {GG['q']} - 1) * {GG['v']} * {GG['p']} / ({GG['q']} - 1)
          + {GG['p']} * frequency / ({GG['p']} * frequency + {GG['q']} - 1) * monetary, 4)
        AS avg_profit FROM rfm""",
    ),
    "loss_mse": check(
        lambda t: _price_rule(t).agg(F.round(mse(F.col("y"), F.col("p")), 6).alias("loss")),
        """SELECT round(avg(pow(l_extendedprice / 1000 - l_quantity * 1.5, 2)), 6) AS loss
        FROM lineitem""",
    ),
    "loss_mae": check(
        lambda t: _price_rule(t).agg(F.round(mae(F.col("y"), F.col("p")), 6).alias("loss")),
        "SELECT round(avg(abs(l_extendedprice / 1000 - l_quantity * 1.5)), 6) AS loss FROM lineitem",
    ),
    "loss_log": check(
        lambda t: quality_scores(t).agg(
            F.round(log_loss(F.col("quality"), F.col("proba")), 6).alias("loss")
        ),
        f"""SELECT round(avg(-ln(CASE quality WHEN 1 THEN {_P} ELSE 1 - {_P} END)), 6) AS loss
        FROM labels""",
    ),
    "silhouette": check(
        silhouettes,
        """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        m AS (SELECT a.vec_id, a.label, b.label AS other,
            CASE WHEN a.label = b.label THEN sum(pow(list_distance(a.x, b.x), 2)) / greatest(count(*) - 1, 1)
            ELSE avg(pow(list_distance(a.x, b.x), 2)) END AS d, count(*) AS n
          FROM e a, e b GROUP BY 1, 2, 3),
        s AS (SELECT vec_id, max(d) FILTER (label = other) AS inside,
            max(n) FILTER (label = other) AS size, min(d) FILTER (label <> other) AS outside
          FROM m GROUP BY 1)
        SELECT vec_id, round(CASE WHEN size = 1 THEN 0 ELSE
          (outside - inside) / greatest(inside, outside) END, 6) AS silhouette FROM s""",
    ),
    "silhouette_euclidean": check(
        euclidean_silhouettes,
        """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        m AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x)) AS d, count(*) AS n
          FROM e a, e b GROUP BY 1, 2, 3),
        s AS (SELECT vec_id, max(d / greatest(n - 1, 1)) FILTER (label = other) AS inside,
            max(n) FILTER (label = other) AS size, min(d / n) FILTER (label <> other) AS outside
          FROM m GROUP BY 1)
        SELECT vec_id, round(CASE WHEN size = 1 THEN 0 ELSE
          (outside - inside) / greatest(inside, outside) END, 6) AS silhouette FROM s""",
    ),
    "silhouette_squared": check(
        squared,
        """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        d AS (SELECT label, i, count(*) AS n, sum(x[i]) AS s, sum(x[i] * x[i]) AS q
          FROM e, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2),
        c AS (SELECT label AS other, any_value(n) AS n, list(s / n ORDER BY i) AS middle, sum(q) / any_value(n) AS q
          FROM d GROUP BY 1),
        m AS (SELECT vec_id, label, other, n,
            list_dot_product(x, x) - 2 * list_dot_product(x, middle) + q AS d FROM e, c),
        s AS (SELECT vec_id, max(n) FILTER (label = other) AS size,
            max(d * n / greatest(n - 1, 1)) FILTER (label = other) AS inside, min(d) FILTER (label <> other) AS outside
          FROM m GROUP BY 1)
        SELECT (SELECT count(*) FROM e) AS n, round(avg(CASE WHEN size = 1 THEN 0 ELSE
          (outside - inside) / greatest(inside, outside) END), 6) AS silhouette FROM s""",
    ),
    "proba_normalize": check(
        type_shares,
        """WITH s AS (SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS total,
        """
        + ", ".join(
            f"sum(CASE WHEN event_type = '{k}' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS s{i}"
            for i, k in enumerate(["click", "error", "purchase", "signup", "view"])
        )
        + """ FROM events GROUP BY 1)
        SELECT user_id, CAST(place AS BIGINT) AS place, round(CAST(CASE place WHEN 0 THEN s0 WHEN 1
          THEN s1 WHEN 2 THEN s2 WHEN 3 THEN s3 ELSE s4 END AS DOUBLE) / CAST(total AS DOUBLE), 6) AS share
        FROM s, (VALUES (0), (1), (2), (3), (4)) v(place)""",
    ),
    "rescale_probability": check(
        rescaled,
        f"SELECT doc_id, round(1 - {_RESCALED}, 6) AS p0, round({_RESCALED}, 6) AS p1 FROM labels",
    ),
    "classification_output": check(
        class_records,
        f"""SELECT doc_id, CAST(class AS BIGINT) AS class,
        round(CASE class WHEN 0 THEN 1 - {_RESCALED} ELSE {_RESCALED} END, 6) AS value
        FROM labels, (VALUES (0), (1)) v(class)""",
    ),
    "prediction_records": check(
        records,
        "SELECT "
        + _RECORD.format(value="round(c_acctbal * 2, 6)", model="spend", part="0", name="NULL")
        + " FROM customer UNION ALL SELECT "
        + _RECORD.format(
            value="""round(CASE class WHEN 0 THEN 1 - (c_custkey % 10) / 10
            ELSE (c_custkey % 10) / 10 END, 6)""",
            model="churn", part="class", name="NULL",
        )
        + " FROM customer, (VALUES (0), (1)) v(class) UNION ALL SELECT "
        + _RECORD.format(value="round(c_acctbal, 6)", model="lifetime", part="0", name="'visits'")
        + " FROM customer",
    ),
    "champion_challenger": check(
        champions,
        """SELECT CAST(version AS BIGINT) AS version, version < 3 AS promoted, n, version < 3 AS better, TRUE AS four_fifths
        FROM (SELECT count(*) AS n FROM lineitem), (VALUES (1), (2), (3)) v(version)""",
    ),
    "training_statistics": check(
        statistics,
        """SELECT 'quality' AS model_name, 'all' AS submodel_name, CAST(1 AS BIGINT) AS version, TRUE AS promoted,
        CAST(4 AS BIGINT) AS columns, TRUE AS balanced, TRUE AS share_known, TRUE AS first, TRUE AS measured
        FROM (SELECT count(*) AS n FROM labels) WHERE n > 0""",
    ),
    "submodel_runs": check(
        submodels,
        """SELECT 'region ' || n_regionkey AS submodel_name, 'done' AS status, count(*) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_regionkey UNION ALL SELECT 'region 9', 'failed', NULL""",
    ),
    "predict_submodel": check(
        scoring_run,
        """SELECT CAST(1700000000 AS BIGINT) AS ts, 'balance' AS model_name, 'all' AS submodel_name, count(*) AS n,
        count(*) AS scored, round(sum(c_acctbal), 2) AS target, TRUE AS unbiased FROM customer""",
    ),
    "save_training_data": check(
        training_data,
        """SELECT CAST(l_returnflag = 'A' AS BIGINT) AS "l_returnflag_A",
        CAST(l_returnflag = 'N' AS BIGINT) AS "l_returnflag_N",
        CAST(l_returnflag = 'R' AS BIGINT) AS "l_returnflag_R", count(*) AS n,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
        FROM lineitem GROUP BY l_returnflag""",
    ),
    "embed_cached": check(
        embedded_twice,
        """SELECT count(*) AS n, count(text) AS embedded, CAST(32 AS BIGINT) AS dimensions,
        count(DISTINCT text) AS added_first, CAST(0 AS BIGINT) AS added_again FROM documents""",
    ),
    "embedding_records": check(
        records_round_trip,
        """SELECT 'vec ' || vec_id AS file_name, code, round(CAST(embedding[code + 1] AS DOUBLE), 6) AS embed
        FROM embeddings, (SELECT unnest(range(64)) AS code)""",
    ),
    "embedding_projection_2d": check(
        lambda t: component_facts(projection_2d(t.embeddings, "vec_id", "embedding", 64), 2),
        "SELECT count(*) AS n, TRUE AS centred, TRUE AS in_order, TRUE AS uncorrelated FROM embeddings",
    ),
}
