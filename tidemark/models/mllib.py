"""Supervised models, clustering and dot-product embeddings on MLlib."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (
    Bucketizer,
    CountVectorizer,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scoring import proba_normalize
from tidemark.models import boosting, clusters, forest
from tidemark.models.base import FEATURES, PREDICTION, Fitted
from tidemark.operators.encode import decode
from tidemark.operators.preparation import label_classes
from tidemark.operators.profile import is_numeric
from tidemark.session import new_location

LABEL_INDEX = "_label"


def assembler(features: Sequence[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid=invalid)


def _head(df: DataFrame, features: Sequence[str] | Pipeline, keep_gaps: bool = False) -> list:
    """Pipeline stages that build the feature vector.

    Values of text columns and labels of list columns become sparse 0/1 features, however many
    there are.
    A feature with gaps in the training rows is filled with 0, the mean of a scaled column,
    and gets a second feature that says where the gaps were; a gap in any other is filled.
    With ``keep_gaps`` gaps stay what they are: not a number.
    """
    if isinstance(features, Pipeline):
        return features.getStages()
    numbers = [c for c in features if is_numeric(df.schema[c].dataType)]
    lists = [c for c in features if isinstance(df.schema[c].dataType, T.ArrayType)]
    text = [c for c in features if c not in numbers and c not in lists]
    stages, wide = [], {}
    if text:
        wide |= {c: f"{c}__flags" for c in text}
        indexed = [f"{c}__index" for c in text]
        stages.append(StringIndexer(inputCols=text, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=[wide[c] for c in text], dropLast=False, handleInvalid="keep"))
    for c in lists:
        wide[c] = f"{c}__flags"
        stages.append(CountVectorizer(inputCol=c, outputCol=wide[c], binary=True, vocabSize=(1 << 31) - 1))
    if not numbers:
        return [*stages, assembler([wide[c] for c in features])]
    if keep_gaps:
        return [*stages, assembler([wide.get(c, c) for c in features], "keep")]
    gap = lambda c: F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double"))
    found = df.agg(*[F.max(gap(c)).alias(f"g{i}") for i, c in enumerate(numbers)]).first()
    filled = [f"coalesce(nanvl(double(`{c}`), null), 0d) AS `{c}__filled`" for c in numbers]
    gaps = [c for i, c in enumerate(numbers) if found[f"g{i}"]]
    flags = [f"double(`{c}` IS NULL OR isnan(double(`{c}`))) AS `{c}__missing`" for c in gaps]
    fill = SQLTransformer(statement=f"SELECT *, {', '.join([*filled, *flags])} FROM __THIS__")
    inputs = [f"{c}__filled" if c in numbers else wide[c] for c in features]
    return [*stages, fill, assembler([*inputs, *(f"{c}__missing" for c in gaps)])]


def _fit_categories(estimator, head: PipelineModel):
    """Trees need as many bins as the widest indexed column has categories."""
    if any(isinstance(s, OneHotEncoderModel) for s in head.stages):
        return
    sizes = [len(x) + 1 for s in head.stages if isinstance(s, StringIndexerModel) for x in s.labelsArray]
    if sizes and estimator.hasParam("maxBins"):
        estimator.set(estimator.maxBins, max(estimator.getOrDefault("maxBins"), *sizes))


def without_summary(model):
    """The model as stored, without the training summary.

    A summary holds the session itself and cannot travel to the tasks once the
    session has observed a query.
    """
    if not getattr(model, "hasSummary", False):
        return model
    spark = SparkSession.getActiveSession()
    path = new_location(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def _fit(name: str, df: DataFrame, features, estimator, meta: dict | None = None) -> Fitted:
    """Build the vector once, keep it while the estimator iterates over it."""
    head = Pipeline(stages=_head(df, features)).fit(df)
    _fit_categories(estimator, head)
    rows = head.transform(df).select(FEATURES, estimator.getLabelCol())
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = without_summary(estimator.fit(rows))
    finally:
        rows.unpersist()
    return Fitted(name, PipelineModel(stages=[*head.stages, model]), meta or {})


def _splits(filled: DataFrame, columns: list[str], most: Sequence[float], bins: int) -> dict[str, list[float]]:
    """Where the columns of more than ``bins`` values are cut into about equal parts; ``most`` are about their numbers of values."""
    wide = [c for c, size in zip(columns, most, strict=True) if size > 2 * bins or filled.select(c).distinct().limit(bins + 1).count() > bins]
    if not wide:
        return {}
    found = filled.approxQuantile(wide, [i / bins for i in range(1, bins)], 1 / (16 * bins))
    return {c: sorted({v for v in cuts if math.isfinite(v)}) for c, cuts in zip(wide, found, strict=True)}


def _steps(filled: DataFrame, column: str) -> list[float]:
    """Cuts between all values of a column of few."""
    value = F.col(f"`{column}`").cast("double")
    return forest.between(sorted(r[0] for r in filled.select(value).distinct().toLocalIterator()))


#: Leaves that a regression forest of MLlib's may have: the driver holds them all.
MOST_LEAVES = 1 << 18


def _fit_trees(name: str, df: DataFrame, features, estimator, meta: dict | None = None) -> Fitted:
    """Trees see numbers in bins, so rows of the same bins (and class) are one weighted row to them.

    Where the numbers have so few values or bins that combinations must repeat, a tree is fitted on
    the combinations with their weights and mean labels: its cuts, leaves and values are those of
    all rows, and the work of a level no longer grows with the table. Otherwise, and for rows drawn
    with replacement, it is fitted on the rows. A regression forest with too many leaves for the
    driver is grown tree by tree in tasks, if its bins make a grid of bounded size; a classification
    forest that would be fitted on the rows is, if their bins and its leaves are of bounded size.
    """
    numbers = [] if isinstance(features, Pipeline) else [c for c in features if is_numeric(df.schema[c].dataType)]
    bootstrap = estimator.hasParam("bootstrap") and estimator.getOrDefault("bootstrap")
    if not numbers or len(numbers) < len(features) or bootstrap:
        return _fit(name, df, features, estimator, meta)
    label, bins, leaf = estimator.getLabelCol(), estimator.getMaxBins(), estimator.getMinInstancesPerNode()
    fill, assemble = _head(df, features)
    filled = fill.transform(df)
    inputs = assemble.getInputCols()
    classes = F.approx_count_distinct(label) if meta else F.lit(1)
    sizes = filled.agg(F.count(F.lit(1)), classes, *[F.approx_count_distinct(F.col(f"`{c}`")) for c in inputs]).first()
    rows, most = sizes[0], sizes[2:]
    combinations = math.prod(min(size, bins) for size in most)
    if isinstance(estimator, RandomForestRegressor) and min(rows / leaf, combinations) * estimator.getNumTrees() > MOST_LEAVES and combinations <= forest.MOST_CELLS:
        cuts = _splits(filled, inputs, most, bins)
        grid = [cuts[c] if c in cuts else _steps(filled, c) for c in inputs]
        if math.prod(len(x) + 1 for x in grid) <= forest.MOST_CELLS:
            return forest.fit_grid(name, df, [fill], inputs, grid, estimator)
    if 2 * sizes[1] * combinations > rows or rows <= 2 * leaf:
        if isinstance(estimator, RandomForestClassifier) and rows and forest.held_bytes(estimator, rows, len(inputs), len(meta["classes"])) <= forest.MOST_BYTES:
            cuts = _splits(filled, inputs, most, bins)
            return forest.fit_classes(name, df, [fill], inputs, [cuts[c] if c in cuts else _steps(filled, c) for c in inputs], estimator, meta)
        return _fit(name, df, features, estimator, meta)
    stages = [fill]
    cuts = _splits(filled, inputs, most, bins)
    if cuts:
        made = {c: f"{c}__bin" for c in cuts}
        stages.append(Bucketizer(inputCols=list(made), outputCols=list(made.values()), splitsArray=[[-math.inf, *x, math.inf] for x in cuts.values()]))
        # a sum, as it is a number and not one of so many categories
        stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(f'`{b}` + 0d AS `{c}__step`' for c, b in made.items())} FROM __THIS__"))
        inputs = [f"{c}__step" if c in cuts else c for c in inputs]
    head = Pipeline(stages=stages).fit(df)
    keys = [F.col(f"`{c}`") for c in inputs]
    keys += [F.col(label).alias("_class")] if meta else []
    known = F.count(label) == F.count(F.lit(1))  # MLlib refuses rows without a label
    cells = head.transform(df).groupBy(*keys).agg(F.when(known, F.avg(label)).alias(label), F.count(F.lit(1)).cast("double").alias("_rows"))
    vector = assembler(inputs)
    cells = vector.transform(cells).select(FEATURES, label, "_rows").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # so many bins that MLlib looks at every cell for its cuts: between all values there are
        weighted = {"maxBins": max(bins, math.isqrt(cells.count()) + 1), "weightCol": "_rows", "minInstancesPerNode": 1, "minWeightFractionPerNode": (leaf - 0.5) / rows}
        model = without_summary(estimator.copy({estimator.getParam(k): v for k, v in weighted.items()}).fit(cells))
    finally:
        cells.unpersist()
    return Fitted(name, PipelineModel(stages=[*head.stages, vector, model]), meta or {})


def _value(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Regression values and cluster ids: MLlib's own prediction column."""
    scored = fitted.pipeline.transform(df)
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.col(PREDICTION))


# ---- regression -----------------------------------------------------------------


#: Trees without a depth of their own grow as deep as MLlib lets them; the rows a leaf needs end them.
DEEPEST = 30


def _forest(params: dict) -> dict:
    return {
        "numTrees": int(params.get("trees", 100)),
        "minInstancesPerNode": int(params.get("min_samples_leaf", 30)),
        "seed": int(params.get("random_state", 0)),
        "maxDepth": int(params.get("max_depth") or DEEPEST),
        "maxBins": int(params.get("max_bins", 64)),
        "subsamplingRate": 1.0,
        "bootstrap": bool(params.get("bootstrap", False)),
    }


def _tree(params: dict) -> dict:
    return {
        "minInstancesPerNode": int(params.get("min_samples_leaf", 30)),
        "seed": int(params.get("random_state", 0)),
        "maxDepth": int(params.get("max_depth") or DEEPEST),
        "maxBins": int(params.get("max_bins", 64)),
    }


def fit_forest_regression(df, features, label, **params) -> Fitted:
    settings = _forest(params)
    return _fit_trees("random_forest_regression", df, features, RandomForestRegressor(labelCol=label, **settings))


def fit_tree_regression(df, features, label, **params) -> Fitted:
    return _fit_trees("tree_regression", df, features, DecisionTreeRegressor(labelCol=label, **_tree(params)))


def _fit_boosted(name: str, df: DataFrame, features, label: str, classes: list | None, params: dict) -> Fitted:
    head, trees = boosting.fit_trees(Pipeline(stages=_head(df, features, keep_gaps=True)), df, label, len(classes or ()), params)
    meta = {"classes": classes, "output": params.get("output", "proba")} if classes else {}
    return Fitted(name, head, {**meta, **trees})


def fit_boosted_regression(df, features, label, **params) -> Fitted:
    """Boosted trees for squared error; a missing number goes to the side of each cut that gains more."""
    return _fit_boosted("xgboost_regression", df.filter(F.col(label).isNotNull()), features, label, None, params)


def score_boosted_value(fitted: Fitted, df: DataFrame) -> DataFrame:
    scored = boosting.with_margins(fitted.pipeline, fitted.meta, df, "_margin")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.get("_margin", F.lit(0)).alias(PREDICTION))


def fit_linear(df, features, label, **params) -> Fitted:
    """Lasso or Ridge; Ridge's penalty is on the sum of squares, MLlib's on their mean."""
    lasso = params.get("reg_type", "Lasso") == "Lasso"
    alpha = float(params.get("alpha", 1e-6))
    estimator = LinearRegression(
        labelCol=label,
        elasticNetParam=1.0 if lasso else 0.0,
        regParam=alpha if lasso else alpha / max(df.count(), 1),
        maxIter=int(params.get("max_iter", 1000)),
        tol=float(params.get("tol", 1e-3)),
        fitIntercept=bool(params.get("fit_intercept", True)),
        standardization=False,
    )
    return _fit("linear_regression", df, features, estimator)


score_value = _value


def score_forest_value(fitted: Fitted, df: DataFrame) -> DataFrame:
    return forest.score_grid(fitted, df) if "cells" in fitted.meta else _value(fitted, df)


# ---- classification -------------------------------------------------------------


def class_index(label: str, classes: Sequence) -> Column:
    """Position of the row's class in the sorted class list."""
    place = F.array_position(F.lit(list(classes)), F.col(label))
    return F.when(place > 0, (place - 1).cast("double"))


def _fit_classes(name: str, df: DataFrame, features, label: str, build, params: dict, fit=_fit) -> Fitted:
    classes = label_classes(df, label)
    rows = df.filter(F.col(label).isNotNull()).withColumn(LABEL_INDEX, class_index(label, classes))
    meta = {"classes": classes, "output": params.get("output", "proba")}
    return fit(name, rows, features, build(len(classes)), meta)


def _forest_classifier(params: dict):
    return lambda classes: RandomForestClassifier(labelCol=LABEL_INDEX, **_forest(params))


def fit_forest_classification(df, features, label, **params) -> Fitted:
    build = _forest_classifier(params)
    return _fit_classes("random_forest_classification", df, features, label, build, params, _fit_trees)


def fit_tree_classification(df, features, label, **params) -> Fitted:
    def build(classes):
        return DecisionTreeClassifier(labelCol=LABEL_INDEX, **_tree(params))

    return _fit_classes("tree_classification", df, features, label, build, params, _fit_trees)


def fit_boosted_classification(df, features, label, **params) -> Fitted:
    """Boosted trees: one tree a round for two classes, one per class on shared softmax gradients for more."""
    classes = label_classes(df, label)
    rows = df.filter(F.col(label).isNotNull()).withColumn(LABEL_INDEX, class_index(label, classes))
    return _fit_boosted("xgboost_classification", rows, features, LABEL_INDEX, classes, params)


def score_boosted_classes(fitted: Fitted, df: DataFrame) -> DataFrame:
    scored = boosting.with_margins(fitted.pipeline, fitted.meta, df, "_margin")
    if len(fitted.meta["classes"]) == 2:
        one = F.get("_margin", F.lit(0))
        proba = F.array(1 / (1 + F.exp(one)), 1 / (1 + F.exp(-one)))
    else:
        powers = F.transform("_margin", lambda m: F.exp(m - F.array_max("_margin")))
        proba = F.transform(powers, lambda e: e / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))
    likeliest = F.array_position(proba, F.array_max(proba)) - 1
    value = _output(fitted, proba, likeliest)
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(PREDICTION))


def fit_logistic(df, features, label, **params) -> Fitted:
    def build(classes):
        return LogisticRegression(
            labelCol=LABEL_INDEX,
            elasticNetParam=1.0 if params.get("penalty", "l1") == "l1" else 0.0,
            regParam=float(params.get("alpha", 1e-4)),
            maxIter=int(params.get("max_iter", 100)),
            tol=float(params.get("tol", 1e-3)),
        )

    return _fit_classes("logistic_regression", df, features, label, build, params)


#: Share of the rows that a network is stopped by, in fifths of the hash range.
_FIFTHS = 5


def _log_loss(model, rows: DataFrame) -> float:
    """Mean log loss of a fitted classifier on rows with features and the index of their class."""
    share = F.get(vector_to_array("probability"), F.col(LABEL_INDEX).cast("int"))
    found = model.transform(rows).agg(F.avg(-F.ln(F.greatest(share, F.lit(1e-15)))).alias("loss")).first()["loss"]
    return math.inf if found is None else found


def fit_network(df, features, label, **params) -> Fitted:
    """A network of the first and last hidden layer; row scores sum to 1.

    Layers use sigmoid and softmax and are fitted by L-BFGS. A fifth of the rows, drawn by a
    hash of their features, is held out and looked at twice in ``early_stopping_patience``
    iterations, after which the fit goes on from its own weights. It ends when their log loss
    has not improved by ``early_stopping_delta`` in that many iterations, or after ``epochs``;
    the weights with the least held-out loss are kept. ``meta`` has the losses in order.
    """
    nodes, classes = list(params.get("nodes", (16, 8))), label_classes(df, label)
    epochs, patience = int(params.get("epochs", 100)), int(params.get("early_stopping_patience", 10))
    look = max(1, patience // 2)
    delta = float(params.get("early_stopping_delta", 1e-4))
    rows = df.filter(F.col(label).isNotNull()).withColumn(LABEL_INDEX, class_index(label, classes))
    head = Pipeline(stages=_head(rows, features)).fit(rows)
    draw = F.pmod(F.xxhash64(vector_to_array(FEATURES), F.lit(int(params.get("random_state", 0)))), F.lit(_FIFTHS)) == 0
    made = head.transform(rows).select(FEATURES, LABEL_INDEX, draw.alias("held")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted, held = made.filter("not held"), made.filter("held")
        if held.isEmpty() or fitted.isEmpty():  # too few rows to hold any out
            fitted = held = made
        width = made.first()[FEATURES].size
        network = MultilayerPerceptronClassifier(
            labelCol=LABEL_INDEX, layers=[width, nodes[0], nodes[-1], len(classes)], tol=1e-9, seed=int(params.get("random_state", 0))
        )
        best, least, losses, done, gained_at = None, math.inf, [], 0, 0
        while done < epochs and (not losses or done - gained_at < patience):
            model = network.setMaxIter(min(look, epochs - done)).fit(fitted)
            done += look
            losses.append(_log_loss(model, held))
            if losses[-1] < least - delta:
                gained_at = done
            if best is None or losses[-1] < least:
                best, least = model, losses[-1]
            network.setInitialWeights(model.weights)
    finally:
        made.unpersist()
    meta = {"classes": classes, "output": params.get("output", "proba"), "held_out_losses": losses}
    return Fitted("neural_network_classification", PipelineModel(stages=[*head.stages, without_summary(best)]), meta)


def score_forest_classes(fitted: Fitted, df: DataFrame) -> DataFrame:
    if fitted.parts is None:
        return score_classes(fitted, df)
    scored = forest.with_shares(fitted, df, "_shares")
    shares = F.col("_shares")
    likeliest = F.array_position(shares, F.array_max(shares)) - 1
    value = _output(fitted, proba_normalize(shares), likeliest)
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(PREDICTION))


def _output(fitted: Fitted, proba: Column, likeliest: Column) -> Column:
    """What the model was asked to say: shares, their logarithms, or the class."""
    output = fitted.meta["output"]
    if output == "log_proba":
        return F.transform(proba, F.ln)
    if output == "class":
        return F.get(F.lit(list(fitted.meta["classes"])), likeliest.cast("int"))
    return proba


def score_classes(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Class probabilities (default), their logarithms, or the class itself."""
    scored = fitted.pipeline.transform(df)
    value = _output(fitted, proba_normalize(vector_to_array("probability")), F.col(PREDICTION))
    kept = [F.col(f"`{c}`") for c in df.columns]
    return scored.select(*kept, value.alias(PREDICTION))


# ---- clustering -----------------------------------------------------------------


#: Wider vectors are mostly of flags, and stay sparse.
_WIDEST = 1024


def fit_kmeans(df, features, label=None, **params) -> Fitted:
    """Best of several seeded starts by within-cluster cost; all starts share the passes over the rows."""
    restarts, seed = int(params.get("n_init", 10)), int(params.get("random_state", 0))
    k, max_iter, tol = int(params["n_clusters"]), int(params.get("max_iter", 300)), float(params.get("tol", 1e-4))
    head = Pipeline(stages=_head(df, features)).fit(df)
    rows = head.transform(df).select(FEATURES)
    first = rows.first()
    if first is not None and first[FEATURES].size <= _WIDEST:
        centers, cost = clusters.best_of(rows, FEATURES, k, restarts, seed, max_iter, tol)
        return Fitted("kmeans_clustering", head, {"cost": cost, "clusters": len(centers), "centers": centers.tolist()})
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        runs = [KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed + i).fit(rows) for i in range(restarts)]
    finally:
        rows.unpersist()
    best = min(runs, key=lambda model: model.summary.trainingCost)
    meta = {"cost": best.summary.trainingCost, "clusters": best.getK()}
    stages = [*head.stages, without_summary(best)]
    return Fitted("kmeans_clustering", PipelineModel(stages=stages), meta)


def clustered(fitted: Fitted, df: DataFrame) -> DataFrame:
    """Rows with their vectors and the number of their cluster."""
    vectors = fitted.pipeline.transform(df)
    if "centers" not in fitted.meta:
        return vectors
    return vectors.withColumn(PREDICTION, clusters.nearest_center(FEATURES, fitted.meta["centers"]))


def score_clusters(fitted: Fitted, df: DataFrame) -> DataFrame:
    return clustered(fitted, df).select(*[F.col(f"`{c}`") for c in df.columns], F.col(PREDICTION))


# ---- dot-product embedding ------------------------------------------------------


def fit_dot_embedding(df, features, label, **params) -> Fitted:
    """Subject and item vectors whose dot product fits the label.

    ``features`` are the subject and the item column, both integer codes.
    """
    subject, item = features
    als = ALS(
        rank=int(params.get("embedding_size", 8)),
        maxIter=int(params.get("epochs", 10)),
        regParam=float(params.get("reg", 0.1)),
        userCol=subject, itemCol=item, ratingCol=label,
        seed=int(params.get("random_state", 0)),
        coldStartStrategy="nan",
    )
    ratings = df.select(F.col(subject).cast("int"), F.col(item).cast("int"), F.col(label).cast("float"))
    meta = {"subject": subject, "item": item}
    return Fitted("dot_embedding", PipelineModel(stages=[als.fit(ratings)]), meta)


def score_dot(fitted: Fitted, df: DataFrame) -> DataFrame:
    codes = {c: F.col(c).cast("int") for c in (fitted.meta["subject"], fitted.meta["item"])}
    return fitted.pipeline.transform(df.withColumns(codes)).withColumn(
        PREDICTION, F.col(PREDICTION).cast("double")
    )


def item_vectors(fitted: Fitted, encoder: DataFrame, name: str = "item") -> DataFrame:
    """``(item, embedding array<struct<dim, value>>)`` with decoded items."""
    factors = fitted.pipeline.stages[-1].itemFactors.withColumnRenamed("id", "_code")
    vector = F.transform(
        "features", lambda v, i: F.struct(i.alias("dim"), v.cast("double").alias("value"))
    )
    return decode(factors, "_code", encoder, name).select(name, vector.alias("embedding"))
