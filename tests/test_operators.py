"""Joins, upserts, preparation, samples and encoders on edge rows."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions.clean import assemble_defaults, clean_category, null_defaults
from tidemark.functions.humanize import kpi_humanize
from tidemark.functions.rules import sport_bucket
from tidemark.operators.encode import apply_encoder, fit_encoder, label_encode
from tidemark.operators.joins import count_matches, join_on_keys, seen_values_only
from tidemark.operators.preparation import (
    apply_pca,
    apply_spec,
    fit_pca,
    fit_spec,
    label_classes,
    label_onehot,
    load_spec,
    save_spec,
    split_roles,
)
from tidemark.operators.profile import ProfileOptions, profile_columns
from tidemark.operators.sampling import train_test_split, undersample
from tidemark.operators.upsert import DuplicateKeys, VersionedTable, write_predictions
from tidemark.plans.incremental import date_windows, window_variables
from tidemark.plans.templates import load_templates, run_templates
from tidemark.session import new_location
from tidemark.sources.warehouse import Warehouse


@pytest.fixture
def house(spark):
    return Warehouse(spark, f"tm_{uuid.uuid4().hex}", new_location(spark, "warehouse"))


def values(df, column):
    return [r[column] for r in df.collect()]


def test_clean_category(spark):
    df = spark.createDataFrame([(None,), ("",), ("New York",), ("a  b",), ("Perú é",), ("ñ",)], "x string")
    assert values(df.select(clean_category(F.col("x")).alias("x")), "x") == [
        "missing", "", "NewmissingYork", "amissingmissingb", "Permissing", "",
    ]


def test_rules(spark):
    df = spark.createDataFrame([("SOCCER",), ("football 1025083526",), ("x",), (None,)], "x string")
    assert values(df.select(sport_bucket(F.col("x")).alias("x")), "x") == [
        "football", "american_football", "other", "other",
    ]


def test_defaults(spark):
    df = spark.createDataFrame([(1, None, float("nan"))], "k int, a string, b double")
    row = null_defaults(df, {"a": "missing", "b": 0}).first()
    assert row["a"] == "missing" and math.isnan(row["b"])
    row = assemble_defaults(df, {"a": "d", "z": 5, "b": 1.0}, static={"b": 2.0}).first()
    assert row.asDict() == {"a": None, "z": 5, "b": 2.0}


def test_humanize(spark):
    df = spark.createDataFrame([(0.0,), (999.0,), (1000.0,), (-5e6,), (1e18,), (None,)], "x double")
    assert values(df.select(kpi_humanize(F.col("x")).alias("x")), "x") == [
        "0", "999", "1 Thousand", "-5 Million", "1000000 Trillion", None,
    ]
    assert df.limit(1).select(kpi_humanize(F.lit(1234567), 2)).first()[0] == "1.23 Million"


def test_count_matches_keeps_zero_and_counts_items_once(spark):
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (3, None)], "id int, item string")
    lookup = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "item string")
    found = {r["id"]: r["n"] for r in count_matches(pairs, lookup, ["id"], "item", "n").collect()}
    assert found == {1: 2, 2: 0, 3: 0}


def test_join_rejects_clashes(spark):
    a = spark.createDataFrame([(1, 2)], "k int, x int")
    with pytest.raises(ValueError, match="x"):
        join_on_keys([a, a], ["k"])
    assert join_on_keys([a, a.withColumnRenamed("x", "y")], ["k"]).first().asDict() == {"k": 1, "x": 2, "y": 2}


def test_seen_values(spark):
    train = spark.createDataFrame([(1, "a"), (None, "b")], "u int, k string")
    check = spark.createDataFrame([(1, "a"), (1, "z"), (2, "a"), (None, "b"), (1, None)], "u int, k string")
    kept = {tuple(r) for r in seen_values_only(check, train, ["u", "k"]).collect()}
    assert kept == {(1, "a"), (None, "b")}


# ---- upsert ---------------------------------------------------------------------


def predictions(spark, rows):
    return spark.createDataFrame(rows, "id long, submodel_name string, model_value double")


def test_merge(spark, house):
    first = predictions(spark, [(1, "a", 1.0), (2, "a", 2.0), (1, "it's", 3.0)])
    write_predictions(house, first, "p")
    second = predictions(spark, [(2, "a", 20.0), (3, "a", 30.0), (9, "new", 9.0)])
    expected = {(1, "a", 1.0), (2, "a", 20.0), (3, "a", 30.0), (1, "it's", 3.0), (9, "new", 9.0)}
    for _ in range(2):  # merging again changes nothing
        table = write_predictions(house, second, "p")
        assert {(r["id"], r["submodel_name"], r["model_value"]) for r in table.collect()} == expected
    # Replaced versions are gone, untouched submodels were not rewritten.
    kept = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {house.name('p__data')}").collect()}
    assert kept == {"submodel_name=a/_bucket=0/_version=3", "submodel_name=it%27s/_bucket=0/_version=1", "submodel_name=new/_bucket=0/_version=3"}


def stored_files(house, table):
    return {r["file"] for r in house.table(f"{table}__data").select(F.col("_metadata.file_path").alias("file")).distinct().collect()}


def test_a_row_rewrites_its_bucket_only(spark, house):
    table = VersionedTable(house, "p", bucket_rows=100)
    rows = spark.range(2000).select("id", F.lit("big").alias("submodel_name"), F.col("id").cast("double").alias("model_value"))
    table.merge(rows.unionByName(predictions(spark, [(1, "small", 0.5)])))
    before = stored_files(house, "p")
    assert len({f.rsplit("/", 1)[0] for f in before}) == 21  # twenty buckets and one
    table.merge(predictions(spark, [(77, "big", -1.0)]))
    after = stored_files(house, "p")
    gone, new = before - after, after - before
    assert len({f.rsplit("/", 1)[0] for f in gone}) == len({f.rsplit("/", 1)[0] for f in new}) == 1
    found = {r["id"]: r["model_value"] for r in table.read().filter("submodel_name = 'big'").collect()}
    assert len(found) == 2000 and found[77] == -1.0 and found[78] == 78.0 and table.read().columns == rows.columns


def test_a_submodel_that_grows_gets_more_buckets(spark, house):
    table = VersionedTable(house, "p", bucket_rows=10)
    rows = lambda lo, hi: spark.range(lo, hi).select("id", F.lit("m").alias("submodel_name"), F.lit(1.0).alias("model_value"))
    table.merge(rows(0, 5))
    assert [tuple(r) for r in table.current().collect()] == [("m", 1, 0, 1)]
    table.merge(rows(3, 30))
    assert {r["_buckets"] for r in table.current().collect()} == {1} and table.read().count() == 30
    table.merge(rows(20, 200))
    assert {r["_buckets"] for r in table.current().collect()} == {21} and table.read().count() == 200
    assert {f.split("/")[-2] for f in stored_files(house, "p")} == {"_version=3"}


def test_many_submodels_merge_in_one_statement(spark, house):
    rows = spark.range(600).select("id", F.concat(F.lit("it's "), F.col("id").cast("string")).alias("submodel_name"), F.lit(1.0).alias("model_value"))
    table = VersionedTable(house, "p")
    table.merge(rows)
    table.merge(rows.filter("id % 3 = 0").withColumn("model_value", F.lit(2.0)))
    assert {(r["model_value"], r["n"]) for r in table.read().groupBy("model_value").agg(F.count("*").alias("n")).collect()} == {(1.0, 400), (2.0, 200)}
    assert spark.sql(f"SHOW PARTITIONS {house.name('p__data')}").count() == 600
    assert spark.sql(f"SHOW PARTITIONS {house.name('p__versions')}").count() == 1
    assert len(spark.sql(f"SHOW CREATE TABLE {house.name('p')}").first()[0]) < 1500  # the view does not list submodels
    with pytest.raises(ValueError):
        table.merge(predictions(spark, [(1, None, 1.0)]))


def test_merge_refuses_duplicate_keys(spark, house):
    write_predictions(house, predictions(spark, [(1, "a", 1.0)]), "p")
    with pytest.raises(DuplicateKeys):
        write_predictions(house, predictions(spark, [(2, "a", 1.0), (2, "a", 2.0)]), "p")
    assert VersionedTable(house, "p").read().count() == 1
    with pytest.raises(ValueError):
        write_predictions(house, predictions(spark, []), "p", method="replace")


def test_truncate_load(spark, house):
    write_predictions(house, predictions(spark, [(1, "a", 1.0), (2, "b", 1.0)]), "p")
    table = write_predictions(house, predictions(spark, [(7, "c", 7.0)]), "p", method="truncate")
    assert [tuple(r) for r in table.select("id", "submodel_name").collect()] == [(7, "c")]


# ---- preparation ----------------------------------------------------------------


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (i, float(i), i % 3, "x" if i % 4 else None, "a,b" if i % 2 else "b", None, 1.0, 1 if i % 5 else 0)
        for i in range(1000)
    ]
    return spark.createDataFrame(
        rows,
        "id int, amount double, level int, kind string, tags string, empty double, same double, flag int",
    )


PREDICTORS = ["amount", "level", "kind", "tags", "empty", "same", "flag"]
OPTIONS = ProfileOptions(max_cat_ratio=0.01, low_info_thresh=1)


def test_profile(raw):
    found = {p.column: p for p in profile_columns(raw, PREDICTORS, OPTIONS)}
    kinds = {c: p.type for c, p in found.items()}
    assert kinds == {
        "amount": "regular", "level": "categorial", "kind": "categorial", "tags": "multilabel",
        "empty": "categorial", "same": "categorial", "flag": "categorial",
    }
    assert found["kind"].counts == {"x": 750, "nan": 250}
    assert found["tags"].counts == {"a": 500, "b": 1000}
    assert found["empty"].counts == {"nan": 1000}


def test_values_are_chosen_before_they_leave_spark(spark, monkeypatch):
    """A text column with a value for nearly every row: the driver gets the values that become model columns."""
    from tidemark.operators import profile

    rows = 400_000
    df = spark.range(rows).select(
        F.when(F.col("id") % 4 == 0, "often").when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), "id")).alias("word"),
        F.concat_ws(",", F.lit("all"), F.when(F.col("id") % 3 == 0, "third"), F.concat(F.lit("t"), "id")).alias("tags"),
        F.concat(F.lit("few"), F.col("id") % 7).alias("few"),
    )
    seen = []
    real = profile._collected_counts
    monkeypatch.setattr(profile, "_collected_counts", lambda counts, *rest: seen.append(counts.count()) or real(counts, *rest))
    options = ProfileOptions(low_info_thresh=0.9)
    found = {p.column: p for p in profile_columns(df, df.columns, options)}
    assert seen == [2 + 1 + 7]
    assert found["word"].counts == {"often": rows / 4, "nan": rows * 3 / 20} and found["word"].distinct == rows * 3 / 5 + 2
    assert set(found["tags"].counts) == {"third"} and found["tags"].distinct == rows + 2 and found["few"].distinct == len(found["few"].counts) == 7
    spec = fit_spec(df, df.columns, options)
    assert spec.expanded == ["word_nan", "word_often", "tags_third", *(f"few_few{i}" for i in range(7))]
    listed = profile.dictionary(df, df.columns, options)
    assert listed.filter("column = 'word'").count() == found["word"].distinct and listed.filter("column = 'tags' and value = 'all'").first()["n"] == rows
    assert listed.filter("value = 'nan'").first()["n"] == rows * 3 / 20


def test_profile_limits_are_exact(spark):
    df = spark.range(100_000).select(
        (F.col("id") % 100).alias("hundred"), (F.col("id") % 101).alias("more"),
        (F.col("id") % 10).cast("decimal(10,2)").alias("ten"),
    )
    options = ProfileOptions(max_cat_val=100, max_cat_ratio=0.01)
    kinds = {p.column: p.type for p in profile_columns(df, df.columns, options)}
    assert kinds == {"hundred": "categorial", "more": "regular", "ten": "categorial"}
    assert fit_spec(df, ["ten"], options).expanded == [f"ten_{i}" for i in range(10)]
    strict = ProfileOptions(max_cat_val=100, max_cat_ratio=0.001)
    assert profile_columns(df, ["hundred"], strict)[0].type == "regular"


def test_spec_round_trip_and_columns(spark, raw):
    spec = fit_spec(raw, PREDICTORS, OPTIONS)
    assert spec.expanded == [
        "amount", "level_0", "level_1", "level_2", "kind_nan", "kind_x", "tags_a", "tags_b",
        "empty_nan", "same_1", "flag_1",
    ]
    path = new_location(spark, "spec")
    save_spec(spark, spec, path)
    assert load_spec(spark, path) == spec
    fitted = apply_spec(raw, spec, ["id"])
    assert fitted.exceptAll(apply_spec(raw, load_spec(spark, path), ["id"])).isEmpty()
    row = fitted.agg(F.avg("amount").alias("m"), F.stddev_pop("amount").alias("s")).first()
    assert abs(row["m"]) < 1e-9 and abs(row["s"] - 1) < 1e-9
    assert "Exchange" not in fitted._jdf.queryExecution().executedPlan().toString()


def test_spec_on_other_data(spark, raw):
    spec = fit_spec(raw, PREDICTORS, OPTIONS)
    other = spark.createDataFrame(
        [(1, None, 7, "unseen", "b,zzz", 5, 0.0)],
        "id int, amount double, level int, kind string, tags string, extra int, same double",
    )
    row = apply_spec(other, spec, ["id"]).first().asDict()
    assert row["amount"] is None
    assert [row[c] for c in ("level_0", "level_1", "level_2", "kind_x", "kind_nan")] == [0] * 5
    assert (row["tags_a"], row["tags_b"], row["same_1"], row["flag_1"]) == (0, 1, 0, 0)
    assert "extra" not in row


def test_low_info_columns_go(raw):
    spec = fit_spec(raw, ["kind", "same", "flag"], OPTIONS._replace(low_info_thresh=0.76))
    assert spec.expanded == ["kind_nan", "kind_x"]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.5,), (1.5,), (None,)], "x double")
    spec = fit_spec(df, ["x"], ProfileOptions(max_cat_ratio=0))
    assert sorted(values(apply_spec(df, spec), "x"), key=str) == [0.0, 0.0, None]


def test_roles(spark, raw):
    df, roles = split_roles(raw, ["id"], "flag")
    assert roles.label == "flag" and "flag" not in roles.predictors
    keyed, roles = split_roles(raw.drop("id"))
    assert roles.keys == ("row_id",) and keyed.select("row_id").distinct().count() == 1000
    with pytest.raises(ValueError):
        split_roles(raw.limit(0), ["id"])
    with pytest.raises(ValueError):
        split_roles(raw, ["nothing"])


def test_label_onehot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, y string")
    flags = label_onehot(df, "y", label_classes(df, "y")).orderBy("id").collect()
    assert [tuple(r) for r in flags] == [(1, 0, 1), (2, 1, 0), (3, 0, 0)]


def test_undersample_is_exact_and_seeded(spark):
    df = spark.range(10_000).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))
    kept, pi, mu = undersample(df, "y", ["id"], ratio=2, seed=1)
    counts = {r["y"]: r["count"] for r in kept.groupBy("y").count().collect()}
    assert counts == {0: 2000, 1: 1000} and kept.select("id").distinct().count() == 3000
    assert pi == pytest.approx(0.1) and mu == pytest.approx(1 / 3)
    again, _, _ = undersample(df.repartition(5), "y", ["id"], ratio=2, seed=1)
    assert kept.exceptAll(again).isEmpty()
    other, _, _ = undersample(df, "y", ["id"], ratio=2, seed=2)
    assert not kept.exceptAll(other).isEmpty()
    with pytest.raises(ValueError):
        undersample(df.filter("y = 0"), "y", ["id"])


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(20_000)
    train, test = train_test_split(df, ["id"], 0.8, seed=4)
    assert train.count() + test.count() == 20_000
    assert train.join(test, "id").isEmpty()
    assert abs(train.count() / 20_000 - 0.8) < 0.02
    again, _ = train_test_split(df.repartition(3), ["id"], 0.8, seed=4)
    assert train.exceptAll(again).isEmpty()


def test_encoder_orders_numbers_as_numbers(spark):
    df = spark.createDataFrame([(10, "x"), (9, "y"), (100, "x"), (None, "z")], "n int, s string")
    encoder = fit_encoder(df, "n")
    assert {r["value"]: r["code"] for r in encoder.collect()} == {9: 0, 10: 1, 100: 2}
    codes = apply_encoder(df, "n", encoder)
    assert {r["n"]: r["n_code"] for r in codes.collect()} == {9: 0, 10: 1, 100: 2, None: None}
    encoded, encoders = label_encode(df.filter("n is not null"), ["n", "s"])
    assert set(encoders) == {"n", "s"}
    assert {tuple(r) for r in encoded.select("n", "s").collect()} == {(1, 0), (0, 1), (2, 0)}


def test_pca_is_centred_and_orthogonal(spark):
    df = spark.range(500).select(
        F.col("id"), (F.rand(1) * 3 + 100).alias("a"), F.rand(2).alias("b"), (F.rand(3) * 0.1).alias("c")
    ).cache()
    model = fit_pca(df, ["a", "b", "c"], 2)
    row = apply_pca(df, model, ["id"]).agg(
        F.avg("pc_0").alias("m"), F.corr("pc_0", "pc_1").alias("r"),
        F.var_pop("pc_0").alias("v0"), F.var_pop("pc_1").alias("v1"),
    ).first()
    assert abs(row["m"]) < 1e-9 and abs(row["r"]) < 1e-9 and row["v0"] > row["v1"]


def test_windows_from_control_rows(spark):
    control = spark.createDataFrame([("t", "2024-01-10", "2024-01-20")], "table_name string, date_from string, date_to string")
    assert window_variables(date_windows(control, 3)) == {"t_date_from": "2024-01-07", "t_date_to": "2024-01-20"}
    fixed = date_windows(control, 3, date_from="2023-12-01", date_to="2023-12-31")
    assert window_variables(fixed) == {"t_date_from": "2023-12-01", "t_date_to": "2023-12-31"}


def test_template_folder(spark, tmp_path):
    (tmp_path / "b.sql").write_text("SELECT :x AS b")
    (tmp_path / "a.sql").write_text("SELECT :x + 1 AS a")
    templates = load_templates(str(tmp_path))
    assert list(templates) == ["a", "b"]
    results = run_templates(spark, templates, {"x": "1; DROP"} | {"x": 4})
    assert results["a"].first()[0] == 5


def test_not_a_number_counts_as_null(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 1.0)] * 50 + [(nan, 3.0), (None, nan)], "few double, x double")
    spec = fit_spec(df, ["few"], ProfileOptions(max_cat_ratio=0.9, low_info_thresh=1))
    assert spec.expanded == ["few_1", "few_nan"]
    assert apply_spec(df, spec).agg(F.sum("few_nan").alias("n")).first()["n"] == 2
    scaled = fit_spec(df, ["x"], ProfileOptions(max_cat_ratio=0)).columns[0]
    assert scaled.mean == pytest.approx((50 + 3) / 51)
    odd = spark.createDataFrame([(inf, 0.0)], "few double, x double")
    assert apply_spec(odd, spec).first()["few_nan"] == 1


def test_sparse_features_equal_the_columns(spark):
    from tidemark.operators.encode import sparse_features
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(i, f"v{i % 5}", float(i)) for i in range(100)], "id int, s string, x double")
    spec = fit_spec(df, ["s"], ProfileOptions(low_info_thresh=1))
    narrow = apply_spec(df, spec, ["id"]).select("id", F.array(*spec.expanded).alias("flags"))
    wide = sparse_features(df, ["s", "x"]).fit(df).transform(df).select(
        "id", vector_to_array("features").alias("v")
    )
    joined = narrow.join(wide, "id").filter(
        (F.slice("v", 1, 5) != F.col("flags").cast("array<double>")) | (F.get("v", F.size("v") - 1) != F.col("id"))
    )
    assert joined.isEmpty()


def test_dominant_key_gives_the_same_rows(spark):
    """A third of all rows share one key; joins and encoders keep every row."""
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key")
    )
    encoder = fit_encoder(df, "key")
    coded = apply_encoder(df, "key", encoder)
    assert coded.count() == 30_000 and coded.filter("key_code is null").isEmpty()
    assert coded.filter("key = 7").select("key_code").distinct().count() == 1
    kept = seen_values_only(df, df.filter("id % 2 = 0"), ["key"])
    # Row 7 carries the dominant key by itself.
    assert kept.count() == df.filter("id % 3 = 0 or id % 2 = 0 or id = 7").count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
