"""Feature preparation queries."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite.tables import Check, Tables, check, key_number
from tidemark.operators.encode import apply_encoder, categorical_features, fit_encoder
from tidemark.operators.preparation import (
    apply_pca,
    apply_spec,
    class_counts,
    fit_pca,
    fit_spec,
    label_classes,
    label_onehot,
    load_spec,
    save_spec,
    spec_rows,
    split_roles,
)
from tidemark.operators.profile import ProfileOptions, profile_columns
from tidemark.operators.sampling import train_test_split, undersample
from tidemark.operators.windows import distinct_list
from tidemark.session import new_location

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
LINE_COLUMNS = [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
# The default ratio of 0.0001 fits tables of millions of rows.
OPTIONS = ProfileOptions(max_cat_ratio=0.01)


def roles(t: Tables) -> DataFrame:
    _, found = split_roles(t.customer, ["c_custkey"], "c_mktsegment")
    columns = F.explode(F.array(*[F.lit(c) for c in t.customer.columns])).alias("column")
    names = t.customer.agg(F.count(F.lit(1)).alias("n")).select("n", columns)
    column = F.col("column")
    role = (
        F.when(column.isin(*found.keys), "key")
        .when(column == found.label, "label")
        .when(column.isin(*found.predictors), "predictor")
    )
    return names.select("column", "n", role.alias("role"))


def quality_onehot(t: Tables) -> DataFrame:
    classes = label_classes(t.labels, "quality")
    flags = label_onehot(t.labels, "quality", classes)
    counts = class_counts(t.labels, "quality").withColumnRenamed("n", "class_size")
    return flags.join(t.labels.select("doc_id", "quality"), "doc_id").join(counts, "quality").drop("quality")


def profiled(t: Tables) -> DataFrame:
    found = profile_columns(t.lineitem, LINE_COLUMNS, OPTIONS)
    rows = [(p.column, p.type, p.rows, len(p.counts)) for p in found]
    return t.spark.createDataFrame(rows, "column string, type string, n long, values long")


def scaled(t: Tables) -> DataFrame:
    spec = fit_spec(t.lineitem, ["l_quantity", "l_extendedprice"], ProfileOptions(max_cat_ratio=0))
    return apply_spec(t.lineitem, spec, LINE_KEYS).select(
        *LINE_KEYS,
        F.round("l_quantity", 6).alias("quantity"),
        F.round("l_extendedprice", 6).alias("price"),
    )


def onehot(t: Tables) -> DataFrame:
    spec = fit_spec(t.orders, ["o_orderstatus", "o_orderpriority"], OPTIONS)
    return apply_spec(t.orders, spec, ["o_orderkey"])


def event_flags(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", "event_type",
        (F.col("event_id") % 1000 == 0).cast("int").alias("rare"),
        (F.col("event_id") % 2).alias("even"),
    )


def low_info(t: Tables) -> DataFrame:
    spec = fit_spec(event_flags(t), ["event_type", "rare", "even"], OPTIONS)
    return apply_spec(event_flags(t), spec, ["event_id"])


def user_lists(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        distinct_list(F.col("event_type"), "|").alias("types")
    )


def multilabel(t: Tables) -> DataFrame:
    lists = user_lists(t)
    spec = fit_spec(lists, ["types"], OPTIONS._replace(separator="|"))
    return apply_spec(lists, spec, ["user_id", "day"])


def encoded(t: Tables) -> DataFrame:
    brands = fit_encoder(t.part, "p_brand")
    sizes = fit_encoder(t.part, "p_size")
    rows = t.part.select("p_partkey", "p_brand", "p_size")
    rows = apply_encoder(rows, "p_brand", brands, "brand_code")
    return apply_encoder(rows, "p_size", sizes, "size_code").select(
        "p_partkey", "brand_code", "size_code"
    )


def components(t: Tables) -> DataFrame:
    """First five components, each with a fixed sign."""
    names = [f"e{i}" for i in range(64)]
    wide = t.embeddings.select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    )
    return component_facts(apply_pca(wide, fit_pca(wide, names, 5), ["vec_id"]), 5)


def component_facts(scores: DataFrame, components: int) -> DataFrame:
    """Rows, and what makes scores principal components: centred, uncorrelated, widest first."""
    names = [f"pc_{i}" for i in range(components)]
    spread = [F.var_pop(c) for c in names]
    alone = [F.abs(F.corr(a, b)) < 1e-6 for i, a in enumerate(names) for b in names[:i]]
    ordered = [a >= b for a, b in zip(spread, spread[1:])]
    centred = [F.abs(F.avg(c)) < 1e-6 for c in names]
    return scores.agg(
        F.count(F.lit(1)).alias("n"), reduce(and_, centred).alias("centred"), reduce(and_, ordered).alias("in_order"), reduce(and_, alone).alias("uncorrelated")
    )


def undersample_shares(t: Tables) -> DataFrame:
    kept, pi, mu = undersample(t.labels, "quality", ["doc_id"], ratio=2, seed=3)
    return kept.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).select(
        "quality", "n", F.round(F.lit(pi), 6).alias("pi"), F.round(F.lit(mu), 6).alias("mu")
    )


def _events(t: Tables) -> DataFrame:
    return t.events.withColumn("k", key_number() % 7)


def applied_spec(t: Tables) -> DataFrame:
    """Fitted on the first 20 days, stored, reloaded and applied to the rest."""
    rows = _events(t)
    cut = F.lit("2024-01-21").cast("timestamp_ntz")
    options = OPTIONS._replace(max_cat_ratio=0.05)
    spec = fit_spec(rows.filter(F.col("ts") < cut), ["event_type", "value", "k"], options)
    path = new_location(t.spark, "spec")
    save_spec(t.spark, spec, path)
    later = apply_spec(rows.filter(F.col("ts") >= cut), load_spec(t.spark, path), ["event_id"])
    return later.withColumn("value", F.round("value", 6))


def stored_spec(t: Tables) -> DataFrame:
    spec = fit_spec(t.lineitem, LINE_COLUMNS, OPTIONS._replace(low_info_thresh=1))
    path = new_location(t.spark, "spec")
    save_spec(t.spark, spec, path)
    rows = spec_rows(t.spark, load_spec(t.spark, path))
    return rows.select(
        "position", "column", "type", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        F.array_join("values", "|").alias("values"), F.array_join("expanded", "|").alias("expanded"),
    )


def split_parts(t: Tables) -> DataFrame:
    train, test = train_test_split(t.lineitem, LINE_KEYS, 0.8, seed=5)
    both = train.select(*LINE_KEYS, F.lit(1).alias("train")).unionByName(test.select(*LINE_KEYS, F.lit(0).alias("train")))
    keys = both.groupBy(*LINE_KEYS).agg(F.count(F.lit(1)).alias("n"), F.min("train").alias("low"), F.max("train").alias("high"))
    return keys.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("keys"), F.max(F.col("low") != F.col("high")).alias("shared"),
        (F.abs(F.avg("high") - 0.8) < 0.02).alias("four_fifths"),
    )


def passthrough(t: Tables) -> DataFrame:
    pipeline = categorical_features(t.lineitem, LINE_COLUMNS)
    return pipeline.fit(t.lineitem).transform(t.lineitem).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_returnflag_index", "l_linestatus_index"
    )


def _flag(column: str, value: str, name: str | None = None) -> str:
    return f"CAST({column} = '{value}' AS BIGINT) AS \"{name or column + '_' + value}\""


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["click", "error", "purchase", "signup", "view"]

CHECKS: dict[str, Check] = {
    "split_roles": check(
        roles,
        """SELECT x[1] AS "column", n, x[2] AS role FROM (SELECT count(*) AS n FROM customer),
        (SELECT unnest([['c_custkey', 'key'], ['c_name', 'predictor'],
          ['c_nationkey', 'predictor'], ['c_acctbal', 'predictor'], ['c_mktsegment', 'label']]) AS x)""",
    ),
    "label_onehot": check(
        quality_onehot,
        """SELECT doc_id, CAST(toxic AS BIGINT) AS toxic, CAST(quality = 0 AS BIGINT) AS quality_0,
        CAST(quality = 1 AS BIGINT) AS quality_1, count(*) OVER (PARTITION BY quality) AS class_size
        FROM labels""",
    ),
    "profile_columns": check(
        profiled,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CASE WHEN {kind} THEN 'categorial' ELSE 'regular' END AS type,
            count(*) AS n, CASE WHEN {kind} THEN count(DISTINCT {value}) ELSE 0 END AS "values"
            FROM lineitem"""
            for c, kind, value in [
                (c, f"count(DISTINCT {c}) <= 100 AND count(DISTINCT {c}) / count(*) < 0.01",
                 f"CAST(trunc({c}) AS BIGINT)")
                for c in LINE_COLUMNS[:4]
            ] + [(c, "true", c) for c in LINE_COLUMNS[4:]]
        ),
    ),
    "standard_scale": check(
        scaled,
        """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
        round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 6) AS quantity,
        round((l_extendedprice - avg(l_extendedprice) OVER ())
          / stddev_pop(l_extendedprice) OVER (), 6) AS price FROM lineitem""",
    ),
    "onehot": check(
        onehot,
        "SELECT o_orderkey, "
        + ", ".join(_flag("o_orderstatus", v) for v in "FOP")
        + ", "
        + ", ".join(_flag("o_orderpriority", v) for v in PRIORITIES)
        + " FROM orders",
    ),
    "drop_low_info": check(
        low_info,
        "SELECT event_id, "
        + ", ".join(_flag("event_type", v) for v in TYPES)
        + ", event_id % 2 AS even_1 FROM events",
    ),
    "multilabel_binarize": check(
        multilabel,
        "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, "
        + ", ".join(f"CAST(max(event_type = '{v}') AS BIGINT) AS types_{v}" for v in TYPES)
        + " FROM events GROUP BY 1, 2",
    ),
    "label_encode": check(
        encoded,
        """SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_code,
        dense_rank() OVER (ORDER BY p_size) - 1 AS size_code FROM part""",
    ),
    "pca": check(components, "SELECT count(*) AS n, TRUE AS centred, TRUE AS in_order, TRUE AS uncorrelated FROM embeddings"),
    "undersample": check(
        undersample_shares,
        """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY 1),
        s AS (SELECT quality, n, least(n, 2 * min(n) OVER ()) AS kept FROM c)
        SELECT CAST(quality AS BIGINT) AS quality, kept AS n,
        round(max(CASE WHEN quality = 1 THEN n END) OVER () / sum(n) OVER (), 6) AS pi,
        round(min(kept) OVER () / sum(kept) OVER (), 6) AS mu FROM s""",
    ),
    "transform_with_spec": check(
        applied_spec,
        """WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) % 7 AS k FROM events),
        fit AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM e WHERE ts < TIMESTAMP '2024-01-21')
        SELECT event_id, """
        + ", ".join(_flag("event_type", v) for v in TYPES)
        + ", round((value - m) / s, 6) AS value, "
        + ", ".join(f"CAST(k = {v} AS BIGINT) AS k_{v}" for v in range(7))
        + " FROM e, fit WHERE ts >= TIMESTAMP '2024-01-21'",
    ),
    "column_spec_store": check(
        stored_spec,
        " UNION ALL ".join(
            f"""SELECT {i} AS position, '{c}' AS "column", 'regular' AS type,
            round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std,
            '' AS "values", '{c}' AS expanded FROM lineitem
            HAVING NOT (count(DISTINCT {c}) <= 100 AND count(DISTINCT {c}) / count(*) < 0.01)
            UNION ALL SELECT {i}, '{c}', 'categorial', round(avg(x), 4), round(stddev_pop(x), 4),
            string_agg(DISTINCT v, '|' ORDER BY CAST(v AS BIGINT)), '{c}_' || string_agg(DISTINCT v, '|{c}_' ORDER BY v)
            FROM (SELECT {c} AS x, CAST(CAST(trunc({c}) AS BIGINT) AS VARCHAR) AS v FROM lineitem)
            HAVING count(DISTINCT x) <= 100 AND count(DISTINCT x) / count(*) < 0.01"""
            for i, c in enumerate(LINE_COLUMNS[:4])
        )
        + " UNION ALL "
        + " UNION ALL ".join(
            f"""SELECT {i}, '{c}', 'categorial', NULL, NULL, string_agg(DISTINCT {c}, '|' ORDER BY {c}),
            '{c}_' || string_agg(DISTINCT {c}, '|{c}_' ORDER BY {c}) FROM lineitem"""
            for i, c in enumerate(LINE_COLUMNS) if i > 3
        ),
    ),
    "train_test_split": check(
        split_parts,
        f"SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT {', '.join(LINE_KEYS)} FROM lineitem)) AS keys, FALSE AS shared, TRUE AS four_fifths FROM lineitem",
    ),
    "categorical_passthrough": check(
        passthrough,
        """SELECT l_orderkey, l_linenumber, l_returnflag,
        CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS DOUBLE) AS l_returnflag_index,
        CAST(dense_rank() OVER (ORDER BY l_linestatus) - 1 AS DOUBLE) AS l_linestatus_index FROM lineitem""",
    ),
}
