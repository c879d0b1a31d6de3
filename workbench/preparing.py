"""Imputation, encoding, sampling, feature and model queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabprep.operators import encode, fill, impute, resample, scale, split
from tabprep.operators.knn import fit_knn
from tabprep.plans import features as fx
from tabprep.plans import modelling
from tabprep.plans.prepare import PreparePlan
from tabprep.plans.store import load_model, save_model
from tabprep.session import ensure_checkpoint_dir, materialise
from tabprep.sizing import local_table
from tabprep.streaming.apply import module_stream, write_prepared
from workbench.profiling import ORDER_GAPS, labelled_documents, order_gaps
from workbench.registry import ORACLES, query, rounded, table


@query("impute_median", f"""
    WITH {ORDER_GAPS} SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM orders_gaps)), 4) AS price FROM orders_gaps
""")
def impute_median(spark, root):
    orders = order_gaps(spark, root)
    return rounded(impute.fit_median(orders, ["price"]).transform(orders).select("o_orderkey", "price"))


@query("impute_mean", f"""
    WITH {ORDER_GAPS} SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM orders_gaps)), 4) AS price FROM orders_gaps
""")
def impute_mean(spark, root):
    orders = order_gaps(spark, root)
    return rounded(impute.fit_mean(orders, ["price"]).transform(orders).select("o_orderkey", "price"))


@query("impute_mode", f"""
    WITH {ORDER_GAPS}
    SELECT o_orderkey, coalesce(priority, (SELECT priority FROM orders_gaps WHERE priority IS NOT NULL GROUP BY 1
                                           ORDER BY count(*) DESC, priority LIMIT 1)) AS priority FROM orders_gaps
""")
def impute_mode(spark, root):
    orders = order_gaps(spark, root)
    return impute.fit_mode(orders, ["priority"]).transform(orders).select("o_orderkey", "priority")


@query("imputation_report", f"""
    WITH {ORDER_GAPS}
    SELECT 'price' AS variable, count(*) FILTER (price IS NULL) AS missing_before, 0::BIGINT AS missing_after,
           count(*) FILTER (price IS NULL) AS imputed FROM orders_gaps
    UNION ALL
    SELECT 'priority', count(*) FILTER (priority IS NULL), count(*) FILTER (priority IS NULL), 0 FROM orders_gaps
""")
def imputation_report(spark, root):
    orders = order_gaps(spark, root)
    after = impute.fit_mean(orders, ["price"]).transform(orders)
    return impute.imputation_report(orders, after, ["price", "priority"])


def event_gaps(spark, root):
    """Only purchases and errors carry a reading."""
    return table(spark, root, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type").isin("purchase", "error"), F.col("value")).alias("reading"))


_EVENT_GAPS = "e AS (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('purchase', 'error') THEN value END AS reading FROM events)"


@query("ffill_bfill", f"""
    WITH {_EVENT_GAPS}
    SELECT event_id, user_id, coalesce(
        last_value(reading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(reading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ) AS reading FROM e
""")
def ffill_bfill(spark, root):
    filled = fill.fill_in_order(event_gaps(spark, root), ["reading"], ["ts", "event_id"], ["user_id"])
    return filled.select("event_id", "user_id", "reading")


_FFILL_GLOBAL = f"""
    WITH {_EVENT_GAPS}
    SELECT event_id, coalesce(
        last_value(reading IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(reading IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ) AS reading FROM e
"""


@query("ffill_global", _FFILL_GLOBAL)
def ffill_global(spark, root):
    filled = fill.fill_in_order(event_gaps(spark, root), ["reading"], ["ts", "event_id"])
    return filled.select("event_id", "reading")


PART_MEASURES = """m AS (
    SELECT p_partkey AS id, p_brand, p_type,
           sum(l_quantity) / count(*) AS q, sum(round(l_extendedprice * 100)::BIGINT) / 100.0::DOUBLE / count(*) / 1000 AS e,
           sum(round(l_discount * 100)::BIGINT)::DOUBLE / count(*) AS d, sum(round(l_tax * 100)::BIGINT)::DOUBLE / count(*) AS t
    FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL),
g AS (SELECT id,
           CASE WHEN p_brand NOT IN ('Brand#1', 'Brand#2') THEN q END AS q,
           CASE WHEN p_brand NOT IN ('Brand#2', 'Brand#3') OR p_type = 'PROMO' THEN e END AS e,
           CASE WHEN p_brand <> 'Brand#4' AND (p_brand <> 'Brand#2' OR p_type <> 'SMALL') THEN d END AS d,
           CASE WHEN p_brand <> 'Brand#5' AND (p_brand <> 'Brand#2' OR p_type <> 'SMALL') THEN t END AS t FROM m)"""


def part_measures(spark, root):
    """Four measures per part, averaged over its lines, with gaps by brand and type. Cents are summed as integers."""
    def cents(c):
        return F.sum(F.round(F.col(c) * 100).cast("bigint"))

    n, brand, kind = F.count(F.lit(1)), F.col("p_brand"), F.col("p_type")
    means = table(spark, root, "lineitem").groupBy("l_partkey").agg(
        (F.sum("l_quantity") / n).alias("q"), (cents("l_extendedprice") / F.lit(100.0) / n / 1000).alias("e"),
        (cents("l_discount").cast("double") / n).alias("d"), (cents("l_tax").cast("double") / n).alias("t"))
    parts = table(spark, root, "part").select(F.col("p_partkey").alias("id"), "p_brand", "p_type")
    joined = parts.join(means, F.col("id") == F.col("l_partkey"))
    small = (brand == "Brand#2") & (kind == "SMALL")
    # Imputation reads its input several times, so a derived input is fixed first.
    return materialise(joined.select(
        "id", F.when(~brand.isin("Brand#1", "Brand#2"), F.col("q")).alias("q"),
        F.when(~brand.isin("Brand#2", "Brand#3") | (kind == "PROMO"), F.col("e")).alias("e"),
        F.when((brand != "Brand#4") & ~small, F.col("d")).alias("d"),
        F.when((brand != "Brand#5") & ~small, F.col("t")).alias("t"),
    ))


def knn_sql(source: str, cols: list[str], k: int = 5) -> str:
    """CTEs that impute `cols` of the CTE `source` (unique `id`) by looking at every pair; the last one is `imputed`."""
    n = len(cols)
    square = " + ".join(f"coalesce((r.{c} - n.{c}) * (r.{c} - n.{c}), 0)" for c in cols)
    shared = " + ".join(f"(r.{c} - n.{c} IS NOT NULL)::INT" for c in cols)
    gaps = " OR ".join(f"r.{c} IS NULL" for c in cols)
    cells = " UNION ALL ".join(
        f"SELECT id, '{c}' AS c, donor, v_{c} AS v, sqrt(sq * ({n}.0::DOUBLE / shared)) AS dist FROM pairs "
        f"WHERE m_{c} AND v_{c} IS NOT NULL AND shared > 0" for c in cols
    )
    columns = ", ".join(f"coalesce(s.{c}, f_{c}.v, (SELECT avg({c}) FROM {source})) AS {c}" for c in cols)
    joins = " ".join(f"LEFT JOIN filled f_{c} ON f_{c}.id = s.id AND f_{c}.c = '{c}'" for c in cols)
    return f"""pairs AS (
        SELECT r.id, n.id AS donor, {", ".join(f"n.{c} AS v_{c}, r.{c} IS NULL AS m_{c}" for c in cols)},
               {square} AS sq, {shared} AS shared
        FROM {source} r, {source} n WHERE {gaps}),
    cells AS ({cells}),
    near AS (SELECT * FROM cells QUALIFY row_number() OVER (PARTITION BY id, c ORDER BY dist, donor) <= {k}),
    filled AS (SELECT id, c, CASE WHEN min(dist) = 0 THEN avg(v) FILTER (dist = 0)
                             ELSE sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) END AS v FROM near GROUP BY id, c),
    imputed AS (SELECT s.* REPLACE ({columns}) FROM {source} s {joins})"""


@query("impute_knn", f"""
    WITH {PART_MEASURES}, {knn_sql("g", ["q", "e", "d", "t"])}
    SELECT id, round(q, 4) AS q, round(e, 4) AS e, round(d, 4) AS d, round(t, 4) AS t FROM imputed
""")
def impute_knn(spark, root):
    parts = part_measures(spark, root)
    return rounded(fit_knn(parts, ["q", "e", "d", "t"], ["id"]).transform(parts))


# Eight measures of every part, each unknown for about three parts in ten, with hundreds of patterns of what is known.
MANY = ["size", "price", "least_q", "most_q", "least_e", "most_e", "least_d", "most_d"]


def _unknown(j: int) -> str:
    return f"((id * 7919 + {j * 104729}) * (id % 97 + 3)) % 1000 < 300"


@query("impute_knn_many", f"""
    WITH m AS (
        SELECT l_partkey AS id, min(l_quantity) AS least_q, max(l_quantity) AS most_q, min(l_extendedprice) / 1000 AS least_e,
               max(l_extendedprice) / 1000 AS most_e, min(l_discount) * 100 AS least_d, max(l_discount) * 100 AS most_d
        FROM lineitem GROUP BY l_partkey),
    f AS (SELECT id, p_size::DOUBLE AS size, p_retailprice / 100 AS price, least_q, most_q, least_e, most_e, least_d, most_d
          FROM m JOIN part ON p_partkey = id),
    g AS (SELECT id, {", ".join(f"CASE WHEN NOT ({_unknown(j)}) THEN {c} END AS {c}" for j, c in enumerate(MANY))} FROM f),
    {knn_sql("g", MANY)}
    SELECT id, {", ".join(f"round({c}, 8) AS {c}" for c in MANY)} FROM imputed
""")
def impute_knn_many(spark, root):
    """Nearest neighbours over eight columns; nearly every row has a pattern of gaps of its own."""
    lines = table(spark, root, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    per_part = lines.groupBy(F.col("l_partkey").alias("id")).agg(
        F.min("l_quantity").alias("least_q"), F.max("l_quantity").alias("most_q"), (F.min("l_extendedprice") / 1000).alias("least_e"),
        (F.max("l_extendedprice") / 1000).alias("most_e"), (F.min("l_discount") * 100).alias("least_d"), (F.max("l_discount") * 100).alias("most_d"))
    part = table(spark, root, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("size"), (F.col("p_retailprice") / 100).alias("price"))
    known = per_part.join(part, "id").select("id", *[F.expr(f"CASE WHEN NOT ({_unknown(j)}) THEN {c} END").alias(c) for j, c in enumerate(MANY)])
    known = materialise(known)
    # Means of measures with five decimals lie on the edge of fewer places.
    return rounded(fit_knn(known, MANY, ["id"]).transform(known), 8)


@query("encode_onehot", """
    SELECT c_custkey, (c_mktsegment = 'BUILDING')::DOUBLE AS "c_mktsegment_BUILDING", (c_mktsegment = 'FURNITURE')::DOUBLE AS "c_mktsegment_FURNITURE",
           (c_mktsegment = 'HOUSEHOLD')::DOUBLE AS "c_mktsegment_HOUSEHOLD", (c_mktsegment = 'MACHINERY')::DOUBLE AS "c_mktsegment_MACHINERY"
    FROM customer
""")
def encode_onehot(spark, root):
    customer = table(spark, root, "customer").select("c_custkey", "c_mktsegment")
    return encode.fit_one_hot(customer, ["c_mktsegment"]).transform(customer)


@query("stream_encode", """
    SELECT c_custkey, c_acctbal, (c_mktsegment = 'BUILDING')::DOUBLE AS "c_mktsegment_BUILDING", (c_mktsegment = 'FURNITURE')::DOUBLE AS "c_mktsegment_FURNITURE",
           (c_mktsegment = 'HOUSEHOLD')::DOUBLE AS "c_mktsegment_HOUSEHOLD", (c_mktsegment = 'MACHINERY')::DOUBLE AS "c_mktsegment_MACHINERY"
    FROM customer
""")
def stream_encode(spark, root):
    """A model fitted on the batch, applied to the same table arriving as a stream."""
    customer = table(spark, root, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    model = encode.fit_one_hot(customer, ["c_mktsegment"])
    place = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = module_stream(spark, f"{root}/customer.parquet", customer.schema).drop("cycle", "module")
    write_prepared(model, stream, f"{place}/out", f"{place}/progress").awaitTermination()
    return spark.read.parquet(f"{place}/out")


@query("encode_ordinal", f"""
    WITH {ORDER_GAPS}, lv AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS i FROM (SELECT DISTINCT o_orderstatus AS s FROM orders))
    SELECT o_orderkey, coalesce(CASE priority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 END, -1)::DOUBLE AS priority,
           i::DOUBLE AS o_orderstatus
    FROM orders_gaps JOIN lv ON s = o_orderstatus
""")
def encode_ordinal(spark, root):
    orders = order_gaps(spark, root).select("o_orderkey", "priority", "o_orderstatus")
    model = encode.fit_ordinal(orders, ["priority", "o_orderstatus"], {"priority": ["5-LOW", "3-MEDIUM", "1-URGENT"]})
    return model.transform(orders)


@query("encode_ordinal_many", """
    SELECT c_custkey, (dense_rank() OVER (ORDER BY c_name) - 1)::DOUBLE AS c_name FROM customer
""")
def encode_ordinal_many(spark, root):
    customer = table(spark, root, "customer").select("c_custkey", "c_name")
    return encode.fit_ordinal(customer, ["c_name"], inline_levels=100).transform(customer)


_DOCS = "d AS (SELECT doc_id, source, quality FROM documents LEFT JOIN labels USING (doc_id))"


@query("encode_target", f"""
    WITH {_DOCS}, a AS (SELECT avg(quality) AS gm FROM d),
    s AS (SELECT source, sum(quality) AS s, count(quality) AS n FROM d GROUP BY source)
    SELECT doc_id, round(coalesce((s + 10 * gm) / (n + 10), gm), 6) AS source
    FROM d LEFT JOIN (SELECT * FROM s WHERE n > 0) USING (source), a
""")
def encode_target(spark, root):
    docs = labelled_documents(spark, root).select("doc_id", "source", "quality")
    return rounded(encode.fit_target(docs, ["source"], "quality", 10.0).transform(docs).select("doc_id", "source"), 6)


@query("group_means", f"WITH {_DOCS} SELECT source AS level, round(avg(quality), 6) AS mean, count(quality) AS n FROM d GROUP BY source")
def group_means(spark, root):
    return rounded(encode.group_means(labelled_documents(spark, root), "source", "quality"), 6)


@query("encode_target_folds", f"""
    WITH {_DOCS}, f AS (SELECT *, ('0x' || substr(md5('0:' || doc_id), 1, 8))::BIGINT % 5 AS fold FROM d),
    lf AS (SELECT source, fold, coalesce(sum(quality), 0) AS s, count(quality) AS n FROM f GROUP BY ALL),
    l AS (SELECT source, sum(s) AS s, sum(n) AS n FROM lf GROUP BY source),
    ff AS (SELECT fold, sum(s) AS s, sum(n) AS n FROM lf GROUP BY fold),
    b AS (SELECT fold, ((SELECT sum(s) FROM ff) - s)::DOUBLE / ((SELECT sum(n) FROM ff) - n) AS base FROM ff)
    SELECT doc_id, round((l.s - lf.s + 10 * base) / (l.n - lf.n + 10), 6) AS source
    FROM f JOIN l USING (source) JOIN lf USING (source, fold) JOIN b USING (fold)
""")
def encode_target_folds(spark, root):
    docs = labelled_documents(spark, root).select("doc_id", "source", "quality")
    return rounded(encode.target_out_of_fold(docs, "source", "quality", "doc_id").select("doc_id", "source"), 6)


@query("encode_plan", """
    WITH a AS (SELECT avg(c_acctbal) AS gm FROM customer), s AS (SELECT c_nationkey, sum(c_acctbal) AS s, count(*) AS n FROM customer GROUP BY 1)
    SELECT c_custkey, (c_mktsegment = 'BUILDING')::DOUBLE AS "c_mktsegment_BUILDING", (c_mktsegment = 'FURNITURE')::DOUBLE AS "c_mktsegment_FURNITURE",
           (c_mktsegment = 'HOUSEHOLD')::DOUBLE AS "c_mktsegment_HOUSEHOLD", (c_mktsegment = 'MACHINERY')::DOUBLE AS "c_mktsegment_MACHINERY",
           round((s + 5 * gm) / (n + 5), 4) AS c_nationkey
    FROM customer JOIN s USING (c_nationkey), a
""")
def encode_plan(spark, root):
    customer = table(spark, root, "customer").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    plan = encode.EncodingPlan.from_config({
        "onehot_cols": ["c_mktsegment"], "ordinal_cols": [],
        "target_cols": {"columns": ["c_nationkey"], "target": "c_acctbal", "smoothing": 5.0},
    })
    return rounded(plan.fit(customer).transform(customer).drop("c_acctbal"))


SURVEY = """survey AS (
    SELECT o_orderkey AS subject_id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 50000 END AS glucose_value,
           CASE WHEN o_orderpriority = '5-LOW' THEN 0 WHEN o_orderpriority <> '1-URGENT' THEN 60 + o_totalprice / 12000 END AS bp_dia,
           100 + o_totalprice / 9000 AS bp_sys, c_acctbal / 100 AS age, c_nationkey AS eth,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment,
           CASE WHEN c_nationkey < 8 THEN 1 WHEN c_nationkey < 20 THEN 2 END AS ht
    FROM orders JOIN customer ON o_custkey = c_custkey)"""


def survey_table(spark, root):
    """A consolidated table: orders as examinations, their customers as subjects."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    customer = table(spark, root, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    price, nation, priority = F.col("o_totalprice"), F.col("c_nationkey"), F.col("o_orderpriority")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("subject_id"),
        F.when(F.col("o_orderstatus") != "P", price / 50000).alias("glucose_value"),
        F.when(priority == "5-LOW", 0).when(priority != "1-URGENT", 60 + price / 12000).alias("BPX_DIA"),
        (100 + price / 9000).alias("BPX_SYS"), (F.col("c_acctbal") / 100).alias("age_years"), nation.alias("ethnicity"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("gender"),
        F.when(nation < 8, 1).when(nation < 20, 2).alias("hypertension"),
    )


@query("prepare_flagship", f"""
    WITH {SURVEY}, kept AS (
        SELECT subject_id, glucose_value, nullif(bp_dia, 0) AS bp_dia, bp_sys, trunc(age)::BIGINT AS age_years, eth,
               segment, CASE WHEN ht = 1 THEN 1 ELSE 0 END AS ht FROM survey WHERE glucose_value IS NOT NULL),
    fit AS (SELECT median(bp_dia) AS dia, (SELECT segment FROM kept WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, segment LIMIT 1) AS seg FROM kept),
    filled AS (SELECT subject_id, glucose_value, coalesce(bp_dia, dia) AS bp_dia, bp_sys, age_years, eth, coalesce(segment, seg) AS seg, ht FROM kept, fit)
    SELECT age_years, round(glucose_value, 8) AS glucose_value, round(bp_dia, 8) AS "BPX_DIA", round(bp_sys, 8) AS "BPX_SYS", eth AS ethnicity,
           CASE WHEN bp_sys > 140 OR bp_dia > 90 THEN 1 ELSE ht END::BIGINT AS hypertension,
           (seg = 'BUILDING')::DOUBLE AS "gender_BUILDING", (seg = 'HOUSEHOLD')::DOUBLE AS "gender_HOUSEHOLD", (seg = 'MACHINERY')::DOUBLE AS "gender_MACHINERY"
    FROM filled
""")
def prepare_flagship(spark, root):
    survey = survey_table(spark, root)
    plan = PreparePlan(keys=("subject_id",), encoding=encode.EncodingPlan(one_hot=("gender",)))
    return rounded(plan.fit(survey).transform(survey), 8)


@query("saved_preparation", ORACLES["prepare_flagship"])
def saved_preparation(spark, root):
    """Fit, save, load, transform."""
    survey = survey_table(spark, root)
    plan = PreparePlan(keys=("subject_id",), encoding=encode.EncodingPlan(one_hot=("gender",)))
    path = f"{ensure_checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
    save_model(plan.fit(survey), path, spark)
    return rounded(load_model(spark, path).transform(survey), 8)


@query("encode_onehot_map", """
    SELECT o_custkey, dense_rank() OVER (ORDER BY o_orderkey) - 2 AS place FROM orders
""")
def encode_onehot_map(spark, root):
    """More levels than columns: the place of the level; the first level is dropped and has place -1."""
    rows = table(spark, root, "orders").select("o_custkey", "o_orderkey")
    out = encode.fit_one_hot(rows, ["o_orderkey"]).transform(rows)
    place = F.coalesce(F.get(F.map_keys("o_orderkey_onehot"), F.lit(0)), F.lit(-1))
    return out.select("o_custkey", place.alias("place"))


@query("prepare_with_neighbours", f"""
    WITH {PART_MEASURES}, raw AS (
        SELECT id, q AS waist_cm, e AS weight_kg, d * 10 AS height_cm, t + 2 AS glucose_value,
               CASE WHEN q > 25 THEN 'high' WHEN q > 20 THEN 'low' END AS gender FROM g),
    staged AS (SELECT *, weight_kg / nullif((height_cm / 100.0::DOUBLE) * (height_cm / 100.0::DOUBLE), 0) AS bmi
               FROM raw WHERE glucose_value IS NOT NULL),
    mode AS (SELECT gender AS m FROM staged WHERE gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, gender LIMIT 1),
    {knn_sql("staged", ["waist_cm", "weight_kg", "height_cm", "bmi"])}
    SELECT round(waist_cm, 4) AS waist_cm, round(weight_kg, 4) AS weight_kg, round(height_cm, 4) AS height_cm, round(bmi, 4) AS bmi,
           round(glucose_value, 4) AS glucose_value, (coalesce(gender, m) = 'low')::DOUBLE AS gender_low
    FROM imputed, mode
""")
def prepare_with_neighbours(spark, root):
    """All ten steps, the nearest-neighbour step on the per-part measures."""
    parts = part_measures(spark, root).select(
        F.col("id").alias("subject_id"), F.col("q").alias("waist_cm"), F.col("e").alias("weight_kg"),
        (F.col("d") * 10).alias("height_cm"), F.lit(None).cast("double").alias("bmi"),
        (F.col("t") + 2).alias("glucose_value"), F.when(F.col("q") > 25, "high").when(F.col("q") > 20, "low").alias("gender"))
    plan = PreparePlan(keys=("subject_id",), encoding=encode.EncodingPlan(one_hot=("gender",)))
    return rounded(plan.fit(parts).transform(parts))


@query("stratified_split", """
    WITH h AS (SELECT doc_id, quality, md5('42:' || doc_id) AS h FROM labels),
    r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM h)
    SELECT doc_id, quality, CASE WHEN rn <= round(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r
""")
def stratified_split(spark, root):
    labels = table(spark, root, "labels").select("doc_id", "quality")
    return split.fit_split(labels, "quality", "doc_id").transform(labels)


@query("standard_scale", """
    WITH f AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_tax) AS tm, stddev_pop(l_tax) AS ts FROM lineitem WHERE l_returnflag = 'A')
    SELECT l_returnflag, count(*) AS n, round(avg((l_quantity - qm) / qs), 6) + 0.0 AS mean_q, round(stddev_pop((l_quantity - qm) / qs), 6) AS sd_q,
           round(avg((l_tax - tm) / ts), 6) + 0.0 AS mean_t
    FROM lineitem, f GROUP BY l_returnflag
""")
def standard_scale(spark, root):
    lines = table(spark, root, "lineitem").select("l_returnflag", "l_quantity", "l_tax")
    scaled = scale.fit_scaler(lines.where("l_returnflag = 'A'"), ["l_quantity", "l_tax"]).transform(lines)
    return rounded(scaled.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mean_q"), F.stddev_pop("l_quantity").alias("sd_q"),
        F.avg("l_tax").alias("mean_t")), 6)


def text_features(spark, root):
    docs = table(spark, root, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("chars"), F.size(F.split("text", " ")).cast("double").alias("words"))
    return docs.join(table(spark, root, "labels").select("doc_id", "quality", "toxic"), "doc_id")


@query("oversample_minority", """
    WITH x AS (SELECT doc_id AS k, quality, n_chars::DOUBLE AS a, len(string_split(text, ' '))::DOUBLE AS b FROM documents JOIN labels USING (doc_id)),
    n AS (SELECT count(*) FILTER (quality = 0) AS lo, count(*) FILTER (quality = 1) AS hi FROM x),
    p AS (SELECT x.k, y.k AS k2, y.a AS a2, y.b AS b2, (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) AS sq
          FROM x, x AS y WHERE x.quality = 0 AND y.quality = 0 AND x.k <> y.k),
    near AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sq, k2) AS r FROM p QUALIFY r <= 5),
    sizes AS (SELECT k, count(*) AS m FROM near GROUP BY k),
    seeds AS (SELECT k, a, b, (hi - lo) // lo + (row_number() OVER (ORDER BY md5('42:' || k), k) <= (hi - lo) % lo)::INT AS draws FROM x, n WHERE quality = 0),
    drawn AS (SELECT k, a, b, unnest(generate_series(1, draws)) AS draw FROM seeds),
    dice AS (SELECT *, md5('42:' || k || ':' || draw) AS h FROM drawn),
    u AS (SELECT dice.*, floor(('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0::DOUBLE * m) + 1 AS pick,
                 ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0::DOUBLE AS gap FROM dice JOIN sizes USING (k))
    SELECT k AS doc_id, 0 AS quality, round(a + gap * (a2 - a), 4) AS chars, round(b + gap * (b2 - b), 4) AS words, true AS synthetic, draw
    FROM u JOIN near USING (k) WHERE r = pick
    UNION ALL SELECT k, quality, a, b, false, NULL FROM x
""")
def oversample_minority(spark, root):
    rows = text_features(spark, root).drop("toxic")
    return rounded(resample.oversample_minority(rows, "quality", ["chars", "words"], "doc_id"))


@query("oversample_incomplete", """
    WITH x AS (SELECT doc_id AS k, quality, n_chars::DOUBLE AS a, CASE WHEN doc_id % 5 <> 0 THEN len(string_split(text, ' '))::DOUBLE END AS b
               FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT * FROM x WHERE quality = 0 AND b IS NOT NULL),
    n AS (SELECT count(*) FILTER (quality = 1) - count(*) FILTER (quality = 0) AS missing, count(*) FILTER (quality = 0 AND b IS NOT NULL) AS usable FROM x),
    p AS (SELECT x.k, y.k AS k2, y.a AS a2, y.b AS b2, (x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) AS sq
          FROM c AS x, c AS y WHERE x.k <> y.k),
    near AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sq, k2) AS r FROM p QUALIFY r <= 5),
    sizes AS (SELECT k, count(*) AS m FROM near GROUP BY k),
    seeds AS (SELECT k, a, b, missing // usable + (row_number() OVER (ORDER BY md5('42:' || k), k) <= missing % usable)::INT AS draws FROM c, n),
    drawn AS (SELECT k, a, b, unnest(generate_series(1, draws)) AS draw FROM seeds),
    dice AS (SELECT *, md5('42:' || k || ':' || draw) AS h FROM drawn),
    u AS (SELECT dice.*, floor(('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0::DOUBLE * m) + 1 AS pick,
                 ('0x' || substr(h, 9, 8))::BIGINT / 4294967296.0::DOUBLE AS gap FROM dice JOIN sizes USING (k))
    SELECT k AS doc_id, 0 AS quality, round(a + gap * (a2 - a), 4) AS chars, round(b + gap * (b2 - b), 4) AS words, true AS synthetic, draw
    FROM u JOIN near USING (k) WHERE r = pick
    UNION ALL SELECT k, quality, a, b, false, NULL FROM x
""")
def oversample_incomplete(spark, root):
    rows = text_features(spark, root).drop("toxic").withColumn("words", F.when(F.col("doc_id") % 5 != 0, F.col("words")))
    return rounded(resample.oversample_minority(rows, "quality", ["chars", "words"], "doc_id"))


@query("pressure_features", """
    WITH v AS (SELECT o_orderkey, 100 + o_totalprice / 9000 AS s, 60 + o_totalprice / 20000 AS d FROM orders)
    SELECT o_orderkey, round(d + (s - d) / 3, 4) AS map, round(s - d, 4) AS pulse, round(s / d, 4) AS ratio FROM v
""")
def pressure_features(spark, root):
    v = table(spark, root, "orders").select(
        "o_orderkey", (100 + F.col("o_totalprice") / 9000).alias("s"), (60 + F.col("o_totalprice") / 20000).alias("d"))
    return rounded(fx.add_features(v, {
        "map": fx.mean_arterial_pressure("s", "d"), "pulse": fx.pulse_pressure("s", "d"), "ratio": fx.pressure_ratio("s", "d"),
    }).drop("s", "d"))


@query("metabolic_features", """
    WITH v AS (SELECT c_custkey, c_acctbal / 20 AS tg, 70 + c_nationkey * 3 AS glucose, 150 + c_nationkey * 4 AS total, 30 + c_nationkey AS hdl,
                      70 + c_nationkey * 2 AS waist, c_mktsegment = 'BUILDING' AS male FROM customer)
    SELECT c_custkey, round(CASE WHEN tg > 0 THEN ln(tg * glucose / 2.0) END, 4) AS tyg, round(CASE WHEN tg > 0 THEN ln(tg * glucose / 2.0) END * waist, 4) AS tyg_waist,
           (total - hdl)::DOUBLE AS non_hdl, round(CASE WHEN tg < 400 THEN total - hdl - tg / 5.0 END, 4) AS ldl,
           round(tg / total, 4) AS tg_chol, round(glucose * waist / 405.0, 4) AS homa, round(1 / (log10(waist) + log10(glucose)), 4) AS quicki,
           ((waist > CASE WHEN male THEN 102 ELSE 88 END)::INT + (tg >= 150)::INT + (hdl < CASE WHEN male THEN 40 ELSE 50 END)::INT
            + (total >= 130 OR hdl >= 85)::INT + (glucose >= 100)::INT)::BIGINT AS score
    FROM v
""")
def metabolic_features(spark, root):
    nation = F.col("c_nationkey")
    v = table(spark, root, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 20).alias("tg"), (70 + nation * 3).alias("glucose"), (150 + nation * 4).alias("total"),
        (30 + nation).alias("hdl"), (70 + nation * 2).alias("waist"), (F.col("c_mktsegment") == "BUILDING").alias("male"))
    criteria = fx.metabolic_syndrome_criteria("waist", "tg", "hdl", "total", "hdl", "glucose", F.col("male"))
    made = fx.add_features(v, {
        "tyg": fx.tyg_index("tg", "glucose"), "tyg_waist": fx.tyg_waist("tg", "glucose", "waist"),
        "non_hdl": fx.non_hdl("total", "hdl"), "ldl": fx.friedewald_ldl("total", "hdl", "tg"), "tg_chol": fx.ratio("tg", "total"),
        "homa": fx.homa_ir("glucose", "waist"), "quicki": fx.quicki("glucose", "waist"), "score": fx.criteria_score(criteria),
    })
    return rounded(made.select("c_custkey", "tyg", "tyg_waist", "non_hdl", "ldl", "tg_chol", "homa", "quicki", "score"))


@query("diet_features", """
    SELECT p_partkey, round(400.0::DOUBLE * p_size / p_retailprice, 4) AS carb_pct, round(900.0::DOUBLE * p_size / p_retailprice, 4) AS fat_pct,
           round(p_size / p_retailprice, 4) AS shape FROM part
""")
def diet_features(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(fx.add_features(part, {
        "carb_pct": fx.energy_percent("p_size", "p_retailprice", "carb"), "fat_pct": fx.energy_percent("p_size", "p_retailprice", "fat"),
        "shape": fx.ratio("p_size", "p_retailprice"),
    }).drop("p_size", "p_retailprice"))


@query("roc_auc", """
    WITH s AS (SELECT n_chars AS s, count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS n FROM documents JOIN labels USING (doc_id) GROUP BY 1),
    w AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
    SELECT sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives, round(sum(p * (below + n / 2.0)) / (sum(p) * sum(n))::DOUBLE, 6) AS auc FROM w
""")
def roc_auc(spark, root):
    scored = labelled_documents(spark, root).select(F.col("quality").alias("label"), F.col("n_chars").alias("score"))
    return rounded(modelling.roc_auc_table(scored), 6)


@query("class_report", """
    WITH p AS (SELECT quality AS t, (n_chars > 300)::INT AS p FROM documents JOIN labels USING (doc_id)),
    c AS (SELECT k AS class, count(*) FILTER (t = k) AS actual, count(*) FILTER (p = k) AS called, count(*) FILTER (t = k AND p = k) AS hit
          FROM p, (VALUES (0), (1)) AS v(k) GROUP BY k)
    SELECT class, round(coalesce(hit::DOUBLE / nullif(called, 0), 0), 6) AS precision, round(coalesce(hit::DOUBLE / nullif(actual, 0), 0), 6) AS recall,
           round(coalesce(2.0::DOUBLE * hit / nullif(actual + called, 0), 0), 6) AS f1, actual AS support FROM c
""")
def class_report(spark, root):
    scored = labelled_documents(spark, root).where("quality IS NOT NULL").select(
        F.col("quality").alias("label"), (F.col("n_chars") > 300).cast("int").alias("prediction"))
    return rounded(modelling.class_report(scored), 6)


_HELD_OUT = """
    WITH h AS (SELECT doc_id, quality, md5('42:' || doc_id) AS h FROM documents JOIN labels USING (doc_id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM h),
    t AS (SELECT * FROM r WHERE rn > round(n * 0.8))"""


def split_text(spark, root):
    rows = text_features(spark, root)
    marked = split.fit_split(rows, "quality", "doc_id").transform(rows)
    return marked.where("split = 'train'"), marked.where("split = 'test'")


# What a trained model says is not expressible in SQL; that its figures are shares, and the rows they rest on, is.
@query("train_logistic", _HELD_OUT + """
    SELECT count(*) AS rows, count(*) FILTER (quality = 1) AS positives, true AS is_share FROM t
""")
def train_logistic(spark, root):
    """Split, scale, train and score; the area under the curve of the held-out rows, and what it rests on."""
    training, held_out = split_text(spark, root)
    scaler = scale.fit_scaler(training, ["chars", "words"])
    model = modelling.train(scaler.transform(training), "quality", ["chars", "words"], "logistic_regression", maxIter=1000)
    scored = modelling.score(model, scaler.transform(held_out), "quality")
    area = modelling.roc_auc(scored)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("positives"),
        F.max(F.lit(0.0 <= area <= 1.0)).alias("is_share"))


@query("train_forest", _HELD_OUT + """
    SELECT quality::DOUBLE AS label, count(*) AS support, true AS is_share FROM t GROUP BY quality
""")
def train_forest(spark, root):
    """100 trees; the share of held-out rows of each class that the forest finds."""
    training, held_out = split_text(spark, root)
    model = modelling.train(training, "quality", ["chars", "words"], "random_forest", numTrees=100)
    found = F.avg((F.col("label") == F.col("prediction")).cast("int"))
    return modelling.score(model, held_out, "quality").groupBy("label").agg(
        F.count(F.lit(1)).alias("support"), ((found >= 0) & (found <= 1)).alias("is_share"))


@query("forest_importance", """
    SELECT unnest(['chars', 'words']) AS feature, count(*) > 0 AS is_share, true AS sums_to_one FROM labels
""")
def forest_importance(spark, root):
    training, _ = split_text(spark, root)
    model = modelling.train(training, "quality", ["chars", "words"], "random_forest", numTrees=100)
    shares = modelling.importances(spark, model, ["chars", "words"])
    total = F.sum("importance").over(Window.partitionBy())
    return shares.select("feature", F.col("importance").between(0, 1).alias("is_share"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@query("cross_validated", """
    SELECT unnest(range(3)) AS setting, count(*) > 0 AS is_share, true AS best_is_one_of_them FROM labels
""")
def cross_validated(spark, root):
    """Three folds over a grid, boosted trees: the area of every setting."""
    training, _ = split_text(spark, root)
    validated = modelling.cross_validate(training, "quality", ["chars", "words"], "boosted_trees", {"maxDepth": [2, 3, 5]}, parallelism=9, maxIter=100)
    areas = list(enumerate(map(float, validated.avgMetrics)))
    best = max(a for _, a in areas)
    rows = local_table(spark, areas, "setting bigint, area double")
    return rows.select("setting", F.col("area").between(0, 1).alias("is_share"),
                       F.lit(any(a == best for _, a in areas)).alias("best_is_one_of_them"))


# The figures of trained models have no SQL; tests hold them on tables where they are known.
@query("logistic_figures")
def logistic_figures(spark, root):
    """Held-out area of a logistic regression, and what each feature adds to it."""
    training, held_out = split_text(spark, root)
    scaler = scale.fit_scaler(training, ["chars", "words"])
    model = modelling.train(scaler.transform(training), "quality", ["chars", "words"], "logistic_regression", maxIter=1000)
    return rounded(modelling.permutation_importance(model, scaler.transform(held_out), "quality", ["chars", "words"], "doc_id"), 6)


@query("forest_figures")
def forest_figures(spark, root):
    """Precision, recall, F1 and support per class of 100 trees on the held-out rows, with the trees' own importances."""
    training, held_out = split_text(spark, root)
    model = modelling.train(training, "quality", ["chars", "words"], "random_forest", numTrees=100)
    report = modelling.class_report(modelling.score(model, held_out, "quality"))
    shares = modelling.importances(spark, model, ["chars", "words"]).select(F.struct("feature", "importance").alias("share"))
    return rounded(report.withColumn("importances", (F.to_json(F.array(*[
        F.struct(F.lit(r["share"]["feature"]).alias("feature"), F.lit(round(r["share"]["importance"], 6)).alias("importance"))
        for r in shares.collect()])))), 6)


@query("halving_search")
def halving_search(spark, root):
    """100 trees: every trial of a successive halving over depth and leaf size, with its held-out area."""
    rows = text_features(spark, root)
    found = modelling.halving_search(rows, "quality", ["chars", "words"], "random_forest",
                                     {"maxDepth": [2, 3, 5, 8], "minInstancesPerNode": [1, 5, 20]}, "doc_id", numTrees=100)
    return rounded(found.trials, 6)


@query("run_metadata", """
    WITH h AS (SELECT doc_id, quality, md5('42:' || doc_id) AS h FROM labels),
    r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM h),
    s AS (SELECT doc_id, quality, CASE WHEN rn <= round(n * 0.8) THEN 'train' ELSE 'test' END AS part FROM r)
    SELECT 'class_' || part AS section, quality::VARCHAR AS name, count(*)::DOUBLE AS value FROM s GROUP BY ALL
    UNION ALL SELECT 'rows', part, count(*)::DOUBLE FROM s GROUP BY ALL
    UNION ALL SELECT 'scale_mean', 'doc_id', round(avg(doc_id::DOUBLE), 4) FROM s WHERE part = 'train'
    UNION ALL SELECT 'scale_std', 'doc_id', round(stddev_pop(doc_id::DOUBLE), 4) FROM s WHERE part = 'train'
    UNION ALL SELECT * FROM (VALUES ('columns', 'train', 2.0::DOUBLE), ('columns', 'test', 2.0::DOUBLE), ('feature', 'doc_id', 0.0::DOUBLE))
""")
def run_metadata(spark, root):
    labels = table(spark, root, "labels").select("doc_id", "quality")
    marked = split.fit_split(labels, "quality", "doc_id").transform(labels)
    parts = [marked.where(F.col("split") == p).drop("split") for p in ("train", "test")]
    scaler = scale.fit_scaler(parts[0], ["doc_id"])
    return rounded(modelling.run_metadata(spark, *parts, "quality", ["doc_id"], scaler))
