"""Profiling, association and outlier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions import sketches
from tabprep.operators import association, outliers, profile
from tabprep.operators.heavy import heavy_hitters
from workbench.registry import query, rounded, table

ORDER_GAPS = """orders_gaps AS (
    SELECT o_orderkey, o_orderstatus, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority
    FROM orders)"""


def order_gaps(spark, root):
    """Orders with gaps: no price while partial, no priority when not specified."""
    return table(spark, root, "orders").select(
        "o_orderkey", "o_orderstatus", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("priority"),
    )


def labelled_documents(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, root, "labels"), "doc_id", "left")


@query("column_summary", f"""
    WITH {ORDER_GAPS}
    SELECT 'price' AS variable, round(min(price), 4) AS min, round(max(price), 4) AS max, round(avg(price), 4) AS mean,
           round(stddev_samp(price), 4) AS std, count(*) FILTER (price IS NULL) AS missing FROM orders_gaps
    UNION ALL
    SELECT 'o_custkey', min(o_custkey)::DOUBLE, max(o_custkey)::DOUBLE, round(avg(o_custkey), 4),
           round(stddev_samp(o_custkey), 4), count(*) FILTER (o_custkey IS NULL) FROM orders_gaps
""")
def column_summary(spark, root):
    return rounded(profile.column_summary(order_gaps(spark, root), ["price", "o_custkey"]))


@query("range_summary", """
    SELECT 'p_size' AS variable, min(p_size)::DOUBLE AS min, max(p_size)::DOUBLE AS max, round(avg(p_size), 4) AS mean FROM part
    UNION ALL SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice), round(avg(p_retailprice), 4) FROM part
""")
def range_summary(spark, root):
    return rounded(profile.range_summary(table(spark, root, "part"), ["p_size", "p_retailprice"]))


@query("value_counts", f"WITH {ORDER_GAPS} SELECT priority, count(*) AS n FROM orders_gaps WHERE priority IS NOT NULL GROUP BY 1")
def value_counts(spark, root):
    return profile.value_counts(order_gaps(spark, root), "priority")


@query("top_categories", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def top_categories(spark, root):
    return profile.value_counts(table(spark, root, "part"), "p_brand", top=10)


@query("distinct_counts", f"""
    WITH {ORDER_GAPS}
    SELECT 'price' AS variable, count(DISTINCT price) AS "distinct" FROM orders_gaps
    UNION ALL SELECT 'priority', count(DISTINCT priority) FROM orders_gaps
    UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) FROM orders_gaps
""")
def distinct_counts(spark, root):
    return profile.distinct_counts(order_gaps(spark, root), ["price", "priority", "o_custkey"])


@query("column_modes", f"""
    WITH {ORDER_GAPS}
    (SELECT 'priority' AS variable, priority AS value, count(*) AS n FROM orders_gaps WHERE priority IS NOT NULL
     GROUP BY priority ORDER BY n DESC, priority LIMIT 1)
    UNION ALL
    (SELECT 'o_custkey', o_custkey::VARCHAR, count(*) AS n FROM orders_gaps GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 1)
""")
def column_modes(spark, root):
    return profile.column_modes(order_gaps(spark, root), ["priority", "o_custkey"])


@query("medians", f"""
    WITH {ORDER_GAPS}
    SELECT 'price' AS variable, round(median(price), 4) AS median FROM orders_gaps
    UNION ALL SELECT 'o_custkey', round(median(o_custkey), 4) FROM orders_gaps
""")
def medians(spark, root):
    return rounded(profile.medians(order_gaps(spark, root), ["price", "o_custkey"]))


@query("medians_bracketed", """
    SELECT l_returnflag, 'l_extendedprice' AS variable, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
           round(quantile_cont(l_extendedprice, 0.5), 4) AS q50, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75
    FROM lineitem GROUP BY l_returnflag
    UNION ALL
    SELECT l_returnflag, 'l_quantity', round(quantile_cont(l_quantity, 0.25), 4), round(quantile_cont(l_quantity, 0.5), 4),
           round(quantile_cont(l_quantity, 0.75), 4)
    FROM lineitem GROUP BY l_returnflag
""")
def medians_bracketed(spark, root):
    """The three-scan quantile plan that large inputs take, forced here."""
    from tabprep.functions.quantiles import exact_quantiles

    found = exact_quantiles(table(spark, root, "lineitem"), ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.75],
                            by=["l_returnflag"], one_task_bytes=0, one_task_rows=0, accuracy=1_000)
    return rounded(found.select(
        "l_returnflag", "variable", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75")))


@query("missing_report", """
    WITH d AS (SELECT * FROM (SELECT doc_id, lang, source, n_chars FROM documents) LEFT JOIN labels USING (doc_id))
    SELECT * FROM (
        SELECT 'quality' AS variable, count(*) FILTER (quality IS NULL) AS missing,
               round(100.0::DOUBLE * count(*) FILTER (quality IS NULL) / count(*), 2) AS missing_pct FROM d
        UNION ALL
        SELECT 'toxic', count(*) FILTER (toxic IS NULL), round(100.0::DOUBLE * count(*) FILTER (toxic IS NULL) / count(*), 2) FROM d
        UNION ALL
        SELECT 'lang', count(*) FILTER (lang IS NULL), round(100.0::DOUBLE * count(*) FILTER (lang IS NULL) / count(*), 2) FROM d)
    WHERE missing > 0
""")
def missing_report(spark, root):
    return profile.missing_report(labelled_documents(spark, root))


@query("missing_totals", """
    WITH d AS (SELECT * FROM (SELECT doc_id, lang, source, n_chars FROM documents) LEFT JOIN labels USING (doc_id))
    SELECT (count(*) FILTER (quality IS NULL) + count(*) FILTER (toxic IS NULL))::BIGINT AS total_missing,
           (count(*) * 6)::BIGINT AS total_cells,
           round(100.0::DOUBLE * (count(*) FILTER (quality IS NULL) + count(*) FILTER (toxic IS NULL)) / (count(*) * 6), 4) AS missing_pct
    FROM d
""")
def missing_totals(spark, root):
    return rounded(profile.missing_totals(labelled_documents(spark, root)))


@query("zero_missing_check", "SELECT count(*) FILTER (p_size IS NULL)::BIGINT AS total_missing, count(*) FILTER (p_size IS NULL) = 0 AS passed FROM part")
def zero_missing_check(spark, root):
    return profile.zero_missing_check(table(spark, root, "part"), ["p_size"])


@query("quality_summary", """
    WITH d AS (SELECT * FROM (SELECT doc_id, lang, source, n_chars FROM documents) LEFT JOIN labels USING (doc_id))
    SELECT count(*) AS rows, 6::BIGINT AS columns, 4::BIGINT AS numeric_columns,
           count(*) FILTER (quality IS NOT NULL AND toxic IS NOT NULL) AS complete_rows,
           count(*) FILTER (quality IS NULL OR toxic IS NULL) AS incomplete_rows,
           (count(*) FILTER (quality IS NULL) + count(*) FILTER (toxic IS NULL))::BIGINT AS missing_cells
    FROM d
""")
def quality_summary(spark, root):
    return profile.quality_summary(labelled_documents(spark, root))


@query("class_descriptives", """
    SELECT quality, 'n_chars' AS variable, count(n_chars) AS n, round(avg(n_chars), 4) AS mean,
           round(stddev_samp(n_chars), 4) AS std, min(n_chars)::DOUBLE AS min, max(n_chars)::DOUBLE AS max,
           round(median(n_chars), 4) AS median
    FROM documents JOIN labels USING (doc_id) GROUP BY quality
""")
def class_descriptives(spark, root):
    return rounded(profile.class_descriptives(labelled_documents(spark, root), "quality", ["n_chars"]))


@query("describe_all", """
    SELECT 'p_size' AS variable, count(p_size) AS count, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq,
           round(avg(p_size), 4) AS mean, round(stddev_samp(p_size), 4) AS std, min(p_size)::DOUBLE AS min,
           quantile_cont(p_size, 0.25) AS q25, quantile_cont(p_size, 0.5) AS q50, quantile_cont(p_size, 0.75) AS q75,
           max(p_size)::DOUBLE AS max FROM part
    UNION ALL
    SELECT 'p_retailprice', count(p_retailprice), NULL, NULL, NULL, round(avg(p_retailprice), 4),
           round(stddev_samp(p_retailprice), 4), min(p_retailprice), round(quantile_cont(p_retailprice, 0.25), 4),
           round(quantile_cont(p_retailprice, 0.5), 4), round(quantile_cont(p_retailprice, 0.75), 4), max(p_retailprice) FROM part
    UNION ALL
    SELECT 'p_brand', count(p_brand), count(DISTINCT p_brand),
           (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 1),
           (SELECT count(*) FROM part GROUP BY p_brand ORDER BY count(*) DESC LIMIT 1), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part
    UNION ALL
    SELECT 'p_type', count(p_type), count(DISTINCT p_type),
           (SELECT p_type FROM part GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 1),
           (SELECT count(*) FROM part GROUP BY p_type ORDER BY count(*) DESC LIMIT 1), NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM part
""")
def describe_all(spark, root):
    return rounded(profile.describe_all(table(spark, root, "part"), ["p_size", "p_retailprice", "p_brand", "p_type"]))


@query("ordered_levels", "SELECT DISTINCT p_brand FROM part")
def ordered_levels(spark, root):
    return profile.levels(table(spark, root, "part"), "p_brand")


@query("sparse_drop", """
    SELECT doc_id, lang, source, n_chars FROM documents
""")
def sparse_drop(spark, root):
    # Most documents carry no label, so both label columns go.
    return profile.drop_sparse(labelled_documents(spark, root), 0.5)


@query("t_statistics", """
    WITH d AS (SELECT quality, n_chars::DOUBLE AS x FROM documents JOIN labels USING (doc_id)),
    s AS (SELECT count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1,
                 avg(x) FILTER (quality = 0) AS m0, avg(x) FILTER (quality = 1) AS m1,
                 var_samp(x) FILTER (quality = 0) AS v0, var_samp(x) FILTER (quality = 1) AS v1 FROM d)
    SELECT 'n_chars' AS variable, n0, n1, round(m0, 4) AS mean0, round(m1, 4) AS mean1, n0 + n1 - 2 AS dof,
           round((m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)), 6) AS t
    FROM s
""")
def t_statistics(spark, root):
    rows = association.t_statistics(labelled_documents(spark, root), "quality", ["n_chars"])
    return rounded(rounded(rows.drop("var0", "var1"), 6, ("mean0", "mean1")), 4, ("t",))


# With whole degrees of freedom the two-sided p is one minus a finite trigonometric sum (Abramowitz and Stegun 26.7.3, 26.7.4).
@query("t_test_p", r"""
    WITH x AS (SELECT quality, n_chars::DOUBLE AS n_chars, doc_id::DOUBLE AS doc_id FROM documents JOIN labels USING (doc_id)),
    l AS (SELECT quality, 'n_chars' AS variable, n_chars AS v FROM x UNION ALL SELECT quality, 'doc_id', doc_id FROM x),
    s AS (SELECT variable, count(v) FILTER (quality = 0) AS n0, count(v) FILTER (quality = 1) AS n1, avg(v) FILTER (quality = 0) AS m0,
                 avg(v) FILTER (quality = 1) AS m1, var_samp(v) FILTER (quality = 0) AS s0, var_samp(v) FILTER (quality = 1) AS s1
          FROM l GROUP BY variable),
    t AS (SELECT variable, n0 + n1 - 2 AS dof, (m0 - m1) / sqrt(((n0 - 1) * s0 + (n1 - 1) * s1) / (n0 + n1 - 2) * (1 / n0 + 1 / n1)) AS t FROM s),
    a AS (SELECT *, atan(abs(t) / sqrt(dof)) AS theta, dof % 2 AS odd FROM t),
    terms AS (SELECT variable, t, dof, theta, odd,
                     list_transform(range(0, CASE WHEN odd = 1 THEN (dof - 1) // 2 ELSE dof // 2 END), lambda k:
                         coalesce(list_product(list_transform(range(1, k + 1), lambda j:
                             CASE WHEN odd = 1 THEN 2.0::DOUBLE * j / (2 * j + 1) ELSE (2.0::DOUBLE * j - 1) / (2 * j) END)), 1)
                         * pow(cos(theta), 2 * k + odd)) AS ts FROM a),
    p AS (SELECT variable, t, dof, 1 - CASE WHEN odd = 1 THEN 2 / pi() * (theta + sin(theta) * coalesce(list_sum(ts), 0))
                                       ELSE sin(theta) * coalesce(list_sum(ts), 0) END AS p FROM terms)
    SELECT variable, round(t, 6) AS t, dof, round(p, 6) AS p,
           CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE 'ns' END AS significance FROM p
""")
def t_test_p(spark, root):
    rows = association.t_test(labelled_documents(spark, root), "quality", ["n_chars", "doc_id"])
    return rounded(rows.select("variable", "t", "dof", "p", "significance"), 6)


@query("target_correlation", """
    SELECT v AS variable, round(c, 6) AS correlation FROM (
        SELECT corr(l_quantity, (l_returnflag = 'R')::INT) AS l_quantity, corr(l_extendedprice, (l_returnflag = 'R')::INT) AS l_extendedprice,
               corr(l_discount, (l_returnflag = 'R')::INT) AS l_discount, corr(l_tax, (l_returnflag = 'R')::INT) AS l_tax FROM lineitem)
    UNPIVOT (c FOR v IN (l_quantity, l_extendedprice, l_discount, l_tax))
""")
def target_correlation(spark, root):
    lines = table(spark, root, "lineitem").withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(association.target_correlation(lines, "returned", cols, top=10), 6)


@query("crosstab_margins", """
    SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority,
           count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O",
           count(*) FILTER (o_orderstatus = 'P') AS "P", count(*) AS "All"
    FROM orders GROUP BY ROLLUP (o_orderpriority)
""")
def crosstab_margins(spark, root):
    return association.crosstab(table(spark, root, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("crosstab_typed", """
    SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'All' ELSE o_orderpriority END AS o_orderpriority,
           count(*) FILTER (o_totalprice < 150000) AS "False", count(*) FILTER (o_totalprice >= 150000) AS "True", count(*) AS "All"
    FROM orders GROUP BY ROLLUP (o_orderpriority)
""")
def crosstab_typed(spark, root):
    rows = table(spark, root, "orders").withColumn("dear", F.col("o_totalprice") >= 150000)
    return association.crosstab(rows, "o_orderpriority", "dear")


@query("crosstab_large_numbers", """
    SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'All' ELSE c_mktsegment END AS c_mktsegment,
           count(*) FILTER (c_nationkey % 3 = 0) AS "0.0", count(*) FILTER (c_nationkey % 3 = 1) AS "15000000.0",
           count(*) FILTER (c_nationkey % 3 = 2) AS "30000000.0", count(*) AS "All"
    FROM customer GROUP BY ROLLUP (c_mktsegment)
""")
def crosstab_large_numbers(spark, root):
    rows = table(spark, root, "customer").withColumn("amount", (F.col("c_nationkey") % 3) * F.lit(1.5e7))
    return association.crosstab(rows, "c_mktsegment", "amount")


@query("crosstab_long", """
    SELECT o_orderstatus, o_custkey, grouping(o_orderstatus) = 1 AS all_rows, grouping(o_custkey) = 1 AS all_columns, count(*) AS n
    FROM orders GROUP BY CUBE (o_orderstatus, o_custkey)
""")
def crosstab_long(spark, root):
    return association.crosstab_long(table(spark, root, "orders"), "o_orderstatus", "o_custkey")


@query("decimal_modes", """
    WITH c AS (SELECT ('20000000000000000000.0' || (s_suppkey % 7))::DECIMAL(38, 2) AS amount FROM supplier),
    n AS (SELECT amount, count(*) AS n FROM c GROUP BY amount)
    SELECT 'amount' AS variable, arg_min(amount, (-n, amount))::VARCHAR AS value, max(n) AS n, count(*) AS distinct_values FROM n
""")
def decimal_modes(spark, root):
    text = F.concat(F.lit("20000000000000000000.0"), (F.col("s_suppkey") % 7).cast("string"))
    rows = table(spark, root, "supplier").select(text.cast("decimal(38,2)").alias("amount"))
    distinct = profile.distinct_counts(rows, ["amount"]).withColumnRenamed("distinct", "distinct_values")
    return profile.column_modes(rows, ["amount"]).join(distinct, "variable")


@query("describe_category", """
    SELECT 'l_linenumber' AS variable, count(*) AS count, count(DISTINCT l_linenumber) AS "unique",
           (SELECT l_linenumber::VARCHAR FROM lineitem GROUP BY l_linenumber ORDER BY count(*) DESC, l_linenumber LIMIT 1) AS top,
           (SELECT count(*) FROM lineitem GROUP BY l_linenumber ORDER BY 1 DESC LIMIT 1) AS freq FROM lineitem
""")
def describe_category(spark, root):
    from tabprep.operators.clean import mark_category

    rows = mark_category(table(spark, root, "lineitem").select("l_linenumber"), ["l_linenumber"])
    return profile.describe_all(rows).select("variable", "count", "unique", "top", "freq")


@query("type_census", """
    SELECT type, count(*) AS columns FROM (VALUES ('bigint'), ('bigint'), ('bigint'), ('category'), ('category'), ('category'), ('double'),
        ('double'), ('double'), ('double'), ('timestamp_ntz')) AS t(type)
    WHERE (SELECT count(*) FROM lineitem) > 0 GROUP BY type
""")
def type_census(spark, root):
    from tabprep.operators.clean import mark_category

    rows = mark_category(table(spark, root, "lineitem"), ["l_linenumber", "l_returnflag", "l_linestatus"])
    return profile.type_census(rows)


@query("crosstab_row_pct", """
    SELECT CASE WHEN p_size > 0 AND p_size <= 18 THEN '< 18' WHEN p_size <= 35 THEN '18-34' WHEN p_size <= 50 THEN '35-49' END AS band,
           round(100.0::DOUBLE * count(*) FILTER (p_type = 'PROMO') / count(*), 2) AS "PROMO",
           round(100.0::DOUBLE * count(*) FILTER (p_type = 'LARGE') / count(*), 2) AS "LARGE"
    FROM part GROUP BY band
""")
def crosstab_row_pct(spark, root):
    from tabprep.operators.clean import AGE_EDGES, AGE_LABELS, bin_column

    part = bin_column(table(spark, root, "part"), "p_size", "band", AGE_EDGES, AGE_LABELS)
    return association.crosstab_row_percent(part, "band", "p_type", ["PROMO", "LARGE"])


_FENCES = """
    WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events),
    f AS (SELECT q1, q2, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"""


@query("iqr_outliers", _FENCES + """
    SELECT 'value' AS variable, round(max(q1), 4) AS q1, round(max(q3), 4) AS q3, round(max(iqr), 4) AS iqr,
           round(max(lo), 4) AS lower_bound, round(max(hi), 4) AS upper_bound, count(value) AS n,
           count(*) FILTER (value < lo OR value > hi) AS outliers, round(min(value), 4) AS data_min, round(max(value), 4) AS data_max,
           round(min(value) FILTER (value < lo OR value > hi), 4) AS outlier_min,
           round(max(value) FILTER (value < lo OR value > hi), 4) AS outlier_max,
           round(100.0::DOUBLE * count(*) FILTER (value < lo OR value > hi) / count(value), 4) AS pct
    FROM events, f
""")
def iqr_outliers(spark, root):
    return rounded(outliers.iqr_outliers(table(spark, root, "events"), ["value"]))


@query("iqr_outliers_by_type", """
    WITH f AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
    b AS (SELECT event_type, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM f)
    SELECT event_type, 'value' AS variable, round(max(lo), 4) AS lower_bound, round(max(hi), 4) AS upper_bound,
           count(*) FILTER (value < lo OR value > hi) AS outliers
    FROM events JOIN b USING (event_type) GROUP BY event_type
""")
def iqr_outliers_by_type(spark, root):
    found = outliers.iqr_outliers(table(spark, root, "events"), ["value"], by=["event_type"])
    return rounded(found.select("event_type", "variable", "lower_bound", "upper_bound", "outliers"))


_Z = "s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events)"


@query("zscore_outliers", f"""
    WITH {_Z}
    SELECT 'value' AS variable, round(max(m), 4) AS mean, round(max(sd), 4) AS std, count(value) AS n,
           count(*) FILTER (abs((value - m) / sd) > 3) AS outliers,
           round(min(value) FILTER (abs((value - m) / sd) > 3), 4) AS outlier_min,
           round(max(value) FILTER (abs((value - m) / sd) > 3), 4) AS outlier_max,
           round(100.0::DOUBLE * count(*) FILTER (abs((value - m) / sd) > 3) / count(value), 4) AS pct
    FROM events, s
""")
def zscore_outliers(spark, root):
    return rounded(outliers.zscore_outliers(table(spark, root, "events"), ["value"]))


@query("boxplot_stats", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
                      quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
    f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT event_type, 'value' AS variable, round(max(q1), 4) AS q1, round(max(q2), 4) AS q2, round(max(q3), 4) AS q3,
           count(value) AS n, round(min(value) FILTER (value >= lo), 4) AS whisker_low,
           round(max(value) FILTER (value <= hi), 4) AS whisker_high, count(*) FILTER (value < lo OR value > hi) AS fliers
    FROM events JOIN f USING (event_type) GROUP BY event_type
""")
def boxplot_stats(spark, root):
    return rounded(outliers.box_plot_figures(table(spark, root, "events"), ["value"], by=["event_type"]))


# One variable is flagged by both methods, one by the fences alone, one by the z-score alone, one by neither.
@query("outlier_summary", """
    WITH x AS (SELECT value, (event_id % 5 = 0)::INT::DOUBLE AS fifth,
                      CASE WHEN event_id % 1000 = 0 THEN 3.5 WHEN event_id % 2 = 0 THEN 1 ELSE -1 END::DOUBLE AS sides, user_id::DOUBLE AS user_id
               FROM events),
    l AS (UNPIVOT x ON value, fifth, sides, user_id INTO NAME variable VALUE v),
    f AS (SELECT variable, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, avg(v) AS m, stddev_pop(v) AS sd FROM l GROUP BY variable),
    c AS (SELECT variable, count(*) AS n, count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS i,
                 count(*) FILTER (abs((v - m) / sd) > 3) AS z FROM l JOIN f USING (variable) GROUP BY variable)
    SELECT variable, nullif(i, 0) AS iqr_outliers, CASE WHEN i > 0 THEN round(100.0::DOUBLE * i / n, 4) END AS iqr_pct,
           nullif(z, 0) AS z_outliers, CASE WHEN z > 0 THEN round(100.0::DOUBLE * z / n, 4) END AS z_pct FROM c WHERE i > 0 OR z > 0
""")
def outlier_summary(spark, root):
    number = F.col("event_id")
    sides = F.when(number % 1000 == 0, 3.5).when(number % 2 == 0, 1.0).otherwise(-1.0)
    events = table(spark, root, "events").select(
        "value", (number % 5 == 0).cast("double").alias("fifth"), sides.alias("sides"), "user_id")
    cols = ["value", "fifth", "sides", "user_id"]
    return rounded(outliers.outlier_summary(
        outliers.iqr_outliers(events, cols), outliers.zscore_outliers(events, cols)))


@query("iqr_drop", _FENCES + "SELECT event_id, value FROM events, f WHERE value BETWEEN lo AND hi")
def iqr_drop(spark, root):
    return outliers.limit_outliers(table(spark, root, "events").select("event_id", "value"), ["value"])


@query("iqr_clip", _FENCES + "SELECT event_id, round(greatest(lo, least(hi, value)), 4) AS value FROM events, f")
def iqr_clip(spark, root):
    return rounded(outliers.limit_outliers(table(spark, root, "events").select("event_id", "value"), ["value"], "clip"))


@query("range_check", """
    SELECT 'c_acctbal' AS variable, count(c_acctbal) AS n, 0.0::DOUBLE AS low, 9000.0::DOUBLE AS high,
           count(*) FILTER (c_acctbal < 0 OR c_acctbal > 9000) AS out_of_range FROM customer
    UNION ALL
    SELECT 'c_nationkey', count(c_nationkey), NULL, 20.0, count(*) FILTER (c_nationkey > 20) FROM customer
""")
def range_check(spark, root):
    return outliers.range_violations(table(spark, root, "customer"), [("c_acctbal", 0, 9000), ("c_nationkey", None, 20)])


@query("range_null", "SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS c_acctbal FROM customer")
def range_null(spark, root):
    return outliers.enforce_ranges(table(spark, root, "customer").select("c_custkey", "c_acctbal"), [("c_acctbal", 0, 9000)])


@query("sketched_quantiles", """
    WITH q AS (SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.95::DOUBLE]) AS p)
    SELECT p, round((SELECT quantile_cont(o_totalprice, 0.1) FROM orders), 4) AS quantile FROM q WHERE p = 0.1
    UNION ALL SELECT p, round((SELECT quantile_cont(o_totalprice, 0.5) FROM orders), 4) FROM q WHERE p = 0.5
    UNION ALL SELECT p, round((SELECT quantile_cont(o_totalprice, 0.95) FROM orders), 4) FROM q WHERE p = 0.95
""")
def sketched_quantiles(spark, root):
    """Sketches per status are merged and guide the exact quantiles of the whole table."""
    orders = table(spark, root, "orders").select("o_orderstatus", "o_totalprice")
    stored = sketches.quantile_sketches(orders, ["o_totalprice"], ["o_orderstatus"])
    merged = sketches.merge_quantiles(stored)
    parts = [sketches.bracketed_quantile(orders, merged, "o_totalprice", p).select(F.lit(p).alias("p"), "quantile") for p in (0.1, 0.5, 0.95)]
    return rounded(parts[0].union(parts[1]).union(parts[2]), skip=("p",))


@query("sketch_rank_errors", """
    SELECT o_orderstatus, count(*) AS n, min(o_totalprice) AS least, max(o_totalprice) AS most, 3 AS ranks_held
    FROM orders GROUP BY o_orderstatus
""")
def sketch_rank_errors(spark, root):
    """Per status: of three quantiles the sketch gives, how many have an exact rank within the stated error."""
    orders = table(spark, root, "orders").select("o_orderstatus", "o_totalprice")
    found = sketches.sketch_quantiles(sketches.quantile_sketches(orders, ["o_totalprice"], ["o_orderstatus"]), [0.25, 0.5, 0.9])
    asked = found.select(F.col("o_orderstatus").alias("status"), "n", "least", "most", F.posexplode("q").alias("place", "q"))
    wanted = F.get(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9)), F.col("place"))
    met = orders.join(F.broadcast(asked), F.col("o_orderstatus") == F.col("status"))
    ranks = met.groupBy("o_orderstatus", "n", "least", "most", "place", wanted.alias("p")).agg(
        F.count_if(F.col("o_totalprice") <= F.col("q")).alias("upto"))
    held = F.abs(F.col("upto") / F.col("n") - F.col("p")) <= 2 * sketches.RANK_ERROR
    return ranks.groupBy("o_orderstatus", "n", "least", "most").agg(F.count_if(held).cast("int").alias("ranks_held"))


@query("id_overlaps", """
    WITH m AS (SELECT DISTINCT o_orderstatus AS cycle, o_orderpriority AS module, o_custkey AS id FROM orders)
    SELECT a.cycle, a.module AS "left", b.module AS "right", count(*) FILTER (a.id = b.id) AS "both"
    FROM m a JOIN m b ON a.cycle = b.cycle AND a.module < b.module GROUP BY ALL
""")
def id_overlaps(spark, root):
    """How many customers two priorities share within a status, from id sketches; exact up to 4,096 customers, near it beyond."""
    orders = table(spark, root, "orders").select(
        F.col("o_orderstatus").alias("cycle"), F.col("o_orderpriority").alias("module"), F.col("o_custkey").alias("id"))
    stored = sketches.id_sketches(orders, "id", ["cycle", "module"])
    return sketches.overlaps(stored, ["cycle"], "module").select("cycle", "left", "right", "both")


@query("heavy_hitters", """
    SELECT l_partkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 10
""")
def heavy(spark, root):
    """The ten most frequent parts, by bounded counters and one exact recount."""
    return heavy_hitters(table(spark, root, "lineitem").select("l_partkey"), "l_partkey", 10)
