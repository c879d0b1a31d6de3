"""Row-local cleaning, harmonising and stacking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabprep.functions import columns as cx
from tabprep.operators import clean, profile, stacking
from tabprep.plans.harmonise import gate_module, harmonise_module
from tabprep.plans.typing import define_types
from tabprep.sources.dictionary import (
    VARIABLES, coalesce_aliases, dictionary_table, readable_names, valid_variables,
)
from workbench.registry import query, rounded, table


def order_cycles(orders):
    """Orders by two-year cycle, a later cycle naming its price column differently."""
    # Ranges of the date itself reach the scan; a year taken from it would not.
    date, y1997, y2000 = F.col("o_orderdate"), F.to_timestamp(F.lit("1997-01-01")), F.to_timestamp(F.lit("2000-01-01"))
    early, middle = date < y1997, (date >= y1997) & (date < y2000)
    return {
        "1995-1996": orders.where(early).select(
            F.col("o_orderkey").cast("double").alias("SEQN"), F.col("o_totalprice").alias("LBXTR"),
            F.col("o_orderpriority").alias("SLD010H"), F.col("o_orderstatus").alias("note")),
        "1997-1999": orders.where(middle).select(
            F.col("o_orderkey").cast("double").alias("SEQN"), F.col("o_totalprice").alias("LBXTR"),
            F.col("o_custkey").alias("BMXWT")),
        "2000-2001": orders.where(date >= y2000).select(
            F.col("o_orderkey").cast("double").alias("SEQN"), F.col("o_totalprice").alias("LBXTLG"),
            F.col("o_custkey").alias("BMXWT"), F.col("o_orderstatus").alias("note")),
    }


@query("cycle_union", """
    SELECT o_orderkey::BIGINT AS subject, o_totalprice AS price, o_orderstatus AS status, NULL::BIGINT AS customer,
           '1995-1996' AS cycle FROM orders WHERE year(o_orderdate) <= 1996
    UNION ALL
    SELECT o_orderkey, o_totalprice, NULL, o_custkey, '1997-1999' FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1999
    UNION ALL
    SELECT o_orderkey, o_totalprice, o_orderstatus, o_custkey, '2000-2001' FROM orders WHERE year(o_orderdate) >= 2000
""")
def cycle_union(spark, root):
    cycles = {c: coalesce_aliases(df) for c, df in order_cycles(table(spark, root, "orders")).items()}
    return stacking.stack_tagged(cycles).select(
        F.col("SEQN").cast("bigint").alias("subject"), F.col("TRIGLY").alias("price"), F.col("note").alias("status"),
        F.col("BMXWT").alias("customer"), "cycle",
    )


@query("long_stack_keys", """
    SELECT CASE WHEN year(o_orderdate) <= 1996 THEN '1995-1996' WHEN year(o_orderdate) <= 1999 THEN '1997-1999'
                ELSE '2000-2001' END AS cycle,
           o_orderkey::BIGINT || '_' || CASE WHEN year(o_orderdate) <= 1996 THEN '1995-1996'
                WHEN year(o_orderdate) <= 1999 THEN '1997-1999' ELSE '2000-2001' END AS subject_key,
           o_totalprice AS price
    FROM orders
""")
def long_stack_keys(spark, root):
    tables = [(c, coalesce_aliases(df)) for c, df in order_cycles(table(spark, root, "orders")).items()]
    stacked = stacking.stack_long(tables, "SEQN")
    return stacked.select(
        F.col("CYCLE").alias("cycle"), F.col("SEQN_UNIQUE").alias("subject_key"), F.col("TRIGLY").alias("price")
    )


@query("alias_coalesce", """
    SELECT o_orderkey::DOUBLE AS subject_id,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice WHEN o_orderstatus = 'O' THEN o_totalprice * 2 END AS triglycerides,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS sleep_hours
    FROM orders
""")
def alias_coalesce(spark, root):
    o, status = table(spark, root, "orders"), F.col("o_orderstatus")
    raw = o.select(
        F.col("o_orderkey").cast("double").alias("SEQN"),
        F.when(status == "F", F.col("o_totalprice")).alias("LBXTR"),
        F.when(status == "O", F.col("o_totalprice") * 2).alias("LBXTLG"),
        F.when(status == "P", F.col("o_custkey")).alias("SLD012"),
    )
    return readable_names(raw)


_DICTIONARY = ", ".join(
    "({})".format(", ".join("NULL" if v is None else (f"'{v}'" if isinstance(v, str) else str(v)) for v in row))
    for row in VARIABLES
)


@query("valid_variables", f"""
    WITH dict(module, variable, canonical, year_from, year_to) AS (VALUES {_DICTIONARY}),
    per_year AS (SELECT year(o_orderdate) + 15 AS y, count(*) AS orders FROM orders GROUP BY 1)
    SELECT y || '-' || (y + 1) AS cycle, orders, module, variable, canonical
    FROM per_year JOIN dict ON (year_from IS NULL OR y >= year_from::INT) AND (year_to IS NULL OR y <= year_to::INT)
""")
def valid_variables_by_cycle(spark, root):
    year = F.year("o_orderdate") + 15
    cycles = table(spark, root, "orders").groupBy(
        F.concat_ws("-", year.cast("string"), (year + 1).cast("string")).alias("cycle")
    ).agg(F.count(F.lit(1)).alias("orders"))
    return valid_variables(cycles, dictionary_table(spark)).select("cycle", "orders", "module", "variable", "canonical")


@query("numeric_coerce", r"""
    WITH texts AS (
        SELECT event_id, event_type,
               CASE event_type WHEN 'click' THEN props WHEN 'view' THEN value || 'd' WHEN 'error' THEN ' ' || value || ' '
                    WHEN 'signup' THEN value || 'e1' ELSE '-.5' END AS text
        FROM (SELECT event_id, event_type, props, regexp_extract(props, '([0-9]+)', 1) AS value FROM events))
    SELECT event_id, CASE WHEN regexp_full_match(trim(text), '[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)')
                          THEN TRY_CAST(trim(text) AS DOUBLE) END AS number
    FROM texts
""")
def numeric_coerce(spark, root):
    value = F.regexp_extract("props", "([0-9]+)", 1)
    text = (
        F.when(F.col("event_type") == "click", F.col("props")).when(F.col("event_type") == "view", F.concat(value, F.lit("d")))
        .when(F.col("event_type") == "error", F.concat(F.lit(" "), value, F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(value, F.lit("e1"))).otherwise("-.5")
    )
    events = table(spark, root, "events").select("event_id", text.alias("number"))
    return cx.coerce_numeric(events, ["number"])


@query("harmonise_module", """
    SELECT event_id::DOUBLE AS SEQN, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS BPX_SYS,
           value AS BPX_DIA, user_id::DOUBLE AS TRIGLY
    FROM events
""")
def harmonise_events(spark, root):
    raw = table(spark, root, "events").select(
        F.col("event_id").cast("double").alias("SEQN"), F.regexp_extract("props", "([0-9]+)", 1).alias("BPXOSY1"),
        F.col("value").alias("BPXODI1"), F.col("user_id").alias("LBXTLG"), F.col("event_type").alias("unused"),
    )
    assert gate_module(raw, "2021-2023", check_rows=False).ok
    return harmonise_module(raw, "2021-2023")


@query("threshold_label", """
    WITH labelled AS (SELECT coalesce((CASE WHEN event_type <> 'error' THEN value END >= 50)::BIGINT, 0) AS high FROM events)
    SELECT high, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM labelled), 4) AS pct
    FROM labelled GROUP BY high
""")
def threshold_label(spark, root):
    events = table(spark, root, "events").withColumn(
        "measured", F.when(F.col("event_type") != "error", F.col("value"))
    )
    labelled = clean.threshold_label(events, "measured", 50, "high", null_label=0)
    return rounded(profile.class_distribution(labelled, "high"))


@query("class_balance", """
    SELECT count(*) FILTER (quality = 1) AS positive, count(*) FILTER (quality = 0) AS negative,
           round(count(*) FILTER (quality = 1)::DOUBLE / count(*) FILTER (quality = 0), 6) AS ratio
    FROM labels
""")
def class_balance(spark, root):
    return rounded(profile.imbalance_ratio(table(spark, root, "labels"), "quality"), 6)


@query("target_filter", """
    SELECT count(*) AS before, count(*) FILTER (quality IS NOT NULL) AS after,
           count(*) FILTER (quality IS NULL) AS removed,
           round(100.0::DOUBLE * count(*) FILTER (quality IS NULL) / count(*), 4) AS removed_pct
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def target_filter(spark, root):
    docs = table(spark, root, "documents").select("doc_id").join(table(spark, root, "labels"), "doc_id", "left")
    return rounded(profile.row_reduction(docs, F.col("quality").isNotNull()))


@query("require_target", """
    SELECT doc_id, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL
""")
def require_target(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "n_chars")
    return clean.require_value(docs.join(table(spark, root, "labels").select("doc_id", "quality"), "doc_id", "left"), "quality")


@query("sentinel_null", """
    SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_discount = 0) AS zeros,
           count(nullif(l_discount, 0)) AS known, round(avg(nullif(l_discount, 0)), 6) AS mean_known
    FROM lineitem GROUP BY l_returnflag
""")
def sentinel_null(spark, root):
    lines = table(spark, root, "lineitem").select("l_returnflag", "l_discount")
    marked = clean.sentinel_to_null(lines.withColumn("raw", F.col("l_discount")), ["l_discount"])
    return rounded(marked.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("raw") == 0).alias("zeros"),
        F.count("l_discount").alias("known"), F.avg("l_discount").alias("mean_known"),
    ), 6)


@query("flag_recode", """
    SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END::BIGINT AS quality,
           CASE WHEN toxic = 1 THEN 1 WHEN toxic IS NOT NULL THEN 0 END::BIGINT AS toxic,
           trunc(n_chars / 7.0)::BIGINT AS sevenths
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def flag_recode(spark, root):
    docs = table(spark, root, "documents").select("doc_id", (F.col("n_chars") / 7.0).alias("sevenths"))
    joined = docs.join(table(spark, root, "labels"), "doc_id", "left")
    recoded = clean.recode_yes_no(clean.recode_yes_no(joined, ["quality"]), ["toxic"], null_as=None)
    return clean.to_integer(recoded, ["sevenths"]).select("doc_id", "quality", "toxic", "sevenths")


@query("flag_text", """
    SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 1 WHEN c_nationkey % 3 < 3 THEN 0 END::BIGINT AS answer FROM customer
""")
def flag_text(spark, root):
    third = F.col("c_nationkey") % 3
    answer = F.when(third == 0, F.lit("1")).when(third == 1, F.lit("Yes")).otherwise(F.col("c_mktsegment"))
    return clean.recode_yes_no(table(spark, root, "customer").select("c_custkey", answer.alias("answer")), ["answer"])


@query("type_definition", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END::BIGINT AS smoker,
           trunc(c_acctbal)::BIGINT AS age_years, c_nationkey AS ethnicity
    FROM customer
""")
def type_definition(spark, root):
    raw = table(spark, root, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", 1).when(F.col("c_mktsegment") == "FURNITURE", 2).alias("smoker"),
        F.col("c_acctbal").alias("age_years"), F.col("c_nationkey").alias("ethnicity"),
    )
    return define_types(raw)


@query("conditional_derive", """
    SELECT p_partkey,
           round(coalesce(CASE WHEN p_type = 'LARGE' THEN p_retailprice / 40 END,
                 CASE WHEN p_brand <> 'Brand#4' THEN p_retailprice END
                 / nullif((p_size / 100.0::DOUBLE) * (p_size / 100.0::DOUBLE), 0)), 4) AS bmi
    FROM part
""")
def conditional_derive(spark, root):
    part = table(spark, root, "part").select(
        "p_partkey", F.when(F.col("p_type") == "LARGE", F.col("p_retailprice") / 40).alias("bmi"),
        F.when(F.col("p_brand") != "Brand#4", F.col("p_retailprice")).alias("weight_kg"),
        F.col("p_size").cast("double").alias("height_cm"),
    )
    return rounded(clean.fill_bmi(part).select("p_partkey", "bmi"))


@query("rule_overwrite", """
    SELECT c_custkey, CASE WHEN c_acctbal > 9000 OR c_nationkey > 22 THEN 1
                           WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 6000 THEN 1
                           WHEN c_mktsegment = 'MACHINERY' THEN NULL
                           ELSE (c_mktsegment = 'BUILDING')::BIGINT END::BIGINT AS hypertension
    FROM customer
""")
def rule_overwrite(spark, root):
    c = table(spark, root, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", (F.col("c_mktsegment") == "BUILDING").cast("bigint")).alias("hypertension"),
        ((F.col("c_acctbal") - 9000) + 140).alias("BPX_SYS"), ((F.col("c_nationkey") - 22) + 90).alias("BPX_DIA"),
        ((F.col("c_acctbal") - 6000) + 60).alias("age_years"),
    )
    return clean.apply_rules(c, clean.blood_pressure_rules(c)).select("c_custkey", "hypertension")


@query("rule_hits", """
    SELECT 'high_balance' AS rule, count(*) FILTER (c_acctbal > 9000) AS hits FROM customer
    UNION ALL SELECT 'in_debt', count(*) FILTER (c_acctbal < 0) FROM customer
""")
def rule_hits(spark, root):
    return clean.rule_hits(table(spark, root, "customer"), {
        "high_balance": F.col("c_acctbal") > 9000, "in_debt": F.col("c_acctbal") < 0,
    })


@query("extreme_filter", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 499000 OR o_totalprice < 1500 OR o_custkey < 3
""")
def extreme_filter(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    limits = [("o_totalprice", ">", 499000), ("o_totalprice", "<", 1500), ("o_custkey", "<", 3), ("absent", ">", 1)]
    return clean.extreme_rows(orders, limits).orderBy("o_orderkey").select("o_orderkey", "o_totalprice")


@query("interval_bins", """
    SELECT p_partkey, CASE WHEN p_size > 1 AND p_size <= 18 THEN '< 18' WHEN p_size > 18 AND p_size <= 35 THEN '18-34'
                           WHEN p_size > 35 AND p_size <= 49 THEN '35-49' END AS band
    FROM part
""")
def interval_bins(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_size")
    return clean.bin_column(part, "p_size", "band", [1, 18, 35, 49], ["< 18", "18-34", "35-49"]).drop("p_size")


@query("complete_cases", """
    SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND lang IS NOT NULL
""")
def complete_cases(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "lang")
    return clean.complete_cases(docs.join(table(spark, root, "labels").select("doc_id", "quality"), "doc_id", "left"))


@query("incomplete_cases", """
    SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR lang IS NULL
""")
def incomplete_cases(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "lang")
    joined = docs.join(table(spark, root, "labels").select("doc_id", "quality"), "doc_id", "left")
    return clean.incomplete_cases(joined).drop("quality")


@query("drop_ids", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL")
def drop_ids(spark, root):
    kept = clean.drop_ids(table(spark, root, "customer"), ["c_custkey", "c_name", "c_acctbal", "absent"])
    return kept.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("infinite_null", """
    SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_tax <> 0 THEN l_discount / l_tax END) AS finite,
           round(avg(CASE WHEN l_tax <> 0 THEN l_discount / l_tax END), 6) AS mean_ratio
    FROM lineitem GROUP BY l_returnflag
""")
def infinite_null(spark, root):
    ratio = F.when(F.col("l_tax") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_discount", "l_tax"))
    lines = table(spark, root, "lineitem").select("l_returnflag", ratio.alias("ratio"))
    return rounded(cx.infinite_to_null(lines, ["ratio"]).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("ratio").alias("finite"), F.avg("ratio").alias("mean_ratio")
    ), 6)


@query("path_parts", r"""
    SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS file, regexp_extract(url, '([^/]+)/[^/]*$', 1) AS parent,
           regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[<>:"/\\|?*]', '_', 'g') AS safe
    FROM pages
""")
def path_parts(spark, root):
    return table(spark, root, "pages").select(
        "page_id", cx.base_name(F.col("url")).alias("file"), cx.parent_name(F.col("url")).alias("parent"),
        cx.safe_filename(cx.base_name(F.col("url"))).alias("safe"),
    )
