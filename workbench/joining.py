"""Joins, file discovery and consolidation queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabprep.operators import joins
from tabprep.operators.ledger import Ledger
from tabprep.plans import cycles
from tabprep.plans.consolidate import availability_report, consolidate, consolidate_modules, read_modules, stack_modules
from tabprep.plans.harmonise import clean_module
from tabprep.session import ensure_checkpoint_dir, materialise
from tabprep.sizing import local_table
from tabprep.sources import links, modules
from tabprep.sources.buckets import join_buckets, open_buckets, write_buckets
from tabprep.sources.quarantine import quarantine
from workbench.cleaning import order_cycles
from workbench.registry import ORACLES, query, table


@query("module_full_join", """
    SELECT doc_id, lang, n_chars, quality, toxic, priority FROM (SELECT doc_id, lang, n_chars FROM documents)
    FULL JOIN labels USING (doc_id) FULL JOIN (SELECT o_orderkey AS doc_id, o_orderpriority AS priority FROM orders) USING (doc_id)
""")
def module_full_join(spark, root):
    docs = table(spark, root, "documents").select("doc_id", "lang", "n_chars")
    orders = table(spark, root, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("priority"))
    return joins.join_modules({"documents": docs, "labels": table(spark, root, "labels"), "orders": orders}, ["doc_id"])


def status_modules(orders):
    """Per-customer figures by order status: three modules that overlap only in part and share column names."""
    def figures(status):
        return orders.where(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("largest")
        )

    return {status: figures(status) for status in ("F", "O", "P")}


@query("module_join_chain", """
    WITH f AS (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS largest FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    o AS (SELECT o_custkey, count(*) AS n_O, max(o_totalprice) AS largest_O FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
    p AS (SELECT o_custkey, count(*) AS n_P, max(o_totalprice) AS largest_P FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
    SELECT o_custkey, n, largest, n_O, largest_O, n_P, largest_P
    FROM f FULL JOIN o USING (o_custkey) FULL JOIN p USING (o_custkey)
""")
def module_join_chain(spark, root):
    # Grouped by the join key, so each module holds a customer once.
    return joins.join_modules(status_modules(table(spark, root, "orders")), ["o_custkey"], unique=True)


@query("module_join_repeated", """
    SELECT custkey, o_orderkey, c_name, n_accounts, c_mktsegment, s_name, rich
    FROM (SELECT o_custkey AS custkey, o_orderkey FROM orders)
    FULL JOIN (SELECT c_custkey AS custkey, c_name FROM customer) USING (custkey)
    FULL JOIN (SELECT c_custkey AS custkey, c_nationkey AS n_accounts FROM customer WHERE c_acctbal > 5000) USING (custkey)
    FULL JOIN (SELECT c_custkey AS custkey, c_mktsegment FROM customer WHERE c_nationkey < 9) USING (custkey)
    FULL JOIN (SELECT s_nationkey::BIGINT AS custkey, s_name FROM supplier) USING (custkey)
    FULL JOIN (SELECT s_suppkey AS custkey, s_acctbal > 5000 AS rich FROM supplier) USING (custkey)
""")
def module_join_repeated(spark, root):
    customer, supplier = table(spark, root, "customer"), table(spark, root, "supplier")
    key = F.col("c_custkey").alias("custkey")
    return joins.join_modules({
        "orders": table(spark, root, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey"),
        "names": customer.select(key, "c_name"),
        "accounts": customer.where("c_acctbal > 5000").select(key, F.col("c_nationkey").alias("n_accounts")),
        "segments": customer.where("c_nationkey < 9").select(key, "c_mktsegment"),
        "suppliers": supplier.select(F.col("s_nationkey").cast("bigint").alias("custkey"), "s_name"),
        "rich": supplier.select(F.col("s_suppkey").alias("custkey"), (F.col("s_acctbal") > 5000).alias("rich")),
    }, ["custkey"])


@query("lookup_default", """
    WITH level AS (SELECT c_nationkey AS level, max(c_acctbal) AS top FROM customer GROUP BY 1 HAVING max(c_acctbal) > 9800)
    SELECT s_suppkey, coalesce(top, -1.0::DOUBLE) AS top FROM supplier LEFT JOIN level ON s_nationkey = level
""")
def lookup_default(spark, root):
    level = table(spark, root, "customer").groupBy(F.col("c_nationkey").alias("level")).agg(
        F.max("c_acctbal").alias("best")).where("best > 9800")
    suppliers = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    return joins.lookup(suppliers, level, "s_nationkey", "best", "top", -1.0).select("s_suppkey", "top")


def survey_modules(spark, root):
    """Module tables of three cycles in raw survey names, from orders and customers."""
    out = {}
    customer = table(spark, root, "customer")
    for cycle, df in order_cycles(table(spark, root, "orders")).items():
        out[cycle, "TRIGLY"] = df.select("SEQN", *[c for c in ("LBXTR", "LBXTLG") if c in df.columns])
        if "BMXWT" in df.columns:
            out[cycle, "BMX"] = df.select("SEQN", F.col("BMXWT").cast("double").alias("BMXWT"))
        out[cycle, "GHB"] = customer.select(
            F.col("c_custkey").cast("double").alias("SEQN"), (F.col("c_acctbal") / 1000).alias("LBXGH"))
    return out


@query("consolidate_cycles", """
    WITH o AS (SELECT CASE WHEN year(o_orderdate) <= 1996 THEN '1995-1996' WHEN year(o_orderdate) <= 1999 THEN '1997-1999'
                           ELSE '2000-2001' END AS cycle, o_orderkey::DOUBLE AS subject_id, o_totalprice AS triglycerides,
                      CASE WHEN year(o_orderdate) >= 1997 THEN o_custkey::DOUBLE END AS weight_kg FROM orders),
    g AS (SELECT cycle, c_custkey::DOUBLE AS subject_id, c_acctbal / 1000 AS glucose_value
          FROM customer, (VALUES ('1995-1996'), ('1997-1999'), ('2000-2001')) AS c(cycle))
    SELECT cycle, subject_id, triglycerides, weight_kg, glucose_value, (glucose_value >= 5.7)::BIGINT AS diabetes_risk
    FROM o FULL JOIN g USING (cycle, subject_id)
""")
def consolidate_cycles(spark, root):
    wide = consolidate_modules(survey_modules(spark, root))
    return wide.select("cycle", "subject_id", "triglycerides", "weight_kg", "glucose_value", "diabetes_risk")


# Survey years in which the modules' variable names are valid.
SURVEY_YEARS = {"1995-1996": "2015-2016", "1997-1999": "2017-2018", "2000-2001": "2021-2023"}


@query("cycle_tree", """
    WITH o AS (SELECT CASE WHEN year(o_orderdate) <= 1996 THEN '2015-2016' WHEN year(o_orderdate) <= 1999 THEN '2017-2018'
                           ELSE '2021-2023' END AS cycle, o_orderkey::DOUBLE AS subject_id, o_totalprice AS tri,
                      CASE WHEN year(o_orderdate) >= 1997 THEN o_custkey::DOUBLE END AS weight_kg FROM orders),
    g AS (SELECT cycle, c_custkey::DOUBLE AS subject_id, c_acctbal / 1000 AS glucose_value
          FROM customer, (VALUES ('2015-2016'), ('2017-2018'), ('2021-2023')) AS c(cycle))
    SELECT 'row' AS kind, cycle, subject_id, tri, weight_kg, glucose_value, NULL AS note FROM o FULL JOIN g USING (cycle, subject_id)
    UNION ALL SELECT 'refused', '2015-2016', NULL, NULL, NULL, NULL, 'SEQN not found'
    UNION ALL SELECT 'refused', '2017-2018', NULL, NULL, NULL, NULL, 'no rows'
""")
def cycle_tree(spark, root):
    """Raw module files, gated and harmonised into a second tree, consolidated into a third, read back."""
    top = f"{ensure_checkpoint_dir(spark)}/tree-{uuid.uuid4().hex}"
    raw = {(SURVEY_YEARS[cycle], module): df for (cycle, module), df in survey_modules(spark, root).items()}
    one = next(iter(raw.values()))
    raw["2015-2016", "NOID"] = one.drop("SEQN")
    raw["2017-2018", "EMPTY"] = one.where(F.lit(False))
    for (cycle, module), df in raw.items():
        modules.write_table(df, f"{top}/raw/{cycle}/{module}.parquet")
    refused = []
    for (cycle, module), df in read_modules(spark, f"{top}/raw").items():
        verdict = clean_module(df, cycle, f"{top}/clean/{cycle}/{module}.parquet")
        if not verdict.ok:
            refused.append((cycle, verdict.reason))
    wide = consolidate(spark, f"{top}/clean", f"{top}/wide")
    rows = wide.select(
        F.lit("row").alias("kind"), F.col("cycle").cast("string").alias("cycle"), "subject_id", F.col("TRIGLY").alias("tri"), "weight_kg",
        "glucose_value", F.lit(None).cast("string").alias("note"))
    table_of = local_table(spark, refused, "cycle string, note string").withColumn("kind", F.lit("refused"))
    return rows.unionByName(table_of, allowMissingColumns=True)


@query("stack_modules", """
    WITH c(cycle) AS (VALUES ('1995-1996'), ('1997-1999'), ('2000-2001')),
    o AS (SELECT CASE WHEN year(o_orderdate) <= 1996 THEN '1995-1996' WHEN year(o_orderdate) <= 1999 THEN '1997-1999'
                      ELSE '2000-2001' END AS cycle, * FROM orders)
    SELECT cycle AS "CYCLE", o_orderkey || '_' || cycle AS "SEQN_UNIQUE", NULL::DOUBLE AS "LBXGH" FROM o
    UNION ALL SELECT cycle, o_orderkey || '_' || cycle, NULL FROM o WHERE cycle <> '1995-1996'
    UNION ALL SELECT cycle, c_custkey || '_' || cycle, c_acctbal / 1000 FROM customer, c
""")
def stack_raw_modules(spark, root):
    return stack_modules(survey_modules(spark, root)).select("CYCLE", "SEQN_UNIQUE", "LBXGH")


@query("variable_availability", """
    WITH c(cycle) AS (VALUES ('1995-1996'), ('1997-1999'), ('2000-2001')),
    o AS (SELECT CASE WHEN year(o_orderdate) <= 1996 THEN '1995-1996' WHEN year(o_orderdate) <= 1999 THEN '1997-1999'
                      ELSE '2000-2001' END AS cycle, count(*) AS n FROM orders GROUP BY 1),
    g AS (SELECT cycle, (SELECT count(*) FROM customer) AS n FROM c),
    files AS (
        SELECT 'SEQN' AS variable, cycle, n FROM o UNION ALL SELECT 'SEQN', cycle, n FROM g
        UNION ALL SELECT 'SEQN', cycle, n FROM o WHERE cycle <> '1995-1996'
        UNION ALL SELECT 'LBXTR', cycle, n FROM o WHERE cycle <> '2000-2001'
        UNION ALL SELECT 'LBXTLG', cycle, n FROM o WHERE cycle = '2000-2001'
        UNION ALL SELECT 'BMXWT', cycle, n FROM o WHERE cycle <> '1995-1996'
        UNION ALL SELECT 'LBXGH', cycle, n FROM g)
    SELECT variable, sum(n)::BIGINT AS rows, array_to_string(list_sort(list(DISTINCT cycle)), ', ') AS cycles
    FROM files GROUP BY variable
""")
def variable_availability(spark, root):
    return availability_report(spark, survey_modules(spark, root))


# The pages hold plain word links, so the harvest looks for words where a survey page has file names.
CODES = ["in", "de", "the"]


@query("link_harvest", r"""
    WITH hrefs AS (
        SELECT page_id, unnest(regexp_extract_all(html, '<[aA]\s(?:[^>]*?\s)?[hH][rR][eE][fF]\s*=\s*["'']([^"'']*)["'']', 1)) AS href
        FROM pages)
    SELECT page_id, code, href, 'https://example.org' || href AS link,
           regexp_replace(regexp_extract(href, '([^/]*)$', 1), '[<>:"/\\|?*]', '_', 'g') AS file
    FROM hrefs, (VALUES ('in'), ('de'), ('the')) AS c(code)
    WHERE ends_with(lower(href), 'e') AND contains(lower(href), code)
""")
def link_harvest(spark, root):
    pages = table(spark, root, "pages")
    return links.harvest_links(pages, CODES, "https://example.org", suffix="e", keep=["page_id"])


@query("incremental_files", """
    WITH manifest AS (SELECT DISTINCT url FROM pages WHERE contains(url, '/en/'))
    SELECT page_id, url FROM pages ANTI JOIN manifest USING (url)
""")
def incremental_files(spark, root):
    pages = table(spark, root, "pages").select("page_id", "url")
    manifest = pages.where(F.col("url").contains("/en/")).select("url").distinct()
    return links.not_yet_loaded(pages, manifest, ["url"])


@query("load_summary", """
    WITH outcomes AS (
        SELECT o_orderpriority AS cycle, CASE WHEN c_custkey IS NOT NULL THEN 'skipped' ELSE 'new' END AS status
        FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON o_custkey = c_custkey)
    SELECT cycle, status, grouping_id(cycle, status)::INT AS level, count(*) AS files
    FROM outcomes GROUP BY ROLLUP (cycle, status)
""")
def load_summary(spark, root):
    candidates = table(spark, root, "orders").select(F.col("o_orderpriority").alias("cycle"), F.col("o_custkey").alias("file"))
    manifest = table(spark, root, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("file"))
    return modules.load_summary(links.load_outcomes(candidates, manifest))


@query("work_list", """
    WITH c AS (SELECT DISTINCT o_orderpriority AS cycle FROM orders)
    SELECT cycle, module FROM c, (VALUES ('DEMO'), ('BMX'), ('BPX')) AS m(module)
""")
def work_list(spark, root):
    return links.work_list_of(table(spark, root, "orders"), "o_orderpriority", ["DEMO", "BMX", "BPX"])


@query("discover_files")
def discover_files(spark, root):
    return modules.discover_files(spark, root).select("cycle", "module", "bytes")


@query("sets_by_key", """
    SELECT o_orderpriority, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses FROM orders GROUP BY 1
""")
def sets_by_key(spark, root):
    from tabprep.operators.stacking import sets_by_key as sets

    found = sets(table(spark, root, "orders"), "o_orderpriority", "o_orderstatus", "statuses")
    return found.withColumn("statuses", F.array_join("statuses", ","))


@query("first_last_rows", """
    (SELECT 'first' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)
    UNION ALL
    (SELECT 'last', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5)
""")
def first_last_rows(spark, root):
    from tabprep.operators.ordering import first_rows, last_rows

    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    order = ["o_totalprice", "o_orderkey"]
    return first_rows(orders, order).select(F.lit("first").alias("part"), "*").unionByName(
        last_rows(orders, order).select(F.lit("last").alias("part"), "*"))


@query("row_index", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_index FROM orders")
def row_index(spark, root):
    from tabprep.operators.ordering import with_row_index

    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return with_row_index(orders, ["o_totalprice", "o_orderkey"]).select("o_orderkey", "row_index")


def cycle_tables(spark, root):
    """Modules by cycle: orders by status as cycles, half of their columns in each of two modules."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")
    for cycle in ("F", "O", "P"):
        rows = orders.where(F.col("o_orderstatus") == cycle)
        subject = F.col("o_orderkey").cast("double").alias("SEQN")
        yield cycle, "GHB", rows.select(subject, (F.col("o_totalprice") / 50000).alias("LBXGH"))
        yield cycle, "BMX", rows.where(F.col("o_custkey") % 3 != 0).select(subject, F.col("o_custkey").cast("double").alias("BMXWT"))


@query("quarantined_files", """
    WITH m AS (SELECT o_orderstatus AS cycle, module, count(*) FILTER (module = 'GHB' OR o_custkey % 3 <> 0) AS rows
               FROM orders, (VALUES ('BMX'), ('GHB')) AS v(module) GROUP BY ALL)
    SELECT cycle, module, CASE WHEN cycle = 'P' AND module = 'BMX' THEN 'failed' ELSE 'processed' END AS status,
           CASE WHEN cycle = 'P' AND module = 'BMX' THEN 0 ELSE rows END::BIGINT AS rows_read FROM m
    UNION ALL SELECT 'O', 'NOTE', 'failed', 0
""")
def quarantined_files(spark, root):
    """A written tree with one file cut in half and one that is no table: what every table gave."""
    base = f"{ensure_checkpoint_dir(spark)}/tree-{uuid.uuid4().hex}"
    for cycle, module, df in cycle_tables(spark, root):
        df.coalesce(1).write.parquet(f"{base}/{cycle}/{module}.parquet")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base)
    victim = files.where(F.col("path").contains("/P/BMX.parquet/")).select("path", F.expr("substring(content, 1, 200)").alias("half")).first()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path, content in ((victim["path"], bytes(victim["half"])), (f"{base}/O/NOTE.parquet", b"no table")):
        where = jvm.org.apache.hadoop.fs.Path(path)
        stream = where.getFileSystem(conf).create(where, True)
        stream.write(bytearray(content))
        stream.close()
    _, outcomes = quarantine(spark, base)
    return outcomes.groupBy("cycle", "module", "status").agg(F.sum("rows_read").alias("rows_read"))


@query("rewritten_cycle", """
    WITH w AS (SELECT o_orderstatus AS cycle, o_orderkey AS subject_id, o_totalprice / 50000 * (CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END) AS g,
                      CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS weight FROM orders)
    SELECT cycle, count(*) AS rows, round(sum(g), 2) AS glucose, count(weight) AS weights, count(*) AS manifest_rows FROM w GROUP BY cycle
""")
def rewritten_cycle(spark, root):
    """Three cycles written, one of them written again from changed modules: the table and its manifest."""
    base = f"{ensure_checkpoint_dir(spark)}/tree-{uuid.uuid4().hex}"
    out = f"{base}-out"
    for cycle, module, df in cycle_tables(spark, root):
        df.write.parquet(f"{base}/{cycle}/{module}.parquet")
    cycles.rewrite_cycles(spark, base, out)
    changed = spark.read.parquet(f"{base}/O/GHB.parquet").withColumn("LBXGH", F.col("LBXGH") * 2)
    materialise(changed).write.mode("overwrite").parquet(f"{base}/O/GHB.parquet")
    cycles.rewrite_cycles(spark, base, out, ["O"])
    totals = cycles.read_cycles(spark, out).groupBy("cycle").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("glucose_value"), 2).alias("glucose"), F.count("weight_kg").alias("weights"))
    return totals.join(cycles.manifest(spark, out).select("cycle", F.col("rows").alias("manifest_rows")), "cycle")


@query("accounted_write", """
    WITH k AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
    g AS (SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price FROM k)
    SELECT 'status known' AS step, 'before' AS name, count(*) AS value FROM orders
    UNION ALL SELECT 'status known', 'after', count(*) FROM k
    UNION ALL SELECT 'rules', 'expensive', count(*) FILTER (price > 150000) FROM g
    UNION ALL SELECT 'rules', 'low', count(*) FILTER (o_orderpriority = '5-LOW') FROM g
    UNION ALL SELECT 'gaps before', 'price', count(*) FILTER (price IS NULL) FROM g
    UNION ALL SELECT 'gaps after', 'price', 0
    UNION ALL SELECT 'written', 'rows', count(*) FROM g
""")
def accounted_write(spark, root):
    """Filter, rules, imputation and writing in one job that also fills every count."""
    orders = table(spark.newSession(), root, "orders").select("o_orderstatus", "o_orderpriority", "o_totalprice")
    ledger = Ledger()
    kept = ledger.keep(orders, "status known", F.col("o_orderstatus") != "P")
    gapped = kept.withColumn("price", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")))
    ruled = ledger.rules(gapped, "rules", {"expensive": F.col("price") > 150000, "low": F.col("o_orderpriority") == "5-LOW"})
    filled = ledger.missing(ruled, "gaps before", ["price"]).fillna({"price": 0.0})
    done = ledger.rows(ledger.missing(filled, "gaps after", ["price"]), "written")
    done.write.parquet(f"{ensure_checkpoint_dir(spark)}/accounted-{uuid.uuid4().hex}")
    return ledger.report(spark)


@query("bucketed_full_join", ORACLES["module_full_join"])
def bucketed_full_join(spark, root):
    """Modules written in buckets of their key, opened again and joined without an exchange."""
    docs = table(spark, root, "documents").select("doc_id", "lang", "n_chars")
    orders = table(spark, root, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("priority"))
    place = f"{ensure_checkpoint_dir(spark)}/buckets-{uuid.uuid4().hex}"
    write_buckets({"documents": docs, "labels": table(spark, root, "labels"), "orders": orders}, ["doc_id"], place, 8)
    return join_buckets(spark, open_buckets(spark, place))
