import pytest
from pyspark.sql import functions as F

from tabprep.plans.harmonise import harmonise_module
from tabprep.sources import links, modules
from tests.conftest import by, rows


def test_write_read_and_discover(make, spark, tmp_path):
    df = make([(1, "a", "c1"), (2, "b", "c2")], "id int, v string, cycle string")
    modules.write_table(df, str(tmp_path / "t"), partition_by=["cycle"])
    back = modules.read_table(spark, str(tmp_path / "t"), ["id", "cycle", "absent"])
    assert rows(back, "id") == [(1, "c1"), (2, "c2")]
    plan = back.where("cycle = 'c1'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cycle" in plan and "ReadSchema: struct<id:int>" in plan
    assert any("snappy" in f for f in back.inputFiles())


@pytest.fixture
def tree(make, tmp_path):
    import pandas as pd

    for cycle, module, data in [("2011-2012", "DEMO", {"SEQN": [1.0, 2.0], "RIDAGEYR": [30.0, 40.0]}),
                                ("2013-2014", "BMX", {"SEQN": [3.0], "BMXWT": [70.0]})]:
        folder = tmp_path / cycle
        folder.mkdir(exist_ok=True)
        pd.DataFrame(data).to_parquet(folder / f"{module}.parquet")
    (tmp_path / "2013-2014" / "BAD.parquet").write_bytes(b"not a parquet file")
    return str(tmp_path)


def test_tolerant_read(spark, tree):
    listed = modules.discover_files(spark, tree).select("cycle", "module")
    assert sorted(rows(listed)) == [("2011-2012", "DEMO"), ("2013-2014", "BAD"), ("2013-2014", "BMX")]
    out, outcomes = modules.read_tolerant(spark, tree)
    failed = {(r["cycle"], r["module"]): r["error"] for r in outcomes.collect() if r["status"] == "failed"}
    assert list(failed) == [("2013-2014", "BAD")] and failed["2013-2014", "BAD"] and outcomes.count() == 3
    assert sorted(rows(out.select("SEQN", "RIDAGEYR", "BMXWT", "cycle", "module")), key=str) == [
        (1.0, 30.0, None, "2011-2012", "DEMO"), (2.0, 40.0, None, "2011-2012", "DEMO"), (3.0, None, 70.0, "2013-2014", "BMX")]


def test_load_summary(make):
    df = make([("c1", "new"), ("c1", "new"), ("c1", "skipped"), ("c2", "failed")], "cycle string, status string")
    out = {(r["cycle"], r["status"]): r["files"] for r in modules.load_summary(df).collect()}
    assert out == {("c1", "new"): 2, ("c1", "skipped"): 1, ("c1", None): 3, ("c2", "failed"): 1, ("c2", None): 1, (None, None): 4}


PAGE = """<html><a href="/Nchs/2011/DEMO_G.XPT">x</a> <A class='k' HREF='/nchs/bmx_g.xpt'>y</A>
<a href="/demo/readme.pdf">z</a><a name="n">w</a><a data-href="/no/DEMO.xpt" href = "/nchs/demo_l.xpt">v</a>
<a href="/demo/BPX?v=1.xpt">u</a><area href="/nchs/demo_area.xpt"></html>"""


def test_link_harvest(make):
    pages = make([(1, PAGE), (2, "no links"), (3, None)], "page int, html string")
    out = links.harvest_links(pages, ["DEMO", "BMX"], "https://example.org", keep=["page"])
    assert sorted(rows(out.select("page", "code", "link", "file"))) == [
        (1, "BMX", "https://example.org/nchs/bmx_g.xpt", "bmx_g.xpt"),
        (1, "DEMO", "https://example.org/Nchs/2011/DEMO_G.XPT", "DEMO_G.XPT"),
        (1, "DEMO", "https://example.org/demo/BPX?v=1.xpt", "BPX_v=1.xpt"),
        (1, "DEMO", "https://example.org/nchs/demo_l.xpt", "demo_l.xpt"),
    ]
    strict = links.harvest_links(pages, ["DEMO"], match="prefix")
    assert sorted(r["file"] for r in strict.collect()) == ["DEMO_G.XPT", "demo_l.xpt"]
    with pytest.raises(ValueError):
        links.harvest_links(pages, ["DEMO"], match="other")


def test_manifest_grows(make, spark, tmp_path):
    path = str(tmp_path / "manifest")
    links.append_manifest(make([("a",), ("a",)], "file string"), path)
    links.append_manifest(make([("b",)], "file string"), path)
    assert sorted(rows(spark.read.parquet(path))) == [("a",), ("b",)]


def test_bad_module_is_reported(spark, tree):
    from tabprep.plans.consolidate import try_modules

    tables, outcomes = try_modules(spark, tree)
    assert list(tables) == [("2011-2012", "DEMO"), ("2013-2014", "BMX")]
    assert rows(outcomes.where("status = 'failed'").select("module")) == [("BAD",)]


def test_skip_known_files(make):
    found, manifest = make([("a",), ("b",)], "file string"), make([("b",)], "file string")
    assert rows(links.not_yet_loaded(found, manifest)) == [("a",)]
    assert rows(links.load_outcomes(found, manifest), "file") == [("a", "new"), ("b", "skipped")]


def test_work_list(spark):
    out = links.work_list(spark, ["c1", "c2"], ["A", "B"])
    assert rows(out, "seq") == [("c1", "A", 0), ("c1", "B", 1), ("c2", "A", 2), ("c2", "B", 3)]


def test_written_tables_can_be_removed(spark):
    import os

    from tabprep.session import materialise, remove_tables

    remove_tables(spark)
    path = materialise(spark.range(5).toDF("x")).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and remove_tables(spark) == 1 and not os.path.exists(path) and remove_tables(spark) == 0
