"""Quarantine of damaged files, ledgers on one job, rewriting single cycles."""

import os
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabprep.operators.ledger import Ledger, imputed_cells
from tabprep.plans import cycles
from tabprep.sources.quarantine import quarantine
from tests.conftest import by, rows


@pytest.fixture
def damaged(tmp_path):
    """A tree of a good table, one of two files of which one breaks in its pages, and a truncated, an empty, a blank and a text file."""
    (tmp_path / "2011").mkdir()
    (tmp_path / "2013" / "LAB.parquet").mkdir(parents=True)
    good = pd.DataFrame({"SEQN": range(2000), "x": [f"value {n * 7919}" for n in range(2000)]})
    good.to_parquet(tmp_path / "2011" / "DEMO.parquet")
    good.head(0).to_parquet(tmp_path / "2011" / "NONE.parquet")
    for n in (0, 1):
        pq.write_table(pa.Table.from_pandas(good), tmp_path / "2013" / "LAB.parquet" / f"part-{n}.parquet", row_group_size=500,
                       use_dictionary=False, write_page_checksum=True)
    broken = tmp_path / "2013" / "LAB.parquet" / "part-1.parquet"
    data = bytearray(broken.read_bytes())
    place = pq.ParquetFile(broken).metadata.row_group(2).column(1).data_page_offset
    data[place + 60:place + 100] = b"\xff" * 40
    broken.write_bytes(data)
    whole = (tmp_path / "2011" / "DEMO.parquet").read_bytes()
    (tmp_path / "2011" / "CUT.parquet").write_bytes(whole[:len(whole) // 2])
    (tmp_path / "2011" / "BLANK.parquet").write_bytes(b"")
    (tmp_path / "2013" / "TEXT.parquet").write_bytes(b"this is no table at all")
    return str(tmp_path)


def test_quarantine(spark, damaged):
    good, outcomes = quarantine(spark, damaged)
    found = {Path(r["file"]).name if r["module"] == "LAB" else r["module"]: r for r in outcomes.collect()}
    assert {k: (r["status"], r["rows"]) for k, r in found.items()} == {
        "DEMO": ("processed", 2000), "NONE": ("empty", 0), "part-0.parquet": ("processed", 2000), "part-1.parquet": ("damaged", 2000),
        "CUT": ("failed", None), "BLANK": ("failed", None), "TEXT": ("failed", None)}
    assert 0 <= found["part-1.parquet"]["rows_read"] < 2000 and "of 2000 rows" in found["part-1.parquet"]["error"]
    assert all(found[k]["error"] for k in ("CUT", "BLANK", "TEXT"))
    assert {k: df.count() for k, df in good.items()} == {("2011", "DEMO"): 2000, ("2011", "NONE"): 0, ("2013", "LAB"): 2000}
    assert good["2013", "LAB"].agg(F.sum("SEQN")).first()[0] == sum(range(2000))


def test_quarantine_without_a_good_file(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "BAD.parquet").write_bytes(b"text")
    good, outcomes = quarantine(spark, str(tmp_path))
    assert good == {} and [(r["module"], r["status"]) for r in outcomes.collect()] == [("BAD", "failed")]


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_ledger_counts_on_the_job_that_writes(spark, make, tmp_path):
    table = make([(i, None if i % 4 == 0 else float(i % 50), i % 3) for i in range(1000)], "id int, x double, kind int")
    table.write.parquet(str(tmp_path / "in"))
    ledger, source = Ledger(), spark.newSession().read.parquet(str(tmp_path / "in"))
    known = ledger.keep(source, "with kind", F.when(F.col("kind") < 2, True))  # NULL elsewhere
    ruled = ledger.rules(known, "rules", {"x above 40": F.col("x") > 40, "`odd` name": F.col("kind") == 1})
    before = ledger.missing(ruled, "before", ["x"])
    after = ledger.rows(ledger.missing(before.fillna({"x": 0.0}), "after", ["x"]), "written")
    assert scans(after) == 1
    tracker, group = spark.sparkContext.statusTracker(), "ledger-test"
    spark.sparkContext.setJobGroup(group, group)
    after.write.parquet(str(tmp_path / "out"))
    jobs = len(tracker.getJobIdsForGroup(group))
    report = ledger.report(spark)
    got = {(r["step"], r["name"]): r["value"] for r in report.collect()}
    spark.sparkContext.setJobGroup("", "")
    kept = [(i, None if i % 4 == 0 else i % 50, i % 3) for i in range(1000) if i % 3 < 2]
    assert got == {
        ("with kind", "before"): 1000, ("with kind", "after"): len(kept), ("rules", "x above 40"): sum((x or 0) > 40 for _, x, _ in kept),
        ("rules", "`odd` name"): sum(k == 1 for *_, k in kept), ("before", "x"): sum(x is None for _, x, _ in kept), ("after", "x"): 0,
        ("written", "rows"): len(kept)}
    assert jobs == 1  # one job has written the table and filled every counter
    assert tuple(imputed_cells(report, "before", "after").first()) == ("x", got["before", "x"], 0, got["before", "x"])
    assert Ledger().report(spark).count() == 0


@pytest.fixture
def tree(tmp_path):
    def write(cycle, module, data):
        (tmp_path / "in" / cycle).mkdir(parents=True, exist_ok=True)
        pd.DataFrame(data).to_parquet(tmp_path / "in" / cycle / f"{module}.parquet")

    write("2011-2012", "DEMO", {"SEQN": [1.0, 2.0, 3.0], "RIDAGEYR": [30.0, 40.0, 50.0]})
    write("2011-2012", "BMX", {"SEQN": [2.0, 3.0, 4.0], "BMXWT": [60.0, 70.0, 80.0]})
    write("2013-2014", "DEMO", {"SEQN": [1.0, 9.0], "RIDAGEYR": [31.0, 41.0]})
    return write, str(tmp_path / "in"), str(tmp_path / "out")


def files_of(out, cycle):
    folder = os.path.join(out, f"cycle={cycle}")
    return {f: os.stat(os.path.join(folder, f)).st_mtime_ns for f in os.listdir(folder)} if os.path.isdir(folder) else None


def test_rewriting_one_cycle_leaves_the_others(spark, tree):
    write, root, out = tree
    first = cycles.rewrite_cycles(spark, root, out)
    assert sorted((r["cycle"], r["rows"]) for r in first.collect()) == [("2011-2012", 4), ("2013-2014", 2)]
    old, others = files_of(out, "2011-2012"), files_of(out, "2013-2014")
    when = {r["cycle"]: r["written_at"] for r in cycles.manifest(spark, out).collect()}
    write("2011-2012", "DEMO", {"SEQN": [1.0, 2.0, 3.0, 7.0], "RIDAGEYR": [30.0, 40.0, 50.0, 60.0]})
    cycles.rewrite_cycles(spark, root, out, ["2011-2012"])
    assert files_of(out, "2013-2014") == others and not set(files_of(out, "2011-2012")) & set(old)
    got = {(r["cycle"], r["subject_id"]): (r["age_years"], r["weight_kg"]) for r in cycles.read_cycles(spark, out).collect()}
    assert got == {("2011-2012", 1): (30.0, None), ("2011-2012", 2): (40.0, 60.0), ("2011-2012", 3): (50.0, 70.0), ("2011-2012", 4): (None, 80.0),
                   ("2011-2012", 7): (60.0, None), ("2013-2014", 1): (31.0, None), ("2013-2014", 9): (41.0, None)}
    now = by(cycles.manifest(spark, out), "cycle")
    assert {c: r["rows"] for c, r in now.items()} == {"2011-2012": 5, "2013-2014": 2}
    assert now["2013-2014"]["written_at"] == when["2013-2014"] and now["2011-2012"]["written_at"] > when["2011-2012"]


def test_a_cycle_that_has_become_empty_goes(spark, tree):
    _, root, out = tree
    cycles.rewrite_cycles(spark, root, out)
    none = cycles.read_cycles(spark.newSession(), out).where("cycle = '2013-2014' and subject_id > 100")
    cycles.write_cycles(none, out, ["2013-2014"])
    assert files_of(out, "2013-2014") is None
    assert {r["cycle"]: r["rows"] for r in cycles.manifest(spark, out).collect()} == {"2011-2012": 4, "2013-2014": 0}
    with pytest.raises(ValueError):
        cycles.write_cycles(spark.newSession().createDataFrame([(1, "x"), (2, "y")], "subject_id int, cycle string"), out + "-2", ["x"])
    with pytest.raises(AnalysisException):
        cycles.rewrite_cycles(spark, root, out, ["1999-2000"])
    assert rows(cycles.read_cycles(spark, out).select("cycle").distinct()) == [("2011-2012",)]


def test_the_session_can_still_evaluate(spark, tree):
    from tabprep.plans.modelling import roc_auc

    _, root, out = tree
    cycles.rewrite_cycles(spark, root, out)
    assert roc_auc(spark.createDataFrame([(0.0, 0.1), (1.0, 0.9)], "label double, score double")) == 1.0
