"""The jobs: registered queries against SQL, a second run over grown input, a run over some sets, batches that run again, odd rows, config files."""

import json
import logging
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_queries import duck, plain  # noqa: F401  a fixture of this name

from jobs import catalog, condition_report, source_ledger
from transect.plans.checkpoint import probe
from transect.sources.survey import file_pattern

HERE = Path(catalog.__file__).parent


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf_small, duck, name):  # noqa: F811
    got, want = catalog.queries()[name](spark, sf_small).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)


@pytest.fixture
def ledger_config():
    return source_ledger.Config("doc_id", "source", "text", buckets=4, files_per_batch=2)


def told(spark, out, config):
    return {(r.source, r.key): r.asDict() for r in source_ledger.current(source_ledger.ledger_of(spark, out, config)).collect()}


def test_ledger_takes_only_what_is_new(spark, sf_small, tmp_path, ledger_config, caplog):
    caplog.set_level(logging.INFO)
    table, out, mark = (str(tmp_path / n) for n in ("documents", "ledger", "mark"))
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "source").cache()
    docs.filter("doc_id % 2 = 0").repartition(3).write.parquet(table)
    first = source_ledger.run(spark, table, out, mark, ledger_config)
    even = docs.filter("doc_id % 2 = 0").count()
    assert first == {"batches": 2, "rows": even, "missing": 0}  # three files, two in a batch
    before = told(spark, out, ledger_config)
    assert len(before) == even and all(r["n_entries"] == 1 and not r["changed"] for r in before.values())
    assert source_ledger.run(spark, table, out, mark, ledger_config) == {"batches": 0, "rows": 0, "missing": 0}
    # Grown: the odd ones, one delivered again as it was, one changed.
    again, other = (r.doc_id for r in docs.filter("doc_id % 2 = 0").orderBy("doc_id").limit(2).collect())
    docs.filter(f"doc_id % 2 = 1 OR doc_id IN ({again}, {other})").withColumn("text", F.when(F.col("doc_id") == other, "now 1.5 2e3\n\n x").otherwise(F.col("text"))).coalesce(1).write.mode("append").parquet(table)
    second = source_ledger.run(spark, table, out, mark, ledger_config)
    assert second["rows"] == docs.count() - even + 2 and second["batches"] == 1
    after = told(spark, out, ledger_config)
    assert len(after) == docs.count() and source_ledger.ledger_of(spark, out, ledger_config).count() == docs.count() + 2
    by_id = {k[1]: r for k, r in after.items()}
    assert by_id[again]["n_entries"] == 2 and not by_id[again]["changed"] and by_id[other]["changed"]
    assert [by_id[other][c] for c in source_ledger.COUNTS] == [15, 2, 4, 2]
    same = [k for k in before if k[1] not in (again, other)]
    assert all(before[k] == after[k] for k in same)
    assert f"read {second['rows']} rows of {table}" in caplog.text
    for r in docs.filter("doc_id < 20").collect():
        if r.doc_id != other:
            data = r.text.encode()
            assert by_id[r.doc_id]["probe"] == probe(lambda at, n, d=data: d[at : at + n], len(data)) and by_id[r.doc_id]["n_bytes"] == len(data)


def test_ledger_batch_that_died_runs_again(spark, tmp_path, ledger_config):
    """A batch whose output was written, but whose end isn't in the checkpoint, replaces what it left."""
    table, out, mark = (str(tmp_path / n) for n in ("t", "ledger", "mark"))
    spark.range(50).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'s' AS source").repartition(4).write.parquet(table)
    source_ledger.run(spark, table, out, mark, ledger_config)
    before = sorted(map(repr, source_ledger.ledger_of(spark, out, ledger_config).collect()))
    for f in (tmp_path / "mark" / "commits").glob("*1*"):
        f.unlink()
    for f in (tmp_path / "mark" / "commits").glob(".1*"):
        f.unlink()
    assert source_ledger.run(spark, table, out, mark, ledger_config)["batches"] == 1
    assert sorted(map(repr, source_ledger.ledger_of(spark, out, ledger_config).collect())) == before


def test_ledger_of_odd_rows(spark, tmp_path, ledger_config):
    long = "é1 " * 5000
    rows = [(1, None, "a", "x"), (2, "", None, "x"), (None, "  \n\t\n", None, "x"), (3, "1 -2.5 .5 1e5 1,5 +3. e5\n\nnan", "a", "x"), (4, long, "a", "x"), (4, long, "a", "x"), (5, "y" * 4096, "a", "x"), (6, "y" * 4097, "a", "x")]
    table, out = str(tmp_path / "t"), str(tmp_path / "o")
    spark.createDataFrame(rows, "doc_id long, text string, source string, batch string").coalesce(1).write.parquet(table)
    source_ledger.run(spark, table, out, str(tmp_path / "m"), ledger_config)
    got = told(spark, out, ledger_config)
    counts = {k: tuple(r[c] for c in source_ledger.COUNTS) for k, r in got.items()}
    assert counts[("a", 1)] == (None,) * 4 and got[("a", 1)]["probe"] is None and not got[("a", 1)]["changed"]
    assert counts[(None, 2)] == (0, 0, 0, 0) and counts[(None, None)] == (5, 0, 0, 0) and counts[("a", 3)] == (29, 2, 8, 5)
    assert counts[("a", 4)] == (20000, 1, 5000, 0) and got[("a", 4)]["n_entries"] == 2
    for k, text in ((4, long), (5, "y" * 4096), (6, "y" * 4097)):
        assert got[("a", k)]["probe"] == probe(lambda at, n, d=text.encode(): d[at : at + n], len(text.encode()))
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(str(tmp_path / "none"))
    assert source_ledger.run(spark, str(tmp_path / "none"), str(tmp_path / "o2"), str(tmp_path / "m2"), ledger_config)["rows"] == 0
    assert source_ledger.current(source_ledger.ledger_of(spark, str(tmp_path / "o2"), ledger_config)).count() == 0


@pytest.fixture
def report_config():
    return condition_report.Config.load(str(HERE / "condition_report.json"))


def test_report_of_some_sets(spark, sf_small, tmp_path, report_config):
    from dataclasses import replace

    embeddings, events, out = f"{sf_small}/embeddings.parquet", f"{sf_small}/events.parquet", str(tmp_path / "out")
    done = condition_report.run(spark, embeddings, events, out, report_config)
    n = spark.read.parquet(embeddings).count()
    assert done["profiles"] == done["ratings"] == n
    rows = sorted(map(repr, condition_report.ratings_of(spark, out, report_config).collect()))
    totals = {(r.level, r.set_id, r.severity): r for r in condition_report.totals_of(spark, out).collect()}
    assert totals["all", None, None].n == n == sum(r.n for (level, *_), r in totals.items() if level == "set") == sum(r.n for (level, *_), r in totals.items() if level == "severity")
    # Two sets come again with other heights: only their partitions change, and a third, unknown one does no harm.
    some = replace(report_config, sets=("1", "2", "no such set"), scale=16.0)
    part = condition_report.run(spark, embeddings, events, out, some)
    assert 0 < part["profiles"] < n == part["ratings"]
    assert condition_report.ratings_of(spark, out, report_config).count() == n
    changed = sorted(map(repr, condition_report.ratings_of(spark, out, report_config).filter("set_id NOT IN ('1', '2')").collect()))
    assert changed == [r for r in rows if "set_id='1'" not in r and "set_id='2'" not in r] and sorted(map(repr, condition_report.ratings_of(spark, out, report_config).collect())) != rows
    condition_report.run(spark, embeddings, events, out, report_config)
    assert sorted(map(repr, condition_report.ratings_of(spark, out, report_config).collect())) == rows


def test_report_of_odd_rows(spark, tmp_path, report_config):
    steady = [0.01 * (k % 3) for k in range(64)]
    rows = [(1, steady, 1, "x"), (2, None, 1, "x"), (3, [], 1, "x"), (4, [float("nan")] * 64, None, "x"), (None, steady, 2, "x"), (5, [None, *steady], 1, "x"), (1, steady, 1, "x"), (6, [1.0], 1, "x")]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, frame string").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([(1, 1, 5.0), (1, 101, 105.0), (1, 101, 7.0), (None, None, None)], "user_id long, event_id long, value double").write.parquet(str(tmp_path / "t"))
    condition_report.run(spark, str(tmp_path / "p"), str(tmp_path / "t"), str(tmp_path / "o"), report_config)
    got = condition_report.ratings_of(spark, str(tmp_path / "o"), report_config).collect()
    assert len(got) == 8 and sorted(r.state for r in got) == ["error"] * 4 + ["ok"] * 4
    assert {(r.profile, round(r.chainage, 9)) for r in got if r.profile in (1, 2)} == {(1, 5.53), (2, 5.93)} and all(r.severity == -1 for r in got if r.state == "error")
    assert [r.chainage for r in got if r.set_id is None or r.profile is None] == [None, None]
    for name in ("p", "t"):
        spark.read.parquet(str(tmp_path / name)).limit(0).write.parquet(str(tmp_path / f"{name}0"))
    assert condition_report.run(spark, str(tmp_path / "p0"), str(tmp_path / "t0"), str(tmp_path / "o0"), report_config)["profiles"] == 0


def test_config_files(tmp_path):
    assert source_ledger.Config.load(str(HERE / "source_ledger.json")).key == "doc_id"
    bad = tmp_path / "c.json"
    bad.write_text(json.dumps({"key": "k", "group": "g", "text": "t", "buckets": 0}))
    with pytest.raises(ValueError):
        source_ledger.Config.load(str(bad))
    bad.write_text(json.dumps({"key": "k", "group": "g", "text": "t", "bucket": 1}))
    with pytest.raises(TypeError):
        source_ledger.Config.load(str(bad))
    assert file_pattern("/a/b.parquet/") == "/a/b.parque[t]"
    with pytest.raises(ValueError):
        file_pattern("/a/b]")


def test_command_line(sf_small, tmp_path):
    args = ["--table", f"{sf_small}/documents.parquet", "--out", str(tmp_path / "o"), "--checkpoint", str(tmp_path / "c"), "--config", str(HERE / "source_ledger.json")]
    got = subprocess.run([sys.executable, "-m", "jobs.source_ledger", *args], cwd=HERE.parent, capture_output=True, text=True, timeout=300, check=True)
    assert "wrote as many entries" in got.stderr and list((tmp_path / "o").rglob("*.parquet"))
