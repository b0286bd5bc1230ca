"""The command line, from a raw CSV to a leaderboard."""

import os

from habitscope import jobs
from habitscope.plans import reports
from habitscope.registry import dataset
from habitscope.sources import tables

SF = "/root/testdata/sf0.001"


def test_jobs_run_from_raw_csv_to_leaderboard(spark, tmp_path, capsys):
    raw, users = str(tmp_path / "raw"), str(tmp_path / "users")
    tables.write_csv(dataset.raw_users(spark, SF).drop("record_id"), raw)
    jobs.main(["clean", "--input", raw, "--output", users])
    printed = capsys.readouterr().out
    assert "raw_rows: 1,500" in printed and "columns: 80" in printed
    n = tables.read_parquet(spark, users).count()

    out = str(tmp_path / "reports")
    jobs.main(["report", "--input", users, "--output", out, "--name", "loyalty_segments", "generations"])
    assert "ads_value_rank" in capsys.readouterr().out

    out = str(tmp_path / "clusters")
    jobs.main(["cluster", "--input", users, "--output", out, "--clusters", "3"])
    found = {name: tables.read_parquet(spark, f"{out}/{name}") for name in (
        "users", "elbow", "sizes", "profile", "projection")}
    assert found["users"].count() == found["projection"].count() == n and found["profile"].count() == 3
    assert {"PC1", "PC2", "Cluster"} <= set(found["projection"].columns)

    board = str(tmp_path / "board")
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    jobs.main(["regress", "--input", users, "--output", board, "--trees", "3", "--rounds", "1"])
    left = {x for x in set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before if "-" in x and x.count("-") < 4}
    assert left == set()
    assert tables.read_parquet(spark, f"{board}/leaderboard").count() == 7
    for name in ("histogram", "correlations", "importances", "permutation_importances"):
        assert tables.read_parquet(spark, f"{board}/{name}").count() > 0


def test_a_report_of_many_rows_is_written_whole(spark, tmp_path, capsys, monkeypatch):
    raw, users, out = (str(tmp_path / x) for x in ("raw", "users", "out"))
    tables.write_csv(dataset.raw_users(spark, SF).drop("record_id"), raw)
    jobs.main(["clean", "--input", raw, "--output", users, "--prefer", "sessions_per_day:double"])
    monkeypatch.setattr(jobs, "PREVIEW_ROWS", 5)
    jobs.main(["report", "--input", users, "--output", out, "--name", "countries_by_age"])
    n = tables.read_parquet(spark, f"{out}/countries_by_age").count()
    assert n == reports.countries_by_age(tables.read_parquet(spark, users)).count() > 5
    assert f"({n - 5} more rows in the output)" in capsys.readouterr().out


def test_reports_from_a_clean_csv_equal_those_from_parquet(spark, tmp_path, capsys):
    raw = str(tmp_path / "raw")
    tables.write_csv(dataset.raw_users(spark, SF).drop("record_id"), raw)
    jobs.main(["clean", "--input", raw, "--output", str(tmp_path / "p")])
    jobs.main(["clean", "--input", raw, "--output", str(tmp_path / "c"), "--output-format", "csv"])
    capsys.readouterr()
    texts = []
    for fmt, path in (("parquet", "p"), ("csv", "c")):
        jobs.main(["report", "--input", str(tmp_path / path), "--format", fmt, "--output", str(tmp_path / f"r{fmt}"),
                   "--name", "persona_by_gender", "anomaly_classes", "generations"])
        texts.append(capsys.readouterr().out)
    assert texts[0] == texts[1]
