"""The two batch jobs end to end on the fixture written as the raw CSV file."""
import pytest

from heartspark import jobs
from heartspark import schema as S
from heartspark.operators.checks import QualityCheckFailed
from heartspark.sources import fixture
from heartspark.sources import io as IO


def test_etl_then_star(spark, tmp_path):
    raw = fixture.raw_survey(spark, "/root/testdata/sf0.001").drop("_src_file", "_src_block")
    IO.write_csv(raw.coalesce(2), str(tmp_path / "raw"))
    res = jobs.run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "base"), sample=None)
    assert res["rows"] == 1500 and res["alerts"] >= 1  # volume differs from the published file
    base = spark.read.parquet(str(tmp_path / "base"))
    assert base.columns == S.ANALYTICAL_COLUMNS
    out = jobs.build_star(spark, str(tmp_path / "base"), str(tmp_path / "exp"))
    assert len(out["tables"]) == 8
    fact = spark.read.parquet(str(tmp_path / "exp/parquet/fact_respondent"))
    assert fact.count() == 1500 and fact.columns == S.FACT_COLUMNS
    assert spark.read.option("header", True).csv(str(tmp_path / "exp/csv/dim_age")).count() == 13


def test_etl_blocks_on_bad_codes(spark, tmp_path):
    p = tmp_path / "bad.csv"
    row = ["0"] * len(S.RENAME)
    header = list(S.RENAME)
    row[header.index("Age")] = "99"
    row[header.index("BMI")] = "25"
    for c in ("GenHlth", "Education", "Income"):
        row[header.index(c)] = "1"
    p.write_text(",".join(header) + "\n" + ",".join(row) + "\n")
    with pytest.raises(QualityCheckFailed):
        jobs.run_etl(spark, str(p), str(tmp_path / "out"), sample=1)
    assert not (tmp_path / "out").exists()
