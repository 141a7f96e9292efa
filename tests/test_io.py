"""Readers and writers."""
import pytest
from pyspark.sql import functions as F

from heartspark import schema as S
from heartspark.operators import transform as TR
from heartspark.sources import fixture
from heartspark.sources import io as IO

SF = "/root/testdata/sf0.001"


def test_csv_roundtrip_and_dense_id(spark, tmp_path):
    raw = fixture.raw_survey(spark, SF).drop("_src_file", "_src_block")
    IO.write_csv(raw.repartition(4), str(tmp_path / "csv"))
    back = IO.read_survey_csv(spark, str(tmp_path / "csv"))
    assert back.count() == 1500 and back.drop("_src_file", "_src_block").columns == list(S.RENAME)
    base = TR.transform_all(back)
    ids = [r[0] for r in base.select("respondent_id").orderBy("respondent_id").collect()]
    assert ids == list(range(1, 1501))


def test_sample_mode(spark, tmp_path):
    raw = fixture.raw_survey(spark, SF).drop("_src_file", "_src_block")
    IO.write_csv(raw.coalesce(1), str(tmp_path / "csv"))
    assert IO.read_survey_csv(spark, str(tmp_path / "csv"), sample=100).count() == 100


def test_failfast_on_bad_row(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(",".join(S.RENAME) + "\n" + ",".join(["x"] * len(S.RENAME)) + "\n")
    with pytest.raises(Exception):
        IO.read_survey_csv(spark, str(p)).collect()


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(Exception):
        IO.read_survey_csv(spark, str(tmp_path / "nope.csv")).collect()


def test_json_document_roundtrip(spark, tmp_path):
    doc = spark.range(3).agg(F.collect_list(F.struct(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))).alias("items"),
                             F.map_from_entries(F.collect_list(F.struct(F.col("id").cast("string"), F.col("id")))).alias("m"))
    IO.write_json_doc(doc, str(tmp_path / "j"))
    back = IO.read_json_doc(spark, str(tmp_path / "j"), doc.schema).first()
    assert [r["v"] for r in back["items"]] == [0, 2, 4] and back["m"]["2"] == 2


def _survey(tmp_path, spark, order):
    raw = fixture.raw_survey(spark, SF).drop("_src_file", "_src_block")
    IO.write_csv(raw.select(*order(raw.columns)), str(tmp_path / "csv"))
    return raw, str(tmp_path / "csv")


def test_columns_are_taken_by_name(spark, tmp_path):
    raw, path = _survey(tmp_path, spark, lambda names: [names[1], names[0], *names[2:]])
    back = IO.read_survey_csv(spark, path).drop("_src_file", "_src_block")
    assert back.columns == raw.columns and back.exceptAll(raw).count() == 0


def test_missing_column_is_named(spark, tmp_path):
    from heartspark import jobs
    from heartspark.operators import checks as CK
    _, path = _survey(tmp_path, spark, lambda names: [n for n in names if n not in ("BMI", "HeartDiseaseorAttack")])
    with pytest.raises(IO.MissingColumns, match="BMI"):
        IO.read_survey_csv(spark, path)
    with pytest.raises(CK.QualityCheckFailed, match="target column 'heart_disease'.*bmi|bmi.*|target"):
        jobs.run_etl(spark, path, str(tmp_path / "out"))
    left = TR.rename(IO.read_survey_csv(spark, path, strict=False))
    report = CK.check_report(left.withColumn("respondent_id", F.monotonically_increasing_id()), sample_mode=True)
    assert report.where("check = 'target_present'").first()["failed"] == 1
    profiles = left.drop("_src_file", "_src_block")
    IO.write_csv(profiles.withColumn("note", F.lit("x")), str(tmp_path / "profiles"))
    with pytest.raises(IO.MissingColumns, match="bmi"):
        IO.read_profiles_csv(spark, str(tmp_path / "profiles"))
    batch = IO.read_profiles_csv(spark, str(tmp_path / "profiles"), strict=False)
    assert "note" in batch.columns
    failed = CK.batch_contract(batch, list(S.FEATURES)).where("failed = 1").collect()
    assert [(r["check"], r["column_name"]) for r in failed] == [("missing_column", "bmi")]


def test_files_in_different_orders_fail(spark, tmp_path):
    raw = fixture.raw_survey(spark, SF).drop("_src_file", "_src_block")
    path = str(tmp_path / "csv")
    raw.coalesce(1).write.option("header", True).csv(path)
    raw.select(*raw.columns[::-1]).coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception):
        IO.read_survey_csv(spark, path).collect()


def test_no_local_folder_on_a_cluster():
    from heartspark import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    assert session.is_local("local[8]") and session.is_local("local") and not session.is_local("local-cluster[1,1,1024]")


def test_profiles_are_joined_by_one_hash(spark):
    """Profile sizes with nulls, negative zero and NaN as in a grouped count; the join's keys are one hash, not every column."""
    rows = [(i, x, y) for i, (x, y) in enumerate([(0.0, 1), (-0.0, 1), (None, 1), (None, 1), (float("nan"), None), (float("nan"), None), (1.0, 2), (2.0, None), (2.0, 1)])]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    out = TR.attach_profile_counts(df, ["x", "y"], "n")
    assert out.columns == ["id", "x", "y", "n"] and {r.id: r.n for r in out.collect()} == {0: 2, 1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 1, 7: 1, 8: 1}
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 1 and "xxhash64" not in joins[0] and "_hash" in joins[0] and "coalesce(x" not in out._jdf.queryExecution().executedPlan().toString()


def test_dimensions_are_checked_without_the_duplicate_flag(spark, monkeypatch):
    from heartspark.operators import star
    from heartspark.plans import io as plans
    seen = []
    monkeypatch.setattr(star, "published_dims", lambda spark, base: seen.append(base) or {})
    plans._star_tables(spark, SF)
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_star_export_is_the_same_in_both_forms(spark, tmp_path):
    fact = spark.createDataFrame([(i, i % 3, i / 4) for i in range(50)], "id long, k int, x double").repartition(3)
    IO.export_star({"dim": fact.select("k").distinct()}, fact, str(tmp_path))
    csv = spark.read.option("header", True).schema(fact.schema).csv(f"{tmp_path}/csv/fact_respondent")
    assert sorted(map(tuple, csv.collect())) == sorted(map(tuple, spark.read.parquet(f"{tmp_path}/parquet/fact_respondent").collect())) == sorted(map(tuple, fact.collect()))
