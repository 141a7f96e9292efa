"""Distributed rank / prefix sum / dense id / split invariants."""
import pandas as pd
from pyspark.sql import functions as F

from heartspark import schema as S
from heartspark.functions import columns as C
from heartspark.operators import curves as CV
from heartspark.operators import ordering
from heartspark.operators import sampling as SP
from heartspark.operators import transform as TR
from heartspark.sources.tables import survey_base

SF = "/root/testdata/sf0.01"


def test_global_rank_is_a_permutation(spark):
    df = spark.range(0, 5000).withColumn("k", (F.col("id") * 7919) % 1009)
    r = ordering.global_rank(df, [F.col("k"), F.col("id")], "r", n=7).toPandas()
    exp = r.sort_values(["k", "id"]).reset_index(drop=True)
    assert list(exp["r"]) == list(range(1, 5001))


def test_running_sum_matches_pandas(spark):
    df = spark.range(0, 3000).withColumn("k", (F.col("id") * 31) % 997).withColumn("v", F.col("id") % 5)
    out = ordering.running_sum(df, [F.col("k"), F.col("id")], ["v"], n=5).toPandas().sort_values(["k", "id"])
    assert list(out["cum_v"]) == list(out["v"].cumsum())


def test_dense_row_id_multi_file(spark, tmp_path):
    pdf = pd.DataFrame({"x": range(1000)})
    for i in range(3):
        spark.createDataFrame(pdf.iloc[i * 333:(i + 1) * 333 + (1 if i == 2 else 0)]).coalesce(1).write.parquet(
            str(tmp_path / f"part{i}"))
    df = spark.read.parquet(str(tmp_path / "part*"))
    df = TR.with_source_position(df)
    ids = TR.dense_row_id(df, "rid").toPandas().sort_values("rid")
    assert list(ids["rid"]) == list(range(1, 1001))
    assert ids["x"].is_unique


def test_split_and_folds(spark):
    b = survey_base(spark, SF).select("respondent_id", S.TARGET)
    s = SP.stratified_split(b)
    c = {(r["split"], r[S.TARGET]): r["count"] for r in s.groupBy("split", S.TARGET).count().collect()}
    for y in (0, 1):
        n = c[("test", y)] + c[("train", y)]
        assert c[("test", y)] == (n * 20 + 99) // 100
    f = SP.stratified_folds(s.where("split = 'train'"))
    sizes = f.groupBy("fold", S.TARGET).count().toPandas()
    assert sizes.groupby(S.TARGET)["count"].agg(lambda x: x.max() - x.min()).max() <= 1


def test_auc_by_curve_equals_rank_sum(spark):
    b = survey_base(spark, SF).withColumn("risk", C.scorecard_risk()).select("risk", S.TARGET).toPandas()
    auc = CV.auc_ap(spark.createDataFrame(b), "risk", S.TARGET).first()["roc_auc"]
    r = b["risk"].rank(method="average")
    pos = b[S.TARGET] == 1
    npos, nneg = pos.sum(), (~pos).sum()
    mw = (r[pos].sum() - npos * (npos + 1) / 2) / (npos * nneg)
    assert abs(auc - mw) < 1e-9


def test_confusion_sums(spark):
    b = survey_base(spark, SF).withColumn("risk", C.scorecard_risk())
    m = CV.threshold_metrics(b, "risk", S.TARGET, 0.1).first()
    assert m["tp"] + m["fn"] == b.where(f"{S.TARGET} = 1").count()
    assert m["tp"] + m["fn"] + m["fp"] + m["tn"] == b.count()


def test_kth_smallest_matches_sort(spark):
    df = spark.range(0, 4000).withColumn("k", (F.col("id") * 7919) % 2003)
    pos = spark.createDataFrame([(1,), (17,), (2000,), (4000,)], "pos long")
    got = {r["pos"]: r["id"] for r in ordering.kth_smallest(df, [F.col("k"), F.col("id")], pos, n=6).collect()}
    srt = df.toPandas().sort_values(["k", "id"]).reset_index(drop=True)
    assert got == {p: int(srt.loc[p - 1, "id"]) for p in (1, 17, 2000, 4000)}
