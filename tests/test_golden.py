"""Published fixture numbers (FIXTURES.md) reproduced by the Spark operators."""
import pytest
from pyspark.sql import functions as F

from heartspark import schema as S
from heartspark.functions import columns as C
from heartspark.operators import curves as CV
from heartspark.operators import duplicates as D
from heartspark.sources.tables import analytical_base, survey_base

GOLDEN = {
    # sf: rows, target %, rows in dup groups, redundant, distinct22-distinct21, ambiguous, sum min, bmi>60, bmi<14
    "sf0.001": (1500, 11.600, 360, 294, 22, 22, 40, 23, 36),
    "sf0.01": (15000, 11.347, 3841, 3690, 62, 62, 433, 165, 189),
}


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_fixture_golden(spark, sf):
    rows, rate, in_groups, redundant, d22_d21, amb, smin, gt60, lt14 = GOLDEN[sf]
    b = analytical_base(spark, f"/root/testdata/{sf}")
    one = b.agg(F.count(F.lit(1)).alias("n"), (F.avg(S.TARGET) * 100).alias("rate"),
                F.sum("flag_profil_duplique").alias("dup"), F.count_if(F.col("bmi") > 60).alias("gt60"),
                F.count_if(F.col("bmi") < 14).alias("lt14")).first()
    assert one["n"] == rows and round(one["rate"], 3) == rate
    assert one["dup"] == in_groups and one["gt60"] == gt60 and one["lt14"] == lt14
    t = D.totals(b).first()
    assert t["redundant_rows"] == redundant and t["rows_in_groups"] == in_groups
    irr = D.irreducible(b).first()
    assert t["distinct_profiles"] - irr["distinct_profiles"] == d22_d21 == irr["ambiguous_profiles"] == amb
    assert irr["min_class_sum"] == smin


def test_scorecard_golden_sf001(spark):
    b = survey_base(spark, "/root/testdata/sf0.01").withColumn("risk", C.scorecard_risk())
    bands = {r["band"]: r["n"] for r in b.groupBy(C.risk_band("risk").alias("band")).count().withColumnRenamed("count", "n").collect()}
    assert [bands[i] for i in range(1, 6)] == [1772, 3124, 5372, 4329, 403]
    levels = {r["l"]: r["count"] for r in b.groupBy(C.risk_level("risk").alias("l")).count().collect()}
    assert [levels[k] for k in ["Faible", "Proche de la moyenne", "Élevé", "Très élevé"]] == [1640, 5651, 5599, 2110]
    auc = CV.auc_ap(b, "risk", S.TARGET).first()["roc_auc"]
    assert round(auc, 4) == 0.7742
