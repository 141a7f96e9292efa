"""Hand-made edge rows (FIXTURES.md section 5) through the operators."""
import pytest
from pyspark.sql import functions as F

from heartspark import schema as S
from heartspark.functions import columns as C
from heartspark.functions import text as TX
from heartspark.operators import checks as CK
from heartspark.operators import duplicates as D
from heartspark.operators import scoring as SC
from heartspark.operators import star
from heartspark.operators import textmatch as TM
from heartspark.operators import transform as TR

BASE_ROW = dict(heart_disease=0, high_bp=0, high_chol=0, chol_check=1, bmi=22.0, smoker=0, stroke=0, diabetes=0,
                phys_activity=1, fruits=1, veggies=1, hvy_alcohol=0, any_healthcare=1, no_doc_cost=0, gen_hlth=2,
                ment_hlth_days=0, phys_hlth_days=0, diff_walk=0, sex=0, age_group=5, education=4, income=5)


def rows_df(spark, rows):
    cols = ["respondent_id"] + S.SOURCE_COLUMNS
    data = []
    for i, r in enumerate(rows):
        d = dict(BASE_ROW, **r)
        data.append(tuple([i + 1] + [float(d[c]) if d[c] is not None else None for c in S.SOURCE_COLUMNS]))
    schema = "respondent_id long, " + ", ".join(f"{c} double" for c in S.SOURCE_COLUMNS)
    return spark.createDataFrame(data, schema)


def analytical(spark, rows):
    return TR.transform_all(rows_df(spark, rows), id_col="respondent_id")


def test_bmi_classes_left_closed(spark):
    df = analytical(spark, [dict(bmi=b) for b in (18.4, 18.5, 25, 30, 35, 40)])
    assert [r.bmi_class for r in df.orderBy("respondent_id").collect()] == [1, 2, 3, 4, 5, 6]


def test_day_cap_flags(spark):
    df = analytical(spark, [dict(ment_hlth_days=30, phys_hlth_days=30), dict(bmi=13.9), dict(bmi=14), dict(bmi=60),
                            dict(bmi=60.1), dict(gen_hlth=4), dict(gen_hlth=3)]).orderBy("respondent_id").collect()
    assert df[0].total_unhealthy_days == 30
    assert [r.flag_bmi_extreme for r in df[1:5]] == [1, 0, 0, 1]
    assert df[5].flag_sante_incoherente == 1 and df[6].flag_sante_incoherente == 0


def test_twins(spark):
    df = analytical(spark, [dict(), dict(), dict(heart_disease=1, income=7), dict(heart_disease=0, income=7)])
    flags = [r.flag_profil_duplique for r in df.orderBy("respondent_id").collect()]
    assert flags == [1, 1, 0, 0]
    irr = D.irreducible(df).first()
    assert irr["ambiguous_profiles"] == 1 and irr["min_class_sum"] == 1


def test_bad_codes(spark):
    raw = rows_df(spark, [dict(high_bp=0.7), dict(age_group=None), dict(income=9), dict()])
    frac = {r["column_name"]: r["observed"] for r in CK.fractional_codes(raw).collect()}
    assert frac["high_bp"] == 1
    base = TR.transform_all(raw, id_col="respondent_id")
    rep = CK.check_report(base, sample_mode=True)
    failed = {(r["check"], r["column_name"]) for r in rep.where("failed = 1").collect()}
    assert ("nulls", "age_group") in failed and ("domain", "income") in failed
    with pytest.raises(CK.QualityCheckFailed):
        CK.raise_on_errors(rep)
    fact = star.build_fact(spark, base).orderBy("respondent_id").collect()
    assert fact[1].age_key == -1 and fact[2].income_key == -1
    need = {r["dimension"]: r["need_unknown"] for r in star.need_unknown(base).collect()}
    assert need["dim_age"] and need["dim_income"] and not need["dim_sex"]
    dim = star.published_dim(spark, base, "dim_income").collect()
    assert (-1, "Inconnu") in [(r[0], r[1]) for r in dim] and len(dim) == 9
    assert len(star.published_dim(spark, base, "dim_sex").collect()) == 2
    orph = {r["dimension"]: r["orphans"] for r in star.orphans(spark, star.build_fact(spark, base), base).collect()}
    assert all(v == 0 for v in orph.values())
    # Against the codebook alone the unknown keys are orphans.
    bare = {t: star.codebook_dim(spark, t) for t, *_ in S.DIMENSIONS}
    lost = {r["dimension"]: r["orphans"] for r in star.orphans_against(star.build_fact(spark, base), bare).collect()}
    assert lost == {t: {"dim_age": 1, "dim_income": 1}.get(t, 0) for t, *_ in S.DIMENSIONS}
    assert {tuple(r) for r in star.outside_codes(base, spark).collect()} == {("dim_income", 9)}
    loaded = [tuple(r) for r in star.load_dims(spark, base).collect()]
    assert {r for r in loaded if r[1] == -1} == {("dim_age", -1, "Inconnu"), ("dim_income", -1, "Inconnu")} and len(loaded) == 45


def test_close_risks_keep_their_order(spark):
    """Two risks of a peer group 1e-15 apart: the lower one has no peer below it."""
    low, high = 0.3, 0.3 + 1e-15
    rows = [(i, 5, 1, high if i % 2 else low) for i in range(40)] + [(100 + i, 9, 0, 0.1) for i in range(3)]
    df = spark.createDataFrame(rows, "respondent_id long, age_group int, sex int, risk double")
    got = {r.respondent_id: (r.grain, r.percentile_pct) for r in SC.peer_position(df).collect()}
    assert got[0] == ("age_sex", 0.0) and got[1] == ("age_sex", 50.0) and got[100] == ("all", 0.0)


def test_contributions_rank_inside_the_row(spark):
    df = spark.createDataFrame([(1, 1, 0, 3), (2, None, 1, 2)], "respondent_id long, a int, b int, c int")
    means = spark.createDataFrame([(0.0, 1.0, 2.0)], "m_a double, m_b double, m_c double")
    out = SC.top_contributions(df, {"a": 1, "b": 2, "c": -1}, means, 2)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().toString()
    assert [tuple(r) for r in out.orderBy("respondent_id", "rank").collect()] == [(1, "b", -2.0, 1), (1, "a", 1.0, 2), (2, "b", 0.0, 1), (2, "c", 0.0, 2)]


def test_text_match_has_no_shuffle(spark):
    from heartspark.operators import textmatch as TM
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Mon Cholestérol et si HDL"), (4, "obésités")], "id long, t string")
    out = TM.match(df, "t", ["id"])
    assert "Exchange" not in out._jdf.queryExecution().toString()
    got = {r.id: (r.faq_id, r.best_score) for r in out.collect()}
    assert got[1] == (None, 0) and got[2] == (None, 0) and got[3] == ("cholesterol", 4) and got[4] == (None, 1)


def test_risk_bands_and_levels(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.0500001,), (1.0,)], "p double")
    assert [r.b for r in df.select(C.risk_band("p").alias("b")).collect()] == [None, 1, 2, 5]
    lv = spark.createDataFrame([(0.0942 * x,) for x in (0.4, 0.6, 2, 4)], "p double")
    assert [r.l for r in lv.select(C.risk_level("p").alias("l")).collect()] == [
        "Faible", "Proche de la moyenne", "Élevé", "Très élevé"]


def test_peer_fallback(spark):
    rows = [(i, 5, 0, 0.01 * (i % 10)) for i in range(29)] + [(100 + i, 5, 1, 0.02) for i in range(30)]
    df = spark.createDataFrame(rows, "respondent_id long, age_group int, sex int, risk double")
    pos = {r.respondent_id: r for r in SC.peer_position(df).collect()}
    assert pos[0].grain == "age" and pos[0].peers_n == 59
    assert pos[100].grain == "age_sex" and pos[100].peers_n == 30 and pos[100].percentile_pct == 0.0
    lower = sum(1 for r in rows if r[3] < 0.05)
    assert pos[5].percentile_pct == pytest.approx(lower / 59 * 100)


def test_scenarios_and_advice(spark):
    base = analytical(spark, [dict(fruits=0, veggies=1), dict(), dict(smoker=1, high_bp=1)]).withColumn("risk", C.scorecard_risk())
    sc = SC.scenarios(base).where("respondent_id = 1").collect()
    assert len(sc) == 1 and sc[0].scenario == "Fruits et légumes au quotidien"
    alls = {r.respondent_id: r for r in SC.scenario_all(base).collect()}
    assert alls[1].n_changes == 2 and 2 not in alls and alls[3].risk_all < base.where("respondent_id = 3").first().risk
    adv = SC.advice(base).orderBy("respondent_id", "priority").collect()
    assert [r.title for r in adv if r.respondent_id == 2] == [SC.ADVICE_DEFAULT]
    assert [r.title for r in adv if r.respondent_id == 3] == ["Hypertension artérielle", "Tabagisme"]


def test_text_match(spark):
    texts = [(1, "C'est quoi le cholestérol élevé ?"), (2, "mal-être et jours"), (3, "bonjour"),
             (4, "ma tension artérielle"), (5, "hypertension")]
    df = spark.createDataFrame(texts, "id long, text string")
    got = {r.id: (r.faq_id, r.best_score) for r in TM.match(df, "text", ["id"]).collect()}
    assert got[1] == ("cholesterol", 2)
    assert got[2] == ("mal_etre", 5)          # phrase 'mal etre' counted once (3) + 'jours' (2)
    assert got[3] == (None, 0)
    assert got[4] == ("hypertension", 4)      # 'tension' word + 'arterielle' word
    assert got[5] == ("hypertension", 3)      # 'hypertension' word 2 + 'tension' substring 1
    n = spark.createDataFrame([("Élevé, Ça-va? ß",)], "t string").select(TX.normalise("t").alias("n")).first().n
    assert n == TX.normalise_py("Élevé, Ça-va? ß")


def test_text_tie_first_entry(spark):
    # 'masse' belongs to 'imc' (3rd) and 'scoring_lot' (13th): equal scores -> first entry.
    df = spark.createDataFrame([(1, "masse")], "id long, text string")
    assert TM.match(df, "text", ["id"]).first().faq_id == "imc"


def test_risk_band_include_zero(spark):
    df = spark.createDataFrame([(0.0,), (0.03,)], "p double")
    assert [r.b for r in df.select(C.risk_band("p", include_zero=True).alias("b")).collect()] == [1, 1]
    assert [r.b for r in df.select(C.risk_band("p").alias("b")).collect()] == [None, 1]


def test_correlation_is_pairwise(spark):
    """A null leaves a row out of the pairs of its own column only."""
    import numpy as np
    from heartspark.operators import stats as ST
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 3))
    x[:, 1] += x[:, 0]
    rows = [tuple(None if rng.random() < 0.2 else float(v) for v in r) for r in x]
    got = {(r.var1, r.var2): r["corr"] for r in ST.corr_pairs(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert len(got) == 9
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            both = np.array([(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None])
            assert abs(got[a, b] - np.corrcoef(both.T)[0, 1]) < 1e-8
