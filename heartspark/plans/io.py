"""Sources, sinks and catalog queries. Each writes what the pipeline writes
to shared storage, reads it back with the matching reader, and returns what was read."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import sampling as SP
from ..operators import star
from ..operators.duplicates import arith_hash_sql
from ..session import scratch_path
from ..sources import fixture
from ..sources import io as IO
from ..sources.tables import analytical_base, fact, survey_base
from .common import Registry
from .sqlbase import ctes, with_fact

R = Registry()
q = R.add


def _tmp(spark, name):
    return scratch_path(spark, f"io/{name}-{uuid.uuid4().hex[:12]}")


_RAW_SQL = ctes() + "SELECT " + ", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in S.RENAME.items()) + " FROM survey"


def _write_survey(spark, sf, path, order=list):
    """The survey as CSV files in the order of the respondents, the columns in the order that ``order`` gives them."""
    back = {v: k for k, v in S.RENAME.items()}
    r = fixture.respondents(spark, sf)
    raw = r.select("respondent_id", *[F.col(c).cast("double").alias(back[c]) for c in S.SOURCE_COLUMNS])
    raw = raw.repartitionByRange("respondent_id").sortWithinPartitions("respondent_id").drop("respondent_id")
    IO.write_csv(raw.select(*order(raw.columns)), path)


@q("src_survey_csv", _RAW_SQL)
def src_survey_csv(spark, sf):
    """Raw survey rows written as CSV with the columns in another order, read back by name, FAILFAST."""
    path = _tmp(spark, "survey_csv")
    _write_survey(spark, sf, path, lambda names: names[::-1])
    return IO.read_survey_csv(spark, path).drop("_src_file", "_src_block")


@q("src_survey_csv_sample", _RAW_SQL + " WHERE respondent_id <= 1000")
def src_survey_csv_sample(spark, sf):
    """Sample mode: the first 1 000 rows in file order."""
    path = _tmp(spark, "survey_csv_sample")
    _write_survey(spark, sf, path)
    return IO.read_survey_csv(spark, path, sample=1000).drop("_src_file", "_src_block")


@q("etl_from_csv", ctes() + "SELECT " + ", ".join(S.ANALYTICAL_COLUMNS) + " FROM base")
def etl_from_csv(spark, sf):
    """The whole ETL chain from the CSV file: rename, type, derive, flag, dense file-order id."""
    from ..operators import transform as TR
    path = _tmp(spark, "survey_csv_etl")
    _write_survey(spark, sf, path)
    return TR.transform_all(IO.read_survey_csv(spark, path))


@q("sink_analytical", ctes() + "SELECT 'analytical_base' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM base")
def sink_analytical(spark, sf):
    """Replace the analytical table (Parquet) and return the row count read back."""
    path = _tmp(spark, "analytical_base")
    n = IO.load_analytical(analytical_base(spark, sf), path)
    return spark.createDataFrame([("analytical_base", n)], "table_name string, n_rows long")


@q("scan_pruned", ctes() + "SELECT " + ", ".join(S.FEATURES) + ", heart_disease FROM base")
def scan_pruned(spark, sf):
    """Read the stored analytical table pruned to the 21 features + target (ReadSchema has 22 columns)."""
    path = _tmp(spark, "analytical_pruned")
    IO.write_parquet(analytical_base(spark, sf), path)
    return spark.read.parquet(path).select(*S.FEATURES, S.TARGET)


@q("scan_full", ctes() + "SELECT * FROM base")
def scan_full(spark, sf):
    """Read the stored analytical table, all 31 columns."""
    path = _tmp(spark, "analytical_full")
    IO.write_parquet(analytical_base(spark, sf), path)
    return spark.read.parquet(path)


def _star_tables(spark, sf):
    base = analytical_base(spark, sf)
    # The dimensions' check reads codes alone: the duplicate flag, the one wide step, is left to the fact.
    return star.published_dims(spark, survey_base(spark, sf)), star.build_fact(spark, base)


def _inventory_sql():
    parts = [f"SELECT '{t}' AS table_name, CAST({len(m)} AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS n_columns" for t, _, _, _, m in S.DIMENSIONS]
    parts.append(f"SELECT 'fact_respondent', CAST(COUNT(*) AS BIGINT), CAST({len(S.FACT_COLUMNS)} AS BIGINT) FROM fact")
    return with_fact() + " UNION ALL ".join(parts)


@q("sink_star_export", _inventory_sql())
def sink_star_export(spark, sf):
    """Export the 8 warehouse tables to CSV and Parquet; inventory of the Parquet files read back."""
    root = _tmp(spark, "exports")
    dims, f = _star_tables(spark, sf)
    names = IO.export_star(dims, f, root)
    parts = []
    for n in names:
        t = spark.read.parquet(f"{root}/parquet/{n}")
        parts.append(t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows",
                                                                      F.lit(len(t.columns)).cast("long").alias("n_columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@q("sink_star_publish", _inventory_sql())
def sink_star_publish(spark, sf):
    """The 8 warehouse tables published as one version beside older ones; inventory of the version in force."""
    from ..sources import publish as PB
    root = _tmp(spark, "published")
    dims, f = _star_tables(spark, sf)
    PB.publish(spark, root, {**dims, "fact_respondent": f}, frozenset(dims))
    version, names = PB.current(spark, root)
    out = None
    for n in names:
        t = PB.read(spark, root, n, version)
        one = t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows", F.lit(len(t.columns)).cast("long").alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


@q("cat_inventory", _inventory_sql())
def cat_inventory(spark, sf):
    """Tables of the catalog with rows and columns (temp views over the exported Parquet files)."""
    root = _tmp(spark, "catalog")
    dims, f = _star_tables(spark, sf)
    names = IO.export_star(dims, f, root)
    for n in names:
        spark.read.parquet(f"{root}/parquet/{n}").createOrReplaceTempView(n)
    listed = sorted(t.name for t in spark.catalog.listTables() if t.name in names)
    return IO.inventory(spark, listed)


@q("cat_exists", ctes() + "SELECT 'analytical_base' AS table_name, CAST(COUNT(*) > 0 AS BIGINT) AS present FROM base "
   "UNION ALL SELECT 'analytical_base_missing', 0")
def cat_exists(spark, sf):
    """Tables that a stage requires, and whether the catalog has them: the stored analytical table, and one that isn't there."""
    path = _tmp(spark, "analytical_exists")
    IO.write_parquet(survey_base(spark, sf), path)
    name = f"analytical_base_{uuid.uuid4().hex[:8]}"
    spark.read.parquet(path).createOrReplaceTempView(name)
    rows = [("analytical_base", int(spark.catalog.tableExists(name))), ("analytical_base_missing", int(spark.catalog.tableExists(f"{name}_missing")))]
    spark.catalog.dropTempView(name)
    return spark.createDataFrame(rows, "table_name string, present long")


@q("cat_preview", with_fact() + "SELECT * FROM fact ORDER BY respondent_id LIMIT 10")
def cat_preview(spark, sf):
    """First 10 rows of a table (ordered by id so the preview is deterministic)."""
    fact(spark, sf).createOrReplaceTempView("fact_respondent")
    return spark.sql("SELECT * FROM fact_respondent ORDER BY respondent_id LIMIT 10")


@q("cat_sql", with_fact() + "SELECT age_key, CAST(COUNT(*) AS BIGINT) AS n, AVG(heart_disease) AS rate FROM fact "
   "WHERE sex_key = 1 GROUP BY age_key")
def cat_sql(spark, sf):
    """An ad-hoc SELECT through spark.sql over the registered fact view."""
    fact(spark, sf).createOrReplaceTempView("fact_respondent")
    return spark.sql("SELECT age_key, COUNT(*) AS n, AVG(heart_disease) AS rate FROM fact_respondent "
                     "WHERE sex_key = 1 GROUP BY age_key")


@q("cat_summarize")
def cat_summarize(spark, sf):
    """SUMMARIZE-like profile of the fact (DataFrame.summary: count, mean, stddev, min, quartiles, max)."""
    return fact(spark, sf).select("bmi", "total_unhealthy_days", "risk_factor_count").summary()


_FACT_TYPES = {"bmi": "float"}


@q("cat_columns", "SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({i + 1} AS BIGINT), '{c}', '{_FACT_TYPES.get(c, 'bigint' if c == 'respondent_id' else 'int')}')" for i, c in enumerate(S.FACT_COLUMNS))
    + ") t(position, column_name, data_type)")
def cat_columns(spark, sf):
    """Ordered columns of the fact with their types, from its schema alone."""
    return IO.columns_of(fact(spark, sf))


_PROFILE_COLUMNS = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in S.FEATURES)


@q("src_batch_profiles", ctes() + f"SELECT {_PROFILE_COLUMNS}, CAST(respondent_id AS VARCHAR) AS reference FROM base")
def src_batch_profiles(spark, sf):
    """A profile batch (21 features, no target) in another column order and with a column more, read by name."""
    path = _tmp(spark, "profiles_csv")
    _write_profiles(spark, sf, path)
    return IO.read_profiles_csv(spark, path)


def _write_profiles(spark, sf, path, without=()):
    b = survey_base(spark, sf)
    names = [c for c in S.FEATURES[::-1] if c not in without]
    IO.write_csv(b.select(*[F.col(c).cast("double") for c in names[:5]], F.col("respondent_id").cast("string").alias("reference"),
                          *[F.col(c).cast("double") for c in names[5:]]), path)


@q("chk_batch_file", "SELECT * FROM (VALUES ('missing_column', 'bmi', CAST(1 AS BIGINT), CAST(1 AS BIGINT)), "
   "('missing_column', 'smoker', CAST(1 AS BIGINT), CAST(1 AS BIGINT))) t(\"check\", column_name, observed, failed) UNION ALL " + ctes().replace("WITH", "SELECT * FROM (WITH", 1)
   + "SELECT 'empty' AS \"check\", '*' AS column_name, CAST(COUNT(*) AS BIGINT) AS observed, CAST(COUNT(*) = 0 AS BIGINT) AS failed FROM base"
   + "".join(f" UNION ALL SELECT 'nulls', '{c}', CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT), CAST(COUNT(*) FILTER (WHERE {c} IS NULL) > 0 AS BIGINT) FROM base"
             for c in S.FEATURES if c not in ("bmi", "smoker")) + ") x")
def chk_batch_file(spark, sf):
    """The batch contract held against a file that lacks two features: each is reported by name."""
    from ..operators import checks as CK
    path = _tmp(spark, "profiles_missing")
    _write_profiles(spark, sf, path, without=("bmi", "smoker"))
    return CK.batch_contract(IO.read_profiles_csv(spark, path, strict=False), list(S.FEATURES))


_BANDED = C.scorecard_risk_sql()


@q("sink_scored_csv", ctes() + f"SELECT {_PROFILE_COLUMNS}, CAST(respondent_id AS VARCHAR) AS reference, {_BANDED} AS risque_estime, "
   f"CAST({_BANDED} >= {S.DECISION_THRESHOLD} AS BIGINT) AS signale FROM base")
def sink_scored_csv(spark, sf):
    """A profile file scored and exported as CSV with all its columns, read back."""
    source, path = _tmp(spark, "to_score"), _tmp(spark, "scored_csv")
    _write_profiles(spark, sf, source)
    s = IO.read_profiles_csv(spark, source)
    s = s.withColumn("risque_estime", C.scorecard_risk())
    s = s.withColumn("signale", (F.col("risque_estime") >= S.DECISION_THRESHOLD).cast("int"))
    IO.write_csv(s, path)
    return spark.read.schema(s.schema).option("header", True).option("enforceSchema", False).csv(path)


@q("sink_ref_sample", ctes() + f"SELECT respondent_id, age_group, sex, bmi, gen_hlth, heart_disease, {C.scorecard_risk_sql()} AS risque "
   f"FROM base ORDER BY {arith_hash_sql('respondent_id', S.SEED)}, respondent_id LIMIT 25000")
def sink_ref_sample(spark, sf):
    """Reference sample: at most 25 000 scored rows to Parquet (src_ref_parquet reads it back)."""
    path = _tmp(spark, "ref_sample")
    b = survey_base(spark, sf).select("respondent_id", "age_group", "sex", "bmi", "gen_hlth", S.TARGET,
                                      C.scorecard_risk().alias("risque"))
    IO.write_parquet(SP.hash_sample(b, 25000), path)
    return spark.read.parquet(path)


@q("sink_ref_sample_profiles")
def sink_ref_sample_profiles(spark, sf):
    """The reference sample with each row's k-means profile (``profil``), to Parquet and read back."""
    from .mining import _profiled
    path = _tmp(spark, "ref_sample_profiles")
    b = survey_base(spark, sf).select("respondent_id", "age_group", "sex", "bmi", "gen_hlth", S.TARGET,
                                      C.scorecard_risk().alias("risque"))
    labels = _profiled(spark, sf).select("respondent_id", F.col("profile").alias("profil"))
    IO.write_parquet(SP.hash_sample(b, 25000).join(labels, "respondent_id", "left"), path)
    return spark.read.parquet(path)


@q("sink_ref_aggregates")
def sink_ref_aggregates(spark, sf):
    """The nested population document written as JSON and read back (src_ref_json)."""
    from .mining import sc_population
    path = _tmp(spark, "ref_json")
    doc = sc_population(spark, sf)
    IO.write_json_doc(doc, path)
    return IO.read_json_doc(spark, path, doc.schema)


def _saved_model(spark, sf, prepared):
    """The calibrated model of the training part of the rows of ``ml._prepared``, saved with its metadata; its path."""
    from ..operators import curves as CV
    from ..operators import models as MD
    from .ml import _split, calibrated_model
    model = calibrated_model(spark, sf, prepared)
    _, test = _split(spark, sf, prepared)
    scored = MD.materialize(model.score(test).select("respondent_id", S.TARGET, "score_raw", "score_calibrated"))
    picked = CV.pick_threshold(scored, "score_calibrated", S.TARGET, S.TARGET_RECALL).first()
    model = MD.CalibratedModel(model.models, model.maps, model.metadata | {"threshold": picked["threshold"], "recall": picked["recall"], "precision": picked["precision"],
                       "metrics": MD.metrics(scored, "score_calibrated", threshold=picked["threshold"]).first().asDict()})
    path = _tmp(spark, "model")
    model.save(spark, path)
    return path


@q("sink_model")
def sink_model(spark, sf):
    """The calibrated model and its metadata saved, loaded back (src_model) and used to score the test part."""
    from ..operators import models as MD
    from . import ml
    prepared = ml._prepared(spark, sf)
    loaded = MD.CalibratedModel.load(spark, _saved_model(spark, sf, prepared))
    _, test = ml._split(spark, sf, prepared)
    out = loaded.score(test).select("respondent_id", "score_raw", "score_calibrated")
    return out.withColumns({"family": F.lit(loaded.metadata["family"]), "threshold": F.lit(loaded.metadata["threshold"])})


@q("src_ref_parquet", ctes() + f"SELECT age_group, sex, CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG({C.scorecard_risk_sql()}), 12) AS mean_risk "
   "FROM base GROUP BY 1, 2")
def src_ref_parquet(spark, sf):
    """Read the stored reference sample (Parquet) and aggregate the peers it holds per (age, sex)."""
    path = _tmp(spark, "ref_sample_read")
    b = survey_base(spark, sf).select("respondent_id", "age_group", "sex", "bmi", "gen_hlth", S.TARGET,
                                      C.scorecard_risk().alias("risque"))
    IO.write_parquet(b, path)
    ref = spark.read.parquet(path)
    return ref.groupBy("age_group", "sex").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("risque"), 12).alias("mean_risk"))


@q("src_ref_json")
def src_ref_json(spark, sf):
    """Read the population JSON document with its declared nested schema and flatten the profiles array."""
    from .mining import sc_population
    path = _tmp(spark, "ref_json_read")
    doc = sc_population(spark, sf)
    IO.write_json_doc(doc, path)
    back = IO.read_json_doc(spark, path, doc.schema)
    return back.select(F.explode("profiles").alias("p")).select("p.*")


@q("src_model")
def src_model(spark, sf):
    """A saved calibrated model loaded and the whole table scored with it, flagged at its own threshold."""
    from ..operators import models as MD
    from . import ml
    loaded = MD.CalibratedModel.load(spark, _saved_model(spark, sf, ml._prepared(spark, sf)))
    rows = loaded.score(survey_base(spark, sf).select("respondent_id", *S.FEATURES))
    return rows.select("respondent_id", F.col("score_calibrated").alias("risk"),
                       (F.col("score_calibrated") >= loaded.metadata["threshold"]).cast("int").alias("signale"))


@q("ml_results")
def ml_results(spark, sf):
    """Nested results document of the kept, calibrated model (test metrics, threshold, confusion, class report, fit gap,
    calibration, learning curve, irreducible error, baseline, importance by mean absolute contribution) written as JSON and read back."""
    from ..operators import curves as CV
    from ..operators import duplicates as D
    from ..operators import models as MD
    from ..operators import treeshap as TS
    from .ml import BEST, KEPT, _folds, _prepared, _split, boosted_pairs, calibrated_model, curve_rows, fit_gap_rows, shift_of
    prepared = _prepared(spark, sf)
    folds = _folds(spark, sf, prepared)
    _, test = _split(spark, sf, prepared)
    model = calibrated_model(spark, sf, prepared)
    sc = model.score(test).cache()
    th = CV.pick_threshold(sc, "score_calibrated", S.TARGET, S.TARGET_RECALL)
    cut = th.first()["threshold"]
    conf = CV.threshold_metrics(sc, "score_calibrated", S.TARGET, float(cut))
    shares = [0.1, 0.28, 0.46, 0.64, 0.82, 1.0]
    pairs = boosted_pairs(folds, [MD.boosting_setting(BEST[KEPT])], shares)
    gap = spark.createDataFrame(fit_gap_rows(pairs[0, len(shares) - 1]), "metric string, train double, validation double, gap double, gap_pct double")
    learning = spark.createDataFrame(curve_rows([pairs[0, j] for j in range(len(shares))], shares),
                                     "fraction double, train_mean double, train_std double, validation_mean double, validation_std double")
    importance = TS.booster_contributions(model.models[0], test).groupBy("variable").agg(F.avg(F.abs("value")).alias("mean_abs")).select("mean_abs", "variable")
    base = survey_base(spark, sf)
    listed = lambda df, name: df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name))
    one = lambda df, name: df.select(F.struct("*").alias(name))
    doc = one(MD.metrics(sc, "score_calibrated", threshold=float(cut)), "test")
    for part in (one(th, "threshold"), one(conf, "confusion"), listed(CV.class_report(conf), "class_report"), listed(gap, "fit_gap"), listed(learning, "learning_curve"),
                 listed(importance, "importance"),
                 one(shift_of(sc), "calibration"), listed(CV.reliability(sc, "score_calibrated", S.TARGET), "reliability"),
                 one(D.irreducible(base), "irreducible_error"),
                 one(base.agg((1 - F.avg(S.TARGET)).alias("majority_accuracy"), (F.avg(S.TARGET) * 100).alias("real_rate_pct")), "baseline")):
        doc = doc.crossJoin(part)  # every part is one row
    doc = doc.withColumns({"model": F.lit(KEPT), "params": F.lit(str(BEST[KEPT])), "features": F.array(*[F.lit(c) for c in S.FEATURES])})
    path = _tmp(spark, "results_json")
    IO.write_json_doc(doc, path)
    sc.unpersist()
    return IO.read_json_doc(spark, path, doc.schema)
