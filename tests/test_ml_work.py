"""The diagnostics do their whole job: rounds, rows and models that they name."""
from types import SimpleNamespace

from heartspark.plans import ml


def test_validation_curve_has_all_rounds(monkeypatch):
    """Each depth's models have as many rounds as the kept family's best setting."""
    seen = []
    pairs = {(i, 0): [({"roc_auc": 0.6}, {"roc_auc": 0.5 + i / 100})] for i in range(7)}
    monkeypatch.setattr(ml, "_folds", lambda spark, sf: None)
    monkeypatch.setattr(ml, "boosted_pairs", lambda folds, settings, shares=None: seen.extend(settings) or pairs)
    ml.ml_validation_curve(SimpleNamespace(createDataFrame=lambda rows, schema: rows), "")
    assert [s.depth for s in seen] == [1, 2, 3, 4, 6, 8, 10] and {s.rounds for s in seen} == {ml.BEST[ml.KEPT]["n_estimators"]}


def test_rows_are_prepared_once_a_query(spark, monkeypatch):
    """The queries that fit, save and score the calibrated model split their rows once."""
    from heartspark.plans import registry
    prepare, calls = ml._prepared, []
    monkeypatch.setattr(ml, "_prepared", lambda spark, sf: calls.append(sf) or prepare(spark, sf))
    monkeypatch.setattr(ml, "_FITTED", {})
    monkeypatch.setitem(ml.BEST, ml.KEPT, ml.BEST[ml.KEPT] | {"n_estimators": 2})
    for name in ("sink_model", "src_model", "ml_calibrate"):
        ml._FITTED.clear()
        calls.clear()
        assert registry.queries()[name](spark, "/root/testdata/sf0.001").count() and len(calls) == 1, name
