"""Batch jobs: the two command-line stages of the survey warehouse.

``run_etl``: raw CSV -> typed analytical table -> one-pass checks (raise on a
failed blocking check, print alerts) -> Parquet. The checks run before any
write, so a failed check publishes nothing.

``build_star``: analytical table -> dimensions (+ unknown member only when
needed) and fact -> referential integrity checked *before* publishing ->
Parquet and CSV exports.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .operators import checks as CK
from .operators import star
from .operators import transform as TR
from .sources import io as IO


class IntegrityError(Exception):
    pass


def run_etl(spark: SparkSession, csv_path: str, out_path: str, sample: int | None = None) -> dict:
    t0 = time.time()
    raw = IO.read_survey_csv(spark, csv_path, sample=sample, strict=False)
    missing = [v for k, v in S.RENAME.items() if k not in raw.columns]
    if missing:
        raise CK.QualityCheckFailed("; ".join(f"{'target ' if c == S.TARGET else ''}column '{c}' missing" for c in missing))
    base = TR.transform_all(raw).persist()
    report = CK.check_report(base, sample_mode=sample is not None,
                             raw=TR.rename(raw).drop("_src_file", "_src_block")).persist()
    alerts = report.where((F.col("severity") == CK.ALERT) & (F.col("failed") == 1)).collect()
    for a in alerts:
        print(f"  [ALERT] {a['check']} {a['column_name']}: {a['observed']}")
    CK.raise_on_errors(report)
    n = IO.load_analytical(base, out_path)
    base.unpersist()
    report.unpersist()
    return {"rows": n, "alerts": len(alerts), "seconds": round(time.time() - t0, 1)}


def build_star(spark: SparkSession, analytical_path: str, export_root: str) -> dict:
    t0 = time.time()
    base = spark.read.parquet(analytical_path)
    dims = star.published_dims(spark, base)
    fact = star.build_fact(spark, base)
    orphans = star.orphans_against(fact, dims).where("orphans > 0").collect()
    if orphans:
        raise IntegrityError("; ".join(f"{r['dimension']}: {r['orphans']} orphan keys" for r in orphans))
    for r in star.unknown_counts(fact).where("unknown_rows > 0").collect():
        print(f"  [info] {r['dimension']}: {r['unknown_rows']} row(s) -> {S.UNKNOWN_LABEL}")
    names = IO.export_star(dims, fact, export_root)
    return {"tables": names, "seconds": round(time.time() - t0, 1)}
