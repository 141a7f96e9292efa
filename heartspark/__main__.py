"""Command line: ``python -m heartspark etl CSV OUT [--sample N]`` and ``python -m heartspark star BASE EXPORTS``.

Uses the active cluster configuration (spark-submit / SPARK_* settings); a
local session is created only when no master is configured.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from . import jobs
from .operators.checks import QualityCheckFailed
from .session import ensure_checkpoint_dir


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="heartspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="raw CSV -> checked analytical table (Parquet)")
    e.add_argument("csv")
    e.add_argument("out")
    e.add_argument("--sample", type=int, default=None, help="first N rows only (volume/prevalence alerts skipped)")
    s = sub.add_parser("star", help="analytical table -> dimensions + fact, integrity, CSV/Parquet exports")
    s.add_argument("analytical")
    s.add_argument("exports")
    a = p.parse_args(argv)
    builder = SparkSession.builder.appName("heartspark")
    spark = builder.getOrCreate() if SparkSession.getActiveSession() or "--master" in sys.argv else builder.master(
        "local[*]").config("spark.ui.enabled", "false").getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        if a.cmd == "etl":
            print(jobs.run_etl(spark, a.csv, a.out, a.sample))
        else:
            print(jobs.build_star(spark, a.analytical, a.exports))
    except (QualityCheckFailed, jobs.IntegrityError) as err:
        print(f"[FAILED] {err}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
