"""Scoring a live feed of survey answers with Structured Streaming.

The survey pipeline itself is batch (one snapshot); this module only shows that
its row-local steps run unchanged on ``readStream``: rename, typing, BMI class,
derived counts, row-level flags, risk, band, level and advice are all narrow
expressions, so the streaming plan is stateless. The duplicate flag and every
population statistic are whole-table operations and stay in the batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import columns as C
from ..operators import scoring as SC
from ..operators import transform as TR
from ..sources.io import RAW_SCHEMA


def read_raw_stream(spark: SparkSession, path: str, fmt: str = "csv", max_files: int | None = None) -> DataFrame:
    """Stream the raw survey files arriving under ``path`` with the declared 22-column schema.

    ``max_files`` limits the files of a batch, if given. A CSV file whose header differs is an error.
    """
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        r = r.option("header", True).option("enforceSchema", False)
    return r.format(fmt).load(path)


def score_stream(raw: DataFrame, id_col: str | None = None) -> DataFrame:
    """Row-local ETL + scorecard risk + presentation columns + advice titles (stateless)."""
    df = raw.transform(TR.rename).transform(TR.cast_types)
    df = df.transform(TR.add_bmi_class).transform(TR.add_derived).transform(TR.add_row_flags)
    df = df.withColumn("risk", C.scorecard_risk())
    rules = F.array(*[F.struct(F.lit(i + 1).alias("priority"), F.lit(t).alias("title"), F.expr(c).alias("applies"))
                      for i, (c, t) in enumerate(SC.ADVICE)])
    fired = F.transform(F.filter(rules, lambda r: r["applies"]), lambda r: r["title"])
    advice = F.when(F.size(fired) == 0, F.array(F.lit(SC.ADVICE_DEFAULT))).otherwise(fired)
    keep = [id_col] if id_col else []
    return df.select(*keep, *S.FEATURES, S.TARGET, "risk", C.risk_band("risk").alias("band"),
                     C.risk_level("risk").alias("niveau"), (F.col("risk") >= S.DECISION_THRESHOLD).cast("int").alias("signale"),
                     advice.alias("conseils"))


def start(scored: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet", trigger_once: bool = False):
    """Append the scored rows to ``sink_path``; the checkpoint folder (shared storage) makes restarts exactly-once."""
    w = scored.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
