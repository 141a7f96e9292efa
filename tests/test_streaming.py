"""The row-local scoring runs on a stream and equals the batch result."""
from pyspark.sql import functions as F

from heartspark.functions import columns as C
from heartspark.sources import fixture
from heartspark.sources import io as IO
from heartspark.streaming import live_scoring as LS


def test_stream_equals_batch(spark, tmp_path):
    raw = fixture.raw_survey(spark, "/root/testdata/sf0.001").drop("_src_file", "_src_block")
    src = str(tmp_path / "in")
    IO.write_csv(raw.repartition(3), src)
    stream = LS.score_stream(LS.read_raw_stream(spark, src))
    q = LS.start(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), trigger_once=True)
    q.awaitTermination(300)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 1500
    batch = LS.score_stream(raw)
    diff = batch.select("risk", "band", "niveau").exceptAll(out.select("risk", "band", "niveau"))
    assert diff.count() == 0
    assert out.where(F.size("conseils") == 0).count() == 0
