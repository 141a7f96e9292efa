"""Publishing tables as one version: a failure on the way leaves the version before."""
import pytest
from pyspark.sql import functions as F

from heartspark.sources import publish as PB


def tables(spark, n):
    return {"dim": spark.range(3).withColumn("v", F.lit(n)), "fact": spark.range(10 * n).withColumn("v", F.lit(n))}


def state(spark, root):
    version, names = PB.current(spark, root)
    return {name: (PB.read(spark, root, name).count(), PB.read(spark, root, name).agg(F.max("v")).first()[0]) for name in names}


def test_versions_replace_each_other_as_a_whole(spark, tmp_path):
    root = str(tmp_path / "star")
    assert PB.current(spark, root) is None
    first = PB.publish(spark, root, tables(spark, 1), frozenset({"dim"}))
    assert state(spark, root) == {"dim": (3, 1), "fact": (10, 1)}
    broken = tables(spark, 2)
    broken["fact"] = broken["fact"].withColumn("v", F.raise_error(F.lit("lost between two tables")))
    with pytest.raises(Exception, match="lost between two tables"):
        PB.publish(spark, root, broken, frozenset({"dim"}))
    assert state(spark, root) == {"dim": (3, 1), "fact": (10, 1)} and PB.current(spark, root)[0] == first
    PB.publish(spark, root, tables(spark, 3), frozenset({"dim"}))
    assert state(spark, root) == {"dim": (3, 3), "fact": (30, 3)} and PB.versions(spark, root).count() == 2
    assert PB.read(spark, root, "fact", first).count() == 10
    csv = spark.read.option("header", True).csv(f"{root}/versions/{PB.current(spark, root)[0]}/csv/fact")
    assert csv.count() == 30 and csv.columns == ["id", "v"]
