"""Deals are made in many tasks although the parts are one small file, and checks on the dealt text do not go back to its scan."""

from pyspark.sql import functions as F

from bidbox.plans import q_handrec
from bidbox.plans.registry import Tables


def test_deals_are_spread_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_handrec, "TASK_PARTS", 50, raising=False)
    at = str(tmp_path)
    spark.range(1, 401).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).coalesce(1).write.parquet(f"{at}/part.parquet")
    t = Tables(spark, at)
    frame = q_handrec.pbn_frame(t)
    rows = sorted(map(tuple, frame.collect()))
    assert frame.rdd.getNumPartitions() > 1
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(q_handrec, "TASK_PARTS", 1000, raising=False)
    assert rows == sorted(map(tuple, q_handrec.pbn_frame(t).collect())) and 0 < len(rows) < 400
