import threading
from pathlib import Path

from pyspark.sql import functions as F

from termshard.operators.bounds import broadcast_if_small, materialized, one_of, scratch_space


def test_scratch_goes_with_its_own_scope_alone(spark):
    """What another thread stores, and what is stored before, stays; inner scopes end first."""
    here, told, go_on = {}, threading.Event(), threading.Event()
    path = lambda df: Path(df.inputFiles()[0].removeprefix("file:")).parent

    def other():
        with scratch_space(spark):
            here["other"] = path(materialized(spark.range(3)))
            told.set()
            go_on.wait(60)
            here["alive"] = here["other"].exists()

    before = path(materialized(spark.range(3)))
    thread = threading.Thread(target=other)
    with scratch_space(spark):
        outer = path(materialized(spark.range(3)))
        thread.start()
        told.wait(60)
        with scratch_space(spark):
            inner = path(materialized(spark.range(3)))
        assert outer.exists() and not inner.exists()
    assert before.exists() and not outer.exists() and here["other"].exists()
    go_on.set()
    thread.join(60)
    assert here["alive"] and not here["other"].exists()


def test_only_small_sides_are_broadcast(spark):
    rows = spark.range(100).withColumn("text", F.lit("x" * 100))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(spark.range(5).join(broadcast_if_small(rows), "id"))
    assert "broadcast" not in plan(spark.range(5).join(broadcast_if_small(rows, max_rows=50), "id"))


def test_long_lists_become_ranges(spark):
    values = list(range(0, 1000, 3))
    kept = spark.range(1000).filter(one_of("id", values))
    assert {r["id"] for r in kept.collect()} >= set(values)
    assert spark.range(1000).filter(one_of("id", values, ranges=False)).count() == len(values)
