"""Tables where a third of the rows share one key and a third have none."""

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import latest, lookups
from tokenloom.settings import SESSION_OPTIONS

ROWS = 1_500_000
OPTIONS = SESSION_OPTIONS | {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    before = {name: spark.conf.get(name, None) for name in OPTIONS}
    for name, value in OPTIONS.items():
        spark.conf.set(name, value)
    folder = str(tmp_path_factory.mktemp("skew"))
    kind = F.col("id") % 3
    raw = F.when(kind == 0, "hot").when(kind == 1, F.concat(F.lit("k"), (F.col("id") % 50_000).cast("string")))
    spark.range(ROWS).withColumn("raw", raw).write.parquet(f"{folder}/rows")
    keys = spark.range(50_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("raw_value"), F.lit("t").alias("token"))
    keys.union(spark.range(1).select(F.lit("hot"), F.lit("t-hot"))).write.parquet(f"{folder}/keys")
    yield spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/keys")
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def records_per_task(spark):
    """Shuffle records read by each task of the last stage."""
    store = spark.sparkContext._jsc.sc().statusStore()
    default = [getattr(store, f"stageList$default${i}")() for i in (4, 5)]
    stage = store.stageList(None, False, False, *default).head()
    tasks, counts = store.taskList(stage.stageId(), stage.attemptId(), 10_000).iterator(), []
    while tasks.hasNext():
        counts.append(tasks.next().taskMetrics().get().shuffleReadMetrics().recordsRead())
    return counts


def test_no_task_of_a_lookup_gets_the_hot_key_whole(spark, skewed):
    rows, keys = skewed
    joined = lookups.lookup_text(rows, keys, "raw", "raw_value", "id")
    joined.write.format("noop").mode("overwrite").save()
    assert max(records_per_task(spark)) < ROWS / 6
    counted = joined.groupBy("token").count().collect()
    assert {r.token: r["count"] for r in counted} == {"t": ROWS // 3, "t-hot": ROWS // 3, None: ROWS // 3}


def test_the_hot_key_is_reduced_before_the_exchange(spark, skewed):
    rows, _ = skewed
    newest = latest.latest_by(rows, ["raw"], ["id"], ["id"])
    newest.write.format("noop").mode("overwrite").save()
    assert sum(records_per_task(spark)) < ROWS / 2
    assert newest.filter("raw = 'hot'").first().id == ROWS - 3 + (3 - ROWS % 3) % 3
