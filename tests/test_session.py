"""Session helpers: UTC pin, checkpoint root, spread, state partitions."""

from windtally.session import checkpoint_root, ensure_utc, spread
from windtally.sources.comments import kafka_options


def test_utc_and_checkpoint_root(spark):
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    root = checkpoint_root(spark)
    assert root and checkpoint_root(spark) == root  # stable once set


def test_spread_only_when_fewer_splits(spark):
    one = spark.range(0, 1000, numPartitions=1)
    n = spark.sparkContext.defaultParallelism
    assert spread(one).rdd.getNumPartitions() == n
    many = spark.range(0, 1000, numPartitions=n * 2)
    assert spread(many) is many  # enough splits: no shuffle added


def test_kafka_min_partitions():
    assert kafka_options("b:1", "comments", min_partitions=24)["minPartitions"] == "24"
    assert "minPartitions" not in kafka_options("b:1", "comments")


def test_state_partitions_conf_restored(spark, scratch):
    from windtally.plans.fixtures import events_stream, events_to_comments
    from windtally.streaming.runner import start

    from conftest import SF_SMALL
    before = spark.conf.get("spark.sql.shuffle.partitions")
    h = start(events_to_comments(events_stream(spark, SF_SMALL)), "q2", "30d", path=scratch("o"),
              checkpoint=scratch("c"), state_partitions=3)
    h.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    ops = [op for p in h.recentProgress for op in p["stateOperators"]]
    assert ops and all(op.get("numShufflePartitions", 3) == 3 for op in ops)
