import pytest

from tapewright import session


class Conf(dict):
    pass


class FakeSpark:
    """The two settings ``scratch_root`` reads."""

    def __init__(self, master, folder=None):
        self.conf = Conf({"spark.checkpoint.dir": folder} if folder else {})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"{master}-app"})()


def test_the_named_shared_folder_is_used():
    spark = FakeSpark("yarn", "hdfs://shared/checkpoints/")
    assert session.scratch_root(spark) == "hdfs://shared/checkpoints"
    a, b = (session.scratch_path(spark, "x") for _ in range(2))
    assert a != b and a.startswith("hdfs://shared/checkpoints/x-")


def test_only_a_local_session_may_fall_back():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(FakeSpark("yarn"))
    local = FakeSpark("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)
    assert session.scratch_root(local).startswith("/tmp/run-")


def test_stream_sessions_fix_their_own_partition_count(spark):
    assert session.stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.stream_session(spark).conf.get("spark.sql.session.timeZone") == "UTC"


def test_materialized_tables_read_back_alike(spark):
    df = spark.range(10).selectExpr("id", "id % 2 = 0 AS even")
    stored = session.materialize(df, "numbers")
    assert stored.dtypes == df.dtypes and sorted(stored.collect()) == sorted(df.collect())
    assert "Parquet" in stored._jdf.queryExecution().executedPlan().toString()
