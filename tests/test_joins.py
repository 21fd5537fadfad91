from tidewater.operators.joins import join_dimension


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_follows_the_byte_threshold(spark):
    fact = spark.range(1000).withColumnRenamed("id", "k")
    dim = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(join_dimension(fact, dim, "k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(join_dimension(fact, dim, "k"))
        assert join_dimension(fact, dim, "k").count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
