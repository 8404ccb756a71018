"""dense_positions equals row_number on skewed data, without a single-task window over the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.ordering import dense_positions
from ledgerline.plans.inspect import plan_text


def test_positions_equal_row_number_under_skew(spark):
    # group 0 holds ~1/2 of the rows, others small; order is unique per group
    df = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 13).alias("g"),
        ((F.col("id") * 104729) % 1000003).alias("o"),
    )
    got = dense_positions(df, ["g"], ["o"], "pos", num_partitions=8)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert got.rows.exceptAll(want).count() == 0
    assert want.exceptAll(got.rows).count() == 0
    sizes = {r["g"]: r["group_size"] for r in got.group_sizes.collect()}
    assert sizes[0] == df.where("g = 0").count() > 10000


def test_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 1)], "g int, o int")
    rows = {tuple(r) for r in dense_positions(df, ["g"], ["o"], "p").rows.collect()}
    assert rows == {(None, 1, 0), (None, 2, 1), (1, 1, 0), (1, 3, 1)}


def test_plan_has_no_single_partition_exchange_on_rows(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    plan = plan_text(dense_positions(df, ["g"], ["o"], "p").rows)
    assert "SinglePartition" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_positions_with_the_shuffle_join_fallback(spark, monkeypatch):
    import ledgerline.operators.joins as joins
    import ledgerline.operators.ordering as ordering

    def no_broadcast(*args, **kwargs):
        return joins.join_bounded(*args, **{**kwargs, "max_rows": 0})

    monkeypatch.setattr(ordering, "join_bounded", no_broadcast)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # Spark may not broadcast by itself either
    try:
        df = spark.range(3000).select((F.col("id") % 4).alias("g"), ((F.col("id") * 7) % 3001).alias("o"))
        got = dense_positions(df, ["g"], ["o"], "p", num_partitions=5).rows
        assert "BroadcastHashJoin" not in plan_text(got)
        want = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
