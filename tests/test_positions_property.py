"""dense_positions equals row_number for generated group layouts (including one dominant group)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.ordering import dense_positions


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    sizes=st.lists(st.integers(0, 300), min_size=1, max_size=6),
    hot=st.integers(0, 3000),
    parts=st.integers(1, 9),
)
def test_dense_positions_matches_row_number(spark, sizes, hot, parts):
    rows = [(0, i * 7 % (hot + 1) + i * (hot + 1)) for i in range(hot)]  # dominant group 0
    for g, n in enumerate(sizes, start=1):
        rows += [(g, (j * 13) % 1009 + 1009 * j) for j in range(n)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "g int, o long").repartition(3)
    got = dense_positions(df, ["g"], ["o"], "p", num_partitions=parts).rows
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    assert got.count() == len(rows)
    assert got.exceptAll(want).count() == 0
