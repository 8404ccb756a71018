"""Ranges with fixed bounds: positions of wide rows, and sequential functions run in parts."""

import zlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.ordering import OrderedFold, fix_ranges, fold_in_order, ranged_positions
from ledgerline.plans.inspect import plan_text


def skewed(spark, n=20_000):
    """Partition 0 holds 40% of all rows, with null keys and groups among the rest."""
    i = F.col("id")
    part = F.when(i % 5 < 2, F.lit(0)).when(i % 97 == 0, F.lit(None)).otherwise(i % 7 + 1).cast("int")
    return spark.range(n).select(part.alias("partition"), ((i * 104_729) % 1_000_003).alias("offset"), F.concat(F.lit("k"), i.cast("string")).alias("key"), F.lit("t").alias("topic"))


@pytest.mark.parametrize("parts", [1, 2, 9])
def test_positions_equal_row_number(spark, parts):
    df = skewed(spark)
    got = ranged_positions(df, ["topic", "partition"], ["offset"], "pos", num_partitions=parts)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("topic", "partition").orderBy("offset")) - 1)
    assert got.rows.exceptAll(want).count() == 0 and got.rows.count() == want.count()
    sizes = {r["partition"]: r["group_size"] for r in got.group_sizes.collect()}
    assert sizes[0] == 8_000 and sum(sizes.values()) == 20_000
    whole = ranged_positions(df, [], ["topic", "partition", "offset"], "pos", num_partitions=parts).rows
    assert sorted(r[0] for r in whole.select("pos").collect()) == list(range(20_000))


def test_keys_of_many_types_and_empty_input(spark):
    df = spark.sql("select cast(id % 3 as string) g, date_add(date'2024-01-01', cast(id as int)) d, timestamp_ntz'2024-01-01 00:00:00' t, cast(id as decimal(20,3)) x, if(id % 2 = 0, null, 'ü') s from range(300)")
    got = ranged_positions(df, ["g"], ["s", "d", "t", "x"], "p", num_partitions=5).rows
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("s", "d", "t", "x")) - 1)
    assert got.exceptAll(want).count() == 0 and got.count() == 300
    assert ranged_positions(df.limit(0), ["g"], ["d"], "p").rows.count() == 0


def test_the_payload_crosses_one_exchange_and_is_not_stored(spark):
    plan = plan_text(ranged_positions(skewed(spark), ["topic", "partition"], ["offset"], "p", num_partitions=4).rows)
    assert plan.count("Exchange (") <= 3 and "Scan ExistingRDD" not in plan  # the rows' exchange, and the counts' broadcast
    assert len(fix_ranges(skewed(spark), ["topic", "partition"], ["offset"], 6).bounds) == 6


P = 1_000_000_007


def chain():
    prime = P

    class Chain(OrderedFold):  # a class of the test's own goes to the workers by value
        """Not a sum: the order of the records matters."""

        start = 7
        schema = "topic string, partition int, offset long, c long, task int"

        def summary(self, rows):
            a, b = 1, 0
            for k in rows["key"]:
                a, b = a * 31 % prime, (b * 31 + zlib.crc32(k.encode())) % prime
            return [a, b]

        def combine(self, left, right):
            return [left[0] * right[0] % prime, (left[1] * right[0] + right[1]) % prime]

        def enter(self, state, summary):
            return (state * summary[0] + summary[1]) % prime

        def run(self, state, rows):
            from pyspark import TaskContext

            out = []
            for k in rows["key"]:
                state = (state * 31 + zlib.crc32(k.encode())) % prime
                out.append(state)
            return rows[["topic", "partition", "offset"]].assign(c=out, task=TaskContext.get().partitionId()), state

    return Chain()


def test_a_sequential_function_over_a_hot_partition(spark):
    df = skewed(spark, 6_000).where("partition is not null")
    rows = fold_in_order(df, chain(), num_partitions=8).collect()
    plain = {}
    for r in sorted(df.collect(), key=lambda r: (r["partition"], r["offset"])):
        last = plain.get(r["partition"], [None, 7])[1]
        plain.setdefault(r["partition"], [{}, None])
        plain[r["partition"]][1] = (last * 31 + zlib.crc32(r["key"].encode())) % P
        plain[r["partition"]][0][r["offset"]] = plain[r["partition"]][1]
    assert len(rows) == df.count()
    assert all(plain[r["partition"]][0][r["offset"]] == r["c"] for r in rows)
    assert len({r["task"] for r in rows if r["partition"] == 0}) >= 3  # the hot one ran in many tasks
