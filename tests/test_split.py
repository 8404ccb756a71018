"""Even split (O5/O6): the rule, its error shapes, and the distributed form."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.split import check_split, even_split, split_list


def sequential_split(items, k, equal):
    """Plain restatement of the sequential splitter: chunks of q, then the tail spread or appended."""
    n = len(items)
    q, r = divmod(n, k)
    if q == 0:
        if n == 0:
            return []
        raise ValueError("chunk size 0")
    chunks = [items[i * q:(i + 1) * q] for i in range(k)]
    tail = items[q * k:]
    if r and r >= q:
        raise ValueError("remainder >= chunk")
    for j, item in enumerate(tail):
        chunks[j if equal else k - 1].append(item)
    return chunks


def test_fixture_cases():
    items = list(range(20))
    assert split_list(items, 20) == [[i] for i in range(20)]
    assert split_list(items, 6, equal=True) == [
        [0, 1, 2, 18], [3, 4, 5, 19], [6, 7, 8], [9, 10, 11], [12, 13, 14], [15, 16, 17]
    ]
    assert split_list(items, 6, equal=False) == [
        [0, 1, 2], [3, 4, 5], [6, 7, 8], [9, 10, 11], [12, 13, 14], [15, 16, 17, 18, 19]
    ]
    with pytest.raises(ValueError):
        split_list(items, 7)
    with pytest.raises(ValueError):
        split_list([0, 1, 2], 5)
    assert split_list([], 5) == []


@pytest.mark.parametrize("equal", [True, False])
def test_rule_matches_sequential_splitter(equal):
    for n in range(60):
        for k in range(1, 30):
            items = list(range(n))
            try:
                want = sequential_split(items, k, equal)
            except ValueError:
                with pytest.raises(ValueError):
                    split_list(items, k, equal)
                continue
            assert split_list(items, k, equal) == want, (n, k, equal)


def test_non_strict_defined_everywhere():
    assert check_split(3, 5, strict=False) == (0, 3)
    assert split_list([0, 1, 2], 5, equal=True, strict=False) == [[0], [1], [2]]
    assert split_list([0, 1, 2], 5, equal=False, strict=False) == [[0, 1, 2]]


@pytest.mark.parametrize("n,k,equal", [(1000, 7, True), (1000, 7, False), (20, 6, True), (997, 31, True)])
def test_distributed_split_equals_rule(spark, n, k, equal):
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("x"))  # shuffled order
    got = {r["x"]: r["split_id"] for r in even_split(df.repartition(5), k, ["x"], equal).collect()}
    want = {}
    for g, chunk in enumerate(split_list(list(range(n)), k, equal)):
        for x in chunk:
            want[x] = g
    assert got == want


def test_distributed_split_raises(spark):
    with pytest.raises(ValueError):
        even_split(spark.range(20).withColumnRenamed("id", "x"), 7, ["x"])
