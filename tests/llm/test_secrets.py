"""Places and overlaps in texts of many spans, and ownership by repositories and owners."""

from itertools import accumulate

from pyspark.sql import functions as F

from ledgerline.llm import secrets


def test_running_sums_and_bounds_over_blocks(spark):
    rows = [[], [3], *[[(7 * i * i) % 101 for i in range(n)] for n in (127, 128, 129, 1000)]]
    table = spark.createDataFrame([(x,) for x in rows], "v array<int>")
    for op, plain in ((lambda a, b: a + b, lambda a, b: a + b), (F.greatest, max), (F.least, min)):
        got = [r[0] for r in table.select(secrets._running(F.col("v"), op)).collect()]
        assert got == [list(accumulate(x, plain)) for x in rows]


def test_spans_of_a_text_with_tens_of_thousands(documents):
    parts = [f"token=abc{i:07d} Zk3x9QpLm2Rt7VbN4c{i:05d}" for i in range(20_000)]
    (got,) = secrets.digest_columns(secrets.scan_secrets(documents([(1, " ".join(parts), "en", "s")]))).collect()
    want, at = [], 0
    for p in parts:
        cut = p.index(" ")
        want += [f"assign:{at}:{at + cut}", f"token:{at + cut + 1}:{at + len(p)}"]
        at += len(p) + 1
    assert got["spans"].split(",") == want and got["n_assign"] == 20_000


def test_candidates_that_overlap_base_spans_are_left_out(documents):
    long = "Zk3x9QpLm2Rt7VbN4cXy8"
    texts = [f"token={long}", f"{long} token={long} {long}", f"AKIA{'A1' * 9}/{long}", f"{long}/{'0123456789abcdef' * 2}", f"x {long}"]
    got = {r["id"]: r["spans"] for r in secrets.digest_columns(secrets.scan_secrets(documents([(i, t, "en", "s") for i, t in enumerate(texts)]))).collect()}
    assert got == {0: "assign:0:27", 1: "token:0:21,assign:22:49,token:50:71", 2: "access:0:22", 3: "hex:22:54", 4: "token:2:23"}


def test_ownership_counts_repositories_and_owners(documents):
    own, leaked, shared, copied = (f"{x}k3x9QpLm2Rt7VbN4cXy8" for x in "ABCD")
    rows = [(i, f"{own} page {i}", "en", "a") for i in range(12)]
    rows += [(100 + i, f"{leaked} page {i}", "en", "a") for i in range(12)] + [(150, f"{leaked} quoted", "en", "b")]
    rows += [(200 + i, f"{shared} page {i}", "en", f"o{i % 3}") for i in range(12)]
    # one owner's copies of one text are one repository: half and half
    rows += [(300 + i, f"{copied} the same", "en", "a") for i in range(12)] + [(350, f"{copied} another", "en", "b")]
    got = {r["id"]: (r["spans"], r["n_live"], r["n_example"]) for r in secrets.digest_columns(secrets.scan_secrets(documents(rows))).collect()}
    assert len(got) == len(rows)
    assert all(v == (("token:0:21", 1, 0) if k < 200 else ("", 0, 1)) for k, v in got.items())
