"""Strict decode: one case per row of the decode table (fixture L2)."""

import pytest
from pyspark.sql import functions as F

from ledgerline.schema import LOG_SCHEMA
from ledgerline.functions.codec import decode_posts

# (case, value, expected status, expected id)
CASES = [
    ("null", None, "skip", None),
    ("valid", '{"id":"a","author":"b","description":"c","text":"d","createdAt":"e","updatedAt":"f"}', "ok", "a"),
    ("missing fields", '{"id":"a"}', "ok", "a"),
    ("empty object", "{}", "ok", None),
    ("explicit null field", '{"id":null}', "ok", None),
    ("unknown field", '{"id":"a","extra":1}', "unknown_field", None),
    ("key in other case", '{"ID":"a"}', "unknown_field", None),
    ("number in string field", '{"id":12}', "ok", "12"),
    ("boolean in string field", '{"id":true}', "ok", "true"),
    ("object in string field", '{"id":"a","text":{"x":1}}', "nested_value", None),
    ("array in string field", '{"id":"a","text":[1,2]}', "nested_value", None),
    ("duplicate field", '{"id":"a","id":"b"}', "ok", "b"),
    ("single quotes", "{'id':'a'}", "malformed", None),
    ("not a number", '{"id":NaN}', "malformed", None),
    ("infinity", '{"id":Infinity}', "malformed", None),
    ("malformed", "{bad", "malformed", None),
    ("literal null", "null", "malformed", None),
    ("empty text", "", "empty", None),
    ("blank text", "   ", "empty", None),
    ("empty array", "[]", "malformed", None),
    ("array of object", '[{"id":"x"}]', "malformed", None),
    ("trailing text", '{"id":"a"} tail', "ok", "a"),
    ("text that looks nested", '{"id":"a","text":"{\\"k\\": 1}"}', "ok", "a"),
    ("truncated object", '{"id":"a",', "malformed", None),
    ("scalar", "42", "malformed", None),
    ("non-ascii and quotes", '{"id":"é中","text":"say \\"hi\\""}', "ok", "é中"),
]


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(c, v, i) for i, (c, v, _, _) in enumerate(CASES)]
    log = spark.createDataFrame(rows, "case string, value string, offset long").withColumns(
        {"key": F.lit("k"), "topic": F.lit("t"), "partition": F.lit(0)}
    )
    out = decode_posts(log).select("case", "decode_status", F.col("post.id").alias("id")).collect()
    return {r["case"]: r for r in out}


@pytest.mark.parametrize("case,value,status,pid", CASES, ids=[c[0] for c in CASES])
def test_decode_case(decoded, case, value, status, pid):
    row = decoded[case]
    assert row["decode_status"] == status
    if status == "ok":
        assert row["id"] == pid
    else:
        assert row["id"] is None


def test_fail_stop_raises(spark):
    log = spark.createDataFrame([("k", "{bad", "t", 0, 5)], "key string, value string, topic string, partition int, offset long")
    with pytest.raises(Exception, match="bad record at t/0@5"):
        decode_posts(log, on_error="fail").collect()


def test_fail_stop_passes_good_rows(spark):
    log = spark.createDataFrame(
        [("k", '{"id":"a"}', "t", 0, 1), ("k", None, "t", 0, 2)],
        "key string, value string, topic string, partition int, offset long",
    )
    rows = decode_posts(log, on_error="fail").select("decode_status").collect()
    assert sorted(r[0] for r in rows) == ["ok", "skip"]


def test_encode_decode_roundtrip(spark):
    from ledgerline.functions.codec import encode_post

    texts = ["plain", 'quote " and \\ backslash', "line\nbreak\ttab", "ünicode ☃", None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    enc = df.select(
        F.col("id").alias("key"), encode_post({"id": F.col("id"), "text": F.col("text")}).alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
    )
    back = decode_posts(enc).select("decode_status", "post.id", "post.text", "post.author").collect()
    assert all(r["decode_status"] == "ok" for r in back)
    assert sorted((r["id"], r["text"]) for r in back) == sorted((str(i), t) for i, t in enumerate(texts))
    assert all(r["author"] is None for r in back)
    # nulls are written, not dropped
    assert '"author":null' in enc.first()["value"]


def test_numbers_keep_their_text(spark):
    """A number in a string field is its text, digit for digit, as a strict mapper hands it on."""
    texts = ["1234567890123456789012345678901234567890.12", "123456789012345678901234567890123456789012", "1e3", "-0.10", "1E-7", "true", "0", "100000000000000000000.5e10"]
    tricky = '{"id" : 1.50 , "text":":12.5, \\\\\\"9.0: 1e5", "author":-2e3}'
    rows = [(f'{{"id": {t}, "text": "[x] {{y}}"}}',) for t in texts] + [('{"id": "[1]", "author": "{}"}',), ('{"id": [1]}',), ('{"id": "1", "text": {"a": 1}}',)]
    log = spark.createDataFrame([(str(k), v, "t", 0, k, None) for k, (v,) in enumerate([*rows, (tricky,)])], LOG_SCHEMA)
    *got, last = decode_posts(log).orderBy("offset").select("decode_status", "post.id", "post.text", "post.author").collect()
    assert tuple(last) == ("ok", "1.50", ':12.5, \\"9.0: 1e5', "-2e3")
    assert [(r[0], r[1], r[2]) for r in got[: len(texts)]] == [("ok", t, "[x] {y}") for t in texts]
    assert [r[0] for r in got[len(texts) :]] == ["ok", "nested_value", "nested_value"]


def test_status_is_computed_once_and_fields_only_where_they_are_read(spark):
    from ledgerline.operators.sink import first_success_per_key

    log = spark.createDataFrame([("k", '{"id":"k"}', "t", 0, 0)], "key string, value string, topic string, partition int, offset long")
    plan = first_success_per_key(decode_posts(log))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # the exact texts of the fields
    assert plan.lower().count("jsonobjectkeys") + plan.count("json_object_keys") == 1
    whole = decode_posts(log)._jdf.queryExecution().optimizedPlan().toString()
    assert whole.lower().count("jsonobjectkeys") + whole.count("json_object_keys") == 1


def test_texts_that_look_like_objects_beside_objects(spark):
    cases = {
        '{"id":"1","text":"{\\"k\\": 7}"}': "ok", '{"id":"2","text":"{\\"k\\": {\\"l\\": [1]}}"}': "ok", '{"id":"3","text":"[x: [y"}': "ok",
        '{"id":"4","text" :\n {"k":1}}': "nested_value", '{"id":"5","text":\t[1]}': "nested_value", '{"id":"6","text":"{\\"k\\": {}}","author":[]}': "nested_value",
        '{"id":"7","text":"{","author": {}}': "nested_value",
    }
    log = spark.createDataFrame([(str(i), v, "t", 0, i) for i, v in enumerate(cases)], "key string, value string, topic string, partition int, offset long")
    got = {r["value"]: (r["decode_status"], r["post"]) for r in decode_posts(log).collect()}
    assert {v: s for v, (s, _) in got.items()} == cases
    assert all((post is not None) == (s == "ok") for s, post in got.values())
