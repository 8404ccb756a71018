"""Strict decode against a plain-Python model of a strict object mapper, on generated objects."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.codec import decode_posts
from ledgerline.schema import POST_FIELDS

TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)
SCALAR = st.one_of(TEXT, st.integers(-10**9, 10**9), st.booleans(), st.none())
NESTED = st.one_of(st.lists(st.integers(0, 9), max_size=3), st.dictionaries(TEXT, st.integers(0, 9), max_size=2))
KEY = st.one_of(st.sampled_from(POST_FIELDS), st.sampled_from(["ID", "extra", "Text"]))
OBJ = st.dictionaries(KEY, st.one_of(SCALAR, SCALAR, NESTED), max_size=6)


def model(obj):
    """(status, id) a strict mapper would give: unknown key or nested value is an error."""
    if any(k not in POST_FIELDS for k in obj):
        return "unknown_field", None
    if any(isinstance(v, (dict, list)) for v in obj.values()):
        return "nested_value", None
    v = obj.get("id")
    if isinstance(v, bool):
        v = "true" if v else "false"
    elif v is not None:
        v = str(v)
    return "ok", v


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(OBJ, min_size=40, max_size=40))
def test_decode_matches_strict_mapper(spark, objs):
    rows = [(i, json.dumps(o, ensure_ascii=bool(i % 2))) for i, o in enumerate(objs)]
    log = spark.createDataFrame(rows, "offset long, value string").withColumns(
        {"key": F.lit("k"), "topic": F.lit("t"), "partition": F.lit(0)}
    )
    got = {r["offset"]: (r["decode_status"], r["id"]) for r in
           decode_posts(log).select("offset", "decode_status", F.col("post.id").alias("id")).collect()}
    for i, o in enumerate(objs):
        assert got[i] == model(o), (o, got[i])
