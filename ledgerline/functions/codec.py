"""Post codec: strict JSON decode (F1) with the guards of a strict object mapper, and encode.

All checks are Spark expressions (no Python UDF). Decode status values:
``skip`` (tombstone, value NULL), ``ok``, or a bad reason: ``empty``, ``malformed``, ``unknown_field``,
``nested_value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import POST_FIELDS

CORRUPT = "_corrupt"
# One parse gives every field's text as it stands in the record (numbers and booleans coerced as a strict mapper does,
# digit for digit) and the corrupt text.
_PARSE_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in [*POST_FIELDS, CORRUPT]])
# Kinds of values, asked only where a field's text could be an object or array.
_KIND_SCHEMA = T.StructType([T.StructField(f, T.VariantType(), True) for f in POST_FIELDS])
# a strict mapper takes double quotes only, and no NaN or Infinity
_PARSE_OPTIONS = {
    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
}

OK, SKIP = "ok", "skip"
BAD_REASONS = ("empty", "malformed", "unknown_field", "nested_value")

# ISO-8601 text of an instant as printed by Instant.toString() with microsecond precision.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_post(value: Column) -> Column:
    """Lenient parse: the texts of the six fields plus the corrupt-record text."""
    return F.from_json(value, _PARSE_SCHEMA, _PARSE_OPTIONS)


def decode_status(value: Column, parsed: Column) -> Column:
    """Status of one record under strict object mapping; cheap checks first (CASE is lazy)."""
    known = F.array(*[F.lit(f) for f in POST_FIELDS])
    unknown = F.coalesce(F.size(F.array_except(F.json_object_keys(value), known)) > 0, F.lit(False))
    kinds = F.from_json(value, _KIND_SCHEMA, {k: v for k, v in _PARSE_OPTIONS.items() if k != "columnNameOfCorruptRecord"})
    looks, nested = None, None
    for f in POST_FIELDS:
        look = F.coalesce(parsed[f].startswith("{") | parsed[f].startswith("["), F.lit(False))
        kind = look & F.coalesce(F.schema_of_variant(kinds[f]).rlike("^(OBJECT|ARRAY)"), F.lit(False))
        looks, nested = (look, kind) if looks is None else (looks | look, nested | kind)
    # objects and arrays are errors for a string field; a text may begin like one, but only they follow a colon
    nested = F.when(looks & value.rlike(r":\s*[\[{]"), nested).otherwise(F.lit(False))
    return (
        F.when(value.isNull(), F.lit(SKIP))
        .when(value.rlike(r"^\s*$"), F.lit("empty"))
        .when(parsed.isNull() | parsed[CORRUPT].isNotNull(), F.lit("malformed"))
        .when(unknown, F.lit("unknown_field"))
        .when(nested, F.lit("nested_value"))
        .otherwise(F.lit(OK))
    )


def _digits_as_text(value: Column) -> Column:
    """A JSON object with its fractional numbers as strings: pieces outside string literals, numbers there quoted."""
    pieces = F.regexp_extract_all(value, F.lit(r'"(?:[^"\\]|\\.)*+"|[^"]+'), F.lit(0))
    quoted = F.transform(pieces, lambda p: F.when(p.startswith('"'), p).otherwise(F.regexp_replace(p, r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)", '"$1"')))
    return F.array_join(quoted, "")


def _exact_texts(value: Column, parsed: Column) -> Column:
    """The parsed fields, fractional numbers digit for digit (the parser reads those as doubles)."""
    # a number after a field's name; times inside texts have no quote before their colons
    return F.when(value.rlike(r'"\s*:\s*-?[0-9]+[.eE]'), F.from_json(_digits_as_text(value), _PARSE_SCHEMA, _PARSE_OPTIONS)).otherwise(parsed)


def decode_posts(log: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """add ``post`` (struct of the six fields) and ``decode_status`` to every log row.

    ``on_error="fail"`` raises on the first bad record (fail-stop, T8); ``"quarantine"`` keeps bad rows
    with their reason so that :func:`split_bad` can route them. The parse is a column of its own, so
    the status and the fields read one parse per row; the status is computed once, and ``post`` where it is read.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    parsed_col = "_ll_parsed"
    texts_col = "_ll_texts"
    staged = log.withColumn(parsed_col, parse_post(F.col("value")))
    parsed, texts = F.col(parsed_col), F.col(texts_col)
    status = decode_status(F.col("value"), parsed)
    if on_error == "fail":
        message = F.concat(
            F.lit("bad record at "), F.coalesce(F.col("topic"), F.lit("?")), F.lit("/"),
            F.col("partition").cast("string"), F.lit("@"), F.col("offset").cast("string"), F.lit(": "), status,
        )
        status = F.when(status.isin(OK, SKIP), status).otherwise(F.raise_error(message).cast("string"))
    # the status leaves through a one-row generator: a later filter on it then stays above the generator instead of
    # being pushed below the parse with the parse expression copied into the predicate
    judged = staged.select(*log.columns, parsed_col, F.inline(F.array(F.struct(status.alias("decode_status")))))
    judged = judged.withColumn(texts_col, _exact_texts(F.col("value"), parsed))
    post = F.when(F.col("decode_status") == OK, F.struct(*[texts[f].alias(f) for f in POST_FIELDS]))
    return judged.select(*log.columns, post.alias("post"), "decode_status")


def iso_text(ts: Column) -> Column:
    """timestamp as ISO-8601 UTC text, e.g. 2024-01-01T00:00:07.179575Z."""
    return F.date_format(ts, ISO_PATTERN)


def encode_post(fields: dict[str, Column]) -> Column:
    """JSON text of a post, all six fields in declaration order, nulls written as null."""
    cols = [(fields[f] if f in fields else F.lit(None)).cast("string").alias(f) for f in POST_FIELDS]
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def key_partition(key: Column, n: int) -> Column:
    """Engine-neutral key partitioner: first 32 bits of md5(key), modulo ``n``."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")
