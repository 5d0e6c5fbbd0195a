from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook import functions as fn
from casebook.functions.typing import ISO_MILLIS, SPACED_SECONDS
from tests.helpers import text_frame


def values(spark, rows, column):
    return [r[0] for r in text_frame(spark, ["x"], [(v,) for v in rows]).select(column).collect()]


def test_safe_cast_to_bigint(spark):
    texts = [" 12 ", "+5", "-3", "12.0", "1e3", "12L", "0x10", "9223372036854775808", "", None]
    assert values(spark, texts, fn.safe_cast("x", "bigint")) == [12, 5, -3, None, None, None, None, None, None, None]


def test_safe_cast_to_double(spark):
    found = values(spark, ["41.5", "Infinity", "1e400", "east", ""], fn.safe_cast("x", "double"))
    assert found == [41.5, float("inf"), float("inf"), None, None]


def test_leading_zeros_are_lost_by_int(spark):
    assert values(spark, ["001", "012"], fn.safe_cast("x", "int")) == [1, 12]


def test_blank_strips_spaces_only(spark):
    assert values(spark, [None, "", "   ", "\t", " a "], fn.blank("x")) == [True, True, True, False, False]
    assert values(spark, [None, "\t", "a"], fn.present("x")) == [False, True, True]


def test_flag_never_null(spark):
    texts = ["true", "T", " yes ", "1", "Y", "false", "0", "maybe", "", None]
    assert values(spark, texts, fn.flag("x")) == [True] * 5 + [False] * 5


@pytest.mark.parametrize(
    ("text", "is_outside"),
    [
        ("41.0", False),
        ("42.1", False),
        ("41.88", False),
        ("40.9", True),
        ("42.11", True),
        ("NaN", True),
        ("east", True),
        ("", False),
        ("  ", False),
        (None, False),
    ],
)
def test_outside_closed_range(spark, text, is_outside):
    assert values(spark, [text], fn.outside("x", 41.0, 42.1)) == [is_outside]


def test_uncastable_needs_content(spark):
    assert values(spark, [None, "  ", "abc", "7"], fn.uncastable("x", "bigint")) == [False, False, True, False]


def test_one_pattern_parse(spark):
    texts = ["2024-01-02T03:04:05.678", "2024-01-02 03:04:05", "2024-01-02T03:04:05", "junk", None]
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    found = values(spark, texts, fn.parse_timestamp("x").cast("timestamp_ntz"))
    assert found == [moment, None, None, None, None]


def test_any_parse_takes_the_three_forms(spark):
    texts = ["2024-01-02T03:04:05.678", "2024-01-02 03:04:05", "2024-01-02", "2024", "junk", "", None]
    found = values(spark, texts, fn.parse_timestamp_any("x").cast("timestamp_ntz"))
    assert found == [
        dt.datetime(2024, 1, 2, 3, 4, 5, 678000),
        dt.datetime(2024, 1, 2, 3, 4, 5),
        dt.datetime(2024, 1, 2),
        dt.datetime(2024, 1, 1),
        None,
        None,
        None,
    ]
    strict = values(spark, texts, fn.parse_timestamp_any("x", free_form=False).cast("timestamp_ntz"))
    assert strict == [found[0], found[1], None, None, None, None, None]


time_text = st.builds(
    lambda y, mo, d, sep, h, mi, s, tail: f"{y:04d}-{mo:02d}-{d:02d}{sep}{h:02d}:{mi:02d}:{s:02d}{tail}",
    st.one_of(st.integers(0, 9999), st.integers(1900, 2100)),
    st.integers(0, 13),
    st.integers(0, 32),
    st.sampled_from(["T", " ", "", "t"]),
    st.integers(0, 25),
    st.integers(0, 61),
    st.integers(0, 61),
    st.sampled_from(["", ".000", ".678", ".1", ".123456", "Z", "z", "+02:00", " "]),
)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(time_text, min_size=50, max_size=200))
def test_parse_order_does_not_matter(spark, texts):
    """The documented order is the two patterns, then free form; the fast order must agree."""
    documented = F.coalesce(
        F.try_to_timestamp("x", F.lit(ISO_MILLIS)), F.try_to_timestamp("x", F.lit(SPACED_SECONDS)), F.try_to_timestamp("x")
    )
    df = spark.createDataFrame(pa.table({"x": pa.array(texts, pa.string())}))
    assert df.filter(~documented.eqNullSafe(fn.parse_timestamp_any("x"))).count() == 0


def test_path_token(spark):
    text = "manual run:2024/01/01+00=a.b-c_d"
    assert values(spark, [text], fn.path_token("x")) == [fn.path_token_text(text)] == ["manual_run_2024_01_01_00=a.b-c_d"]


def test_column_or_null(spark):
    df = text_frame(spark, ["a"], [("1",)])
    row = df.select(*[fn.column_or_null(df, c).alias(n) for n, c in (("x", "a"), ("y", "b"), ("z", "A"))]).first()
    assert (row.x, row.y, row.z) == ("1", None, None)


def test_daypart_buckets(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("h"))
    found = dict(hours.select("h", fn.daypart(F.col("h"))).collect())
    assert [found[h] for h in (0, 5, 6, 11, 12, 17, 18, 23)] == [
        "night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening",
    ]


def key_of(spark, *fields):
    return spark.range(1).select(fn.surrogate_key(*[F.lit(f).cast("string") for f in fields])).first()[0]


def test_surrogate_keys_tell_tuples_apart(spark):
    tuples = [("a", None, "b"), ("a", "b", None), ("a", "b"), ("a|b",), ("a", "", "b"), ("1:a",), ("-",), (None,)]
    keys = [key_of(spark, *t) for t in tuples]
    assert len(set(keys)) == len(tuples)
    assert keys[0] == key_of(spark, "a", None, "b")
    assert all(len(k) == 64 for k in keys)


field = st.one_of(st.none(), st.text(alphabet="a1:-\x1f", max_size=4))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(field, field, field), min_size=40, max_size=120, unique=True))
def test_surrogate_keys_are_injective(spark, tuples):
    columns = {name: pa.array([t[i] for t in tuples], pa.string()) for i, name in enumerate("abc")}
    df = spark.createDataFrame(pa.table(columns))
    assert df.select(fn.surrogate_key("a", "b", "c")).distinct().count() == len(tuples)
