from __future__ import annotations

import contextlib
import io

U = "2024-02-01T00:00:00.000"
EDGE_COLUMNS = "id date primary_type arrest domestic district latitude longitude updated_on".split()
_T = "2024-01-01T12:00:00.000"
_D = "2024-01-02T10:00:00.000"
EDGE_ROWS = [
    ("1", "2024-01-01T10:00:00.000", "THEFT", "true", "false", "001", "41.88", "-87.63", U),
    ("2", "2024-01-01T11:30:00.000", "BATTERY", "false", "true", "012", "41.80", "-87.60", U),
    ("2", "2024-01-01T11:30:00.000", "BATTERY", "true", "true", "012", "41.80", "-87.60", "2024-03-01T00:00:00.000"),
    ("2", "2024-01-01T11:30:00.000", "BATTERY", "false", "false", "012", "41.80", "-87.60", "2024-01-15T00:00:00.000"),
    (None, _T, "THEFT", "false", "false", "003", "41.9", "-87.7", U),
    ("   ", _T, "THEFT", "false", "false", "003", "41.9", "-87.7", U),
    ("abc", _T, "THEFT", "false", "false", "003", "41.9", "-87.7", U),
    ("12.0", _T, "THEFT", "false", "false", "003", "41.9", "-87.7", U),
    ("\t", _T, "THEFT", "false", "false", "003", "41.9", "-87.7", U),
    (" 8 ", "2024-01-02 09:00:00", "THEFT", "Y", "0", "x", "41.9", "-87.7", U),
    ("9", None, "NARCOTICS", "false", "false", "004", "", "", U),
    ("10", "not a date", "ARSON", "false", "false", "004", None, None, U),
    ("11", "2999-01-01T00:00:00.000", "THEFT", "false", "false", "004", "41.9", "-87.7", U),
    ("12", _D, None, "false", "false", "004", "41.9", "-87.7", U),
    ("13", _D, "theft", "true", "false", "004", "40.9", "-87.7", U),
    ("14", _D, "  ", "false", "false", "004", "NaN", "-88.0", U),
    ("15", _D, "THEFT", "maybe", None, "004", "41.0", "east", U),
]


def text_frame(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in columns))


def edge_rows(spark, rows=EDGE_ROWS):
    """The edge rows as raw rows with all landing columns."""
    from pyspark.sql import functions as F

    from casebook.plans.incidents import LANDING_COLUMNS

    df = text_frame(spark, EDGE_COLUMNS, rows)
    fixed = {"year": "2024", "ward": "7", "community_area": "32"}
    given = [F.col(c) if c in df.columns else F.lit("v").alias(c) for c in LANDING_COLUMNS if c not in fixed]
    return df.select(*given, *[F.lit(value).alias(name) for name, value in fixed.items()])


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def final_plan_of(df) -> str:
    """The plan after it has run, with the decisions taken at run time."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df)
