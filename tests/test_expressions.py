import datetime as dt

from pyspark.sql import functions as F

from tallyfold.functions import scalars as X
from tallyfold.operators import contract, rowsets


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(expr.alias("v")).first().v


def test_two_digit_years(spark):
    cases = {"28-Feb-97": dt.date(1997, 2, 28), "1-Jan-69": dt.date(1969, 1, 1), "31-Dec-68": dt.date(2068, 12, 31),
             "7-Jul-06": dt.date(2006, 7, 7), "29-Feb-72": dt.date(1972, 2, 29), "nonsense": None}
    for text, want in cases.items():
        assert one(spark, X.parse_dmy(F.col("t")), t=text) == want


def test_money_and_years(spark):
    assert one(spark, X.parse_money(F.col("t")), t="$1,234.50 ") == 1234.5
    assert one(spark, X.parse_money(F.col("t")), t="n/a") is None
    assert one(spark, X.parse_year(F.col("t"), {"1976A": 1976}), t="1976A") == 1976
    assert one(spark, X.parse_year(F.col("t")), t="x") is None


def test_flags(spark):
    assert one(spark, X.flag_pos(F.col("a")), a=-3) == -3
    assert one(spark, X.flag_pos(F.col("a")), a=8) == 1
    assert one(spark, X.has_franchise(F.col("a")), a=1) == 1
    assert one(spark, X.has_franchise(F.col("a"), True), a=1) == 0
    assert one(spark, X.flag_eq(F.col("a"), F.lit(None)), a=1) == 0
    assert one(spark, X.safe_ratio(F.col("a"), F.lit(0.0)), a=1.0) is None
    assert one(spark, X.recode(F.col("a"), {1: "x"}), a=2) is None


def test_caps_and_text(spark):
    assert one(spark, X.cap_std(F.col("m"), F.col("s")), m=2.0, s=2.0) == 1.98
    assert one(spark, X.cap_std(F.col("m"), F.col("s"), True), m=2.0, s=2.0) == 2.0
    assert one(spark, X.fmt_mean_std(F.col("m"), F.col("s"), 2), m=1.0, s=0.5) == "1.00 ± 0.50"
    assert one(spark, X.title_case(F.col("t"), {"District Of Columbia": "District of Columbia"}), t="DISTRICT OF COLUMBIA") == "District of Columbia"


def test_filters_keep_nulls(spark):
    df = spark.createDataFrame([(1, 2, "Y"), (2, 1, None), (None, 1, "Z")], "a int, b int, c string")
    assert rowsets.drop_if_greater(df, "a", "b").count() == 2
    assert rowsets.keep_in(df, "c", ["Y"], keep_null=True).count() == 2


def test_column_kinds(spark):
    df = spark.createDataFrame([(1, 2.0, "x", dt.date(2020, 1, 1))], "a int, b double, c string, d date")
    assert (X.numeric_cols(df), X.string_cols(df)) == (["a", "b"], ["c"])


def test_upsert_and_duplicates(spark):
    new = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 3, "x"), ("c", 4, "y")], "k string, o int, v string")
    old = spark.createDataFrame([("c",)], "k string")
    got = {(r.k, r.v) for r in rowsets.upsert_first_wins(old, new, ["k"], ["v"], F.col("o")).collect()}
    assert got == {("a", "early"), ("b", "x")}
    assert {r.o for r in rowsets.duplicate_rows(new, ["k"], "o").collect()} == {2}
    same = spark.createDataFrame([("a", 1, "x")] * 3 + [("a", 1, "y"), (None, 2, None), (None, 2, None)], "k string, o int, v string")
    got = sorted(map(tuple, rowsets.duplicate_rows(same, ["k", "o"], "o").collect()), key=str)
    assert got == [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), (None, 2, None)]


def test_texts_of_missing_spreads_and_numeric_columns(spark):
    assert one(spark, X.fmt_mean_std(F.col("m"), F.lit(None).cast("double")), m=1.0) is None
    df = spark.sql("SELECT 1 AS i, 2.5D AS d, INTERVAL '1' DAY AS v, 'x' AS s, CAST(1 AS DECIMAL(3,1)) AS e")
    assert X.numeric_cols(df) == ["i", "d", "e"]


def test_contract_lists_every_failure(spark):
    df = spark.createDataFrame([(1, "aa", 5.0), (1, None, -1.0)], "id long, name string, x double")
    fields = [contract.Field("id", "bigint", unique=True), contract.Field("name", "string", max_length=1),
              contract.Field("x", "double", ge=0), contract.Field("gone", "int")]
    got = {(r.column, r["check"]): r.n_failed for r in contract.validate(df, fields).collect()}
    assert got == {("id", "unique"): 1, ("name", "not_null"): 1, ("name", "str_length(1)"): 1, ("x", "ge(0)"): 1, ("gone", "missing"): 1}


def test_first_rows_are_met_where_they_were_picked(spark):
    """Three shuffles: the groups, the rows that look for their first row, and the few first rows that may have copies."""
    from tallyfold.operators import rowsets

    rows = [(1, None, 5, "a"), (1, None, 4, "b"), (1, None, 4, "b"), (2, 7, 1, None), (2, 7, 1, None), (2, 7, 1, None), (2, 7, 1, "z"), (3, 3, 3, "x"), (None, None, 0, "q")]
    df = spark.createDataFrame(rows, "k long, l long, o long, t string")
    found = rowsets.duplicate_rows(df, ["k", "l"], "o")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [(1, None, 4, "b"), (1, None, 5, "a"), (2, 7, 1, None), (2, 7, 1, None), (2, 7, 1, "z")]))
    wide = spark.range(40).selectExpr("id % 7 AS k", "id AS o", "repeat('x', 100) AS t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rowsets.duplicate_rows(wide, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) <= 6 and "isnull" not in "".join(moved)
