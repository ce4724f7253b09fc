"""Cleaning queries: dirty text made from clean columns, cleaned again, checked against the clean side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.registry import LINE_ID, Tables, query
from tallyfold.functions import scalars as X
from tallyfold.operators import contract, rowsets, stats
from tallyfold.operators.ordered import forward_fill
from tallyfold.plans import loan_cleaning as LC

_BASE = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey"""
# Raw text columns; {fmt(x)} and {usd(x)} stand for the engines' own date and money formats.
_RAW = {
    "LoanNr_ChkDgt": f"CAST({LINE_ID} AS STRING)",
    "Name": "CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'SEA INN' "
            "WHEN o_orderkey % 13 = 0 THEN 'Joe Pizza' ELSE c_name END",
    "City": "CASE WHEN l_partkey % 40 = 0 THEN NULL ELSE concat('CITY_', c_custkey % 100) END",
    "State": "CASE WHEN c_custkey % 7 = 0 AND l_linenumber IN (1, 2, 3) THEN NULL ELSE cn.n_name END",
    "Zip": "CAST(c_custkey % 400 AS STRING)",
    "Bank": "CASE WHEN l_suppkey % 29 = 0 THEN NULL ELSE concat('BANK_', l_suppkey) END",
    "BankState": "CASE WHEN l_suppkey % 31 = 0 OR (l_linenumber = 1 AND l_suppkey % 3 = 0) THEN NULL ELSE cn.n_name END",
    "NAICS": "CASE WHEN o_custkey % 9 = 0 THEN '0' ELSE CAST((11 + l_partkey % 82) * 10000 + l_partkey AS STRING) END",
    "ApprovalDate": "{fmt(o_orderdate)}",
    "ApprovalFY": "CASE WHEN o_orderkey % 97 = 0 THEN '1976A' ELSE CAST(year(o_orderdate) AS STRING) END",
    "Term": "CAST(CAST(l_quantity * 6 AS BIGINT) AS STRING)",
    "NoEmp": "CAST(l_partkey % 90 AS STRING)", "CreateJob": "CAST(l_partkey % 4 AS STRING)",
    "RetainedJob": "CAST(l_suppkey % 3 AS STRING)", "FranchiseCode": "CAST(o_custkey % 5 AS STRING)",
    "UrbanRural": "CAST(o_orderkey % 3 AS STRING)",
    "NewExist": "CASE l_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '0.0' WHEN 2 THEN '2.0' ELSE '1.0' END",
    "RevLineCr": "CASE l_suppkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'T' WHEN 2 THEN 'Y' ELSE 'N' END",
    "LowDoc": "CASE l_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'C' WHEN 2 THEN 'Y' ELSE 'N' END",
    "ChgOffDate": "CASE WHEN l_returnflag = 'R' THEN {fmt(l_shipdate)} END",
    "DisbursementDate": "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE {fmt(l_shipdate)} END",
    "DisbursementGross": "{usd(l_extendedprice)}", "BalanceGross": "'$0.00 '",
    "MIS_Status": "CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'CHGOFF' ELSE 'P I F' END",
    "ChgOffPrinGr": "CASE WHEN l_returnflag = 'R' THEN {usd(l_quantity)} ELSE '$0.00 ' END",
    "GrAppv": "CASE WHEN l_discount = 0 THEN {usd(l_extendedprice)} ELSE {usd(o_totalprice)} END",
    "SBA_Appv": "{usd(l_quantity)}",
}


def _spark_text(expr: str) -> str:
    for col in ("o_orderdate", "l_shipdate"):
        expr = expr.replace(f"{{fmt({col})}}", f"date_format({col}, 'd-MMM-yy')")
    for col in ("l_extendedprice", "l_quantity", "o_totalprice"):
        expr = expr.replace(f"{{usd({col})}}", f"concat('$', format_number({col}, 2), ' ')")
    return expr


def raw_loans(t: Tables) -> DataFrame:
    joined = (t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(t.nation.alias("cn"), F.col("c_nationkey") == F.col("cn.n_nationkey")))
    return joined.selectExpr(*[f"{_spark_text(e)} AS {n}" for n, e in _RAW.items()], f"{LINE_ID} AS {LC.ROW_ID}").repartition(LC.ROW_ID)


def _typed_sql() -> str:
    """The same rows with proper types, without a detour through text."""
    typed = dict(_RAW)
    typed.update({
        "LoanNr_ChkDgt": LINE_ID, "ApprovalDate": "o_orderdate::DATE",
        "ChgOffDate": "CASE WHEN l_returnflag = 'R' THEN l_shipdate::DATE END",
        "DisbursementDate": "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE l_shipdate::DATE END",
        "ApprovalFY": "CASE WHEN o_orderkey % 97 = 0 THEN 1976 ELSE year(o_orderdate) END::INT",
        "DisbursementGross": "l_extendedprice", "BalanceGross": "0::DOUBLE",
        "ChgOffPrinGr": "CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END",
        "GrAppv": "CASE WHEN l_discount = 0 THEN l_extendedprice ELSE o_totalprice END", "SBA_Appv": "l_quantity",
        "NewExist": "CASE l_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 1 END::INT",
    })
    for c in LC.COUNT_COLS:
        typed[c] = f"({typed[c]})::BIGINT"
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in typed.items()) + f" FROM {_BASE}"


_KEPT = ("SELECT * FROM typed WHERE NOT coalesce(ApprovalDate > DisbursementDate, FALSE) AND NewExist IN (1, 2) "
         "AND RevLineCr IN ('Y', 'N') AND (LowDoc IN ('Y', 'N') OR LowDoc IS NULL) AND DisbursementDate IS NOT NULL")
_LAST = "last_value({c} IGNORE NULLS) OVER (PARTITION BY {g} ORDER BY LoanNr_ChkDgt ROWS UNBOUNDED PRECEDING)"
_INDUSTRY = "CASE NAICS " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LC.INDUSTRIES.items()) + " END"
CLEAN_SQL = f"""WITH typed AS ({_typed_sql()}), kept AS ({_KEPT}),
filled AS (SELECT * REPLACE (coalesce(Name, 'Unknown Company') AS Name, coalesce(City, 'Unknown City') AS City,
    coalesce(Bank, 'Unknown Bank') AS Bank, coalesce({_LAST.format(c='State', g='Zip')}, 'AP') AS State) FROM kept),
banked AS (SELECT * REPLACE ({_LAST.format(c='BankState', g='Bank')} AS BankState) FROM filled),
ruled AS (SELECT * REPLACE (CASE WHEN MIS_Status IS NULL AND ChgOffDate IS NOT NULL AND ChgOffPrinGr > 0 THEN 'CHGOFF'
    ELSE MIS_Status END AS MIS_Status, CASE WHEN LowDoc IS NULL THEN CASE WHEN DisbursementGross < 150000 THEN 'Y' ELSE 'N'
    END ELSE LowDoc END AS LowDoc) FROM banked WHERE BankState IS NOT NULL),
coded AS (SELECT * REPLACE ((RevLineCr = 'Y')::INT AS RevLineCr, (LowDoc = 'Y')::INT AS LowDoc,
    (MIS_Status = 'CHGOFF')::INT AS MIS_Status, CASE WHEN substr(NAICS, 1, 2) = '0' AND (Name ILIKE '% INN%' OR Name ILIKE
    '%MOTEL%' OR Name ILIKE '%RESTAURANT%' OR Name ILIKE '%PIZZA%' OR Name ILIKE '%CAFE%') THEN '72'
    ELSE substr(NAICS, 1, 2) END AS NAICS) FROM ruled WHERE MIS_Status IS NOT NULL),
done AS (SELECT *, year(DisbursementDate)::BIGINT AS DisbursementFY, (FranchiseCode <> 0)::INT AS IsFranchised,
    (CASE WHEN CreateJob > 0 THEN 1 ELSE CreateJob END)::INT AS IsCreatedJob,
    (CASE WHEN RetainedJob > 0 THEN 1 ELSE RetainedJob END)::INT AS IsRetainedJob, {_INDUSTRY} AS Industry,
    (Term >= 240)::BIGINT AS RealEstate, Term * 30 AS DaysTerm, DisbursementDate + (Term * 30)::INT AS Active,
    datediff('day', ApprovalDate, DisbursementDate) AS DaysToDisbursement, (State = BankState)::INT AS StateSame,
    round(SBA_Appv / nullif(GrAppv, 0), 9) AS SBA_AppvPct, (DisbursementGross = GrAppv)::INT AS AppvDisbursed,
    (NewExist = 2)::INT AS IsExisting FROM coded WHERE NAICS <> '0')
SELECT * REPLACE (ApprovalDate::TIMESTAMP AS ApprovalDate, ChgOffDate::TIMESTAMP AS ChgOffDate,
    DisbursementDate::TIMESTAMP AS DisbursementDate, Active::TIMESTAMP AS Active),
    (Active BETWEEN DATE '2007-12-01' AND DATE '2009-06-30')::BIGINT AS Recession FROM done"""


@query("clean_loans", CLEAN_SQL)
def clean_loans(t: Tables) -> DataFrame:
    out = LC.clean_loans(raw_loans(t)).withColumn("SBA_AppvPct", F.round("SBA_AppvPct", 9))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (*LC.DATE_COLS, "Active")})


@query("contract_report", f"""WITH rows AS ({CLEAN_SQL}) SELECT * FROM (
SELECT 'Industry' AS "column", 'not_null' AS "check", count(*) FILTER (Industry IS NULL) AS n_failed FROM rows)
WHERE n_failed > 0""")
def contract_report(t: Tables) -> DataFrame:
    return LC.check_loans(LC.clean_loans(raw_loans(t))).select("column", "check", "n_failed")


@query("contract_failures", """SELECT * FROM (
SELECT 'o_orderkey' AS "column", 'ge(100)' AS "check", count(*) FILTER (o_orderkey < 100) AS n_failed FROM orders
UNION ALL SELECT 'o_custkey', 'unique', count(*) - count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'o_totalprice', 'in_range(2000, 400000)', count(*) FILTER (o_totalprice NOT BETWEEN 2000 AND 400000) FROM orders
UNION ALL SELECT 'o_orderstatus', 'isin(''F'', ''O'')', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'o_orderpriority', 'str_length(6)', count(*) FILTER (length(o_orderpriority) > 6) FROM orders
UNION ALL SELECT 'o_orderdate', 'unexpected', 1) WHERE n_failed > 0""")
def contract_failures(t: Tables) -> DataFrame:
    fields = [contract.Field("o_orderkey", "bigint", unique=True, ge=100), contract.Field("o_custkey", "bigint", unique=True),
              contract.Field("o_totalprice", "double", in_range=(2000, 400000)),
              contract.Field("o_orderstatus", "string", isin=("F", "O")),
              contract.Field("o_orderpriority", "string", max_length=6)]
    return contract.validate(t.orders, fields).select("column", "check", "n_failed")


@query("parse_dates", "SELECT o_orderkey, o_orderdate::DATE AS parsed FROM orders")
def parse_dates(t: Tables) -> DataFrame:
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "d-MMM-yy").alias("text"))
    return text.select("o_orderkey", X.parse_dmy(F.col("text")).alias("parsed"))


@query("parse_money", "SELECT o_orderkey, o_totalprice AS amount FROM orders")
def parse_money(t: Tables) -> DataFrame:
    text = t.orders.select("o_orderkey", F.concat(F.lit("$"), F.format_number("o_totalprice", 2), F.lit(" ")).alias("text"))
    return text.select("o_orderkey", X.parse_money(F.col("text")).alias("amount"))


@query("parse_years", "SELECT o_orderkey, (CASE WHEN o_orderkey % 97 = 0 THEN 1976 ELSE year(o_orderdate) END)::INT AS fy FROM orders")
def parse_years(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 97 == 0, "1976A").otherwise(F.year("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", X.parse_year(text, {"1976A": 1976}).alias("fy"))


@query("non_numeric_values", "SELECT DISTINCT CASE WHEN o_orderkey % 97 = 0 THEN year(o_orderdate)::VARCHAR || 'A' END AS fy "
       "FROM orders WHERE o_orderkey % 97 = 0")
def non_numeric_values(t: Tables) -> DataFrame:
    year = F.year("o_orderdate").cast("string")
    df = t.orders.select(F.when(F.col("o_orderkey") % 97 == 0, F.concat(year, F.lit("A"))).otherwise(year).alias("fy"))
    return rowsets.non_numeric_values(df, "fy")


@query("date_order_filter", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
       "WHERE NOT coalesce(o_orderdate > CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_shipdate END, FALSE)")
def date_order_filter(t: Tables) -> DataFrame:
    ship = F.when(F.col("l_partkey") % 9 != 0, F.col("l_shipdate"))
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("ship", ship)
    return rowsets.drop_if_greater(rows, "o_orderdate", "ship").select("l_orderkey", "l_linenumber", "l_partkey")


@query("membership_filter", "SELECT o_orderkey, s FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS s "
       "FROM orders) WHERE s IN ('F', 'O') OR s IS NULL")
def membership_filter(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("s"))
    return rowsets.keep_in(df, "s", ["F", "O"], keep_null=True)


@query("recode_values", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS code, "
       "coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'top' END, 'rest') AS level FROM orders")
def recode_values(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", X.recode(F.col("o_orderstatus"), {"F": 1, "O": 0}).alias("code"),
                           X.recode(F.col("o_orderpriority"), {"1-URGENT": "top"}, F.lit("rest")).alias("level"))


@query("keyword_fill", "SELECT p_partkey, CASE WHEN code <> '0' THEN code WHEN p_name ILIKE '%RING%' THEN '72' "
       "WHEN p_name ILIKE '%BOLT%' OR p_name ILIKE '%GEAR%' THEN '44' ELSE code END AS code FROM "
       "(SELECT *, CASE WHEN p_partkey % 2 = 0 THEN '0' ELSE '11' END AS code FROM part)")
def keyword_fill(t: Tables) -> DataFrame:
    df = t.part.withColumn("code", F.when(F.col("p_partkey") % 2 == 0, "0").otherwise("11"))
    return rowsets.fill_by_keyword(df, "p_name", "code", "0", {"RING": "72", "BOLT|GEAR": "44"}).select("p_partkey", "code")


@query("forward_fill", "SELECT c_custkey, c_nationkey, last_value(seg IGNORE NULLS) OVER (PARTITION BY c_nationkey ORDER BY "
       "c_custkey ROWS UNBOUNDED PRECEDING) AS seg FROM (SELECT *, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS seg "
       "FROM customer)")
def filled_segments(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"))
    return forward_fill(df, "c_nationkey", "seg", "c_custkey")


@query("imputation_audit", "WITH b AS (SELECT *, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS seg FROM customer), "
       "f AS (SELECT c_custkey, seg, last_value(seg IGNORE NULLS) OVER (PARTITION BY c_nationkey ORDER BY c_custkey "
       "ROWS UNBOUNDED PRECEDING) AS filled FROM b) SELECT c_custkey, filled FROM f WHERE seg IS NULL")
def imputation_audit(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"))
    return contract.imputation_audit(df, forward_fill(df, "c_nationkey", "seg", "c_custkey"), "c_custkey", "seg")


@query("constant_fill", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END, 'Unknown') AS seg FROM customer")
def constant_fill(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"))
    return rowsets.fill_constants(df, {"seg": "Unknown"})


@query("rule_imputation", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_totalprice < 150000 THEN 'Y' ELSE 'N' END "
       "ELSE 'Y' END AS LowDoc FROM orders")
def rule_imputation(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, "Y").alias("LowDoc"),
                         F.col("o_totalprice").alias("DisbursementGross"))
    return LC.impute_low_doc(df).select("o_orderkey", "LowDoc")


@query("loan_flags", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity * 6 >= 240)::INT AS real_estate,
CASE WHEN l_quantity - 25 > 0 THEN 1 ELSE (l_quantity - 25)::BIGINT END AS positive, (l_suppkey % 5 <> 0)::INT AS franchised,
(l_suppkey % 5 > 1)::INT AS franchised_strict, (l_returnflag = 'R')::INT AS returned,
round(l_tax / nullif(l_discount, 0), 9) AS ratio, (l_shipdate::DATE + (l_quantity * 30)::INT) AS matures,
((l_shipdate::DATE + (l_quantity * 30)::INT) BETWEEN DATE '1998-01-01' AND DATE '1999-06-30')::INT AS recession,
substr(l_partkey::VARCHAR, 1, 2) AS prefix FROM lineitem""")
def loan_flags(t: Tables) -> DataFrame:
    ship, months = F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")
    matures = X.add_term_days(ship, months)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.flag_ge(months * 6, 240).alias("real_estate"),
        X.flag_pos((months - 25).cast("long")).alias("positive"), X.has_franchise(F.col("l_suppkey") % 5).alias("franchised"),
        X.has_franchise(F.col("l_suppkey") % 5, True).alias("franchised_strict"),
        X.flag_eq(F.col("l_returnflag"), F.lit("R")).alias("returned"),
        F.round(X.safe_ratio(F.col("l_tax"), F.col("l_discount")), 9).alias("ratio"), matures.alias("matures"),
        X.in_closed_interval(matures, "1998-01-01", "1999-06-30").alias("recession"),
        X.code_prefix(F.col("l_partkey")).alias("prefix"))


@query("calendar_parts", """SELECT event_id, year(ts)::INT AS year, quarter(ts)::INT AS quarter, month(ts)::INT AS month,
day(ts)::INT AS day, dayname(ts) AS day_of_week, hour(ts)::INT AS hour, strftime(ts, '%Y-%m-%d') AS iso, strftime(ts, '%H:%M') AS hm
FROM events""")
def calendar_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select("event_id", *[e.alias(n) for n, e in X.date_parts(ts).items()], F.hour(ts).alias("hour"),
                           X.iso_date(ts).alias("iso"), X.hhmm(ts).alias("hm"))


@query("day_spans", "SELECT l_orderkey, l_linenumber, l_partkey, datediff('day', o_orderdate, l_shipdate)::INT AS days "
       "FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def day_spans(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey",
                       X.days_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("days"))


@query("number_functions", """SELECT o_orderkey, round(ln(o_totalprice), 8) AS ln, round(ln(1 + o_totalprice), 8) AS log1p,
round(exp(o_totalprice / 1000000) - 1, 8) AS expm1, round(sqrt(o_totalprice), 6) AS root, round(o_totalprice / 1000000, 9) AS mega FROM orders""")
def number_functions(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    logged = X.log_columns(t.orders.select("o_orderkey", p.alias("p"), p.alias("ln")), ["ln"])
    p = F.col("p")
    return logged.select("o_orderkey", F.round("ln", 8).alias("ln"), F.round(F.log1p(p), 8).alias("log1p"),
                         F.round(F.expm1(X.scale_units(p)), 8).alias("expm1"), F.round(F.sqrt(p), 6).alias("root"),
                         F.round(X.scale_units(p), 9).alias("mega"))


@query("outlier_trim", "SELECT o_orderkey, round(ln(o_totalprice), 8) AS logged FROM orders WHERE ln(o_totalprice) <= 13.0 "
       "AND ln(o_totalprice) >= 7.5")
def outlier_trim(t: Tables) -> DataFrame:
    df = X.log_columns(t.orders.select("o_orderkey", F.col("o_totalprice").alias("logged")), ["logged"])
    return df.filter((F.col("logged") <= 13.0) & (F.col("logged") >= 7.5)).withColumn("logged", F.round("logged", 8))


@query("title_names", "SELECT r_regionkey, CASE WHEN r_name = 'MIDDLE EAST' THEN 'Middle east' ELSE array_to_string(list_transform("
       "string_split(lower(r_name), ' '), lambda x: upper(x[1]) || x[2:]), ' ') END AS title FROM region")
def title_names(t: Tables) -> DataFrame:
    return t.region.select("r_regionkey", X.title_case(F.col("r_name"), {"Middle East": "Middle east"}).alias("title"))


@query("null_audit", """SELECT 'seg' AS "column", count(*) FILTER (c_custkey % 7 = 0) AS n_null FROM customer
UNION ALL SELECT 'bal', count(*) FILTER (c_acctbal < 0) FROM customer""")
def null_audit(t: Tables) -> DataFrame:
    df = t.customer.select(F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"),
                           F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"))
    return stats.null_counts(df)
