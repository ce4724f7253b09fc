"""Star schema and OLAP queries on loans made from order lines."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.catalog.registry import LINE_ID, Tables, h32, query
from tallyfold.operators.rowsets import keep_in
from tallyfold.plans import warehouse as WH
from tallyfold.session import drop_staged, recorded, release_shuffles, stage_table
from tallyfold.sources import io

# Loan columns from a line, its order, customer, supplier and their nations; text both engines read.
LOAN_COLUMNS = {
    "loan_number": LINE_ID,
    "name": "c_name", "city": "concat('CITY_', c_custkey % 100)", "state": "cn.n_name",
    "zip_code": "CAST(c_custkey % 100000 AS INT)",
    "bank_name": "concat('BANK_', CAST(floor(s_suppkey / 2.0) AS BIGINT))", "bank_state": "sn.n_name",
    "naics_code": "CAST(11 + l_partkey % 80 AS VARCHAR(4))", "industry": "c_mktsegment",
    "approval_date": "CAST(o_orderdate AS DATE)",
    "disbursement_date": "CAST(l_shipdate AS DATE)",
    "charged_off_date": "CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) + 200 END",
    "maturity_date": "CAST(l_shipdate AS DATE) + CAST(l_quantity * 30 AS INT)",
    "term": "CAST(l_quantity AS INT)", "term_in_days": "CAST(l_quantity * 30 AS INT)",
    "n_employees": "CAST(l_partkey % 90 AS INT)", "n_jobs_created": "CAST(l_partkey % 4 AS INT)",
    "n_jobs_retained": "CAST(l_suppkey % 3 AS INT)", "franchise_code": "CAST(o_custkey % 5 AS INT)",
    "urban_or_rural": "CAST(o_orderkey % 3 AS INT)",
    "has_franchise": "CAST(CASE WHEN o_custkey % 5 <> 0 THEN 1 ELSE 0 END AS INT)",
    "has_jobs_created": "CAST(CASE WHEN l_partkey % 4 > 0 THEN 1 ELSE 0 END AS INT)",
    "has_jobs_retained": "CAST(CASE WHEN l_suppkey % 3 > 0 THEN 1 ELSE 0 END AS INT)",
    "rev_line_of_credit": "CAST(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS INT)",
    "low_doc": "CAST(CASE WHEN l_extendedprice < 50000 THEN 1 ELSE 0 END AS INT)",
    "status": "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT)",
    "real_estate_backed": "CAST(CASE WHEN l_quantity >= 24 THEN 1 ELSE 0 END AS INT)",
    "recession": "CAST(CASE WHEN l_shipdate BETWEEN DATE '1998-01-01' AND DATE '1999-06-30' THEN 1 ELSE 0 END AS INT)",
    "in_bank_state": "CAST(CASE WHEN cn.n_name = sn.n_name THEN 1 ELSE 0 END AS INT)",
    "full_amount_disbursed": "CAST(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS INT)",
    "is_existing": "CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INT)",
    "disbursement_gross": "l_extendedprice", "balance_gross": "l_extendedprice * l_tax",
    "charged_off_amount": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE CAST(0 AS DOUBLE) END",
    "approved_gross": "l_extendedprice * (1 + l_tax)", "sba_guaranteed_amount": "l_extendedprice * (1 - l_discount)",
    "days_to_disbursement": "CAST(datediff(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS INT)",
    "sba_guaranteed_ratio": "(1 - l_discount) / (1 + l_tax)",
}
_SOURCE = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey"""


def _duck(expr: str) -> str:
    return expr.replace("datediff(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE))",
                        "datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))")


LOANS_SQL = "src AS (SELECT " + ", ".join(f"{_duck(e)} AS {n}" for n, e in LOAN_COLUMNS.items()) + f" FROM {_SOURCE})"


def loans(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """The loans of all lines, or of ``lines`` that were laid out for a purpose."""
    cn = t.nation.alias("cn")
    sn = t.nation.alias("sn")
    joined = ((t.lineitem if lines is None else lines).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(cn, F.col("c_nationkey") == F.col("cn.n_nationkey"))
              .join(sn, F.col("s_nationkey") == F.col("sn.n_nationkey")))
    return joined.selectExpr(*[f"{e} AS {n}" for n, e in LOAN_COLUMNS.items()])


def _keyed(name: str, key: str, natural: str, cols: str, source: str) -> str:
    return (f"{name} AS (SELECT row_number() OVER (ORDER BY {h32('nk')}, nk) AS {key}, {cols} "
            f"FROM (SELECT concat_ws('|', {natural}) AS nk, * FROM ({source}) q) p)")


_B_ATTRS = ", ".join(WH.BORROWER_ATTRS)
_FLAG_CAST = ", ".join(f"{f}::BOOLEAN AS {f}" for f in WH.BORROWER_FLAGS)
_BORROWER_ROWS = ("SELECT s.state_key, src.name, city, zip_code, approval_date AS snapshot_date, n_employees, "
                  "n_jobs_created, n_jobs_retained, franchise_code, " + _FLAG_CAST + ", naics_code, industry, loan_number "
                  "FROM src JOIN states s ON s.name = src.state")
_FIRST = "SELECT * FROM ({rows}) r QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY loan_number) = 1"
_PROFILE = ", ".join(f"{f}::BOOLEAN AS {f}" for f in WH.PROFILE_FLAGS)

STATES_SQL = _keyed("states", "state_key", "name", "name",
                    "SELECT state AS name FROM src UNION SELECT bank_state FROM src")
BORROWERS_SQL = _keyed("borrowers", "borrower_key", ", ".join(WH.BORROWER_KEY),
                       ", ".join(WH.BORROWER_KEY) + ", " + _B_ATTRS,
                       _FIRST.format(rows=_BORROWER_ROWS, keys=", ".join(WH.BORROWER_KEY)))
BANKS_SQL = _keyed("banks", "bank_key", "name", "name, state_key", _FIRST.format(
    rows="SELECT bank_name AS name, s.state_key, loan_number FROM src JOIN states s ON s.name = src.bank_state",
    keys="name"))
DATES_SQL = _keyed("dates", "date_key", "date", "date, year(date)::SMALLINT AS year, quarter(date)::TINYINT AS quarter, "
                   "month(date)::TINYINT AS month, day(date)::TINYINT AS day, dayname(date) AS day_of_week",
                   " UNION ".join(f"SELECT {r} AS date FROM src WHERE {r} IS NOT NULL" for r in WH.DATE_ROLES))
PROFILES_SQL = _keyed("loan_profiles", "loan_profile_key", ", ".join(WH.PROFILE_FLAGS), ", ".join(WH.PROFILE_FLAGS),
                      f"SELECT DISTINCT {_PROFILE} FROM src")
FACT_SQL = ("loans AS (SELECT b.borrower_key, k.bank_key, "
            + ", ".join(f"d{i}.date_key AS {r}_key" for i, r in enumerate(WH.DATE_ROLES))
            + ", p.loan_profile_key, " + ", ".join(WH.MEASURES)
            + " FROM src JOIN states s ON s.name = src.state"
            + " JOIN borrowers b ON b.state_key = s.state_key AND b.name = src.name AND b.city = src.city"
            + " AND b.zip_code = src.zip_code AND b.snapshot_date = src.approval_date"
            + " JOIN banks k ON k.name = src.bank_name"
            + "".join(f" LEFT JOIN dates d{i} ON d{i}.date = src.{r}" for i, r in enumerate(WH.DATE_ROLES))
            + " JOIN loan_profiles p ON " + " AND ".join(f"p.{f} = src.{f}::BOOLEAN" for f in WH.PROFILE_FLAGS) + ")")
ALL_SQL = "WITH " + ", ".join([LOANS_SQL, STATES_SQL, BORROWERS_SQL, BANKS_SQL, DATES_SQL, PROFILES_SQL, FACT_SQL])


def star(t: Tables) -> WH.Star:
    """The star of the cleaned loans, which the load reads from a written table.

    The narrow lines of an order are brought together before its wide loans are made: the join with large orders needs that
    anyway, and loans of one borrower then lie together, so that only one of them travels to the dimension.
    """
    rows = stage_table(loans(t, t.lineitem.repartition("l_orderkey")), "loans", "zstd")
    release_shuffles(t.spark)
    return WH.load_star(rows)


@query("dim_states", f"WITH {LOANS_SQL}, {STATES_SQL} SELECT * FROM states")
def dim_states(t: Tables) -> DataFrame:
    return WH.build_states(loans(t))


@query("dim_borrowers", f"WITH {LOANS_SQL}, {STATES_SQL}, {BORROWERS_SQL} SELECT * FROM borrowers")
def dim_borrowers(t: Tables) -> DataFrame:
    rows = loans(t)
    return WH.build_borrowers(rows, WH.build_states(rows))


@query("dim_banks", f"WITH {LOANS_SQL}, {STATES_SQL}, {BANKS_SQL} SELECT * FROM banks")
def dim_banks(t: Tables) -> DataFrame:
    rows = loans(t)
    return WH.build_banks(rows, WH.build_states(rows))


@query("dim_dates", f"WITH {LOANS_SQL}, {DATES_SQL} SELECT * FROM dates")
def dim_dates(t: Tables) -> DataFrame:
    return WH.build_dates(loans(t))


@query("dim_loan_profiles", f"WITH {LOANS_SQL}, {PROFILES_SQL} SELECT * FROM loan_profiles")
def dim_loan_profiles(t: Tables) -> DataFrame:
    return WH.build_loan_profiles(loans(t))


@query("fact_loans", ALL_SQL + " SELECT * REPLACE (round(balance_gross, 6) AS balance_gross, "
       "round(charged_off_amount, 6) AS charged_off_amount, round(approved_gross, 6) AS approved_gross, "
       "round(sba_guaranteed_amount, 6) AS sba_guaranteed_amount, round(sba_guaranteed_ratio, 9) AS "
       "sba_guaranteed_ratio) FROM loans")
def fact_loans(t: Tables) -> DataFrame:
    money = ("balance_gross", "charged_off_amount", "approved_gross", "sba_guaranteed_amount")
    return warehouse(t).loans.withColumns({**{c: F.round(c, 6) for c in money},
                                      "sba_guaranteed_ratio": F.round("sba_guaranteed_ratio", 9)})


_STORED: dict[tuple[str, str], WH.Star] = {}  # application and folder to its warehouse


def warehouse(t: Tables) -> WH.Star:
    """The warehouse of a folder: loaded and written once, then asked by all OLAP queries of the session.

    Once the fact is written, the wide loans it was made from are removed, and the shuffle files with them.
    """
    key = t.spark.sparkContext.applicationId, t.folder
    if key not in _STORED:
        with recorded() as paths:
            _STORED[key] = WH.stored_star(star(t))
        drop_staged(t.spark, [p for p in paths if p.rsplit("/", 1)[-1].startswith("loans-")])
    return _STORED[key]


@query("warehouse_cycle", ALL_SQL + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS tables, count(*) AS loaded, 0::BIGINT AS truncated, count(*) AS reloaded, true AS listed, false AS listed_after FROM {n}" for n in WH.TABLES))
def warehouse_cycle(t: Tables) -> DataFrame:
    """Create, load, truncate, load again, list and drop the six tables of the star."""
    prefix, held = f"star_{uuid.uuid4().hex}_", warehouse(t)

    def counts(name: str) -> DataFrame:
        now = WH.read_tables(t.spark, prefix)
        parts = [getattr(now, n).agg(F.count("*").alias(name)).select(F.lit(n).alias("tables"), name) for n in WH.TABLES]
        return stage_table(reduce(DataFrame.unionAll, parts), "counts")

    WH.create_tables(t.spark, held, prefix)
    WH.append_star(held, prefix)
    out = counts("loaded")
    WH.truncate_tables(t.spark, prefix)
    out = out.join(counts("truncated"), "tables")
    WH.append_star(held, prefix)
    out = out.join(counts("reloaded"), "tables")
    before = io.list_tables(t.spark)
    WH.drop_tables(t.spark, prefix)
    after = io.list_tables(t.spark)
    names = F.concat(F.lit(prefix), F.col("tables"))
    return out.withColumns({"listed": names.isin([n for n in before if n.startswith(prefix)]), "listed_after": names.isin([n for n in after if n.startswith(prefix)])})


@query("warehouse_counts", ALL_SQL + " " + " UNION ".join(
    f"SELECT '{k}' AS types, '{n}' AS tables, count(*) AS rows FROM {n}" for k, n in
    [*[("dimension", d) for d in ("states", "borrowers", "banks", "dates", "loan_profiles")], ("fact_table", "loans")])
    + " ORDER BY rows")
def warehouse_counts(t: Tables) -> DataFrame:
    return WH.warehouse_counts(warehouse(t))


_OVERVIEW = ("term", "term_in_days", "days_to_disbursement", "charged_off_amount", "approved_gross",
             "sba_guaranteed_amount", "sba_guaranteed_ratio")


@query("industry_overview", ALL_SQL + " SELECT industry, count(*) AS n_applications, "
       "sum(CASE WHEN status THEN 1 ELSE 0 END)::BIGINT AS n_charged_offs, "
       + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _OVERVIEW)
       + " FROM loans JOIN borrowers USING (borrower_key) JOIN loan_profiles USING (loan_profile_key) "
       "GROUP BY industry ORDER BY industry")
def industry_overview(t: Tables) -> DataFrame:
    out = WH.industry_overview(warehouse(t))
    return out.withColumns({f"avg_{c}": F.round(f"avg_{c}", 6) for c in _OVERVIEW})


_BANK = [f"{k}_{c}" for c in ("term_in_days", "approved_gross") for k in ("min", "max", "avg")]
_BANK_AVG = ("days_to_disbursement", "sba_guaranteed_amount", "sba_guaranteed_ratio")


@query("bank_comparison", ALL_SQL + " SELECT b.name, bs.name AS state, "
       + ", ".join(f"round({k}({c}), 6) AS {k}_{c}" if c == "approved_gross" or k == "avg" else f"{k}({c}) AS {k}_{c}"
                   for c in ("term_in_days", "approved_gross") for k in ("min", "max", "avg")) + ", "
       + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in _BANK_AVG)
       + " FROM loans l JOIN banks b ON b.bank_key = l.bank_key JOIN states bs ON bs.state_key = b.state_key "
       "GROUP BY b.name, bs.name ORDER BY (0.5 * avg(term_in_days) + 0.5 * avg(approved_gross)) DESC, b.name LIMIT 500")
def bank_comparison(t: Tables) -> DataFrame:
    out = WH.bank_comparison(warehouse(t))
    rounded = [c for c in [*_BANK, *[f"avg_{a}" for a in _BANK_AVG]] if c not in ("min_term_in_days", "max_term_in_days")]
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query("borrowers_of_banks", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)")
def borrowers_of_banks(t: Tables) -> DataFrame:
    """The IN-list lookup as a semi join on the whole table."""
    return t.customer.join(t.supplier, F.col("c_nationkey") == F.col("s_nationkey"), "left_semi").select("c_custkey", "c_name")


@query("incremental_load", f"WITH {LOANS_SQL}, {STATES_SQL} SELECT name, 1::BIGINT AS n FROM states")
def incremental_load(t: Tables) -> DataFrame:
    """A second load of overlapping rows adds no state twice."""
    rows = loans(t)
    first = WH.build_states(keep_in(rows, "status", [1]))
    return WH.build_states(rows, first).groupBy("name").agg(F.count("*").alias("n"))
