"""Star schema of the cleaned loans: five dimensions, one fact table, three OLAP questions.

Surrogate keys number the natural keys in hash order, bucket by bucket, so even the borrowers never
pass through one task. A later load passes the existing dimension: known natural keys keep their
key, new ones are numbered from the highest key on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.hashing import hash32
from tallyfold.functions.scalars import date_parts
from tallyfold.operators.ordered import rank_by_hash
from tallyfold.operators.rowsets import lookup_key, upsert_first_wins
from tallyfold.session import release_shuffles, stage_table
from tallyfold.sources import io

# Column names of the cleaned loans and of the warehouse.
RENAMES = {
    "LoanNr_ChkDgt": "loan_number", "Name": "name", "City": "city", "State": "state", "Zip": "zip_code",
    "Bank": "bank_name", "BankState": "bank_state", "NAICS": "naics_code", "ApprovalDate": "approval_date",
    "ApprovalFY": "approval_year", "Term": "term", "NoEmp": "n_employees", "NewExist": "new_or_existing",
    "CreateJob": "n_jobs_created", "RetainedJob": "n_jobs_retained", "FranchiseCode": "franchise_code",
    "UrbanRural": "urban_or_rural", "RevLineCr": "rev_line_of_credit", "LowDoc": "low_doc",
    "ChgOffDate": "charged_off_date", "DisbursementDate": "disbursement_date",
    "DisbursementGross": "disbursement_gross", "BalanceGross": "balance_gross", "MIS_Status": "status",
    "ChgOffPrinGr": "charged_off_amount", "GrAppv": "approved_gross", "SBA_Appv": "sba_guaranteed_amount",
    "DisbursementFY": "disbursement_year", "IsFranchised": "has_franchise", "IsCreatedJob": "has_jobs_created",
    "IsRetainedJob": "has_jobs_retained", "Industry": "industry", "RealEstate": "real_estate_backed",
    "DaysTerm": "term_in_days", "Active": "maturity_date", "Recession": "recession",
    "DaysToDisbursement": "days_to_disbursement", "StateSame": "in_bank_state",
    "SBA_AppvPct": "sba_guaranteed_ratio", "AppvDisbursed": "full_amount_disbursed", "IsExisting": "is_existing",
}
DATE_ROLES = ("approval_date", "charged_off_date", "disbursement_date", "maturity_date")
PROFILE_FLAGS = ("rev_line_of_credit", "low_doc", "status", "real_estate_backed", "recession", "in_bank_state",
                 "full_amount_disbursed", "is_existing")
BORROWER_KEY = ("state_key", "name", "city", "zip_code", "snapshot_date")
BORROWER_FLAGS = ("urban_or_rural", "has_franchise", "has_jobs_created", "has_jobs_retained")
BORROWER_ATTRS = ("n_employees", "n_jobs_created", "n_jobs_retained", "franchise_code", *BORROWER_FLAGS,
                  "naics_code", "industry")
MEASURES = ("loan_number", "term", "term_in_days", "disbursement_gross", "balance_gross", "charged_off_amount",
            "approved_gross", "sba_guaranteed_amount", "days_to_disbursement", "sba_guaranteed_ratio")


def natural_text(keys: Sequence[str]) -> Column:
    """The natural key as one text, the base of the hash order."""
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def with_surrogate_key(rows: DataFrame, natural: Sequence[str], key: str, existing: DataFrame | None = None) -> DataFrame:
    """Number the rows 1..n in hash order of their natural key, after the highest existing key."""
    hashed = rows.withColumns({"__t": natural_text(natural), "__h": hash32(natural_text(natural))})
    ranked = rank_by_hash(hashed, "__h", "__t", name=key).drop("__h", "__t")
    if existing is not None:
        top = existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
        ranked = ranked.withColumn(key, F.col(key) + top)
    return ranked.select(key, *[c for c in ranked.columns if c != key])


def _append(existing: DataFrame | None, fresh: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    keyed = with_surrogate_key(fresh, natural, key, existing)
    return stage_table(keyed if existing is None else existing.unionByName(keyed), f"dim-{key}")


def build_states(loans: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Every state of a borrower or a bank, once."""
    names = loans.select(F.col("state").alias("name")).union(loans.select("bank_state")).distinct()
    fresh = names if existing is None else names.join(existing.select("name"), "name", "left_anti")
    return _append(existing, fresh, ["name"], "state_key")


def _as_borrowers(loans: DataFrame, states: DataFrame) -> DataFrame:
    rows = loans.withColumn("snapshot_date", F.col("approval_date").cast("date"))
    rows = rows.withColumns({f: F.col(f).cast("boolean") for f in BORROWER_FLAGS})
    return lookup_key(rows, states, {"state": "name"}, "state_key")


def build_borrowers(loans: DataFrame, states: DataFrame, existing: DataFrame | None = None,
                    order: str = "loan_number") -> DataFrame:
    """First record of each (state, name, city, zip, approval date). A code 2 for urban/rural is true."""
    fresh = upsert_first_wins(existing, _as_borrowers(loans, states), BORROWER_KEY, BORROWER_ATTRS, F.col(order))
    return _append(existing, fresh, BORROWER_KEY, "borrower_key")


def build_banks(loans: DataFrame, states: DataFrame, existing: DataFrame | None = None,
                order: str = "loan_number") -> DataFrame:
    """One row per bank name: the state of its first record."""
    rows = lookup_key(loans.select(F.col("bank_name").alias("name"), "bank_state", order), states,
                      {"bank_state": "name"}, "state_key")
    fresh = upsert_first_wins(existing, rows, ["name"], ["state_key"], F.col(order))
    return _append(existing, fresh, ["name"], "bank_key")


def build_dates(loans: DataFrame, existing: DataFrame | None = None, roles: Sequence[str] = DATE_ROLES) -> DataFrame:
    """Every calendar day used in any role, with its parts."""
    days = loans.select(F.explode(F.array(*[F.col(c).cast("date") for c in roles])).alias("date"))
    days = days.filter(F.col("date").isNotNull()).distinct()
    if existing is not None:
        days = days.join(existing.select("date"), "date", "left_anti")
    parts = date_parts(F.col("date"))
    kinds = {"year": "smallint", "quarter": "tinyint", "month": "tinyint", "day": "tinyint", "day_of_week": "string"}
    fresh = days.select("date", *[parts[k].cast(t).alias(k) for k, t in kinds.items()])
    return _append(existing, fresh, ["date"], "date_key")


def build_loan_profiles(loans: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct combinations of the eight flags (at most 256)."""
    flags = loans.select(*[F.col(f).cast("boolean").alias(f) for f in PROFILE_FLAGS]).distinct()
    if existing is not None:
        flags = flags.join(existing.select(*PROFILE_FLAGS), list(PROFILE_FLAGS), "left_anti")
    return _append(existing, flags, PROFILE_FLAGS, "loan_profile_key")


@dataclass
class Star:
    states: DataFrame
    borrowers: DataFrame
    banks: DataFrame
    dates: DataFrame
    loan_profiles: DataFrame
    loans: DataFrame | None = None


def build_loans(loans: DataFrame, star: Star, existing: DataFrame | None = None) -> DataFrame:
    """The fact rows: seven keys and ten measures. A loan number already loaded is not loaded twice."""
    if existing is not None:
        loans = loans.join(existing.select("loan_number"), "loan_number", "left_anti")
    rows = _as_borrowers(loans, star.states).withColumns({f: F.col(f).cast("boolean") for f in PROFILE_FLAGS})
    rows = lookup_key(rows, star.loan_profiles, {f: f for f in PROFILE_FLAGS}, "loan_profile_key")
    rows = lookup_key(rows, star.banks, {"bank_name": "name"}, "bank_key", how="left")
    for role in DATE_ROLES:
        rows = rows.withColumn(role, F.col(role).cast("date"))
        rows = lookup_key(rows, star.dates, {role: "date"}, "date_key", f"{role}_key", how="left")
    rows = lookup_key(rows, star.borrowers, {k: k for k in BORROWER_KEY}, "borrower_key")
    return rows.select("borrower_key", "bank_key", *[f"{r}_key" for r in DATE_ROLES], "loan_profile_key", *MEASURES)


def build_dimensions(loans: DataFrame, old: Star | None = None) -> Star:
    """All five dimensions; with ``old`` the natural keys seen before keep their keys.

    A dimension is a written table. The shuffle files it was made from go before the next one is begun, so that the disk holds
    those of one dimension at a time.
    """
    def was(name: str) -> DataFrame | None:
        return getattr(old, name) if old else None

    def written(dimension: DataFrame) -> DataFrame:
        release_shuffles(loans.sparkSession)
        return dimension

    states = written(build_states(loans, was("states")))
    return Star(states, written(build_borrowers(loans, states, was("borrowers"))), written(build_banks(loans, states, was("banks"))),
                written(build_dates(loans, was("dates"))), written(build_loan_profiles(loans, was("loan_profiles"))))


def load_star(loans: DataFrame, old: Star | None = None) -> Star:
    star = build_dimensions(loans, old)
    fact = build_loans(loans, star, old.loans if old else None)
    star.loans = fact if old is None or old.loans is None else old.loans.unionByName(fact)
    return star


TABLES = ("states", "borrowers", "banks", "dates", "loan_profiles", "loans")


def stored_star(star: Star) -> Star:
    """The same star with a written fact: questions read what they need of it and rebuild nothing.

    The dimensions are written tables since they were built.
    """
    return replace(star, loans=stage_table(star.loans, "star-loans", "zstd"))


def create_tables(spark: SparkSession, star: Star, prefix: str) -> None:
    """The six tables as empty catalog tables, unless they exist."""
    for t in TABLES:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in getattr(star, t).schema)
        io.create_table(spark, prefix + t, columns)


def append_star(star: Star, prefix: str) -> None:
    """Append the rows of all six tables, dimensions first."""
    for t in TABLES:
        io.append_rows(getattr(star, t), prefix + t)


def truncate_tables(spark: SparkSession, prefix: str) -> None:
    for t in reversed(TABLES):
        io.truncate_table(spark, prefix + t)


def drop_tables(spark: SparkSession, prefix: str) -> None:
    for t in reversed(TABLES):
        io.drop_table(spark, prefix + t)


def read_tables(spark: SparkSession, prefix: str) -> Star:
    return Star(**{t: spark.table(prefix + t) for t in TABLES})


# --- OLAP --------------------------------------------------------------------------------------

def warehouse_counts(star: Star) -> DataFrame:
    """Rows of each table, fewest first."""
    tables = [("dimension", n) for n in ("states", "borrowers", "banks", "dates", "loan_profiles")]
    parts = [getattr(star, n).agg(F.count("*").alias("rows")).select(F.lit(t).alias("types"), F.lit(n).alias("tables"), "rows")
             for t, n in [*tables, ("fact_table", "loans")]]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct().orderBy("rows", "tables")


def industry_overview(star: Star) -> DataFrame:
    """Applications, charge-offs and averages per industry."""
    averages = ("term", "term_in_days", "days_to_disbursement", "charged_off_amount", "approved_gross",
                "sba_guaranteed_amount", "sba_guaranteed_ratio")
    rows = (star.loans.join(star.borrowers.select("borrower_key", "industry"), "borrower_key")
            .join(star.loan_profiles.select("loan_profile_key", "status"), "loan_profile_key"))
    return rows.groupBy("industry").agg(
        F.count("*").alias("n_applications"), F.sum(F.col("status").cast("long")).alias("n_charged_offs"),
        *[F.avg(c).alias(f"avg_{c}") for c in averages]).orderBy("industry")


def bank_comparison(star: Star, limit: int = 500) -> DataFrame:
    """Terms and amounts per bank, the largest mean of average term and amount first.

    The fact is reduced to one row per bank key before it meets the bank and state names.
    """
    spread = [f(c).alias(f"{k}_{c}") for c in ("term_in_days", "approved_gross")
              for k, f in (("min", F.min), ("max", F.max), ("avg", F.avg))]
    means = [F.avg(c).alias(f"avg_{c}") for c in ("days_to_disbursement", "sba_guaranteed_amount", "sba_guaranteed_ratio")]
    per_bank = star.loans.groupBy("bank_key").agg(*spread, *means)
    named = per_bank.join(star.banks, "bank_key").join(
        star.states.select("state_key", F.col("name").alias("state")), "state_key")
    order = (0.5 * F.col("avg_term_in_days") + 0.5 * F.col("avg_approved_gross")).desc()
    return named.drop("bank_key", "state_key").orderBy(order, "name").limit(limit)
