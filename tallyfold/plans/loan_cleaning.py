"""Raw loan records to the cleaned 41-column table, as one declared plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions import scalars as X
from tallyfold.operators.contract import Field, validate
from tallyfold.operators.ordered import forward_fill
from tallyfold.operators.rowsets import drop_if_greater, fill_by_keyword, fill_constants, keep_in
from tallyfold.session import stage_table
from tallyfold.sources.io import read_csv

ROW_ID = "__row"
# Column names of the raw loans.
DATE_COLS = ("ApprovalDate", "ChgOffDate", "DisbursementDate")
MONEY_COLS = ("DisbursementGross", "BalanceGross", "ChgOffPrinGr", "GrAppv", "SBA_Appv")
COUNT_COLS = ("Zip", "Term", "NoEmp", "CreateJob", "RetainedJob", "FranchiseCode", "UrbanRural")

RAW_SCHEMA = ", ".join(f"{c} string" for c in (
    "LoanNr_ChkDgt", "Name", "City", "State", "Zip", "Bank", "BankState", "NAICS", "ApprovalDate", "ApprovalFY",
    "Term", "NoEmp", "NewExist", "CreateJob", "RetainedJob", "FranchiseCode", "UrbanRural", "RevLineCr", "LowDoc",
    "ChgOffDate", "DisbursementDate", "DisbursementGross", "BalanceGross", "MIS_Status", "ChgOffPrinGr", "GrAppv",
    "SBA_Appv"))

# Leading two digits of the industry code and the label they stand for.
INDUSTRIES = {
    "11": "Ag/Forest/Fish/Hunt",
    "21": "Min/Quar/OilGas",
    "22": "Utilities",
    "23": "Construction",
    "31": "Manufacturing",
    "32": "Manufacturing",
    "33": "Manufacturing",
    "42": "WholesaleTrade",
    "44": "RetailTrade",
    "45": "RetailTrade",
    "48": "Trans/Warehouse",
    "49": "Trans/Warehouse",
    "51": "Information",
    "52": "Finance/Insurance",
    "53": "REst/Rental/Lease",
    "54": "Prof/Science/Tech",
    "55": "MgmtCompEnt",
    "56": "Admin/Support/WasteMgmtRem",
    "61": "Educational",
    "62": "Healthcare/SocialAssist",
    "71": "Arts/Entertain/Rec",
    "72": "Accom/Food",
    "81": "OthersNoPublicAdmin",
    "92": "PublicAdmin",
}
# Words in a company name that place it in code 72, the recession, and the low-doc limit.
KEYWORDS = {" INN|MOTEL": "72", "RESTAURANT|PIZZA|CAFE": "72"}
RECESSION = ("2007-12-01", "2009-06-30")
LOW_DOC_LIMIT = 150000


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text plus the place of the row in its source (the fill order): file, block of the file, row.

    Spark packs splits by size, so a row number alone would not follow the files.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return read_csv(spark, path, RAW_SCHEMA).withColumn(ROW_ID, place)


def typed(raw: DataFrame) -> DataFrame:
    """Text to dates, money, years and counts. Values that do not parse become null."""
    return raw.withColumns({
        **{c: X.parse_dmy(F.col(c)) for c in DATE_COLS},
        **{c: X.parse_money(F.col(c)) for c in MONEY_COLS},
        **{c: F.col(c).try_cast("long") for c in COUNT_COLS},
        "LoanNr_ChkDgt": F.col("LoanNr_ChkDgt").try_cast("long"),
        "NewExist": F.col("NewExist").try_cast("double"),
        "ApprovalFY": X.parse_year(F.col("ApprovalFY"), {"1976A": 1976}),
    })


def impute_status(df: DataFrame) -> DataFrame:
    """A missing status with a charge-off date and amount is a charge-off; other missing ones are dropped."""
    evidence = F.col("MIS_Status").isNull() & F.col("ChgOffDate").isNotNull() & (F.col("ChgOffPrinGr") > 0)
    return df.withColumn("MIS_Status", F.when(evidence, "CHGOFF").otherwise(F.col("MIS_Status"))).filter(
        F.col("MIS_Status").isNotNull())


def impute_low_doc(df: DataFrame) -> DataFrame:
    """A missing low-doc flag follows the disbursed amount."""
    missing, gross = F.col("LowDoc").isNull(), F.col("DisbursementGross")
    return df.withColumn("LowDoc", F.when(missing & (gross < LOW_DOC_LIMIT), "Y")
                         .when(missing & (gross >= LOW_DOC_LIMIT), "N").otherwise(F.col("LowDoc")))


def filtered(df: DataFrame) -> DataFrame:
    """Rows with consistent dates and valid codes."""
    df = drop_if_greater(df, "ApprovalDate", "DisbursementDate")
    df = keep_in(df, "NewExist", [1, 2]).withColumn("NewExist", F.col("NewExist").cast("int"))
    df = keep_in(df, "RevLineCr", ["Y", "N"])
    df = keep_in(df, "LowDoc", ["Y", "N"], keep_null=True)
    return df.filter(F.col("DisbursementDate").isNotNull())


def imputed(df: DataFrame) -> DataFrame:
    """Missing names, states and banks filled in order; status and low-doc by rule.

    ``df`` is a written table: both fills read their own three columns of it.
    """
    banked = fill_constants(df, {"Bank": "Unknown Bank"})
    out = forward_fill(fill_constants(banked, {"Name": "Unknown Company", "City": "Unknown City"}), "Zip", "State", ROW_ID, df)
    out = fill_constants(out, {"State": "AP"})
    out = forward_fill(out, "Bank", "BankState", ROW_ID, banked).filter(F.col("BankState").isNotNull())
    return impute_low_doc(impute_status(out))


def recoded(df: DataFrame) -> DataFrame:
    """Codes to numbers, missing industry codes from the company name, industry labels."""
    yes_no = {"Y": 1, "N": 0}
    df = df.withColumns({
        "NAICS": X.code_prefix(F.col("NAICS")),
        "RevLineCr": X.recode(F.col("RevLineCr"), yes_no),
        "LowDoc": X.recode(F.col("LowDoc"), yes_no),
        "MIS_Status": X.recode(F.col("MIS_Status"), {"P I F": 0, "CHGOFF": 1}),
    })
    df = fill_by_keyword(df, "Name", "NAICS", "0", KEYWORDS)
    return df.withColumn("Industry", X.recode(F.col("NAICS"), INDUSTRIES)).filter(F.col("NAICS") != "0")


def derived(df: DataFrame) -> DataFrame:
    """Flags, spans and ratios of each loan."""
    df = df.withColumns({
        "DisbursementFY": F.year("DisbursementDate").cast("long"),
        "IsFranchised": X.has_franchise(F.col("FranchiseCode")),
        "IsCreatedJob": X.flag_pos(F.col("CreateJob")).cast("int"),
        "IsRetainedJob": X.flag_pos(F.col("RetainedJob")).cast("int"),
        "RealEstate": X.flag_ge(F.col("Term"), 240).cast("long"),
        "DaysTerm": F.col("Term") * 30,
        "Active": X.add_term_days(F.col("DisbursementDate"), F.col("Term")),
        "DaysToDisbursement": X.days_between(F.col("ApprovalDate"), F.col("DisbursementDate")).cast("long"),
        "StateSame": X.flag_eq(F.col("State"), F.col("BankState")),
        "SBA_AppvPct": X.safe_ratio(F.col("SBA_Appv"), F.col("GrAppv")),
        "AppvDisbursed": X.flag_eq(F.col("DisbursementGross"), F.col("GrAppv")),
        "IsExisting": X.recode(F.col("NewExist"), {1: 0, 2: 1}),
    })
    df = df.withColumn("Recession", X.in_closed_interval(F.col("Active"), *RECESSION).cast("long"))
    return df.withColumns({c: F.col(c).cast("timestamp") for c in (*DATE_COLS, "Active")})


def clean_loans(raw: DataFrame) -> DataFrame:
    """The whole cleaning, in the order the results depend on. The text is parsed once, into a written table."""
    kept = stage_table(filtered(typed(raw)), "typed")
    out = derived(recoded(imputed(kept)))
    return out.select(*[f.name for f in CONTRACT])


FLAG = (0, 1)
# Types and checks of the cleaned table.
CONTRACT = (
    Field("LoanNr_ChkDgt", "bigint", unique=True),
    Field("Name", "string"), Field("City", "string"), Field("State", "string"),
    Field("Zip", "bigint", in_range=(0, 99999)),
    Field("Bank", "string"), Field("BankState", "string"),
    Field("NAICS", "string", max_length=2),
    Field("ApprovalDate", "timestamp"),
    Field("ApprovalFY", "int", in_range=(1970, 2014)),
    Field("Term", "bigint", ge=0), Field("NoEmp", "bigint", ge=0),
    Field("NewExist", "int", isin=(1, 2)),
    Field("CreateJob", "bigint", ge=0), Field("RetainedJob", "bigint", ge=0),
    Field("FranchiseCode", "bigint"),
    Field("UrbanRural", "bigint", isin=(0, 1, 2)),
    Field("RevLineCr", "int", isin=FLAG), Field("LowDoc", "int", isin=FLAG),
    Field("ChgOffDate", "timestamp", nullable=True), Field("DisbursementDate", "timestamp"),
    Field("DisbursementGross", "double", ge=0), Field("BalanceGross", "double", ge=0),
    Field("MIS_Status", "int", isin=FLAG),
    Field("ChgOffPrinGr", "double", ge=0), Field("GrAppv", "double", ge=0), Field("SBA_Appv", "double", ge=0),
    Field("DisbursementFY", "bigint", in_range=(1970, 2028)),
    Field("IsFranchised", "int", isin=FLAG), Field("IsCreatedJob", "int", isin=FLAG),
    Field("IsRetainedJob", "int", isin=FLAG),
    Field("Industry", "string"),
    Field("RealEstate", "bigint", isin=FLAG),
    Field("DaysTerm", "bigint", ge=0),
    Field("Active", "timestamp"),
    Field("Recession", "bigint", isin=FLAG),
    Field("DaysToDisbursement", "bigint", ge=0),
    Field("StateSame", "int", isin=FLAG),
    Field("SBA_AppvPct", "double", in_range=(0, 100)),
    Field("AppvDisbursed", "int", isin=FLAG), Field("IsExisting", "int", isin=FLAG),
)


def check_loans(cleaned: DataFrame) -> DataFrame:
    return validate(cleaned, CONTRACT)
