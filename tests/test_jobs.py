import datetime as dt

from pyspark.sql import functions as F

from tallyfold.plans import loan_cleaning as LC
from tallyfold.plans import retail, trips
from tallyfold.plans import warehouse as WH
from tallyfold.sources import io
from tallyfold.streaming.incremental_load import load_batch, load_stream, read_star

BASE = {"LoanNr_ChkDgt": "1", "Name": "ACME", "City": "ROME", "State": "NY", "Zip": "100", "Bank": "B1", "BankState": "NY", "NAICS": "451120",
        "ApprovalDate": "28-Feb-97", "ApprovalFY": "1997", "Term": "240", "NoEmp": "4", "NewExist": "2.0", "CreateJob": "0", "RetainedJob": "3",
        "FranchiseCode": "1", "UrbanRural": "0", "RevLineCr": "N", "LowDoc": "Y", "ChgOffDate": None, "DisbursementDate": "5-Mar-97",
        "DisbursementGross": "$60,000.00 ", "BalanceGross": "$0.00 ", "MIS_Status": "P I F", "ChgOffPrinGr": "$0.00 ", "GrAppv": "$60,000.00 ",
        "SBA_Appv": "$48,000.00 "}


def raw(spark, *changes):
    rows = [{**BASE, "LoanNr_ChkDgt": str(i + 1), **c} for i, c in enumerate(changes)]
    df = spark.createDataFrame([[r[c] for c in BASE] for r in rows], ", ".join(f"{c} string" for c in BASE))
    return df.withColumn(LC.ROW_ID, F.col("LoanNr_ChkDgt").cast("long"))


def test_cleaning_rules(spark):
    df = raw(spark, {}, {"State": None}, {"NewExist": "0.0"}, {"LowDoc": None, "DisbursementGross": "$150,000.00 "}, {"NAICS": "0", "Name": "Sea Inn"},
             {"NAICS": "0"}, {"MIS_Status": None}, {"MIS_Status": None, "ChgOffDate": "1-Jan-99", "ChgOffPrinGr": "$5.00 "}, {"ApprovalFY": "1976A"},
             {"DisbursementDate": "1-Jan-97"}, {"Bank": None, "BankState": None}, {"Zip": "777", "State": None}, {"GrAppv": "$0.00 "})
    out = {r.LoanNr_ChkDgt: r for r in LC.clean_loans(df).collect()}
    assert sorted(out) == [1, 2, 4, 5, 8, 9, 12, 13]
    assert out[2].State == "NY" and out[12].State == "AP" and out[13].SBA_AppvPct is None
    assert out[4].LowDoc == 0 and out[5].NAICS == "72" and out[8].MIS_Status == 1 and out[9].ApprovalFY == 1976
    one = out[1]
    assert (one.RealEstate, one.DaysTerm, one.DaysToDisbursement, one.IsFranchised, one.IsRetainedJob, one.StateSame) == (1, 7200, 5, 1, 1, 1)
    assert one.Active == dt.datetime(1997, 3, 5) + dt.timedelta(days=7200) and one.Industry == "RetailTrade"
    assert LC.check_loans(LC.clean_loans(df)).select("column").collect()[0].column == "SBA_AppvPct"


def test_csv_to_star(spark, tmp_path):
    df = raw(spark, {}, {"Name": "OTHER"}, {"Bank": "B2", "BankState": "CA"}).drop(LC.ROW_ID)
    df.coalesce(1).write.option("header", True).csv(str(tmp_path / "raw"))
    cleaned = LC.clean_loans(LC.read_raw(spark, str(tmp_path / "raw")))
    io.write_table(cleaned, str(tmp_path / "clean"))
    loans = spark.read.parquet(str(tmp_path / "clean")).withColumnsRenamed(WH.RENAMES)
    star = WH.load_star(loans)
    counts = {r.tables: r.rows for r in WH.warehouse_counts(star).collect()}
    assert counts == {"states": 2, "borrowers": 2, "banks": 2, "dates": 3, "loan_profiles": 2, "loans": 3}
    again = WH.load_star(loans, star)
    assert again.loans.count() == 3 and again.states.count() == 2


def _loans(spark, *changes):
    return LC.clean_loans(raw(spark, *changes)).withColumnsRenamed(WH.RENAMES)


def test_batches_keep_keys(spark, tmp_path):
    folder = str(tmp_path / "star")
    load_batch(_loans(spark, {}, {"State": "CA"}), 0, folder)
    first = {r.name: r.state_key for r in read_star(spark, folder, 0).states.collect()}
    more = _loans(spark, {}, {"State": "CA"}, {"State": "TX", "Zip": "5"})
    load_batch(more, 1, folder)
    load_batch(more, 1, folder)  # a replay changes nothing
    star = read_star(spark, folder, 1)
    second = {r.name: r.state_key for r in star.states.collect()}
    assert set(second) == {"NY", "CA", "TX"} and all(second[n] == k for n, k in first.items())
    assert star.loans.count() == 3 and star.loans.select("loan_number").distinct().count() == 3


def test_stream_load(spark, tmp_path):
    source = str(tmp_path / "in")
    _loans(spark, {}, {"State": "CA"}).write.parquet(source)
    schema = spark.read.parquet(source).schema
    query = load_stream(spark.readStream.schema(schema).parquet(source), str(tmp_path / "star"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert read_star(spark, str(tmp_path / "star"), 0).loans.count() == 2


def test_trips(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    zones = spark.createDataFrame([(1, square), (2, [(x + 10, y) for x, y in square])], "OBJECTID int, ring array<struct<x:double,y:double>>")
    row = (1, dt.datetime(2024, 3, 1), 1, 2)
    data = spark.createDataFrame([row, row, (1, dt.datetime(2024, 4, 1), 1, 2), (1, dt.datetime(2024, 3, 2), 1, 99)],
                                 "VendorID int, tpep_pickup_datetime timestamp, PULocationID int, DOLocationID int")
    out = trips.prepare_trips(data, zones, "2024-03-01", "2024-04-01").collect()
    assert [(r.pick_up_x, r.pick_up_y, r.drop_off_x) for r in out] == [(1.0, 1.0, 11.0)]


def test_retail(spark):
    lines = [(t, "s", d, q, None, p, 1, "UK") for t, d, q, p in
             [("1", "a", 1, 1.0), ("1", "a", 2, 1.0), ("1", "b", 1, 1.0), ("2", "a", 1, 1.0), ("2", "b", 1, 1.0), ("3", "", 1, 1.0), ("3", "c", -1, 1.0)]]
    df = spark.createDataFrame(lines, "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp, "
                                      "UnitPrice double, CustomerID int, Country string")
    sets, rules = retail.mine_retail(df, 0.5, 0.8)
    assert {tuple(r["items"]): r.freq for r in sets.collect()} == {("a",): 2, ("b",): 2, ("a", "b"): 2}
    assert rules.count() == 2


def test_tables_and_bundles(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val")], "id int, split string")
    io.save_splits(df, str(tmp_path / "splits"))
    assert [r.id for r in io.load_splits(spark, str(tmp_path / "splits"), "val").collect()] == [2]
    io.create_table(spark, "tf_states", "state_key int, name string")
    io.create_table(spark, "tf_states", "state_key int, name string")
    io.append_rows(spark.createDataFrame([(1, "NY")], "state_key int, name string"), "tf_states")
    assert "tf_states" in io.list_tables(spark) and spark.table("tf_states").count() == 1
    io.truncate_table(spark, "tf_states")
    assert spark.table("tf_states").count() == 0
    io.drop_table(spark, "tf_states")
    imp = spark.createDataFrame([("a", 0.5)], "feature string, importance double")
    io.append_importances(imp, str(tmp_path / "imp"), "r1")
    io.append_importances(imp, str(tmp_path / "imp"), "r2")
    assert spark.read.parquet(str(tmp_path / "imp")).count() == 2


def test_stored_star_writes_the_fact_alone(spark):
    """Dimensions are written tables since they were built; a second copy of each would only cost disk."""
    from tallyfold.session import staged

    star = WH.load_star(LC.clean_loans(raw(spark, {}, {"Name": "OTHER"})).withColumnsRenamed(WH.RENAMES))
    before = len(staged(spark))
    stored = WH.stored_star(star)
    assert len(staged(spark)) == before + 1
    assert all(getattr(stored, t) is getattr(star, t) for t in WH.TABLES if t != "loans")
    assert sorted(stored.loans.collect()) == sorted(star.loans.collect())


def test_wide_loans_go_once_the_fact_is_written(spark):
    from tallyfold.catalog import star
    from tallyfold.catalog.registry import Tables
    from tallyfold.session import staged

    t, before = Tables(spark, "/root/testdata/sf0.001/."), set(staged(spark))  # a folder no other test asks for
    held = star.warehouse(t)
    mine = [p.rsplit("/", 1)[-1] for p in staged(spark) if p not in before]
    assert any(p.startswith("star-loans-") for p in mine) and not any(p.startswith("loans-") for p in mine)
    assert held.loans.count() == star.loans(t).count() and held.borrowers.count() > 0
