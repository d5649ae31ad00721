import json
import math

from pyspark.sql import functions as F

from tidewatch.sources import io


def test_csv_parquet_json_roundtrip(spark, tmp_path):
    csv = tmp_path / "tx.csv"
    csv.write_text("TransactionID,isFraud,TransactionDT,TransactionAmt,ProductCD,card1,card2\n"
                   "1,0,86400,10.5,W,1000,361\n2,1,x,,H,1001,\n")
    df = io.read_csv(spark, str(csv), io.TRANSACTION_SCHEMA)
    rows = df.orderBy("TransactionID").collect()
    assert rows[0].card2 == 361.0 and rows[1].TransactionDT is None and rows[1].TransactionAmt is None
    out = str(tmp_path / "pq")
    io.write_parquet(df, out, partition_by=["isFraud"])
    assert io.read_parquet(spark, out).count() == 2
    rep = spark.createDataFrame([(float("nan"), float("inf"), 1.5)], "a double, b double, c double")
    io.write_json_report(rep, str(tmp_path / "rep"))
    line = json.loads(next(p for p in (tmp_path / "rep").glob("*.json")).read_text().strip() or "{}")
    assert line == {"c": 1.5}          # NaN / inf written as null (dropped by the JSON writer)


def test_load_temperature_rules(tmp_path):
    assert io.load_temperature(str(tmp_path / "missing.json")) is None
    assert io.load_temperature(str(tmp_path / "missing.json"), strict=False) == 1.0
    p = tmp_path / "t.json"
    p.write_text(json.dumps({"temperature": -2}))
    assert io.load_temperature(str(p)) is None
    p.write_text(json.dumps({"temperature": 0.98}))
    assert math.isclose(io.load_temperature(str(p)), 0.98)


def test_stand_in_projection_only_renames(spark):
    from tidewatch.sources.standins import events_transactions
    tx = events_transactions(spark, "/root/testdata/sf0.001")
    assert tx.columns == ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "card1", "DeviceInfo",
                          "P_emaildomain"]
    assert tx.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert tx.filter(F.col("TransactionDT").isNull()).count() == 0
