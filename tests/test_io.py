import datetime as dt
import json

import pandas as pd
import pytest

from txnlens import schemas
from txnlens.operators import parity as PV
from txnlens.sources import catalog, readers, writers


def test_absent_keys_and_bad_records(spark, tmp_path):
    lines = [json.dumps({"uniqueId": "1", "customerId": "c", "sessionId": "s", "action": "login",
                         "timestamp": "2024-01-01T00:00:00"}), '{"uniqueId": ', json.dumps({"uniqueId": "2", "amount": 3.5})]
    (tmp_path / "e.json").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "e.json")
    good = readers.read_json(spark, path, schemas.EVENTS, max_bad_records=1)
    assert good.count() == 2 and good.where("uniqueId = '2'").first()["action"] is None
    with pytest.raises(readers.BadRecordsError):
        readers.read_json(spark, path, schemas.EVENTS, max_bad_records=0)
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):  # no record may be unreadable by default
        readers.read_json(spark, path, schemas.EVENTS).collect()
    with pytest.raises(ValueError):
        readers.load(spark, path, "AVRO")


def test_csv_and_globs(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 0.5, "a", 2.0)], schemas.BATCH_SCORES)
    for k in range(2):
        writers.export(df, str(tmp_path / f"part_{k}.csv"))
    assert readers.read_csv(spark, str(tmp_path / "part_*.csv"), schemas.BATCH_SCORES).count() == 2
    assert readers.read_csv(spark, str(tmp_path / "part_0.csv")).dtypes[0] == ("fraudLabel", "double")
    with pytest.raises(ValueError):
        writers.export(df, str(tmp_path / "x.avro"))


def test_model_columns_reads_whole_numbers_as_doubles(tables):
    out = readers.model_columns(tables.features(), ["hour", "amount"], "fraudLabel", ["amount", "uniqueId"])
    assert out.dtypes == [("hour", "double"), ("amount", "double"), ("fraudLabel", "double"), ("uniqueId", "string")]


def test_dispositions_partitions_and_evolution(spark, tmp_path):
    spark.sql(f"CREATE DATABASE disp LOCATION '{tmp_path}/disp'")
    one = spark.createDataFrame([(1, "x", dt.date(2024, 1, 1)), (2, "y", dt.date(2024, 1, 2))], "a long, b string, d date")
    name = "disp.t"
    catalog.create_table(spark, name, one.schema)
    writers.write_table(one, name, "EMPTY", partition_by=["d"])
    with pytest.raises(ValueError):
        writers.write_table(one, name, "EMPTY")
    writers.write_table(one.where("a = 1").selectExpr("a + 10 AS a", "b", "d"), name, "TRUNCATE",
                        replace_partitions=True)
    assert sorted(r[0] for r in spark.table(name).select("a").collect()) == [2, 11]  # only its partition replaced
    with pytest.raises(ValueError):
        writers.write_table(one.selectExpr("a", "d"), name, "APPEND")
    writers.write_table(one.selectExpr("a", "d", "1.5D AS extra"), name, "APPEND", partition_by=["d"], relax_schema=True)
    rows = spark.table(name)
    assert rows.count() == 4 and rows.where("extra IS NULL").count() == 2 and rows.where("b IS NULL").count() == 2
    catalog.load_frame(spark, pd.DataFrame({"k": [1]}), "disp.frame")
    with pytest.raises(Exception):
        catalog.load_frame(spark, pd.DataFrame({"k": [1]}), "disp.frame")
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql" / "totals.sql").write_text("SELECT sum(a) AS s FROM disp.t WHERE d >= :start")
    assert catalog.run_query_files(spark, str(tmp_path / "sql"), {"start": dt.date(2024, 1, 1)}, "disp") == ["disp.totals"]
    assert spark.table("disp.totals").first()[0] == 16
    catalog.drop_table(spark, "disp.totals")
    assert not catalog.table_exists(spark, "disp.totals")
    catalog.drop_database(spark, "disp", contents=True)
    assert not catalog.database_exists(spark, "disp")
    with pytest.raises(ValueError):
        catalog.drop_table(spark, "t; DROP TABLE u")


def test_schema_from_fields():
    st = schemas.schema_from_fields([
        {"name": "id", "type": "STRING", "mode": "REQUIRED"}, {"name": "at", "type": "DATETIME"},
        {"name": "items", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "n", "type": "INTEGER"}]}])
    assert st.simpleString() == "struct<id:string,at:timestamp_ntz,items:array<struct<n:bigint>>>"
    assert not st["id"].nullable
    assert schemas.schema_from_fields({"x": "FLOAT"}).simpleString() == "struct<x:double>"
    with pytest.raises(ValueError):
        schemas.schema_from_fields({"x": "GEOGRAPHY"})


def test_parity_of_equal_and_of_shifted_sides(spark):
    names = ["amount", "hour"]
    batch = spark.createDataFrame([("1", 0.5, 10.0, 1), ("2", 0.6, 20.0, 2), ("3", 0.7, 30.0, 3)],
                                  "uniqueId string, score double, amount double, hour long")
    at = dt.datetime(2024, 1, 1)
    later = at + dt.timedelta(hours=1)
    online = spark.createDataFrame(
        [("1", at, at, 0.5, "10.0, 1"), ("2", at, at, 0.1, "0, 0"), ("2", at, later, 0.6, "20.5, 2"), ("9", at, at, 0.9, "1, x")],
        "uniqueId string, timestamp timestamp_ntz, scoreTimestamp timestamp_ntz, score double, featureValuesStr string")
    parsed = PV.parse_features(PV.latest_scores(online, at, later), names)
    joined = PV.full_join(batch, parsed)
    assert joined.count() == 4
    r = PV.join_rates(joined).first()
    assert abs(r[0] - 2 / 3) < 1e-12 and abs(r[1] - 2 / 3) < 1e-12
    rates = [(x["feature"], x["mismatch_rate"]) for x in PV.feature_mismatch(joined, names).collect()]
    assert rates == [("amount", 0.25), ("hour", 0.0)]
    q = PV.score_diff_quantiles(joined).collect()
    assert len(q) == 101 and q[-1]["quantile"] == 0.0
    named = spark.createDataFrame([("a, b",)], "featureNamesStr string")
    assert PV.feature_names(named) == ["a", "b"]


def test_scratch_is_the_named_checkpoint_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = writers.scratch_root(spark)
    assert root and (not named or root == named.rstrip("/"))


def test_broadcast_only_what_was_counted(spark):
    df = spark.range(100)
    assert "broadcast" in writers.broadcast_if_small(df, 100)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in writers.broadcast_if_small(df, 99)._jdf.queryExecution().logical().toString().lower()
