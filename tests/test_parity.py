"""Score events that list their features in an order of their own, and tables made with a layout."""

from pyspark.sql import functions as F

from txnlens.operators import parity as PV
from txnlens.sources import catalog, writers


def test_values_belong_to_the_names_of_the_event(spark):
    rows = [("t1", 0.5, "a, b, c", "1.0, 2.0, 3.0"), ("t2", 0.6, "c, a, b", "3.5, 1.5, 2.5"), ("t3", 0.7, "b, x", "2.0, 9.0"),
            ("t4", 0.8, None, "1.0, 2.0"), ("t5", 0.9, "a, b, c", "1.0, , oops")]
    df = spark.createDataFrame(rows, "uniqueId string, score double, featureNamesStr string, featureValuesStr string")
    got = {r["uniqueId"]: (r["a_df"], r["b_df"], r["c_df"]) for r in PV.parse_features(df, ["a", "b", "c"]).collect()}
    assert got == {"t1": (1.0, 2.0, 3.0), "t2": (1.5, 2.5, 3.5), "t3": (None, 2.0, None), "t4": (1.0, 2.0, None),
                   "t5": (1.0, None, None)}
    by_place = PV.parse_features(df.drop("featureNamesStr").where("uniqueId = 't2'"), ["a", "b", "c"]).first()
    assert (by_place["a_df"], by_place["c_df"]) == (3.5, 2.5)


def test_table_made_with_a_layout_keeps_it(spark):
    name = "layout_kept"
    catalog.drop_table(spark, name)
    rows = spark.range(0, 60, 1, 3).select((F.col("id") % 2).alias("day"), (59 - F.col("id")).alias("k"), F.lit("x").alias("v"))
    catalog.create_table(spark, name, rows.schema, partition_by=["day"], cluster_by=["k"])
    assert spark.table(name).isEmpty() and writers.clustering(spark, name) == ["k"]
    writers.write_table(rows, name, "EMPTY")
    writers.write_table(rows.withColumn("k", F.col("k") + 100), name, "APPEND")
    assert spark.table(name).count() == 120 and writers.clustering(spark, name) == ["k"]
    files = spark.table(name).select("day", "k", F.input_file_name().alias("f")).groupBy("f").agg(
        F.count_distinct("day").alias("days"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()
    assert all(r["days"] == 1 for r in files)  # a file lies in one partition
    catalog.drop_table(spark, name)
