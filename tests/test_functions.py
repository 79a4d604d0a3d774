import datetime as dt

from pyspark.sql import functions as F

from shoplens.functions import expr as X


def test_ids_csv(spark):
    df = spark.createDataFrame([("1,1,2",), ("7",), (None,)], "c string")
    got = [r[0] for r in df.select(X.ids_from_csv("c")).collect()]
    assert got == [[1, 1, 2], [7], None]
    exploded = df.select(F.explode(X.ids_from_csv("c")).alias("id")).groupBy("id").count()
    assert {r.id: r["count"] for r in exploded.collect()} == {1: 2, 2: 1, 7: 1}


def test_group_concat_distinct_skips_nulls(spark):
    df = spark.createDataFrame([("a", "1:X"), ("a", "11:X"), ("a", "1:X"), ("a", None)],
                               "g string, v string")
    # sorted by bytes: "11:X" < "1:X" because "1" < ":"
    assert df.groupBy("g").agg(X.group_concat_distinct("v").alias("s")).first().s == "11:X,1:X"


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), 1.005, 7, None, "")],
                               "t timestamp, x double, n int, s string, e string")
    r = df.select(
        X.date_hour("t").alias("dh"), X.format_date("t").alias("d"), X.format_time("t").alias("ft"),
        X.date_key("t").alias("dk"), X.minute_key("t").alias("mk"),
        X.round_half_up("x", 2).alias("r"), X.pad2("n").alias("p"),
        X.is_empty("s").alias("e1"), X.is_empty("e").alias("e2"), X.is_not_empty("n").alias("e3"),
        X.concat_long_string("n", F.lit("X")).alias("c"),
        X.before("t", F.lit("2024-01-03").cast("timestamp")).alias("b"),
        X.after("t", F.lit("2024-01-03").cast("timestamp")).alias("a"),
        X.format_date(X.parse_date_key(F.lit("20240102"))).alias("pk"),
        X.seconds_between(F.lit("2024-01-02 03:00:00").cast("timestamp"), "t").alias("sec"),
    ).first()
    assert (r.dh, r.d, r.ft, r.dk, r.mk) == ("2024-01-02_03", "2024-01-02", "2024-01-02 03:04:05",
                                             "20240102", "202401020304")
    assert r.r == 1.01 and r.p == "07" and r.e1 and r.e2 and r.e3 and r.c == "7:X"
    assert r.b and not r.a and r.pk == "2024-01-02" and r.sec == 245
    parts = df.select(*X.minute_key_parts(X.minute_key("t"))).first()
    assert tuple(parts) == ("20240102", "03", "04")


def test_today_and_yesterday(spark):
    r = spark.range(1).select(X.today().alias("t"), X.yesterday().alias("y")).first()
    assert r.t - r.y == dt.timedelta(days=1)


def test_area_level_parameter(spark):
    df = spark.createDataFrame([("华北",), ("东北",), ("EUROPE",)], "a string")
    assert [r[0] for r in df.select(X.area_level("a")).collect()] == \
        ["A_Level", "D_Level", "D_Level"]
    assert [r[0] for r in df.select(X.area_level("a", {"EUROPE": "A_Level"})).collect()] == \
        ["D_Level", "D_Level", "A_Level"]
