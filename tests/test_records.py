from datetime import date

from pyspark.sql import functions as F

from leafmill.functions import records as r


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_fields(spark):
    lit = F.lit
    assert one(spark, r.https(lit("http://a/b")), r.decade(lit("1974-12")), r.decade(lit("x1974")), r.page_file(lit(7)), r.whole_number(lit(" 12 ")), r.whole_number(lit("1x"))) == ("https://a/b", "1970s", "undated", "00007.pdf", 12, None)
    assert one(spark, r.page_ranges(lit("0-2, 9,x,5-3")), r.first_text(F.array(lit(None), lit(" "), lit("a")))) == ([0, 1, 2, 9], "a")
    assert one(spark, r.strict_date(lit("2024-02-29")), r.strict_date(lit("2023-02-29")), r.strict_date(lit("2024-2-1"))) == (date(2024, 2, 29), None, None)
    got = one(spark, r.stamp(lit("01/03/2024 08:00")), r.stamp(lit("Mar 5, 2024")), r.stamp(lit("soon")))
    assert got[0] and got[1] and got[2] is None
    assert spark.range(1).select(F.date_format(r.stamp(lit("01/03/2024 08:00")), "yyyy-MM-dd HH:mm")).first()[0] == "2024-03-01 00:00"
    title = one(spark, r.labelled_title(lit("Aspirin 100 [ACME] ")), r.labelled_title(lit("Aspirin")))
    assert [tuple(t) for t in title] == [("Aspirin 100", "ACME"), ("Aspirin", None)]
    assert one(spark, r.role_score(lit("Public Notes.pdf"), {"public": 30, "notes": -100, "primary": 50})) == (-70,)


def test_addresses_and_outcomes(spark):
    urls = ["https://a.example/x", "https://b.a.example/x", "http://a.example/x", "https://aa.example/x", "no", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [x[0] for x in df.select(r.allowed(F.col("u"), ["a.example"])).collect()] == [True, True, False, False, False, False]
    cases = [(200, "application/pdf", False, "ok"), (200, "text/html", None, "permanent"), (404, None, False, "permanent"), (503, None, False, "transient"), (200, "text/html", True, "transient"), (None, None, None, "transient")]
    df = spark.createDataFrame(cases, "s int, c string, r boolean, want string")
    assert all(x["want"] == x["got"] for x in df.select("want", r.fetch_outcome(F.col("s"), F.col("c"), F.col("r")).alias("got")).collect())


def test_texts_in_python(spark):
    df = spark.createDataFrame([("é <b>&eacute;</b>",), (None,), ("((a) OR (b))",)], "t string")
    rows = df.select(r.nfc("t").alias("n"), r.unescaped("t").alias("u"), r.blake_order("t").alias("b"), r.plain_query("t").alias("q")).collect()
    assert rows[0]["n"].startswith("é ") and rows[0]["u"] == "é é" and len(rows[0]["b"]) == 16 and tuple(rows[1]) == (None,) * 4 and rows[2]["q"] == "(a) or (b)"
