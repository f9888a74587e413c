import zipfile

from pyspark.sql import functions as F

from leafmill.functions import geometry, text
from leafmill.sources import scans
from leafmill.storage import table


def test_files(spark, tmp_path):
    (tmp_path / "a.idx").write_bytes("Form   Company      Date\n-----\nARS    Caf\xe9 Co      2020-01-02\n10-K   Other        2020-02-03\n".encode("latin-1"))
    got = scans.patterned(spark, str(tmp_path / "a.idx"), r"^(\S+)\s{2,}(.+?)\s{2,}(\d{4}-\d{2}-\d{2})", ["form", "company", "day"]).collect()
    assert [tuple(r) for r in got] == [("ARS", "Café Co", "2020-01-02"), ("10-K", "Other", "2020-02-03")]
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfname,n\nx,1\n")
    assert scans.csv(spark, str(tmp_path / "b.csv")).columns == ["name", "n"]
    (tmp_path / "c.xml").write_text('<r xmlns:m="urn:m"><m:item><m:id>7</m:id></m:item><m:item><m:id>8</m:id></m:item></r>')
    assert sorted(r["id"] for r in scans.xml(spark, str(tmp_path / "c.xml"), "item", "id long").collect()) == [7, 8]
    with zipfile.ZipFile(tmp_path / "d.zip", "w") as z:
        z.writestr("x/1.pdf", b"%PDF-1")
        z.writestr("x/2.txt", b"no")
    assert [(r["name"], bytes(r["content"])) for r in scans.zip_members(spark, str(tmp_path / "*.zip")).collect()] == [("x/1.pdf", b"%PDF-1")]


def test_merged_and_latest(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k long, v string").write.parquet(str(tmp_path / "1"))
    spark.createDataFrame([(2, 9, True)], "k int, v int, more boolean").write.parquet(str(tmp_path / "2"))
    assert sorted(tuple(r) for r in scans.merged(spark, [str(tmp_path / "1"), str(tmp_path / "2")]).collect()) == [(1, "a"), (2, "9")]
    log = spark.createDataFrame([(1, 1, "open"), (1, 2, "closed"), (2, None, "open")], "run long, seq int, state string")
    assert {r["run"]: r["state"] for r in scans.latest(log, ["run"], ["seq"]).collect()} == {1: "closed", 2: "open"}


def test_ink(spark):
    df = spark.createDataFrame([(bytearray([0, 255, 255, 199]),), (None,), (bytearray(),)], "b binary")
    assert [r[0] for r in df.select(geometry.ink_share("b")).collect()] == [0.5, None, None]
