from leafmill.storage import table
from leafmill.streaming import attempts


def run(stream, folder, mode):
    name = f"t{abs(hash(str(folder)))}"
    stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(folder)).trigger(availableNow=True).start().awaitTermination(120)
    return stream.sparkSession.table(name)


def source(spark, data, folder):
    table(spark, data, "events").repartition(3).write.parquet(str(folder))
    return spark.readStream.schema(table(spark, data, "events").schema).option("maxFilesPerTrigger", "3").parquet(str(folder))


def test_windows_once_and_sessions(spark, data, tmp_path):
    stream = source(spark, data, tmp_path / "in")
    got = run(attempts.failure_rates(stream), tmp_path / "a", "complete")
    assert got.agg({"n": "sum"}).first()[0] == table(spark, data, "events").count()
    once = run(attempts.once(stream.union(stream), ["event_id"], "60 days"), tmp_path / "b", "append")
    assert once.count() == table(spark, data, "events").count()
    assert run(attempts.sessions(stream), tmp_path / "c", "complete").agg({"n": "sum"}).first()[0] == table(spark, data, "events").count()


def test_stale_attempts(spark, tmp_path):
    rows = [(1, "2025-01-01 00:00:00", "begin"), (1, "2025-01-01 00:10:00", "end"), (2, "2025-01-01 00:00:00", "begin"), (3, "2025-01-01 09:00:00", "begin")]
    late = [(9, "2025-01-01 09:30:00", "end")]
    for k, part in enumerate((rows, late, [(9, "2025-01-01 09:31:00", "end")])):
        df = spark.createDataFrame(part, "doc_id long, ts string, what string").selectExpr("doc_id", "cast(ts as timestamp) as ts", "what")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/k={k}"))
    stream = spark.readStream.schema("doc_id long, ts timestamp, what string").option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = run(attempts.stale(stream, "doc_id", "what = 'begin'", "what = 'end'", 3600), tmp_path / "c", "append")
    assert [r["doc_id"] for r in got.collect()] == [2]
