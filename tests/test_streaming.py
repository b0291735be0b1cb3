"""The streaming forms, on files."""

from pyspark.sql import functions as F

from sparkledger.streaming.triggers import backfill_on_update, backlog_by_state


def test_backfill_on_update(spark, tmp_path):
    children, updates = str(tmp_path / "child"), str(tmp_path / "updates")
    # The table as it is, without any layout of its own.
    spark.createDataFrame([(1, 74, "x")], "party_id long, party_cfd_id int, field_value string").write.parquet(f"{children}/initial")
    spark.createDataFrame([(1,), (2,), (2,), (3,)], "party_id long").write.mode("append").parquet(updates)

    def run(checkpoint="cp"):
        source = spark.readStream.schema("party_id long").parquet(updates)
        query = backfill_on_update(
            source, children, str(tmp_path / checkpoint), "party_id", "party_cfd_id", 74, {"field_value": F.col("party_id").cast("string")}
        )
        query.awaitTermination()
        found = spark.read.option("recursiveFileLookup", "true").parquet(children)
        return sorted((r["party_id"], r["field_value"]) for r in found.collect())

    assert run() == [(1, "x"), (2, "2"), (3, "3")]
    spark.createDataFrame([(3,), (4,)], "party_id long").write.mode("append").parquet(updates)
    assert run() == [(1, "x"), (2, "2"), (3, "3"), (4, "4")]
    # A new checkpoint starts at batch 0 and sees all updates again; nothing is lost or doubled.
    spark.createDataFrame([(5,)], "party_id long").write.mode("append").parquet(updates)
    assert run("other") == [(1, "x"), (2, "2"), (3, "3"), (4, "4"), (5, "5")]


def test_backlog_by_state(spark, tmp_path, data):
    events = spark.read.parquet(f"{data}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    query = (
        backlog_by_state(source, "ts", "event_type", delay="30 days")
        .writeStream.outputMode("complete").format("memory").queryName("backlog").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination()
    got = spark.sql("SELECT event_type, sum(n_rows) AS n FROM backlog GROUP BY event_type").collect()
    expected = events.groupBy("event_type").count().collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in expected}
