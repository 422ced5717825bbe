"""Streams over files."""

from pyspark.sql import functions as F

from corpusloom.sources import captures
from corpusloom.streaming import ingest


def test_replace_by_key_in_batches(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "k long, at long, v string"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    write([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")])
    for rows in (None, [(2, 3, "d"), (3, 1, "e")], [(1, 1, "late"), (3, 1, "again")]):
        if rows:
            write(rows)
        stream = ingest.new_files(spark, source, spark.createDataFrame([], schema).schema)
        query = stream.writeStream.foreachBatch(ingest.replace_partitions(root, "k", "at", 4)).option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start()
        query.awaitTermination()
    table = ingest.read_table(spark, root)
    assert sorted((r.k, r.v) for r in table.collect()) == [(1, "c"), (2, "d"), (3, "again")]


def test_windowed_counts_of_a_stream(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = ingest.event_counts(ingest.new_files(spark, str(tmp_path / "in"), events.schema))
    query = stream.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("counted").agg(F.sum("n")).first()[0] == events.count()


def test_capture_payloads(spark, tmp_path):
    for name, text in {"a": '{"html": "", "TextoNorma": "x"}', "b": '{"html": null}', "c": '{"TextoNorma": "y"}', "d": '{"TextoNorma": ""}', "e": "{"}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = {r.path[-6]: (r.html, r.problem) for r in captures.captures(spark, str(tmp_path)).collect()}
    assert got == {"a": ("", None), "b": ("null", None), "c": ("y", None), "d": (None, "payload"), "e": (None, "json")}
    names = captures.files(spark, str(tmp_path), without=("a.json",))
    assert sorted(r.name for r in names.collect()) == ["b.json", "c.json", "d.json", "e.json"]


def test_batches_are_kept_once_and_old_folders_go(spark, tmp_path):
    root = f"file://{tmp_path}/table"
    write = ingest.replace_partitions(root, "k", "at", 3)
    assert ingest.read_table(spark, root) is None
    frame = lambda *rows: spark.createDataFrame(list(rows), "k long, at long, v string")
    for number in range(8):
        write(frame((number % 3, number, f"v{number}"), (99, number, "same")), number)
        write(frame((99, 1000, "twice")), number)  # the same batch again does nothing
    assert sorted(map(tuple, ingest.read_table(spark, root).collect())) == [(0, 6, "v6"), (1, 7, "v7"), (2, 5, "v5"), (99, 7, "same")]
    write(frame().limit(0), 8)
    assert len(list((tmp_path / "table" / "data").iterdir())) <= 2 + ingest.KEPT * 2 and ingest.read_table(spark, root).count() == 4


def test_events_that_come_again_count_once(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:01:00", "a"), (2, "2024-01-01 00:02:00", "b")]
    spark.createDataFrame(rows, "event_id long, ts string, event_type string").selectExpr("event_id", "cast(ts as timestamp_ntz) as ts", "event_type").write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = ingest.distinct_events(ingest.new_files(spark, str(tmp_path / "in"), schema), "event_id")
    stream.writeStream.format("memory").queryName("once").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.event_id for r in spark.table("once").collect()) == [1, 2]
