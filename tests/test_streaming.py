"""The stream forms, over files read as streams."""

from pyspark.sql import functions as F

from millrace.operators import conversations
from millrace.streaming import ingest


def drain(df, name, tmp_path, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_clean_and_deduplicate(spark, tmp_path):
    body = "word " * 60
    rows = [(0, body, "2024-01-01 00:00:00"), (1, body, "2024-01-01 00:01:00"), (2, "short", "2024-01-01 00:02:00"), (3, body + "PASSWORD=abcdefgh1", "2024-01-01 00:03:00")]
    spark.createDataFrame(rows, "doc_id long, text string, at string").withColumn("at", F.to_timestamp("at")).write.parquet(f"{tmp_path}/in")
    docs = spark.readStream.schema("doc_id long, text string, at timestamp").parquet(f"{tmp_path}/in")
    got = drain(ingest.first_of_content_stream(ingest.clean_stream(docs), "at"), "clean", tmp_path).collect()
    assert sorted(r.n_redactions for r in got) == [0, 1] and len(got) == 2


def test_counts(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 00:09:00"), ("b", "2024-01-01 00:11:00")], "tool string, at string").withColumn("at", F.to_timestamp("at")).write.parquet(f"{tmp_path}/in")
    events = spark.readStream.schema("tool string, at timestamp").parquet(f"{tmp_path}/in")
    got = {(r.tool, r.n) for r in drain(ingest.tool_counts(events, "at", "tool"), "counts", tmp_path, "complete").collect()}
    assert got == {("a", 2), ("b", 1)}


def test_pairing_agrees_with_the_batch(spark, tmp_path):
    rows = [("s", k, kind, key) for k, (kind, key) in enumerate([("call", "a"), ("output", "a"), ("output", "a"), ("call", "b"), ("call", "b"), ("output", "b"), ("call", None), ("output", None), ("message", "x")])]
    batch = spark.createDataFrame(rows, "session string, pos long, kind string, call_id string")
    batch.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(batch.schema).parquet(f"{tmp_path}/in")
    got = {tuple(r) for r in drain(ingest.pair_calls_stream(stream), "pairs", tmp_path).collect()}
    assert got == {tuple(r) for r in conversations.pair_calls(batch, "session", "pos", "kind", "call_id").collect()}
