import datetime as dt

from millrace.operators import dedup
from millrace.streaming import jobs

SCHEMA = "id string, repository string, pull_number bigint, event_type string, created_at timestamp, ingested_at timestamp"


def _write(spark, path, lo, hi):
    t = dt.datetime(2025, 1, 1)
    data = [(f"evt-{i % 40}", "A/b", i % 2, "E", t + dt.timedelta(minutes=7 * (i % 40)), t + dt.timedelta(minutes=i)) for i in range(lo, hi)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    _write(spark, src, 0, 50)
    schema = spark.read.parquet(src).schema
    run = lambda: jobs.run_once(jobs.distinct_messages(jobs.event_stream(spark, src, schema)), str(tmp_path / "out"), str(tmp_path / "cp"))
    run()
    _write(spark, src, 50, 100)
    run()
    got = spark.read.parquet(str(tmp_path / "out")).count()
    assert got == dedup.message_counts(spark.read.parquet(src)).count()


def test_hours_and_shards(spark, tmp_path):
    src = str(tmp_path / "in")
    _write(spark, src, 0, 60)
    stream = jobs.event_stream(spark, src, spark.read.parquet(src).schema)
    jobs.run_once(jobs.hourly_counts(stream, "0 seconds"), str(tmp_path / "h"), str(tmp_path / "c1"))
    jobs.run_once(jobs.hourly_counts(stream, "0 seconds"), str(tmp_path / "h"), str(tmp_path / "c1"))
    done = spark.read.parquet(str(tmp_path / "h"))
    assert done.count() >= 1 and done.agg({"n": "sum"}).first()[0] <= 60
    jobs.shards_once(stream, str(tmp_path / "s"), str(tmp_path / "c2"))
    jobs.shards_once(stream, str(tmp_path / "s"), str(tmp_path / "c2"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 60


def test_ttl_stream_equals_the_batch_walk(spark, tmp_path):
    from millrace.operators import cache

    src, t = str(tmp_path / "in"), dt.datetime(2025, 1, 1)
    data = [("ab"[i % 2], i, t + dt.timedelta(seconds=13 * i)) for i in range(60)]
    df = spark.createDataFrame(data, "key string, id bigint, at timestamp")
    df.where("id < 30").coalesce(1).write.parquet(src)
    stream = lambda: jobs.ttl_stream(jobs.event_stream(spark, src, df.schema), 100)
    jobs.run_once(stream(), str(tmp_path / "o"), str(tmp_path / "c"))
    df.where("id >= 30").coalesce(1).write.mode("append").parquet(src)
    jobs.run_once(stream(), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {r["id"]: r["hit"] for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    walked = cache.ttl_hits(df.selectExpr("key", "unix_micros(at) AS at", "id"), 100)
    assert got == {r["id"]: r["hit"] for r in walked.collect()}


def test_budgets_and_what_was_delivered(spark, tmp_path):
    src = str(tmp_path / "in")
    _write(spark, src, 0, 60)
    batch = spark.read.parquet(src)
    old = batch.where("id = 'evt-3'")
    assert jobs.unseen(batch, old).count() == dedup.message_counts(batch).count() - dedup.message_counts(old).count()
    assert jobs.unseen(batch, batch).count() == 0
    stream = jobs.spending_by_day(jobs.event_stream(spark, src, batch.schema), "created_at", "pull_number", "0 seconds")
    jobs.run_once(stream, str(tmp_path / "o"), str(tmp_path / "c"))
    assert set(spark.read.parquet(str(tmp_path / "o")).columns) == {"day", "spent"}
    assert jobs.progress_rows([{"batchId": 1, "numInputRows": 5}]) == [(1, 5, 0.0)]
