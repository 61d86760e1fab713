"""The queue source: order, commits, failed and repeated writes, streams over restarts."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from presswork.sources import queues
from presswork.streaming import streams


def values(spark, low, high, parts=3):
    return spark.range(low, high, 1, parts).select(F.col("id").cast("string").alias("value"))


def read(df):
    return [int(r.value) for r in sorted(df.collect(), key=lambda r: r.seq)]


def test_newest_and_oldest_first(spark, tmp_path):
    q = f"{tmp_path}/q"
    queues.push(values(spark, 0, 10), q)
    queues.push(values(spark, 10, 15), q)
    assert read(queues.messages(spark, q)) == list(range(15))
    assert read(queues.pop(spark, q, 7)) == list(range(8, 15))
    assert read(queues.pop(spark, q, 2, newest=False)) == [0, 1]
    queues.push(values(spark, 20, 22), q)
    assert read(queues.messages(spark, q)) == [2, 3, 4, 5, 6, 7, 20, 21]
    assert read(queues.pop(spark, q, 3)) == [7, 20, 21] and read(queues.pop(spark, q, 99)) == [2, 3, 4, 5, 6]
    assert read(queues.pop(spark, q, 1)) == [] and queues.messages(spark, q).count() == 0
    assert queues.swept(q, -1) > 0 and os.listdir(f"{q}/data") == []


def test_a_failed_job_leaves_nothing_and_a_retried_task_nothing_twice(spark, tmp_path):
    q = f"{tmp_path}/q"
    queues.push(values(spark, 0, 4), q)
    with pytest.raises(Exception, match="by zero|DIVIDE_BY_ZERO"):
        queues.push(values(spark, 0, 30).select((F.lit(1) / (F.col("value").cast("int") - 29)).cast("string").alias("value")), q)
    assert read(queues.messages(spark, q)) == [0, 1, 2, 3]
    message = queues._write(f"{q}", iter(values(spark, 5, 6, 1).toArrow().to_batches()))  # of an attempt that was lost after it wrote
    assert message.files and read(queues.messages(spark, q)) == [0, 1, 2, 3]


def test_poppers_and_pushers_at_once(spark, tmp_path):
    q = f"{tmp_path}/q"
    queues.push(values(spark, 0, 40), q)
    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(lambda: read(queues.pop(spark, q, 6))) for _ in range(4)] + [pool.submit(queues.push, values(spark, 100 * k, 100 * k + 5), q) for k in (1, 2)]
        got = [x for j in jobs[:4] for x in j.result()]
        [j.result() for j in jobs]
    assert len(got) == len(set(got)) == 24
    assert sorted(got + read(queues.messages(spark, q))) == [*range(40), *range(100, 105), *range(200, 205)]


def test_streams_go_on_where_they_stopped(spark, tmp_path):
    q, out = f"{tmp_path}/q", []
    queues.push(values(spark, 0, 6), q)
    for low, high in ((6, 9), (9, 9), (9, 12)):
        streams.run_available(spark.readStream.format("queue").load(q), lambda b, _: out.extend(r.value for r in b.collect()), f"{tmp_path}/c")
        if low < high:
            queues.push(values(spark, low, high), q)
    assert [int(x) for x in out] == list(range(9))


def test_a_stream_is_written_once(spark, tmp_path):
    q = f"{tmp_path}/q"
    queues.register(spark)
    values(spark, 0, 5).write.parquet(f"{tmp_path}/in")
    for k in range(3):
        stream = spark.readStream.schema("value string").parquet(f"{tmp_path}/in")
        w = stream.writeStream.format("queue").option("writer", "w").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(q)
        assert w.awaitTermination(120)
        if k == 1:
            values(spark, 5, 8).write.mode("append").parquet(f"{tmp_path}/in")
    assert sorted(read(queues.messages(spark, q))) == list(range(8))
    log = queues.Log(q)
    again = queues._StreamWriter(log, "w")
    message = again.write(iter(values(spark, 50, 52, 1).toArrow().to_batches()))
    again.commit([message], log.read().batches["w"])  # a batch that was in when the driver died
    assert sorted(read(queues.messages(spark, q))) == list(range(8)) and not os.path.exists(f"{q}/data/{message.files[0][0]}")


def test_odd_tables(spark, tmp_path):
    q = f"{tmp_path}/q"
    queues.push(values(spark, 0, 0), q)
    assert queues.messages(spark, q).count() == 0
    queues.push(spark.createDataFrame([(None, 1), ("x" * 100_000, 2), ("", 3)], "value string, seq long"), q)
    assert sorted((r.value or "-")[:2] for r in queues.messages(spark, q).collect()) == ["-", "-", "xx"]
    with pytest.raises(Exception, match="named value"):
        spark.range(1).write.format("queue").mode("append").save(q)
    with pytest.raises(ValueError, match="mounted"):
        queues.Log("s3://b/q")
