"""Sinks by the scheme of an address, logs that keep what is latest, and JSON rows."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.operators.crawl import keep_latest
from presswork.sources import queues

Writer = Callable[[DataFrame, str, dict], None]


def as_json(df: DataFrame) -> DataFrame:
    """One column `value`: each row as JSON, nulls left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def log_rows(df: DataFrame, level: str = "INFO", **extra: str) -> DataFrame:
    """`value`: each row's message as a JSON log record, with level and fixed fields."""
    return df.select(F.to_json(F.struct(F.col("message").alias("_message"), F.lit(level).alias("_levelname"), *[F.lit(v).alias(k) for k, v in sorted(extra.items())])).alias("value"))


def _files(fmt: str) -> Writer:
    def write(df: DataFrame, uri: str, options: dict) -> None:
        mode = options.pop("mode", "append")
        df.write.format(fmt).mode(mode).options(**options).save(uri.split("://", 1)[1])

    return write


def _jdbc(df: DataFrame, uri: str, options: dict) -> None:
    u = urlsplit(uri)
    db, _, table = u.path.strip("/").partition("/")
    df.write.format("jdbc").mode("append").options(url=f"jdbc:{u.scheme}://{u.hostname}:{u.port or 3306}/{db}", dbtable=options.pop("table", table), user=unquote(u.username or ""), password=unquote(u.password or ""), **options).save()


def _kafka(df: DataFrame, uri: str, options: dict) -> None:
    u = urlsplit(uri)
    as_json(df).write.format("kafka").options(**{"kafka.bootstrap.servers": u.netloc.replace("#", ","), "topic": u.path.strip("/"), "kafka.acks": "all", "kafka.batch.size": "262144", "kafka.linger.ms": "15", **options}).save()


def _queue(df: DataFrame, uri: str, options: dict) -> None:
    """A queue of JSON messages in the folder that the address or `path` names; one commit has all rows."""
    queues.push(as_json(df), options.get("path") or urlsplit(uri).path)


#: How posts are written, by scheme. A scheme that is None takes nothing.
WRITERS: dict[str, Writer | None] = {
    **{f: _files(f) for f in ("parquet", "json", "csv", "orc")},
    "mysql": _jdbc,
    "mongodb": lambda df, uri, options: df.write.format("mongodb").mode("append").options(**{"connection.uri": uri, **options}).save(),
    "kafka": _kafka,
    "redis": _queue,
    "rocketmq": _queue,
    "zmq": None,
}


def sink_for(uri: str) -> tuple[str, Writer | None]:
    """The scheme of an address, without underscores, and its writer; raises for one that isn't known."""
    scheme = urlsplit(uri.replace("_", "", 1) if "_" in uri.split("://")[0] else uri).scheme
    if scheme not in WRITERS:
        raise ValueError(f"no sink for {scheme!r}; there are {', '.join(sorted(WRITERS))}")
    return scheme, WRITERS[scheme]


def send(df: DataFrame, uri: str, **options: str) -> bool:
    """Writes all rows; says whether the scheme takes any."""
    _, write = sink_for(uri)
    if write is None:
        return False
    write(df, uri, options)
    return True


def to_batches(uri: str, **options: str) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch that sends each micro-batch."""
    return lambda df, _: send(df, uri, **options) and None


def run_log(log: DataFrame, new: DataFrame, n: int = 1000) -> DataFrame:
    """The log with new rows, the latest n a config."""
    return keep_latest(log.unionByName(new, allowMissingColumns=True), "config_id", "end_time", n)


def monitor_log(log: DataFrame, new: DataFrame, most: int = 100_000, keep: bool = False) -> DataFrame:
    """The log with new rows; one that has grown beyond `most` starts anew, or keeps its latest rows."""
    if log.limit(most + 1).count() <= most:
        return log.unionByName(new, allowMissingColumns=True)
    return new if not keep else log.orderBy(F.desc("seq")).limit(most).unionByName(new, allowMissingColumns=True)
