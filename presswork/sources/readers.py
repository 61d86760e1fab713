"""Sources: connections by address or name, queues, settings, arguments and listed shapes."""

from __future__ import annotations

import argparse
import configparser
from collections.abc import Callable
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[SparkSession, str, dict], DataFrame]


def _files(fmt: str) -> Reader:
    return lambda spark, path, options: spark.read.format(fmt).options(**options).load(path)


def _jdbc(spark: SparkSession, uri: str, options: dict) -> DataFrame:
    """A table by JDBC; the driver's jar must be there. Give column, bounds and partitions to read in parallel."""
    u = urlsplit(uri)
    table = options.pop("table", None) or u.path.strip("/").split("/")[-1]
    base = f"jdbc:{u.scheme}://{u.hostname}:{u.port or 3306}/{u.path.strip('/').split('/')[0]}"
    return spark.read.format("jdbc").options(url=base, dbtable=table, user=unquote(u.username or ""), password=unquote(u.password or ""), **options).load()


#: How tables are read, by scheme. Others may be added.
READERS: dict[str, Reader] = {
    **{f: _files(f) for f in ("parquet", "json", "csv", "orc", "text", "binaryFile")},
    "mysql": _jdbc,
    "mongodb": lambda spark, uri, options: spark.read.format("mongodb").options(**{"connection.uri": uri, **options}).load(),
    "kafka": lambda spark, uri, options: spark.read.format("kafka").options(**{"kafka.bootstrap.servers": urlsplit(uri).netloc.replace("#", ","), "subscribe": urlsplit(uri).path.strip("/"), **options}).load(),
    "table": lambda spark, uri, options: spark.table(urlsplit(uri).netloc + urlsplit(uri).path.replace("/", ".")),
}


def connect(spark: SparkSession, address: str, named: dict[str, str] | None = None, **options: str) -> DataFrame:
    """The table at scheme://rest?options, or at the address that `named` has for a name.

    Files are scheme:///path, as parquet:///data/pages.
    """
    address = (named or {}).get(address, address)
    scheme, mark, rest = address.partition("://")
    if not mark or scheme not in READERS:
        raise ValueError(f"no source for {scheme!r}; there are {', '.join(sorted(READERS))}")
    rest, _, query = rest.partition("?")
    options = dict(parse_qsl(query)) | options
    return READERS[scheme](spark, rest if scheme in ("parquet", "json", "csv", "orc", "text", "binaryFile") else f"{scheme}://{rest}", options)


def decoded_queue(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON messages as rows of the schema; ctime and gtime may be seconds, undecodable messages are null.

    Rows keep the message's other columns.
    """
    parsed = F.from_json(value, schema, {"mode": "PERMISSIVE"})
    out = df.withColumn("_m", parsed)
    names = [c.name for c in out.schema["_m"].dataType.fields]
    rest = [c for c in df.columns if c != value]
    cols = [F.timestamp_seconds(F.col(f"_m.{c}").cast("double")).alias(c) if c in ("ctime", "gtime") and dict(_types(out))[c] in ("bigint", "int", "double") else F.col(f"_m.{c}").alias(c) for c in names]
    return out.select(*rest, *cols)


def _types(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema["_m"].dataType.fields]


def popped(queue: DataFrame, n: int, new_first: bool = True) -> DataFrame:
    """The next n messages of queue(seq, ...): the newest, or the oldest."""
    return queue.orderBy(F.desc("seq") if new_first else F.asc("seq")).limit(n)


def seeds(spark: SparkSession, urls: list[str] | None) -> DataFrame:
    return spark.createDataFrame([(u,) for u in urls or []], "url string")


#: Shapes in which lists of hosts come, by name: a path of fields, or lines of text.
LIST_SHAPES = {
    "nested": ("struct<data:struct<proxy_list:array<string>>>", "data.proxy_list"),
    "data": ("struct<data:array<struct<ip:string,port:string>>>", "data"),
    "result": ("struct<RESULT:array<struct<ip:string,port:string>>>", "RESULT"),
    "array": ("array<struct<ip:string,port:string>>", ""),
}


def listed_hosts(df: DataFrame, shape: str, protocol: str = "http", value: str = "value") -> DataFrame:
    """(protocol, ip, port) from documents of one of LIST_SHAPES, or of lines ip:port ("lines"), each once."""
    if shape == "lines":
        items = F.split(F.trim(value), r"[\r\n]+")
    else:
        schema, path = LIST_SHAPES[shape]
        parsed = F.from_json(value, schema)
        items = parsed if not path else parsed
        for part in path.split("."):
            items = items[part] if part else items
    one = df.select(F.explode(items).alias("x"))
    if dict(one.dtypes)["x"] == "string":
        one = one.select(F.split_part(F.trim("x"), F.lit(":"), F.lit(1)).alias("ip"), F.split_part(F.trim("x"), F.lit(":"), F.lit(2)).alias("port"))
    else:
        one = one.select("x.ip", F.col("x.port").alias("port"))
    return one.select(F.lit(protocol).alias("protocol"), "ip", "port").where("ip <> '' and port <> ''").distinct()


class Settings:
    """An INI file with %(name)s references; comments and order stay when it is written back."""

    def __init__(self, text: str = ""):
        self.lines = text.splitlines()
        self.parser = configparser.ConfigParser()
        self.parser.optionxform = str
        self.parser.read_string(text)

    def get(self, section: str, option: str, default: str | None = None) -> str | None:
        return self.parser.get(section, option, fallback=default)

    def set(self, section: str, option: str, value: str) -> None:
        """Changes the option's line, adds it behind its section, or adds both at the end."""
        if not self.parser.has_section(section):
            self.parser.add_section(section)
            self.lines += ["", f"[{section}]"] if self.lines else [f"[{section}]"]
        self.parser.set(section, option, value)
        here, last = None, len(self.lines)
        for i, line in enumerate(self.lines):
            s = line.strip()
            if s.startswith("[") and s.endswith("]"):
                here = s[1:-1]
            elif here == section and s and s[0] not in "#;":
                name = s.split("=", 1)[0].split(":", 1)[0].strip()
                if name == option:
                    self.lines[i] = f"{option} = {value}"
                    return
            if here == section and s:
                last = i + 1
        self.lines.insert(last, f"{option} = {value}")

    def __str__(self) -> str:
        return "\n".join(self.lines) + "\n"


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="presswork", description="Runs a crawl's plan over tables.")
    p.add_argument("--config", required=True, help="name of the site's settings")
    p.add_argument("--debug", action="store_true", help="runs once and shows the result")
    p.add_argument("--log-level", default="INFO", choices=("DEBUG", "INFO", "WARNING", "ERROR"))
    p.add_argument("--pages", help="address of the pages' table")
    p.add_argument("--sink", help="address to which posts are written")
    return p.parse_args(argv)
