"""A source that is asked page by page, from recorded responses: a Python data source for batches and streams.

A response holds the records from one position on, how many records there are in all, and the position of the next. It is a file named by its
first position, its number of records and the latest date in it, so what has to be read is planned from names alone: the chain of
responses from the start, up to the first position that no response begins with or the cap. Each response is read by a task of its own.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition
from pyspark.sql.types import StructType

from noticeweave.operators.durable import durable
from noticeweave.operators.identity import numbered

_NAME = re.compile(r"(\d{12})-(\d{6})-([0-9-]*)\.xml")


@dataclass
class Response(InputPartition):
    """One answer: its records from `position` on, of which `take` are read."""

    uri: str
    position: int
    count: int
    latest: str
    take: int


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def chain(folder: str, start: int = 1, limit: int | None = None) -> list[Response]:
    """The responses that follow each other from a position on: up to a missing or empty one, no more than hold `limit` records."""
    system, path = _folder(folder)
    names = (_NAME.fullmatch(f.base_name) for f in system.get_file_info(pafs.FileSelector(path, allow_not_found=True)))
    there = {int(m[1]): (m[0], int(m[2]), m[3]) for m in names if m}
    out, fetched = [], 0
    while start in there and there[start][1] and (limit is None or fetched < limit):
        name, count, latest = there[start]
        out.append(Response(f"{folder}/{name}", start, count, latest, count if limit is None else min(count, limit - fetched)))
        start, fetched = start + count, fetched + count
    return out


def _records(part: Response, names: list[str], since: str | None, log: str | None) -> Iterator[pa.RecordBatch]:
    """The records of a response as texts by their elements' local names; `position` is their place in the whole."""
    system, path = _folder(part.uri)
    if log:
        asked, where = _folder(log)
        asked.create_dir(where, recursive=True)
        with asked.open_output_stream(f"{where}/{part.position:012d}-{uuid.uuid4().hex}"):
            pass
    with system.open_input_stream(path) as file:
        root = ElementTree.fromstring(file.read())
    rows = []
    for i, record in enumerate([e for e in root.iter() if e.tag.rsplit("}", 1)[-1] == "record"][: part.take]):
        told: dict[str, str] = {}
        for element in record.iter():
            name = element.tag.rsplit("}", 1)[-1]
            if name not in told or not told[name]:
                told[name] = (element.text or "").strip()
        if since is None or told.get("available", "") >= since:
            rows.append([part.position + i if n == "position" else told.get(n, "") for n in names])
    columns = list(zip(*rows)) or [()] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "position" else pa.string()) for n, c in zip(names, columns)], names=names)


class _Batch(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.options, self.since = schema.names, options, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """The date that an earlier run has reached: responses that are older are not asked for, records that are older not returned."""
        for f in filters:
            if isinstance(f, (GreaterThanOrEqual, GreaterThan)) and f.attribute == ("available",):
                self.since = max(self.since or "", str(f.value))
                if isinstance(f, GreaterThanOrEqual):
                    continue
            yield f

    def partitions(self) -> list[Response]:
        limit = self.options.get("limit")
        parts = chain(self.options["path"], int(self.options.get("start", 1)), None if limit is None else int(limit))
        return [p for p in parts if self.since is None or p.latest >= self.since] or [Response("", 0, 0, "", 0)]

    def read(self, partition: Response) -> Iterator[pa.RecordBatch]:
        if partition.uri:
            yield from _records(partition, self.names, self.since, self.options.get("log"))


class _Stream(DataSourceStreamReader):
    """The offset is the next position to ask for, so what was taken in is never asked for again."""

    def __init__(self, schema: StructType, options: dict):
        self.names, self.options = schema.names, options
        self.reached = 0

    def initialOffset(self) -> dict:
        return {"position": int(self.options.get("start", 1))}

    def latestOffset(self) -> dict:
        start = max(self.reached, self.initialOffset()["position"])
        last = chain(self.options["path"], start)
        self.reached = last[-1].position + last[-1].count if last else start
        return {"position": self.reached}

    def partitions(self, start: dict, end: dict) -> list[Response]:
        self.reached = max(self.reached, end["position"])
        return [p for p in chain(self.options["path"], start["position"]) if p.position < end["position"]]

    def read(self, partition: Response) -> Iterator[pa.RecordBatch]:
        yield from _records(partition, self.names, None, self.options.get("log"))


class PagedSource(DataSource):
    """Format `recorded_pages` with options path (a URI), start, limit (for batches) and log (a folder that gets a file for each request)."""

    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return "position long, id string, kind string, subject string, available string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Batch(schema, self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Stream(schema, self.options)


def _prepared(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
    return spark


def paged(spark: SparkSession, folder: str, limit: int | None = None, since: str | None = None, log: str | None = None) -> DataFrame:
    """All records of recorded responses, or the first `limit`, and only those available since a date."""
    options = {"path": folder} | ({} if limit is None else {"limit": str(limit)}) | ({"log": log} if log else {})
    rows = _prepared(spark).read.format("recorded_pages").options(**options).load()
    return rows if since is None else rows.where(F.col("available") >= since)


def paged_stream(spark: SparkSession, folder: str, log: str | None = None) -> DataFrame:
    """A stream of the records; a query that starts again with its checkpoint goes on behind the last position that it took in."""
    options = {"path": folder} | ({"log": log} if log else {})
    return _prepared(spark).readStream.format("recorded_pages").options(**options).load()


def record_responses(rows: DataFrame, folder: str, chunk: int, order: str, start: int = 1) -> int:
    """Records rows as responses of `chunk` records each in the order of a column (values that differ): their columns become elements, `available` holds
    the date. `start` is the first one's position. Returns the number of records. Responses are written by tasks; one that runs again writes
    the same file."""
    placed = numbered(rows, order, "__n", "", 1).withColumn("__n", F.col("__n").cast("long") - 1)
    escaped = lambda c: F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    fields = F.concat(*[F.concat(F.lit(f"<{c}>"), escaped(c), F.lit(f"</{c}>")) for c in rows.columns])
    placed = durable(placed.select("__n", F.concat(F.lit("<record>"), fields, F.lit("</record>")).alias("record"), F.col("available").cast("string").alias("available")), "recorded")
    total = placed.count()
    pages = placed.groupBy(F.floor(F.col("__n") / chunk).alias("page")).agg(F.array_sort(F.collect_list(F.struct("__n", "record"))).alias("all"), F.max("available").alias("latest"), F.count("*").alias("n"))  # `chunk` records
    body = F.concat(F.lit(f"<response><numberOfRecords>{total}</numberOfRecords><records>"), F.array_join(F.transform("all", lambda x: x["record"]), ""), F.lit("</records></response>"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _folder(folder)
        system.create_dir(path, recursive=True)
        for batch in batches:
            for position, n, latest, xml in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"{position:012d}-{n:06d}-{latest or ''}.xml"
                with system.open_output_stream(f"{path}/.{name}") as file:
                    file.write(xml.encode())
                system.move(f"{path}/.{name}", f"{path}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    pages.select((F.col("page") * chunk + start).cast("long").alias("position"), "n", "latest", body.alias("xml")).mapInArrow(write, "n long").count()
    return total
