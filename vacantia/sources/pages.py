"""A data source of landed pages: batch scans in parallel with pushed filters, and a stream of the pages that land later.

A listing is landed in pages of a fixed number of rows in the order of a key, as an interface with offset and limit hands it out. Pages are
numbered Parquet files, a thousand to a folder, and ``pages.json`` has their number and the schema, so that nothing lists
files: a scan is cut into ranges of page numbers, and a task opens its pages by name. Filters that compare a column with a value are
taken over by the scan, which skips a page by its statistics before it reads it; Spark keeps those it can't take.
``scan_pages`` is the way to read: it loads anew for each query.

Cases: null keys come first; equal keys in any order; repeated rows stay; an empty listing has no pages and its
schema; a filter never keeps a null, as in SQL; pages that land again under a number are read as they are then.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from vacantia.storage import importable, written

ROWS = 1000
#: Pages that one task reads.
PAGES = 64

COMPARE = {
    EqualTo: lambda c, v: c == v,
    GreaterThan: lambda c, v: c > v,
    GreaterThanOrEqual: lambda c, v: c >= v,
    LessThan: lambda c, v: c < v,
    LessThanOrEqual: lambda c, v: c <= v,
    In: lambda c, v: c.isin(list(v)),
}


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if ":" in uri else f"file://{uri}")


def _page(path: str, number: int) -> str:
    return f"{path}/block={number // 1000}/page-{number:012d}.parquet"


def _state(path: str) -> dict:
    store, at = _store(f"{path}/pages.json")
    if store.get_file_info(at).type == fs.FileType.NotFound:
        return {"pages": 0}
    with store.open_input_file(at) as f:
        return json.loads(f.read())


def land_pages(df: DataFrame, path: str, key: str, rows: int = ROWS) -> int:
    """Writes the rows in the order of ``key`` as pages after those that are there; the number of all pages."""
    importable(df.sparkSession)
    first = _state(path)["pages"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(n, key).withColumn("_range", F.spark_partition_id()))
    before = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = before.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))  # a row for each range
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    paged = ranged.join(before, "_range").withColumn("_page", F.expr(f"{first}") + F.floor(place / rows)).drop("_range", "_before")

    def write(page: pa.Table) -> pa.Table:
        number = page.column("_page")[0].as_py()
        store, at = _store(_page(path, number))
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(f"{at}.part") as out:
            pq.write_table(page.drop_columns(["_page"]).sort_by([(key, "ascending")]), out)
        store.move(f"{at}.part", at)  # a page is there as a whole or not at all
        return pa.table({"page": [number], "rows": [page.num_rows]})

    last = paged.groupBy("_page").applyInArrow(write, "page long, rows long").agg(F.max("page")).first()[0]
    pages = first if last is None else last + 1
    store, at = _store(f"{path}/pages.json")
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(at) as out:
        out.write(json.dumps({"pages": pages, "schema": json.loads(df.schema.json())}).encode())
    return pages


class Range(InputPartition):
    """Pages from ``low`` on, before ``high``."""

    def __init__(self, low: int, high: int):
        super().__init__((low, high))
        self.low, self.high = low, high


def ranges(low: int, high: int, pages: int) -> list[Range]:
    return [Range(at, min(high, at + pages)) for at in range(low, high, pages)]


def read_range(path: str, part: Range, schema: StructType, condition: ds.Expression | None = None) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(schema)
    for number in range(part.low, part.high):
        store, at = _store(_page(path, number))
        yield from pq.read_table(at, filesystem=store, filters=condition, columns=wanted.names).cast(wanted).to_batches()


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.pages = schema, options["path"], int(options.get("pages", PAGES))
        self.filters: list[tuple] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(f.attribute) == 1 else None
            if column in self.schema.names and (type(f) in COMPARE or type(f) is IsNotNull):
                self.filters.append((type(f), column, getattr(f, "value", None)))
            else:
                yield f

    def condition(self) -> ds.Expression | None:
        parts = [ds.field(c).is_valid() if kind is IsNotNull else COMPARE[kind](ds.field(c), v) for kind, c, v in self.filters]
        return reduce(lambda a, b: a & b, parts) if parts else None

    def partitions(self) -> list[Range]:
        return ranges(0, _state(self.path)["pages"], self.pages) or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(self.path, partition, self.schema, self.condition())


class PagedStreamReader(DataSourceStreamReader):
    """Offsets are numbers of pages."""

    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.pages = schema, options["path"], int(options.get("pages", PAGES))

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": _state(self.path)["pages"]}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return ranges(start["page"], end["page"], self.pages)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return read_range(self.path, partition, self.schema)


class PagedSource(DataSource):
    """``spark.read.format("pages").load(path)`` and ``spark.readStream``; option ``pages``: pages of one task."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> StructType:
        return StructType.fromJson(_state(self.options["path"])["schema"])

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self.options)

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(schema, self.options)


def register_pages(spark: SparkSession) -> None:
    importable(spark)
    spark.dataSource.register(PagedSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def scan_pages(spark: SparkSession, path: str, *conditions: Column | str, **options: object) -> DataFrame:
    """The landed rows that satisfy all conditions.

    Each scan is a frame of its own: Spark 4.1 keeps the filters of the first query on a loaded frame for later ones that push none."""
    register_pages(spark)
    df = spark.read.format("pages").options(**options).load(path)
    for condition in conditions:
        df = df.where(condition)
    return df
