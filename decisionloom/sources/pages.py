"""A paginated scan as a Python data source: points of a store of Parquet files, in pages of a fixed size.

    spark.dataSource.register(Pages)
    spark.read.format("pages").option("path", ...).option("fields", "id,label").option("page", 512).load()

Each row group is a partition and is read once, by the fields that are asked for; its rows come page by page.  Simple comparisons
are pushed to the reader, which leaves out row groups by their statistics and rows by their values.  A page depends on nothing but
its cursor (file, row group, offset), so a page that is read again is the same.  The path must be one that pyarrow opens.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # so that executors need no copy of this package

PAGE = 512
#: What can be pushed: the comparison of a value, and whether a row group of values from low to high can hold one.
PUSHED = {
    EqualTo: (pc.equal, lambda low, high, v: low <= v <= high), GreaterThan: (pc.greater, lambda low, high, v: high > v), GreaterThanOrEqual: (pc.greater_equal, lambda low, high, v: high >= v),
    LessThan: (pc.less, lambda low, high, v: low < v), LessThanOrEqual: (pc.less_equal, lambda low, high, v: low <= v),
}


@dataclass
class Cursor(InputPartition):
    """Where a partition's pages lie."""

    file: str
    group: int

    def __init__(self, file: str, group: int):
        self.file, self.group = file, group


def _opened(path: str) -> tuple[fs.FileSystem, list[str]]:
    """The files of a path, in order."""
    system, inner = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.File:
        return system, [inner]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return system, sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet"))


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def _fields(self) -> list[str] | None:
        return [x.strip() for x in self.options["fields"].split(",")] if self.options.get("fields") else None

    def schema(self) -> StructType:
        system, files = _opened(self.options["path"])
        whole = from_arrow_schema(pq.read_schema(files[0], filesystem=system))
        return StructType([whole[c] for c in self._fields() or whole.names])

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options["path"], schema.names, int(self.options.get("page", PAGE)))


class PageReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], page: int):
        self.path, self.names, self.page, self.filters = path, names, page, []

    def pushFilters(self, filters: list[Filter]):
        """Keep the comparisons of a field of the schema with a value; give back the others."""
        for f in filters:
            simple = type(f) in PUSHED or isinstance(f, In)
            if simple and len(f.attribute) == 1 and f.attribute[0] in self.names and (isinstance(f, In) or f.value is not None):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Cursor]:
        system, files = _opened(self.path)
        out = []
        for file in files:
            with pq.ParquetFile(file, filesystem=system) as f:
                out += [Cursor(file, g) for g in range(f.num_row_groups) if self._may_hold(f.metadata.row_group(g))]
        return out or [Cursor("", -1)]

    def _may_hold(self, group) -> bool:
        """Whether a row group's statistics leave room for what the filters ask for."""
        known = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        for f in self.filters:
            s = known.get(f.attribute[0])
            if type(f) in PUSHED and s is not None and s.has_min_max and not PUSHED[type(f)][1](s.min, s.max, f.value):
                return False
        return True

    def read(self, partition: Cursor):
        if partition.group < 0:
            return
        system, _ = _opened(self.path)
        with pq.ParquetFile(partition.file, filesystem=system) as f:
            for batch in f.iter_batches(self.page, [partition.group], self.names):
                keep = None
                for one in self.filters:
                    column = batch.column(batch.schema.get_field_index(one.attribute[0]))
                    hit = pc.is_in(column, value_set=_values(one.value, column.type)) if isinstance(one, In) else PUSHED[type(one)][0](column, one.value)
                    keep = hit if keep is None else pc.and_(keep, hit)
                page = batch if keep is None else batch.filter(pc.fill_null(keep, False))
                if page.num_rows:
                    yield page.select(self.names)


def _values(values, kind):
    import pyarrow as pa

    return pa.array([v for v in values if v is not None], kind)


def scan(spark: SparkSession, path: str, fields: list[str], page: int = PAGE) -> DataFrame:
    """The points at path by pages; comparisons on fields reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Pages)
    return spark.read.format("pages").option("path", path).option("fields", ",".join(fields)).option("page", page).load()
