"""A growing table of Parquet files as a streaming source.

The offset of the stream is a position, the (cursor, key) pair of the last row handed
out, and lives in the checkpoint of the query like that of any source: a restart goes
on behind the last finished batch, and a batch that died is read again with the same
bounds.  A batch holds the rows after one position up to another, so rows that share
a cursor value come once, and a row that arrives below the position is not seen
(``poll_late`` finds those).  The key breaks ties; the pair of cursor and key should
tell rows apart.

Every row group that may hold rows of a batch, by its statistics, is one partition of
the batch.  The bounds reach the file reader, and rows stay Arrow batches.  Rows whose
cursor is NULL or NaN, or whose key is NULL, have no position and never come;
``TableWatch`` hands those out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

NAME = "tidemark_table"

Position = dict[str, str | None]
_NOWHERE: Position = {"cursor": None, "key": None}


@dataclass
class _RowGroup(InputPartition):
    path: str
    group: int
    after: Position
    until: Position


class _TableReader(DataSourceStreamReader):
    def __init__(self, path: str, cursor: str, key: str, schema: T.StructType):
        self.path, self.cursor, self.key = path, cursor, key
        self.schema = to_arrow_schema(schema)
        self.last = _NOWHERE

    def initialOffset(self) -> Position:
        return dict(_NOWHERE)

    def latestOffset(self) -> Position:
        """The largest position in the table, never before one given out earlier."""
        best = None
        for fragment, group in self._groups(self._table(self.path)):
            highest = _bound(group, self.cursor, "max")
            if best is not None and highest is not None and highest < best[0]:
                continue
            found = self._highest(fragment.subset(row_group_ids=[group.id]), best)
            best = found if best is None else max(best, found or best)
        if best is not None:
            latest = {name: _text(value, self._kind(c)) for name, c, value in zip(("cursor", "key"), (self.cursor, self.key), best)}
            if self.last["cursor"] is None or best >= self._values(self.last):
                self.last = latest
        return dict(self.last)

    def partitions(self, start: Position, end: Position) -> list[InputPartition]:
        if end["cursor"] is None or start == end:
            return []
        # The offsets of a restarted query come from its checkpoint.
        self.last = dict(end)
        upper, lower = self._values(end)[0], None if start["cursor"] is None else self._values(start)[0]
        found = []
        for fragment, group in self._groups(self._table(self.path)):
            low, high = (_bound(group, self.cursor, side) for side in ("min", "max"))
            if (low is None or low <= upper) and (high is None or lower is None or high >= lower):
                found.append(_RowGroup(fragment.path, group.id, start, end))
        return found

    def read(self, partition: _RowGroup) -> Iterator[pa.RecordBatch]:
        place = self._placed() & ~self._past(partition.until)
        if partition.after["cursor"] is not None:
            place &= self._past(partition.after)
        for fragment in self._table(partition.path).get_fragments():
            rows = fragment.subset(row_group_ids=[partition.group])
            for batch in rows.to_batches(schema=self.schema, columns=self.schema.names, filter=place):
                if batch.num_rows:
                    columns = [batch.column(f.name).cast(f.type) for f in self.schema]
                    yield pa.RecordBatch.from_arrays(columns, schema=self.schema)

    def _table(self, path: str) -> ds.Dataset:
        # Spark writes instants in the older form by default; they are read in its own unit.
        form = ds.ParquetFileFormat(coerce_int96_timestamp_unit="us")
        return ds.dataset(path, schema=self.schema, format=form)

    @staticmethod
    def _groups(table: ds.Dataset) -> Iterator[tuple]:
        for fragment in table.get_fragments():
            for group in fragment.row_groups:
                yield fragment, group

    def _kind(self, column: str) -> pa.DataType:
        return self.schema.field(column).type

    def _value(self, column: str, text: str) -> pa.Scalar:
        return pa.scalar(text).cast(self._kind(column))

    def _values(self, position: Position) -> tuple:
        return tuple(self._value(c, position[n]).as_py() for n, c in (("cursor", self.cursor), ("key", self.key)))

    def _placed(self) -> pc.Expression:
        return ~pc.field(self.cursor).is_null(nan_is_null=True) & pc.field(self.key).is_valid()

    def _past(self, position: Position) -> pc.Expression:
        cursor, key = (self._value(c, position[n]) for n, c in (("cursor", self.cursor), ("key", self.key)))
        return (pc.field(self.cursor) > cursor) | ((pc.field(self.cursor) == cursor) & (pc.field(self.key) > key))

    def _highest(self, rows: ds.Fragment, least: tuple | None) -> tuple | None:
        """The largest position among ``rows``, of those not below the cursor of ``least``."""
        place = self._placed()
        if least is not None:
            place &= pc.field(self.cursor) >= pa.scalar(least[0], self._kind(self.cursor))
        best = None
        for batch in rows.to_batches(schema=self.schema, columns=[self.cursor, self.key], filter=place):
            if batch.num_rows:
                cursor, key = (batch.column(c).cast(self._kind(c)) for c in (self.cursor, self.key))
                top = pc.max(cursor)
                found = (top.as_py(), pc.max(key.filter(pc.equal(cursor, top))).as_py())
                best = found if best is None else max(best, found)
        return best


def _bound(group: object, column: str, side: str) -> object | None:
    """The least or greatest value of a column in a row group, where the file knows it."""
    try:
        return (group.statistics or {}).get(column, {}).get(side)
    except NotImplementedError:  # statistics of the older form of instants
        return None


def _text(value: object, kind: pa.DataType) -> str:
    return pa.scalar(value, kind).cast(pa.string()).as_py()


class TableStream(DataSource):
    """``spark.readStream.format(NAME)`` with the options ``path``, ``cursor`` and ``key`` and a schema."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        raise ValueError("name the schema of the table")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        given = {name: self.options.get(name) for name in ("path", "cursor", "key")}
        missing = [name for name, value in given.items() if not value]
        if missing:
            raise ValueError(f"a table stream needs the options {', '.join(missing)}")
        return _TableReader(**given, schema=schema)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, cursor: str, key: str) -> DataFrame:
    """The rows of the Parquet folder ``path`` as an unbounded table, in batches by (``cursor``, ``key``).

    A query without a pause between batches (``start`` without ``every``) takes one batch a run.
    Files must be visible under the same path to the driver and every executor.
    """
    missing = [c for c in (cursor, key) if c not in schema.fieldNames()]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    spark.dataSource.register(TableStream)
    return spark.readStream.format(NAME).schema(schema).options(path=path, cursor=cursor, key=key).load()
