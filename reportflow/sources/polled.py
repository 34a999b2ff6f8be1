"""A table that is polled (R1, S1, F3): rows after a checkpoint, as a streaming source with offsets.

The original asked its database every few minutes for the rows after its checkpoint. Here the poll is a Spark data source:
an offset is the newest time seen, Spark keeps it in the stream's checkpoint, a batch reads the rows with a time in
(start, end], and a restart goes on where the last finished batch ended. A batch's rows are read in parallel pieces, as Arrow batches.

    spark.dataSource.register(PolledTable)
    spark.readStream.format("polled_table").option("path", ...).option("time_col", "ts").load()

Options: ``time_col``; ``start`` (ISO time; default before all); ``settle`` (seconds that the newest rows are left to a later poll, for
writers that commit out of order; default 0: a row that appears later with a time already polled is missed);
``client`` (``module:factory``, called with the options, for tables other than Parquet; default Parquet files under
``path``, any file system that pyarrow reads). A client has ``schema()`` (Arrow), ``newest()`` (time or None), ``pieces(after, upto)`` (a list of
picklable pieces) and ``read(piece, after, upto)`` (Arrow batches of exactly the rows in that range). Rows with a null time are never polled.
"""

from __future__ import annotations

import importlib
import sys
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

# Spark's planning and task processes get this module along with the source, wherever the driver was started.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH = datetime(1970, 1, 1)


def to_micros(at: datetime | None) -> int | None:
    if at is None:
        return None
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return (at - EPOCH) // timedelta(microseconds=1)


class ParquetClient:
    """Parquet files under a path that grow by new files; pieces are row groups whose statistics reach into the range."""

    def __init__(self, options: dict[str, str]):
        self.time_col = options["time_col"]
        path = options["path"]
        if path.startswith("file:"):   # Hadoop writes one slash, pyarrow wants none or three
            path = "/" + path.removeprefix("file:").lstrip("/")
        self.fs, self.path = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)

    def _data(self) -> ds.Dataset:
        return ds.dataset(self.path, filesystem=self.fs, format="parquet")

    def _in_range(self, schema: pa.Schema, after: int, upto: int) -> pc.Expression:
        type_ = schema.field(self.time_col).type
        bound = lambda micros: pa.scalar(micros, pa.int64()).cast(pa.timestamp("us", type_.tz)).cast(type_)
        return (ds.field(self.time_col) > bound(after)) & (ds.field(self.time_col) <= bound(upto))

    def schema(self) -> pa.Schema:
        return self._data().schema.remove_metadata()

    def newest(self) -> datetime | None:
        """From the row groups' statistics; files without them are read (that column only)."""
        best = None
        for fragment in self._data().get_fragments():
            for group in fragment.row_groups:
                stats = (group.statistics or {}).get(self.time_col)
                top = stats["max"] if stats else pc.max(fragment.subset(row_group_ids=[group.id]).to_table(columns=[self.time_col]).column(0)).as_py()
                best = top if best is None or (top is not None and top > best) else best
        return best

    def pieces(self, after: int, upto: int) -> list[tuple[str, int]]:
        data = self._data()
        found = []
        for fragment in data.get_fragments():
            kept = fragment.subset(self._in_range(data.schema, after, upto), schema=data.schema)
            found += [(fragment.path, group.id) for group in kept.row_groups]
        return found

    def read(self, piece: tuple[str, int], after: int, upto: int) -> Iterator[pa.RecordBatch]:
        path, group = piece
        schema = self.schema()
        fragment = ds.ParquetFileFormat().make_fragment(path, filesystem=self.fs, row_groups=[group])
        for batch in fragment.scanner(schema=schema, filter=self._in_range(schema, after, upto)).to_batches():
            if batch.num_rows:
                yield batch


def client(options: dict[str, str]):
    if "client" not in options:
        return ParquetClient(options)
    module, _, factory = options["client"].partition(":")
    return getattr(importlib.import_module(module), factory)(options)


class Piece(InputPartition):
    def __init__(self, piece, after: int, upto: int):
        self.piece, self.after, self.upto = piece, after, upto


class PolledReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def initialOffset(self) -> dict:
        start = self.options.get("start")
        return {"upto": to_micros(datetime.fromisoformat(start)) if start else to_micros(datetime(1, 1, 1))}

    def latestOffset(self) -> dict:
        newest = to_micros(client(self.options).newest())
        if newest is None:
            return self.initialOffset()
        return {"upto": newest - int(float(self.options.get("settle", 0)) * 1_000_000)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if end["upto"] <= start["upto"]:
            return []
        return [Piece(p, start["upto"], end["upto"]) for p in client(self.options).pieces(start["upto"], end["upto"])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        yield from client(self.options).read(partition.piece, partition.after, partition.upto)

    def commit(self, end: dict) -> None:
        """Nothing to release: the offset is in Spark's checkpoint."""


class PolledTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polled_table"

    def schema(self) -> StructType:
        return from_arrow_schema(client(dict(self.options)).schema(), prefer_timestamp_ntz=True)

    def streamReader(self, schema: StructType) -> PolledReader:
        if "time_col" not in self.options:
            raise ValueError("the polled table needs the option time_col")
        return PolledReader(dict(self.options))
