"""Files of binary records of one length, as a data source.

Splits begin and end on record boundaries, and a task hands its bytes on as Arrow batches: one buffer
with a length, no work per record.  Files are opened by pyarrow, in any store that it knows by URI.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from cardledger.session import configure

#: Bytes of a split and of an Arrow batch, before they are rounded to whole records.
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
_SCHEMA = pa.schema([("record", pa.binary())])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


@dataclass
class _Split(InputPartition):
    path: str
    begin: int  # record numbers
    end: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self._path, self._length = options["path"], int(options["length"])
        self._each = max(1, int(options.get("split_bytes", SPLIT_BYTES)) // self._length)

    def partitions(self) -> list[_Split]:
        store, path = _open(self._path)
        root = store.get_file_info(path)
        files = [root] if root.is_file else store.get_file_info(fs.FileSelector(path))
        out = []
        for file in files:
            if not file.is_file or file.base_name.startswith(("_", ".")):
                continue
            records, rest = divmod(file.size, self._length)
            if rest:
                raise ValueError(f"{file.path}: {rest} bytes behind the last record of {self._length} bytes")
            out += [_Split(file.path, b, min(b + self._each, records)) for b in range(0, records, self._each)]
        return out or [_Split("", 0, 0)]

    def read(self, part: _Split) -> Iterator[pa.RecordBatch]:
        if part.begin == part.end:
            return
        store, _ = _open(self._path)
        step = max(1, BATCH_BYTES // self._length)
        with store.open_input_file(part.path) as file:
            for begin in range(part.begin, part.end, step):
                n = min(step, part.end - begin)
                file.seek(begin * self._length)
                data = file.read_buffer(n * self._length)
                records = pa.FixedSizeBinaryArray.from_buffers(pa.binary(self._length), n, [None, data])
                yield pa.RecordBatch.from_arrays([records.cast(pa.binary())], schema=_SCHEMA)


@dataclass
class _Written(WriterCommitMessage):
    path: str


class _Writer(DataSourceArrowWriter):
    """Every task writes a hidden file; the driver shows those of the tasks that count."""

    def __init__(self, options: dict) -> None:
        self._path, self._length = options["path"], int(options["length"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, path = _open(self._path)
        store.create_dir(path)
        name = f"{path}/.part-{uuid.uuid4().hex}"
        with store.open_output_stream(name) as out:
            for batch in iterator:
                # A record of another length, or none, is an error of the cast.
                column = batch.column(0).cast(pa.binary()).cast(pa.binary(self._length))
                if column.null_count:
                    raise ValueError("a null is no record")
                for at in range(0, len(column), 8192):
                    out.write(b"".join(column.slice(at, 8192).to_pylist()))
        return _Written(name)

    def commit(self, messages: list) -> None:
        store, _ = _open(self._path)
        for m in messages:
            if m is not None:
                folder, name = m.path.rsplit("/", 1)
                store.move(m.path, f"{folder}/{name[1:]}.bin")

    def abort(self, messages: list) -> None:
        store, _ = _open(self._path)
        for m in messages:
            if m is not None:
                store.delete_file(m.path)


class BinaryRecords(DataSource):
    """``binary_records``: options ``path`` and ``length``; one column ``record``."""

    @classmethod
    def name(cls) -> str:
        return "binary_records"

    def schema(self) -> str:
        return "record binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def scan_binary(spark: SparkSession, path: str, record_length: int, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Binary records of fixed length of a file or folder, one ``record`` (bytes) per row."""
    configure(spark).dataSource.register(BinaryRecords)
    source = spark.read.format("binary_records").option("length", record_length).option("split_bytes", split_bytes)
    return source.load(path)


def write_binary(df: DataFrame, path: str, record_length: int) -> None:
    """Write column ``record`` as files of records without anything between them."""
    configure(df.sparkSession).dataSource.register(BinaryRecords)
    rows = df.select("record").write.format("binary_records").option("length", record_length)
    rows.mode("append").save(path)
