"""Bulk files as a sink of batches and streams, ``format("bulk")``.

Rows are dealt so that one task holds all requests of a file. The tasks write under ``_temporary``; the commit on the driver moves the files
in place. A file is named by its shard, its part of the log and its batch, never by its task, so a batch that is run again after a
failure replaces what the first run left: no request stands in two files. Folders are reached through ``pyarrow.fs``.

A batch's files stand in the folder itself. A micro-batch has a folder ``batch_id=...``; it is complete once ``_committed`` has its
number, and a micro-batch that is there is not written again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from changeflow.functions.numbers import floor_div
from changeflow.functions.positions import log_seq
from changeflow.operators.bulk import DEFAULT_BULK_SIZE, DEFAULT_SHARDS, bulk_size_or_default, shard_of
from changeflow.operators.mapping import bulk_line

#: Bytes of a log file whose requests share a file per shard. This bounds what a task sorts, whatever the size of the log file.
PART_BYTES = 1 << 30

FILE_KEY = ("shard", "server_id", "log_seq", "log_part")
ORDER = (*FILE_KEY, "log_pos", "row_ordinal")
COLUMNS = (*ORDER, "line")
_DIGITS = (5, 19, 10, 9)


def bulk_rows(requests: DataFrame, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Requests as the sink takes them: their lines, dealt by file. A batch is sorted too; of a stream each task sorts its own part of
    the micro-batch, which ``maxFilesPerTrigger`` and the like bound."""
    line = bulk_line(*(F.col(c) for c in ("action", "index", "id", "parent", "pipeline", "data")))
    number = {"shard": shard_of(shards), "server_id": F.coalesce("server_id", F.lit(-1)), "log_seq": log_seq(F.col("log_name")),
              "log_part": F.coalesce(floor_div(F.col("log_pos"), PART_BYTES), F.lit(0)), "log_pos": F.coalesce("log_pos", F.lit(0)),
              "row_ordinal": F.coalesce("row_ordinal", F.lit(0))}
    rows = requests.select(*(c.cast("bigint").alias(n) for n, c in number.items()), line.alias("line")).repartition(*FILE_KEY)
    return rows if requests.isStreaming else rows.sortWithinPartitions(*ORDER)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkFiles)


class Folder:
    """A folder on any file system that pyarrow reaches."""

    def __init__(self, path: str):
        uri = path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path
        self.system, self.root = fs.FileSystem.from_uri(uri)

    def at(self, *names: str) -> str:
        return "/".join((self.root.rstrip("/"), *names))

    def exists(self, *names: str) -> bool:
        return self.system.get_file_info(self.at(*names)).type != fs.FileType.NotFound

    def files(self, *names: str) -> list[str]:
        """Names of the files directly in a folder that do not start with ``_`` or ``.``."""
        found = self.system.get_file_info(fs.FileSelector(self.at(*names), allow_not_found=True))
        return [f.base_name for f in found if f.type == fs.FileType.File and f.base_name[0] not in "_."]

    def drop(self, *names: str) -> None:
        if self.exists(*names):
            self.system.delete_dir(self.at(*names))

    def touch(self, *names: str) -> None:
        with self.system.open_output_stream(self.at(*names)):
            pass


@dataclass
class Written(WriterCommitMessage):
    """Files that a task left in a temporary folder of its own."""

    folder: str
    names: list[str]


class _Sink:
    """What writers of batches and of micro-batches share."""

    def __init__(self, path: str, bulk_size: int, bodies_per_file: int):
        self.path, self.job = path, uuid.uuid4().hex
        self.lines_per_file = bulk_size_or_default(bulk_size) * bodies_per_file

    def _write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        folder, own = Folder(self.path), uuid.uuid4().hex
        place = ("_temporary", self.job, own)
        folder.system.create_dir(folder.at(*place), recursive=True)
        names, out, now, last, lines = [], None, None, None, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ORDER], 1)
                text = batch.column(batch.schema.get_field_index("line")).to_pylist()
                width = len(FILE_KEY)
                cuts = np.flatnonzero((keys[1:, :width] != keys[:-1, :width]).any(1)) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                    key = tuple(keys[a, :width].tolist())
                    if key != now:
                        if now is not None and key < now:
                            raise ValueError("rows are not in the order of their files; use bulk_rows")
                        now, lines, at = key, 0, 0
                        out = self._opened(out, folder, place, names, key, 0)
                    while a < b:
                        if self.lines_per_file and lines == self.lines_per_file:
                            at, lines = at + 1, 0
                            out = self._opened(out, folder, place, names, key, at)
                        to = min(b, a + self.lines_per_file - lines) if self.lines_per_file else b
                        out.write(("\n".join(text[a:to]) + "\n").encode())
                        lines, a = lines + to - a, to
                end = tuple(keys[-1].tolist())
                if last is not None and tuple(keys[0].tolist()) < last:
                    raise ValueError("requests are not in the order of the log; use bulk_rows")
                last = end
        finally:
            if out is not None:
                out.close()
        return Written("/".join(place), names)

    @staticmethod
    def _opened(out, folder: Folder, place: tuple[str, ...], names: list[str], key: tuple[int, ...], at: int):
        if out is not None:
            out.close()
        # One more, as what is unknown is -1: names sort like the numbers.
        names.append("-".join(f"{x + 1:0{n}d}" for x, n in zip(key, _DIGITS)) + f"-{at:06d}")
        return folder.system.open_output_stream(folder.at(*place, names[-1]))

    def _moved(self, messages: list, batch: str, *target: str) -> None:
        """Puts the files of all tasks in place. A file that two tasks wrote would lose requests, so there is none."""
        folder = Folder(self.path)
        told = [m for m in messages if m is not None]
        names = [n for m in told for n in m.names]
        if len(names) != len(set(names)):
            raise ValueError("the rows of a file were in several tasks; use bulk_rows")
        folder.system.create_dir(folder.at(*target) if target else folder.root, recursive=True)
        for m in told:
            for name in m.names:
                folder.system.move(folder.at(m.folder, name), folder.at(*target, f"{name}-{batch}.txt"))

    def _clean(self) -> None:
        Folder(self.path).drop("_temporary", self.job)


class BatchWriter(_Sink, DataSourceArrowWriter):
    def __init__(self, path: str, bulk_size: int, bodies_per_file: int, overwrite: bool, batch: str):
        super().__init__(path, bulk_size, bodies_per_file)
        self.overwrite, self.batch = overwrite, batch or self.job[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self._write(iterator)

    def commit(self, messages: list) -> None:
        folder = Folder(self.path)
        # What stood there goes only now that the new files are complete; so do leftovers of this batch.
        for name in folder.files():
            if self.overwrite or name.endswith(f"-{self.batch}.txt"):
                folder.system.delete_file(folder.at(name))
        self._moved(messages, self.batch)
        folder.touch("_SUCCESS")
        self._clean()

    def abort(self, messages: list) -> None:
        self._clean()


class StreamWriter(_Sink, DataSourceStreamArrowWriter):
    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        held = [b for b in iterator if b.num_rows]
        if not held:
            return self._write(iter(()))
        # A micro-batch comes unsorted.
        return self._write(iter(pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ORDER]).to_batches()))

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 - Spark's name
        folder, number = Folder(self.path), f"{batchId:012d}"
        if not folder.exists("_committed", number):
            folder.drop(f"batch_id={number}")
            self._moved(messages, number, f"batch_id={number}")
            folder.system.create_dir(folder.at("_committed"), recursive=True)
            folder.touch("_committed", number)
        # Micro-batches follow each other, so whatever is there was left by attempts that failed.
        folder.drop("_temporary")

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self._clean()


class BulkFiles(DataSource):
    """The sink. Options: ``path``, ``bulkSize`` and ``bodiesPerFile`` (0: one file, however many bodies), and ``batchId`` for a batch: to
    append under one id again replaces what was appended under it (default: a new one)."""

    @classmethod
    def name(cls) -> str:
        return "bulk"

    def _how(self, schema: StructType) -> dict:
        if missing := [c for c in COLUMNS if c not in schema.names]:
            raise ValueError(f"a bulk sink needs the columns of bulk_rows; missing: {', '.join(missing)}")
        if "path" not in self.options:
            raise ValueError("a bulk sink needs a path")
        return {"path": self.options["path"], "bulk_size": int(self.options.get("bulkSize", DEFAULT_BULK_SIZE)),
                "bodies_per_file": int(self.options.get("bodiesPerFile", 0))}

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(**self._how(schema), overwrite=overwrite, batch=self.options.get("batchId", ""))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:  # noqa: N802
        return StreamWriter(**self._how(schema))


def read_bulk_stream(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, file, value``: the lines of the micro-batches that are complete, one number per micro-batch on the driver."""
    folder = Folder(path)
    done = [f"{path.rstrip('/')}/batch_id={number}" for number in sorted(folder.files("_committed"))]
    if not done:
        return spark.createDataFrame([], "batch_id bigint, file string, value string")
    lines = spark.read.option("basePath", path).text(done)
    return lines.select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("_metadata.file_name").alias("file"), "value")
