"""A log laid out as files, as a stream whose offset is the position in each server's log: ``format("changelog")``.

Spark's file stream remembers the files it has seen, so a stream that starts at a saved position must list and open all that came
before, and a file that is renamed or rewritten is read again. Here the offset of a micro-batch is the log position reached per server. What
lies before it is not opened, and it does not matter which part files hold the events after it.

The log is what :func:`changeflow.sources.files.write_changes_files` writes: Parquet by ``server_id`` and ``log_name``. A server's log
grows at its end: an event that is written behind the position a stream has reached is not seen. Files are reached through ``pyarrow.fs``."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from changeflow import schema as S
from changeflow.functions.positions import log_number
from changeflow.sources.bulk_files import Folder

#: Before every file, those without a number included.
BEGINNING = [-2, 0]
#: Part files of one log file that are read by one task, in bytes.
TASK_BYTES = 128 << 20

#: Offset of a stream: server -> [number of the log file, position in it], both reached.
Offset = dict[str, list[int]]


def read_changes_log(spark: SparkSession, path: str, positions: Sequence[tuple[int, str, int]] | None = None, max_log_bytes: int | None = None,
                     progress: str | None = None) -> DataFrame:
    """Change events of a log as a stream.

    ``positions`` (server, log name, position) are where an earlier reader stood, for instance the rows of ``saved_positions``: the stream begins
    after them. As in ``changes_since``, a server without one, with an empty name or offset 0 begins at what is there now. Without
    ``positions`` all servers begin at their first file; servers that turn up later always do.

    ``max_log_bytes`` bounds a micro-batch: each server advances by so many bytes of its log at most. Spark does not tell a source where a
    restarted query stands, so this needs ``progress``, a folder of the stream's own, where the end of each planned micro-batch is
    kept; the checkpoint alone decides what is read. ``availableNow`` takes one micro-batch: leave the bound out there."""
    if max_log_bytes and not progress:
        raise ValueError("max_log_bytes needs a folder for the progress")
    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format("changelog").option("path", path)
    if positions is not None:
        reader = reader.option("positions", json.dumps([[int(s), n or "", int(p or 0)] for s, n, p in positions]))
    if max_log_bytes:
        reader = reader.option("maxLogBytes", max_log_bytes).option("progress", progress)
    return reader.load()


@dataclass
class Part(InputPartition):
    """Part files of one server's log file, and the positions to read of them: after ``low``, up to ``high``."""

    server: int
    log_name: str
    files: list[str]
    low: int | None
    high: int | None


class LogReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, positions: list | None, max_log_bytes: int, progress: str | None):
        self.schema, self.path, self.positions, self.limit, self.progress = schema, path, positions, max_log_bytes, progress
        self.at: Offset | None = None
        self.known: dict[str, tuple[int, int]] = {}
        self.log_folder: Folder | None = None

    def __getstate__(self) -> dict:
        # Tasks need the schema and the path only.
        return {"schema": self.schema, "path": self.path, "positions": None, "limit": 0, "progress": None, "at": None, "known": {}, "log_folder": None}

    # What is there

    @property
    def folder(self) -> Folder:
        if self.log_folder is None:
            self.log_folder = Folder(self.path)
        return self.log_folder

    def _folders(self, key: str, *under: str) -> dict[str, str]:
        """Value -> folder name of the folders ``key=value``."""
        found = self.folder.system.get_file_info(fs.FileSelector(self.folder.at(*under), allow_not_found=True))
        names = [f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name.startswith(f"{key}=")]
        values = {n: unquote(n[len(key) + 1:]) for n in names}
        return {"" if v == "__HIVE_DEFAULT_PARTITION__" else v: n for n, v in values.items()}

    def _servers(self) -> dict[str, str]:
        return {v: n for v, n in self._folders("server_id").items() if v.lstrip("-").isdigit()}

    def _logs(self, server: str) -> dict[int, list[tuple[str, str]]]:
        """Number -> (log name, folder name) of a server's log files. Only names are listed."""
        out: dict[int, list[tuple[str, str]]] = {}
        for value, name in self._folders("log_name", server).items():
            out.setdefault(log_number(value), []).append((value, name))
        return out

    def _parts(self, server: str, log: str) -> list[fs.FileInfo]:
        found = self.folder.system.get_file_info(fs.FileSelector(self.folder.at(server, log), allow_not_found=True))
        return sorted((f for f in found if f.type == fs.FileType.File and f.base_name.endswith(".parquet") and f.base_name[0] not in "_."), key=lambda f: f.path)

    def _range(self, path: str) -> tuple[int, int]:
        """Lowest and highest position in a part file, from its footer."""
        if path not in self.known:
            low, high = [], []
            with self.folder.system.open_input_file(path) as source:
                file = pq.ParquetFile(source)
                place = file.schema_arrow.get_field_index("log_pos")
                for g in range(file.metadata.num_row_groups):
                    told = file.metadata.row_group(g).column(place).statistics
                    if told is None or not told.has_min_max:
                        column = file.read_row_group(g, ["log_pos"]).column(0)
                        told = pc.min_max(column).as_py()
                        low.append(-1 if told["min"] is None else told["min"])
                        high.append(-1 if told["max"] is None else told["max"])
                    else:
                        low.append(-1 if told.null_count else told.min)
                        high.append(told.max)
            self.known[path] = (min(low, default=-1), max(high, default=-1))
        return self.known[path]

    def _end_of(self, server: str, logs: list[tuple[str, str]]) -> int:
        return max((self._range(f.path)[1] for _, log in logs for f in self._parts(server, log)), default=0)

    # Offsets

    def initialOffset(self) -> Offset:  # noqa: N802 - Spark's names
        if self.at is not None:
            return self.at
        start: Offset = {}
        if self.positions is not None:
            saved = {str(s): [log_number(n), p] for s, n, p in self.positions if n and p}
            start = saved | {s: self._latest(folder) for s, folder in self._servers().items() if s not in saved}
        self.at = dict(sorted(start.items()))
        return self.at

    def _latest(self, server: str) -> list[int]:
        logs = self._logs(server)
        return [max(logs), self._end_of(server, logs[max(logs)])] if logs else BEGINNING

    def latestOffset(self) -> Offset:  # noqa: N802
        # Spark asks for the end first, also where a query begins or is taken up again.
        if self.at is None and (planned := self._planned()) is not None:
            self.at = planned
        if self.at is None and self.limit:
            self.initialOffset()
        end = dict(self.at or {})
        for server, folder in self._servers().items():
            start = end.get(server, BEGINNING)
            end[server] = self._step(folder, start) if self.limit else max(start, self._latest(folder))
        return dict(sorted(end.items()))

    def _step(self, server: str, start: list[int]) -> list[int]:
        """As far as the limit lets a server go."""
        logs, rest = self._logs(server), self.limit
        now = start
        for number in sorted(n for n in logs if n >= start[0]):
            begin = start[1] if number == start[0] else 0
            end = self._end_of(server, logs[number])
            if end - begin >= rest:
                return max(now, [number, begin + rest])
            rest -= max(0, end - begin)
            now = max(now, [number, end])
        return now

    def _planned(self) -> Offset | None:
        if not self.progress or not Folder(self.progress).exists("planned.json"):
            return None
        kept = Folder(self.progress)
        with kept.system.open_input_stream(kept.at("planned.json")) as source:
            return json.loads(source.read())

    def _keep(self, end: Offset) -> None:
        kept = Folder(self.progress)
        kept.system.create_dir(kept.root, recursive=True)
        with kept.system.open_output_stream(kept.at("planned.json.new")) as out:
            out.write(json.dumps(end).encode())
        kept.system.move(kept.at("planned.json.new"), kept.at("planned.json"))

    # Tasks

    def partitions(self, start: Offset, end: Offset) -> list[Part]:
        """A task for some part files of one log file. Footers are read of the first and the last log file only, to leave part files out
        that lie before the start or after the end."""
        if any(end.get(server, BEGINNING) < reached for server, reached in start.items()):
            raise ValueError("the stream has read further than its folder of progress knows, which was lost or is of another stream")
        self.at = end
        if self.progress:
            self._keep(end)
        out: list[Part] = []
        folders = self._servers()
        for server, (last, high) in end.items():
            first, low = start.get(server, BEGINNING)
            if server not in folders or [first, low] == [last, high]:
                continue
            for number, logs in sorted(self._logs(folders[server]).items()):
                if first <= number <= last:
                    above, upto = low if number == first else None, high if number == last else None
                    for log_name, log in logs:
                        files = [f for f in self._parts(folders[server], log) if self._touches(f.path, above, upto)]
                        out.extend(Part(int(server), log_name, some, above, upto) for some in self._dealt(files))
        return out

    def _touches(self, path: str, above: int | None, upto: int | None) -> bool:
        if above is None and upto is None:
            return True
        low, high = self._range(path)
        return (above is None or high > above) and (upto is None or low <= upto)

    @staticmethod
    def _dealt(files: list[fs.FileInfo]) -> Iterator[list[str]]:
        held, size = [], 0
        for f in files:
            if held and size + f.size > TASK_BYTES:
                yield held
                held, size = [], 0
            held.append(f.path)
            size += f.size
        if held:
            yield held

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(self.schema)
        told = {"server_id": partition.server, "log_name": partition.log_name}
        for path in partition.files:
            with self.folder.system.open_input_file(path) as source:
                file = pq.ParquetFile(source)
                there = [n for n in target.names if n in file.schema_arrow.names and n not in told]
                for batch in file.iter_batches(batch_size=10_000, columns=there):
                    position = pc.fill_null(batch.column(batch.schema.get_field_index("log_pos")), -1)
                    wanted = None
                    for bound, inside in ((partition.low, pc.greater), (partition.high, pc.less_equal)):
                        if bound is not None:
                            mask = inside(position, bound)
                            wanted = mask if wanted is None else pc.and_(wanted, mask)
                    kept = batch if wanted is None else batch.filter(wanted)
                    if kept.num_rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(told[f.name], kept.num_rows).cast(f.type) if f.name in told else
                             kept.column(kept.schema.get_field_index(f.name)).cast(f.type) if f.name in there else pa.nulls(kept.num_rows, f.type)
                             for f in target], schema=target)

    def commit(self, end: Offset) -> None:
        """Nothing is kept here; the checkpoint has the offsets."""


class ChangeLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changelog"

    def schema(self) -> str:
        return S.CHANGE_SCHEMA

    def streamReader(self, schema: StructType) -> LogReader:  # noqa: N802
        told = self.options
        return LogReader(schema, told["path"], json.loads(told["positions"]) if "positions" in told else None,
                         int(told.get("maxLogBytes", 0)), told.get("progress"))
