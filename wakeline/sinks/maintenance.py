"""Upkeep of stored tables by their folders: compaction of stream output, and retention by partition."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from wakeline.session import materialise

FILE_BYTES = 128 << 20


class Store:
    """The few file operations that a table's upkeep needs, on whatever store its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(self, pattern: str) -> list[str]:
        return sorted(s.getPath().toString() for s in self._files.globStatus(self._path(pattern)) or [] if s.isDirectory())

    def size(self, folder: str) -> int:
        return self._files.getContentSummary(self._path(folder)).getLength()

    def delete(self, folder: str) -> None:
        self._files.delete(self._path(folder), True)


@dataclass(frozen=True)
class _Live:
    """What readers see: compacted turns with their bytes, and the last compacted batch of each query."""

    turn: int = -1
    turns: tuple[tuple[int, int], ...] = ()
    upto: tuple[tuple[str, int], ...] = ()


class BatchFolders:
    """Stream output with a folder for each batch of each query, and its compacted form beside it.

    ``compact`` merges the batches that are over into files of about ``file_bytes``, below ``_compacted``, and then writes a
    manifest that names the compacted turns and, per query, the last batch they hold. A turn that is closed is not written again;
    only a last one with less than half a file is taken into the next. So the number of files follows the bytes and not
    the batches, and every row is rewritten a bounded number of times.

    The newest batch of a query is left alone: it may still be written, or run again. What a turn replaced is deleted by the
    next one, so a reader has the time between two compactions. A compaction that fails half-way has changed nothing.
    """

    _MANIFEST = "turns ARRAY<STRUCT<turn: BIGINT, bytes: BIGINT>>, upto MAP<STRING, BIGINT>"

    def __init__(self, spark: SparkSession, path: str, columns: str, file_bytes: int = FILE_BYTES) -> None:
        self.spark, self.path, self.columns, self.file_bytes = spark, path, columns, file_bytes
        self.store = Store(spark, path)

    def _live(self) -> _Live:
        try:
            rows = self.spark.read.schema(f"{self._MANIFEST}, turn BIGINT").parquet(f"{self.path}/_manifest")
            newest = rows.orderBy(F.desc("turn")).first()
        except AnalysisException:
            newest = None
        if newest is None:
            return _Live()
        return _Live(newest["turn"], tuple((t["turn"], t["bytes"]) for t in newest["turns"]), tuple(sorted(newest["upto"].items())))

    def _batches(self) -> list[tuple[str, int, str]]:
        found = []
        for folder in self.store.folders(f"{self.path}/query_id=*/batch_id=*"):
            query, batch = re.search(r"query_id=([^/]*)/batch_id=(\d+)$", folder).groups()
            found.append((query, int(batch), folder))
        return found

    def _read(self, live: _Live, folders: list[str]) -> DataFrame:
        folders = [f"{self.path}/_compacted/turn={turn}" for turn, _ in live.turns] + folders
        if not folders:
            return self.spark.createDataFrame([], self.columns)
        return self.spark.read.schema(self.columns).parquet(*folders)

    def read(self) -> DataFrame:
        """All rows, each once, however far compaction has come."""
        live = self._live()
        upto = dict(live.upto)
        return self._read(live, [folder for query, batch, folder in self._batches() if batch > upto.get(query, -1)])

    def compact(self) -> None:
        live = self._live()
        upto, batches = dict(live.upto), self._batches()
        newest = {query: max(b for q, b, _ in batches if q == query) for query, _, _ in batches}
        over = [(q, b, f) for q, b, f in batches if upto.get(q, -1) < b < newest[q]]
        gone = [f for q, b, f in batches if b <= upto.get(q, -1)]
        if over:
            small = [t for t in live.turns[-1:] if 2 * t[1] < self.file_bytes]
            bytes_in = sum(self.store.size(f) for _, _, f in over) + sum(n for _, n in small)
            turn = live.turn + 1
            target = f"{self.path}/_compacted/turn={turn}"
            rows = self._read(_Live(turns=tuple(small)), [f for _, _, f in over])
            rows.repartition(max(1, math.ceil(bytes_in / self.file_bytes))).write.mode("overwrite").parquet(target)
            turns = [*(t for t in live.turns if t not in small), (turn, self.store.size(target))]
            for q, b, _ in over:
                upto[q] = max(b, upto.get(q, -1))
            row = self.spark.createDataFrame([(turns, upto)], self._MANIFEST)
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_manifest/turn={turn}")
        # readers of the manifest before this one's are over
        for folder in gone:
            self.store.delete(folder)
        now = self._live()
        named = {f"turn={t}" for t, _ in (*live.turns, *now.turns)}
        for place, kept in (("_compacted", named), ("_manifest", {f"turn={live.turn}", f"turn={now.turn}"})):
            for folder in self.store.folders(f"{self.path}/{place}/turn=*"):
                if folder.rsplit("/", 1)[1] not in kept:
                    self.store.delete(folder)


def drop_before(spark: SparkSession, path: str, oldest: datetime, time: str = "base_datetime") -> None:
    """Retention of a table partitioned by year, month and day: rows before ``oldest`` go.

    Whole days are deleted by their folders, without reading a row; only the day that ``oldest`` cuts is written again, from a
    copy of what stays of it below the shared folder. Should the job end while that day is written, the copy has its rows.
    """
    store, edge = Store(spark, path), None
    for folder in store.folders(f"{path}/year=*/month=*/day=*"):
        day = date(*(int(x) for x in re.search(r"year=(\d+)/month=(\d+)/day=(\d+)$", folder).groups()))
        if day < oldest.date():
            store.delete(folder)
        elif day == oldest.date():
            edge = folder
    if edge is not None and oldest > datetime.combine(oldest.date(), datetime.min.time()):
        kept = spark.read.parquet(edge).filter(F.col(time) >= F.lit(oldest.isoformat(sep=" ")).cast("timestamp_ntz"))
        materialise(kept, "retained").write.mode("overwrite").parquet(edge)
