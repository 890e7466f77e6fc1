"""Versioned tables: immutable folders, and a log that says which of them count.

Layout of a table at ``path``::

    v=<version>/...            data folders, never changed once committed
    _LOG/epoch=<e>/<files>     the log, text lines ``seq kind version part rows``
    _KEYS/v=...                key ranges of a folder's files

A commit adds one small file with one or more lines; nothing is replaced, so a
job that stops anywhere leaves the log as it was, and a folder that no line
names is never read.  ``base`` starts the table anew, ``add`` appends a folder,
``part`` makes a folder the only one of its partition (``part`` column).

Once ``EPOCH_LINES`` lines no longer count, the next commit opens a new epoch,
whose first file repeats the folders that do; ``merge`` does so at once.  A
reader needs the newest epoch only, so the log it lists stays short however
many loads a year brings.

``_KEYS/v=...`` holds the key range of every file of a folder, written before
the folder is committed: readers that look for given keys open only files that
can hold one (``files_with``).

One writer at a time owns a table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, replace
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMPTY = "-"            # the version of a table that has no rows yet
EPOCH_LINES = 500
FILE_KEYS = "file string, low string, high string, n long"


class UnpublishedDataError(RuntimeError):
    """Data folders without the log that names the published ones: never taken for an empty table."""


@dataclass(frozen=True)
class Entry:
    seq: int
    kind: str
    version: str
    part: str | None = None
    rows: int = -1

    def line(self) -> str:
        part = "-" if self.part is None else "=" + quote(self.part, safe="")
        return f"{self.seq} {self.kind} {self.version} {part} {self.rows}"

    @staticmethod
    def read(line: str) -> "Entry":
        seq, kind, version, *rest = line.split(" ")
        part = unquote(rest[0][1:]) if rest and rest[0] != "-" else None
        return Entry(int(seq), kind, version, part, int(rest[1]) if len(rest) > 1 else -1)


def new_version(as_of: dt.datetime | None = None) -> str:
    return (as_of or dt.datetime.now()).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]


def _missing(err: AnalysisException) -> bool:
    return err.getCondition() == "PATH_NOT_FOUND"


class TableLog:
    def __init__(self, spark: SparkSession, path: str, epoch_lines: int = EPOCH_LINES):
        self.spark, self.path, self.epoch_lines = spark, path.rstrip("/"), epoch_lines
        self._epoch: int | None = None
        self._lines: list[Entry] | None = None

    # reading ----------------------------------------------------------------
    def _read_epoch(self, epoch: int) -> list[Entry] | None:
        try:
            found = self.spark.read.schema("value string").text(f"{self.path}/_LOG/epoch={epoch}")
        except AnalysisException as err:
            if _missing(err):
                return None
            raise
        # bounded: an epoch has the live folders of its start and `epoch_lines` commits
        return sorted((Entry.read(r.value) for r in found.collect()), key=lambda e: e.seq)

    def lines(self) -> list[Entry] | None:
        """The newest epoch's entries, read once; None if the table was never written."""
        if self._lines is not None:
            return self._lines
        known, step, found = -1, 1, None
        while (lines := self._read_epoch(known + step)) is not None:      # 0, 2, 6, 14, ... then back
            known, found, step = known + step, lines, step * 2
        while step > 1:
            step //= 2
            if (lines := self._read_epoch(known + step)) is not None:
                known, found = known + step, lines
        if found is None:
            try:
                self.spark.read.schema("x string").parquet(f"{self.path}/v=*")
            except AnalysisException as err:
                if _missing(err):
                    return None
                raise
            raise UnpublishedDataError(f"{self.path} holds data folders but no log of published versions")
        self._epoch, self._lines = known, found
        return found

    def live(self) -> list[Entry]:
        """The folders that count now."""
        out: list[Entry] = []
        for e in self.lines() or []:
            if e.kind == "base":
                out = []
            elif e.kind == "part":
                out = [o for o in out if o.part != e.part]
            if e.version != EMPTY:
                out.append(e)
        return out

    def folder(self, e: Entry) -> str:
        return f"{self.path}/v={e.version}" + (f"/part={quote(e.part, safe='')}" if e.part is not None else "")

    def folders(self) -> list[str]:
        return [self.folder(e) for e in self.live()]

    def read(self, schema=None, parts: set[str] | None = None) -> DataFrame | None:
        """The published rows (of some partitions), or None without any folder."""
        paths = sorted(self.folder(e) for e in self.live() if parts is None or e.part in parts)
        if not paths:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    # writing ----------------------------------------------------------------
    def _next(self) -> int:
        return max((e.seq for e in self.lines() or []), default=-1) + 1

    def _snapshot(self, live: list[Entry]) -> list[Entry]:
        first = Entry(min((e.seq for e in live), default=0) - 1, "base", EMPTY)
        return [first] + [replace(e, kind="part" if e.part is not None else "add") for e in live]

    def commit(self, version: str, kind: str = "base", parts: dict[str, int] | None = None, rows: int = -1) -> None:
        """Publish a folder or, for ``part``, some partitions of it (rows of each; a partition without rows is
        emptied), in one step."""
        lines, seq = self.lines() or [], self._next()
        if kind == "part":
            fresh = [Entry(seq, kind, version if n else EMPTY, p, n) for p, n in sorted((parts or {}).items())]
        else:
            fresh = [Entry(seq, kind, version, None, rows)]
        live = self.live()
        if len(lines) >= self.epoch_lines + len(live):      # so many lines no longer count
            self.start(self._snapshot(live) + fresh)
        else:
            self._write(self._epoch or 0, fresh)
            self._epoch, self._lines = self._epoch or 0, lines + fresh

    def merge(self, old: list[Entry], version: str, rows: int) -> None:
        """One folder in place of some; the others stay as they are, and so does the order of commits."""
        gone = {e.version for e in old}
        kept = [e for e in self.live() if e.version not in gone]
        new = Entry(max(e.seq for e in old), "add", version, None, rows)
        self.start(self._snapshot(sorted([*kept, new], key=lambda e: e.seq)))

    def start(self, entries: list[Entry]) -> None:
        """Open an epoch with these entries alone."""
        epoch = (self._epoch or 0) + 1
        self._write(epoch, entries)              # one file: the epoch is there as a whole or not at all
        self._epoch, self._lines = epoch, entries

    def begin(self) -> None:
        """Open the log before the first data folder is written."""
        if self.lines() is None:
            self._lines = []
            self.commit(EMPTY)

    def _write(self, epoch: int, entries: list[Entry]) -> None:
        text = "\n".join(e.line() for e in entries)
        frame = self.spark.createDataFrame([(text,)], "value string")
        frame.coalesce(1).write.mode("append").text(f"{self.path}/_LOG/epoch={epoch}")

    # keys -------------------------------------------------------------------
    def write_sorted(self, df: DataFrame, version: str, key: str) -> int:
        """Write a folder whose files hold neighbouring keys, and the key range of each file.  Returns its rows."""
        folder, index = f"{self.path}/v={version}", f"{self.path}/_KEYS/v={version}"
        df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite").parquet(folder)
        written = self.spark.read.schema(df.schema).parquet(folder)
        written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")
        ).coalesce(1).write.mode("overwrite").parquet(index)
        return self.spark.read.schema(FILE_KEYS).parquet(index).agg(F.sum("n")).first()[0] or 0

    def files_with(self, ranges: list[tuple[str, str]]) -> list[str]:
        """Files of the published folders whose key range meets one of ``ranges``."""
        folders = {e.version: self.folder(e) for e in self.live()}
        if not folders or not ranges:
            return []
        meets = F.lit(False)
        for low, high in ranges:
            meets = meets | ((F.col("low") <= high) & (F.col("high") >= low))
        index = self.spark.read.schema(FILE_KEYS).parquet(*[f"{self.path}/_KEYS/v={v}" for v in folders])
        version = F.regexp_extract(F.col("_metadata.file_path"), r"/_KEYS/v=([^/]+)/", 1)
        # bounded by the files that the batch's keys can be in
        return sorted(f"{folders[r.version]}/{r.file}"
                      for r in index.where(meets).select(version.alias("version"), "file").collect())


def key_ranges(keys: DataFrame, key: str, ranges: int = 64) -> list[tuple[str, str]]:
    """At most ``ranges`` (low, high) that hold all of a batch's keys, from a range partitioning of them."""
    dealt = keys.select(key).where(F.col(key).isNotNull()).repartitionByRange(ranges, F.col(key))
    found = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return sorted((r.low, r.high) for r in found.collect())
