"""Keyed tables that grow by segments: an upsert writes what it brings and nothing else.

A segment is a set of Parquet files, dealt out by ranges of the key and sorted by it.  A manifest lists the segments,
oldest first, with the least and the greatest key of every file; a new one is put beside the old ones by a single
rename, so a reader sees the table before or after a write.  Rows of a later segment replace those of an earlier
one when the table is read.  Segments of like size that follow one another are merged, and of those only the files whose
keys lie within the range of another's file are written anew; the others pass from one segment to the next as they are.
A large merge goes range by range.
"""

from __future__ import annotations

import datetime
import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.operators.keyed import latest_in_ranges
from cardlens.schema import KeyedTable
from cardlens.sinks.files import MAX_RECORDS_PER_FILE
from cardlens.sinks.keyed import keyless, winner_order
from cardlens.workspace import list_files, passing_shuffles, put_text, remove_path

FAN = 4
MERGE_ROWS = 25_000_000
CONTENT = "_content"
SPREAD = "_spread"
AGE = "_age"


@dataclass(frozen=True)
class DataFile:
    """One file, by its path below the table, and the range of its keys."""

    path: str
    rows: int
    low: tuple
    high: tuple


@dataclass(frozen=True)
class Segment:
    files: tuple[DataFile, ...]

    @property
    def rows(self) -> int:
        return sum(f.rows for f in self.files)


@dataclass(frozen=True)
class Manifest:
    """The segments of one version of the table, oldest first."""

    version: int = 0
    segments: tuple[Segment, ...] = ()

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> Manifest:
        raw = json.loads(text)
        made = [Segment(tuple(DataFile(f["path"], f["rows"], _as_key(f["low"]), _as_key(f["high"])) for f in s["files"])) for s in raw["segments"]]
        return Manifest(raw["version"], tuple(made))


class ConcurrentWrite(RuntimeError):
    """Another writer has put up a manifest of the same version; this write is not part of the table, and can be tried again."""


def _as_key(parts: Iterable) -> tuple:
    return tuple(tuple(part) for part in parts)


def overlapping(files: Iterable[DataFile], others: Iterable[DataFile]) -> tuple[list[DataFile], list[DataFile]]:
    """``files`` whose key range meets that of one of ``others``, and the rest; n log n in the number of files."""
    spans: list[list] = []
    for other in sorted(others, key=lambda f: f.low):
        if spans and other.low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], other.high)
        else:
            spans.append([other.low, other.high])
    lows, highs = [s[0] for s in spans], [s[1] for s in spans]
    meets: tuple[list[DataFile], list[DataFile]] = ([], [])
    for file in files:
        # spans that begin at or below the file's end, less those that end below its beginning
        meets[0 if bisect_right(lows, file.high) > bisect_left(highs, file.low) else 1].append(file)
    return meets


class SegmentTable:
    """A keyed table below ``root`` in segments; as with ``upsert_keyed``, the row written last wins for its key.

    What the driver holds is one entry per file, as Spark itself does when it lists a table.  One writer at a time; a second
    one that commits the same version gets ``ConcurrentWrite``.
    """

    def __init__(self, spark: SparkSession, table: KeyedTable, root: str, fan: int = FAN):
        self.spark, self.table, self.fan = spark, table, fan
        self.path = f"{root}/{table.name}"
        self.schema = T.StructType([T.StructField(n, k, True) for n, k in table.fields.items()])

    # ---- manifests

    def versions(self) -> list[int]:
        names = [path.rsplit("/", 1)[-1] for path in list_files(self.spark, f"{self.path}/manifests")]
        return sorted(int(name.split(".")[0]) for name in names if name.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of ``version``; an empty one where nothing was written yet."""
        if version is None:
            found = self.versions()
            if not found:
                return Manifest()
            version = found[-1]
        return Manifest.parse(self.spark.read.text(self._manifest_path(version), wholetext=True).head()[0])

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifests/{version:010d}.json"

    def _commit(self, manifest: Manifest) -> Manifest:
        if not put_text(self.spark, self._manifest_path(manifest.version), manifest.text()):
            raise ConcurrentWrite(self._manifest_path(manifest.version))
        return manifest

    # ---- reading

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows, one per key, as of the newest or a given version."""
        return self._rows(self.manifest(version).segments)

    def read_times(self, day: str, version: int | None = None) -> DataFrame:
        """The table's rows from the files that may hold times of ``day`` in any time zone: a part of the table that has all rows of that day.

        For tables with a time in their key: their files are ranges of time first.
        """
        noon = datetime.datetime.fromisoformat(day).replace(hour=12, tzinfo=datetime.timezone.utc)
        low, high = (int((noon + datetime.timedelta(hours=h)).timestamp()) * 1_000_000 for h in (-36, 36))
        near = lambda f: f.low[0] <= (True, high) and f.high[0] >= (True, low)
        return self.read_files(self.manifest(version), lambda files: [f for f in files if near(f)])

    def rows_of(self, files: Iterable[DataFile]) -> DataFrame:
        """What was written into some files, whatever replaced it later."""
        return self._load(files)

    def read_files(self, manifest: Manifest, choose: Callable[[Iterable[DataFile]], Iterable[DataFile]]) -> DataFrame:
        """The rows of a version from the files that ``choose`` picks of each segment; it must pick all files of a key or none."""
        return self._rows(tuple(Segment(tuple(choose(s.files))) for s in manifest.segments))

    def _load(self, files: Iterable[DataFile]) -> DataFrame:
        paths = [f"{self.path}/{f.path}" for f in files]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _rows(self, segments: tuple[Segment, ...]) -> DataFrame:
        """Rows of segments, a later one's in place of an earlier one's.

        Only files that lie in the key range of a later segment's file are compared with it at all, by an anti join
        that needs the later segments' keys alone; Spark broadcasts these if they are few.
        """
        parts, newer = [], []
        for segment in reversed(segments):
            mixed, clear = overlapping(segment.files, newer)
            if clear:
                parts.append(self._load(clear))
            if mixed:
                around, _ = overlapping(newer, mixed)
                parts.append(self._without(self._load(mixed), self._load(around), self._keyed_throughout(mixed)))
            newer = [*newer, *segment.files]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def _keyed_throughout(self, files: Iterable[DataFile]) -> bool:
        """Whether no row lacks its key, as far as the ranges tell: a missing part sorts first, but only the first part shows in them."""
        return len(self.table.key) == 1 and all(f.low[0][0] for f in files)

    def _without(self, rows: DataFrame, newer: DataFrame, keyed: bool) -> DataFrame:
        if keyed:  # nothing but the key is read of ``newer``, and nothing but what is asked for of ``rows``
            return rows.join(newer.select(*self.table.key), list(self.table.key), "left_anti")
        names = [*self.table.key, CONTENT]
        keys = self._identified(newer).select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(names)])
        return self._identified(rows).join(keys, same, "left_anti").drop(CONTENT)

    def _identified(self, df: DataFrame) -> DataFrame:
        """With a digest of the whole row where a part of the key is missing: such rows are one only if equal throughout."""
        whole = F.sha2(F.to_json(F.struct(*self.table.fields), {"ignoreNullFields": "false"}), 256)
        return df.withColumn(CONTENT, F.when(keyless(self.table), whole))

    # ---- writing

    def upsert(self, df: DataFrame, compact: bool = True) -> Manifest:
        """Add ``df`` as a segment of its own; no stored file is read or rewritten, but for a merge that falls due."""
        typed = df.select([F.col(name).try_cast(kind).alias(name) for name, kind in self.table.fields.items()])
        files = self._write(typed, winner_order(self.table))
        manifest = self.manifest()
        if files:
            manifest = self._commit(Manifest(manifest.version + 1, (*manifest.segments, Segment(files))))
        return self.compact() if compact else manifest

    def _order(self) -> list[Column]:
        """Time first where the key has one, so that segments of different days lie apart."""
        time = [self.table.time] if self.table.time in self.table.key else []
        names = [*time, *[c for c in self.table.key if c not in time]]
        return [F.unix_micros(c) if isinstance(self.table.fields[c], T.TimestampType) else F.col(c) for c in names]

    def _write(self, rows: DataFrame, newest: list[Column]) -> tuple[DataFile, ...]:
        """The first row by ``newest`` of every key, in files that each hold a range of keys; rows without key are dealt out by their content.

        One shuffle brings copies of a key together and makes the ranges: rows are dealt out by range first and
        ranked where they lie.
        """
        keys = [self.table.time] if self.table.time in self.table.key else []
        keys += [c for c in self.table.key if c not in keys]
        ranges = list(keys)
        if any(rows.schema[c].nullable for c in keys):  # a column that is always null would not count as a range
            rows, ranges = rows.withColumn(SPREAD, F.when(keyless(self.table), F.xxhash64(*self.table.fields))), [*keys, SPREAD]
        whole = F.when(keyless(self.table), F.struct(*self.table.fields))
        placed = latest_in_ranges(rows, ranges, [], [whole], newest).select(*self.table.fields)
        folder = f"data/{uuid.uuid4().hex}"
        writer = placed.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "zstd")
        for name in self.table.key:  # a look-up of one key skips the files that do not hold it
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        with passing_shuffles(self.spark):
            writer.parquet(f"{self.path}/{folder}")
        key = F.struct(*[F.struct(c.isNotNull().alias("known"), c.alias("value")) for c in self._order()])
        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        ranges = stored.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
        return tuple(sorted((DataFile(f"{folder}/{r['name']}", r["n"], _plain(r["low"]), _plain(r["high"])) for r in ranges.collect()), key=lambda f: f.low))

    # ---- merging

    def _due(self, segments: tuple[Segment, ...]) -> int:
        """How many of the newest segments are merged: those, from the newest back, that are no more than ``fan`` times what follows them."""
        taken, rows = 0, 0
        for segment in reversed(segments):
            if taken and segment.rows > self.fan * rows:
                break
            taken, rows = taken + 1, rows + segment.rows
        return taken if taken >= self.fan else 0

    def compact(self, everything: bool = False) -> Manifest:
        """Merge the newest segments once ``fan`` of like size have gathered, or all of them."""
        manifest = self.manifest()
        due = len(manifest.segments) if everything else self._due(manifest.segments)
        if due < 2:
            return manifest
        old, run = manifest.segments[:-due], manifest.segments[-due:]
        rewrite: list[DataFile] = []
        keep: list[DataFile] = []
        for i, segment in enumerate(run):
            others = [f for j, other in enumerate(run) if j != i for f in other.files]
            mixed, clear = overlapping(segment.files, others)
            rewrite += mixed
            keep += clear
        again = set(rewrite)
        merged = [f for low, high in _passes(rewrite) for f in self._merged([[f for f in s.files if f in again] for s in run], low, high)]
        whole = Segment(tuple(sorted([*keep, *merged], key=lambda f: f.low)))
        return self._commit(Manifest(manifest.version + 1, (*old, whole)))

    def _merged(self, files: list[list[DataFile]], low, high) -> tuple[DataFile, ...]:
        """One file after another of the rows from ``low`` up to ``high``, of every key the row of the last of ``files`` that has it."""
        first = self._order()[0]
        within = F.lit(True) if low is None else first >= low
        if high is not None:
            within = within & (first < high)
        if low is None:
            within = within | first.isNull()
        near = [[f for f in some if (high is None or f.low[0] < (True, high)) and (low is None or f.high[0] >= (True, low))] for some in files]
        # all versions of a row meet in the one shuffle that writing needs anyway
        aged = [self._load(some).where(within).withColumn(AGE, F.lit(age)) for age, some in enumerate(near) if some]
        return self._write(reduce(DataFrame.unionByName, aged), [F.desc(AGE)])

    def vacuum(self, keep: int = 1) -> int:
        """Remove what only versions before the newest ``keep`` need; returns how many files went."""
        versions = self.versions()
        kept = {f.path for v in versions[-keep:] for s in self.manifest(v).segments for f in s.files}
        gone = {f.path for v in versions[:-keep] for s in self.manifest(v).segments for f in s.files} - kept
        used = {path.rsplit("/", 1)[0] for path in kept}
        for path in sorted({p if p.rsplit("/", 1)[0] in used else p.rsplit("/", 1)[0] for p in gone}):
            remove_path(self.spark, f"{self.path}/{path}")  # a folder of which nothing is used goes as a whole
        for version in versions[:-keep]:
            remove_path(self.spark, self._manifest_path(version))
        return len(gone)


def _passes(files: Iterable[DataFile]) -> list[tuple]:
    """Ranges of the key's first part that hold about ``MERGE_ROWS`` rows each, as far as the files' beginnings tell; ``None`` is no bound.

    A merge needs room for the shuffle of one of them at a time, not for that of all its rows.
    """
    ordered = sorted(files, key=lambda f: f.low)
    cuts, rows = [], 0
    for file in ordered:
        known, value = file.low[0]
        if rows >= MERGE_ROWS and known and file.low[0] != ordered[0].low[0] and value not in cuts[-1:]:
            cuts, rows = [*cuts, value], 0
        rows += file.rows
    return list(zip([None, *cuts], [*cuts, None])) if ordered else []


def _plain(key) -> tuple:
    """A key that sorts in Python as in Spark: what is missing first, whatever its type."""
    return tuple((part["known"], part["value"]) if part["known"] else (False, "") for part in key)


def read_segments(spark: SparkSession, table: KeyedTable, root: str, version: int | None = None) -> DataFrame:
    return SegmentTable(spark, table, root).read(version)
