"""Lines that many documents share, kept in levelled sorted runs of line hashes.

A run is a folder of rows ``key, docs, top``, dealt out and sorted by the line's hash: how many documents of some batches hold
the line, and the largest id among them.  Batches come in falling order of their ids.  A new batch is counted, merge
anti-joined with the keys that a run already knows to be in enough documents (nothing of the batch can change what happens
to those), and what is left becomes a run of level 0.  As soon as a level has ``fan`` runs they are
merged into one of the next level, so a line's hash is rewritten once a level only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import ascii_lower
from cardlens.workspace import remove_path, scratch_path, snapshot

BLANKS = "\t\n\x0b\x0c\r "
# a key with more than one in so many of a batch's lines is joined by broadcast; a batch has fewer such keys than that
HOT_SHARE = 20_000


def line_key(line: Column) -> Column:
    """A line without the blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


class LineRuns:
    """Counted line hashes below one folder of their own, in levels; the list of runs is all that the driver holds."""

    def __init__(self, spark: SparkSession, root: str, enough: int, fan: int = 2):
        if fan < 2:
            raise ValueError("a level is merged when it has two runs or more")
        self.spark, self.root, self.enough, self.fan = spark, root, enough, fan
        self.levels: list[list[str]] = []
        self.written = 0

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def _write(self, counted: DataFrame, level: int) -> None:
        """One more run; Parquet keeps the least and the greatest key of every file."""
        path = f"{self.root}/level={level}/run={self.written}"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        counted.repartition(parts, "key").sortWithinPartitions("key").write.parquet(path)
        self.written += 1
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(path)

    @staticmethod
    def _merged(*runs: DataFrame) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def add(self, counted: DataFrame) -> None:
        """A batch whose ids are all below those of the batches before: its lines that no run has settled become a run."""
        new = counted
        for path in (path for level in self.levels for path in level):
            settled = self._read(path).where(F.col("docs") >= self.enough).select("key")
            new = new.join(settled.hint("merge"), "key", "left_anti")
        self._write(new, 0)
        level = 0
        while len(self.levels[level]) >= self.fan:
            old, self.levels[level] = self.levels[level], []
            self._write(self._merged(*map(self._read, old)), level + 1)
            for path in old:
                remove_path(self.spark, path)
            level += 1

    def repeated(self) -> DataFrame:
        """The lines in enough documents, ``key, top``, over all runs."""
        rows = self._merged(*[self._read(path) for level in self.levels for path in level])
        return rows.where(F.col("docs") >= self.enough).select("key", "top")


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = 20, enough: int = 3, batches: int = 4, fan: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every whole text without the lines that ``enough`` documents share, except in the largest of these.

    Lines end at ``\\n``; a line's key is the line without blanks at its ends and with A-Z in lower case, and a shorter
    key than ``least_chars`` is never dropped.  Returns ``doc_id, n_lines, n_dropped, kept``: lines before, lines dropped, the
    lines that stay joined by ``\\n``.  A null or empty text is one empty line.  Rows of one id are one document: a line of several
    of them counts once, and its lines stay or go in all of them, however often they stand there; rows without id
    are together the least document.  An empty table gives an empty result; other columns are not looked at.  A batch is
    a range of ids; a key is the 128-bit digest of the line.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("print"))
    lines = _lines(rows, least_chars, batches)
    line_path, run_path = scratch_path(spark, "lines"), scratch_path(spark, "runs")
    lines.write.partitionBy("batch").parquet(line_path)
    lines = spark.read.schema(lines.schema).parquet(line_path)

    runs, hot = LineRuns(spark, run_path, enough, fan), []
    for batch in range(batches):
        own = lines.where(F.col("batch") == batch)
        per_document = own.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("lines"))
        counted = per_document.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("top"), F.sum("lines").alias("lines"))
        counted = snapshot(counted)
        hot.append(counted.where(F.col("lines") * HOT_SHARE > counted.agg(F.sum("lines")).scalar()).select("key"))
        runs.add(counted.drop("lines"))
    repeated = snapshot(runs.repeated())
    dropped = _dropped(lines, repeated, hot)
    per_row = dropped.groupBy("doc_id", "print").agg(F.collect_list("line").alias("gone"))
    return _without(rows, per_row)


def _lines(rows: DataFrame, least_chars: int, batches: int) -> DataFrame:
    """``key, doc_id, print, line, batch`` of every line long enough to be dropped; batch 0 has the largest ids."""
    share = [(batches - 1 - i) / batches for i in range(batches - 1)]
    number = F.lit(0)
    if share:
        cuts = F.broadcast(rows.agg(F.percentile_approx("doc_id", share).alias("cuts")))  # one row
        rows = rows.join(cuts)
        below = F.aggregate("cuts", F.lit(0), lambda n, cut: n + (F.col("doc_id") <= cut).cast("int"))
        number = F.coalesce(below, F.lit(batches - 1))
    each = rows.select("doc_id", "print", number.alias("batch"), F.posexplode(F.split("text", "\n", -1)).alias("line", "words"))
    keyed = each.select("doc_id", "print", "line", "batch", line_key(F.col("words")).alias("normal"))
    keyed = keyed.where(F.char_length("normal") >= least_chars)
    return keyed.select(F.unhex(F.md5(F.col("normal").cast("binary"))).alias("key"), "doc_id", "print", "line", "batch")


def _dropped(lines: DataFrame, repeated: DataFrame, hot: list[DataFrame]) -> DataFrame:
    """The lines whose key is repeated and whose document is not the one that keeps it.

    Frequent keys are fewer than ``HOT_SHARE`` a batch and go by broadcast; any other key has so few lines that its
    task stays small.
    """
    frequent = hot[0]
    for more in hot[1:]:
        frequent = frequent.unionByName(more)
    frequent = snapshot(repeated.join(F.broadcast(frequent.distinct()), "key", "left_semi"))
    loses = ~F.col("doc_id").eqNullSafe(F.col("top"))
    of_frequent = lines.join(F.broadcast(frequent), "key")
    others = repeated.join(F.broadcast(frequent.select("key")), "key", "left_anti")
    rest = lines.join(F.broadcast(frequent.select("key")), "key", "left_anti").join(others.hint("merge"), "key")
    columns = ("doc_id", "print", "line")
    return of_frequent.where(loses).select(*columns).unionByName(rest.where(loses).select(*columns))


def _without(rows: DataFrame, per_row: DataFrame) -> DataFrame:
    """The texts without the lines whose numbers ``gone`` lists."""
    named = per_row.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), F.array_distinct("gone").alias("gone"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("print") == F.col("_print"))
    met = rows.join(named.hint("merge"), same, "left")
    split = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "gone")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(split, i)), "\n"))
    count = F.size(split).cast("long")
    return met.select("doc_id", count.alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))
