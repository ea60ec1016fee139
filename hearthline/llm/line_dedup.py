"""Dropping lines that many documents hold, with levelled sorted runs; DataFrame functions only.

Texts arrive in batches. What is known of lines is kept in *runs*: tables of ``(h1, h2, n)``, the 128-bit
hash of a line's key and the number of documents counted for it, dealt into buckets by hash and sorted
inside each. A new batch, dealt and sorted alike, is merge-anti-joined with the runs: lines that a run
already counts in enough documents are settled and need no more counting. What is left is added as a
run of level 0. When a level has ``fanout`` runs they are compacted into one of the next level, so a line
is written once per level, and a batch meets few runs however many batches came before. All runs share
one dealing into buckets, so neither the anti-joins nor the writing of a run move rows between tasks.

``drop_lines`` deals a table into batches by hash of the text, counts each batch, puts the batches through
the runs, and then drops the lines of the keys that reach ``least_documents``. Counts are combined in
each task before they are exchanged, so a line that a third of all documents share arrives as one row
per task. Positions of dropped lines are found by a semi-join that adaptive execution can split, and
are gathered per distinct text, so copies of a text are gathered once.

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at either end and with A-Z in lower
case. Defined results: a null or empty text is one empty line and becomes an empty text; a key shorter
than ``least_length`` code points is never dropped; every row is a document, so repeated rows count as often
as they are there, and a line counts once in a document however often it stands there; very long texts
are taken whole, one row of Spark each; an empty table gives an empty result. Only the text is read
to judge, ids may be null or repeat; new columns replace columns of ``docs`` with the same name.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthline.sources.stages import new_path, remove, stage

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    least_documents: int = 10
    least_length: int = 1
    batches: int = 4
    fanout: int = 2


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _hash(value: Column) -> tuple[Column, Column]:
    """128 bits of a text."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


class Runs:
    """Levelled sorted runs of line counts. ``add`` takes batches, ``totals`` gives what they sum to.

    Tables are external ones in the shared folder; ``close`` drops them with their files.
    """

    def __init__(self, spark: SparkSession, settings: Settings = Settings()):
        self.spark, self.settings = spark, settings
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._paths: dict[str, str] = {}

    def write(self, rows: DataFrame, *parts: str) -> str:
        """Store rows with ``h1`` and ``h2`` in sorted buckets; the name of the table."""
        name = f"line_run_{uuid.uuid4().hex}"
        self._paths[name] = new_path(self.spark, "line-run")
        out = rows.write.format("parquet").option("path", self._paths[name])
        out = out.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        (out.partitionBy(*parts) if parts else out).saveAsTable(name)
        return name

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, self._paths.pop(name))

    def close(self) -> None:
        for name in list(self._paths):
            self.drop(name)

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """The lines of a batch that no run has counted in enough documents yet."""
        for level in self.levels:
            for name in level:
                done = self.spark.table(name).where(F.col("n") >= self.settings.least_documents)
                batch = batch.join(done.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Count a batch of ``(h1, h2, n)``, a line once; compact the levels that are full."""
        run = self.write(self.unsettled(batch).select("h1", "h2", "n"))
        for at in range(len(self.levels) + 1):
            if at == len(self.levels):
                self.levels.append([])
            self.levels[at].append(run)
            if len(self.levels[at]) < self.settings.fanout:
                return
            run = self.write(self._merged(self.levels[at]))
            for old in self.levels[at]:
                self.drop(old)
            self.levels[at] = []

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs side by side, merged bucket by bucket: two without an exchange.

        Not a union and a sum: Spark 4.1 takes a union of bucketed scans for bucketed and sums too little.
        """

        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            both = a.join(b.withColumnRenamed("n", "m").hint("merge"), ["h1", "h2"], "full")
            return both.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

        return reduce(merge, [self.spark.table(n) for n in names])

    def totals(self) -> DataFrame:
        """``h1, h2, n`` of every line; a settled line's count is a lower bound."""
        names = [n for level in self.levels for n in level]
        return self._merged(names)


def _counted(docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """``batch, h1, h2, n``: in how many documents of a batch a line stands."""
    keys = F.array_distinct(F.transform(_lines(text), line_key))
    batch = F.pmod(F.xxhash64(F.col(text)), F.lit(settings.batches)).cast("int")
    rows = docs.select(batch.alias("batch"), F.explode(keys).alias("key"))
    rows = rows.where(F.char_length("key") >= settings.least_length)
    h1, h2 = _hash(F.col("key"))
    rows = rows.select("batch", h1.alias("h1"), h2.alias("h2"))
    # One exchange by line serves all batches, and leaves rows where their buckets are written.
    each = [F.count_if(F.col("batch") == b).alias(str(b)) for b in range(settings.batches)]
    wide = rows.groupBy("h1", "h2").agg(*each)
    per = F.array(*[F.struct(F.lit(b).alias("batch"), F.col(str(b)).alias("n")) for b in range(settings.batches)])
    return wide.select("h1", "h2", F.inline(per)).where("n > 0")


def frequent_lines(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``h1, h2`` of the keys that at least ``least_documents`` rows hold, as a stage table."""
    runs = Runs(docs.sparkSession, settings)
    try:
        dealt = runs.write(_counted(docs, text, settings), "batch")
        for b in range(settings.batches):
            runs.add(docs.sparkSession.table(dealt).where(F.col("batch") == b))
        many = runs.totals().where(F.col("n") >= settings.least_documents)
        return stage(many.select("h1", "h2"), "frequent-lines")
    finally:
        runs.close()


def drop_lines(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the lines left in ``text``, ``n_lines`` before and ``n_dropped``."""
    many = frequent_lines(docs, text, settings)
    t1, t2 = _hash(F.coalesce(F.col(text), F.lit("")))
    placed = docs.select(t1.alias("t1"), t2.alias("t2"), F.posexplode(_lines(text)).alias("at", "line"))
    placed = placed.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= settings.least_length)
    h1, h2 = _hash(F.col("key"))
    placed = placed.select("t1", "t2", "at", h1.alias("h1"), h2.alias("h2"))
    hits = placed.join(many, ["h1", "h2"], "left_semi").groupBy("t1", "t2").agg(F.collect_set("at").alias("hits"))
    # Stored, so that the join below exchanges both sides plainly and can split the copies of one text.
    hits = stage(hits, "line-hits")
    others = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), _lines(text).alias("lines"), t1.alias("t1"), t2.alias("t2"))
    rows = rows.join(hits, ["t1", "t2"], "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("hits"))
    kept = F.transform(left, lambda i: F.get(F.col("lines"), i))
    rows = rows.select(
        "row", F.array_join(F.when(F.col("hits").isNull(), F.col("lines")).otherwise(kept), "\n").alias("kept"),
        F.size("lines").cast("long").alias("n"), F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("gone"),
    )
    given = [F.col("row").getField(c).alias(c) for c in others]
    return rows.select(*given, F.col("kept").alias(text), F.col("n").alias("n_lines"), F.col("gone").alias("n_dropped"))
