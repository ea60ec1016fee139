"""Records of CSV files whose quoted cells hold line breaks, read in blocks of a file at once.

A line break ends a record only where the number of quotes before it is even. Files are read as plain
lines, which Spark splits anywhere. One pass counts the quotes of each block; running sums over the few blocks of a
file say which of them start inside a cell. With that a task puts together the records of its own blocks, and
no line is exchanged but those of the records that go over the end of a block: two parts of a block at most.

The columns needed are the line's file and its block; a task reads the lines of a block in order. Spark deals blocks to
tasks by size, so blocks are put in order by their place in the file and not by number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.sources.stages import stage


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``line`` with its ``file`` and ``block`` (where that starts), in the order of the block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """A row per block: its ``number``, whether it is the ``first`` of its file and starts ``inside`` of a cell."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    odd = stage(lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd")), "csv-quotes")
    # A file starts outside of quotes, whatever the files before it hold.
    if not (broken := odd.groupBy("file").agg(F.sum("odd").alias("n")).where("n % 2 = 1").limit(3)).isEmpty():
        raise ValueError(f"quotes left open in {[r['file'] for r in broken.collect()]}")
    order = Window.partitionBy("file").orderBy("block")
    before = F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1))
    blocks = odd.select(
        "file", "block", (F.row_number().over(order) == 1).alias("first"), (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside")
    )
    return stage(blocks.withColumn("number", F.monotonically_increasing_id()), "csv-blocks")


def _put_together(lines: DataFrame, blocks: DataFrame, whole: bool) -> DataFrame:
    """``number, nth, opens, text``: the records that lie in one block, or else the parts of the others.

    ``nth`` is the place of the first line in its block; a part ``opens`` a record or goes on with one.
    """
    known = lines.join(F.broadcast(blocks.select("file", "block", "number", "inside")), ["file", "block"])

    def run(batches):
        number, state, nth, held, begun, goes_on = None, 0, 0, [], 0, False

        def rows(at, text, opens):
            size = len(text)
            columns = [pa.array(np.full(size, number)), pa.array(at, pa.int64()), pa.array(np.full(size, opens)), text.cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["number", "nth", "opens", "text"])

        def joined(parts, offsets):
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(parts)), "\n")

        def part():
            """What is held of a record whose end or start is in another block."""
            return rows([begun], joined(held, [0, sum(map(len, held))]), not goes_on)

        for batch in batches:
            numbers = batch.column(1).to_numpy()
            cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if a == b:
                    continue
                own = batch.column(0).slice(a, b - a)
                if numbers[a] != number:
                    if held and not whole:
                        yield part()
                    goes_on = batch.column(2)[a].as_py()
                    number, state, nth, held, begun = int(numbers[a]), int(goes_on), 0, [], 0
                sums = state + np.cumsum(pc.count_substring(own, '"').to_numpy())
                ends = np.flatnonzero(sums % 2 == 0)
                if len(ends):
                    before, past = sum(map(len, held)), int(ends[-1]) + 1
                    text = joined([*held, own.slice(0, past)], np.concatenate([[0], before + ends + 1]))
                    at = np.concatenate([[begun], nth + ends[:-1] + 1])
                    if goes_on and not whole:
                        yield rows(at[:1], text.slice(0, 1), False)
                    elif whole:
                        yield rows(at[goes_on:], text.slice(int(goes_on)), True)
                    held, begun, goes_on = [], nth + past, False
                    own = own.slice(past)
                if len(own):
                    held.append(own)
                state, nth = int(sums[-1] % 2), nth + b - a
        if held and not whole:
            yield part()

    return known.select("line", "number", "inside").mapInArrow(run, "number long, nth long, opens boolean, text string")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``text`` of each record with its ``place``, a struct that orders records as their files do.

    The first record of each file is its header and is left out, as are empty lines.
    """
    lines = read_lines(spark, path)
    blocks = _blocks(lines)
    named = F.broadcast(blocks.select("file", "block", "number", "first"))
    head, place = F.col("first") & (F.col("nth") == 0), F.struct("file", "block", F.col("nth").alias("id")).alias("place")
    alone = _put_together(lines, blocks, True).join(named, "number").where(~head).select(place, "text")
    # Of a file there are two parts for each block at most.
    parts = _put_together(lines, blocks, False).join(named, "number")
    record = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("file").orderBy("block", "nth"))
    joined = (
        parts.withColumn("record", record)
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "nth", "text", "first"))).alias("parts"))
        .select("file", F.col("parts")[0].alias("at"), F.array_join(F.col("parts.text"), "\n").alias("text"))
        .select("file", "at.block", "at.nth", "at.first", "text")
        .where(~head)
        .select(place, "text")
    )
    records = alone.unionByName(joined)
    return records.withColumn("text", F.regexp_replace("text", r"\r$", "")).where("text <> ''")
