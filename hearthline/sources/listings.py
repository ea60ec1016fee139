"""Listing tables in and out."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import settings as S
from hearthline.functions import canonical_code, canonical_number, parse_number
from hearthline.sources.csv_records import read_records

# The audit itself decides what in these is a number, so the scan leaves their text alone.
RAW_TEXT_KEPT = (
    "price", "latitude", "longitude", "livable_surface", "garages", "facades",
    "number_of_floors", "floor", "indoor_parking", "outdoor_parking", "build_year",
)

_ENGINEERED = (
    "post_year", "post_month", "statbel_commune_median", "statbel_transaction_count",
    "property_age", "available_immediately",
)


def raw_types() -> dict[str, str]:
    """Kinds of the raw columns that the scan converts; every other column stays text.

    A "code" is text with whole numbers in one spelling; flags with three answers are codes,
    because they end as categories.
    """
    numbers = {c: "double" for c in S.NUMERIC_FEATURES + S.FLAGS_MISSING_AS_ZERO}
    codes = {c: "code" for c in S.FLAGS_MISSING_AS_UNKNOWN}
    skipped = RAW_TEXT_KEPT + _ENGINEERED
    return {c: t for c, t in (numbers | codes).items() if c not in skipped}


def with_row_order(df: DataFrame, name: str = "row_ord") -> DataFrame:
    """Number the rows of a file scan by file, block and place in the block.

    The running id alone follows how Spark packs files into tasks, hence the file first.
    Call it directly on the scan.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(name, place)


def read_listings_csv(
    spark: SparkSession,
    path: str | list[str],
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
    order_col: str | None = "row_ord",
) -> DataFrame:
    """Scan raw listings: comma CSV with a header, any number of files.

    Spark splits large files. A quoted cell with a line break then leaves a row without its last cells,
    which is an error, not a row of nulls; pass ``multi_line=True`` for such files: they are split too, and
    records are put together again in the tasks that read them, for which the files are read three times.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
    if multi_line:
        names = reader.option("multiLine", True).csv(path).columns
        schema = ", ".join(f"`{n}` STRING" for n in names)
        row = F.from_csv("text", schema, {"escape": '"', "mode": "PERMISSIVE"}).alias("row")
        raw = read_records(spark, path).select(row, F.col("place"))
        raw = raw.select("row.*", *([F.col("place").alias(order_col)] if order_col else []))
    else:
        # A row is checked whole.
        raw = reader.option("mode", "FAILFAST").option("columnPruning", False).csv(path)
        names = raw.columns
        if order_col:
            raw = with_row_order(raw, order_col)
    types = raw_types() if types is None else types
    cells = [_cell(n, types.get(n)).alias(n) for n in names]
    return raw.select(*cells, *([order_col] if order_col else []))


def _cell(name: str, kind: str | None):
    text = F.col(f"`{name}`")
    text = F.when(~text.isin(list(S.MISSING_TOKENS)), text)
    if kind is None:
        return canonical_number(text) if name in RAW_TEXT_KEPT else text
    if kind == "code":
        return canonical_code(text)
    if kind == "double":
        return parse_number(text)
    return text.try_cast(kind)


def read_table(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Scan a table that an earlier step wrote."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    order_col: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Write a table as Parquet or CSV.

    With ``order_col`` the rows are sorted back into input order and the column is left out.
    """
    if order_col:
        df = df.orderBy(order_col).drop(order_col)
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.options(
            header=True,
            escape='"',
            encoding="UTF-8",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        ).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"format must be 'parquet' or 'csv', not {fmt!r}")
