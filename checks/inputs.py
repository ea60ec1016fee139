"""Listings, postal map and commune statistics made from the given tables.

One SQL text serves both engines; ``{table}`` names a given table.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

from hearthline import settings as S
from hearthline.sources import shared_folder

_SOURCE = """
WITH b AS (
  SELECT o_orderkey AS k, o_totalprice AS tp, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS st,
         c_nationkey AS nk, c_mktsegment AS seg
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey),
g AS (
  SELECT *, CAST(49 AS DOUBLE) + CAST(k % 270 AS DOUBLE) / CAST(100 AS DOUBLE) AS la,
         CAST(2 AS DOUBLE) + CAST(k % 470 AS DOUBLE) / CAST(100 AS DOUBLE) AS lo FROM b)"""

_STATES = (
    "To be renovated", "To demolish", "Normal", "New", "Excellent", "Fully renovated", "To renovate",
    "To restore",
)


def _choice(by: str, labels) -> str:
    """One of the labels by a remainder; one remainder more is missing."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(labels))
    return f"CASE {by} % {len(labels) + 1} {whens} ELSE NULL END"


_EPC = [f" {v} " if i % 4 == 3 else v for i, v in enumerate(S.EPC_QUALITY)]

# SQL that both engines read, by column.
_COLUMNS = {
    "property_id": "k",
    "row_ord": "k",
    "latitude": "CASE WHEN k % 31 = 1 THEN lo ELSE la END",
    "longitude": "CASE WHEN k % 31 = 1 THEN la WHEN k % 37 = 2 THEN NULL ELSE lo END",
    "price": """CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'on demand' WHEN k % 83 = 0 THEN '-1'
      ELSE CAST(CAST(FLOOR(tp) AS BIGINT) AS STRING) END""",
    "property_type": "CASE WHEN seg = 'MACHINERY' THEN NULL ELSE seg END",
    "category": """CASE WHEN k % 19 = 0 THEN NULL WHEN k % 17 = 0 THEN 'land' WHEN k % 17 = 1 THEN 'garage'
      WHEN k % 17 = 2 THEN 'student_house' WHEN k % 2 = 0 THEN 'appartment' ELSE 'house' END""",
    "postal_code": "CAST(1000 + nk * 40 + k % 5 AS STRING)",
    "street": "CASE WHEN k % 7 = 0 THEN NULL ELSE 'rue  de ' || CAST(k % 211 AS STRING) END",
    "house_number": "CAST(k % 50 AS STRING)",
    "livable_surface": "CASE WHEN k % 23 = 0 THEN NULL ELSE CAST(k % 220 AS DOUBLE) END",
    "bedrooms": "CAST(k % 6 AS INT)",
    "floor": "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k % 61 AS INT) END",
    "number_of_floors": "CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k % 73 AS INT) END",
    "garages": "CAST(k % 7 AS INT)",
    "facades": "CAST(k % 6 AS INT)",
    # A time alone is no date.
    "date_posted": "CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN '12:30' ELSE CAST(d AS STRING) END",
    "availability": "CASE st WHEN 'F' THEN ' Immediately ' WHEN 'O' THEN 'On delivery' ELSE NULL END",
    "epc": _choice("k", [*_EPC, "Unlisted"]),
    "flooding_area_type": """CASE k % 4 WHEN 0 THEN '(Information  not available)' WHEN 1 THEN ' No  Flooding area'
      WHEN 2 THEN 'Low risk' ELSE NULL END""",
    # A number with a Java suffix is no number.
    "indoor_parking": "CASE k % 6 WHEN 0 THEN '0' WHEN 1 THEN '2' WHEN 2 THEN 'n.c.' WHEN 3 THEN '-1' WHEN 4 THEN '5d' ELSE NULL END",
    "outdoor_parking": "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k % 3 - 1 AS STRING) END",
    "building_state": _choice("k", _STATES),
    "build_year": "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 59 = 0 THEN '5d' ELSE CAST(1950 + k % 56 AS STRING) END",
    "kitchen_equipment": _choice("k", S.ORDINAL_FEATURES["kitchen_equipment"]),
}
_ENGINEERED = (
    "post_year", "post_month", "statbel_commune_median", "statbel_transaction_count", "property_age",
    "available_immediately", "flooding_area_clean", "epc_quality",
)


def _rest() -> dict[str, str]:
    """The other columns of the full schema, by rule."""
    made: dict[str, str] = {}

    def add(names, rule):
        for i, name in enumerate(names):
            if name not in _COLUMNS and name not in _ENGINEERED:
                made[name] = rule(i, name)

    add(S.NUMERIC_FEATURES, lambda i, c: f"CASE WHEN k % {5 + i % 7} = 0 THEN NULL ELSE CAST((k * {7 + 2 * i}) % {40 + 3 * i} AS DOUBLE) / CAST(2 AS DOUBLE) END")
    add(S.FLAGS_MISSING_AS_ZERO, lambda i, c: f"CASE WHEN k % {3 + i % 5} = 0 THEN NULL ELSE CAST((k % {7 + 2 * i}) % 2 AS DOUBLE) END")
    add(S.FLAGS_MISSING_AS_UNKNOWN, lambda i, c: _choice(f"(k + {i})", ("0", "1")))
    add(S.NOMINAL_FEATURES, lambda i, c: f"CASE WHEN k % {9 + i} = 0 THEN NULL ELSE '{c} ' || CAST(k % {3 + i} AS STRING) END")
    add(S.METADATA_COLUMNS, lambda i, c: f"'{c} ' || CAST(k AS STRING)")
    add(S.DROPPED_COLUMNS, lambda i, c: f"CASE WHEN k % {4 + i % 9} = 0 THEN NULL ELSE CAST(k % {2 + i % 11} AS STRING) END")
    return made


_COLUMNS |= _rest()
COLUMNS = tuple(_COLUMNS)
TEXT_COLUMNS = tuple(
    c for c in COLUMNS
    if c not in S.NUMERIC_FEATURES + S.FLAGS_MISSING_AS_ZERO + ("property_id", "row_ord") or c == "build_year"
)


def _copy(changes: dict[str, str], test: str) -> str:
    cells = ", ".join(f"{changes[c]} AS {c}" if c in changes else c for c in COLUMNS)
    return f"SELECT {cells} FROM l WHERE {test}"


# Some are posted again a day later, with one number in another spelling; and some with less in them.
_LATER = {
    "property_id": "property_id + 10000000", "row_ord": "row_ord + 10000000",
    "date_posted": "CAST(CAST(TRY_CAST(date_posted AS DATE) + INTERVAL '1' DAY AS DATE) AS STRING)",
    "total_surface": "total_surface || '.0'", "immovlan_id": "'again ' || immovlan_id",
}
_LESS = {
    "property_id": "property_id + 20000000", "row_ord": "row_ord + 20000000",
    "street": "UPPER(' ' || street)", "epc": "NULL",
}
_WIDE = (
    "l AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in _COLUMNS.items())
    + " FROM g)\nSELECT * FROM l UNION ALL "
    + _copy(_LATER, "property_id % 10 = 3")
    + " UNION ALL "
    + _copy(_LESS, "property_id % 25 = 4")
    + "\n"
)
LISTINGS = _SOURCE + ",\n" + _WIDE

# Four codes per commune, and the first one once more under another commune.
POSTAL_MAP = """
SELECT CAST(1000 + n_nationkey * 40 + r AS STRING) AS postal_code, 21000 + n_nationkey AS nis_code, 1 AS ord
FROM (SELECT n_nationkey, {explode} AS r FROM {nation}) codes
UNION ALL
SELECT CAST(1000 + n_nationkey * 40 AS STRING), 21000 + (n_nationkey + 1) % 25, 2 FROM {nation}
"""

COMMUNE_STATS = """
SELECT 21000 + c_nationkey AS nis_code, 2024 + CAST(c_nationkey % 2 AS INT) AS year,
  COUNT(*) AS house_count, CAST(FLOOR(AVG(c_acctbal) * 10) AS DOUBLE) AS house_median,
  COUNT(*) + 7 AS apt_count,
  CASE WHEN c_nationkey % 6 = 3 THEN NULL ELSE CAST(FLOOR(AVG(c_acctbal) * 12) AS DOUBLE) END AS apt_median
FROM {customer} GROUP BY c_nationkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


_stored: dict[tuple[str, str], str] = {}


#: Orders that one task widens to listings, whatever the size of the table.
ORDERS_PER_TASK = 100_000


def _made(spark: SparkSession, sf_dir: str, per_task: int = ORDERS_PER_TASK) -> DataFrame:
    """The listings, made in tasks of bounded size.

    A few narrow columns are dealt to the tasks and the full schema is made there, so no wide row is exchanged.
    """
    narrow = _run(spark, sf_dir, f"{_SOURCE}\nSELECT * FROM g", "orders", "customer", "nation")
    # Tables of a few small files give fewer tasks than there are cores.
    needed = math.ceil(table(spark, sf_dir, "orders").count() / per_task)
    dealt = narrow.repartition(max(spark.sparkContext.defaultParallelism, needed))
    return spark.sql("WITH g AS (SELECT * FROM {dealt}),\n" + _WIDE, dealt=dealt)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings table, made once per session and directory and then scanned."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        path = f"{shared_folder(spark)}/checks/listings-{uuid.uuid4().hex}"
        _made(spark, sf_dir).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def postal_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = POSTAL_MAP.replace("{explode}", "explode(sequence(0, 3))")
    return _run(spark, sf_dir, sql, "nation")


def commune_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, COMMUNE_STATS, "customer")


def with_inputs(body: str) -> str:
    """``body`` for DuckDB, in which ``listings``, ``postal_map`` and ``commune_stats`` exist."""

    def plain(sql: str) -> str:
        for name in ("orders", "customer", "nation"):
            sql = sql.replace("{" + name + "}", name)
        return sql.replace("{explode}", "unnest([0, 1, 2, 3])")

    head = f"""WITH listings AS ({plain(LISTINGS)}),
postal_map AS ({plain(POSTAL_MAP)}),
commune_stats AS ({plain(COMMUNE_STATS)})"""
    body = body.strip()
    return f"{head},\n{body[5:]}" if body.upper().startswith("WITH ") else f"{head}\n{body}"
