"""The queries as SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

from checks.inputs import COLUMNS, TEXT_COLUMNS, with_inputs
from hearthline import settings as S

CONTENT = tuple(c for c in COLUMNS if c not in (*S.METADATA_COLUMNS, "row_ord"))
KEPT = tuple(c for c in COLUMNS if c not in S.DROPPED_COLUMNS and c not in ("row_ord", "date_posted"))


def _spelled(c: str) -> str:
    """Text with a number in one spelling."""
    return f"COALESCE(CAST(TRY_CAST({c} AS DOUBLE) AS VARCHAR), {c})" if c in TEXT_COLUMNS else c


def _norm(c: str) -> str:
    trimmed = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    return rf"lower(regexp_replace({trimmed}, '\s+', ' ', 'g'))"


def _num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


POSTED = "TRY_CAST(date_posted AS DATE)"

# --- shared steps ------------------------------------------------------------

REPAIR = """
swapped AS (SELECT *, COALESCE(latitude BETWEEN 2.5 AND 6.5 AND longitude BETWEEN 49.5 AND 51.6, FALSE) AS sw
            FROM listings),
unswapped AS (SELECT * EXCLUDE (sw) REPLACE (
    CASE WHEN sw THEN longitude ELSE latitude END AS latitude,
    CASE WHEN sw THEN latitude ELSE longitude END AS longitude) FROM swapped),
judged AS (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL
    AND NOT (latitude BETWEEN 49.5 AND 51.6 AND longitude BETWEEN 2.5 AND 6.5) AS bad FROM unswapped),
located AS (SELECT * EXCLUDE (bad) REPLACE (
    CASE WHEN NOT bad THEN latitude END AS latitude,
    CASE WHEN NOT bad THEN longitude END AS longitude) FROM judged)
"""


def _safe(source: str, name: str) -> str:
    return f"""
{name} AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(map(_spelled, CONTENT))}
    ORDER BY {POSTED} DESC NULLS LAST, row_ord) AS rn FROM {source}) WHERE rn = 1)
"""


def _suspicious(source: str, name: str) -> str:
    key = [_norm(c) for c in ("property_type", "category", "postal_code", "street", "house_number")]
    key += [_num(c) for c in ("longitude", "latitude", "price", "livable_surface", "floor")]
    key.append("bedrooms")
    filled = " + ".join(
        f"({c} IS NOT NULL)::INT" for c in (*[c for c in COLUMNS if c != "row_ord"], POSTED)
    )
    return f"""
{name} AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(key)}
    ORDER BY {filled} DESC, {POSTED} DESC NULLS LAST, row_ord) AS rn FROM {source}) WHERE rn = 1)
"""


def _priced(source: str, name: str, least: int = 30000) -> str:
    return f"""
cap AS (SELECT quantile_cont({_num('price')}, 0.99) AS c FROM {source}),
{name} AS (SELECT * REPLACE ({_num('price')} AS price) FROM {source}
  WHERE {_num('price')} >= {least} AND {_num('price')} <= (SELECT c FROM cap))
"""


def _plausible(source: str, name: str) -> str:
    return f"""
{name}_total AS (SELECT * REPLACE (
    CASE WHEN livable_surface >= 12 THEN CAST(livable_surface AS DOUBLE) END AS livable_surface,
    CASE WHEN garages <= 4 THEN CAST(garages AS DOUBLE) END AS garages,
    CASE WHEN facades <= 4 THEN CAST(facades AS DOUBLE) END AS facades,
    CASE WHEN number_of_floors <= 50 THEN CAST(number_of_floors AS DOUBLE) END AS number_of_floors)
  FROM {source}),
{name} AS (SELECT * REPLACE (
    CASE WHEN floor > 50 OR floor > number_of_floors THEN NULL ELSE CAST(floor AS DOUBLE) END AS floor)
  FROM {name}_total)
"""


def _audit(least: int) -> str:
    return ",".join(
        (
            REPAIR,
            _safe("located", "safe"),
            _suspicious("safe", "deduplicated"),
            _priced("deduplicated", "priced", least),
            _plausible("priced", "audited"),
        )
    )


AUDIT, AUDIT_LIMITS = _audit(30000), _audit(200000)

LOOKUPS = """
first_codes AS (SELECT postal_code, nis_code FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY postal_code ORDER BY ord) AS rn FROM postal_map) WHERE rn = 1),
stats AS (SELECT * FROM commune_stats WHERE year = 2025 AND nis_code IS NOT NULL)
"""

EPC = "CASE TRIM(epc) {} END".format(" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.EPC_QUALITY.items()))
AVAILABLE = """CASE WHEN LOWER(TRIM(availability)) = 'immediately' THEN 1
  WHEN availability IS NOT NULL THEN 0 END"""
FLOODING = f"NULLIF({_norm('flooding_area_type')}, '(information not available)')"
STATE = """CASE building_state WHEN 'To be renovated' THEN 'To renovate'
  WHEN 'To demolish' THEN 'To restore' ELSE building_state END"""
RELABEL = "CASE category WHEN 'student_house' THEN 'appartment' ELSE category END"
IN_SCOPE = "(category IS NULL OR category NOT IN ('garage', 'investment_property', 'land', 'entreprise'))"


def _parked(c: str) -> str:
    return f"CASE WHEN {_num(c)} = 0 THEN 0 WHEN {_num(c)} IS NOT NULL THEN 1 END"


def _engineered(source: str, extra: str) -> str:
    """``source`` has post_year and post_month; ``extra`` are its leading columns."""
    changed = {
        "category": RELABEL, "indoor_parking": _parked("indoor_parking"),
        "outdoor_parking": _parked("outdoor_parking"), "building_state": STATE,
    }
    gone = ("availability", "epc", "flooding_area_type")
    cells = ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in KEPT if c not in gone)
    age = f"post_year - {_num('build_year')}"
    return f"""
reached AS (
  SELECT {extra} {cells}, post_year, post_month,
    {AVAILABLE} AS available_immediately, {EPC} AS epc_quality, {FLOODING} AS flooding_area_clean
  FROM {source} WHERE {IN_SCOPE}),
engineered AS (
  SELECT r.*,
    CASE WHEN category = 'appartment' THEN apt_median ELSE house_median END AS statbel_commune_median,
    CAST(CASE WHEN category = 'appartment' THEN apt_count ELSE house_count END AS DOUBLE)
      AS statbel_transaction_count,
    CAST(CASE WHEN {age} < 0 THEN 0 ELSE {age} END AS DOUBLE) AS property_age
  FROM reached r LEFT JOIN first_codes USING (postal_code) LEFT JOIN stats USING (nis_code))
"""


DATED = f"""dated AS (SELECT * EXCLUDE (date_posted),
  CAST(YEAR({POSTED}) AS INT) AS post_year, CAST(MONTH({POSTED}) AS INT) AS post_month FROM listings)"""
def _cleaned(source: str) -> str:
    return f"""cleaned AS (SELECT row_ord, {', '.join(KEPT)},
  CAST(YEAR({POSTED}) AS INT) AS post_year, CAST(MONTH({POSTED}) AS INT) AS post_month FROM {source})"""


CLEANED = _cleaned("listings")
DISTINCT = "bare AS (SELECT DISTINCT * EXCLUDE (row_ord) FROM cleaned)"


def _split_of(source: str, name: str) -> str:
    return f"""
{name} AS (SELECT * EXCLUDE (nth, n), CASE WHEN nth <= CEIL(0.2 * n) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY md5('13:' || CAST(property_id AS VARCHAR))) AS nth,
    COUNT(*) OVER () AS n FROM {source}))
"""


GROUP_MEAN = ",".join(
    (
        _priced("listings", "priced"),
        """known AS (SELECT property_id, price AS actual, COALESCE(category, 'Unknown') AS category
           FROM priced)""",
        _split_of("known", "parted"),
        "means AS (SELECT category, AVG(actual) AS predicted FROM parted WHERE split = 'train' GROUP BY 1)",
        "predictions AS (SELECT property_id, split, actual, predicted FROM parted LEFT JOIN means USING (category))",
        """measured AS (SELECT split, AVG(ABS(predicted - actual)) AS mae,
             SQRT(AVG((predicted - actual) * (predicted - actual))) AS rmse,
             1 - SUM((predicted - actual) * (predicted - actual)) / (VAR_POP(actual) * COUNT(*)) AS r2
           FROM predictions GROUP BY 1)""",
    )
)

TARGETS = f"""
p AS (SELECT property_id, postal_code, ln(1 + {_num('price')}) AS y, property_id % 5 AS fold
  FROM listings WHERE {_num('price')} >= 30000),
centre AS (SELECT AVG(y) AS m FROM p),
g AS (SELECT postal_code, fold, COUNT(*) AS n, SUM(y - m) AS s, SUM((y - m) * (y - m)) AS q
  FROM p, centre GROUP BY 1, 2)
"""
BY_FOLD = """
c AS (SELECT a.postal_code, a.fold, SUM(b.n) AS n, SUM(b.s) AS s, SUM(b.q) AS q
  FROM g a LEFT JOIN g b ON a.postal_code = b.postal_code AND a.fold <> b.fold GROUP BY 1, 2),
t AS (SELECT f.fold, SUM(g.s) / SUM(g.n) AS m, SUM(g.q) / SUM(g.n) - POWER(SUM(g.s) / SUM(g.n), 2) AS v
  FROM (SELECT DISTINCT fold FROM g) f JOIN g ON g.fold <> f.fold GROUP BY 1),
oof AS (SELECT c.postal_code, c.fold, centre.m + CASE WHEN c.n IS NULL THEN t.m ELSE
    (t.v * c.n * (c.s / c.n) + (c.q / c.n - POWER(c.s / c.n, 2)) * t.m)
    / (t.v * c.n + (c.q / c.n - POWER(c.s / c.n, 2))) END AS encoded
  FROM c JOIN t ON c.fold = t.fold, centre)
"""
OVERALL = """
w AS (SELECT SUM(s) / SUM(n) AS m, SUM(q) / SUM(n) - POWER(SUM(s) / SUM(n), 2) AS v FROM g),
k AS (SELECT postal_code, SUM(n) AS n, SUM(s) / SUM(n) AS a,
    GREATEST(SUM(q) / SUM(n) - POWER(SUM(s) / SUM(n), 2), 0) AS o FROM g GROUP BY 1),
enc AS (SELECT postal_code, centre.m + (w.v * n * a + o * w.m) / (w.v * n + o) AS encoded FROM k, w, centre)
"""

NUMBERS = (
    "latitude", "longitude", "bedrooms", "livable_surface", "floor", "build_year", "facades",
    "garages", "number_of_floors",
)
MEDIANS = "md AS (SELECT {} FROM listings)".format(
    ", ".join(f"quantile_cont({_num(c)}, 0.5) AS m_{c}" for c in NUMBERS)
)
FILLED = "filled AS (SELECT property_id, {} FROM listings, md)".format(
    ", ".join(f"COALESCE({_num(c)}, m_{c}) AS num_{c}" for c in NUMBERS)
)


def _report(least: int = 30000) -> str:
    def count(step, measure, source, test=None):
        rows = f"COUNT(*) FILTER (WHERE {test})" if test else "COUNT(*)"
        return f"SELECT '{step}' AS step, '{measure}' AS measure, {rows} AS rows FROM {source}"

    price = _num("price")
    parts = [
        count("coordinates", "swapped", "swapped", "sw"),
        count("coordinates", "rows_in", "listings"),
        count("coordinates", "out_of_bounds", "judged", "bad"),
        count("safe_duplicates", "rows_after", "safe"),
        count("suspicious_duplicates", "rows_after", "deduplicated"),
        count("price", "price_missing", "deduplicated", f"{price} IS NULL"),
        count("price", "price_not_positive", "deduplicated", f"{price} <= 0"),
        count("price", "price_below_min", "deduplicated", f"{price} > 0 AND {price} < {least}"),
        count("price", "price_above_cap", "deduplicated, cap", f"{price} > c"),
        count("price", "rows_after", "priced"),
        count("implausible", "livable_surface_below_min", "priced", "livable_surface < 12"),
        count("implausible", "garages_above_max", "priced", "garages > 4"),
        count("implausible", "facades_above_max", "priced", "facades > 4"),
        count("implausible", "number_of_floors_above_max", "priced", "number_of_floors > 50"),
        count("implausible", "floor_above_max", "priced", "floor > 50"),
        count(
            "implausible", "floor_above_number_of_floors", "audited_total",
            "floor > number_of_floors",
        ),
        count(
            "implausible", "floor_nulled", "audited_total",
            "floor > 50 OR floor > number_of_floors",
        ),
    ]
    return "\nUNION ALL ".join(parts)


def _money(c: str) -> str:
    """Thousands separators on the half-even whole number."""
    return f"format('{{:,}}', CAST(ROUND_EVEN({c}, 0) AS BIGINT))"


def _ranks() -> str:
    parts = []
    for c, scale in S.ORDINAL_FEATURES.items():
        whens = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(scale))
        known = ", ".join(f"'{v}'" for v in scale)
        parts.append(f"CAST(CASE {c} {whens} ELSE -1 END AS DOUBLE) AS ord_{c}")
        parts.append(f"CAST(CASE WHEN {c} IN ({known}) THEN 0 ELSE 1 END AS DOUBLE) AS ord_{c}_missing")
    return ", ".join(parts)


CLEANED_DATED = f"""dated_clean AS (SELECT property_id, {', '.join(KEPT)},
  CAST(YEAR({POSTED}) AS INT) AS post_year, CAST(MONTH({POSTED}) AS INT) AS post_month FROM listings)"""

# Cells of three flags: what a tree that is grown to every cell predicts, and least squares on two.
CELLS = ",".join(
    (
        _priced("listings", "priced"),
        """known AS (SELECT property_id, price AS actual, LN(1 + price) AS y, COALESCE(heat_pump, 0) AS a,
           COALESCE(garden, 0) AS b, COALESCE(alarm, 0) AS c FROM priced)""",
        _split_of("known", "parted"),
    )
)
CELL_MEANS = f"""{CELLS},
means AS (SELECT a, b, c, EXP(AVG(y)) - 1 AS predicted FROM parted WHERE split = 'train' GROUP BY 1, 2, 3),
predictions AS (SELECT property_id, split, actual, predicted FROM parted JOIN means USING (a, b, c)),
measured AS (SELECT split, AVG(ABS(predicted - actual)) AS mae,
    SQRT(AVG((predicted - actual) * (predicted - actual))) AS rmse,
    1 - SUM((predicted - actual) * (predicted - actual)) / (VAR_POP(actual) * COUNT(*)) AS r2
  FROM predictions GROUP BY 1)"""
LEAST_SQUARES = f"""{CELLS},
s AS (SELECT AVG(a) AS ma, AVG(b) AS mb, AVG(y) AS my, COVAR_POP(a, a) AS aa, COVAR_POP(a, b) AS ab,
    COVAR_POP(b, b) AS bb, COVAR_POP(a, y) AS ay, COVAR_POP(b, y) AS cy FROM parted WHERE split = 'train'),
w AS (SELECT *, (ay * bb - cy * ab) / (aa * bb - ab * ab) AS wa, (cy * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s)"""
_CELL_ROWS = """SELECT property_id, split, actual, ROUND(predicted, 3) AS predicted FROM predictions"""


BODIES = {
    "listings_csv_scan": "SELECT property_id, epc, street, availability, date_posted, "
    + ", ".join(f"{_num(c)} AS {c}" for c in ("price", "indoor_parking", *NUMBERS))
    + " FROM listings",
    "listings_csv_line_breaks": f"""SELECT property_id, CASE WHEN property_id % 3 = 0
      THEN street || chr(10) || chr(10) || '"bus" ' || property_id || chr(10) ELSE street END AS street, epc, availability,
      {_num('price')} AS price FROM listings""",
    "audited_table_roundtrip": "SELECT property_id, price, category, livable_surface FROM listings",
    "commune_stats_scan": "SELECT * FROM commune_stats WHERE year = 2025",
    "postal_map_scan": f"WITH {LOOKUPS} SELECT * FROM first_codes",
    "text_normalise": f"""SELECT property_id, {_norm('street')} AS street,
      {_norm('flooding_area_type')} AS flooding, TRIM(epc) AS epc FROM listings""",
    "number_parse": "SELECT property_id, {} FROM listings".format(
        ", ".join(f"{_num(c)} AS {c}" for c in ("price", "indoor_parking", "floor"))
    ),
    "date_parse": f"""SELECT property_id, {POSTED} AS posted, CAST(YEAR({POSTED}) AS INT) AS y,
      CAST(MONTH({POSTED}) AS INT) AS m FROM listings""",
    "log_target": f"""SELECT property_id, ROUND(ln(1 + {_num('price')}), 9) AS log_price,
      {_num('price')} AS price_back FROM listings WHERE {_num('price')} > 0""",
    "euros_text": f"""SELECT l_orderkey, l_linenumber, {_money('l_extendedprice * 100')} AS shown
      FROM lineitem""",
    "row_completeness": "SELECT property_id, {} AS filled FROM listings".format(
        " + ".join(f"({c} IS NOT NULL)::INT" for c in COLUMNS if c != "row_ord")
    ),
    "drop_and_date_parts": f"WITH {CLEANED} SELECT * FROM cleaned",
    "target_and_features": """SELECT property_id, category, livable_surface, NULL AS price FROM listings
      UNION ALL SELECT NULL, NULL, NULL, price FROM listings""",
    "swap_coordinates": f"WITH {REPAIR} SELECT property_id, latitude, longitude FROM unswapped",
    "null_invalid_coordinates": f"WITH {REPAIR} SELECT property_id, latitude, longitude FROM located",
    "null_where_rules": f"""WITH {_plausible('listings', 'plausible')}
      SELECT property_id, livable_surface, garages, facades, number_of_floors, floor FROM plausible""",
    "null_floor_alone": """SELECT property_id, CASE WHEN floor > 50 OR floor > number_of_floors
      THEN NULL ELSE CAST(floor AS DOUBLE) END AS floor FROM listings""",
    "dedup_safe": f"WITH {REPAIR}, {_safe('located', 'safe')} SELECT * FROM safe",
    "dedup_suspicious": f"WITH {_suspicious('listings', 'kept')} SELECT * FROM kept",
    "dedup_exact": f"SELECT DISTINCT {', '.join(CONTENT)} FROM listings",
    "first_per_key": f"WITH {LOOKUPS} SELECT * FROM first_codes",
    "price_filter_p99": f"WITH {_priced('listings', 'priced')} SELECT property_id, price FROM priced",
    "price_quantile": f"""SELECT COUNT(*) AS rows, quantile_cont({_num('price')}, 0.99) AS p99
      FROM listings""",
    "audit_listings": f"WITH {AUDIT} SELECT * FROM audited",
    "audit_report": f"WITH {AUDIT} {_report()}",
    "lineitem_price_audit": """WITH cap AS (SELECT quantile_cont(l_extendedprice, 0.99) AS c FROM lineitem)
      SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_quantity >= 12 THEN l_quantity END AS l_quantity
      FROM lineitem WHERE l_extendedprice >= 2000 AND l_extendedprice <= (SELECT c FROM cap)""",
    "availability_flag": f"SELECT property_id, {AVAILABLE} AS available_immediately FROM listings",
    "category_scope": f"SELECT property_id, {RELABEL} AS category FROM listings WHERE {IN_SCOPE}",
    "epc_quality": f"SELECT property_id, {EPC} AS epc_quality FROM listings",
    "flooding_area": f"SELECT property_id, {FLOODING} AS flooding_area_clean FROM listings",
    "parking_flags": f"""SELECT property_id, {_parked('indoor_parking')} AS indoor_parking,
      {_parked('outdoor_parking')} AS outdoor_parking FROM listings""",
    "building_state": f"SELECT property_id, {STATE} AS building_state FROM listings",
    "property_age": f"""WITH {DATED} SELECT property_id, CAST(CASE WHEN post_year - {_num('build_year')} < 0 THEN 0
      ELSE post_year - {_num('build_year')} END AS DOUBLE) AS property_age FROM dated""",
    "commune_code": f"""WITH {LOOKUPS} SELECT property_id, nis_code
      FROM listings LEFT JOIN first_codes USING (postal_code)""",
    "commune_enrich": f"""WITH {LOOKUPS} SELECT property_id,
      CASE WHEN category = 'appartment' THEN apt_median ELSE house_median END AS statbel_commune_median,
      CAST(CASE WHEN category = 'appartment' THEN apt_count ELSE house_count END AS DOUBLE)
        AS statbel_transaction_count
      FROM listings LEFT JOIN first_codes USING (postal_code) LEFT JOIN stats USING (nis_code)""",
    "commune_match_count": f"""WITH {LOOKUPS} SELECT
      COUNT(CASE WHEN category = 'appartment' THEN apt_median ELSE house_median END) AS matched,
      COUNT(*) AS listings
      FROM listings LEFT JOIN first_codes USING (postal_code) LEFT JOIN stats USING (nis_code)""",
    "engineered": f"WITH {CLEANED}, {LOOKUPS}, {_engineered('cleaned', 'row_ord,')} SELECT * FROM engineered",
    "cv_table": f"""WITH {CLEANED}, {DISTINCT}, {LOOKUPS}, {_engineered('bare', '')}
      SELECT * FROM engineered""",
    "training_split_sizes": f"""WITH {CLEANED}, {DISTINCT},
      n AS (SELECT COUNT(*) AS n FROM bare WHERE {IN_SCOPE})
      SELECT 'test' AS split, CAST(CEIL(0.2 * n) AS BIGINT) AS rows FROM n
      UNION ALL SELECT 'train', CAST(n - CEIL(0.2 * n) AS BIGINT) FROM n""",
    "exact_split": f"WITH {_split_of('listings', 'parted')} SELECT property_id, split FROM parted",
    "encoder_folds": """SELECT property_id, CAST(
      ('0x' || SUBSTR(md5('13:fold:' || CAST(property_id AS VARCHAR)), 1, 8))::BIGINT % 5 AS INT) AS fold
      FROM listings""",
    "median_impute": f"WITH {MEDIANS}, {FILLED} SELECT * FROM filled",
    "standardise": f"WITH {MEDIANS}, {FILLED} SELECT property_id, "
    + ", ".join(
        f"ROUND((num_{c} - AVG(num_{c}) OVER ()) / STDDEV_POP(num_{c}) OVER (), 6) AS std_num_{c}"
        for c in NUMBERS
    )
    + " FROM filled",
    "zero_fill": "SELECT property_id, {} FROM listings".format(
        ", ".join(f"COALESCE(CAST({c} AS DOUBLE), 0) AS flag_{c}" for c in S.FLAGS_MISSING_AS_ZERO)
    ),
    "one_hot_long": " UNION ALL ".join(
        f"""SELECT property_id, '{c}' AS feature, COALESCE({c}, 'Unknown') AS category,
        CAST(1 AS DOUBLE) AS value FROM listings"""
        for c in ("property_type", "category", "availability")
    ),
    "ordinal_rank": f"""WITH {CLEANED_DATED}, {LOOKUPS}, {_engineered('dated_clean', 'property_id,')}
      SELECT property_id, {_ranks()} FROM engineered""",
    "target_encode_oof": f"""WITH {TARGETS}, {BY_FOLD} SELECT postal_code, CAST(fold AS INT) AS fold,
      ROUND(encoded, 6) AS encoded FROM oof""",
    "target_encode_training": f"""WITH {TARGETS}, {BY_FOLD} SELECT property_id, ROUND(encoded, 6) AS encoded
      FROM p JOIN oof ON p.postal_code = oof.postal_code AND p.fold = oof.fold""",
    "target_encode_new": f"""WITH {TARGETS}, {OVERALL} SELECT property_id,
      ROUND(CASE WHEN CAST(l.postal_code AS INT) % 4 = 0 THEN centre.m + w.m
        ELSE COALESCE(encoded, centre.m + w.m) END, 6) AS encoded
      FROM listings l LEFT JOIN enc ON l.postal_code = enc.postal_code, w, centre""",
    "metrics_group_mean": f"""WITH {GROUP_MEAN} SELECT split, ROUND(mae, 2) AS mae,
      ROUND(rmse, 2) AS rmse, ROUND(r2, 4) AS r2 FROM measured""",
    "overfit_gaps": f"""WITH {GROUP_MEAN} SELECT ROUND(b.mae - a.mae, 2) AS mae_gap,
      ROUND(b.rmse - a.rmse, 2) AS rmse_gap, ROUND(a.r2 - b.r2, 4) AS r2_gap
      FROM measured a JOIN measured b ON a.split = 'train' AND b.split = 'test'""",
    "prediction_range": f"""WITH {GROUP_MEAN} SELECT ROUND(MIN(predicted), 2) AS min_predicted,
      ROUND(MAX(predicted), 2) AS max_predicted,
      COUNT(*) FILTER (WHERE predicted < 0) AS negative_predictions FROM predictions WHERE split = 'test'""",
    "worst_errors": f"""WITH {GROUP_MEAN} SELECT property_id, {_money('actual')} AS actual,
      {_money('predicted')} AS predicted, {_money('predicted - actual')} AS error,
      {_money('ABS(predicted - actual)')} AS absolute_error
      FROM predictions WHERE split = 'test'
      ORDER BY ABS(predicted - actual) DESC NULLS LAST, property_id LIMIT 10""",
    "linear_cells": f"""WITH {LEAST_SQUARES} SELECT property_id, split, actual,
      ROUND(my + wa * (a - ma) + wb * (b - mb), 6) AS predicted_log FROM parted, w""",
    "linear_collinear": f"""WITH {_priced('listings', 'priced')}, known AS (SELECT property_id, price AS actual,
        LN(1 + price) AS y, COALESCE(category, 'Unknown') AS category FROM priced), {_split_of("known", "parted")},
      means AS (SELECT category, AVG(y) AS predicted FROM parted WHERE split = 'train' GROUP BY 1)
      SELECT property_id, split, actual, ROUND(predicted, 6) AS predicted_log FROM parted JOIN means USING (category)""",
    "cross_validated_cells": f"""WITH {CELLS}, dealt AS (SELECT *, CAST(
        ('0x' || SUBSTR(md5('14:fold:' || CAST(property_id AS VARCHAR)), 1, 8))::BIGINT % 5 AS INT) AS fold FROM known),
      means AS (SELECT f.fold, a, b, c, EXP(AVG(y)) - 1 AS predicted FROM dealt d
        JOIN (SELECT DISTINCT fold FROM dealt) f ON d.fold <> f.fold GROUP BY f.fold, a, b, c),
      e AS (SELECT fold, actual, predicted - actual AS off FROM dealt JOIN means USING (fold, a, b, c))
      SELECT fold, ROUND(AVG(ABS(off)), 2) AS mae, ROUND(SQRT(AVG(off * off)), 2) AS rmse,
        ROUND(1 - SUM(off * off) / (VAR_POP(actual) * COUNT(*)), 4) AS r2 FROM e GROUP BY fold""",
    "price_cap_approx": f"SELECT COUNT({_num('price')}) AS rows, TRUE AS within FROM listings",
    "forest_cells": f"WITH {CELL_MEANS} {_CELL_ROWS}",
    "boosted_cells": f"WITH {CELL_MEANS} {_CELL_ROWS}",
    "boosted_cells_metrics": f"""WITH {CELL_MEANS} SELECT split, ROUND(mae, 2) AS mae, ROUND(rmse, 2) AS rmse,
      ROUND(r2, 4) AS r2 FROM measured""",
    "model_roundtrip": f"""WITH {AUDIT}, {_cleaned('audited')}, {DISTINCT},
      n AS (SELECT COUNT(*) AS n FROM bare WHERE {IN_SCOPE})
      SELECT 'test' AS split, CAST(CEIL(0.2 * n) AS BIGINT) AS rows, CAST(1 AS DOUBLE) AS same FROM n
      UNION ALL SELECT 'train', CAST(n - CEIL(0.2 * n) AS BIGINT), CAST(1 AS DOUBLE) FROM n""",
    "audit_report_limits": f"WITH {AUDIT_LIMITS} {_report(200000)}",
    "price_quantile_narrowed": f"""SELECT COUNT(*) AS rows, quantile_cont({_num('price')}, 0.99) AS p99
      FROM listings""",
    "listings_in_order": """SELECT property_id, ROW_NUMBER() OVER (ORDER BY row_ord) - 1 AS place FROM listings""",
    "group_numbers": f"""SELECT property_id, DENSE_RANK() OVER (ORDER BY {", ".join(
        f"{_norm(c)} NULLS FIRST" for c in ("street", "category", "epc"))}) - 1 AS group_id FROM listings""",
    "ols_one_feature": f"""WITH p AS (SELECT property_id, livable_surface AS x, ln(1 + {_num('price')}) AS y
        FROM listings WHERE {_num('price')} >= 30000 AND livable_surface IS NOT NULL),
      f AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM p)
      SELECT property_id, ROUND(b + a * x, 6) AS prediction FROM p, f""",
}

ORACLES = {name: with_inputs(body) for name, body in BODIES.items()}
