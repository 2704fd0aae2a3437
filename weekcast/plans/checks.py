"""SQL that recomputes each registered query from the raw tables.

Written for DuckDB and independent of the Spark expressions: look-ups are joins
over explicit week lists instead of windows, the running division is a recursive
query.  Each statement is assembled from the named parts it refers to.
"""

from __future__ import annotations

import re

from weekcast.plans.registry import (
    AFTER_WEEK,
    BEFORE_WEEK,
    GROUP,
    ITEM,
    K5,
    K6,
    REGION,
    SITE,
    UPDATED_WINDOW,
)
from weekcast.sources.schemas import DISPLAY_COLUMNS, MART_COLUMNS

_K5, _K6 = ", ".join(K5), ", ".join(K6)
_LINE = "regionSeg1, productSeg1, productSeg2, regionSeg2, regionSeg3, productSeg3"
_P4 = "regionseg, salesid, productgroup, item"
_MEASURES = "map_price, ir, pmap, pmap10, pro_percent"
_PANEL = f"{_K6}, yearweek, {_MEASURES}, qty, promotionNY"


def _on(a: str, b: str, columns: list[str]) -> str:
    """Equal keys; only the product segment can be missing, the others may be compared plainly."""
    same = {"productseg1": "IS NOT DISTINCT FROM", "productSeg1": "IS NOT DISTINCT FROM"}
    return " AND ".join(f"{a}.{c} {same.get(c, '=')} {b}.{c}" for c in columns)


def _of(alias: str, columns: list[str]) -> str:
    return ", ".join(f"{alias}.{c}" for c in columns)


_PARTS: dict[str, str] = {}

# Weeks

_PARTS["iso_weeks"] = """
SELECT strftime(d, '%G%V') AS yw, row_number() OVER (ORDER BY d) AS idx
FROM (SELECT CAST(g AS DATE) AS d FROM generate_series(
        TIMESTAMP '1985-01-07', TIMESTAMP '2035-12-31', INTERVAL 7 DAY) AS s(g))
"""
_PARTS["steps"] = "SELECT CAST(n AS INTEGER) AS n FROM range(-25, 26) AS r(n)"
_PARTS["shift_reference"] = """
SELECT yw, n, CASE
    WHEN n > 0 THEN (SELECT b.yw FROM iso_weeks b WHERE b.idx = w.idx + n)
    WHEN wk + n >= 1 THEN lpad(CAST(y AS VARCHAR), 4, '0') || lpad(CAST(wk + n AS VARCHAR), 2, '0')
    ELSE lpad(CAST(y - 1 AS VARCHAR), 4, '0')
         || lpad(CAST(wk + n + weekofyear(make_date(y, 12, 28)) AS VARCHAR), 2, '0')
    END AS target
FROM (SELECT yw, idx, CAST(substr(yw, 1, 4) AS INTEGER) AS y,
             CAST(substr(yw, 5, 2) AS INTEGER) AS wk FROM iso_weeks) w, steps
"""
_PARTS["shift_corrected"] = """
SELECT a.yw, n, b.yw AS target
FROM iso_weeks a CROSS JOIN steps JOIN iso_weeks b ON b.idx = a.idx + n
"""

# Raw tables

_PARTS["order_lines"] = """
SELECT c_mktsegment, r_name, p_type, split_part(p_name, ' ', 2) AS noun,
       strftime(l_shipdate, '%G%V') AS ship_week, strftime(o_orderdate, '%G%V') AS order_week,
       l_quantity, l_extendedprice, l_discount, l_returnflag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
"""
_PARTS["lines"] = """
SELECT 'A01' AS regionSeg1, CAST(NULL AS VARCHAR) AS productSeg1, p_type AS productSeg2,
       c_mktsegment AS regionSeg2, r_name AS regionSeg3, noun AS productSeg3,
       ship_week AS yearweek, l_quantity AS qty
FROM order_lines
"""
_PARTS["sales"] = f"SELECT {_LINE}, yearweek, sum(qty) AS qty FROM lines GROUP BY ALL"
_PARTS["promo"] = """
SELECT 'A01' AS regionseg, c_mktsegment AS salesid, p_type AS productgroup, noun AS item,
       ship_week AS targetweek, min(order_week) AS planweek,
       CASE WHEN min(l_returnflag) = 'R' THEN 0
            ELSE CAST(floor(max(l_extendedprice / l_quantity)) AS BIGINT) END AS map_price,
       CAST(floor(max(l_extendedprice / l_quantity) * max(l_discount)) AS BIGINT) AS ir,
       0.0::DOUBLE AS pmap, 0.0::DOUBLE AS pmap10, 0.0::DOUBLE AS pro_percent
FROM order_lines WHERE l_discount >= 0.05 GROUP BY ALL
"""
_PARTS["entries"] = """
SELECT CASE event_type WHEN 'click' THEN 'average_window' WHEN 'view' THEN 'predict_range'
       WHEN 'purchase' THEN 'base_data' ELSE event_type END AS parameter,
       CAST(trunc(value) AS INTEGER) AS value
FROM events
"""
_PARTS["valid_entries"] = """
SELECT * FROM entries
WHERE (parameter = 'average_window' AND value BETWEEN 3 AND 8)
   OR (parameter = 'predict_range' AND value BETWEEN 4 AND 8)
   OR (parameter = 'base_data' AND value BETWEEN 4 AND 20)
"""
_PARTS["resolved_entries"] = """
SELECT d.parameter, CAST(coalesce(e.value, d.fallback) AS INTEGER) AS value
FROM (VALUES ('average_window', 5), ('predict_range', 5), ('base_data', 4),
             ('maxyearweek', 201627)) AS d(parameter, fallback)
LEFT JOIN (SELECT parameter, max(value) - CASE parameter WHEN 'base_data' THEN 1 ELSE 0 END AS value
           FROM entries GROUP BY parameter) e USING (parameter)
"""

# Promotions and panel

_PARTS["valid_promo"] = "SELECT * FROM promo WHERE targetweek >= planweek"
_PARTS["price_totals"] = f"""
SELECT {_P4}, CAST(sum(map_price) AS BIGINT) AS sum_price, count(*) AS row_count,
       count(*) FILTER (WHERE map_price = 0) AS zero_count
FROM valid_promo GROUP BY ALL
"""
_PARTS["average_prices"] = f"""
SELECT {_P4}, CASE WHEN row_count > zero_count THEN sum_price // (row_count - zero_count)
                   ELSE 0 END AS avg_price
FROM price_totals
"""
_PARTS["net_prices"] = f"""
SELECT {_P4}, targetweek, planweek, avg_price AS map_price,
       CASE WHEN avg_price = 0 THEN 0 ELSE ir END AS ir,
       CASE WHEN avg_price = 0 THEN 0 ELSE CAST(avg_price - ir AS DOUBLE) END AS pmap
FROM valid_promo JOIN average_prices USING ({_P4})
"""
_PARTS["refined"] = f"""
SELECT {_P4}, targetweek, planweek, map_price, ir, pmap, pmap10,
       CASE WHEN map_price = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - pmap10 / map_price END AS pro_percent
FROM (SELECT *, floor(pmap * 0.9::DOUBLE + 0.5::DOUBLE) AS pmap10 FROM net_prices)
"""
_SALES_PROMO = """s.regionSeg1 = p.regionseg AND s.regionSeg2 = p.salesid
AND s.productSeg2 = p.productgroup AND s.productSeg3 = p.item AND s.yearweek = p.targetweek"""
_PARTS["joined"] = f"""
SELECT s.regionSeg1 AS regionseg, s.productSeg1 AS productseg1, s.productSeg2 AS productgroup,
       s.regionSeg2 AS salesid, s.regionSeg3 AS regionseg3, s.productSeg3 AS item, s.yearweek,
       coalesce(p.map_price, 0) AS map_price, coalesce(p.ir, 0) AS ir,
       coalesce(p.pmap, 0) AS pmap, coalesce(p.pmap10, 0) AS pmap10,
       coalesce(p.pro_percent, 0) AS pro_percent, s.qty
FROM sales s LEFT JOIN refined p ON {_SALES_PROMO}
"""
_PARTS["bounds"] = f"""
SELECT {_K6}, min(yearweek) AS first_week, max(yearweek) AS last_week FROM joined GROUP BY ALL
"""
_PARTS["all_weeks"] = f"""
SELECT {_K6}, yw AS yearweek FROM bounds JOIN iso_weeks ON yw BETWEEN first_week AND last_week
"""
_PARTS["absent_weeks"] = f"""
SELECT * FROM all_weeks EXCEPT SELECT {_K6}, yearweek FROM joined
"""
_PARTS["filled"] = f"""
SELECT * FROM joined UNION ALL
SELECT {_K6}, yearweek, 0, 0, 0, 0, 0, 0 FROM absent_weeks
"""
_PARTS["panel_rows"] = """
SELECT *, CASE WHEN pro_percent = 0 THEN 'N' ELSE 'Y' END AS promotionNY FROM filled
"""
_PARTS["panel_weekly"] = f"""
SELECT {_K5}, yearweek, min(qty) AS qty FROM panel_rows WHERE productseg1 IS NULL GROUP BY ALL
"""


def _means(name: str, probes: str, values: str, shifts: str) -> None:
    """Part with the mean of the values found in the weeks that ``shifts`` leads to from each probe week.

    The weeks to look in are a part of their own, computed first: the values could
    otherwise be joined by series before the week narrows them down.
    """
    _PARTS[f"{name}_targets"] = f"""
SELECT {_of("p", K5)}, p.yearweek, s.target FROM {probes} p JOIN {shifts} s ON s.yw = p.yearweek
"""
    _PARTS[name] = f"""
SELECT {_of("p", K5)}, p.yearweek, CASE WHEN count(v.qty) = 0 THEN 0.0::DOUBLE
       ELSE sum(v.qty) / count(v.qty) END AS moving_avg
FROM {name}_targets p LEFT JOIN {values} v ON {_on("p", "v", K5)} AND v.yearweek = p.target
GROUP BY ALL
"""


for _name, _semantics, _half in (
    ("means_reference", "reference", 2),
    ("means_corrected", "corrected", 2),
    ("means_w4", "reference", 1),
    ("means_w7", "reference", 3),
):
    _near = f"near_{_semantics}_{_half}"
    _PARTS[_near] = f"SELECT * FROM shift_{_semantics} WHERE abs(n) <= {_half}"
    _means(_name, "panel_weekly", "panel_weekly", _near)

for _semantics in ("reference", "corrected"):
    _PARTS[f"seasonal_{_semantics}"] = f"""
SELECT {_of("p", _PANEL.split(", "))}, m.moving_avg,
       CASE WHEN m.moving_avg = 0 THEN 0.0::DOUBLE ELSE p.qty / m.moving_avg END AS seasonality
FROM panel_rows p JOIN means_{_semantics} m
  ON {_on("p", "m", K5)} AND p.yearweek = m.yearweek
"""
_PARTS["seasonal_weeks"] = f"SELECT {_K6}, yearweek, seasonality FROM seasonal_reference"
_PARTS["previous_targets"] = f"""
SELECT {_of("p", K6)}, p.yearweek, h.target FROM seasonal_weeks p
JOIN shift_reference h ON h.yw = p.yearweek AND h.n = -1
"""
_PARTS["near_targets"] = f"""
SELECT {_of("p", K5)}, p.yearweek, h.n, h.target FROM panel_weekly p
JOIN near_reference_2 h ON h.yw = p.yearweek
"""

# Forecasts.  A forecast "f" reads the parts f_cfg (one row: half, horizon, base_back,
# max_week), f_hist (rows that make series), and f_look (one row per series and week).


def _forecast_parts(f: str, keys: list[str], semantics: str, look: list[str] = K5) -> None:
    columns = ", ".join(keys)
    corrected = semantics == "corrected"
    divisor = "(base_back + 1)" if corrected else "4"
    scale = "base_seasonality / (base_back + 1)" if corrected else "base_seasonality"
    _PARTS[f"{f}_ahead"] = f"""
SELECT b.yw, CAST(substr(b.yw, 1, 4) AS INTEGER) AS y, substr(b.yw, 5, 2) AS wk
FROM {f}_cfg JOIN iso_weeks a ON a.yw = max_week
JOIN iso_weeks b ON b.idx BETWEEN a.idx + 1 AND a.idx + horizon
"""
    _PARTS[f"{f}_base"] = f"""
SELECT n, target FROM {f}_cfg JOIN shift_{semantics} ON yw = max_week AND n BETWEEN -base_back AND 0
"""
    _PARTS[f"{f}_series"] = f"""
SELECT {columns}, min(CAST(substr(yearweek, 1, 4) AS INTEGER)) AS first_year
FROM {f}_hist GROUP BY ALL
"""
    _PARTS[f"{f}_totals"] = f"""
SELECT {_of("s", keys)},
       list_reduce(list(coalesce(l.qty, 0.0::DOUBLE) ORDER BY b.n), lambda x, y: x + y) AS base_qty,
       list_reduce(list(coalesce(l.seasonality, 0.0::DOUBLE) ORDER BY b.n),
                   lambda x, y: x + y) AS base_seasonality
FROM {f}_series s CROSS JOIN {f}_base b
LEFT JOIN {f}_look l ON {_on("s", "l", look)} AND l.yearweek = b.target
GROUP BY ALL
"""
    _PARTS[f"{f}_level"] = f"""
SELECT {_of("t", keys)}, base_qty, base_seasonality, base_qty / {divisor} AS fcst
FROM {f}_totals t, {f}_cfg
"""
    if corrected:
        _PARTS[f"{f}_week"] = f"""
SELECT {_of("s", keys)}, a.yw AS yearweek,
       CASE WHEN count(l.yearweek) = 0 THEN 0.0::DOUBLE ELSE
       list_reduce(list(l.seasonality ORDER BY l.yearweek) FILTER (WHERE l.yearweek IS NOT NULL),
                   lambda x, y: x + y) / count(l.yearweek) END AS seasonality
FROM {f}_series s CROSS JOIN {f}_ahead a
LEFT JOIN {f}_look l ON {_on("s", "l", K5)} AND substr(l.yearweek, 5, 2) = a.wk
     AND substr(l.yearweek, 1, 4) < substr(a.yw, 1, 4)
GROUP BY ALL
"""
    else:
        _PARTS[f"{f}_fold"] = f"""
SELECT {columns}, a.yw AS yearweek, a.wk, first_year - 1 AS y, 0.0::DOUBLE AS value, 0 AS hits,
       (SELECT max(y) FROM {f}_ahead) - 1 AS last_year
FROM {f}_series CROSS JOIN {f}_ahead a
UNION ALL
SELECT {_of("g", keys)}, g.yearweek, g.wk, g.y + 1,
       CASE WHEN g.hits + CASE WHEN l.yearweek IS NULL THEN 0 ELSE 1 END = 0 THEN g.value
            ELSE (g.value + coalesce(l.seasonality, 0))
                 / (g.hits + CASE WHEN l.yearweek IS NULL THEN 0 ELSE 1 END) END,
       g.hits + CASE WHEN l.yearweek IS NULL THEN 0 ELSE 1 END, g.last_year
FROM {f}_fold g LEFT JOIN {f}_look l
  ON {_on("g", "l", K5)} AND l.yearweek = lpad(CAST(g.y + 1 AS VARCHAR), 4, '0') || g.wk
WHERE g.y < g.last_year
"""
        _PARTS[f"{f}_week"] = f"""
SELECT {columns}, yearweek, value AS seasonality FROM {f}_fold WHERE y >= last_year
"""
    _PARTS[f"{f}_values"] = f"""
SELECT {_of("w", keys)}, w.yearweek, t.fcst, w.seasonality,
       CASE WHEN {scale} = 0 THEN 0.0::DOUBLE
            ELSE (t.fcst * w.seasonality) / ({scale}) END AS time_series
FROM {f}_week w JOIN {f}_level t ON {_on("w", "t", keys)}, {f}_cfg
"""


def _picked(keys: list[str], rows: str, pick: str = "min") -> str:
    """Per key and week quantity and seasonality of the smallest (largest) row by both; neither is null here."""
    columns = ", ".join(keys)
    return f"""
SELECT {columns}, yearweek, v.q AS qty, v.s AS seasonality FROM (
  SELECT {columns}, yearweek, {pick}(struct_pack(q := qty, s := seasonality)) AS v FROM {rows} GROUP BY ALL)
"""


def _stage_forecast(f: str, source: str, semantics: str, hist: str) -> None:
    """Forecast stage on a seasonality panel."""
    _PARTS[f"{f}_cfg"] = f"""
SELECT 2 AS half, 5 AS horizon, 3 AS base_back, max(yearweek) AS max_week FROM {source}
"""
    _PARTS[f"{f}_hist"] = hist
    _PARTS[f"{f}_look"] = _picked(K5, f"{source} WHERE productseg1 IS NULL")
    _forecast_parts(f, K6, semantics)
    _PARTS[f"{f}_rows"] = f"""
SELECT *, 0.0::DOUBLE AS fcst, 0.0::DOUBLE AS time_series FROM {f}_hist
UNION ALL
SELECT {_K6}, yearweek, 0, 0, 0, 0, 0, 0, 'N', 0, seasonality, fcst, time_series FROM {f}_values
"""


def _active(source: str, semantics: str, condition: str = "TRUE") -> str:
    return f"""
SELECT r.* FROM {source} r SEMI JOIN (
  SELECT * FROM {source}
  WHERE {condition} AND yearweek >= (SELECT target FROM shift_{semantics}
    WHERE n = -7 AND yw = (SELECT max(yearweek) FROM {source}))) k ON {_on("r", "k", K6)}
"""


for _semantics in ("reference", "corrected"):
    _source = f"seasonal_{_semantics}"
    _PARTS[f"active_{_semantics}"] = _active(_source, _semantics)
    _stage_forecast(f"fc_{_semantics}", _source, _semantics, f"SELECT * FROM active_{_semantics}")
    _stage_forecast(f"all_{_semantics}", _source, _semantics, f"SELECT * FROM {_source}")
_PARTS["selling"] = _active("seasonal_reference", "reference", "qty <> 0")
_stage_forecast("fc_selling", "seasonal_reference", "reference", "SELECT * FROM selling")

_PARTS["line_values"] = f"""
SELECT 'A01' AS regionseg, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS productseg1,
       p_type AS productgroup, c_mktsegment AS salesid, r_name AS regionseg3, noun AS item,
       ship_week AS yearweek, l_quantity AS qty, l_discount AS seasonality
FROM order_lines
"""
for _semantics, _look, _seen in (("reference", K5, "WHERE productseg1 IS NULL"), ("corrected", K6, "")):
    _stage_forecast(f"lines_{_semantics}", "line_values", _semantics, "SELECT * FROM line_values")
    _PARTS[f"lines_{_semantics}_look"] = _picked(_look, f"line_values {_seen}")
    _forecast_parts(f"lines_{_semantics}", K6, _semantics, _look)

_PARTS["mart"] = f"""
SELECT {_K5}, yearweek, substr(yearweek, 1, 4) AS year, substr(yearweek, 5, 2) AS week,
       {_MEASURES}, qty, CASE WHEN promotionNY = 'Y' THEN 1 ELSE 0 END AS promotionNY,
       moving_avg, seasonality, fcst, time_series
FROM fc_reference_rows
"""
_PARTS["latest_week"] = "SELECT max(yearweek) AS yw FROM sales"


def _mart_forecast(f: str, semantics: str, recompute: bool, max_week: str) -> None:
    """Re-forecast of the mart with the settings of the entry table."""
    corrected = semantics == "corrected"
    _PARTS[f"{f}_cfg"] = f"""
SELECT (max(value) FILTER (WHERE parameter = 'average_window') - 1) // 2 AS half,
       max(value) FILTER (WHERE parameter = 'predict_range') AS horizon,
       max(value) FILTER (WHERE parameter = 'base_data') - 1 AS base_back,
       {max_week} AS max_week
FROM valid_entries
"""
    _PARTS[f"{f}_hist"] = f"SELECT mart.* FROM mart, {f}_cfg WHERE yearweek <= max_week"
    seen = f"{f}_hist" if corrected else "mart"
    _PARTS[f"{f}_known"] = _picked(K5, seen, "max")
    # Averages enter the result in the trailing weeks, the forecast's weeks and, through
    # look-ups, in weeks of the forecast's week numbers.
    _PARTS[f"{f}_probes"] = f"""
SELECT {_K5}, yearweek FROM {f}_hist
WHERE yearweek >= (SELECT target FROM {f}_base ORDER BY n LIMIT 1)
   OR substr(yearweek, 5, 2) IN (SELECT wk FROM {f}_ahead)
UNION SELECT {_K5}, yw FROM {f}_series CROSS JOIN {f}_ahead
"""
    _PARTS[f"{f}_near"] = f"SELECT s.* FROM shift_{semantics} s, {f}_cfg WHERE abs(n) <= half"
    _means(f"{f}_means", f"{f}_probes", f"{f}_known", f"{f}_near")
    if corrected and recompute:
        _PARTS[f"{f}_look"] = f"""
SELECT {_of("v", K5)}, v.yearweek, v.qty,
       CASE WHEN moving_avg = 0 THEN 0.0::DOUBLE ELSE v.qty / moving_avg END AS seasonality
FROM {f}_known v JOIN {f}_means m ON {_on("v", "m", K5)} AND v.yearweek = m.yearweek
"""
    else:
        _PARTS[f"{f}_look"] = f"SELECT * FROM {f}_known"
    _forecast_parts(f, K5, semantics)
    _PARTS[f"{f}_trailing"] = f"""
SELECT h.* FROM {f}_hist h
WHERE yearweek >= (SELECT target FROM {f}_base ORDER BY n LIMIT 1)
"""
    if recompute:
        join = f"JOIN {f}_means m ON {_on('t', 'm', K5)} AND t.yearweek = m.yearweek"
        average = "m.moving_avg"
        ratio = "CASE WHEN m.moving_avg = 0 THEN 0.0::DOUBLE ELSE t.qty / m.moving_avg END"
        ahead_average = "m.moving_avg"
    else:
        join, average, ratio, ahead_average = "", "t.moving_avg", "t.seasonality", "0"
    head = [*K5, "yearweek", "year", "week", *_MEASURES.split(", "), "qty", "promotionNY"]
    _PARTS[f"{f}_rows"] = f"""
SELECT {_of("t", head)}, {average} AS moving_avg, {ratio} AS seasonality,
       0.0::DOUBLE AS fcst, 0.0::DOUBLE AS time_series
FROM {f}_trailing t {join}
UNION ALL
SELECT {_of("t", K5)}, t.yearweek, substr(t.yearweek, 1, 4), substr(t.yearweek, 5, 2),
       0, 0, 0, 0, 0, 0, 0, {ahead_average}, t.seasonality, t.fcst, t.time_series
FROM {f}_values t {join}
"""


_LATEST = "(SELECT yw FROM latest_week)"
_EARLIER = (
    "(SELECT CAST(CAST(substr(yw, 1, 4) AS INTEGER) - 1 AS VARCHAR) || '50' FROM latest_week)"
)
for _f, _semantics, _recompute, _week in (
    ("re_ref", "reference", False, _LATEST),
    ("re_new", "reference", True, _LATEST),
    ("re_cor", "corrected", False, _LATEST),
    ("re_new_cor", "corrected", True, _LATEST),
    ("re_early", "reference", True, _EARLIER),
    ("re_early_cor", "corrected", True, _EARLIER),
):
    _mart_forecast(_f, _semantics, _recompute, _week)

_REFERENCES = re.compile(r"\b[a-z_0-9]+\b")


def _needs(sql: str) -> list[str]:
    return [name for name in dict.fromkeys(_REFERENCES.findall(sql)) if name in _PARTS]


def statement(final: str) -> str:
    """``final`` preceded by every part it refers to, in dependency order."""
    ordered: dict[str, str] = {}

    def visit(name: str, above: tuple[str, ...]) -> None:
        if name in ordered or name in above:
            return
        for needed in _needs(_PARTS[name]):
            visit(needed, (*above, name))
        ordered[name] = _PARTS[name].strip()

    for name in _needs(final):
        visit(name, ())
    if not ordered:
        return final
    uses = [n for sql in (final, *ordered.values()) for n in _needs(sql)]

    def kind(name: str) -> str:
        # A recursive part refers to itself; one that several others name is computed once,
        # one of look-up weeks before the join it is made for.
        if name in _needs(ordered[name]):
            return ""
        return "MATERIALIZED " if uses.count(name) > 1 or name.endswith("_targets") else ""

    parts = ",\n".join(f"{name} AS {kind(name)}({sql})" for name, sql in ordered.items())
    return f"WITH RECURSIVE {parts}\n{final}"


def _means_query(part: str) -> str:
    return f"""SELECT {_of("p", K6)}, p.yearweek, p.qty, m.moving_avg FROM panel_rows p
JOIN {part} m ON {_on("p", "m", K5)} AND p.yearweek = m.yearweek"""


def _first_line(order: str) -> str:
    return f"SELECT {_LINE}, yearweek, {order}(qty) AS qty FROM lines GROUP BY ALL"


def _shift_query(semantics: str) -> str:
    return f"""SELECT {_LINE}, yearweek, CAST(s.qty AS INTEGER) % 17 - 8 AS weeks, h.target AS shifted
FROM sales s JOIN shift_{semantics} h ON h.yw = s.yearweek AND h.n = CAST(s.qty AS INTEGER) % 17 - 8"""


_MART = ", ".join(MART_COLUMNS)
_CUT = "yearweek <= (SELECT yw FROM latest_week)"
_VALID_PRICED = "SELECT * FROM promo WHERE targetweek >= planweek AND map_price <> 0"
_GLOBAL_PRICED = """SELECT * FROM promo WHERE map_price <> 0 AND CAST(targetweek AS INTEGER)
>= (SELECT min(CAST(planweek AS INTEGER)) FROM promo)"""
_SITE_ITEM = f"regionseg3 = '{SITE}' AND item = '{ITEM}'"
_POINT = "max(time_series) AS value FROM mart GROUP BY regionseg3, item, yearweek"

_EDITED = f"""SELECT {", ".join(c for c in MART_COLUMNS if c != "ir")},
CASE WHEN regionseg = '{REGION}' AND week = '30' THEN 7 ELSE ir END AS ir FROM (
  SELECT {", ".join(c for c in MART_COLUMNS if c != "qty")}, CASE WHEN productgroup = '{GROUP}' AND week = '10' THEN 1000 + max(qty)
    OVER (PARTITION BY regionseg, regionseg3, salesid, productgroup, item, yearweek) ELSE qty END AS qty
  FROM mart WHERE NOT (item = '{ITEM}' AND week = '20')
  UNION ALL BY NAME SELECT {", ".join(c for c in MART_COLUMNS if c != "fcst")}, CAST(-1 AS DOUBLE) AS fcst
  FROM mart WHERE productgroup = '{GROUP}' AND week = '30')"""

_FINAL = {
    "csv_roundtrip": "SELECT * FROM promo",
    "csv_reordered": "SELECT * FROM promo",
    "csv_accepted": f"SELECT * FROM promo WHERE item <> '{ITEM}' AND substr(targetweek, 5) <> '20'",
    "csv_rejected": f"""SELECT 'map_price' AS column, 'not a value of type bigint' AS reason, count(*) AS n
FROM promo WHERE item = '{ITEM}' UNION ALL
SELECT 'targetweek', 'no ISO week', count(*) FROM promo WHERE substr(targetweek, 5) = '20'""",
    "scan_all": "SELECT * FROM sales",
    "partitioned_roundtrip": f"SELECT {_MART} FROM mart",
    "preview_top2": f"SELECT * FROM sales ORDER BY {_LINE}, yearweek, qty LIMIT 2",
    "normalize_columns": """SELECT regionSeg1 AS regionseg1, productSeg1 AS productseg1,
productSeg2 AS productseg2, regionSeg2 AS regionseg2, regionSeg3 AS regionseg3,
productSeg3 AS productseg3, yearweek, qty FROM sales""",
    "typed_panel": f"SELECT {_PANEL} FROM panel_rows",
    "shift_week_ref": _shift_query("reference"),
    "shift_week_cor": _shift_query("corrected"),
    "weeks_in_year": """SELECT y AS year, CAST(weekofyear(make_date(y, 12, 28)) AS INTEGER) AS weeks
FROM (SELECT DISTINCT CAST(substr(yearweek, 1, 4) AS INTEGER) AS y FROM sales)""",
    "promo_filter_row": "SELECT * FROM valid_promo",
    "promo_filter_row_price": _VALID_PRICED,
    "promo_filter_global": _GLOBAL_PRICED,
    "min_plan_week": "SELECT min(CAST(planweek AS INTEGER)) AS min_plan_week FROM promo",
    "price_stats": "SELECT * FROM price_totals",
    "avg_nonzero_price": "SELECT * FROM average_prices",
    "price_refinement": "SELECT * FROM refined",
    "sales_promo_join": "SELECT * FROM joined",
    "sales_promo_join_promo_side": f"""SELECT p.*, s.qty FROM sales s
LEFT JOIN ({_VALID_PRICED}) p ON {_SALES_PROMO}""",
    "sales_promo_join_sales_side": f"""SELECT s.*, {_of("p", _MEASURES.split(", "))} FROM sales s
LEFT JOIN ({_GLOBAL_PRICED}) p ON {_SALES_PROMO}""",
    "key_exists": f"SELECT s.* FROM sales s SEMI JOIN refined p ON {_SALES_PROMO}",
    "series_bounds": """SELECT *, CAST(substr(first_week, 1, 4) AS INTEGER) AS first_year,
CAST(substr(last_week, 1, 4) AS INTEGER) AS last_year FROM bounds""",
    "week_calendar": "SELECT * FROM all_weeks",
    "missing_weeks": "SELECT * FROM absent_weeks",
    "missing_weeks_by_difference": "SELECT * FROM absent_weeks",
    "gap_fill": "SELECT * FROM filled",
    "promotion_flag": """SELECT *, CASE WHEN pro_percent = 0 THEN 'N' ELSE 'Y' END AS promotionNY
FROM joined""",
    "panel_sorted": f"""SELECT {_PANEL} FROM panel_rows
ORDER BY regionseg, productgroup, salesid, regionseg3, item, yearweek""",
    "panel": f"SELECT {_PANEL} FROM panel_rows",
    "qty_lookup": f"""SELECT *, min(qty) OVER (PARTITION BY {_LINE}, yearweek) AS first_qty
FROM lines""",
    "seasonality_lookup": f"""SELECT {_of("p", K6)}, p.yearweek, p.target AS previous_week,
q.seasonality AS previous_seasonality FROM previous_targets p
LEFT JOIN seasonal_weeks q ON {_on("p", "q", K6)} AND q.yearweek = p.target""",
    "dedupe_first": _first_line("min"),
    "dedupe_last": _first_line("max"),
    "max_year_week": "SELECT max(yearweek) AS max_year_week FROM sales",
    "moving_avg_ref": _means_query("means_reference"),
    "moving_avg_cor": _means_query("means_corrected"),
    "moving_avg_w4": _means_query("means_w4"),
    "moving_avg_w7": _means_query("means_w7"),
    "shifted_join": f"""SELECT {_of("p", K5)}, p.yearweek, p.n AS "offset", p.target AS met_week,
v.qty AS met_value FROM near_targets p JOIN panel_weekly v ON {_on("p", "v", K5)} AND v.yearweek = p.target""",
    "seasonality_ref": "SELECT * FROM seasonal_reference",
    "seasonality_cor": "SELECT * FROM seasonal_corrected",
    "drop_inactive": "SELECT * FROM active_reference",
    "drop_zero_demand": "SELECT * FROM selling",
    "extend_horizon": f"""SELECT * FROM seasonal_reference UNION ALL
SELECT {_K6}, yw, 0, 0, 0, 0, 0, 0, 'N', 0, 0 FROM all_reference_series CROSS JOIN all_reference_ahead""",
    "prior_year_join": f"""SELECT {_of("s", K6)}, a.yw AS yearweek, q.yearweek AS prior_yearweek,
q.seasonality FROM all_reference_series s CROSS JOIN all_reference_ahead a
JOIN seasonal_reference q ON {_on("s", "q", K6)} AND substr(q.yearweek, 5, 2) = a.wk
 AND substr(q.yearweek, 1, 4) < substr(a.yw, 1, 4)""",
    "base_window_ref": f"SELECT {_K6}, base_qty, base_seasonality FROM all_reference_level",
    "base_window_cor": f"SELECT {_K6}, base_qty, base_seasonality FROM all_corrected_level",
    "base_window_lines_ref": f"SELECT {_K6}, base_qty, base_seasonality FROM lines_reference_level",
    "base_window_lines_cor": f"SELECT {_K6}, base_qty, base_seasonality FROM lines_corrected_level",
    "base_level_ref": f"SELECT {_K6}, fcst FROM all_reference_level",
    "base_level_cor": f"SELECT {_K6}, fcst FROM all_corrected_level",
    "week_of_year_seasonality_ref": "SELECT * FROM all_reference_week",
    "week_of_year_seasonality_cor": "SELECT * FROM all_corrected_week",
    "forecast_ref": "SELECT * FROM fc_reference_rows",
    "forecast_cor": "SELECT * FROM fc_corrected_rows",
    "forecast_drop_zero": "SELECT * FROM fc_selling_rows",
    "param_validate": "SELECT * FROM valid_entries",
    "param_append": """SELECT * FROM resolved_entries UNION ALL SELECT * FROM valid_entries""",
    "param_update": f"""SELECT parameter, CASE WHEN parameter = 'average_window'
THEN {UPDATED_WINDOW} ELSE value END AS value FROM entries""",
    "param_versions": f"""SELECT parameter, CASE WHEN parameter = 'average_window'
THEN {UPDATED_WINDOW} ELSE value END AS value
FROM (SELECT * FROM resolved_entries UNION ALL SELECT * FROM valid_entries)""",
    "param_edits": f"""SELECT parameter, CASE WHEN parameter = 'average_window'
THEN {UPDATED_WINDOW} ELSE value END AS value
FROM (SELECT * FROM resolved_entries UNION ALL SELECT * FROM valid_entries)""",
    "mart_edits": _EDITED,
    "mart_edits_compacted": _EDITED,
    "reforecast_published": "SELECT * FROM re_ref_rows",
    "resolve_params": "SELECT * FROM resolved_entries",
    "reforecast_ref": "SELECT * FROM re_ref_rows",
    "reforecast_upper_columns": "SELECT * FROM re_ref_rows",
    "reforecast_job": "SELECT * FROM re_ref_rows",
    "reforecast_recompute": "SELECT * FROM re_new_rows",
    "reforecast_cor": "SELECT * FROM re_cor_rows",
    "reforecast_recompute_cor": "SELECT * FROM re_new_cor_rows",
    "reforecast_earlier_ref": "SELECT * FROM re_early_rows",
    "reforecast_earlier_cor": "SELECT * FROM re_early_cor_rows",
    "cut_history": f"SELECT {_MART} FROM mart WHERE {_CUT}",
    "trailing_output": f"""SELECT {_MART} FROM mart WHERE yearweek >= (SELECT target
FROM shift_reference WHERE n = -4 AND yw = (SELECT max(yearweek) FROM mart))""",
    "final_mart": f"SELECT {_MART} FROM mart",
    "display_view": f"SELECT {', '.join(DISPLAY_COLUMNS)} FROM mart",
    "mart_before": f"""SELECT {_MART} FROM mart WHERE productgroup = '{GROUP}'
AND CAST(yearweek AS INTEGER) < {BEFORE_WEEK}""",
    "mart_after": f"""SELECT {_MART} FROM mart WHERE productgroup = '{GROUP}'
AND CAST(yearweek AS INTEGER) > {AFTER_WEEK}""",
    "drill_down": f"""SELECT {_MART} FROM mart WHERE regionseg = '{REGION}'
AND productgroup = '{GROUP}' AND {_SITE_ITEM} ORDER BY yearweek""",
    "drill_down_clustered": f"""SELECT {_MART} FROM mart WHERE regionseg = '{REGION}'
AND productgroup = '{GROUP}' AND {_SITE_ITEM} ORDER BY yearweek""",
    "drill_down_series": f"""SELECT regionseg, regionseg3, productgroup, item,
CAST(row_number() OVER (PARTITION BY regionseg, regionseg3, productgroup, item ORDER BY yearweek) - 1
AS INTEGER) AS pos, yearweek, value FROM (
  SELECT regionseg, regionseg3, productgroup, item, yearweek, max(time_series) AS value FROM mart
  WHERE regionseg = '{REGION}' AND productgroup = '{GROUP}' GROUP BY ALL)""",
    "item_series": f"SELECT yearweek, time_series FROM mart WHERE {_SITE_ITEM} ORDER BY yearweek",
    "item_series_clustered": f"SELECT yearweek, time_series FROM mart WHERE {_SITE_ITEM} ORDER BY yearweek",
    "item_list": "SELECT DISTINCT item FROM mart ORDER BY item",
    "row_count": "SELECT count(*) AS row_count FROM mart",
    "series_array": f"""SELECT regionseg3, item, CAST(row_number() OVER (
PARTITION BY regionseg3, item ORDER BY yearweek) - 1 AS INTEGER) AS pos, yearweek, value
FROM (SELECT regionseg3, item, yearweek, {_POINT})""",
    "chart_points": """SELECT regionseg3, item, string_agg('[''' || yearweek || ''', '
|| CAST(value AS VARCHAR) || ']', ',' ORDER BY yearweek) AS points
FROM (SELECT regionseg3, item, yearweek, max(qty) AS value FROM mart GROUP BY ALL)
GROUP BY ALL""",
}

CHECKS = {name: statement(final) for name, final in _FINAL.items()}
