"""SQL equivalents of the registered queries, for a second engine over the same tables.

Kept apart from the DataFrame code on purpose: nothing here is derived from it.
"""

from __future__ import annotations

_CAPTAINS = """
dim_captains AS (
  SELECT s_suppkey AS captain_id, s_name AS name,
         (25 + (s_suppkey * 7) % 26) / 10.0::DOUBLE AS rating,
         CAST(20 + s_suppkey % 41 AS BIGINT) AS avg_speed_kmh,
         CAST(4 + s_suppkey % 9 AS BIGINT) AS active_hours,
         n_name AS district,
         CAST(50 + (s_suppkey * 37) % 4951 AS BIGINT) AS total_deliveries,
         (60 + s_suppkey % 40) / 100.0::DOUBLE AS on_time_rate
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

_RESTAURANTS = """
dim_restaurants AS (
  SELECT p_partkey AS restaurant_id, p_name AS name, p_type AS cuisine_type,
         CAST(5 + (p_size - 1) % 31 AS BIGINT) AS avg_prep_time_min,
         (25 + p_partkey % 26) / 10.0::DOUBLE AS rating,
         p_brand AS district,
         CAST(100 + (p_partkey * 13) % 9901 AS BIGINT) AS total_orders
  FROM part
)"""

_FACT = """
lines AS (
  SELECT l_orderkey, min(l_suppkey) AS captain, max(l_partkey) AS restaurant, count(*) AS n
  FROM lineitem GROUP BY l_orderkey
),
f1 AS (
  SELECT o_orderkey AS k, o_custkey AS cust, captain, restaurant, r.district AS district,
         7 + o_orderkey % 17 AS hh,
         o_orderdate + to_hours(CAST(7 + o_orderkey % 17 AS INTEGER))
                     + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS moment,
         greatest(5, r.avg_prep_time_min + o_orderkey % 9 - 3) AS prep,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'stormy' WHEN '2' THEN 'very_hot'
              WHEN '3' THEN 'cloudy' WHEN '4' THEN 'cold' ELSE 'clear' END AS weather,
         CASE WHEN n <= 2 THEN 'light' WHEN n <= 4 THEN 'medium' WHEN n <= 6 THEN 'heavy'
              ELSE 'severe' END AS traffic,
         (1500 + CAST(round(o_totalprice * 100) AS BIGINT) % 33501) / 100.0::DOUBLE AS val
  FROM orders JOIN lines ON l_orderkey = o_orderkey
       JOIN dim_restaurants r ON r.restaurant_id = restaurant
),
f2 AS (
  SELECT *, CASE WHEN hh IN (12, 13, 19, 20, 21) THEN 1 ELSE 0 END AS peak FROM f1
),
f3 AS (
  SELECT *, prep + 10 + cust % 26
      + CASE weather WHEN 'stormy' THEN 5 + k % 6 WHEN 'very_hot' THEN 2 + k % 4 ELSE 0 END
      + CASE traffic WHEN 'severe' THEN 8 + k % 5 WHEN 'heavy' THEN 3 + k % 5 ELSE 0 END
      + CASE WHEN peak = 1 THEN 3 + k % 6 ELSE 0 END
      + CASE WHEN (25 + (captain * 7) % 26) < 35 THEN 2 + k % 4 ELSE 0 END AS mins
  FROM f2
),
fact_orders AS (
  SELECT k AS order_id, cust AS customer_id, captain AS captain_id, restaurant AS restaurant_id,
         district, moment AS order_time, CAST(mins AS BIGINT) AS delivery_time_min,
         CAST(prep AS BIGINT) AS prep_time_min, weather, traffic AS traffic_level,
         val AS order_value_sar,
         CASE WHEN k % 100 < 5 + CASE WHEN weather = 'stormy' THEN 4 ELSE 0 END
                               + CASE WHEN traffic = 'severe' THEN 3 ELSE 0 END
                               + CASE WHEN mins > 60 THEN 5 ELSE 0 END THEN 'cancelled'
              WHEN mins > 50 THEN 'delayed' ELSE 'delivered' END AS status,
         CAST(hh AS BIGINT) AS hour_of_day, dayname(moment) AS day_of_week,
         CAST(peak AS BIGINT) AS is_peak_hour,
         CAST(CASE WHEN mins > 50 THEN 1 ELSE 0 END AS BIGINT) AS is_delayed
  FROM f3
)"""

_STAR = f"WITH {_CAPTAINS},{_RESTAURANTS},{_FACT}"


def _star(body: str, *more: str) -> str:
    extra = "".join(f",\n{cte}" for cte in more)
    return f"{_STAR}{extra}\n{body}"


def _up(s: str, n: str, digits: int) -> str:
    """s / n in whole numbers, halves away from zero."""
    top = f"abs(CAST({s} AS HUGEINT))"
    return f"(sign({s}) * ((2 * {top} * {10**digits} + {n}) // (2 * {n}))::DOUBLE / {10**digits}::DOUBLE)"


def _even(s: str, n: str, digits: int) -> str:
    """s / n in whole numbers, halves to the even digit."""
    top = f"(abs(CAST({s} AS HUGEINT)) * {10**digits})"
    up = (
        f"CASE WHEN 2 * ({top} % {n}) > {n} OR (2 * ({top} % {n}) = {n} AND ({top} // {n}) % 2 = 1) THEN 1 ELSE 0 END"
    )
    return f"(sign({s}) * ({top} // {n} + {up})::DOUBLE / {10**digits}::DOUBLE)"


def _settled(x: str, digits: int) -> str:
    return f"round(round({x}, 9), {digits})"


def _big(x: str, name: str) -> str:
    return f"CAST({x} AS BIGINT) AS {name}"


_MINUTES = ("sum(delivery_time_min)", "count(delivery_time_min)")
_CENTS = "sum(CAST(round(order_value_sar * 100) AS BIGINT))"
_VALUE = (_CENTS, "(100 * count(order_value_sar))")
_FLAGGED = "sum(CASE WHEN is_delayed = 1 THEN 1 ELSE 0 END)"
_RATE = (f"(100 * {_FLAGGED})", "count(*)")
_MEAN_RATE = ("(100 * sum(is_delayed))", "count(is_delayed)")
_MART_RATE = ("(100 * sum(is_delayed))", "count(order_id)")
_TIME_TEXT = "strftime(order_time, '%Y-%m-%d %H:%M:%S') AS order_time"

_SPEED = """CASE WHEN delivery_time_min <= 30 THEN 'fast' WHEN delivery_time_min <= 50 THEN 'normal'
            ELSE 'slow' END AS delivery_speed"""
_SEGMENT = """CASE WHEN order_value_sar >= 200 THEN 'high' WHEN order_value_sar >= 100 THEN 'medium'
            ELSE 'low' END AS order_value_segment"""
_TIER = """CASE WHEN rating >= 4.5 THEN 'excellent' WHEN rating >= 3.5 THEN 'good'
            WHEN rating >= 2.5 THEN 'average' ELSE 'poor' END AS performance_tier"""
_PREP = """CASE WHEN avg_prep_time_min <= 10 THEN 'fast' WHEN avg_prep_time_min <= 20 THEN 'normal'
            ELSE 'slow' END AS prep_speed_tier"""

_ORDERS_AS_TEXT = f"SELECT * REPLACE ({_TIME_TEXT}) FROM fact_orders"

_SCATTER = f"""
scatter AS (
  SELECT c.captain_id, c.rating, count(o.order_id) AS total_orders,
         {_even(*_MINUTES, 1)} AS avg_time, {_even(*_MEAN_RATE, 1)} AS delay_rate
  FROM fact_orders o JOIN dim_captains c ON o.captain_id = c.captain_id
  GROUP BY c.captain_id, c.rating
)"""

_SLOT_KEYS = "district, hour_of_day, day_of_week, is_peak_hour, weather, traffic_level"
_SLOTS = f"""
slots AS (
  SELECT {_SLOT_KEYS}, count(*) AS order_count FROM fact_orders GROUP BY {_SLOT_KEYS}
),
split_slots AS (
  SELECT *, CASE WHEN substr(md5(concat_ws('|', district, hour_of_day, day_of_week, is_peak_hour,
                                 weather, traffic_level) || ':42'), 1, 4) < 'cccd'
                 THEN 'train' ELSE 'test' END AS split
  FROM slots
)"""

_ROWS = """
rows_ AS (
  SELECT o.order_id, o.hour_of_day, o.is_peak_hour, o.order_value_sar, o.weather, o.traffic_level,
         o.day_of_week, o.district, c.rating AS captain_rating, c.avg_speed_kmh AS captain_speed,
         r.cuisine_type, o.is_delayed
  FROM fact_orders o JOIN dim_captains c ON o.captain_id = c.captain_id
       JOIN dim_restaurants r ON o.restaurant_id = r.restaurant_id
)"""


def _codes(name: str, column: str, table: str) -> str:
    return f"""
{name} AS (
  SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
  FROM (SELECT DISTINCT {column} AS v FROM {table})
)"""


_CODES = ",".join(
    [
        _codes("c_weather", "weather", "rows_"),
        _codes("c_traffic", "traffic_level", "rows_"),
        _codes("c_day", "day_of_week", "rows_"),
        _codes("c_district", "district", "rows_"),
        _codes("c_cuisine", "cuisine_type", "rows_"),
    ]
)


def _slowest(keys: str) -> str:
    return _star(f"""
SELECT {keys}, count(o.order_id) AS total_orders, {_up("sum(o.prep_time_min)", "count(o.prep_time_min)", 1)} AS avg_prep_min,
       {_up(*_MINUTES, 1)} AS avg_total_min, {_up(*_RATE, 1)} AS delay_rate_pct
FROM fact_orders o JOIN dim_restaurants r ON o.restaurant_id = r.restaurant_id
GROUP BY {keys} ORDER BY avg_prep_min DESC, {keys} LIMIT 5""")


def _dq(table: str, column: str, test: str, bad: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, "
        f"(SELECT count(*) FROM ({bad})) AS failures"
    )


def _dq_unique(table: str, column: str, source: str | None = None) -> str:
    bad = f"SELECT {column} FROM {source or table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return _dq(table, column, "unique", bad)


def _dq_null(table: str, column: str, source: str | None = None) -> str:
    return _dq(table, column, "not_null", f"SELECT 1 FROM {source or table} WHERE {column} IS NULL")


def _dq_values(table: str, column: str, values: str, source: str | None = None) -> str:
    bad = f"SELECT DISTINCT {column} FROM {source or table} WHERE {column} NOT IN ({values})"
    return _dq(table, column, "accepted_values", bad)


_GRAIN = "district, hour_of_day, day_of_week, is_peak_hour, weather, traffic_level, status"

# ---- dataset builder: draws are 32-bit slices of md5(id:seed:block) ----


def _slice(block: int, i: int) -> str:
    return f"CAST('0x' || substr(b{block}, {1 + 8 * i}, 8) AS BIGINT)"


def _draws(source: str, seed: int, names: str) -> str:
    """A frame (id, <names>) of uniform integers below 2**32."""
    listed = names.split()
    blocks = ", ".join(
        f"md5(id || ':{seed}:{b}') AS b{b}" for b in range((len(listed) + 3) // 4)
    )
    columns = ", ".join(f"{_slice(i // 4, i % 4)} AS {name}" for i, name in enumerate(listed))
    return f"SELECT id, {columns} FROM (SELECT id, {blocks} FROM ({source}))"


def _pick(draw: str, n: int | str) -> str:
    return f"(({draw} * {n}) >> 32)"


def _from_list(draw: str, values: list) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"[{items}][{_pick(draw, len(values))} + 1]"


def _rounded(draw: str, low: int, width: int, scale: str) -> str:
    return f"(({low} + {_pick(draw, width)} + 50) // 100) / {scale}::DOUBLE"


# fixed domain values
_ZONES = {
    "العليا": 18,
    "النخيل": 33,
    "الملقا": 47,
    "حطين": 59,
    "الياسمين": 70,
    "الورود": 79,
    "السليمانية": 87,
    "المروج": 94,
    "الربوة": 98,
    "الشهداء": 100,
}
_SKIES = ["صافي", "غائم", "عاصف", "حار جداً", "بارد"]
_ROADS = ["خفيف", "متوسط", "كثيف", "شديد الكثافة"]
_KITCHENS = ["برغر", "مندي", "بيتزا", "سوشي", "مشاوي", "فراخ", "حلويات"]


def _zone(draw: str) -> str:
    steps = " ".join(f"WHEN {_pick(draw, 100)} < {edge} THEN '{zone}'" for zone, edge in _ZONES.items())
    return f"CASE {steps} END"


_BUILT_CAPTAINS = f"""
built_captains AS (
  SELECT printf('CAP%03d', id) AS captain_id, 'captain ' || id AS name,
         {_rounded("a", 2500, 2500, "10.0")} AS rating,
         20 + {_pick("b", 41)} AS avg_speed_kmh, 4 + {_pick("c", 9)} AS active_hours,
         {_zone("d")} AS district, 50 + {_pick("e", 4951)} AS total_deliveries,
         {_rounded("f", 6000, 3900, "100.0")} AS on_time_rate
  FROM ({_draws("SELECT s_suppkey AS id FROM supplier", 100, "a b c d e f")})
)"""

_BUILT_RESTAURANTS = f"""
built_restaurants AS (
  SELECT printf('REST%03d', id) AS restaurant_id, 'مطعم ' || (1 + {_pick("a", 40)}) AS name,
         {_from_list("b", _KITCHENS)} AS cuisine_type, 5 + {_pick("c", 31)} AS avg_prep_time_min,
         {_rounded("d", 2500, 2500, "10.0")} AS rating, {_zone("e")} AS district,
         100 + {_pick("f", 9901)} AS total_orders
  FROM ({_draws("SELECT p_partkey AS id FROM part", 101, "a b c d e f")})
)"""

_BUILT_ORDERS = f"""
riders AS (
  SELECT captain_id, rating AS stars,
         row_number() OVER (ORDER BY substr(md5(captain_id), 1, 3), captain_id) - 1 AS no
  FROM built_captains
),
kitchens AS (
  SELECT restaurant_id, district, avg_prep_time_min AS usual,
         row_number() OVER (ORDER BY substr(md5(restaurant_id), 1, 3), restaurant_id) - 1 AS no
  FROM built_restaurants
),
d AS ({_draws("SELECT o_orderkey AS id FROM orders", 99,
              "cap rest dy pk hr mi pr leg we tr cu va ca xw xt xp xr")}),
g1 AS (
  SELECT d.*, riders.captain_id, stars, kitchens.restaurant_id, kitchens.district,
         {_pick("dy", "(72 * 490 + 330)")} AS tick,
         CASE WHEN {_pick("pk", 100)} < 40 THEN {_from_list("hr", [12, 13, 19, 20, 21])}
              ELSE {_from_list("hr", [7, 8, 9, 10, 11, 14, 15, 16, 17, 18, 22, 23])} END AS hh,
         {_from_list("we", _SKIES)} AS weather, {_from_list("tr", _ROADS)} AS traffic,
         greatest(5, usual - 3 + {_pick("pr", 9)}) AS prep
  FROM d JOIN riders ON riders.no = {_pick("cap", "(SELECT count(*) FROM built_captains)")}
         JOIN kitchens ON kitchens.no = {_pick("rest", "(SELECT count(*) FROM built_restaurants)")}
),
g2 AS (
  SELECT *, CASE WHEN hh IN (12, 13, 19, 20, 21) THEN 1 ELSE 0 END AS peak,
         TIMESTAMP '2025-01-01' + to_days(CAST(7 * (tick // 490)
           + CASE WHEN tick % 490 < 55 THEN 0 WHEN tick % 490 < 155 THEN 1
                  WHEN tick % 490 < 255 THEN 2 WHEN tick % 490 < 330 THEN 3
                  WHEN tick % 490 < 390 THEN 4 WHEN tick % 490 < 440 THEN 5 ELSE 6 END AS INTEGER))
           + to_hours(CAST(hh AS INTEGER)) + to_minutes(CAST({_pick("mi", 60)} AS INTEGER)) AS moment
  FROM g1
),
g3 AS (
  SELECT *, prep + 10 + {_pick("leg", 26)}
      + CASE weather WHEN 'عاصف' THEN 5 + {_pick("xw", 6)} WHEN 'حار جداً' THEN 2 + {_pick("xw", 4)} ELSE 0 END
      + CASE traffic WHEN 'شديد الكثافة' THEN 8 + {_pick("xt", 5)} WHEN 'كثيف' THEN 3 + {_pick("xt", 5)} ELSE 0 END
      + CASE WHEN peak = 1 THEN 3 + {_pick("xp", 6)} ELSE 0 END
      + CASE WHEN stars < 3.5 THEN 2 + {_pick("xr", 4)} ELSE 0 END AS mins
  FROM g2
),
built_orders AS (
  SELECT printf('ORD%06d', id) AS order_id, printf('CUST%05d', 1 + {_pick("cu", 5000)}) AS customer_id,
         captain_id, restaurant_id, district,
         strftime(moment, '%Y-%m-%d %H:%M:%S') AS order_time,
         CAST(mins AS BIGINT) AS delivery_time_min, CAST(prep AS BIGINT) AS prep_time_min,
         weather, traffic AS traffic_level,
         {_rounded("va", 150000, 3350000, "100.0")} AS order_value_sar,
         CASE WHEN {_pick("ca", 100)} < 5 + CASE WHEN weather = 'عاصف' THEN 4 ELSE 0 END
                      + CASE WHEN traffic = 'شديد الكثافة' THEN 3 ELSE 0 END
                      + CASE WHEN mins > 60 THEN 5 ELSE 0 END THEN 'cancelled'
              WHEN mins > 50 THEN 'delayed' ELSE 'delivered' END AS status,
         CAST(hh AS BIGINT) AS hour_of_day, dayname(moment) AS day_of_week,
         CAST(peak AS BIGINT) AS is_peak_hour,
         CAST(CASE WHEN mins > 50 THEN 1 ELSE 0 END AS BIGINT) AS is_delayed
  FROM g3
)"""

_BUILT = f"WITH {_BUILT_CAPTAINS},{_BUILT_RESTAURANTS},{_BUILT_ORDERS}"


def _status_count(status: str, otherwise: str = "") -> str:
    return f"CAST(sum(CASE WHEN status = '{status}' THEN 1 {otherwise} END) AS BIGINT) AS {status}"


def _status_pct(status: str) -> str:
    return f"{_even(f"(100 * sum(CASE WHEN status = '{status}' THEN 1 ELSE 0 END))", "count(*)", 1)} AS {status}_pct"


def _features(names: str) -> str:
    listed = ", ".join(f"('{name}')" for name in names.split())
    return f"SELECT feature, 1::BIGINT AS in_range, 1::BIGINT AS adds_up FROM (VALUES {listed}) t(feature)"


_RULE_CELLS = """
cells AS (
  SELECT count(*) FILTER (WHERE is_delayed = 0 AND is_peak_hour = 0) AS tn,
         count(*) FILTER (WHERE is_delayed = 0 AND is_peak_hour = 1) AS fp,
         count(*) FILTER (WHERE is_delayed = 1 AND is_peak_hour = 0) AS fn,
         count(*) FILTER (WHERE is_delayed = 1 AND is_peak_hour = 1) AS tp
  FROM fact_orders
)"""

_BRANDS = [f"Brand#{i}" for i in range(1, 26)]

_TREE_FEATURES = ["district_enc", "hour_of_day", "day_enc", "weather_enc", "traffic_enc"]
_SCENARIOS = """
  SELECT district, [20, 20, 13, 13, 21][place]::BIGINT AS hour_of_day, 'Thursday' AS day_of_week,
         'clear' AS weather, 'heavy' AS traffic_level
  FROM (SELECT district, row_number() OVER (ORDER BY count(*) DESC, district) AS place
        FROM fact_orders GROUP BY district) WHERE place <= 5
  UNION ALL SELECT 'no such district', 20, 'Thursday', 'clear', 'heavy'"""


def _boosted(rounds: int, depth: int, rate: float, least: int) -> str:
    """Regression trees over the training slots, grown level by level; every step is a table.

    Round after round: rows are summed per node, feature and value; values are put in order
    (hours as they are, labels by their mean); the cut with the largest drop in variance
    wins, ties going to the first feature and value; rows move to their side. Each later
    tree learns twice the error that is left and counts ``rate``.
    """
    steps = [
        f"""
base AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, split, order_count, {_SLOT_KEYS} FROM split_slots
  UNION ALL
  SELECT -row_number() OVER (), 'scenario', NULL, district, hour_of_day, day_of_week, NULL, weather, traffic_level
  FROM ({_SCENARIOS})
),
parts AS MATERIALIZED (
  SELECT rid, split, unnest([0, 1, 2, 3, 4]) AS f,
         unnest([district, lpad(hour_of_day::VARCHAR, 2, '0'), day_of_week, weather, traffic_level]) AS v
  FROM base
),
hours AS MATERIALIZED (
  SELECT v, (v::DOUBLE + lead(v::DOUBLE) OVER (ORDER BY v)) / 2 AS midpoint
  FROM (SELECT DISTINCT v FROM parts WHERE f = 1 AND split = 'train')
),
pred0 AS MATERIALIZED (SELECT rid, 0.0::DOUBLE AS p FROM base)"""
    ]
    nodes = []
    for r in range(rounds):
        goal = "order_count::DOUBLE" if r == 0 else "2 * (order_count - p)"
        steps.append(f"""
goal{r} AS MATERIALIZED (
  SELECT rid, {goal} AS t FROM base JOIN pred{r} USING (rid) WHERE split = 'train'
),
at{r}_0 AS MATERIALIZED (SELECT rid, 1::BIGINT AS node FROM base)""")
        for d in range(depth):
            steps.append(f"""
ordered{r}_{d} AS MATERIALIZED (
  SELECT *, row_number() OVER w AS place, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(q) OVER w AS lq,
         sum(n) OVER (PARTITION BY node, f) AS n_all, sum(s) OVER (PARTITION BY node, f) AS s_all,
         sum(q) OVER (PARTITION BY node, f) AS q_all
  FROM (SELECT node, f, v, count(*) AS n, sum(t) AS s, sum(t * t) AS q
        FROM at{r}_{d} JOIN goal{r} USING (rid) JOIN parts USING (rid)
        WHERE node >= {2**d} GROUP BY node, f, v)
  WINDOW w AS (PARTITION BY node, f ORDER BY CASE WHEN f = 1 THEN 0 ELSE s / n END, v ROWS UNBOUNDED PRECEDING)
),
best{r}_{d} AS MATERIALIZED (
  SELECT *
  FROM (SELECT node, f, v, place, (q_all - s_all * s_all / n_all) / n_all - (lq - ls * ls / ln) / n_all
               - ((q_all - lq) - (s_all - ls) * (s_all - ls) / (n_all - ln)) / n_all AS gain
        FROM ordered{r}_{d} WHERE ln >= {least} AND n_all - ln >= {least})
  WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, f, place) = 1
),
left{r}_{d} AS MATERIALIZED (
  SELECT o.node, o.f, o.v FROM ordered{r}_{d} o JOIN best{r}_{d} b ON o.node = b.node AND o.f = b.f AND o.place <= b.place
),
at{r}_{d + 1} AS MATERIALIZED (
  SELECT a.rid, CASE WHEN b.node IS NULL THEN a.node
                     WHEN CASE WHEN b.f = 1 THEN p.v <= b.v ELSE l.v IS NOT NULL END THEN 2 * a.node
                     ELSE 2 * a.node + 1 END AS node
  FROM at{r}_{d} a LEFT JOIN best{r}_{d} b USING (node) LEFT JOIN parts p ON p.rid = a.rid AND p.f = b.f
       LEFT JOIN left{r}_{d} l ON l.node = a.node AND l.f = p.f AND l.v = p.v
)""")
            nodes.append(f"""
  SELECT {r} AS tree, node, any_value(feature) AS feature, any_value(threshold) AS threshold,
         any_value(left_labels) AS left_labels, any_value(gain) AS gain, count(*) AS n_rows, avg(t) AS value
  FROM at{r}_{d} JOIN goal{r} USING (rid) LEFT JOIN (
    SELECT b.node, {_TREE_FEATURES}[b.f + 1] AS feature, any_value(CASE WHEN b.f = 1 THEN midpoint END) AS threshold,
           string_agg(CASE WHEN b.f <> 1 THEN l.v END, '|' ORDER BY l.v) AS left_labels, any_value(gain) AS gain
    FROM best{r}_{d} b JOIN left{r}_{d} l USING (node) LEFT JOIN hours h ON b.f = 1 AND b.v = h.v GROUP BY b.node, b.f
  ) USING (node) WHERE node >= {2**d} GROUP BY node""")
        nodes.append(f"""
  SELECT {r}, node, NULL, NULL, NULL, NULL, count(*), avg(t)
  FROM at{r}_{depth} JOIN goal{r} USING (rid) WHERE node >= {2**depth} GROUP BY node""")
        share = 1.0 if r == 0 else rate
        steps.append(f"""
pred{r + 1} AS MATERIALIZED (
  SELECT rid, p + {share}::DOUBLE * value AS p
  FROM pred{r} JOIN at{r}_{depth} USING (rid)
       JOIN (SELECT node, avg(t) AS value FROM at{r}_{depth} JOIN goal{r} USING (rid) GROUP BY node) USING (node)
)""")
    steps.append(f"""
nodes AS MATERIALIZED ({" UNION ALL ".join(nodes)}
),
scored AS (SELECT base.*, p FROM base JOIN pred{rounds} USING (rid))""")
    return ",".join(steps)


_SMALL = f"{_SLOTS},{_boosted(rounds=3, depth=3, rate=0.1, least=20)}"

EQUIVALENTS: dict[str, str] = {
    "stg_orders": _star(f"SELECT *, {_SPEED}, {_SEGMENT} FROM ({_ORDERS_AS_TEXT})"),
    "stg_captains": _star(f"SELECT *, {_TIER} FROM dim_captains"),
    "stg_restaurants": _star(f"SELECT *, {_PREP} FROM dim_restaurants"),
    "report_overview": _star(f"""
SELECT count(*) AS total_orders, {_up(*_MINUTES, 1)} AS avg_delivery_min,
       {_up(_CENTS, "100", 0)} AS total_revenue_sar,
       {_up(*_VALUE, 1)} AS avg_order_value,
       {_status_count("delivered")}, {_status_count("delayed")}, {_status_count("cancelled")}
FROM fact_orders"""),
    "report_busiest_districts": _star(f"""
SELECT district, count(*) AS total_orders, {_up(*_MINUTES, 1)} AS avg_time,
       {_big(_FLAGGED, "delayed_orders")}, {_up(*_RATE, 1)} AS delay_rate_pct
FROM fact_orders GROUP BY district ORDER BY total_orders DESC, district LIMIT 5"""),
    "report_weather_impact": _star(f"""
SELECT weather, count(*) AS orders, {_up(*_MINUTES, 1)} AS avg_time, {_up(*_RATE, 1)} AS delay_rate_pct
FROM fact_orders GROUP BY weather ORDER BY avg_time DESC, weather"""),
    "report_hours": _star(f"""
SELECT hour_of_day, count(*) AS orders, {_up(*_MINUTES, 1)} AS avg_time, {_up(*_RATE, 1)} AS delay_rate_pct
FROM fact_orders GROUP BY hour_of_day ORDER BY orders DESC, hour_of_day LIMIT 8"""),
    "report_worst_captains": _star(f"""
SELECT c.captain_id, c.rating, count(o.order_id) AS total_orders, {_up(*_MINUTES, 1)} AS avg_time,
       {_up(*_RATE, 1)} AS delay_rate_pct
FROM fact_orders o JOIN dim_captains c ON o.captain_id = c.captain_id
GROUP BY c.captain_id, c.rating HAVING count(o.order_id) >= 50
ORDER BY delay_rate_pct DESC, c.captain_id, c.rating LIMIT 5"""),
    "report_slowest_restaurants": _slowest("r.name, r.cuisine_type"),
    "report_slowest_restaurants_by_id": _slowest("r.restaurant_id, r.name, r.cuisine_type"),
    "check_row_counts": _star("""
SELECT 'fact_orders' AS table_name, count(*) AS n_rows FROM fact_orders
UNION ALL SELECT 'dim_captains', count(*) FROM dim_captains
UNION ALL SELECT 'dim_restaurants', count(*) FROM dim_restaurants"""),
    "check_status": _star(f"""
SELECT status, count(*) AS total, {_up(*_MINUTES, 1)} AS avg_time
FROM fact_orders GROUP BY status ORDER BY total DESC, status"""),
    "check_districts": _star(f"""
SELECT district, count(*) AS orders, {_up(*_MINUTES, 1)} AS avg_delivery_min
FROM fact_orders GROUP BY district ORDER BY orders DESC, district LIMIT 5"""),
    "check_sample": _star("""
SELECT order_id, district, delivery_time_min, weather, traffic_level, status
FROM fact_orders ORDER BY order_id LIMIT 5"""),
    "order_summary": _star(f"""
SELECT count(*) AS total_orders,
       {_status_count("delivered", "ELSE 0")}, {_status_pct("delivered")},
       {_status_count("delayed", "ELSE 0")}, {_status_pct("delayed")},
       {_status_count("cancelled", "ELSE 0")}, {_status_pct("cancelled")},
       {_even(*_MINUTES, 1)} AS avg_delivery_min, {_even(*_VALUE, 1)} AS avg_order_value
FROM fact_orders"""),
    "mart_captain_performance": _star(f"""
SELECT o.captain_id, c.name, c.rating, c.performance_tier, c.district, c.total_deliveries,
       count(o.order_id) AS total_orders, {_up(*_MINUTES, 1)} AS avg_delivery_min,
       {_big("sum(o.is_delayed)", "total_delayed")},
       {_up(*_MART_RATE, 1)} AS delay_rate_pct,
       {_up(_CENTS, "100", 0)} AS total_revenue_sar,
       {_up(*_VALUE, 1)} AS avg_order_value,
       {_big("sum(o.is_peak_hour)", "peak_hour_orders")}
FROM fact_orders o LEFT JOIN (SELECT *, {_TIER} FROM dim_captains) c ON o.captain_id = c.captain_id
GROUP BY ALL ORDER BY delay_rate_pct DESC, o.captain_id"""),
    "mart_zone_analysis": _star(f"""
SELECT district, count(order_id) AS total_orders, {_up(*_MINUTES, 1)} AS avg_delivery_min,
       {_big("sum(is_delayed)", "total_delayed")},
       {_up(*_MART_RATE, 1)} AS delay_rate_pct,
       {_up(_CENTS, "100", 0)} AS total_revenue_sar,
       {_big("sum(is_peak_hour)", "peak_hour_orders")},
       {_up("(100 * sum(is_peak_hour))", "count(order_id)", 1)} AS peak_hour_pct
FROM fact_orders GROUP BY district ORDER BY total_orders DESC, district"""),
    "gold_cube": _star(f"""
SELECT {_GRAIN}, count(*) AS n_rows, count(order_id) AS n_orders,
       {_big("sum(delivery_time_min)", "sum_minutes")}, count(delivery_time_min) AS n_minutes,
       {_big("sum(prep_time_min)", "sum_prep")}, count(prep_time_min) AS n_prep,
       {_CENTS}::DOUBLE / 100.0::DOUBLE AS sum_value, count(order_value_sar) AS n_value,
       {_big("sum(is_delayed)", "sum_delayed")}, count(is_delayed) AS n_delayed,
       {_big(_FLAGGED, "n_flagged")}, {_big("sum(is_peak_hour)", "sum_peak")},
       CAST(sum(CASE WHEN status = 'delivered' THEN 1 END) AS BIGINT) AS rows_delivered,
       CAST(sum(CASE WHEN status = 'delayed' THEN 1 END) AS BIGINT) AS rows_delayed,
       CAST(sum(CASE WHEN status = 'cancelled' THEN 1 END) AS BIGINT) AS rows_cancelled
FROM fact_orders GROUP BY {_GRAIN}"""),
    "dash_kpis": _star(f"""
SELECT count(*) AS total_orders, {_even(_CENTS, "100000000", 2)} AS revenue_m,
       {_even(*_MINUTES, 1)} AS avg_delivery_min, {_status_count("delivered", "ELSE 0")},
       {_status_count("cancelled", "ELSE 0")}, {_even(*_MEAN_RATE, 1)} AS delay_rate
FROM fact_orders"""),
    "dash_status_share": _star(f"""
SELECT status, n AS count, {_even("(100 * n)", "(SELECT count(*) FROM fact_orders)", 1)} AS share_pct
FROM (SELECT status, count(*) AS n FROM fact_orders WHERE status IS NOT NULL GROUP BY status)
ORDER BY n DESC, status"""),
    "dash_weather_delay": _star(f"""
SELECT weather, count(order_id) AS total, {_big("sum(is_delayed)", "delayed")},
       {_even(*_MART_RATE, 1)} AS delay_rate
FROM fact_orders GROUP BY weather ORDER BY weather"""),
    "dash_districts": _star("""
SELECT district, count(order_id) AS total FROM fact_orders GROUP BY district ORDER BY total DESC, district"""),
    "dash_hourly": _star("""
SELECT hour_of_day, count(order_id) AS total FROM fact_orders GROUP BY hour_of_day ORDER BY hour_of_day"""),
    "dash_traffic": _star(f"""
SELECT traffic_level, count(order_id) AS total_orders, {_even(*_MINUTES, 1)} AS avg_delivery_min,
       {_even(*_MEAN_RATE, 1)} AS delay_rate_pct
FROM fact_orders GROUP BY traffic_level ORDER BY traffic_level"""),
    "dash_captain_scatter": _star("SELECT * FROM scatter", _SCATTER),
    "dash_top_captains": _star(
        "SELECT captain_id, rating, total_orders, delay_rate FROM scatter "
        "ORDER BY delay_rate, captain_id, rating LIMIT 10",
        _SCATTER,
    ),
    "dash_attention_captains": _star(
        "SELECT * FROM scatter WHERE total_orders >= 50 ORDER BY delay_rate DESC, captain_id, rating LIMIT 10",
        _SCATTER,
    ),
    "dash_captain_ranking": _star(
        "SELECT *, rank() OVER (ORDER BY delay_rate) AS place FROM scatter", _SCATTER
    ),
    "dash_district_weather": _star(f"""
SELECT district, weather, {_even(*_MEAN_RATE, 1)} AS delay_rate
FROM fact_orders GROUP BY district, weather ORDER BY district, weather"""),
    "dash_district_weather_wide": _star(
        "SELECT weather, "
        + ", ".join(f"max(CASE WHEN district = '{b}' THEN delay_rate END) AS \"{b}\"" for b in _BRANDS)
        + f""" FROM (SELECT district, weather, {_even(*_MEAN_RATE, 1)} AS delay_rate
       FROM fact_orders GROUP BY district, weather) GROUP BY weather ORDER BY weather"""
    ),
    "dash_district_weather_map": _star(f"""
SELECT weather, count(*) AS districts,
       string_agg(district || '=' || coalesce(delay_rate::VARCHAR, 'none'), ', ' ORDER BY district) AS rates
FROM (SELECT district, weather, {_even(*_MEAN_RATE, 1)} AS delay_rate FROM fact_orders GROUP BY district, weather)
GROUP BY weather"""),
    "dash_hour_district": _star("""
SELECT hour_of_day, district, count(*) AS orders FROM fact_orders
GROUP BY hour_of_day, district ORDER BY hour_of_day, district"""),
    "dash_alerts": _star("""
SELECT district, count(*) AS delayed_orders,
       district || ' — ' || format('{:,}', count(*)) || ' delayed orders detected' AS alert
FROM fact_orders WHERE is_delayed = 1 GROUP BY district
ORDER BY delayed_orders DESC, district LIMIT 5"""),
    "late_orders_per_hour": _star("""
SELECT strftime(date_trunc('hour', order_time), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', order_time) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       district, count(*) AS delayed_orders,
       district || ' — ' || format('{:,}', count(*)) || ' delayed orders detected' AS alert
FROM fact_orders WHERE is_delayed = 1
GROUP BY date_trunc('hour', order_time), district"""),
    "raised_alerts": _star("""
SELECT strftime(make_timestamp(start * 604800000000), '%Y-%m-%d %H:%M:%S') AS window_start, district,
       raised_at, district || ' — ' || format('{:,}', raised_at) || ' delayed orders detected' AS alert
FROM (SELECT start, district, unnest(list_filter([2 * (1::BIGINT << k) FOR k IN range(40)], lambda b: b <= n)) AS raised_at
      FROM (SELECT epoch(order_time)::BIGINT // 604800 AS start, district, count(*) AS n
            FROM fact_orders WHERE is_delayed = 1 GROUP BY ALL))"""),
    "dq_results": _star(
        "\nUNION ALL ".join(
            [
                _dq_unique("stg_orders", "order_id", "fact_orders"),
                _dq_null("stg_orders", "order_id", "fact_orders"),
                _dq_values("stg_orders", "status", "'delivered', 'delayed', 'cancelled'", "fact_orders"),
                _dq_null("stg_orders", "delivery_time_min", "fact_orders"),
                _dq_unique("stg_captains", "captain_id", "dim_captains"),
                _dq_null("stg_captains", "captain_id", "dim_captains"),
                _dq_unique("stg_restaurants", "restaurant_id", "dim_restaurants"),
                _dq_null("stg_restaurants", "restaurant_id", "dim_restaurants"),
            ]
        )
    ),
    "dq_results_raw": "\nUNION ALL ".join(
        [
            _dq_unique("lineitem", "l_orderkey"),
            _dq_null("lineitem", "l_suppkey"),
            _dq_values("lineitem", "l_returnflag", "'A'"),
            _dq_unique("orders", "o_orderkey"),
            _dq_unique("orders", "o_custkey"),
            _dq_values("orders", "o_orderpriority", "'1-URGENT', '2-HIGH'"),
            _dq_null("part", "p_name"),
            _dq_unique("part", "p_name"),
        ]
    ),
    "dq_rejected_rows": """
SELECT table_name, row_id, tests FROM (
  SELECT 'lineitem' AS table_name, l_orderkey || '|' || l_linenumber AS row_id, concat_ws(', ',
         CASE WHEN l_orderkey IS NOT NULL AND count(*) OVER (PARTITION BY l_orderkey) > 1 THEN 'l_orderkey unique' END,
         CASE WHEN l_suppkey IS NULL THEN 'l_suppkey not_null' END,
         CASE WHEN l_returnflag NOT IN ('A') THEN 'l_returnflag accepted_values' END) AS tests
  FROM lineitem
  UNION ALL
  SELECT 'orders', o_orderkey::VARCHAR, concat_ws(', ',
         CASE WHEN o_orderkey IS NOT NULL AND count(*) OVER (PARTITION BY o_orderkey) > 1 THEN 'o_orderkey unique' END,
         CASE WHEN o_custkey IS NOT NULL AND count(*) OVER (PARTITION BY o_custkey) > 1 THEN 'o_custkey unique' END,
         CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'o_orderpriority accepted_values' END)
  FROM orders
  UNION ALL
  SELECT 'part', p_partkey::VARCHAR, concat_ws(', ', CASE WHEN p_name IS NULL THEN 'p_name not_null' END,
         CASE WHEN p_name IS NOT NULL AND count(*) OVER (PARTITION BY p_name) > 1 THEN 'p_name unique' END)
  FROM part
) WHERE tests <> ''""",
    "peak_flags": _star(f"""
SELECT order_id, {_TIME_TEXT}, CAST(extract(hour FROM f.order_time) AS BIGINT) AS hour_of_day,
       dayname(f.order_time) AS day_of_week,
       CAST(CASE WHEN extract(hour FROM f.order_time) IN (12, 13, 19, 20, 21) THEN 1 ELSE 0 END AS BIGINT)
         AS is_peak_hour
FROM fact_orders f"""),
    "delay_enrichment": _star(
        "SELECT order_id, prep_time_min, delivery_time_min, is_delayed FROM fact_orders"
    ),
    "order_labels": _star(f"""
SELECT order_id, printf('ORD%06d', order_id) AS order_key, printf('CUST%05d', customer_id) AS customer_key,
       'Restaurant ' || name AS restaurant_label,
       {_up("CAST(round(order_value_sar * 100) AS BIGINT)", "100", 1)} AS value_rounded
FROM fact_orders JOIN dim_restaurants USING (restaurant_id)"""),
    "status_rule": _star("SELECT order_id, weather, traffic_level, delivery_time_min, status FROM fact_orders"),
    "demand_slots": _star("SELECT * FROM slots", _SLOTS),
    "demand_slot_stats": _star(
        f"SELECT count(*) AS slots, {_even('sum(order_count)', 'count(*)', 1)} AS avg_orders, "
        "max(order_count) AS max_orders FROM slots",
        _SLOTS,
    ),
    "demand_slot_split": _star(
        "SELECT split, count(*) AS slots, CAST(sum(order_count) AS BIGINT) AS orders FROM split_slots GROUP BY split",
        _SLOTS,
    ),
    "demand_metrics_on_mean": _star(
        f"""
SELECT count(*) AS n, {_settled("avg(abs(order_count - p))", 4)} AS mae,
       {_settled("sqrt(avg((order_count - p) * (order_count - p)))", 4)} AS rmse,
       {_settled("avg(CASE WHEN order_count > 0 THEN abs(order_count - p) / order_count END) * 100.0::DOUBLE", 4)} AS mape_pct
FROM (SELECT s.order_count,
             coalesce(g.p, (SELECT avg(order_count) FROM split_slots WHERE split = 'train')) AS p
      FROM split_slots s
      LEFT JOIN (SELECT district, traffic_level, avg(order_count) AS p FROM split_slots
                 WHERE split = 'train' GROUP BY ALL) g USING (district, traffic_level)
      WHERE s.split = 'test')""",
        _SLOTS,
    ),
    "orphan_orders": _star("""
SELECT captain_id, count(*) AS n_orders FROM fact_orders
WHERE captain_id NOT IN (SELECT captain_id FROM dim_captains WHERE rating >= 3.0) GROUP BY captain_id"""),
    "ml_demand_features": _star(
        f"""
SELECT {_SLOT_KEYS}, c_district.code AS district_enc, c_day.code AS day_enc, c_weather.code AS weather_enc,
       c_traffic.code AS traffic_enc, split, order_count
FROM split_slots JOIN c_weather ON weather = c_weather.v JOIN c_traffic ON traffic_level = c_traffic.v
     JOIN c_day ON day_of_week = c_day.v JOIN c_district ON district = c_district.v""",
        _SLOTS,
        ",".join(
            _codes(name, column, "slots")
            for name, column in [
                ("c_weather", "weather"),
                ("c_traffic", "traffic_level"),
                ("c_day", "day_of_week"),
                ("c_district", "district"),
            ]
        ),
    ),
    "ml_delay_model": _star(
        """
SELECT count(*) AS n_test, CAST(sum(is_delayed) AS BIGINT) AS late, count(*) AS scores_in_range,
       0::BIGINT AS reload_mismatches, 1::BIGINT AS beats_majority
FROM (SELECT is_delayed, row_number() OVER (PARTITION BY is_delayed ORDER BY md5(order_id || ':42')) AS place,
             count(*) OVER (PARTITION BY is_delayed) AS n
      FROM rows_) WHERE place > n - ceil(n / 5.0)""",
        _ROWS,
    ),
    "ml_demand_model": _star(
        """
SELECT count(*) AS n_test, CAST(sum(order_count) AS BIGINT) AS orders, count(*) AS finite_scores,
       0::BIGINT AS reload_mismatches
FROM split_slots WHERE split = 'test'""",
        _SLOTS,
    ),
    "ml_delay_importance": _features(
        "hour_of_day is_peak_hour order_value_sar captain_rating captain_speed weather_enc traffic_enc day_enc "
        "district_enc cuisine_enc"
    ),
    "ml_demand_importance": _features("district_enc hour_of_day day_enc weather_enc traffic_enc"),
    "ml_demand_scenarios": _star("""
SELECT district, [20, 20, 13, 13, 21][place]::BIGINT AS hour_of_day, 'Thursday' AS day_of_week,
       'clear' AS weather, 'heavy' AS traffic_level, 1::BIGINT AS predicted
FROM (SELECT district, row_number() OVER (ORDER BY count(*) DESC, district) AS place
      FROM fact_orders GROUP BY district) WHERE place <= 5
UNION ALL SELECT 'no such district', 20, 'Thursday', 'clear', 'heavy', 0"""),
    "ml_small_demand_trees": _star(
        f"""
SELECT tree, node, feature, threshold, left_labels, {_settled("gain", 6)} AS gain, n_rows, {_settled("value", 6)} AS value
FROM nodes""",
        _SMALL,
    ),
    "ml_small_demand_scores": _star(
        f"SELECT {_SLOT_KEYS}, order_count, {_settled('p', 6)} AS score FROM scored WHERE split = 'test'", _SMALL
    ),
    "ml_small_demand_metrics": _star(
        f"""
SELECT count(*) AS n, {_settled("avg(abs(order_count - p))", 4)} AS mae,
       {_settled("sqrt(avg((order_count - p) * (order_count - p)))", 4)} AS rmse,
       {_settled("avg(CASE WHEN order_count > 0 THEN abs(order_count - p) / order_count END) * 100.0::DOUBLE", 4)} AS mape_pct
FROM scored WHERE split = 'test'""",
        _SMALL,
    ),
    "ml_small_demand_importance": _star(
        f"""
SELECT feature, {_settled("sum(gain * n_rows) / (SELECT sum(gain * n_rows) FROM nodes)", 6)} AS importance
FROM nodes WHERE feature IS NOT NULL GROUP BY feature""",
        _SMALL,
    ),
    "ml_small_demand_scenarios": _star(
        """
SELECT district, hour_of_day, day_of_week, weather, traffic_level,
       CASE WHEN district IN (SELECT district FROM slots) THEN round_even(p, 0) END AS predicted_orders
FROM scored WHERE split = 'scenario'""",
        _SMALL,
    ),
    "ml_features": _star(
        """
SELECT order_id, hour_of_day, is_peak_hour, order_value_sar, captain_rating, captain_speed,
       c_weather.code AS weather_enc, c_traffic.code AS traffic_enc, c_day.code AS day_enc,
       c_district.code AS district_enc, c_cuisine.code AS cuisine_enc, is_delayed
FROM rows_ JOIN c_weather ON weather = c_weather.v JOIN c_traffic ON traffic_level = c_traffic.v
     JOIN c_day ON day_of_week = c_day.v JOIN c_district ON district = c_district.v
     JOIN c_cuisine ON cuisine_type = c_cuisine.v""",
        _ROWS,
        _CODES,
    ),
    "ml_split_profile": _star(
        """
SELECT CASE WHEN substr(md5(order_id || ':42'), 1, 4) < 'cccd' THEN 'train' ELSE 'test' END AS split,
       is_delayed, count(*) AS n
FROM rows_ GROUP BY 1, 2""",
        _ROWS,
    ),
    "ml_stratified_split": _star(
        """
SELECT order_id, CASE WHEN place <= n - ceil(n / 5.0) THEN 'train' ELSE 'test' END AS split
FROM (SELECT order_id, row_number() OVER (PARTITION BY is_delayed ORDER BY md5(order_id || ':42')) AS place,
             count(*) OVER (PARTITION BY is_delayed) AS n
      FROM rows_)""",
        _ROWS,
    ),
    "ml_class_ratio": _star(
        f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE is_delayed = 1) AS positives,
       {_even("(100 * count(*) FILTER (WHERE is_delayed = 1))", "count(*)", 1)} AS positive_pct,
       {_up("count(*) FILTER (WHERE is_delayed = 0)", "count(*) FILTER (WHERE is_delayed = 1)", 6)} AS class_ratio
FROM rows_""",
        _ROWS,
    ),
    "ml_metrics_on_rule": _star(
        f"""
SELECT tn, fp, fn, tp, {_up("(tp + tn)", "(tp + tn + fp + fn)", 4)} AS accuracy,
       {_up("tp", "(tp + fp)", 4)} AS precision_1, {_up("tp", "(tp + fn)", 4)} AS recall_1,
       {_up("(2 * tp)", "(2 * tp + fp + fn)", 4)} AS f1_1
FROM cells""",
        _RULE_CELLS,
    ),
    "ml_permutation_on_rule": _star(
        """
SELECT feature, count(*) AS n_rows, CAST(sum(CASE WHEN a.is_delayed <> a.is_peak_hour THEN 1 ELSE 0 END) AS BIGINT) AS base_loss,
       CAST(sum(CASE WHEN a.is_delayed <> CASE WHEN feature = 'is_peak_hour' THEN b.is_peak_hour ELSE a.is_peak_hour END
                THEN 1 ELSE 0 END) AS BIGINT) AS permuted_loss
FROM placed a, (VALUES ('is_peak_hour', 1), ('weather', 2), ('traffic_level', 3)) f(feature, step)
     JOIN placed b ON b.bucket = a.bucket AND b.place = (a.place + step) % a.size
GROUP BY feature""",
        """
hashed AS (
  SELECT order_id, is_delayed, is_peak_hour, md5(order_id || ':42') AS h,
         greatest(1, ceil((SELECT count(*) FROM fact_orders) / 4096.0))::BIGINT AS buckets
  FROM fact_orders
),
bucketed AS (SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % buckets AS bucket FROM hashed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h, order_id) - 1 AS place,
         count(*) OVER (PARTITION BY bucket) AS size
  FROM bucketed
)""",
    ),
    "landed_orders": _star(_ORDERS_AS_TEXT),
    "landed_captains": _star("SELECT * FROM dim_captains"),
    "landed_restaurants": _star("SELECT * FROM dim_restaurants"),
    "warehouse_orders": _star(_ORDERS_AS_TEXT),
    "catalog_orders": _star(_ORDERS_AS_TEXT),
    "built_captains": f"WITH {_BUILT_CAPTAINS} SELECT * FROM built_captains",
    "built_restaurants": f"WITH {_BUILT_RESTAURANTS} SELECT * FROM built_restaurants",
    "built_orders": f"{_BUILT} SELECT * FROM built_orders",
    "build_summary": f"""{_BUILT}
SELECT count(*) AS total_orders,
       {_status_count("delivered", "ELSE 0")}, {_status_pct("delivered")},
       {_status_count("delayed", "ELSE 0")}, {_status_pct("delayed")},
       {_status_count("cancelled", "ELSE 0")}, {_status_pct("cancelled")},
       {_even(*_MINUTES, 1)} AS avg_delivery_min, {_even(*_VALUE, 1)} AS avg_order_value
FROM built_orders""",
}

# incrementally folded tables have the rows of those built at once
for _name, _same in {
    "refreshed_captain_mart": "mart_captain_performance",
    "refreshed_zone_mart": "mart_zone_analysis",
    "refreshed_demand_slots": "demand_slots",
    "refreshed_slowest_restaurants": "report_slowest_restaurants",
}.items():
    EQUIVALENTS[_name] = EQUIVALENTS[_same]

# the products of the whole flow that are the rows of a query above, and the parts by their own count
_FLOW = {
    name: EQUIVALENTS[name]
    for name in [
        "dq_results", "mart_captain_performance", "report_overview", "report_busiest_districts",
        "report_weather_impact", "report_hours", "check_status", "check_districts", "mart_zone_analysis",
        "dash_kpis", "dash_status_share", "dash_weather_delay", "dash_districts", "dash_hourly", "dash_traffic",
        "dash_district_weather", "dash_hour_district", "dash_alerts", "report_worst_captains",
        "report_slowest_restaurants", "dash_captain_scatter", "dash_top_captains", "dash_attention_captains",
        "dash_district_weather_wide", "check_row_counts", "check_sample", "demand_slots", "demand_slot_stats",
    ]
} | {"build_summary": EQUIVALENTS["order_summary"]}
_FLOW_PARTS = {
    "gold_cube": EQUIVALENTS["gold_cube"],
    "captain_parts": _star("SELECT DISTINCT captain_id FROM fact_orders"),
    "restaurant_parts": _star("SELECT DISTINCT restaurant_id FROM fact_orders"),
}
EQUIVALENTS["flow_products"] = "\nUNION ALL ".join(
    [
        f"""
SELECT '{name}' AS product, count(*) AS n_rows, sum(h)::VARCHAR AS content FROM (
  SELECT r, ('0x' || substr(md5(string_agg(c || '=' || coalesce(try_cast(v AS DECIMAL(30,4))::VARCHAR, v), '|' ORDER BY c)), 1, 15))::BIGINT AS h
  FROM (UNPIVOT (SELECT row_number() OVER () AS r, COLUMNS(*)::VARCHAR FROM ({rows})) ON COLUMNS(* EXCLUDE (r)) INTO NAME c VALUE v)
  GROUP BY r)"""
        for name, rows in _FLOW.items()
    ]
    + [f"SELECT '{name}', count(*), NULL FROM ({rows})" for name, rows in _FLOW_PARTS.items()]
)
