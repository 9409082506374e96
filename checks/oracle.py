"""The registered queries as DuckDB SQL over the test tables.

Each statement is a chain of named steps: the ride mapping, the star schema, the
reductions, the answer. Averages are whole numbers scaled by a power of ten and
rounded half up, so that no floating-point sum enters a comparison.
"""

from __future__ import annotations

from checks.queries import DRIVER_NAMES, SALT
from fleetmart.functions import labels
from fleetmart.schemas import FOREIGN_KEYS, RULES

# --- small builders ---------------------------------------------------------


def _half_up(total: str, count: str, digits: int) -> str:
    """round(total / count, digits) as a whole number scaled by 10^digits."""
    total, count = f"CAST({total} AS HUGEINT)", f"CAST({count} AS HUGEINT)"
    return (
        f"(sign({total}) * ((2 * abs({total}) * CAST({10**digits} AS HUGEINT) + {count})"
        f" // (2 * {count})))"
    )


def _places(scaled: str, digits: int, keep: int) -> str:
    """A number scaled by 10^digits, rounded to ``keep`` places, as DOUBLE."""
    if keep < digits:
        scaled = _half_up(scaled, str(10 ** (digits - keep)), 0)
    return f"CAST({scaled} AS DOUBLE) / {10**keep}"


def _cents(column: str) -> str:
    return f"CAST({column} * 100 AS BIGINT)"


def _money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def _case(condition: str, pairs: list[tuple[object, str]], otherwise: str | None) -> str:
    arms = " ".join(f"WHEN {condition.format(bound)} THEN '{label}'" for bound, label in pairs)
    tail = "" if otherwise is None else f" ELSE '{otherwise}'"
    return f"CASE {arms}{tail} END"


def _listed(values: list[object]) -> str:
    return ", ".join(f"'{value}'" if isinstance(value, str) else str(value) for value in values)


# --- the ride mapping -------------------------------------------------------

_USERS = """
raw_users AS (
  SELECT c_custkey AS user_id,
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(c_custkey % 26 + 1 AS BIGINT), 1) || c_name AS name,
         lower(c_name) || '@example.com' AS email,
         '+1-' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_number,
         DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS registration_date,
         CAST(18 + c_custkey % 60 AS BIGINT) AS age,
         if(c_custkey % 2 = 0, 'F', 'M') AS gender,
         '  ' || n_name || ' ' AS location
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""

_VEHICLES = """
raw_vehicles AS (
  SELECT p_partkey AS vehicle_id, p_brand AS make, p_name AS model,
         CAST(2000 + p_partkey % 24 AS BIGINT) AS year, CAST(2 + p_size % 6 AS BIGINT) AS capacity
  FROM part)"""

_DRIVERS = """
raw_drivers AS (
  SELECT s_suppkey AS driver_id,
         'Driver#' || CAST(s_suppkey - CAST(s_suppkey % 10 = 9 AS BIGINT) AS VARCHAR) AS name,
         if(s_suppkey % 11 = 0, -1, (s_suppkey * 3) % (SELECT count(*) FROM part)) AS vehicle_id,
         s_acctbal > 0 AS available
  FROM supplier)"""

_EVENT_RIDES = """
raw_rides AS (
  SELECT event_id AS ride_id, user_id, ts AS ride_start_time,
         ts + to_seconds(300 + (event_id * 37) % 5400) AS ride_end_time,
         CAST(100 + (event_id * 53) % 2900 AS BIGINT) AS km100,
         CAST(value AS DECIMAL(10,2)) AS fare_amount,
         (event_id * 7 + user_id * 13) % (SELECT count(*) FROM supplier) AS driver_id
  FROM events)"""

_EVENT_RATINGS = """
raw_ratings AS (
  SELECT event_id AS rating_id, event_id AS ride_id, user_id,
         1 + (event_id * 7 + user_id) % 5 AS rating_value, CAST(ts AS DATE) AS rating_date
  FROM events WHERE event_id % 10 < 3)"""

_LINES = """
lines AS (
  SELECT l.*, o_custkey AS user_id,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS ride_id
  FROM lineitem l JOIN orders ON o_orderkey = l_orderkey)"""

_ORDER_RIDES = """
raw_rides AS (
  SELECT ride_id, user_id,
         l_shipdate + to_seconds((l_orderkey * 97 + l_partkey * 31 + l_linenumber * 7919 + l_suppkey * 53) % 86400) AS ride_start_time,
         ride_start_time + to_seconds(300 + (l_partkey * 37 + l_orderkey) % 5400) AS ride_end_time,
         CAST(CAST(l_quantity AS DECIMAL(10,2)) * 100 AS BIGINT) AS km100,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS fare_amount, l_suppkey AS driver_id
  FROM lines)"""

_ORDER_RATINGS = """
raw_ratings AS (
  SELECT ride_id AS rating_id, ride_id, user_id,
         1 + (l_orderkey * 7 + l_linenumber + user_id) % 5 AS rating_value,
         CAST(l_shipdate AS DATE) AS rating_date
  FROM lines WHERE l_orderkey % 10 < 3)"""

_RAW = {
    "events": [_USERS, _VEHICLES, _DRIVERS, _EVENT_RIDES, _EVENT_RATINGS],
    "orders": [_USERS, _VEHICLES, _DRIVERS, _LINES, _ORDER_RIDES, _ORDER_RATINGS],
}

# --- the star schema --------------------------------------------------------

_STAR = [
    """
masked AS (
  SELECT user_id, substr(name, 1, 1) || '.' AS masked_name, md5(email) AS masked_email_hash,
         md5(phone_number) AS masked_phone_hash, registration_date, age, gender,
         trim(location) AS location_city, CAST(NULL AS BOOLEAN) AS is_active_subscriber
  FROM raw_users)""",
    """
dim_user AS (
  SELECT row_number() OVER (ORDER BY user_id) AS user_key, * FROM masked)""",
    """
dim_driver AS (
  SELECT row_number() OVER (ORDER BY driver_id) AS driver_key, driver_id, name AS driver_name,
         make AS vehicle_make, model AS vehicle_model, year AS vehicle_year,
         capacity AS vehicle_capacity, available AS is_available_flag
  FROM raw_drivers LEFT JOIN raw_vehicles USING (vehicle_id))""",
    """
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS BIGINT) AS date_key, full_date,
         CAST(dayofweek(full_date) AS BIGINT) AS day_of_week, dayname(full_date) AS day_name,
         monthname(full_date) AS month_name, CAST(year(full_date) AS BIGINT) AS year,
         dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT CAST(ride_start_time AS DATE) AS full_date FROM raw_rides))""",
    f"""
trips AS (
  SELECT r.ride_id, user_key, driver_key, driver_name, masked_name,
         CAST(strftime(ride_start_time, '%Y%m%d') AS BIGINT) AS start_date_key,
         ride_start_time AS start_time, ride_end_time AS end_time, km100, fare_amount,
         {_cents("fare_amount")} AS fare100, rating_value AS stars,
         lag(ride_end_time) OVER w AS previous_end, lead(ride_start_time) OVER w AS next_start,
         row_number() OVER w AS ride_number
  FROM raw_rides r JOIN dim_user USING (user_id) JOIN dim_driver USING (driver_id)
  LEFT JOIN raw_ratings t ON t.ride_id = r.ride_id
  WINDOW w AS (PARTITION BY driver_key ORDER BY ride_start_time, r.ride_id))""",
    f"""
fact AS (
  SELECT *, {_half_up("date_diff('microsecond', start_time, end_time)", "60000000", 2)} AS length100,
         {_half_up("date_diff('microsecond', previous_end, start_time)", "60000000", 2)} AS gap100,
         hour(start_time) IN ({_listed(labels.PEAK_HOURS)}) AS is_peak_hour
  FROM trips)""",
]


def _daily(name: str) -> str:
    return f"""
daily AS (
  SELECT {name}, CAST(start_time AS DATE) AS full_date,
         {_half_up("sum(gap100)", "(100 * count(gap100))", 16)} AS wait16,
         count(ride_id) AS rides, sum(fare100) AS revenue100
  FROM fact WHERE gap100 IS NOT NULL GROUP BY ALL)"""


def _waits(name: str) -> str:
    return f"""
waits AS (
  SELECT {name}, {_half_up("sum(wait16)", "count(wait16)", 0)} AS wait16,
         CAST(sum(rides) AS BIGINT) AS total_rides
  FROM daily GROUP BY ALL)"""


def _spend(name: str) -> str:
    return f"""
spend AS (
  SELECT {name}, count(ride_id) AS total_rides, sum(fare100) AS fare100,
         {_half_up("sum(km100)", "(100 * count(km100))", 16)} AS km16
  FROM fact GROUP BY ALL)"""


_REVENUE = """
revenue AS (
  SELECT driver_name, count(ride_id) AS total_rides, sum(fare100) AS revenue100
  FROM fact GROUP BY ALL)"""


def _steps(rides: str, *more: str) -> str:
    return "WITH " + ",".join([*_RAW[rides], *_STAR, *more])


def _slots(limit: int | None) -> str:
    return f"""
slots AS (
  SELECT dayname(start_time) AS day_name, CAST(hour(start_time) AS BIGINT) AS hour_of_day,
         count(*) AS total_rides, CAST(sum(fare100) AS BIGINT) AS revenue100
  FROM fact GROUP BY ALL ORDER BY revenue100 DESC, day_name, hour_of_day {_limit(limit)})"""


def _limit(limit: int | None) -> str:
    return "" if limit is None else f"LIMIT {limit}"


# --- answers ----------------------------------------------------------------

_DAILY_ANSWER = f"""
SELECT {{}}, full_date, {_places("wait16", 16, 6)} AS avg_wait_time_minutes,
       rides AS total_rides_that_day, {_money("revenue100")} AS total_revenue_that_day
FROM daily"""


def _q1(rides: str, name: str = "driver_name", more_than: int = 100) -> str:
    return f"""{_steps(rides, _daily(name), _waits(name))}
SELECT {name}, {_places("wait16", 16, 6)} AS overall_avg_wait_time_minutes, total_rides
FROM waits WHERE total_rides > {more_than}
ORDER BY wait16, total_rides DESC, {name} LIMIT 10"""


def _q2(rides: str, limit: int | None) -> str:
    return f"""{_steps(rides, _slots(limit))}
SELECT day_name, hour_of_day, total_rides, {_money("revenue100")} AS total_revenue FROM slots"""


def _q3(rides: str, name: str = "masked_name", limit: int | None = 5) -> str:
    return f"""{_steps(rides, _spend(name))}
SELECT {name}, total_rides, {_money("fare100")} AS total_fare_spent,
       {_places("km16", 16, 6)} AS avg_ride_distance_km
FROM spend ORDER BY fare100 DESC, total_rides DESC, {name} {_limit(limit)}"""


def _q4(rides: str, limit: int | None) -> str:
    fleet = f"(SELECT {_half_up('sum(wait16)', 'count(*)', 0)} FROM waits)"
    return f"""{_steps(rides, _daily("driver_name"), _waits("driver_name"))}
SELECT row_number() OVER (ORDER BY wait16, driver_name) AS efficiency_rank, driver_name,
       {_places("wait16", 16, 6)} AS overall_avg_wait_time_minutes, total_rides,
       {_places(fleet, 16, 2)} AS fleet_avg_wait_time
FROM waits ORDER BY 1 {_limit(limit)}"""


def _q5(rides: str, limit: int | None) -> str:
    tiers = _case("place <= {}", labels.REVENUE_TIERS, labels.REVENUE_TIER_REST)
    return f"""{_steps(rides, _REVENUE)}, placed AS (
  SELECT a.*, (SELECT count(*) + 1 FROM revenue b WHERE b.revenue100 > a.revenue100) AS place
  FROM revenue a)
SELECT place AS revenue_rank, driver_name, total_rides, {_money("revenue100")} AS total_revenue,
       {_money(_half_up("revenue100", "total_rides", 0))} AS avg_fare_per_ride,
       {tiers} AS performance_tier
FROM placed ORDER BY place, driver_name {_limit(limit)}"""


def _rated(limit: int | None) -> str:
    tiers = _case("place = {}", labels.QUALITY_TIERS, labels.QUALITY_TIER_REST)
    return f"""
rated AS (
  SELECT driver_name, count(*) AS rides_completed, sum(stars) AS stars,
         {_half_up("sum(stars)", "count(*)", 2)} AS mean100,
         {_half_up("sum(stars)", "count(*)", 16)} AS mean16
  FROM fact WHERE stars IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
tiers AS (
  SELECT dense_rank() OVER (ORDER BY mean16 DESC) AS place, rated.*, {tiers} AS tier_name
  FROM rated ORDER BY place, driver_name {_limit(limit)})"""


def _q6(rides: str, limit: int | None) -> str:
    return f"""{_steps(rides, _rated(limit))}
SELECT place AS quality_tier, driver_name, rides_completed, {_money("mean100")} AS avg_rating,
       tier_name
FROM tiers"""


def _q7(rides: str, limit: int | None) -> str:
    tiers = _case(
        "share < {}.5",
        [(int(bound * 1000), label) for bound, label in labels.COMMISSION_TIERS],
        labels.COMMISSION_TIER_REST,
    )
    share = _half_up("place - 1", "greatest(n - 1, 1)", 3)
    return f"""{_steps(rides, _REVENUE)}, placed AS (
  SELECT *, rank() OVER (ORDER BY revenue100 DESC) AS place, count(*) OVER () AS n FROM revenue),
shared AS (SELECT *, {share} AS share FROM placed)
SELECT driver_name, {_money("revenue100")} AS total_revenue, total_rides,
       {_money(_half_up("revenue100", "total_rides", 0))} AS revenue_per_ride,
       CAST(share AS DOUBLE) / 1000 AS revenue_percentile, {tiers} AS commission_tier
FROM shared ORDER BY revenue100 DESC, driver_name {_limit(limit)}"""


def _q8(rides: str, limit: int | None) -> str:
    tiers = _case(
        "share < {}.5",
        [(int(bound * 1000), label) for bound, label in labels.EFFICIENCY_QUARTILES],
        labels.EFFICIENCY_QUARTILE_REST,
    )
    return f"""{_steps(rides, _daily("driver_name"), _waits("driver_name"))}, placed AS (
  SELECT a.*, (SELECT count(*) FROM waits b WHERE b.wait16 <= a.wait16) AS upto,
         (SELECT count(*) FROM waits) AS n
  FROM waits a),
shared AS (SELECT *, {_half_up("upto", "n", 3)} AS share FROM placed)
SELECT driver_name, total_rides, {_places("wait16", 16, 6)} AS avg_wait_time,
       CAST(share AS DOUBLE) / 1000 AS efficiency_cume_dist, {tiers} AS efficiency_quartile
FROM shared ORDER BY wait16, driver_name {_limit(limit)}"""


def _segments(name: str, limit: int | None) -> str:
    segment = _case("tile = {}", labels.VALUE_SEGMENTS, labels.VALUE_SEGMENT_REST)
    offer = _case("tile = {}", labels.SEGMENT_OFFERS, labels.SEGMENT_OFFER_REST)
    return f"""
tiled AS (
  SELECT ntile(4) OVER (ORDER BY fare100 DESC, {name}) AS tile, * FROM spend),
segments AS (
  SELECT *, {segment} AS segment_name, {offer} AS offer
  FROM tiled ORDER BY fare100 DESC, {name} {_limit(limit)})"""


def _q9(rides: str, limit: int | None, name: str = "masked_name") -> str:
    return f"""{_steps(rides, _spend(name), _segments(name, limit))}
SELECT tile AS customer_value_quartile, {name}, total_rides,
       {_money("fare100")} AS total_fare_spent, {_places("km16", 16, 6)} AS avg_distance_km,
       segment_name, offer
FROM segments"""


def _q10(rides: str, limit: int | None, keys: list[int] | None, with_next: bool = True) -> str:
    micros = "date_diff('microsecond', end_time, next_start)"
    flags = _case(
        f"{micros} > {{}} * 3600000000::BIGINT", labels.IDLE_FLAGS, labels.IDLE_NORMAL
    )
    only = "" if keys is None else f"AND driver_key IN ({_listed(keys)})"
    return f"""{_steps(rides)}
SELECT driver_name, CAST(start_time AS DATE) AS ride_date,
       CAST(hour(start_time) AS BIGINT) AS start_hour, {_money("fare100")} AS current_fare,
       {"next_start AS next_ride_start," if with_next else ""}
       {_places(_half_up(micros, "3600000000", 1), 1, 1)} AS idle_hours_until_next_ride,
       {flags} AS retention_risk_flag
FROM fact WHERE next_start IS NOT NULL {only}
ORDER BY driver_name, start_time, ride_id {_limit(limit)}"""


def _q11(rides: str, limit: int | None, names: list[str] | None) -> str:
    trend = _case(
        "gain100 >= {}00",
        [(bound or "", label) for bound, label in labels.PROGRESSION_TRENDS],
        labels.PROGRESSION_REST,
    )
    only = "" if names is None else f"WHERE driver_name IN ({_listed(names)})"
    return f"""{_steps(rides)}, firsts AS (
  SELECT driver_key, arg_min(fare100, ride_number) AS first100 FROM fact GROUP BY driver_key),
gains AS (SELECT *, fare100 - first100 AS gain100 FROM fact JOIN firsts USING (driver_key))
SELECT driver_name, ride_number, CAST(start_time AS DATE) AS ride_date,
       {_money("fare100")} AS current_fare, {_money("first100")} AS first_ever_fare,
       {_money("gain100")} AS fare_improvement,
       CASE WHEN first100 <> 0 THEN {_places(_half_up("100 * gain100", "first100", 1), 1, 1)} END
         AS improvement_percent,
       {trend} AS performance_trend
FROM gains {only} ORDER BY driver_name, ride_number, driver_key {_limit(limit)}"""


def _q12(rides: str, limit: int | None) -> str:
    below = int(labels.TREND_ALERT_BELOW * 100)
    return f"""{_steps(rides)}, latest AS (
  SELECT driver_key, any_value(driver_name) AS driver_name, count(*) AS total_rides,
         {_half_up("sum(stars)", "count(*)", 2)} AS mean100,
         100 * arg_max(stars, ride_number) AS last100
  FROM fact WHERE stars IS NOT NULL GROUP BY driver_key),
trends AS (SELECT *, last100 - mean100 AS trend100 FROM latest)
SELECT driver_name, total_rides, {_money("mean100")} AS lifetime_avg_rating,
       {_money("last100")} AS most_recent_rating, {_money("trend100")} AS recent_trend,
       CASE WHEN trend100 < {below} THEN '{labels.TREND_ALERT}'
            WHEN trend100 < 0 THEN '{labels.TREND_WARNING}'
            ELSE '{labels.TREND_POSITIVE}' END AS quality_trend_flag
FROM trends ORDER BY trend100, driver_name, driver_key {_limit(limit)}"""


def _milestones(limit: int | None, least: int) -> str:
    fares = ", ".join(
        f"max(fare100) FILTER (ride_number = {n}) AS f{n}" for n in labels.MILESTONES
    )
    return f"""
milestones AS (
  SELECT driver_key, any_value(driver_name) AS driver_name, count(*) AS rides, {fares}
  FROM fact GROUP BY driver_key HAVING count(*) >= {least}
  ORDER BY rides DESC, driver_name, driver_key {_limit(limit)})"""


_MILESTONE_FARES = ", ".join(f"{_money(f'f{n}')} AS ride_{n}_fare" for n in labels.MILESTONES)


def _q13(rides: str, limit: int | None) -> str:
    stage = _case("rides >= {}", labels.LIFECYCLE_STAGES, labels.LIFECYCLE_REST)
    return f"""{_steps(rides, _milestones(limit, 10))}
SELECT driver_name, rides AS total_rides_to_date, {stage} AS driver_lifecycle_stage,
       {_MILESTONE_FARES},
       if(rides >= 50 AND f10 > f1, '{labels.STRONG_ONBOARDING}', '{labels.MONITOR_ONBOARDING}')
         AS onboarding_quality
FROM milestones"""


def _marts(rides: str) -> dict[str, str]:
    return {
        "driver_daily_utilization": _steps(rides, _daily("driver_name"))
        + _DAILY_ANSWER.format("driver_name"),
        "q1_driver_efficiency": _q1(rides),
        "q2_peak_hours": _q2(rides, 20),
        "q3_vip_customers": _q3(rides),
        "q4_leaderboard": _q4(rides, 15),
        "q5_revenue_rank": _q5(rides, 30),
        "q6_quality_tiers": _q6(rides, 20),
        "q7_commission": _q7(rides, 25),
        "q8_efficiency_quartiles": _q8(rides, 30),
        "q9_value_segments": _q9(rides, 50),
        "q10_idle_gaps": _q10(rides, 30, labels.SAMPLE_DRIVER_KEYS),
        "q11_progression": _q11(rides, 50, DRIVER_NAMES),
        "q12_quality_trend": _q12(rides, 20),
        "q13_milestones": _q13(rides, 30),
    }


def _variants() -> dict[str, str]:
    rides = "events"
    return {
        "driver_key_daily_utilization": _steps(rides, _daily("driver_key"))
        + _DAILY_ANSWER.format("driver_key"),
        "q1_by_driver_key": _q1(rides, "driver_key", 90),
        "q2_all": _q2(rides, None),
        "q3_by_user": _q3(rides, "user_key", None),
        "q4_all": _q4(rides, None),
        "q5_all": _q5(rides, None),
        "q6_all": _q6(rides, None),
        "q7_all": _q7(rides, None),
        "q8_all": _q8(rides, None),
        "q9_all": _q9(rides, None),
        "q9_by_user": _q9(rides, None, "user_key"),
        "q10_100": _q10(rides, 100, labels.SAMPLE_DRIVER_KEYS, with_next=False),
        "q10_all_drivers": _q10(rides, None, None),
        "q11_all_drivers": _q11(rides, None, None),
        "q11_five_names": _q11(rides, None, DRIVER_NAMES),
        "q12_all": _q12(rides, None),
        "q13_all": _q13(rides, None),
        "q5_from_states": _q5(rides, None),
        "q6_from_states": _q6(rides, None),
        "q7_from_states": _q7(rides, None),
        "q9_from_states": _q9(rides, None),
        "q12_from_states": _q12(rides, None),
        "q13_from_states": _q13(rides, None),
    }


# --- load -------------------------------------------------------------------

_FACT_COLUMNS = f"""ride_id, user_key, driver_key, start_date_key, start_time, end_time,
       {_money("length100")} AS ride_duration_minutes, {_money("km100")} AS distance_km,
       {_money("fare100")} AS fare_amount, {_money("gap100")} AS time_to_next_ride_minutes,
       is_peak_hour, CAST(stars AS DOUBLE) AS average_driver_rating"""

_CSV_COLUMNS = {
    "users": "CAST(user_id AS VARCHAR) AS user_id, name, email, phone_number, registration_date, "
    "age, gender, location",
    "drivers": "CAST(driver_id AS VARCHAR) AS driver_id, name, "
    "CAST(vehicle_id AS VARCHAR) AS vehicle_id, CAST(NULL AS DOUBLE) AS rating, "
    "CAST(NULL AS BIGINT) AS total_rides, available",
    "vehicles": "CAST(vehicle_id AS VARCHAR) AS vehicle_id, make, model, year, capacity",
    "rides": "CAST(ride_id AS VARCHAR) AS ride_id, CAST(user_id AS VARCHAR) AS user_id, "
    "CAST(NULL AS VARCHAR) AS start_location, CAST(NULL AS VARCHAR) AS end_location, "
    f"ride_start_time, ride_end_time, {_money('km100')} AS distance_km, "
    "CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(driver_id AS VARCHAR) AS driver_id",
    "ratings": "CAST(rating_id AS VARCHAR) AS rating_id, CAST(ride_id AS VARCHAR) AS ride_id, "
    "CAST(user_id AS VARCHAR) AS user_id, rating_value, CAST(NULL AS VARCHAR) AS comments, "
    "rating_date",
}

# Columns of the checked tables that hold NULLs or long text, as SQL; the rest of
# the declared columns are checked on the mapping's own columns.
_CHECKED = {
    "users": "raw_users",
    "drivers": "(SELECT *, CAST(NULL AS DECIMAL(3,2)) AS rating FROM raw_drivers)",
    "vehicles": "raw_vehicles",
    "rides": "(SELECT *, NULL AS start_location, NULL AS end_location, km100 / 100 AS distance_km"
    " FROM raw_rides)",
    "ratings": "raw_ratings",
    "dim_user": "dim_user",
    "dim_driver": "dim_driver",
    "dim_date": "dim_date",
    "fact_rides": f"(SELECT {_FACT_COLUMNS} FROM fact)",
}


def _violations() -> str:
    parts = []
    for table, rules in RULES.items():
        checks = [(name, "not_null", f"{name} IS NULL") for name in rules.not_null]
        checks += [
            (name, f"varchar({size})", f"length(CAST({name} AS VARCHAR)) > {size}")
            for name, size in rules.max_length.items()
        ]
        checks += [
            (name, f"decimal({p},{s})", f"abs({name}) >= {10 ** (p - s)}")
            for name, (p, s) in rules.decimals.items()
        ]
        parts += [
            f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{rule}' AS rule,"
            f" count(*) FILTER ({bad}) AS n_rows FROM {_CHECKED[table]}"
            for name, rule, bad in checks
        ]
    return _steps("events") + "\n" + "\nUNION ALL ".join(parts)


def _references() -> str:
    parts = []
    for child, column, parent, parent_column in FOREIGN_KEYS:
        parts.append(
            f"SELECT '{child}' AS child_table, '{column}' AS child_column,"
            f" '{parent}' AS parent_table, count(DISTINCT {column}) AS n_values,"
            f" count(*) AS n_rows FROM {_CHECKED[child]}"
            f" WHERE {column} IS NOT NULL AND {column} NOT IN"
            f" (SELECT {parent_column} FROM {_CHECKED[parent]})"
        )
    return _steps("events") + "\n" + "\nUNION ALL ".join(parts)


# Table, key and the rule's columns, as the table definitions state them.
_KEYS = [
    ("users", "user_id"), ("drivers", "driver_id"), ("vehicles", "vehicle_id"),
    ("rides", "ride_id"), ("ratings", "rating_id"), ("dim_user", "user_key"),
    ("dim_user", "user_id"), ("dim_driver", "driver_key"), ("dim_driver", "driver_id"),
    ("dim_date", "date_key"), ("dim_date", "full_date"), ("fact_rides", "ride_id"),
]
_FIRST_KEY = dict(reversed(_KEYS))


def _declared_keys() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{key}' AS key, count(*) AS n_keys, count(*) AS n_rows"
        f" FROM {_CHECKED[table]} WHERE {_third(_FIRST_KEY[table])}"
        for table, key in _KEYS
    ]
    return _steps("events") + "\n" + "\nUNION ALL ".join(parts)


def _third(column: str) -> str:
    return f"substr(md5(CAST({column} AS VARCHAR)), 1, 1) < '5'"


def _broken_rows(tables: list[str] | None = None) -> str:
    """Every rule is broken by as many rows as its table has, and by no other."""
    parts = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule,"
        f" count(*) AS n_rows FROM {_CHECKED[table]}"
        for table, rules in _RULES.items()
        if tables is None or table in tables
        for column, rule in (x.split(" ") for x in rules.split(", "))
    ]
    return _steps("events") + "\n" + "\nUNION ALL ".join(parts)


# The rules as the table definitions state them, and the types of what is not text.
_RULES = {
    "users": "user_id not_null, user_id varchar(50), name varchar(255), email varchar(255),"
    " phone_number varchar(50), gender varchar(20), location varchar(255),"
    " registration_date date, age int",
    "drivers": "driver_id not_null, driver_id varchar(50), name varchar(255),"
    " vehicle_id varchar(50), rating decimal(3,2), total_rides int, available boolean",
    "vehicles": "vehicle_id not_null, vehicle_id varchar(50), make varchar(100),"
    " model varchar(100), year int, capacity int",
    "rides": "ride_id not_null, ride_id varchar(50), user_id varchar(50),"
    " start_location varchar(255), end_location varchar(255), driver_id varchar(50),"
    " distance_km decimal(10,2), fare_amount decimal(10,2),"
    " ride_start_time timestamp_ntz, ride_end_time timestamp_ntz",
    "ratings": "rating_id not_null, rating_id varchar(50), ride_id varchar(50),"
    " user_id varchar(50), rating_value int, rating_date date",
    "dim_user": "user_key not_null, user_id not_null, user_id varchar(50),"
    " masked_name varchar(255), masked_email_hash varchar(32), masked_phone_hash varchar(32),"
    " gender varchar(20), location_city varchar(100), user_key bigint, registration_date date,"
    " age int, is_active_subscriber boolean",
    "dim_driver": "driver_key not_null, driver_id not_null, driver_id varchar(50),"
    " driver_name varchar(255), vehicle_make varchar(100), vehicle_model varchar(100),"
    " driver_key bigint, vehicle_year int, vehicle_capacity int, is_available_flag boolean",
    "dim_date": "date_key not_null, full_date not_null, day_name varchar(10),"
    " month_name varchar(10), date_key int, full_date date, day_of_week int, year int,"
    " is_weekend boolean",
    "fact_rides": "ride_id not_null, ride_id varchar(50), ride_duration_minutes decimal(10,2),"
    " distance_km decimal(10,2), fare_amount decimal(10,2),"
    " time_to_next_ride_minutes decimal(10,2), average_driver_rating decimal(3,2),"
    " user_key bigint, driver_key bigint, start_date_key int, start_time timestamp_ntz,"
    " end_time timestamp_ntz, is_peak_hour boolean",
}


def _broken_references() -> str:
    parts = [
        f"SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,"
        f" count(DISTINCT {column}) AS n_values, count(*) AS n_rows FROM {_CHECKED[child]}"
        f" WHERE {column} IS NOT NULL AND ({_third(column)}"
        f" OR {column} NOT IN (SELECT {parent_column} FROM {_CHECKED[parent]}))"
        for child, column, parent, parent_column in FOREIGN_KEYS
    ]
    return _steps("events") + "\n" + "\nUNION ALL ".join(parts)


def _broken_losses() -> str:
    return f"""{_steps("events")},
known AS (SELECT driver_id FROM raw_drivers WHERE available),
kept AS (SELECT user_id FROM raw_users WHERE user_id % 5 <> 0)
SELECT 'ride without ride_start_time' AS reason, count(*) AS n_rows FROM raw_rides WHERE ride_id % 17 = 0
UNION ALL SELECT 'ride without user_id', count(*) FROM raw_rides WHERE ride_id % 19 = 0
UNION ALL SELECT 'ride without driver_id', count(*) FROM raw_rides WHERE ride_id % 23 = 0
UNION ALL SELECT 'ride of an unknown user', count(*) FROM raw_rides
  WHERE ride_id % 19 <> 0 AND user_id NOT IN (SELECT user_id FROM kept)
UNION ALL SELECT 'ride of an unknown driver', count(*) FROM raw_rides
  WHERE ride_id % 23 <> 0 AND driver_id NOT IN (SELECT driver_id FROM known)
UNION ALL SELECT 'further rating of a ride', count(*) FROM raw_ratings WHERE ride_id % 4 = 0"""


def _load_losses() -> str:
    return f"""{_steps("events")}, known AS (SELECT driver_id FROM raw_drivers WHERE available)
SELECT 'ride without ' || column_name AS reason, 0::BIGINT AS n_rows
FROM (VALUES ('ride_start_time'), ('user_id'), ('driver_id')) v(column_name)
UNION ALL SELECT 'ride of an unknown user', count(*) FROM raw_rides
  WHERE user_id NOT IN (SELECT user_id FROM raw_users)
UNION ALL SELECT 'ride of an unknown driver', count(*) FROM raw_rides
  WHERE driver_id NOT IN (SELECT driver_id FROM known)
UNION ALL SELECT 'further rating of a ride', count(*) - count(DISTINCT ride_id) FROM raw_ratings"""


def _lookup(by: str) -> str:
    return f"""{_steps("events")} SELECT {_FACT_COLUMNS} FROM fact
WHERE {by} = (SELECT {by} FROM fact GROUP BY {by} ORDER BY count(*) DESC, {by} LIMIT 1)"""


def _load() -> dict[str, str]:
    found = {
        f"csv_{name}": f"{_steps('events')} SELECT {columns} FROM raw_{name}"
        for name, columns in _CSV_COLUMNS.items()
    }
    found |= {
        "dq_duplicate_keys": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,"
        " count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
        "dq_violations": _violations(),
        "dq_broken_rows": _broken_rows(),
        "dq_text_rows": _broken_rows(["rides"]),
        "dq_declared_keys": _declared_keys(),
        "dq_references": _references(),
        "dq_broken_references": _broken_references(),
        "dq_broken_losses": _broken_losses(),
        "dq_orphans": _steps("events")
        + """ SELECT driver_id, count(*) AS n_rows FROM raw_rides
            WHERE driver_id NOT IN (SELECT driver_id FROM raw_drivers WHERE available)
            GROUP BY driver_id""",
        "dq_load_losses": _load_losses(),
        "dq_reasons": _steps("events")
        + """, doubled AS (
  SELECT * FROM raw_rides UNION ALL SELECT * FROM raw_rides WHERE ride_id % 29 = 0)
SELECT ride_id AS number, driver_id, concat_ws('; ',
  CASE WHEN ride_id % 31 = 0 THEN 'ride_id not_null' END,
  CASE WHEN ride_id % 37 = 0 THEN 'fare_amount decimal(10,2)' END,
  CASE WHEN ride_id % 19 <> 0 AND user_id NOT IN (SELECT user_id FROM raw_users WHERE user_id % 5 <> 0)
    THEN 'user_id reference' END,
  CASE WHEN driver_id NOT IN (SELECT driver_id FROM raw_drivers WHERE available)
    THEN 'driver_id reference' END,
  CASE WHEN ride_id % 29 = 0 AND ride_id % 31 <> 0 THEN 'ride_id key' END) AS reasons
FROM doubled""",
        "dim_date": _steps("events") + " SELECT * FROM dim_date",
        "dim_user": _steps("events") + " SELECT * FROM dim_user",
        "dim_driver": _steps("events") + " SELECT * FROM dim_driver",
        "upsert_ignore_dim": _steps("events")
        + """, early AS (
          SELECT row_number() OVER (ORDER BY user_id) AS user_key, *, 1 AS batch
          FROM masked WHERE registration_date < DATE '2023-07-01'),
        late AS (
          SELECT (SELECT max(user_key) FROM early) + row_number() OVER (ORDER BY user_id) AS user_key,
                 *, 2 AS batch
          FROM masked WHERE user_id IN (SELECT user_id FROM raw_rides)
            AND user_id NOT IN (SELECT user_id FROM early))
        SELECT * REPLACE (CAST(batch AS BIGINT) AS batch)
        FROM (SELECT * FROM early UNION ALL SELECT * FROM late)""",
        "csv_line_breaks": _steps("events")
        + """ SELECT *, '"' || rating_id || '"' || chr(10) || ', "' || chr(10) AS comments
        FROM raw_ratings""",
        "durable_keys": _steps("events")
        + """, halves AS (
          SELECT user_id, user_id > (SELECT (min(user_id) + max(user_id)) // 2 FROM raw_users) AS early
          FROM masked)
        SELECT user_id, early, true AS kept, true AS positive,
               (SELECT count(*) FROM halves WHERE early) AS n_early,
               (SELECT count(*) FROM halves) AS n_keys, (SELECT count(*) FROM halves) AS last_key
        FROM halves""",
        "distinct_dates": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS full_date FROM lineitem"
        " WHERE l_orderkey IN (SELECT o_orderkey FROM orders)",
        "mask_pii": _steps("events") + " SELECT * FROM masked",
        "mask_pii_salted": _steps("events")
        + f""" SELECT masked.* REPLACE (sha256('{SALT}' || email) AS masked_email_hash,
            sha256('{SALT}' || phone_number) AS masked_phone_hash)
            FROM masked JOIN raw_users USING (user_id)""",
        "join_inner": _steps("events") + " SELECT ride_id, user_key, driver_key FROM fact",
        "join_inner_dropping": _steps("events")
        + """ SELECT ride_id, user_key, driver_key FROM fact
            WHERE user_key % 5 <> 0 AND driver_key % 3 <> 0 AND start_date_key % 7 <> 0""",
        "join_computed_key": _steps("orders")
        + " SELECT ride_id, start_date_key AS date_key FROM fact",
        "join_left_ratings": _steps("events")
        + " SELECT ride_id, CAST(stars AS DOUBLE) AS average_driver_rating FROM fact",
        "join_star": _steps("events")
        + """ SELECT ride_id, d.driver_name, vehicle_make, dayname(start_time) AS day_name, masked_name
            FROM fact JOIN dim_driver d USING (driver_key)""",
        "fact_by_date": f"{_steps('events')} SELECT {_FACT_COLUMNS} FROM fact",
        "fact_by_user_date": f"{_steps('events')} SELECT {_FACT_COLUMNS} FROM fact",
        "lookup_user": _lookup("user_key"),
        "lookup_date": _lookup("start_date_key"),
        "ride_uses": _steps("events")
        + """ SELECT r.ride_id, CASE WHEN r.ride_id % 10 = 3 THEN 2 ELSE 1 END AS n_batch,
               CASE WHEN f.ride_id IS NULL THEN 0 ELSE 1 END AS n_stored
        FROM raw_rides r LEFT JOIN fact f ON f.ride_id = r.ride_id
        UNION ALL SELECT -ride_id - 1, 1, 0 FROM raw_rides""",
        "fact_in_batches": f"{_steps('events')} SELECT {_FACT_COLUMNS} FROM fact",
        "daily_in_batches": f"""{_steps('events')}
SELECT driver_key, start_date_key, {_money("sum(gap100)")} AS wait, count(gap100) AS waits,
       count(ride_id) AS rides, {_money("sum(fare100)")} AS revenue
FROM fact WHERE gap100 IS NOT NULL GROUP BY driver_key, start_date_key""",
        "utilization_in_batches": _steps("events", _daily("driver_name"))
        + _DAILY_ANSWER.format("driver_name"),
        "fact_rides": f"{_steps('events')} SELECT {_FACT_COLUMNS} FROM fact",
        "orders_fact_rides": f"{_steps('orders')} SELECT {_FACT_COLUMNS} FROM fact",
    }
    return found


# --- windows ----------------------------------------------------------------


def _seconds(start: str, end: str) -> str:
    return f"CAST(date_diff('microsecond', {start}, {end}) AS DOUBLE) / 1000000"


def _rank_family(limit: int | None) -> str:
    return f"""{_steps("events")}, counts AS (
  SELECT driver_key, count(*) AS n_rides FROM fact GROUP BY driver_key)
SELECT driver_key, n_rides, row_number() OVER (ORDER BY n_rides DESC, driver_key) AS row_no,
       rank() OVER w AS rank_no, dense_rank() OVER w AS dense_no,
       round(percent_rank() OVER w, 9) AS pct, round(cume_dist() OVER w, 9) AS cume,
       ntile(4) OVER (ORDER BY n_rides DESC, driver_key) AS tile
FROM counts WINDOW w AS (ORDER BY n_rides DESC) ORDER BY row_no {_limit(limit)}"""


def _windows() -> dict[str, str]:
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    found = {
        "win_lag_gap": f"""{_steps("events")}
SELECT ride_id, previous_end, next_start, {_seconds("previous_end", "start_time")} AS seconds_since,
       {_seconds("end_time", "next_start")} AS seconds_until FROM fact""",
        "win_numbering": f"""{_steps("events")}
SELECT ride_id, ride_number, {_money("first_value(fare100) OVER w")} AS first_fare
FROM fact WINDOW w AS (PARTITION BY driver_key ORDER BY ride_number {whole})""",
        "win_partition_values": f"""{_steps("events")}, per_ride AS (
  SELECT ride_id, count(*) OVER p AS n_rides, sum(stars) OVER p AS stars, count(stars) OVER p AS rated,
         last_value(fare100) OVER w AS last100, last_value(stars) OVER w AS last_stars
  FROM fact WINDOW p AS (PARTITION BY driver_key),
                   w AS (PARTITION BY driver_key ORDER BY ride_number {whole}))
SELECT ride_id, n_rides,
       CASE WHEN rated > 0 THEN {_places(_half_up("stars", "rated", 16), 16, 6)} END AS mean_rating,
       {_money("last100")} AS last_fare, CAST(last_stars AS DOUBLE) AS last_rating FROM per_ride""",
        "win_null_partition": f"""{_steps("events")}
SELECT ride_id, CAST(stars AS DOUBLE) AS average_driver_rating, count(*) OVER p AS n_rides,
       {_money("last_value(fare100) OVER w")} AS last_fare
FROM fact WINDOW p AS (PARTITION BY stars),
                 w AS (PARTITION BY stars ORDER BY start_time, CAST(ride_id AS VARCHAR) {whole})""",
        "win_nth_value": f"""{_steps("events", _milestones(None, 1))}
SELECT driver_key, rides AS total_rides_to_date, {_MILESTONE_FARES} FROM milestones""",
        "latest_per_driver": f"""{_steps("events")}
SELECT driver_key, ride_id, start_time, end_time, CAST(fare_amount AS DOUBLE) AS fare_amount,
       CAST(stars AS DOUBLE) AS average_driver_rating
FROM fact WHERE next_start IS NULL""",
        "win_fleet_avg": f"""{_steps("events", _daily("driver_name"), _waits("driver_name"))}
SELECT driver_name, {_places("wait16", 16, 6)} AS avg_wait,
       {_places("(SELECT " + _half_up("sum(wait16)", "count(*)", 0) + " FROM waits)", 16, 6)}
         AS fleet_avg_wait
FROM waits""",
        "win_rank_family": _rank_family(None),
        "win_rank_family_top": _rank_family(25),
        "q10_colocated": _q10("events", None, None),
        "q11_colocated": _q11("events", None, None),
    }
    return found | {f"{name}_colocated": found[name] for name in ("win_lag_gap", "win_numbering")}


# --- reports ----------------------------------------------------------------


def _heatmap(limit: int | None) -> str:
    hours = ", ".join(
        f"CAST(sum(revenue100) FILTER (hour_of_day = {hour}) AS DOUBLE) / 100 AS h{hour:02d}"
        for hour in range(24)
    )
    return f"""{_steps("events", _slots(limit))}
SELECT list_position([{_listed(labels.WEEKDAYS)}], day_name)::BIGINT AS day_order, day_name, {hours}
FROM slots GROUP BY day_name"""


def _funnel(limit: int | None) -> str:
    steps = "\nUNION ALL ".join(
        f"SELECT CAST({n} AS BIGINT) AS ride, 'Ride #{n}' AS milestone, count(f{n}) AS drivers,"
        f" CASE WHEN count(f{n}) > 0 THEN"
        f" {_places(_half_up(f'sum(f{n})', f'(100 * count(f{n}))', 6), 6, 6)} END AS avg_fare"
        " FROM milestones"
        for n in labels.MILESTONES
    )
    return f"{_steps('events', _milestones(limit, 10))}\n{steps}"


def _two(scaled: str) -> str:
    """A whole number of hundredths as text with two places."""
    return f"CAST(CAST({scaled} AS DECIMAL(38,2)) / 100 AS DECIMAL(38,2))::VARCHAR"


def _manifest() -> str:
    rides = "events"
    counted = [
        ("01_driver_efficiency", _q1(rides)),
        ("02_peak_hours_heatmap", _heatmap(20)),
        ("03_top_peak_hours", _q2(rides, 20)),
        ("04_vip_customers", _q3(rides)),
        ("05_vip_revenue_distribution", _q3(rides)),
        ("06_driver_leaderboard", _q4(rides, 15)),
        ("07_revenue_tier_ranks", _q5(rides, 30)),
        ("08_quality_tier_counts", _tier_counts()),
        ("08_quality_tier_averages", _tier_counts()),
        ("09_commission_percentiles", _q7(rides, 25)),
        ("10_efficiency_quartiles", _q8(rides, None)),
        ("11_customer_value_segments", _segment_stats()),
        ("12_churn_risk_matrix", _q10(rides, 100, labels.SAMPLE_DRIVER_KEYS)),
        ("13_driver_progression", _q11(rides, 50, DRIVER_NAMES)),
        ("14_quality_trend_alerts", _q12(rides, 20)),
        ("15_driver_milestones", _funnel(30)),
    ]
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS report, count(*) AS n_rows,"
        f" if(count(*) > 0, 'OK', 'NO DATA') AS status FROM ({sql})"
        for name, sql in counted
    )


def _tier_counts() -> str:
    return f"""{_steps("events", _rated(None))}
SELECT tier_name, count(*) AS drivers FROM tiers GROUP BY tier_name"""


def _whole(column: str) -> str:
    return f"format('{{:,}}', CAST(round_even({column}, 0) AS BIGINT))"


def _segment_stats() -> str:
    return f"""{_steps("events", _spend("masked_name"), _segments("masked_name", None))}
SELECT *, customer_count || ' in ' || segment_name || ' with ' || {_whole("min_fare")} || ' to '
    || {_whole("max_fare")} || ' each, ' || {_whole("total_fare")} || ' together; first: '
    || top_customers AS caption
FROM (SELECT segment_name, {_money("min(fare100)")} AS min_fare, {_money("max(fare100)")} AS max_fare,
       {_places(_half_up("sum(fare100)", "(100 * count(*))", 6), 6, 6)} AS avg_fare,
       {_money("sum(fare100)")} AS total_fare, count(*) AS customer_count,
       array_to_string(list(masked_name ORDER BY fare100 DESC, masked_name)[1:3], ', ')
         AS top_customers
FROM segments GROUP BY segment_name)"""


def _reports() -> dict[str, str]:
    vip = """
vip AS (SELECT * FROM spend ORDER BY fare100 DESC, total_rides DESC, masked_name LIMIT 5)"""
    total = "(SELECT sum(fare100) FROM vip)"
    return {
        "report_peak_heatmap": _heatmap(20),
        "report_peak_heatmap_full": _heatmap(None),
        "report_peak_labels": f"""{_steps("events", _slots(20))}
SELECT day_name || ' ' || hour_of_day || ':00' AS hour_label, day_name, hour_of_day, total_rides,
       {_money("revenue100")} AS total_revenue
FROM slots""",
        "report_vip_share": f"""{_steps("events", _spend("masked_name"), vip)}
SELECT masked_name, {_money("fare100")} AS total_fare_spent,
       {_places(_half_up("fare100", total, 6), 6, 6)} AS share,
       masked_name || ' spent ' || {_two("fare100")} || ' on ' || total_rides
         || ' trips of ' || {_two(_half_up("km16", str(10**14), 0))} || ' km each' AS caption
FROM vip""",
        "report_tier_counts": _tier_counts(),
        "report_tier_avg": f"""{_steps("events", _rated(None))}
SELECT tier_name, {_places(_half_up("sum(mean100)", "(100 * count(*))", 6), 6, 6)} AS avg_rating
FROM tiers GROUP BY tier_name""",
        "report_segment_stats": _segment_stats(),
        "report_milestone_funnel": _funnel(30),
        "report_milestone_funnel_full": _funnel(None),
        "report_manifest": _manifest(),
        "report_manifest_shared": _manifest(),
    }


def statements() -> dict[str, str]:
    found = _load() | _windows() | _marts("events")
    found |= {f"orders_{name}": sql for name, sql in _marts("orders").items()}
    return found | _variants() | _reports()
