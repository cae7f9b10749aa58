"""The registered queries as plain SQL over the same tables.

Written from the meaning of each query, by direct distinct counts, joins and
windows, so that it shares no step with the DataFrame functions.
"""

from curfew import schema
from curfew.functions import fixed_values as V
from curfew.plans.queries import LOOKUP_PLAYER


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case(branches, otherwise="NULL") -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in branches) + f" ELSE {otherwise} END"


def below(value, bounds, otherwise) -> str:
    return case([(f"{value} < {bound}", quoted(name)) for bound, name in bounds], quoted(otherwise))


def up_to(value, bounds, otherwise) -> str:
    return case([(f"{value} <= {bound}", quoted(name)) for bound, name in bounds], quoted(otherwise))


#: Bounds are written out here, apart from those of the library, so that a wrong one shows.
HISTOGRAM_BOUNDS = [30, 60, 120, 180, 240, 360]


def named(bounds, classes) -> list:
    """Bounds with the names of the library's classes, in order."""
    return [(bound, name) for bound, (_, name) in zip(bounds, classes, strict=True)]


def wording(vocabulary, label="risk_label") -> str:
    other = V.RISK_WORDING_ELSE.get(vocabulary)
    return case([(f"{label} = {k}", quoted(v)) for k, v in V.RISK_WORDING[vocabulary].items()],
                quoted(other) if other else "NULL")


def rounded(value, digits) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def avg(value, digits) -> str:
    return rounded(f"avg({value})", digits)


def pct(part, whole, digits) -> str:
    return rounded(f"({part}) * 100.0 / nullif({whole}, 0)", digits)


def money(value) -> str:
    return f"CAST({value} AS DOUBLE)"


def cd(condition=None, column="player_id") -> str:
    where = f" FILTER (WHERE {condition})" if condition else ""
    return f"count(DISTINCT {column}){where}"


def cnt(condition) -> str:
    return f"count(*) FILTER (WHERE {condition})"


DURATION_SQL = "CAST((event_id * 7919) % 21601 AS BIGINT)"
REGION_SQL = "list_extract([" + ", ".join(map(quoted, V.REGIONS)) + "], event_id % 12 + 1)"
DEVICE_SQL = "list_extract([" + ", ".join(map(quoted, V.DEVICES)) + "], event_id % 3 + 1)"
PLAYER_SQL = "'P' || lpad(CAST(user_id AS VARCHAR), 8, '0')"
GAME_SQL = "'GAME_' || lpad(CAST(event_id % 10 + 1 AS VARCHAR), 3, '0')"
IP_SQL = "'10.0.' || (event_id % 256) || '.' || (1 + event_id % 250)"
AMOUNT_SQL = ("CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) "
              "ELSE CAST(0 AS DECIMAL(12,2)) END")
PERIOD_SQL = case([("h BETWEEN 6 AND 17", quoted(V.DAYTIME)), ("h >= 18", quoted(V.EVENING))], quoted(V.NIGHT))
NIGHT_SQL = f"(login_hour >= 22 OR login_hour < 8)"
LABEL_SQL = case([
    ("is_minor = 0", "0"),
    (f"online_duration > 14400 AND {NIGHT_SQL}", "3"),
    (f"online_duration > 14400", "1"),
    (NIGHT_SQL, "2"),
], "0")
MINUTES_SQL = "CAST(round(CAST(online_duration / 60.0 AS DECIMAL(18,6)), 1) AS DECIMAL(10,1))"

# Columns that follow from others, the same for facts of events and of raw rows.
DERIVED_SQL = f"""
  CAST(login_time AS DATE) AS login_date,
  CAST(hour(login_time) AS INTEGER) AS login_hour,
  CAST(isodow(login_time) AS INTEGER) AS login_dayofweek,
  {MINUTES_SQL} AS online_duration_min,
  CASE WHEN login_period = '{V.NIGHT}' THEN 1 ELSE 0 END AS is_night_login,
  CASE WHEN account_type = 'minor' THEN 1 ELSE 0 END AS is_minor,
  CASE WHEN online_duration > 14400 THEN 1 ELSE 0 END AS is_heavy_gamer,
  CASE WHEN recharge_amount > 0 THEN 1 ELSE 0 END AS is_paying_player"""

BEH = f"""
base AS (
  SELECT {PLAYER_SQL} AS player_id,
    CASE WHEN user_id % 10 < 3 THEN 'minor' ELSE 'adult' END AS account_type,
    {GAME_SQL} AS game_id, ts AS login_time,
    ts + to_seconds({DURATION_SQL}) AS logout_time,
    {DURATION_SQL} AS online_duration,
    CAST(event_id % 16 AS INTEGER) AS match_count, {AMOUNT_SQL} AS recharge_amount,
    event_id % 200 AS item_consumption, {IP_SQL} AS login_ip,
    {REGION_SQL} AS game_region, {DEVICE_SQL} AS device_type,
    {PERIOD_SQL} AS login_period
  FROM (SELECT *, hour(ts) AS h FROM events)
),
derived AS (SELECT *, {DERIVED_SQL} FROM base),
beh AS (SELECT *, {LABEL_SQL} AS risk_label, login_date AS dt FROM derived),
newest AS (SELECT max(dt) AS d FROM beh)"""

TEXT_FORMAT = "'%Y-%m-%d %H:%M:%S'"
RAW = f"""
once AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN '' ELSE {PLAYER_SQL} END AS player_id,
    CASE WHEN user_id % 10 < 3 THEN ' Minor' ELSE 'adult' END AS account_type,
    {GAME_SQL} AS game_id,
    strftime(ts, {TEXT_FORMAT}) AS login_time,
    strftime(ts + to_seconds(CASE WHEN event_id % 131 = 0 THEN -{DURATION_SQL} ELSE {DURATION_SQL} END),
      {TEXT_FORMAT}) AS logout_time,
    CASE WHEN event_id % 103 = 0 THEN 'abc' WHEN event_id % 107 = 0 THEN '-5'
      WHEN event_id % 109 = 0 THEN '21601' ELSE CAST({DURATION_SQL} AS VARCHAR) END AS online_duration,
    CAST(event_id % 16 AS VARCHAR) AS match_count,
    CAST({AMOUNT_SQL} AS VARCHAR) AS recharge_amount,
    CAST(event_id % 200 AS VARCHAR) AS item_consumption,
    CASE WHEN event_id % 113 = 0 THEN '127.0.0.1' WHEN event_id % 127 = 0 THEN '300.1.1.1'
      ELSE {IP_SQL} END AS login_ip,
    {PERIOD_SQL} AS login_period,
    {REGION_SQL} AS game_region, {DEVICE_SQL} AS device_type,
    strftime(ts, '%Y%m%d') AS dt, event_id
  FROM (SELECT *, hour(ts) AS h FROM events)
),
raw AS (
  SELECT * EXCLUDE (event_id) FROM once
  UNION ALL
  SELECT * EXCLUDE (event_id) FROM once WHERE event_id % 97 = 0
),
newest AS (SELECT max(strptime(dt, '%Y%m%d')::DATE) AS d FROM raw)"""

# The shape of an address, restated for the other engine: four numbers up to
# 255 with no more than three digits each, and a first number in use.
IP_OK_SQL = """(regexp_full_match(trim(login_ip), '[0-9]{1,3}(\\.[0-9]{1,3}){3}')
  AND list_max(list_transform(string_split(trim(login_ip), '.'), lambda x: TRY_CAST(x AS INTEGER))) <= 255
  AND string_split(trim(login_ip), '.')[1] NOT IN ('0', '127')
  AND TRY_CAST(string_split(trim(login_ip), '.')[1] AS INTEGER) < 224
  AND trim(login_ip) NOT LIKE '169.254.%')"""
REQUIRED_SQL = " AND ".join(
    f"coalesce(trim({name}), '') <> ''" for name in ["player_id", "login_time", "logout_time", "online_duration"])
DURATION_OK_SQL = f"coalesce(TRY_CAST(online_duration AS INTEGER) BETWEEN 0 AND 21600, false)"
ORDER_OK_SQL = f"try_strptime(login_time, {TEXT_FORMAT}) < try_strptime(logout_time, {TEXT_FORMAT})"
RAW_LIST = ", ".join(schema.RAW_FIELDS)

TYPED_SQL = f"""
  SELECT player_id, lower(trim(account_type)) AS account_type, upper(trim(game_id)) AS game_id,
    try_strptime(login_time, {TEXT_FORMAT}) AS login_time,
    try_strptime(logout_time, {TEXT_FORMAT}) AS logout_time,
    TRY_CAST(online_duration AS BIGINT) AS online_duration,
    TRY_CAST(match_count AS INTEGER) AS match_count,
    TRY_CAST(recharge_amount AS DECIMAL(12,2)) AS recharge_amount,
    TRY_CAST(item_consumption AS BIGINT) AS item_consumption,
    trim(login_ip) AS login_ip, trim(login_period) AS login_period, trim(game_region) AS game_region,
    lower(trim(device_type)) AS device_type, login_time AS login_text"""

TYPED = RAW + f""",
typed AS ({TYPED_SQL} FROM raw),
tagged AS (SELECT *, {DERIVED_SQL} FROM typed),
facts AS (SELECT *, {LABEL_SQL} AS risk_label FROM tagged)"""

PASSED_SQL = f"{REQUIRED_SQL} AND {DURATION_OK_SQL} AND {ORDER_OK_SQL} AND {IP_OK_SQL}"


def cleaned(source: str) -> str:
    """CTEs from raw rows to facts of the rows that pass, ``source`` naming them."""
    return RAW + f""",
valid AS (SELECT {source} FROM raw WHERE {PASSED_SQL}),
typed AS ({TYPED_SQL} FROM valid),
tagged AS (SELECT *, {DERIVED_SQL} FROM typed),
beh AS (SELECT *, {LABEL_SQL} AS risk_label, login_date AS dt FROM tagged)"""


CLEAN = cleaned(f"DISTINCT {RAW_LIST}")
STREAM = cleaned(RAW_LIST)

DECIMALS = {"online_duration_min", "recharge_amount"}
FACT_LIST = ", ".join(
    [f"{money(name)} AS {name}" if name in DECIMALS else name for name in schema.FACT_COLUMNS] + ["dt"])
ON_DAY = "dt = (SELECT d FROM newest)"
MINOR = "is_minor = 1"
RISK = "risk_label > 0"


def since(days) -> str:
    return f"dt >= (SELECT d FROM newest) - {days - 1} AND dt <= (SELECT d FROM newest)"


RANGE = "dt IS NOT NULL"

ORACLES: dict[str, str] = {}


def on_fact(name: str, body: str, ctes: str = "") -> None:
    ORACLES[name] = f"WITH {BEH}{',' + ctes if ctes else ''}\n{body}"


def on_raw(name: str, body: str, ctes: str = "") -> None:
    ORACLES[name] = f"WITH {RAW}{',' + ctes if ctes else ''}\n{body}"


def on_typed(name: str, columns: str) -> None:
    ORACLES[name] = f"WITH {TYPED}\nSELECT login_text, {columns} FROM facts"


def per_label(prefix: str) -> str:
    return ", ".join(f"{cd(f'risk_label = {k}')} AS {prefix}{k}" for k in range(4))


# --- scans, sinks --------------------------------------------------------------

NULL_TEXT = ", ".join(f"nullif({name}, '') AS {name}" for name in schema.RAW_FIELDS)
DAY_KEY = "strftime((SELECT d FROM newest), '%Y%m%d')"
on_raw("ods_scan", f"SELECT {NULL_TEXT}, dt FROM raw WHERE dt = {DAY_KEY}")
on_raw("partition_discovery", "SELECT DISTINCT 'dt=' || dt AS partition FROM raw")
on_fact("dwd_scan_day", f"SELECT {FACT_LIST} FROM beh WHERE {ON_DAY}")
on_fact("dwd_scan_range", f"SELECT {FACT_LIST} FROM beh WHERE {since(10)}")
on_fact("dwd_scan_dates", f"SELECT {FACT_LIST} FROM beh, newest WHERE dt IN (d, d - 2, d - 5)")
on_fact("latest_dt", "SELECT d AS latest_dt FROM newest")
on_fact("catalog_scan", f"SELECT {FACT_LIST} FROM beh")
on_fact("orc_dir_scan", f"SELECT {FACT_LIST} FROM beh WHERE {ON_DAY}")
on_raw("tolerant_load", f"SELECT {NULL_TEXT}, dt FROM raw WHERE online_duration <> 'abc'")
on_raw("provenance", """SELECT nullif(player_id, '') AS player_id, login_time, 'dt=' || dt AS source_day,
  true AS is_stamped FROM raw""")
on_fact("write_dwd", f"SELECT {FACT_LIST} FROM beh")
STATS_LIST = f"""{cd()} AS dau, count(*) AS total_records, {cd('is_paying_player = 1')} AS paying_players,
  {cd()} AS total_players, {money('sum(recharge_amount)')} AS total_recharge, {cd(MINOR)} AS minor_players,
  {per_label('risk_label_')}, {rounded('avg(online_duration) / 60', 1)} AS avg_online_min, dt"""
on_fact("write_daily_stats", f"SELECT {STATS_LIST} FROM beh GROUP BY dt")


def spark_time(column):
    """Text of a time as Spark casts it: no trailing zeros in the fraction."""
    return f"rtrim(rtrim(strftime({column}, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"


EXPORT = ", ".join(
    f"{spark_time(name)} AS {name}" if name in ("login_time", "logout_time")
    else f"CAST({name} AS VARCHAR) AS {name}" for name in schema.FACT_COLUMNS)
on_fact("export_delimited", f"SELECT {EXPORT} FROM beh WHERE {ON_DAY}")
on_fact("publish_serving", f"SELECT {FACT_LIST} FROM beh WHERE {ON_DAY}")
on_fact("publish_serving_bulk", f"SELECT {FACT_LIST} FROM beh WHERE {since(3)}")
on_fact("replace_day", f"SELECT {FACT_LIST} FROM beh, newest WHERE dt < d OR {MINOR}")
on_raw("labelled_load", f"""SELECT {NULL_TEXT}, dt, 'newest' AS load_label FROM raw, newest
  WHERE dt = strftime(d, '%Y%m%d') AND online_duration <> 'abc'
  UNION ALL SELECT {NULL_TEXT}, dt, 'before' FROM raw, newest
  WHERE dt <> strftime(d, '%Y%m%d') AND online_duration <> 'abc'""")
on_fact("table_layout", f"SELECT {FACT_LIST} FROM beh")
on_raw("retention_raw", """SELECT dt, count(*) AS record_count FROM raw, newest
  WHERE strptime(dt, '%Y%m%d') >= d - 10 GROUP BY dt""")
OVERVIEW = f"""SELECT dt, count(*) AS total_rows, {cd()} AS players, {cd(MINOR)} AS minors,
  {cd(RISK)} AS at_risk FROM beh"""
on_fact("retention", f"{OVERVIEW} WHERE {since(11)} GROUP BY dt")
on_fact("add_column", f"""SELECT dt, player_id, login_time, CASE WHEN dt = d THEN risk_label END AS risk_label
  FROM beh, newest""")
on_fact("compact_output", f"SELECT {FACT_LIST} FROM beh")

# --- filters and cleaning ------------------------------------------------------

RAW_DT = f"{RAW_LIST}, dt"
on_raw("clean_required", f"SELECT {RAW_DT} FROM raw WHERE {REQUIRED_SQL}")
on_raw("clean_duration", f"SELECT {RAW_DT} FROM raw WHERE {DURATION_OK_SQL}")
on_raw("clean_time_order", f"SELECT {RAW_DT} FROM raw WHERE {ORDER_OK_SQL}")
on_raw("clean_ip", f"SELECT {RAW_DT} FROM raw WHERE {IP_OK_SQL}")
on_raw("clean_dedup", f"SELECT DISTINCT {RAW_DT} FROM raw")
on_raw("clean_all", f"SELECT DISTINCT {RAW_DT} FROM raw WHERE {PASSED_SQL}")
on_raw("clean_funnel", f"""SELECT n0 AS rows_before, n0 - n1 AS failed_required, n1 - n2 AS failed_duration,
  n2 - n3 AS failed_time_order, n3 - n4 AS failed_ip, n4 - n5 AS removed_copies, n1 AS after_required,
  n2 AS after_duration, n3 AS after_time_order, n4 AS after_ip, n5 AS rows_kept, n0 - n5 AS rows_removed,
  {pct('n0 - n5', 'n0', 2)} AS removed_pct
FROM (SELECT
  (SELECT count(*) FROM raw) AS n0,
  (SELECT count(*) FROM raw WHERE {REQUIRED_SQL}) AS n1,
  (SELECT count(*) FROM raw WHERE {REQUIRED_SQL} AND {DURATION_OK_SQL}) AS n2,
  (SELECT count(*) FROM raw WHERE {REQUIRED_SQL} AND {DURATION_OK_SQL} AND {ORDER_OK_SQL}) AS n3,
  (SELECT count(*) FROM raw WHERE {PASSED_SQL}) AS n4,
  (SELECT count(*) FROM (SELECT DISTINCT {RAW_LIST} FROM raw WHERE {PASSED_SQL})) AS n5)""")
on_raw("clean_sql_path", f"""SELECT {RAW_DT} FROM raw WHERE player_id <> '' AND login_time IS NOT NULL
  AND logout_time IS NOT NULL AND TRY_CAST(online_duration AS BIGINT) >= 0
  AND TRY_CAST(online_duration AS BIGINT) <= 21600 AND login_time < logout_time""")
on_fact("minor_risk_filter", f"""SELECT player_id, login_time, risk_label, risk_label IN (2, 3) AS is_curfew
  FROM beh WHERE {MINOR} AND {RISK}""")
on_fact("window_days", f"""SELECT player_id, login_time, dt, dt >= d - 1 AS in_last_two
  FROM beh, newest WHERE {since(7)}""")
on_fact("pk_lookup", f"SELECT {FACT_LIST} FROM beh WHERE player_id = '{LOOKUP_PLAYER}'")

# --- derived columns -----------------------------------------------------------

ORACLES["std_text"] = f"""WITH {TYPED}
SELECT account_type, game_id, device_type, login_ip, login_period, game_region FROM typed"""
on_typed("std_times", "login_time, logout_time")
on_typed("login_date", "login_date")
on_typed("login_hour", "login_hour")
on_typed("login_dayofweek", "login_dayofweek")
on_typed("std_numbers", f"online_duration, match_count, {money('recharge_amount')} AS recharge_amount, item_consumption")
on_typed("online_duration_min", f"online_duration, {money('online_duration_min')} AS online_duration_min")
on_typed("is_minor", "account_type, is_minor")
on_typed("is_night_login", "login_period, is_night_login")
on_typed("is_heavy_gamer", "online_duration, is_heavy_gamer")
on_typed("is_paying_player", f"{money('recharge_amount')} AS recharge_amount, is_paying_player")
on_typed("risk_label", "player_id, is_minor, online_duration, login_hour, risk_label")
ORACLES["event_dt"] = f"""WITH {TYPED}
SELECT player_id, login_time, login_date AS login_day, d AS batch_day FROM facts, newest"""
FOUR = case([("login_hour < 6", quoted(V.SMALL_HOURS)), ("login_hour < 12", quoted(V.MORNING)),
             ("login_hour < 18", quoted(V.AFTERNOON))], quoted(V.LATE))
on_fact("login_period", f"""SELECT player_id, login_time, login_hour, login_period AS period_of_three,
  {FOUR} AS period_of_four FROM beh""")
on_fact("risk_text", "SELECT player_id, login_time, risk_label, " + ", ".join(
    f"{wording(name)} AS {name}_text" for name in V.RISK_WORDING) + " FROM beh")


def yes_no(test):
    return case([(test, quoted(V.YES))], quoted(V.NO))


on_fact("yes_no", f"""SELECT player_id, login_time, {yes_no('is_paying_player = 1')} AS is_paying,
  {yes_no(MINOR)} AS is_minor FROM beh""")
DURATION_TEXT = (f"CAST(floor(online_duration_min / 60) AS INTEGER) || '{V.HOURS_UNIT}' || "
                 f"CAST(floor(online_duration_min % 60) AS INTEGER) || '{V.MINUTES_UNIT}'")
KEY_MIN = f"player_id, login_time, {money('online_duration_min')} AS online_duration_min"
on_fact("duration_text", f"SELECT {KEY_MIN}, {DURATION_TEXT} AS duration_text FROM beh")
RECORD_CLASS = up_to("online_duration", named([3600, 7200, 10800, 14400], V.RECORD_CLASSES), V.RECORD_CLASS_ELSE)
SIX = below("online_duration_min", named([30, 60, 120, 180, 240], V.DASHBOARD_CLASSES), V.DASHBOARD_CLASS_ELSE)
SEVEN = below("online_duration_min", named([30, 60, 120, 180, 240, 300], V.MINOR_CLASSES), V.MINOR_CLASS_ELSE)
HISTOGRAM = case([(f"online_duration_min <= {b}", str(b)) for b in HISTOGRAM_BOUNDS])
RECHARGE = case(
    [("recharge_amount = 0", quoted(V.RECHARGE_ZERO))]
    + [(f"recharge_amount <= {b}", quoted(n)) for b, n in named([30, 100, 300, 1000], V.RECHARGE_CLASSES)], quoted(V.RECHARGE_CLASS_ELSE))
on_fact("bucket_5", f"SELECT player_id, login_time, online_duration, {RECORD_CLASS} AS bucket FROM beh")
on_fact("bucket_6", f"SELECT {KEY_MIN}, {SIX} AS bucket FROM beh")
on_fact("bucket_7", f"SELECT {KEY_MIN}, {SEVEN} AS bucket FROM beh")
on_fact("bucket_hist", f"SELECT {KEY_MIN}, {HISTOGRAM} AS bucket FROM beh")
on_fact("recharge_bucket", f"""SELECT player_id, login_time, {money('recharge_amount')} AS recharge_amount,
  {RECHARGE} AS bucket FROM beh""")
NIGHT_TEXT = case([(NIGHT_SQL, quoted(V.NIGHT))], quoted(V.NOT_NIGHT))
on_fact("night_flag", f"SELECT player_id, login_time, login_hour, {NIGHT_TEXT} AS night_flag FROM beh")

ISLANDS = f"""
days AS (SELECT DISTINCT player_id, dt FROM beh WHERE {MINOR} AND risk_label = 3 AND {RANGE}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY dt) AS rn FROM days),
islands AS (
  SELECT player_id, count(*) AS consecutive_days, min(dt) AS streak_start, max(dt) AS streak_end
  FROM numbered GROUP BY player_id, dt - CAST(rn AS INTEGER))"""
TIER = case([(f"consecutive_days >= {b}", quoted(n)) for b, n in named([7, 5], V.TIERS)], quoted(V.TIER_ELSE))
ISLAND_LIST = "player_id, consecutive_days, streak_start, streak_end"
on_fact("intervention_tier", f"SELECT {ISLAND_LIST}, {TIER} AS tier FROM islands", ISLANDS)
BADGE = ("'Lv' || risk_label || ' ' || " + case(
    [(f"risk_label = {k}", quoted(V.RISK_BADGE[k])) for k in (3, 2)], quoted(V.RISK_BADGE[1])))
on_fact("display_fields", f"""SELECT player_id, login_time, strftime(login_time, '%H:%M') AS clock,
  lpad(CAST(login_hour AS VARCHAR), 2, '0') || ':00' AS hour_label, {BADGE} AS badge,
  '{V.CURRENCY}' || CAST(round(recharge_amount, 0) AS DECIMAL(20,0)) AS amount FROM beh""")
on_raw("is_valid_ip", f"SELECT login_ip, {IP_OK_SQL} AS is_valid FROM raw")
on_fact("compute_risk_label", "SELECT player_id, login_time, risk_label FROM beh")

# --- joins ---------------------------------------------------------------------

on_fact("streak_join", f"""SELECT {', '.join('s.' + c.strip() for c in ISLAND_LIST.split(','))}, b.dt, b.login_time,
  b.game_id, {money('b.online_duration_min')} AS online_duration_min,
  {money('b.recharge_amount')} AS recharge_amount
FROM islands s JOIN beh b ON s.player_id = b.player_id AND b.dt BETWEEN s.streak_start AND s.streak_end
  AND b.is_minor = 1 AND b.risk_label = 3
WHERE s.consecutive_days >= 3""", ISLANDS)
ORACLES["streak_join_bucketed"] = ORACLES["streak_join"]
ADULTS, MINORS = cd("account_type = 'adult'"), cd("account_type = 'minor'")
on_fact("hour_fill", f"""SELECT CAST(h AS INTEGER) AS hour_of_day, {cd("account_type = 'adult'")} AS adult_active,
  {cd("account_type = 'minor'")} AS minor_active, {cd()} AS total_active
FROM range(24) AS hours(h) LEFT JOIN (SELECT * FROM beh WHERE {ON_DAY} AND {RISK}) ON login_hour = h GROUP BY h""")
GRID = f"""
paid AS (
  SELECT CASE WHEN account_type = 'adult' THEN 'adult' ELSE 'minor' END AS account, {RECHARGE} AS recharge_range,
    {cd()} AS n, sum(recharge_amount) AS amount FROM beh WHERE {ON_DAY} GROUP BY ALL),
grid AS (
  SELECT account, place, recharge_range, coalesce(n, 0) AS player_count, {money('coalesce(amount, 0)')} AS total_amount
  FROM (SELECT unnest(['adult', 'minor']) AS account),
    (SELECT CAST(unnest(range(6)) AS INTEGER) AS place,
      unnest([{', '.join(map(quoted, V.RECHARGE_ORDER))}]) AS recharge_range)
    LEFT JOIN paid USING (account, recharge_range))"""
GRID = GRID.replace("""  FROM (SELECT unnest(['adult', 'minor']) AS account),
    (SELECT""", """  FROM (SELECT * FROM (SELECT unnest(['adult', 'minor']) AS account), (SELECT""").replace(
    "AS recharge_range)\n    LEFT", "AS recharge_range))\n    LEFT")
on_fact("payment_grid", "SELECT * FROM grid", GRID)
on_fact("missing_dates", """SELECT CAST(unnest(generate_series(d + 1, d + 4, INTERVAL 1 DAY)) AS DATE) AS dt
  FROM newest""")
on_fact("missing_dates_interior", """SELECT dt FROM (
  SELECT CAST(unnest(generate_series(min(dt), (SELECT d + 1 FROM newest), INTERVAL 1 DAY)) AS DATE) AS dt
  FROM beh WHERE day(dt) % 5 <> 0) WHERE dt NOT IN (SELECT dt FROM beh WHERE day(dt) % 5 <> 0)""")
ONLINE_MIN = f"{money('round(online_duration_min, 0)')} AS online_min"
AMOUNT = f"{money('recharge_amount')} AS recharge_amount"


def session_list(vocabulary):
    return f"""dt, player_id, login_time, logout_time, {ONLINE_MIN}, login_hour, device_type, game_region, game_id,
  {AMOUNT}, {wording(vocabulary)} AS risk_desc"""


RANKING = f"""
ranked AS (
  SELECT player_id, {cd(column='dt')} AS active_days, {rounded('sum(online_duration_min) / 60', 1)} AS total_hours,
    {avg('online_duration_min', 0)} AS avg_daily_min, {money('sum(recharge_amount)')} AS total_recharge,
    max(risk_label) AS max_risk_level, {cd(column='game_id')} AS game_count
  FROM beh WHERE {MINOR} AND {RISK} AND {since(7)} GROUP BY player_id),
top10 AS (SELECT *, row_number() OVER (ORDER BY max_risk_level DESC, total_hours DESC, player_id) AS place
  FROM ranked QUALIFY place <= 10)"""
on_fact("drilldown", f"""SELECT {session_list('player')} FROM beh
  WHERE {since(7)} AND player_id IN (SELECT player_id FROM top10)""", RANKING)
ORACLES["layer_reconcile"] = f"""WITH {CLEAN},
a AS (SELECT CAST(strptime(dt, '%Y%m%d') AS DATE) AS dt, count(*) AS n FROM raw GROUP BY ALL),
b AS (SELECT dt, count(*) AS n FROM beh GROUP BY dt)
SELECT dt, coalesce(a.n, 0) AS rows_a, coalesce(b.n, 0) AS rows_b, coalesce(b.n, 0) - coalesce(a.n, 0) AS row_diff
FROM a FULL JOIN b USING (dt)"""

# --- aggregates ----------------------------------------------------------------

TOTAL = f"{money('sum(recharge_amount)')} AS total_recharge"
KPI = f"""SELECT {cd()} AS total_active, {cd(MINOR)} AS minor_active, {cd(RISK)} AS at_risk_count,
  {cd('risk_label = 3')} AS severe_count, {TOTAL}, {avg('online_duration_min', 0)} AS avg_online_min
FROM beh WHERE {ON_DAY}"""
on_fact("kpi_today", KPI)
DIST = f"""
dist AS (SELECT {SIX} AS duration_range, {cd()} AS player_count, count(*) AS record_count,
  min(online_duration_min) AS shortest FROM beh WHERE {ON_DAY} GROUP BY ALL),
shares AS (SELECT *, {pct('player_count', 'sum(player_count) OVER ()', 1)} AS pct FROM dist)"""
on_fact("duration_dist", "SELECT duration_range, player_count, record_count, pct FROM shares", DIST)
TREND = f"""SELECT dt AS stat_date, {cd()} AS dau, {cd('risk_label = 1')} AS level1_count,
  {cd('risk_label = 2')} AS level2_count, {cd('risk_label = 3')} AS level3_count,
  {pct(cd(RISK), cd(), 1)} AS risk_rate_pct,
  {pct(cd(f'{RISK} AND {MINOR}'), cd(MINOR), 1)} AS minor_risk_rate_pct
FROM beh WHERE {since(7)} GROUP BY dt"""
on_fact("risk_trend", TREND)
on_fact("payment_analysis", f"""SELECT account_type, {RECHARGE} AS recharge_range, {cd()} AS player_count,
  {money('sum(recharge_amount)')} AS total_amount, {avg('recharge_amount', 2)} AS avg_amount
FROM beh WHERE {ON_DAY} GROUP BY ALL""")
on_fact("period_stats", f"""SELECT login_hour AS hour_of_day, {ADULTS} AS adult_active, {MINORS} AS minor_active,
  {cd()} AS total_active, {NIGHT_TEXT} AS night_flag FROM beh WHERE {ON_DAY} GROUP BY login_hour""")
on_fact("risk_ranking", "SELECT * EXCLUDE (place) FROM top10", RANKING)
on_fact("risk_ranking_by_hours", "SELECT * FROM ranked ORDER BY total_hours DESC, player_id LIMIT 10", RANKING)
on_fact("daily_stats", f"SELECT {STATS_LIST} FROM beh WHERE {ON_DAY} GROUP BY dt")
on_fact("duration_records", f"""SELECT duration_range, n AS record_count, {pct('n', 'sum(n) OVER ()', 1)} AS pct
FROM (SELECT {RECORD_CLASS} AS duration_range, count(*) AS n FROM beh WHERE {ON_DAY} GROUP BY ALL)""")
PAYING = cd("is_paying_player = 1")
on_fact("paying_stats", f"""SELECT {PAYING} AS paying_players, {cd()} AS total_players,
  {pct(PAYING, cd(), 1)} AS paying_rate_pct, {TOTAL},
  {rounded(f'sum(recharge_amount) / nullif({PAYING}, 0)', 2)} AS arppu FROM beh WHERE {ON_DAY}""")
on_fact("label_players", f"""SELECT risk_label, {wording('job')} AS risk_text, {cd()} AS player_count,
  (SELECT {cd()} FROM beh WHERE {ON_DAY}) AS total_players,
  {pct(cd(), f'(SELECT {cd()} FROM beh WHERE {ON_DAY})', 1)} AS pct
FROM beh WHERE {ON_DAY} GROUP BY risk_label""")
on_fact("label_records", f"""SELECT risk_label, {wording('job')} AS risk_text, n AS record_count,
  {pct('n', 'sum(n) OVER ()', 1)} AS pct
FROM (SELECT risk_label, count(*) AS n FROM beh WHERE {ON_DAY} GROUP BY risk_label)""")
on_fact("minor_records_at_risk", f"""SELECT count(*) AS minor_records, {cnt(RISK)} AS risk_records,
  {pct(cnt(RISK), 'count(*)', 1)} AS risk_pct FROM beh WHERE {ON_DAY} AND {MINOR}""")
on_fact("minor_profile", f"""SELECT risk_label, {wording('job')} AS risk_text, {cd()} AS player_count,
  (SELECT {cd()} FROM minors) AS minor_players,
  (SELECT {rounded('avg(online_duration) / 60', 1)} FROM minors) AS avg_online_min,
  {pct(cd(), f'(SELECT {cd()} FROM minors)', 1)} AS pct FROM minors GROUP BY risk_label""",
        f"\nminors AS (SELECT * FROM beh WHERE {ON_DAY} AND {MINOR})")
on_fact("daily_risk", f"""SELECT dt, {cd()} AS active_players, {per_label('label_')}, {cd(RISK)} AS at_risk_players,
  {pct(cd(RISK), cd(), 2)} AS at_risk_pct, {pct(cd('risk_label = 3'), cd(), 2)} AS severe_pct
FROM beh WHERE {RANGE} GROUP BY dt""")
on_fact("daily_minor_risk", f"""SELECT dt, {cd()} AS active_minors, {per_label('label_')},
  {avg('online_duration_min', 0)} AS avg_online_min,
  {money('round(max(online_duration_min), 0)')} AS max_online_min,
  {pct(PAYING, cd(), 2)} AS paying_pct, {TOTAL} FROM beh WHERE {MINOR} AND {RANGE} GROUP BY dt""")
SEVEN_DIST = f"""
grouped AS (SELECT {SEVEN} AS duration_range, {cd()} AS player_count, count(*) AS record_count, {per_label('label_')}
  FROM beh WHERE {MINOR} AND {ON_DAY} GROUP BY 1),
minor_dist AS (SELECT *, {pct('player_count', 'sum(player_count) OVER ()', 2)} AS pct FROM grouped)"""
on_fact("minor_duration_dist", "SELECT * FROM minor_dist", SEVEN_DIST)
BREACH = f"{MINOR} AND risk_label IN (2, 3) AND {RANGE}"
NIGHT_TOTALS = f"""
breaches AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY online_duration_min DESC, device_type) AS rn
  FROM beh WHERE {BREACH}),
night AS (
  SELECT player_id, {cd(column='dt')} AS violation_days, count(*) AS night_logins,
    {avg('online_duration_min', 0)} AS avg_online_min, {rounded('sum(online_duration_min) / 60', 1)} AS total_hours,
    {TOTAL}, {cd('risk_label = 3', 'dt')} AS severe_days, {cd(column='game_id')} AS game_count,
    max(dt) AS latest_violation, max(device_type) FILTER (WHERE rn = 1) AS usual_device
  FROM breaches GROUP BY player_id)"""
NIGHT_PLACE = "row_number() OVER (ORDER BY night_logins DESC, total_hours DESC, player_id)"
on_fact("night_topn", f"SELECT * FROM night QUALIFY {NIGHT_PLACE} <= 100", NIGHT_TOTALS)
SEVERITY = "risk_label DESC, online_duration_min DESC, player_id, login_time, game_id"
on_fact("night_export", f"""SELECT dt, player_id, game_id, login_time, logout_time,
  {money('b.online_duration_min')} AS online_duration_min, {DURATION_TEXT} AS duration_text, login_ip, device_type,
  game_region, match_count, {money('b.recharge_amount')} AS recharge_amount, {wording('night_export')} AS risk_type,
  {yes_no('risk_label = 3')} AS is_severe, {yes_no('is_paying_player = 1')} AS is_paying
FROM (SELECT * FROM beh WHERE {BREACH} ORDER BY {SEVERITY} LIMIT 500) b""")
on_fact("cross_analysis", f"""SELECT account_type, login_period, {wording('cross')} AS risk_level, device_type,
  {cd()} AS player_count, count(*) AS record_count, {avg('online_duration_min', 0)} AS avg_online_min,
  {avg('match_count', 1)} AS avg_match_count, {avg('recharge_amount', 2)} AS avg_recharge, {TOTAL},
  {pct('sum(is_paying_player)', 'count(*)', 2)} AS paying_pct
FROM beh WHERE {ON_DAY} GROUP BY account_type, login_period, risk_label, device_type""")
on_fact("today_snapshot", f"""SELECT {cd()} AS total_active, {cd(MINOR)} AS minor_active, {cd(RISK)} AS at_risk_count,
  {cd('risk_label = 3')} AS severe_count, {pct(cd('risk_label = 3'), cd(MINOR), 2)} AS minor_severe_pct,
  {avg('online_duration_min', 0)} AS avg_online_min, {TOTAL},
  {cd("login_time >= CAST((SELECT d FROM newest) AS TIMESTAMP) + INTERVAL '23:29:59'")} AS active_last_30m,
  {cd('risk_label = 1')} AS overtime_count, {cd('risk_label = 2')} AS curfew_count FROM beh WHERE {ON_DAY}""")
STREAKS = ISLANDS + f""",
streaks AS (
  SELECT s.player_id, s.consecutive_days, s.streak_start, s.streak_end,
    {avg('b.online_duration_min', 0)} AS avg_online_min, {money('sum(b.recharge_amount)')} AS total_recharge,
    {cd(column='b.game_id')} AS game_count, {TIER.replace('consecutive_days', 's.consecutive_days')} AS tier
  FROM islands s JOIN beh b ON s.player_id = b.player_id AND b.dt BETWEEN s.streak_start AND s.streak_end
    AND b.is_minor = 1 AND b.risk_label = 3
  WHERE s.consecutive_days >= 3 GROUP BY s.player_id, s.consecutive_days, s.streak_start, s.streak_end)"""
STREAK_PLACE = "row_number() OVER (ORDER BY consecutive_days DESC, total_recharge DESC, player_id, streak_start)"
on_fact("severe_streaks", f"SELECT * FROM streaks QUALIFY {STREAK_PLACE} <= 200", STREAKS)
on_raw("ods_check", f"""SELECT dt, count(*) AS record_count, {cd()} AS unique_players,
  {cd(column='game_id')} AS unique_games FROM raw WHERE dt = {DAY_KEY} GROUP BY dt""")
on_fact("dwd_quality_pct", f"""SELECT dt, count(*) AS record_count, {pct('sum(is_minor)', 'count(*)', 1)} AS minor_pct,
  {pct('sum(is_night_login)', 'count(*)', 1)} AS night_pct,
  {pct(cnt(f'{MINOR} AND is_night_login = 1'), 'sum(is_minor)', 1)} AS minor_night_pct,
  {pct('sum(is_heavy_gamer)', 'count(*)', 1)} AS heavy_pct, {avg('online_duration_min', 1)} AS avg_online_min,
  {pct('sum(is_paying_player)', 'count(*)', 1)} AS paying_pct, {TOTAL} FROM beh WHERE {ON_DAY} GROUP BY dt""")
on_fact("slice_overview", f"""SELECT dt, account_type, login_period, count(*) AS cnt,
  {avg('online_duration_min', 1)} AS avg_online_min, {avg('recharge_amount', 2)} AS avg_recharge,
  {avg('match_count', 1)} AS avg_matches FROM beh WHERE {ON_DAY} GROUP BY dt, account_type, login_period""")
on_fact("sync_check", f"""SELECT count(*) AS synced_rows, {cd()} AS synced_players,
  CAST(sum(is_minor) AS BIGINT) AS minor_count, {cnt(RISK)} AS at_risk_count, {DAY_KEY} AS sync_date
FROM beh WHERE {ON_DAY}""")
on_fact("risk_summary", f"""SELECT risk_label, {wording('summary')} AS risk_desc, count(*) AS record_count,
  {cd()} AS player_count, {avg('online_duration_min', 0)} AS avg_online_min, {TOTAL}
FROM beh WHERE {ON_DAY} GROUP BY risk_label""")
on_fact("daily_overview", f"{OVERVIEW} GROUP BY dt")
on_fact("label_distribution", f"""SELECT risk_label, {wording('distribution')} AS label, count(*) AS cnt
FROM beh GROUP BY risk_label""")
on_fact("recent_volume", f"""SELECT dt, count(*) AS row_count, {cd()} AS players FROM beh, newest
WHERE dt >= d - 7 GROUP BY dt""")
on_fact("daily_report", f"""SELECT count(*) AS record_count, {cd()} AS active_players, {cd(MINOR)} AS minor_players,
  {cd(RISK)} AS at_risk_players, {cd('risk_label = 3')} AS severe_players, {TOTAL},
  {avg('online_duration_min', 0)} AS avg_online_min FROM beh WHERE {ON_DAY}""")
HIST_COUNTS = ", ".join(
    cnt(f"online_duration_min <= {b}" + (f" AND online_duration_min > {a}" if a else "")) + f" AS upto_{b}_min"
    for a, b in zip([None, *HISTOGRAM_BOUNDS], HISTOGRAM_BOUNDS))
on_fact("load_summary", f"""SELECT count(*) AS total_records, {cnt("account_type = 'minor'")} AS minor_records,
  {cnt("account_type <> 'minor'")} AS adult_records,
  {', '.join(f"{cnt(f'risk_label = {k}')} AS risk_{k}" for k in range(4))}, {HIST_COUNTS},
  {cnt('recharge_amount > 0')} AS paying_records,
  {money('sum(recharge_amount) FILTER (WHERE recharge_amount > 0)')} AS total_recharge,
  {pct(cnt("account_type = 'minor'"), 'count(*)', 1)} AS minor_pct,
  {pct(cnt("account_type <> 'minor'"), 'count(*)', 1)} AS adult_pct,
  {pct(cnt('recharge_amount > 0'), 'count(*)', 1)} AS paying_pct FROM beh WHERE {ON_DAY}""")
RAW_MINOR, RAW_NIGHT = "lower(trim(account_type)) = 'minor'", f"login_period = '{V.NIGHT}'"
on_raw("raw_log_summary", f"""SELECT count(*) AS total_rows, {cnt(f'NOT {RAW_MINOR}')} AS adult_rows,
  {cnt(RAW_MINOR)} AS minor_rows, {cnt(RAW_NIGHT)} AS night_rows,
  {cnt(f'{RAW_MINOR} AND {RAW_NIGHT}')} AS minor_night_rows,
  {pct(cnt(f'NOT {RAW_MINOR}'), 'count(*)', 1)} AS adult_pct, {pct(cnt(RAW_MINOR), 'count(*)', 1)} AS minor_pct,
  {pct(cnt(RAW_NIGHT), 'count(*)', 1)} AS night_pct,
  {pct(cnt(f'{RAW_MINOR} AND {RAW_NIGHT}'), cnt(RAW_MINOR), 1)} AS minor_night_pct FROM raw""")
on_fact("short_long_split", f"""SELECT CASE WHEN online_duration_min < 60 THEN 'short' ELSE 'long' END AS split,
  count(*) AS record_count FROM beh WHERE {ON_DAY} GROUP BY ALL""")
on_fact("player_roster", """SELECT player_id, min(dt) AS first_seen, max(dt) AS last_active FROM beh
WHERE player_id IS NOT NULL GROUP BY player_id HAVING max(dt) >= (SELECT d FROM newest) - 14""")
VIOLATION_LIST = f"""dt AS stat_date, player_id, game_id, login_time, logout_time, {ONLINE_MIN}, login_ip, device_type,
  game_region, {wording('violation')} AS risk_type, {AMOUNT}, match_count"""
VIOLATIONS = f"""
worst AS (SELECT *, CAST(row_number() OVER (ORDER BY {SEVERITY}) AS INTEGER) AS rank_index
  FROM beh WHERE {RISK} AND {since(2)} QUALIFY rank_index <= 100)"""
on_fact("violation_detail", f"SELECT {VIOLATION_LIST} FROM worst", VIOLATIONS)
MINOR_NIGHT = f"FROM beh WHERE {MINOR} AND risk_label IN (2, 3) AND {since(7)}"
on_fact("minor_night_detail", f"SELECT {session_list('minor_night')} {MINOR_NIGHT}")
on_fact("player_detail", f"""SELECT {session_list('player')} FROM beh
WHERE player_id = '{LOOKUP_PLAYER}' AND {since(7)}""")

# --- windows, orders, shapes ---------------------------------------------------

on_fact("share_of_total", f"""SELECT device_type, n AS record_count, {pct('n', 'sum(n) OVER ()', 1)} AS pct
FROM (SELECT device_type, count(*) AS n FROM beh WHERE {ON_DAY} GROUP BY device_type)""")
on_fact("longest_session", f"""SELECT {FACT_LIST} FROM (SELECT * FROM beh QUALIFY row_number() OVER
  (PARTITION BY player_id ORDER BY online_duration_min DESC, login_time, game_id) = 1)""")
on_fact("streak_islands", f"SELECT {ISLAND_LIST} FROM islands", ISLANDS)


def place(order):
    return f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank_index"


on_fact("rank_index", f"""SELECT CAST(place AS INTEGER) AS rank_index, player_id, active_days, total_hours,
  avg_daily_min, '{V.CURRENCY}' || CAST(round(CAST(total_recharge AS DECIMAL(18,2)), 0) AS DECIMAL(20,0))
    AS recharge_text, {BADGE.replace('risk_label', 'max_risk_level')} AS risk_badge FROM top10""", RANKING)
on_fact("top10", "SELECT * EXCLUDE (place), CAST(place AS INTEGER) AS rank_index FROM top10", RANKING)
on_fact("top100_violations", f"SELECT rank_index, {VIOLATION_LIST} FROM worst", VIOLATIONS)
on_fact("top100_night", f"""SELECT *, CAST({NIGHT_PLACE} AS INTEGER) AS rank_index FROM night
QUALIFY rank_index <= 100""", NIGHT_TOTALS)
on_fact("top200_streaks", f"""SELECT *, CAST({STREAK_PLACE} AS INTEGER) AS rank_index FROM streaks
QUALIFY rank_index <= 200""", STREAKS)
on_fact("top500_export", f"""SELECT player_id, login_time, rank_index, risk_label,
  {money('b.online_duration_min')} AS online_duration_min
FROM (SELECT *, {place(SEVERITY)} FROM beh WHERE {BREACH} QUALIFY rank_index <= 500) b""")
on_fact("order_by_bucket_min", f"""SELECT duration_range, player_count, record_count, {money('s.shortest')} AS shortest,
  pct, {place('s.shortest')} FROM shares s""", DIST)
on_fact("custom_order", f"""SELECT login_period, count(*) AS record_count, {place(
    f"CASE login_period WHEN '{V.DAYTIME}' THEN 1 WHEN '{V.EVENING}' THEN 2 WHEN '{V.NIGHT}' THEN 3 ELSE 0 END")}
FROM beh WHERE {ON_DAY} GROUP BY login_period""")
on_fact("order_by_ordinal", f"SELECT *, {place('duration_range')} FROM minor_dist", SEVEN_DIST)


def series(value, order):
    return f"CAST(to_json(list({value} ORDER BY {order})) AS VARCHAR)"


on_fact("kpi_payload", f"""SELECT d AS dt, total_active AS "totalActive", minor_active AS "minorActive",
  at_risk_count AS "atRiskCount", severe_count AS "severeCount", total_recharge AS "totalRecharge",
  avg_online_min AS "avgOnlineMin" FROM kpi, newest""", f"\nkpi AS ({KPI})")
on_fact("duration_payload", f"""SELECT {series('duration_range', 'shortest')} AS names,
  {series('player_count', 'shortest')} AS "values", {series('pct', 'shortest')} AS pcts FROM shares""", DIST)
on_fact("trend_payload", f"""SELECT {series('CAST(stat_date AS VARCHAR)', 'stat_date')} AS categories,
  {series('dau', 'stat_date')} AS dau, {series('level1_count', 'stat_date')} AS level1,
  {series('level2_count', 'stat_date')} AS level2, {series('level3_count', 'stat_date')} AS level3,
  {series('risk_rate_pct', 'stat_date')} AS "riskRate",
  {series('minor_risk_rate_pct', 'stat_date')} AS "minorRiskRate" FROM trend""", f"\ntrend AS ({TREND})")


def of_account(value, account):
    return (f"CAST(to_json(list({value} ORDER BY place) FILTER (WHERE account = '{account}')) AS VARCHAR)")


on_fact("payment_payload", f"""SELECT {of_account('recharge_range', 'adult')} AS categories,
  {of_account('player_count', 'adult')} AS "adultCount", {of_account('total_amount', 'adult')} AS "adultAmount",
  {of_account('player_count', 'minor')} AS "minorCount", {of_account('total_amount', 'minor')} AS "minorAmount"
FROM grid""", GRID)
on_fact("period_payload", f"""SELECT {series('h', 'h')} AS hours, {series('adults', 'h')} AS "adultActive",
  {series('minors', 'h')} AS "minorActive"
FROM (SELECT h, {ADULTS} AS adults, {MINORS} AS minors
  FROM range(24) AS hours(h) LEFT JOIN (SELECT * FROM beh WHERE {ON_DAY}) ON login_hour = h GROUP BY h)""")
on_fact("rows_total", """SELECT CAST(to_json(list({'player_id': player_id, 'active_days': active_days,
  'max_risk_level': max_risk_level, 'game_count': game_count} ORDER BY place)) AS VARCHAR) AS data,
  count(*) AS total FROM top10""", RANKING)
on_fact("rows_with_total", f"""SELECT {session_list('minor_night')}, (SELECT count(*) {MINOR_NIGHT}) AS total
{MINOR_NIGHT}""")
on_fact("flow_edges", f"""SELECT CASE account WHEN 'adult' THEN '{V.ADULT_NODE}' ELSE '{V.MINOR_NODE}' END AS source,
  recharge_range AS target, player_count AS value FROM grid WHERE player_count > 0""", GRID)

# --- quality -------------------------------------------------------------------

# check name, group, status above zero, count
DAY_CHECKS = [
    ("partition_nonempty", "partition_nonempty", "FAIL", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
    ("player_null", "player_null", "FAIL", cnt("coalesce(player_id, '') = ''")),
    ("label_domain", "label_domain", "FAIL", cnt("risk_label NOT IN (0, 1, 2, 3)")),
    ("account_domain", "account_domain", "FAIL", cnt("account_type NOT IN ('minor', 'adult')")),
    ("duration_negative", "duration_negative", "FAIL", cnt("online_duration < 0")),
    ("recharge_negative", "recharge_negative", "FAIL", cnt("recharge_amount < 0")),
    ("duration_zero", "duration_zero", "INFO", cnt("online_duration = 0")),
    ("duration_not_positive", "duration_not_positive", "WARN", cnt("online_duration <= 0")),
    ("duration_max", "duration_max", "INFO", cnt("online_duration = 21600")),
    ("hour_edge_0", "hour_edges", "INFO", cnt("login_hour = 0")),
    ("hour_edge_23", "hour_edges", "INFO", cnt("login_hour = 23")),
    ("small_recharge", "small_recharge", "INFO", cnt("recharge_amount > 0 AND recharge_amount <= 1")),
    ("over_limit", "over_limit", "FAIL", cnt("online_duration > 21600")),
    ("minor_consistent", "minor_consistent", "FAIL", cnt("(account_type = 'minor') <> (is_minor = 1)")),
    ("night_consistent", "night_consistent", "FAIL", cnt(f"{MINOR} AND risk_label = 2 AND NOT {NIGHT_SQL}")),
    ("reserved_ip", "reserved_ip", "FAIL",
     cnt("login_ip LIKE '0.%' OR login_ip LIKE '127.%' OR login_ip LIKE '169.254.%'")),
    ("rows_vs_players", "rows_vs_players", "FAIL", f"CASE WHEN count(*) <= {cd()} THEN 1 ELSE 0 END"),
    ("label_sum", "label_sum", "FAIL", f"count(*) - {cnt('risk_label IN (0, 1, 2, 3)')}"),
    ("recharge_total", "recharge_total", "FAIL", "CASE WHEN sum(recharge_amount) < 0 THEN 1 ELSE 0 END"),
    ("device_domain", "device_domain", "FAIL", "CASE WHEN " + cnt("device_type = 'android'") + " = 0 THEN 1 ELSE 0 END"),
    ("null_risk_label", "nulls", "WARN", cnt("risk_label IS NULL")),
    ("null_is_minor", "nulls", "WARN", cnt("is_minor IS NULL")),
    ("null_online_duration_min", "nulls", "WARN", cnt("online_duration_min IS NULL")),
    ("recharge_huge", "recharge_huge", "WARN", cnt("recharge_amount > 50000")),
    ("cardinality_players", "cardinalities", "INFO", cd()),
    ("cardinality_at_risk", "cardinalities", "INFO", cd(RISK)),
    ("cardinality_minors", "cardinalities", "INFO", cd(MINOR)),
]


def check_sql(name, status, count, source):
    worded = "'INFO'" if status == "INFO" else f"CASE WHEN n > 0 THEN '{status}' ELSE 'PASS' END"
    return f"""SELECT '{name}' AS check_name, n AS failing_rows, {worded} AS status
FROM (SELECT CAST({count} AS BIGINT) AS n FROM {source})"""


_checks: dict[str, list[str]] = {}
for _name, _group, _status, _count in DAY_CHECKS:
    _checks.setdefault(_group, []).append(check_sql(_name, _status, _count, f"beh WHERE {ON_DAY}"))
_checks["future_dt"] = [check_sql("future_dt", "FAIL", cnt("dt > d"), "beh, newest")]
_checks["min_volume"] = [check_sql("min_volume", "FAIL", "CASE WHEN count(*) <= 1000 THEN 1 ELSE 0 END", "beh")]
_checks["duplicates"] = [check_sql(
    "duplicates", "FAIL", "count(*)",
    f"(SELECT player_id, login_time FROM beh WHERE {ON_DAY} GROUP BY ALL HAVING count(*) > 1)")]
for _group, _parts in _checks.items():
    on_fact(f"dq_{_group}", "\nUNION ALL ".join(_parts))
on_fact("dq_future_dt", check_sql("future_dt", "FAIL", cnt("dt > d - 1"), "beh, newest"))
on_fact("dq_report", "\nUNION ALL ".join(part for parts in _checks.values() for part in parts))

# --- streaming and the daily job -----------------------------------------------

on_raw("stream_source", f"SELECT {NULL_TEXT} FROM raw")
on_raw("stream_split_line", f"SELECT {NULL_TEXT} FROM raw")
on_raw("stream_dated_files", f"SELECT {NULL_TEXT} FROM raw")
on_raw("stream_packed_files", f"SELECT {NULL_TEXT} FROM raw")
on_raw("stream_enrich", """SELECT nullif(player_id, '') AS player_id, login_time, 'collector-1' AS host,
  true AS is_stamped FROM raw""")
on_raw("stream_fanout", """SELECT sink, nullif(player_id, '') AS player_id, login_time, login_ip
FROM raw, (SELECT unnest(['files', 'batches']) AS sink)""")
on_raw("stream_arrival_check", f"""SELECT count(*) AS arrived_rows, {cnt(f"player_id = '{LOOKUP_PLAYER}'")}
  AS marked_rows, {cnt(f"player_id = '{LOOKUP_PLAYER}'")} > 0 AS marker_arrived FROM raw""")
on_raw("stream_rows_read", "SELECT count(*) AS input_rows FROM raw")
on_raw("stream_microbatch_load", "SELECT count(*) AS loaded_rows FROM raw")
on_raw("stream_dedup", f"SELECT DISTINCT {NULL_TEXT} FROM raw")
ORACLES["stream_label"] = f"WITH {STREAM}\nSELECT {FACT_LIST} FROM beh WHERE risk_label = 3"
ORACLES["stream_active_30m"] = f"""WITH {STREAM},
placed AS (
  SELECT player_id, time_bucket(INTERVAL 5 MINUTE, login_time) - to_minutes(CAST(5 * k AS INTEGER)) AS window_start
  FROM beh, range(6) AS offsets(k))
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, {cd()} AS active_players, count(*) AS row_count
FROM placed
GROUP BY window_start"""
ORACLES["stream_daily_risk"] = f"""WITH {STREAM}
SELECT dt, {cd()} AS active_players, {cd(RISK)} AS at_risk_players, {per_label('label_')} FROM beh GROUP BY dt"""
ORACLES["daily_job_facts"] = f"WITH {CLEAN}\nSELECT {FACT_LIST} FROM beh"
ORACLES["daily_job_stats"] = f"WITH {CLEAN}\nSELECT {STATS_LIST} FROM beh GROUP BY dt"
ORACLES["daily_cycle_sync"] = f"""WITH {CLEAN}
SELECT dt, count(*) AS rows_a, count(*) AS rows_b, CAST(0 AS BIGINT) AS row_diff FROM beh
GROUP BY dt"""
ORACLES["daily_cycle_gap"] = f"WITH {CLEAN}\nSELECT dt, count(*) AS record_count FROM beh GROUP BY dt"
on_fact("roster_after_day", """SELECT player_id, min(dt) AS first_seen, max(dt) AS last_active
FROM (SELECT * FROM beh, newest WHERE dt = d OR player_id IN
  (SELECT player_id FROM beh, newest WHERE dt < d GROUP BY player_id, d HAVING max(dt) >= d - 15))
WHERE player_id IS NOT NULL GROUP BY player_id HAVING max(dt) >= (SELECT d FROM newest) - 14""")
ORACLES["daily_job_tables"] = f"WITH {CLEAN}\nSELECT {STATS_LIST} FROM beh WHERE {ON_DAY} GROUP BY dt"
