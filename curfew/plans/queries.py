"""Registered queries: one per operator, over the tables of a folder."""

from collections.abc import Callable
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curfew import schema
from curfew.functions import classes, rules, sql_functions
from curfew.functions import fixed_values as V
from curfew.functions.conditions import AT_RISK, MINOR, PAYING
from curfew.operators import analysis, cleaning, daily, dashboard, quality, reshape, standardize
from curfew.plans import daily_cycle, daily_job
from curfew.session import shared_folder, stream_session
from curfew.sinks import ledger, packing, tables
from curfew.sources import raw as raw_source
from curfew.sources import sessions, warehouse
from curfew.streaming import operators as stream_operators
from curfew.streaming import sinks as stream_sinks
from curfew.streaming import sources as stream_sources

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP_PLAYER = "P00000007"
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.facts(sessions.read_events(spark, folder))


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.raw_rows(sessions.read_events(spark, folder))


def report_day(spark: SparkSession, folder: str) -> date:
    return sessions.newest_day(sessions.read_events(spark, folder))


def plain(df: DataFrame) -> DataFrame:
    """Types every client reads alike: doubles for decimals, JSON for nested values."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType)):
            column = column.cast("int")
        elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
            column = F.to_json(_plain_elements(column, field.dataType))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _plain_elements(column, kind):
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.DecimalType):
        return column.cast("array<double>")
    return column


def of_fact(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(fact(spark, folder)))


def of_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(raw(spark, folder)))


def of_day(build: Callable[[DataFrame, date], DataFrame]) -> Query:
    """A report on the newest day, which is looked up first and then a literal."""
    return lambda spark, folder: plain(build(fact(spark, folder), report_day(spark, folder)))


def of_range(build: Callable[[DataFrame, date, date], DataFrame]) -> Query:
    def run(spark, folder):
        first, last = sessions.day_range(sessions.read_events(spark, folder))
        return plain(build(fact(spark, folder), first, last))

    return run


def session_key(*others):
    return ["player_id", "login_time", *others]


# --- scans and sources ---------------------------------------------------------


def raw_folder(spark: SparkSession, folder: str) -> str:
    """Raw rows laid out as log files, one directory per day."""
    root = f"{shared_folder(spark)}/raw"
    raw_source.write_raw_lines(raw(spark, folder), root)
    return root


def fact_folder(spark: SparkSession, folder: str) -> str:
    root = f"{shared_folder(spark)}/facts"
    tables.write_dwd(fact(spark, folder), root)
    return root


def fact_columns(df: DataFrame) -> DataFrame:
    return plain(df.select(*schema.FACT_COLUMNS, "dt"))


def new_table(spark: SparkSession, name: str) -> tuple[str, str]:
    """A table name in a fresh database of the shared folder, and a folder for it."""
    root = shared_folder(spark)
    database = "curfew_" + root.rsplit("/", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/db'")
    return f"{database}.{name}", f"{root}/{name}"


@query
def ods_scan(spark, folder):
    return raw_source.ods_scan_day(spark, raw_folder(spark, folder), report_day(spark, folder))


@query
def partition_discovery(spark, folder):
    table, _ = new_table(spark, "raw")
    raw_source.create_raw_table(spark, table, raw_folder(spark, folder))
    raw_source.add_day(spark, table, report_day(spark, folder))
    raw_source.discover_days(spark, table)
    return spark.sql(f"SHOW PARTITIONS {table}")


QUERIES["dwd_scan_day"] = of_day(lambda f, d: fact_columns(warehouse.on_day(f, d)))
QUERIES["dwd_scan_range"] = of_day(
    lambda f, d: fact_columns(warehouse.in_range(f, d - timedelta(days=9), d))
)
QUERIES["dwd_scan_dates"] = of_day(
    lambda f, d: fact_columns(warehouse.on_days(f, [d, d - timedelta(days=2), d - timedelta(days=5)]))
)


def fact_table(spark: SparkSession, folder: str, bucketed: bool = False) -> str:
    """A catalog table of the whole fact."""
    table, root = new_table(spark, "facts")
    rows = fact(spark, folder)
    first, last = sessions.day_range(sessions.read_events(spark, folder))
    buckets = tables.buckets_for(rows, (last - first).days + 1) if bucketed else 0
    tables.create_fact_table(spark, table, root, buckets)
    tables.write_table_days(rows, table, bucketed=bucketed)
    return table


@query
def latest_dt(spark, folder):
    """The newest day by the catalog's list of days."""
    return warehouse.latest_day(warehouse.partition_days(spark, fact_table(spark, folder)))


@query
def catalog_scan(spark, folder):
    return fact_columns(warehouse.catalog_scan(spark, f"spark_catalog.{fact_table(spark, folder)}"))


@query
def orc_dir_scan(spark, folder):
    day = report_day(spark, folder)
    path = f"{fact_folder(spark, folder)}/dt={day:%Y-%m-%d}"
    return fact_columns(warehouse.orc_dir_scan(spark, path, day))


@query
def tolerant_load(spark, folder):
    return raw_source.tolerant_load(spark, raw_folder(spark, folder), f"{shared_folder(spark)}/loaded", 0.3)


@query
def provenance(spark, folder):
    stamped = raw_source.with_provenance(raw_source.ods_scan(spark, raw_folder(spark, folder)))
    return stamped.select(
        "player_id", "login_time",
        F.regexp_extract("source_file", "/(dt=[0-9]+)/", 1).alias("source_day"),
        F.col("etl_time").isNotNull().alias("is_stamped"),
    )


# --- sinks ---------------------------------------------------------------------


@query
def write_dwd(spark, folder):
    root = fact_folder(spark, folder)
    day = report_day(spark, folder)
    tables.write_dwd(warehouse.on_day(fact(spark, folder), day), root, day)
    return fact_columns(warehouse.scan(spark, root))


@query
def write_daily_stats(spark, folder):
    """All days in one job, the newest again on its own."""
    root, last = f"{shared_folder(spark)}/stats", report_day(spark, folder)
    tables.write_daily_stats_of_days(daily.stats_by_day(fact(spark, folder)), root)
    tables.write_daily_stats(daily.daily_stats(fact(spark, folder), last), root, last)
    layout = schema.ddl([*schema.DAILY_STATS_DDL, ("dt", "date")])
    return plain(spark.read.schema(layout).orc(root).drop("etl_time"))


@query
def export_delimited(spark, folder):
    path = f"{shared_folder(spark)}/export"
    tables.export_delimited(fact(spark, folder), path, report_day(spark, folder))
    layout = schema.ddl([(name, "string") for name in schema.FACT_COLUMNS])
    return spark.read.schema(layout).option("sep", "\t").csv(path)


@query
def publish_serving(spark, folder):
    root, day = f"{shared_folder(spark)}/serving", report_day(spark, folder)
    tables.publish_serving(fact(spark, folder), root, day)
    tables.publish_serving(fact(spark, folder), root, day)
    return fact_columns(spark.read.orc(root))


@query
def publish_serving_bulk(spark, folder):
    root, day = f"{shared_folder(spark)}/serving", report_day(spark, folder)
    tables.publish_serving_bulk(fact(spark, folder), root, [day, day - timedelta(days=1), day - timedelta(days=2)])
    return fact_columns(spark.read.orc(root))


@query
def replace_day(spark, folder):
    """All days written, then the newest replaced by the sessions of its minors."""
    root, day = fact_folder(spark, folder), report_day(spark, folder)
    minors = warehouse.on_day(fact(spark, folder), day).filter(MINOR)
    tables.replace_day(minors, root, day)
    return fact_columns(warehouse.scan(spark, root))


@query
def labelled_load(spark, folder):
    """All days under two labels, one of them tried twice: each counts once."""
    root, day = f"{shared_folder(spark)}/loads", report_day(spark, folder)
    marked = raw_source.read_marked(spark, raw_folder(spark, folder))
    newest = F.col("dt") == raw_source.day_key(day)
    for label, rows in [("newest", newest), ("newest", newest), ("before", ~newest)]:
        ledger.labelled_load(marked.filter(rows), root, label, 0.3)
    layout = schema.ddl([*[(name, "string") for name in schema.RAW_FIELDS], ("dt", "string")])
    return ledger.loaded_rows(spark, root, layout)


@query
def table_layout(spark, folder):
    """A bucketed table of all days, the newest written twice."""
    table, day = fact_table(spark, folder, bucketed=True), report_day(spark, folder)
    tables.write_table_day(warehouse.on_day(fact(spark, folder), day), table, day, bucketed=True)
    return fact_columns(spark.table(table))


@query
def retention(spark, folder):
    """Days older than ten are gone, also from the folder: a repair finds none of them."""
    table = fact_table(spark, folder)
    tables.retention(spark, table, report_day(spark, folder), 10)
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return plain(daily.daily_overview(spark.table(table)))


@query
def retention_raw(spark, folder):
    """Raw days and their files older than ten days; a repair finds none of them again."""
    table, _ = new_table(spark, "raw")
    raw_source.create_raw_table(spark, table, raw_folder(spark, folder))
    raw_source.discover_days(spark, table)
    tables.retention(spark, table, report_day(spark, folder), 10)
    raw_source.discover_days(spark, table)
    return spark.table(table).groupBy("dt").agg(F.count(F.lit(1)).alias("record_count"))


@query
def add_column(spark, folder):
    table, root = new_table(spark, "facts")
    tables.create_fact_table(spark, table, root, 0, with_label=False)
    last = report_day(spark, folder)
    rows = fact(spark, folder)
    tables.write_table_days(rows.filter(F.col("dt") < F.lit(last)), table)
    tables.add_column(spark, table, "risk_label", "int")
    tables.add_column(spark, table, "risk_label", "int")
    tables.write_table_day(warehouse.on_day(rows, last), table, last)
    return spark.table(table).select("dt", "player_id", "login_time", "risk_label")


QUERIES["compact_output"] = of_fact(lambda f: fact_columns(tables.compact_output(f)))

# --- filters and cleaning ------------------------------------------------------

QUERIES["clean_required"] = of_raw(cleaning.clean_required)
QUERIES["clean_duration"] = of_raw(cleaning.clean_duration)
QUERIES["clean_time_order"] = of_raw(cleaning.clean_time_order)
QUERIES["clean_ip"] = of_raw(cleaning.clean_ip)
QUERIES["clean_dedup"] = of_raw(cleaning.clean_dedup)
QUERIES["clean_all"] = of_raw(cleaning.clean)
QUERIES["clean_funnel"] = of_raw(cleaning.clean_funnel)
QUERIES["clean_sql_path"] = of_raw(cleaning.clean_sql_path)
QUERIES["minor_risk_filter"] = of_fact(
    lambda f: f.filter(f"{MINOR} AND {AT_RISK}").select(
        *session_key("risk_label"), F.col("risk_label").isin(V.CURFEW, V.SEVERE).alias("is_curfew")
    )
)
QUERIES["window_days"] = of_day(
    lambda f, d: warehouse.last_days(f, d, 7).select(
        *session_key("dt"), (F.col("dt") >= F.date_sub(F.lit(d), 1)).alias("in_last_two")
    )
)


@query
def pk_lookup(spark, folder):
    """One player's sessions from the bucketed table: one bucket of each day, whose stripes a bloom filter skips."""
    return fact_columns(warehouse.of_player(spark.table(fact_table(spark, folder, bucketed=True)), LOOKUP_PLAYER))


# --- derived columns -----------------------------------------------------------


def _columns(*names: str):
    return lambda df: df.select(*names)


def _derived(*names: str):
    """Columns of raw rows after typing, with the login as it was written."""
    def build(rows):
        facts = standardize.derive(standardize.standardize(rows.withColumn("login_text", F.col("login_time"))))
        return facts.select("login_text", *names)

    return build


QUERIES["std_text"] = of_raw(lambda r: standardize.standardize(r).select(
    "account_type", "game_id", "device_type", "login_ip", "login_period", "game_region"))
QUERIES["std_times"] = of_raw(_derived("login_time", "logout_time"))
QUERIES["login_date"] = of_raw(_derived("login_date"))
QUERIES["login_hour"] = of_raw(_derived("login_hour"))
QUERIES["login_dayofweek"] = of_raw(_derived("login_dayofweek"))
QUERIES["std_numbers"] = of_raw(_derived(
    "online_duration", "match_count", "recharge_amount", "item_consumption"))
QUERIES["online_duration_min"] = of_raw(_derived("online_duration", "online_duration_min"))
QUERIES["is_minor"] = of_raw(_derived("account_type", "is_minor"))
QUERIES["is_night_login"] = of_raw(_derived("login_period", "is_night_login"))
QUERIES["is_heavy_gamer"] = of_raw(_derived("online_duration", "is_heavy_gamer"))
QUERIES["is_paying_player"] = of_raw(_derived("recharge_amount", "is_paying_player"))
QUERIES["risk_label"] = of_raw(_derived("player_id", "is_minor", "online_duration", "login_hour", "risk_label"))


@query
def event_dt(spark, folder):
    typed = standardize.standardize(raw(spark, folder)).drop("dt")
    day = report_day(spark, folder)
    by_login = standardize.with_event_day(typed).withColumnRenamed("dt", "login_day")
    return standardize.with_event_day(by_login, day).select(
        *session_key("login_day"), F.col("dt").alias("batch_day"))


QUERIES["login_period"] = of_fact(lambda f: f.select(
    *session_key("login_hour"),
    rules.login_period(F.col("login_hour")).alias("period_of_three"),
    rules.login_period(F.col("login_hour"), 4).alias("period_of_four"),
))
QUERIES["risk_text"] = of_fact(lambda f: f.select(
    *session_key("risk_label"),
    *[classes.risk_text("risk_label", name).alias(f"{name}_text") for name in V.RISK_WORDING],
))
QUERIES["yes_no"] = of_fact(lambda f: f.select(
    *session_key(),
    classes.yes_no(PAYING).alias("is_paying"),
    classes.yes_no(MINOR).alias("is_minor"),
))
QUERIES["duration_text"] = of_fact(lambda f: f.select(
    *session_key("online_duration_min"), classes.duration_text("online_duration_min").alias("duration_text")))
QUERIES["bucket_5"] = of_fact(lambda f: f.select(
    *session_key("online_duration"), classes.record_class("online_duration").alias("bucket")))
QUERIES["bucket_6"] = of_fact(lambda f: f.select(
    *session_key("online_duration_min"), classes.dashboard_class("online_duration_min").alias("bucket")))
QUERIES["bucket_7"] = of_fact(lambda f: f.select(
    *session_key("online_duration_min"), classes.minor_class("online_duration_min").alias("bucket")))
QUERIES["bucket_hist"] = of_fact(lambda f: f.select(
    *session_key("online_duration_min"), classes.histogram_class("online_duration_min").alias("bucket")))
QUERIES["recharge_bucket"] = of_fact(lambda f: f.select(
    *session_key("recharge_amount"), classes.recharge_class("recharge_amount").alias("bucket")))
QUERIES["night_flag"] = of_fact(lambda f: f.select(
    *session_key("login_hour"), classes.night_flag("login_hour").alias("night_flag")))
QUERIES["intervention_tier"] = of_range(lambda f, a, b: analysis.severe_islands(f, a, 1).withColumn(
    "tier", classes.intervention_tier("consecutive_days")))
QUERIES["display_fields"] = of_fact(reshape.display_fields)


@query
def is_valid_ip(spark, folder):
    sql_functions.register(spark)
    return raw(spark, folder).select("login_ip", F.expr("is_valid_ip(login_ip)").alias("is_valid"))


@query
def compute_risk_label(spark, folder):
    sql_functions.register(spark)
    return fact(spark, folder).select(
        *session_key(), F.expr("compute_risk_label(is_minor, online_duration, login_hour)").alias("risk_label"))


# --- joins ---------------------------------------------------------------------

QUERIES["streak_join"] = of_range(
    lambda f, a, b: analysis.streak_join(analysis.severe_islands(f, a), warehouse.in_range(f, a, b)))


@query
def streak_join_bucketed(spark, folder):
    """The same between two tables in buckets by player: neither side moves."""
    table = fact_table(spark, folder, bucketed=True)
    first, last = sessions.day_range(sessions.read_events(spark, folder))
    sessions_of = spark.table(table)
    buckets = tables.bucket_count(spark, table)
    streaks, root = new_table(spark, "streaks")
    tables.write_bucketed(analysis.severe_islands(sessions_of, first), streaks, root, buckets)
    return plain(analysis.streak_join_by_player(spark.table(streaks), warehouse.in_range(sessions_of, first, last)))


QUERIES["hour_fill"] = of_day(lambda f, d: reshape.hour_fill(
    dashboard.period_stats(f.filter(AT_RISK), d)))
QUERIES["payment_grid"] = of_day(
    lambda f, d: reshape.payment_grid(f.sparkSession, dashboard.payment_analysis(f, d)))


@query
def missing_dates(spark, folder):
    """Days after the newest one, by the catalog's list of days."""
    days = warehouse.partition_days(spark, fact_table(spark, folder))
    return reshape.missing_dates(days, report_day(spark, folder) + timedelta(days=5))


@query
def missing_dates_interior(spark, folder):
    """Days between the oldest and the newest as well: of the table every fifth day is dropped."""
    table = fact_table(spark, folder)
    for row in warehouse.partition_days(spark, table).filter("day(dt) % 5 = 0").collect():
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (dt = '{row['dt']}')")
    return reshape.missing_dates(
        warehouse.partition_days(spark, table), report_day(spark, folder) + timedelta(days=2), interior=True)


QUERIES["drilldown"] = of_day(lambda f, d: dashboard.drilldown(f, dashboard.risk_ranking(f, d), d))


@query
def layer_reconcile(spark, folder):
    rows = raw(spark, folder)
    kept = standardize.to_facts(cleaning.clean(rows.drop("dt")))
    return reshape.layer_reconcile(rows.withColumn("dt", F.to_date("dt", V.DAY_FORMAT)), kept)


# --- aggregates ----------------------------------------------------------------

for _name, _build in {
    "kpi_today": dashboard.kpi_today,
    "duration_dist": dashboard.duration_dist,
    "risk_trend": dashboard.risk_trend,
    "payment_analysis": dashboard.payment_analysis,
    "period_stats": dashboard.period_stats,
    "risk_ranking": dashboard.risk_ranking,
    "risk_ranking_by_hours": dashboard.risk_ranking_by_hours,
    "daily_stats": daily.daily_stats,
    "duration_records": daily.duration_records,
    "paying_stats": daily.paying_stats,
    "label_players": daily.label_players,
    "label_records": daily.label_records,
    "minor_records_at_risk": daily.minor_records_at_risk,
    "minor_profile": daily.minor_profile,
    "minor_duration_dist": analysis.minor_duration_dist,
    "cross_analysis": analysis.cross_analysis,
    "dwd_quality_pct": daily.dwd_quality_pct,
    "slice_overview": daily.slice_overview,
    "sync_check": daily.sync_check,
    "risk_summary": daily.risk_summary,
    "recent_volume": daily.recent_volume,
    "daily_report": daily.daily_report,
    "load_summary": daily.load_summary,
    "short_long_split": daily.short_long_split,
    "player_roster": daily.player_roster,
    "violation_detail": dashboard.violation_detail,
    "minor_night_detail": dashboard.minor_night_detail,
}.items():
    QUERIES[_name] = of_day(_build)

QUERIES["daily_risk"] = of_range(analysis.daily_risk)
QUERIES["daily_minor_risk"] = of_range(analysis.daily_minor_risk)
QUERIES["night_topn"] = of_range(analysis.night_topn)
QUERIES["night_export"] = of_range(analysis.night_export)
QUERIES["severe_streaks"] = of_range(lambda f, a, b: analysis.severe_streaks(f, a))
QUERIES["daily_overview"] = of_fact(daily.daily_overview)
QUERIES["label_distribution"] = of_fact(daily.label_distribution)
QUERIES["raw_log_summary"] = of_raw(daily.raw_log_summary)


@query
def player_detail(spark, folder):
    """One player's last days from the bucketed table."""
    table = spark.table(fact_table(spark, folder, bucketed=True))
    return plain(dashboard.player_detail(table, LOOKUP_PLAYER, report_day(spark, folder)))



@query
def ods_check(spark, folder):
    return daily.ods_check(raw(spark, folder), report_day(spark, folder))


@query
def today_snapshot(spark, folder):
    now = datetime.combine(report_day(spark, folder), time(23, 59, 59))
    return plain(analysis.today_snapshot(fact(spark, folder), now))


# --- windows, orders, shapes ---------------------------------------------------


def _ranked(totals: Callable, order: Callable, n: int) -> Callable:
    return lambda *args: dashboard.rank_index(totals(*args), order(), n)


QUERIES["share_of_total"] = of_day(lambda f, d: dashboard.share_of_total(
    warehouse.on_day(f, d).groupBy("device_type").agg(F.count(F.lit(1)).alias("record_count")), "record_count", 1))
QUERIES["longest_session"] = of_fact(lambda f: fact_columns(analysis.longest_session(f)))
QUERIES["streak_islands"] = of_range(lambda f, a, b: analysis.severe_islands(f, a, 1))
QUERIES["rank_index"] = of_day(dashboard.ranking_table)
QUERIES["top10"] = of_day(_ranked(dashboard.player_risk_totals, dashboard.ranking_order, 10))
QUERIES["top100_violations"] = of_day(dashboard.violation_ranked)
QUERIES["top100_night"] = of_range(_ranked(analysis.night_totals, analysis.night_order, 100))
QUERIES["top200_streaks"] = of_range(
    _ranked(lambda f, a, b: analysis.severe_streak_totals(f, a), analysis.streak_order, 200))
QUERIES["top500_export"] = of_range(lambda f, a, b: dashboard.rank_index(
    analysis.curfew_breaches(f, a, b), dashboard.severity_order(), 500).select(
        *session_key("rank_index", "risk_label", "online_duration_min")))
QUERIES["order_by_bucket_min"] = of_day(lambda f, d: dashboard.numbered(
    dashboard.duration_dist_with_order(f, d), [F.col("shortest")]))
QUERIES["custom_order"] = of_day(lambda f, d: dashboard.numbered(
    warehouse.on_day(f, d).groupBy("login_period").agg(F.count(F.lit(1)).alias("record_count")),
    [classes.custom_order("login_period", [V.DAYTIME, V.EVENING, V.NIGHT])]))
QUERIES["order_by_ordinal"] = of_day(lambda f, d: dashboard.numbered(
    analysis.minor_duration_dist(f, d), [F.col("duration_range")]))

QUERIES["kpi_payload"] = of_day(reshape.kpi_payload)
QUERIES["duration_payload"] = of_day(reshape.duration_payload)
QUERIES["trend_payload"] = of_day(reshape.trend_payload)
QUERIES["payment_payload"] = of_day(reshape.payment_payload)
QUERIES["period_payload"] = of_day(reshape.period_payload)
QUERIES["rows_total"] = of_day(lambda f, d: reshape.rows_total(
    dashboard.rank_index(dashboard.player_risk_totals(f, d), dashboard.ranking_order(), 10).select(
        "rank_index", "player_id", "active_days", "max_risk_level", "game_count")))
QUERIES["rows_with_total"] = of_day(lambda f, d: reshape.with_total(dashboard.minor_night_detail(f, d)))
QUERIES["flow_edges"] = of_day(
    lambda f, d: reshape.flow_edges(f.sparkSession, dashboard.payment_analysis(f, d)))

# --- quality -------------------------------------------------------------------

def _checked(wanted: list[str] | None, days_back: int = 0) -> Query:
    """Checks of the written fact; what they ask of the whole table comes from file footers."""
    def run(spark, folder):
        root, day = fact_folder(spark, folder), report_day(spark, folder)
        counts = warehouse.rows_per_day(spark, root)
        return plain(quality.dq_report(warehouse.scan(spark, root), day, day - timedelta(days=days_back), wanted, counts))

    return run


QUERIES["dq_report"] = _checked(None)
for _name in quality.check_names():
    QUERIES[f"dq_{_name}"] = of_day(lambda f, d, name=_name: quality.dq_report(f, d, d, [name]))
QUERIES["dq_min_volume"] = _checked(["min_volume"])
# A day before the newest as today, so that there are rows ahead of it.
QUERIES["dq_future_dt"] = _checked(["future_dt"], 1)

# --- streaming -----------------------------------------------------------------


def _through_stream(spark: SparkSession, folder: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Raw log files read as a stream, changed by ``build``, written and read back."""
    stream = build(stream_sources.stream_source(stream_session(spark), raw_folder(spark, folder)))
    root = shared_folder(spark)
    stream_sinks.append_files(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query
def stream_source(spark, folder):
    return _through_stream(spark, folder, lambda s: s)


@query
def stream_enrich(spark, folder):
    arrived = _through_stream(spark, folder, lambda s: stream_sources.stream_enrich(s, "collector-1"))
    return arrived.select("player_id", "login_time", "host", F.col("arrival_time").isNotNull().alias("is_stamped"))


@query
def stream_fanout(spark, folder):
    """Two sinks from one reading of the source."""
    stream = stream_sources.stream_source(spark, raw_folder(spark, folder), max_files=10)
    root = shared_folder(spark)
    stream_sinks.stream_fanout(stream, {
        name: stream_sinks.into_batches(f"{root}/{name}") for name in ("files", "batches")
    }, root, f"{root}/checkpoint").awaitTermination()
    read = [spark.read.schema(schema.RAW).option("recursiveFileLookup", "true").parquet(f"{root}/{name}").withColumn("sink", F.lit(name))
            for name in ("files", "batches")]
    return read[0].unionByName(read[1]).select("sink", "player_id", "login_time", "login_ip")


@query
def stream_dated_files(spark, folder):
    stream = stream_sources.stream_source(spark, raw_folder(spark, folder))
    root = shared_folder(spark)
    stamped = stream_sources.stream_enrich(stream, "collector-1")
    stream_sinks.stream_dated_files(stamped, f"{root}/logs", f"{root}/checkpoint", seconds=None).awaitTermination()
    return raw_source.ods_scan(spark, f"{root}/logs").drop("dt")


@query
def stream_packed_files(spark, folder):
    """The same files in several batches, packed but for the newest day, and read as one."""
    root, logs = shared_folder(spark), raw_folder(spark, folder)
    stream = stream_sources.stream_source(spark, logs, max_files=10)
    dated = stream.withColumn("arrival_time", F.to_timestamp("login_time"))
    stream_sinks.stream_dated_files(dated, f"{root}/logs", f"{root}/checkpoint", seconds=None).awaitTermination()
    packing.pack_days(spark, f"{root}/logs", f"{root}/packed", report_day(spark, folder))
    return packing.scan(spark, f"{root}/logs", f"{root}/packed").drop("dt")


@query
def stream_arrival_check(spark, folder):
    arrived = _through_stream(spark, folder, lambda s: s)
    return stream_sinks.stream_arrival_check(arrived, F.col("player_id") == LOOKUP_PLAYER)


@query
def stream_rows_read(spark, folder):
    """Rows that a query has read in all its batches, over two starts."""
    root, logs = shared_folder(spark), raw_folder(spark, folder)
    progress = stream_sinks.ProgressTable(spark, f"{root}/progress")
    spark.streams.addListener(progress)
    try:
        for _ in range(2):
            stream = stream_sources.stream_source(spark, logs, max_files=4)
            running = stream_sinks.append_files(stream, f"{root}/out", f"{root}/checkpoint")
            running.awaitTermination()
            progress.wait_for(running)
    finally:
        spark.streams.removeListener(progress)
    return progress.read().agg(F.sum("input_rows").alias("input_rows"))


@query
def stream_microbatch_load(spark, folder):
    stream = stream_sources.stream_source(spark, raw_folder(spark, folder), max_files=10)
    root = shared_folder(spark)
    stream_sinks.stream_microbatch_load(stream, f"{root}/batches", f"{root}/checkpoint").awaitTermination()
    per_batch = stream_sinks.loaded_per_batch(
        spark, f"{root}/batches", schema.ddl([(name, "string") for name in schema.RAW_FIELDS]))
    return per_batch.agg(F.sum("loaded_rows").alias("loaded_rows"))


@query
def stream_split_line(spark, folder):
    lines = spark.read.text(raw_folder(spark, folder)).select(F.col("value").cast("binary").alias("value"))
    return stream_sources.split_line(lines)


@query
def stream_label(spark, folder):
    """Alerts: severe sessions among the raw rows of the stream."""
    alerts = _through_stream(
        spark, folder, lambda s: stream_operators.stream_alerts(stream_operators.stream_facts(s)))
    return fact_columns(alerts)


@query
def stream_dedup(spark, folder):
    """Two streams over the same files in several batches: copies within, across and after them."""
    root, logs = shared_folder(spark), raw_folder(spark, folder)
    for name in ["first", "again"]:
        stream = stream_sources.stream_source(stream_session(spark), logs, max_files=6)
        stream_sinks.stream_dedup_load(stream, f"{root}/out", f"{root}/{name}").awaitTermination()
    found = spark.read.schema(
        f"{schema.ddl([(name, 'string') for name in schema.RAW_FIELDS])}, {stream_sinks.DEDUP_DDL}").parquet(f"{root}/out")
    return found.select(*schema.RAW_FIELDS)


def _fact_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Graded sessions as they come, in several batches."""
    return stream_operators.stream_facts(stream_sources.stream_source(spark, raw_folder(spark, folder), max_files=10))


@query
def stream_active_30m(spark, folder):
    root = shared_folder(spark)
    stream_sinks.stream_active_counts(_fact_stream(spark, folder), f"{root}/active", f"{root}/checkpoint").awaitTermination()
    return stream_operators.active_so_far(stream_sinks.active_table(spark, f"{root}/active").read())


@query
def stream_daily_risk(spark, folder):
    root = shared_folder(spark)
    stream_sinks.stream_risk_counts(_fact_stream(spark, folder), f"{root}/risk", f"{root}/checkpoint").awaitTermination()
    return stream_sinks.risk_table(spark, f"{root}/risk").read(kind="counts")


# --- the daily job -------------------------------------------------------------


def _job(spark: SparkSession, folder: str, lateness_days: int | None) -> daily_job.Layers:
    """The job over every raw day in one run, then over the newest day again."""
    layers = daily_job.Layers.under(raw_folder(spark, folder), shared_folder(spark))
    days = list(warehouse.folder_days(spark, layers.raw))
    daily_job.run_days(spark, layers, days, lateness_days)
    daily_job.run(spark, layers, max(days), lateness_days)
    return layers


@query
def daily_job_facts(spark, folder):
    return fact_columns(warehouse.scan(spark, _job(spark, folder, None).facts))


@query
def daily_job_stats(spark, folder):
    layout = schema.ddl([*schema.DAILY_STATS_DDL, ("dt", "date")])
    stats = spark.read.schema(layout).orc(_job(spark, folder, 2).stats)
    return plain(stats.drop("etl_time"))


@query
def daily_cycle_sync(spark, folder):
    """A cycle on the newest day but one, which catches up on all days before it, and one on the newest;
    rows of both layers per day."""
    root, last = shared_folder(spark), report_day(spark, folder)
    layers, serving = daily_job.Layers.under(raw_folder(spark, folder), root), f"{root}/serving"
    first = daily_cycle.run_cycle(spark, layers, serving, last - timedelta(days=1))
    second = daily_cycle.run_cycle(spark, layers, serving, last)
    return first.sync.unionByName(second.sync)


@query
def daily_cycle_gap(spark, folder):
    """The raw files of a day come after a cycle has passed it: the next one loads it."""
    root, last = shared_folder(spark), report_day(spark, folder)
    logs, late = f"{root}/raw", last - timedelta(days=2)
    rows, key = raw(spark, folder), raw_source.day_key(late)
    raw_source.write_raw_lines(rows.filter(F.col("dt") != key), logs)
    layers = daily_job.Layers.under(logs, root)
    daily_cycle.run_cycle(spark, layers, f"{root}/serving", last - timedelta(days=1))
    raw_source.write_raw_lines(rows.filter(F.col("dt") == key), logs, append=True)
    daily_cycle.run_cycle(spark, layers, f"{root}/serving", last)
    served = warehouse.scan_serving(spark, f"{root}/serving")
    return served.groupBy("dt").agg(F.count(F.lit(1)).alias("record_count"))


@query
def roster_after_day(spark, folder):
    day, rows = report_day(spark, folder), fact(spark, folder)
    before = daily.player_roster(rows, day - timedelta(days=1))
    return daily.roster_after_day(before, rows, day)


@query
def daily_job_tables(spark, folder):
    """The job between catalog tables, the newest day run twice."""
    raw_table, root = new_table(spark, "raw")
    names = daily_job.Tables(raw_table, raw_table.replace(".raw", ".facts"), raw_table.replace(".raw", ".stats"))
    raw_source.create_raw_table(spark, names.raw, raw_folder(spark, folder))
    tables.create_fact_table(spark, names.facts, f"{root}_facts", buckets=0)
    tables.create_stats_table(spark, names.stats, f"{root}_stats")
    day = report_day(spark, folder)
    for _ in range(2):
        daily_job.run_tables(spark, names, day)
    return plain(spark.table(names.stats).drop("etl_time"))
