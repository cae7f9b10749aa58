"""The daily job: raw text to graded facts, then the day's aggregate row.

    spark-submit run_daily.py 20240130 --raw <folder> --warehouse <folder>

Two writes and two small checks. Both writes replace the day, so the job can be
run again at any time. Nothing is cached: the aggregate reads the written day
back from its columnar files.
"""

import argparse
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curfew.functions import fixed_values as V
from curfew.functions import rules
from curfew.operators import cleaning, daily, standardize
from curfew.session import build_session, size_shuffles
from curfew.sinks import tables
from curfew.sources import raw as raw_source
from curfew.sources import warehouse


class Layers(NamedTuple):
    raw: str
    facts: str
    stats: str

    @classmethod
    def under(cls, raw: str, root: str) -> "Layers":
        return cls(raw, f"{root}/facts", f"{root}/daily_stats")


class Tables(NamedTuple):
    raw: str
    facts: str
    stats: str


def clean_facts(raw: DataFrame, batch_day: date | None) -> DataFrame:
    """Scanned raw rows as clean facts, of the batch's day or each of its login's."""
    stamped = raw_source.with_provenance(raw).drop("dt")
    return standardize.to_facts(cleaning.clean(stamped), batch_day)


def days_read(days: list[date], lateness_days: int | None) -> list[date]:
    """Directories that the job reads for some days."""
    return sorted({day + timedelta(days=late) for day in days for late in range((lateness_days or 0) + 1)})


def days_facts(scanned: DataFrame, days: list[date], lateness_days: int | None = None) -> DataFrame:
    """Clean facts of days, from the scan of ``days_read``.

    By default the day of the raw directory is the day of its rows. With
    ``lateness_days`` it is the day of login: directories up to so many days
    later are read too, since a log may arrive late, and only logins of the wanted
    days are kept; the job then reads so many days more. Either way a rerun sees the
    same rows, and a day comes out the same whether it is loaded alone or among others.
    """
    if lateness_days is None:
        stamped = raw_source.with_provenance(scanned)
        return standardize.to_facts(cleaning.clean(stamped, ["dt"]), F.to_date("dt", V.DAY_FORMAT))
    login = F.to_date(rules.parse_time(F.col("login_time")))
    late = F.date_diff(F.to_date("dt", V.DAY_FORMAT), login)
    return clean_facts(scanned.filter(login.isin(list(days)) & late.between(0, lateness_days)), None)


def run_days(spark: SparkSession, layers: Layers, days: list[date], lateness_days: int | None = None) -> list[date]:
    """Load many days in one run: facts in one job, daily rows in another. Returns the days that had
    raw rows to read; the others are left as they are. A day whose rows are all refused is cleared."""
    days = sorted(set(days))
    there = set(warehouse.folder_days(spark, layers.raw))
    if not there & set(days_read(days, lateness_days)):
        return []
    raw_seen, fact_seen = Observation(), Observation()
    scanned = raw_source.ods_scan_list(spark, layers.raw, days_read(days, lateness_days))
    facts = days_facts(scanned.observe(raw_seen, F.collect_set("dt").alias("days")), days, lateness_days)
    tables.write_days(facts.observe(fact_seen, F.collect_set("dt").alias("days")), layers.facts, compact=len(days) > 1)
    read = set(raw_seen.get["days"])
    loaded = [day for day in days if any(raw_source.day_key(d) in read for d in days_read([day], lateness_days))]
    filled = set(fact_seen.get["days"])
    written = warehouse.on_days(warehouse.scan(spark, layers.facts), sorted(filled)) if filled else facts.limit(0)
    stats = daily.stats_by_day(written)
    if filled:
        tables.write_daily_stats_of_days(stats, layers.stats)
    for day in loaded:
        if day not in filled:
            tables.clear_day(facts, layers.facts, day)
            tables.clear_day(tables.stamped(stats), layers.stats, day)
    return loaded


def run(spark: SparkSession, layers: Layers, day: date, lateness_days: int | None = None) -> bool:
    """One day; False, and nothing written, when there is no raw row to read."""
    return bool(run_days(spark, layers, [day], lateness_days))


def raw_table_day(spark: SparkSession, table: str, day: date) -> DataFrame:
    return spark.table(table).filter(F.col("dt") == raw_source.day_key(day))


def run_tables(spark: SparkSession, names: Tables, day: date) -> bool:
    """The same between catalog tables, by batch day. New raw days are registered first."""
    raw_source.add_day(spark, names.raw, day)
    raw = raw_table_day(spark, names.raw, day)
    if raw.isEmpty():
        return False
    tables.write_table_day(clean_facts(raw, day), names.facts, day)
    stats = daily.daily_stats(spark.table(names.facts), day)
    tables.write_table_day(tables.stamped(stats), names.stats, day)
    return True


def parse_day(text: str) -> date:
    return datetime.strptime(text, "%Y%m%d").date()


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="curfew-daily", description="Clean, grade and aggregate one day.")
    parser.add_argument("day", type=parse_day, help="yyyyMMdd")
    parser.add_argument("--raw", help="folder of raw logs, dt=yyyyMMdd below")
    parser.add_argument("--warehouse", help="folder of the written layers")
    parser.add_argument("--by-login-day", type=int, metavar="DAYS", dest="lateness_days",
                        help="take rows by login day from directories up to DAYS later")
    parser.add_argument("--tables", nargs=3, metavar=("RAW", "FACTS", "STATS"),
                        help="work between tables of a Hive metastore instead of folders")
    parser.add_argument("--funnel", action="store_true",
                        help="also show how many rows each rule dropped, in another pass over the raw rows")
    options = parser.parse_args(arguments)
    if not options.tables and not (options.raw and options.warehouse):
        parser.error("give --raw and --warehouse, or --tables")
    spark = build_session(f"curfew-daily-{options.day:%Y%m%d}", hive=bool(options.tables))
    if options.tables:
        names = Tables(*options.tables)
        raw_source.add_day(spark, names.raw, options.day)
        raw = raw_table_day(spark, names.raw, options.day)
    else:
        layers = Layers.under(options.raw, options.warehouse)
        raw = raw_source.ods_scan_list(spark, layers.raw, days_read([options.day], options.lateness_days))
    size_shuffles(spark, raw)
    if options.tables:
        done = run_tables(spark, names, options.day)
    else:
        done = run(spark, layers, options.day, options.lateness_days)
    if not done:
        print(f"no raw rows for {options.day}")
        return 1
    if options.funnel:
        cleaning.clean_funnel(raw).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
