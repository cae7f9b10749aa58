"""The daily cycle: fill gaps, run the job, publish, check, report.

    raw days -> facts and daily row -> serving copy -> comparison and checks

Every step replaces whole days, so a cycle that broke off is simply run again.
"""

import argparse
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from curfew import schema
from curfew.operators import daily, quality, reshape
from curfew.plans import daily_job
from curfew.session import build_session
from curfew.sinks import tables
from curfew.sources import warehouse


class Outcome(NamedTuple):
    loaded: list[date]
    sync: DataFrame
    checks: DataFrame
    report: DataFrame
    volume: DataFrame


def gap_days(spark: SparkSession, layers: daily_job.Layers, today: date, since: date | None = None) -> list[date]:
    """Days to catch up on: those before today, from ``since`` on, that have raw files but
    no facts. Days between loaded ones count too, so raw files may come late; before the
    first cycle all days do. Both lists are of directories; no file is read."""
    have = warehouse.folder_days(spark, layers.raw)
    loaded = warehouse.folder_days(spark, layers.facts)
    return sorted(day for day in have if day < today and day not in loaded and (since is None or day >= since))


def facts_or_none(spark: SparkSession, root: str, scan) -> DataFrame:
    """The scan of a folder, or no rows where nothing was written yet."""
    if warehouse.folder_exists(spark, root):
        return scan(spark, root)
    columns = [*schema.FACT_DDL, *schema.PROVENANCE_DDL, ("dt", "date")]
    return spark.createDataFrame([], schema.ddl(columns))


def run_cycle(spark: SparkSession, layers: daily_job.Layers, serving_root: str, today: date,
              catch_up: bool = True, since: date | None = None, lateness_days: int | None = None,
              keep_days: tuple[int, int] | None = None) -> Outcome:
    """Load today and, with ``catch_up``, the days missed before it; publish what was loaded.

    ``lateness_days`` takes rows by login day, as in the job. ``keep_days`` are how long
    raw logs, facts and serving copy, and how long daily rows are kept; none are
    deleted without it. With nothing to load and nothing loaded the reports are empty.
    """
    days = gap_days(spark, layers, today, since) if catch_up else []
    loaded = daily_job.run_days(spark, layers, [*days, today], lateness_days)
    fact = facts_or_none(spark, layers.facts, warehouse.scan)
    if loaded:
        tables.publish_serving_bulk(fact, serving_root, loaded)
    if keep_days:
        for root, keep in [(layers.raw, keep_days[0]), (layers.facts, keep_days[0]), (serving_root, keep_days[0]),
                           (layers.stats, keep_days[1])]:
            tables.retention_folder(spark, root, today, keep)
    serving = facts_or_none(spark, serving_root, warehouse.scan_serving)
    return Outcome(
        loaded,
        reshape.layer_reconcile(warehouse.on_days(fact, loaded), warehouse.on_days(serving, loaded)),
        quality.dq_report(serving, today, today, per_day=warehouse.rows_per_day(spark, serving_root)
                          if warehouse.folder_exists(spark, serving_root) else None),
        daily.daily_report(serving, today),
        daily.recent_volume(serving, today),
    )


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="curfew-cycle", description="Load a day and what was missed, publish, check.")
    parser.add_argument("day", type=daily_job.parse_day, help="yyyyMMdd")
    parser.add_argument("--raw", required=True, help="folder of raw logs, dt=yyyyMMdd below")
    parser.add_argument("--warehouse", required=True, help="folder of the written layers")
    parser.add_argument("--serving", required=True, help="folder of the serving copy")
    parser.add_argument("--since", type=daily_job.parse_day, help="earliest day to catch up on, yyyyMMdd")
    parser.add_argument("--by-login-day", type=int, metavar="DAYS", dest="lateness_days")
    parser.add_argument("--keep", type=int, nargs=2, metavar=("DAYS", "STATS_DAYS"),
                        help="delete older raw, fact and serving days, and older daily rows")
    options = parser.parse_args(arguments)
    spark = build_session(f"curfew-cycle-{options.day:%Y%m%d}")
    layers = daily_job.Layers.under(options.raw, options.warehouse)
    keep = tuple(options.keep) if options.keep else None
    done = run_cycle(spark, layers, options.serving, options.day, since=options.since,
                     lateness_days=options.lateness_days, keep_days=keep)
    print("loaded:", *done.loaded)
    for part in (done.sync, done.checks, done.report, done.volume):
        part.show(100, truncate=False)
    return 0 if options.day in done.loaded else 1


if __name__ == "__main__":
    raise SystemExit(main())
