"""Time the headline queries; print one line of JSON.

The fact is loaded into day partitions, as a serving copy is, and queried by one
session that stays up, as a dashboard's does: every step is run before it is
timed, and the median of its timed runs counts. Each timed run builds its query
anew.
"""

import json
import os
import statistics
import sys
import time
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from curfew.operators import analysis, cleaning, daily, dashboard, quality
from curfew.plans import daily_job, queries
from curfew.session import SETTINGS, shared_folder
from curfew.sinks import tables
from curfew.sources import raw as raw_source
from curfew.sources import sessions, warehouse
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UPS, RUNS = 3, 5


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": CPUS,
    }
    for key, value in {**SETTINGS, **local}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    root = shared_folder(spark)

    def load():
        events = sessions.facts(sessions.read_events(spark, SF_DIR))
        tables.write_dwd(events, f"{root}/facts")

    load()
    seconds = {"load_facts": timed(load)}
    fact = warehouse.scan(spark, f"{root}/facts")
    day = warehouse.newest_folder_day(spark, f"{root}/facts")
    first = day - timedelta(days=29)

    reports = {
        "kpi_today": lambda: dashboard.kpi_today(fact, day),
        "duration_dist": lambda: dashboard.duration_dist(fact, day),
        "risk_trend": lambda: dashboard.risk_trend(fact, day),
        "payment_analysis": lambda: dashboard.payment_analysis(fact, day),
        "period_stats": lambda: dashboard.period_stats(fact, day),
        "risk_ranking": lambda: dashboard.risk_ranking(fact, day),
        "violation_detail": lambda: dashboard.violation_detail(fact, day),
        "minor_night_detail": lambda: dashboard.minor_night_detail(fact, day),
        "player_detail": lambda: dashboard.player_detail(fact, queries.LOOKUP_PLAYER, day),
        "daily_stats": lambda: daily.daily_stats(fact, day),
        "daily_risk": lambda: analysis.daily_risk(fact, first, day),
        "daily_minor_risk": lambda: analysis.daily_minor_risk(fact, first, day),
        "minor_duration_dist": lambda: analysis.minor_duration_dist(fact, day),
        "night_topn": lambda: analysis.night_topn(fact, first, day),
        "cross_analysis": lambda: analysis.cross_analysis(fact, day),
        "severe_streaks": lambda: analysis.severe_streaks(fact, first),
        "dq_report": lambda: quality.dq_report(fact, day, day),
    }
    for _ in range(WARM_UPS):
        for report in reports.values():
            report().collect()
    for name, report in reports.items():
        seconds[name] = statistics.median(timed(lambda: report().collect()) for _ in range(RUNS))

    layers = daily_job.Layers.under(queries.raw_folder(spark, SF_DIR), f"{root}/job")
    raw = raw_source.ods_scan(spark, layers.raw)
    steps = {
        "clean_all": lambda: cleaning.clean(raw).write.format("noop").mode("overwrite").save(),
        "clean_funnel": lambda: cleaning.clean_funnel(raw).collect(),
        "daily_job": lambda: daily_job.run(spark, layers, day),
    }
    for name, step in steps.items():
        step()
        seconds[name] = timed(step)

    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
