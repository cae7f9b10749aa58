"""The dashboard's nine end points as methods over one fact."""

from datetime import date

from pyspark.sql import DataFrame

from curfew.operators import dashboard, reshape
from curfew.sources.warehouse import newest_day


class Dashboard:
    """Every method reports on ``day``, by default the newest loaded one."""

    def __init__(self, fact: DataFrame, day: date | None = None):
        self.fact = fact
        self.day = day or newest_day(fact)
        if self.day is None:
            raise ValueError("no day is loaded")

    def kpi(self) -> DataFrame:
        return reshape.kpi_payload(self.fact, self.day)

    def duration(self) -> DataFrame:
        return reshape.duration_payload(self.fact, self.day)

    def trend(self) -> DataFrame:
        return reshape.trend_payload(self.fact, self.day)

    def payment(self) -> DataFrame:
        return reshape.payment_payload(self.fact, self.day)

    def period(self) -> DataFrame:
        return reshape.period_payload(self.fact, self.day)

    def risk_ranking(self) -> DataFrame:
        totals = dashboard.player_risk_totals(self.fact, self.day)
        return reshape.rows_total(dashboard.rank_index(totals, dashboard.ranking_order(), 10))

    def violations(self) -> DataFrame:
        return reshape.rows_total(dashboard.violation_ranked(self.fact, self.day))

    def minor_night(self) -> DataFrame:
        return reshape.with_total(dashboard.minor_night_detail(self.fact, self.day))

    def player(self, player_id: str) -> DataFrame:
        return reshape.with_total(dashboard.player_detail(self.fact, player_id, self.day))
