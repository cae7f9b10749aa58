"""The two rules that SQL text may call by name, as SQL functions that Catalyst inlines."""

from pyspark.sql import SparkSession

from curfew.functions import fixed_values as V


def register(spark: SparkSession) -> None:
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION is_valid_ip(ip STRING) RETURNS BOOLEAN RETURN "
        f"coalesce(trim(ip) RLIKE r'{V.IPV4}' AND NOT trim(ip) RLIKE r'{V.RESERVED_IP}', false)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION compute_risk_label("
        "is_minor INT, online_duration BIGINT, login_hour INT) RETURNS INT RETURN "
        f"if(is_minor = 0, {V.NORMAL}, "
        f"if(online_duration > {V.MINOR_LIMIT_SECONDS}, {V.OVERTIME}, 0) + "
        f"if(login_hour >= {V.NIGHT_FROM_HOUR} OR login_hour < {V.NIGHT_UNTIL_HOUR}, {V.CURFEW}, 0))"
    )
