"""Declared schemas of the layers. Nothing is inferred from data."""

from pyspark.sql import types as T

RAW_FIELDS = [
    "player_id", "account_type", "game_id", "login_time", "logout_time",
    "online_duration", "match_count", "recharge_amount", "item_consumption",
    "login_ip", "login_period", "game_region", "device_type",
]

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

MINUTES = "decimal(10,1)"
MONEY = "decimal(12,2)"

# The fact, without the partition column ``dt`` (a date).
FACT_DDL = [
    ("player_id", "string"),
    ("account_type", "string"),
    ("game_id", "string"),
    ("login_time", "timestamp"),
    ("logout_time", "timestamp"),
    ("login_date", "date"),
    ("login_hour", "int"),
    ("login_dayofweek", "int"),
    ("online_duration", "bigint"),
    ("online_duration_min", MINUTES),
    ("match_count", "int"),
    ("recharge_amount", MONEY),
    ("item_consumption", "bigint"),
    ("login_ip", "string"),
    ("login_period", "string"),
    ("is_night_login", "int"),
    ("game_region", "string"),
    ("device_type", "string"),
    ("is_minor", "int"),
    ("is_heavy_gamer", "int"),
    ("is_paying_player", "int"),
    ("risk_label", "int"),
]
PROVENANCE_DDL = [("etl_time", "timestamp"), ("source_file", "string")]
FACT_COLUMNS = [name for name, _ in FACT_DDL]

# Types of the serving copy where they are narrower than the fact's.
SERVING_TYPES = {
    "login_hour": "tinyint",
    "login_dayofweek": "tinyint",
    "online_duration": "int",
    "match_count": "smallint",
    "item_consumption": "int",
    "is_night_login": "tinyint",
    "is_minor": "tinyint",
    "is_heavy_gamer": "tinyint",
    "is_paying_player": "tinyint",
    "risk_label": "tinyint",
}

DAILY_STATS_DDL = [
    ("dau", "bigint"),
    ("total_records", "bigint"),
    ("paying_players", "bigint"),
    ("total_players", "bigint"),
    ("total_recharge", "decimal(16,2)"),
    ("minor_players", "bigint"),
    ("risk_label_0", "bigint"),
    ("risk_label_1", "bigint"),
    ("risk_label_2", "bigint"),
    ("risk_label_3", "bigint"),
    ("avg_online_min", MINUTES),
    ("etl_time", "timestamp"),
]
DAILY_STATS_COLUMNS = [name for name, _ in DAILY_STATS_DDL]


def ddl(columns) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns)
