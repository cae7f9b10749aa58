"""Fixed values that results must carry exactly: thresholds, domains, wording."""

# Limits of a session, in seconds and hours.
MIN_SESSION_SECONDS = 0
MAX_SESSION_SECONDS = 21600
MINOR_LIMIT_SECONDS = 14400
NIGHT_FROM_HOUR = 22
NIGHT_UNTIL_HOUR = 8

# Account types, devices, games, regions.
MINOR = "minor"
ADULT = "adult"
DEVICES = ["android", "ios", "pc"]
REGIONS = [
    "华东一区", "华东二区", "华南一区", "华南二区", "华北一区", "华北二区",
    "华中一区", "西南一区", "西北一区", "东北一区", "港澳台区", "海外区",
]

# Names of the parts of a day, in three and in four classes.
DAYTIME, EVENING, NIGHT = "白天", "傍晚", "夜间"
SMALL_HOURS, MORNING, AFTERNOON, LATE = "凌晨", "上午", "下午", "晚上"
NOT_NIGHT = "非夜间"

# Risk labels and their wordings, one vocabulary per report.
NORMAL, OVERTIME, CURFEW, SEVERE = 0, 1, 2, 3
RISK_WORDING = {
    "job": {0: "正常玩家", 1: "一级预警(单日>4小时)", 2: "二级违规(夜间登录)", 3: "重度沉迷(时长+夜间)"},
    "summary": {0: "正常玩家", 1: "一级预警(>4h)", 2: "二级违规(夜间)", 3: "重度沉迷"},
    "distribution": {0: "正常", 1: "预警", 2: "违规", 3: "重度沉迷"},
    "cross": {0: "正常", 1: "超时预警", 2: "夜间违规", 3: "重度沉迷"},
    "violation": {1: "超时预警", 2: "夜间违规", 3: "重度沉迷"},
    "minor_night": {2: "二级违规(仅夜间)", 3: "重度沉迷(夜间+超时)"},
    "player": {0: "正常", 1: "超时预警(>4h)", 2: "夜间违规(22:00-08:00)", 3: "重度沉迷(夜间+超时)"},
    "night_export": {2: "二级违规(仅夜间登录)", 3: "重度沉迷(夜间+超时)"},
}
# What a vocabulary says for a label it does not list.
RISK_WORDING_ELSE = {"job": "未知", "night_export": "其他"}
RISK_BADGE = {1: "预警", 2: "违规", 3: "重度"}

# Session length classes. Bounds are inclusive for the record
# statistics (seconds) and the histogram (minutes), exclusive for the others.
RECORD_CLASSES = [(3600, "0-1小时"), (7200, "1-2小时"), (10800, "2-3小时"), (14400, "3-4小时")]
RECORD_CLASS_ELSE = "4小时以上"
DASHBOARD_CLASSES = [
    (30, "<30分钟"), (60, "30~60分钟"), (120, "1~2小时"), (180, "2~3小时"), (240, "3~4小时"),
]
DASHBOARD_CLASS_ELSE = "4小时以上(超限)"
MINOR_CLASSES = [
    (30, "A: <30分钟"), (60, "B: 30~60分钟"), (120, "C: 1~2小时"), (180, "D: 2~3小时"),
    (240, "E: 3~4小时"), (300, "F: 4~5小时(超限)"),
]
MINOR_CLASS_ELSE = "G: 5小时以上(严重超限)"
HISTOGRAM_BOUNDS = [30, 60, 120, 180, 240, 360]

# Recharge classes; zero first, then inclusive upper bounds.
RECHARGE_ZERO = "未付费"
RECHARGE_CLASSES = [(30, "1~30元"), (100, "30~100元"), (300, "100~300元"), (1000, "300~1000元")]
RECHARGE_CLASS_ELSE = "1000元以上"
RECHARGE_ORDER = [RECHARGE_ZERO, *[name for _, name in RECHARGE_CLASSES], RECHARGE_CLASS_ELSE]

# Tiers of intervention by streak length. The first sign of the
# first tier is the radical U+2F00, as results have it.
TIERS = [(7, "⼀级干预(7天+)"), (5, "二级干预(5-6天)")]
TIER_ELSE = "三级干预(3-4天)"

# Short answers, units, marks, node names of the flow chart.
YES, NO = "是", "否"
HOURS_UNIT, MINUTES_UNIT = "小时", "分钟"
MISSING = "--"
CURRENCY = "¥"
ADULT_NODE, MINOR_NODE = "成人账号", "未成年账号"

# The shape of an IPv4 address, and reserved first parts.
IPV4 = (
    r"^((25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}"
    r"(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)$"
)
RESERVED_IP = r"^(0|127|169\.254|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
RESERVED_IP_IN_FACT = r"^(0|127|169\.254)\."

# Time format of raw text, day format of raw directories.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyyMMdd"
