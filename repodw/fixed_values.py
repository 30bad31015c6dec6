"""Values the results depend on.

Fixed values: they must equal the original data contract (labels, limits, word lists), so they are
kept as plain text in their natural order.
"""

NO_DESCRIPTION = "无"
NO_LANGUAGE = "未标注"
REST_LABEL = "其他"
UNKNOWN_PLATFORM = "unknown"

DESCRIPTION_MAX = 15000
NAME_MAX = 250
MIGRATED_PATTERN = "迁移|migrated"
SMALLEST_RAW_FILE = 10

RANKING_ROWS = 20
FOLD_AFTER = 7
CHART_ROWS = 15
LINE_ROWS = 20
COMPARE_POOL = 20
COMPARE_DEFAULT = 3
COMPARE_MAX = 6
LOG_ROWS = 200
PROFILE_ROWS = 10

STAR_BINS = [("0", 0, 1), ("1-9", 1, 10), ("10-49", 10, 50), ("50-99", 50, 100), ("100-499", 100, 500),
             ("500-999", 500, 1000), ("1000+", 1000, None)]

CALENDAR_START = "2010-01-01"
CALENDAR_END = "2030-12-31"

LOGIN_ACTION = "登录"
EXPORT_ACTION = "导出"

EXPORT_HEADER = ["仓库全名", "组织", "语言", "平台", "Star", "Fork", "Watch", "Issues", "统计日期"]

WATCHED_ORGS = {
    "gitee": [
        "openeuler", "src-openeuler", "mindspore", "opengauss", "openlookeng", "anolis",
        "deepin-community", "openatom-foundation", "ubuntukylin", "openkylin", "openEuler-riscv",
        "kunpengcompute",
    ],
    "github": [
        "mindspore-ai", "PaddlePaddle", "kubeedge", "karmada-io", "volcano-sh", "openlookeng",
        "openGemini", "kubernetes", "apache", "tensorflow", "pytorch", "pingcap", "grafana",
        "prometheus", "etcd-io", "cncf", "trinodb", "rust-lang", "golang",
    ],
}

SEARCH_KEYWORDS = ["xinchuang", "信创", "kunpeng", "ascend", "harmonyos", "openHarmony", "openEuler"]
SEARCH_ROWS_PER_KEYWORD = 500
