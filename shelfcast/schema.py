"""Column names, fixed schemas and the constants that define the results."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("family", "store_nbr")
REQUIRED = ("date", "store_nbr", "family", "sales")
RAW_COLUMNS = REQUIRED + ("onpromotion",)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
PANEL_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store_nbr", T.IntegerType()),
        T.StructField("family", T.StringType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("onpromotion", T.LongType()),
    ]
)

# Thresholds of the checks, the cleaning rules and the models.
MIN_HISTORY_DAYS = 90
SHORT_GAP, LONG_GAP = 7, 30
SPIKE_WINDOW, SPIKE_MEDIAN_FACTOR, SPIKE_FENCE, SPIKE_NEIGHBOUR = 7, 10.0, 3.0, 0.5
TRAIN_RATIO, VAL_RATIO = 0.70, 0.15
LAGS, ROLLING = (7, 14, 30), (7, 30)
DAILY_TREND_LIMIT = 365
HORIZON_RANGE = (7, 90)
MIN_SERIES_ROWS, MIN_ADF_ROWS = 30, 20
WINDOW_LENGTH = 30
MODELS = ("ARIMA", "Prophet", "LSTM")
MAX_FILE_BYTES = 16 * 1024 * 1024
ENCODINGS = ("utf-8", "utf-8-sig", "gbk")
TARGET_STORES = (1, 2, 3, 4, 5)

# Event types that protect a day, and the days each one covers around its date.
EVENT_WINDOWS = {"Holiday": (-1, 1), "Event": (0, 0), "Additional": (0, 0)}

# Texts that mean "missing" in an uploaded file.
NULL_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Display label per product family.
FAMILY_LABELS = {
    "AUTOMOTIVE": "汽车用品",
    "BABY CARE": "婴儿用品",
    "BEAUTY": "美妆",
    "BEVERAGES": "饮料",
    "BOOKS": "图书",
    "BREAD/BAKERY": "面包烘焙",
    "CELEBRATION": "节庆礼品",
    "CLEANING": "清洁用品",
    "DAIRY": "乳制品",
    "DELI": "熟食",
    "EGGS": "蛋类",
    "FROZEN FOODS": "冷冻食品",
    "GROCERY I": "杂货I",
    "GROCERY II": "杂货II",
    "HARDWARE": "五金",
    "HOME AND KITCHEN I": "家居厨具I",
    "HOME AND KITCHEN II": "家居厨具II",
    "HOME APPLIANCES": "家电",
    "HOME CARE": "家居护理",
    "LADIESWEAR": "女装",
    "LAWN AND GARDEN": "园艺",
    "LINGERIE": "内衣",
    "LIQUOR,WINE,BEER": "酒水",
    "MAGAZINES": "杂志",
    "MEATS": "肉类",
    "PERSONAL CARE": "个人护理",
    "PET SUPPLIES": "宠物用品",
    "PLAYERS AND ELECTRONICS": "电子产品",
    "POULTRY": "禽肉",
    "PREPARED FOODS": "即食食品",
    "PRODUCE": "生鲜",
    "SCHOOL AND OFFICE SUPPLIES": "文具办公",
    "SEAFOOD": "海鲜",
}
