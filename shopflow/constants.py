"""Values that must equal the reference for identical results.

Fixed values, stated as plain text in their natural order; every module
imports them from here.
"""

# --- fixed values --------------------------------------------------------------

# topics: log router (start-up / everything else) and change-feed router
TOPIC_STARTUP = "GMALL_STARTUP"
TOPIC_EVENT = "GMALL_EVENT"
TOPIC_ORDER_INFO = "TOPIC_ORDER_INFO"
TOPIC_ORDER_DETAIL = "TOPIC_ORDER_DETAIL"
TOPIC_USER_INFO = "TOPIC_USER_INFO"

# document index prefixes (index name = "<prefix>-<yyyy-MM-dd>")
DAU_INDEX_PREFIX = "gmall2020_dau"
ALERT_INDEX_PREFIX = "gmall_coupon_alert"

# app event ids used by the alert rule
COUPON = "coupon"
CLICK = "clickItem"
MIN_ACCOUNTS = 3

# phone mask: keep the first 4 characters, append 8 '*'
PHONE_KEEP = 4
PHONE_STARS = 8

# KPI cards: id and display name ("new daily active", "new devices", "new revenue")
CARD_DAU = ("dau", "新增日活")
CARD_NEW_MID = ("new_mid", "新增设备")
CARD_ORDER_AMOUNT = ("order_amount", "新增交易额")

# search page: terms sizes, age-band labels ("under 20", "20 to 30",
# "30 and over"), gender display names
GENDER_BUCKETS = 2
AGE_BUCKETS = 100
BAND_UNDER_20 = "20岁以下"
BAND_20_TO_30 = "20岁到30岁"
BAND_30_PLUS = "30岁及30岁以上"
GENDER_NAMES = {"M": "男", "F": "女"}
