"""Declared schemas.  Readers take these; nothing is inferred at run time."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


LONG, INT, STR, DBL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

USER_VISIT_ACTION = _struct(
    date=STR,
    user_id=LONG,
    session_id=STR,
    page_id=LONG,
    action_time=STR,
    search_keyword=STR,
    click_category_id=LONG,
    click_product_id=LONG,
    order_category_ids=STR,
    order_product_ids=STR,
    pay_category_ids=STR,
    pay_product_ids=STR,
    city_id=LONG,
)
USER_INFO = _struct(
    user_id=LONG, username=STR, name=STR, age=INT, professional=STR, city=STR, sex=STR
)
PRODUCT_INFO = _struct(product_id=LONG, product_name=STR, extend_info=STR)
CITY_INFO = _struct(city_id=LONG, city_name=STR, area=STR)
EMPLOYEE = _struct(name=STR, age=LONG, depId=LONG, gender=STR, salary=DBL)
DEPARTMENT = _struct(id=LONG, name=STR)
KEY_VALUE = _struct(key=INT, value=STR)
AD_CLICK = _struct(click_ms=LONG, province=STR, city=STR, user_id=LONG, ad_id=LONG)
ORDER_INFO = _struct(
    order_id=STR, platform=STR, s_time=LONG, currency_type=STR, payment_type=STR, amount=LONG
)
MEMBER_INFO = _struct(member_id=STR, last_visit_date=STR, created=STR)
IP_RANGE = _struct(begin_ip=STR, end_ip=STR, region=STR)
INBOUND = _struct(id=INT, url=STR)

# Names of the log parameters that get a column of their own; a
# record may carry more, which land in the map column ``extra``.
EVENT_LOG_COLUMNS = [
    "en", "ver", "pl", "sdk", "u_ud", "u_mid", "u_sd", "c_time", "l", "b_iev", "b_rst",
    "p_url", "p_ref", "tt", "oid", "on", "cua", "cut", "pt", "ca", "ac", "du",
]
