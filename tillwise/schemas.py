"""Source schemas and the fixed values shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# The results must use exactly these.
OPEN_END = dt.date(9999, 12, 31)
TIERS = ("Bronze", "Silver", "Gold")
STORE_STATUSES = ("active", "closed")
GRAINS = ("daily", "monthly")
SEGMENTS = ("Champions", "Loyal", "Promising", "At Risk", "Need Attention")
SCORES = (1, 2, 3)
CUSTOMER_CHECK_COLUMNS = ("full_name", "email", "phone", "city", "province", "tier")
STORE_CHECK_COLUMNS = (
    "store_description", "country", "area", "city", "district", "zip", "channel_type", "gross_area",
    "net_sales_area", "area_unit", "latitude", "longitude", "opening_date", "closing_date",
    "local_currency", "format",
)
SALES_CHECK_COLUMNS = (
    "order_date", "store_code", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _DATE = T.StringType(), T.DateType()

SRC_SALES = _struct(
    order_id=T.LongType(), order_date=_DATE, store_code=_TEXT, customer_id=_TEXT, product_id=_TEXT,
    quantity=T.IntegerType(), unit_price=MONEY, total_amount=MONEY, partition_time=_DATE,
)
SRC_STORE = _struct(
    store_code=_TEXT, latitude=_TEXT, longitude=_TEXT, store_description=_TEXT, country=_TEXT,
    area=_TEXT, city=_TEXT, district=_TEXT, partition_time=T.TimestampNTZType(),
)
SRC_CUSTOMER = _struct(
    customer_id=_TEXT, full_name=_TEXT, email=_TEXT, phone=_TEXT, city=_TEXT, province=_TEXT,
    registration_date=_DATE, tier=_TEXT, partition_time=_DATE,
)
SRC_STORE_DETAIL = _struct(
    store_code=_TEXT, store_description=_TEXT, country=_TEXT, area=_TEXT, city=_TEXT, district=_TEXT,
    zip=_TEXT, channel_type=_TEXT, gross_area=MONEY, net_sales_area=MONEY, area_unit=_TEXT,
    latitude=_TEXT, longitude=_TEXT, opening_date=_DATE, closing_date=_DATE, local_currency=_TEXT,
    format=_TEXT, partition_time=_DATE,
)
CODE_HISTORY = _struct(initial_store_code=_TEXT, store_code=_TEXT, start_date=_DATE, end_date=_DATE)

SOURCES = {
    "src_sales": SRC_SALES,
    "src_store": SRC_STORE,
    "src_customer": SRC_CUSTOMER,
    "src_store_detail": SRC_STORE_DETAIL,
}
