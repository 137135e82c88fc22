"""Names, schemas and keys of the layers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import types as T

# Readers of the published tables and the landing files rely on them.
LANDING_PREFIX = "landing/"
LANDING_SUFFIX = ".csv"
DATE_PATTERN = "M/d/yyyy"
LATEST_DAY = date(2018, 12, 30)
DATABASE = "retail_sales"
DAY_COLUMNS = ["year", "month", "day"]
SILVER_KEY = "row_id"
SALES_KEY = "order_id"
CUSTOMER_KEY = "customer_id"

# Columns that ingest adds, so a landing file must not bring its own.
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
ORDER_DATE_PARSED = "_order_date_parsed"
INGEST_ID = "ingest_id"
RESERVED_COLUMNS = [SOURCE_FILE, INGESTED_AT, ORDER_DATE_PARSED, INGEST_ID, *DAY_COLUMNS]

# A file without these can be neither keyed nor dated; any other column may be missing.
REQUIRED_COLUMNS = ["row_id", "order_id", "order_date", "customer_id"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, DAY, INT, COUNT = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()

SILVER = _struct(
    row_id=INT, order_id=TEXT, order_date=DAY, ship_date=DAY, ship_mode=TEXT,
    customer_id=TEXT, customer_first_name=TEXT, customer_last_name=TEXT,
    segment=TEXT, country=TEXT, city=TEXT, year=INT, month=INT, day=INT,
)

GOLD_SALES = _struct(
    order_id=TEXT, order_date=DAY, shipment_date=DAY, shipment_mode=TEXT, city=TEXT,
    year=INT, month=INT, day=INT,
)

GOLD_CUSTOMER = _struct(
    customer_id=TEXT, customer_first_name=TEXT, customer_last_name=TEXT,
    customer_segment=TEXT, country=TEXT,
    orders_last_month=COUNT, orders_last_6_months=COUNT, orders_all_time=COUNT,
)

# An object-created notification; other fields are ignored. Text that is no whole JSON value
# lands in the last field.
_S3 = _struct(bucket=_struct(name=TEXT), object=_struct(key=TEXT, sequencer=TEXT))
DAMAGED = "_damaged"
OBJECT_EVENT = _struct(Records=T.ArrayType(_struct(eventTime=TEXT, s3=_S3)), **{DAMAGED: TEXT})
