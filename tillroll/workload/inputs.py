"""Landing rows and notifications derived from the given tables."""

from __future__ import annotations

from datetime import date
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import day_parts
from tillroll.layers import DATE_PATTERN, SILVER_KEY
from tillroll.plans.bronze import dated
from tillroll.plans.silver import conform

# Fixed values shared with the oracles.
ANCHOR = date(2001, 8, 1)
INGESTED = "2001-08-02T00:00:00+00:00"
FIRST_FILE = "landing/b1.csv"
SECOND_FILE = "landing/b2.csv"


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_suppkey"]

# Lines that a task groups and joins at most: its memory follows this number, not the table.
LINES_PER_TASK = 500_000

# Folders of landing rows that `store` wrote, by application and given tables.
_STORED: dict[tuple[str, str], str] = {}


def store(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Keep the landing rows in `folder`, so that queries of this application time no derivation."""
    landing(spark, sf_dir).write.parquet(folder)
    _STORED[spark.sparkContext.applicationId, sf_dir] = folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy order lines: bad ids and dates, padded text, names of one to three words."""
    stored = _STORED.get((spark.sparkContext.applicationId, sf_dir))
    if stored:
        return spark.read.parquet(stored)
    lines = (
        _dealt(spark, table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS))
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_shipdate").alias("shipped"),
            # A flag is one letter; as a number it can be hash-aggregated, as a string it
            # would force a sort of every line.
            F.min(F.ascii("l_returnflag")).alias("flag"),
            F.min("l_suppkey").alias("supplier"),
        )
    )
    # The nations are a fixed list of 25; customers are joined to them before the lines so
    # that the large joins see two sides only.
    buyers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    order, buyer, name = F.col("l_orderkey"), F.col("o_custkey"), F.col("c_name")
    text = {
        "row_id": F.when(order % 501 == 0, "x").otherwise(
            (order * 10 + F.col("l_linenumber")).cast("string")
        ),
        "order_id": F.concat(F.lit(" ORD-"), order.cast("string"), F.lit(" ")),
        "order_date": F.when(order % 97 == 0, "1998-10-03")
        .when(order % 89 == 0, None)
        .otherwise(F.date_format("o_orderdate", DATE_PATTERN)),
        "ship_date": F.date_format("shipped", DATE_PATTERN),
        "ship_mode": F.when(F.col("flag") == ord("A"), " First Class")
        .when(F.col("flag") == ord("N"), " Second Class")
        .otherwise(" Standard Class"),
        "customer_id": F.concat(F.lit("CUST-"), buyer.cast("string")),
        "customer_name": F.when(buyer % 4 == 0, name)
        .when(buyer % 4 == 1, F.replace(name, F.lit("#"), F.lit(" ")))
        .when(
            buyer % 4 == 2,
            F.concat(F.lit(" "), F.replace(name, F.lit("#"), F.lit(" van ")), F.lit(" ")),
        )
        .otherwise(F.replace(name, F.lit("#"), F.lit("  "))),
        "segment": F.when(order % 5 == 0, "VIP ").otherwise(F.col("c_mktsegment")),
        "country": F.col("n_name"),
        "city": F.concat(F.lit("CITY_"), (F.col("supplier") % 50).cast("string")),
        "_source_file": F.when(F.year("o_orderdate") < 2000, FIRST_FILE).otherwise(SECOND_FILE),
    }
    return rows.select(*(column.alias(alias) for alias, column in text.items()))


def _dealt(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """The lines dealt out by order once: those of an order then group and join where they are.

    Partitions sized by bytes alone hold ever more of these narrow, well packed rows. The count reads
    the files' footers only.
    """
    tasks = ceil(lines.count() / LINES_PER_TASK)
    if tasks <= 1:
        return lines.repartition("l_orderkey")
    return lines.repartition(max(tasks, spark.sparkContext.defaultParallelism), "l_orderkey")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(landing(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(bronze(spark, sf_dir))


def early(silver: DataFrame) -> DataFrame:
    """Silver rows before the late ones come: some are still missing."""
    return silver.filter(F.col(SILVER_KEY) % 7 != 0)


def late(silver: DataFrame) -> DataFrame:
    """Late rows: some new, some known; of the known ones some move to other days or to none.

    All rows of June 1997 move, so its days empty. Cities of even rows are blanked.
    """
    key, day = F.col(SILVER_KEY), F.col("order_date")
    june = (F.year(day) == 1997) & (F.month(day) == 6)
    moved = (
        F.when(june, F.add_months(day, 1))
        .when(key % 5 == 0, F.lit(None).cast("date"))
        .when(key % 5 == 1, F.date_add(day, 1))
        .otherwise(day)
    )
    rows = silver.filter((key % 17 == 0) | F.coalesce(june, F.lit(False)) | (key % 7 == 0))
    rows = rows.withColumns({"order_date": moved, "city": F.when(key % 2 == 1, F.col("city"))})
    return rows.withColumns(day_parts(F.col("order_date")))


def crowded(silver: DataFrame) -> DataFrame:
    """The rows in one partition per year, and every third one in that of the undated rows."""
    dated = (F.col(SILVER_KEY) % 3 != 0) & F.col("year").isNotNull()
    first = F.when(dated, F.lit(1))
    return silver.withColumns({"year": F.when(dated, F.col("year")), "month": first, "day": first})


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON notification per event, its key URL-encoded."""
    number = F.col("event_id")
    folder = F.when(number % 3 == 0, "other/").otherwise("landing/")
    suffix = (
        F.when(number % 4 == 0, ".csv")
        .when(number % 4 == 1, ".CSV")
        .when(number % 4 == 2, ".txt")
        .otherwise(".csv.gz")
    )
    key = F.url_encode(F.concat(folder, F.lit("f "), number.cast("string"), suffix))
    s3 = F.struct(
        F.struct(F.lit("b").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
    )
    body = F.to_json(F.struct(F.array(F.struct(s3.alias("s3"))).alias("Records")))
    return table(spark, sf_dir, "events").select(body.alias("value"))


def damaged_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but every seventh body is cut short and every eleventh names no bucket."""
    bodies = notifications(spark, sf_dir).withColumn(
        "number", F.regexp_extract("value", r"f\+(\d+)", 1).cast("long")
    )
    cut = F.expr("left(value, length(value) - 5)")
    nameless = F.replace(F.col("value"), F.lit('"name":"b"'), F.lit('"nom":"b"'))
    damaged = F.when(F.col("number") % 7 == 0, cut).when(F.col("number") % 11 == 0, nameless).otherwise(F.col("value"))
    return bodies.select(damaged.alias("value"))


def file_notifications(spark: SparkSession, bucket: str, key: str, sequencer: str) -> DataFrame:
    """A file's notification, delivered twice, beside a damaged one and one of a file that is none of ours."""
    body = (
        '{"Records":[{"eventTime":"2001-08-02T00:00:00.000Z",'
        '"s3":{"bucket":{"name":"%s"},"object":{"key":"%s","sequencer":"%s"}}}]}'
    )
    mine = body % (bucket, key.replace("/", "%2F"), sequencer)
    other = body % (bucket, "other%2Ff.csv", sequencer)
    return spark.createDataFrame([(mine,), (mine,), (mine[:-4],), (other,)], "value string")
