"""Landing files: CSV text with a header row, every column a string."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.layers import REQUIRED_COLUMNS, RESERVED_COLUMNS

# Columns that a scan of several files adds; the space keeps them apart from any folded header.
LANDING_KEY = "landing key"
LANDING_ID = "landing id"
_PATH = "landing path"

LISTINGS_AT_ONCE = 16


def folded(header: str) -> str:
    return header.strip().lower().replace(" ", "_")


def folded_names(headers: list[str | None]) -> list[str]:
    """Column names for a header row; two headers that fold to one name are an error.

    A header without text names its column by its place.
    """
    names = [folded(header or "") or f"_c{i}" for i, header in enumerate(headers)]
    clashes = sorted(name for name, n in Counter(names).items() if n > 1)
    if clashes:
        raise ValueError(f"headers fold to the same name: {clashes}")
    return names


def check_landing_columns(frame: DataFrame) -> None:
    missing = [name for name in REQUIRED_COLUMNS if name not in frame.columns]
    if missing:
        raise ValueError(f"landing file lacks columns: {missing}")
    taken = [name for name in RESERVED_COLUMNS if name in frame.columns]
    if taken:
        raise ValueError(f"landing file uses reserved columns: {taken}")


def literal_path(path: str) -> str:
    """The path with its glob characters escaped: it names one file, whatever its name holds."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def scan_csv(
    spark: SparkSession, uri: str, *, multi_line: bool = False, escape: str | None = None
) -> DataFrame:
    """One landing file (or folder of its parts) with folded headers.

    The header row is read as data first, so that Spark can't rename repeated headers.
    `multi_line` reads quoted line breaks but keeps Spark from splitting a file over tasks;
    `escape='"'` reads doubled quotes.
    """
    reader = spark.read.options(multiLine=multi_line)
    if escape is not None:
        reader = reader.option("escape", escape)
    path = literal_path(uri)
    names = _header_names(reader, [path])
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    return reader.schema(_text_columns(names)).option("header", True).csv(path)


def _header_names(reader, paths: list[str]) -> list[str]:
    headers = reader.option("header", False).csv(paths).take(1)
    return folded_names(list(headers[0])) if headers else []


def _text_columns(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def same_path(path: str) -> str:
    """A local path may come with one slash or three."""
    return re.sub("^file:/+", "file:/", path)


def listed_files(spark: SparkSession, uris: list[str]) -> dict[str, list[str]]:
    """The files behind each URI, which names one file or a folder of its parts. Runs no Spark job."""
    with ThreadPoolExecutor(LISTINGS_AT_ONCE) as calls:
        listed = calls.map(lambda uri: spark.read.text(literal_path(uri)).inputFiles(), uris)
        return {uri: sorted(map(same_path, paths)) for uri, paths in zip(uris, listed)}


def header_lines(spark: SparkSession, uris: list[str], files: list[str]) -> dict[str, str]:
    """The first line with text of each of the files below the URIs, by its path: one scan, whatever their number.

    The condition on a file's name is one that the listing answers, so no other file is opened. It has to
    stand below the numbers of the lines, as no condition is moved past those.
    """
    meta = F.col("_metadata")
    wanted = F.regexp_replace(meta["file_path"], "^file:/+", "file:/").isin(files)
    texts = spark.read.text([literal_path(uri) for uri in uris])
    lines = texts.filter(wanted).filter((meta["file_block_start"] == 0) & (F.trim("value") != "")).select(
        "value", meta["file_path"].alias("path"), F.monotonically_increasing_id().alias("place")
    )
    first = lines.groupBy("path")
    return {same_path(path): line for path, line in first.agg(F.min_by("value", "place")).collect()}


def scan_files(spark: SparkSession, files: list[tuple[str, str, str]]) -> list[DataFrame]:
    """Landing files given as (uri, key, id): one scan per distinct header, each row with its file's key and id.

    The files of a batch come to the driver by name, with their header lines; rows never do. A
    file without a header line yields a frame without columns.
    """
    uris = list(dict.fromkeys(uri for uri, _, _ in files))
    paths = listed_files(spark, uris)
    # A folder's parts have one header, which its first part shows unless that is blank.
    lines, blank = {}, uris
    for part in (slice(1), slice(1, None)):
        parts = [path for uri in blank for path in paths[uri][part]]
        lines |= header_lines(spark, blank, parts) if parts else {}
        blank = [uri for uri in uris if not any(path in lines for path in paths[uri])]
    alike = defaultdict(list)
    for uri in uris:
        alike[next((lines[path] for path in paths[uri] if path in lines), None)].append(uri)
    owners = [(path, key, one) for uri, key, one in files for path in paths[uri]]
    owner = spark.createDataFrame(owners, T.StructType([T.StructField(name, T.StringType()) for name in (_PATH, LANDING_KEY, LANDING_ID)]))
    scans = []
    for line, group in alike.items():
        globs = [literal_path(uri) for uri in group]
        names = [] if line is None else _header_names(spark.read, globs[:1])
        if not names:
            scans.append(spark.createDataFrame([], T.StructType([])))
            continue
        rows = spark.read.schema(_text_columns(names)).option("header", True).csv(globs)
        path = F.regexp_replace(rows.metadataColumn("_metadata")["file_path"], "^file:/+", "file:/")
        # One row per file of the batch, which the driver holds anyway.
        scans.append(rows.withColumn(_PATH, path).join(F.broadcast(owner), _PATH).drop(_PATH))
    return scans
