"""A table of very many ranges: what follows their number must stay cheap."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows_of
from test_ranges import check, orders, plain, table  # noqa: F401
from tillroll.sinks import merge
from tillroll.sinks.catalog import LISTING_TASKS, add_partitions, define_table, in_partitions, partition_folder, point_partitions
from tillroll.sinks.merge import merge_into


def test_folders_are_listed_in_few_tasks(spark, table, monkeypatch):  # noqa: F811
    before, seen = spark.conf.get(LISTING_TASKS), []
    spark.conf.set(LISTING_TASKS, 5000)
    try:
        for name in ("stage", "folder_files", "scanned_files"):
            step = getattr(merge, name)
            noted = lambda *args, step=step, **kw: seen.append(int(spark.conf.get(LISTING_TASKS))) or step(*args, **kw)
            monkeypatch.setattr(merge, name, noted)
        merge_into(spark, table, orders(spark, range(100)))
        merge_into(spark, table, orders(spark, range(50, 200), city="Oslo"))
        assert len(seen) > 4 and max(seen) <= 4 * spark.sparkContext.defaultParallelism
        assert spark.conf.get(LISTING_TASKS) == "5000"
    finally:
        spark.conf.set(LISTING_TASKS, before)
    check(spark, table, plain(range(50)) | plain(range(50, 200), "Oslo"))


def test_calls_do_not_grow_with_ranges(spark, table, tmp_path, monkeypatch):  # noqa: F811
    define_table(spark, table, str(tmp_path / "t"))
    places = [(2018 if n % 2 else None, 1 if n % 2 else None, n % 5 + 1 if n % 2 else None, n) for n in range(400)]
    for version in ("a", "b"):
        for place in places:
            (tmp_path / version / partition_folder(table, place)).mkdir(parents=True)
    at = {version: {p: f"{tmp_path}/{version}/{partition_folder(table, p)}" for p in places} for version in ("a", "b")}
    add_partitions(spark, table, at["a"])

    sent, send = [], spark.sql
    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", lambda text: sent.append(text) or send(text))
        point_partitions(spark, table, {p: at["b"][p] for p in places[:399]})
    assert 0 < len(sent) <= 16
    for place, version in ((places[0], "b"), (places[398], "b"), (places[399], "a")):
        spec = ", ".join(f"{name}={'null' if value is None else value}" for name, value in zip(table.placed_by, place))
        rows = spark.sql(f"DESCRIBE EXTENDED {table.stored} PARTITION ({spec})").collect()
        assert at[version][place] in next(row.data_type for row in rows if row.col_name == "Location")

    commands, client = [], spark.sparkContext._gateway._gateway_client
    send_command = client.send_command
    with monkeypatch.context() as patch:
        patch.setattr(client, "send_command", lambda *args, **kw: commands.append(1) or send_command(*args, **kw))
        condition = in_partitions(table, places[::2] + [places[1]])
    assert len(commands) < 100
    rows = spark.createDataFrame(places, "year int, month int, day int, _range int")
    assert rows_of(rows.filter(condition)) == sorted(places[::2] + [places[1]], key=repr)
    assert rows.filter(in_partitions(table, [(2018, 1, 2)])).count() == rows.filter(F.col("day") == 2).count()
