from __future__ import annotations

import os
import time

from tillroll.plans.run import Layers, ingest, run_files
from tillroll.sources.bronze_files import read_bronze
from tillroll.streaming.landing_stream import start

HEADER = "Row ID,Order ID,Order Date,Customer ID"


def test_each_csv_is_handed_on_once_across_restarts(spark, tmp_path):
    folder = tmp_path / "landing"
    (folder / "sub").mkdir(parents=True)
    seen = []

    def run():
        start(spark, str(folder), str(tmp_path / "checkpoint"), "b",
              lambda files: seen.extend(file.key for file in files)).awaitTermination()

    (folder / "a b+c.csv").write_text(HEADER)
    (folder / "sub" / "B.CSV").write_text(HEADER)
    (folder / "skip.txt").write_text(HEADER)
    run()
    assert sorted(seen) == ["landing/a b+c.csv", "landing/sub/B.CSV"]
    (folder / "late.csv").write_text(HEADER)
    run()
    assert sorted(seen) == ["landing/a b+c.csv", "landing/late.csv", "landing/sub/B.CSV"]


def test_headers_in_another_order_stay_right(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{HEADER}\n1,O1,1/2/2018,C1\n")
    (folder / "b c.csv").write_text("Customer ID,Row ID,City,Order Date,Order ID\nC2,2,Rome,1/3/2018,O2\n")
    layers = Layers(str(tmp_path / "lake"), "t_stream_headers")
    start(spark, str(folder), str(tmp_path / "checkpoint"), "b",
          lambda files: ingest(spark, layers, files, "now")).awaitTermination()
    rows = read_bronze(spark, layers.bronze).select("row_id", "order_id", "customer_id", "city", "day")
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("1", "O1", "C1", None, 2), ("2", "O2", "C2", "Rome", 3),
    ]


def test_names_with_glob_characters_name_one_file(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for i, name in enumerate(["a[1].csv", "a*.csv", "a1.csv", "{b,c}.csv", "d?.csv"]):
        (folder / name).write_text(f"{HEADER}\n{i},O{i},1/2/2018,C{i}\n")
    layers = Layers(str(tmp_path / "lake"), "t_stream_globs")
    batches = []

    def on_files(files):
        batches.append(len(files))
        run_files(spark, layers, files)

    start(spark, str(folder), str(tmp_path / "checkpoint"), "b", on_files, files_per_batch=2).awaitTermination()
    assert batches == [2, 2, 1]
    rows = read_bronze(spark, layers.bronze).select("_source_file", "row_id").collect()
    assert len(rows) == 5 and len({tuple(row) for row in rows}) == 5
    assert sorted(row.row_id for row in spark.table(layers.silver.name).collect()) == [0, 1, 2, 3, 4]


def test_a_file_with_an_old_time_stamp_is_handed_on(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    seen = []

    def run():
        start(spark, str(folder), str(tmp_path / "checkpoint"), "b",
              lambda files: seen.extend(file.key for file in files)).awaitTermination()

    (folder / "first.csv").write_text(HEADER)
    run()
    (folder / "old.csv").write_text(HEADER)
    (folder / "new.csv").write_text(HEADER)
    long_ago = time.time() - 400 * 86_400
    os.utime(folder / "old.csv", (long_ago, long_ago))
    run()
    assert sorted(seen) == ["landing/first.csv", "landing/new.csv", "landing/old.csv"]
