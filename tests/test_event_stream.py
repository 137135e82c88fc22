"""Notifications that start runs."""

from __future__ import annotations

import json
import os
import time

import pytest

from conftest import rows_of
from test_run import HEADER, Landing, line
from tillroll.plans.run import run_files
from tillroll.streaming.event_stream import start


class Bucket(Landing):
    """A folder that stands for a bucket, and a folder of its notifications."""

    def __init__(self, spark, folder, database):
        super().__init__(spark, folder, database)
        (folder / "notes").mkdir()
        (folder / "bucket" / "landing").mkdir(parents=True)
        self.batches, self.number = [], 0

    def put(self, name, *lines):
        (self.folder / "bucket" / "landing" / name).write_text("\n".join([HEADER, *lines]) + "\n")

    def note(self, *bodies):
        self.number += 1
        (self.folder / "notes" / f"{self.number}.json").write_text("\n".join(bodies) + "\n")

    def listen(self):
        def on_batch(batch):
            self.batches.append(batch)
            for files in batch.portions(2):
                run_files(self.spark, self.layers, files, "2019-01-01T00:00:00+00:00")

        start(
            self.spark, str(self.folder / "notes"), str(self.folder / "checkpoint"), on_batch,
            lambda bucket, key: str(self.folder / bucket / key),
        ).awaitTermination()
        return self.batches[-1]


def body(key, sequencer="1", at="2019-01-01T00:00:00.000Z", bucket="bucket"):
    place = {"key": key} | ({"sequencer": sequencer} if sequencer else {})
    return json.dumps({"Records": [{"eventTime": at, "s3": {"bucket": {"name": bucket}, "object": place}}]})


@pytest.fixture
def store(spark, tmp_path, request):
    return Bucket(spark, tmp_path, "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower())


def test_overwritten_and_old_files_reach_gold(store):
    store.put("a.csv", line(1, "O1", "12/1/2018"))
    store.put("b c.csv", line(2, "O2", "12/2/2018", "C2"))
    store.note(body("landing/a.csv"), body("landing/a.csv"), body("landing/b+c.csv"), body("other/x.csv"), body("landing/x.txt"))
    store.note(body("landing/a.csv")[:-4], "{}", '{"Records":[{}]}', body("landing/gone.csv"))
    batch = store.listen()
    assert [file.key for file in batch.files] == ["landing/a.csv", "landing/b c.csv"]
    assert (batch.malformed, [file.key for file in batch.missing]) == (2, ["landing/gone.csv"])

    store.put("a.csv", line(1, "O1", "12/1/2018", city="Oslo"), line(3, "O3", "12/3/2018"))
    store.put("old.csv", line(4, "O4", "12/4/2018", "C4"))
    long_ago = time.time() - 900 * 86_400
    os.utime(store.folder / "bucket" / "landing" / "old.csv", (long_ago, long_ago))
    store.note(body("landing/a.csv", "2"), body("landing/old.csv", "1F"), body("landing/b+c.csv"))
    batch = store.listen()
    # The copy of an earlier notification starts nothing.
    assert [file.key for file in batch.files] == ["landing/a.csv", "landing/old.csv"]
    assert store.silver("row_id", "city") == [(1, "Oslo"), (2, "Rome"), (3, "Rome"), (4, "Rome")]
    store.check_gold()


def test_order_and_notifications_without_a_sequencer(store, spark):
    for name in ("a.csv", "b.csv", "c.csv"):
        store.put(name, line(1, "O1", "12/1/2018", city=name))
    store.note(
        body("landing/c.csv", None, "2019-01-03T00:00:00.000Z"), body("landing/a.csv", "AA", "2019-01-04T00:00:00.000Z"),
        body("landing/b.csv", "1AA", "2019-01-04T00:00:00.000Z"), body("landing/c.csv", None, "2019-01-02T00:00:00.000Z"),
    )
    assert [file.key for file in store.listen().files] == ["landing/c.csv", "landing/a.csv", "landing/b.csv"]
    assert rows_of(spark.table(store.layers.silver.name).select("city")) == [("b.csv",)]
