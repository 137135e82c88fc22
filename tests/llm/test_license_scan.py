"""The license scan against a plain reading of its rules: no gates, and every pair of detections compared."""

from __future__ import annotations

import random
import re
from pathlib import Path

import duckdb
import pytest

from tillroll.llm import license_scan, queries
from tillroll.llm.license_rules import GRANT, TAG, rules

TINY = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(words):
    """(start, label) of every place of every phrase."""
    found = []
    for phrase, label in PHRASES.items():
        wanted = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted]
    return sorted(found)


def plain_rules(words):
    """(tier, start, end, rule, label) of every rule, ungated, after comparing every pair of detections."""
    spaced = "".join(f" {word}" for word in words) + " "
    found = []
    for number, rule in enumerate(rules()):
        for match in re.finditer(rule.pattern + "(?= )", spaced):
            start = spaced[: match.start()].count(" ")
            found.append((rule.tier, start, start + match[0].count(" "), number, rule.label))
    kept = []
    for one in sorted(found, key=lambda one: (one[0], one[1] - one[2], one[3], one[1])):
        tier, start, end, *_ = one
        inside = any(other[1] <= start and end <= other[2] for other in kept)
        around = any(start <= other[1] and other[2] <= end for other in kept)
        if not inside and not around:
            kept.append(one)
    return sorted((start, end, label, tier) for tier, start, end, _, label in kept)


def check(text):
    words = plain_words(text)
    n_words, found = license_scan.scan(text)
    assert n_words == len(words)
    assert sorted((one.start, one.label) for one in found if one.tier == license_scan.BASE) == plain_base(words)
    assert sorted((one.start, one.end, one.label, one.tier) for one in found if one.tier != license_scan.BASE) == plain_rules(words)
    assert 0 <= license_scan.score(found) <= 1
    return found


CITED = [
    ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
    ("Released under the MIT License.", {"mit"}),
    ("under the GNU General Public License, version 3.", {"gpl", "gpl-3.0"}),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", {"lgpl-2.1"}),
    ("GPLv2 or AGPL v3", {"gpl-2.0", "agpl-3.0"}),
    ("© 2020. All Rights Reserved.", {"reserved"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
    ("CC BY", {"cc-by"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", {"mit"}),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", {"bsd"}),
    ("dual licensed under the terms of the Mozilla Public License 2.0", {"mpl-2.0"}),
    ("This is free and unencumbered software released into the public domain", {"unlicense"}),
    ("mit dem Hund, the apache helicopter, a python, public licence fees", set()),
    ("ccby, general public licenses; all rights, reserved", {"reserved"}),
    (None, set()),
    ("", set()),
    ("...", set()),
]


@pytest.mark.parametrize(("text", "labels"), CITED)
def test_cited_licenses(text, labels):
    assert {one.label for one in check(text)} == labels


def test_hundreds_of_rules_by_priority():
    assert len(rules()) > 300 and len({(rule.label, rule.pattern) for rule in rules()}) == len(rules())
    assert [rule.tier for rule in rules()] == sorted(rule.tier for rule in rules())
    assert all(rule.gates and all(rule.gates) for rule in rules())


def test_random_texts_equal_the_plain_reading():
    """Words of the rules in random order make overlapping and nested detections; gates lose none."""
    rng = random.Random(7)
    pieces = [text for text, _ in CITED if text] + "the under license version v2 v3 2 0 1 or later gnu gpl lgpl cc by sa nc mit bsd".split()
    for _ in range(60):
        check(" ".join(rng.choice(pieces) for _ in range(rng.randrange(40))))


def test_given_texts_equal_the_plain_reading():
    for (text,) in duckdb.sql(f"SELECT text FROM '{TINY}/documents.parquet'").fetchall():
        check(text)


def test_a_better_rule_wins_and_the_base_stays():
    found = check("SPDX-License-Identifier: CC-BY-SA-4.0, licensed under CC BY-SA 4.0")
    assert [(one.label, one.tier) for one in found if one.tier] == [("cc-by-sa-4.0", TAG), ("cc-by-sa-4.0", GRANT)]
    assert [one.start for one in found if not one.tier] == [3, 10]


def test_a_very_long_text():
    _, found = license_scan.scan("lorem ipsum " * 200_000 + "All rights reserved. " * 20_000 + "MIT license")
    assert len(found) == 20_001 and found[0].start == 400_000 and found[-1].end == 460_002


def test_query_over_the_given_table(spark):
    rows = {row.doc_id: row for row in queries.queries()["op11_license_scan"](spark, str(TINY)).collect()}
    given = duckdb.sql(f"SELECT doc_id, text FROM '{TINY}/documents.parquet'").fetchall()
    assert len(rows) == len(given)
    for doc, text in given:
        words, row = plain_words(text), rows[doc]
        base = plain_base(words)
        starts = [start for start, _ in base]
        assert (row.n_words, row.n_base) == (len(words), len(base))
        assert (row.first_word, row.last_word) == (min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in base}))
        assert row.labels == ",".join(sorted({label for _, label in base} | {found[2] for found in plain_rules(words)}))


def test_columns_that_clash_and_rows_that_repeat(spark):
    rows = [("x", "Released under the MIT License.", 1)] * 2 + [(None, None, None), ("y", "", 2)]
    found = license_scan.find_licenses(spark.createDataFrame(rows, "score string, text string, `N_Words` int"))
    assert found.columns == ["score", "text", "N_Words", "n_words_", "score_", "detections"]
    assert sorted(row["n_words_"] for row in found.collect()) == [0, 0, 5, 5]
    assert license_scan.find_licenses(found.limit(0).select("text")).count() == 0
