"""Licence scan and benchmark decontamination."""

import brute
import duckdb

from stintlake.llm import decontaminate, licenses, multiset_hash

ITEM = "If Tom has 12 apples and gives Anna 5 of them each week, how many apples does Tom have after 3 weeks of giving?"


def test_licenses_as_sql(spark):
    found = licenses.scan(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    c = duckdb.connect()
    c.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    assert sorted(map(tuple, found)) == sorted(c.sql(licenses.oracle_sql()).fetchall()) and found


def test_license_texts(spark, tmpdir_path):
    mit = "The MIT Licence\n\nCopyright (c) 2020 X\n\n" + "\n\n".join(licenses.TEXTS["MIT"]).replace(" the ", " the\n").replace("sublicense", "sub-licence")
    part = "\n\n".join(licenses.TEXTS["MIT"][:2])
    rows = brute.odd_rows() + [(11, mit), (12, part), (13, "\n\n".join(licenses.TEXTS["ISC"])), (14, "x\n// SPDX-License-Identifier: GPL-3.0\ny"),
                               (15, "Licensed under the Apache Licence, version 2.0!"), (15, "Licensed under the Apache Licence, version 2.0!"),
                               (None, "see\n\nreleased UNDER the MIT license"), (16, "MIT is a place; licensed under nothing")]
    found = licenses.scan(brute.stored(spark, rows, f"{tmpdir_path}/d")).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [
        (11, "MIT", "paragraph"), (13, "ISC", "text"), (14, "GPL-3.0", "line"), (15, "Apache-2.0", "text"), (None, "MIT", "paragraph")]))
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_headers(spark, tmpdir_path):
    rows = [(1, '# Copyright 2020 X\n#\n# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except\ncode'),
            (2, "/* This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as\n"
                " * published by the Free Software Foundation, either version 3 of the\n * License, or (at your option) any later version.\n *\n * more */"),
            (3, "\n\n".join(licenses.TEXTS["BSL-1.0"])), (4, "This program is free software: you can redistribute it")]
    found = licenses.scan(brute.stored(spark, rows, f"{tmpdir_path}/d")).collect()
    assert sorted((r["doc_id"], r["license_id"]) for r in found) == [(1, "Apache-2.0"), (2, "GPL-3.0"), (3, "BSL-1.0")]


def test_decontaminate_finds_every_passage(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    assert found == {(r["doc_id"], i) for r in docs.collect() for i, t in items if r["text"] and t in r["text"]}


def test_reparameterised_questions(spark, tmpdir_path):
    rows = brute.odd_rows() + [
        (11, "intro words. If Bob has 99 apples and gives Eve 7 of them each week, how many apples does Bob have after 4 weeks of giving? bye"),
        (12, "If Bob has 99 apples and gives Eve 7 of them each week, how many apples does Carl have after 4 weeks of giving?"),  # two names for one
        (13, "If Bob has 99 pears and sells Eve 7 of them"), (None, "so, " + ITEM), (14, ITEM + " " + ITEM), (14, ITEM + " " + ITEM)]
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "short one"), (4, ITEM.replace("Tom", "Sue").replace("12", "40"))], "item_id long, text string")
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d")
    found = decontaminate.contaminated(docs, bench).collect()
    assert sorted(str((r["doc_id"], r["item_id"], r["n_items"], r["same_values"])) for r in found) == sorted(
        map(str, [(11, 1, 2, False), (None, 1, 2, True), (14, 1, 2, True)]))
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 4
    for d, b in ((docs.limit(0), bench), (docs, bench.limit(0))):
        assert decontaminate.contaminated(d, b).count() == 0


def test_items_with_other_equal_slots_are_other_templates(spark, tmpdir_path):
    numbers = "so Tom bought {} apples and {} pears at the market and carried them home in a large bag"
    names = "today {} bought some apples at the market and later {} carried all of them home in a large bag"
    items = [(1, numbers.format(2, 2)), (2, numbers.format(3, 4)), (3, names.format("Tom", "Tom")), (4, names.format("Tom", "Anna"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = brute.stored(spark, [(i, "intro, " + t) for i, t in items], f"{tmpdir_path}/d")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert {(i, i) for i, _ in items} <= found and decontaminate.clean(docs, bench).count() == 0


def test_items_with_few_windows_of_words(spark, tmpdir_path):
    sums = "Add 12 34 56 78 90 and 11 22 33 44 55 then say what the total of all these is"  # some windows have enough words
    digits = "7 1 8 2 8 1 8 2 8 4 5 9 0 4 5 2 3 5 3 6 0 2 8 7 4 7 1 3 5 2 6 6 2 4 9 7"  # no window has
    start = "What is the name of the river that runs there"  # 10 tokens
    items = [(1, sums), (2, digits), (3, start), (4, "Who wrote the old red book?"), (5, digits[:-1] + "8"), (6, "???")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "so, " + sums), (2, "see " + digits + " 7"), (3, "Question: " + start + "? No"), (4, "Asked: who wrote\nthe old red book"),
            (5, digits[2:]), (6, "Who wrote the old blue book?"), (7, "x " + digits[:40] + " and " + digits[40:]), (8, digits + " " + digits[:-1] + "8")]
    docs = brute.stored(spark, rows + brute.odd_rows()[:3], f"{tmpdir_path}/d")
    assert {r["doc_id"] for r in decontaminate.contaminated(docs, bench).collect()} == {1, 2, 3, 4, 8}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, bench).collect() if r["doc_id"]) == [1, 5, 6, 7]


def test_names_at_sentence_starts_and_repeated_numbers(spark, tmpdir_path):
    short = "Tom has 12 apples. Anna has 5 pears. How many do they have?"
    twice = "he bought 2 apples and 2 pears at the market and carried them home in a large bag"
    start = "What is the total weight of 3 red apples and 4 green pears in the bag"
    bench = spark.createDataFrame([(1, short), (2, twice), (3, start)], "item_id long, text string")
    rows = [(1, "intro. Bob has 7 apples. Eve has 9 pears. How many do they have? bye"), (2, "so " + twice.replace("2 apples", "3 apples").replace("2 pears", "5 pears")),
            (3, "Question: " + start.replace("3", "8")), (4, "Bob has 7 apples. How has 9 pears. How many do they have?"),  # one name for two
            (5, "Bob had 7 apples. Eve had 9 pears. How many do they have?"), (6, "so, " + short.lower())]
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d")
    found = {(r["doc_id"], r["item_id"], r["same_values"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {(1, 1, False), (2, 2, False), (3, 3, False), (6, 1, True)}


def test_shuffled_join_gives_the_same(spark, tmpdir_path, monkeypatch):
    docs = brute.stored(spark, [(1, "so, " + ITEM), (2, "clean")], f"{tmpdir_path}/d")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert [r["doc_id"] for r in decontaminate.contaminated(docs, bench).collect()] == [1]


def test_long_texts_by_pieces_and_texts_of_hits_only(spark, tmpdir_path, monkeypatch):
    """Windows and whole items that lie over the border of two pieces are
    found once each; texts without a hit don't cross the network, unless the hits are many."""
    whole = "Who wrote the old red book?"
    bench = spark.createDataFrame([(1, ITEM), (2, whole)], "item_id long, text string")
    rows = [(k, "word " * k + ITEM + " so it goes, and now. " + whole + " end" * k) for k in range(24)] + [(50, ITEM + " " + ITEM), (51, "clean " * 90), (52, "")]
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d")
    want = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    assert {r[0] for r in want} == {*range(24), 50} and len(want) == 49
    monkeypatch.setattr(decontaminate, "PIECE", 16)
    found = decontaminate.contaminated(docs, bench)
    assert sorted(map(tuple, found.collect())) == want and "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(decontaminate, "BROADCAST_TEXTS", 0)
    found = decontaminate.contaminated(docs, bench)
    assert sorted(map(tuple, found.collect())) == want and "LeftSemi" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_many_like_runs_do_not_wrap(spark):
    """Lanes hold the sums of a text of 150,000 like runs; the likeness is that of the shared runs."""
    rows = spark.createDataFrame([(2, "a " * 600_000), (1, "b " * 600_000)], "doc_id long, text string")
    near = [r["near_edited"] for r in multiset_hash.with_edited(rows).collect()]
    # of each text two thirds are left: |a - b|^2 / (|a|^2 + |b|^2) with a third exchanged
    assert all(0.85 <= x <= 0.98 for x in near), near


def test_shared_stems_and_everyday_words(spark, tmpdir_path):
    """A stem that a series of items shares tells nothing; an item of one word isn't looked for."""
    stem = "a train leaves the station at noon and travels along the coast for several hours until it"
    tails = [f"{a} {b}" for a in ("reaches", "passes", "leaves", "misses") for b in ("town", "port", "bridge", "tunnel", "forest")]
    items = [(i, f"{stem} {t} where the {t.split()[1]} guard waits for all of them") for i, t in enumerate(tails)] + [(50, "the"), (51, "train station")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "I know that " + stem + " stops."), (2, "so " + items[7][1]), (3, "the train station is the place"), (4, "clean words only")]
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()} == {(2, 7)}
    assert sorted(tuple(r) for r in decontaminate.too_short(bench).collect()) == [(50, 1), (51, 2)]
