"""Toxicity: held-out accuracy, long texts and odd rows."""

import zlib

import brute
import numpy as np

from stintlake.llm import toxicity


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.classify(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").filter("toxic IS NOT NULL").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    toxic, clean = ([r["predicted"] for r in rows if r["held_out"] and r["toxic"] == k] for k in (1, 0))
    assert len(toxic) > 50 and len(clean) > 400
    # few labels a language here; the rates grow with the labels (README)
    assert np.mean(toxic) >= 0.5 and np.mean(clean) <= 0.05, (np.mean(toxic), np.mean(clean))


def _model(spark):
    good = [(i, f"nice words here {i} and kind ones too " * (1 + i % 9), 0) for i in range(100)]
    bad = [(i, f"nice words {i} you zorgblat fool and kind ones " * (1 + i % 9), 1) for i in range(100, 180)]
    rows = spark.createDataFrame(good + bad, "doc_id long, text string, toxic int")
    return toxicity.learn(rows, rows)


def test_a_toxic_passage_in_a_long_text(spark):
    model = _model(spark)
    clean = "nice words here and kind ones too " * 3000
    scores = toxicity.score_texts([clean, clean[:50_000] + " nice words you zorgblat fool and kind ones " * 60 + clean[50_000:], None, "", clean], model)
    assert scores[1] >= 0.5 > scores[0] == scores[4] and scores[2] == scores[3] < 0.5


def test_places_do_not_depend_on_blocks(monkeypatch):
    text = "Ünicode and plain words, 12 of them. " * 400
    before = [np.sort(x).tolist() for x in toxicity.stretches(text)]
    monkeypatch.setattr(toxicity, "AT_ONCE", 1)
    assert before == [np.sort(x).tolist() for x in toxicity.stretches(text)] and len(before) == -(-(len(text) + 2) // 1000)
    slow = {hash_ for n in toxicity.SIZES for hash_ in _places("\n" + text.lower() + "\n", n)}
    assert {p for x in before for p in x} == slow


def _places(text, n):
    """The places of all n-grams, one by one in Python's integers."""
    mask = (1 << 64) - 1
    for i in range(len(text) - n + 1):
        h = 0
        for c in text[i:i + n]:
            h = (h * 0x9E3779B97F4A7C15 + ord(c)) & mask
        x = (h + n) & mask
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        yield (x ^ (x >> 31)) >> (64 - toxicity.BITS)


def test_ratios_count_every_labelled_text(spark):
    rows = [(1, "abcd", 1), (2, "abcx", 0), (3, "abcd abcd", 1), (4, None, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    ratio = toxicity.ratios(toxicity._counts(df))
    at = lambda s: next(_places(s, len(s)))
    assert np.isclose(ratio[at("abcd")], np.log((3 / 4) / (1 / 4))) and np.isclose(ratio[at("abc")], np.log((3 / 4) / (2 / 4)))
    assert toxicity._counts(df.filter("label = 1")) is None and toxicity._counts(df.limit(0)) is None


def test_odd_rows(spark, tmpdir_path):
    docs = brute.stored(spark, brute.odd_rows(), f"{tmpdir_path}/d")
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (5, None), (None, 1), (6, 1), (3, 0), (2, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 1")):
        found = toxicity.classify(docs, known).collect()
        assert len(found) == len(brute.odd_rows())
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert toxicity.classify(docs.limit(0), labels).count() == 0
