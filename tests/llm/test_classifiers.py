"""Quality and language: held-out accuracy and odd rows."""

import brute
import numpy as np
import zlib

from stintlake.llm import langid, quality


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels)
    rows = found.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    good = [r["predicted"] for r in held if r["quality"] == 1]
    bad = [r["predicted"] for r in held if r["quality"] == 0]
    assert np.mean(good) >= 0.97 and (not bad or np.mean(bad) <= 0.4)
    assert found.count() == docs.count()


def test_quality_of_odd_rows(spark, tmpdir_path):
    docs = brute.stored(spark, brute.odd_rows(), f"{tmpdir_path}/d")
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (5, None), (None, 1), (6, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        found = quality.classify(docs, known).collect()
        assert len(found) == len(brute.odd_rows())
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_scores_do_not_depend_on_stretches(monkeypatch):
    rng = np.random.default_rng(0)
    net = quality.fit(["good words here. " * 20, "bad*** bad### " * 20] * 8, np.array([1.0, 0.0] * 8))
    texts = ["".join(chr(97 + x) for x in rng.integers(0, 26, 3000)), "bad*** bad### " * 300]
    before = quality.score_texts(texts, net)
    monkeypatch.setattr(quality, "STRETCH", quality.CHUNK // 2 * 3)
    assert np.allclose(before, quality.score_texts(texts, net), atol=1e-6) and before[0] > before[1]


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.98


def test_language_of_odd_rows(spark, tmpdir_path):
    rows = [(i, t, "en" if t else None) for i, t in brute.odd_rows()] + [(20, "123 ...", "en"), (21, "le la les un une des", "fr"), (22, "le la du", "fr"), (24, "la les", None)]
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d", "doc_id long, text string, lang string")
    found = langid.identify(docs).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    by = {r["doc_id"]: r for r in found}
    assert by[20]["lang_pred"] == by[2]["lang_pred"] == by[3]["lang_pred"] == "und" and by[24]["lang_pred"] == "fr"
    assert langid.identify(docs.limit(0)).count() == 0


def test_counts_do_not_depend_on_stretches(monkeypatch):
    text = "Les étés sont beaux, 12 fois. " * 40
    before = langid.counts(text)
    monkeypatch.setattr(langid, "STRETCH", 37)
    assert (langid.counts(text) == before).all()


def test_long_texts_are_learned_from(spark, tmpdir_path):
    """Of texts over the fitted length a stretch is fitted on; marks without a letter are no language."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:12]
    rows = [(i, ("le la les un une des " if k % 2 else "zyx wvu tsr qpo ") * 4000, "fr" if k % 2 else "xx") for k, i in enumerate(ids)]
    rows += [(300, "zyx wvu tsr", None), (301, "½ ² ³", "fr"), (302, "Ⅷ Ⅸ", "fr"), (303, "les une", None)] + [rows[0]] * 500
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d", "doc_id long, text string, lang string")
    by = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs).collect()}
    assert (by[300], by[301], by[302], by[303]) == ("xx", "und", "und", "fr")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    long = brute.stored(spark, [(i, t * 3) for i, t, _ in rows[:12]], f"{tmpdir_path}/q")
    assert quality.learn(long, labels) is not None
