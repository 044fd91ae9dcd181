"""The pipeline's stages, each against a brute-force version on what its predecessor kept."""

import brute
import corpus_pipeline as P
import public_tokenizers
from tokenizers import Tokenizer

from stintlake.llm import quality
from stintlake.llm.common import stored, table


def test_stages(spark):
    sf = brute.SF
    docs = table(spark, sf, "documents")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark_free", "tokens"]
    net = quality.learn(docs, table(spark, sf, "labels"))
    items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for name, stage in P.STAGES:
        before = [tuple(r) for r in docs.select(*P.COLUMNS).orderBy("doc_id").collect()]
        docs = stored(stage(spark, docs, sf), name)
        after = sorted(map(tuple, docs.collect()))
        texts = [(i, t) for i, t, *_ in before]
        if name == "quality":
            scores = quality.score_texts([t for _, t in texts], net)
            expected = [r for r, s in zip(before, scores) if s >= quality.CUT]
        elif name == "near_duplicates":
            expected = [r for r, (i, c, _, _) in zip(before, brute.jaccard(texts)) if i == c]
        elif name == "repeated_passages":
            expected = []
            for r, (_, n, gone, kept) in zip(before, brute.substring(texts)):
                if not n or gone < n:
                    expected.append((r[0], r[1] if not gone else kept.decode(), r[2], r[3]))
        elif name == "benchmark_free":
            expected = [r for r in before if not any(t in r[1] for t in items)]
        else:
            expected = []
            for i, t in texts:
                ids = tok.encode(t, add_special_tokens=False).ids
                expected.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(tok.decode(ids, skip_special_tokens=False))))
        if name == "repeated_passages":  # the words that are left, between white space of the text
            texts = dict(texts)
            assert all(t in texts[i] or t.split() != texts[i].split() for i, t, *_ in after) and all(r[4] == len(r[1]) for r in after)
            after, own = [(i, " ".join(t.encode().decode().split()) if t != texts[i] else t, *r[:2]) for i, t, *r in after], after
            assert any("\n" in t for i, t, *_ in own if t != texts[i])
        assert after == sorted(expected), name


def test_run_and_registration(spark):
    import __spark_entry__ as E

    names = E.queries()
    assert sum(n.startswith("op") and n[2:].split("_")[0].isdigit() for n in names) == 13 and names["pipeline"] is P.run
    assert P.run(spark, brute.SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
