"""Spelling variants: words one edit apart, found by a relational trie frontier.

The trie of all words is an edge table (node, next letter, child); a node is
the hash of its prefix, its depth the level. States (word, node, rest: the
word from its position on, edits) are joined with the edges of one level after
the other. Without an edit, a word stands at its own prefix; where another
edge leaves that node, it may replace its letter or take the edge as an
inserted letter. With the edit spent it follows its own letters. Two words one
edit apart part at one node, and the edit can be placed there, so no other
edits need be tried; deletions are the other word's insertions.

Two things keep the frontier small. Words go forward through a trie of the
words and backward through one of the reversed words, and edit in the second
half only: one of the two ways has the edit there. And an edge knows what lies
below it: the one rest there is (by hash), or the set of rests as 64 bits, so
a state goes on only where its rest can be. States end at a word's end, or as
soon as one word is left below; those pairs are compared letter by letter.

Words of over ``LONG`` code points would need as many levels. Pairs of them are
found at once, by joining the hashes of the word before and after the edit.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CRC32_SQL, crc32_sql, pick, stored, tidy
from .rolling import mix

RUN = "[A-Za-zÀ-ÿ]"
#: A word's least code points and occurrences; one run in so many loses a letter.
LEAST_LENGTH, LEAST_COUNT, MISSPELT = 7, 2, 31
#: A form has at least so many times the word's occurrences.
FACTOR = 10
#: Most code points, and so levels, of the frontier; pairs of longer words are joined by hashes.
LONG = 64


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) over all texts. Null texts have no run; a null doc_id counts as empty in the hash."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    # shorter runs make no word; a longest run of letters is one match
    runs = pick(docs, doc_id=doc_id, text=text).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(lower, F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc_id", "run"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(h % MISSPELT == 0, cut).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT))


def _both_ways(words: DataFrame) -> DataFrame:
    """word, n, s (the word forward or reversed), side, len, full (hash of s)."""
    s = F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))
    two = words.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    return two.select("word", "n", "side", s.alias("s"), F.length("word").alias("len")).withColumn("full", F.xxhash64("side", "s"))


def _half(n: Column) -> Column:
    """Least position of an edit that a word of n code points looks for on one side."""
    return F.floor((n - 1) / 2).cast("int")


def _prefix(d: int) -> Column:
    return F.xxhash64("side", F.substring("s", 1, d))


def _edges(words: DataFrame, d: int) -> DataFrame:
    """Edges from nodes of depth d: node, letter, child, and of the words below
    it: count, set of rests, whether one ends, one rest's hash and one word's."""
    below = words.filter((F.col("len") > d) & (_half(F.col("len")) <= d + 1))
    rest = F.xxhash64(F.substring("s", d + 2, LONG))
    below = below.select(_prefix(d).alias("node"), F.substring("s", d + 1, 1).alias("letter"), _prefix(d + 1).alias("child"),
                         rest.alias("suffix"), "full", (F.col("len") == d + 1).alias("ending"))
    return below.groupBy("node", "letter").agg(
        F.max("child").alias("child"), F.count(F.lit(1)).alias("below"), F.max("ending").alias("ends"),
        F.bit_or(F.expr("shiftleft(1L, CAST(pmod(suffix, 64) AS INT))")).alias("rests"), F.max("suffix").alias("suffix"), F.max("full").alias("other"))


def _can_be(rest: Column) -> Column:
    """The edge's words may have this rest."""
    h = F.xxhash64(rest)
    bit = F.call_function("getbit", F.col("rests"), F.pmod(h, F.lit(64)).cast("int"))
    return F.when(F.col("below") == 1, F.col("suffix") == h).otherwise(bit == 1)


def _short_pairs(words: DataFrame) -> list[DataFrame]:
    """(full, other) of words of up to LONG code points, level by level."""
    both = _both_ways(words.filter(F.length("word") <= LONG))
    longest = both.agg(F.max("len")).first()[0] or 0
    found, moved = [], None
    for d in range((LEAST_LENGTH - 1) // 2, longest):
        here = both.filter((F.col("len") >= d) & (_half(F.col("len")) <= d)).select(
            "full", _prefix(d).alias("node"), F.substring("s", d + 1, LONG).alias("rest"), F.lit(0).alias("edits"))
        states = here if moved is None else here.unionByName(moved)
        own, after = F.substring("rest", 1, 1), F.expr("substring(rest, 2)")
        # a replacement is looked for by the word with the smaller letter: the pair is one either way
        step = F.when(F.col("edits") == 1, own == F.col("letter")).otherwise((own != "") & (own < F.col("letter"))) & _can_be(after)
        insert = (F.col("edits") == 0) & (own != F.col("letter")) & _can_be(F.col("rest"))
        none = F.array().cast("array<string>")
        met = states.join(_edges(both, d).withColumnRenamed("node", "at"), (F.col("node") == F.col("at")) & (step | insert))
        out = met.select("full", "child", "below", "ends", "other", F.explode(F.concat(
            F.when(step, F.array(after)).otherwise(none), F.when(insert, F.array("rest")).otherwise(none))).alias("rest"))
        # one word below with this rest: found; else the word ends here, or the state goes on
        hit = F.when(F.col("below") == 1, F.col("other")).when((F.col("rest") == "") & F.col("ends"), F.col("child"))
        out = stored(out.select("full", "child", "rest", hit.alias("other")).filter("other IS NOT NULL OR rest <> ''"), f"spelling-level{d}")
        found.append(out.filter("other IS NOT NULL").select("full", "other"))
        moved = out.filter("other IS NULL").select("full", F.col("child").alias("node"), "rest", F.lit(1).alias("edits"))
    return found


def _long_keys(words: DataFrame) -> DataFrame:
    """Per long word and position p: hash of (length, p, what is before p, what
    is after) with the letter at p replaced, with it deleted, and with one
    more letter at p wanted. kind 0, 1, 2; letter is that at p."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for word, full in zip(pdf["word"], pdf["full"], strict=True):
                c = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
                n = len(c)
                i = np.arange(1, n + 1, dtype=np.uint64) << np.uint64(21)
                zero = np.zeros(1, np.uint64)
                before = np.concatenate([zero, np.bitwise_xor.accumulate(mix(c | i))])
                after = np.concatenate([np.bitwise_xor.accumulate(mix(~(c[::-1] | i)))[::-1], zero])
                p = np.arange(n + 1, dtype=np.uint64)

                def key(m: int, at, rest, before=before, p=p):
                    return mix(before[at] ^ mix(after[rest] + mix(p[at] + (np.uint64(m) << np.uint64(32)))))

                all_p, first = np.arange(n), np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
                for kind, at, k in ((0, all_p, key(n, all_p, all_p + 1)), (1, first, key(n - 1, first, first + 1)), (2, np.arange(n + 1), key(n, np.arange(n + 1), np.arange(n + 1)))):
                    letter = c[np.minimum(at, n - 1)].astype(np.int32) if kind == 0 else np.zeros(len(at), np.int32)
                    yield pd.DataFrame({"kind": kind, "key": k.view(np.int64), "letter": letter, "full": full})

    long = words.filter(F.length("word") >= LONG).select("word", F.xxhash64(F.lit(0), "word").alias("full"))
    return long.mapInPandas(tidy(run), "kind int, key bigint, letter int, full bigint")


def _long_pairs(words: DataFrame) -> list[DataFrame]:
    """(full, other) of words of LONG code points and more; a key's group has a
    word per letter at most."""
    keys = stored(_long_keys(words), "spelling-long")
    a = keys.filter("kind = 0").select("key", "letter", "full")
    b = a.select(F.col("key").alias("k"), F.col("letter").alias("l"), F.col("full").alias("other"))
    deleted = keys.filter("kind = 1").select(F.col("key").alias("k"), F.col("full").alias("other"))
    wanting = keys.filter("kind = 2").select("key", "full")
    return [a.join(b, (F.col("key") == F.col("k")) & (F.col("letter") < F.col("l"))).select("full", "other"),
            wanting.join(deleted, F.col("key") == F.col("k")).select("full", "other")]


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways round, of the words (word, n) that are
    one inserted, deleted or replaced code point apart."""
    found = [*_short_pairs(words), *_long_pairs(words)]
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    names = _both_ways(words).select("full", "word", "n")
    named = (pairs.distinct().join(names, "full")
             .join(names.select(F.col("full").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n")), "other")
             # hashes only propose: the words themselves decide
             .filter(F.levenshtein("word", "near", 1) == 1))
    way = F.explode(F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return named.select(way.alias("p")).select("p.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): every round doubles the length of the
    followed path, which a form's larger count bounds by a logarithm."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("w"), F.col("root").alias("further"))
        further = at.join(on, F.col("root") == F.col("w"), "left")
        if further.filter("w IS NOT NULL").isEmpty():
            return at
        at = stored(further.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: word, form (its near word of largest count if that is
    ``FACTOR`` times its own; of equals the smallest), root (where its forms
    end, itself without one), n, n_near, form_n."""
    words = stored(word_counts(docs, doc_id, text), "spelling-words")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fit = F.col("best.less") * -1 >= FACTOR * F.col("n")
    out = stored(words.join(near, "word", "left").select(
        "word", F.when(fit, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fit, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(out.filter("form IS NOT NULL"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql() -> str:
    """DuckDB SQL for ``variants`` over ``documents``."""
    code = "list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda s: CASE WHEN ord(s) < 128 THEN [ord(s)::BIGINT] ELSE [192 | (ord(s)::BIGINT >> 6), 128 | (ord(s)::BIGINT & 63)] END)"
    return f"""
WITH RECURSIVE {CRC32_SQL},
run AS (SELECT doc_id, run, count(*) AS m FROM
        (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{RUN}+')) AS run FROM documents)
        WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
hashed AS (SELECT run, m, {crc32_sql("bytes")} AS h FROM (SELECT run, m, flatten({code}) AS bytes FROM run), crc_table),
w AS (SELECT CASE WHEN h % {MISSPELT} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(m)::BIGINT AS n
      FROM hashed GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(m) >= {LEAST_COUNT}),
del AS (SELECT word, n, i, substr(word, i, 1) AS c, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
longer AS (SELECT DISTINCT w.word, w.n, del.word AS near, del.n AS near_n FROM w JOIN del ON del.d = w.word),
pair AS (SELECT word, near, near_n FROM longer UNION ALL SELECT near, word, n FROM longer
         UNION ALL SELECT a.word, b.word, b.n FROM del a JOIN del b ON a.d = b.d AND a.i = b.i AND a.c <> b.c),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM pair GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {FACTOR} * n THEN most END AS form_n,
             CASE WHEN most >= {FACTOR} * n THEN (SELECT min(near) FROM pair WHERE pair.word = w.word AND near_n = most) END AS form
      FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL
          UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL),
ended AS (SELECT chain.word, root FROM chain JOIN f ON f.word = root WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM f LEFT JOIN ended USING (word)"""
