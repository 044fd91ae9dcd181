"""Conversation prefix trie, rolled up in depth bands.

A conversation is its rebuilt turns; a node of depth d is a distinct sequence
of first d turns, known by the XOR of position-salted 64-bit hashes (two
lanes). Prefix hashes of a conversation are a running XOR, scanned block by
block, so that no task holds a long conversation whole.

Totals over subtrees go up by depth bands of ``BAND`` levels. Within a band
every node explodes to its ancestors of that band only, and sums with
map-side combining make its part of the total. The bands' roots form a tree
that is ``BAND`` times flatter; it is rolled up in the same way, and the
completed totals of its nodes go to the ancestors in the band above them. So a
node explodes to ``BAND`` ancestors at most, and the number of rounds grows with
the logarithm of the largest depth.

Rules for odd rows: null role and text are empty; turns alike in number are
taken in the order of role and text, and repeated rows are turns of their own;
rows without a conv_id belong to no conversation and make no node; an empty
table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import numbered
from ..operators.windows import prefix_scan, scan_levels
from .common import CRC32_SQL, crc32_sql, pick, small_batches, stored, tidy

#: Levels of a band; a node explodes to so many ancestors at most.
BAND = 4
#: Turns of a conversation that one window holds.
BLOCK = 1024
#: Conversations that share a head: the ids from one multiple of this to the next.
FAMILY, MOST_SHARED = 20, 3
#: Conv_ids of one packed row (a range of 2^PACK ids) of a node's ends.
PACK = 12
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["q", "ka", "kb"]


def rebuilt(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, p from 1, x, y: digest, words, ends: the last
    one) and conversations (conv_id, length). A conversation takes the first h
    turns of its family's first conversation, then its own after its first h."""
    small_batches(convs.sparkSession)
    d = (pick(convs, conv_id=conv_id, turn=turn, role=role, text=text).filter("conv_id IS NOT NULL")
         .select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    own = numbered(d, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "j", keep={
        "conv_id": F.col("conv_id"), "x": F.xxhash64("role", "text"), "y": F.xxhash64("text", F.lit("turn"), "role"),
        "words": F.regexp_count("text", F.lit(WORD)).cast("long")})
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    n = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns({"base": base, "h": F.crc32(F.col("conv_id").cast("string")) % (MOST_SHARED + 1)})
    first = n.filter("conv_id = base").select("base", F.col("n").alias("base_n"))
    conv = n.join(first, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))
    conv = stored(conv.select("conv_id", "base", "h", "m", (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-convs")
    # at most FAMILY conversations ask for the head of one
    heads = own.filter(f"conv_id % {FAMILY} = 0 AND j <= {MOST_SHARED}").select(F.col("conv_id").alias("base"), F.col("j").alias("p"), "x", "y", "words")
    asked = conv.filter("m > 0").select("conv_id", "base", "length", F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("p")).join(heads, ["base", "p"])
    # the join side with the rows of a long conversation is split by AQE where it is skewed
    rest = own.join(conv.select("conv_id", "h", "m", "length"), "conv_id").filter("j > h").withColumn("p", F.expr("m + j - h"))
    cols = ["conv_id", "p", "x", "y", "words", (F.col("p") == F.col("length")).alias("ends")]
    return asked.select(*cols).unionByName(rest.select(*cols)), conv.select("conv_id", "length")


def _paths(turns: DataFrame, conv: DataFrame, longest: int) -> DataFrame:
    """conv_id, q (depth, from 0), ka, kb (prefix hash), words (of the last turn), ends."""
    salted = turns.select("conv_id", F.col("p").alias("q"), "words", "ends", F.xxhash64("p", "x", "y").alias("a"), F.xxhash64("y", "p", "x").alias("b"))
    found = prefix_scan(salted, "conv_id", "q", {"ka": "a", "kb": "b"}, "xor", True, BLOCK, scan_levels(longest + 1, BLOCK))
    zero = F.lit(0).cast("long")
    root = conv.select("conv_id", zero.alias("q"), zero.alias("words"), (F.col("length") == 0).alias("ends"), zero.alias("ka"), zero.alias("kb"))
    return found.select(*root.columns).unionByName(root)


def _with_ancestors(paths: DataFrame) -> DataFrame:
    """Every row of ``paths`` but the root's, with ``up``: the nodes above it
    back to the root of its band, topmost first; a band's root gets those of
    the band above. A group is the piece of one conversation in one band."""
    bands = F.expr(f"CASE WHEN q % {BAND} = 0 AND q > 0 THEN array(q div {BAND}, q div {BAND} - 1) ELSE array(q div {BAND}) END")
    rest = [c for c in paths.columns if c not in ("conv_id", *KEY)]
    piece = (paths.select("*", F.explode(bands).alias("band")).groupBy("conv_id", "band")
             .agg(F.sort_array(F.collect_list(F.struct(*KEY, *rest))).alias("piece")))
    one = piece.select("conv_id", "piece", F.posexplode("piece").alias("i", "node")).filter("i > 0")
    up = F.transform(F.slice("piece", F.lit(1), F.col("i")), lambda x: F.struct(*[x[c].alias(c) for c in KEY]))
    return one.select("conv_id", *[F.col(f"node.{c}").alias(c) for c in (*KEY, *rest)], up.alias("up"))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _totals(paths: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """Sums of leaves and saved over the subtree of every node (q, ka, kb).
    ``nodes`` has q, ka, kb, up, leaves, saved; ``paths`` conv_id, q, ka, kb."""
    inside = nodes.filter(f"q % {BAND} <> 0").select(F.explode("up").alias("k"), "leaves", "saved").select("k.*", "leaves", "saved")
    own = _summed(inside.unionByName(nodes.select(*inside.columns)))
    if deepest < BAND:
        return own
    own = stored(own, "trie-band")
    flat = F.expr(f"q div {BAND}").alias("q")
    roots = f"q % {BAND} = 0"
    above = stored(paths.filter(roots).select("conv_id", flat, "ka", "kb"), "trie-roots")
    tops = above.transform(_with_ancestors).groupBy(*KEY).agg(F.max("up").alias("up"))
    met = own.filter(roots).select(flat, "ka", "kb", "leaves", "saved").join(tops, KEY, "left")
    done = stored(_totals(above, met, deepest // BAND), "trie-done").withColumn("q", F.col("q") * BAND)
    # a band's root is complete; the others of the band above it still lack its total
    handed = (done.join(nodes.filter(roots).select(*KEY, "up"), KEY).filter("size(up) > 1")
              .select(F.explode(F.slice("up", 2, BAND)).alias("k"), "leaves", "saved").select("k.*", "leaves", "saved"))
    return _summed(own.filter(f"NOT {roots}").unionByName(handed)).unionByName(done.select(*KEY, "leaves", "saved"))


def _ends(paths: DataFrame) -> DataFrame:
    """ends_sha256 per node with ends. Ids are packed by ranges first; a node's
    packs then run through one digest in order, a batch at a time."""
    packs = (paths.filter("ends").groupBy(*KEY, F.shiftright("conv_id", PACK).alias("pack"))
             .agg(F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("ids")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, digest = None, None
        for pdf in frames:
            out = []
            for q, ka, kb, ids in zip(pdf["q"], pdf["ka"], pdf["kb"], pdf["ids"], strict=True):
                if at != (q, ka, kb):
                    if at:
                        out.append((*at, digest.hexdigest()))
                    at, digest = (q, ka, kb), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if at:
            yield pd.DataFrame([(*at, digest.hexdigest())], columns=[*KEY, "ends_sha256"])

    return (packs.repartition(*KEY).sortWithinPartitions(*KEY, "pack").select(*KEY, "ids")
            .mapInPandas(tidy(run), "q bigint, ka bigint, kb bigint, ends_sha256 string"))


def trie(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per node: conv_id (its smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, conv = rebuilt(convs, conv_id, turn, role, text)
    longest, least = conv.agg(F.max("length"), F.min("conv_id")).first()
    paths = stored(_paths(turns, conv, longest or 0), "trie-paths")
    zero = F.lit(0).cast("long")
    members = [F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words")]
    below = _with_ancestors(paths.select("conv_id", *KEY, "words")).groupBy(*KEY).agg(*members, F.max("up").alias("up"))
    root = paths.filter("q = 0").groupBy(*KEY).agg(*members).withColumn("up", F.lit(None).cast(below.schema["up"].dataType))
    nodes = stored(below.unionByName(root), "trie-nodes")
    over = F.element_at("up", -1)
    kids = nodes.filter("q > 0").groupBy(*[over[c].alias(c) for c in KEY]).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(kids, KEY, "left").na.fill(0, ["n_children"]).withColumns({
        "leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-nodes")
    totals = _totals(paths.select("conv_id", *KEY), nodes.select(*KEY, "up", "leaves", "saved"), longest or 0)
    # a node of depth 1 has the root above it, whose smallest member is known; a
    # popular node further down is one row of this join, and AQE splits its children
    parents = nodes.filter("n_children > 0 AND q > 0").select(*[F.col(c).alias(f"p_{c}") for c in KEY], F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.filter("q > 1").join(parents, [over[c] == F.col(f"p_{c}") for c in KEY])
    high = nodes.filter("q <= 1").withColumn("parent_conv_id", F.when(F.col("q") == 1, F.lit(least).cast("long")))
    cols = [*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children"]
    found = deep.select(*cols).unionByName(high.select(*cols)).join(totals, KEY).join(_ends(paths), KEY, "left")
    return found.select("conv_id", F.col("q").alias("depth"), "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def oracle_sql() -> str:
    """DuckDB SQL for ``trie`` over ``conversations``; a node is the joined digests of its turns."""
    return rf"""
WITH {CRC32_SQL},
own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS j,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
               len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS words FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n, c - c % {FAMILY} AS base FROM own GROUP BY c),
hashed AS (SELECT n.*, {crc32_sql("bytes")} % {MOST_SHARED + 1} AS h FROM (SELECT *, list_transform(string_split(c::VARCHAR, ''), lambda s: ord(s)::BIGINT) AS bytes FROM n) n, crc_table),
conv AS (SELECT a.c, a.base, a.h, least(a.h, coalesce(b.n, 0)) AS m, a.n FROM hashed a LEFT JOIN n b ON b.c = a.base),
turns AS (SELECT conv.c, j AS p, x, words FROM conv JOIN own ON own.c = base AND j <= m
          UNION ALL SELECT conv.c, m + j - h, x, words FROM conv JOIN own ON own.c = conv.c AND j > h),
path AS (SELECT c, p, words, string_agg(x, '') OVER (PARTITION BY c ORDER BY p ROWS UNBOUNDED PRECEDING) AS k FROM turns
         UNION ALL SELECT c, 0, 0, '' FROM conv),
node AS (SELECT k, any_value(p) AS p, count(*) AS n_convs, min(c) AS c, any_value(words) AS words FROM path GROUP BY k),
kids AS (SELECT substr(k, 1, length(k) - 32) AS k, count(*) AS n_children FROM node WHERE p > 0 GROUP BY 1),
every AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (k)),
total AS (SELECT k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM
          (SELECT n_children, (n_convs - 1) * words AS saved, substr(k, 1, 32 * unnest(range(p + 1))) AS k FROM every) GROUP BY k),
last AS (SELECT c, max(p) AS p FROM path GROUP BY c),
ends AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends_sha256 FROM path JOIN last USING (c, p) GROUP BY k)
SELECT e.c AS conv_id, e.p::BIGINT AS depth, up.c AS parent_conv_id, e.n_convs, e.n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM every e JOIN total USING (k) LEFT JOIN ends USING (k) LEFT JOIN node up ON e.p > 0 AND up.k = substr(e.k, 1, length(e.k) - 32)
"""
