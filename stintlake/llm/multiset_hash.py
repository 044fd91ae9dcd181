"""Document fingerprints: a homomorphic multiset hash, in DataFrame functions.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to
a wide vector, and a fingerprint is the sum of these vectors, lane by lane,
modulo powers of two. So the order of paragraphs doesn't matter, the
fingerprint of a text with a paragraph more (or less) is the sum (or
difference) of two fingerprints, and equal multisets have equal fingerprints.

A paragraph's vector has two parts:

* ``EQUAL`` lanes modulo 2**32 hashed from the whole paragraph;
* ``SIGNS`` lanes modulo 2**40, the sum of +1/-1 vectors hashed from its runs
  of up to ``RUN`` words. The squared length of a difference of two such sums
  estimates how many runs the texts don't share, which gives ``likeness``.

A fingerprint is an array<bigint> of EQUAL + SIGNS lanes. Null texts count as
empty; the empty text is one empty paragraph.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stored

#: Lanes of either part, words of a run.
EQUAL, SIGNS, RUN = 8, 128, 4
#: Modulus of the signed lanes: no text has half as many runs.
WIDE = 1 << 40
_MOD = [1 << 32] * EQUAL + [WIDE] * SIGNS


def _lanes() -> list[Column]:
    """Sums over rows (paragraph's hash once a paragraph, else null; hash of a run or null)."""
    out = []
    for i in range(EQUAL):
        word = F.xxhash64(F.lit(i // 2), F.col("para"))
        half = F.shiftrightunsigned(word, 32) if i % 2 else word.bitwiseAND(F.lit(0xFFFFFFFF))
        out.append(F.coalesce(F.sum(F.when(F.col("first"), half)), F.lit(0)).alias(f"e{i}"))
    for i in range(SIGNS):
        bit = F.shiftrightunsigned(F.col(f"run{i // 64}"), i % 64).bitwiseAND(F.lit(1).cast("long"))
        out.append(F.coalesce(F.sum(bit * 2 - 1), F.lit(0)).alias(f"s{i}"))
    return out


def fingerprints(df: DataFrame, keys: list[str], text: str, name: str = "fingerprint") -> DataFrame:
    """One row per row of ``df`` (``keys`` must tell its rows apart): keys and
    the fingerprint. Where ``df`` is already dealt by some of the keys,
    nothing is shuffled."""
    lines = df.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line"))
    lines = lines.select(*keys, F.xxhash64("line", F.length("line")).alias("para"), "line")
    runs = lines.select(*keys, "para", F.posexplode_outer(
        F.regexp_extract_all("line", F.lit(r"(?:\S+\s*){1,%d}" % RUN), F.lit(0))).alias("at", "run"))
    runs = runs.select(*keys, "para", (F.coalesce("at", F.lit(0)) == 0).alias("first"),
                       *[F.when(F.col("run").isNotNull(), F.xxhash64(F.lit(64 + i), F.rtrim("run"))).alias(f"run{i}") for i in range(SIGNS // 64)])
    sums = runs.groupBy(*keys).agg(*_lanes())
    # the low bits of a sum are it modulo a power of two, also below zero
    lanes = [F.col(f"e{i}").bitwiseAND(F.lit((1 << 32) - 1)) for i in range(EQUAL)] + [F.col(f"s{i}").bitwiseAND(F.lit(WIDE - 1)) for i in range(SIGNS)]
    return sums.select(*keys, F.array(*lanes).alias(name))


def _mods() -> Column:
    return F.array(*[F.lit(m).cast("long") for m in _MOD])


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the two texts' paragraphs together."""
    return F.zip_with(F.zip_with(a, b, lambda x, y: x + y), _mods(), lambda x, m: F.pmod(x, m))


def remove(a: Column, b: Column) -> Column:
    """Fingerprint of what is left of a's paragraphs without b's."""
    return F.zip_with(F.zip_with(a, b, lambda x, y: x - y), _mods(), lambda x, m: F.pmod(x, m))


def to_text(a: Column) -> Column:
    """The lanes as hexadecimal digits."""
    digits = lambda part, n: F.array_join(F.transform(part, lambda x: F.lpad(F.hex(x), n, "0")), "")
    return F.lower(F.concat(digits(F.slice(a, 1, EQUAL), 8), digits(F.slice(a, EQUAL + 1, SIGNS), 10)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else an estimate of the share of
    runs in both, from the squared lengths of a, b and a - b."""
    def length(x: Column) -> Column:
        signed = F.transform(F.slice(x, EQUAL + 1, SIGNS), lambda v: F.pmod(v + WIDE // 2, F.lit(WIDE)) - WIDE // 2)
        return F.aggregate(signed, F.lit(0).cast("double"), lambda s, v: s + v.cast("double") * v)

    both = length(a) + length(b)
    near = F.when(both > 0, 1 - length(F.zip_with(a, b, lambda x, y: x - y)) / both).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0)))


#: A text among the documents: its id (0 if null), whether the id is null, the text's hash.
_KEY = ["id", "no_id", "h"]


def _before(texts: DataFrame) -> DataFrame:
    """Per key, the key (to_*) and length (to_n) of the text before it in
    descending doc_id order, round the end. Null ids come last; texts of one
    id are ordered by hash. Only keys and lengths move: they are dealt by
    ranges and windowed within a range, and the ranges' ends, a row each, are
    joined on."""
    order = [F.col("no_id"), F.col("id").desc(), F.col("h")]
    ids = texts.groupBy(*_KEY).agg(F.max(F.length("text").cast("long")).alias("n"))
    ids = stored(ids.repartitionByRange(*order).withColumn("p", F.spark_partition_id()), "fingerprint-order")
    row = F.struct(*_KEY, "n")
    w = Window.partitionBy("p").orderBy(*order)
    ids = ids.withColumn("before", F.lag(row).over(w)).withColumn("ends", F.lead("h").over(w).isNull())
    ends = ids.filter("ends").select("p", row.alias("own"))
    end = ends.orderBy(F.col("p").desc()).limit(1).collect()  # the last key of all
    last = F.struct(*[F.lit(end[0]["own"][c] if end else None).cast(ids.schema[c].dataType).alias(c) for c in [*_KEY, "n"]])
    ends = ends.select("p", F.lag("own").over(Window.orderBy("p")).alias("end_before"))
    found = ids.join(ends, "p").withColumn("to", F.coalesce("before", "end_before", last))
    return stored(found.select(*_KEY, *[F.col(f"to.{c}").alias(f"to_{c}") for c in [*_KEY, "n"]]), "fingerprint-before")


def with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    The edited text: the last floor(n/3) code points replaced by the first as
    many (or all) of the next document, in descending doc_id order, after the
    last the first. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, one row per row of ``docs``.
    Rows that share doc_id and text are handled once: all but the last have
    their like as the next document. A single row is its own next document.

    Texts are dealt once, by key; from there each text sends the one before it
    the head that its edit needs, and its fingerprint.
    """
    d = pick(docs, doc_id=doc_id, text=text).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("id", "no_id", F.xxhash64("text").alias("h"), "text")
    # the filter (always true) makes every use need the same columns, so that texts are shuffled once for all of them
    own = d.groupBy(*_KEY).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")).filter("copies > 0")
    before = _before(d)
    to = [F.col(f"to_{c}").alias(c) for c in _KEY]
    heads = own.join(before, _KEY).select(*to, F.expr("substring(text, 1, cast(to_n div 3 as int))").alias("head"))
    cut = F.expr("cast(length(text) div 3 as int)")
    kept = F.expr("substring(text, 1, length(text) - cast(length(text) div 3 as int))")
    like = F.struct(F.lit(False).alias("same"), F.lit(1).cast("long").alias("rows"), F.concat(kept, "head").alias("edited"))
    same = F.struct(F.lit(True).alias("same"), (F.col("copies") - 1).alias("rows"), F.concat(kept, F.substring("text", F.lit(1), cut)).alias("edited"))
    edits = own.join(heads, _KEY).select(*_KEY, F.length("text").cast("long").alias("n_chars"),
                                         F.explode(F.when(F.col("copies") > 1, F.array(like, same)).otherwise(F.array(like))).alias("e"))
    edits = edits.select(*_KEY, "n_chars", "e.*").withColumn("edited_sha256", F.sha2("edited", 256))
    prints = fingerprints(own, _KEY, "text", "own_print")
    sent = prints.join(before, _KEY).select(*to, F.col("own_print").alias("next_print"))
    found = (fingerprints(edits, [*_KEY, "n_chars", "same", "rows", "edited_sha256"], "edited", "edited_print")
             .join(prints, _KEY).join(sent, _KEY))
    return found.select(
        F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", to_text(F.col("own_print")).alias("fingerprint"),
        to_text(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("own_print"), F.col("edited_print")).alias("near_edited"),
        F.when(F.col("same"), F.lit(1.0)).otherwise(likeness(F.col("own_print"), F.col("next_print"))).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("row")).drop("row")
