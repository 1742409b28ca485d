"""Document fingerprints by consistent weighted sampling, in SQL functions only.

A text's terms are its words, each with the word before it; a term's weight is
how often it occurs. Weights are whole numbers, so a term of weight w stands
for the units (term, 0) to (term, w - 1), each of weight one. Each of the
``SAMPLES`` samples hashes every unit anew and keeps the least: the sample lies
under a term with a probability in proportion to its weight, and two weighted
sets have the same sample with the probability of their generalised Jaccard
similarity (sum of lesser weights by sum of greater ones), whatever the weights.
The share of equal samples estimates the similarity.

``signature`` is one expression for a text. ``compare_edited`` needs the
samples of two texts that share most units, so it deals the units out as rows
(common ones once) and takes the least hashes by an aggregate, inside the
ranges in which the documents are ordered anyway, without a further shuffle.
``let`` binds a value by a lambda, so that no part is computed twice.

Edge cases: a null or empty text, or one of blanks, has the empty fingerprint;
two empty fingerprints have likeness 1, an empty and another one 0; a null id
sorts below all others; rows of equal ids follow each other in order of their
texts; a single document is its own next one; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benelake.llm.tables import free_name, partitions

SAMPLES = 128  # at most 128
_IDS = 24  # bits of a sample's identity
RANGE_BYTES = 32 << 20  # text of a range of ids that one task orders


def let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _seed(k: int) -> int:
    """The constant of sample ``k``: spread over 64 bits, signed."""
    x = (k + 1) * 0x9E3779B97F4A7C15 % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return (x ^ x >> 31) - 2**63


def _units(column: str) -> str:
    """The hashes of a text's units, all different."""
    words = f"filter(split(coalesce({column}, ''), '[ \t\n\x0b\f\r]+'), w -> w <> '')"
    hashes = f"transform({words}, w -> xxhash64(w))"
    terms = "sort_array(transform(h, (x, i) -> xxhash64(x, if(i = 0, 0L, h[i - 1]))))"
    starts = "filter(transform(s, (x, i) -> if(i > 0 and x = s[i - 1], -1, i)), i -> i >= 0)"
    several = "transform(sequence(0, coalesce(get(p, k + 1), size(s)) - i - 1), j -> if(j = 0, s[i], xxhash64(s[i], j)))"
    body = f"if(size(p) = size(s), s, flatten(transform(p, (i, k) -> if(coalesce(get(p, k + 1), size(s)) = i + 1, array(s[i]), {several}))))"
    for name, value in (("p", starts), ("s", terms), ("h", hashes)):
        body = let(name, value, body)
    return body


def _samples(least: str) -> str:
    """The least hash of each sample as integers, sample * 2**24 + identity."""
    return f"transform({least}, (e, i) -> cast(shiftleft(cast(i as bigint), {_IDS}) + (e & {(1 << _IDS) - 1}L) as int))"


def signature(column: str, samples: int = SAMPLES) -> Column:
    """The samples of a text as sorted integers, sample * 2**24 + identity."""
    seeds = f"array({', '.join(f'{_seed(k)}L' for k in range(samples))})"
    least = f"transform({seeds}, c -> array_min(transform(u, e -> xxhash64(e ^ c))))"
    return F.expr(let("u", _units(column), f"if(size(u) = 0, cast(array() as array<int>), {_samples(least)})"))


def fingerprint(samples: str) -> Column:
    """A signature as text, eight hex digits for each sample."""
    return F.expr(f"array_join(transform({samples}, e -> lpad(lower(hex(e)), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Share of equal samples; of an empty and another signature 0."""
    return F.expr(f"if(size({a}) + size({b}) = 0, 1D, size(array_intersect({a}, {b})) / cast(greatest(size({a}), size({b}), 1) as double))")


def with_next(docs: DataFrame, columns: list[str], id_column: str = "doc_id", place: tuple[str, str, str] | None = None) -> DataFrame:
    """``docs`` with ``next_<name>`` for each of ``columns``: that of the row
    with the next smaller id (after the last: of the first). Ties follow the
    first of ``columns``, downwards; it has no nulls.

    Ids are dealt into ranges of about equal size, each ordered by one task;
    the last row of a range takes the first of the next range. ``place`` names
    columns for a row's range, its number in it, and whether it is the last."""
    spark = docs.sparkSession
    key, part = free_name(docs, "order_key"), free_name(docs, "order_part")
    lowest = -(2**63)
    keyed = docs.withColumn(key, F.coalesce(F.col(id_column).cast("long"), F.lit(lowest)))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(columns[0])), F.lit(0))).first()[0] if dict(docs.dtypes)[columns[0]] in ("string", "binary") else 0
    n = max(partitions(spark), -(-size // RANGE_BYTES))
    bounds = keyed.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], 10000).alias("b")).first()["b"]
    bounds = sorted(set(bounds or []))
    dealt = keyed.withColumn(part, F.expr(f"size(filter(array({', '.join(f'{b}L' if b > lowest else '(-9223372036854775807L - 1L)' for b in bounds)}), b -> b <= `{key}`))") if bounds else F.lit(0))
    order = Window.partitionBy(part).orderBy(F.col(key).desc(), F.col(columns[0]).desc())
    ordered = dealt
    tops = sorted(dealt.groupBy(part).agg(F.max(key).alias("top")).collect())  # one row for each range
    after = {r[0]: tops[i - 1][0] for i, r in enumerate(tops)}
    for name in columns:
        ordered = ordered.withColumn(f"next_{name}", F.lead(name).over(order))
    if place:
        ordered = ordered.withColumn(place[0], F.col(part)).withColumn(place[1], F.row_number().over(order)).withColumn(place[2], F.lead(F.lit(1)).over(order).isNull())
    heads = dealt.where(F.col(key).isin([r["top"] for r in tops]) if tops else F.lit(False))
    heads = heads.groupBy(part).agg(F.max(F.struct(*columns)).alias("head"))
    before = spark.createDataFrame([(b, a) for a, b in after.items()], "of int, into int") if after else spark.createDataFrame([], "of int, into int")
    heads = heads.join(F.broadcast(before), F.col(part) == F.col("of")).select(F.col("into"), "head")
    joined = ordered.join(heads, F.col(part) == F.col("into"), "left")
    return joined.select(*docs.columns, *(place or ()), *[F.coalesce(f"next_{c}", F.col(f"head.{c}")).alias(f"next_{c}") for c in columns])


def compare_edited(docs: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """For each document its id, ``n_chars``, and fingerprints of its text and
    of the text whose last third is replaced by the beginning of the next
    document; with the likeness to the edited text and to the next document."""
    own = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("body"))
    paired = with_next(own, ["body"], place=("range", "place", "last"))
    third = "cast(floor(char_length(body) / 3) as int)"
    edited = F.expr(f"concat(substring(body, 1, char_length(body) - {third}), substring(next_body, 1, {third}))")
    both = paired.withColumn("edited", edited)
    kept = ["range", "place", "doc_id", "n_chars", "edited_sha256", "after"]
    units = both.select(
        "range",
        "place",
        "doc_id",
        F.char_length("body").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.when(F.col("last"), F.col("next_body")).alias("after"),
        F.expr(_units("body")).alias("x"),
        F.expr(_units("edited")).alias("y"),
    )
    # units of both texts, of the own text only, of the edited text only
    parts = units.select(*kept, F.array_intersect("x", "y").alias("xy"), F.array_except("x", "y").alias("x"), F.array_except("y", "x").alias("y"))
    dealt = parts.select(*kept, F.size("xy").alias("i"), F.expr("size(xy) + size(x)").alias("j"), F.posexplode_outer(F.concat("xy", "x", "y")).alias("at", "unit"))
    kind = F.expr("if(at < i, 0, if(at < j, 1, 2))").alias("kind")
    least = dealt.groupBy(*kept, kind).agg(*[F.expr(f"min(xxhash64(unit ^ {_seed(k)}L))").alias(f"s{k}") for k in range(SAMPLES)], F.expr("count(unit) > 0").alias("some"))
    whole = least.select(*kept, "kind", F.when(F.col("some"), F.array(*[f"s{k}" for k in range(SAMPLES)])).alias("s"))
    sides = whole.groupBy(*kept).agg(*[F.max(F.when(F.col("kind") == k, F.col("s"))).alias(f"of{k}") for k in range(3)])
    sampled = lambda k: F.expr(_samples(f"coalesce(zip_with(of0, of{k}, (a, b) -> least(a, b)), of0, of{k}, array())"))
    signed = sides.select(*kept, sampled(1).alias("samples"), sampled(2).alias("edited_samples"))
    following = F.lead("samples").over(Window.partitionBy("range").orderBy("place"))
    followed = signed.withColumn("next_samples", F.coalesce(following, signature("after")))
    return followed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint("samples").alias("fingerprint"),
        fingerprint("edited_samples").alias("edited_fingerprint"),
        likeness("samples", "edited_samples").alias("near_edited"),
        likeness("samples", "next_samples").alias("near_next"),
    )
