"""Mixing sources to target weights with hash-threshold histograms.

A source that is to give ``r`` times its words gives every document ``floor(r)``
times and, of those whose hash lies below a threshold, one copy more. The
threshold is found from word sums by source and leading hash bits; only the
bucket in which the budget runs out is divided further. Nothing is sorted, and
what remains is a filter on the hash, so a larger budget takes a superset. Rows
that are equal share a hash; where the threshold falls on such a group, its rows
are numbered and some of them taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeline.llm.quality import word_list
from gaugeline.llm.ranks import placed
from gaugeline.session import materialize

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
MOST_TIMES = 3
HASH_BITS = 60
STEP_BITS = 12


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the md5 of the id and the text's md5; nulls count as empty."""
    parts = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words; 0 for a null text) and hash of every document."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.size(word_list(F.coalesce("text", F.lit("")))).cast("long").alias("size"), hash_of(F.col("doc_id"), F.col("text")).alias("hash"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Per source: source_size and target.

    Targets share the sum of all sizes by weight; none is above ``most_times``
    its source's size, and what that leaves is shared among the others by weight. Sources reach
    their limit in the order of limit over weight, so the share of the rest is
    known from running sums over the sources (one row each).
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    limits = totals.select(
        "source", "source_size", F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(place, F.lit(len(weights)))).alias("weight"),
        (F.col("source_size") * most_times).alias("limit"))
    order = [F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy(*order).rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    # The level at which this source and those after it would share what is left.
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    levels = limits.withColumn("level", level).withColumn("free", F.col("limit") >= F.col("level") * F.col("weight"))
    # The first source that stays below its limit sets the level of all after it.
    common = F.max(F.when(F.col("free"), F.struct(-F.row_number().over(W.orderBy(*order)), F.col("level").alias("level"))))
    return levels.withColumn("common", common.over(everything)["level"]).select(
        "source", "source_size",
        F.when(F.col("free"), F.col("common") * F.col("weight")).otherwise(F.col("limit").cast("double")).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame, step_bits: int = STEP_BITS) -> DataFrame:
    """Per source: copies of every document, the hash below which one more is taken, and of how many rows with that hash.

    Each pass sums words by source and the next ``step_bits`` hash bits, within
    the source's boundary bucket only, and moves the threshold past the buckets
    that fit into what is left of the budget. The last bucket is one hash
    value: of its rows so many are taken as bring the sum nearest to the target.
    """
    budget = targets.where("source_size > 0").select(
        "source", F.floor(F.col("target") / F.col("source_size")).alias("copies"), F.col("target"), "source_size")
    state = materialize(budget.select(
        "source", "copies", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("equals"),
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("left")), "mix-state")
    for used in range(0, HASH_BITS, step_bits):
        shift = HASH_BITS - used - step_bits
        bucket = F.shiftright(F.col("hash"), shift)
        inside = sizes.join(state.select(F.col("source").alias("s"), "low"), F.col("source").eqNullSafe(F.col("s"))).where(
            F.shiftright(F.col("hash"), shift + step_bits) == F.shiftright(F.col("low"), shift + step_bits))
        if used:  # later passes read the boundary buckets only
            inside = sizes = materialize(inside.select("source", "size", "hash"), "mix-boundary")
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        held = sums.withColumn("upto", upto).join(
            state.select(F.col("source").alias("s"), "left"), F.col("source").eqNullSafe(F.col("s")))
        fits = F.col("upto") <= F.col("left")
        # Buckets fit from the first on; the one after the last that fits holds the boundary.
        passed = held.where(fits).groupBy("source").agg(F.max("upto").alias("passed"), F.max("bucket").alias("last"))
        boundary = held.where(~fits).groupBy("source").agg(
            F.min("bucket").alias("edge"), F.min_by(F.col("words") / F.col("rows"), "bucket").alias("each"))
        old = state.alias("old")
        joined = (
            old.join(passed.select(F.col("source").alias("p"), "passed", "last"), F.col("source").eqNullSafe(F.col("p")), "left")
            .join(boundary.select(F.col("source").alias("e"), "edge", "each"), F.col("source").eqNullSafe(F.col("e")), "left"))
        # Without a boundary all fits, and the next bucket's start is the threshold.
        edge = F.coalesce("edge", F.col("last") + 1)
        rest = F.col("left") - F.coalesce("passed", F.lit(0))
        equals = F.lit(0) if shift else F.coalesce(F.floor(rest / F.col("each") + 0.5), F.lit(0))
        state = materialize(joined.select(
            "source", "copies", F.coalesce(F.shiftleft(edge, shift), F.col("low")).alias("low"),
            equals.cast("long").alias("equals"), rest.alias("left")), "mix-state")
    return state.select("source", "copies", F.col("low").alias("threshold"), "equals")


def times(rows: DataFrame) -> DataFrame:
    """``rows`` with __times, how often each is taken; they have __hash, __source, __copies, __threshold and __equals.

    The rows with the very hash of their source's threshold are numbered; they are one, or equal ones.
    """
    under = rows.where("__hash != __threshold").withColumn("__times", F.col("__copies") + (F.col("__hash") < F.col("__threshold")).cast("long"))
    edge = placed(rows.where("__hash = __threshold"), ["__source"], [], "mix-equals")
    return under.unionByName(edge.withColumn("__times", F.col("__copies") + (F.col("__place") < F.col("__equals")).cast("long")).select(
        *under.columns))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, copies and taken (words, copies counted).

    A null source is a source, the last; a null text has no words and is taken
    0 times if its source has no words. Rows with equal id and text (nulls too) are taken
    as often as each other but for one copy. A source's taken words differ from its target by
    half of the words of one document at most. An empty table gives an empty result.
    """
    sizes = materialize(sized(docs), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, most_times), "mix-targets")
    cut = thresholds(sizes, targets)
    by_source = materialize(
        targets.join(cut.select(F.col("source").alias("c"), "copies", "threshold", "equals"), F.col("source").eqNullSafe(F.col("c")), "left")
        .select(F.col("source").alias("s"), "source_size", "target", F.coalesce("copies", F.lit(0)).alias("__copies"),
                F.coalesce("threshold", F.lit(0)).alias("__threshold"), F.coalesce("equals", F.lit(0)).alias("__equals")), "mix-thresholds")
    rows = sizes.join(by_source, F.col("source").eqNullSafe(F.col("s"))).withColumns(
        {"__hash": F.col("hash"), "__source": F.col("source")})
    return times(rows).select(
        "doc_id", "source", "size", "source_size", "target", F.col("__times").alias("copies"), (F.col("size") * F.col("__times")).alias("taken"))


def mixture_report(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """The documents as often as the mixture takes them, with the columns of ``docs`` (none named with ``__``).

    Null texts have no words, repeated rows are taken as ``mix`` says, and an empty table stays empty.
    """
    sizes = materialize(sized(docs), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, most_times), "mix-targets")
    cut = materialize(thresholds(sizes, targets), "mix-thresholds").toDF("__s", "__copies", "__threshold", "__equals")
    # One row per source: only the documents' own rows are repeated.
    rows = docs.withColumns({"__hash": hash_of(F.col("doc_id"), F.col("text")), "__source": F.col("source").cast("string")}).join(
        cut, F.col("__source").eqNullSafe(F.col("__s")))
    return (
        times(rows).where("__times > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int"))))
        .select(*docs.columns))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, ((sum(source_size) OVER ()
              - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT)::DOUBLE
            / (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place
  FROM totals
), targets AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size >= level * weight
              THEN weight * first_value(level) OVER (ORDER BY CASE WHEN 3 * source_size >= level * weight THEN 0 ELSE 1 END, place)
              ELSE (3 * source_size)::DOUBLE END AS target
  FROM levels
), running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, s.hash, s.source,
         CASE WHEN t.source_size = 0 THEN 0 ELSE floor(t.target / t.source_size) END::BIGINT AS copies,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE UNBOUNDED PRECEDING), 0)::BIGINT AS upto,
         coalesce(sum(s.size) OVER (PARTITION BY s.source, s.hash), 0)::BIGINT AS words,
         row_number() OVER (PARTITION BY s.source, s.hash) AS nth
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), budgets AS (
  SELECT *, target - copies * source_size - (upto - words) AS rest FROM running
)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN source_size > 0 AND size > 0 AND (words <= rest OR (rest >= 0 AND nth <= floor(rest / size + 0.5)))
                THEN 1 ELSE 0 END))::BIGINT AS taken
FROM budgets
"""
