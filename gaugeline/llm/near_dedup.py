"""Near-duplicate classes by tensored banding of MinHash, verified on full sets.

A table key joins one sketch of the first collection with one of the second, so
``m * m`` tables cost ``2 * m`` sketches. Documents that meet in a bucket are
compared with the bucket's smallest document on their full shingle sets. What a
comparison with one member cannot show (two documents that are linked to each
other but not to it) is found by an exact prefix and position filter over the
documents of the buckets that still hold several classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.batches import LOWER, MULTIPLIER, mix, shingles, text_slices, words
from gaugeline.llm.components import components
from gaugeline.llm.ranges import parts_of
from gaugeline.operators.scale import top_rows
from gaugeline.session import materialize

BLOCK = 1024  # shingles hashed at once
PAIRS_A_TASK = 128  # documents compared with one copy of a bucket's first document


def sketches_for(threshold: float, width: int, recall: float) -> int:
    """The fewest sketches a collection needs for ``recall`` at ``threshold``."""
    sketches = 1
    while (1 - (1 - threshold**width) ** sketches) ** 2 < recall:
        sketches += 1
    return sketches


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text.

    A text with fewer than ``size`` words has its word sequence as one shingle;
    one without words (or null) has none.
    """
    for first, end, data, starts in text_slices(column):
        hashes, row, counts = words(LOWER[data], starts)
        runs, run_row = shingles(hashes, row, size)
        cut = np.searchsorted(run_row, np.arange(end - first + 1))
        at = np.concatenate(([0], np.cumsum(counts)))
        for place in range(end - first):
            if counts[place] >= size or counts[place] == 0:
                yield np.unique(runs[cut[place]:cut[place + 1]])
            else:
                whole = np.array([counts[place]], dtype=np.uint64)
                for word in hashes[at[place]:at[place + 1]]:
                    whole = mix(whole * np.uint64(MULTIPLIER) + word)
                yield whole


def sketch(shingle_set: np.ndarray, sketches: int, width: int) -> np.ndarray:
    """``2 * sketches`` values, each a hash of ``width`` MinHash values."""
    count = 2 * sketches * width
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(MULTIPLIER))
    scale, shift = (seeds[:count] | np.uint64(1))[:, None], seeds[count:, None]
    low = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingle_set), BLOCK):
        low = np.minimum(low, (shingle_set[start:start + BLOCK] * scale + shift).min(axis=1))
    low = low.reshape(2 * sketches, width)
    joined = low[:, 0]
    for place in range(1, width):
        joined = mix(joined * np.uint64(MULTIPLIER) + low[:, place])
    return joined


def set_signature(shingle_set: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return mix(shingle_set).sum(dtype=np.uint64), mix(shingle_set ^ np.uint64(MULTIPLIER)).sum(dtype=np.uint64)


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64))


def sketch_documents(docs: DataFrame, size: int, sketches: int, width: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit signature of the set, and its sketch."""

    def run(batches):
        for batch in batches:
            counts, one, two, flat = [], [], [], []
            for found in shingle_sets(batch.column(1), size):
                counts.append(len(found))
                for part, value in zip((one, two), set_signature(found), strict=True):
                    part.append(value)
                flat.append(sketch(found, sketches, width) if len(found) else np.zeros(0, np.uint64))
            places = np.concatenate(([0], np.cumsum([len(x) for x in flat]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), _signed(one), _signed(two),
                 pa.ListArray.from_arrays(pa.array(places), _signed(np.concatenate(flat or [np.zeros(0)])))],
                ["doc_id", "n_shingles", "sig_1", "sig_2", "sketch"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, sig_1 bigint, sig_2 bigint, sketch array<bigint>")


def table_keys(sketch_column: Column, sketches: int) -> Column:
    """The keys of all ``sketches ** 2`` tables, each naming its table."""
    places = F.sequence(F.lit(0), F.lit(sketches - 1))
    return F.flatten(F.transform(places, lambda i: F.transform(places, lambda j: F.xxhash64(
        i, j, F.get(sketch_column, i), F.get(sketch_column, j + F.lit(sketches))))))


def _length_allows(one: Column, other: Column, percent: int) -> Column:
    return F.least(one, other) * 100 >= F.greatest(one, other) * percent


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (doc, hub) whose full shingle sets are similar enough.

    Rows are grouped by hub, the hub's own text first, so each text moves once
    per hub and a task holds one set. A hub with many documents is split into
    groups of about ``PAIRS_A_TASK``, each with its own copy of the hub's text.
    """
    groups = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PAIRS_A_TASK).cast("int").alias("groups"))
    # A table: its size decides how the texts are joined.
    asked = materialize(
        pairs.join(groups, "hub").select(
            "hub", F.pmod(F.xxhash64("doc"), F.col("groups")).cast("int").alias("part"), F.lit(1).alias("role"), "doc")
        .unionByName(groups.select(
            "hub", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("role"),
            F.col("hub").alias("doc"))),
        "near-asked")

    def run(batches):
        hub, part, held = None, None, []
        for batch in batches:
            docs, hubs = [], []
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            for (this_hub, this_part, role, doc), found in zip(rows, shingle_sets(batch.column(4), size), strict=True):
                if (this_hub, this_part) != (hub, part):
                    hub, part, held = this_hub, this_part, []
                if role == 0:
                    held.append(found)
                    continue
                for other in held:  # several only where rows share a doc_id
                    if min(len(found), len(other)) * 100 < percent * max(len(found), len(other)):
                        continue
                    common = len(np.intersect1d(found, other, assume_unique=True))
                    if common * 100 >= percent * (len(found) + len(other) - common):
                        docs.append(doc)
                        hubs.append(this_hub)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(hubs, pa.int64())], ["a", "b"])

    moved = (
        asked.join(texts.select(F.col("doc_id").alias("doc"), "text"), "doc")
        .select("hub", "part", "role", "doc", "text")
        .repartition("hub", "part").sortWithinPartitions("hub", "part", "role", "doc"))
    return moved.mapInArrow(run, "a bigint, b bigint").distinct()


def prefix_pairs(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of documents of different classes that the prefix and position filter cannot rule out.

    ``members`` is (doc, root). Shingles are ordered from rare to frequent
    among the members. Two similar sets share a shingle among their rarest, and
    what stands before it in either set cannot be shared by both, so most pairs
    are dropped inside the join, before a row is made. No similar pair is lost,
    also if rows of ``texts`` share a doc_id: each distinct set counts once.
    """
    signature = ["sig_1", "sig_2", "n"]

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(2), size))
            counts = [len(x) for x in sets]
            one, two = zip(*map(set_signature, sets), strict=True) if sets else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.asarray(batch.column(0)), counts), pa.int64()),
                 pa.array(np.repeat(np.asarray(batch.column(1)), counts), pa.int64()),
                 _signed(np.repeat(np.array(one, np.uint64), counts)), _signed(np.repeat(np.array(two, np.uint64), counts)),
                 pa.array(np.repeat(counts, counts), pa.int64()),
                 _signed(np.concatenate(sets) if sets else [])], ["doc", "root", *signature, "shingle"])

    rows = materialize(
        members.join(texts.select(F.col("doc_id").alias("doc"), "text"), "doc")
        .select("doc", "root", "text")
        .mapInArrow(run, "doc bigint, root bigint, sig_1 bigint, sig_2 bigint, n bigint, shingle bigint"),
        "near-shingles")
    often = rows.groupBy("shingle").agg(F.count("*").alias("often"))
    # The sets are put in order inside the row of their document; a repeated row adds nothing to its set.
    ordered = rows.join(often, "shingle").groupBy("doc", "root", *signature).agg(
        F.array_sort(F.collect_set(F.struct("often", "shingle"))).alias("all"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    placed = materialize(
        ordered.select("doc", "root", "n", F.posexplode(F.slice("all", F.lit(1), prefix.cast("int"))))
        .where("col.often > 1")
        .select("doc", "root", "n", (F.col("n") - F.col("pos")).alias("rest"), F.col("col.shingle").alias("shingle")),
        "near-prefixes")
    one, two = placed.alias("one"), placed.alias("two")
    return (
        one.join(two, (F.col("one.shingle") == F.col("two.shingle"))
                 & (F.col("one.doc") < F.col("two.doc")) & (F.col("one.root") != F.col("two.root"))
                 & (F.least("one.rest", "two.rest") * (100 + percent) >= (F.col("one.n") + F.col("two.n")) * percent))
        .select(F.col("two.doc").alias("doc"), F.col("one.doc").alias("hub")).distinct())


def near_classes(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    width: int = 3,
    recall: float = 0.9995,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of distinct ``size``-word shingles
    (A-Z lower-cased, words parted by ASCII space) have a Jaccard similarity
    of at least ``percent`` / 100; classes are the connected components, named
    by their smallest doc_id. ``recall`` is the chance that a pair right at
    the threshold meets in a bucket; more similar pairs meet more surely.

    Defined cases: a null, empty or wordless text has an empty set, is linked
    with nothing and is kept. Fewer words than ``size`` are one shingle. Rows
    that share a doc_id are one document, so their links are joined. A null
    doc_id is no document to link: component_id is null and kept is true. Extra columns of ``docs`` are not read. An empty table gives an empty result.
    """
    sketches = sketches_for(percent / 100, width, recall)
    sketched = materialize(sketch_documents(docs, size, sketches, width), "near-sketches")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    # Equal sets are one representative from here on.
    signature = ["sig_1", "sig_2", "n_shingles"]
    alike = materialize(
        sketched.where("n_shingles > 0 and doc_id is not null").groupBy(*signature).agg(
            F.min("doc_id").alias("rep"), F.any_value("sketch").alias("sketch")), "near-representatives")

    # Every row becomes ``sketches ** 2`` rows, so the tasks that make them are to be many.
    keyed = alike.repartition(parts_of(docs), "rep").select(
        F.col("rep").alias("doc"), F.col("n_shingles").alias("n"),
        F.explode(table_keys(F.col("sketch"), sketches)).alias("key"))
    buckets = keyed.groupBy("key").agg(
        F.min(F.struct("doc", "n")).alias("first"), F.count("*").alias("members")).where("members > 1")
    met = materialize(
        keyed.join(buckets.select("key", "first"), "key").select("key", "doc", "n", "first"), "near-buckets")

    stars = (
        met.where((F.col("doc") != F.col("first.doc")) & _length_allows(F.col("n"), F.col("first.n"), percent))
        .select("doc", F.col("first.doc").alias("hub")).distinct())
    # Only texts that met another are compared; they are stored once for all comparisons.
    involved = materialize(texts.join(met.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi"), "near-texts")
    same_id = (
        sketched.where("n_shingles > 0").select("doc_id", *signature).distinct()
        .join(alike.select("rep", *signature), signature).groupBy("doc_id")
        .agg(F.min("rep").alias("b"), F.collect_set("rep").alias("reps")).where(F.size("reps") > 1)
        .select(F.explode("reps").alias("a"), "b"))
    links = materialize(verify(stars, involved, size, percent).unionByName(same_id), "near-links")
    first = materialize(components(links), "near-components")

    rooted = met.join(first.withColumnRenamed("node", "doc"), "doc", "left").select(
        "key", "doc", F.coalesce("root", "doc").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    members = materialize(rooted.join(mixed.select("key"), "key", "left_semi").select("doc", "root").distinct(), "near-members")
    more = verify(prefix_pairs(members, involved, size, percent), involved, size, percent)
    root = first.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    bridges = (
        more.join(root, "a", "left").join(root.select(F.col("a").alias("b"), F.col("ra").alias("rb")), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")))
    second = components(bridges)

    final = (
        first.join(second.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        .select("node", F.coalesce("top", "root").alias("root"))
        .unionByName(second.join(first.select("node"), "node", "left_anti")))
    named = final.join(final.groupBy("root").agg(F.min("node").alias("component")), "root").select(
        F.col("node").alias("rep"), "component")
    classes = alike.select("rep", *signature).join(named, "rep", "left").select(
        *signature, F.coalesce("component", "rep").alias("class"))
    empty = F.col("n_shingles") == 0
    return (
        sketched.join(classes, signature, "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNull() | empty, F.col("doc_id")).otherwise(F.col("class")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, without those that another of their class stands for.

    Of rows that share a doc_id one stays, the one with the smallest text. Rows with a
    null doc_id all stay. The columns are those of ``docs``.
    """
    gone = materialize(
        near_classes(docs, size, percent).where(~F.col("kept")).select("doc_id").distinct(), "near-gone")
    again = materialize(
        docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "near-again")
    # Only rows that share an id are brought together; the others stay where they are.
    once = docs.join(gone.unionByName(again).distinct(), "doc_id", "left_anti")
    shared = docs.join(again, "doc_id", "left_semi").join(gone, "doc_id", "left_anti")
    first = top_rows(shared, ["doc_id"], [F.col("text").asc_nulls_last()], 1, "__place")
    return once.select(*docs.columns).unionByName(first.select(*docs.columns))


# Classes at three words and 85 of 100, where ids are unique: shingle lists, a join on common shingles, reachability.
SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM listed
), members AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n + b.n) AS n
  FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common WHERE 100 * c >= 85 * (n - c) UNION ALL SELECT b, a FROM common WHERE 100 * c >= 85 * (n - c)
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id <= coalesce(low, doc_id) AS kept
FROM sets LEFT JOIN smallest ON doc_id = a
"""
