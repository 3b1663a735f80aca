"""A stored word index with block maxima: exact top-k search that leaves most postings unread.

The index of a corpus is a folder of segments under a versioned manifest. A
segment has the rows' own word lists (``forward``), the postings of every word
in blocks of falling impact (``blocks``), and per word its counts and
best block (``words``). Adding rows writes a further segment; rows that it
replaces are named in ``gone`` and taken out of the word counts, so weights are
always those of a fresh index.

A search reads the best blocks of each query's strongest words and scores the rows in
them whole: the k-th best is a score to reach. Words are then taken from the
strongest (mostly the rarest) down. A block is skipped if its highest impact and
the best of all later words together fall short of that score: a row met there first
cannot get further. Of the rows that the remaining blocks leave in reach, those with the most in
the blocks read are scored whole from their own word lists, which gives a higher score to reach; what
it leaves in reach is scored whole too, so the result is that of scoring everything.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gaugeline import fixed_values as fv
from gaugeline.operators.scale import deal_by, top_rows
from gaugeline.operators.search import (
    ALL_ROWS,
    exact_words,
    index_words,
    match_words,
    query_words,
    vocabulary,
    word_weights,
)
from gaugeline.session import materialize
from gaugeline.sources.sinks import newest
from gaugeline.sources.versions import commit, read_manifest, versions, write_part

BLOCK = 128
BUCKETS = 32
SEEDS = 4  # rows scored first, as a multiple of k
LEADERS = 32  # rows scored whole before the others in reach, as a multiple of k
SCORES_PER_TASK = 250_000  # a score is grouped twice and sorted twice by its task
SLACK = 2e-6  # scores are compared at six places
NOISE = 1e-9  # more than the order of a sum can change

Fields = list[tuple[str, float, str]]


def saturated(tf: Column, length: Column, b: Column, average: Column) -> Column:
    """The part of BM25 that depends on the scored row, between 0 and 1."""
    return tf / (tf + fv.BM25_K1 * (1.0 - b + b * length / average))


def bucket_of() -> Column:
    return F.pmod(F.xxhash64("field", "word"), F.lit(BUCKETS)).cast("int")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- Writing ------------------------------------------------------------------


def _length_norms(fields: Fields) -> Column:
    """The length norm's weight of a field: keywords have none."""
    text = [name for name, _, kind in fields if kind == "text"]
    return F.when(F.col("field").isin(text), F.lit(fv.BM25_B)).otherwise(F.lit(0.0))


def _write_segment(forward: DataFrame, folder: str, fields: Fields, number: int, gone: str | None, lost: DataFrame | None) -> dict:
    """Write one segment. ``lost`` are the word counts of replaced rows, to be taken off."""
    spark = forward.sparkSession
    stored = write_part(forward, folder)
    forward = spark.read.schema(forward.schema).parquet(f"{folder}/{stored}")
    average = materialize(forward.groupBy("field").agg(F.avg("len").alias("average")), "field-lengths")
    ids = forward.schema["id"].dataType
    impact = saturated(F.col("tf"), F.col("len"), _length_norms(fields), F.col("average"))
    postings = forward.select("id", "field", "len", F.inline("counts")).join(average, "field").select(
        bucket_of().alias("bucket"), "field", "word", F.col("id").cast(ids).alias("id"), "tf", "len", "average", impact.alias("impact"))
    # Sorted by falling impact, then cut where the running number passes a multiple of BLOCK.
    order = ["bucket", "field", "word", F.desc("impact"), "id"]
    numbered = postings.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    blocks = numbered.groupBy("bucket", "field", "word", F.expr(f"at div {BLOCK}").alias("block")).agg(
        F.count("*").alias("n"), F.max("impact").alias("impact"), F.max("tf").alias("max_tf"), F.min("len").alias("min_len"),
        F.first("average").alias("average"), F.collect_list(F.struct("id", "tf", "len")).alias("rows"))
    cut = write_part(
        blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "word", F.desc("impact")), folder, ("bucket",))
    heads = spark.read.schema(blocks.schema).parquet(f"{folder}/{cut}").groupBy("field", "word").agg(
        F.max("impact").alias("impact"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"),
        F.max_by(F.struct("block", "n"), F.struct("impact", F.negative("block"))).alias("best"), F.first("average").alias("average"))
    counts = vocabulary(forward)
    if lost is not None:
        counts = counts.unionByName(lost).groupBy("field", "word").agg(F.sum("df").alias("df"), F.sum("total_len").alias("total_len"))
    rows = counts.join(heads, ["field", "word"], "left")
    words = write_part(rows, folder)
    schemas = {"forward": forward.schema, "blocks": blocks.schema, "words": rows.schema}
    return {"number": number, "forward": stored, "blocks": cut, "words": words, "gone": gone,
            "schemas": {name: schema.json() for name, schema in schemas.items()}}


def _rows_of(corpus: DataFrame, id_col: str, fields: Fields) -> DataFrame:
    """One row for every id; a null id names nothing and is left out."""
    named = corpus.filter(F.col(id_col).isNotNull()).select(id_col, *[name for name, _, _ in fields if name != id_col])
    return newest(named, [id_col])


def write_index(corpus: DataFrame, folder: str, id_col: str = "indicator_code", fields: Fields | None = None) -> dict:
    """Index a corpus as the first version of ``folder``; of several rows of one id one counts."""
    fields = fields if fields is not None else fv.SEARCH_FIELDS
    if versions(corpus.sparkSession, folder):
        raise FileExistsError(folder)
    forward = index_words(_rows_of(corpus, id_col, fields), id_col, fields)
    segment = _write_segment(forward, folder, fields, 0, None, None)
    return commit(corpus.sparkSession, folder, 1, {
        "id_col": id_col, "id_type": forward.schema["id"].dataType.simpleString(), "fields": fields, "segments": [segment]})


def _fields(manifest: dict) -> Fields:
    return [tuple(field) for field in manifest["fields"]]


def _segments(spark: SparkSession, folder: str, manifest: dict, what: str) -> DataFrame:
    """One kind of table over all segments, with the segment's number."""
    def one(segment: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(segment["schemas"][what]))
        return spark.read.schema(schema).parquet(f"{folder}/{segment[what]}").select(
            *schema.names, F.lit(segment["number"]).alias("segment"))

    return _union([one(segment) for segment in manifest["segments"]])


def _gone(spark: SparkSession, folder: str, manifest: dict) -> DataFrame | None:
    """(segment, id) of the rows that later segments replace or delete."""
    named = [spark.read.parquet(f"{folder}/{segment['gone']}") for segment in manifest["segments"] if segment["gone"]]
    return _union(named) if named else None


def _live(rows: DataFrame, gone: DataFrame | None) -> DataFrame:
    return rows if gone is None else rows.join(gone, ["segment", "id"], "left_anti")


def read_forward(spark: SparkSession, folder: str, manifest: dict | None = None) -> DataFrame:
    """The word lists of all live rows: (segment, id, field, len, counts)."""
    manifest = manifest or read_manifest(spark, folder)
    return _live(_segments(spark, folder, manifest, "forward"), _gone(spark, folder, manifest))


def _change(folder: str, ids: DataFrame, forward: DataFrame) -> dict:
    """Commit a segment of ``forward`` that replaces all live rows of ``ids`` (id)."""
    spark = ids.sparkSession
    manifest = read_manifest(spark, folder)
    ids = materialize(ids.select(F.col("id").cast(manifest["id_type"]).alias("id")).distinct(), "index-ids")
    replaced = materialize(read_forward(spark, folder, manifest).join(ids, "id", "left_semi"), "index-replaced")
    gone = write_part(replaced.select("segment", "id").distinct(), folder)
    lost = vocabulary(replaced).select("field", "word", F.negative("df").alias("df"), F.negative("total_len").alias("total_len"))
    number = 1 + max(segment["number"] for segment in manifest["segments"])
    segment = _write_segment(forward, folder, _fields(manifest), number, gone, lost)
    return commit(spark, folder, manifest["version"] + 1, {**manifest, "segments": [*manifest["segments"], segment]})


def add_rows(corpus: DataFrame, folder: str) -> dict:
    """Index further rows; a row replaces the indexed one of its id."""
    manifest = read_manifest(corpus.sparkSession, folder)
    id_col, fields = manifest["id_col"], _fields(manifest)
    rows = materialize(_rows_of(corpus, id_col, fields), "index-rows")
    return _change(folder, rows.select(F.col(id_col).alias("id")), index_words(rows, id_col, fields))


def delete_rows(ids: DataFrame, folder: str) -> dict:
    """Take the rows of ``ids`` (the id column) out of the index; unknown ids change nothing."""
    manifest = read_manifest(ids.sparkSession, folder)
    named = ids.select(F.col(manifest["id_col"]).alias("id")).filter("id is not null")
    nothing = read_forward(ids.sparkSession, folder, manifest).drop("segment").limit(0)
    return _change(folder, named, nothing)


def merge_segments(spark: SparkSession, folder: str) -> dict:
    """Write all live rows as one segment, without those that were replaced."""
    manifest = read_manifest(spark, folder)
    forward = read_forward(spark, folder, manifest).drop("segment")
    number = 1 + max(segment["number"] for segment in manifest["segments"])
    segment = _write_segment(forward, folder, _fields(manifest), number, None, None)
    return commit(spark, folder, manifest["version"] + 1, {**manifest, "segments": [segment]})


# --- Searching ----------------------------------------------------------------


def _weights(spark: SparkSession, folder: str, manifest: dict, queries: DataFrame, fuzzy: bool) -> DataFrame:
    """(query_id, field, word, weight, b, avg_len) from the word counts of all segments."""
    fields = _fields(manifest)
    asked = materialize(query_words(queries, fields), "query-words")
    words = _segments(spark, folder, manifest, "words").select("field", "word", "df", "total_len")
    if not fuzzy:
        every_row = [(name, ALL_ROWS) for name, _, _ in fields]
        wanted = asked.select("field", "word").unionByName(spark.createDataFrame(every_row, "field string, word string"))
        words = words.join(wanted.distinct(), ["field", "word"], "left_semi")
    known = words.groupBy("field", "word").agg(F.sum("df").alias("df"), F.sum("total_len").alias("total_len")).filter("df > 0")
    known = materialize(known, "vocabulary")
    find = match_words if fuzzy else exact_words
    return materialize(word_weights(asked, find(asked, known.filter(F.col("word") != ALL_ROWS)), known, fields), "word-weights")


def _highest() -> Column:
    """The most that a posting under these maxima can add to a score.

    The impact was measured with the average length at the time of writing. A
    higher average raises an impact by no more than the ratio of the two.
    """
    then = F.col("impact") * F.greatest(F.lit(1.0), F.col("avg_len") / F.col("average"))
    now = saturated(F.col("max_tf"), F.col("min_len"), F.col("b"), F.col("avg_len"))
    return F.col("weight") * F.least(then, now)


def _parts(blocks: DataFrame, gone: DataFrame | None) -> DataFrame:
    """(query_id, field, word, segment, id, part, …) of the postings in some blocks."""
    rows = blocks.select("query_id", "field", "word", "segment", "weight", "b", "avg_len", F.inline("rows"))
    part = F.col("weight") * saturated(F.col("tf"), F.col("len"), F.col("b"), F.col("avg_len"))
    return _live(rows.withColumn("part", part), gone)


def _scores(forward: DataFrame, weights: DataFrame, wanted: DataFrame) -> DataFrame:
    """(query_id, id, score) of the rows ``wanted`` (query_id, segment, id), from their own word lists."""
    row = ["segment", "id"]
    wanted = wanted.select("query_id", *row)
    n_wanted = wanted.count()
    used = weights.select("field", "word").distinct()
    rows = forward.select(*row, "field", "len", "counts")
    if n_wanted <= SCORES_PER_TASK:  # few rows are found before their words are unfolded
        rows = rows.join(F.broadcast(wanted.select(*row).distinct()), row, "left_semi")
    found = rows.select(*row, "field", "len", F.inline("counts")).join(used, ["field", "word"], "left_semi")
    if n_wanted > SCORES_PER_TASK:
        found = found.join(wanted.select(*row).distinct(), row, "left_semi")
    # Both sides by row, to as many tasks as the scores need: a row may be wanted by every query. The size of
    # the stored lists says little of the unfolded words, so the join does not go by it.
    n_scores = n_wanted * weights.select("field").distinct().count()
    met = deal_by(found, row, n_scores, SCORES_PER_TASK).join(
        deal_by(wanted, row, n_scores, SCORES_PER_TASK).hint("shuffle_hash"), row)
    part = F.col("weight") * saturated(F.col("tf"), F.col("len"), F.col("b"), F.col("avg_len"))
    return (
        met.join(weights, ["query_id", "field", "word"])
        .groupBy("query_id", *row, "field").agg(F.sum(part).alias("score"))
        .groupBy("query_id", *row).agg(F.round(F.max("score"), 6).alias("score"))
        .select("query_id", "id", "score"))


def _reached(scores: DataFrame, k: int) -> DataFrame:
    """(query_id, bar, last): the k-th best score of each query and its row's id, null where there are fewer rows."""
    best = top_rows(scores, ["query_id"], [F.desc("score"), F.col("id")], k)
    full = F.count("*") == k
    return best.groupBy("query_id").agg(
        F.when(full, F.min("score")).alias("bar"), F.when(full, F.max_by("id", "rank")).alias("last"))


def _search(spark: SparkSession, folder: str, queries: DataFrame, k: int, fuzzy: bool) -> tuple[DataFrame, DataFrame]:
    """The hits, and per query how many postings were scored out of how many."""
    manifest = read_manifest(spark, folder)
    gone = _gone(spark, folder, manifest)
    gone = None if gone is None else materialize(gone, "index-gone")
    forward = _segments(spark, folder, manifest, "forward")
    blocks = _segments(spark, folder, manifest, "blocks")
    weights = _weights(spark, folder, manifest, queries, fuzzy)

    # One row for every query word and segment that has it, with its best block.
    heads = _segments(spark, folder, manifest, "words").filter("best is not null").join(weights, ["field", "word"])
    lists = materialize(heads.select(
        "query_id", bucket_of().alias("bucket"), "field", "word", "segment", "weight", "b", "avg_len", F.col("best.block").alias("block"),
        F.col("best.n").alias("n"), _highest().alias("top")), "query-lists")
    strongest = Window.partitionBy("query_id").orderBy(F.desc("top"), "field", "word", "segment")
    chosen = lists.withColumn("before", F.coalesce(
        F.sum("n").over(strongest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).filter(F.col("before") < SEEDS * k)
    seeds = blocks.join(chosen.drop("n", "top", "before"), ["bucket", "segment", "field", "word", "block"])
    sums = _parts(seeds, gone).groupBy("query_id", "segment", "id", "field").agg(F.sum("part").alias("part"))
    sums = sums.groupBy("query_id", "segment", "id").agg(F.max("part").alias("part"))
    first = materialize(top_rows(
        sums, ["query_id"], [F.desc("part"), F.col("id")], SEEDS * k).select("query_id", "segment", "id"), "seed-rows")
    reached = materialize(_reached(_scores(forward, weights, first), k).drop("last"), "scores-to-reach")

    # What a block of a word has to offer, given all that the words after it could still add.
    words = lists.groupBy("query_id", "field", "word").agg(
        F.max("top").alias("top"), F.first("weight").alias("weight"), F.first("b").alias("b"), F.first("avg_len").alias("avg_len"))
    after = Window.partitionBy("query_id", "field").orderBy(F.desc("top"), "word").rowsBetween(1, Window.unboundedFollowing)
    need = F.col("bar") - SLACK - F.coalesce(F.sum("top").over(after), F.lit(0.0))
    needs = words.join(reached, "query_id", "left").withColumn("need", F.coalesce(need, F.lit(-1.0)))
    # A skipped block of the word adds less than this; nothing is skipped where the need is not above 0.
    needs = materialize(needs.withColumn("credit", F.greatest(F.lit(0.0), F.least("top", "need"))).withColumn(
        "bucket", bucket_of()), "block-needs")
    met = blocks.join(needs, ["bucket", "field", "word"])
    unread = needs.groupBy("query_id", "field").agg(F.sum("credit").alias("unread"), F.first("bar").alias("bar"))
    # A block is read once for all queries that need it; its postings meet them again where their row is dealt to.
    asked = needs.select(*[F.col(name).alias(f"_{name}") for name in ("bucket", "field", "word")], "need", "weight", "b", "avg_len")
    same = [F.col(name) == F.col(f"_{name}") for name in ("bucket", "field", "word")]
    needed = blocks.join(asked, reduce(Column.__and__, same) & (_highest() >= F.col("need")), "left_semi")
    postings = _live(needed.select(
        "segment", "field", "word", "impact", "max_tf", "min_len", "average", F.inline("rows")), gone)
    n_parts = met.filter(_highest() >= F.col("need")).agg(F.sum("n")).first()[0] or 0
    kept = deal_by(postings, ["id"], n_parts).join(needs.drop("bucket", "bar", "top"), ["field", "word"]).filter(_highest() >= F.col("need"))
    part = F.col("weight") * saturated(F.col("tf"), F.col("len"), F.col("b"), F.col("avg_len"))
    partial = kept.groupBy("query_id", "field", "segment", "id").agg(F.sum(part).alias("part"), F.sum("credit").alias("credit"))
    most = F.col("part") + F.col("unread") - F.col("credit")
    possible = partial.join(unread, ["query_id", "field"]).withColumn("most", most).filter(
        F.col("bar").isNull() | (F.col("most") >= F.col("bar") - SLACK))
    possible = materialize(possible.groupBy("query_id", "segment", "id").agg(
        F.max("part").alias("part"), F.max("most").alias("most")), "rows-in-reach")
    row = ["query_id", "segment", "id"]
    leaders = materialize(top_rows(possible, ["query_id"], [F.desc("part"), F.col("id")], LEADERS * k).select(*row), "leading-rows")
    scored = materialize(_scores(forward, weights, leaders), "leading-scores")
    # What falls short of their k-th best, or at most equals it and comes after its row, is not among the hits.
    short = F.col("most") < F.col("bar") - SLACK
    after_it = (F.round(F.col("most") + NOISE, 6) <= F.col("bar")) & (F.col("id") > F.col("last"))
    rest = materialize(possible.join(_reached(scored, k), "query_id", "left").filter(
        F.col("bar").isNull() | ~(short | after_it)).select(*row).join(leaders, row, "left_anti"), "rows-left")
    if not rest.isEmpty():
        scored = scored.unionByName(_scores(forward, weights, rest))
    hits = top_rows(scored, ["query_id"], [F.desc("score"), F.col("id")], k)

    seeded = chosen.groupBy("query_id").agg(F.sum("n").alias("scored"), F.lit(0).cast("long").alias("postings"))
    counted = met.groupBy("query_id").agg(
        F.sum(F.when(_highest() >= F.col("need"), F.col("n")).otherwise(0)).alias("scored"), F.sum("n").alias("postings"))
    report = seeded.unionByName(counted).groupBy("query_id").agg(F.sum("scored").alias("scored"), F.sum("postings").alias("postings"))
    return hits, report


def search_stored(spark: SparkSession, folder: str, queries: DataFrame, k: int = fv.LEXICAL_SIZE, fuzzy: bool = True) -> DataFrame:
    """Best rows of a stored index for every query of (query_id, query): the rows that ``search`` gives.

    Ties are broken by id. Returns (query_id, id, score, rank), rank from 1. A
    query without a known word, and any query of an empty index, has no rows.
    """
    return _search(spark, folder, queries, k, fuzzy)[0]


def scored_postings(spark: SparkSession, folder: str, queries: DataFrame, k: int = fv.LEXICAL_SIZE, fuzzy: bool = True) -> DataFrame:
    """(query_id, scored, postings): how many postings of a query's words the search scores, and all there are."""
    return _search(spark, folder, queries, k, fuzzy)[1]
