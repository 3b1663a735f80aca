"""Lexical search: BM25 over several fields, with fuzzy word matching.

Scoring, per field and query word::

    idf   = ln(1 + (N - df + 0.5) / (df + 0.5))
    score = boost * closeness * idf * tf / (tf + k1 * (1 - b + b * len / avg_len))

``N`` and ``avg_len`` count the rows that have the field. Text fields are
lower-cased and split into words; keyword fields are one word compared as
written against the whole query, without length norm. A row's score is that of
its best field. A fuzzy match within the edit distance allowed for the query
word (0 up to two characters, 1 up to five, else 2; swapping neighbours is one
edit) counts with closeness ``1 - distance / shorter length``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions.text import counted, let, words
from gaugeline.operators.scale import deal_by, top_rows
from gaugeline.session import materialize

# A word that no tokenizer produces; it carries the row count of a field.
ALL_ROWS = ""
# Longest known word that is joined on strings with two characters deleted. Words
# that only one edit can reach have at most six characters and must be among these.
SHORT_WORD = 12


def allowed_edits(word: Column) -> Column:
    length = F.length(word)
    return F.when(length <= 2, 0).when(length <= 5, 1).otherwise(2)


def query_words(queries: DataFrame, fields: list[tuple[str, float, str]]) -> DataFrame:
    """(query_id, field, word, n) of every query; keyword fields take the query whole."""
    parts = []
    for name, _, kind in fields:
        found = words(F.col("query")) if kind == "text" else F.array(F.col("query"))
        parts.append(queries.select("query_id", F.lit(name).alias("field"), F.explode(found).alias("word")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.groupBy("query_id", "field", "word").agg(F.count("*").alias("n"))


def index_words(corpus: DataFrame, id_col: str, fields: list[tuple[str, float, str]]) -> DataFrame:
    """(id, field, len, counts) of every row and non-empty field.

    ``counts`` holds each word of the field once, with its frequency. One scan,
    no shuffle; store the result to search the same corpus many times.
    """
    per_field = []
    for name, _, kind in fields:
        if kind == "text":
            found = words(F.col(name))
        else:
            found = F.when(F.length(name) > 0, F.array(name))
        per_field.append(F.struct(F.lit(name).alias("field"), found.alias("words")))
    if len(per_field) == 1:
        rows = corpus.select(F.col(id_col).alias("id"), per_field[0].alias("f"))
    else:
        rows = corpus.select(F.col(id_col).alias("id"), F.explode(F.array(*per_field)).alias("f"))
    return rows.select("id", "f.field", "f.words").filter(F.size("words") > 0).select(
        "id", "field", F.size("words").alias("len"), counted(F.col("words")).alias("counts"))


def postings(index: DataFrame) -> DataFrame:
    """The index as one row per word: (id, field, len, word, tf)."""
    return index.select("id", "field", "len", F.inline("counts"))


def vocabulary(index: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """(field, word, df, total_len) of all words, plus one ALL_ROWS entry per field.

    ``keep`` limits it to the words of a table (field, word).
    """
    counted_once = F.array_append(F.transform("counts", lambda c: c["word"]), F.lit(ALL_ROWS))
    rows = index.select("field", "len", F.explode(counted_once).alias("word"))
    if keep is not None:
        rows = rows.join(keep, ["field", "word"], "left_semi")
    return rows.groupBy("field", "word").agg(F.count("*").alias("df"), F.sum("len").alias("total_len"))


def deletion_keys(word: Column, edits: Column) -> Column:
    """Hashes of the word and of every string left after deleting up to ``edits`` characters."""
    end = F.length(word) + 1
    none = F.array().cast("array<bigint>")

    def piece(start: Column, stop: Column) -> Column:
        return F.substring(word, start, stop - start)

    def without(i: Column) -> Column:
        return F.xxhash64(F.concat(piece(F.lit(1), i), piece(i + 1, end)))

    def without_pairs(i: Column) -> Column:
        head = piece(F.lit(1), i)
        return F.transform(
            F.sequence(i + 1, end - 1),
            lambda j: F.xxhash64(F.concat(head, piece(i + 1, j), piece(j + 1, end))))

    one = F.when(edits >= 1, F.transform(F.sequence(F.lit(1), end - 1), without)).otherwise(none)
    two = F.when(
        (edits >= 2) & (end > 2),
        F.flatten(F.transform(F.sequence(F.lit(1), end - 2), without_pairs))).otherwise(none)
    return F.concat(F.array(F.xxhash64(word)), one, two)


def one_deleted(part: Column) -> Column:
    """Every string left after deleting one character."""
    return F.when(F.length(part) > 0, F.transform(
        F.sequence(F.lit(1), F.length(part)),
        lambda i: F.concat(F.substring(part, F.lit(1), i - 1), F.substring(part, i + 1, F.length(part))),
    )).otherwise(F.array().cast("array<string>"))


def half_keys(word: Column) -> Column:
    """Hashes of each half of a long known word, whole and with one character deleted.

    One half is within one edit of what a word two edits away has in its place:
    two plain edits cannot both fall into both halves, and a swap across the
    middle is one replaced character on either side.
    """
    length = F.length(word)
    middle = F.floor(length / 2).cast("int")

    def keys(side: int, part: Column) -> Column:
        return let(part, lambda x: F.transform(
            F.array_append(one_deleted(x), x), lambda s: F.xxhash64(length, F.lit(side), s)))

    return F.concat(
        keys(0, F.substring(word, F.lit(1), middle)), keys(1, F.substring(word, middle + 1, length)))


def half_keys_within_two(word: Column) -> Column:
    """The keys by which ``half_keys`` of any long word within two edits can be met."""

    def keys(length: Column, side: int, half: Column) -> Column:
        def part(width: Column) -> Column:
            start = F.lit(1) if side == 0 else F.length(word) - width + 1
            return F.substring(word, start, width)

        # A half meets a shorter part by deleting from itself, a longer one if that gives one up.
        strings = F.concat(
            F.array(part(half - 1), part(half)), one_deleted(part(half)),
            F.when(half < F.length(word), one_deleted(part(half + 1))).otherwise(F.array().cast("array<string>")))
        return F.transform(strings, lambda s: F.xxhash64(length, F.lit(side), s))

    def both(length: Column) -> Column:
        middle = F.floor(length / 2).cast("int")
        return F.concat(keys(length, 0, middle), keys(length, 1, length - middle))

    lengths = F.filter(
        F.sequence(F.length(word) - 2, F.length(word) + 2), lambda n: n > SHORT_WORD)
    return F.array_distinct(F.flatten(F.transform(lengths, both)))


def swapped(word: Column) -> Column:
    """All strings left after swapping two neighbouring characters."""
    return F.when(
        F.length(word) > 1,
        F.transform(
            F.sequence(F.lit(1), F.length(word) - 1),
            lambda i: F.concat(
                F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(1)),
                F.substring(word, i, F.lit(1)), F.substring(word, i + 2, F.length(word))),
        ),
    ).otherwise(F.array().cast("array<string>"))


def edit_distance(a: Column, b: Column) -> Column:
    """Edits between two words up to 2, a swap of neighbours counting as one; else null.

    ``levenshtein`` counts a swap as two, so its value tells which combinations
    are possible: 2 may be one swap; 3 may be a swap and another edit (which may
    come before or after it, so the swap is tried on either word); two swaps
    give 3 or 4.
    """
    plain = F.levenshtein(a, b, 4)
    longer = F.length(a) - F.length(b)

    def near(word: Column, other: Column) -> Column:
        return F.exists(swapped(word), lambda s: F.levenshtein(s, other, 1) >= 0)

    is_swap = (longer == 0) & F.exists(swapped(a), lambda s: s == b)
    two_swaps = F.exists(F.flatten(F.transform(swapped(a), swapped)), lambda s: s == b)
    return (
        F.when(plain.between(0, 1), plain)
        .when(plain == 2, F.when(is_swap, 1).otherwise(2))
        .when((plain == 3) & longer.between(-1, 1) & (near(a, b) | near(b, a)), 2)
        .when((plain >= 3) & (longer == 0) & two_swaps, 2)
    )


def match_words(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (field, word, known_word, distance) within the edits a word allows.

    Two words within d edits share a string that both reach by deleting at most
    d characters, so candidates come from an equality join on those strings and
    only they are compared. Words longer than ``SHORT_WORD`` join on their
    halves with at most one character deleted, so that a known word has about
    as many keys as characters. Both sides are first cut to the lengths that
    can match at all.
    """
    asked = asked.select("field", "word").distinct().withColumn("edits", allowed_edits(F.col("word")))
    known = known.select("field", F.col("word").alias("known_word"), F.length("word").alias("len"))
    known_lengths = known.select("field", F.col("len").alias("near_len")).distinct()
    reach = asked.withColumn("near_len", F.explode(F.sequence(
        F.length("word") - F.col("edits"), F.length("word") + F.col("edits"))))
    matchable = materialize(
        reach.join(known_lengths, ["field", "near_len"], "left_semi")
        .select("field", "word", "edits").distinct(), "asked-words")
    asked_lengths = matchable.select("field", F.explode(F.sequence(
        F.length("word") - F.col("edits"), F.length("word") + F.col("edits"))).alias("len")).distinct()
    near = known.join(asked_lengths, ["field", "len"], "left_semi")
    # Fewest deletions that suffice on this side, given which longer or shorter
    # words may reach a word of this length.
    edits = F.when(F.col("len") <= 1, 0).when(F.col("len") <= 5, 1).otherwise(2)
    known_keys = near.select("field", "known_word", F.explode(
        F.when(F.col("len") <= SHORT_WORD, deletion_keys(F.col("known_word"), edits))
        .otherwise(half_keys(F.col("known_word")))).alias("key"))
    none = F.array().cast("array<bigint>")
    near_short = F.length("word") - F.col("edits") <= SHORT_WORD
    wanted = F.concat(
        F.when(near_short, deletion_keys(F.col("word"), F.col("edits"))).otherwise(none),
        F.when(F.length("word") + F.col("edits") > SHORT_WORD, half_keys_within_two(F.col("word"))).otherwise(none))
    # Stored, so that the join is chosen by its size in bytes.
    asked_keys = materialize(matchable.select(
        "field", "word", "edits", F.explode(wanted).alias("key")), "asked-keys")
    pairs = known_keys.join(asked_keys, ["field", "key"]).select(
        "field", "word", "edits", "known_word").distinct()
    distance = F.when(F.col("word") == F.col("known_word"), 0).otherwise(
        edit_distance(F.col("word"), F.col("known_word")))
    return pairs.withColumn("distance", distance).filter(F.col("distance") <= F.col("edits")).select(
        "field", "word", "known_word", "distance")


def exact_words(asked: DataFrame, known: DataFrame) -> DataFrame:
    asked = asked.select("field", "word").distinct()
    return known.select("field", "word").join(asked, ["field", "word"]).select(
        "field", "word", F.col("word").alias("known_word"), F.lit(0).alias("distance"))


def word_weights(
    asked: DataFrame, matches: DataFrame, known: DataFrame, fields: list[tuple[str, float, str]]
) -> DataFrame:
    """(query_id, field, word, weight, norms, df) of every word that scores for a query.

    The weight holds everything that does not depend on the scored row; ``df`` is how many rows have the word.
    """
    field_rows = known.filter(F.col("word") == ALL_ROWS).select(
        "field", F.col("df").alias("n_rows"), (F.col("total_len") / F.col("df")).alias("avg_len"))
    boosts = F.create_map(*[x for name, boost, _ in fields for x in (F.lit(name), F.lit(boost))])
    is_text = F.col("field").isin(*[name for name, _, kind in fields if kind == "text"])
    idf = F.log1p((F.col("n_rows") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    closeness = 1.0 - F.col("distance") / F.least(F.length("word"), F.length("known_word"))
    known_df = known.select("field", F.col("word").alias("known_word"), "df")
    return (
        asked.join(matches, ["field", "word"])
        .join(known_df, ["field", "known_word"])
        .join(F.broadcast(field_rows), "field")  # one row for each field
        .withColumn("weight", boosts[F.col("field")] * F.col("n") * closeness * idf)
        .groupBy("query_id", "field", "known_word")
        .agg(F.sum("weight").alias("weight"),
             F.first(F.when(is_text, fv.BM25_B).otherwise(0.0)).alias("b"),
             F.first("avg_len").alias("avg_len"),
             F.first("df").alias("df"))
        .withColumnRenamed("known_word", "word")
        .filter(F.col("weight") > 0)
    )


def score_rows(index: DataFrame, weights: DataFrame, k: int, by_id: bool = False) -> DataFrame:
    """The ``k`` best rows of every query as (query_id, id, score, rank).

    The words of a row are already counted, and those outside the queries are
    dropped, before the rest is moved by row id. The weights are stored, so
    Spark broadcasts them if their bytes allow it; scoring then happens inside those
    partitions, and only ``k`` rows per query leave each of them. Larger
    weights meet the words in a shuffle join, whose hot words adaptive
    execution splits. The postings are dealt to as many tasks as the scored ones need, since
    a posting counts for every query with its word. An index stored in buckets by id (``by_id``) is not moved for a broadcast.
    """
    weights = materialize(weights, "word-weights")
    used = materialize(weights.select("field", "word").distinct(), "words-used")
    found = postings(index).join(used, ["field", "word"], "left_semi")
    if not by_id:
        n_scored = weights.agg(F.sum("df")).first()[0] or 0
        found = deal_by(found, ["id"], n_scored)
    scored = found.join(weights, ["field", "word"])
    norm = 1.0 - F.col("b") + F.col("b") * F.col("len") / F.col("avg_len")
    part = F.col("weight") * F.col("tf") / (F.col("tf") + fv.BM25_K1 * norm)
    return top_rows(
        scored.groupBy("id", "query_id", "field").agg(F.sum(part).alias("score"))
        .groupBy("id", "query_id").agg(F.round(F.max("score"), 6).alias("score")),
        ["query_id"], [F.col("score").desc(), F.col("id")], k,
    )


def search_index(
    index: DataFrame,
    queries: DataFrame,
    fields: list[tuple[str, float, str]] | None = None,
    k: int = fv.LEXICAL_SIZE,
    fuzzy: bool = True,
    by_id: bool = False,
) -> DataFrame:
    """Best rows of a word index for every query of (query_id, query).

    Ties are broken by id. Returns (query_id, id, score, rank), rank from 1.
    """
    fields = fields if fields is not None else fv.SEARCH_FIELDS
    asked = materialize(query_words(queries, fields), "query-words")
    if fuzzy:
        known = materialize(vocabulary(index), "vocabulary")
        matches = match_words(asked, known.filter(F.col("word") != ALL_ROWS))
    else:
        words_asked = asked.select("field", "word").distinct()
        every_row = words_asked.select("field", F.lit(ALL_ROWS).alias("word")).distinct()
        known = materialize(vocabulary(index, words_asked.unionByName(every_row)), "vocabulary")
        matches = exact_words(asked, known.filter(F.col("word") != ALL_ROWS))
    return score_rows(index, word_weights(asked, matches, known, fields), k, by_id)


def search(
    corpus: DataFrame,
    queries: DataFrame,
    id_col: str = "indicator_code",
    fields: list[tuple[str, float, str]] | None = None,
    k: int = fv.LEXICAL_SIZE,
    fuzzy: bool = True,
) -> DataFrame:
    """``search_index`` over a corpus whose words are indexed for this search.

    The index is read twice, so it is stored rather than computed again.
    """
    fields = fields if fields is not None else fv.SEARCH_FIELDS
    index = materialize(index_words(corpus, id_col, fields), "index")
    return search_index(index, queries, fields, k, fuzzy)


def store_index(index: DataFrame, table: str, buckets: int) -> DataFrame:
    """Store an index as a table in buckets by id, for many searches without a shuffle."""
    index.write.mode("overwrite").bucketBy(buckets, "id").sortBy("id").saveAsTable(table)
    return index.sparkSession.table(table)
