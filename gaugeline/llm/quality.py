"""Quality rules as a short-circuit cascade, in column expressions only.

A sample gives every rule's cost and verdicts. Rules are then taken greedily by
rejections per cost among the documents that the rules before them let pass, and
joined into one CASE expression, which stops at the first rule that rejects a
document. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.session import materialize

# Fixed values of the contract and of the rules.
SPACES = r"[\x20\x09-\x0D]+"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

SAMPLE_ROWS = 1000
TIMED_RUNS = 2


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean expression that is never null."""

    name: str
    rejects: Column


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    """The runs of characters other than ASCII space, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def word_lines(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE))


def duplicate_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more.

    Windows are compared by 64-bit hashes within the row. Only a text in which
    one repeats sorts its windows; the words they cover are then counted in one
    pass over their sorted places.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(placed, lambda rows: let(
            F.array_sort(F.transform(
                F.filter(rows, lambda e, k: F.coalesce(F.get(rows, k - 1)["h"] == e["h"], F.lit(False))
                         | F.coalesce(F.get(rows, k + 1)["h"] == e["h"], F.lit(False))),
                lambda e: e["i"])),
            lambda starts: F.aggregate(
                starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
                lambda acc, at: F.struct((acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n"), at.alias("last")),
                lambda acc: acc["n"].cast("long"))))

    def windows(hashed: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashed) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashed, i + place) for place in range(WINDOW)]))

    def count(hashed: Column) -> Column:
        return F.when(F.size(hashed) <= WINDOW, F.lit(0).cast("long")).otherwise(let(
            windows(hashed),
            lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long"))
            .otherwise(covered(found))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def counts(text: Column, words: Column) -> dict[str, Column]:
    """The counts of a text, by name. ``words`` is ``word_list(text)`` or a column that holds it."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": count_matches(text, SYMBOLS),
        "n_dup_lines": let(word_lines(text), duplicate_lines),
        "n_lines": F.size(word_lines(text)).cast("long"),
        "n_repeat_words": repeated_words(words),
    }


def standard_rules(text: Column, count: dict[str, Column]) -> list[Rule]:
    """The rules of production over a text and its counts.

    The counts may be expressions, which only the rule that needs them then
    computes, or columns that are there already.
    """
    return [
        Rule("few_words", count["n_words"] < LEAST_WORDS),
        Rule("symbols", count["n_symbols"] * 10 > count["n_words"]),
        Rule("word_length", (count["word_chars"] < count["n_words"] * 2) | (count["word_chars"] > count["n_words"] * 15)),
        Rule("duplicate_lines", count["n_dup_lines"] * 2 > count["n_lines"]),
        Rule("few_letters", F.length(F.regexp_replace(text, r"\P{L}+", "")) * 2 < count["word_chars"]),
        Rule("capitals", count_matches(text, "[A-Z]") * 2 > count["word_chars"]),
        Rule("repeated_windows", count["n_repeat_words"] * 100 > count["n_words"] * MOST_REPEATED_PERCENT),
    ]


def order_rules(
    docs: DataFrame, rules: Sequence[Rule], prepare: Callable[[DataFrame], DataFrame] = lambda some: some,
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """The rules by rejections per second, each among what those before it let pass.

    ``prepare`` adds the columns that the rules read, to the sample only.
    Both figures come from about ``sample_rows`` rows of the whole table. What
    is brought to the driver is a count for each combination of verdicts in the sample.
    """
    rows = docs.count()
    if rows == 0:
        return list(rules)
    some = materialize(prepare(docs.sample(fraction=min(1.0, sample_rows / rows), seed=17)), "rule-sample")

    def seconds(expression: Column) -> float:
        spent = []
        for _ in range(TIMED_RUNS):
            start = time.perf_counter()
            some.agg(F.count_if(expression)).collect()
            spent.append(time.perf_counter() - start)
        return min(spent)

    nothing = seconds(F.lit(True))
    cost = {rule.name: max(seconds(rule.rejects) - nothing, 1e-4) for rule in rules}
    left = [
        row.asDict() for row in some.select(*[rule.rejects.alias(rule.name) for rule in rules])
        .groupBy(*[rule.name for rule in rules]).count().collect()]
    waiting, ordered = {rule.name: rule for rule in rules}, []
    while waiting:
        gain = {name: sum(row["count"] for row in left if row[name]) / cost[name] for name in waiting}
        best = max(waiting, key=lambda name: (gain[name], -cost[name]))
        ordered.append(waiting.pop(best))
        left = [row for row in left if not row[best]]
    return ordered


def cascade(rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects, else null; later rules are not run."""
    if not rules:
        return F.lit(None).cast("string")
    return reduce(lambda chain, rule: chain.when(rule.rejects, rule.name), rules[1:], F.when(rules[0].rejects, rules[0].name))


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: the counts, whether the base rules fail, and the cascade's verdict.

    A null or empty text has no words and fails. Rows that repeat are judged
    one by one. Columns of ``docs`` other than doc_id and text are not read.
    """
    clean = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = counts(F.col("text"), F.col("words"))

    def counted(some: DataFrame) -> DataFrame:
        return some.withColumn("words", word_list(F.col("text"))).select(
            "doc_id", "text", *[count.alias(name) for name, count in found.items()])

    # The counts are asked for anyway, so the rules take them as they are.
    rules = standard_rules(F.col("text"), {name: F.col(name) for name in found})
    failed = rules[0].rejects | rules[-1].rejects
    verdict = cascade(order_rules(clean, rules, counted))
    return counted(clean).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict.isNull()).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with the columns of ``docs``.

    A null text is rejected; rows that repeat are judged one by one; an empty
    table stays empty. The words of a text are listed once, around the rules.
    """
    text = F.col("text")
    ordered = order_rules(
        docs.select(F.coalesce("text", F.lit("")).alias("text")), standard_rules(text, counts(text, word_list(text))))

    def rejected(words: Column) -> Column:
        rules = {rule.name: rule for rule in standard_rules(text, counts(text, words))}
        return cascade([rules[rule.name] for rule in ordered])

    return docs.where(text.isNotNull() & let(word_list(text), rejected).isNull())


SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), listed AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM base
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM listed
), windows AS (
  SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w || ' '
         || lead(word, 3) OVER w || ' ' || lead(word, 4) OVER w AS span
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), again AS (
  SELECT doc_id, span FROM windows WHERE span IS NOT NULL GROUP BY doc_id, span HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2, pos + 3, pos + 4]) AS place
        FROM windows JOIN again USING (doc_id, span))
  GROUP BY doc_id
), counted AS (
  SELECT l.doc_id, text, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(lines) AS n_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM listed l LEFT JOIN covered c ON l.doc_id = c.doc_id
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR n_symbols * 10 > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_dup_lines > n_lines
            OR 2 * length(regexp_replace(text, '\P{L}', '', 'g')) < word_chars
            OR 2 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > word_chars) AS kept
FROM judged
"""
