"""Small corpora for the tests of the corpus operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, words string, _rank int"
TABLES = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

SYLLABLES = {"en": "the ing tion er and on re st", "de": "der ung schaft keit lich ein zu ge", "fr": "le eau ment que oux ais dé ré"}


def prose(seed: int, count: int, lang: str = "en") -> str:
    """``count`` invented words."""
    chance = random.Random(seed)
    parts = SYLLABLES[lang].split()
    return " ".join("".join(chance.choices(parts, k=chance.randint(1, 3))) + str(chance.randint(0, 999)) * (chance.random() < 0.3)
                    for _ in range(count))


def frame(spark: SparkSession, rows: list[tuple], parts: int = 3) -> DataFrame:
    """Rows of (doc_id, text, lang, source), with extra columns whose names operators might use themselves."""
    return spark.createDataFrame(
        [(i, text, lang, source, len(text or ""), "x", "y", 7) for i, text, lang, source in rows], SCHEMA).repartition(parts)


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, few words, repeated rows, equal texts, a very long text."""
    same = prose(1, 40)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n \x0b", None, "b"),
        (4, "one", "en", "b"),
        (5, "one two", "en", None),
        (6, same, "en", None),
        (7, same, "en", "a"),
        (8, same.upper(), "en", "a"),
        (9, same, "en", "a"),
        (9, same, "en", "a"),
        (None, same, "en", "c"),
        (None, None, None, None),
        (12, prose(2, 30_000), "en", "c"),
        (13, prose(3, 60, "de"), "de", "c"),
        (14, prose(4, 60, "fr"), "fr", "c"),
        (15, "é漢字 🙂  x\n\ny ", "fr", "d"),
    ]


def plain_words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
