import pytest
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv
from gaugeline.functions import dates, text


def evaluate(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'bigint' if isinstance(v, int) else 'double'}"
                       for k, v in values.items()) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("question, expected", [
    ("Kinh tế Việt Nam", ["VNM"]),
    ("So sánh ASEAN", fv.REGION_COUNTRIES),
    ("GDP của Indonesia và Thái Lan", ["IDN", "THA"]),
    ("Dữ liệu thế giới", ["VNM"]),
])
def test_country_resolution(spark, question, expected):
    assert evaluate(spark, text.resolve_countries(F.col("q")), q=question) == expected


def test_country_words_can_be_whole_words_only(spark):
    inside = text.resolve_countries(F.col("q"))
    whole = text.resolve_countries(F.col("q"), word_boundary=True)
    assert evaluate(spark, inside, q="is that so in Laos") == ["THA", "LAO"]
    assert evaluate(spark, whole, q="is that so in Laos") == ["LAO"]


def test_expand_skips_synonyms_already_there(spark):
    phrases = evaluate(spark, text.expand_phrases(F.col("q")), q="Lạm phát CPI, xuất khẩu và nhập khẩu")
    assert phrases == ["Lạm phát CPI, xuất khẩu và nhập khẩu", "inflation", "consumer price index",
                       "export", "exports", "trade", "import", "imports"]


@pytest.mark.parametrize("answer, blocks, expected", [
    ("nothing cited", 0, True),
    ("nothing cited", 2, False),
    ("see [Doc_3]", 2, False),
    ("see [Doc_1][Doc_2]", 2, True),
    ("see [Doc_0]", 2, False),
    ("see [Doc_99999999999999999999]", 2, False),
])
def test_citations(spark, answer, blocks, expected):
    assert evaluate(spark, text.citations_valid(F.col("t"), F.col("n")), t=answer, n=blocks) is expected


@pytest.mark.parametrize("url, expected", [
    ("http://h/x/pdf/y.pdf", "https://h/x/text/y.txt"),
    ("https://h/pdf/y.PDF", "https://h/text/y.txt"),
    ("http://h/x/doc/y.pdf", None),
    ("http://h/x/pdf/y.html", None),
])
def test_text_url(spark, url, expected):
    assert evaluate(spark, text.text_url(F.col("u")), u=url) == expected


@pytest.mark.parametrize("question, expected", [
    ("in 2019 and 2020", 2019), ("x2019 20190", None), ("năm 1999", None), ("(2021)", 2021)])
def test_year(spark, question, expected):
    assert evaluate(spark, text.mentioned_year(F.col("q")), q=question) == expected


@pytest.mark.parametrize("value", [0.0, 1.5, 100.0, 1234567.89, -9876.5, 0.001, 123456789012.25])
def test_thousands(spark, value):
    assert evaluate(spark, text.thousands(F.col("v")), v=value) == f"{value:,}"


@pytest.mark.parametrize("given, valid", [
    ("9D5ED678-FE57-BCCA-6101-40957AFAB571", True),
    ("{9d5ed678fe57bcca610140957afab571}", True),
    ("urn:uuid:9d5ed678-fe57-bcca-6101-40957afab571", True),
    ("9d5ed678", False), ("", False), ("no-such-session", False)])
def test_uuid(spark, given, valid):
    expected = "9d5ed678-fe57-bcca-6101-40957afab571" if valid else None
    assert evaluate(spark, text.canonical_uuid(F.col("s")), s=given) == expected


def test_whitespace_is_any_white_space(spark):
    given = "\u2003 a\u00a0\u00a0b\x1c\x85c \u3000"
    assert evaluate(spark, text.collapse_whitespace(F.col("t")), t=given) == " ".join(given.split())
    assert evaluate(spark, text.strip(F.col("t")), t=given) == given.strip()


def test_first_long_value_and_join(spark):
    row = spark.sql("select map('a', 'short', 'b', ' a  longer value ') m, map('a', 'x') n, cast(null as map<string,string>) z")
    out = row.select(text.first_long_value(F.col("m")), text.first_long_value(F.col("n")), text.first_long_value(F.col("z"))).first()
    assert tuple(out) == ("a longer value", "", "")
    for raw, expected in (('["Laos","Peru"]', "Laos;Peru"), ("Laos", "Laos"), (None, "")):
        assert evaluate(spark, text.join_list_or_scalar(F.col("r")), r=raw) == expected


def test_counted_matches_a_counter(spark):
    from collections import Counter

    words = "to be or not to be that is the the the question".split()
    out = spark.createDataFrame([(words,), ([],)], "w array<string>").select(text.counted(F.col("w")).alias("c")).collect()
    assert {r["word"]: r["tf"] for r in out[0]["c"]} == Counter(words)
    assert out[1]["c"] is None


def test_long_words_are_cut(spark):
    found = evaluate(spark, text.words(F.col("t")), t="A" * 600 + " b_c d’é")
    assert [len(w) for w in found] == [255, 255, 90, 1, 1, 1, 1]


def test_slices(spark):
    assert evaluate(spark, text.slices(F.col("t"), 4), t="abcdefghij") == ["abcd", "efgh", "ij"]
    assert evaluate(spark, text.slices(F.col("t"), 4), t="") == []


def test_load_year_and_calendar(spark):
    out = spark.sql("select date'2024-06-30' a, date'2024-07-01' b").select(
        dates.load_year(F.col("a")), dates.load_year(F.col("b")), dates.is_quarter_end_month(F.col("a"))).first()
    assert tuple(out) == (2023, 2024, True)
    calendar = dates.generate_calendar(spark)
    assert calendar.count() == 29585
    sunday = calendar.filter("full_date = date'2024-07-07'").first()
    assert (sunday["date_key"], sunday["day_of_week"], sunday["is_weekend"], sunday["month_name"]) == (20240707, 1, True, "July")
