"""Column expressions over text. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline import fixed_values as fv


def strip(text: Column) -> Column:
    """Drop white space (any Unicode white space, not only blanks) at both ends."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one blank; ends are stripped."""
    return F.btrim(F.regexp_replace(text, fv.WHITESPACE_CLASS + "+", " "))


def or_empty(text: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def first_long_value(values: Column, min_chars: int = fv.ABSTRACT_MIN_CHARS) -> Column:
    """First value of a map that is longer than ``min_chars``, cleaned, else ''."""
    longer = F.filter(F.map_values(values), lambda v: F.length(v) > min_chars)
    return F.coalesce(collapse_whitespace(F.get(longer, 0)), F.lit(""))


def join_list_or_scalar(raw_json: Column, sep: str = ";") -> Column:
    """A JSON list becomes ``sep``-joined text, a scalar passes through, null is ''."""
    as_list = F.array_join(F.from_json(raw_json, "array<string>"), sep)
    return or_empty(F.when(F.startswith(raw_json, F.lit("[")), as_list).otherwise(raw_json))


def split_and_strip(text: Column, sep: str) -> Column:
    """Split on a literal separator and strip each item."""
    literal = "\\Q" + sep + "\\E"
    return F.transform(F.split(text, literal), strip)


def text_url(pdf_url: Column) -> Column:
    """Address of the extracted text of a ``/pdf/….pdf`` address, else null."""
    is_pdf = F.contains(pdf_url, F.lit("/pdf/")) & F.endswith(F.lower(pdf_url), F.lit(".pdf"))
    secure = F.replace(pdf_url, F.lit("http://"), F.lit("https://"))
    moved = F.replace(secure, F.lit("/pdf/"), F.lit("/text/"))
    stem = F.substring(moved, F.lit(1), F.length(moved) - 4)
    return F.when(is_pdf, F.concat(stem, F.lit(".txt")))


def slices(text: Column, width: int) -> Column:
    """Consecutive pieces of ``width`` characters, the last one shorter."""
    return F.regexp_extract_all(or_empty(text), F.lit("(?s).{1,%d}" % width), F.lit(0))


def sentences(text: Column) -> Column:
    """Sentences and lines, stripped, empties dropped."""
    parts = F.transform(F.split(text, fv.SENTENCE_BREAK), strip)
    return F.filter(parts, lambda s: s != "")


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, stripped, empties dropped."""
    parts = F.transform(F.split(text, fv.PARAGRAPH_BREAK), strip)
    return F.filter(parts, lambda s: s != "")


def words(text: Column) -> Column:
    """Lower-cased words; a word beyond the length limit is cut into several."""
    return F.regexp_extract_all(F.lower(text), F.lit(fv.WORD_PATTERN), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    A function passed to ``transform`` or ``filter`` computes the columns it
    refers to again for every element; what it gets as its argument is computed
    already.
    """
    return F.get(F.transform(F.array(value), body), 0)


def counted(items: Column) -> Column:
    """Distinct items of an array with their counts, as structs (word, tf).

    The array is sorted, and each item's count is the distance between the
    places where it and its successor begin; nothing leaves the row.
    """

    def count_sorted(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)))

        def count_from(starts: Column) -> Column:
            return F.transform(starts, lambda start, n: F.struct(
                F.get(ordered, start - 1).alias("word"),
                (F.coalesce(F.get(starts, n + 1), F.size(ordered) + 1) - start).alias("tf")))

        return let(starts, count_from)

    # The items may be costly to make, so they are made once for their number and their order.
    return let(items, lambda made: F.when(F.size(made) > 0, let(F.sort_array(made), count_sorted)))


def thousands(value: Column) -> Column:
    """A double with thousands separators and its shortest decimal part."""
    return F.call_function("format_number", value, F.lit(fv.THOUSANDS_FORMAT))


def citations(text: Column) -> Column:
    """Numbers N of every ``[Doc_N]`` label, in order."""
    found = F.regexp_extract_all(text, F.lit(fv.CITATION_PATTERN), F.lit(1))
    return F.transform(found, lambda n: n.try_cast("long"))


def citations_valid(text: Column, blocks: Column) -> Column:
    """True without blocks; else at least one label and all within 1..blocks."""
    cited = citations(text)
    in_range = F.forall(cited, lambda n: F.coalesce(n.between(1, blocks), F.lit(False)))
    return F.when(blocks == 0, F.lit(True)).otherwise((F.size(cited) > 0) & in_range)


def citation_labels(context: Column) -> Column:
    """How many ``[Doc_`` labels open in a context."""
    return F.regexp_count(context, F.lit("\\Q" + fv.CITATION_OPENING + "\\E"))


def canonical_uuid(text: Column) -> Column:
    """The identifier in its usual 8-4-4-4-12 form, or null if it is not one."""
    bare = F.lower(F.regexp_replace(text, r"^\{+|\}+$|urn:|uuid:|-", ""))
    dashed = F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(bare.rlike(fv.UUID_DIGITS), dashed)


def contains_any(text: Column, terms: list[str]) -> Column:
    """Whether lower-cased ``text`` contains one of the terms."""
    lowered = F.lower(text)
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(lowered, F.lit(term))
    return found


def expand_phrases(text: Column, rules: list[tuple[str, list[str]]] | None = None) -> Column:
    """The text itself plus the synonyms of every rule term it contains.

    A synonym already present (ignoring case) is skipped; order is the order of
    the rules and repeated phrases are dropped.
    """
    lowered = F.lower(text)
    phrases = [F.array(text)]
    for term, synonyms in rules if rules is not None else fv.SYNONYMS:
        known = F.array(*[F.lit(s) for s in synonyms])
        fresh = F.filter(known, lambda s: ~F.contains(lowered, F.lower(s)))
        empty = F.array().cast("array<string>")
        phrases.append(F.when(F.contains(lowered, F.lit(term)), fresh).otherwise(empty))
    return F.array_distinct(F.concat(*phrases))


def resolve_countries(
    text: Column,
    aliases: list[tuple[str, str]] | None = None,
    region_words: list[str] | None = None,
    region_countries: list[str] | None = None,
    default: str = fv.DEFAULT_COUNTRY,
    word_boundary: bool = False,
) -> Column:
    """Codes of the countries a question is about, in alias order.

    A region word stands for its fixed list of codes. Without any match the
    default country is returned. ``word_boundary`` asks for whole words instead
    of plain containment.
    """
    lowered = F.lower(text)
    aliases = aliases if aliases is not None else fv.COUNTRY_ALIASES
    region_words = region_words if region_words is not None else fv.REGION_WORDS
    region_countries = region_countries if region_countries is not None else fv.REGION_COUNTRIES

    def mentioned(name: str) -> Column:
        if word_boundary:
            return lowered.rlike(r"(?<![\p{L}\p{N}])\Q" + name + r"\E(?![\p{L}\p{N}])")
        return F.contains(lowered, F.lit(name))

    hits = F.array(*[F.when(mentioned(name), F.lit(code)) for name, code in aliases])
    found = F.array_distinct(F.array_compact(hits))
    region = F.array(*[F.lit(code) for code in region_countries])
    named = F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(default)))
    return F.when(contains_any(text, region_words), region).otherwise(named)


def mentioned_year(text: Column) -> Column:
    """First year 20xx standing alone in the text, or null."""
    found = F.regexp_extract(text, "(?U)" + fv.YEAR_PATTERN, 1)
    return F.nullif(found, F.lit("")).cast("int")

