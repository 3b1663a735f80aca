import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm.language_id import Places, code_lengths, fit, identify, keep_known, language_report, training_texts
from tests.llm.corpora import TABLES, frame, odd_rows, prose

LANGS = ("en", "de", "fr")


def training_rows():
    return [(n, prose(n, 30, LANGS[n % 3]), LANGS[n % 3], "a") for n in range(60)]


def exact_bits(texts, symbols, text, order=3):
    """Code length by the definition, context by context, with exact fractions."""
    counts = defaultdict(Counter)
    for one in texts:
        data = b" " * order + one.encode()
        for at in range(order, len(data)):
            for length in range(order + 1):
                counts[data[at - length:at]][data[at]] += 1

    @cache
    def probability(context, symbol):
        if context is None:
            return Fraction(1, 256)
        shorter = context[1:] if context else None
        seen = counts.get(context)
        if not seen:
            return probability(shorter, symbol)
        total, distinct = sum(seen.values()), len(seen)
        left = sum(probability(shorter, s) for s in range(256) if s not in seen) if distinct < 256 else 0
        if symbol in seen:
            return Fraction(seen[symbol], total + (distinct if left else 0))
        return Fraction(distinct, total + distinct) * probability(shorter, symbol) / left

    data, bits = b" " * order + text.encode(), 0.0
    for at in range(order, len(data)):
        context = data[at - order:at]
        while context and context not in counts:
            context = context[1:]
        bits -= np.log2(float(probability(context, data[at])))
    return bits


def test_code_lengths_equal_the_definition(spark):
    rows = [(1, "abab aba", "x", "a"), (2, "bcb cbcb", "y", "a")]
    model = fit(frame(spark, rows))
    for text in ("aba", "cab", "b q a", "ab" * 6):
        found = code_lengths(model, pa.array([text]))[0]
        for place, (_, learned, *_rest) in enumerate(rows):
            assert found[place] == pytest.approx(exact_bits([learned], 256, text), rel=1e-4)


class Tree:
    """A context tree by the definition: each context's distribution over all 256 bytes, when asked for."""

    def __init__(self, texts, order):
        self.order, self.counts, self.known = order, defaultdict(Counter), {}
        for one in texts:
            data = b" " * order + one.encode()
            for at in range(order, len(data)):
                for length in range(order + 1):
                    self.counts[data[at - length:at]][data[at]] += 1

    def distribution(self, context):
        if context in self.known:
            return self.known[context]
        found = shorter = self.distribution(context[1:]) if context else np.full(256, 1 / 256)
        if context in self.counts:
            seen = np.zeros(256)
            for symbol, n in self.counts[context].items():
                seen[symbol] = n
            rest = np.where(seen > 0, 0.0, shorter)
            escape = (seen > 0).sum() if rest.sum() > 0 else 0
            found = (seen + escape * rest / max(rest.sum(), 1e-300)) / (seen.sum() + escape)
        self.known[context] = found
        return found

    def bits(self, text):
        data = b" " * self.order + text.encode()
        pairs = Counter((data[at - self.order:at], data[at]) for at in range(self.order, len(data)))
        return -sum(n * np.log2(self.distribution(context)[symbol]) for (context, symbol), n in pairs.items())


def guesses(docs):
    """(lang_pred, score) of every row (doc_id, text, lang) by the definition, learned from all texts not held out."""
    learned = defaultdict(list)
    for doc_id, text, lang in docs:
        if text is not None and lang is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1:
            learned[lang].append(text)
    trees, found = {lang: Tree(texts, 3) for lang, texts in sorted(learned.items())}, {}
    for doc_id, text, _ in docs:
        if not any(c.isalpha() for c in text or ""):
            found[doc_id] = ("und", 0.0)
            continue
        bits = np.array([tree.bits(text) for tree in trees.values()])
        found[doc_id] = (list(trees)[bits.argmin()], 1 / np.exp2(np.maximum(bits.min() - bits, -1000)).sum())
    return found


def test_the_report_equals_the_definition_on_the_table(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    expected = guesses([(r["doc_id"], r["text"], r["lang"]) for r in docs.select("doc_id", "text", "lang").collect()])
    for r in language_report(docs).collect():
        lang, score = expected[r["doc_id"]]
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-3), r["doc_id"]


@pytest.mark.parametrize("order", [1, 3, 4])
def test_all_contexts_of_the_table_equal_the_definition(spark, order):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").where("length(text) < 1500")
    model = fit(docs, per_language=12, order=order)
    learned = defaultdict(list)
    for r in training_texts(docs, 12).collect():
        learned[r["lang"]].append(r["text"])
    assert sorted(learned) == model.languages and all(len(texts) <= 12 for texts in learned.values())
    for text in [r["text"] for r in docs.orderBy("doc_id").limit(4).collect()] + ["\n\n  ", "É漢 zzz 123"]:
        found = code_lengths(model, pa.array([text]))[0]
        for place, language in enumerate(model.languages):
            assert found[place] == pytest.approx(Tree(learned[language], order).bits(text), rel=1e-5), (language, text)


def test_the_sample_is_bounded_by_rows(spark):
    rows = [(n % 40, f"{prose(n, 5)} {n}", "en", "a") for n in range(2000)]
    assert training_texts(frame(spark, rows), 25).count() == 25
    assert training_texts(frame(spark, rows), 60).count() == 40


def test_places_find_what_is_there():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 50_000))
    places = Places(keys)
    assert (places.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(np.arange(0, 200_000, 3), keys)
    assert (places.find(other) == -1).all()
    assert (Places(keys[:0]).find(keys) == -1).all() and len(places.find(keys[:0])) == 0


def test_batches_and_slices_do_not_matter(spark):
    model = fit(frame(spark, training_rows()))
    texts = [prose(900 + n, 1 + n * 37, LANGS[n % 3]) for n in range(9)] + ["", None, "x" * 300_000]
    together = code_lengths(model, pa.array(texts))
    apart = np.concatenate([code_lengths(model, pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, apart, rtol=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_documents_teach_nothing(spark):
    rows = training_rows()
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows]
    one, two = (sorted(map(tuple, language_report(frame(spark, r)).collect())) for r in (rows, wrong))
    assert one == two


def test_odd_texts(spark):
    found = {r["doc_id"]: r for r in language_report(frame(spark, training_rows() + [(1000 + (i or 0), *r) for i, *r in odd_rows()])).collect()}
    assert [found[1000 + i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert found[1013]["lang_pred"] == "de" and found[1014]["lang_pred"] == "fr" and found[1012]["lang_pred"] == "en"


def test_keep_known_and_empty(spark):
    docs = frame(spark, training_rows() + odd_rows())
    kept = keep_known(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {6, 7, 12, 13, 14} <= ids and not {r["doc_id"] for r in kept.where("text is null or text = ''").collect()}
    empty = docs.limit(0)
    assert keep_known(empty).collect() == [] and language_report(empty).collect() == []
    unlabelled = frame(spark, [(1, "text", None, "a")])
    assert [r["lang_pred"] for r in language_report(unlabelled).collect()] == ["und"]
    assert identify(docs.withColumnRenamed("kept", "score"), None).columns[-2:] == ["lang_pred", "score"]


def test_keep_known_without_a_language_keeps_texts_with_letters(spark):
    rows = [(i, text, None, source) for i, text, _, source in odd_rows()]
    kept = keep_known(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(
        str(i) for i, text, *_ in rows if any(c.isalpha() for c in text or ""))
    held_out = [n for n in range(30) if zlib.crc32(str(n).encode()) % 3 == 1]
    assert keep_known(frame(spark, [(n, prose(n, 20), "en", "a") for n in held_out])).count() == len(held_out)
