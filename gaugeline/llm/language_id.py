"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree of variable order: contexts of up to
``order`` bytes with the counts of the byte that followed. In a context, a byte
seen there gets its count over ``total + distinct`` and the escape gets
``distinct`` (method C); escaped bytes share it as the next shorter context
predicts them, seen bytes excluded. With the counts frozen after training, the
bits of a byte seen in its context are fixed, and those of any other byte are the context's
escape bits and its bits in the next shorter context. The trees of all
languages are kept as one sparse table for each order, of the (context, byte) pairs and
contexts that any language has; all contexts that were learned are in it.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.batches import MULTIPLIER, text_slices
from gaugeline.llm.sampling import hash_sample, one_text
from gaugeline.session import materialize

ORDER = 3
DOCS_A_LANGUAGE = 400  # training texts of each language, whole, chosen by hash
MIN_SCORE = 0.5
UNDETERMINED = "und"
BYTES_AT_ONCE = 1 << 18


class Places:
    """Places of sorted keys, found by hashing; a key that is not there has the place -1."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(3, int(4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size, -1, dtype=np.int64)
        self.places = np.full(size, -1, dtype=np.int32)
        waiting, slots = np.arange(len(keys)), self._slots(keys)
        while len(waiting):
            free = self.keys[slots] == -1
            _, first = np.unique(slots[free], return_index=True)
            chosen = np.flatnonzero(free)[first]  # one key for every free slot
            self.keys[slots[chosen]] = keys[waiting[chosen]]
            self.places[slots[chosen]] = waiting[chosen]
            left = np.ones(len(waiting), dtype=bool)
            left[chosen] = False
            waiting, slots = waiting[left], slots[left]
            slots = np.where(self.keys[slots] == -1, slots, (slots + 1) & (size - 1))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(MULTIPLIER)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.places[slots], -1)
        going = np.flatnonzero((held != keys) & (held != -1))
        slots = slots[going]
        while len(going):
            slots = (slots + 1) & (len(self.keys) - 1)
            held, wanted = self.keys[slots], keys[going]
            found[going] = np.where(held == wanted, self.places[slots], -1)
            on = (held != wanted) & (held != -1)
            going, slots = going[on], slots[on]
        return found


@dataclass
class Model:
    """By order from 1: the pairs (context and byte packed) and contexts known, with bits by language.

    ``first`` has the bits of all 256 bytes without a context.
    """

    languages: list[str]
    first: np.ndarray
    pairs: list[Places]
    pair_bits: list[np.ndarray]
    contexts: list[Places]
    escape_bits: list[np.ndarray]


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls in ``part``; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def training_texts(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, text) of ``per_language`` documents of each language at most, chosen by a hash of the id.

    Ids are chosen first, so that only chosen texts are moved; of an id that repeats one text counts.
    """
    narrow = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang").distinct()
    chosen = materialize(hash_sample(narrow, "lang", per_language).select("doc_id", "lang"), "language-sample")
    texts = docs.where("text is not null").select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"], "left_semi")
    return one_text(texts, "lang").select("lang", "text")


def context_counts(texts: DataFrame, order: int) -> DataFrame:
    """(lang, order, code, n): ``code`` packs the context's bytes and the byte that followed.

    Bytes before a text count as spaces.
    """

    def run(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, end, data, starts in text_slices(batch.column(1)):
                for row in range(first, end):
                    part = data[starts[row - first]:starts[row - first + 1]].astype(np.int64)
                    padded = np.concatenate((np.full(order, 32, np.int64), part))
                    code = part.copy()
                    for length in range(order + 1):
                        if length:
                            code = code + (padded[order - length:len(padded) - length] << (8 * length))
                        values, counts = np.unique(code, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([langs[row]] * len(values), pa.string()),
                             pa.array(np.full(len(values), length, np.int32)), pa.array(values), pa.array(counts.astype(np.int64))],
                            ["lang", "length", "code", "n"])

    return texts.mapInArrow(run, "lang string, length int, code bigint, n bigint").groupBy(
        "lang", "length", "code").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, per_language: int = DOCS_A_LANGUAGE, order: int = ORDER) -> Model | None:
    """The model of the languages of ``docs`` (doc_id, text, lang), or None if there are none.

    What reaches the driver is bounded by the sample (``per_language`` texts of
    each language): its distinct contexts and the bytes that followed, all of them.
    """
    if not 1 <= order <= 6:
        raise ValueError("a context has one to six bytes")
    rows = materialize(context_counts(training_texts(docs, per_language), order), "language-contexts").toPandas()
    languages = sorted(rows["lang"].unique())
    if not languages:
        return None
    first, pairs, pair_bits, contexts, escape_bits = np.zeros((256, len(languages))), [], [], [], []
    shorter: list[tuple[np.ndarray, np.ndarray]] = []  # by language: codes and probabilities one order down
    for length in range(order + 1):
        part = rows[rows["length"] == length]
        codes, known = np.unique(part["code"].to_numpy()), np.unique(part["code"].to_numpy() >> 8)
        seen, escapes = np.full((len(codes), len(languages)), np.nan), np.zeros((len(known), len(languages)))
        before, shorter = shorter, []
        for plane, language in enumerate(languages):
            own = part[part["lang"] == language].sort_values("code")
            code, count = own["code"].to_numpy(), own["n"].to_numpy().astype(np.float64)
            # What the shorter context says of the bytes seen here; without a context all bytes are alike.
            below = np.full(len(code), 1 / 256) if not length else before[plane][1][
                np.searchsorted(before[plane][0], code & ((1 << 8 * length) - 1))]
            starts = np.flatnonzero(np.diff(code >> 8, prepend=-1))
            total, taken = np.add.reduceat(count, starts), np.add.reduceat(below, starts)
            distinct = np.diff(np.append(starts, len(code)))
            rest = np.where(distinct < 256, np.maximum(1 - taken, 1e-12), 0.0)
            escape = np.where(rest > 0, distinct, 0)  # nothing left to escape to
            probability = count / np.repeat(total + escape, distinct)
            shorter.append((code, probability))
            seen[np.searchsorted(codes, code), plane] = -np.log2(probability)
            share = np.divide(escape, (total + escape) * rest, out=np.full(len(starts), 1e-12), where=rest > 0)
            escapes[np.searchsorted(known, code[starts] >> 8), plane] = -np.log2(share)
        if length == 0:
            first[:] = escapes + 8.0
            first[codes] = np.where(np.isnan(seen), first[codes], seen)
            continue
        down = codes & ((1 << 8 * length) - 1)
        # Every pair is there one order down too, as some language has it there.
        longer = first[down] if length == 1 else pair_bits[-1][pairs[-1].find(down)]
        bits = np.where(np.isnan(seen), escapes[np.searchsorted(known, codes >> 8)] + longer, seen)
        pairs.append(Places(codes))
        contexts.append(Places(known))
        pair_bits.append(bits)
        escape_bits.append(escapes)
    return Model(languages, first, pairs, [bits.astype(np.float32) for bits in pair_bits], contexts,
                 [bits.astype(np.float32) for bits in escape_bits])


def _byte_bits(model: Model, codes: np.ndarray) -> np.ndarray:
    """Bits of bytes by language; ``codes`` holds each byte and the bytes before it, as in the tables."""
    bits = np.zeros((len(codes), len(model.languages)))
    left, order = np.arange(len(codes)), len(model.pairs)
    for length in range(order, 0, -1):
        code = codes[left] & ((1 << 8 * (length + 1)) - 1)
        place = model.pairs[length - 1].find(code)
        hit = place >= 0
        bits[left[hit]] += model.pair_bits[length - 1][place[hit]]
        left, code = left[~hit], code[~hit]
        context = model.contexts[length - 1].find(code >> 8)
        known = context >= 0
        bits[left[known]] += model.escape_bits[length - 1][context[known]]
    bits[left] += model.first[codes[left] & 255]
    return bits


def code_lengths(model: Model, column: pa.Array) -> np.ndarray:
    """Bits of every text under every language's tree. Long texts are scored in parts of ``BYTES_AT_ONCE``."""
    result = np.zeros((len(column), len(model.languages)))
    order = len(model.pairs)
    for first, _, data, starts in text_slices(column):
        for low in range(0, len(data), BYTES_AT_ONCE):
            high = min(low + BYTES_AT_ONCE, len(data))
            row = np.searchsorted(starts, np.arange(low, high), "right") - 1
            depth = np.arange(low, high) - starts[row]
            code = data[low:high].astype(np.int64)
            for distance in range(1, order + 1):
                before = np.full(high - low, 32, dtype=np.int64)  # bytes before a text count as spaces
                start = max(low - distance, 0)
                before[start + distance - low:] = data[start:high - distance]
                before[depth < distance] = 32
                code |= before << (8 * distance)
            cuts = np.flatnonzero(np.diff(row, prepend=-1))
            result[first + row[cuts]] += np.add.reduceat(_byte_bits(model, code), cuts, axis=0)
    return result


def _guessed(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with __lang_pred and __score."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__lang_pred", T.StringType()), T.StructField("__score", T.DoubleType())])
    place = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        learned = pickle.loads(shared.value)
        names = np.array(learned.languages, dtype=object)
        for batch in batches:
            column = batch.column(place)
            lettered = pc.match_substring_regex(column.fill_null(""), r"\p{L}")
            bits = code_lengths(learned, column)
            weight = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
            lang = pc.if_else(lettered, pa.array(names[bits.argmin(axis=1)], pa.string()), UNDETERMINED)
            score = pc.if_else(lettered, pa.array(1 / weight.sum(axis=1)), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, lang, score], schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1: the posterior of the language, all being equally likely before).

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if no language was learned. Ties go to the first language by
    code point. Columns of ``docs`` called lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    return _guessed(docs, model).withColumnsRenamed({"__lang_pred": "lang_pred", "__score": "score"})


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learned where held_out is false.

    Rows that share an id are judged one by one; a null id is not held out and
    teaches nothing. Extra columns are not read; an empty table gives an empty result.
    """
    out = held_out(F.col("doc_id"), 3, 1)
    model = fit(docs.where(~out))
    return identify(docs.select("doc_id", out.alias("held_out"), "text"), model).drop("text")


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose text has a language of which the model is sure enough; columns as given.

    Null and empty texts go; rows that repeat are judged one by one; an empty table stays empty. Without a language to learn from, every document whose text has a letter is kept.
    """
    model = fit(docs.where(~held_out(F.col("doc_id"), 3, 1)))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    sure = (F.col("__lang_pred") != UNDETERMINED) & (F.col("__score") >= min_score)
    return _guessed(docs, model).where(sure).drop("__lang_pred", "__score")
