"""Toxicity by non-negative positive-unlabelled (PU) learning.

Confirmed toxic texts are the positive sample; texts taken without regard to
any label are the unlabelled one. With the class prior ``p``, the risk of calling
clean texts toxic is that of the unlabelled sample less ``p`` times that of the
positives; where this estimate turns negative, it is not followed further down.
The prior itself is estimated from the two samples only. The classifier is
linear over all words and word beginnings that positives have more often than
the unlabelled, by a test of their shares.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.batches import LOWER, SEED, text_slices, words
from gaugeline.llm.language_id import held_out
from gaugeline.llm.sampling import hash_sample, one_text
from gaugeline.session import materialize

MAX_POSITIVE = 4000  # texts of each sample, whole, chosen by a hash of the id
MAX_UNLABELLED = 8000
BUCKETS = 1 << 20
PREFIXES = (None, 4, 5, 6)  # whole words, and their first bytes
LEAST_Z = 3.0  # standard errors by which a feature's share among positives is above that among the unlabelled
STEPS = 1000
RATE = 0.2
DECAY = 1e-5

# Lower-cased, and ASCII punctuation parts words.
_PLAIN = LOWER.copy()
for _low, _high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _PLAIN[_low:_high] = 0x20


@dataclass
class Model:
    """``weights`` by feature bucket, and the logit of a text without any feature."""

    weights: np.ndarray
    bias: float


def features(data: np.ndarray, starts: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct features of each row of a slice, in row order."""
    plain = _PLAIN[data]
    found = []
    for salt, prefix in enumerate(PREFIXES):
        hashes, row, _ = words(plain, starts, prefix)
        bucket = ((hashes + np.uint64(salt * SEED % (1 << 64))) % np.uint64(BUCKETS)).astype(np.int64)
        if wanted is not None:
            keep = wanted[bucket]
            bucket, row = bucket[keep], row[keep]
        found.append(row * BUCKETS + bucket)
    both = np.unique(np.concatenate(found))
    return both // BUCKETS, both % BUCKETS


def samples(docs: DataFrame, labels: DataFrame, max_positive: int, max_unlabelled: int) -> DataFrame:
    """(kind, text): 1 for confirmed toxic, 0 for unlabelled texts, so many rows at most.

    A text may be in both, as unlabelled texts include toxic ones; of an id that repeats one text counts.
    """
    ids = docs.where("text is not null and doc_id is not null").select("doc_id").distinct()
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    pool = ids.select(F.lit(0).alias("kind"), "doc_id").unionByName(
        ids.join(toxic, "doc_id", "left_semi").select(F.lit(1).alias("kind"), "doc_id"))
    chosen = hash_sample(pool, "kind", {1: max_positive, 0: max_unlabelled})
    texts = docs.where("text is not null").select("doc_id", "text").join(
        materialize(chosen.select("kind", "doc_id"), "toxicity-sample"), "doc_id")
    return one_text(texts, "kind").select("kind", "text")


def _counted(sample: DataFrame) -> DataFrame:
    """(bucket, positive, unlabelled): in how many texts of each sample a feature occurs."""

    def run(batches):
        for batch in batches:
            kinds = np.asarray(batch.column(0)).astype(bool)
            for first, end, data, starts in text_slices(batch.column(1)):
                row, bucket = features(data, starts)
                toxic = kinds[first:end][row]
                names, place = np.unique(bucket, return_inverse=True)
                positive = np.bincount(place, weights=toxic, minlength=len(names))
                every = np.bincount(place, minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(positive.astype(np.int64)), pa.array((every - positive).astype(np.int64))],
                    ["bucket", "positive", "unlabelled"])

    return sample.mapInArrow(run, "bucket bigint, positive bigint, unlabelled bigint").groupBy("bucket").agg(
        F.sum("positive").alias("positive"), F.sum("unlabelled").alias("unlabelled"))


def _rows(sample: DataFrame, chosen: np.ndarray) -> DataFrame:
    """(kind, own): the chosen features of each text, by their place in ``chosen``."""
    shared = sample.sparkSession.sparkContext.broadcast(chosen)

    def run(batches):
        place = np.full(BUCKETS, -1, dtype=np.int32)
        place[shared.value] = np.arange(len(shared.value))
        for batch in batches:
            own = [[] for _ in range(batch.num_rows)]
            for first, end, data, starts in text_slices(batch.column(1)):
                row, bucket = features(data, starts, place >= 0)
                cut = np.searchsorted(row, np.arange(end - first + 1))
                for one in range(end - first):
                    own[first + one] = place[bucket[cut[one]:cut[one + 1]]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int32()))], ["kind", "own"])

    return sample.mapInArrow(run, "kind int, own array<int>")


def estimate_prior(kind: np.ndarray, row: np.ndarray, column: np.ndarray, width: int) -> float:
    """The share of positives among the unlabelled, from the two samples alone.

    Whatever positives hold, the unlabelled hold at least ``p`` times as often,
    so no set of texts has a smaller ratio of its share among the unlabelled to that
    among positives than ``p``. The sets tried are the texts above each level of
    a naive Bayes score. Scores come from one half of the texts and shares from
    the other, both ways; a share counts with one standard error, so that small sets do not decide.
    """
    half = np.arange(len(kind)) % 2
    found = []
    for own in (0, 1):
        train, test = half == own, half != own
        counts = [np.bincount(column[(train & (kind == k))[row]], minlength=width) + 0.5 for k in (0, 1)]
        sizes = [max((train & (kind == k)).sum(), 1) + 1 for k in (0, 1)]
        weight = np.log(counts[1] / sizes[1]) - np.log(counts[0] / sizes[0])
        score = np.bincount(row, weights=weight[column], minlength=len(kind))
        levels = np.unique(score[test & (kind == 1)])
        above = [len(x) - np.searchsorted(x, levels, "left") for x in (np.sort(score[test & (kind == k)]) for k in (0, 1))]
        n = [max((test & (kind == k)).sum(), 1) for k in (0, 1)]
        shares = [above[k] / n[k] for k in (0, 1)]
        errors = [np.sqrt(np.maximum(shares[k] * (1 - shares[k]), 1 / n[k]) / n[k]) for k in (0, 1)]
        low = shares[1] - errors[1]
        ratios = (shares[0] + errors[0])[low > 0] / low[low > 0]
        found.append(ratios.min() if len(ratios) else 1.0)
    return float(min(max(np.mean(found), 0.001), 0.5))


def _train(kind: np.ndarray, row: np.ndarray, column: np.ndarray, width: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk (logistic loss) with Adam.

    All features speak for toxicity, so a text without any is no likelier toxic
    than a text of which nothing is known: the bias is at most the prior's logit.
    """
    rows = len(kind)
    positive = kind == 1
    share_p = np.where(positive, 1 / max(positive.sum(), 1), 0.0)
    share_u = np.where(~positive, 1 / max((~positive).sum(), 1), 0.0)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        logit = theta[-1] + np.bincount(row, weights=theta[column], minlength=rows)
        toxic = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        as_clean = -np.log(np.maximum(1 - toxic, 1e-12))
        clean_risk = (share_u * as_clean).sum() - prior * (share_p * as_clean).sum()
        clean_slope = share_u * toxic - prior * share_p * toxic
        # Below zero the estimate is wrong: step back from it and leave the rest alone.
        slope = -clean_slope if clean_risk < 0 else clean_slope + prior * share_p * (toxic - 1)
        gradient = np.append(np.bincount(column, weights=slope[row], minlength=width), slope.sum())
        gradient[:-1] += DECAY * theta[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        theta[-1] = min(theta[-1], np.log(prior / (1 - prior)))
    return theta[:-1], float(theta[-1])


def fit(
    docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
    prior: float | None = None,
) -> Model | None:
    """The classifier, or None without a toxic text.

    ``prior`` is the share of toxic texts; by default it is estimated from the two samples. The driver gets, for each
    sampled text, which of the features that pass the test it has.
    """
    sample = materialize(samples(docs, labels, max_positive, max_unlabelled), "toxicity-texts")
    sizes = {row["kind"]: row["count"] for row in sample.groupBy("kind").count().collect()}
    if not sizes.get(1):
        return None
    p = (F.col("positive") + 0.5) / (sizes[1] + 1)
    u = (F.col("unlabelled") + 0.5) / (sizes.get(0, 0) + 1)
    z = (p - u) / F.sqrt(p * (1 - p) / (sizes[1] + 1) + u * (1 - u) / (sizes.get(0, 0) + 1))
    best = _counted(sample).where(z > LEAST_Z).select("bucket").collect()
    chosen = np.sort(np.array([row["bucket"] for row in best], dtype=np.int64))
    weights = np.zeros(BUCKETS, dtype=np.float32)
    rows = _rows(sample, chosen).orderBy("kind", "own").toPandas()
    kind = rows["kind"].to_numpy()
    counts = rows["own"].map(len).to_numpy()
    row = np.repeat(np.arange(len(rows)), counts)
    column = np.concatenate([np.asarray(x, dtype=np.int64) for x in rows["own"]] or [np.zeros(0, np.int64)])
    if prior is None:
        prior = estimate_prior(kind, row, column, len(chosen))
    learned, bias = _train(kind, row, column, len(chosen), prior)
    weights[chosen] = learned
    return Model(weights, bias)


def toxicity_scores(column: pa.Array, model: Model) -> np.ndarray:
    logits = np.full(len(column), model.bias)
    used = model.weights != 0
    for first, _, data, starts in text_slices(column):
        row, bucket = features(data, starts, used)
        np.add.at(logits, first + row, model.weights[bucket].astype(np.float64))
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score (0 to 1). A null or empty text has the score of a text without features; without a model all are 0."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches):
        learned = pickle.loads(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(toxicity_scores(batch.column(1), learned))], ["doc_id", "score"])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; learned where held_out is false.

    Rows that share a doc_id are scored one by one; null labels teach nothing,
    and an id that any row labels 1 is toxic. Extra columns are not read; an
    empty table gives an empty result.
    """
    out = held_out(F.col("doc_id"), 5, 0)
    model = fit(docs.where(~out), labels.where(~out))
    return score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
