"""Toxicity scores by non-negative positive-unlabelled learning.

Positives are texts confirmed as toxic; all other texts count as unlabelled, whatever is said of
them. With the class prior p, the risk of a scorer is p * R(positives as toxic) plus the risk of
taking unlabelled texts for clean, less p * R(positives as clean); that difference cannot be below
zero for a true scorer, so where it becomes negative the step goes the other way, which keeps a
flexible model from explaining the positives away. A prior above the true one keeps turning the steps until
nothing scores as toxic any more; such a prior is lowered. The scorer is linear over indicators of hashed
words and of their first four and five bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm import words as N

BUCKETS = 1 << 18
#: The fit takes about so many confirmed toxic texts and so many unlabelled ones, by a hash.
POSITIVES, UNLABELLED = 3000, 9000
#: A feature must occur in so many of the fitted texts.
LEAST_TEXTS = 4
#: Estimating the prior: confirmed texts at most and at least, folds, and the prior its scorers are trained with.
PRIOR_POSITIVES, LEAST_ROWS, FOLDS, FIRST_PRIOR = 800, 5, 5, 0.1
FEW = 30
#: Share of its confirmed texts that a fitted model must score as toxic.
RECOGNISED = 0.5
STEPS = 300
RATE = 0.5
MOMENTUM = 0.9
#: Lasso weight: words that tell little get none, so the scorer can't learn texts by heart.
SPARSITY = 0.0007


def features(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for each distinct feature of each text, in order."""
    data, offsets = N.text_bytes(column)
    data = N.LOWER[data]
    starts, ends, text = N.spans(N.LETTER[data], offsets)
    rolling = N.Rolling(data)
    found = [(text, rolling.of(starts, ends))]
    for size in (4, 5):
        long = ends - starts > size
        at = starts[long]
        found.append((text[long], N.mix(rolling.of(at, at + size) + np.uint64(size))))
    return N.distinct(
        np.concatenate([t for t, _ in found]),
        np.concatenate([f for _, f in found]) % np.uint64(buckets), buckets,
    )


@dataclass
class Model:
    weight: np.ndarray
    bias: float

    def score(self, text: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        logit = np.bincount(text, self.weight[feature], minlength=rows) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _sparse(rows: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    at = rows.offsets.to_numpy()
    return np.repeat(np.arange(len(rows)), np.diff(at)), rows.values.to_numpy()[at[0]:at[-1]]


def train(positive: pa.ListArray, unlabelled: pa.ListArray, prior: float, buckets: int = BUCKETS) -> Model:
    """Proximal gradient steps with momentum on the non-negative risk with the logistic loss."""
    n_p, n_u = len(positive), len(unlabelled)
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    if not n_p or not n_u:  # nothing confirmed or nothing to compare with: the prior alone
        return Model(np.zeros(buckets), float(np.log(prior / (1 - prior))))
    (row_p, f_p), (row_u, f_u) = _sparse(positive), _sparse(unlabelled)
    frequent = np.bincount(f_p, minlength=buckets) + np.bincount(f_u, minlength=buckets) >= LEAST_TEXTS
    place = np.cumsum(frequent) - 1
    row_p, f_p = row_p[frequent[f_p]], place[f_p[frequent[f_p]]]
    row_u, f_u = row_u[frequent[f_u]], place[f_u[frequent[f_u]]]
    size = int(frequent.sum()) + 1  # the last weight is the bias
    w = np.zeros(size)
    w[-1] = np.log(prior / (1 - prior))
    pace = np.zeros(size)

    def logits(row, f, n):
        return np.bincount(row, w[f], minlength=n) + w[-1]

    def back(row, f, slope):
        return np.append(np.bincount(f, slope[row], minlength=size - 1), slope.sum())

    for _ in range(STEPS):
        z_p, z_u = (np.clip(logits(*x), -30, 30) for x in ((row_p, f_p, n_p), (row_u, f_u, n_u)))
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        as_clean = np.log1p(np.exp(z_u)).mean() - prior * np.log1p(np.exp(z_p)).mean()
        clean = back(row_u, f_u, s_u / n_u) - prior * back(row_p, f_p, s_p / n_p)
        g = prior * back(row_p, f_p, (s_p - 1) / n_p) + clean if as_clean >= 0 else -clean
        pace = MOMENTUM * pace + g
        w[:-1] -= RATE * pace[:-1]
        w[-1] -= 0.3 * RATE * pace[-1]
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - RATE / (1 - MOMENTUM) * SPARSITY, 0)
    weight = np.zeros(buckets)
    weight[frequent] = w[:-1]
    return Model(weight, float(w[-1]))


def _share_above(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    return 1 - np.searchsorted(np.sort(scores), at, "left") / len(scores)


def estimate_prior(
    positive: pa.ListArray, unlabelled: pa.ListArray, folds: tuple[np.ndarray, np.ndarray], buckets: int = BUCKETS
) -> float:
    """The share of toxic texts among unlabelled ones.

    If it is p, at least p times the share of positives lies above any score; so the share of
    unlabelled texts above it, divided by that of the positives, is never below p, and comes near it where
    hardly a clean text scores as high. Each fold is scored by a model of the other ones, and a text that is
    in both samples must be in one fold, or it would be known to the model; the prior is the least quotient over all scores, with half a standard error on top, as it is a least one. Up to
    ``PRIOR_POSITIVES`` and three times as many unlabelled texts take part, the first ones of samples in random order.
    """
    positive, unlabelled = positive[:PRIOR_POSITIVES], unlabelled[:3 * PRIOR_POSITIVES]
    if min(len(positive), len(unlabelled)) < LEAST_ROWS:
        return len(positive) / max(1, len(positive) + len(unlabelled))
    p, u = np.empty(len(positive)), np.empty(len(unlabelled))
    for fold in range(FOLDS):
        parts = []
        for x, in_fold in zip((positive, unlabelled), folds):
            mine = in_fold[:len(x)] % FOLDS == fold
            parts.append((x.take(pa.array(np.flatnonzero(~mine))), x.take(pa.array(np.flatnonzero(mine))), mine))
        (own_p, other_p, at_p), (own_u, other_u, at_u) = parts
        model = train(own_p, own_u, FIRST_PRIOR, buckets)
        p[at_p], u[at_u] = model.score(*_sparse(other_p), len(other_p)), model.score(*_sparse(other_u), len(other_u))
    at = np.quantile(p, np.arange(0.02, 0.8, 0.02))  # below, a few odd positives would decide; above, too few
    above = _share_above(u, at)
    error = np.sqrt(np.maximum(above * (1 - above), 1 / len(u)) / len(u))
    return float(min(((above + error / 2) / np.maximum(_share_above(p, at), 1e-9)).min(), 1.0))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
    prior: float | None = None,
) -> Model:
    """Learn from ``labels``: documents with label 1 are confirmed; the unlabelled sample is drawn from all
    documents. Without a ``prior``, the share of toxic ones is estimated from scores; with fewer than ``FEW``
    confirmed documents that is too rough, and their share among labelled rows counts if some have label 0.

    Both samples are of bounded size and chosen by a hash, of the id for confirmed documents, of id and
    text for unlabelled ones; rows equal in both count once, so one that is repeated without end takes
    one place. The ids of the confirmed sample, some ``POSITIVES``, are the driver's to broadcast; the
    samples' features go to the driver. Without a confirmed document everything scores as clean.
    """
    marks = labels.filter((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    scale = 1 << 30

    def sample(most: int, of: int, *by: Column | str) -> Column:
        share = min(1.0, most / max(1, of))
        return F.pmod(F.xxhash64(*by), F.lit(scale)) < F.lit(share * scale)

    chosen = marks.filter(sample(POSITIVES, marks.count(), F.lit(1), "_id")).withColumn("positive", F.lit(True))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("unlabelled", sample(UNLABELLED, rows.count(), F.lit(2), "_id", "text"))
    rows = rows.join(F.broadcast(chosen), "_id", "left").filter("positive OR unlabelled")
    rows = rows.withColumn("rank", F.xxhash64(F.lit(3), "_id", "text")).dropDuplicates(["rank"])
    rows = rows.select("text", F.coalesce("positive", F.lit(False)).alias("positive"), "unlabelled", "rank")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in N.slices(batches, 0):
            lists = N.rows_of(*(x.astype(np.int32) for x in features(batch.column(0))), batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists], names=["positive", "unlabelled", "rank", "features"])

    schema = "positive boolean, unlabelled boolean, rank long, features array<int>"
    found = rows.mapInArrow(extract, schema).toArrow().sort_by("rank")

    def sampled(flag: str) -> tuple[pa.ListArray, np.ndarray]:
        rows = found.filter(found.column(flag)).combine_chunks()
        lists = rows.column("features").combine_chunks() if len(rows) else pa.array([], pa.list_(pa.int32()))
        return lists, rows.column("rank").to_numpy().astype(np.uint64)

    (positive, fold_p), (unlabelled, fold_u) = sampled("positive"), sampled("unlabelled")
    if prior is None and len(positive) < FEW:
        clean, toxic = labels.filter(F.col(id_col).isNotNull()).agg(F.count_if(F.col(label_col) == 0), F.count_if(F.col(label_col) == 1)).first()
        prior = toxic / (clean + toxic) if clean else None
    if prior is None:
        prior = estimate_prior(positive, unlabelled, (fold_p, fold_u))
    while True:
        model = train(positive, unlabelled, prior)
        if not len(positive) or prior < 1e-3 or (model.score(*_sparse(positive), len(positive)) >= 0.5).mean() >= RECOGNISED:
            return model
        prior *= 0.8


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """doc (struct of ``carry``) and score, 0 to 1, of every text; null counts as empty.

    A text without words gets the score of the bias alone. Equal texts get equal scores. Only
    texts go to Python; carried columns stay where they are.
    """
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [
            model.score(*features(part.column(0)), part.num_rows) for part in N.slices([batch], 0)
        ]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    scored = F.arrow_udf(score, "double")
    return docs.select(F.struct(*carry).alias("doc"), scored(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))
