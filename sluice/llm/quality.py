"""Quality scores by naive Bayes support vectors.

Features are indicators of hashed n-grams: words, and runs of one to three word kinds (length,
capitals, digits, last mark, repeated or not). Each indicator is scaled by its log-count ratio
between the classes, counted over all labelled training texts; a linear hinge-loss model over the
scaled indicators is then fitted by dual coordinate descent on a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.llm import words as N
from sluice.llm.common import Stage

#: Hashed features; bounds the model and the counts the driver receives.
BUCKETS = 1 << 17
#: The model is fitted on about so many labelled rows, chosen by a hash; counts cover all rows.
FIT_ROWS = 6000
#: One of so many fitted rows is held back to turn margins into probabilities.
CALIBRATION = 4
PASSES = 12
COST = 1.0


def _kinds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A small code for the look of each word."""
    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[ends] - sums[starts]

    upper = count((data >= 65) & (data <= 90))
    letters = count(N.LETTER[data])
    digits = count((data >= 48) & (data <= 57))
    size = np.searchsorted([2, 3, 5, 9, 15], ends - starts, "right")
    capitals = np.where(upper == 0, 0, np.where((upper > 1) & (2 * upper >= letters), 2, 1))
    last = data[ends - 1]
    mark = np.where(N.LETTER[last], 0, last)
    again = np.zeros(len(h), np.int64)
    for back in (1, 2):
        same = (h[back:] == h[:-back]) & (text[back:] == text[:-back])
        again[back:] |= same.astype(np.int64) << (back - 1)
    code = size * 3 + capitals
    for part, width in ((digits > 0, 2), (again, 4), (mark, 256), (2 * letters < ends - starts, 2)):
        code = code * width + part
    return code.astype(np.uint64)


def features(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) for each distinct feature of each text, in order."""
    data, offsets = N.text_bytes(column)
    starts, ends, text = N.spans(~N.SEPARATOR[data], offsets)
    h = N.Rolling(N.LOWER[data]).of(starts, ends)
    kind = N.mix(_kinds(data, starts, ends, text, h))
    found = [(text, h)]
    gram = np.zeros(len(kind), np.uint64)
    for size in (1, 2, 3):
        gram = (gram[:-1] if size > 1 else gram) * np.uint64(31) + kind[size - 1:]
        whole = text[:len(gram)] == text[size - 1:]
        found.append((text[:len(gram)][whole], N.mix(gram[whole] + np.uint64(size))))
        if not len(gram):
            break
    return N.distinct(
        np.concatenate([t for t, _ in found]),
        np.concatenate([f for _, f in found]) % np.uint64(buckets), buckets,
    )


@dataclass
class Model:
    """Score of a text: slope * (sum of weights / length of the scaled indicators + bias) + shift."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, text: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        size = np.sqrt(np.bincount(text, self.ratio[feature] ** 2, minlength=rows))
        margin = np.bincount(text, self.weight[feature], minlength=rows) / np.maximum(size, 1e-9) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task by feature and class, and the features of the rows to fit on."""
    counts, seen = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
    for batch in N.slices(batches, 0):
        text, feature = features(batch.column(0))
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        seen += np.bincount(label, minlength=2)
        for c in (0, 1):
            counts[c] += np.bincount(feature[label[text] == c], minlength=BUCKETS)
        chosen = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
        lists = N.rows_of(text, feature.astype(np.int32), batch.num_rows).take(pa.array(chosen))
        none = pa.nulls(len(chosen), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, pa.array(label[chosen]), none, batch.column(3).take(pa.array(chosen)), lists],
            names=["feature", "label", "n", "rank", "features"],
        )
    for c in (0, 1):
        at = np.concatenate([np.flatnonzero(counts[c]), [BUCKETS]])  # the last place has the rows of the class
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(np.full(len(at), c)), pa.array(np.concatenate([counts[c], seen[c:c + 1]])[at]),
             pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.list_(pa.int32()))],
            names=["feature", "label", "n", "rank", "features"],
        )


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray, buckets: int, cost: np.ndarray, passes: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge-loss model, one dual variable per row.

    ``rows`` are sparse: indices and values. The bias is the weight of a constant feature.
    """
    w, bias, alpha = np.zeros(buckets), 0.0, np.zeros(len(rows))
    norm = np.array([v @ v for _, v in rows]) + 1.0
    random = np.random.default_rng(7)
    for _ in range(passes):
        for i in random.permutation(len(rows)):
            at, values = rows[i]
            gradient = sign[i] * (w[at] @ values + bias) - 1
            step = min(max(alpha[i] - gradient / norm[i], 0.0), cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[at] += step * sign[i] * values
                bias += step * sign[i]
    return w, bias


def _sigmoid_fit(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small ridge."""
    if not len(label):
        return 4.0, 0.0
    x, theta = np.stack([margin, np.ones_like(margin)], 1), np.array([4.0, 0.0])
    target = np.where(label, (label.sum() + 1) / (label.sum() + 2), 1 / (len(label) - label.sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (p - target) + 1e-3 * theta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(curve, slope)
    return (float(theta[0]), float(theta[1])) if theta[0] > 0 else (4.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from all rows of ``labels`` (label 0 or 1) whose document is in ``docs``.

    Rows without label are ignored; one class alone, or no rows, gives a score of 1/2. A document
    with two labels counts for each. The driver gets 2 x BUCKETS counts at most and the features
    of about FIT_ROWS rows.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")
    )
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    rank = F.pmod(F.xxhash64("_id"), F.lit(1 << 30))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.join(known.hint("merge"), "_id").select(
        "text", "_label", (rank < F.lit(share * (1 << 30))).alias("fit"), rank.alias("rank")
    )
    stage = Stage(docs.sparkSession, "quality")
    parts = stage.write(
        rows.mapInArrow(_collect, "feature long, label long, n long, rank long, features array<int>")
    )
    sums = parts.filter("feature IS NOT NULL").groupBy("feature", "label").agg(F.sum("n").alias("n")).toArrow()
    examples = parts.filter("feature IS NULL").select("rank", "label", "features").toArrow()
    stage.clear()
    counts = np.zeros((2, BUCKETS + 1))
    counts[sums.column(1).to_numpy(), sums.column(0).to_numpy()] = sums.column(2).to_numpy()
    return _train(counts, examples)


def _train(counts: np.ndarray, examples: pa.Table) -> Model:
    if not counts[:, BUCKETS].all():  # a class is missing
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 1.0, 0.0)
    smooth = (counts[:, :BUCKETS] + 1) / (counts[:, BUCKETS:] + 2)
    ratio = np.log(smooth[1] / smooth[0])
    order = np.argsort(examples.column(0).to_numpy(), kind="stable")
    label = examples.column(1).to_numpy()[order] == 1
    lists = pa.concat_arrays(examples.column(2).chunks)
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    rows = []
    for i in order:
        feature = values[at[i]:at[i + 1]]
        scaled = ratio[feature]
        rows.append((feature, scaled / max(float(np.sqrt(scaled @ scaled)), 1e-9)))
    held = np.arange(len(rows)) % CALIBRATION == 0
    fitted = [r for r, h in zip(rows, held) if not h]
    sign = np.where(label[~held], 1.0, -1.0)
    shares = [max(1, int((sign == s).sum())) for s in (1, -1)]
    cost = COST * np.where(sign > 0, len(sign) / (2 * shares[0]), len(sign) / (2 * shares[1]))
    w, bias = dual_coordinate_descent(fitted, sign, BUCKETS, cost, PASSES)
    margin = np.array([w[f] @ v + bias for (f, v), h in zip(rows, held) if h])
    slope, shift = _sigmoid_fit(margin, label[held])
    return Model(ratio, w * ratio, float(bias), slope, shift)


def predict(docs: DataFrame, model: Model, text_col: str = "text", carry: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """doc (struct of ``carry``) and score, 0 to 1, of every text; null counts as empty.

    A text without words gets the score of the bias alone. Equal texts get equal scores.
    """
    source = docs.select(F.struct(*carry).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in N.slices(batches, 1):
            text, feature = features(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(text, feature, batch.num_rows))], names=["doc", "score"]
            )

    return source.mapInArrow(score, T.StructType([source.schema["doc"], T.StructField("score", T.DoubleType())]))
