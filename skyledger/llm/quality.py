"""Quality classifier: support vectors on naive Bayes features.

A text is a set of n-gram indicators, hashed into ``FEATURES`` places: single tokens and
pairs (lower case; letters, digits and punctuation runs are tokens), and triples of
token shapes (case, digits, punctuation, line end, same as the token before). An
indicator f is scaled by its class log-count ratio

    r_f = log((1 + p_f) / |p|) - log((1 + q_f) / |q|)

where p_f and q_f count the documents of label 1 and 0 that have it; scaled texts have
length one. A linear hinge-loss model is fitted by dual coordinate descent, and its
margins become scores by a logistic curve fitted on rows that the model did not see.

The counts cover every labelled training row and are summed by Spark per feature; labels
meet their texts by a broadcast while their counted rows stay under a bound, by a shuffle
beyond it. The
model itself is fitted on a sample of at most about ``SAMPLE`` labelled rows, chosen by a
hash of doc_id: this bound is a parameter (``sample``), and keeps the driver's share
constant.

Defined results: a null text counts as empty, and an empty text has the score of the
bias; labels that are null or not 0 or 1 teach nothing; repeated labels teach repeatedly;
with labels of one class only (or none) every score is the smoothed share of label 1;
a null doc_id counts as an empty text in the split and meets no label; whole texts count;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.langid import held_out
from skyledger.llm.registry import register, table
from skyledger.session import ship_package, stage_table

FEATURES = 1 << 16
SHAPES = 4096  # shape triples have places of their own before the hashed n-grams
SAMPLE = 12_288
EPOCHS, COST, TOLERANCE = 20, 1.0, 1e-3
CALIBRATION = 4  # one row in so many is kept for the logistic curve
THRESHOLD = 0.3
SEED = 23
MEMORY_ENTRIES = 150_000
BROADCAST_LABELS = 1_000_000  # counted rows of (doc_id, label); beyond it the texts are shuffled to them

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_LOWER, _TITLE, _UPPER, _DIGIT, _MARK, _END, _AGAIN = 1, 2, 3, 4, 5, 6, 7


def _shape(token: str) -> int:
    if token[0].isdigit():
        return _DIGIT
    if not token[0].isalpha():
        return _MARK
    return _LOWER if token.islower() else _UPPER if token.isupper() and len(token) > 1 else _TITLE


class _Chunks(dict):
    """White-space free piece of text -> its tokens as (hash << 4 | shape)."""

    def __missing__(self, chunk: str) -> tuple:
        value = tuple(crc32(t.lower().encode()) << 4 | _shape(t) for t in _TOKEN.findall(chunk))
        if len(self) < MEMORY_ENTRIES and len(chunk) <= 40:
            self[chunk] = value
        return value


_CHUNKS = _Chunks({"\n": (_END,)})


def indicators(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    pieces = (text or "").replace("\n", " \n ").split(" ")
    code = np.fromiter(chain.from_iterable(map(_CHUNKS.__getitem__, pieces)), dtype=np.int64)
    if not len(code):
        return code
    word, shape = (code >> 4).astype(np.uint64), code & 15
    shape[1:][(word[1:] == word[:-1]) & (shape[1:] <= _UPPER)] = _AGAIN
    mixed = word * np.uint64(0x9E3779B97F4A7C15)
    pair = (mixed[:-1] ^ (mixed[1:] >> np.uint64(7))) * np.uint64(0xBF58476D1CE4E5B9)
    room = np.uint64(FEATURES - SHAPES)
    triple = shape[:-2] << 8 | shape[1:-1] << 4 | shape[2:]
    return np.unique(np.concatenate([triple, SHAPES + ((mixed >> np.uint64(20)) % room).astype(np.int64),
                                     SHAPES + ((pair >> np.uint64(20)) % room).astype(np.int64)]))


# -------------------------------------------------------------------- fit
def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                 cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the bias) of the linear hinge-loss model: min |w|²/2 + C sum of
    losses, by coordinate descent on its dual. Rows are (feature numbers, values); classes have
    equal total cost."""
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    limit = cost / (2 * share)
    w, alpha = np.zeros(size + 1), np.zeros(len(y))
    square = np.array([1.0 + (v * v).sum() for _, v in rows])
    rng = np.random.default_rng(SEED)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)).tolist():
            at, value = rows[i]
            gradient = y[i] * (w[at] @ value + w[size]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), limit[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[at] += step * y[i] * value
                w[size] += step * y[i]
                worst = max(worst, abs(step))
        if worst < TOLERANCE:
            break
    return w


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label 1) = 1 / (1 + exp(-(slope * margin + offset))), by Newton steps
    on smoothed targets."""
    ones = label.sum()
    target = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        weight = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((target - p) * margin).sum(), (target - p).sum()])
        h = np.array([[(weight * margin * margin).sum() + 1e-6, (weight * margin).sum()],
                      [(weight * margin).sum(), weight.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 0.0), offset


def _scaled(at: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value = ratio[at]
    return at, value / max(float(np.sqrt((value * value).sum())), 1e-12)


class Model:
    """Weights per feature, their ratios, and the score curve; ``prior`` where there is no model."""

    def __init__(self, ratio=None, w=None, curve=(0.0, 0.0), prior=0.5):
        self.ratio, self.w, self.curve, self.prior = ratio, w, curve, prior

    def margin(self, at: np.ndarray) -> float:
        at, value = _scaled(at, self.ratio)
        return float(self.w[at] @ value + self.w[-1])

    def score(self, text: str | None) -> float:
        if self.w is None:
            return self.prior
        return float(1 / (1 + np.exp(-np.clip(self.curve[0] * self.margin(indicators(text)) + self.curve[1], -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from ``labels`` (doc_id, quality) of ``docs`` (doc_id, text) outside the held-out fifth."""
    ship_package(docs.sparkSession)
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))))
    by_label = {r.label: r.n for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, sample / max(1, sum(by_label.values())))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    if sum(by_label.values()) <= BROADCAST_LABELS:
        marked = F.broadcast(marked)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(~held_out(F.col("doc_id")))
            .join(marked, "doc_id").select("label", chosen.alias("chosen"), "doc_id", "text"))

    def count(batches):
        seen = np.zeros((2, FEATURES), dtype=np.int64)
        texts = np.zeros(2, dtype=np.int64)
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        names = ["label", "feature", "n", "doc_id", "row"]
        for batch in batches:
            kept = []
            for label, pick, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = indicators(text)
                seen[label, at] += 1
                texts[label] += 1
                if pick:
                    kept.append((label, None, None, doc, at.astype("<i4").tobytes()))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*kept, strict=True), kinds, strict=True)], names)
        for label in (0, 1):
            at = np.nonzero(seen[label])[0]
            columns = [np.full(len(at) + 1, label), np.append(at, -1), np.append(seen[label, at], texts[label])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)]
                + [pa.nulls(len(at) + 1, t) for t in kinds[3:]], names)

    counted = stage_table(rows.mapInArrow(count, "label int, feature int, n long, doc_id long, row binary"), "quality")
    totals = (counted.filter("row is null").groupBy("label", "feature").agg(F.sum("n").alias("n")).toArrow())
    seen, texts = np.ones((2, FEATURES)), [0, 0]
    label, feature, n = (totals.column(c).to_numpy() for c in ("label", "feature", "n"))
    for c in (0, 1):
        here = (label == c) & (feature >= 0)
        seen[c, feature[here]] += n[here]
        texts[c] = int(n[(label == c) & (feature < 0)].sum())
    prior = (texts[1] + 1) / (sum(texts) + 2)
    if not all(texts):
        return Model(prior=prior)
    ratio = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
    taken = counted.filter("row is not null").select("label", "doc_id", "row").limit(2 * sample).toArrow()
    taken = taken.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    y = np.where(taken.column("label").to_numpy() > 0, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        return Model(prior=prior)
    sparse = [_scaled(np.frombuffer(r.as_py(), "<i4"), ratio) for r in taken.column("row")]
    keep = np.random.default_rng(SEED).permutation(len(y)) % CALIBRATION > 0
    if len(set(y[keep].tolist())) < 2 or len(set(y[~keep].tolist())) < 2:
        keep = np.ones(len(y), dtype=bool)  # too few rows to set some aside
    w = dual_descent([s for s, k in zip(sparse, keep, strict=True) if k], y[keep], FEATURES)
    aside = ~keep if not keep.all() else keep
    margin = np.array([w[at] @ value + w[-1] for (at, value), a in zip(sparse, aside, strict=True) if a])
    return Model(ratio, w, logistic_curve(margin, y[aside] > 0), prior)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return (docs.select("doc_id", scores(F.col("text")).alias("score"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


@register("op7_nb_svm")
def op7_nb_svm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
