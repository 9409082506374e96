"""Quality classifier learned from positive and unlabelled texts."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.common import map_batches, possible, text_slices
from fleetmart.llm.textstats import Stats, byte_grams, mean_of, stats

GRAM, BITS = 3, 9


def _shares(s: Stats) -> np.ndarray:
    """Dense features of each row that don't grow with its length."""
    n_bytes, n_words = np.maximum(s.n_bytes, 1), np.maximum(s.n_words, 1)
    return np.stack(
        [
            s.n_symbols / n_words,
            s.n_upper / n_bytes,
            s.n_repeat_words / n_words,
            (2 * s.n_repeat_words > s.n_words).astype(np.float64),
            s.n_dup_lines / n_words,
            np.minimum(s.word_chars / n_words, 30) / 30,
            (s.n_words == 0).astype(np.float64),
        ],
        axis=1,
    )


_DENSE = 7
# Dense features weigh as much as this many gram buckets.
_WEIGHT = 16.0


def _vectors(column: pa.Array) -> np.ndarray:
    """Gram shares and dense features of every row of a small batch."""
    s = stats(column)
    buckets, begins = byte_grams(s.data, s.offsets, GRAM, BITS)
    n = np.diff(begins)
    row = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(row * (1 << BITS) + buckets, minlength=len(n) << BITS)
    shares = counts.reshape(len(n), 1 << BITS) / np.maximum(n, 1)[:, None]
    return np.concatenate([shares, _shares(s)], axis=1).astype(np.float32)


@dataclass
class Model:
    """score = 1 / (1 + exp(-(grams · mean + dense · features + bias)))"""

    grams: np.ndarray
    dense: np.ndarray
    bias: float
    prior: float

    def margins(self, column: pa.Array) -> np.ndarray:
        s = stats(column)
        buckets, begins = byte_grams(s.data, s.offsets, GRAM, BITS)
        return mean_of(self.grams[buckets], begins) + _shares(s) @ self.dense + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-np.clip(self.margins(column), -40, 40))), 9)


def _descend(positive, unlabelled, prior, steps, rate, decay):
    """Weights and bias that minimise the non-negative risk with logistic loss.

    Risk: prior · mean loss of positives as positive, plus what the unlabelled as negative
    cost beyond prior · positives as negative, that part not below 0; where it is, the step
    goes against it instead.
    """
    w, b = np.zeros(positive.shape[1], dtype=np.float32), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    soft = lambda z: np.logaddexp(0, z)
    for step in range(1, steps + 1):
        zp, zu = ((x @ w).astype(np.float64) + b for x in (positive, unlabelled))
        sp, su = sigmoid(zp), sigmoid(zu)
        negative = soft(zu).mean() - prior * soft(zp).mean()
        pull_p = prior * (sp - 1) / len(zp)  # positives as positive
        push_u, push_p = su / len(zu), -prior * sp / len(zp)  # the negative part
        if negative < 0:
            gp, gu = -push_p, -push_u
        else:
            gp, gu = pull_p + push_p, push_u
        pull = gp.astype(np.float32) @ positive + gu.astype(np.float32) @ unlabelled
        g = np.append(pull + decay * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = (w - change[:-1]).astype(np.float32), b - change[-1]
    return w, b


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from the scores of rows not trained on.

    Above a threshold, unlabelled rows hold at least prior · the share of positives there;
    the bound is tightest where few negatives score as high. Shares carry a margin for
    their size of sample.
    """
    if not len(positive):
        return 0.5
    cuts = _cuts(positive)
    return _prior(positive, cuts, np.array([(unlabelled >= c).sum() for c in cuts]), len(unlabelled))


def _cuts(positive: np.ndarray) -> np.ndarray:
    return np.quantile(positive, np.linspace(0.02, 0.8, 79))


def _prior(positive: np.ndarray, cuts: np.ndarray, above: np.ndarray, n: int) -> float:
    """``class_prior`` of ``n`` unlabelled rows of which ``above`` reach the cuts."""
    if not n:
        return 0.5
    p, u = np.array([(positive >= c).mean() for c in cuts]), above / n
    margin = np.sqrt(1 / n) * 0.5 + np.sqrt(1 / len(positive)) * 0.5
    bound = (u + margin * np.sqrt(u * (1 - u))) / p
    return float(np.clip(bound.min(), 0.05, 0.98))


_UNIT = 1 << 24
_WIDTH = (1 << BITS) + _DENSE


def moments(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every feature over all texts of ``docs``.

    Tasks add up whole numbers, so the sums don't depend on the order of tasks; a row a
    feature reaches the driver.
    """

    def run(batches):
        total = np.zeros(_WIDTH, dtype=object)
        square, n = total.copy(), 0
        for batch in batches:
            for part in text_slices(batch):
                x = _vectors(part.column("text")).astype(np.float64)
                n += len(x)
                for into, values in ((total, x.sum(axis=0)), (square, (x * x).sum(axis=0))):
                    into += np.array([int(v) for v in np.rint(values * _UNIT)], dtype=object)
        whole = lambda xs: pa.array([Decimal(v) for v in xs], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(_WIDTH), pa.int32()), whole(total), whole(square), pa.array([n] * _WIDTH, pa.int64())],
            names=["feature", "total", "square", "n"],
        )

    schema = "feature int, total decimal(38,0), square decimal(38,0), n long"
    sums = map_batches(docs.select("text"), run, schema).groupBy("feature")
    mean, spread = np.zeros(_WIDTH), np.zeros(_WIDTH)
    for r in sums.agg(F.sum("total").alias("t"), F.sum("square").alias("s"), F.sum("n").alias("n")).collect():
        if r["n"]:
            mean[r["feature"]] = float(r["t"]) / _UNIT / r["n"]
            left = float(r["s"]) / _UNIT / r["n"] - mean[r["feature"]] ** 2
            spread[r["feature"]] = np.sqrt(max(left, 0.0))
    return mean, spread


def counts_above(docs: DataFrame, model: Model, cuts: np.ndarray, without: np.ndarray) -> tuple[np.ndarray, int]:
    """How many texts of (_order, text) reach each cut, and of how many.

    Rows whose ``_order`` is among ``without``, those trained on, don't count.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model, cuts, without))

    def run(batches):
        model, cuts, without = sent.value
        reached, n = np.zeros(len(cuts) + 1, dtype=np.int64), 0
        for batch in batches:
            for part in text_slices(batch):
                z = model.margins(part.column("text"))
                z = z[~np.isin(part.column("_order").to_numpy(), without)]
                n += len(z)
                reached += np.bincount(np.searchsorted(cuts, z, side="right"), minlength=len(cuts) + 1)
        above = np.append(reached[::-1].cumsum()[::-1][1:], n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(above)), pa.int32()), pa.array(above)], names=["cut", "n"]
        )

    found = map_batches(docs.select("_order", "text"), run, "cut int, n long")
    above = np.zeros(len(cuts) + 1, dtype=np.int64)
    for r in found.groupBy("cut").agg(F.sum("n").alias("n")).collect():
        above[r["cut"]] = r["n"]
    return above[:-1], int(above[-1])


def fit(
    docs: DataFrame, positive: np.ndarray, unlabelled: np.ndarray, orders: np.ndarray, *,
    steps: int = 400, rate: float = 0.02, decay: float = 0.1,
) -> Model:
    """Learn from feature rows of trusted positives and of unlabelled texts.

    Centre and spread of the unlabelled features and the class prior come from all texts of
    ``docs`` (_order, text); ``orders`` are those of the unlabelled rows. Both arrays are
    scaled in place.
    """
    width = 1 << BITS
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(width), np.zeros(_DENSE), 0.0, 0.5)
    p, u = positive, unlabelled
    # Positives and the corpus, weighted as the rows that the risk sees.
    share = len(p) / (len(p) + len(u))
    mean, deviation = moments(docs)
    of_p = p.mean(axis=0, dtype=np.float64)
    centre = share * of_p + (1 - share) * mean
    within = share * p.var(axis=0, dtype=np.float64) + (1 - share) * deviation**2
    spread = np.sqrt(within + share * (1 - share) * (of_p - mean) ** 2) + 1e-4
    spread[width:] /= _WEIGHT
    for x in (p, u):
        x -= centre.astype(np.float32)
        x /= spread.astype(np.float32)

    def model(w: np.ndarray, b: float, prior: float) -> Model:
        scaled = w.astype(np.float64) / spread
        return Model(scaled[:width], scaled[width:], float(b - scaled @ centre), prior)

    # Prior: positives against unlabelled on one half, read off on all other texts.
    w, b = _descend(p[::2], u[::2], 0.5, steps // 2, rate, decay)
    held, prior = p[1::2] @ w + b, 0.5
    if len(held):
        cuts = _cuts(held.astype(np.float64))
        prior = _prior(held, cuts, *counts_above(docs, model(w, b, prior), cuts, orders[::2]))
    return model(*_descend(p, u, prior, steps, rate, decay), prior)


# Feature rows that the driver fetches at once: some 8 MB.
_PIECE = 2000


def _sample(docs: DataFrame, rows: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of the ``rows`` documents whose id hashes lowest, and the hashes.

    Features are taken where the texts are; of those the lowest are chosen.
    """

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("_order"), pa.array([x.tobytes() for x in _vectors(part.column("text"))], pa.binary())],
                    names=["_order", "features"],
                )

    found = map_batches(_ordered(docs, seed), run, "_order long, features binary")
    # The sample comes in pieces, so that the driver's JVM holds one of them at a time.
    pieces = found.orderBy("_order", "features").limit(rows).repartition(-(-rows // _PIECE))
    out, orders, n = np.zeros((rows, _WIDTH), np.float32), np.zeros(rows, np.int64), 0
    for row in pieces.toLocalIterator():
        orders[n], out[n] = row["_order"], np.frombuffer(row["features"], dtype=np.float32)
        n += 1
    out, orders = out[:n], orders[:n]
    # In the order of the hashes, whatever the order of the tasks.
    by = np.lexsort((out[:, -3], out[:, 0], orders))
    return out[by], orders[by]


def _ordered(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(F.xxhash64(F.lit(seed), "doc_id").alias("_order"), "text")


def held_out(doc_id: str = "doc_id"):
    """True for the fold that no label is learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def learn(
    docs: DataFrame, labels: DataFrame, *, positives: int = 4000, unlabelled: int = 8000
) -> Model:
    """Fit on at most ``positives`` trusted and ``unlabelled`` other texts of the learning folds.

    The bounds are parameters; what is drawn depends on ids alone. Trusted are documents
    whose labels all say 1; unlabelled texts are any texts, whatever their label. Rows of
    null ids and copies take no place in the sample. The features' centre and spread and
    the class prior come from all texts of these folds.
    """
    plain = docs.selectExpr("cast(doc_id as long) as doc_id", "text").where(~held_out())
    trusted = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("q"))
        .where("q = 1")
        .where(~held_out())
        .select("doc_id")
    )
    few = trusted.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(positives)
    p, _ = _sample(possible(plain, "doc_id", few).join(few, "doc_id"), positives, 1)
    # Documents with the lowest id hashes, found without their texts.
    ids = plain.select("doc_id").where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64(F.lit(2), "doc_id"), "doc_id").limit(unlabelled)
    u, orders = _sample(possible(plain, "doc_id", ids).join(ids, "doc_id"), unlabelled, 2)
    return fit(_ordered(plain, 2), p, u, orders)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row: score from the text alone.

    A null text counts as empty; empty texts get the score of a text without features.
    Rows are kept as they come, repeated ones and null ids too.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch in batches:
            for part in text_slices(batch):
                score = model.scores(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(score, pa.float64()),
                        pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                    ],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    plain = docs.selectExpr("cast(doc_id as long) as doc_id", "text").withColumn("held_out", held_out())
    return map_batches(plain, run, "doc_id long, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    return classify(docs, learn(docs, labels, **bounds))


def keep_good(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier predicts as good."""
    model = learn(docs, labels, **bounds)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place, schema = docs.columns.index("text"), docs.schema

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                yield part.filter(pa.array(sent.value.scores(part.column(place)) >= 0.5))

    return map_batches(docs, run, schema)
