"""Quality rules: base counts, and a likelihood ratio of hashed n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.common import map_batches, possible, text_slices
from fleetmart.llm.textstats import byte_grams, mean_of, stats

GRAM, BITS = 4, 14


def gram_counts(texts: DataFrame, gram: int = GRAM, bits: int = BITS) -> np.ndarray:
    """Occurrences of every n-gram bucket in all texts: 2**bits numbers.

    Each task adds up its own buckets, so what is shuffled is a row per task and bucket.
    """

    def run(batches):
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for part in text_slices(batch):
                column = part.column("text").fill_null("").cast(pa.large_string())
                data = np.frombuffer("".join(column.to_pylist()).encode("utf-8"), dtype=np.uint8)
                sizes = [len(t.encode("utf-8")) for t in column.to_pylist()]
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                total += np.bincount(byte_grams(data, offsets, gram, bits)[0], minlength=1 << bits)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"]
        )

    found = (
        map_batches(texts.select("text"), run, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    out = np.zeros(1 << bits, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Per bucket, log of its share in the target over its share in the raw corpus."""
    share = lambda n: (n + smoothing) / (n.sum() + smoothing * len(n))
    if not target.sum():
        return np.zeros(len(target))
    return np.round(np.log(share(target) / share(raw)), 9)


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    *,
    threshold: float = -0.4,
    min_words: int = 50,
    repeat_percent: int = 50,
) -> DataFrame:
    """Base counts and the verdict for every row of ``docs`` (doc_id, text).

    ``trusted`` (doc_id) names the documents of the target. Two multinomials over hashed
    byte 4-grams are counted, one over all texts of the target and one over all texts.
    A document's ratio is the mean over its n-grams of log(target share / raw share), and
    it is kept if that is at least ``threshold`` and the base rules hold: at least
    ``min_words`` words, and no more than ``repeat_percent`` of them in repeated windows.

    A null text has no words. Without trusted texts all ratios are 0. Rows are kept as they
    come, repeated ones and null ids too; other columns are ignored.
    """
    plain = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    ids = trusted.selectExpr("cast(doc_id as long) as doc_id").where("doc_id is not null").distinct()
    # The bitmap spares the shuffle most texts; the join after it is exact. An inner join: a
    # semi join would be moved below the bitmap, and all texts shuffled.
    target = possible(plain, "doc_id", ids).join(ids.hint("shuffle_hash"), "doc_id")
    ratios = log_ratio(gram_counts(target), gram_counts(plain))
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                s = stats(part.column("text"))
                buckets, begins = byte_grams(s.data, s.offsets, GRAM, BITS)
                ratio = np.round(mean_of(sent.value[buckets], begins), 9)
                failed = (s.n_words < min_words) | (
                    100 * s.n_repeat_words > repeat_percent * s.n_words
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(
                            pa.array(x, pa.int64())
                            for x in (
                                s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words
                            )
                        ),
                        pa.array(failed, pa.bool_()),
                        pa.array(ratio, pa.float64()),
                        pa.array(~failed & (ratio >= threshold), pa.bool_()),
                    ],
                    names=_NAMES,
                )

    return map_batches(plain, run, _SCHEMA)


_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean, log_ratio double, kept boolean"
)
_NAMES = [field.split()[0] for field in _SCHEMA.split(", ")]
