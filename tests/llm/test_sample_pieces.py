"""The classifier's sample reaches the driver in pieces."""

import numpy as np

from fleetmart.llm import classifier


def test_sample_in_pieces_is_the_sample(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(k, f"text {k} " * (k % 5 + 1)) for k in range(20)] + [(3, "another text"), (7, None)],
        "doc_id long, text string",
    )
    frame = type(docs)

    def whole(self):
        raise AssertionError("the sample was fetched at once")

    monkeypatch.setattr(frame, "toArrow", whole)
    one, order = classifier._sample(docs, 12, 1)
    monkeypatch.setattr(classifier, "_PIECE", 5)
    other, again = classifier._sample(docs, 12, 1)
    assert one.shape[0] == 12 and one.dtype == np.float32
    assert np.array_equal(one, other) and np.array_equal(order, again)
    hashes = sorted(r[0] for r in classifier._ordered(docs, 1).collect())
    assert order.tolist() == hashes[:12]
    assert classifier._sample(docs.where("doc_id < 0"), 12, 1)[0].shape[0] == 0
