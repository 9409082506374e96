"""Mixing as a whole against a plain computation, with repeated rows and null ids."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from fleetmart.llm import mixing

SCHEMA = "doc_id long, text string, source string, mark string"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def repeated_rows(seed):
    """A third of all rows equal, null ids and sources, empty texts, rows that differ in ``mark`` only."""
    rnd = random.Random(seed)
    text = lambda: " ".join(rnd.choice("abcdefg") * rnd.randint(1, 3) for _ in range(rnd.randint(1, 20)))
    rows = [(k, text(), "a", "x") for k in range(150)]
    rows += [(None, "one row that comes again and again", "b", "x")] * 100
    rows += [(None, "equal but for a mark", "c", f"m{k}") for k in range(30)]
    rows += [(7, text(), None, "x") for k in range(12)] + [(8, "twice", None, "x")] * 2
    rows += [(500 + k, t, "d", "x") for k, t in enumerate((None, "", " \n ", "word"))]
    rows += [(None, None, "e", "x")] * 3
    return rows


def plain_mix(spark, rows, total, block_tokens, **target):
    """Taken rows by (source, epoch), each source in its order; and its budget."""
    tokens = {}
    for _, text, source, _ in rows:
        tokens[source] = tokens.get(source, 0) + n_words(text)
    names = list(tokens)
    sizes = [tokens[s] for s in names]
    some = [n for n in sizes if n]
    exponent = mixing.exponent_for(some, **target)
    weights = mixing.weights_at(sizes, exponent)
    if total is None:
        budgets = [math.ceil(n * p - 1e-6) if n else 0 for n, p in zip(sizes, mixing.passes(sizes, weights), strict=True)]
    else:
        budgets = [int(w * total) for w in weights]
    count = {s: max(1, -(-n // block_tokens)) for s, n in zip(names, sizes, strict=True)}
    key = F.xxhash64(F.lit(0), "doc_id", "text")
    numbered = [(*r, count[r[2]]) for r in rows]
    placed = (
        spark.createDataFrame(numbered, SCHEMA + ", n_blocks long")
        .select("*", key.alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(60).cast("long"))).alias("e"))
        .withColumn("b", F.pmod("k", "n_blocks"))
        .withColumn("bo", F.xxhash64(F.lit(0), F.lit("block"), "source", "b", "e"))
        .withColumn("do", F.xxhash64(F.lit(0), F.lit("document"), "k", "e"))
        .collect()
    )
    placed.sort(key=lambda r: (r["bo"], r["b"], r["do"], r["k"]))
    out = {}
    for s, n, budget in zip(names, sizes, budgets, strict=True):
        whole, part = (budget // n, budget % n) if n else (1, 0)
        assert whole < 60
        for epoch in range(whole + 1):
            left = float("inf") if epoch < whole else part
            taken = []
            for r in (r for r in placed if r["source"] == s and r["e"] == epoch):
                if left > 0:  # rows without words before the end cost nothing and are taken
                    taken.append((r["doc_id"], r["text"]))
                    left -= n_words(r["text"])
            out[s, epoch] = taken
    return out, dict(zip(names, zip(sizes, budgets, strict=True), strict=True))


CASES = [
    dict(repetitions=2.0),
    dict(repetitions=1.5),
    dict(repetitions=None, target_entropy=1.2),
    dict(repetitions=2.0, total=1500),
    dict(repetitions=3.0, total=300),
    dict(repetitions=1.2, total=5000),
    dict(repetitions=None, target_entropy=1.3, total=777),
    dict(repetitions=2.0, total=0),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_mix_equals_plain_computation(spark, case):
    block_tokens = (100, 1 << 20)[case // 2 % 2]
    target = dict(CASES[case])
    total = target.pop("total", None)
    rows = repeated_rows(case)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want, budgets = plain_mix(spark, rows, total, block_tokens, **target)
    out = mixing.mix(docs, total=total, block_tokens=block_tokens, **target)
    got = {}
    for r in out.collect():
        got.setdefault((r["source"], r["_epoch"]), []).append((r["doc_id"], r["text"]))
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    for at in set(want) | set(got):
        assert sorted(got.get(at, []), key=key) == sorted(want.get(at, []), key=key), at
    longest = max(n_words(t) for _, t, _, _ in rows)
    for s, (n, budget) in budgets.items():
        spent = sum(n_words(t) for (source, _), part in got.items() if source == s for _, t in part)
        assert n == 0 or budget <= spent < budget + longest


def test_rows_that_differ_elsewhere_are_taken_by_number(spark):
    rows = [(None, "equal but for a mark", "c", f"m{k}") for k in range(40)] + [(k, "a b", "a", "x") for k in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    runs = [
        sorted((r["mark"], r["_epoch"]) for r in mixing.mix(docs.repartition(p), total=60).where("source = 'c'").collect())
        for p in (1, 5)
    ]
    assert runs[0] == runs[1] and len(set(runs[0])) == len(runs[0])
    spent = 5 * len(runs[0])
    assert 0 < spent <= 60


def test_ordered_rows_hold_the_permutation(spark, tmp_path):
    rows = [(k, " ".join(["w"] * (1 + k % 7)), "big" if k % 3 else "small", "x") for k in range(900)]
    rows += [(None, "again and again", "same", "x")] * 500
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plain = mixing.mix(docs, repetitions=2.0, block_tokens=50)
    laid = mixing.mix(docs, repetitions=2.0, block_tokens=50, ordered=True)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, laid.collect()))
    laid.write.parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    files = back.select("*", F.col("_metadata.file_name").alias("f")).collect()
    files.sort(key=lambda r: r["f"])  # stable: rows of a file stay as they are
    place = {}
    for at, r in enumerate(files):
        place.setdefault(r["source"], []).append((at, r["_epoch"], r["_block_order"], r["_doc_order"]))
    for of in place.values():
        assert [x[1:] for x in of] == sorted(x[1:] for x in of)
        # Read from end to end, not in one stretch.
        assert of[0][0] < len(files) * 0.3 and of[-1][0] > len(files) * 0.6
