"""Periodic runs against plain searches, and the query against its contract."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmart.llm import periods
from fleetmart.llm.queries import op11_periods

SF = "/root/testdata/sf0.001"


def plain_runs(s, min_length=6, exponent=4):
    """Every stretch of every period, word by word."""
    out, n = set(), len(s)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            if length >= max(min_length, exponent * q):
                part = s[i : j + q]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(seed, count, size):
    rnd = random.Random(seed)
    for _ in range(count):
        s = []
        while len(s) < rnd.randint(1, size):
            if rnd.random() < 0.6:
                root = [rnd.randint(0, rnd.randint(0, 2)) for _ in range(rnd.randint(1, max(9, size // 15)))]
                s += (root * rnd.randint(1, 7))[: max(1, len(root) * 7 - rnd.randint(0, len(root) - 1))]
            else:
                s += [rnd.randint(0, 3) for _ in range(rnd.randint(1, 8))]
        yield s


@pytest.mark.parametrize("seed,count,size", [(1, 800, 60), (2, 60, 600)])
@pytest.mark.parametrize("min_length,exponent", [(6, 4), (2, 4), (6, 5), (12, 4)])
def test_runs_equal_plain_search(seed, count, size, min_length, exponent):
    for s in sequences(seed, count, size):
        keys = np.array([x * 7919 + 13 for x in s], dtype=np.uint64)
        got = periods._ordered(periods.runs(keys, len(s), min_length, exponent))
        assert [tuple(map(int, r)) for r in got] == plain_runs(s, min_length, exponent), s


def test_known_words():
    fibonacci, before = [0], [1]
    while len(fibonacci) < 2000:
        fibonacci, before = fibonacci + before, fibonacci
    morse = [bin(k).count("1") % 2 for k in range(2048)]
    for s in (fibonacci * 4, morse, [0] * 3000, [0, 1] * 1500, ([0] * 99 + [1]) * 12, [0] * 5, []):
        keys = np.array([x + 5 for x in s], dtype=np.uint64)
        got = [tuple(map(int, r)) for r in periods._ordered(periods.runs(keys, len(s)))]
        assert got == plain_runs(s)
    with pytest.raises(ValueError):
        periods.runs(np.zeros(9, dtype=np.uint64), 9, exponent=3)


def test_range_successor_equals_sorting():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 500):
        values = rng.permutation(n)
        tree = periods.RangeSuccessor(values)
        lo = rng.integers(0, n, 300)
        hi = np.array([rng.integers(a + 1, n + 1) for a in lo])
        bound = rng.integers(0, n + 3, 300)
        below = tree.below(lo, hi, bound)
        for a, b, x, c in zip(lo, hi, bound, below, strict=True):
            want = (values[a:b] < x).sum()
            assert c == want or (c == -1 and x >= 1 << tree.bits and want == b - a)
            for k in range(b - a):
                got = tree.ranked(np.array([a]), np.array([b]), np.array([k]))
                assert got[0] == np.sort(values[a:b])[k]
                if k > 3:
                    break


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return (doc_id, *digest(words))


def digest(words):
    found = plain_runs(words)
    dropped = {i for a, length, q in found for i in range(a + q, a + length)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{a},{b},{q}\n" for a, b, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_plain_search(spark, rows_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = op11_periods(spark, SF)
    assert out.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    want = sorted((expected(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    got = rows_of(out)
    assert got == want
    assert sum(r[1] > 0 for r in got) > 10


def test_query_on_awkward_rows(spark, awkward, tmp_path, rows_of):
    more = spark.createDataFrame(
        [(100 + k, f" {w} " * 40) for k, w in enumerate(("a b\tc", "é", "\x00 x", "one\ntwo\x0bthree"))],
        "doc_id long, text string",
    )
    docs = awkward.select("doc_id", "text").unionByName(more).unionByName(more)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # The plain search is quadratic: the longest text is left to the test of known words.
    short = docs.where("text is null or length(text) < 60000")
    want = sorted((expected(r["doc_id"], r["text"]) for r in short.collect()), key=repr)
    long = [r["doc_id"] for r in docs.where("length(text) >= 60000").collect()]
    got = [r for r in rows_of(op11_periods(spark, str(tmp_path))) if r[0] not in long]
    assert got == want and len(long) == 1


def test_operator_keeps_columns(spark, awkward, no_docs):
    clash = awkward.withColumn("_runs", F.lit("x"))
    out = periods.periodic_runs(clash)
    assert out.columns == [*clash.columns, "_n_words", "_runs_", "_collapsed"]
    assert out.count() == clash.count()
    blank = out.where("text is null").select("_n_words", "_runs_", "_collapsed").distinct().collect()
    assert [tuple(r) for r in blank] == [(0, [], "")]
    assert periods.periodic_runs(no_docs).count() == 0
