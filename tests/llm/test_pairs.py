"""Line dedup, similarity join, top-k and mixing against brute force."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmart.llm import jaccard, linededup, mixing, topk
from fleetmart.llm.components import components

SF = "/root/testdata/sf0.001"
TRIM = " \t\x0b\x0c\r"


def within_one(a, b):
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute_lines(rows):
    """Dropped line numbers by document id."""
    lines = [
        ((i is None, i or 0, no), line.strip(TRIM))
        for i, text in rows
        if text is not None
        for no, line in enumerate(text.split("\n"))
        if len(line.strip(TRIM)) >= linededup.MIN_CHARS
    ]
    by_length, out = {}, {}
    for at, line in lines:
        by_length.setdefault(len(line), []).append((at, line))
    for at, line in lines:
        others = [x for n in (-1, 0, 1) for x in by_length.get(len(line) + n, [])]
        if any(other < at and within_one(line, x) for other, x in others):
            out.setdefault(None if at[0] else at[1], set()).add(at[2])
    return out


def check_lines(docs, report):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute_lines(rows)
    got = report.collect()
    assert len(got) == len(rows)
    for r in got:
        assert set(r["dropped"]) == want.get(r["doc_id"], set()), r["doc_id"]
        assert r["n_dropped"] == len(r["dropped"])


def test_line_dedup_equals_brute_force_on_awkward_rows(awkward):
    check_lines(awkward, linededup.line_report(awkward))


def test_line_dedup_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_lines(docs, linededup.line_report(docs))


def test_line_dedup_finds_every_edit(spark):
    base = "abcdefghij klm"
    edits = [base[:k] + "X" + base[k:] for k in range(len(base) + 1)]
    edits += [base[:k] + "X" + base[k + 1 :] for k in range(len(base))]
    edits += [base[:k] + base[k + 1 :] for k in range(len(base))]
    runs = ["aaaaaaaaab", "aaaaaaaab", "aaaabaaaab", "aaaaaaaaaa", "baaaaaaaaa"]
    docs = spark.createDataFrame(list(enumerate([base, *edits, *runs])), "doc_id long, text string")
    check_lines(docs, linededup.line_report(docs))


def test_line_dedup_keeps_columns_and_rest(awkward, no_docs):
    out = linededup.dedup_lines(awkward)
    assert out.columns == awkward.columns
    kept = {r["doc_id"]: r for r in out.collect()}
    assert kept[10]["text"] == "a same line here\nsome other line\n"
    assert kept[10]["_left"] == "x-_left"
    assert kept[3]["text"] is None and kept[4]["text"] == ""
    assert 2 not in kept  # a copy has no line of its own
    assert 7 not in kept  # short lines are compared too, unless spared
    assert 7 in {r["doc_id"] for r in linededup.dedup_lines(awkward, min_chars=8).collect()}
    assert linededup.dedup_lines(no_docs).count() == 0
    assert linededup.line_report(no_docs).count() == 0


def grams(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if not w:
        return None
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if len(w) >= n else frozenset([tuple(w)])


def brute_similar(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    linked = [
        [
            j for j in range(n)
            if j != i and sets[i] and sets[j]
            and (rows[i][1] == rows[j][1]
                 or len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]))
        ]
        for i in range(n)
    ]
    top = list(range(n))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(n):
        for j in linked[i]:
            a, b = find(i), find(j)
            top[max(a, b)] = min(a, b)
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    out = []
    for i, (doc, text) in enumerate(rows):
        members = [rows[j][0] for j in range(n) if find(j) == find(i)]
        copies = [rows[j][0] for j in range(n) if sets[i] and rows[j][1] == text]
        out.append((doc, low(copies) if sets[i] else doc, low(members) if sets[i] else doc, len(linked[i])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [256, 4])
def test_similar_documents_equal_brute_force(awkward, rows_of, block):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert rows_of(jaccard.similar_documents(awkward, block=block)) == brute_similar(rows)


def test_large_group_in_blocks_equals_brute_force(spark, rows_of):
    rnd = np.random.default_rng(4)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(120):
        text = list(base)
        for k in rnd.choice(90, rnd.integers(0, 4), replace=False):
            text[k] = f"v{rnd.integers(50)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_similar(rows)
    assert len({r[3] for r in want}) > 10
    assert rows_of(jaccard.similar_documents(docs, block=16)) == want


def test_buckets_inside_others_go(spark):
    buckets = {(0, 1): "abc", (1, 2): "ab", (2, 3): "bc", (3, 4): "cd", (4, 5): "de", (5, 6): "ac"}
    rows = [(c, band, h, len(m)) for (band, h), m in buckets.items() for c in m]
    left = jaccard._uncovered(
        spark.createDataFrame(rows, "cls string, band int, hash long, size long")
    ).collect()
    assert sorted(map(tuple, left)) == sorted(r for r in rows if (r[1], r[2]) in ((0, 1), (3, 4), (4, 5)))


def test_texts_of_near_copies_go_to_few_units(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    rows = []
    for group in range(40):
        base = [f"g{group}w{k}" for k in range(120)]
        for _ in range(3):
            text = list(base)
            text[rnd.integers(120)] = f"v{rnd.integers(10**6)}"
            rows.append((len(rows), " ".join(text)))
    sent, plain = [], jaccard.map_batches

    def counted(df, function, schema, **options):
        if "links" in schema:
            sent.append(df.count())
        return plain(df, function, schema, **options)

    monkeypatch.setattr(jaccard, "map_batches", counted)
    out = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["n_links"] == 2 and r["class_id"] == r["doc_id"] // 3 * 3 for r in out)
    assert sent[0] < 1.5 * len(rows)


def test_keep_one_of_each_class(awkward, no_docs):
    out = jaccard.keep_one(awkward)
    assert out.columns == awkward.columns
    ids = sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None)
    assert ids == [0, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14, 14, 15]
    assert jaccard.keep_one(no_docs).count() == 0
    assert jaccard.similar_documents(no_docs).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}


def brute_topk(rows, every, k):
    usable = {
        (i, tuple(math.floor(1024 * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, a in usable:
        if q % every:
            continue
        found = sorted(
            (-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in usable if i != q
        )
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(found[:k])]
    return sorted(out, key=repr)


def test_topk_units_are_bounded():
    for n in (0, 1, 10**4, 10**6, 10**8, 10**10):
        rows, chunks, tasks = topk.unit_sizes(n, n // 100, 64)
        assert 1024 <= rows <= 65_536 and 1 <= tasks <= 20_000
        assert n // 100 <= chunks * 65_536
    assert topk.unit_sizes(10**8, 10**6, 64) == (65_536, 16, 20_000)
    assert topk.unit_sizes(10**6, 10**4, 4096)[0] == 1024  # wider vectors, as many bytes
    # A side of a third of all rows is cut, the small ones share segments.
    counts = [(0, 5), *((s, 90) for s in range(1, 60)), (-7, 3000)]
    places, segments = topk._placed_sides(counts, 1000)
    assert segments == 3 + 6 and {p[0] for p in places} == {s for s, _ in counts}
    held = [0.0] * segments
    for (side, first, parts), n in zip(sorted(places), [n for _, n in sorted(counts)], strict=True):
        for part in range(parts):
            held[first + part] += n / parts
    assert max(held) <= 1000
    assert topk._placed_sides([], 1000) == ([], 1)


def test_topk_floors_spare_blocks(monkeypatch):
    rng = np.random.default_rng(4)
    ids = np.arange(4096)
    terms = rng.integers(-50, 50, (4096, 8))
    terms[np.arange(4096), ids // 512] += 2000  # eight directions, one a segment
    asks, asked = ids[::64], terms[::64]
    alone, carried, scored = [], [], []
    real = topk._best
    monkeypatch.setattr(topk, "_best", lambda s, i, k: scored.append(len(s)) or real(s, i, k))
    floors = np.full(len(asks), topk._LOWEST)
    for a in range(0, 4096, 512):
        part = slice(a, a + 512)
        scored.clear()
        alone += zip(*topk.search_segment(ids[part], terms[part], asks, asked, 10, 64), strict=True)
        without = len(scored)
        home = np.flatnonzero(asks // 512 == a // 512)
        got = topk.search_segment(ids[part], terms[part], asks[home], asked[home], 10, 64)
        for q in home:
            floors[q] = np.sort(got[2][got[0] == asks[q]])[-10]
        assert without >= 64
    scored.clear()
    for a in range(0, 4096, 512):
        part = slice(a, a + 512)
        carried += zip(*topk.search_segment(ids[part], terms[part], asks, asked, 10, 64, floors), strict=True)
    best = lambda rows: {q: sorted((-s, i) for a, i, s in rows if a == q)[:10] for q in asks}
    assert best(alone) == best(carried)
    assert len(carried) == 10 * len(asks)  # other segments return nothing
    assert len(scored) <= 8 * len(asks)  # nor are their rows merged


def test_topk_equals_brute_force(spark, rows_of, monkeypatch):
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.normal(size=8).round(1)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None] * 4), (302, [float("nan")] * 8), (303, [float("inf")] * 8)]
    rows += [(304, []), (305, [1.0]), (None, [1.0] * 8), rows[5], (306, rows[5][1]), (307, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    want = brute_topk(rows, 10, 10)
    assert rows_of(topk.top_k(df, every=10)) == want
    real = topk.unit_sizes
    monkeypatch.setattr(topk, "unit_sizes", lambda n, q, *_: (40, -(-q // 7), 11))
    assert rows_of(topk.top_k(df, every=10, block=4)) == want
    monkeypatch.setattr(topk, "unit_sizes", real)
    assert topk.top_k(df.limit(0)).count() == 0


def test_block_bounds_spare_blocks(monkeypatch):
    rnd = np.random.default_rng(2)
    centres = rnd.normal(size=(8, 16)) * 300
    terms = np.concatenate([(c + rnd.normal(size=(64, 16)) * 5).astype(np.int64) for c in centres])
    scored = []
    real = topk._best
    monkeypatch.setattr(topk, "_best", lambda s, i, k: scored.append(len(s)) or real(s, i, k))
    topk.search_segment(np.arange(512), terms, np.array([1000]), terms[:1], 10, 64)
    assert len(scored) == 1  # of eight blocks


def mixed_tokens(rows):
    out = {}
    for r in rows:
        out[r["source"]] = out.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    return out


def test_mixing_meets_its_budgets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("source in ('src0', 'src1', 'src2', 'src3')")
    docs = docs.unionByName(docs.where("source = 'src0'").withColumn("doc_id", F.col("doc_id") + 10_000))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 9 == 0, F.concat_ws(" ", "text", "doc_id")).otherwise(F.col("text")))
    rows, out = docs.collect(), mixing.mix(docs, repetitions=1.5, block_tokens=500).collect()
    have, got = mixed_tokens(rows), mixed_tokens(out)
    names = sorted(have)
    tokens = [have[s] for s in names]
    exponent = mixing.exponent_for(tokens, repetitions=1.5)
    weights = mixing.weights_at(tokens, exponent)
    assert max(mixing.passes(tokens, weights)) == pytest.approx(1.5)
    longest = max(mixed_tokens([r])[r["source"]] for r in rows)
    for s, budget in zip(names, mixing.budgets(tokens, weights), strict=True):
        assert budget <= got[s] < budget + longest
    # Every document once at least, twice at most, in different orders.
    times = {}
    for r in out:
        times.setdefault(r["doc_id"], []).append(r["_epoch"])
    assert all(sorted(t) in ([0], [0, 1]) for t in times.values()) and len(times) == len(rows)
    # The last pass is a prefix of a whole pass in its own order.
    for s in names:
        taken = [r for r in out if r["source"] == s and r["_epoch"] == 1]
        cut = max((r["_block_order"], r["_doc_order"]) for r in taken) if taken else None
        assert cut is None or len({(r["_block_order"], r["_doc_order"]) for r in taken}) == len(taken)


def test_exponent_meets_target_entropy():
    tokens = [1000, 100, 10]
    exponent = mixing.exponent_for(tokens, target_entropy=0.9)
    assert mixing.entropy(mixing.weights_at(tokens, exponent)) == pytest.approx(0.9)
    assert mixing.exponent_for(tokens, repetitions=1.0) == pytest.approx(1.0)
    assert mixing.exponent_for(tokens, repetitions=1000) == 0.0


def test_mixing_of_awkward_rows(awkward, no_docs):
    out = mixing.mix(awkward, repetitions=2.0)
    assert out.columns[: len(awkward.columns)] == awkward.columns
    assert out.columns[len(awkward.columns) :] == ["_epoch_", "_block", "_block_order", "_doc_order"]
    ids = {r["doc_id"] for r in out.collect()}
    assert ids == {r["doc_id"] for r in awkward.collect()}
    assert mixing.mix(awkward, repetitions=2.0, places=False).columns == awkward.columns
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mix(awkward, total=0).where("source = 'c'").count() == 0
