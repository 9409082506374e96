"""Edit bounds of line dedup and recall of the similarity join, against plain computations."""

import math
import random
from itertools import combinations

import numpy as np
import pytest

from fleetmart.llm import jaccard, linededup
from fleetmart.llm.queries import op7_lines

TRIM = " \t\x0b\x0c\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_report(rows, edits):
    """Dropped line numbers by id, every line held against every earlier one."""
    lines = [
        ((i, no), line.strip(TRIM)) for i, text in rows for no, line in enumerate(text.split("\n")) if line.strip(TRIM)
    ]
    lines.sort()
    out = {i: [] for i, _ in rows}
    for k, (at, line) in enumerate(lines):
        if any(abs(len(line) - len(x)) <= edits and distance(line, x) <= edits for _, x in lines[:k]):
            out[at[0]].append(at[1])
    return out


def changed(rnd, line, edits):
    out = list(line)
    for _ in range(edits):
        kind, at = rnd.randrange(3), rnd.randrange(len(out) + 1)
        if kind == 0:
            out.insert(at, rnd.choice("abé😀"))
        elif out and kind == 1:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rnd.choice("abé😀")
    return "".join(out)


def line_rows(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab") for _ in range(rnd.choice((1, 2, 3, 5, 9, 14, 30)))) for _ in range(14)]
    lines = base + [changed(rnd, rnd.choice(base), rnd.randrange(5)) for _ in range(45)]
    rnd.shuffle(lines)
    return [(k, "\n".join(lines[3 * k : 3 * k + 3])) for k in range(len(lines) // 3)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_within_any_bound(spark, edits):
    rows = line_rows(edits)
    if edits == 3:  # variants grow with the cube of the length
        rows = [(i, "\n".join(x[:14] for x in t.split("\n"))) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["dropped"] for r in linededup.line_report(docs, edits=edits).collect()}
    assert got == plain_report(rows, edits)
    with pytest.raises(ValueError):
        linededup.line_report(docs, edits=0)


def test_registered_query_equals_plain_search(spark, tmp_path):
    rows = line_rows(11) + [(900, "abcdefgh\nabcdefg"), (901, "a long line with a typo\na long line with s typo")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["dropped"] for r in op7_lines(spark, str(tmp_path)).collect()}
    want = plain_report(rows, 1)
    assert got == want and want[900] and want[901]


def test_all_deletions_are_hashed_alike():
    for line in ("", "a", "ab", "aab", "xyé😀q"):
        for edits in (1, 2, 3):
            seen = {}
            for hashes, gaps in linededup.deletions(line, edits):
                sets = combinations(range(len(line)), gaps.shape[1])
                for h, gap, gone in zip(hashes.tolist(), gaps.tolist(), sets, strict=True):
                    left = "".join(c for k, c in enumerate(line) if k not in gone)
                    assert gap == [sum(j not in gone for j in range(g)) for g in gone]
                    assert seen.setdefault(left, h) == h
            assert len(set(seen.values())) == len(seen)
    one = {h for hashes, _ in linededup.deletions("some line", 1) for h in hashes.tolist()}
    assert one == set(linededup.variant_hashes("some line").tolist())


def test_bands_reach_their_recall():
    assert jaccard.bands_for(0.8) == (32, 4)
    for threshold in (0.1, 0.4, 0.5, 0.7, 0.9, 0.99, 1.0):
        for recall in (0.5, 0.95, 0.999, jaccard.RECALL):
            bands, rows = jaccard.bands_for(threshold, recall)
            assert 1 - (1 - threshold**rows) ** bands >= recall - 1e-9
            assert bands <= 32 or rows == 1
    with pytest.raises(ValueError):
        jaccard.bands_for(0.0)


@pytest.mark.parametrize("threshold", [0.4, 0.5])
def test_planted_pairs_are_found(spark, threshold):
    rng = np.random.default_rng(4)
    rows, size = [], 120
    for k in range(150):
        words = [f"w{k}x{j}" for j in range(size)]
        other = list(words)
        # New words at the end: of the n-grams of either text ``same`` are common.
        same = math.ceil(2 * threshold * (size - 4) / (1 + threshold))
        other[same + 4 :] = [f"v{k}x{j}" for j in range(size - same - 4)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    order = rng.permutation(len(rows))
    docs = spark.createDataFrame([rows[i] for i in order], "doc_id long, text string").repartition(3)
    for recall, least in ((jaccard.RECALL, 150), (0.95, 0.9 * 150)):
        out = jaccard.similar_documents(docs, threshold=threshold, recall=recall).collect()
        found = sum(r["doc_id"] % 2 == 1 and r["class_id"] == r["doc_id"] - 1 for r in out)
        assert found >= least
