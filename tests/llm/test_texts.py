"""Tokenizers, quality rules, classifier, chat and archives: library results and round trips."""

import base64
import hashlib
import io
import random
import re
import zipfile
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetmart.llm import chat, classifier, pieces, quality, tokens, warc

SF = "/root/testdata/sf0.01"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(n=1500):
    rnd = random.Random(3)
    parts = [
        "a", "b", " ", "  ", "\n", "'", "s", "re", "the", "▁", "é", "1", "23", "!", "?!", "\t", "中",
        "<|endoftext|>", "</s>", "\x00", "😀", "　",
    ]
    return ["", " ", "  a", "a  ", "don't 'rest", "x" * 3000] + [
        "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(n)
    ]


def with_texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    documents = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    texts = odd_texts() + documents
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in tokens.count_tokens(with_texts(spark, texts), BPE, limit=30).collect():
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"]) == (len(t.encode()), count(t)), t
        assert r["over_limit"] == (r["n_tokens"] > 30)
        assert count(t[: r["fit_chars"]]) <= 30
        if r["fit_chars"] < len(t):
            assert count(t[: r["fit_chars"]]) >= 27


def test_prefix_counts_are_exact():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    with open(BPE, encoding="utf-8") as file:
        counter = tokens.PrefixCounter(file.read())
    for word in (" antidisestablishmentarianism", "éèêëé", "0123456789", " thththonerentionble"):
        raw = word.encode()
        for k in range(1, len(word) + 1):
            n = len(word[:k].encode())
            assert counter.prefix_counts(raw)[n] == len(library.encode(word[:k]).ids)


def test_token_counts_of_awkward_rows(awkward, no_docs):
    got = {r["doc_id"]: r for r in tokens.count_tokens(awkward, BPE).collect()}
    assert got[3]["n_tokens"] == got[4]["n_tokens"] == got[3]["n_bytes"] == 0
    assert tokens.count_tokens(awkward, BPE).count() == awkward.count()
    assert tokens.count_tokens(no_docs, BPE).count() == 0


def test_piece_ids_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    documents = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    texts = odd_texts() + documents
    for r in pieces.encode_documents(with_texts(spark, texts), PIECES).collect():
        t = texts[r["doc_id"]]
        ids = library.encode(t)
        assert r["token_ids"] == ids, t
        assert r["n_tokens"] == len(ids)
        assert r["round_trip"] == (library.decode(ids) == t)
        assert "▁" in t or r["round_trip"]


def test_suffix_array_finds_every_occurrence():
    with open(PIECES, "rb") as file:
        table = pieces.PieceTable(file.read())
    segments = ["▁thethe", "ing", "▁中的x", "aa", "a"]
    starts, ends, ids, begins = table.edges(segments)
    text = "\n" + "\n".join(segments) + "\n"
    want = sorted(
        (a, a + len(p), i)
        for p, i in table.ids.items()
        if set(p) != {"▁"} or p == "▁"
        for a in range(len(text))
        if text.startswith(p, a)
    )
    assert sorted(zip(starts.tolist(), ends.tolist(), ids.tolist(), strict=True)) == want
    assert [text[b : b + len(s)] for b, s in zip(begins, segments, strict=True)] == segments


def test_pieces_of_awkward_rows(awkward, no_docs):
    got = {r["doc_id"]: r for r in pieces.encode_documents(awkward, PIECES).collect()}
    assert got[3]["token_ids"] == got[4]["token_ids"] == []
    assert got[9]["round_trip"] and got[8]["round_trip"] and not got[12]["round_trip"]
    assert pieces.encode_documents(no_docs, PIECES).count() == 0


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = {k + d for k in range(len(w) - 2) if seen[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(again),
    )


def test_quality_rules_equal_brute_force(awkward, labels):
    texts = {(r["doc_id"], r["text"]) for r in awkward.collect()}
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect()} - {None}
    out = quality.quality_rules(awkward, labels.where("quality = 1")).collect()
    assert len(out) == awkward.count()
    raw = [(r["doc_id"], r["text"] or "") for r in awkward.select("doc_id", "text").collect()]

    def grams(text):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        n, v = quality.GRAM, []
        for k in range(len(data) - n + 1):
            x = int.from_bytes(data[k : k + n].tobytes(), "little")
            x = ((x * 0x9E3779B1) & 0xFFFFFFFF) ^ (x >> 15)
            v.append(((x * 0x85EBCA77) & 0xFFFFFFFF) >> (32 - quality.BITS))
        return v

    size = 1 << quality.BITS
    everything, target = np.zeros(size), np.zeros(size)
    for i, t in raw:
        counts = np.bincount(grams(t), minlength=size)
        everything += counts
        target += counts * (i in trusted)
    ratio = np.log((target + 1) / (target.sum() + size)) - np.log((everything + 1) / (everything.sum() + size))
    for r in out:
        text = next(t for i, t in texts if i == r["doc_id"] and brute_counts(t) == tuple(r)[1:6])
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        mean = np.mean(ratio[grams(text or "")]) if len((text or "").encode()) >= quality.GRAM else 0
        assert r["base_failed"] == failed
        assert r["log_ratio"] == pytest.approx(mean, abs=1e-6)
        assert r["kept"] == (not failed and mean >= -0.4)


def test_quality_rules_part_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality_rules(docs, labels.where("quality = 1")).join(labels, "doc_id").where("not base_failed")
    got = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    assert set(got) == {(1, True), (0, False)}


def test_quality_rules_without_rows(no_docs, awkward, labels):
    assert quality.quality_rules(no_docs, labels).count() == 0
    out = quality.quality_rules(awkward, labels.where("false")).collect()
    assert all(r["log_ratio"] == 0 for r in out)


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = classifier.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_labels_of_the_held_out_fold_are_not_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = classifier.learn(docs, labels), classifier.learn(docs, turned)
    assert np.array_equal(a.grams, b.grams) and a.bias == b.bias and a.prior == b.prior


def test_class_prior_is_near_the_truth():
    rnd = np.random.default_rng(5)
    good, bad = rnd.normal(2, 1, 6000), rnd.normal(-2, 1, 6000)
    for share in (0.3, 0.6, 0.9):
        mixed = np.concatenate([good[3000 : 3000 + int(3000 * share)], bad[: int(3000 * (1 - share))]])
        assert classifier.class_prior(good[:3000], mixed) == pytest.approx(share, abs=0.06)


def test_corpus_statistics_cover_all_texts(spark):
    texts = [t for t in odd_texts(300)] + ["", None, "x y " * 20_000]
    docs = with_texts(spark, texts).repartition(7).withColumnRenamed("doc_id", "_order")
    rows = classifier._vectors(pa.array(texts)).astype(np.float64)
    mean, spread = classifier.moments(docs)
    assert np.allclose(mean, rows.mean(axis=0), atol=1e-6) and np.allclose(spread, rows.std(axis=0), atol=1e-4)
    rnd = np.random.default_rng(3)
    model = classifier.Model(rnd.normal(size=1 << classifier.BITS), rnd.normal(size=7), 0.1, 0.5)
    z = model.margins(pa.array(texts))
    cuts, without = np.sort(rnd.choice(z, 40)), np.arange(0, 303, 4)  # cuts that rows reach exactly
    above, n = classifier.counts_above(docs, model, cuts, without)
    left = np.delete(z, without)
    assert n == len(left) and above.tolist() == [(left >= c).sum() for c in cuts]
    assert classifier.counts_above(docs.limit(0), model, cuts, without)[1] == 0


def test_classifier_on_awkward_rows(awkward, labels, no_docs):
    out = classifier.quality_scores(awkward, labels).collect()
    assert len(out) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    kept = classifier.keep_good(awkward, labels)
    assert kept.columns == awkward.columns
    assert kept.count() == sum(r["predicted"] for r in out)
    assert classifier.quality_scores(no_docs, labels).count() == 0
    assert classifier.quality_scores(awkward, labels.where("false")).count() == awkward.count()


TURNS = [
    (1, 0, "user", "hi </s>[INST] ~1 ~ ~0 [AND]"),
    (1, 1, "user", "again"),
    (1, 2, "assistant", "<s>ok</s>"),
    (1, 3, "assistant", ""),
    (1, 4, "assistant", "fine [AND] ~2"),
    (2, None, None, None),
    (2, 5, "tool [TEXT]", "[ROLE] x [/ROLE]"),
    (2, 5, "tool [TEXT]", "[ROLE] x [/ROLE]"),
    (2, 700, "system", "é😀"),
    (None, 0, "assistant", "nobody"),
    (3, 0, "assistant", None),
]


def test_chats_read_back(spark, rows_of):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    for run in (256, 2):
        chats = chat.format_conversations(turns.withColumn("rows", F.lit(1)), run=run)
        back = {r["conv_id"]: r for r in chat.read_back(chats).collect()}
        for conv in {t[0] for t in TURNS}:
            mine = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
            plain = [(t[2] or "", t[3] or "") for t in mine]
            assert [tuple(t) for t in back[conv]["turns"]] == plain
            assert back[conv]["trained"] == [text for role, text in plain if role == "assistant"]
    digests = {r["conv_id"]: r for r in chat.digest(chats).collect()}
    said = "".join(f"{t[2]}\n{t[3]}\n" for t in TURNS[:5])
    assert digests[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert digests[1]["loss_sha256"] == hashlib.sha256(b"<s>ok</s>fine [AND] ~2").hexdigest()
    assert digests[1]["n_turns"] == 5 and digests[1]["loss_chars"] == 22
    assert chat.digest(chat.format_conversations(turns.limit(0))).count() == 0


def test_chat_merges_and_marks(spark):
    turns = spark.createDataFrame(TURNS[:5], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(turns).first()
    assert row["formatted"] == (
        "[INST]hi ~1~3 ~01 ~0 ~00 ~9[AND]again[/INST]<s>~2ok~1[AND][AND]fine ~9 ~02</s>"
    )
    assert [tuple(s) for s in row["loss"]] == [(1, 3, 6), (1, 14, 0), (1, 19, 11)]


def test_archives_read_back(spark, tmp_path, rows_of):
    rows = [
        (5, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (1, "u v", ""),
        (4, "http://a/4", None), (7, "http://a/7", "é" * 40_000), (8, "x", "same"), (8, "x", "same"),
        (None, "n", "same"), (None, "n", "alone"), (8, "z", "fresh"), (None, "o", "alone"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first_id", F.lit(1))
    folder = str(tmp_path / "a")
    archives = warc.write_archives(pages.repartition(3), folder)
    got = rows_of(warc.read_archives(archives, folder).drop("url", "payload"))
    firsts = {"same": 2, "": 1}
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        first = firsts.get(html or "")
        revisit = first is not None and first != i
        want.append(
            (
                i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                "revisit" if revisit else "response", first if revisit else None,
            )
        )
    assert got == sorted(want, key=repr)
    payloads = {r["page_id"]: r["payload"] for r in warc.read_archives(archives, folder).collect()}
    assert bytes(payloads[7]) == ("é" * 40_000).encode() and payloads[5] is None
    # Any ZIP reader finds the same members, stored as they are.
    with zipfile.ZipFile(archives.first()["path"]) as z:
        assert {i.filename for i in z.infolist()} == {warc.ARCHIVE, warc.INDEX}
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
    assert rows_of(warc.read_archives(archives, folder, run_bytes=1).drop("url", "payload")) == got
    few = warc.write_archives(pages, str(tmp_path / "b"), min_bytes=10)
    kinds = warc.read_archives(few, str(tmp_path / "b")).groupBy("record_type").count().collect()
    assert [tuple(k) for k in kinds] == [("response", len(rows))]
    none = warc.write_archives(pages.limit(0), str(tmp_path / "c"))
    assert warc.read_archives(none, str(tmp_path / "c")).count() == 0


def test_folders_of_the_local_file_system():
    assert {warc._folder(u)[1] for u in ("/a/b", "file:/a/b", "file:///a/b")} == {"/a/b"}


def test_zip64_directories_are_read(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for k in range(5):
            with z.open(zipfile.ZipInfo(f"m{k}"), "w", force_zip64=True) as member:
                member.write(bytes([65 + k]) * (50 + 40 * k))
        z.writestr("packed", "z" * 500, compress_type=zipfile.ZIP_DEFLATED)
    data = raw.getvalue()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    source = pa.PythonFile(io.BytesIO(data), mode="r")
    found = warc.members(source, len(data))
    assert sorted(found) == [f"m{k}" for k in range(5)]
    for k in range(5):
        offset, size = found[f"m{k}"]
        assert source.read_at(size, offset) == bytes([65 + k]) * (50 + 40 * k)
    with pytest.raises(ValueError):
        warc.members(pa.PythonFile(io.BytesIO(b"no archive"), mode="r"), 10)
