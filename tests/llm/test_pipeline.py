"""The pipeline stage by stage against what each operator decides on its own."""

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from fleetmart.llm import classifier, jaccard, linededup, mixing  # noqa: E402

SF = "/root/testdata/sf0.001"


def through(spark, docs, sf_dir, folder):
    """Each stage's input and output, written and read again."""
    steps = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        steps.append((docs, after))
        docs = after
    return steps


def test_stages_decide_as_their_operators_do(spark, tmp_path, rows_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = through(spark, docs, SF, str(tmp_path))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert all(after.columns == docs.columns for _, after in steps[:-1])

    before, after = steps[0]
    good = classifier.quality_scores(before, labels).where("predicted = 1").select("doc_id")
    assert rows_of(after) == rows_of(before.join(good, "doc_id", "left_semi").select(before.columns))
    wrong = labels.where("quality = 1").join(after, "doc_id", "left_anti").count()
    # About 45 texts to learn from; test_texts holds a larger table to 1 in 100.
    assert wrong <= 0.1 * labels.count()

    before, after = steps[1]
    drops = {r["doc_id"]: set(r["dropped"]) for r in linededup.line_report(before).collect()}
    want = {}
    for r in before.collect():
        lines = [x for k, x in enumerate(r["text"].split("\n")) if k not in drops[r["doc_id"]]]
        if not drops[r["doc_id"]] or "\n".join(lines).strip(" "):
            want[r["doc_id"]] = "\n".join(lines)
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want

    before, after = steps[2]
    classes = {r["doc_id"]: r["class_id"] for r in jaccard.similar_documents(before).collect()}
    assert {r["doc_id"] for r in after.collect()} == set(classes.values())

    before, after = steps[3]
    assert rows_of(after) == rows_of(mixing.mix(before, places=False))
    assert after.select("doc_id").distinct().count() == before.count()

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    before, after = steps[4]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert r["token_ids"] == library.encode(texts[r["doc_id"]]) and r["round_trip"]

    whole = corpus_pipeline.run(spark, SF)
    assert rows_of(whole) == rows_of(after)


def test_awkward_rows_go_through(spark, awkward, labels, tmp_path):
    folder = str(tmp_path / "in")
    labels.write.parquet(f"{folder}/labels.parquet")
    steps = through(spark, awkward, folder, str(tmp_path / "out"))
    assert all(after.columns == awkward.columns for _, after in steps[:-1])
    assert steps[-1][1].count() == steps[-2][1].count()


def test_empty_tables_go_through(spark, no_docs, labels, tmp_path):
    folder = str(tmp_path / "in")
    labels.where("false").write.parquet(f"{folder}/labels.parquet")
    steps = through(spark, no_docs.withColumn("_row", F.lit("x")), folder, str(tmp_path / "out"))
    assert steps[-1][1].count() == 0


def test_stages_are_the_dealt_ones():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
