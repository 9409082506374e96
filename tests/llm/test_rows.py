"""Rows without an id of their own: null ids, ids with several texts, rows that come twice."""

from pyspark.sql import functions as F

from fleetmart.llm import jaccard, linededup

SCHEMA = "doc_id long, text string, source string"
A, B, C, D = ("first line of them all", "words of another kind", "the weather is fine", "nothing like the rest")
ROWS = [
    (1, f"{A}\n{B}", "a"),
    (None, f"{C}\n{A}", "a"),  # line 1 repeats document 1
    (None, f"{D}\nclean line number one", "b"),
    (None, f"{D}\nclean text, number two", "b"),  # or the one above: line 0 of a null id twice
    (None, "a whole copy\nof two lines here", "a"),
    (None, "a whole copy\nof two lines here", "b"),
    (7, f"{B}\nonly in the first seven", "a"),  # line 0 repeats document 1
    (7, "another text under seven\nits clean second line", "a"),
    (8, "written twice under eight", "c"),
    (8, "written twice under eight", "d"),
]


def table_of(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_line_verdicts_are_per_row(spark):
    out = linededup.line_report(table_of(spark), repeats=True).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_lines"], r["dropped"]) for r in out))
    assert [x[1:] for x in got if not x[0]] == [(1, 2, []), (7, 2, []), (7, 2, [0]), (8, 1, []), (8, 1, [0])]
    assert [x[3] for x in got if x[0]] == [[], [], [0], [0, 1], [1]]
    assert all(r["n_dropped"] == len(r["dropped"]) for r in out)


def test_dedup_lines_loses_no_clean_line(spark):
    out = linededup.dedup_lines(table_of(spark)).collect()
    lines = sorted(line for r in out for line in r["text"].split("\n"))
    assert lines == sorted({line for _, text, _ in ROWS for line in text.split("\n")})
    assert len(out) == 8


def test_one_row_of_each_class_stays(spark):
    base = [f"w{k}" for k in range(90)]
    near = " ".join(["changed", *base[1:]])
    rows = [
        (None, " ".join(base), "a"), (None, " ".join(base), "b"), (None, near, "a"),  # one class of nobody
        (None, "some other text of nobody here", "a"),
        (None, "known to three as well as nobody", "a"), (3, "known to three as well as nobody", "b"),
        (None, "known to three as well as nobody", "c"),
        (4, "copied from three and four", "a"), (3, "copied from three and four", "a"),
        (4, "a clean text that repeats an id", "a"),
        (5, "five twice in all but its source", "a"), (5, "five twice in all but its source", "b"),
        (6, "six and six are unlike", "a"), (6, "entirely different words", "a"),
        (None, None, "a"), (None, None, "b"), (None, " ", "a"), (None, " ", "a"), (9, "", "a"), (9, "", "b"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_cls", F.lit("x")).repartition(3)
    out = jaccard.keep_one(docs, repeats=True)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    of_nobody = [t for i, t in got if i is None and t is not None and t.strip()]
    assert len(of_nobody) == 2 and "some other text of nobody here" in of_nobody
    assert got.count((None, None)) == 2 and got.count((None, " ")) == 2
    assert sorted((i, t) for i, t in got if i is not None) == [
        (3, "copied from three and four"),
        (3, "known to three as well as nobody"),
        (4, "a clean text that repeats an id"),
        (5, "five twice in all but its source"),
        (6, "entirely different words"),
        (6, "six and six are unlike"),
        (9, ""),
        (9, ""),
    ]
    once = jaccard.keep_one(docs).where("doc_id = 5").count()
    assert once == 2  # rows that repeat an id and a text, unless asked for


def test_equal_short_lines_are_found(spark):
    rows = [(1, "Home\n\nLog in\na", "a"), (2, "Home\nLog on\n \nHom", "a"), (3, " Home \nb\na", "a")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r["dropped"] for r in linededup.line_report(docs, min_chars=8, min_equal=1).collect()}
    assert got == {1: [], 2: [0], 3: [0, 2]}
    assert not any(r["dropped"] for r in linededup.line_report(docs, min_chars=8).collect())
    # Without a floor: "Log on", "Hom" and "b" are one edit from earlier lines, too.
    got = {r["doc_id"]: r["dropped"] for r in linededup.line_report(docs).collect()}
    assert got == {1: [], 2: [0, 1, 3], 3: [0, 1, 2]}
