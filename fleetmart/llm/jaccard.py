"""Similarity join of documents by the Jaccard similarity of their word n-grams."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.common import (
    lists,
    map_batches,
    mixed,
    ngrams,
    packed,
    possible,
    steps,
    stored,
    text_slices,
    unpacked,
    words,
)
from fleetmart.llm.components import components

# A pair at the threshold is missed once in 20 million times.
RECALL = 1 - 5e-8
_MOST_BANDS = 32


def bands_for(threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the most rows a band with which up to 32 bands reach ``recall``.

    A pair of similarity s shares a band with probability 1 - (1 - s**rows)**bands, so pairs
    at the ``threshold`` are found with at least ``recall``, and others above it more surely.
    Where even bands of one row are too few, there are as many as it takes.
    """
    if not (0 < threshold <= 1 and 0 < recall < 1):
        raise ValueError(f"threshold and recall must be in (0, 1], got {threshold}, {recall}")

    def needed(rows: int) -> int:
        shared = threshold**rows
        return 1 if shared == 1 else max(1, math.ceil(math.log1p(-recall) / math.log1p(-shared) - 1e-9))

    best = 1
    while best < 16 and needed(best + 1) <= _MOST_BANDS:
        best += 1
    return needed(best), best


def _constants(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def band_hashes(grams: np.ndarray, begins: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per row and band of ``rows`` MinHash values; rows without n-grams get zeros."""
    out = np.zeros((len(begins) - 1, bands), dtype=np.uint64)
    some = np.flatnonzero(np.diff(begins))
    if not len(some):
        return out
    cuts = begins[:-1][some]
    for band in range(bands):
        value = np.full(len(some), band + 1, dtype=np.uint64)
        for a in _constants(bands * rows, 1)[band * rows : (band + 1) * rows]:
            # A multiplication by an odd number permutes the 64-bit values.
            value = mixed(value * np.uint64(31) + np.minimum.reduceat(grams * a, cuts))
        out[some, band] = value
    return out


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, h1, h2, grams, bands) of every row: text hash, n-grams, band hashes."""

    def run(batches):
        for batch in batches:
            for part in text_slices(batch):
                _, _, _, hashes, first = words(part.column("text"))
                grams, begins = ngrams(hashes, first, n)
                found = band_hashes(grams, begins, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("h1"), part.column("h2"),
                        pa.array(np.diff(begins), pa.int64()),
                        lists(found.ravel().view(np.int64), np.full(len(found), bands), pa.int64()),
                    ],
                    names=["doc_id", "h1", "h2", "grams", "bands"],
                )

    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(7), "text").alias("h2"),
    )
    return map_batches(plain, run, "doc_id long, h1 long, h2 long, grams long, bands array<long>")


def _grams(rows: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row's text."""
    out = []
    for part in text_slices(rows):
        _, _, _, hashes, first = words(part.column("text"))
        grams, begins = ngrams(hashes, first, n)
        out += [np.unique(grams[a:b]) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    return out


def _verify(threshold: float, n: int):
    """Counts links among the rows of each unit, which come together and in order of side."""

    def links(buckets, sizes, sets, side, band):
        """Similar pairs of one unit: those that share no unit's bucket of an earlier band."""
        crossed = bool(side.any())
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if crossed else left
        # Positions of all n-grams in the unit's own vocabulary; what one row has alone can't meet.
        everything = np.concatenate(sets)
        _, code, counts = np.unique(everything, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        shared = counts[code] > 1
        code, owner = code[shared], owner[shared]
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        common = np.zeros((len(left), len(right)), dtype=np.int32)
        at_left, at_right = np.full(len(sets), -1), np.full(len(sets), -1)
        at_left[left], at_right[right] = np.arange(len(left)), np.arange(len(right))
        # Blocks of the vocabulary as 0/1 matrices: their product counts common n-grams.
        if len(code):
            cuts = np.flatnonzero(np.diff(code)) + 1
            column = np.zeros(len(code), dtype=np.int64)
            column[cuts] = 1
            column = np.cumsum(column)
            width = 2048
            edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                who, col = owner[a:b], column[a:b] - k * width
                x = np.zeros((len(left), width), dtype=np.float32)
                keep = at_left[who] >= 0
                x[at_left[who[keep]], col[keep]] = 1
                if crossed:
                    y = np.zeros((len(right), width), dtype=np.float32)
                    keep = at_right[who] >= 0
                    y[at_right[who[keep]], col[keep]] = 1
                else:
                    y = x
                common += (x @ y.T).astype(np.int32)
        union = sizes[left][:, None] + sizes[right][None, :] - common
        alike = common >= threshold * union
        for k in range(band):  # found in an earlier band
            here = [x.get(k) for x in buckets]
            if len(set(here)) > 1 or here[0] is not None:
                there = np.array([x is not None for x in here])
                value = np.array([x or 0 for x in here], dtype=np.int64)
                same = value[left][:, None] == value[right][None, :]
                alike &= ~(same & there[left][:, None] & there[right][None, :])
        if not crossed:
            np.fill_diagonal(alike, False)
        return left, right, alike

    def roots(n, left, right, alike):
        """The smallest row linked to each row, through any others of the unit."""
        parent = np.arange(n)

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for i in range(len(left)):
            row = right[alike[i]]
            for j in row.tolist():
                a, b = find(left[i]), find(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        return np.array([find(x) for x in range(n)])

    def answer(rows):
        whole = pa.Table.from_batches(rows)
        names = whole.column("cls").to_pylist()
        side = whole.column("side").to_numpy()
        if len(names) < 2 or (side.any() and side.all()):
            return None
        sets = [x for batch in rows for x in _grams(batch, n)]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        buckets = [{b["band"]: b["hash"] for b in x} for x in whole.column("buckets").to_pylist()]
        copies = whole.column("copies").to_numpy()
        band = int(whole.column("band")[0].as_py())
        left, right, alike = links(buckets, sizes, sets, side, band)
        linked = np.zeros(len(names), dtype=np.int64)
        linked[left] += alike @ copies[right]
        if side.any():
            linked[right] += alike.T @ copies[left]
        if not linked.any():
            return None
        top = roots(len(names), left, right, alike)
        some = np.flatnonzero(linked)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[k] for k in some]),
                pa.array(linked[some], pa.int64()),
                pa.array([names[top[k]] for k in some]),
            ],
            names=["cls", "links", "other"],
        )

    def run(batches):
        unit, rows = None, []
        for batch in batches:
            units = batch.column("unit").to_pylist()
            a = 0
            while a < len(units):
                b = a
                while b < len(units) and units[b] == units[a]:
                    b += 1
                if units[a] != unit:
                    if rows and (out := answer(rows)) is not None:
                        yield out
                    unit, rows = units[a], []
                rows.append(batch.slice(a, b - a))
                a = b
        if rows and (out := answer(rows)) is not None:
            yield out

    return run


def _uncovered(members: DataFrame) -> DataFrame:
    """``members`` (cls, band, hash, size) of the buckets that don't lie in one larger bucket.

    Every class names its largest bucket; one that all classes of a bucket name holds all of its
    pairs. So each class keeps its largest bucket, and its text needs to go to fewer units.
    """
    bucket = F.struct("size", "band", "hash")
    of_class = members.groupBy("cls").agg(F.collect_list(bucket).alias("_all"))
    named = of_class.select(F.array_max("_all").alias("_top"), F.explode("_all").alias("_own"))
    covered = (
        named.groupBy("_own")
        .agg(F.min("_top").alias("_low"), F.max("_top").alias("_high"))
        .where("_low = _high and _low <> _own")
        .select("_own.band", "_own.hash")
    )
    return members.join(covered, ["band", "hash"], "left_anti").select(*members.columns)


def similar_documents(
    docs: DataFrame,
    *,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = RECALL,
    block: int = 256,
) -> DataFrame:
    """Documents whose sets of word n-grams have a Jaccard similarity of ``threshold`` or more.

    Returns a row for every row of ``docs`` (doc_id, text): doc_id; copy_id, the smallest id
    with the same text; class_id, the smallest id of all documents that links connect to
    it; n_links, how many other documents are linked to it, equal texts included.

    Words are ``[^\\x20\\x09-\\x0D]+``; a text of fewer than n words has one n-gram, of all of
    them. Texts without words (null, empty) link to nothing; their copy_id and class_id are
    their own. Ids are meant to be unique; rows that repeat one are documents of their own.
    Rows with a null id take part; ids returned are then the smallest that is not null.

    MinHash banding, with bands and rows chosen by ``bands_for``: a pair of similarity
    ``threshold`` shares a band with probability ``recall``; at 0.8 that is 32 bands of 4 rows. Equal texts are one class, grouped by hash with map-side counts, so
    copies are never paired. Band hashes are shuffled; bands with the same classes count
    once, and one inside another isn't looked at (see ``_uncovered``). A bucket larger than
    ``block`` classes is cut into blocks, and each pair of blocks is a unit of work of its own,
    so neither a row per pair nor a large group in one task occurs. A unit gets one text of each
    of its classes, counts the n-grams that they share exactly, over their full sets, and returns
    one row per linked class. Only the first of the buckets left that a pair shares counts it.
    """
    with steps(docs.sparkSession):
        worded, known, rest = _similar(docs, n, threshold, recall, block)
        found = (
            stored(worded.select("cls", "doc_id"), "members-of")
            .join(known, "cls")
            .select("doc_id", "copy_id", "class_id", "n_links")
            .unionByName(rest)
        )
        return stored(found, "similar-documents", keep=True)


def _similar(
    docs: DataFrame,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = RECALL,
    block: int = 256,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with words (cls, doc_id), their classes of equal texts, and the answer for the rest.

    A class has its ``root``, one for all classes that links connect.
    """
    sign = stored(signatures(docs, n, *bands_for(threshold, recall)), "signatures")
    key = F.concat_ws("-", F.hex("h1"), F.hex("h2")).alias("cls")
    worded = sign.where("grams > 0").select(key, "doc_id", "bands")
    classes = stored(
        worded.groupBy("cls").agg(
            F.min("doc_id").alias("copy_id"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    banded = classes.select("cls", F.posexplode("bands").alias("band", "hash"))
    spread = F.xxhash64("cls")
    again = F.xxhash64(F.lit(5), F.col("cls"))
    buckets = (
        banded.groupBy("band", "hash")
        .agg(F.count("*").alias("size"), F.bit_xor(spread).alias("x1"), F.bit_xor(again).alias("x2"))
        .where("size > 1")
        .groupBy("size", "x1", "x2")
        .agg(F.min(F.struct("band", "hash")).alias("first"))
        .select("first.band", "first.hash", "size")
    )
    buckets = stored(buckets, "buckets")
    members = stored(
        possible(banded, "hash", buckets.select("hash"))
        .join(buckets, ["band", "hash"])
        .select("cls", "band", "hash", "size"),
        "members",
    )
    # One row per class with its buckets, and one text: of the rows of its smallest id, found by
    # a bitmap of ids first. Ids are met as two columns, since joins hash null-safe keys otherwise.
    wanted = stored(
        _uncovered(members)
        .groupBy("cls")
        .agg(F.collect_list(F.struct("band", "hash", "size")).alias("buckets")),
        "similar",
    )
    id_keys = lambda name: (F.coalesce(name, F.lit(0)).alias("_id"), F.isnull(name).alias("_null"))
    owners = stored(
        classes.join(wanted, "cls").select(
            "cls", F.col("copy_id").alias("doc_id"), *id_keys("copy_id"), "copies", "buckets"
        ),
        "owners",
    )
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.concat_ws(
            "-", F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit(7), "text"))
        ).alias("cls"),
    )
    held = possible(plain, "doc_id", owners.select("doc_id").where("doc_id is not null"))
    one = ["cls", "_id", "_null"]
    texts = (
        held.unionByName(plain.where("doc_id is null"))
        .select("cls", *id_keys("doc_id"), "text")
        .join(owners.drop("doc_id"), one)
        .dropDuplicates(one)
    )
    blocks = F.ceil(F.col("size") / block).cast("long")
    own = F.pmod(F.xxhash64(F.lit(9), "cls"), F.col("blocks"))
    units = (
        texts.withColumn("bucket", F.explode("buckets"))
        .select("cls", "text", "copies", "buckets", "bucket.*")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "cls",
            "band",
            F.concat_ws(
                "-", F.hex("hash"), "band", F.least("own", "other"), F.greatest("own", "other")
            ).alias("unit"),
            F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
            "copies",
            F.transform("buckets", lambda x: F.struct(x["band"].alias("band"), x["hash"].alias("hash"))).alias(
                "buckets"
            ),
            "text",
        )
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(
        map_batches(
            units.repartition(parts, "unit").sortWithinPartitions("unit", "side", "cls"),
            _verify(threshold, n),
            "cls string, links long, other string",
        ),
        "links",
    )
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    ids = roots.join(classes.select("cls", "copy_id"), roots["node"] == classes["cls"])
    lowest = stored(ids.groupBy("root").agg(F.min("copy_id").alias("class_id")), "lowest-ids")
    named = stored(roots.join(lowest, "root").select(F.col("node").alias("cls"), "root", "class_id"), "named")
    known = stored(
        classes.join(stored(linked, "linked"), "cls", "left")
        .join(named, "cls", "left")
        .select(
            "cls",
            "copy_id",
            F.coalesce("class_id", "copy_id").alias("class_id"),
            F.coalesce("root", "cls").alias("root"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "known",
    )
    rest = sign.where("grams = 0").select(
        "doc_id",
        F.col("doc_id").alias("copy_id"),
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return worded, known, rest


def keep_one(docs: DataFrame, *, repeats: bool = False, **options) -> DataFrame:
    """Of each class of similar documents one row, all columns kept.

    It is the row of the smallest id, a null id last; among rows of one id the text hash
    decides, and among null ids with one text the other columns. A row is told from others
    by its id and text. Rows without words all stay. Rows equal in an id that isn't null and
    in their text stay or go together; with ``repeats`` one of them stays.
    """
    with steps(docs.sparkSession):
        worded, known, _ = _similar(docs, **options)
        linked = known.where("n_links > 0")
        # A text of each class that stays, and the id of the row with it.
        first = F.min(F.struct(F.col("copy_id").isNull().alias("late"), "copy_id", "cls"))
        keepers = stored(linked.groupBy("root").agg(first.alias("keep")), "keepers")
        verdicts = linked.join(keepers, "root").select(
            "cls", F.expr("cls = keep.cls").alias("has"), F.col("keep.copy_id").alias("keep_id")
        )
        alike = worded.groupBy("cls", "doc_id").agg(F.count("*").alias("n"))
        found = (
            alike.join(stored(verdicts, "verdicts"), "cls")
            .withColumn("stays", F.expr("has and doc_id <=> keep_id"))
            .where(F.expr("not stays or n > 1") if repeats else F.expr("not stays or doc_id is null and n > 1"))
        )
        few = stored(
            found.select(F.col("doc_id").alias("_id"), F.col("cls").alias("_cls"), "stays"),
            "verdicts-of-rows",
            keep=True,
        )
    text_hash = F.concat_ws("-", F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit(7), "text")))
    own = packed(
        docs,
        _id=F.col("doc_id").cast("long"),
        _cls=text_hash,
        _words=F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)),
    )
    named, of_ids = own.where("_id is not null"), few.where("_id is not null")
    # Null ids go by their text alone. Those of one text are one row before they are shuffled.
    nobody = own.where("_id is null")
    of_texts = few.where("_id is null").select("_cls", "stays")
    one = F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")
    # Outer joins: anti joins would be moved below the bitmap, and all texts shuffled.
    met = possible(named, "_id", of_ids).join(of_ids, ["_id", "_cls"], "left")
    alone = possible(nobody.where("_words"), "_cls", of_texts).groupBy("_cls").agg(one)
    kept = [
        met.where("stays is null").select("_row"),
        possible(named, "_id", of_ids, inverse=True).select("_row"),
        alone.join(of_texts, "_cls", "left").where("coalesce(stays, true)").select("_row"),
        possible(nobody.where("_words"), "_cls", of_texts, inverse=True).select("_row"),
        nobody.where("not _words").select("_row"),
    ]
    if repeats:
        kept.append(met.where("stays").groupBy("_id", "_cls").agg(one).select("_row"))
    return unpacked(reduce(DataFrame.unionByName, kept), docs)
