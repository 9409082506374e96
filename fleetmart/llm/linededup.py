"""Near-duplicate lines: a join on deletion neighbourhoods that keeps the earliest line."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.common import (
    map_batches,
    mixed,
    packed,
    possible,
    steps,
    stored,
    text_key,
    unpacked,
)

MIN_CHARS = 1
_TRIM = " \t\x0b\x0c\r"


def _line(line: Column) -> Column:
    return F.btrim(line, F.lit(_TRIM))


def _halves(line: Column) -> Column:
    """Keys of which two different lines within one edit share at least one.

    The edit leaves the first or the last half of the shorter length m intact. Lines of an
    even length m and of m + 1 use m; an even length also uses m - 2, for a partner that is
    one shorter.
    """
    n = F.char_length(line)
    even = n - n % 2

    def pair(m: Column) -> list[Column]:
        half = (m / 2).cast("int")
        return [
            F.xxhash64(F.lit("p"), m, F.substring(line, F.lit(1), half)),
            F.xxhash64(F.lit("s"), m, F.substring(line, n - half + 1, half)),
        ]

    return F.when(n % 2 == 0, F.array(*pair(even), *pair(even - 2))).otherwise(
        F.array(*pair(even))
    )


def _pieces(line: Column, edits: int) -> Column:
    """Keys of which two lines within ``edits`` edits share at least one.

    A line is cut into edits + 1 pieces, one of which no edit touches: its partner holds it
    at a place moved by ``edits`` at most. So a line gives keys for the pieces of every
    length that its partner may have, at every such place.
    """
    n = F.char_length(line)
    found = []
    for more in range(-edits, edits + 1):
        length = n + more
        for k in range(edits + 1):
            start = F.floor(length * k / (edits + 1)).cast("int")
            size = F.floor(length * (k + 1) / (edits + 1)).cast("int") - start
            for move in range(-edits, edits + 1):
                at = start + move
                inside = (length > 0) & (at >= 0) & (at + size <= n)
                found.append(
                    F.when(inside, F.xxhash64(F.lit(k), length, F.substring(line, at + 1, size)))
                )
    return F.array_distinct(F.array_compact(F.array(*found)))


def _spread(points: np.ndarray) -> np.ndarray:
    """A 64-bit value for each code point."""
    values = points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return values ^ (values >> np.uint64(32))


def variant_hashes(line: str) -> np.ndarray:
    """Hashes of the line without its k-th character, for every k, and of the line itself.

    A polynomial over code points: what follows the deleted character moves down a power,
    so two running sums give all variants in one pass.
    """
    values = _spread(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32))
    n = len(values)
    powers = np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    before, after = np.zeros(n + 1, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    np.cumsum(values * powers[:n], out=before[1:])
    np.cumsum(values[1:] * powers[: n - 1], out=after[1:])
    return np.append(before[:n] + (after[-1] - after), before[n])


_MOST = 200_000


def _neighbourhoods(batches):
    """Rows (variant, place, rank) of each line: without character ``place``; itself at -1."""
    for batch in batches:
        parts, size = [], 0
        for rank, line in zip(
            batch.column("rank").to_pylist(), batch.column("line").to_pylist(), strict=True
        ):
            hashes = variant_hashes(line)
            parts.append((rank, hashes))
            size += len(hashes)
            if size >= _MOST:
                yield _variants(parts)
                parts, size = [], 0
        if parts:
            yield _variants(parts)


def _variants(parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    places = [np.append(np.arange(len(h) - 1, dtype=np.int32), np.int32(-1)) for _, h in parts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([h for _, h in parts]).view(np.int64)),
            pa.array(np.concatenate(places).astype(np.int32)),
            pa.array(np.repeat([r for r, _ in parts], [len(h) for _, h in parts]).astype(np.int64)),
        ],
        names=["variant", "place", "rank"],
    )


def deletions(line: str, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the line without any set of up to ``edits`` characters, and their gaps.

    A gap is the number of characters left before a deleted one. The hashes are those of
    ``variant_hashes``: each stretch between deleted characters moves down by their number.
    """
    values = _spread(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32))
    n = len(values)
    powers = np.full(n + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.zeros((edits + 1, n + 1), dtype=np.uint64)
    for moved in range(min(edits, n) + 1):
        np.cumsum(values[moved:] * powers[: n - moved], out=sums[moved, moved + 1 :])
    for count in range(min(edits, n) + 1):
        sets = combinations(range(n), count)
        while chunk := list(islice(sets, _SETS)):
            gone = np.array(chunk, dtype=np.int64).reshape(len(chunk), count)
            starts = np.concatenate([np.zeros((len(gone), 1), np.int64), gone + 1], axis=1)
            ends = np.concatenate([gone, np.full((len(gone), 1), n, np.int64)], axis=1)
            part = sums[np.arange(count + 1), np.maximum(ends, np.arange(count + 1))]
            part = part - sums[np.arange(count + 1), np.maximum(starts, np.arange(count + 1))]
            yield part.sum(axis=1, dtype=np.uint64), gone - np.arange(count)


_SETS = 50_000


def _meeting_keys(hashes: np.ndarray, gaps: np.ndarray, size: int, shared: int) -> list[np.ndarray]:
    """Keys of variants of ``size`` deletions by each choice of ``shared`` of their gaps."""
    out = []
    for columns in combinations(range(gaps.shape[1]), shared):
        key = mixed(hashes + np.uint64(1 + size * 64 + shared))
        for c in columns:
            key = mixed(key * np.uint64(31) + gaps[:, c].astype(np.uint64) + np.uint64(1))
        out.append(key)
    return out


def _meetings(edits: int):
    """Rows (variant, asks, rank): where lines are to be found, and where they look."""

    def run(batches):
        for batch in batches:
            ranks, texts = batch.column("rank").to_pylist(), batch.column("line").to_pylist()
            for rank, line in zip(ranks, texts, strict=True):
                for hashes, gaps in deletions(line, edits):
                    p = gaps.shape[1]
                    told, asked = [], []
                    # Variants of p and q deletions are within the bound where they share as many
                    # gaps as p + q exceeds it: those are replacements.
                    for q in range(edits + 1):
                        shared = max(0, p + q - edits)
                        if shared <= min(p, q):
                            asked += _meeting_keys(hashes, gaps, q, shared)
                            told += _meeting_keys(hashes, gaps, p, shared)
                    for keys, asks in ((told, False), (asked, True)):
                        found = np.unique(np.concatenate(keys)).view(np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(found),
                                pa.array(np.full(len(found), asks)),
                                pa.array(np.full(len(found), rank, dtype=np.int64)),
                            ],
                            names=["variant", "asks", "rank"],
                        )

    return run


def _far_partners(lines: DataFrame, edits: int) -> DataFrame:
    """``_partners`` for any bound: all variants with up to ``edits`` characters deleted.

    Whoever meets under a key is within the bound, so again a minimum per key is enough.
    """
    met = stored(
        map_batches(
            lines.select("rank", "line"), _meetings(edits), "variant long, asks boolean, rank long"
        ),
        "variants",
    )
    best = stored(
        met.where("not asks").groupBy("variant").agg(F.min("rank").alias("best")), "earliest-variants"
    )
    asked = met.where("asks").join(best, "variant").where("best < rank")
    return asked.groupBy("rank").agg(F.min("best").alias("best"))


def _row_key(text: str = "text") -> tuple[Column, Column]:
    """Beside its id, what tells a row from others: 128 bits of its text."""
    t1, t2 = text_key(text)
    return t1.alias("t1"), t2.alias("t2")


def _same_row(*names: str) -> Column:
    """Whether (doc, t1, t2) and the columns ``names`` are the same row; ids may be null."""
    doc, t1, t2 = names
    return F.col(doc).eqNullSafe(F.col("doc")) & (F.col(t1) == F.col("t1")) & (F.col(t2) == F.col("t2"))


def _split(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, t1, t2, no, line) of every line that is compared.

    Lines are parted by \\n and compared without blanks at their ends; lines of fewer than
    ``min_chars`` characters are not compared.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc"),
        *_row_key(),
        F.posexplode(F.transform(F.split("text", "\n"), _line)).alias("no", "line"),
    ).where(F.char_length("line") >= min_chars)


def lines_of(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_equal: int | None = None,
    edits: int = 1,
) -> DataFrame:
    """(doc, t1, t2, no, h1, h2, halves) of every line that is compared, without its text.

    Lines of ``min_equal`` characters (``min_chars`` if None) up to ``min_chars`` are only
    compared for equality and have no halves.
    """
    line = F.col("line")
    keys = _halves(line) if edits == 1 else _pieces(line, edits)
    halves = F.when(F.char_length("line") >= min_chars, keys)
    return _split(docs, _floor(min_chars, min_equal)).select(
        "doc", "t1", "t2", "no", *text_key("line"), halves.alias("halves")
    )


def _floor(min_chars: int, min_equal: int | None) -> int:
    return min_chars if min_equal is None else max(1, min(min_equal, min_chars))


_PLACE = "struct(doc is null as late, doc, t1, t2, no)"


def _candidates(docs: DataFrame, lines: DataFrame, first: DataFrame, min_chars: int) -> DataFrame:
    """(rank, line, h1, h2, at) of each different line that shares a half with another one.

    ``at`` is its earliest place, ``rank`` numbers the lines by it.
    """
    halves = lines.select("h1", "h2", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b"))
    shared = stored(shared.where("a <> b").select("half"), "halves")
    found = stored(
        possible(halves, "half", shared).join(shared, "half").select("h1", "h2").distinct(),
        "candidates",
    )
    places = stored(found.join(first.select("h1", "h2", "at"), ["h1", "h2"]), "places")
    # Their texts: from the documents that own them, line by line.
    owners = places.select(F.col("at.doc").alias("doc_id")).where("doc_id is not null").distinct()
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = possible(plain, "doc_id", owners).unionByName(plain.where("doc_id is null"))
    texts = _split(texts, min_chars).select("doc", "t1", "t2", "no", "line", *text_key("line"))
    wanted = places.select(
        "h1", "h2", "at", *(F.col(f"at.{name}").alias(f"_{name}") for name in ("doc", "t1", "t2", "no"))
    )
    line_of = (
        texts.withColumnsRenamed({"h1": "k1", "h2": "k2"}).join(
            wanted,
            _same_row("_doc", "_t1", "_t2")
            & (F.col("no") == F.col("_no"))
            & (F.col("k1") == F.col("h1"))
            & (F.col("k2") == F.col("h2")),
        )
    )
    once = line_of.groupBy("h1", "h2", "at").agg(F.min("line").alias("line"))
    ordered = once.orderBy("at", "h1", "h2").withColumn("rank", F.monotonically_increasing_id())
    return stored(ordered, "candidate-lines")


def _partners(lines: DataFrame) -> DataFrame:
    """(rank, best): lines and the earliest line they share a variant with, if it is earlier."""
    variants = stored(
        map_batches(
            lines.select("rank", "line"), _neighbourhoods, "variant long, place int, rank long"
        ),
        "variants",
    )
    groups = variants.groupBy("variant").agg(F.min("rank").alias("a"), F.max("rank").alias("b"))
    shared = stored(groups.where("a <> b").select("variant"), "shared-variants")
    met = stored(possible(variants, "variant", shared).join(shared, "variant"), "met")
    whole, reduced = met.where("place < 0"), met.where("place >= 0")

    def earliest(df: DataFrame, *keys: str) -> DataFrame:
        return stored(df.groupBy(*keys).agg(F.min("rank").alias("best")), "earliest-variants")

    return (
        reduced.join(earliest(reduced, "variant", "place"), ["variant", "place"])
        .select("rank", "best")
        .unionByName(reduced.join(earliest(whole, "variant"), "variant").select("rank", "best"))
        .unionByName(whole.join(earliest(reduced, "variant"), "variant").select("rank", "best"))
        .where("best < rank")
        .distinct()
    )


def repeated_lines(
    docs: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_equal: int | None = None,
    edits: int = 1,
) -> DataFrame:
    """(doc, t1, t2, no): lines that an earlier line equals or differs from by ``edits`` edits.

    An edit inserts, deletes or replaces one character. Earlier is the smaller
    (doc_id, text hash, line number), a null id last, so rows of a null or repeated id are
    told apart by their texts (t1, t2). Lines at one such place, of rows equal in id and
    text, don't repeat each other. Every line is held against every earlier one, kept or
    not, so no line's verdict depends on others' verdicts.

    All lines that aren't blank are compared. ``min_chars`` may spare shorter lines; with
    ``min_equal`` these still repeat an equal line if they have that many characters.

    ``edits`` is the bound, 1 or more. A line has about length ** edits variants, so bounds
    above 1 are for tables of short lines.

    Equal lines meet first, by hash, in a map-side minimum. Different lines within one edit
    agree in one half (within more edits, in one piece of edits + 1); lines that share none
    with another line have no partner and go no further. For the others all variants with
    that many characters deleted are emitted as hashed keys; with a bound of 1 these are as follows. Two lines reduced at the same place to the same variant differ by a replacement
    there; a reduced line and a whole one by a deletion. So a minimum per (variant, place)
    and per whole variant gives every line its earliest partner: no pairs within a group
    are formed, and a group of any size shrinks before it is shuffled. The partners found
    are verified by their edit distance.
    """
    if edits < 1:
        raise ValueError(f"edits must be 1 or more, got {edits}")
    lines = stored(lines_of(docs, min_chars, min_equal, edits), "lines")
    first = stored(
        lines.groupBy("h1", "h2").agg(F.min(F.expr(_PLACE)).alias("at"), F.count("*").alias("n")),
        "first-lines",
    )
    few = _candidates(docs, lines, first, min_chars)
    late = few.select("rank", "h1", "h2", "line")
    early = few.select(F.col("rank").alias("best"), F.col("line").alias("other"), F.col("at").alias("near"))
    verified = (
        stored(_partners(few) if edits == 1 else _far_partners(few, edits), "partners")
        .join(late, "rank")
        .join(early, "best")
        .where(F.levenshtein("line", "other", edits) >= 0)
        .groupBy("h1", "h2")
        .agg(F.min("near").alias("near"))
    )
    repeated = first.join(stored(verified, "near-lines"), ["h1", "h2"], "left")
    earliest = stored(
        repeated.where("n > 1 or near is not null").select("h1", "h2", F.least("at", "near").alias("at")),
        "earliest-lines",
    )
    return (
        possible(lines.select("doc", "t1", "t2", "no", "h1", "h2"), "h1", earliest)
        .join(earliest, ["h1", "h2"])
        .where(F.expr(f"at < {_PLACE}"))
        .select("doc", "t1", "t2", "no")
    )


def _by_row(docs: DataFrame, min_chars: int, min_equal: int | None, edits: int) -> DataFrame:
    """(doc, t1, t2, dropped): the sorted line numbers to drop in each row that has any."""
    with steps(docs.sparkSession):
        found = repeated_lines(docs, min_chars=min_chars, min_equal=min_equal, edits=edits)
        dropped = found.groupBy("doc", "t1", "t2").agg(F.sort_array(F.collect_set("no")).alias("dropped"))
        return stored(dropped, "dropped", keep=True)


def _copies(docs: DataFrame) -> DataFrame:
    """(doc, t1, t2, copies) of the rows with lines that come more than once, id and text alike."""
    rows = docs.where(F.btrim("text", F.lit(_TRIM + "\n")) != "").select(
        F.col("doc_id").cast("long").alias("doc"), *_row_key()
    )
    counted = rows.groupBy("doc", "t1", "t2").agg(F.count("*").alias("copies"))
    return stored(counted.where("copies > 1"), "copies")


def line_report(
    docs: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_equal: int | None = None,
    edits: int = 1,
    repeats: bool = False,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped) for every row of ``docs`` (doc_id, text).

    ``dropped`` holds the numbers, from 0, of the lines that repeat an earlier line (see
    ``repeated_lines``). A null text has no lines. Rows that repeat an id, or have none, get
    verdicts of their own; of rows equal in id and text each gets those of the first, or
    with ``repeats`` all but one have all compared lines dropped. Other columns are ignored.
    """
    drops = _by_row(docs, min_chars, min_equal, edits)
    none = F.expr("cast(array() as array<int>)")
    counts = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        *(key.alias(f"_{name}") for name, key in zip(("t1", "t2"), _row_key(), strict=True)),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).alias("n_lines"),
        "text",
    )
    plain = counts.drop("text")
    joined = plain.join(drops, _same_row("_id", "_t1", "_t2"), "left").drop("doc", "t1", "t2")
    if repeats:
        again = _copies(docs)
        single = joined.join(again, _same_row("_id", "_t1", "_t2"), "left").where("copies is null")
        # Rows equal in id and text differ in nothing here: one stands for all of them.
        one = (
            possible(counts, "_t1", again.select(F.col("t1").alias("_t1")))
            .join(again, _same_row("_id", "_t1", "_t2"))
            .groupBy("_id", "_t1", "_t2", "n_lines", "copies")
            .agg(F.first("text").alias("text"))
        )
        every = F.transform(F.split("text", "\n"), lambda line, no: F.when(F.char_length(_line(line)) >= _floor(min_chars, min_equal), no))
        each = (
            one.join(drops, _same_row("_id", "_t1", "_t2"), "left")
            .withColumn("every", F.array_compact(every))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .withColumn("dropped", F.when(F.col("copy") == 1, F.col("dropped")).otherwise(F.col("every")))
        )
        joined = single.select("_id", "n_lines", "dropped").unionByName(
            each.select("_id", "n_lines", "dropped")
        )
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", none).alias("dropped"),
    )


def dedup_lines(
    docs: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_equal: int | None = None,
    edits: int = 1,
) -> DataFrame:
    """``docs`` with the repeated lines taken out of its texts, all columns kept.

    Documents of which nothing but blanks is left go; those that had nothing to begin with
    stay as they are. Of rows equal in id and text one stays; which, their other columns decide.
    """
    drops = _by_row(docs, min_chars, min_equal, edits)
    copies = _copies(docs)
    few = stored(
        drops.select("doc", "t1", "t2", "dropped")
        .join(copies.withColumnsRenamed({"doc": "_id", "t1": "_t1", "t2": "_t2"}), _same_row("_id", "_t1", "_t2"), "full")
        .select(
            F.coalesce("doc", "_id").alias("doc"),
            F.coalesce("t1", "_t1").alias("t1"),
            F.coalesce("t2", "_t2").alias("t2"),
            "dropped",
            F.coalesce("copies", F.lit(1)).alias("copies"),
        ),
        "verdicts",
    )
    t1, t2 = _row_key()
    own = packed(docs, _id=F.col("doc_id").cast("long"), _t1=t1, _t2=t2, _text=F.col("text"))
    rest = "transform(filter(transform(split(_text, '\\n'), (line, no) -> struct(no, line)),"
    rest += " x -> not array_contains(dropped, x.no)), x -> x.line)"
    key = few.select(F.col("t1").alias("_t1"))
    # An outer join: an inner one would be moved below the bitmap.
    met = possible(own, "_t1", key).join(few, _same_row("_id", "_t1", "_t2"), "left")
    once = (
        met.where("copies > 1")
        .groupBy("_id", "_t1", "_t2")
        .agg(
            F.min_by(F.struct("_row", "_text", "dropped"), F.xxhash64(F.to_json("_row"))).alias("_one")
        )
        .select("_one.*")
    )
    cut = (
        met.where("copies is null or copies = 1")
        .select("_row", "_text", "dropped")
        .unionByName(once)
        .withColumn(
            "_left",
            F.when(F.col("dropped").isNull(), F.col("_text")).otherwise(
                F.array_join(F.expr(rest), "\n")
            ),
        )
        .where("dropped is null or _text is null or trim(_left) <> ''")
    )
    same = possible(own, "_t1", key, inverse=True)
    return unpacked(cut, docs, text=F.col("_left")).unionByName(unpacked(same, docs))
