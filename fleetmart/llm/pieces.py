"""SentencePiece encoding by suffix-array matching of all pieces, and decoding."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fleetmart.llm.bpe import Pairs, merge
from fleetmart.llm.common import lists, map_batches, text_slices

SPACE = "▁"
_WIDTH = 16


class PieceTable:
    """The pieces of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        lib = SentencePieceProcessor(model_proto=model)
        size = lib.get_piece_size()
        self.names = [lib.id_to_piece(i) for i in range(size)]
        scores = [lib.get_score(i) for i in range(size)]
        plain = [
            i for i in range(size)
            if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))
        ]
        self.ids = {self.names[i]: i for i in plain}
        self.bytes = [self.ids_of_byte(lib, b) for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        # What an id says on its own: bytes below 0x80 their character, control ids nothing.
        self.texts = ["" if lib.is_control(i) else self.names[i] for i in range(size)]
        self.wide = np.zeros(size, dtype=bool)
        for i, b in self.byte_of.items():
            if b < 0x80:
                self.texts[i] = chr(b)
            else:
                self.wide[i] = True
        if max(map(len, self.ids)) > _WIDTH:
            raise ValueError(f"pieces of more than {_WIDTH} characters are not supported")
        self.chars = {c for piece in self.ids for c in piece}
        # Characters that follow each other inside some piece: only there can merges happen.
        self.alone = {c for c in self.chars if c in self.ids}
        self.touching = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        ranks = {self.names[i]: -scores[i] for i in plain}
        rank = lambda a, b, get=ranks.get: get(a + b, float("inf"))
        self.rank = rank
        self.pairs = Pairs(self.names, list, rank)
        # Pieces as rows of code points, longest first at each start of a match.
        order = [p for p in self.ids if set(p) != {SPACE} or p == SPACE]
        self.widths = np.array([len(name) for name in self.names], dtype=np.int64)
        self.matrix = np.zeros((len(order), _WIDTH), dtype=np.uint32)
        for k, piece in enumerate(order):
            self.matrix[k, : len(piece)] = [ord(c) for c in piece]
        self.lengths = np.array([len(p) for p in order])
        self.numbers = np.array([self.ids[p] for p in order])
        self.alphabet = np.array(sorted(ord(c) for c in self.chars), dtype=np.uint32)

    @staticmethod
    def ids_of_byte(lib, byte: int) -> int:
        return lib.piece_to_id(f"<0x{byte:02X}>")

    def spaces(self, n: int) -> list[int]:
        """A run of spaces alone."""
        return [self.ids[p] for p in merge([SPACE] * n, self.rank)]

    def edges(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every occurrence of every piece in the segments: starts, ends, piece ids.

        The segments are joined into one text and its suffixes sorted by their first
        characters, as many as fit 64 bits. Each piece is searched in them: its occurrences
        are one range of the suffix array, where of longer pieces the rest is compared. Edges come sorted by end, longest first; the last value returned
        holds where each segment starts.
        """
        text = np.frombuffer("\n".join(["", *segments, ""]).encode("utf-32-le"), dtype=np.uint32)
        used = np.unique(text)
        used = used[np.isin(used, self.alphabet)]
        bits = 8 if len(used) < 255 else 16
        # Codes from 1, in order; 0 ends a suffix, for any character that no piece has.
        top = int(max(text.max(initial=0), self.alphabet[-1])) + 1
        code = np.zeros(top, dtype=np.uint64)
        code[used] = np.arange(1, len(used) + 1, dtype=np.uint64)
        coded = np.concatenate([code[text], np.zeros(_WIDTH, dtype=np.uint64)])
        # A suffix ends at the first foreign character: later ones must not count.
        per = 64 // bits
        full = np.uint64((1 << bits) - 1)

        def keys(columns, n):
            """The first 16 codes as integers of ``per`` codes, most significant first."""
            out, alive = [], np.ones(n, dtype=bool)
            for a in range(0, _WIDTH, per):
                key = np.zeros(n, dtype=np.uint64)
                for k in range(a, a + per):
                    column = columns(k)
                    alive &= column > 0
                    key |= np.where(alive, column, np.uint64(0)) << np.uint64(bits * (per - 1 - k + a))
                out.append(key)
            return out

        places = np.flatnonzero(code[text] > 0)
        suffixes = keys(lambda k: coded[places + k], len(places))
        order = np.argsort(suffixes[0])
        array, ranked = places[order], suffixes[0][order]

        inside = np.isin(self.matrix, used) | (self.matrix == 0)
        rows = np.flatnonzero(inside.all(axis=1))
        pieces, lengths = self.matrix[rows], self.lengths[rows]
        low = keys(lambda k: code[pieces[:, k]], len(rows))
        # Bits of each key that a piece's characters take.
        masks = [np.zeros(len(rows), dtype=np.uint64) for _ in low]
        for k in range(_WIDTH):
            shift = np.uint64(bits * (per - 1 - k % per))
            masks[k // per] |= np.where(k < lengths, full << shift, np.uint64(0))
        first = np.searchsorted(ranked, low[0], side="left")
        last = np.searchsorted(ranked, low[0] | ~masks[0], side="right")
        n = last - first
        total = int(n.sum())
        which = np.repeat(np.arange(len(rows)), n)
        at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        same = np.ones(total, dtype=bool)  # what a long piece has beyond the first key
        long = np.flatnonzero(lengths[which] > per)
        for key, mask, wanted in list(zip(suffixes, masks, low, strict=True))[1:]:
            same[long] &= key[order[at[long]]] & mask[which[long]] == wanted[which[long]]
        which, at = which[same], at[same]
        starts = array[at]
        ends = starts + lengths[which]
        by_position = np.lexsort((starts, ends))
        sizes = np.array([len(s) for s in segments], dtype=np.int64)
        begins = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])[:-1]
        return (
            starts[by_position], ends[by_position], self.numbers[rows][which][by_position], begins
        )

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, one after another, and how many each has.

        Edges are relaxed from left to right, for all segments at once, position by
        position: a position takes the one edge whose piece may follow the piece that the
        edge's start took. Then the segments are read off backwards.
        """
        if not segments:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        starts, ends, ids, begins = self.edges(segments)
        sizes = np.array([len(s) for s in segments], dtype=np.int64)
        last = np.full(int(sizes.sum()) + len(segments) + 2, -1, dtype=np.int64)
        last[begins] = -2
        step = ends - begins[np.searchsorted(begins, ends, side="left") - 1]
        order = np.argsort(step, kind="stable")
        starts, ends, ids = starts[order], ends[order], ids[order]
        cuts = np.searchsorted(step[order], np.arange(1, int(sizes.max()) + 2))
        pairs = self.pairs
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            before = last[starts[a:b]]
            asked = np.flatnonzero(before >= 0)
            fits = before == -2
            wanted, back = np.unique(before[asked] << 20 | ids[a:b][asked], return_inverse=True)
            known = np.fromiter(map(pairs.__getitem__, wanted.tolist()), dtype=bool, count=len(wanted))
            fits[asked] = known[back]
            last[ends[a:b][fits]] = ids[a:b][fits]
        found, owners = [], []
        at, who = begins + sizes, np.arange(len(segments))
        while len(who):
            token = last[at]
            found.append(token)
            owners.append(who)
            at = at - self.widths[token]
            more = at > begins[who]
            at, who = at[more], who[more]
        owner = np.concatenate(owners[::-1])
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate(found[::-1])[order].astype(np.int32)
        return ids, np.bincount(owner, minlength=len(segments))


def _gather(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of all elements of lists that begin at ``begins`` in one array."""
    total = int(counts.sum())
    return np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(total)


class _Lists:
    """Lists of integers by name, kept in one growing array."""

    def __init__(self, kind: type):
        self.number: dict[str, int] = {}
        self.values = np.zeros(1 << 16, dtype=kind)
        self.begins, self.counts = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def add(self, names: list[str], values: np.ndarray, counts: np.ndarray) -> None:
        n, m = len(self.number), len(names)
        while self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while n + m > len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.values[self.used : self.used + len(values)] = values
        self.begins[n : n + m] = self.used + np.cumsum(counts) - counts
        self.counts[n : n + m] = counts
        self.number.update(zip(names, range(n, n + m), strict=True))
        self.used += len(values)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[numbers]
        return self.values[_gather(self.begins[numbers], counts)], counts


class Encoder:
    """Encodes texts in batches; remembers up to ``most`` words and the parts they fall into."""

    def __init__(self, model: bytes, most: int = 600_000):
        self.table, self.most = PieceTable(model), most
        self.words, self.parts = _Lists(np.int32), _Lists(np.int32)
        self.odd = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def _marked(self, text: str) -> list[str]:
        """Words of any text: spaces become marks, one goes before the text, and it falls
        apart before each run of marks, since no piece has a mark after another character."""
        return self.odd.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _parts_of(self, word: str) -> list[str]:
        """Cuts a word between characters that no piece holds side by side.

        Only characters outside all pieces must be cut off; the other cuts save work, and
        in an ASCII word of known characters a look at the last one does.
        """
        touching = self.table.touching
        if word[1:].isascii() and self.table.alone.issuperset(word):
            if word[-1].isalnum() or word[-2:] in touching:
                return [word]
            if word[-3:-1] in touching:
                return [word[:-1], word[-1]]
        out, begin = [], 0
        for k in range(1, len(word)):
            if word[k - 1 : k + 1] not in touching:
                out.append(word[begin:k])
                begin = k
        out.append(word[begin:])
        return out

    def _learn(self, words: list[str]) -> None:
        split = [self._parts_of(w) for w in words]
        known = self.parts.number
        fresh = [p for p in dict.fromkeys(chain.from_iterable(split)) if p not in known]
        # Runs of marks and characters outside the pieces go their own way.
        plain = [p for p in fresh if len(p) > 1 and not p.startswith(SPACE + SPACE)]
        self.parts.add(plain, *self.table.encode_segments(plain))
        for p in fresh:
            if p not in known:
                ids = self._odd_part(p)
                self.parts.add([p], np.array(ids, np.int32), np.array([len(ids)]))
        flat = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), dtype=np.int32)
        self.words.add(words, flat, np.array([len(parts) for parts in split], dtype=np.int64))

    def _odd_part(self, part: str) -> list[int]:
        table = self.table
        if len(part) == 1:
            return [table.ids[part]] if part in table.ids else [table.bytes[b] for b in part.encode("utf-8")]
        run = len(part) - len(part.lstrip(SPACE))
        if run == len(part):
            return table.spaces(run)
        ids = table.encode_segments([part[run - 1 :]])[0].tolist()
        if ids[0] == table.ids[SPACE]:  # a lone mark joins the run; merges of marks come last
            return table.spaces(run) + ids[1:]
        return table.spaces(run - 1) + ids

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words, learning those that are new."""
        number = self.words.number
        fresh = [w for w in words if w not in number]
        if len(number) + len(fresh) > self.most:
            self.words, self.parts = _Lists(np.int32), _Lists(np.int32)
            number, fresh = self.words.number, words
        if fresh:
            self._learn(fresh)
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def _ids(self, numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as ``lengths`` words each, and how many each text has."""
        parts, per_word = self.words.of(numbers)
        ids, per_part = self.parts.of(parts)
        sums = np.concatenate([[0], np.cumsum(per_part)])
        ends = np.concatenate([[0], np.cumsum(per_word)])[np.concatenate([[0], np.cumsum(lengths)])]
        return ids, np.diff(sums[ends])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and how many each text has."""
        easy = np.array(
            [
                bool(t) and t[0] != " " and t[-1] != " " and "  " not in t and SPACE not in t
                for t in texts
            ],
            dtype=bool,
        )
        found = []
        plain = [t for t, e in zip(texts, easy, strict=True) if e]
        if plain:  # each space parts two words
            lists_ = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
            coded = lists_.flatten().dictionary_encode()
            numbers = self._numbers([SPACE + w for w in coded.dictionary.to_pylist()])
            lengths = pc.list_value_length(lists_).to_numpy()
            found.append(self._ids(numbers[coded.indices.to_numpy()], lengths))
        others = [self._marked(t) for t, e in zip(texts, easy, strict=True) if not e]
        if others:
            distinct = list(dict.fromkeys(chain.from_iterable(others)))
            place = dict(zip(distinct, self._numbers(distinct).tolist(), strict=True))
            numbers = np.array([place[w] for words in others for w in words], dtype=np.int64)
            found.append(self._ids(numbers, np.array([len(words) for words in others])))
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(found) == 1:
            return found[0]
        # Back into the order of the texts.
        ids = np.concatenate([x[0] for x in found])
        counts = np.concatenate([x[1] for x in found])
        order = np.argsort(np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy)]))
        begins = (np.cumsum(counts) - counts)[order]
        return ids[_gather(begins, counts[order])], counts[order]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of id lists: marks become spaces, the first one goes, bytes are joined."""
        table = self.table
        texts, wide, out, at = table.texts, table.wide[ids], [], 0
        any_wide = np.concatenate([[0], np.cumsum(wide)])
        values = ids.tolist()
        for n in counts.tolist():
            row = values[at : at + n]
            if any_wide[at + n] == any_wide[at]:
                text = "".join(map(texts.__getitem__, row))
            else:  # bytes of longer characters stand together
                parts, raw = [], bytearray()
                for i in row:
                    if i in table.byte_of:
                        raw.append(table.byte_of[i])
                        continue
                    parts += (raw.decode("utf-8", "replace"), texts[i])
                    raw = bytearray()
                text = "".join(parts) + raw.decode("utf-8", "replace")
            at += n
            out.append(text.removeprefix(SPACE).replace(SPACE, " "))
        return out


def encode_documents(docs: DataFrame, model: str, *, remember: int = 600_000) -> DataFrame:
    """(doc_id, token_ids, n_tokens, decoded_chars, round_trip) for every row of ``docs``.

    ``model`` is the path of a SentencePiece BPE model with byte fallback. Ids are those of
    the library's plain ``encode``. A task remembers up to ``remember`` words, about 300 bytes
    each; fewer cost time where words keep coming back. ``round_trip`` says whether decoding the ids gives the
    text again, which only a text with the space mark U+2581 itself does not; decoded_chars
    is the length of the decoded text. A null text counts as empty and has no ids. Rows are
    kept as they come, repeated rows and null ids too; other columns are ignored.
    """
    with open(model, "rb") as file:
        proto = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches):
        encoder = Encoder(proto.value, remember)
        for batch in batches:
            for part in text_slices(batch, limit=2 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, counts = encoder.encode(texts)
                again = encoder.decode(ids, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        lists(ids, counts, pa.int32()),
                        pa.array(counts, pa.int64()),
                        pa.array([len(t) for t in again], pa.int64()),
                        pa.array([a == b for a, b in zip(texts, again, strict=True)], pa.bool_()),
                    ],
                    names=["doc_id", "token_ids", "n_tokens", "decoded_chars", "round_trip"],
                )

    schema = (
        "doc_id long, token_ids array<int>, n_tokens long, decoded_chars long, round_trip boolean"
    )
    return map_batches(docs.selectExpr("cast(doc_id as long) as doc_id", "text"), run, schema)
