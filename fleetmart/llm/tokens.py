"""Token counts of a byte-level BPE tokenizer, exact at every prefix of a text."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from fleetmart.llm.bpe import Pairs
from fleetmart.llm.common import map_batches, text_slices

# The pattern that byte-level BPE tokenizers of this kind split texts with (fixed value).
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_names() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files, by the published rule:
    printable Latin-1 stands for itself, the other bytes count up from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


_HEAD = 6


class _Counts(dict):
    """Chunk after a space to its number of tokens; -1 for a chunk that white space joins to
    its neighbours. Filled on use, emptied when full."""

    def __init__(self, counter: PrefixCounter, most: int):
        super().__init__()
        self.counter, self.most = counter, most

    def __missing__(self, chunk: str) -> int:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return -1
        n = self.counter.count_words(" " + chunk)
        if len(self) >= self.most:
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = n
        return n


class PrefixCounter:
    """Counts tokens by dynamic programming over prefixes.

    Texts fall into chunks whose counts add up, and chunks into words; for each word the
    table holds the exact token count of every one of its prefixes, so a truncation or a
    budget is looked up. Chunks and words seen before are remembered, up to ``most`` each.
    """

    def __init__(self, tokenizer_json: str, most: int = 600_000):
        spec = json.loads(tokenizer_json)
        names = byte_names()
        as_bytes = lambda token: bytes(names[c] for c in token)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.vocab = {
            as_bytes(token): number
            for token, number in spec["model"]["vocab"].items()
            if token not in self.special
        }
        merges = {}
        for place, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges[as_bytes(a), as_bytes(b)] = place
        pieces = [b""] * (max(self.vocab.values()) + 1)
        for token, number in self.vocab.items():
            pieces[number] = token
        # Every ending of a token: its number, or -1 where it is no token itself.
        self.endings = dict.fromkeys((t[k:] for t in self.vocab for k in range(len(t))), -1)
        self.endings |= self.vocab
        self.pairs = Pairs(
            pieces, lambda text: [text[k : k + 1] for k in range(len(text))],
            lambda a, b: merges.get((a, b), float("inf")),
        )
        self.words = regex.compile(PATTERN)
        self.splitter = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special else None
        )
        self.most = most
        self.chunks = _Counts(self, most)
        self.known: dict[str, int] = {}
        self.heads: dict[bytes, tuple[list[int], list[int]]] = {}

    def _table(self, word: bytes) -> tuple[list[int], list[int]]:
        """For every prefix of a word: the last token of its encoding, and its tokens.

        A prefix ends in the one token that may follow the last token of the shorter prefix
        before it. Words share the tables of their first bytes.
        """
        endings, pairs, done = self.endings, self.pairs, 0
        if len(word) > _HEAD:
            head = word[:_HEAD]
            if head not in self.heads:
                if len(self.heads) >= self.most:
                    self.heads.clear()
                self.heads[head] = self._table(head)
            (last, counts), done = self.heads[head], _HEAD
            last, counts = last[:], counts[:]
        else:
            last, counts = [0], [0]
        for end in range(done + 1, len(word) + 1):
            begin, fits = end - 1, []
            token = endings.get(word[begin:end])
            while token is not None:
                if token >= 0:
                    fits.append((begin, token))
                if begin == 0:
                    break
                begin -= 1
                token = endings.get(word[begin:end])
            for begin, token in reversed(fits):  # the longest mostly is the one
                if begin == 0 or pairs[last[begin] << 20 | token]:
                    break
            last.append(token)
            counts.append(counts[begin] + 1)
        return last, counts

    def prefix_counts(self, word: bytes) -> list[int]:
        """Tokens of word[:i] for every i, for a word that the pattern leaves whole."""
        return self._table(word)[1]

    def count_words(self, text: str) -> int:
        """Tokens of a text without special tokens, word by word."""
        known, total = self.known, 0
        for word in self.words.findall(text):
            n = known.get(word)
            if n is None:
                raw = word.encode("utf-8")
                n = 1 if self.endings.get(raw, -1) >= 0 else self.prefix_counts(raw)[-1]
                if len(known) >= self.most:
                    known.clear()
                if len(word) <= 64:
                    known[word] = n
            total += n
        return total

    def _pieces(self, text: str):
        """Each special token's string, and the texts between them, in order."""
        if self.splitter is None or not any(s in text for s in self.special):
            yield text, False
            return
        for k, part in enumerate(self.splitter.split(text)):
            yield part, k % 2 == 1

    def count(self, text: str) -> int:
        """Tokens of the whole text; a special token's string is that one token."""
        return sum(
            1 if special else self.count_words(part) for part, special in self._pieces(text)
        )

    def within(self, text: str, limit: int) -> int:
        """Characters of a longest prefix, in whole words and then characters, that has at
        most ``limit`` tokens when it is encoded on its own."""
        at, left = 0, limit
        for part, special in self._pieces(text):
            for word in [part] if special else self.words.findall(part):
                n = 1 if special else self.count_words(word)
                if n > left:
                    return self._settled(text, at + (0 if special else self._fits(word, left)), limit)
                at, left = at + len(word), left - n
        return len(text)

    def _settled(self, text: str, cut: int, limit: int) -> int:
        """``cut``, or less where the prefix on its own is read otherwise than in the text:
        after white space, and inside a contraction."""
        while cut and self.count(text[:cut]) > limit:
            cut -= 1
        return cut

    def count_batch(self, texts: list[str], limit: int) -> tuple[list[int], list[int]]:
        """``count`` and, for texts beyond ``limit`` tokens, ``within`` (else their length).

        The pattern never joins what stands before and after a single space. So the texts'
        chunks between spaces meet in one dictionary, each distinct one is counted once, and
        sums over a text's chunks give its count and the chunk that the limit falls into.
        """
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        chunks, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        value = np.fromiter(map(self.chunks.__getitem__, chunks), np.int64, len(chunks))[place]
        chars = np.fromiter(map(len, chunks), np.int64, len(chunks))[place] + 1
        for k, begin in enumerate((ends - pc.list_value_length(split).to_numpy()).tolist()):
            head = chunks[place[begin]]
            value[begin] = -1 if head and head[-1].isspace() else self.count_words(head)
        odd = np.concatenate([[0], np.cumsum(value < 0)])
        sums = np.concatenate([[0], np.cumsum(value)])
        counts, fits, begin = [], [], 0
        for text, end in zip(texts, ends.tolist(), strict=True):
            if odd[end] > odd[begin] or any(s in text for s in self.special):
                n = self.count(text)
                fit = self.within(text, limit) if n > limit else len(text)
            else:
                n, fit = int(sums[end] - sums[begin]), len(text)
                if n > limit:
                    k = int(np.searchsorted(sums[begin : end + 1], sums[begin] + limit, "right")) - 1
                    chunk = chunks[place[begin + k]]
                    chunk = " " + chunk if k else chunk
                    at = int(chars[begin : begin + k].sum()) - (1 if k else 0)
                    inside = self._fits(chunk, limit - int(sums[begin + k] - sums[begin]))
                    fit = at + inside
                    if not inside or "'" in chunk or chunk[inside - 1].isspace():
                        fit = self._settled(text, fit, limit)
            counts.append(n)
            fits.append(fit)
            begin = end
        return counts, fits

    def _fits(self, chunk: str, budget: int) -> int:
        """Characters of ``chunk`` within ``budget`` tokens, from the stored prefix counts."""
        done = 0
        for word in self.words.findall(chunk):
            counts = self.prefix_counts(word.encode("utf-8"))
            if counts[-1] <= budget:
                budget, done = budget - counts[-1], done + len(word)
                continue
            place, best = 0, 0
            for k, c in enumerate(word):
                place += len(c.encode("utf-8"))
                if counts[place] <= budget:
                    best = k + 1
            return done + best
        return done


def count_tokens(
    docs: DataFrame, tokenizer: str, *, limit: int = 512, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars) for every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE tokenizer.json. Counts are those of the
    whole text without added tokens; a null text counts as empty, and gives 0. ``fit_chars``
    is how many characters fit ``limit`` tokens. Rows are kept as they come: repeated rows
    and null ids too; other columns are ignored; an empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())

    def run(batches):
        counter = PrefixCounter(spec.value)
        for batch in batches:
            for part in text_slices(batch, limit=2 << 20):
                texts = [t or "" for t in part.column("text").to_pylist()]
                n, fits = counter.count_batch(texts, limit)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([x > limit for x in n], pa.bool_()),
                        pa.array(fits, pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"],
                )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return map_batches(
        docs.selectExpr(f"cast(`{doc_id}` as long) as doc_id", f"`{text}` as text"), run, schema
    )
