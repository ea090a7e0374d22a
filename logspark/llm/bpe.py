"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The tree's leaves hold the merge rank of each adjacent pair of symbols; each inner node holds the smaller of its
children, so the root gives the lowest rank, and going down to the left where both are equal finds the leftmost pair.
A merge changes three leaves (its own and its two neighbours), each with a logarithmic update, until no pair can merge:
O(n log n) for a word of n symbols however long it is.

Edge cases: a null or empty text has no tokens and decodes to "". Equal texts give equal rows; nothing depends on the
other rows of the table, so empty tables, repeated rows and ties need no rule. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from struct import pack, unpack

import regex
from pyspark.sql import DataFrame

from logspark.llm.common import hold, id_text, map_rows

NONE = 1 << 40
#: Most words, and most pre-tokens, in a generation of what a Python worker remembers; it holds two generations.
CACHE = 250_000
SPACES = "\t\n\x0b\x0c\r\x85\xa0                　"


class MergeTree:
    """Segment tree of minima over pair ranks."""

    def __init__(self, ranks: list[int]):
        self.n = 1 << max(0, len(ranks) - 1).bit_length()
        self.low = low = [NONE] * self.n + ranks + [NONE] * (self.n - len(ranks))
        for i in range(self.n - 1, 0, -1):
            a, b = low[2 * i], low[2 * i + 1]
            low[i] = a if a <= b else b

    def set(self, i: int, rank: int) -> None:
        low = self.low
        i += self.n
        low[i] = rank
        while i > 1:
            i >>= 1
            a, b = low[2 * i], low[2 * i + 1]
            best = a if a <= b else b
            if low[i] == best:
                return
            low[i] = best

    def first(self) -> int:
        """Leaf of the leftmost lowest rank."""
        low, i = self.low, 1
        while i < self.n:
            i = 2 * i if low[2 * i] == low[i] else 2 * i + 1
        return i - self.n


class Memory:
    """A bounded memory: entries that were used in the last generation live on in the next one."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        """From the older generation only; callers look in new first."""
        if (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old = self.new.copy()
            self.new.clear()  # callers hold on to this dict's get
        self.new[key] = value


class Bpe:
    """A byte-level BPE vocabulary with word ends, read from a tokenizer JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in enumerate(pairs)}.get
        self.made = [self.vocab[a + b] for a, b in pairs]
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = iter(range(0x100, 0x200))
        self.byte_char = {b: chr(b) if b in printable else chr(next(other)) for b in range(256)}
        self.words, self.memory = Memory(CACHE), Memory(CACHE)

    def merge(self, ids: list[int]) -> list[int]:
        """Merges symbols until no pair has a rank."""
        n = len(ids)
        if n < 2:
            return ids
        rank, made = self.rank, self.made
        tree = MergeTree([rank(p, NONE) for p in zip(ids, ids[1:])])
        low, put, first = tree.low, tree.set, tree.first
        if low[1] == NONE:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (best := low[1]) != NONE:
            i = first()
            j = after[i]
            ids[i] = new = made[best]
            ids[j] = -1
            after[i] = k = after[j]
            if j < n - 1:
                put(j, NONE)
            if k < n:
                before[k] = i
                put(i, rank((new, ids[k]), NONE))
            else:
                put(i, NONE)
            if (h := before[i]) >= 0:
                put(h, rank((ids[h], new), NONE))
        return [x for x in ids if x >= 0]

    def piece(self, piece: str) -> list[int]:
        """Ids of one pre-token."""
        if (found := self.memory.new.get(piece) or self.memory.get(piece)) is None:
            chars = [self.byte_char[b] for b in piece.encode()]
            chars[-1] += self.end
            found = self.merge([self.vocab[c] for c in chars])
            self.memory.put(piece, found)
        return found

    def word(self, word: str) -> tuple[int, bytes, str]:
        """Of a word without white space: number of ids, ids as little-endian 32-bit integers, decoded text."""
        if (found := self.words.get(word)) is not None:
            return found
        ids: list[int] = []
        for part in self.specials.split(word) if "<|" in word else (word,):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                # lower-casing goes by single characters: a final capital sigma has no form of its own
                part = part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                if part.isalpha():  # letters only are one pre-token
                    ids += self.piece(part)
                elif part[:-1].isalpha():
                    ids += self.piece(part[:-1])
                    ids += self.piece(part[-1])
                else:
                    for p in self.pieces.findall(part):
                        ids += self.piece(p)
        found = len(ids), pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(word) <= 256:
            self.words.put(word, found)
        return found

    def split(self, text: str) -> list[tuple[int, bytes, str]]:
        for c in SPACES:
            if c in text:
                text = text.replace(c, " ")
        get, make = self.words.new.get, self.word
        return [get(w) or make(w) for w in text.split(" ") if w]

    def encode(self, text: str) -> list[int]:
        return [i for n, b, _ in self.split(text) for i in unpack(f"<{n}I", b)]

    def decode(self, ids: list[int]) -> str:
        """The tokens' strings with blanks between them: the vocabulary file names no decoder."""
        return " ".join([self.token[i] for i in ids])


def load(path: str) -> Bpe:
    """The vocabulary, with what it remembers, of a Python worker."""
    return hold(("bpe", path), lambda: Bpe(path))


def digest(doc_id, text: bytes, bpe: Bpe) -> tuple:
    words = bpe.split(text.decode("utf-8", "replace"))
    decoded = " ".join([w[2] for w in words])
    return doc_id, sum([w[0] for w in words]), hashlib.sha256(b"".join([w[1] for w in words])).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: doc_id, n_tokens, ids_sha256, decoded_sha256.

    path is the vocabulary file, which every executor must be able to open (it is part of an installed package).
    """
    return map_rows(id_text(df, id_col, text_col), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", digest, (("bpe", path), lambda: Bpe(path)))


def encode_ids(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids themselves."""
    return map_rows(id_text(df, id_col, text_col), "doc_id long, ids array<int>", lambda i, t, bpe: (i, bpe.encode(t.decode("utf-8", "replace"))), (("bpe", path), lambda: Bpe(path)))


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of token ids; null ids decode to ""."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    def run(batches):
        bpe = load(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
