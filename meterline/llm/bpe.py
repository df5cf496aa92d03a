"""BPE encoding and decoding with the vocabulary of a public tokenizer.

The encoder is the backtracking one. All vocabulary entries within a word are found by one
Aho-Corasick pass, which leaves the longest entry starting at each character. From the left, the
encoder takes the longest entry that may follow the one before; where none fits it tries the next
shorter prefix, and where none is left it takes the last entry back. Characters from which no
encoding can go on are remembered, so every state is visited once and the work is linear in the
word. Two entries may stand side by side exactly if merging their joined characters gives the two
again; that pair table is filled as pairs come up. A sequence whose neighbours are all compatible
is the one that merging gives, so the result is exact.

Before that the text is cut as the vocabulary's own settings say: special entries are taken out as
written, the rest is brought to NFC and lower case (character by character), and cut into
contractions, runs of letters, single digits and runs of other signs, each ending in the word-end
mark. Words met before come from a table of bounded size.

Decoding is a lookup: one byte string of all entries and a table of offsets, entries joined by a
space, as the vocabulary names no decoder.

Defined cases: null text is empty; an empty text has no tokens and decodes to the empty text.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import kept, map_rows, sha256_hex

#: Words whose encoding a worker remembers (in each of two generations), and pairs whose compatibility it remembers.
WORDS_KEPT = 1 << 17
PAIRS_KEPT = 1 << 20
#: Fixed by the vocabulary: how words are cut, and Unicode's white space.
SPACES = r"\t-\r \x85\xa0  -     　"
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{L}\p{N}" + SPACES + "]+"
#: Stands for the word-end mark within a word; no byte maps to it.
END = "￿"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(0x100 + len(letters) - len(printable))
    return [letters[b] for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.ids = {self._inner(k): v for k, v in model["vocab"].items()}
        # Entries that no merge makes are single letters; they count only as such.
        made = {a + b for a, b in self.rank}
        single = {k for k in self.ids if len(k) == 1 or (len(k) == 2 and k[1] == END)}
        self.words = {k for k in self.ids if k in single or self._outer(k) in made}
        self.finder = ahocorasick.Automaton()
        for k in self.words:
            self.finder.add_word(k, len(k))
        self.finder.make_automaton()
        self.shorter = {k: self._next_shorter(k) for k in self.words}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cut = regex.compile(CUT)
        self.letters = byte_letters()
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self._offsets(model["vocab"])

    def _inner(self, entry: str) -> str:
        return entry[: -len(self.suffix)] + END if entry.endswith(self.suffix) and entry != self.suffix else entry

    def _outer(self, entry: str) -> str:
        return entry[:-1] + self.suffix if entry.endswith(END) else entry

    def _next_shorter(self, entry: str) -> str | None:
        return next((entry[:n] for n in range(len(entry) - 1, 0, -1) if entry[:n] in self.words), None)

    def _offsets(self, vocab: dict[str, int]) -> None:
        names = dict(vocab) | self.special
        size = max(names.values(), default=-1) + 1
        by_id = [b""] * size
        for k, v in names.items():
            by_id[v] = k.encode()
        self.blob = b"".join(by_id)
        self.offset = np.concatenate([[0], np.cumsum([len(x) for x in by_id])]).tolist()

    # ---- words --------------------------------------------------------------------------

    def merged(self, symbols: list[str]) -> list[str]:
        """Plain merging, lowest rank and leftmost first: what makes pairs compatible."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(symbols, symbols[1:], strict=False)]
            best = min(ranks)
            if best == len(self.rank):
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def symbols(self, word: str) -> list[str]:
        """Single letters, the word end joined to the last."""
        if not word.endswith(END):
            return list(word)
        return [*word[:-2], word[-2] + self.suffix] if len(word) > 1 else [self.suffix]

    def compatible(self, left: str, right: str) -> bool:
        pair = (left, right)
        found = self.pairs.get(pair)
        if found is None:
            whole = self.merged(self.symbols(left + right))
            found = whole == [self._outer(left), self._outer(right)]
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            self.pairs[pair] = found
        return found

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Tokens of one word, given in byte letters without the end mark."""
        word += END
        size = len(word)
        longest: list[str | None] = [None] * size
        for end, length in self.finder.iter(word):
            start = end - length + 1  # ends come in order: the last entry of a start is its longest
            longest[start] = word[start : end + 1]
        stack: list[str] = []
        dead = [False] * (size + 1)
        at, entry = 0, longest[0]
        while at < size:
            while entry is not None:
                after = at + len(entry)
                if not dead[after] and (not stack or self.compatible(stack[-1], entry)):
                    break
                entry = self.shorter[entry]
            if entry is None:
                # Whether an encoding may pass here depends on the last entry only, and that of
                # a text's start is unique: nothing that ends here can be part of the result.
                dead[at] = True
                if not stack:
                    raise ValueError("the vocabulary lacks a letter")
                last = stack.pop()
                at -= len(last)
                entry = self.shorter[last]
            else:
                stack.append(entry)
                at = after
                entry = longest[at] if at < size else None
        return tuple(self.ids[x] for x in stack)

    # ---- texts --------------------------------------------------------------------------

    def lowered(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # Character by character: no other form of sigma at a word's end.
        return text.replace("Σ", "σ").lower()

    def _plain(self, text: str, out: list[int]) -> None:
        known = self.known
        for word in self.cut.findall(self.lowered(text)):
            tokens = known.get(word)
            if tokens is None:
                tokens = self.older.get(word)
            if tokens is None:
                letters = word if word.isascii() and word.isprintable() else "".join(self.letters[b] for b in word.encode())
                tokens = self.encode_word(letters)
                if len(known) >= WORDS_KEPT:
                    self.older, self.known = known, {}
                    known = self.known
                known[word] = tokens
            out += tokens

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        if not any(s in text for s in self.special):
            self._plain(text, out)
            return out
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                self._plain(part, out)
        return out

    def decode(self, ids: list[int]) -> str:
        blob, offset = self.blob, self.offset
        return b" ".join([blob[offset[i] : offset[i + 1]] for i in ids]).decode()


def vocabulary(path: str) -> Bpe:
    return kept(__name__, path, lambda: Bpe(path))


def public_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encode_step(path: str | None):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        bpe = vocabulary(path or public_path())
        for doc_id, text in rows:
            ids = bpe.encode(text)
            yield doc_id, ids

    return step


def _digest_step(path: str | None):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        bpe = vocabulary(path or public_path())
        for doc_id, text in rows:
            ids = bpe.encode(text)
            data = np.array(ids, dtype="<u4").tobytes()
            yield doc_id, len(ids), sha256_hex(data), sha256_hex(bpe.decode(ids).encode())

    return step


def _decode_step(path: str | None):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        bpe = vocabulary(path or public_path())
        for doc_id, ids in rows:
            yield doc_id, bpe.decode(ids or [])

    return step


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def encode(docs: DataFrame, path: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, ids`` of every row."""
    return map_rows(_texts(docs, id_col, text_col), _encode_step(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``."""
    return map_rows(encoded.select("doc_id", "ids"), _decode_step(path), "doc_id long, text string")


def encode_digests(docs: DataFrame, path: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """Token count and digests of tokens and decoded text; the tokens themselves stay in the task."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(_texts(docs, id_col, text_col), _digest_step(path), schema)
