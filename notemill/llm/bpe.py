"""Exact BPE encoding and decoding by a last token for every prefix.

For a given merge list, the encoding of each prefix of a word ends in exactly
one token. Walking over the word, all vocabulary tokens that end at a position
come from an automaton with suffix links; token ``t`` is the last one of the
prefix if it covers the prefix, or if it can stand next to the last token of
the prefix before it. Back-pointers from the end give the ids. No merge is ever
applied to the word itself, so the time is linear in its length.

Two tokens can stand side by side if, while their bytes merge each on their
own side, no merge across the border comes first (:meth:`Coder.fits`).
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from notemill.llm.common import map_batches, texts_of

#: The word pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = 1 << 60
START = 1 << 23  # stands before the first byte; above every token id
# What a worker keeps at most: encoded words (twice), and pairs of tokens. About 120 MB.
KEPT_WORDS = 150_000
KEPT_PAIRS = 400_000
LONG_WORD = 64      # words from this length on are not kept
WORDS_AT_ONCE = 20_000


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free letter from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Coder:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str) -> None:
        parsed = json.loads(spec)
        self.ids: dict[str, int] = parsed["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.letters = byte_letters()
        value = {letter: bytes([b]) for b, letter in enumerate(self.letters)}
        self.piece = {i: b"".join(value[c] for c in token) for token, i in self.ids.items() if i not in self.special.values()}
        self.piece |= {i: content.encode() for content, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        halves: dict[int, tuple[int, int, int]] = {}
        for at, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]):
            left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
            self.rank.setdefault((left, right), at)
            halves.setdefault(whole, (left, right, at))
        self.right_edge: dict[int, tuple[list[int], list[int]]] = {}
        self.left_edge: dict[int, tuple[list[int], list[int]]] = {}
        self.good: set[int] = set()  # pairs that fit, as left << 24 | right
        self.bad: set[int] = set()
        self.size: dict[int, int] = {}
        matcher = ahocorasick.Automaton()
        # Merges are listed so that both halves of a token come before it.
        for token, i in sorted(self.ids.items(), key=lambda x: halves.get(x[1], (0, 0, -1))[2]):
            if i not in halves:
                if len(token) > 1:
                    continue
                self.right_edge[i] = self.left_edge[i] = ([i], [-1, NEVER])
            else:
                left, right, at = halves[i]
                if left not in self.left_edge or right not in self.right_edge or self._first_crossing(left, right) != (left, right):
                    continue  # its own bytes never merge into it
                ends, when = self.right_edge[right]
                self.right_edge[i] = ([*ends, i], [*when[:-1], at, NEVER])
                ends, when = self.left_edge[left]
                self.left_edge[i] = ([*ends, i], [*when[:-1], at, NEVER])
            matcher.add_word(self.piece[i].decode("latin-1"), (i, len(token)))
            self.size[i] = len(token)
        matcher.make_automaton()
        self.matcher = matcher
        self.words = regex.compile(PATTERN)
        self.cut_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, tuple[bytes, int, bytes]] = {}
        self.older: dict[str, tuple[bytes, int, bytes]] = {}

    def _first_crossing(self, left: int, right: int) -> tuple[int, int] | None:
        """The first pair of tokens that merges across the border, or None.

        The token at either side of the border grows by merges of rising rank.
        A border pair merges once both stand, before either grows further; of
        equal ranks the merge further left comes first.
        """
        ends, grown = self.right_edge[left]
        starts, grows = self.left_edge[right]
        i = j = 0
        while True:
            pair = (ends[i], starts[j])
            at = self.rank.get(pair, NEVER)
            if at < grown[i + 1] and at <= grows[j + 1]:
                return pair
            if grown[i + 1] == NEVER and grows[j + 1] == NEVER:
                return None
            if grown[i + 1] <= grows[j + 1]:
                i += 1
            else:
                j += 1

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` in an encoding; any token can follow :data:`START`."""
        key = left << 24 | right
        if len(self.good) + len(self.bad) > KEPT_PAIRS:
            self.good.clear()
            self.bad.clear()
        fits = left == START or self._first_crossing(left, right) is None
        (self.good if fits else self.bad).add(key)
        return fits

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word of the pattern."""
        mapped = word.encode("utf-8", "replace").decode("latin-1")  # a letter for each byte
        last = [-1] * len(mapped)
        last.append(START)  # where index -1 looks: before the first byte
        good, bad = self.good, self.bad
        for end, (token, size) in self.matcher.iter(mapped):
            if last[end] < 0:
                key = last[end - size] << 24 | token
                if key in good or (key not in bad and self.fits(key >> 24, token)):
                    last[end] = token
        out, end = [], len(mapped) - 1
        while end >= 0:
            token = last[end]
            out.append(token)
            end -= self.size[token]
        out.reverse()
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.piece.__getitem__, ids)).decode("utf-8", "replace")

    def _coded_word(self, word: str) -> tuple[bytes, int, bytes]:
        """Decimal ids, their number and the decoded bytes of a word of the pattern."""
        ids = self.word_ids(word)
        return ",".join(map(str, ids)).encode(), len(ids), b"".join(map(self.piece.__getitem__, ids))

    def coded(self, text: str) -> list[tuple[bytes, int, bytes]]:
        """(decimal ids, number, decoded bytes) of the words of a text; special tokens are cut out first."""
        if self.cut_special and (found := list(self.cut_special.finditer(text))):
            out, at = [], 0
            for m in found:
                token = self.special[m.group()]
                out += [*self.coded_plain(text[at:m.start()]), (b"%d" % token, 1, self.piece[token])]
                at = m.end()
            return out + self.coded_plain(text[at:])
        return self.coded_plain(text)

    def coded_plain(self, text: str) -> list[tuple[bytes, int, bytes]]:
        out, words = [], self.words.findall(text)
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at:at + WORDS_AT_ONCE]
            if len(self.known) >= KEPT_WORDS:  # what is still in use moves on from the older half
                self.known, self.older = {}, self.known
            known, older, long = self.known, self.older, []
            for word in set(some).difference(known):
                known[word] = older.get(word) or self._coded_word(word)
                if len(word) >= LONG_WORD:
                    long.append(word)
            out += map(known.__getitem__, some)
            for word in long:
                del known[word]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for ids, _, _ in self.coded(text) for i in ids.split(b",")]


@lru_cache(maxsize=2)
def coder(spec: str) -> Coder:
    return Coder(spec)


def read_spec(path: str) -> str:
    """The tokenizer file as text. It goes to the executors with the function (a file of a few MB, bounded by its vocabulary)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every row, as the tokenizer file at ``path`` encodes it.

    NULL texts count as empty and have no ids; NULL ids stay NULL, repeated
    rows are encoded each, special tokens in a text become their id, and a text
    of any length is encoded whole. An empty table gives an empty table.
    """
    spec = read_spec(path)
    ints = pa.list_(pa.int32())

    def run(batch: pa.RecordBatch) -> dict:
        own = coder(spec)
        return {
            "doc_id": batch.column(0), "ids": pa.array([own.encode(t) for t in texts_of(batch, text_col)], ints),
        }

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias(text_col))
    return map_batches(source, run, "doc_id bigint, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids). NULL ids give an empty text; bytes that are no UTF-8 decode to U+FFFD."""
    spec = read_spec(path)

    def run(batch: pa.RecordBatch) -> dict:
        own = coder(spec)
        return {"doc_id": batch.column(0), "text": [own.decode(i or []) for i in batch.column(1).to_pylist()]}

    return map_batches(coded.select("doc_id", "ids"), run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the decimal ids joined by commas, SHA-256 of the decoded text.

    The same rules as :func:`encode`; ids and decoded text are not kept.
    """
    spec = read_spec(path)

    def run(batch: pa.RecordBatch) -> dict:
        own = coder(spec)
        counts, ids_hash, text_hash = [], [], []
        for text in texts_of(batch, text_col):
            ids, sizes, pieces = zip(*own.coded(text), strict=True) if text else ((), (), ())
            counts.append(sum(sizes))
            ids_hash.append(hashlib.sha256(b",".join(ids)).hexdigest())
            whole = b"".join(pieces).decode("utf-8", "replace")
            text_hash.append(hashlib.sha256(whole.encode()).hexdigest())
        return {
            "doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": ids_hash,
            "decoded_sha256": text_hash,
        }

    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias(text_col))
    return map_batches(source, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows=1024)
