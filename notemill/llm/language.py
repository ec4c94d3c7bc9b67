"""Language identification by n-gram filters that answer with a bitmask of languages.

Character 4-grams of each language go into Bloom filters that share their hash
functions, kept bit-sliced: one row of bits per slot, one bit per language. The
AND of the rows an n-gram hashes to is the set of all languages that hold it,
in one look-up for any number of languages. A text is decided by popcounts: in
how many of its n-grams each language's bit is set, less what a filter of that
fill would claim by chance.

N-grams lie inside words or at their ends: the middle two characters are
letters, the outer ones letters or a border. A language's filter holds those
n-grams that make up at least ``MIN_SHARE`` of all its n-grams, so it never has
more than ``1 / MIN_SHARE`` of them, however large the corpus. Counts cover all
training texts in whole and are summed up in each task before they move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.common import texts_of
from notemill.session import saved

MIN_SHARE = 2e-5      # at most 50,000 n-grams per language
PROBES = 3
BITS_PER_GRAM = 16
GROUP = 1 << 19       # characters worked on at a time
FLUSH = 1 << 22       # n-grams a task holds before it sums them up
UNDECIDED = "und"

_ODD = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number) of every n-gram of the texts, and which texts have letters."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[codes]
    sizes = np.array([len(t) + 1 for t in lowered])
    owner = np.repeat(np.arange(len(texts)), sizes)
    has = np.zeros(len(texts), bool)
    has[owner[letter]] = True
    code = np.where(letter, codes, 0).astype(np.uint64)
    code = np.concatenate(([np.uint64(0)], code, [np.uint64(0)]))
    inner = np.flatnonzero(letter[:-1] & letter[1:]) if len(letter) > 1 else np.empty(0, np.int64)
    own = code[inner] * _ODD[0] + code[inner + 1] * _ODD[1] + code[inner + 2] * _ODD[2] + code[inner + 3] * _ODD[3]
    own ^= own >> np.uint64(29)
    own *= _ODD[0]
    own ^= own >> np.uint64(32)
    return own, owner[inner], has


def _grouped(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``GROUP`` characters."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= GROUP:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


@dataclass
class Filters:
    """Bit-sliced Bloom filters: ``rows[word][slot]`` holds the bits of 64 languages."""

    languages: list[str] = field(default_factory=list)
    rows: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.uint64))
    chance: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def of(cls, held: dict[str, np.ndarray]) -> Filters:
        """Filters of the n-gram hashes of each language."""
        languages = sorted(held)
        most = max([len(g) for g in held.values()], default=0)
        slots = 1 << max(10, int(most * BITS_PER_GRAM - 1).bit_length())
        rows = np.zeros((max(1, -(-len(languages) // 64)), slots), np.uint64)
        fill = np.zeros(len(languages))
        for k, language in enumerate(languages):
            bit = np.uint64(1 << (k % 64))
            for at in _slots(held[language], slots):
                np.bitwise_or.at(rows[k // 64], at, bit)
            fill[k] = np.count_nonzero(rows[k // 64] & bit) / slots
        return cls(languages, rows, fill ** PROBES)

    def masks(self, own: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that hold it, 64 per row."""
        found = None
        for at in _slots(own, self.rows.shape[1]):
            got = self.rows[:, at]
            found = got if found is None else found & got
        return found

    def counts(self, own: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """(text, language): n-grams of the text in the language, corrected for false positives."""
        masks = self.masks(own)
        total = np.bincount(owner, minlength=texts)
        out = np.empty((texts, len(self.languages)))
        for k in range(len(self.languages)):
            hit = (masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)
            seen = np.bincount(owner[hit.astype(bool)], minlength=texts)
            out[:, k] = np.clip((seen - total * self.chance[k]) / max(1e-9, 1 - self.chance[k]), 0, None)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language of each text and the share of its n-grams that language holds."""
        names, scores = [], []
        for low, high in _grouped(texts):
            own, owner, has = grams(texts[low:high])
            if not self.languages:
                names += [UNDECIDED] * (high - low)
                scores += [0.0] * (high - low)
                continue
            counts = self.counts(own, owner, high - low)
            total = np.bincount(owner, minlength=high - low)
            # Ties go to the first language in order; a text of single letters has no n-grams and gets that one too.
            best = counts.argmax(axis=1)
            share = counts[np.arange(len(best)), best] / np.maximum(total, 1)
            names += [self.languages[b] if h else UNDECIDED for b, h in zip(best.tolist(), has.tolist(), strict=True)]
            scores += np.where(has, np.clip(share, 0, 1), 0.0).tolist()
        return names, scores


def _slots(own: np.ndarray, slots: int) -> Iterator[np.ndarray]:
    """The slots of each n-gram, one array per hash function (double hashing)."""
    step = (own >> np.uint64(32)) | np.uint64(1)
    for k in range(PROBES):
        yield ((own + step * np.uint64(k)) & np.uint64(slots - 1)).astype(np.int64)


def gram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``train`` (text, lang); tasks sum up their own first."""

    def summed(held: list[tuple[np.ndarray, np.ndarray]], names: list[str]) -> pa.RecordBatch:
        gram, lang = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((gram, lang))
        gram, lang = gram[order], lang[order]
        new = np.flatnonzero(np.concatenate(([True], (gram[1:] != gram[:-1]) | (lang[1:] != lang[:-1]))))
        n = np.diff(np.concatenate((new, [len(gram)])))
        return pa.RecordBatch.from_pydict({
            "lang": pa.array(names, pa.string()).take(pa.array(lang[new])), "gram": pa.array(gram[new].view(np.int64)), "n": pa.array(n.astype(np.int64)),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number, names = [], 0, {}, []
        for batch in batches:
            texts, langs = texts_of(batch, "text"), batch.column(1).to_pylist()
            for lang in set(langs).difference(number):
                number[lang] = len(names)
                names.append(lang)
            for low, high in _grouped(texts):
                own, owner, _ = grams(texts[low:high])
                held.append((own, np.array([number[x] for x in langs[low:high]])[owner]))
                size += len(own)
                if size >= FLUSH:
                    yield summed(held, names)
                    held, size = [], 0
        if size:
            yield summed(held, names)

    counted = train.select("text", "lang").mapInArrow(run, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, usable: Column, min_share: float = MIN_SHARE) -> Filters:
    """Filters learned from (text, lang) of the ``usable`` rows with a language.

    The driver gets the n-grams of at least ``min_share`` of a language's: at
    most ``1 / min_share`` per language. Without such rows there are no filters.
    """
    train = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = gram_counts(train).filter(F.col("n") > 0)
    counted = saved(counted, "language-grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counted.join(totals, "lang").filter(F.col("n") >= F.col("total") * min_share)
    rows = kept.groupBy("lang").agg(F.collect_list("gram").alias("grams")).collect()
    return Filters.of({r["lang"]: np.array(r["grams"], np.int64).view(np.uint64) for r in rows})


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its text alone.

    NULL texts and texts without letters are ``und`` with score 0. Rows may
    repeat, ids may be NULL, an empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = filters.predict(texts_of(batch, "text"))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether ``crc32`` of the id as text leaves 1 when divided by 3; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
