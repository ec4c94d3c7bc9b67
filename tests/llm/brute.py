"""Plain forms of the operators, to compare with, and awkward tables."""

import hashlib
import random
import re

import numpy as np
import xxhash

#: Two rows of one id, NULL ids, NULL and empty texts, ties, repeated rows.
ODD = [
    (1, "alpha beta gamma delta epsilon", "en", "a"), (2, "alpha beta gamma delta epsilon", "en", "a"), (2, "alpha beta gamma delta epsilon", "en", "a"),
    (3, None, None, None), (4, "", "en", "b"), (5, "   \n\t ", "fr", "b"), (6, "12 34 !!", None, "c"), (None, "alpha beta", "en", None),
    (None, None, None, None), (7, "é ü 漢字 😀 \x00 \x85", "de", "c"), (8, "One Two three", "de", "zz"), (9, "w " * 3000, "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that an operator might use itself.
CLASHES = (
    "_id", "_text", "_hash", "key", "size", "lot", "start", "stop", "n", "a", "b", "name", "more", "score", "target", "place", "component_id", "fp",
    "node", "root", "n_tokens", "ids", "toxic", "unit", "gram", "rank", "term", "low", "copies", "_kept_id", "_cut_id", "_mix_id", "part", "block",
)


def odd_documents(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES})


def generated(count: int, seed: int) -> list[tuple]:
    """Documents with shared passages, copies and near copies."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeghilmnoprst") for _ in range(r.randint(2, 8))) for _ in range(400)]
    passages = [" ".join(r.choices(words, k=r.randint(14, 60))) for _ in range(12)]
    rows = []
    for i in range(count):
        if i and r.random() < 0.15:
            text = r.choice(rows)[1]
            if r.random() < 0.6 and text:
                text = text.replace(text.split()[0], r.choice(words), 1)
        else:
            text = " ".join(r.choice(passages)[r.randint(0, 20):] if r.random() < 0.3 else " ".join(r.choices(words, k=r.randint(1, 40))) for _ in range(r.randint(1, 4)))
        rows.append((i, text, r.choice(["en", "fr"]), r.choice(["a", "a", "a", "b", "c", None])))
    return rows


def repeats(rows):
    """doc_id -> (bytes, removed, runs, hash of the rest)."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            own = data[at:at + 100]
            if own in seen:
                gone[at:at + 100] = True
            else:
                seen.add(own)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[doc_id] = (len(data), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def fingerprint(text, words=4):
    lowered = re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
    tokens = [t for t in re.split(rb"[\x20\x09-\x0d]+", lowered) if t]
    if not tokens:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i:i + words]), 42) for i in range(max(1, len(tokens) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, linked):
    """Smallest id reachable from each, ``linked`` a boolean matrix."""
    low = np.array(ids)
    while True:
        after = np.where(linked | np.eye(len(low), dtype=bool), low[None, :], low.max()).min(axis=1)
        if (after == low).all():
            return low.tolist()
        low = after
