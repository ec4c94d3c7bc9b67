"""Token files and BPE against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from notemill.llm import bpe, rans
from tests.llm.brute import ODD, generated, odd_documents

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "\n", "  a  b   c\n d\t\te \n\n f\r\n", "<|endoftext|>x<|endoftext|> y<|startoftext|>", "a" * 70, "it's we'll 'S I'VE", "日本語 é é \x85 \xa0y\x1c z\x1d",
    "123456 ½ ² ٣", "x" * 3000, "ab" * 900, "😀😀 😀", "    code(x, y=1);\n        z\n", "ΑΣ ΟΔΟΣ İ ǅ ﬁ ŉ", " ̈a ̈ b",
]


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_spec(BYTES))


def test_bpe_equals_library(coder):
    library = Tokenizer.from_file(BYTES)
    for text in TEXTS + [t for _, t, _, _ in generated(60, 5)]:
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == want, text[:60]
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_bpe_of_random_letters(coder):
    library, r = Tokenizer.from_file(BYTES), np.random.default_rng(3)
    for _ in range(300):
        text = "".join(r.choice(list(" \n\tabcdeéß'.,12thingan"), 60))
        assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_bpe_of_broken_bytes(coder):
    ids = [coder.ids[coder.letters[0xC3]], coder.ids["a"]]
    assert coder.decode(ids) == Tokenizer.from_file(BYTES).decode(ids) == "�a"


def test_bpe_table_cases(spark):
    library = Tokenizer.from_file(BYTES)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _, _ in ODD), key=repr)
    docs = odd_documents(spark)
    coded = bpe.encode(docs, BYTES)
    assert sorted(((r.doc_id, r.ids) for r in coded.collect()), key=repr) == [(i, x) for i, x, _ in want]
    assert sorted(((r.doc_id, r.text) for r in bpe.decode(coded, BYTES).collect()), key=repr) == sorted(((i, t) for i, _, t in want), key=repr)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert sorted((tuple(r) for r in bpe.digests(docs, BYTES).collect()), key=repr) == sorted(
        ((i, len(x), digest(",".join(map(str, x))), digest(t)) for i, x, t in want), key=repr
    )
    assert bpe.digests(docs.limit(0), BYTES).collect() == []


@pytest.mark.parametrize("size", [0, 1, 2, 63, 1000, 200_000])
def test_block_round_trip(size):
    ids = np.minimum(np.random.default_rng(size).zipf(1.3, size), 49_000).astype(np.uint32)
    counts = dict(zip(*[x.tolist() for x in np.unique(ids, return_counts=True)], strict=True))
    table = rans.Table(rans.frequencies(counts))
    block = rans.encode_block(ids, table) | {"tokens": size}
    assert (rans.decode_block(block, table) == ids).all()
    segments = len(block["sums"]) // 4
    if segments > 1:  # a segment decodes alone, from its checkpoint
        step = rans.STEPS * block["lanes"]
        assert (rans.decode_segment(block, 1, table) == ids[step:2 * step]).all()
    if size > 1000:
        broken = bytearray(block["stream"])
        broken[len(broken) // 2] ^= 1
        with pytest.raises(ValueError, match="checksum"):
            rans.decode_block(block | {"stream": bytes(broken)}, table)


def test_frequencies_keep_every_id():
    freq = rans.frequencies({i: 1 for i in range(0, 40_000, 3)} | {7: 10 ** 12})
    assert freq.sum() == rans.SCALE and (freq[list(range(0, 40_000, 3))] >= 1).all()
    assert rans.frequencies({}).sum() == rans.frequencies({5: 9}).sum() == rans.SCALE


def test_parts_encode_as_the_whole():
    spec = bpe.read_spec(WORDS)
    library = Tokenizer.from_file(WORDS)
    for text in TEXTS:
        assert np.frombuffer(rans.token_bytes(text, spec), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_marks_after_letters_with_combining_marks():
    """Letters that the normaliser ends in a combining mark, which takes the mark after it into its word."""
    spec = bpe.read_spec(WORDS)
    library = Tokenizer.from_file(WORDS)
    for text in ["BELEDİYESİ,", "হয়,", "BELEDİYESİ, হয়. x, İ. é, é."] + [f"a{chr(c)}, {chr(c)}." for c in range(0x10000) if chr(c).isalpha()]:
        assert np.frombuffer(rans.token_bytes(text, spec), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_texts_of_a_batch_encode_as_each_alone(monkeypatch):
    library = Tokenizer.from_file(WORDS)
    spec, end = open(WORDS, encoding="utf-8").read(), b"\x02\x00"
    texts = [None, *TEXTS, "Word WORD word, word!!! word?! word's word'!! İz İz, e\u0301a H\u0331a ſs K's <|endoftext|> (a) a1, ٣a. ǅa.. Σ, ΟΣ!", *[t for _, t, _, _ in generated(60, 9)]]
    want = [b"".join([np.array(library.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes(), end]) for t in texts]
    calls, encode = [], type(rans._library(spec)).encode_batch_fast
    counted = type("Counted", (), {"__getattr__": lambda self, name: getattr(rans_library, name), "encode_batch_fast": lambda self, parts, **kw: calls.extend(parts) or encode(rans_library, parts, **kw)})
    rans_library, library_of = rans._library(spec), counted()
    monkeypatch.setattr(rans, "_library", lambda _: library_of)
    for size in (7, 20_000):
        monkeypatch.setattr(rans, "WORDS_AT_ONCE", size)
        assert rans.text_bytes(pa.array(texts), spec, "<u2", end).to_pylist() == want
    calls.clear()
    words = [f"{a}{b}{mark}" for a in "abcdeABCDE" for b in "fghijFGHIJ" for mark in ("", ".", "!!", "...")]
    rans.text_bytes(pa.array([" ".join(words)] * 50), spec, "<u2", end)
    assert sum(len(c.split(" ")) for c in calls) < 40  # 25 words and their marks, each once
    assert [len(g) for g in rans._groups(pa.array(["a" * (rans.GROUP_BYTES + 1), None, "b", "c"]))] == [1, 3]


def test_token_file_cases(spark, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_TOKENS", 50)
    library = Tokenizer.from_file(WORDS)
    rows = sorted(((-1 if i is None else i, library.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _, _ in ODD), key=lambda r: (r[0], np.array(r[1], "<u4").tobytes()))
    want, start = [], 0
    for i, ids in rows:
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [(-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rans.stored_tokens(odd_documents(spark), WORDS).collect()]
    assert sorted(got) == sorted(want)
    assert rans.stored_tokens(odd_documents(spark).limit(0), WORDS).collect() == []
