"""Token ids in a binary file, coded by a static range asymmetric numeral system.

One frequency table, counted over all tokens, is shared by all blocks. A block
holds whole documents and is coded on its own, so any block can be read
without the others. Inside a block many lanes (interleaved states) advance
together: token ``i`` belongs to lane ``i mod lanes``, which makes coding and
decoding array operations. At every checkpoint the lane states and the place in
the stream are kept with a checksum of the ids up to the next one, so decoding
can start at any checkpoint and in parallel, and damage is found where it is.

The file is a folder of Parquet parts with one row per block (blobs and their
headers), which Spark writes and reads wherever the table lies.

Layout of a block's blobs (little-endian): ``doc_ids`` int64, ``doc_tokens``
uint32, ``states`` uint64 per checkpoint and lane, ``places`` uint32 (words of the
stream read before a checkpoint), ``sums`` uint32 (CRC-32 of the ids of its
segment as uint32), ``stream`` uint32.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notemill.llm.common import NULL_ID, map_batches, real_id, texts_of
from notemill.session import saved, scratch_path

LETTERS_AND_MARKS = r"\A(?P<letters>(?s:.*?))(?P<marks>[!-/:-@\[-`{-~]{0,8})\z"
SCALE_BITS = 20
SCALE = 1 << SCALE_BITS
LOW = 1 << 32            # states stay in [2**32, 2**64); 32 bits move at once
BLOCK_TOKENS = 1 << 20   # a block closes with the document that reaches this
MAX_LANES = 2048
STEPS = 256              # steps of all lanes between checkpoints
GROUP_BYTES = 1 << 24    # bytes of texts cut at a time
WORDS_AT_ONCE = 20_000   # words or parts that the library encodes at a time

FILE_SCHEMA = (
    "part int, block int, tokens bigint, lanes int, doc_ids binary, doc_tokens binary, states binary, places binary, "
    "sums binary, stream binary"
)


# -- tokens ----------------------------------------------------------------------


@lru_cache(maxsize=2)
def _library(spec: str):
    # Spark runs as many workers as there are cores; threads of the library would only wait for each other.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


def id_type(spec: str) -> str:
    """How ids are kept on the way to the file: as 16 bits where they fit."""
    return "<u2" if max(_library(spec).get_vocab().values()) < 1 << 16 else "<u4"


def token_bytes(text: str, spec: str, kind: str = "<u4") -> bytes:
    """Ids of a text as little-endian numbers."""
    return text_bytes(pa.array([text], pa.string()), spec, kind, b"")[0].as_py()


def text_bytes(texts: pa.Array, spec: str, kind: str, end: bytes) -> pa.Array:
    """Ids of each text as little-endian numbers, then ``end``; NULL counts as empty.

    The texts are cut at plain spaces and line breaks, each different part is encoded once
    and the ids are put together again, so that a part costs no Python object. That is exact for tokenizers whose words never reach
    across white space (see :func:`splits_at_spaces`).
    """
    cut = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
    parts = cut.flatten().dictionary_encode()
    coded = pa.concat_arrays([_coded_parts(parts.dictionary, spec, kind), pa.array([end], pa.binary())])
    ends = np.cumsum(cut.value_lengths().to_numpy())
    joined = coded.take(pa.array(np.insert(parts.indices.to_numpy(), ends, len(coded) - 1)))
    at = _offsets(joined)[np.concatenate(([0], ends + np.arange(1, len(ends) + 1)))]
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(at), joined.buffers()[2]])


def _offsets(blobs: pa.Array) -> np.ndarray:
    return np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset:blobs.offset + len(blobs) + 1]


def _groups(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about ``GROUP_BYTES``, or one larger text."""
    ends, at = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)), 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_BYTES, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def _coded_parts(parts: pa.Array, spec: str, kind: str) -> pa.Array:
    """Ids of each part. Marks after letters are words of their own, so letters and marks are encoded apart, each once."""
    library = _library(spec)
    split = pc.extract_regex(parts, LETTERS_AND_MARKS)
    letters, marks = split.field(0), split.field(1)
    plain = pc.utf8_is_alpha(letters).to_numpy(zero_copy_only=False).copy()
    letters = pc.if_else(pa.array(plain), letters, "")
    if _ignores_case(library):
        letters = pc.if_else(pc.string_is_ascii(letters), pc.ascii_lower(letters), letters)
    last = pc.utf8_slice_codeunits(letters, -1).dictionary_encode()
    letters, marks = letters.dictionary_encode(), marks.dictionary_encode()
    # Only pairs of a last letter and marks that the tokenizer itself parts.
    pair, of = np.unique(last.indices.to_numpy().astype(np.int64) * len(marks.dictionary) + marks.indices.to_numpy(), return_inverse=True)
    good = [_parted(library, last.dictionary[p // len(marks.dictionary)].as_py(), marks.dictionary[p % len(marks.dictionary)].as_py()) for p in pair.tolist()]
    plain &= np.array(good, bool)[of]
    words, found = _coded_words(letters.dictionary, library, kind)
    plain &= found[letters.indices.to_numpy()]
    rest = np.flatnonzero(~plain)
    ends = pc.take(_coded_each(marks.dictionary, library, kind), marks.indices)
    joined = pc.binary_join_element_wise(pc.take(words, letters.indices), ends, b"")
    if not len(rest):
        return joined
    others = _coded_each(parts.take(pa.array(rest)), library, kind)
    order = np.arange(len(parts))
    order[rest] = len(parts) + np.arange(len(rest))
    return pa.concat_arrays([joined, others]).take(pa.array(order))


def _coded_each(parts: pa.Array, library, kind: str) -> pa.Array:
    out = []
    for at in range(0, len(parts), WORDS_AT_ONCE):
        out += [np.array(c.ids, kind).tobytes() for c in library.encode_batch_fast(parts[at:at + WORDS_AT_ONCE].to_pylist(), add_special_tokens=False)]
    return pa.array(out, pa.binary())


def _coded_words(words: pa.Array, library, kind: str) -> tuple[pa.Array, np.ndarray]:
    """(ids, whether they are known) of words of letters, which are encoded as one text and cut after each word.

    A text that gives another number of words holds letters that the tokenizer takes for none; its words are not known.
    """
    ends, width = _word_ends(library), int(kind[-1])
    known, sizes, blobs = np.zeros(len(words), bool), np.zeros(len(words), np.int64), []
    use = np.flatnonzero(_whole(words, library)) if len(ends) else []
    for at in range(0, len(use), WORDS_AT_ONCE):
        some = use[at:at + WORDS_AT_ONCE]
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), words.take(pa.array(some))), " ").to_pylist()
        ids = np.array(library.encode_batch_fast(text, add_special_tokens=False)[0].ids, kind)
        cut = np.flatnonzero(ends[ids]) + 1
        if len(cut) == len(some):
            known[some], sizes[some] = True, np.diff(np.concatenate(([0], cut))) * width
            blobs.append(ids.tobytes())
    at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(at), pa.py_buffer(b"".join(blobs))]), known


@lru_cache(maxsize=1 << 16)
def _pieces(library, text: str) -> list[str]:
    normal = library.normalizer.normalize_str(text) if library.normalizer else text
    return [w for w, _ in library.pre_tokenizer.pre_tokenize_str(normal)] if library.pre_tokenizer else [normal]


def _whole(words: pa.Array, library) -> np.ndarray:
    """Whether each word is not empty and holds no letter that the tokenizer itself parts (U+0130 becomes i and a combining mark)."""
    letters = set(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")[0].as_py())
    odd = [c for c in sorted(letters) if len(_pieces(library, c)) != 1 or not all(map(str.isalpha, _normal(library, c)))]
    fine = pc.greater(pc.binary_length(words), 0)
    return (pc.and_(fine, pc.invert(pc.match_substring_regex(words, "[" + "".join(odd) + "]"))) if odd else fine).to_numpy(zero_copy_only=False)


def _normal(library, text: str) -> str:
    return library.normalizer.normalize_str(text) if library.normalizer else text


@lru_cache(maxsize=1 << 16)
def _parted(library, letter: str, marks: str) -> bool:
    """Whether the tokenizer itself cuts ``marks`` off after ``letter``.

    Its normaliser may turn a letter into one with a combining mark (U+0130 into
    i and U+0307), which then makes a single word with the mark that follows.
    """
    if not marks:
        return True
    return _normal(library, letter)[-1:].isalpha() and _pieces(library, letter + marks) == _pieces(library, letter) + _pieces(library, marks)


@lru_cache(maxsize=2)
def _ignores_case(library) -> bool:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return _normal(library, upper) == _normal(library, lower) == lower


@lru_cache(maxsize=2)
def _word_ends(library) -> np.ndarray:
    """Which ids end a word, for vocabularies that mark it; else empty."""
    vocab = library.get_vocab()
    marked = [i for token, i in vocab.items() if token.endswith("</w>")]
    ends = np.zeros(max(vocab.values()) + 1 if marked else 0, bool)
    ends[marked] = True
    return ends


def splits_at_spaces(spec: str) -> bool:
    """Whether the tokenizer drops white space and cuts marks off words, so that both can be encoded alone."""
    library = _library(spec)
    plain = lambda text: library.encode(text, add_special_tokens=False).ids
    return plain("ab c. \n d") == plain("ab") + plain("c") + plain(".") + plain("d")


def tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(_id, ids binary, width) of every row, ``end_id`` after each document; NULL texts have only that. ``width`` is bytes per id."""
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    by_part, kind = splits_at_spaces(spec), id_type(spec) if end_id < 1 << 16 else "<u4"
    end = np.array([end_id], kind).tobytes()

    def run(batch: pa.RecordBatch) -> dict:
        whole = lambda text: np.array(_library(spec).encode(text, add_special_tokens=False).ids, kind).tobytes()
        if by_part:
            out = pa.concat_arrays([text_bytes(group, spec, kind, end) for group in _groups(batch.column("_text"))])
        else:
            out = pa.array([whole(t) + end for t in texts_of(batch, "_text")], pa.binary())
        return {"_id": batch.column(0), "ids": out, "width": pa.array(np.full(len(out), int(kind[-1]), np.int32))}

    source = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("_id"), F.col("text").alias("_text"))
    return map_batches(source, run, "_id bigint, ids binary, width int")


# -- frequency table ---------------------------------------------------------------


def counted(tokens: DataFrame) -> DataFrame:
    """(id, n) over all tokens; each task sums up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in (b for b in batches if b.num_rows):
            own = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), f"<u{batch.column(1)[0].as_py()}"))
            if len(own) > len(total):
                total = np.pad(total, (0, len(own) - len(total)))
            total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used.astype(np.int64)), "n": pa.array(total[used])})

    return tokens.select("ids", "width").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def frequencies(counts: dict[int, int]) -> np.ndarray:
    """Counts scaled to sum to ``SCALE``, at least 1 for every id that occurs; index is the id.

    A second symbol is always there, so no frequency is the whole scale.
    """
    size = max([*counts, 0]) + 2
    n = np.zeros(size, np.int64)
    n[list(counts)] = list(counts.values())
    if np.count_nonzero(n) < 2:
        n[np.flatnonzero(n == 0)[:2 - np.count_nonzero(n)]] = 1
    used = np.flatnonzero(n)
    if len(used) > SCALE // 2:
        raise ValueError(f"{len(used)} different ids do not fit a scale of {SCALE}")
    share = np.maximum(1, (n[used] * ((SCALE - len(used)) / n.sum())).astype(np.int64))
    share[np.argmax(share)] += SCALE - share.sum()
    out = np.zeros(size, np.uint32)
    out[used] = share
    return out


class Table:
    """Lookups of a frequency table: first slot of an id, and id of a slot."""

    def __init__(self, freq: np.ndarray) -> None:
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate(([0], np.cumsum(self.freq)[:-1])).astype(np.uint64)
        self.of_slot = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


@lru_cache(maxsize=2)
def _table(freq: bytes) -> Table:
    return Table(np.frombuffer(freq, "<u4"))


# -- blocks --------------------------------------------------------------------------


def encode_block(ids: np.ndarray, table: Table) -> dict:
    """Blobs of one block. Tokens are coded last to first, so that they decode first to last."""
    lanes = int(min(MAX_LANES, max(1, len(ids) // 64)))
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, states, at_word, written = [], [], [], 0
    for step in range(steps - 1, -1, -1):
        own = ids[step * lanes:(step + 1) * lanes]
        x, f = state[: len(own)], table.freq[own]
        full = (x >> np.uint64(64 - SCALE_BITS)) >= f
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")[::-1])
            written += len(words[-1])
            x = np.where(full, x >> np.uint64(32), x)
        whole = x // f
        state[: len(own)] = (whole << np.uint64(SCALE_BITS)) + (x - whole * f) + table.first[own]
        if step % STEPS == 0:
            states.append(state.copy())
            at_word.append(written)
    stream = np.concatenate(words)[::-1] if words else np.empty(0, "<u4")
    segment = lanes * STEPS
    return {
        "lanes": lanes, "states": b"".join(s.astype("<u8").tobytes() for s in reversed(states)),
        "places": (written - np.array(at_word[::-1], np.int64)).astype("<u4").tobytes(),
        "sums": np.array([zlib.crc32(ids[a:a + segment].astype("<u4").tobytes()) for a in range(0, len(ids), segment)], "<u4").tobytes(),
        "stream": stream.astype("<u4").tobytes(),
    }


def decode_segment(block: dict, index: int, table: Table) -> np.ndarray:
    """The ids between checkpoint ``index`` and the next, checked against their sum."""
    lanes, tokens = block["lanes"], block["tokens"]
    stream = np.frombuffer(block["stream"], "<u4")
    state = np.frombuffer(block["states"], "<u8")[index * lanes:(index + 1) * lanes].astype(np.uint64)
    place = int(np.frombuffer(block["places"], "<u4")[index])
    start, end = index * STEPS * lanes, min(tokens, (index + 1) * STEPS * lanes)
    out = np.empty(end - start, np.uint32)
    mask, shift = np.uint64(SCALE - 1), np.uint64(SCALE_BITS)
    for at in range(start, end, lanes):
        n = min(lanes, end - at)
        x = state[:n]
        slot = x & mask
        own = table.of_slot[slot]
        out[at - start:at - start + n] = own
        x = table.freq[own] * (x >> shift) + slot - table.first[own]
        empty = np.flatnonzero(x < np.uint64(LOW))
        if place + len(empty) > len(stream):
            raise ValueError(f"the stream ends before segment {index}, whose checksum can't be met")
        if len(empty):
            x[empty] = (x[empty] << np.uint64(32)) | stream[place:place + len(empty)]
            place += len(empty)
        state[:n] = x
    if zlib.crc32(out.astype("<u4").tobytes()) != int(np.frombuffer(block["sums"], "<u4")[index]):
        raise ValueError(f"checksum of segment {index} differs")
    return out


def decode_block(block: dict, table: Table) -> np.ndarray:
    """All ids of a block: its segments one after the other."""
    count = len(block["sums"]) // 4
    return np.concatenate([decode_segment(block, k, table) for k in range(count)]) if count else np.empty(0, np.uint32)


# -- files ---------------------------------------------------------------------------


def write_ids(tokens: DataFrame, path: str, freq: np.ndarray, partitions: int | None = None) -> None:
    """Write (_id, ids, width) in ascending order of ``_id`` (repeated ids by their tokens) as blocks below ``path``.

    Parts are ranges of ids, so their numbers and the block numbers inside give
    the order. A document longer than a block makes a block of its own size. The
    table of frequencies lies beside the blocks.
    """
    spark = tokens.sparkSession
    table = freq.astype("<u4").tobytes()
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, doc_ids, blobs, size, width = None, 0, [], [], 0, 4

        def close() -> pa.RecordBatch:
            nonlocal block, size
            out = encode_block(np.frombuffer(b"".join(blobs), f"<u{width}"), _table(table))
            row = {
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()), "tokens": pa.array([size // width], pa.int64()),
                "lanes": pa.array([out["lanes"]], pa.int32()), "doc_ids": [np.array(doc_ids, "<i8").tobytes()],
                "doc_tokens": [np.array([len(b) // width for b in blobs], "<u4").tobytes()],
            } | {k: [out[k]] for k in ("states", "places", "sums", "stream")}
            block, size = block + 1, 0
            doc_ids.clear()
            blobs.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in (b for b in batches if b.num_rows):
            width, own = batch.column(2)[0].as_py(), batch.column(3).to_pylist()
            for doc_id, ids, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), own, strict=True):
                part = number
                doc_ids.append(doc_id)
                blobs.append(ids)
                size += len(ids)
                if size >= width * BLOCK_TOKENS:
                    yield close()
        if blobs:
            yield close()

    ranged = (
        tokens.select("_id", "ids", "width").repartitionByRange(count, "_id").sortWithinPartitions("_id", "ids")
        .withColumn("part", F.spark_partition_id())
    )
    ranged.mapInArrow(run, FILE_SCHEMA).write.parquet(f"{path}/blocks")
    spark.createDataFrame([(bytearray(table),)], "freq binary").coalesce(1).write.parquet(f"{path}/table")


def read_documents(spark, path: str) -> DataFrame:
    """(_id, part, block, at, in_block, n_tokens, ids_crc32) of every stored document, from its decoded ids.

    ``in_block`` counts the tokens of the block before the document, ``at`` its
    documents. Every block is a row, so blocks decode in parallel.
    """
    freq = bytes(spark.read.schema("freq binary").parquet(f"{path}/table").first()[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids = decode_block(block, _table(freq)).astype("<u4")
                sizes = np.frombuffer(block["doc_tokens"], "<u4").astype(np.int64)
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                sums = [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "_id": pa.array(np.frombuffer(block["doc_ids"], "<i8")), "part": pa.array(np.full(len(sizes), block["part"], np.int32)),
                    "block": pa.array(np.full(len(sizes), block["block"], np.int32)), "at": pa.array(np.arange(len(sizes), dtype=np.int32)),
                    "in_block": pa.array(starts), "n_tokens": pa.array(sizes), "ids_crc32": pa.array(np.array(sums, np.int64)),
                })

    blocks = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/blocks")
    return blocks.mapInArrow(run, "_id bigint, part int, block int, at int, in_block bigint, n_tokens bigint, ids_crc32 bigint")


def block_starts(spark, path: str) -> DataFrame:
    """(part, block, block_start): tokens of the file before each block, from the headers alone."""
    heads = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/blocks").select("part", "block", "tokens")
    parts = heads.groupBy("part").agg(F.sum("tokens").alias("n"))
    # One row per part in the window without a key.
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.sum("tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("tokens")
    return heads.select("part", "block", own.alias("own")).join(before, "part").select("part", "block", (F.col("own") + F.col("before")).alias("block_start"))


def stored_tokens(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Encode, write in order of doc_id, read back: (doc_id, start, n_tokens, ids_crc32) per row.

    NULL texts count as empty, so they hold the end id alone. A NULL doc_id
    comes before all others, rows that share a doc_id come in order of their
    ids. An empty table gives an empty file and an empty result.
    """
    spark = docs.sparkSession
    tokens = saved(tokenized(docs, path, end_id), "rans-tokens")
    # One row per token id that occurs: bounded by the vocabulary.
    freq = frequencies({r["id"]: r["n"] for r in counted(tokens).collect()})
    folder = scratch_path(spark, "rans-file")
    write_ids(tokens, folder, freq)
    placed = read_documents(spark, folder).join(block_starts(spark, folder), ["part", "block"])
    return placed.select(real_id("_id").alias("doc_id"), (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32")
