"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``span`` (100) bytes that covers it also starts
earlier. Two equal strings have equal prefixes of every length, so positions
are told apart by names of growing length: the name of ``2 L`` bytes is made of
the names of its halves at distance ``L``, and Spark sorts (name, position) rows;
positions whose name is unique drop out, the others go on to a longer name.

Not every position is a row. Among the 32-byte names inside a string, the
smallest one marks an anchor; equal strings have it at the same place, so
comparing at anchors (about one in 35 positions) finds every match.

1. *32 bytes, then the surroundings.* Rows (32-byte name, name of all strings
   around the anchor, place) are sorted. Of rows equal in both, all but the
   earliest are repeats as far as the strings around the anchor reach. The
   earliest one goes on only if its 32 bytes also have other surroundings.
2. *88 bytes, then 112.* For those, strings that start within 12 bytes of each
   other are one row: (name of the 88 bytes they share, name of all their bytes).
   The same rule settles or drops most of them.
3. *100 bytes.* Of what is left, at the ends of repeated passages, every string is
   a row of its own (two names of 64 bits), and all but the earliest are repeats.

Names are 64-bit mixes made by doubling, not dense ranks, so a round needs no
look-up of ranks; the last round compares 128 bits. Each task first settles the
repeats among its own rows, so a passage that stands in a third of all documents
sends one row per task, and the sorted rows are read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.llm.common import map_batches, real_id, released, row_key, sliced
from notemill.session import saved

SPAN = 100
BASE = 32                    # bytes of an anchor's name
REACH = SPAN - BASE          # how far a string around an anchor starts before it
GROUP = 1 << 18              # bytes worked on at a time
PIECE = 1 << 19              # longer texts are worked on in pieces that overlap
MARGIN = 2 * SPAN
STEP = 12                    # strings that start this close go through the second round together
FLUSH = 300_000              # rows a task holds before it settles its own repeats

_MIX = np.random.default_rng(20240229)
_TABLES = _MIX.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_ODD = _MIX.integers(1, 1 << 63, (2, 8, 2), dtype=np.uint64) | np.uint64(1)


def _mixed(a: np.ndarray, b: np.ndarray, level: int, seed: int) -> np.ndarray:
    """The name of two neighbours from their names."""
    out = a * _ODD[seed, level, 0]
    out += b * _ODD[seed, level, 1]
    out ^= out >> np.uint64(31)
    return out


def names(data: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Names of all runs of 32 and of 64 bytes, by doubling from single bytes."""
    own, base, size = _TABLES[seed][data], None, 1
    for level in range(6):
        own = _mixed(own[:-size], own[size:], level, seed) if len(own) > size else own[:0]
        size *= 2
        if size == BASE:
            base = own
    return base, own


def _running(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, 32-byte name, 64-byte names) of the anchors of texts laid end to end.

    ``ends`` has the end of the text at each byte; texts are as good as apart.
    """
    base, wide = names(data)
    base |= np.uint64(1)
    inside = np.arange(len(data) - SPAN + 1) + SPAN <= ends[: len(data) - SPAN + 1]
    least = np.where(inside, _running(base, REACH + 1, np.minimum)[: len(inside)], np.uint64(0))
    around = np.zeros(len(base) + REACH, np.uint64)
    around[REACH: REACH + len(least)] = least
    return np.flatnonzero(_running(around, REACH + 1, np.maximum) == base), base, wide


def _surroundings(at: np.ndarray, low: np.ndarray, high: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Names of all bytes that strings around the anchors cover: three 64-byte names lie over them, as cut off by the text."""
    left, right = np.minimum(at - low, REACH), np.minimum(high - at, SPAN)
    start, size = at - left, left + right
    out = _mixed(wide[start], wide[start + size - 64], 6, 0)
    out = _mixed(out, wide[start + np.minimum(52, size - 64)], 7, 0)
    return _mixed(out, (left * 256 + right).astype(np.uint64), 6, 1)


def _bytes_of(texts: pa.Array) -> list[bytes]:
    """UTF-8 of a column without NULLs, not decoded on the way."""
    return texts.cast(pa.binary()).to_pylist()


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, int, int, bytes]]]:
    """Groups of (text number, offset of the piece, first and end of what counts, bytes); texts too short for a match are left out."""
    group, size = [], 0
    for number, text in enumerate(texts):
        if len(text) < SPAN:
            continue
        for first in range(0, len(text), PIECE):
            low, high = max(0, first - MARGIN), min(len(text), first + PIECE + MARGIN)
            group.append((number, low, first, min(len(text), first + PIECE), text[low:high]))
            size += high - low
            if size >= GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group


def _laid_out(group: list[tuple[int, int, int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a group end to end, and the start of each piece and the piece's number at each byte."""
    sizes = np.array([len(g[4]) for g in group])
    return np.frombuffer(b"".join(g[4] for g in group), np.uint8), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(group)), sizes)


def anchor_rows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, position, 32-byte name, name of the surroundings) of all anchors."""
    for group in _pieces(texts):
        data, starts, owner = _laid_out(group)
        number, offset, first, end = (np.array([g[k] for g in group]) for k in range(4))
        ends = (starts + [len(g[4]) for g in group])[owner]
        at, base, wide = anchors(data, ends)
        piece = owner[at]
        position = at - starts[piece] + offset[piece]
        keep = (position >= first[piece]) & (position < end[piece])
        at, piece, position = at[keep], piece[keep], position[keep]
        yield number[piece], position, base[at], _surroundings(at, starts[piece], ends[at], wide)


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals by document; input sorted by (document, start)."""
    if not len(doc):
        return doc, start, end
    # Documents are shifted apart, so that one running maximum serves all.
    shift = np.cumsum(np.concatenate(([False], doc[1:] != doc[:-1]))).astype(np.int64) << 40
    reached = np.maximum.accumulate(end + shift)
    fresh = np.concatenate(([True], start[1:] + shift[1:] > reached[:-1]))
    last = np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(doc) - 1]))
    return doc[fresh], start[fresh], (reached - shift)[last]


ROWS = "name bigint, more bigint, _id bigint, _turn bigint, place bigint"
NAMED, COVER, OPEN = 0, 1, 2


def _batch(kind: int, name: np.ndarray, more: np.ndarray, doc: np.ndarray, text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    """ROWS; ``place`` packs kind, start (from ``-MARGIN`` on) and length, and sorts in that order for the first two kinds."""
    place = (np.uint64(kind) << np.uint64(62)) | ((start + MARGIN).astype(np.uint64) << np.uint64(31)) | (stop - start).astype(np.uint64)
    return pa.RecordBatch.from_pydict({
        "name": pa.array(np.asarray(name).view(np.int64)), "more": pa.array(np.asarray(more).view(np.int64)), "_id": pa.array(doc),
        "_turn": pa.array(text.astype(np.int64)), "place": pa.array(place.view(np.int64)),
    })


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, start, stop)."""
    own = place.view(np.uint64)
    start = ((own >> np.uint64(31)) & np.uint64((1 << 31) - 1)).astype(np.int64) - MARGIN
    return (own >> np.uint64(62)).astype(np.int64), start, start + (own & np.uint64((1 << 31) - 1)).astype(np.int64)


def _settled(
    doc_id: np.ndarray, doc_turn: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, name: np.ndarray, more: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """What a task sends on: the earliest row of each name, and the repeats among its own rows as merged covers."""
    rank = np.empty(len(doc_id), np.int64)
    rank[np.lexsort((doc_turn, doc_id))] = np.arange(len(doc_id))
    order = np.lexsort((start, rank[doc], more, name))
    doc, start, stop, name, more = doc[order], start[order], stop[order], name[order], more[order]
    same = np.concatenate(([False], (name[1:] == name[:-1]) & (more[1:] == more[:-1])))
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(doc))))
    # The same place of a document given twice is no repeat of itself.
    twin = same & (doc_id[doc] == doc_id[doc[lead]]) & (doc_turn[doc] == doc_turn[doc[lead]]) & (start == start[lead])
    sent = ~same | twin
    yield _batch(NAMED, name[sent], more[sent], doc_id[doc[sent]], doc_turn[doc[sent]], start[sent], stop[sent])
    again = same & ~twin
    if again.any():
        own, low, high = doc[again], np.maximum(0, start[again]), stop[again]
        by = np.lexsort((low, own))
        own, low, high = _merged(own[by], low[by], high[by])
        # Covers only pass through the next sort; a mixed name spreads them.
        yield _batch(COVER, (doc_id[own] ^ low) * int(_ODD[0, 0, 0] >> np.uint64(2)), np.zeros(len(own), np.int64), doc_id[own], doc_turn[own], low, high)


def _rows_of_tasks(docs: DataFrame, read) -> DataFrame:
    """ROWS from (_id, _turn, ...) batches: ``read(batch)`` yields (row number, start, stop, name, more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, found, size, docs_held = [], [], [], 0, 0
        for batch in sliced(batches):
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            hashes.append(batch.column(1).to_numpy(zero_copy_only=False))
            for number, *columns in read(batch):
                found.append((number + docs_held, *columns))
                size += len(number)
                if size >= FLUSH:
                    yield from _settled(np.concatenate(ids), np.concatenate(hashes), *map(np.concatenate, zip(*found, strict=True)))
                    found, size = [], 0
            docs_held += batch.num_rows
            if not found:
                ids, hashes, docs_held = [], [], 0
        if found:
            yield from _settled(np.concatenate(ids), np.concatenate(hashes), *map(np.concatenate, zip(*found, strict=True)))

    return docs.mapInArrow(released(run), ROWS)


def repeats(rows: DataFrame, follow: bool) -> DataFrame:
    """Covers of all rows but the earliest of (name, more), and with ``follow`` the earliest ones whose ``name`` has another ``more``.

    The sorted rows are read as a stream: what is kept between batches is one row.
    """
    ordered = rows.repartition("name").sortWithinPartitions("name", "more", "_id", "_turn", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting = None, None
        for batch in batches:
            name, more, doc, text, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            kind, start, stop = _unpacked(place)
            columns = [name, more, doc, text, start, stop]
            passed = kind == COVER
            if passed.any():
                yield _batch(COVER, *[c[passed] for c in columns])
                columns = [c[~passed] for c in columns]
            name, more, doc, text, start, stop = columns
            if not len(name):
                continue
            new_name = name != np.concatenate(([name[0] if last is None else last[0]], name[:-1]))
            new_more = more != np.concatenate(([more[0] if last is None else last[1]], more[:-1]))
            if last is None:
                new_name[0] = True
            lead = new_name | new_more
            first = np.maximum.accumulate(np.where(lead, np.arange(len(name)), -1))
            lead_of = [np.where(first >= 0, c[first], 0 if last is None else last[2 + k]) for k, c in enumerate((doc, text, start))]
            again = ~lead & ~((doc == lead_of[0]) & (text == lead_of[1]) & (start == lead_of[2]))
            if again.any():
                yield _batch(COVER, name[again], more[again], doc[again], text[again], np.maximum(0, start[again]), stop[again])
            at = np.flatnonzero(lead)
            if follow and len(at):
                others = ~new_name[at]
                if waiting is not None and others[0]:
                    yield _batch(OPEN, *waiting)
                going = others.copy()
                going[:-1] |= others[1:]
                if going.any():
                    yield _batch(OPEN, *[c[at[going]] for c in columns])
                waiting = [c[at[-1]:at[-1] + 1] for c in columns] if not going[-1] else None
            last = (name[-1], more[-1], *[c[-1] for c in lead_of])

    return ordered.mapInArrow(released(run), ROWS)


def _opened(batch: pa.RecordBatch, seeds: tuple[int, ...]) -> Iterator[tuple[int, int, int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """For each text (piece) with open rows: text number, its offset and length, 64-byte names by seed, starts and stops of the rows."""
    texts = _bytes_of(batch.column(2))
    places = [np.unique(np.array(p, np.int64)) for p in batch.column(3).to_pylist()]
    for group in _pieces(texts):
        data, starts, _ = _laid_out(group)
        wides = [names(data, seed)[1] for seed in seeds]
        for piece, (number, offset, first, end, _) in enumerate(group):
            _, start, stop = _unpacked(places[number])
            here = (start + REACH >= first) & (start + REACH < end)
            if here.any():
                yield number, offset - int(starts[piece]), len(texts[number]), wides, start[here], stop[here]


def _spread_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Around each open anchor, the strings that start within ``STEP`` of each other: (name of the bytes all share, name of the bytes any has)."""
    for number, shift, size, (inner, outer), start, _ in _opened(batch, (0, 1)):
        at = start + REACH
        least, most = np.maximum(0, at + SPAN - size), np.minimum(REACH, at)
        for near in range(0, REACH, STEP):
            some = (near <= most) & (near + STEP >= least)
            low, high = np.maximum(near, least)[some], np.minimum(near + STEP, most)[some]
            core, begin, end = at[some] - near - shift, at[some] - high, at[some] - low + SPAN
            shared = _mixed(inner[core], inner[core + SPAN - STEP - 64], 6, 0)
            whole = _mixed(_mixed(outer[begin - shift], outer[end - 64 - shift], 6, 1), (low * 256 + high).astype(np.uint64), 7, 1)
            # Blocks at different distances from their anchors are never the same strings.
            yield np.full(len(core), number), begin, end, shared ^ np.uint64(near), whole


def _string_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Every string inside the open rows, with a name of 128 bits in two halves."""
    for number, shift, _, wides, start, stop in _opened(batch, (0, 1)):
        begin = np.unique(np.concatenate([np.arange(a, b - SPAN + 1) for a, b in zip(start.tolist(), stop.tolist(), strict=True)]))
        here = begin - shift
        yield (
            np.full(len(begin), number), begin, begin + SPAN,
            _mixed(wides[0][here], wides[0][here + SPAN - 64], 6, 0), _mixed(wides[1][here], wides[1][here + SPAN - 64], 6, 1),
        )


def covers(docs: DataFrame) -> DataFrame:
    """(_id, _turn, start, stop) of byte intervals to remove, of ``row_key`` documents; they may overlap and reach past the end.

    The rounds after the first all join the same texts by the same key, so
    Spark shuffles the texts once for them and for what is done with the covers.
    """
    keyed = docs.select("_id", "_turn", "_text")

    def first_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for number, at, name, around in anchor_rows(_bytes_of(batch.column(2))):
            yield number, at - REACH, at + SPAN, name, around

    def opened(rows: DataFrame) -> DataFrame:
        still = rows.filter(kind == OPEN).groupBy("_id", "_turn").agg(F.collect_list("place").alias("_places"))
        return keyed.join(still, ["_id", "_turn"]).select("_id", "_turn", "_text", "_places")

    kind = F.shiftrightunsigned("place", 62)
    first = saved(repeats(_rows_of_tasks(keyed, first_rows), follow=True), "suffix-anchors")
    second = repeats(_rows_of_tasks(opened(first), _spread_rows), follow=True)
    third = repeats(_rows_of_tasks(opened(second), _string_rows), follow=False)
    start = F.shiftrightunsigned("place", 31).bitwiseAND((1 << 31) - 1) - MARGIN
    found = first.unionByName(second).unionByName(third).filter(kind == COVER)
    return found.select("_id", "_turn", start.alias("start"), (start + F.col("place").bitwiseAND((1 << 31) - 1)).alias("stop"))


def _cut(text: bytes, start: list[int], stop: list[int]) -> tuple[bytes, int]:
    """What is left of a text, and the number of removed runs."""
    if not start:
        return text, 0
    a, b = np.array(start, np.int64), np.minimum(np.array(stop, np.int64), len(text))
    by = np.argsort(a, kind="stable")
    _, a, b = _merged(np.zeros(len(a), np.int64), a[by], b[by])
    kept, at = [], 0
    for low, high in zip(a.tolist(), b.tolist(), strict=True):
        kept.append(text[at:low])
        at = high
    return b"".join([*kept, text[at:]]), len(a)


def removed(docs: DataFrame) -> DataFrame:
    """(_id, _turn, kept binary, n_bytes, n_spans) of every row of a ``row_key`` table."""
    spans = covers(docs).groupBy("_id", "_turn").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    joined = docs.select("_id", "_turn", "_text").join(spans, ["_id", "_turn"], "left")

    def run(batch: pa.RecordBatch) -> dict:
        texts = _bytes_of(batch.column(2))
        spans = [s or [] for s in batch.column(3).to_pylist()]
        out = [_cut(t, [x["start"] for x in s], [x["stop"] for x in s]) for t, s in zip(texts, spans, strict=True)]
        return {
            "_id": batch.column(0), "_turn": batch.column(1), "kept": pa.array([k for k, _ in out], pa.binary()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_spans": pa.array([n for _, n in out], pa.int64()),
        }

    return map_batches(joined, run, "_id bigint, _turn bigint, kept binary, n_bytes bigint, n_spans bigint", rows=1024)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    NULL and short texts keep all bytes. A NULL doc_id comes before all others.
    Rows equal in doc_id and text are one document: none repeats the other, and
    all get its result. Rows that share a doc_id but not the text come in the
    order of a hash of the text. An empty table gives an empty table.
    """
    return removed(row_key(docs)).select(
        real_id("_id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut out of ``text`` and ``n_chars`` set anew.

    A character that loses some of its bytes goes as a whole. Rows come as often
    as before: equal rows share one result. Texts move once more, to meet their
    intervals.
    """
    keyed = row_key(docs)
    spans = covers(keyed.drop("_row")).groupBy("_id", "_turn").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))
    met = keyed.select("_id", "_turn", "_row").join(spans, ["_id", "_turn"], "left")
    # By place: names of the input may be anything, and may come twice in upper and lower case.
    rows = met.select(*[F.col("_row").getField(c).alias(f"_{i}") for i, c in enumerate(docs.columns)], F.col("_spans"))
    names, place = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, spans = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            cut = [
                t if not s else _cut(t.encode(), [x["start"] for x in s], [x["stop"] for x in s])[0].decode("utf-8", "ignore")
                for t, s in zip(texts, spans, strict=True)
            ]
            columns = batch.columns[:-1]
            columns[place] = pa.array(cut, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    left = rows.mapInArrow(released(run), docs.schema)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left
