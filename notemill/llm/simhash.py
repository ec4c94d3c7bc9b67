"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within ``distance`` bits of each other are found like this:

* The 64 bits are dealt into ``m`` parts, correlated bits into the same part,
  so that a part's value is as selective as its width allows.
* Part ``i`` gets a threshold ``t_i >= -1`` with ``sum(t_i + 1) = distance + 1``.
  Two fingerprints that differ in more than ``t_i`` bits of every part differ in
  at least ``sum(t_i + 1) > distance`` bits; so a close pair is within ``t_i`` in
  some part. The thresholds are unequal: dynamic programming picks those of
  the least estimated work (rows to shuffle plus candidates to compare).
* Every distinct fingerprint is sent to the value of each part, and for
  ``t_i > 0`` also to all values within ``t_i`` bits of it; fingerprints that meet
  are compared in full.

Only distinct fingerprints take part, so a group of copies is one row. A part
value met by very many is cut into chunks, and every pair of chunks is a task
of its own: memory stays bounded and nothing is dropped. A task gives a
spanning forest of the links it verified, never all pairs; components follow
from the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.common import components, forest, map_batches, real_id, released, texts_of
from notemill.session import saved

BITS = 64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SAMPLE = 4096        # distinct fingerprints the parts and thresholds are fitted on
MAX_PARTS = 8
CHUNK = 4096         # fingerprints of one part value that a task compares with as many others
SHIFT_ROW = 40.0     # work of a shuffled row, in comparisons


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 (seed 42) of every run of ``words`` words, joined by spaces; of all of them if there are fewer."""
    tokens = text.encode("utf-8", "replace").translate(LOWER).split()
    if not tokens:
        return []
    size = min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    hashed = xxhash.xxh64_intdigest
    return [
        hashed(joined[a:b], 42) for a, b in zip(starts[: len(tokens) - size + 1].tolist(), (ends[size - 1:] - 1).tolist(), strict=True)
    ]


def fingerprint(text: str, words: int) -> int:
    """Bit ``i`` is 1 if it is set in over half the hashes; no words give zero."""
    hashes = np.array(shingle_hashes(text, words), dtype="<u8")
    if not len(hashes):
        return 0
    set_in = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, more: str = "", *carried: Column) -> DataFrame:
    """(doc_id, fp) of every row, the fingerprint as a signed 64-bit number; with the ``carried`` columns, named and typed by ``more``."""
    names = [field.split()[0] for field in more.split(",")] if more else []

    def run(batch: pa.RecordBatch) -> dict:
        own = np.array([fingerprint(t, words) for t in texts_of(batch, "text")], dtype=np.uint64)
        return {"doc_id": batch.column(0), "fp": pa.array(own.view(np.int64)), **{n: batch.column(2 + i) for i, n in enumerate(names)}}

    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text"), *[c.alias(n) for n, c in zip(names, carried, strict=True)]
    )
    return map_batches(source, run, ", ".join(["doc_id bigint, fp bigint", *filter(None, [more])]))


@dataclass(frozen=True)
class Parts:
    """Bit masks and thresholds of the parts; a threshold of -1 leaves a part out."""

    masks: tuple[int, ...]
    limits: tuple[int, ...]


def grouped_bits(bits: np.ndarray, count: int) -> list[list[int]]:
    """64 bits in ``count`` parts of near equal width: each part takes a bit and those most correlated with it."""
    spread = bits - bits.mean(axis=0)
    norm = np.sqrt((spread ** 2).sum(axis=0))
    bound = np.abs(spread.T @ spread) / np.maximum(np.outer(norm, norm), 1e-9)
    left, parts = set(range(BITS)), []
    for k in range(count):
        width = BITS // count + (k < BITS % count)
        part = [min(left, key=lambda b: (-bound[b, sorted(left)].sum(), b))]
        left.discard(part[0])
        while len(part) < width:
            part.append(min(left, key=lambda b: (-bound[b, part].sum(), b)))
            left.discard(part[-1])
        parts.append(sorted(part))
    return parts


def plan_parts(sample: np.ndarray, total: int, distance: int) -> Parts:
    """Parts and thresholds of the least estimated work for ``total`` distinct fingerprints.

    The share of candidate pairs per part and threshold is measured on pairs of
    the sample, but not below what independent even bits would give, for which
    a sample is too small. Whatever the estimates, the thresholds are exact.
    """
    if len(sample) < 2:
        sample = np.array([0, 1], np.uint64)
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    some = np.random.default_rng(7).permutation(sample)[:1024]
    pairs = (some[:, None] ^ some[None, :])[np.triu_indices(len(some), 1)]
    best: tuple[float, Parts] | None = None
    for count in range(1, min(MAX_PARTS, distance + 1) + 1):
        masks, costs = [], []
        for part in grouped_bits(bits, count):
            mask = sum(1 << b for b in part)
            apart = np.bitwise_count(pairs & np.uint64(mask))
            seen = np.bincount(apart, minlength=BITS + 1).cumsum() / len(pairs)
            own = [0.0]
            for limit in range(distance + 1):
                sent, ball = (sum(comb(len(part), k) for k in range(r + 1)) for r in ((limit + 1) // 2, limit))
                met = max(seen[limit], min(1.0, ball / 2.0 ** len(part)))
                own.append(total * sent * SHIFT_ROW + met * total * (total - 1) / 2 * (limit + 1))
            masks.append(mask)
            costs.append(own)
        # least[b]: the least work of the parts so far that use up a budget of b, and how.
        least: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for own in costs:
            reach: dict[int, tuple[float, tuple[int, ...]]] = {}
            for spent, (work, limits) in least.items():
                for more in range(distance + 2 - spent):
                    option = (work + own[more], (*limits, more - 1))
                    if spent + more not in reach or option < reach[spent + more]:
                        reach[spent + more] = option
            least = reach
        work, limits = least[distance + 1]
        if best is None or work < best[0]:
            best = (work, Parts(tuple(masks), limits))
    return best[1]


def _variants(mask: int, limit: int) -> np.ndarray:
    """XOR patterns of up to ``limit`` bits inside ``mask``, the empty one first."""
    bits = [b for b in range(BITS) if mask >> b & 1]
    return np.array([sum(1 << b for b in some) for k in range(limit + 1) for some in combinations(bits, k)], np.uint64)


def meetings(distinct: DataFrame, parts: Parts) -> DataFrame:
    """(part, key, fp): where every fingerprint goes; a part with a threshold over 0 sends it to all near values."""
    used = [(i, m, t) for i, (m, t) in enumerate(zip(parts.masks, parts.limits, strict=True)) if t >= 0]
    # Two fingerprints within t of each other meet if one goes t // 2 bits and the other the rest;
    # as either may come first, both go the larger half.
    reach = {i: _variants(m, (t + 1) // 2) for i, m, t in used}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, mask, _ in used:
                step = max(1, (1 << 18) // len(reach[i]))
                for at in range(0, len(own), step):
                    some = own[at:at + step]
                    keys = (some & np.uint64(mask))[:, None] ^ reach[i][None, :]
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array(np.full(keys.size, i, np.int32)), "key": pa.array(keys.ravel().view(np.int64)),
                        "fp": pa.array(np.repeat(some, len(reach[i])).view(np.int64)),
                    })

    return distinct.select("fp").mapInArrow(released(run), "part int, key bigint, fp bigint")


def _close_pairs(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    found = [np.nonzero(np.bitwise_count(left[at:at + 512, None] ^ right[None, :]) <= distance) for at in range(0, len(left), 512)]
    return (
        np.concatenate([a + 512 * k for k, (a, _) in enumerate(found)]).astype(np.int64),
        np.concatenate([b for _, b in found]).astype(np.int64),
    )


def _compare(own: np.ndarray, side: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of links in one meeting place. ``side`` 0: all among themselves; 1 and 2: only across."""
    if side[0] == 0:
        a, b = _close_pairs(own, own, distance)
    else:
        first, second = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
        if not len(first) or not len(second):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        a, b = _close_pairs(own[first], own[second], distance)
        a, b = first[a], second[b]
    member, root = forest(len(own), a, b)
    return own[member], own[root]


def links(distinct: DataFrame, parts: Parts, distance: int, chunk: int = CHUNK) -> DataFrame:
    """(a, b) of fingerprints within ``distance``: enough links to connect all that are."""
    rows = saved(meetings(distinct, parts), "simhash-meetings")
    crowds = (
        rows.groupBy("part", "key").count().filter("count > 1")
        .select("part", "key", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    )
    # A crowd of k chunks is compared chunk by chunk: each row goes to the k pairs its chunk is in.
    met = rows.join(crowds, ["part", "key"]).withColumn("c", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda o: F.struct(
            F.least("c", o).alias("low"), F.greatest("c", o).alias("high"),
            F.when(o == F.col("c"), 0).when(F.col("c") < o, 1).otherwise(2).alias("side"),
        ),
    )
    dealt = (
        met.select("part", "key", "fp", F.explode(pairs).alias("p"))
        .select("part", "key", "p.low", "p.high", "p.side", "fp")
        .repartition("part", "key", "low", "high").sortWithinPartitions("part", "key", "low", "high")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places come one after the other; the last of a batch may go on in the next."""
        rest: list[np.ndarray] = []
        for batch in batches:
            rest.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]))
            rows = np.concatenate(rest, axis=1)
            new = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            if len(new):
                yield from work(rows[:, : new[-1]], new[:-1])
                rest = [rows[:, new[-1]:].copy()]
            else:
                rest = [rows]
        if rest:
            yield from work(rest[0], np.empty(0, np.int64))

    def work(rows: np.ndarray, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        for a, b in zip([0, *new.tolist()], [*new.tolist(), rows.shape[1]], strict=True):
            if b - a > 1:
                found.append(_compare(rows[5, a:b].view(np.uint64), rows[4, a:b], distance))
        if found:
            left, right = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
            if len(left):
                yield pa.RecordBatch.from_pydict({"a": pa.array(left), "b": pa.array(right)})

    return dealt.mapInArrow(released(run), "a bigint, b bigint").distinct()


def rooted(distinct: DataFrame, distance: int, sample: int) -> DataFrame:
    """The rows of ``distinct``, one per ``fp``, with ``root``: the same number for all fingerprints that are linked."""
    total = distinct.count()
    # A bounded sample in hash order; only the plan depends on it, never the result.
    some = [r["fp"] for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()]
    parts = plan_parts(np.array(some, np.int64).view(np.uint64), total, distance)
    roots = components(links(distinct, parts, distance), "simhash-links")
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest doc_id reachable over links of ``distance`` bits or fewer.

    NULL and empty texts have the fingerprint 0, which links like any other.
    Rows may repeat. A NULL doc_id stays NULL; in a component it is passed over
    for the smallest, unless it has no other id.
    """
    printed = saved(fingerprints(docs, words), "simhash-fp")
    distinct = saved(printed.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    placed = rooted(distinct, distance, sample)
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    members = placed.join(lowest, "root").select("fp", "component_id")
    return printed.join(members, "fp").select("doc_id", "fp", "component_id")


def _document_key(doc_id: Column, text: Column) -> Column:
    """One text of its own for each document, that is for each id and text; never NULL."""
    return F.concat_ws("|", doc_id.cast("bigint").cast("string"), F.md5(F.coalesce(text, F.lit(""))))


def one_per_group(docs: DataFrame, words: int = 4, distance: int = 4, sample: int = SAMPLE) -> DataFrame:
    """One row of every group of near duplicates, with all columns of ``docs``: that of smallest (doc_id, text hash).

    NULL ids come after all others. Rows are told apart by id and text, so ids
    may be NULL or repeat within groups and across them; of rows equal in both
    one stays. Exactly one row of a group is left.
    """
    keyed = docs.select("doc_id", "text", _document_key(docs["doc_id"], docs["text"]).alias("key"))
    printed = saved(fingerprints(keyed, words, "key string, hash bigint", F.col("key"), F.xxhash64("text")), "simhash-fp")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash", "key")
    distinct = saved(printed.groupBy("fp").agg(F.min(order).alias("least")), "simhash-least")
    least = rooted(distinct, distance, sample).groupBy("root").agg(F.min("least").alias("least"))
    kept = saved(least.select(F.col("least.key").alias("key")), "simhash-kept")
    # All is settled on keys, without texts: rows that go, and the few kept keys that several equal rows have.
    times = printed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    told = saved(times.join(kept.withColumn("stays", F.lit(True)), "key", "left"), "simhash-keys")
    others = told.filter("stays IS NULL OR n > 1").select(F.col("key").alias("_kept_key"))
    repeated = told.filter("stays AND n > 1").select(F.col("key").alias("_kept_key"))
    rows = docs.select(_document_key(docs["doc_id"], docs["text"]).alias("_kept_key"), F.struct(*[docs[c] for c in docs.columns]).alias("_kept_row"))
    single = rows.join(others, "_kept_key", "left_anti").select("_kept_row.*")
    # Equal rows become one inside each task first, so no key brings many rows to one task.
    one = rows.join(repeated, "_kept_key", "left_semi").groupBy("_kept_key").agg(F.first("_kept_row").alias("_kept_row")).select("_kept_row.*")
    return single.unionAll(one)


def hex_digits(column: str = "fp"):
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
