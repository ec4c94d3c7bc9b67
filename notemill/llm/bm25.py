"""Exact top-k search by BM25: an inverted index per chunk of documents, float32 bounds, exact scores of what they leave.

1. Every document becomes packed term hashes and counts. One pass gathers the
   document frequencies of the terms that queries hold, the number of documents
   and their mean length, so scores are global and results merge exactly.
2. Up to ``COMMON`` of the most frequent of these terms get numbers of two bytes, other
   terms stay hashes. Documents are dealt into at most ``SHARDS`` shards, queries
   into blocks of about ``QUERY_BLOCK``; a unit is one shard and one block. A unit
   reads its queries first and then streams its documents, ``SHARD_DOCS`` at a
   time, so a task holds a block and a chunk, however many documents there are.
3. A chunk is inverted. Products of the ``DENSE`` most frequent terms are one
   float32 matrix product, those of other terms come from their postings. Sums of
   numbers above 0 are off by a known share at most, so a document whose sum stays
   below a query's k-th score by more than that is provably out. The others are
   scored exactly, in doubles, and enter the query's list, whose k-th score is the
   bound for later chunks.
4. Each unit gives k rows per query, which are merged by score and id: rows grow
   with the queries, not with queries and documents.

A query is weighted by its own term counts, so a whole document can be a query.
Every query meets every document, so the time of step 3 grows with the product
of both; documents are copied once for each block of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notemill.llm.common import NULL_ID, real_id, released, sliced, texts_of
from notemill.session import saved

K1, B = 1.2, 0.75
SHARDS = 24           # shards of documents, at most
SHARD_DOCS = 2048     # documents of a chunk
QUERY_BLOCK = 32768   # queries of a block, about
BLOCK_TERMS = 1 << 24  # their terms, about
COMMON = 1 << 16      # terms that get a number of two bytes, at most
DENSE = 1024          # terms of the matrix product
PIECE = 128           # queries met at a time
TABLE = 1 << 19       # cells of the table of weights that exact scores are read off
PAIRS = 1 << 19       # products, or postings of documents, worked on at a time
ROUNDING = 2.0 ** -22  # share by which a term may move a float32 sum, four times the unit roundoff
QUERY_TERM = np.dtype([("term", "<u8"), ("weight", "<u4"), ("df", "<u8")])
GROUP = 1 << 19       # bytes worked on at a time
CHUNK_TERMS = 1 << 20  # terms of a chunk, about
PACKED = ("common", "common_times", "rare", "rare_times")
FLUSH = 1 << 21       # terms a task holds before it sums up frequencies

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_RADIX), -1, 1 << 64))


def _powers(radix: np.uint64, count: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(count, radix, np.uint64))), dtype=np.uint64)


_UP, _DOWN = _powers(_RADIX, GROUP), _powers(_INVERSE, GROUP)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, first byte) of every word of a lower-cased byte array.

    A word's hash is that of the polynomial of its bytes, read off running sums.
    The array is worked on in groups that end at a space; a word longer than a
    group is one word too, its polynomial summed up over its pieces.
    """
    hashes, starts, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(data):
        stop = min(at + GROUP, len(data))
        if stop < len(data):
            spaces = np.flatnonzero(_SPACE[data[at:stop]])
            if not len(spaces):
                hashed, at_end = _long_word(data, at)
                hashes.append(hashed)
                starts.append(np.array([at]))
                at = at_end
                continue
            stop = at + int(spaces[-1]) + 1
        own, start = _words_of_group(data[at:stop])
        hashes.append(own)
        starts.append(start + at)
        at = stop
    return np.concatenate(hashes), np.concatenate(starts)


def _weighed(data: np.ndarray) -> np.ndarray:
    return (_LOWER[data].astype(np.uint64) + np.uint64(1)) * _UP[: len(data)]


def _words_of_group(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    letter = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], letter, [False]))))
    start, end = edge[::2], edge[1::2]
    total = np.concatenate(([np.uint64(0)], np.cumsum(_weighed(data), dtype=np.uint64)))
    return _mixed((total[end] - total[start]) * _DOWN[start] ^ (end - start).astype(np.uint64)), start


def _long_word(data: np.ndarray, start: int) -> tuple[np.ndarray, int]:
    """(hash, end) of the word that starts at ``start``, however long."""
    total, at = 0, start
    while at < len(data):
        piece = data[at:at + GROUP]
        spaces = np.flatnonzero(_SPACE[piece])
        piece = piece[: spaces[0]] if len(spaces) else piece
        total += int(_weighed(piece).sum(dtype=np.uint64)) * pow(int(_RADIX), at - start, 1 << 64)
        at += len(piece)
        if len(spaces):
            break
    return _mixed(np.array([total % (1 << 64)], np.uint64) ^ np.uint64(at - start)), at


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, length, terms binary uint64, counts binary uint32) of every row; terms ascend."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, counts = [], [], []
            for group in _groups([t.encode("utf-8", "replace") for t in texts_of(batch, "_text")]):
                sizes = np.array([len(t) + 1 for t in group])
                hashed, start = word_hashes(np.frombuffer(b" ".join([*group, b""]), np.uint8))
                owner = np.searchsorted(np.cumsum(sizes), start, side="right")
                order = np.lexsort((hashed, owner))
                hashed, owner = hashed[order], owner[order]
                new = np.flatnonzero(np.concatenate(([True], (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])))) if len(hashed) else np.empty(0, np.int64)
                times = np.diff(np.concatenate((new, [len(hashed)]))).astype("<u4")
                hashed, bounds = hashed[new].astype("<u8"), np.searchsorted(owner[new], np.arange(len(group) + 1))
                lengths += np.bincount(owner, minlength=len(group)).tolist()
                terms += [hashed[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                counts += [times[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({
                "_id": batch.column(0), "length": pa.array(lengths, pa.int64()), "terms": pa.array(terms, pa.binary()), "counts": pa.array(counts, pa.binary()),
            })

    source = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("_id"), F.col(text_col).alias("_text"))
    return source.mapInArrow(released(run), "_id bigint, length bigint, terms binary, counts binary")


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text) + 1
        if size >= GROUP // 2:
            yield group
            group, size = [], 0
    if group:
        yield group


def term_rows(packed: DataFrame) -> DataFrame:
    """(kind, term, df, words): documents that hold each term; tasks sum up their own first. Kind 1 counts all documents and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, documents, words = [], 0, 0, 0

        def summed() -> pa.RecordBatch:
            term, n = np.unique(np.concatenate(held), return_counts=True)
            zeros = np.zeros(len(term), np.int64)
            return pa.RecordBatch.from_pydict({"kind": pa.array(zeros.astype(np.int32)), "term": pa.array(term.view(np.int64)), "df": pa.array(n.astype(np.int64)), "words": pa.array(zeros)})

        for batch in batches:
            documents += batch.num_rows
            words += sum(batch.column(0).to_pylist())
            for blob in batch.column(1).to_pylist():
                held.append(np.frombuffer(blob, "<u8"))
                size += len(held[-1])
                if size >= FLUSH:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()
        if documents:
            yield pa.RecordBatch.from_pydict({"kind": pa.array([1], pa.int32()), "term": pa.array([0], pa.int64()), "df": pa.array([documents], pa.int64()), "words": pa.array([words], pa.int64())})

    return packed.select("length", "terms").mapInArrow(released(run), "kind int, term bigint, df bigint, words bigint")


def _spans(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``low[i] ... low[i] + n[i] - 1`` of all i, one after the other."""
    return np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of items of at most ``PAIRS`` in sum, or of one item."""
    total, at = np.cumsum(sizes), 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(total, PAIRS + (total[at - 1] if at else 0), side="right")))
        yield at, stop
        at = stop


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of queries of these sizes whose table, of each query by the terms of all, has ``TABLE`` cells at most, or of one query."""
    at, stop, total = 0, 0, 0
    for stop, size in enumerate(sizes.tolist()):
        if stop > at and (stop + 1 - at) * (total + size) > TABLE:
            yield at, stop
            at, total = stop, 0
        total += size
    if len(sizes):
        yield at, stop + 1


class Block:
    """Queries and the best documents found for each so far.

    Terms are numbered: common ones by their place among them, others after these in order
    of their hash, so the terms of equal documents are summed up in the same order everywhere.
    """

    def __init__(self, queries: list[tuple], common_df: np.ndarray, dense: int, count: int, mean: float, k: int) -> None:
        self.ids, common, weight, rare, rare_weight, rare_df = zip(*queries, strict=True)
        flat = np.frombuffer(b"".join(rare), "<u8")
        self.rare, first = np.unique(flat, return_index=True)
        df = np.concatenate((common_df, np.frombuffer(b"".join(rare_df), "<u8")[first])).astype(np.float64)
        self.idf, self.mean, self.k = np.log(1 + (count - df + 0.5) / (df + 0.5)), mean, k
        own = [(np.frombuffer(c, "<u2"), np.frombuffer(r, "<u8")) for c, r in zip(common, rare, strict=True)]
        self.term = np.concatenate([x for c, r in own for x in (c.astype(np.int32), (len(common_df) + np.searchsorted(self.rare, r)).astype(np.int32))])
        self.weight = np.concatenate([np.frombuffer(x, "<u4") for pair in zip(weight, rare_weight, strict=True) for x in pair])
        self.at = np.concatenate(([0], np.cumsum([len(c) + len(r) for c, r in own])))
        self.used = np.zeros(len(df), bool)
        self.used[self.term] = True
        self.column = np.full(len(df), -1, np.int32)
        top = np.argsort(common_df, kind="stable")[::-1][:dense]
        self.column[top] = np.arange(len(top))
        self.width = max(1, len(top))
        self.slot, self.weights = np.full(len(df), -1, np.int32), np.zeros(0)  # empty between calls of _exact
        self.best = np.zeros((len(self.ids), k)), np.zeros((len(self.ids), k), np.int64)  # scores fall; 0 is no document

    def meet(self, docs: list[tuple]) -> None:
        """Enter the documents (id, length, common, times, rare, rare times) that are among the best."""
        copies: dict[tuple, int] = {}
        held = []
        for row in sorted(docs, key=lambda row: row[0]):  # of equal documents the k first suffice
            copies[row[2:]] = n = copies.get(row[2:], 0) + 1
            if n <= self.k:
                held.append(row)
        del copies
        ids, lengths, common, times, rare, rare_times = zip(*held, strict=True)
        ids = np.array(ids, np.int64)
        scale = K1 * (1 - B + B * np.array(lengths, np.float64) / max(self.mean, 1e-9))
        number = np.arange(len(held), dtype=np.int32)
        term = np.frombuffer(b"".join(common), "<u2").astype(np.int32)
        found = np.frombuffer(b"".join(rare), "<u8")
        place = np.searchsorted(self.rare, found)
        known = np.flatnonzero(self.rare[np.minimum(place, len(self.rare) - 1)] == found) if len(self.rare) else np.empty(0, np.int64)
        wanted = np.flatnonzero(self.used[term])
        doc = np.concatenate((np.repeat(number, [len(b) // 2 for b in common])[wanted], np.repeat(number, [len(b) // 8 for b in rare])[known]))
        times = np.concatenate((np.frombuffer(b"".join(times), "<u4")[wanted], np.frombuffer(b"".join(rare_times), "<u4")[known])).astype(np.float64)
        term = np.concatenate((term[wanted], (len(self.idf) - len(self.rare) + place[known]).astype(np.int32)))
        order = np.argsort(doc, kind="stable")  # common terms stay before others, both ascend
        doc, term, times = doc[order], term[order], times[order]
        score = self.idf[term] * times * (K1 + 1) / (times + scale[doc])
        doc_at = np.searchsorted(doc, np.arange(len(held) + 1))
        column = self.column[term]
        dense = np.zeros((len(held), self.width), np.float32)
        dense[doc[column >= 0], column[column >= 0]] = score[column >= 0]
        sparse = np.flatnonzero(column < 0)
        sparse = sparse[np.argsort(term[sparse], kind="stable")]
        first = np.concatenate(([0], np.cumsum(np.bincount(term[sparse], minlength=len(self.idf)))))
        postings = first, doc[sparse].astype(np.int64), score[sparse]
        for a in range(0, len(self.ids), PIECE):
            self._piece(a, min(a + PIECE, len(self.ids)), ids, (doc_at, term, score), dense, postings)

    def _piece(self, a: int, b: int, ids: np.ndarray, by_doc: tuple, dense: np.ndarray, postings: tuple) -> None:
        terms = self.term[self.at[a]:self.at[b]]
        weight = self.weight[self.at[a]:self.at[b]].astype(np.float64)
        sizes = np.diff(self.at[a:b + 1])
        query, docs = np.repeat(np.arange(b - a), sizes), len(ids)
        column = self.column[terms]
        asked = np.zeros((b - a, self.width), np.float32)
        asked[query[column >= 0], column[column >= 0]] = weight[column >= 0]
        about = asked @ dense.T
        flat = about.reshape(-1)
        first, post_doc, post_score = postings
        other = np.flatnonzero(column < 0)
        low = first[terms[other]]
        n = first[terms[other] + 1] - low
        other, low, n = other[n > 0], low[n > 0], n[n > 0]
        for i, j in _parts(n):
            post = _spans(low[i:j], n[i:j])
            place, product = np.repeat(query[other[i:j]] * docs, n[i:j]), np.repeat(weight[other[i:j]], n[i:j])
            place += post_doc[post]
            product *= post_score[post]
            flat += np.bincount(place, product, minlength=len(flat))

        # A sum of t numbers above 0 in float32, and each of them, is off by its share times t and a few at most.
        off = (sizes + 16) * ROUNDING
        least = self.best[0][a:b, -1].copy()
        if docs > self.k:
            new = np.flatnonzero(least == 0)
            least[new] = np.partition(about[new], docs - self.k, axis=1)[:, docs - self.k] * (1 - off[new])
        least = np.maximum((least * (1 - 4 * off)).astype(np.float32), np.finfo(np.float32).smallest_subnormal)
        q, d = np.divmod(np.flatnonzero((about >= least[:, None]).reshape(-1)), docs)
        if not len(q):
            return
        exact = np.zeros(len(q))
        edges = np.searchsorted(q, np.arange(b - a + 1))
        for i, j in _runs(sizes):
            x, y = edges[i], edges[j]
            if x < y:
                own = slice(self.at[a + i] - self.at[a], self.at[a + j] - self.at[a])
                exact[x:y] = self._exact(q[x:y] - i, d[x:y], query[own] - i, terms[own], weight[own], by_doc)
        own = np.flatnonzero(edges[1:] > edges[:-1])
        of = np.concatenate((np.repeat(own, self.k), q))
        scores, names = np.concatenate((self.best[0][a + own].reshape(-1), exact)), np.concatenate((self.best[1][a + own].reshape(-1), ids[d]))
        order = np.lexsort((names, -scores, of))
        best = order[np.searchsorted(of[order], own)[:, None] + np.arange(self.k)]
        self.best[0][a + own], self.best[1][a + own] = scores[best], names[best]

    def _exact(self, q: np.ndarray, d: np.ndarray, query: np.ndarray, terms: np.ndarray, weight: np.ndarray, by_doc: tuple) -> np.ndarray:
        """Scores, summed up in the order of terms, of the documents ``d`` for the queries ``q``; these have ``weight`` of ``terms`` each."""
        doc_at, doc_term, doc_score = by_doc
        self.slot[terms] = np.arange(len(terms), dtype=np.int32)  # of queries that share a term, any one's place
        keys = query * len(terms) + self.slot[terms]
        if len(self.weights) < (int(query[-1]) + 1) * len(terms):
            self.weights = np.zeros((int(query[-1]) + 1) * len(terms))
        self.weights[keys] = weight
        wide, exact = doc_at[d + 1] - doc_at[d], np.zeros(len(q))
        for i, j in _parts(wide):
            post, of = _spans(doc_at[d[i:j]], wide[i:j]), np.repeat(np.arange(j - i), wide[i:j])
            slot = self.slot[doc_term[post]]
            hit = np.flatnonzero(slot >= 0)
            post, of = post[hit], of[hit]
            exact[i:j] = np.bincount(of, doc_score[post] * self.weights[q[i:j][of] * len(terms) + slot[hit]], minlength=j - i)
        self.weights[keys] = 0
        self.slot[terms] = -1
        return exact

    def rows(self) -> pa.RecordBatch:
        query, at = np.nonzero(self.best[0] > 0)
        return pa.RecordBatch.from_pydict({
            "_query": pa.array(np.array(self.ids, np.int64)[query]), "_id": pa.array(self.best[1][query, at]), "score": pa.array(self.best[0][query, at]),
        })


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", query_col: str = "query_id") -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query by BM25.

    ``docs`` has (doc_id, text), ``queries`` (query_id, text). Words are runs of
    characters other than ASCII white space, A-Z lowered. Equal scores are ranked
    by the smaller doc_id, NULL ids first. A query without words, or without any
    matching document, has no rows; documents without words are never found but
    count in the statistics. Rows may repeat: each is a document or query of its
    own. Empty tables give an empty table.
    """
    packed = vectors(docs, id_col)
    asked = saved(vectors(queries, query_col).filter("length > 0").withColumn("_query", F.monotonically_increasing_id()), "bm25-queries")
    queried, held = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("terms") / 8)).first()
    query_blocks = max(1, -(-queried // QUERY_BLOCK), -(-int(held or 0) // BLOCK_TERMS))

    wanted = term_rows(asked).select("kind", "term").distinct()
    totals = term_rows(packed).groupBy("kind", "term").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))
    df = saved(totals.join(wanted, ["kind", "term"]), "bm25-df")
    stats = df.filter("kind = 1").select("df", "words").first()
    count, mean = (stats[0], stats[1] / stats[0]) if stats else (0, 0.0)
    df = df.filter("kind = 0").select("term", "df")
    shards = min(SHARDS, max(1, -(-count // SHARD_DOCS)))
    spread = asked.withColumn("_block", F.pmod(F.xxhash64("_query"), F.lit(query_blocks)).cast("int"))

    # Frequencies are counted by eighths of a power of two; the common terms are as many of the upper steps as fit.
    step = F.floor(F.log2("df") * 8).cast("int")
    steps = sorted(df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    fit = [row.step for row, total in zip(steps, np.cumsum([row.n for row in steps]), strict=True) if total <= COMMON]
    top = df.filter(step >= fit[-1]).collect() if fit else []
    common = np.array([row.term for row in top], np.int64).view(np.uint64)
    common_df = np.array([row.df for row in top], "<u8")[np.argsort(common)]
    common = np.sort(common)

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs, times = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            n = np.array([len(b) // 8 for b in blobs])
            yield pa.RecordBatch.from_pydict({
                "_block": batch.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))), "_query": batch.column(1).take(pa.array(np.repeat(np.arange(len(n)), n))),
                "term": pa.array(np.frombuffer(b"".join(blobs), "<i8")), "weight": pa.array(np.frombuffer(b"".join(times), "<u4").astype(np.int32)),
            })

    # A row for each query term with its global frequency, gathered by query.
    terms = spread.select("_block", "_query", "terms", "counts").mapInArrow(released(exploded), "_block int, _query bigint, term bigint, weight int")
    weighed = terms.join(df, "term").groupBy("_block", "_query").agg(F.collect_list(F.struct("term", "weight", "df")).alias("own"))

    def parted(term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number among common terms, whether it is one) of each term."""
        at = np.searchsorted(common, term)
        return at, common[np.minimum(at, len(common) - 1)] == term if len(common) else np.zeros(len(term), bool)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[bytes]] = [[], [], [], [], []]
            for row in batch.column(2).to_pylist():
                own = np.array(sorted((t["term"] & (2 ** 64 - 1), t["weight"], t["df"]) for t in row), dtype=QUERY_TERM)
                at, is_common = parted(own["term"])
                rest = own[~is_common]
                for column, value in zip(columns, (at[is_common].astype("<u2"), own["weight"][is_common], rest["term"], rest["weight"], rest["df"]), strict=True):
                    column.append(value.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.binary()) for c in columns]], ["_block", "_id", *PACKED, "dfs"])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[bytes]] = [[], [], [], []]
            for blob, counts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                term, times = np.frombuffer(blob, "<u8"), np.frombuffer(counts, "<u4")
                at, is_common = parted(term)
                for column, value in zip(columns, (at[is_common].astype("<u2"), times[is_common], term[~is_common], times[~is_common]), strict=True):
                    column.append(value.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.binary()) for c in columns]], ["_id", "length", *PACKED])

    blobs = ", ".join(f"{name} binary" for name in PACKED)
    ready = saved(weighed.mapInArrow(released(pack), f"_block int, _id bigint, {blobs}, dfs binary"), "bm25-weights")
    rows = packed.filter("length > 0").mapInArrow(released(coded), f"_id bigint, length bigint, {blobs}")
    shard = F.pmod(F.xxhash64("_id", "common", "rare"), F.lit(shards))
    # Every shard meets every block of queries; a unit's queries come before its documents.
    unit = lambda block, of: (F.col(block) * shards + of).cast("int").alias("_unit")
    left = rows.withColumn("_shard", shard).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))).select(
        unit("_block", F.col("_shard")), F.lit(1).alias("_kind"), "_id", "length", *PACKED, F.lit(None).cast("binary").alias("dfs")
    )
    right = ready.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        unit("_block", F.col("_shard")), F.lit(0).alias("_kind"), "_id", F.lit(0).cast("bigint").alias("length"), *PACKED, "dfs"
    )
    dense, chunk = DENSE, SHARD_DOCS

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, asked, docs, size, block = None, [], [], 0, None
        for batch in sliced(batches):
            for own, kind, row_id, length, *blobs, dfs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own != unit:
                    if docs:
                        block.meet(docs)
                    if block:
                        yield block.rows()
                    unit, asked, docs, size, block = own, [], [], 0, None
                if kind == 0:
                    asked.append((row_id, *blobs, dfs))
                elif asked or block:
                    if not block:
                        block, asked = Block(asked, common_df, dense, count, mean, k), []
                    docs.append((row_id, length, *blobs))
                    size += len(blobs[0]) // 2 + len(blobs[2]) // 8
                    if len(docs) >= chunk or size >= CHUNK_TERMS:
                        block.meet(docs)
                        docs, size = [], 0
        if docs:
            block.meet(docs)
        if block:
            yield block.rows()

    units = left.unionByName(right).repartition("_unit").sortWithinPartitions("_unit", "_kind")
    found = units.mapInArrow(released(best), "_query bigint, _id bigint, score double")
    order = Window.partitionBy("_query").orderBy(F.col("score").desc(), F.col("_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = asked.select("_query", real_id("_id").alias("query_id"))
    return ranked.join(names, "_query").select("query_id", "rank", real_id("_id").alias("doc_id"), "score")
