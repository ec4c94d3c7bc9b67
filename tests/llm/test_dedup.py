"""Repeated strings, SimHash and embedding joins against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from notemill.llm import common, ego, simhash, suffix
from tests.llm.brute import ODD, SCHEMA, components, fingerprint, generated, odd_documents, repeats


def test_repeats_equal_brute_force(spark):
    rows = [*generated(150, 1), (900, "a" * 700, "en", "a"), (901, "a" * 250, "en", "a"), (902, "ab" * 300, "en", "a"), (903, "é" * 120, "en", "a"), (904, "xé" + "é" * 120, "en", "a")]
    got = {r[0]: tuple(r[1:]) for r in suffix.digests(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == repeats([r[:2] for r in rows])


def test_repeats_in_pieces(monkeypatch):
    """Small groups and pieces find the same anchors as whole texts."""
    texts = [t.encode() for _, t, _, _ in generated(60, 2)] + [b"ab" * 2000]
    collected = lambda: sorted((int(n), int(p), int(a), int(m)) for number, at, name, more in suffix.anchor_rows(texts) for n, p, a, m in zip(number, at, name, more, strict=True))
    whole = collected()
    monkeypatch.setattr(suffix, "GROUP", 500)
    monkeypatch.setattr(suffix, "PIECE", 350)
    assert collected() == whole


def test_repeats_table_cases(spark):
    long = "the quick brown fox jumps over the lazy dog and runs away from the angry bear in the dark forest tonight again"
    rows = [(1, long, "en", "a"), (1, long, "en", "a"), (1, "x" + long, "en", "a"), (None, long, "en", "a"), (2, None, None, None), (3, long + "!", "en", "b")]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffix.digests(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    n = len(long)
    assert got == sorted([(None, n, 0), (1, n, n), (1, n, n), (1, n + 1, n), (2, 0, 0), (3, n + 1, n)], key=repr)
    docs = odd_documents(spark)
    left = suffix.without_repeats(docs)
    assert left.columns == docs.columns and left.count() == len(ODD)
    assert suffix.without_repeats(docs.limit(0)).collect() == []


@pytest.mark.parametrize("shared_id", [2, None])
def test_texts_of_one_id_are_told_apart_whatever_their_hashes(spark, shared_id):
    texts = spark.range(250_000).select(F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(s)), 256) for s in "xyz"]).alias("text"))
    a, b = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).filter(F.size("t") > 1).first()["t"][:2]
    rows = [(1, a, "en", "s"), (shared_id, a, "en", "s"), (shared_id, b, "en", "s"), (shared_id, b, "en", "s"), (7, None, "en", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    earlier = shared_id is None  # NULL comes before all others
    got = sorted(((r.doc_id, r.kept_sha256 == hashlib.sha256(b.encode()).hexdigest(), r.n_removed) for r in suffix.digests(docs).collect()), key=repr)
    want = [(1, False, 192 if earlier else 0), (shared_id, False, 0 if earlier else 192), (shared_id, True, 0), (shared_id, True, 0), (7, False, 0)]
    assert got == sorted(want, key=repr)
    left = [(r.doc_id, r.text) for r in suffix.without_repeats(docs).collect()]
    assert sorted(left, key=repr) == sorted([(1, "" if earlier else a), (shared_id, a if earlier else ""), (shared_id, b), (shared_id, b), (7, None)], key=repr)


def test_turns_are_zero_for_single_texts(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, None), (None, "d"), (4, None)], "doc_id long, text string")
    keys = {}
    for r in common.row_key(docs).collect():
        keys.setdefault((r._id, r._text), set()).add(r._turn)
        assert (r._row.doc_id, r._row.text or "") == (None if r._id == common.NULL_ID else r._id, r._text)
    assert keys[1, "a"] == keys[4, ""] == {0} and all(len(v) == 1 for v in keys.values())
    assert len({(i, min(t)) for (i, _), t in keys.items()}) == len(keys)


def test_cut_keeps_whole_characters(spark):
    shared = "".join(chr(0x400 + i) for i in range(60))
    rows = [(1, "a" + shared, "en", "a"), (2, "b" + shared + "c", "en", "a")]
    got = {r.doc_id: r.text for r in suffix.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "a" + shared, 2: "bc"}


def test_streamed_repeats_keep_state_over_batches(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(60)) + f" tail {i}", "en", "a") for i in range(120)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r[0]: tuple(r[1:]) for r in suffix.digests(spark.createDataFrame(rows, SCHEMA).repartition(9)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == repeats([r[:2] for r in rows])


def test_simhash_equals_brute_force(spark):
    rows = generated(250, 4)
    prints = np.array([fingerprint(r[1]) for r in rows], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    want = {r[0]: (f"{int(f):016x}", c) for r, f, c in zip(rows, prints, components([r[0] for r in rows], near), strict=True)}
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    got = {r[0]: (r[1], r[2]) for r in found.select("doc_id", simhash.hex_digits("fp"), "component_id").collect()}
    assert got == want
    left = simhash.one_per_group(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c in want.values()})


@pytest.mark.parametrize("total", [100, 10 ** 5, 10 ** 7, 10 ** 10])
def test_parts_find_every_close_pair(spark, total):
    """Whatever thresholds the plan picks, pairs up to 4 bits apart meet."""
    r = np.random.default_rng(total)
    base = r.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = base.copy()
    for i in range(len(near)):
        for bit in r.choice(64, i % 5, replace=False):
            near[i] ^= np.uint64(1 << int(bit))
    every = np.unique(np.concatenate((base, near)))
    parts = simhash.plan_parts(every, total, 4)
    assert sum(t + 1 for t in parts.limits) == 5
    distinct = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long")
    found = simhash.links(distinct, parts, 4, chunk=16).collect()
    number = {int(x): i for i, x in enumerate(every.view(np.int64))}
    linked = np.zeros((len(every), len(every)), bool)
    for a, b in found:
        linked[number[a], number[b]] = linked[number[b], number[a]] = True
    want = np.bitwise_count(every[:, None] ^ every[None, :]) <= 4
    assert not (linked & ~want).any()
    assert components(range(len(every)), linked) == components(range(len(every)), want)


def test_crowded_value_is_split(spark):
    """A part value that all share is compared in chunks."""
    own = np.arange(300, dtype=np.int64) << 32
    parts = simhash.Parts((0xFFFFFFFF,), (4,))
    parts = simhash.Parts((0xFFFFFFFF, 0xFFFFFFFF << 32), (0, 3))
    distinct = spark.createDataFrame([(int(x),) for x in own], "fp long")
    roots = common.components(simhash.links(distinct, parts, 4, chunk=20)).collect()
    assert {r.root for r in roots} == {0} and len(roots) == 299


def test_simhash_table_cases(spark):
    docs = odd_documents(spark)
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert len(got) == len(ODD)
    zero = [c for _, f, c in got if f == 0]
    assert len(zero) == 4 and set(zero) == {3}
    assert [c for i, _, c in got if i in (1, 2)] == [1, 1, 1]
    left = simhash.one_per_group(docs)
    assert left.columns == docs.columns
    assert [r.doc_id for r in left.collect()].count(1) == 1 and left.filter("doc_id = 2").count() == 0
    assert simhash.near_duplicates(docs.limit(0)).collect() == [] == simhash.one_per_group(docs.limit(0)).collect()


def test_one_row_of_each_group_with_null_and_repeated_ids(spark):
    """Ids tell no rows apart: a third is NULL, others repeat within groups and across them."""
    rows = [(None if i % 3 == 0 else i % 40, *r[1:]) for i, r in enumerate(generated(200, 6))]
    rows += [(None, None, "en", "a"), (None, "", "en", "a"), (7, None, "en", "a"), *rows[:9]]
    prints = np.array([fingerprint(r[1]) for r in rows], np.uint64)
    group = components(range(len(rows)), np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4)
    of_row = {(r[0], r[1]): g for r, g in zip(rows, group, strict=True)}
    least = {g: min((r[0] is None, r[0] or 0) for r, own in zip(rows, group, strict=True) if own == g) for g in set(group)}
    left = simhash.one_per_group(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(of_row[r.doc_id, r.text] for r in left) == sorted(set(group))
    assert all((r.doc_id is None, r.doc_id or 0) == least[of_row[r.doc_id, r.text]] for r in left)
    assert {tuple(r) for r in left} <= set(rows)
    assert sum(r.doc_id is None for r in simhash.one_per_group(odd_documents(spark)).collect()) == 1


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in common.components(chain).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def brute_vectors(rows, least):
    good = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if good[i] and good[j] and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                linked[i, j] = linked[j, i] = a == b or x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least
    low = components([i for i, _ in rows], linked)
    return {i: (int(n), c, c == i) for (i, _), n, c in zip(rows, linked.sum(axis=1), low, strict=True)}


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(0)
    rows = [(i, (np.eye(8)[r.integers(0, 6)] + r.normal(0, 0.12, 8)).tolist()) for i in range(240)]
    rows += [
        (300, None), (301, [0.0] * 8), (302, [1.0, None] + [0.0] * 6), (303, [float("nan")] + [1.0] * 7), (304, [float("inf")] + [1.0] * 7), (305, [1.0, 0.0]),
        (306, [1.0, 0.001]), (307, []), (308, rows[0][1]), (309, rows[0][1]),
    ]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, component_id string, number int")
    got = {r[0]: tuple(r[1:]) for r in ego.near_duplicates(table, 0.95, block=8).collect()}
    assert got == brute_vectors(rows, 0.95)


def test_vector_table_cases(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None)]
    got = sorted((tuple(r) for r in ego.near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, True), (None, 0, None, True)], key=repr)
    assert ego.near_duplicates(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_in_many_groups_are_never_copied(spark, monkeypatch, kind):
    """Groups meet without a shuffle of their vectors, whether they come in one precision or the other; equal digests don't mix vectors up."""
    r = np.random.default_rng(5)
    centres = r.normal(0, 1, (25, 12))
    rows = [(i, (np.float32(centres[r.integers(0, 25)] + r.normal(0, 0.12, 12))).astype(float).tolist()) for i in range(260)]
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, [-0.0] + [1.0] * 11), (503, [0.0] + [1.0] * 11), (504, [0.0] * 12), (505, [1.0, 0.0]), (506, None)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    monkeypatch.setattr(ego, "BLOCKS", 2)
    plans, was = [], ego.joined
    monkeypatch.setattr(ego, "joined", lambda parts, *a: plans.append((parts.count(), was(parts, *a)._jdf.queryExecution().executedPlan().toString())) or was(parts, *a))
    got = {x[0]: tuple(x[1:]) for x in ego.near_duplicates(table, 0.95, block=4).collect()}
    assert got == brute_vectors(rows, 0.95)
    count, plan = plans[0]
    assert count > 20 and not [line for line in plan.split("\n") if "Exchange" in line and "BroadcastExchange" not in line]
    monkeypatch.setattr(ego, "_digest", lambda vector: [F.lit(0), F.lit(0)])
    assert {x[0]: tuple(x[1:]) for x in ego.near_duplicates(table, 0.95, block=4).collect()} == got


def test_close_vectors_are_told_apart_in_doubles():
    """Float32 products that can't tell whether a pair reaches the least cosine give way to double precision."""
    r = np.random.default_rng(6)
    left = r.normal(0, 1, (40, 16))
    other = r.normal(0, 1, (40, 16))
    unit = lambda x: x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    left = unit(left)
    side = unit(other - (other * left).sum(axis=1, keepdims=True) * left)
    cosine = 0.95 + r.choice([-1, 1], (40, 1)) * 10.0 ** -r.integers(8, 13, (40, 1))
    right = cosine * left + np.sqrt(1 - cosine * cosine) * side
    group = lambda number, x: ego.Group(number, 16, np.arange(40).astype("<i8").tobytes(), np.ones(40, "<i8").tobytes(), x.astype("<f8").tobytes(), "<f8", {}, 16)
    found = {(int(x), int(y)) for xs, ys in ego._close(group(0, left), group(1, right), 0.95, np.sqrt(0.1)) for x, y in zip(xs, ys, strict=True)}
    want = unit(left) @ unit(right).T >= 0.95
    assert {(i, i) for i in range(40) if cosine[i, 0] > 0.95} == {x for x in found if x[0] == x[1]} and found == {tuple(map(int, x)) for x in np.argwhere(want)}
