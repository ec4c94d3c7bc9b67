"""Archives, mixing, languages, toxicity and search."""

import collections
import hashlib
import math
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from notemill.llm import bm25, language, mixing, queries, toxicity, warc
from notemill.session import saved, scratch_path
from tests.llm.brute import ODD, SCHEMA, generated, odd_documents

SF = "/root/testdata/sf0.001"


def in_duckdb(sql, **tables):
    db = duckdb.connect()
    for name, rows in tables.items():
        frame = rows.toPandas()  # noqa: F841
        db.execute(f"CREATE TABLE {name} AS SELECT * FROM frame")
    cursor = db.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    cursor = db.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.select(*columns).collect()) == sorted(cursor.fetchall())


def test_archives(spark):
    big, other = "x" * 1500 + "\r\n\r\nWARC/1.1\r\n", "é" * 700
    rows = [
        (1, "http://a/", big), (2, "http://b/\r\nX: y", big), (3, "u", big), (3, "u", big), (4, None, "small"), (5, "u", "small"), (6, "u", None), (None, "u", other), (7, "u", other), (8, "u", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("_digest", "_refers", "record", "payload_bytes")})
    got = sorted((tuple(r) for r in warc.deduplicated(pages).collect()), key=repr)

    def want(page_id, html):
        data = (html or "").encode()
        answer = {big: 3, other: 7}.get(html)
        again = answer is not None and page_id != answer
        return page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", answer if again else None

    assert got == sorted((want(i, h) for i, _, h in rows), key=repr)
    assert warc.deduplicated(pages.limit(0)).collect() == []


def test_archive_is_plain_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", "y" * 1200), (2, "http://b/", "y" * 1200)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(warc.records(pages).coalesce(1), folder)
    import glob
    import gzip

    data = gzip.decompress(b"".join(open(f, "rb").read() for f in glob.glob(f"{folder.removeprefix('file://')}/*.gz")))
    heads = [h for h, _ in warc.parse_archive(data)]
    assert {h["WARC-Type"] for h in heads} == {"response", "revisit"}
    assert all(h["WARC-Payload-Digest"].startswith("sha1:") and len(h["WARC-Payload-Digest"]) == 37 for h in heads)
    assert next(h for h in heads if h["WARC-Type"] == "revisit")["WARC-Refers-To"] == "<urn:page:2>"


def reshared(sizes, weights, share, most):
    """Targets by repeated resharing."""
    want = share * sum(sizes)
    fixed = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = want - sum(fixed.values())
        target = {i: rest * weights[i] / sum(weights[k] for k in free) for i in free}
        over = [i for i in free if target[i] > most * sizes[i]]
        if not over:
            return [fixed.get(i, target.get(i)) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}


def test_targets_equal_resharing(spark):
    sizes = {"a": 100, "b": 1, "c": 5000, "d": 0, "ß": 700, "é": 40, None: 60}
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    order = [*sorted(s for s in sizes if s), None]
    want = reshared([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5, 2.0)
    assert all(math.isclose(got[s], w, rel_tol=1e-9, abs_tol=1e-9) for s, w in zip(order, want, strict=True))


def test_mix_takes_near_target_and_repeats(spark):
    docs = spark.createDataFrame(generated(600, 9), SCHEMA)
    mixed = mixing.mix(docs)
    first, second = (sorted(((tuple(r)) for r in mixing.mix(d).collect()), key=repr) for d in (docs, docs.repartition(7)))
    assert first == second
    for r in mixed.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("w"), F.max("size").alias("m")).collect():
        assert abs(r.t - r.w) <= 2 * r.m
    assert mixed.filter("copies > 2 OR copies < 0").count() == 0
    taken = mixing.taken_documents(docs)
    assert taken.columns == docs.columns and taken.count() == mixed.agg(F.sum("copies")).first()[0]


def test_mix_takes_rows_of_null_and_repeated_ids_by_their_own_copies(spark):
    rows = [(None if i % 3 == 0 else i % 50, *r[1:]) for i, r in enumerate(generated(300, 5))]
    rows += [(None, "one two three", "en", "a")] * 9 + [(3, "one two three", "en", "b")] * 5
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mix(docs)
    taken = mixing.taken_documents(docs)
    assert taken.columns == docs.columns
    words = taken.select("doc_id", "source", mixing.size_in_words().alias("size"))
    got = {tuple(r)[:3]: r.n for r in words.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {tuple(r)[:3]: r.n for r in mixed.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("n")).filter("n > 0").collect()}
    assert got == want
    assert {tuple(r) for r in taken.collect()} <= set(rows)


def test_mix_table_cases(spark):
    docs = odd_documents(spark)
    columns, want = in_duckdb(mixing.MIX_SQL, documents=spark.createDataFrame([(10 ** 6 + i, *r[1:]) for i, r in enumerate(ODD)], SCHEMA))
    got = mixing.mix(spark.createDataFrame([(10 ** 6 + i, *r[1:]) for i, r in enumerate(ODD)], SCHEMA)).withColumn("taken", F.col("size") * F.col("copies"))
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(want)
    mixed = mixing.mix(docs)
    assert mixed.count() == len(ODD)
    assert mixing.taken_documents(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).collect() == []
    none = spark.createDataFrame([(1, None, None, "a"), (2, "", None, None)], SCHEMA)
    assert {r.copies for r in mixing.mix(none).collect()} == {0}


def test_languages(spark):
    rows = []
    for i in range(300):
        lang, words = [("en", ["the", "and", "with", "thing", "rather"]), ("fr", ["le", "avec", "quelle", "toujours", "être"]), ("de", ["der", "über", "schön", "nicht", "wasser"])][i % 3]
        rows.append((i, " ".join(words[(i * k) % 5] for k in range(1, 30)), lang, "s"))
    docs = spark.createDataFrame(rows, SCHEMA)
    filters = language.fit(docs, ~language.held_out())
    got = language.predict(docs, filters).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.filter("lang <> lang_pred").count() == 0
    odd = language.predict(odd_documents(spark), filters).collect()
    assert len(odd) == len(ODD)
    none = {r.doc_id for r in odd if r.lang_pred == "und" and r.score == 0}
    assert {3, 4, 5, 6} <= none and all(0 <= r.score <= 1 for r in odd)
    assert language.predict(docs.limit(0), filters).collect() == []
    empty = language.fit(docs.limit(0), ~language.held_out())
    assert {r.lang_pred for r in language.predict(docs, empty).collect()} == {"und"}


@pytest.mark.parametrize("words", [20, 180, 200, 2000])
def test_more_text_of_a_rare_language_never_costs_its_documents(spark, words):
    import random

    r = random.Random(words)
    make = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(n))
    rows = [(i, make("abcdefgh", 60), "en", "s") for i in range(60)] + [(100, make("ijklmnop", words), "xx", "s"), (101, make("ijklmnop", 60), "xx", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    filters = language.fit(docs, F.col("doc_id") != 101)
    got = {x.doc_id: (x.lang_pred, x.score) for x in language.predict(docs, filters).collect()}
    assert got[100][0] == "xx" and got[100][1] > 0.9
    if words >= 200:
        assert got[101][0] == "xx"


def filters_of(rows):
    """Exact n-gram sets by language."""
    out = {}
    for _, text, lang, _ in rows:
        out.setdefault(lang, set()).update(language.grams([text])[0].tolist())
    return out


def test_filters_answer_as_exact_sets_do_but_for_false_positives(spark):
    """Every n-gram of a language is found; the share of others found is that of the filter's bits."""
    rows = [(i, t, ["en", "fr"][i % 2], "s") for i, (_, t, _, _) in enumerate(generated(80, 6))]
    filters = language.fit(spark.createDataFrame(rows, SCHEMA), F.lit(True))
    sets = filters_of(rows)
    totals = {lang: sum(len(language.grams([t])[0]) for _, t, own, _ in rows if own == lang) for lang in sets}
    assert max(totals.values()) * language.MIN_SHARE <= 1  # so nothing is left out here
    for k, lang in enumerate(filters.languages):
        masks = filters.masks(np.array(sorted(sets[lang]), np.uint64))
        assert ((masks[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).all()
        other = np.array(sorted(set().union(*sets.values()) - sets[lang]), np.uint64)
        found = ((filters.masks(other)[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()
        assert found < 0.05


def test_words_of_any_length_are_one_word():
    base = "z" * (bm25.GROUP + 5)
    texts = [base, "z" * bm25.GROUP + "QQ", base.upper(), f"a {base} b {base}", "z" * bm25.GROUP, "y" * (2 * bm25.GROUP + 1)]
    got = [bm25.word_hashes(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    assert [len(h) for h, _ in got] == [1, 1, 1, 4, 1, 1]
    assert got[0][0][0] == got[2][0][0] == got[3][0][1] == got[3][0][3]
    assert len({int(g[0][0]) for g in (got[0], got[1], got[4], got[5])}) == 4
    assert got[3][1].tolist() == [0, 2, 3 + len(base), 5 + len(base)]
    short = np.frombuffer(b"the cat  sat", np.uint8)
    at = [int(_hash) for _hash in bm25.word_hashes(short)[0]]
    assert at == [int(bm25.word_hashes(np.frombuffer(w, np.uint8))[0][0]) for w in (b"the", b"cat", b"sat")]


def test_filters_hold_every_gram():
    own, _, _ = language.grams(["the quick brown fox", "über größe"])
    many = language.Filters.of({f"l{i:03d}": own for i in range(70)} | {"zz": own[:3]})
    masks = many.masks(own)
    assert masks.shape[0] == 2
    assert ((masks[0] == 2 ** 64 - 1) & (masks[1] & 63 == 63)).all()


def test_segments_are_maximal():
    """The scan equals the definition: no segment can grow or hold a better part, by trying all."""
    import random

    r = random.Random(1)
    for _ in range(300):
        scores = [r.choice([-1.0, -1.0, -1.0, r.uniform(0.5, 3), r.uniform(0.5, 3)]) for _ in range(r.randint(0, 14))]  # no ties

        def split(low, high):
            spans = [(sum(scores[a:b]), -(b - a), a, b) for a in range(low, high) for b in range(a + 1, high + 1)]
            if not spans or max(spans)[0] <= 0:
                return []
            _, _, a, b = max(spans, key=lambda s: (s[0], s[1], -s[2]))
            return [*split(low, a), (a, b), *split(b, high)]

        got = toxicity.maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0], 1.0)
        assert [(s.start, s.end) for s in got] == split(0, len(scores))
        assert all(math.isclose(s.score, sum(scores[s.start:s.end])) for s in got)


def test_toxicity(spark):
    import random

    r = random.Random(2)
    calm = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(500):
        words, toxic = r.choices(calm, k=80), int(i % 6 == 0)
        if toxic:
            words[20:20] = r.choices(["nasty", "vile", "awful"], k=5)
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, toxic))
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([*marks, (0, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert [i for i, t in marks if got[i].predicted != t] == []
    passage = got[6].passages[0]
    assert {"nasty", "vile", "awful"} >= set(rows[6][1].split()[passage.start:passage.stop]) or passage.stop - passage.start <= 8
    odd = toxicity.score(odd_documents(spark), model).collect()
    assert len(odd) == len(ODD) and all(0 <= x.score <= 1 and x.predicted == 0 for x in odd)
    clean = toxicity.clean_documents(docs.withColumn("score", F.lit("s")), model)
    assert {r.doc_id for r in clean.collect()} == {i for i, t in marks if not t} and clean.columns == [*docs.columns, "score"]
    assert toxicity.score(docs.limit(0), model).collect() == []
    silent = toxicity.fit(docs, labels.limit(0), ~toxicity.held_out())
    assert len({r.score for r in toxicity.score(docs, silent).collect()}) == 1


def test_toxic_scores_equal_brute_force(spark):
    import random

    r = random.Random(5)
    rows, marks = [], []
    for i in range(240):
        toxic = int(i % 5 == 0)
        words = r.choices([f"calm{j}" for j in range(40)], k=30) + (r.choices(["vilely", "vileness", "nasty"], k=4) if toxic or i % 37 == 0 else [])
        rows.append((i, " ".join(words), "en", "s"))
        marks.append((i, toxic))
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    sets = [set().union(*[toxicity.units(w) for w in row[1].split()]) for row in rows]
    n = [sum(t == c for _, t in marks) for c in (0, 1)]
    want = {}
    for unit in set().union(*sets):
        y = [sum(unit in s and t == c for s, (_, t) in zip(sets, marks, strict=True)) for c in (0, 1)]
        a = 10 * sum(y) / sum(n)
        odds = [math.log((y[c] + a) / max(n[c] + 10 - y[c] - a, 0.5)) for c in (0, 1)]
        gap = odds[1] - odds[0]
        if y[1] >= 3 and gap >= 1 and gap / math.sqrt(1 / (y[0] + a) + 1 / (y[1] + a)) >= 3:
            want[unit] = gap
    assert want and model.scores.keys() == want.keys() and all(math.isclose(model.scores[u], s) for u, s in want.items())
    # Clean text loses on average, and the extreme-value rate solves its equation.
    calm = [max([want.get(u, 0) for u in toxicity.units(w)]) for row, (_, t) in zip(rows, marks, strict=True) if not t for w in row[1].split()]
    assert math.isclose(model.drift, 0.1 + 2 * sum(calm) / calm.count(0), rel_tol=0.01) and sum(s or -model.drift for s in calm) < 0
    assert math.isclose(sum(math.exp(model.rate * (s or -model.drift)) for s in calm) / len(calm), 1, rel_tol=0.02)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_DOCS", 50)
    monkeypatch.setattr(bm25, "QUERY_BLOCK", 20)
    rows = [*[r[:2] for r in generated(260, 6)], (900, None), (901, ""), (902, "Zebra"), (903, "zebra")]
    asked = [(i, t) for i, t in rows if i % 5 == 0] + [(1, "zebra zebra"), (2, "nowhere"), (3, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    counted = {i: collections.Counter(re.sub(r"[A-Z]", lambda m: m.group().lower(), t or "").split()) for i, t in rows}
    total = len(rows)
    df = collections.Counter(w for c in counted.values() for w in c)
    mean = sum(sum(c.values()) for c in counted.values()) / total
    got = collections.defaultdict(list)
    for r in bm25.search(docs, spark.createDataFrame(asked, "query_id long, text string"), k=7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, round(r.score, 6)))
    want = {}
    for q, text in asked:
        own = collections.Counter((text or "").lower().split())
        scored = []
        for i, c in counted.items():
            size = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(n * math.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + size) for w, n in own.items() if w in c)
            if s > 0:
                scored.append((-round(s, 9), i))
        if scored:
            want[q] = [(i, round(-s, 6)) for s, i in sorted(scored)[:7]]
    assert {q: [d for d, _ in x] for q, x in got.items()} == {q: [d for d, _ in x] for q, x in want.items()}
    assert all(math.isclose(a[1], b[1], abs_tol=2e-6) for q in want for a, b in zip(got[q], want[q], strict=True))
    none = spark.createDataFrame([], "query_id long, text string")
    assert bm25.search(docs, none).collect() == [] == bm25.search(docs.limit(0), spark.createDataFrame(asked, "query_id long, text string")).collect()


@pytest.mark.parametrize("common, dense", [(0, 4), (12, 4), (1 << 16, 1024)])
def test_search_by_few_numbered_terms_in_small_chunks(spark, monkeypatch, common, dense):
    """Common, dense and hashed terms, and copies that fill whole chunks."""
    for name, value in {"COMMON": common, "DENSE": dense, "SHARDS": 2, "SHARD_DOCS": 16, "QUERY_BLOCK": 9}.items():
        monkeypatch.setattr(bm25, name, value)
    r = random.Random(4)
    words = [f"w{j}" for j in range(40)] + [f"Rare{j}" for j in range(300)]
    rows = [(i, " ".join(r.choices(words, weights=[9] * 40 + [1] * 300, k=r.randint(1, 40)))) for i in range(160)]
    rows += [(i, rows[3][1]) for i in range(500, 560)] + [(None, rows[7][1]), (None, rows[7][1])]
    asked = [row for row in rows if row[0] is not None and row[0] % 20 == 0 or row[0] in (3, 7)]
    found = bm25.search(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, text string"), k=5)
    got = collections.defaultdict(list)
    for x in found.orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.doc_id, round(x.score, 6)))
    counted = [(i, collections.Counter(t.lower().split())) for i, t in rows]
    df = collections.Counter(w for _, c in counted for w in c)
    mean = sum(sum(c.values()) for _, c in counted) / len(rows)
    for q, text in asked:
        scored = []
        for i, c in counted:
            size = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(n * math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + size) for w, n in collections.Counter(text.lower().split()).items() if w in c)
            if s > 0:
                scored.append((-round(s, 9), -1 if i is None else i, round(s, 6)))
        want = [(None if i < 0 else i, s) for _, i, s in sorted(scored)[:5]]
        assert [i for i, _ in got[q]] == [i for i, _ in want] and all(math.isclose(a[1], b[1], abs_tol=2e-6) for a, b in zip(got[q], want, strict=True))


def test_search_pieces_and_lists(monkeypatch):
    """A block's lists stay k long whatever the chunks, and small pieces give the same."""
    r = np.random.default_rng(3)

    def packed(n: int) -> list[tuple]:
        out = []
        for _ in range(n):
            term = np.unique(r.integers(0, 30, 12))
            rare = np.unique(r.integers(100, 140, 6)).astype("<u8")
            out.append((term.astype("<u2").tobytes(), r.integers(1, 4, len(term)).astype("<u4").tobytes(), rare.tobytes(), r.integers(1, 4, len(rare)).astype("<u4").tobytes()))
        return out

    asked = [(i, *p, np.full(len(p[2]) // 8, 9, "<u8").tobytes()) for i, p in enumerate(packed(20))]
    docs = [(i, 18, *p) for i, p in enumerate(packed(300))]

    def found(step: int) -> list[dict]:
        block = bm25.Block(asked, np.arange(40, 70, dtype="<u8"), 8, 300, 18.0, 6)
        for at in range(0, 300, step):
            block.meet(docs[at:at + step])
        return block.rows().to_pylist()

    whole = found(300)
    assert len(whole) == 20 * 6
    for name, value in {"PAIRS": 7, "PIECE": 3}.items():
        monkeypatch.setattr(bm25, name, value)
    assert found(25) == whole


@pytest.mark.parametrize("cells", [1, 200, 1 << 19])
def test_exact_scores_are_read_off_a_bounded_table(monkeypatch, cells):
    """Queries that share terms, in runs of any size; the table is empty again after each chunk."""
    monkeypatch.setattr(bm25, "TABLE", cells)
    r = np.random.default_rng(8)

    def packed() -> tuple[dict, tuple]:
        term, rare = np.unique(r.integers(0, 30, 14)), np.unique(r.integers(100, 140, 8)).astype("<u8")
        times = r.integers(1, 4, len(term) + len(rare)).astype("<u4")
        return dict(zip([*term.tolist(), *rare.tolist()], times.tolist(), strict=True)), (term.astype("<u2").tobytes(), times[:len(term)].tobytes(), rare.tobytes(), times[len(term):].tobytes())

    queries, docs = [packed() for _ in range(15)], [packed() for _ in range(120)]
    df = {**{t: 40 + t for t in range(30)}, **dict.fromkeys(range(100, 140), 9)}
    block = bm25.Block([(i, *p, np.full(len(p[2]) // 8, 9, "<u8").tobytes()) for i, (_, p) in enumerate(queries)], np.arange(40, 70, dtype="<u8"), 8, 120, 18.0, 5)
    for at in range(0, 120, 30):
        block.meet([(i, 18, *docs[i][1]) for i in range(at, at + 30)])
        most = max(len(q) for q, _ in queries)
        assert (block.slot == -1).all() and not block.weights.any() and len(block.weights) <= max(cells, most)
    got = collections.defaultdict(list)
    for row in block.rows().to_pylist():
        got[row["_query"]].append((row["_id"], row["score"]))
    for i, (q, _) in enumerate(queries):
        score = lambda d: sum(q[t] * math.log(1 + (120.5 - df[t]) / (df[t] + 0.5)) * d[t] * 2.2 / (d[t] + 1.2) for t in q if t in d)
        want = sorted((-round(score(d), 9), j) for j, (d, _) in enumerate(docs))[:5]
        assert [j for j, _ in got[i]] == [j for _, j in want] and all(math.isclose(a[1], -b[0], abs_tol=1e-8) for a, b in zip(got[i], want, strict=True))


def test_pipeline_equals_plain_stages(spark):
    """Each stage against its plain form, on what the stage before it really gave."""
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from tests.llm.brute import components, fingerprint, repeats

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(saved(stage(spark, seen[-1], SF), "test-stage"))
    assert all(s.columns == docs.columns for s in seen[:-1])
    rows = [{r.doc_id: r for r in s.collect()} for s in seen[:-1]]

    # Toxicity: rows go or stay as they are, and what goes is what the model says.
    assert all(rows[1][i] == rows[0][i] for i in rows[1])
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~toxicity.held_out())
    for i, row in rows[0].items():
        assert (i in rows[1]) == (model.probability(model.evidence(*model.segments(row.text, {}))) < 0.3)

    # One document, the smallest, of each component of near fingerprints.
    ids = sorted(rows[1])
    prints = np.array([fingerprint(rows[1][i].text) for i in ids], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    assert sorted(rows[2]) == sorted(set(components(ids, near)))

    # Repeated strings are cut; characters that lose a byte go.
    want = repeats([(i, r.text) for i, r in rows[2].items()])
    assert sorted(rows[3]) == sorted(rows[2])
    for i, row in rows[3].items():
        size, removed, _, _ = want[i]
        assert row.n_chars == len(row.text) and size - removed - 6 * want[i][2] <= len(row.text.encode()) <= size - removed
        assert removed or row.text == rows[2][i].text

    # The mix, by its SQL.
    columns, mixed = in_duckdb(mixing.MIX_SQL, documents=seen[3])
    taken = {r[columns.index("doc_id")]: (r[columns.index("taken")], r[columns.index("size")]) for r in mixed}
    count = collections.Counter(r.doc_id for r in seen[4].select("doc_id").collect())
    assert all(n * count.get(i, 0) == t for i, (t, n) in taken.items())

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in seen[5].dropDuplicates(["doc_id"]).collect():
        ids = library.encode(rows[3][row.doc_id].text, add_special_tokens=False).ids
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(rows[3][row.doc_id].text.encode()).hexdigest()
    assert seen[5].count() == sum(count.values()) == corpus_pipeline.run(spark, SF).count()
