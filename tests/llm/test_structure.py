"""Centroid clusters, Merkle manifests and main text of pages."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from notemill.llm import centroids, extraction, manifest, queries
from tests.llm.brute import CLASHES, ODD, SCHEMA, generated, odd_documents


def lloyd(rows, k, rounds, seed):
    """(id, vector) -> cluster and distance of each, centroids; by definition."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[1]))
    centres = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in rows]
        for j in range(len(centres)):
            members = [v for (_, v), c in zip(rows, own) if c == j]
            if members:
                centres[j] = [sum(x) // len(members) for x in zip(*members)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in rows), key=repr), centres


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clusters_equal_plain_rounds(spark, seed):
    r = random.Random(seed)
    heads = [[r.uniform(-2, 2) for _ in range(4)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.2 * seed) for x in heads[r.randrange(5)]]) for i in range(400)]
    rows += [(i % 20, rows[i][1]) for i in range(40)] + [(500, [0.0] * 4)] * 30 + [(None, rows[0][1]), (None, [9.0] * 4)]
    found, centres, scans = centroids.cluster(vectors_of(spark, rows).repartition(5), k=6, rounds=7, seed=seed, dim=4, block=64)
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want, want_centres = lloyd(whole, 6, 7, seed)
    assert centres == want_centres
    assert sorted(((x.vec_id, x.cluster, x.distance) for x in found.collect()), key=repr) == want
    assert scans[0] == len(rows) and sum(scans[1:]) < len(rows) * (len(scans) - 1)


def test_loosening_bounds_every_point_of_the_sphere_and_is_less_than_drift():
    rng = np.random.default_rng(4)
    less = 0
    for _ in range(300):
        before = rng.normal(0, 100, (4, 3))
        after = before + rng.normal(0, 20, (4, 3))
        radius = rng.uniform(0, 60, 4)
        got, drift = centroids.loosening(before, after, radius), np.sqrt(((after - before) ** 2).sum(axis=1))
        for i in range(4):
            way = rng.normal(0, 1, (200, 3))
            x = before[i] + way / np.sqrt((way ** 2).sum(axis=1, keepdims=True)) * radius[i] * rng.uniform(0, 1, (200, 1)) ** 0.2
            others = [j for j in range(4) if j != i]
            shrunk = max((np.sqrt(((x - before[j]) ** 2).sum(axis=1)) - np.sqrt(((x - after[j]) ** 2).sum(axis=1))).max() for j in others)
            assert shrunk <= got[i] + 1e-9 and got[i] <= drift[others].max() * (1 + 1e-12)
            less += got[i] < 0.9 * drift[others].max()
    assert less > 300


def test_cluster_table_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 0.0]), (6, [inf, 0.0]), (7, []), (8, [0.0, 0.0]), (None, [1.0, 2.0])]
    table = vectors_of(spark, rows).withColumns({c: F.lit(1) for c in (*CLASHES, "_x", "cluster", "distance", "at")})
    found, centres, _ = centroids.cluster(table, k=8, rounds=3, dim=2)
    assert len(centres) == 3
    assert sorted(((r.vec_id, r.distance) for r in centroids.with_inertia(found, centres).collect()), key=repr) == [(1, 0), (8, 0), (None, 0)]
    for none in (table.limit(0), table.filter("vec_id = 2")):
        empty, centres, _ = centroids.cluster(none, dim=2)
        assert centroids.with_inertia(empty, centres).collect() == []
    with pytest.raises(Exception, match="lies beyond"):
        centroids.cluster(vectors_of(spark, [(1, [1e30, 0.0])]), dim=2)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(row, path_of):
    """Top of one tree; appends to ``path_of[i]`` what is left and right of leaf i's ancestors."""
    groups = [[i] for i in range(len(row))]
    while len(row) > 1:
        for start in range(0, len(row), 3):
            run = row[start:start + 3]
            for k in range(len(run)):
                for i in groups[start + k]:
                    path_of[i].append((run[:k], run[k + 1:]))
        groups = [sum(groups[i:i + 3], []) for i in range(0, len(row), 3)]
        row = [digest(*row[i:i + 3]) for i in range(0, len(row), 3)]
    return row[0]


def plain_manifest(rows, tampered):
    """Rows of op12 by definition."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r, leaf(*r)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops, paths = [], {}
    for s in order:
        own = sorted(by_source[s], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        by_source[s] = own
        paths[s] = [[] for _ in own]
        tops.append(climb([d for _, d in own], paths[s]))
    over = [[] for _ in tops]
    root = climb(list(tops), over)
    out = []
    for k, s in enumerate(order):
        for (row, d), path in zip(by_source[s], paths[s]):
            whole = path + over[k]
            fold = leaf(*row[:4], row[4].replace("\n", "")) if tampered(row) and row[4] is not None else d
            for left, right in whole:
                fold = digest(*left, fold, *right)
            out.append((row[0], d, tops[k], root, digest(*[x for left, right in whole for x in left + right]), fold, fold == root))
    return sorted(out, key=repr)


def halves(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0


def proved(docs):
    found = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = manifest.proofs(manifest.manifest(manifest.leaves(docs, found)))
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256), "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [10, 1, 4], [1] * 12, [800, 5, 1], [2200]])
def test_manifest_equals_definition(spark, sizes):
    rows = []
    for s, size in enumerate(sizes):
        rows += [(len(rows) + 1, None if s == 1 else f"s{s}é", None if i % 7 == 0 else "en", i, None if i % 11 == 0 else f"line {i}\nmore\n" if i % 2 else f"text {i}") for i in range(size)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert proved(docs.repartition(3)) == plain_manifest(rows, halves)


def test_manifest_table_cases(spark):
    docs = odd_documents(spark).withColumns({"n_chars": F.length("text"), "tree": F.lit(1), "at": F.lit(2), "level": F.lit(3), "digest": F.lit("x")})
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert proved(docs) == plain_manifest(rows, halves)
    assert proved(docs.limit(0)) == []
    copies = [(None, None, None, None, None)] * 900 + [(5, "a", "en", 1, "x\ny")] * 40
    many = spark.createDataFrame(copies, "doc_id long, source string, lang string, n_chars long, text string")
    assert proved(many) == plain_manifest(copies, halves)


def test_manifest_nodes_nest(spark):
    docs = spark.createDataFrame(generated(1000, 3), SCHEMA).withColumn("n_chars", F.length("text"))
    made = manifest.manifest(manifest.leaves(docs))
    nodes = {(n.tree, n.level, n.low): (n.high, n.digest) for n in made.nodes().collect()}
    for (tree, level, low), (high, own) in nodes.items():
        width = 3 ** (level - 1)
        inside = [nodes[tree, level - 1, a] for a in range(low, high, width)] if level > 1 else []
        assert low % (3 * width) == 0 and all(h <= high for h, _ in inside)
        assert level == 1 or own == digest(*[d for _, d in inside])
    assert made.root == max((n for n in nodes.items() if n[0][0] is None), key=lambda n: n[0][1])[1][1]


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a<b) x='</p>';</script></head><body class='has-sidebar'>"
    "<a class=skip-link href=#m>skip</a><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav>"
    "<div id=cookie-notice>We use cookies. <button>OK</button></div>{main}"
    "<div class='sidebar-left'><p>Other things to read, at some length, all of the time.</p></div>"
    "<section><h3>3 Comments</h3><p>I never read such a long and silly text in my life, honestly.</p></section>"
    "<form><label>Mail</label><input name=m></form><footer>&copy; all</footer></body></html>"
)
LONG = "A sentence of many words, which goes on &amp; on &lt;so far&gt;&nbsp;and says little. " * 6
WANT = " ".join("A sentence of many words, which goes on & on <so far> and says little. ".split() * 6)


@pytest.mark.parametrize("main", [
    f"<article><h1>Head</h1><p>{LONG}<p>Short.<aside>pull</aside><div class=comments>{LONG}</div><p>{LONG}</article>",
    f"<main><h1>Head</h1><p>{LONG}</p><p>Short.</p>\n<p>{LONG}</p></main>",
    f"<div id=content><h1>Head</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>",
    f"<div class=page><h1>Head</h1><div class=text><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></div>",
    f"<article><h1>Head</h1><p><b>{LONG}<br><p>Short.</p><!-- <p>no</p> --><p>{LONG}<script>x</script></article>",
])
def test_main_text(main):
    assert extraction.main_text(PAGE.format(main=main)) == f"Head {WANT} Short. {WANT}"


@pytest.mark.parametrize(("source", "want"), [
    ("", ""), ("   ", ""), ("plain text, no tags", "plain text, no tags"), ("<p>a<p>b", "a b"), ("a<b>b</b>c<br>d", "abc d"), ("<!-- open", ""), ("<script>var x", ""),
    ("x < y &lt; z &#233; &eacute; &#x1F600;", "x < y < z é é 😀"), ("<div>a</div>b</body></html>c", "a b c"), ("<p title='a>b'>t</p>", "t"), ("<P CLASS=x>A</P>", "A"),
    ("<html><head><meta charset=x><p>no body tag", "no body tag"), ("<body hidden><p>x", "x"),
    ("<article>a <a href=x>link</a>, b.</article>", "a link, b."), ("<td>1<td>2<tr><td>3", "1 2 3"), ("<p>a   b\t\n</p>", "a b"),
])
def test_small_pages(source, want):
    assert extraction.main_text(source) == want


def test_densities_equal_definition():
    """Characters, tags and densities of every node by walking subtrees one by one."""
    import math

    page = extraction.parse(f"<body><div><p>{LONG}</p><p>x <a href=1>yy</a></p></div><ul><li><a href=1>menu</a></li></ul></body>")
    keep = [True] * len(page.tags)
    got = extraction.densities(page, keep, 1)

    def under(node, top):
        while node > top:
            node = page.parents[node]
        return node == top

    def linked(node):
        while node > 0 and page.tags[node] != "a":
            node = page.parents[node]
        return node > 0

    def numbers(top):
        text = [(n, len("".join(p.split()))) for n, p in page.pieces if p and under(n, top)]
        nodes = [n for n in range(1, len(page.tags)) if n != top and under(n, top)]
        return sum(c for _, c in text), sum(c for n, c in text if linked(n)), len(nodes), sum(linked(n) for n in nodes)

    chars, links, *_ = numbers(1)
    ratio = links / chars
    for top in range(len(page.tags)):
        c, lc, t, lt = numbers(top)
        want = 0.0
        if c:
            base = math.log(math.log(c / ((c - lc) or 1) * (lc or 1) + ratio * c + math.e))
            want = c / (t or 1) * math.log(c / (lc or 1) * (t or 1) / (lt or 1)) / base
        assert math.isclose(got.density[top], want, rel_tol=1e-12), top
        assert math.isclose(got.sums[top], sum(got.density[n] for n in range(1, len(page.tags)) if page.parents[n] == top), rel_tol=1e-12)


def test_extraction_table_cases(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", ""), (3, "w", "<div>" * 20000 + "deep"), (4, "x", "<p>" + "word " * 200000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in (*CLASHES, "n_chars")})
    got = {(r.page_id, r.url, r.text, r.n_chars) for r in extraction.extract(table).collect()}
    assert got == {(1, "u", "a", 1), (None, None, "", 0), (2, "v", "", 0), (3, "w", "deep", 4), (4, "x", ("word " * 200000).strip(), 999999)}
    assert extraction.extract(table).count() == 6 and extraction.extract(table.limit(0)).collect() == []


def test_odd_tables_are_what_they_seem():
    assert len(ODD) == 12 and "op13_density_extraction" in queries.QUERIES
