"""Merkle manifest of a dataset: a tree of digests per source, a tree over the sources, and a proof for every row.

Every node carries the interval [low, high) of leaf ranks it covers, so that
intervals nest like the tree. Ancestors of a leaf are found by containment, and
the siblings of a node are what is left of its parent's interval without its own.

Containment joins work on buckets of levels: a stratum is ``STRATUM`` levels, and
its buckets are the intervals of the nodes at its upper end, ``FAN ** STRATUM``
lower nodes each. Containment in a bucket is equality of ``rank div width``, so it
is a plain equi-join, and no group is larger than a bucket, however many rows a
source has. Going up, buckets give the members of the next stratum; going down,
each bucket gets from the stratum above what lies beside its ancestors and
hands it on to its own members.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.session import saved

FAN = 3
STRATUM = 6
SPAN = FAN ** STRATUM
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree string, bucket bigint, level int, low bigint, high bigint, digest string, size bigint, top boolean"
PATHS = "before array<string>, after array<string>, subroot string"


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def levels_of(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def leaf_digest(*fields: Column) -> Column:
    """sha256 over the fields: ``-`` for NULL, else byte count, a colon and the value."""
    told = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*told), 256)


def tree_key(source: str = "source") -> Column:
    """The name of a source's tree, never NULL; names sort as sources do, NULL first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the rank within its tree by ``order``, and ``size``, the number of rows of its tree.

    Rows are sorted by ranges, so a tree of any size is spread over tasks. Ranks
    are the place inside a task plus the counts of the tasks before, which are one
    row per task and tree. Rows equal in ``order`` are told apart by where they were
    read, so copies don't meet in one range either; they are interchangeable.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "_read"]
    ordered = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("_read")
    placed = saved(ordered.withColumns({"_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}), "manifest-placed")
    own = Window.partitionBy("tree")
    runs = placed.groupBy("_task", "tree").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    runs = runs.withColumns({"_before": F.sum("_rows").over(own.orderBy("_task")) - F.col("_rows"), "size": F.sum("_rows").over(own)}).drop("_rows")
    return placed.join(runs, ["_task", "tree"]).withColumn("at", F.col("_place") - F.col("_first") + F.col("_before")).drop("_task", "_place", "_first", "_before")


def _inner_nodes(members: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one bucket above its members, up to the bucket's own or the tree's top."""
    members = members.sort_values("at")
    tree, first, size = members["tree"].iloc[0], int(members["at"].iloc[0]), int(members["size"].iloc[0])
    digests, width, rows, last = members["digest"].tolist(), 1, [], min(STRATUM, levels_of(size))
    above = 1 if size <= SPAN else -(-size // SPAN)
    if not last:
        rows.append((tree, 0, 0, first, first + 1, digests[0], above, True))
    for level in range(1, last + 1):
        digests = [_hash(digests[i:i + FAN]) for i in range(0, len(digests), FAN)]
        width *= FAN
        rows += [(tree, first // SPAN, level, first + i * width, min(first + (i + 1) * width, size), d, above, level == last) for i, d in enumerate(digests)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in NODES.split(", ")])


@dataclass
class Stratum:
    """Members (tree, at, size, digest, ...) of a stratum and the nodes above them."""

    members: DataFrame
    nodes: DataFrame


def build(members: DataFrame) -> tuple[list[Stratum], DataFrame]:
    """(strata, tops): all nodes of the trees over ``members`` (tree, at, size, digest), and (tree, digest) of each tree's top."""
    strata, tops = [], None
    while True:
        grouped = members.select("tree", "at", "size", "digest").groupBy("tree", F.expr(f"at div {SPAN}L"))
        nodes = saved(grouped.applyInPandas(_inner_nodes, NODES), "manifest-nodes")
        strata.append(Stratum(members, nodes))
        done = nodes.filter("top AND size = 1").select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        members = nodes.filter("top AND size > 1").select("tree", F.col("bucket").alias("at"), "size", "digest")
        if members.isEmpty():
            return strata, tops


def _beside(members: pd.DataFrame, nodes: pd.DataFrame) -> tuple[list[list[str]], list[list[str]], str]:
    """For each member, sorted by rank: what lies left and right of it and of each ancestor within the parent's interval."""
    path = nodes[nodes["level"] < 0].iloc[0]
    size = int(members["size"].iloc[0])
    labelled: dict[int, dict[int, tuple[int, str]]] = {0: {int(a): (int(a) + 1, d) for a, d in zip(members["at"], members["digest"], strict=True)}}
    for level, low, high, digest in nodes.loc[nodes["level"] > 0, ["level", "low", "high", "digest"]].itertuples(index=False):
        labelled.setdefault(int(level), {})[int(low)] = (int(high), digest)
    last = min(STRATUM, levels_of(size))
    known = {low: (list(path["before"]), list(path["after"])) for low in (labelled[last] if last else labelled[0])}
    for level in range(last - 1, -1, -1):
        width, below = FAN ** level, {}
        for low, (high, _) in labelled[level].items():
            start = low - low % (width * FAN)
            end = min(start + width * FAN, size)
            left = "".join(labelled[level][i][1] for i in range(start, low, width))
            right = "".join(labelled[level][i][1] for i in range(high, end, width))
            before, after = known[start]
            below[low] = ([left, *before], [right, *after])
        known = below
    found = [known[int(a)] for a in members["at"]]
    return [b for b, _ in found], [a for _, a in found], path["subroot"]


def _paths(members: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    """(tree, bucket, before, after, subroot) of each member, which is a bucket of the stratum below."""
    if members.empty:
        return pd.DataFrame({c: [] for c in ("tree", "bucket", "before", "after", "subroot")})
    before, after, subroot = _beside(members, nodes)
    return pd.DataFrame({"tree": members["tree"], "bucket": members["at"], "before": before, "after": after, "subroot": subroot})


def _split(text: str) -> list[str]:
    return [text[i:i + 64] for i in range(0, len(text), 64)]


def _proofs(members: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    """Members with their siblings, level by level from left to right, and the root that their claimed digest folds to."""
    if members.empty:
        return pd.DataFrame({c: [] for c in (*members.columns, "siblings", "subroot", "folded_root")})
    before, after, subroot = _beside(members, nodes)
    folded = []
    for digest, lefts, rights in zip(members["claimed"], before, after, strict=True):
        for left, right in zip(lefts, rights, strict=True):
            digest = _hash([left, digest, right])
        folded.append(digest)
    siblings = [[d for left, right in zip(b, a, strict=True) for d in _split(left + right)] for b, a in zip(before, after, strict=True)]
    return members.assign(siblings=siblings, subroot=subroot, folded_root=folded)


def descend(strata: list[Stratum], above: DataFrame, lowest, schema: str) -> DataFrame:
    """Hand down what lies beside the ancestors, stratum by stratum.

    ``above`` has (tree, before, after, subroot) of each tree's top. ``lowest`` is
    applied to the buckets of leaves and returns rows of ``schema``.
    """
    handed = None
    for number in range(len(strata) - 1, -1, -1):
        own = strata[number]
        ended = own.nodes.filter("top AND size = 1").select("tree", "bucket").join(above, "tree")
        paths = ended if handed is None else ended.unionByName(handed)
        inner = own.nodes.filter("level > 0").select("tree", "bucket", "level", "low", "high", "digest")
        right = inner.unionByName(paths.withColumn("level", F.lit(-1)), allowMissingColumns=True)
        grouped = own.members.groupBy("tree", F.expr(f"at div {SPAN}L")).cogroup(right.groupBy("tree", "bucket"))
        if not number:
            return grouped.applyInPandas(lowest, schema)
        handed = saved(grouped.applyInPandas(_paths, f"tree string, bucket bigint, {PATHS}"), "manifest-paths")
    raise AssertionError("build gives one stratum at least")


@dataclass
class Manifest:
    """``strata`` and ``tops`` of the sources' trees, ``over`` those of the tree above them, and its root (None if there are no rows)."""

    strata: list[Stratum]
    tops: DataFrame
    over: list[Stratum]
    root: str | None

    def nodes(self) -> DataFrame:
        """(tree, level, low, high, digest) of every inner node; ``tree`` is NULL above the sources."""
        def labelled(strata: list[Stratum], tree: Column) -> list[DataFrame]:
            out = []
            for number, s in enumerate(strata):
                unit = SPAN ** number
                out.append(s.nodes.filter("level > 0").select(
                    tree.alias("tree"), (F.col("level") + number * STRATUM).alias("level"), (F.col("low") * unit).alias("low"), (F.col("high") * unit).alias("high"), "digest"
                ))
            return out
        every = labelled(self.strata, F.col("tree")) + labelled(self.over, F.lit(None).cast("string"))
        found = every[0]
        for more in every[1:]:
            found = found.unionByName(more)
        return found


def leaves(docs: DataFrame, found_text: Column | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(tree, doc_id, source, digest, claimed): the digest of each row, and of the row with ``found_text`` for its last field."""
    *plain, text = [F.col(c) for c in fields]
    digest = leaf_digest(*plain, text)
    claimed = digest if found_text is None else F.when(found_text.eqNullSafe(text), digest).otherwise(leaf_digest(*plain, found_text))
    return docs.select(tree_key().alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), digest.alias("digest"), claimed.alias("claimed"))


def manifest(rows: DataFrame) -> Manifest:
    """The trees over ``rows`` from :func:`leaves`, ordered by doc_id (NULL first, equal ids by digest)."""
    # The leaf digests are written before they are sorted: sampling for the ranges would hash all texts once more.
    members = saved(ranked(saved(rows, "manifest-leaves"), ["doc_id", "digest"]), "manifest-members")
    strata, tops = build(members)
    tops = saved(tops, "manifest-tops")
    above = ranked(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    over, root = build(saved(above, "manifest-sources"))
    top = root.first()
    return Manifest(strata, tops, over, top["digest"] if top else None)


def proofs(made: Manifest) -> DataFrame:
    """(doc_id, source, leaf, claimed, siblings, subroot, root, folded_root, verified) of every row.

    ``siblings`` is the proof: the digests beside the leaf and each of its ancestors,
    up through the tree of sources. ``folded_root`` is what ``claimed`` and the siblings
    fold to; a row is verified if that is the root. NULL fields are ``-`` in the
    leaf, empty texts ``0:``; a NULL source is a source of its own, first of all.
    Rows that repeat an id, or come as often as you like, are leaves of their own.
    An empty table has no root and gives an empty table.
    """
    start = made.tops.sparkSession.createDataFrame([("", [], [], "")], f"tree string, {PATHS}")
    named = descend(made.over, start, _source_paths, f"name string, {PATHS}")
    paths = saved(named.withColumnRenamed("name", "tree"), "manifest-sources")
    found = descend(
        made.strata, paths, _proofs,
        "tree string, doc_id bigint, source string, digest string, claimed string, size bigint, at bigint, siblings array<string>, subroot string, folded_root string",
    )
    root = F.lit(made.root)
    return found.select(
        "doc_id", "source", F.col("digest").alias("leaf"), "claimed", "siblings", "subroot", root.alias("root"), "folded_root", F.coalesce(F.col("folded_root") == root, F.lit(False)).alias("verified")
    )


def _source_paths(members: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    """(name, before, after, subroot) of each source; its subroot is its digest here."""
    if members.empty:
        return pd.DataFrame({c: [] for c in ("name", "before", "after", "subroot")})
    before, after, _ = _beside(members, nodes)
    return pd.DataFrame({"name": members["name"], "before": before, "after": after, "subroot": members["digest"]})


#: The same manifest in DuckDB. DuckDB has no CRC-32: its lowest bit is worked out bit by bit.
MANIFEST_SQL = """
WITH RECURSIVE marked AS (
    SELECT *, list_reduce(
        [4294967295::BIGINT] || flatten([[(ascii(c) >> b) & 1 for b in range(8)] for c in string_split(doc_id::VARCHAR, '')]),
        lambda s, b: CASE WHEN (s & 1) <> b THEN xor(s >> 1, 3988292384) ELSE s >> 1 END
    ) & 1 = 1 AS tampered FROM documents
), told AS (
    SELECT doc_id, source,
           coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
           text, CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS found
    FROM marked
), leaves AS MATERIALIZED (
    SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(octet_length(encode(found)) || ':' || found, '-')) AS claimed
    FROM told
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER () AS row_id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size FROM leaves
), nodes AS (
    SELECT source, 0 AS level, pos, leaf AS digest, size FROM placed
    UNION ALL
    SELECT source, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (size + 2) // 3 FROM nodes WHERE size > 1 GROUP BY source, level, pos // 3, size
), tops AS MATERIALIZED (
    SELECT source, level, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM nodes WHERE size = 1
), upper AS (
    SELECT 0 AS level, pos, digest, size FROM tops
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (size + 2) // 3 FROM upper WHERE size > 1 GROUP BY level, pos // 3, size
), steps AS MATERIALIZED (  -- every node with what lies left and right of it below its parent
    SELECT n.source, false AS up, n.level, n.pos, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < n.pos), '') AS l,
           coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > n.pos), '') AS r
    FROM nodes n JOIN nodes o ON n.source IS NOT DISTINCT FROM o.source AND n.level = o.level AND n.pos // 3 = o.pos // 3
    WHERE n.size > 1 GROUP BY ALL
    UNION ALL
    SELECT NULL, true, n.level, n.pos, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < n.pos), ''),
           coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > n.pos), '')
    FROM upper n JOIN upper o ON n.level = o.level AND n.pos // 3 = o.pos // 3 WHERE n.size > 1 GROUP BY ALL
), folds AS (
    SELECT row_id, p.source, t.level AS tops_level, t.pos AS top_at, 0 AS turn, p.pos, claimed AS digest, '' AS proof
    FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source
    UNION ALL
    SELECT f.row_id, f.source, f.tops_level, f.top_at, f.turn + 1, CASE WHEN f.turn + 1 = f.tops_level THEN f.top_at ELSE s.pos // 3 END,
           sha256(s.l || f.digest || s.r), f.proof || s.l || s.r
    FROM folds f JOIN steps s ON s.up = (f.turn >= f.tops_level) AND (s.up OR s.source IS NOT DISTINCT FROM f.source)
         AND s.level = CASE WHEN s.up THEN f.turn - f.tops_level ELSE f.turn END AND s.pos = CASE WHEN f.turn = f.tops_level THEN f.top_at ELSE f.pos END
), ends AS (
    SELECT row_id, arg_max(digest, turn) AS folded_root, arg_max(proof, turn) AS proof FROM folds GROUP BY row_id
)
SELECT p.doc_id, p.leaf, t.digest AS subroot, u.digest AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = u.digest AS verified
FROM placed p JOIN tops t ON p.source IS NOT DISTINCT FROM t.source JOIN ends e USING (row_id) CROSS JOIN (SELECT digest FROM upper WHERE size = 1) u
"""
