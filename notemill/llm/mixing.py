"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every source gets a target of words: its share by weight of the whole, not
above ``most`` times its size; what it can't take goes to the others by weight.
Each document of a source then expects ``target / size`` copies. These are
summed up along the source, one random offset is added, and a document is
emitted once for every integer boundary its interval crosses. Documents lie in
order of size, so that those taken are spread evenly over small and large ones
and the words taken come close to the target.

The running sum along a source never meets in one task, not even for a source
or a size that holds a third of all rows. Rows are counted by (source, size,
lot), where the lot is a fixed spread of the id; running counts over sizes and
over lots are small windows; only the place inside a lot is counted on rows.
The expected copies are equal within a source, so places are exact integers
and a rerun gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.session import saved

WORD = r"[^\x20\x09-\x0D]+"
LOTS = 4096
WEIGHTS = (3, 1, 2)
SEED = "mix"


def size_in_words(text: str = "text") -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def lot(doc_id: str = "doc_id") -> Column:
    """A fixed spread of ids over lots, also of ids that come in regular steps. NULL ids lie in lot 0."""
    return F.coalesce(F.pmod(F.pmod(F.col(doc_id), F.lit(1_000_003)) * 7919, F.lit(LOTS)), F.lit(0)).cast("int")


def source_key(source: str) -> Column:
    """The source as a text that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def offset(source: str = "source", seed: str = SEED) -> Column:
    """The random offset in [0, 1) of a source: from a hash of seed and name, so reruns agree."""
    name = F.concat(F.lit(f"{seed}|"), source_key(source))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Weights go round the sources in code point order, NULL last. The water level
    that fills all sources to the wanted total, each not above its cap, is found
    by one pass over the sources in order of cap per weight. One row per source
    lies in each of the two windows without a key.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(turn, F.lit(len(weights))) + 1).cast("int"))
    every = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    level = (F.col("wanted") - (F.col("caps") - F.col("cap"))) / (F.col("all_weights") - (F.col("weights") - F.col("weight")))
    # The first source whose cap is not reached fixes the level for all after it.
    return (
        totals.withColumn("weight", weight)
        .withColumns({"cap": F.col("source_size") * F.lit(float(most)), "wanted": F.sum("source_size").over(every) * F.lit(float(share))})
        .withColumns({"caps": F.sum("cap").over(filled), "weights": F.sum("weight").over(filled), "all_weights": F.sum("weight").over(every)})
        .withColumn("level", level)
        .withColumn("water", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(every)["level"])
        .select("source", "source_size", F.coalesce(F.least(F.col("cap"), F.col("weight") * F.col("water")), F.col("cap")).alias("target"))
    )


def _placed(docs: DataFrame, weights: tuple[int, ...], share: float, most: float, seed: str, *carry: Column) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, *carry) of every row.

    Sizes are counted on a copy without texts; then each row moves once, to its
    (source, size, lot), with what it carries along.
    """
    keys = {"doc_id": F.col("doc_id").cast("bigint"), "source": F.col("source").cast("string"), "size": size_in_words(), "lot": lot(), "key": source_key("source")}
    named = lambda *some: [keys[c].alias(c) for c in some]
    sized = saved(docs.select(*named(*keys)), "mix-sizes")
    by_lot = sized.groupBy("key", "size", "lot").agg(F.count(F.lit(1)).alias("n"))
    before = lambda group, order: F.sum("n").over(Window.partitionBy(*group).orderBy(order)) - F.col("n")
    before_size = by_lot.groupBy("key", "size").agg(F.sum("n").alias("n")).select("key", "size", before(["key"], "size").alias("smaller"))
    starts = (
        by_lot.select("key", "size", "lot", before(["key", "size"], "lot").alias("same")).join(before_size, ["key", "size"])
        .select("key", "size", "lot", (F.col("same") + F.col("smaller")).alias("start"))
    )
    rows, order = sized.drop("source"), ["doc_id"]
    if carry:
        rows, order = docs.select(*named("doc_id", "size", "lot", "key"), F.xxhash64("text").alias("hash"), *carry), ["doc_id", "hash"]
    # Rows move once: the join and the window share the distribution by lot.
    within = F.row_number().over(Window.partitionBy("key", "size", "lot").orderBy(*order)) - 1
    placed = rows.join(starts, ["key", "size", "lot"]).withColumn("place", F.col("start") + within)
    per_doc = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = source_targets(sized, weights, share, most).select(
        source_key("source").alias("key"), "source", "source_size", "target", per_doc.alias("each"), offset("source", seed).alias("shift")
    )
    crossed = F.floor((F.col("place") + 1) * F.col("each") + F.col("shift")) - F.floor(F.col("place") * F.col("each") + F.col("shift"))
    return placed.join(known, "key").withColumn("copies", crossed.cast("bigint"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of every row.

    ``copies`` is how often the mix takes the document. NULL texts have size 0,
    a NULL source is a source of its own, empty documents are counted like any
    other. Repeated rows are rows of their own: they take different places, so
    their copies may differ, but as a group they are the same in each run. An
    empty table gives an empty table.
    """
    return _placed(docs, weights, share, most, seed).select("doc_id", "source", "size", "source_size", "target", "copies")


def taken_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it: every row by its own copies, whatever its id.

    Texts move once. Rows equal in all columns can't be told apart; together they
    come as often as the mix takes them together.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_mix_row")
    taken = _placed(docs, weights, share, most, seed, row).filter("copies > 0")
    return taken.select("_mix_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_mix_row.*")


#: The same mix in DuckDB.
MIX_SQL = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           coalesce(((doc_id % 1000003 + 1000003) % 1000003) * 7919 % {LOTS}, 0) AS lot
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
           [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
           sum(source_size) OVER () * 1.5::DOUBLE AS wanted
    FROM totals
), levels AS (
    SELECT *, (wanted - (sum(cap) OVER f - cap)) / (sum(weight) OVER () - (sum(weight) OVER f - weight)) AS level
    FROM weighed WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)
), targets AS (
    SELECT source, source_size,
           coalesce(least(cap, weight * (SELECT level FROM levels WHERE level * weight <= cap ORDER BY cap / weight, level LIMIT 1)), cap) AS target
    FROM levels
), placed AS (
    SELECT doc_id, s.source, size, source_size, target,
           row_number() OVER (PARTITION BY s.source ORDER BY size, lot, doc_id NULLS FIRST) - 1 AS place,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each,
           ('0x' || substr(md5('{SEED}|' || coalesce('=' || s.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor((place + 1) * each + shift) - floor(place * each + shift)))::BIGINT AS taken
FROM placed
"""
