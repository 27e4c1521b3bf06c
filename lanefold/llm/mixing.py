"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is dealt by hash into blocks, which puts its documents in random order. A target of
q times the source's size is met by floor(q) passes over all its blocks and one pass over the first
blocks, up to the block in which the rest of the target ends; of that block the first documents are
taken, as many as fit the rest. The number of block draws of every source is then split among the output
shards: at each node of a binary tree over the shards, the left half gets a multivariate
hypergeometric draw of the node's counts, so all counts stay exact and no shard sees another's
randomness. A shard takes the next blocks of each source's permuted sequence, as many as it was
dealt, so the shards' draws are disjoint, and shuffles its documents locally.

The driver sees one row a source: its name and number of draws. The tree is split in tasks, one for
each subtree, which walks down from the root by the same seeded draws; it gives a range of draws for
each (source, shard), and draws and blocks meet by a join. Blocks grow in size with the corpus, so
there are at most ``MOST_BLOCKS`` of them and one more for each source; shards are no smaller than blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanefold.llm._common import apart, back, load, written

#: Fixed value: a word of the contract.
WORD = r"[^\x20\x09-\x0D]+"
MOST_BLOCKS = 1 << 20
#: Levels of the tree that every task walks down; below them a task has a subtree of its own.
TOP_LEVELS = 8


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """source, source_size, target from (source, source_size): shares of the total by weight, none above cap x size.

    Weights repeat along the sources in code point order, null last. With sources ordered by cap per
    weight, the level at which the k-th and all later ones are filled evenly rises until the first that
    isn't capped; the highest level is the solution that resharing the excess again and again arrives at.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    t = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * float(cap))
    ordered = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(ordered), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(ordered), F.lit(0.0)))
    t = t.withColumn("level", level)
    return t.withColumn("target", F.least("cap", F.max("level").over(every) * F.col("w"))).select("source", "source_size", "target")


def halve(held: np.ndarray, lo: int, hi: int, seed: int) -> np.ndarray:
    """What the left half of the shards lo to hi gets of the counts ``held``: a multivariate hypergeometric draw."""
    total = int(held.sum())
    room = total * ((lo + hi) // 2 - lo) // (hi - lo)
    return np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(held, room, method="marginals") if total else held


def subtree(counts: np.ndarray, shards: int, seed: int, path: int, levels: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """shard, first draw and number of draws of each source, for the shards below the node that the bits of ``path`` lead to."""
    lo, hi, held, before = 0, shards, np.asarray(counts, np.int64), np.zeros(len(counts), np.int64)
    for level in range(levels):
        right = path >> (levels - 1 - level) & 1
        if hi - lo == 1:  # a leaf above this level belongs to the leftmost path below it
            if right:
                return
            continue
        left = halve(held, lo, hi, seed)
        if right:
            before, held, lo = before + left, held - left, (lo + hi) // 2
        else:
            held, hi = left, (lo + hi) // 2
    todo = [(lo, hi, held, before)]
    while todo:
        lo, hi, held, before = todo.pop()
        if hi - lo == 1:
            yield lo, before, held
            continue
        left = halve(held, lo, hi, seed)
        todo += [((lo + hi) // 2, hi, held - left, before + left), (lo, (lo + hi) // 2, left, before)]


def split_draws(spark: SparkSession, counts: list[int], shards: int, seed: int) -> DataFrame:
    """k, shard, draw: the shard of every draw of the k-th source; shards' numbers of draws differ by the tree's depth at most."""
    levels = min(TOP_LEVELS, max(shards - 1, 0).bit_length())
    held = np.asarray(counts, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("id").to_pylist():
                for shard, first, n in subtree(held, shards, seed, path, levels):
                    k = np.flatnonzero(n)
                    cols = [pa.array(k), pa.array(np.full(len(k), shard)), pa.array(first[k]), pa.array(first[k] + n[k] - 1)]
                    yield pa.RecordBatch.from_arrays(cols, names=["k", "shard", "first", "last"])

    ranges = spark.range(0, 1 << levels, 1, 1 << max(0, levels - 3)).mapInArrow(run, "k long, shard long, first long, last long")
    return ranges.select("k", F.col("shard").cast("int").alias("shard"), F.explode(F.sequence("first", "last")).alias("draw"))


def _marked(docs: DataFrame, seed: int, id: str, text: str) -> DataFrame:
    return docs.withColumn("_size", word_count(F.col(text))).withColumn("_h", F.xxhash64(F.lit(seed), F.col(id), F.col(text)))


def _block(n: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), "_h"), n)


def _taken(fills: Column) -> Column:
    """Whether any round of filling takes the document: it fits what was left, and comes by hash no later than the last that did."""
    return F.exists(fills, lambda f: (F.col("_size") <= f["left"]) & (F.col("_h") <= f["cut"]))


def plan_blocks(slim: DataFrame, weights: tuple[float, ...], cap: float, block_words: int, shard_words: int, seed: int) -> DataFrame:
    """One row a (source, block): source_size, target, blocks, shards of the whole draws, shard of a partial draw and how it is filled."""
    spark = slim.sparkSession
    sizes = written(slim.groupBy("source").agg(F.sum("_size").alias("source_size")), "sizes")
    targets = written(source_targets(sizes, weights, cap), "targets")
    total = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    step = max(block_words, total // MOST_BLOCKS + 1)
    targets = targets.withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / step), F.lit(1)))
    targets = targets.withColumn("passes", F.coalesce(F.floor(F.try_divide("target", "source_size") + 1e-12), F.lit(0)).cast("long"))
    targets = targets.withColumn("rest", F.greatest(F.col("target") - F.col("passes") * F.col("source_size"), F.lit(0.0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    rows = slim.join(targets, same(slim, targets)).select(slim["source"], "_size", "_h", _block(F.col("blocks")).alias("block"), "rest")
    sums = rows.groupBy("source", "block").agg(F.sum("_size").alias("words"))
    all_blocks = targets.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sums = all_blocks.join(sums.select(F.col("source").alias("s"), F.col("block").alias("b"), "words"), F.expr("source <=> s and block = b"), "left").drop("s", "b")
    before = F.sum(F.coalesce("words", F.lit(0))).over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("before", F.coalesce(before, F.lit(0)))
    whole = F.col("before") + F.coalesce("words", F.lit(0)) <= F.col("rest") + 1e-9
    sums = sums.withColumns({"whole": whole, "left": F.when(~whole & (F.col("before") < F.col("rest")), F.col("rest") - F.col("before"))})
    sums = written(sums, "blocks")
    # Where the rest ends inside a block: documents in order of their hash as long as they fit, then
    # again those of the others that fit into what is left.
    ends = sums.filter("left is not null").select(F.col("source").alias("s"), F.col("block").alias("b"), "left", F.array().cast("array<struct<left:double,cut:bigint>>").alias("fills"))
    inside = written(rows.join(ends.select("s", "b"), F.expr("source <=> s and block = b")).select("s", "_size", "_h"), "ends")
    filled = None
    while True:
        ends = ends.withColumnRenamed("s", "e")
        open_ = inside.join(ends, F.expr("s <=> e")).filter((F.col("_size") <= F.col("left")) & ~_taken(F.col("fills")))
        upto = F.sum("_size").over(Window.partitionBy("s").orderBy("_h"))
        fit = open_.withColumn("upto", upto).filter(F.col("upto") <= F.col("left")).groupBy("s").agg(F.max("_h").alias("cut"), F.max("upto").alias("got"))
        ends = ends.join(fit, F.expr("e <=> s"), "left").select(
            F.col("e").alias("s"), "b", (F.col("left") - F.coalesce("got", F.lit(0))).alias("left"),
            F.when(F.col("cut").isNotNull(), F.array_append("fills", F.struct("left", "cut"))).otherwise(F.col("fills")).alias("fills"),
        )
        ends = written(ends, "ends")
        now = ends.agg(F.sum(F.size("fills"))).first()[0]
        if now == filled:  # in no source does any other document fit
            break
        filled = now
    planned = sums.drop("left").join(ends.select("s", "b", "fills"), F.expr("source <=> s and block = b and size(fills) > 0"), "left").drop("s", "b")
    planned = planned.withColumn("draws", F.col("passes") + F.when(F.col("whole") | F.col("fills").isNotNull(), 1).otherwise(0))
    planned = written(planned, "draws")
    counts = planned.groupBy("source").agg(F.sum("draws").alias("n"), F.first("blocks").alias("blocks")).orderBy(F.col("source").asc_nulls_last()).collect()
    shards = max(1, -(-int(total) // max(shard_words, step)))
    numbered = spark.createDataFrame([(k, r["source"], r["blocks"]) for k, r in enumerate(counts)], "k long, s string, n long")
    # Draw j of a source is block j mod n of pass j div n; the last pass ends with the partly taken block.
    drawn = split_draws(spark, [r["n"] for r in counts], shards, seed).join(numbered, "k")
    drawn = drawn.groupBy("s", F.pmod("draw", "n").alias("b")).agg(F.array_sort(F.collect_list(F.struct("draw", "shard"))).alias("drawn"))
    planned = planned.join(drawn, F.expr("source <=> s and block = b"), "left").drop("s", "b")
    all_shards = F.coalesce(F.transform("drawn", lambda d: d["shard"]), F.array().cast("array<int>"))
    partly = F.col("fills").isNotNull()
    planned = planned.withColumn("shards", F.when(partly, F.slice(all_shards, 1, F.greatest(F.size(all_shards) - 1, F.lit(0)))).otherwise(all_shards))
    planned = planned.withColumn("part", F.when(partly, F.get(all_shards, F.size(all_shards) - 1)))
    return written(planned.select(F.col("source").alias("p_source"), "block", "blocks", "source_size", "target", "shards", "part", "fills"), "plan")


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, block_words: int = 100_000, shard_words: int = 4_000_000, seed: int = 42, id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target and ``shards``: the output shard of each time the mix takes the document.

    Null texts have size 0; null sources are one source, last in order. Repeated rows are dealt
    alike and each counts. An empty table gives an empty table. Columns of ``docs`` with the
    new names are replaced; rows stay one for one. The seed decides the outcome, so reruns agree.
    """
    safe, names = apart(docs)
    made = ["size", "source_size", "target", "shards"]
    return back(_planned(safe, weights, cap, block_words, shard_words, seed, names[id], names[source], names[text]), names, made)


def _planned(kept: DataFrame, weights: tuple[float, ...], cap: float, block_words: int, shard_words: int, seed: int, id: str, source: str, text: str) -> DataFrame:
    """``plan_mix`` of a table under names of its own."""
    slim = _marked(kept.select(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text")), seed, "id", "text")
    slim = written(slim.select("source", "_size", "_h"), "slim")
    plan = plan_blocks(slim, weights, cap, block_words, shard_words, seed)
    blocks = plan.groupBy("p_source").agg(F.first("blocks").alias("_n")).withColumnRenamed("p_source", "_s")
    rows = _marked(kept, seed, id, text)
    rows = rows.join(blocks, rows[source].cast("string").eqNullSafe(blocks["_s"])).withColumn("_block", _block(F.col("_n")))
    plan = plan.select(*[F.col(c).alias(f"_p_{c}") for c in plan.columns])
    rows = rows.join(plan, (F.col("_s").eqNullSafe(F.col("_p_p_source"))) & (F.col("_block") == F.col("_p_block")))
    partial = F.coalesce(_taken(F.col("_p_fills")), F.lit(False))
    drawn = F.when(partial, F.array_append("_p_shards", F.col("_p_part"))).otherwise(F.col("_p_shards"))
    return rows.select(*kept.columns, F.col("_size").alias("size"), F.col("_p_source_size").alias("source_size"), F.col("_p_target").alias("target"), drawn.alias("shards"))


def _drawn(docs: DataFrame, seed: int = 42, id: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, block_words: int = 100_000, shard_words: int = 4_000_000) -> tuple[DataFrame, dict[str, str]]:
    safe, names = apart(docs)
    rows = _planned(safe, weights, cap, block_words, shard_words, seed, names[id], names[source], names[text])
    rows = rows.select(*names.values(), F.posexplode("shards").alias("_draw", "shard"))
    rows = rows.withColumn("position", F.xxhash64(F.lit(seed), "_draw", F.col(names[id]), F.col(names[text]))).drop("_draw")
    return rows.repartition("shard").sortWithinPartitions("shard", "position"), names


def mix(docs: DataFrame, **params) -> DataFrame:
    """The mixed documents, a row for each draw, with ``shard`` and ``position`` (order inside the shard) added, which replace columns of these names.

    Documents that the mix doesn't take are missing, those taken twice are there twice. For parameters see ``plan_mix``.
    """
    return back(*_drawn(docs, **params), ["shard", "position"])


def mixed(docs: DataFrame, **params) -> DataFrame:
    """``mix`` in the documents' own columns."""
    return back(*_drawn(docs, **params))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and the words taken, of every document."""
    plan = plan_mix(load(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))
