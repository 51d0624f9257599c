"""Mixing sources to target weights by the cube method.

Every source has a target number of words. A document of a source is wanted `m = target / source words` times: the
whole part of `m` copies are certain and its fraction is an inclusion probability. The flight phase moves the
probabilities of a block of documents through the null space of the two balancing equations (words and documents): the
longest open document goes up or down, all shorter ones give way a little, and each step settles at least one. A block
keeps its shortest documents open; what is left of all blocks forms the next, far smaller round, until each source is
one block, where a dozen of the shortest documents stay open. The landing phase settles these with the least error in
words of all their outcomes.

A block is chosen by a hash of the document, so a source of any size is split evenly. Random numbers are seeded by
source, round and block: reruns agree.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.llm import _common as C

WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3.0
BLOCK = 4096
#: Open documents that a block leaves to the next round.
LEFT = 32
#: Open documents of a source that the landing settles: all their outcomes are compared.
LANDED = 12
TINY = 1e-9


def flight(sizes: np.ndarray, probs: np.ndarray, rng: random.Random, leave: int = 2) -> np.ndarray:
    """Move `probs` in place, keeping sum(p) and sum(size * p), until at most `leave` are fractional; returns their places.

    sizes is in falling order. Where the open documents can't keep both sums, words alone are kept.
    """
    live = np.flatnonzero((probs > TINY) & (probs < 1 - TINY))
    while len(live) > max(leave, 1):
        a, p = sizes[live].astype(float), probs[live]
        u = np.zeros(len(live))
        u[0], x, w = 1.0, a[1:], p[1:] * (1 - p[1:])
        s0, s1, s2 = w.sum(), (w * x).sum(), (w * x * x).sum()
        det = s0 * s2 - s1 * s1
        if det > 1e-9 * s0 * s2:
            u[1:] = -w * ((s2 - s1 * a[0]) / det + x * (s0 * a[0] - s1) / det)
        elif a[0] > 0 and s2 > 0:
            u[1:] = -w * x * a[0] / s2
        with np.errstate(divide="ignore"):
            room = np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)), np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf))
        up, down = room[0].min(), room[1].min()
        p += u * (up if rng.random() * (up + down) < down else -down)
        p[p < TINY], p[p > 1 - TINY] = 0.0, 1.0
        probs[live] = p
        live = live[(p > 0) & (p < 1)]
    return live


def land(sizes: np.ndarray, probs: np.ndarray, held: np.ndarray) -> None:
    """Settle the last fractions: of all their outcomes, that with the least error in words, then in documents."""
    outcomes = (np.arange(1 << len(held))[:, None] >> np.arange(len(held)) & 1).astype(float)
    words = np.abs(outcomes @ sizes[held] - sizes[held] @ probs[held])
    docs = np.abs(outcomes.sum(axis=1) - probs[held].sum())
    probs[held] = outcomes[np.lexsort((docs, np.round(words, 6)))[0]]


def _move(seed: int, last: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "_id"], ascending=[False, True], kind="stable").reset_index(drop=True)
        sizes, probs = pdf["size"].to_numpy(), pdf["p"].to_numpy(copy=True)
        held = flight(sizes, probs, random.Random(f"{seed}/{pdf['_rank'].iat[0]}/{pdf['_block'].iat[0]}"), LANDED if last else LEFT)
        if last:
            land(sizes, probs, held)
        pdf["p"] = probs
        return pdf

    return run


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: _rank (by code point, null last), n_docs, source_size, target.

    target = min(level * weight, most * source_size), the level being such that all targets add up to all words: each
    pass caps the sources above their limit and shares what is left among the others, as often as that caps another.
    """
    spark = sizes.sparkSession
    per = C.stage(sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size")))
    # Places within ranges of sources, after the sources of the ranges before: the number of sources is not bounded by one task.
    order = F.col("source").asc_nulls_last()
    dealt = C.stage(per.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), order).withColumn("_part", F.spark_partition_id()))
    before = dealt.groupBy("_part").agg(F.count("*").alias("n"))
    before = before.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    per = C.stage(dealt.withColumn("_place", place).join(before, "_part").withColumn("_rank", F.col("_place") + F.col("_before")).drop("_part", "_place", "_before"))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", weight)
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while total:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("_w") >= most * F.col("source_size")
        got = per.agg(F.sum(F.when(capped, most * F.col("source_size"))).alias("cap"), F.sum(F.when(~capped, F.col("_w"))).alias("w")).first()
        if not got["w"]:
            break
        new = (total - (got["cap"] or 0.0)) / got["w"]
        if level is not None and new <= level:
            break
        level = new
    target = F.least(F.lit(level or 0.0) * F.col("_w"), most * F.col("source_size"))
    return C.stage(per.withColumn("target", target).drop("_w"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = 7, block: int = BLOCK, key: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of `docs` (doc_id, text, source; other columns are ignored).

    A document without words has size 0 and takes 0 words; a null source is a source of its own; equal rows are
    separate documents. An empty table gives an empty result. The result is a table in the shared folder.
    A `key` names a column of `docs` that is carried through as the last one.
    """
    with C.scratch(docs.sparkSession):
        return C.stage(_mix(docs, weights, most, seed, block, [key] if key else []), keep=True)


def _mix(docs: DataFrame, weights: Sequence[float], most: float, seed: int, block: int, carried: list[str]) -> DataFrame:
    sizes = C.stage(docs.select("doc_id", "source", C.n_words("text").alias("size"), *carried))
    per = source_targets(sizes, weights, most)
    known = sizes.withColumn("_s", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source").join(
        per.withColumn("_s", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source"), "_s"
    )
    m = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = known.select(
        *("doc_id", "size", "source_size", "target", "_rank", *carried),
        F.floor(m).alias("_whole"),
        (m - F.floor(m)).alias("p"),
        F.ceil(F.col("n_docs") / block).alias("_blocks"),
        F.xxhash64("doc_id", "size").alias("_id"),
    )
    most_blocks, done, rounds = per.agg(F.max(F.ceil(F.col("n_docs") / block))).first()[0] or 1, [], 0
    while True:
        # Salted with the round, so that each block of a round draws from many of the last.
        units = units.withColumn("_block", F.pmod(F.xxhash64("_id", F.lit(rounds)), F.col("_blocks")))
        last = most_blocks <= 1
        moved = C.stage(units.groupBy("_rank", "_block").applyInPandas(_move(seed + rounds, last), units.schema))
        if last:
            done.append(moved)
            break
        open_ = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(moved.where(~open_))
        units = moved.where(open_).withColumn("_blocks", F.ceil(F.col("_blocks") * LEFT / block)).drop("_block")
        most_blocks, rounds = -(-most_blocks * LEFT // block), rounds + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    taken = (F.col("size") * (F.col("_whole") + F.round("p"))).cast("long")
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), *carried)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(C.table(spark, sf_dir, "documents"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the mix, each as often as it is taken (documents without words are not taken)."""
    # The row key is written, so that both readings of the rows agree on it; ids may be null or repeated.
    # The columns of `docs` are held in one, so that none clashes with those made here.
    rows = C.stage(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")))
    mixed = mix(rows.select("_row", "_doc.doc_id", "_doc.text", "_doc.source"), key="_row")
    copies = mixed.where("taken > 0").select("_row", (F.col("taken") / F.col("size")).cast("int").alias("_n"))
    # Nearly every row has a count, so that table is no small one at any size.
    return rows.join(copies.hint("merge"), "_row").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_doc.*")
