r"""Line dedup by a deletion-neighbourhood join: a line goes where an earlier line is equal or one word away.

Lines are the `\n`-split pieces of a text, compared as word sequences; an edit is the insertion, deletion or replacement
of one word. Lines of fewer than `min_words` words are never touched, lines of fewer than `near_words` only match equal
ones. Earlier means by (doc_id, line number) of a line's first occurrence.

Every variant of a line within the bound is a gap: a word deleted, or a place where one could stand, with what is
before and after it hashed. Two lines are at most one word apart exactly if they share a gap at the same place, so all
lines of one gap are neighbours of its earliest line: no pairs within a gap are needed. Gaps are only listed for lines
that share their first or second half with another line, as one edit leaves one of the halves alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

MIN_WORDS = 5
NEAR_WORDS = 10
#: The query and the pipeline compare every line that has a word, and look for near ones from five words on.
EVERY = {"min_words": 1, "near_words": 5}
BLOCK = 32


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, line, w (words) of every line of min_words words or more."""
    cut = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "_x"))
    # `inline` keeps the split from being repeated in the condition.
    return cut.select("doc_id", "line", F.inline(F.array(F.struct(C.words("_x").alias("w"))))).where(F.size("w") >= min_words)


def _half(side: str, n: Column) -> Column:
    """Hash of the first or last n words; n is part of it."""
    part = F.slice("w", 1, n) if side == "p" else F.slice("w", F.size("w") - n + 1, n)
    return F.xxhash64(F.lit(side), n, part)


def _digests() -> tuple[Column, Column]:
    return F.xxhash64("w").alias("h1"), F.xxhash64(F.lit(1), F.col("w")).alias("h2")


def all_lines(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """doc_id, line, h1, h2 (digest), n (words) and keys (halves) k0 to k3 of every line."""
    n = F.size("w")
    m = F.floor(n / 2).cast("int")
    even = F.array(_half("p", m), _half("s", m))
    odd = F.array(_half("p", m), _half("s", m), _half("p", m + 1), _half("s", m + 1))
    keys = F.when(n < near_words, F.array().cast("array<bigint>")).when(n % 2 == 0, even).otherwise(odd)
    rows = _lines(docs, min_words).select("doc_id", "line", *_digests(), n.alias("n"), F.inline(F.array(F.struct(keys.alias("k")))))
    return rows.select("doc_id", "line", "h1", "h2", "n", *(F.get("k", i).alias(f"k{i}") for i in range(4)))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """h1, h2, n, first (doc_id, line) and keys of every distinct line among `all_lines`."""
    return rows.groupBy("h1", "h2", "n", "k0", "k1", "k2", "k3").agg(F.min(F.struct("doc_id", "line")).alias("first"))


def _block_hash(c: str):
    return lambda i: F.xxhash64(F.slice(c, i, BLOCK))


def near_lines(docs: DataFrame, lines: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """h1, h2 of the distinct lines that have an earlier line one word away."""
    sides = F.array(*(F.struct(F.col(f"k{i}").alias("key"), F.lit("ps"[i % 2]).alias("side")) for i in range(4)))
    keys = lines.where(F.col("n") >= near_words).select("h1", "h2", F.inline(sides)).where("key IS NOT NULL")
    shared = keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo <> hi").select("key")
    asked = keys.join(shared, "key", "left_semi").groupBy("h1", "h2")
    asked = asked.agg(F.max(F.col("side") == "p").alias("p"), F.max(F.col("side") == "s").alias("s"))
    asked = C.stage(asked.join(lines.select("h1", "h2", "first.doc_id", "first.line"), ["h1", "h2"]))

    texts = C.maybe_in(_lines(docs, max(min_words, near_words)), asked, "doc_id", "line")
    texts = C.stage(texts.join(asked, ["doc_id", "line"]).where((F.xxhash64("w") == F.col("h1"))).dropDuplicates(["doc_id", "line", "h1", "h2"]))

    # What is before and after a gap is hashed by blocks from either end, so that a gap costs n / BLOCK + BLOCK words.
    n = F.size("w")
    hashed = texts.select("h1", "h2", F.struct("doc_id", "line").alias("at"), "p", "s", F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    hashed = hashed.withColumn("r", F.reverse("w"))
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(BLOCK))
    hashed = hashed.withColumns({f"{c}b": F.transform(starts, _block_hash(c)) for c in "wr"})

    def run(c: str, size: Column) -> Column:
        whole = F.floor(size / BLOCK).cast("int")
        return F.xxhash64(size, F.slice(f"{c}b", 1, whole), F.slice(c, whole * BLOCK + 1, size - whole * BLOCK))

    lo = F.when(F.col("p") & ~F.col("s"), F.floor(n / 2).cast("int") + 1).otherwise(1)
    hi = F.when(F.col("s") & ~F.col("p"), n - F.floor(n / 2).cast("int") + 1).otherwise(n + 1)
    gaps = hashed.withColumn("i", F.explode(F.sequence(lo, hi)))
    after = F.array(F.when(F.col("i") <= n, run("r", n - F.col("i"))), run("r", n - F.col("i") + 1))
    keyed = gaps.select("h1", "h2", "at", run("w", F.col("i") - 1).alias("before"), F.explode(after).alias("after")).where("after IS NOT NULL")
    return _neighbours(keyed, texts)


def _neighbours(keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """h1, h2 of the lines with an earlier line in one of their gaps, the edit verified on the words."""
    least = keyed.groupBy("before", "after").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).where("lo < hi").select("before", "after", "lo")
    earlier = keyed.join(least, ["before", "after"]).where("lo < at").groupBy("h1", "h2", "at").agg(F.min("lo").alias("lo"))
    a = texts.select("doc_id", "line", F.col("w").alias("a"))
    b = texts.select("doc_id", "line", F.col("w").alias("b"))
    pairs = earlier.select("h1", "h2", "at.doc_id", "at.line", F.col("lo.doc_id").alias("d2"), F.col("lo.line").alias("l2")).join(a, ["doc_id", "line"])
    pairs = pairs.select("h1", "h2", "a", F.col("d2").alias("doc_id"), F.col("l2").alias("line")).join(b, ["doc_id", "line"])
    return pairs.where(one_word_apart("a", "b")).select("h1", "h2").distinct()


def one_word_apart(a: str, b: str) -> Column:
    """Whether two word arrays differ by one insertion, deletion or replacement at most."""
    x, y = F.size(a), F.size(b)
    same = F.zip_with(a, b, lambda p, q: F.coalesce(p == q, F.lit(False)))
    at = F.coalesce(F.array_position(same, False), F.lit(0)).cast("int")
    rest = lambda c, skip: F.slice(c, at + skip, F.greatest(F.size(c), F.lit(1)))
    return (
        F.when(at == 0, x == y)
        .when(x == y, rest(a, 1) == rest(b, 1))
        .when(x == y + 1, rest(a, 1) == rest(b, 0))
        .when(y == x + 1, rest(a, 0) == rest(b, 1))
        .otherwise(F.lit(False))
    )


def dropped_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id, line, h1 of every line that goes (line from 0).

    Null and empty texts have no lines. Rows without a doc_id take no part. Two rows with the same doc_id hold lines at
    the same places: equal lines there are not earlier than each other and stay.
    """
    with C.scratch(docs.sparkSession):
        rows = C.stage(all_lines(docs, min_words, near_words))
        lines = C.stage(distinct_lines(rows))
        near = C.stage(near_lines(docs, lines, min_words, near_words))
        verdict = lines.select("h1", "h2", "first").join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
        own = rows.select("doc_id", "line", "h1", "h2")
        hits = own.join(verdict, ["h1", "h2"]).where(F.col("near") | (F.struct("doc_id", "line") != F.col("first")))
        return C.stage(hits.select("doc_id", "line", "h1"), keep=True)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """`docs` with the dropped lines taken out of `text`; documents stay, a text may become empty. Null texts stay null.

    The columns of `docs` are held in one meanwhile, so that none clashes with those made here.
    """
    gone = dropped_lines(docs, min_words, near_words).groupBy(F.col("doc_id").alias("_d")).agg(F.collect_set(F.struct("line", "h1")).alias("_gone"))
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")).join(gone, F.col("_doc.doc_id") == F.col("_d"), "left")
    kept = F.filter(F.split("_doc.text", "\n"), lambda x, i: ~F.array_contains("_gone", F.struct(i.alias("line"), F.xxhash64(C.words(x)).alias("h1"))))
    text = F.when(F.col("_gone").isNull(), F.col("_doc.text")).otherwise(F.array_join(kept, "\n"))
    return out.select(*(text.alias(c) if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped (line numbers from 0, ascending, joined by commas) of every document."""
    docs = C.table(spark, sf_dir, "documents")
    gone = dropped_lines(docs, **EVERY).groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("gone"))
    n = docs.select("doc_id", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    gone = gone.select("doc_id", F.size("gone").cast("long").alias("n"), F.array_join(F.transform("gone", lambda x: x.cast("string")), ",").alias("d"))
    return n.join(gone, "doc_id", "left").select("doc_id", "n_lines", F.coalesce("n", F.lit(0)).alias("n_dropped"), F.coalesce("d", F.lit("")).alias("dropped"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without repeated lines, n_chars as it is then; those left without a word go."""
    left = dedup_lines(docs, **EVERY).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
