"""Quality rules with risk-controlled cutoffs.

Each signal of a document ("higher is worse", a share) is counted in fine bins. A fixed part of the labelled good
documents of a stratum gives a sequence of joint rules from loose to strict: the first rejects nothing, the next come
ever closer to the highest value of these documents in each signal, and the cutoffs of the last STEPS are those that
j / STEPS of the allowed risk of these documents exceed. A rule rejects what exceeds any of its cutoffs. On the other labelled good documents, the holdout, the number that a rule rejects is binomial; the exact lower
tail at the allowed risk is the p-value of "this rule rejects more than `risk` of the good documents". Rules are tested
in their order up to the first failure, and the last one before it is used (fixed-sequence testing needs no correction
along a sequence). The bound holds for all signals of a stratum together; over the strata the level is divided by their
number (Bonferroni). Strata with too few labels to certify even a rule without false rejections are pooled, and the
rule of the pool, which is one more test, is certified for the pool as a whole. Where that is too small as well, and in
strata without labels, only the base rules reject.

Everything is DataFrame code: per document array functions, partial aggregations of the labelled rows, and a join with
one row per stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.llm import _common as C

#: Signal: (numerator, denominator).
SIGNALS = {
    "symbols": ("n_symbols", "word_chars"),
    "shouting": ("n_upper", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
RISK, LEVEL = 0.01, 0.05
#: Bins of a signal, joint rules of a stratum above and below the highest value, and one in so many labelled documents that gives the rules.
BINS, ABOVE, STEPS, FIT = 4096, 100, 100, 3
POOL = "(pool)"
SYMBOLS = "#*$%&|<>"  # as a class of a regular expression
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "base_failed"]
WINDOW = 5


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks, base_failed.

    Columns of these names are replaced. Null and empty texts count 0 everywhere and fail the base rule. Work and
    memory are proportional to one text; nothing is shuffled.
    """
    # The columns of `docs` are held in one, so that none clashes with those made here.
    t = F.coalesce(F.col("_doc")[text], F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")).withColumn("_w", C.words(t)).withColumn("_l", lines).withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": C.count_chars(t, SYMBOLS),
            "n_upper": C.count_chars(t, "A-Z"),
            "n_marks": C.count_chars(t, "!"),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "_b": F.zip_with("_w", F.slice("_w", 2, 2**30), lambda a, b: F.xxhash64(a, b)),
        }
    )
    # A window found twice shows as its outer four words found twice; only such texts get exact windows and a sort.
    four = F.slice(F.zip_with("_b", F.slice("_b", 4, 2**30), lambda a, b: F.xxhash64(a, b)), 1, F.size("_w") - (WINDOW - 1))
    out = out.withColumn("_q", F.when(F.size("_w") > WINDOW, four))
    starts = F.sequence(F.lit(0), F.size("_w") - WINDOW)
    grams = F.transform(starts, lambda i: F.struct(F.xxhash64(*(F.get("_w", i + k) for k in range(WINDOW))).alias("g"), i.alias("i")))
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_q")) < F.size("_q"), F.sort_array(grams)))
    same = lambda x, y: F.coalesce(x["g"] == y["g"], F.lit(False))
    at = F.transform("_s", lambda x, i: F.when(same(x, F.get("_s", i - 1)) | same(x, F.get("_s", i + 1)), x["i"]))
    out = out.withColumn("_p", F.sort_array(F.filter(at, lambda p: p.isNotNull())))
    run = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW))))
    out = out.withColumn("n_repeat_words", F.coalesce(F.aggregate(run, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = out.withColumn("base_failed", failed)
    # `inline` keeps later filters on these columns from being computed a second time below this point.
    rest = [c for c in docs.columns if c not in COUNTS]
    return out.select(*(F.col("_doc")[c].alias(c) for c in rest), F.inline(F.array(F.struct(*COUNTS))))


def _bin(name: str) -> Column:
    top, bottom = SIGNALS[name]
    return F.floor(F.col(top) * BINS / F.greatest(F.col(bottom), F.lit(1)))


def _log_gamma(z: Column) -> Column:
    """Stirling's series after a shift by eight; relative error below 1e-12 for z >= 1."""
    y = z + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y)
    series = series + 1 / (1260 * F.pow(y, F.lit(5)))
    for i in range(8):
        series = series - F.log(z + i)
    return series


def binomial_tail(x: Column, n: Column, p: float) -> Column:
    """P(X <= x) for X ~ Binomial(n, p) where x < n * p, else 1.

    The terms are summed downwards from x, where each is smaller than the last; twelve standard deviations and 200
    terms on, nothing is left in double precision, so the work grows with the root of n only.
    """
    n, x = n.cast("double"), x.cast("long")
    log_top = _log_gamma(n + 1) - _log_gamma(x + 1) - _log_gamma(n - x + 1) + x * math.log(p) + (n - x) * math.log1p(-p)
    least = F.greatest(F.lit(0).cast("long"), (x - 200 - 12 * F.sqrt(n * p * (1 - p))).cast("long"))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    down = lambda a, i: (lambda t: F.struct(t.alias("t"), (a["s"] + t).alias("s")))(a["t"] * i / (n - i + 1) * ((1 - p) / p))
    steps = F.when(x > least, F.sequence(x, least + 1, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    tail = F.exp(log_top) * F.aggregate(steps, start, down)["s"]
    return F.when(x < n * p, F.least(tail, F.lit(1.0))).otherwise(F.lit(1.0))


def _certifies(n: Column, risk: float, level: Column) -> Column:
    """Whether n holdout documents of which none is rejected certify a rule."""
    return n * math.log1p(-risk) <= F.log(level)


def certified_cutoffs(scored: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """One row per stratum with a certified rule: `_stratum` and the highest bin that is kept per signal (`_cut_<signal>`).

    scored: output of `signals`, with doc_id and the stratum's column; labels: doc_id and quality (1 is good). All
    labelled good documents that pass the base rules are used, one in FIT (by a hash of the id) for the rules and the
    others for the tests; documents labelled both ways count as bad, rows without id are not used.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("_quality")).where("_quality = 1")
    held = scored.where("NOT base_failed").join(good, "doc_id", "left_semi")
    held = held.select(
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("own"), (F.pmod(F.xxhash64("doc_id"), F.lit(FIT)) == 0).alias("fit"), *(_bin(s).alias(s) for s in SIGNALS)
    )
    held = C.stage(held)
    sizes = held.groupBy("own").agg(F.count_if(~F.col("fit")).alias("n"))
    tests = sizes.agg((F.lit(level) / (F.count("*") + 1)).alias("level"))
    sizes = sizes.join(F.broadcast(tests)).withColumn("_stratum", F.when(_certifies(F.col("n"), risk, F.col("level")), F.col("own")).otherwise(F.lit(POOL)))
    sizes = C.stage(sizes.select("own", "_stratum", "level"))
    held = held.join(sizes, "own")

    # Bins of the signals among the documents that give the rules, with the number of documents above each.
    bins = held.where("fit").select("_stratum", F.inline(F.array(*(F.struct(F.lit(s).alias("signal"), F.col(s).alias("bin")) for s in SIGNALS))))
    bins = bins.groupBy("_stratum", "signal", "bin").agg(F.count("*").alias("c"))
    down = Window.partitionBy("_stratum", "signal").orderBy(F.desc("bin"))
    bins = bins.withColumn("above", F.sum("c").over(down) - F.col("c")).withColumn("n", F.sum("c").over(Window.partitionBy("_stratum", "signal")))
    # Steps are made and counted in arrays: a column for each would make plans of megabytes, all of which the driver keeps.
    runs = bins.groupBy("_stratum", "signal").agg(F.max("bin").alias("top"), F.max("n").alias("n"), F.collect_list(F.struct("bin", "above")).alias("bins"))
    near = F.transform(F.sequence(F.lit(ABOVE), F.lit(1), F.lit(-1)), lambda k: F.col("top") + F.floor((BINS - F.col("top")) * k * k / (ABOVE * ABOVE)))
    risked = lambda j: F.filter("bins", lambda b: b["above"] <= F.col("n") * (F.lit(risk) * j / STEPS))
    within = F.transform(F.sequence(F.lit(0), F.lit(STEPS)), lambda j: F.array_min(F.transform(risked(j), lambda b: b["bin"])))
    runs = runs.select("_stratum", "signal", F.concat(near, within).alias("cuts"))
    cuts = runs.groupBy("_stratum").agg(*(F.first(F.when(F.col("signal") == s, F.col("cuts")), ignorenulls=True).alias(s) for s in SIGNALS))
    cuts = C.stage(cuts)

    # A document is rejected from some step on: cutoffs fall with the steps.
    n_steps = ABOVE + STEPS + 1
    passed = lambda s: F.size(F.filter(F.col(f"c.{s}"), lambda c: F.col(f"h.{s}") > c))
    first = [n_steps - passed(s) for s in SIGNALS]
    tested = held.where("NOT fit").alias("h").join(cuts.alias("c"), "_stratum").select("_stratum", "level", F.least(*first).alias("from"))
    counts = tested.groupBy("_stratum", "level", "from").agg(F.count("*").alias("c")).groupBy("_stratum", "level")
    counts = counts.agg(F.sum("c").alias("n"), F.collect_list(F.struct("from", "c")).alias("rejected"))
    rows = counts.select("_stratum", "level", "n", "rejected", F.explode(F.sequence(F.lit(0), F.lit(n_steps - 1))).alias("j"))
    so_far = F.aggregate(F.filter("rejected", lambda r: r["from"] <= F.col("j")), F.lit(0).cast("long"), lambda x, r: x + r["c"])
    rows = rows.select("_stratum", "level", "n", "j", so_far.alias("x"))
    rows = rows.withColumn("ok", binomial_tail(F.col("x"), F.col("n"), risk) <= F.col("level"))
    so_far = F.min("ok").over(Window.partitionBy("_stratum").orderBy("j"))
    best = rows.withColumn("ok", so_far).where("ok").groupBy("_stratum").agg(F.max("j").alias("j"))
    best = best.join(cuts, "_stratum").join(sizes, "_stratum")
    return best.select(F.col("own").alias("_stratum"), *(F.get(F.col(s), F.col("j")).alias(f"_cut_{s}") for s in SIGNALS))


def judge(scored: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """`scored` with `kept`: false where the base rules fail or a signal exceeds its stratum's cutoff; a column of this name is replaced."""
    names = {c: C.fresh(scored, c) for c in cutoffs.columns}
    key = names["_stratum"]
    out = scored.drop("kept").withColumn(key, F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    out = out.join(cutoffs.withColumnsRenamed(names), key, "left")
    rejected = F.col("base_failed")
    for s in SIGNALS:
        rejected = rejected | F.coalesce(_bin(s) > F.col(names[f"_cut_{s}"]), F.lit(False))
    return out.withColumn("kept", ~rejected).drop(*names.values())


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = C.stage(signals(C.table(spark, sf_dir, "documents")).drop("text", "source", "n_chars"))
    cutoffs = C.stage(certified_cutoffs(scored, C.table(spark, sf_dir, "labels")))
    return judge(scored, cutoffs).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep. Texts are scored once, beside which the signals are written."""
    # The columns of `docs` are held in one, so that none is replaced by a signal.
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ("text", "lang"))).alias("_rest")
    with C.scratch(spark):
        scored = C.stage(signals(docs.select(doc, "doc_id", "text", "lang")), keep=True)
        cutoffs = C.stage(certified_cutoffs(scored, C.table(spark, sf_dir, "labels")), keep=True)
    return judge(scored, cutoffs).where("kept").select(*(F.col(c) if c in ("text", "lang") else F.col("_rest")[c].alias(c) for c in docs.columns))
