"""What the driver holds: plans of bounded size, and columns where it takes rows."""

import tracemalloc

from vesselflow.llm import jaccard, quality

SF = "/root/testdata/sf0.001"


def test_plans_of_the_cutoffs_are_small(spark, monkeypatch):
    """A column for each of the 201 steps made a plan of 90,000 characters here, kept for each of its updates."""
    sizes = []
    stage = quality.C.stage

    def measured(df, keep=False):
        sizes.append(len(df._jdf.queryExecution().toString()))
        return stage(df, keep)

    monkeypatch.setattr(quality.C, "stage", measured)
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    measured(quality.certified_cutoffs(quality.signals(docs), labels))
    assert len(sizes) == 4 and max(sizes) < 60_000, sizes


def test_counts_come_to_the_driver_as_columns(spark):
    """Rows of a quarter of a million counters took tens of MB of Python objects; the result is 2 MB."""
    rows = spark.range(jaccard.SLOTS).selectExpr("id AS slot", "id % 7 AS count").repartition(4)
    tracemalloc.start()
    try:
        counts = jaccard.shingle_counts(rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (counts == jaccard.np.arange(jaccard.SLOTS) % 7).all() and peak < 15e6, peak


def test_bitmaps_come_to_the_driver_as_columns(spark):
    ids = spark.range(400_000).withColumnRenamed("id", "doc_id").repartition(4).cache()
    tracemalloc.start()
    try:
        known = jaccard.Bitmap.of(ids, "doc_id")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    slots = {r[0] for r in known.slot(ids, "doc_id").select("_slot").distinct().collect()}
    words = known.words.value
    assert all(words[s >> 5] >> (s & 31) & 1 for s in slots) and sum(int(w).bit_count() for w in words) == len(slots)
    assert peak < 15e6, peak
