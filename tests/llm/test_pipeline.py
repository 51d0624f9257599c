"""The pipeline's stages against brute force, with clashing columns and empty tables, and what they leave on disk."""

import collections
import os

import pytest

import corpus_pipeline
from tests.llm.test_documents import brute_components, words
from vesselflow.llm import jaccard, mixing, packing, quality

SF = "/root/testdata/sf0.001"
CLASHES = "_row long, _n long, _c long, _m long, _b long, _in long, _doc long, _d long, fill long, _block long, size long, kept boolean, n_words long, _cut_symbols long, _rest long, sequence_id long"


def with_clashes(spark, rows):
    """(doc_id, text, lang, source) with columns of the names that the stages use."""
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
    names = [c.split()[0] for c in CLASHES.split(", ")]
    own = [True if n == "kept" else 9 for n in names]
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *own) for i, t, g, s in rows], schema)


def rows_of(texts):
    return [(i, t, "en" if i % 3 else None, None if i % 9 == 0 else f"src{i % 4}") for i, t in texts]


def test_stages_keep_clashing_columns(spark, texts):
    docs = with_clashes(spark, rows_of(texts))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert rows and all(r[c] == 9 for r in rows for c in ("_row", "_n", "_m", "_in", "fill", "size", "n_words", "_cut_symbols", "_rest")), name
        assert all(r.kept is True for r in rows), name
    packed = packing.pack(with_clashes(spark, [(i, "t", None, None) for i in range(5)]).selectExpr("*", "0 AS piece", "doc_id + 1 AS length"))
    assert sorted((r.doc_id, r.fill, r._block) for r in packed.collect()) == [(i, 9, 9) for i in range(5)]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_of_nothing(spark, nothing, stage):
    assert stage(spark, nothing, SF).collect() == []


def test_near_duplicate_stage_against_brute_force(spark, documents, texts):
    want = {d for d, (_, c) in brute_components(texts, jaccard.Rule(5, 80, 100)).items() if c == d}
    got = [r.doc_id for r in jaccard.near_duplicate_stage(spark, documents, SF).collect()]
    assert sorted(got) == sorted(want) and len(want) < len(texts)


def test_quality_stage_against_its_verdicts(spark, documents, texts):
    """Kept are all that pass the base rules and exceed no cutoff of their stratum, whole."""
    scored = quality.signals(documents)
    cuts = {r._stratum: r.asDict() for r in quality.certified_cutoffs(scored, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    want = {}
    for r in scored.collect():
        cut = cuts.get(r.lang or "", {})
        over = [s for s, (top, bottom) in quality.SIGNALS.items() if f"_cut_{s}" in cut and r[top] * quality.BINS // max(r[bottom], 1) > cut[f"_cut_{s}"]]
        if not r.base_failed and not over:
            want[r.doc_id] = r.text
    got = {r.doc_id: r.text for r in quality.quality_stage(spark, documents, SF).collect()}
    assert got == want and 0 < len(want) < len(texts)


def test_packing_stage_packs_every_token(spark, documents, texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    total, bins = collections.Counter(), collections.defaultdict(list)
    for r in packing.packing_stage(spark, documents, SF).collect():
        total[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert dict(total) == {i: len(own.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts}
    for some in bins.values():
        ends = [0, *(a + n for a, n in sorted(some))]
        assert ends[-1] <= 2048 and [a for a, _ in sorted(some)] == ends[:-1]


def test_small_sources_come_near_their_targets(spark):
    """Fifty documents a source."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken = collections.Counter()
    for r in mixing.mix(docs).collect():
        taken[r.source_size, r.target] += r.taken
    assert len(taken) > 10 and all(abs(n - t) <= 0.005 * t for (_, t), n in taken.items())


def test_only_the_result_is_left(spark):
    from vesselflow.llm import _common as C

    folder = C.shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, SF)
    left = {x for x in set(os.listdir(folder)) - before if x.startswith("stage-")}
    assert len(left) == 1 and out._staged.endswith(left.pop())
    assert out.count() > 0 and all(words(x) for x in out.columns)
