"""Operators on documents against brute force, with null, empty, long and repeated texts and clashing columns."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vesselflow.llm import jaccard, licenses, line_dedup, mixing, packing, quality, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# Shared helpers


@pytest.mark.parametrize("full", [False, True])
def test_without_and_maybe_in(spark, monkeypatch, full):
    from vesselflow.llm import _common

    if full:
        monkeypatch.setattr(_common, "MOST_BITS", 4)  # no bitmap
    rows = spark.createDataFrame([(i if i % 5 else None, f"t{i}") for i in range(100)] + [(7, "again")], "id long, text string")
    gone = spark.createDataFrame([(i,) for i in range(0, 200, 3)], "id long")
    want = sorted(r.text for r in rows.collect() if r.id is None or r.id % 3)
    assert sorted(r.text for r in _common.without(rows, gone, "id").collect()) == want
    assert _common.without(rows, gone, "id").columns == rows.columns
    some = {r.text for r in _common.maybe_in(rows, gone, "id").collect()}
    assert {r.text for r in rows.collect() if r.id is not None and r.id % 3 == 0} <= some and (full or len(some) < 60)


# 1: mixing


def test_mix_reaches_targets(documents, texts):
    rows = mixing.mix(documents).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in texts)
    size = {i: len(words(t)) for i, t in texts}
    assert all(r.size == size[r.doc_id] and r.taken <= 3 * r.size for r in rows)
    source = {i: None if i % 9 == 0 else f"src{i % 4}" for i, _ in texts}
    names = [*sorted({s for s in source.values() if s}), None]
    total = {s: sum(size[i] for i in source if source[i] == s) for s in names}
    weight = {s: float(k % 3 + 1) for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in capped)
        share = left / sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * total[s] if s in capped else share * weight[s] for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not over:
            break
        capped |= over
    for s in names:
        mine = [r for r in rows if source[r.doc_id] == s]
        assert all(r.source_size == total[s] and abs(r.target - target[s]) < 1e-6 for r in mine)
        largest = max(r.size for r in mine)  # where it is most of its source, only whole copies of it are possible
        assert abs(sum(r.taken for r in mine) - target[s]) <= (largest if 2 * largest > total[s] else max(0.01 * target[s], 10))
    assert sorted(mixing.mix(documents.repartition(2)).collect()) == sorted(rows)


def test_mix_stage_counts_each_row(spark):
    # By weights 1 and 2, half of the six documents of a are wanted, those of b twice each.
    rows = [(i, f"a{k} " * 10, "a") for k, i in enumerate([None, None, 7, 7, 1, 2])] + [(i, f"b{k} " * 10, "b") for k, i in enumerate([None, 7, 1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_stage(spark, docs, "")
    got = collections.Counter(tuple(r) for r in out.collect())
    assert out.columns == docs.columns and set(got) <= set(rows)
    assert all(got[r] == 2 for r in rows if r[2] == "b")
    taken = [got[r] for r in rows if r[2] == "a"]
    assert sum(taken) == 3 and max(taken) == 1


def test_mix_of_nothing(nothing):
    assert mixing.mix(nothing).collect() == []


def test_every_source_is_near_its_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mix(docs).collect()
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[r.source_size, r.target] += r.taken
        target[r.source_size, r.target] = r.target
    assert len(target) > 10 and len(rows) == 10_000
    assert all(abs(taken[k] - t) <= 0.01 * t for k, t in target.items())


def test_mix_of_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "a b c", "x", 5, "k"), (1, "a b c", "x", 5, "k"), (1, None, None, 5, "k"), (2, "d " * 900, "y", 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target string")
    got = mixing.mix(docs).collect()
    assert sorted((r.doc_id, r.size, r.source_size) for r in got) == [(1, 0, 0), (1, 3, 6), (1, 3, 6), (2, 900, 900)]
    assert all(r.taken % r.size == 0 if r.size else r.taken == 0 for r in got)


def test_many_sources_are_ranked(spark):
    names = [f"s{i:03d}" for i in range(150)] + ["é", "😀", None]
    docs = spark.createDataFrame([(i, "w " * 10, s) for i, s in enumerate(names)], "doc_id long, text string, source string")
    with mixing.C.scratch(spark):
        sizes = docs.select("doc_id", "source", mixing.C.n_words("text").alias("size"))
        got = {r.source: r._rank for r in mixing.source_targets(sizes).collect()}
    assert [got[s] for s in names] == list(range(len(names)))


@pytest.mark.parametrize("leave", [2, 20])
def test_flight_keeps_both_totals(leave):
    import random

    sizes, probs = np.array([2000, 1500, *range(200, 1, -1)]), np.full(201, 0.3)
    held = mixing.flight(sizes, probs, random.Random(1), leave)
    assert len(held) <= leave and all(sizes[held] < 60)
    assert abs(sum(probs) - 0.3 * 201) < 1e-6 and abs(sum(sizes * probs) - 0.3 * sum(sizes)) < 1e-4
    mixing.land(sizes, probs, held[-2:])
    assert sum((0 < p < 1) for p in probs) == max(0, len(held) - 2)


# 2: line dedup


def brute_lines(rows, least=5, near=10):
    seen = []
    for doc, text in sorted(rows):
        for i, x in enumerate((text or "").split("\n")):
            w = tuple(words(x))
            if len(w) >= least:
                seen.append((doc, i, w))
    first, gaps, close = {}, set(), set()
    for doc, i, w in seen:
        first.setdefault(w, (doc, i))
    for w in sorted(first, key=first.get):
        if len(w) >= near:
            own = {(w[:i], w[i:]) for i in range(len(w) + 1)} | {(w[:i], w[i + 1 :]) for i in range(len(w))}
            if own & gaps:
                close.add(w)
            gaps |= own
    return {(doc, i) for doc, i, w in seen if w in close or first[w] != (doc, i)}


def test_line_dedup(documents, texts):
    want = brute_lines(texts)
    got = {(r.doc_id, r.line) for r in line_dedup.dropped_lines(documents).collect()}
    assert got == want and len(want) > 20
    out = line_dedup.dedup_lines(documents)
    assert out.columns == documents.columns
    text = {r.doc_id: r.text for r in out.collect()}
    for doc, t in texts:
        assert text[doc] == (t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (doc, i) not in want))


def test_query_and_stage_drop_short_lines(spark, documents, texts, tmp_path):
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute_lines(texts, least=1, near=5)
    got = {(r.doc_id, int(x)) for r in line_dedup.op2_line_dedup(spark, str(tmp_path)).collect() for x in r.dropped.split(",") if x}
    assert got == want and want - brute_lines(texts)
    left = {r.doc_id: r.text for r in line_dedup.line_dedup_stage(spark, documents, str(tmp_path)).collect()}
    kept = {doc: "\n".join(x for i, x in enumerate((t or "").split("\n")) if (doc, i) not in want) for doc, t in texts}
    assert left == {doc: t for doc, t in kept.items() if words(t)}


def test_short_lines(spark):
    rows = ["Les.", "All rights reserved.", "a b c d e", "Les.\nLes. x", " All rights  reserved.", "a b c d f", "a b c g", "a b c d"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {(r.doc_id, r.line) for r in line_dedup.dropped_lines(docs, **line_dedup.EVERY).collect()} == {(3, 0), (4, 0), (5, 0)}


def test_one_word_edits(spark):
    base = [f"w{i}" for i in range(12)]
    rows = [base, base[:5] + base[6:], base[:3] + ["new"] + base[3:], base[:11] + ["z"], ["z"] + base, base[:4] + ["q", "q"] + base[6:]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.dropped_lines(docs).collect()} == {1, 2, 3, 4}


def test_line_dedup_keeps_clashing_columns(spark):
    rows = [(1, "a b c d e f", "mine", 1), (2, "a b c d e f\nnew words here as well", "mine", 2), (2, "other text of some words", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone string, `a.b` int")
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[3]) == [rows[0], (2, "new words here as well", "mine", 2), rows[2]]


def test_line_dedup_of_nothing(nothing):
    assert line_dedup.dropped_lines(nothing).collect() == []


# 3: repeated byte strings


def brute_repeats(rows, length):
    data = {i: (t or "").encode() for i, t in rows}
    count = collections.Counter(b[i : i + length] for b in data.values() for i in range(len(b) - length + 1))
    out = {}
    for doc, b in data.items():
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[doc] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(documents, texts):
    want = brute_repeats(texts, 200)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.clean(documents).collect()}
    assert got == want and sum(x[1] > 0 for x in want.values()) > 10


def test_hot_windows_agree_with_the_merge(documents, monkeypatch):
    a = {tuple(r)[:5] for r in suffix_dedup.clean(documents).drop("kept").collect()}
    monkeypatch.setattr(suffix_dedup, "HOT", 0)
    assert {tuple(r)[:5] for r in suffix_dedup.clean(documents).drop("kept").collect()} == a


@pytest.mark.parametrize(("hot", "frequent"), [(3, 2.0), (3, 0.0), (20_000, 0.05)])
def test_groups_split_by_halves_and_frequent_keys(spark, monkeypatch, hot, frequent):
    """One passage in many surroundings, of which some are shared in part: groups of many distinct strings."""
    rng = np.random.default_rng(8)
    some = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    passage, shared = some(190), [some(60) for _ in range(4)]
    rows = [(i, some(40 + i) + shared[i % 4][i % 7 :] + passage + shared[(i // 4) % 4][: 60 - i % 5] + some(30)) for i in range(40)]
    rows += [(100 + i, "a" * (198 + i)) for i in range(6)] + [(200, passage), (201, None), (202, "x" + passage * 3)]
    want = brute_repeats(rows, 200)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.clean(frame).collect()}
    assert got == want and sum(x[1] > 0 for x in want.values()) > 20


def test_suffix_dedup_with_repeated_and_missing_ids(spark):
    rng = np.random.default_rng(2)
    t, u, v = ("".join(chr(97 + x) for x in rng.integers(0, 26, n)) for n in (250, 309, 280))
    rows = [(1, t, 5), (1, u, 5), (2, t, 5), (None, v, 5), (None, v + "x", 5), (None, None, 5)]
    got = suffix_dedup.clean(spark.createDataFrame(rows, "doc_id long, text string, key int")).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got) == [(0, 0, 0), (0, 280, 280), (0, 281, 280), (1, 250, 250), (1, 309, 0), (2, 250, 250)]


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_transforms(shards):
    rng = np.random.default_rng(3)
    base = rng.integers(97, 100, 300).astype(np.uint8).tobytes()
    strings = [base, base[40:250], b"a" * 120, b"ab" * 60, base[100:], rng.integers(97, 100, 90).astype(np.uint8).tobytes(), b"aab" * 40]
    count = collections.Counter(s[i : i + 50] for s in strings for i in range(len(s) - 49))
    for s, got in zip(strings, suffix_dedup.repeated_starts(strings, 50, shards)):
        assert got.tolist() == [count[s[i : i + 50]] > 1 for i in range(len(s) - 49)]


def test_suffix_dedup_of_nothing(nothing):
    assert suffix_dedup.clean(nothing).collect() == []


# 4: packing


def test_packing(documents, texts):
    path = packing.tokenizer_path()
    rows = packing.pack(packing.tokenise(documents, path)).collect()
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    by, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    assert sorted(by) == sorted(i for i, _ in texts)
    for doc, text in texts:
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        parts = sorted(by[doc], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == 2048 for r in parts[1:])
        for r in parts:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for some in bins.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(bins) <= 1.05 * sum(r.length for r in rows) / 2048 + 1


@pytest.mark.parametrize("text", ["a  b\n\n c", "<|endoftext|> x", "tab\t\there ", "naïve  ", "", "  x", "it's 12 34  ok?!"])
def test_encoder_agrees_with_tokenizers(text):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    assert packing.encode(text, packing.tokenizer_path()).tolist() == [*own.encode(text, add_special_tokens=False).ids, 0]


def test_packing_holds_every_constraint():
    lengths = np.array([5] * 30 + [90, 60, 40, 10])
    bins, _, fill = packing.pack_block(lengths, 100, 4, 6000.0)
    for b in set(bins):
        mine = lengths[bins == b]
        assert mine.sum() == fill[b] <= 100 and len(mine) <= 4 and ((mine**2).sum() <= 6000 or len(mine) == 1)


def test_packing_of_nothing(nothing):
    assert packing.pack(packing.tokenise(nothing, packing.tokenizer_path())).collect() == []


# 5: quality


def brute_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= set(range(i, i + 5))
    return len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(documents, texts):
    rows = {r.doc_id: r for r in quality.signals(documents).collect()}
    for doc, text in texts:
        r = rows[doc]
        want = brute_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_binomial_tail(spark):
    from math import comb

    cases = [(x, n) for n in (1, 10, 700, 5000) for x in (0, 1, 3, 20) if x <= n]
    got = spark.createDataFrame(cases, "x long, n long").select(quality.binomial_tail(F.col("x"), F.col("n"), 0.01)).collect()
    for (x, n), (p,) in zip(cases, got):
        want = sum(comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(x + 1)) if x < 0.01 * n else 1.0
        assert abs(p - want) < 1e-9


def brute_kept(rows, labels, fit):
    """doc_id -> verdict, for rows of (doc_id, text, lang) and labels of doc_id -> quality; fit: ids that give the rules."""
    from math import comb

    def bins(text):
        text, w = text or "", words(text)
        n, chars, symbols, dup, rep = brute_counts(text)
        lines = sum(bool(words(x)) for x in text.split("\n"))
        parts = ((symbols, chars), (sum(text.count(x) for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars), (text.count("!"), chars), (dup, lines), (rep, n))
        return n < 10 or 100 * rep > 20 * n, [a * quality.BINS // max(1, b) for a, b in parts]

    seen = {doc: (lang, *bins(text)) for doc, text, lang in rows}
    good = [d for d in seen if labels.get(d) == 1 and not seen[d][1]]
    langs = {seen[d][0] for d in good}
    level = quality.LEVEL / (len(langs) + 1)
    tail = lambda x, n: sum(comb(n, i) * 0.01**i * 0.99 ** (n - i) for i in range(x + 1)) if x < 0.01 * n else 1.0
    held = collections.Counter(seen[d][0] for d in good if d not in fit)
    of = {x: x if 0.99 ** held[x] <= level else "" for x in langs}
    cut = {}
    for stratum in set(of.values()):
        a = [seen[d][2] for d in good if of[seen[d][0]] == stratum and d in fit]
        b = [seen[d][2] for d in good if of[seen[d][0]] == stratum and d not in fit]
        top = [max((x[k] for x in a), default=0) for k in range(5)]
        steps = [[t + (quality.BINS - t) * k * k // quality.ABOVE**2 for t in top] for k in range(quality.ABOVE, 0, -1)]
        low = lambda k, j: min(v for v in {x[k] for x in a} if sum(x[k] > v for x in a) <= len(a) * 0.01 * j / quality.STEPS)
        steps += [[low(k, j) for k in range(5)] for j in range(quality.STEPS + 1)]
        for c in steps if a else ():
            if tail(sum(any(x > y for x, y in zip(r, c)) for r in b), len(b)) > level:
                break
            cut[stratum] = c
    return {d: not failed and not any(x > y for x, y in zip(v, cut.get(of.get(lang), [10**9] * 5))) for d, (lang, failed, v) in seen.items()}


def test_kept_against_brute_force(spark):
    rng = np.random.default_rng(6)
    text = lambda i, k: " ".join(f"W{(i * 7 + n) % 91}x{n}" if n % k else f"w{n}!*" for n in range(1, 31))
    sizes = {"en": (2500, 200), "de": (500, 40), "fr": (400, 40), "xx": (0, 30)}
    rows, labels = [], {}
    for lang, (n, bad) in sizes.items():
        for i in range(n + bad):
            doc = len(rows)
            rows.append((doc, text(int(rng.integers(0, 90)), int(rng.integers(8, 40)) if i < n and i % 150 else 2 if i < n else 1), lang))
            labels[doc] = int(i < n)
    rows += [(len(rows), None, None), (len(rows) + 1, "", "en")]
    labels |= {0: 0, len(rows) - 1: 1}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([*labels.items(), (0, 1), (None, 1)], "doc_id long, quality int")
    fit = {r.doc_id for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(quality.FIT)) == 0).collect()}
    want = brute_kept(rows, labels, fit)
    scored = quality.signals(docs)
    with mixing.C.scratch(spark):
        got = {r.doc_id: r.kept for r in quality.judge(scored, quality.certified_cutoffs(scored, marks)).collect()}
    assert got == want
    kept = lambda lang, good: [want[d] for d, _, x in rows if x == lang and labels.get(d) == good]
    assert all(sum(kept(x, 1)) >= 0.98 * len(kept(x, 1)) and sum(kept(x, 0)) <= 1 for x in ("en", "de", "fr"))
    assert all(kept("xx", 0))  # no label there is good: nothing is certified


def test_signals_keep_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a b", "mine", 7, None), (1, "a b", "mine", 7, None)], "doc_id long, text string, _w string, n_words int, `a.b` string")
    got = quality.signals(rows)
    assert got.columns == ["doc_id", "text", "_w", "a.b", *quality.COUNTS]
    assert [(r._w, r.n_words) for r in got.collect()] == [("mine", 2)] * 2


def test_quality_of_nothing(nothing, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    scored = quality.signals(nothing)
    assert quality.judge(scored, quality.certified_cutoffs(scored, labels)).collect() == []


# 7: licenses


def license_styles(text):
    """The text as shipped: as it stands, wrapped, and in three kinds of comments, after a copyright line."""
    import textwrap

    parts = [textwrap.wrap(x, 70) for x in re.split(r"\n\s*\n", text)]
    lines = "\n\n".join("\n".join(x) for x in parts).split("\n")
    head = "Copyright (c) 2019-2024 Some Body <some@body.example>"
    yield text
    yield f"MY PROJECT\n\n{head}\n\n" + "\n".join(lines)
    if text[-1] not in ".:/":
        return  # a title without a full stop ends with its paragraph
    yield f"{head}\n" + "\r\n".join(lines) + "\r\n\r\nint x;"
    yield f"# {head}\n#\n" + "\n".join(f"# {x}".rstrip() for x in lines) + "\nimport os"
    yield "\n".join(f"// {x}".rstrip() for x in lines) + "\n\npackage main"
    yield f"/*\n * {head}\n *\n" + "\n".join(f" * {x}".rstrip() for x in lines) + "\n */\n#include <x.h>"


def test_license_scan(spark):
    rows, want = [], {}
    for rule, (name, text) in enumerate(licenses.RULES):
        for style, own in enumerate(license_styles(text)):
            rows.append((rule * 10 + style, own))
            want[rule * 10 + style] = name
    numbered = "Copyright 2020 X. All rights reserved.\n\n{g}\n\n1. {a}\n\n2. {b}\n\n3. {c}\n".format(g=licenses._BSD_GRANT, a=licenses._BSD_SOURCE, b=licenses._BSD_BINARY, c=licenses._BSD_NAMES)
    lettered = "{g}\n  (a) {a}\n  (b) {b}\n".format(g=licenses._BSD_GRANT, a=licenses._BSD_SOURCE, b=licenses._BSD_BINARY)
    rows += [(-1, numbered), (-2, lettered), (-3, lettered + "\n" + lettered), (-4, "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0+\nx"), (-5, "no license here"), (-6, None), (-7, ""), (-8, "LICENSED under the mit license!\nx")]
    rows += [(-9, "Released under the MIT License. And more."), (-9, "All rights reserved."), (None, "All rights reserved.")]
    got = collections.defaultdict(dict)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got[r.doc_id][r.license] = r.n_found
    for doc, name in want.items():
        assert got[doc] == {name: 1}, (doc, licenses.RULES[doc // 10][1][:60], got[doc])
    assert got[-1] == {"BSD-3-Clause": 1, "all-rights-reserved": 1} and got[-2] == {"BSD-2-Clause": 1} and got[-3] == {"BSD-2-Clause": 2}
    assert got[-4] == {"MIT": 1, "Apache-2.0": 1, "GPL-2.0+": 1} and got[-8] == {"MIT": 1} and got[-9] == {"MIT": 1, "all-rights-reserved": 1}
    assert not any(x in got for x in (-5, -6, -7)) and got[None] == {"all-rights-reserved": 1}


def test_licenses_are_found_row_by_row(spark):
    mit, half = licenses.RULES[1][1], licenses._MIT_GRANT
    rows = [(1, mit), (1, mit), (1, "no license"), (None, mit), (None, mit), (None, mit), (2, half), (2, licenses._MIT_NOTICE), (3, f"{mit}\n\nAll rights reserved.")]
    got = {(r.doc_id, r.license, r.n_found) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x"))).collect()}
    assert got == {(1, "MIT", 2), (None, "MIT", 3), (3, "MIT", 1), (3, "all-rights-reserved", 1)}


def test_licenses_of_the_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    plain = lambda x: " ".join(re.findall(r"[^\W_]+", x.lower()))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    single = {plain(text): name for name, text in licenses.RULES}
    want = set()
    for doc, text in texts.items():
        sentences = {plain(x) for line in text.split("\n") for x in re.split(r"(?<=[.!?:;])\s+", line)}
        want |= {(doc, single[x]) for x in sentences if x in single}
    got = {(r.doc_id, r.license) for r in licenses.op7_license_scan(spark, sf).collect()}
    assert got == want and len(want) > 10


def test_hint_covers_every_rule():
    for _, text in licenses.RULES:
        assert re.search(licenses.HINT.removeprefix("(?i)"), text, re.I), text


def test_licenses_of_nothing(nothing):
    assert licenses.scan(nothing).collect() == []


# 9: n-gram Jaccard


def brute_components(rows, rule):
    sets = {}
    for doc, text in rows:
        w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[doc] = {tuple(w[i : i + rule.k]) for i in range(max(1, len(w) - rule.k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and rule.den * both >= rule.num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("rule", [jaccard.Rule(3, 90, 100), jaccard.Rule(5, 80, 100, part=1)])
def test_jaccard_components(documents, texts, rule):
    want = brute_components(texts, rule)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(documents, rule).collect()}
    assert got == want and sum(c != d for d, (_, c) in want.items()) > 10


def test_jaccard_of_a_large_group_of_near_copies(spark, monkeypatch):
    """Copies of one text with words of their own, not all similar to the first one; a passage that all of them share; small sets."""
    rng = np.random.default_rng(8)
    base, common = [f"b{i}" for i in range(70)], " ".join(f"c{i}" for i in range(30))
    rows = []
    for i in range(120):
        own = list(base)
        for at in rng.integers(0, 70, int(rng.integers(0, 5))):
            own[at] = f"own{rng.integers(0, 40)}"
        rows.append((i, " ".join(own)))
    rows += [(200 + i, f"{common} " + " ".join(f"x{i}y{k}" for k in range(int(rng.integers(1, 60))))) for i in range(60)]
    rows += [(300 + i, " ".join(f"s{k}" for k in range(int(rng.integers(8, 16))))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 16)
    rule = jaccard.Rule(3, 80, 100, part=20)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs, rule).collect()}
    assert got == brute_components(rows, rule)


@pytest.mark.parametrize("rule", [jaccard.Rule(3, 90, 100), jaccard.Rule(5, 80, 100)])
def test_similar_sets_share_an_entry_with_room(rule):
    rng = np.random.default_rng(2)
    for _ in range(600):
        n = int(rng.integers(1, rng.choice([12, 24, 300])))
        m = int(rng.integers(rule.least(n), rule.most(n) + 1))
        both = rule.overlap(n, m)
        if 0 < both <= min(n, m) < n + m - both:
            a, b = rng.permutation(n), rng.permutation(m)  # shared shingles are the first `both` numbers
            order = rng.permutation(n + m)
            a, b = sorted(a, key=lambda x: order[x]), sorted((x if x < both else n + x - both for x in b), key=lambda x: order[x])
            i, j = next((a.index(x), b.index(x)) for x in a if x in b)
            assert i < rule.prefix(n) and j < rule.prefix(m) and min(n - i, m - j) >= both
            assert abs(rule.class_of(n) - rule.class_of(m)) <= 1
            for boundary in (jaccard.MOST_LIGHT, max(n, m)):
                if max(n, m) <= min(boundary, jaccard.MOST_LIGHT):
                    assert both in rule.subset_sizes(n, boundary) and both in rule.subset_sizes(m, boundary)


def test_boundary_is_the_one_of_least_cost():
    rule = jaccard.Rule(3, 90, 100)
    assert jaccard.choose_boundary({n: (100, 100.0 * 2) for n in range(1, 25)}, rule) < 15
    assert jaccard.choose_boundary({n: (100, 100.0 * 10**6) for n in range(1, 25)}, rule) == jaccard.MOST_LIGHT
    assert jaccard.choose_boundary({}, rule) == 0


def test_words_that_defeat_polynomial_hashes(spark):
    """Thue-Morse words collide under every polynomial modulo 2**64."""
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, morse), (2, morse.translate(str.maketrans("ab", "ba"))), (3, morse.upper())]
    got = {r.doc_id: r.component_id for r in jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_words_of_long_texts(monkeypatch):
    text = "Ab \t" + "x" * 50 + "  é\u2003y\x0b" * 30 + "end"
    want = jaccard.word_hashes(text).tolist()
    monkeypatch.setattr(jaccard, "CHUNK", 7)
    assert jaccard.word_hashes(text).tolist() == want and len(want) == len(words(text))


def test_jaccard_of_chains_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(5, " ".join(base)), (5, "something else entirely here now"), (9, " ".join(base)), (2, "Something ELSE entirely here now"), (None, " ".join(base))]
    got = {(r.doc_id, r.component_id) for r in jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 2), (9, 2), (2, 2), (None, None)}


def test_jaccard_of_nothing(nothing):
    assert jaccard.similar_documents(nothing).collect() == []
