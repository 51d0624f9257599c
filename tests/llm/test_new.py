"""Whitening, token files and fill-in-middle against brute force."""

import hashlib
import random
import uuid
import zlib

import duckdb
import numpy as np
import pytest
import regex

from vesselflow.llm import _common as C
from vesselflow.llm import fill_middle, wavelet, whitening

SF = "/root/testdata/sf0.001"


def whitened(spark, rows, k=32, schema="vec_id long, embedding array<float>, label int, n string, x int"):
    return whitening.whiten(spark.createDataFrame(rows, schema).repartition(5), k)


def check_whitening(rows, got, k):
    """Against the covariance formed in the driver."""
    good = [(i, v) for i, v, *_ in rows if v and all(e is not None and np.isfinite(e) for e in v)]
    x = np.floor(64 * np.array([np.array(v, dtype=np.float32).astype(float) for _, v in good])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    want = c @ vectors / np.sqrt(values)
    assert len(got) == n * len(values)
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
    for j in range(len(values)):
        mine = np.array([by[j + 1][i].whitened for i, _ in good])
        assert min(np.abs(mine - want[:, j]).max(), np.abs(mine + want[:, j]).max()) < 1e-8
        assert abs(by[j + 1][good[0][0]].explained - values[j] / np.trace(c.T @ c / n)) < 1e-9
    for i, row in zip([i for i, _ in good], x.tolist(), strict=True):
        assert by[1][i].deviation == sum((n * v - t) ** 2 for v, t in zip(row, s.tolist(), strict=True))
    assert {(r.n, r.identity_error) for r in got} == {(n, got[0].identity_error)} and got[0].identity_error < 1e-9


@pytest.mark.parametrize(("d", "k", "fall"), [(8, 3, 0.9), (8, 32, 1.0), (120, 4, 0.7), (120, 5, 0.97)])
def test_whitening_equals_brute_force(spark, d, k, fall):
    rng = np.random.default_rng(d + k)
    x = rng.standard_normal((600, d)) * fall ** np.arange(d) @ np.linalg.qr(rng.standard_normal((d, d)))[0] * 8 + 3
    rows = [(i, v.tolist(), 0, "a", 1) for i, v in enumerate(x.astype(np.float32))]
    odd = [None, [], [None] * d, [float("nan")] * d, [1.0] * (d - 1) + [float("-inf")]]
    check_whitening(rows, whitened(spark, rows + [(1000 + i, v, None, None, None) for i, v in enumerate(odd)], k).collect(), min(d, k))


def test_whitening_iterates_on_falling_spectra_and_widens_on_flat_ones(spark, monkeypatch):
    rng = np.random.default_rng(1)
    for fall, wide in ((0.5, False), (1.0, True)):
        x = (rng.standard_normal((500, 64)) * fall ** np.arange(64) * 2000).astype(np.float32)
        blocks, dims = whitening.blocked(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"))
        n, s = whitening.totals(blocks, dims)
        widths = []
        plain = whitening.product
        monkeypatch.setattr(whitening, "product", lambda b, n, s, q: (widths.append(q.shape[1]), plain(b, n, s, q))[1])
        values, y, trace, passes = whitening.principal(blocks, n, s, 3)
        monkeypatch.setattr(whitening, "product", plain)
        assert passes == len(widths) > 1 and (max(widths) == 64) == wide
        v = np.cov((np.floor(64 * x.astype(float))).T, bias=True)
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:3], rtol=1e-10) and abs(trace / np.trace(v) - 1) < 1e-10
        assert np.abs(v @ y - y * values).max() < 1e-9 * values[0]


def test_whitening_of_odd_tables(spark):
    assert whitened(spark, []).count() == 0 and whitened(spark, [(1, None, 0, "", 0)]).count() == 0
    assert whitened(spark, [(1, [1.0, 2.0], 0, "", 0)]).count() == 0
    assert whitened(spark, [(i, [1.0, 2.0], 0, "", 0) for i in range(9)]).count() == 0
    got = whitened(spark, [(None if i < 3 else 7, [float(i), 2.0 * i], 0, "", 0) for i in range(9)] + [(8, [1.0], 0, "", 0)]).collect()
    assert len(got) == 9 and sum(r.vec_id is None for r in got) == 3  # one direction varies
    big = whitened(spark, [(i, [float(i % 2) * 1e30, float(i)], 0, "", 0) for i in range(400)]).collect()
    assert len(big) == 800 and all(r.deviation is None or r.deviation >= 0 for r in big)


def test_partial_sums_are_added_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rows = [(i, [float(i % 7), float(i % 5)], 0, "", 0) for i in range(200)]
    check_whitening(rows, whitened(spark, rows, 2).collect(), 2)


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return str(public_tokenizers.path(wavelet.VOCABULARY)), Tokenizer.from_file(str(public_tokenizers.path(wavelet.VOCABULARY)))


def test_ids_are_those_of_the_library(texts, monkeypatch):
    path, plain = tokenizer()
    rng = random.Random(2)
    bits = ["a", "É", "ß", " ", "  ", "\n", "\t", "'s", "'ll", "9", "日本", " ", " ", "<|endoftext|>", "!", "...", "\x1c", "\x85", "ǅ", "🙂", "don't", " the", "́", "\x00"]
    odd = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    encode = wavelet.Encoder(path)
    texts = [t for _, t in texts] + odd
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, wavelet.END] for t in texts]
    assert [x.tolist() for x in encode.batch(texts)] == want
    assert [encode(t).tolist() for t in texts] == want
    monkeypatch.setattr(wavelet, "SLICE", 500)
    monkeypatch.setattr(wavelet, "KNOWN", 40)
    assert [x.tolist() for x in wavelet.Encoder(path).batch(texts)] == want
    assert wavelet.Encoder(path).batch([]) == []
    assert encode(None).tolist() == encode("").tolist() == [wavelet.END]


@pytest.mark.parametrize(("n", "most"), [(0, 1), (1, 1), (5000, 2), (5000, 50257), (40_000, 300)])
def test_wavelet_matrix(n, most, monkeypatch):
    monkeypatch.setattr(wavelet, "CHUNK", 1 << 10)
    rng = np.random.default_rng(n + most)
    ids = (rng.integers(0, most, n) * rng.random(n) ** 3).astype("<u4")
    shard = wavelet.Shard(wavelet.pack(ids, [(None, n // 2), (7, n - n // 2)]))
    assert (shard.tokens() == ids).all() and shard.doc_ids == [None, 7] and shard.lengths.tolist() == [n // 2, n - n // 2]
    for i in rng.integers(0, n, 50 if n else 0):
        assert shard.access(int(i)) == ids[i]
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        token = int(ids[i])
        assert shard.count(token, a, b) == (ids[a:b] == token).sum()
        if (ids == token).sum() < 300:
            assert shard.places(token, a, b) == (np.flatnonzero(ids[a:b] == token) + a).tolist()
    assert shard.count(1 << 20) == 0 and shard.count(most + 3) == 0 and shard.places(-1) == []
    with pytest.raises(IndexError):
        shard.access(n)
    if n:
        assert (shard.document(0) == ids[: n // 2]).all() if n < 6000 else True


def expected(texts):
    _, plain = tokenizer()
    start = 0
    for i, t in texts:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, wavelet.END], dtype="<u4")
        yield (i, start, len(ids), zlib.crc32(ids.tobytes())), ids.tolist()
        start += len(ids)


def test_token_files(spark, documents, nothing, texts, tmp_path):
    path, _ = tokenizer()
    folder = f"file://{tmp_path}/tokens"
    manifest = wavelet.write_shards(documents, folder, path, shard=3000)
    assert manifest.count() > 5 and manifest.where("n_tokens > 3000 AND n_docs > 1").count() == 0
    (tmp_path / "tokens" / f"part-000000-000000-{uuid.uuid4().hex}.wm").write_bytes(b"of a lost task")
    want = list(expected(sorted(texts)))
    assert sorted(map(tuple, wavelet.read_documents(manifest).collect())) == [w for w, _ in want]
    assert {r.doc_id: r.ids for r in wavelet.read_tokens(manifest).collect()} == {w[0]: ids for w, ids in want}
    some = [2, 198, 11, 257, 50_300]
    counts = {r.token: r.n for r in wavelet.count_tokens(manifest, some).collect()}
    assert counts == {t: sum(ids.count(t) for _, ids in want) for t in some}
    places = sorted((r.token, r.doc_id, r.place) for r in wavelet.find_tokens(manifest, some[1:]).collect())
    assert places == sorted((t, w[0], p) for w, ids in want for p, t in enumerate(ids) if t in some[1:])
    empty = wavelet.write_shards(nothing, f"file://{tmp_path}/none", path)
    assert empty.count() == 0 and wavelet.read_documents(empty).count() == 0 and wavelet.count_tokens(empty, [1]).count() == 0


def test_ids_are_asked_for_without_places(texts):
    """Places in the text are half of the library's work and no one needs them."""
    path, plain = tokenizer()
    encode, asked = wavelet.Encoder(path), []

    class Fast:
        def encode_batch_fast(self, some, add_special_tokens):
            asked.extend(some)
            return plain.encode_batch_fast(some, add_special_tokens=add_special_tokens)

    encode.tokenizer = Fast()
    got = encode.batch([t for _, t in texts])
    assert asked and [x.tolist() for x in got] == [[*plain.encode(t or "", add_special_tokens=False).ids, wavelet.END] for _, t in texts]


def test_words_reach_the_library_once_and_in_pieces():
    """A word with marks behind it is the word; letters, digits and other characters need no search for pieces."""
    path, plain = tokenizer()
    encode, asked = wavelet.Encoder(path), []

    class Pieces:
        def encode_batch_fast(self, some, add_special_tokens):
            asked.extend(some)
            return pieces.encode_batch_fast(some, add_special_tokens=add_special_tokens)

    pieces, encode.pieces = encode.pieces, Pieces()
    texts = ["a zorbel, zorbel. zorbel! zorbel? zorbel; zorbel: (zorbel) zorbel\n" * 3, "b torvel9x, Éclatéȿ ×÷ q×r it's, |<|endoftext|> <|endoftext|>, ok."]
    want = [[*plain.encode(t, add_special_tokens=False).ids, wavelet.END] for t in texts]
    assert [x.tolist() for x in encode.batch(texts)] == want
    assert asked and "".join(asked).split().count("Ġzorbel") == 1 and "Ġtorvel\n9\nx" in asked[0] and "'" not in asked[0] and "endoftext" not in asked[0]
    rng = random.Random(8)
    bits = [" ", " ", "\n", "\r", "\x7f", "\u00a0", ",", ".", "?", "!", ")", "'", "|", "_", "s", "ll", "Ab", "7", "×", "÷", "é", "ɐ", "ƻ", "ȿ", "̀", "<|endoftext|>"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    want = [[*plain.encode(t, add_special_tokens=False).ids, wavelet.END] for t in texts]
    assert [x.tolist() for x in wavelet.Encoder(path).batch(texts)] == want
    import pyarrow as pa

    whole = pa.array(["x", None, *texts, "y"])
    assert [x.tolist() for x in wavelet.Encoder(path).batch(whole[1:-1])] == [[wavelet.END], *want]


def test_token_files_of_repeated_and_null_ids(spark, tmp_path):
    path, _ = tokenizer()
    rows = [(None, "a b"), (5, "same"), (5, "same"), (5, "other words"), (None, None), (-3, "x")] * 3
    got = wavelet.read_documents(wavelet.write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), f"file://{tmp_path}/t", path)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 6 + [-3] * 3 + [5] * 9
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()


def test_op12_whole_table(spark):
    docs = duckdb.execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    got = wavelet.op12_token_files(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == [w for w, _ in expected(docs)]


def plain_fim(doc, text, seed=1):
    """By lists of characters."""
    text, h = text or "", hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    a, b, c, d = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    chars, n = list(text), len(text)
    p, q = min(a % (n + 1), b % (n + 1)), max(a % (n + 1), b % (n + 1))
    pre, mid, suf = ("".join(x) for x in (chars[:p], chars[p:q], chars[q:]))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or c % 100 >= 90:
        form, out, p, q = "plain", text, None, None
    elif d % 100 < 20:
        form, out = "spm", "<S>" + suf + "<P>" + pre + "<M>" + mid
    else:
        form, out = "psm", "<P>" + pre + "<S>" + suf + "<M>" + mid
    return (doc, n, form, p, None if p is None else q - p, out, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_fill_in_middle(spark, documents, nothing, texts):
    more = [(None, "no id"), (200, "a<P>b"), (201, "<S>"), (202, "<M"), (203, "<<P"), (204, "🙂é" * 40), (205, "same"), (205, "same"), (206, "a\x00b\r\n")]
    more += [(300 + i, "<" * (i % 5) + "S>" + ">P<M" * (i % 3) + "<P") for i in range(60)]
    docs = documents.select("doc_id", "text", "n").unionByName(spark.createDataFrame(more, "doc_id long, text string").selectExpr("*", "1L AS n"))
    got = sorted(map(repr, (tuple(r) for r in fill_middle.fill_in_middle(docs).collect())))
    want = [plain_fim(i, t) for i, t in texts + more]
    assert got == sorted(map(repr, want)) and {w[2] for w in want} == {"plain", "spm", "psm"}
    assert fill_middle.fill_in_middle(nothing).count() == 0
    assert "output" not in fill_middle.fill_in_middle(docs, with_output=False).columns


def test_fill_in_middle_of_words(spark):
    unit = regex.compile(r"\w+\s*")
    for i in range(40):
        n, form, p, m, out = fill_middle.transform(i, "one two, three\nfour  five", unit, cut=100)
        assert n == 5 and fill_middle.restore(out, form) == "one two, three\nfour  five"
        assert p in (0, 4, 7, 15, 21, 25) and p + m in (0, 4, 7, 15, 21, 25)


def test_op13_equals_its_sql(spark):
    frame = fill_middle.op13_fill_in_middle(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    asked = con.execute(fill_middle.SQL["op13_fill_in_middle"])
    names = [d[0] for d in asked.description]
    assert names == frame.columns and sorted(map(repr, asked.fetchall())) == sorted(map(repr, (tuple(r) for r in frame.collect())))


def test_op11_whole_table(spark):
    rows = duckdb.execute(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    check_whitening(rows, whitening.op11_embedding_whitening(spark, SF).collect(), 32)
    assert C.shared_dir(spark)
