"""Removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

Sorting all suffixes of a corpus is out of reach, and nearly all of them are unique. So the places are narrowed down
first, without loss: every string of `length` bytes has a least hash among its `GRAM`-byte pieces, equal strings have it
at equal offsets, and consecutive starts with the same piece form a run. Only pieces met more than once can lie in
repeated strings. Runs with all their bytes equal are one string with a count. Where a piece occurs in different
surroundings, the runs' bytes are dealt out by their common core, and each group of distinct strings is settled by
Burrows-Wheeler transforms: one per shard, merged by interleave refinement. A pass of the refinement stably sorts the
interleave by the symbols that the transforms hold, which orders the suffixes by one symbol more and splits the
intervals of equal prefixes; after `length` passes, the intervals of two or more suffixes are the repeated strings.
No suffix of one shard is sorted again with those of others. Groups too large for a task are dealt out again by halves
of their starts, which share a longer core, as often as needed; where one start is left, the core is the whole string,
and equal ones are counted. Pieces, strings and cores that very many rows hold are joined by broadcast, apart from others.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

U = np.uint64
LENGTH = 200
GRAM = 32
SEGMENT = 1 << 20
OFFSETS = 64
SHARDS = 4
BATCH = 50_000
#: Strings of a group that one task settles.
HOT = 20_000
#: A key is frequent if it has more than this fraction of all rows: there can't be more such keys than its inverse.
FREQUENT = 1 / 2000
BASE = 0x9E3779B97F4A7C55 | 1
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables:
        n = SEGMENT + LENGTH + 8
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(n, base, dtype=U)
            p[0] = 1
            _tables[name] = np.multiply.accumulate(p)
        _tables["byte"] = mix(np.arange(1, 257, dtype=U))
    return _tables["up"], _tables["down"]


def runs(data: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, ...]]:
    """(piece hash, digest of the bytes, first start, last start, place of the piece) of the runs, by segments of the text."""
    up, down = _powers()
    width = length - GRAM + 1
    for at in range(0, len(data) - length + 1, SEGMENT):
        seg = data[at : at + SEGMENT + length - 1]
        x = _tables["byte"][seg]
        for m in (1, 2, 4, 8, 16):
            x = x[:-m] * up[2 * m + 1] + x[m:]
        x = mix(x)
        # Hash above, place below: the least is the first of equal ones.
        v = (x & ~U((1 << 24) - 1)) | np.arange(len(x), dtype=U)
        m = 1
        while 2 * m <= width:
            v = np.minimum(v[:-m], v[m:])
            m *= 2
        v = np.minimum(v[: len(x) - width + 1], v[width - m :])
        cut = np.flatnonzero(v[1:] != v[:-1]) + 1
        lo = np.concatenate([[0], cut])
        hi = np.concatenate([cut, [len(v)]]) - 1
        place = (v[lo] & U((1 << 24) - 1)).astype(np.int64)
        sums = np.zeros(len(seg) + 1, dtype=U)
        np.cumsum((seg.astype(U) + U(1)) * up[: len(seg)], out=sums[1:])
        digest = mix((sums[hi + length] - sums[lo]) * down[lo] + U(0x51ED27) * (hi - lo + 1).astype(U))
        yield x[place], digest, lo + at, hi + at, place + at


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "replace") if text else b""


def _rows(*columns, names: list[str]) -> pa.RecordBatch:
    arrays = [pa.array(c.view(np.int64)) if isinstance(c, np.ndarray) and c.dtype == U else c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names)


def all_runs(docs: DataFrame, length: int) -> DataFrame:
    """h, digest, doc_id, lo, hi, place of every run of every text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = np.frombuffer(_bytes(text.as_py()), dtype=np.uint8)
                for h, d, lo, hi, place in runs(data, length) if len(data) >= length else ():
                    out.append((h, d, np.full(len(h), doc, dtype=np.int64), lo, hi, place))
                if sum(len(x[0]) for x in out) > 50_000:
                    yield _rows(*(np.concatenate(c) for c in zip(*out, strict=True)), names=["h", "digest", "doc_id", "lo", "hi", "place"])
                    out = []
            if out:
                yield _rows(*(np.concatenate(c) for c in zip(*out, strict=True)), names=["h", "digest", "doc_id", "lo", "hi", "place"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(scan, "h long, digest long, doc_id long, lo long, hi long, place long")


def symbol_ranks(sym: np.ndarray, nxt: np.ndarray, width: int) -> np.ndarray:
    """Rank of the `width` symbols from each place on."""
    key, step = sym.astype(np.int64), nxt
    for k in range(1, width):
        key = key * 257 + sym[step]
        step = nxt[step]
        if k == 5:
            key = np.unique(key, return_inverse=True)[1]
    return np.unique(key, return_inverse=True)[1]


def shard_order(ranks: np.ndarray, width: int, nxt: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Places `at` of a shard, in the order of their rotations by `length` symbols at least. ranks: of `width` symbols."""
    step = nxt
    for _ in range(width - 1):
        step = nxt[step]
    own, done = np.zeros(len(ranks), dtype=np.int64), width
    own[at] = ranks[at]
    while done < length:
        own[at] = np.unique(own[at] * len(ranks) + own[step[at]], return_inverse=True)[1]
        step, done = step[step], done * 2
    return at[np.argsort(own[at], kind="stable")]


def repeated_starts(strings: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """For each string, which of its starts have `length` bytes that start elsewhere among the strings too.

    A symbol of the transforms is a piece of several bytes, each place being followed by the piece before it, so that a
    pass orders by that many bytes; pieces are as long as their ranks fit 16 bits, which sort by radix.
    """
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes)
    first = ends - sizes
    n = int(ends[-1])
    sym = np.zeros(n, dtype=np.int64)
    body = np.ones(n, dtype=bool)
    body[ends - 1] = False  # each string ends with the least symbol and goes round
    sym[body] = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int64) + 1
    nxt = np.arange(1, n + 1)
    nxt[ends - 1] = first
    prev = np.arange(-1, n - 1)
    prev[first] = ends - 1
    for width in (w for w in (8, 5, 4, 2, 1) if length % w == 0):
        ranks = symbol_ranks(sym, nxt, width)
        if ranks.max() < 1 << 16:
            break
    ranks16 = ranks.astype(np.uint16)
    back = prev
    for _ in range(width - 1):
        back = prev[back]
    shards = min(shards, len(strings))
    shard = np.repeat(np.arange(len(strings)) % shards, sizes)
    orders = [shard_order(ranks, width, nxt, np.flatnonzero(shard == s), length) for s in range(shards)]
    transforms = [ranks16[back[order]] for order in orders]

    z = np.repeat(np.arange(shards, dtype=np.uint8), [len(order) for order in orders])
    block, n_blocks = np.zeros(n, dtype=np.int32), 1
    c = np.empty(n, dtype=np.uint16)
    for _ in range(length // width):
        for s, transform in enumerate(transforms):
            c[z == s] = transform
        move = np.argsort(c, kind="stable")
        z, c_new, old = z[move], c[move], block[move]
        new = np.empty(n, dtype=bool)
        new[0] = False
        new[1:] = (c_new[1:] != c_new[:-1]) | (old[1:] != old[:-1])
        block = np.cumsum(new, dtype=np.int32)
        if block[-1] + 1 == n_blocks:  # intervals no longer split
            break
        n_blocks = int(block[-1]) + 1
    place = np.empty(n, dtype=np.int64)
    for s, order in enumerate(orders):
        place[z == s] = order
    often = np.empty(n, dtype=bool)
    often[place] = np.bincount(block)[block] > 1
    return [often[a : a + max(0, k - length)] for a, k in zip(first, sizes, strict=True)]


def cut_runs(found: DataFrame, length: int) -> DataFrame:
    """key, doc_id, start, bytes, multi, rel of the parts of the runs in `runs` (found: doc_id, text, runs), by blocks of offsets.

    rel: the place of the part's first start in its block.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, some in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = _bytes(text.as_py())
                for r in some:
                    for block in range((r["place"] - r["hi"]) // OFFSETS, (r["place"] - r["lo"]) // OFFSETS + 1):
                        last, one = r["place"] - OFFSETS * block, r["place"] - OFFSETS * block - OFFSETS + 1
                        a, b = max(one, r["lo"]), min(last, r["hi"])
                        if a > b or b + length > len(data):
                            continue
                        core = hashlib.blake2b(data[last : one + length], digest_size=8, salt=block.to_bytes(4, "little")).digest()
                        out.append((int.from_bytes(core, "little", signed=True), doc, a, data[a : b + length], r["multi"], a - one))
                if len(out) > 5_000:
                    yield _parts(out)
                    out = []
            if out:
                yield _parts(out)

    return found.select("doc_id", "text", "runs").mapInArrow(scan, PARTS)


PARTS = "key long, doc_id long, start long, bytes binary, multi boolean, rel int"


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    key, doc, start, data, multi, rel = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(data, pa.binary()), pa.array(multi, pa.bool_()), pa.array(rel, pa.int32())], ["key", "doc_id", "start", "bytes", "multi", "rel"])


def _spans(starts: np.ndarray, often: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], often.astype(np.int8), [0]]))
    return [(int(starts + a), int(starts + b - 1)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def merge_groups(parts: DataFrame, length: int) -> DataFrame:
    """doc_id, lo, hi: ranges of repeated starts, from the groups of equal key in `parts`."""

    def settle(groups: list[list[tuple]]) -> Iterator[tuple]:
        strings, owners = [], []
        for rows in groups:
            by: dict[bytes, list[tuple]] = {}
            for row in rows:
                by.setdefault(row[3], []).append(row)
            several = len(by) > 1
            for data, own in by.items():
                if len(own) > 1 or any(r[4] for r in own):
                    for r in own:
                        yield r[1], r[2], r[2] + len(data) - length
                    own = []
                if several:
                    strings.append(data)
                    owners.append(own)
        if strings:
            for own, often in zip(owners, repeated_starts(strings, length), strict=True):
                for r in own:
                    for lo, hi in _spans(r[2], often):
                        yield r[1], lo, hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(groups):
            out = list(settle(groups))
            if out:
                doc, lo, hi = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, lo, hi)], ["doc_id", "lo", "hi"])

        groups, size = [], 0
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "start", "bytes", "multi")), strict=True))
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            group = list(group)
            groups.append(group)
            size += sum(len(r[3]) for r in group)
            if size > BATCH:
                yield from flush(groups)
                groups, size = [], 0
        yield from flush(groups)

    spark = parts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, "key").sortWithinPartitions("key").select("key", "doc_id", "start", "bytes", "multi").mapInArrow(run, "doc_id long, lo long, hi long")


def joined(rows: DataFrame, keyed: DataFrame, key: list[str], count: str) -> DataFrame:
    """Inner join of staged `rows` with staged `keyed`: one row a key, with the number of `rows` that hold it.

    Frequent keys are broadcast, so that their rows stay where they are; the others are shuffled.
    """
    often = F.col(count) > FREQUENT * rows.count()
    hot = F.broadcast(keyed.where(often))
    rare = rows.join(F.broadcast(keyed.where(often).select(*key)), key, "left_anti").join(keyed.where(~often), key)
    return rows.join(hot, key).unionByName(rare)


def halves(parts: DataFrame, length: int, width: int) -> DataFrame:
    """`parts` of groups of `width` starts, cut into two groups of half as many, by cores that are longer by as much."""
    half, o, n = width // 2, F.col("o"), F.length("bytes") - length
    cut = parts.withColumn("o", F.explode(F.array(F.lit(0), F.lit(half))))
    cut = cut.withColumn("a", F.greatest("rel", o)).withColumn("b", F.least(F.col("rel") + n, o + half - 1)).where("a <= b")
    core = F.substring(F.col("bytes"), o + half - F.col("rel"), F.lit(length - half + 1))
    return cut.select(
        F.xxhash64("key", "o", core).alias("key"),
        "doc_id",
        (F.col("start") + F.col("a") - F.col("rel")).alias("start"),
        F.substring(F.col("bytes"), F.col("a") - F.col("rel") + 1, F.col("b") - F.col("a") + length).alias("bytes"),
        "multi",
        (F.col("a") - o).alias("rel"),
    )


def settled_ranges(parts: DataFrame, length: int) -> DataFrame:
    """doc_id, lo, hi: ranges of repeated starts of the strings in `parts` (staged), whatever the size of their groups."""
    out, width = None, OFFSETS
    while True:
        groups = C.stage(parts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
        placed = joined(parts, groups, ["key"], "n")
        some = merge_groups(placed.where(F.col("n") <= HOT), length)
        out = some if out is None else out.unionByName(some)
        if (groups.agg(F.max("n")).first()[0] or 0) <= HOT:
            return out
        parts, width = C.stage(halves(placed.where(F.col("n") > HOT), length, width)), width // 2
        if width == 1:  # of equal cores only equal strings are left
            same = C.stage(parts.groupBy("bytes").agg(F.count("*").alias("n"), F.max("multi").alias("many")).where("n > 1 OR many"))
            last = joined(parts, same, ["bytes"], "n")
            return out.unionByName(last.select("doc_id", F.col("start").alias("lo"), F.col("start").alias("hi")))


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, lo, hi: ranges of starts whose `length` bytes start anywhere else too. doc_id must be unique."""
    found = C.stage(all_runs(docs, length))
    pieces = found.groupBy("h").agg(F.count("*").alias("c"), (F.min("digest") == F.max("digest")).alias("one"))
    shared = C.stage(joined(found, C.stage(pieces.where("c > 1")), ["h"], "c").drop("c"))
    mixed = shared.where("NOT one")
    strings = C.stage(mixed.groupBy("h", "digest").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "lo", "hi", "place")).alias("r")))
    copies = joined(mixed, strings.where("c > 1").select("h", "digest", "c"), ["h", "digest"], "c")
    whole = shared.where("one").select("doc_id", "lo", "hi").unionByName(copies.select("doc_id", "lo", "hi"))

    asked = strings.select("r.doc_id", F.struct("r.lo", "r.hi", "r.place", (F.col("c") > 1).alias("multi")).alias("run"))
    asked = asked.groupBy("doc_id").agg(F.collect_list("run").alias("runs"))
    texts = C.maybe_in(docs.select("doc_id", "text"), asked, "doc_id").join(asked, "doc_id")
    return whole.unionByName(settled_ranges(C.stage(cut_runs(texts, length)), length))


def keyed(docs: DataFrame) -> DataFrame:
    """key, doc_id, text: the key is doc_id where that tells all rows apart, else a number given to each row."""
    told = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    rows = docs.select("doc_id", "text")
    if told.isEmpty():
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text")
    # Written, so that all readings of the rows agree on their numbers.
    return C.stage(rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), keep=True)


def clean(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary) of every row of `docs` (doc_id, text).

    A null text is empty; texts shorter than `length` bytes keep all. Each row is a text of its own: equal rows, rows with
    one doc_id and rows without are copies of each other like any others.
    """
    with C.scratch(docs.sparkSession):
        mine = keyed(docs)
        ranges = repeated_ranges(mine.select(F.col("key").alias("doc_id"), "text"), length)
        ranges = ranges.groupBy(F.col("doc_id").alias("key")).agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
        ranges = C.stage(ranges, keep=True)
    out = mine.join(ranges, "key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, rows = whole.slice(at, 256), []
                for doc, text, some in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                    data = _bytes(text.as_py())
                    edge = np.zeros(len(data) + 1, dtype=np.int64)
                    if some.is_valid:
                        flat = some.values
                        lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
                        np.add.at(edge, np.minimum(lo, len(data)), 1)
                        np.add.at(edge, np.minimum(hi + length, len(data)), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                    spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
                    rows.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                doc, n, removed, spans, sha, kept = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return out.select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(C.table(spark, sf_dir, "documents")).drop("kept")
