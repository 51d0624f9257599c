"""Edited copies of pictures by local descriptors, Hamming tables and geometric consensus.

A picture is a binary PGM (P5, 8 bit). Corners (maxima of their neighbourhood, as many as the picture has) are found on
a pyramid of scales down to the smallest usable size; each is turned to the direction of its patch's centroid, and 128
comparisons of smoothed pixels give its descriptor. Descriptors within `MAX_BITS` of each other are matches: all of them
are found, by tables of five disjoint chunks of bits probed up to one bit away. A match says how the query lies on the
picture (turn, scale, place). Matches of a pair that agree on that refit one similarity transform, and the pair is
reported when enough corners of the query follow it. Equal pictures are found by digest first and stand for each other.

The corners of the queries go out in blocks of bounded size; a task describes its pictures, matches them with the block
and settles each pair on the spot, as all corners of a picture and of a query are together there. Nothing but the found
pairs is shuffled, so that common descriptors and large groups of copies crowd no task.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C
from vesselflow.llm.components import components

#: Each step of the pyramid is smaller by this.
STEP = 0.84
DENSE = 3
RADIUS = 8
#: A corner is the strongest within this distance along either axis.
APART = 4
TURNS = 72
TESTS = 128
POOL = 1000
MAX_BITS = 9
#: Places that must agree.
MIN_AGREE = 5
#: Corners nearer than about this count once.
SPOT = 6.0
#: Two descriptors at most MAX_BITS apart are at most MAX_BITS // len(CHUNKS) = PROBED apart in one of the disjoint chunks.
CHUNKS = (26, 26, 26, 25, 25)
PROBED = MAX_BITS // len(CHUNKS)
_starts = [sum(CHUNKS[:i]) for i in range(len(CHUNKS))]
BUCKET_BITS = 21
#: Corners of the queries in one block, candidates compared at once, and pictures described and matched at once.
QUERY_BLOCK = 1 << 18
CANDIDATES = 1 << 17
#: Entries of a table counted at once.
COUNTED = 1 << 20
PICTURES, MATCHED = 20, 500

_disk = np.array([(y, x) for y in range(-6, 7) for x in range(-6, 7) if y * y + x * x <= 36])
#: Pictures of a smaller side have too little detail to tell corners apart.
SMALLEST = 30
CORNER = np.dtype([("x", "<f4"), ("y", "<f4"), ("scale", "<f4"), ("turn", "<i4"), ("d0", "<i8"), ("d1", "<i8")])


def to_pgm(pixels: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % (pixels.shape[1], pixels.shape[0]) + pixels.astype(np.uint8).tobytes()


def from_pgm(data: bytes | None) -> np.ndarray | None:
    """Pixels, or None for what is no whole 8-bit PGM."""
    head = re.match(rb"P5\s+(\d+)\s+(\d+)\s+255\s", data or b"")
    if not head:
        return None
    w, h = int(head[1]), int(head[2])
    return np.frombuffer(data, np.uint8, w * h, head.end()).reshape(h, w) if w * h and len(data) >= head.end() + w * h else None


@functools.lru_cache(maxsize=1024)
def _weights(n: int, scale: float) -> np.ndarray:
    """Rows of triangle-filter weights that bring n pixels to about n * scale."""
    at = (np.arange(max(1, round(n * scale))) + 0.5) / scale - 0.5
    w = np.maximum(0, 1 - np.abs(at[:, None] - np.arange(n)) * min(1.0, scale)).astype(np.float32)
    return w / np.maximum(w.sum(axis=1, keepdims=True), 1e-6)


def resize(a: np.ndarray, scale: float) -> np.ndarray:
    """Picture, or stack of pictures, at another scale."""
    return a if scale == 1.0 else np.matmul(np.matmul(_weights(a.shape[-2], scale), a), _weights(a.shape[-1], scale).T)


def _sum3(a: np.ndarray) -> np.ndarray:
    """Sums over squares of three; one pixel of border is lost."""
    high = a[..., :-2, :] + a[..., 1:-1, :]
    high += a[..., 2:, :]
    wide = high[..., :-2] + high[..., 1:-1]
    wide += high[..., 2:]
    return wide


def _highest(a: np.ndarray, reach: int) -> np.ndarray:
    """Maximum within `reach` along either axis; so many pixels of border are lost."""
    for axis in (-2, -1):
        width = 1
        cut = lambda x, lo, hi, axis=axis: x[..., lo : x.shape[-2] - hi, :] if axis == -2 else x[..., lo : x.shape[-1] - hi]
        while width < 2 * reach + 1:
            step = min(width, 2 * reach + 1 - width)
            a = np.maximum(cut(a, 0, step), cut(a, step, 0))
            width += step
    return a


def _found(s: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(picture, place in the flattened s, turn) of the corners. s begins one pixel inside the picture, r three."""
    m = RADIUS + 1 - 3
    inner, near = (r[:, k : r.shape[1] - k, k : r.shape[2] - k] for k in (m, m - APART))
    pic, y, x = np.nonzero((inner >= _highest(near, APART)) & (inner > 1.0))
    width = s.shape[2]
    at = (y + RADIUS) * width + x + RADIUS
    patch = s.take((pic * s[0].size + at)[:, None] + (_disk[:, 0] * width + _disk[:, 1]), mode="clip")
    turn = np.arctan2(patch @ _disk[:, 0].astype(np.float32), patch @ _disk[:, 1].astype(np.float32))
    return pic, at, np.rint(turn / (2 * np.pi) * TURNS).astype(np.int64) % TURNS


def _smooth(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed pictures (one pixel of border lost) and how much each place is a corner (three lost)."""
    s = _sum3(a)
    gy, gx = s[:, 2:, 1:-1] - s[:, :-2, 1:-1], s[:, 1:-1, 2:] - s[:, 1:-1, :-2]
    xx, yy, xy = _sum3(gx * gx), _sum3(gy * gy), _sum3(gx * gy)
    # In place, as fresh arrays cost more than the sums.
    r = xx * yy
    xy *= xy
    r -= xy
    trace = np.add(xx, yy, out=xx)
    np.multiply(trace, 0.05, out=yy)
    yy *= trace
    r -= yy
    return s, r


def _values(s: np.ndarray, pic: np.ndarray, at: np.ndarray, turn: np.ndarray, points: np.ndarray) -> np.ndarray:
    """s at the points (turn, point, (x, y)) around the corners."""
    return s.take((pic * s[0].size + at)[:, None] + (points[..., 1] * s.shape[2] + points[..., 0])[turn], mode="clip")


def _turned(points: np.ndarray) -> np.ndarray:
    """Points (x, y) in all turns, on whole pixels."""
    a = 2 * np.pi * np.arange(TURNS) / TURNS
    x, y = points[:, 0], points[:, 1]
    return np.rint(np.stack([np.outer(np.cos(a), x) - np.outer(np.sin(a), y), np.outer(np.sin(a), x) + np.outer(np.cos(a), y)], axis=-1)).astype(np.int64)


@functools.lru_cache(maxsize=1)
def _tests() -> tuple[np.ndarray, np.ndarray]:
    """Both ends of the tests in all turns: of a pool of random pairs those that split the corners of random textures evenly and say different things."""
    rng = np.random.default_rng(20240601)
    pool = np.clip(rng.normal(0, 3.2, (POOL, 2, 2)), -RADIUS + 2, RADIUS - 2)
    ends = [_turned(pool[:, k]) for k in (0, 1)]
    textures = np.repeat(np.repeat(rng.integers(0, 256, (30, 40, 40)), 2, axis=1), 2, axis=2).astype(np.float32)
    rows = []
    for scale in (1.0, STEP, STEP * STEP):
        s, r = _smooth(resize(textures, scale))
        pic, at, turn = _found(s, r)
        rows.append(_values(s, pic, at, turn, ends[0]) < _values(s, pic, at, turn, ends[1]))
    bits = np.concatenate(rows).astype(np.float32)
    mean = bits.mean(axis=0)
    z = (bits - mean) / np.maximum(bits.std(axis=0), 1e-6)
    alike = np.abs(z.T @ z) / len(z)
    order, chosen, most = np.argsort(np.abs(mean - 0.5), kind="stable"), [], 0.2
    while len(chosen) < TESTS:
        for k in order:
            if len(chosen) < TESTS and k not in chosen and (not chosen or alike[k, chosen].max() < most):
                chosen.append(k)
        most += 0.05
    chosen = rng.permutation(chosen)  # so that no chunk holds the best or the worst
    return ends[0][:, chosen], ends[1][:, chosen]


def describe(stack: np.ndarray, dense: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(number of the picture, CORNER) of the corners of a stack of pictures of one size; places in pixels of the whole picture.

    A dense pyramid, for queries, has DENSE levels for one of the others and begins above the picture's size.
    """
    pics, out = [np.zeros(0, np.int64)], [np.zeros(0, CORNER)]
    scale, step = (1 / STEP, STEP ** (1 / DENSE)) if dense else (1.0, STEP)
    whole = stack.astype(np.float32)
    first, second = _tests()
    while True:
        a = resize(whole, scale)
        if min(a.shape[-2:]) < SMALLEST:
            break
        s, r = _smooth(a)
        pic, at, turn = _found(s, r)
        bits = np.packbits(_values(s, pic, at, turn, first) < _values(s, pic, at, turn, second), axis=1, bitorder="little").view(np.int64)
        found = np.empty(len(pic), CORNER)
        found["x"], found["y"] = (at % s.shape[2] + 1.5) / scale - 0.5, (at // s.shape[2] + 1.5) / scale - 0.5
        found["scale"], found["turn"], found["d0"], found["d1"] = scale, turn, bits[:, 0], bits[:, 1]
        pics.append(pic)
        out.append(found)
        scale *= step
    pics, out = np.concatenate(pics), np.concatenate(out)
    order = np.argsort(pics, kind="stable")
    return pics[order], out[order]


def corners(images: DataFrame, dense: bool = False) -> DataFrame:
    """id, tag and sha (hash and digest of the bytes), corners (CORNER items) of every picture (id, image) that has any."""
    # Edited pictures have many sizes and only those of one size are described at once.
    n = PICTURES * (len(EDITS) if dense else 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, n):
                batch = whole.slice(at, n)
                by_shape: dict[tuple, list] = {}
                for k, data in enumerate(batch.column(1)):
                    pixels = from_pgm(data.as_py())
                    if pixels is not None:
                        by_shape.setdefault(pixels.shape, []).append((k, pixels))
                rows, data = [], []
                for some in by_shape.values():
                    pic, found = describe(np.stack([p for _, p in some]), dense)
                    ends = np.searchsorted(pic, np.arange(len(some) + 1))
                    for (k, _), lo, hi in zip(some, ends[:-1], ends[1:], strict=True):
                        if hi > lo:
                            rows.append(k)
                            data.append(found[lo:hi].tobytes())
                got = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([got.column(0), got.column(2), got.column(3), pa.array(data, pa.binary())], ["id", "tag", "sha", "corners"])

    hashed = images.select("id", "image", F.xxhash64("image").alias("tag"), F.unhex(F.sha2("image", 256)).alias("sha"))
    return hashed.mapInArrow(run, "id long, tag long, sha binary, corners binary")


def _chunks(d0: np.ndarray, d1: np.ndarray) -> list[np.ndarray]:
    """The descriptors cut into disjoint chunks of bits."""
    lo, hi, out = d0.view(np.uint64), d1.view(np.uint64), []
    for at, bits in zip(_starts, CHUNKS, strict=True):
        part = hi >> np.uint64(at - 64) if at >= 64 else lo >> np.uint64(at)
        if at < 64 < at + bits:
            part = part | (hi << np.uint64(64 - at))
        out.append((part & np.uint64((1 << bits) - 1)).astype(np.int64))
    return out


def _bucket(chunk: np.ndarray) -> np.ndarray:
    """Place of a chunk in a table of 2**BUCKET_BITS; different chunks may share one, as candidates are compared anyway."""
    return ((chunk.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def probe_tables(d0: np.ndarray, d1: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per chunk (starts by bucket, rows): the rows with a value at most PROBED bits away from their chunk in the bucket."""
    out = []
    for chunk, bits in zip(_chunks(d0, d1), CHUNKS, strict=True):
        flips = [sum(1 << b for b in some) for k in range(PROBED + 1) for some in itertools.combinations(range(bits), k)]
        # (bucket, row) in one array that is filled and sorted in place, as a task has little memory beside its tables.
        both = np.empty((len(flips), len(chunk)), dtype="<i8")
        for place, flip in zip(both, flips, strict=True):
            np.left_shift(_bucket(chunk ^ flip), 32, out=place)
            place |= np.arange(len(chunk))
        both = both.reshape(-1)
        both.sort()
        starts = np.zeros((1 << BUCKET_BITS) + 1, dtype=np.int32)
        for at in range(0, len(both), COUNTED):
            bucket = both[at : at + COUNTED] >> 32
            starts[bucket[0] + 1 : bucket[-1] + 2] += np.bincount(bucket - bucket[0]).astype(np.int32)
        out.append((np.cumsum(starts, out=starts), both.view("<i4")[::2].copy()))
    return out


def within_bits(d0: np.ndarray, d1: np.ndarray, tables: list, q0: np.ndarray, q1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (row of d, row of q) at most MAX_BITS apart, each once; the tables are those of q."""
    found = [np.zeros(0, np.int64)]
    u0, u1, v0, v1 = (np.ascontiguousarray(x).view(np.uint64) for x in (d0, d1, q0, q1))  # bits of a negative number are those of its absolute value
    for at, chunk, (starts, rows) in zip(_starts, _chunks(np.ascontiguousarray(d0), np.ascontiguousarray(d1)), tables, strict=True):
        # In the order of the buckets, so that the tables are read from front to back.
        chunk = _bucket(chunk)
        order = np.argsort(chunk, kind="stable")
        chunk = chunk[order]
        # That half first which holds less of the chunk, as the chunk's bits are alike in all candidates.
        (w0, x0), (w1, x1) = ((u1[order], v1), (u0[order], v0)) if at < 64 else ((u0[order], v0), (u1[order], v1))
        first, n = starts[chunk].astype(np.int64), (starts[chunk + 1] - starts[chunk]).astype(np.int64)
        ends = n.cumsum()
        # Slices of a bounded number of candidates, whatever the tables hold.
        lo = 0
        while lo < len(n):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
            m = n[lo:hi]
            place = np.repeat(first[lo:hi] - (ends[lo:hi] - m - done), m)
            place += np.arange(len(place))
            b = rows.take(place)
            half = x0.take(b)
            half ^= np.repeat(w0[lo:hi], m)
            apart = np.bitwise_count(half)
            some = np.flatnonzero(apart <= MAX_BITS)
            a, b = lo + np.searchsorted(ends[lo:hi] - done, some, "right"), b[some]
            near = apart[some] + np.bitwise_count(w1[a] ^ x1[b]) <= MAX_BITS
            found.append(order[a[near]] * len(q0) + b[near])
            lo = hi
    pairs = np.unique(np.concatenate(found))
    return pairs // max(1, len(q0)), pairs % max(1, len(q0))


def agreeing(q: np.ndarray, p: np.ndarray) -> int:
    """Most places of corners that follow one similarity transform, from the matches q[i], p[i] of a pair.

    Every match is a hypothesis; the matches that lie within its error are refitted by least squares, and those near
    the fitted transform count.
    """
    zq, zp = q["x"] + 1j * q["y"], p["x"] + 1j * p["y"]
    own = (q["scale"] / p["scale"]) * np.exp(2j * np.pi * (p["turn"] - q["turn"]) / TURNS)
    best = 0
    # Hypotheses in slices, so that memory is bounded for pairs with very many matches.
    for lo in range(0, len(q), 256):
        h = slice(lo, lo + 256)
        off = np.abs(zp[h, None] + own[h, None] * (zq[None] - zq[h, None]) - zp[None])
        reach = 3 + 0.25 * np.abs(zp[None] - zp[h, None])
        alike = np.abs(np.log(own[None] / own[h, None])) < 0.55
        close = (off <= reach) & alike
        for k in np.argsort(-close.sum(axis=1), kind="stable")[:3]:
            some = close[k]
            for _ in range(2):
                if some.sum() < 2:
                    break
                cq, cp = zq[some].mean(), zp[some].mean()
                dq = zq[some] - cq
                power = (np.abs(dq) ** 2).sum()
                if not power:
                    break
                m = (np.conj(dq) * (zp[some] - cp)).sum() / power
                some = (np.abs(cp + m * (zq - cq) - zp) <= 2.0 + 0.02 * np.abs(zp - cp)) & (np.abs(np.log(own / m)) < 0.55) if m else np.zeros(len(q), bool)
            best = max(best, min(_spots(zq[some]), _spots(zp[some])))
    return best


def _spots(z: np.ndarray) -> int:
    """Number of different places: corners of several scales at one place say the same."""
    return len(np.unique(np.rint(z.real / SPOT) + 1j * np.rint(z.imag / SPOT)))


def likely_pairs(pair: np.ndarray, q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which pairs (numbers from 0) can agree: MIN_AGREE matches of about the same turn and scale (bins overlap in both), and as many places in both pictures."""
    steps = np.rint(np.log(q["scale"] / p["scale"]) / np.log(STEP)).astype(np.int64) + 64
    turn = (p["turn"].astype(np.int64) - q["turn"]) % TURNS * 9 // TURNS
    bins = np.concatenate([(pair * 128 + steps + i) * 16 + (turn + j) % 9 for i in (0, 1) for j in (0, 1)])
    value, count = np.unique(bins, return_counts=True)
    likely = np.unique(value[count >= MIN_AGREE] // (128 * 16))
    for side in (q, p):
        own = np.isin(pair, likely)
        number = np.searchsorted(likely, pair[own])
        x, y = (np.rint(side[c][own] / SPOT).astype(np.int64) for c in ("x", "y"))
        spots = np.unique(np.stack([number, x, y]), axis=1)[0]
        likely = likely[np.bincount(spots, minlength=len(likely)) >= MIN_AGREE]
    return likely


def matched_pairs(known: DataFrame, asked: DataFrame) -> DataFrame:
    """q_id, id, tag, n_agree of the pairs with MIN_AGREE agreeing corners; both sides as from `corners`, staged.

    The asked corners go to the executors in blocks of about QUERY_BLOCK, one pass over the known ones for each. A task
    makes the block's tables and lets them go: an executor keeps more Python processes than it runs tasks, and they would
    all hold tables in the end.
    """
    spark = asked.sparkSession
    total = asked.agg(F.coalesce(F.sum(F.length("corners")), F.lit(0))).first()[0] // CORNER.itemsize
    n_blocks = max(1, -(-total // QUERY_BLOCK))
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    out = None
    for k in range(n_blocks):
        block = dealt.where(F.col("_block") == k).select("id", "corners").toArrow().combine_chunks()
        data = block["corners"].to_pylist()
        q_ids = np.repeat(block["id"].to_numpy().astype(np.int64), [len(x) // CORNER.itemsize for x in data])
        sent = spark.sparkContext.broadcast((q_ids, np.frombuffer(b"".join(data), CORNER)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            q_ids, q = sent.value
            q0, q1 = (np.ascontiguousarray(q[c]) for c in ("d0", "d1"))
            tables = None
            for whole in batches:
                tables = tables or probe_tables(q0, q1)
                for at in range(0, whole.num_rows, MATCHED):
                    batch, rows = whole.slice(at, MATCHED), []
                    data = batch.column(2).to_pylist()
                    pic = np.repeat(np.arange(len(data)), [len(x) // CORNER.itemsize for x in data])
                    d = np.frombuffer(b"".join(data), CORNER)
                    a, b = within_bits(d["d0"], d["d1"], tables, q0, q1)
                    order = np.lexsort((pic[a], q_ids[b]))
                    a, b = a[order], b[order]
                    new = np.flatnonzero((np.diff(pic[a]) != 0) | (np.diff(q_ids[b]) != 0)) + 1
                    starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(a)]])
                    for k in likely_pairs(np.repeat(np.arange(len(starts)), ends - starts), q[b], d[a]):
                        lo, hi = starts[k], ends[k]
                        n = agreeing(q[b[lo:hi]], d[a[lo:hi]])
                        if n >= MIN_AGREE:
                            rows.append((int(q_ids[b[lo]]), int(pic[a[lo]]), n))
                    if rows:
                        one = batch.take(pa.array([r[1] for r in rows]))
                        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), one.column(0), one.column(1), pa.array([r[2] for r in rows])], ["q_id", "id", "tag", "n_agree"])

        met = C.stage(known.select("id", "tag", "corners").mapInArrow(run, "q_id long, id long, tag long, n_agree long"))
        out = met if out is None else out.unionByName(met)
        sent.destroy()
    return out


def find_copies(images: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, id, n_copies, n_agree: pictures of `images` (id, image) that a picture of `queries` is an edited copy of.

    Pictures with equal bytes are one class: id is the least of them and n_copies their number. Null, empty and broken
    pictures match nothing; so do plain ones, which have no corners. Equal queries are answered each.
    Rows of one id with other bytes are judged each, and the best of them counts; pictures and queries without id take no
    part. The result is a table in the shared folder.
    """
    with C.scratch(images.sparkSession):
        found, _ = _find_copies(images.where("id IS NOT NULL"), queries.where("id IS NOT NULL"))
        found = found.groupBy("query_id", "id").agg(F.sum("n_copies").alias("n_copies"), F.max("n_agree").alias("n_agree"))
        return C.stage(found, keep=True)


def _find_copies(images: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (query_id, id, tag, n_copies, n_agree) of a query and a class, and the class (id, tag, n_copies) of every member that has corners."""
    # One pass over the pictures: what is equal is known from its result, which is read again by each block.
    known = C.stage(corners(images))
    classes = C.stage(known.groupBy("sha").agg(F.min("id").alias("id"), F.count("*").alias("n_copies"), F.first("tag").alias("tag")))
    asked = C.stage(corners(queries, dense=True))
    # Corners are never shuffled: those of copies go by a bitmap before they are matched, the rest of them by the join after.
    met = matched_pairs(C.maybe_in(known, classes, "id", "tag"), asked).join(classes, ["id", "tag"])
    members = C.stage(known.select(F.col("id").alias("member"), "sha").distinct().join(classes, "sha").select("member", "id", "tag", "n_copies"))
    C.drop(known)  # the corners are most of what is staged, and what follows grows with the links
    C.drop(asked)
    found = met.groupBy(F.col("q_id").alias("query_id"), "id", "tag").agg(F.max("n_copies").alias("n_copies"), F.max("n_agree").alias("n_agree"))
    return found, members


def count_copies(ids: DataFrame, images: DataFrame, queries: DataFrame) -> DataFrame:
    """One row for every id of `ids` with the number of its links, where a query bears the id of the picture it was made from.

    The links are those of `find_copies`, none left out: n_links queries are linked to the picture's class (id, n_copies),
    query_id is the one with the most agreeing places (n_agree; the least of equal ones), n_found pictures are linked to
    the picture's own query, and component_id is the least id that links and equal bytes reach. A picture that nothing is
    linked to, or that can't be read, is a class of its own. An id with several pictures has a row for each of their classes.
    `ids` are those of `images`, from a table that is cheaper to read than the pictures are to make.
    """
    with C.scratch(images.sparkSession):
        known = ids.where("id IS NOT NULL").select(F.col("id").alias("member")).distinct()
        return C.stage(_count_copies(known, images.where("id IS NOT NULL"), queries.where("id IS NOT NULL")), keep=True)


def _count_copies(ids: DataFrame, images: DataFrame, queries: DataFrame) -> DataFrame:
    found, members = _find_copies(images, queries)
    found = C.stage(found)
    asked = found.groupBy(F.col("query_id").alias("member")).agg(F.sum("n_copies").alias("n_found"))
    named = found.groupBy("id", "tag").agg(F.count("*").alias("n_links"), F.min(F.struct((-F.col("n_agree")).alias("less"), "query_id")).alias("best"))
    # Copies share their class's component, so only ids that links start from, or that are in several classes, are nodes beside the classes.
    nodes = asked.select("member").unionByName(members.groupBy("member").agg(F.count("*").alias("n")).where("n > 1").select("member")).distinct()
    parts = components(found.select(F.col("query_id").alias("a"), F.col("id").alias("b")).unionByName(members.join(nodes, "member").select(F.col("member").alias("a"), F.col("id").alias("b"))))
    every = ids.join(members, "member", "left")
    every = every.select("member", F.coalesce("id", "member").alias("id"), "tag", F.coalesce("n_copies", F.lit(1)).alias("n_copies"))
    every = every.join(named, ["id", "tag"], "left").join(parts, "id", "left").join(asked, "member", "left")
    none = F.lit(0).cast("long")
    return every.select(
        "member",
        "id",
        "n_copies",
        F.col("best.query_id").alias("query_id"),
        (-F.col("best.less")).alias("n_agree"),
        F.coalesce("n_links", none).alias("n_links"),
        F.coalesce("n_found", none).alias("n_found"),
        F.coalesce("component", "id").alias("component_id"),
    )


def rendered(data: bytes, cells: int = 40) -> np.ndarray:
    """A grey picture of all bytes of a page: laid out in rows of cells, further layers added to them."""
    return _rendered([data], cells)[0]


def _rendered(pages: list[bytes], cells: int = 40) -> np.ndarray:
    area = cells * cells
    grey = np.zeros((len(pages), area), dtype=np.uint8)  # sums are modulo 256
    for data, own in zip(pages, grey, strict=True):
        layers = np.frombuffer(data, np.uint8, len(data) // area * area).reshape(-1, area)
        rest = np.frombuffer(data, np.uint8, offset=layers.size) if layers.size < len(data) else own[:0]
        np.add.reduce(layers, axis=0, dtype=np.uint8, out=own)
        own[: len(rest)] += rest
    grey = np.repeat(np.repeat((grey * np.uint8(37)).reshape(-1, cells, cells), 2, axis=1), 2, axis=2)
    return np.rint(_sum3(np.pad(grey.astype(np.float32), ((0, 0), (1, 1), (1, 1)), mode="edge")) / 9).astype(np.uint8)


def _cropped(pixels: np.ndarray) -> np.ndarray:
    """A cropped, darker, slightly uneven copy."""
    h, w = pixels.shape
    part = pixels[h // 10 : h - h // 12, w // 8 : w - w // 16].astype(float) * 0.8 + 20
    return part + np.linspace(0, 6, part.shape[1])


def turned(pixels: np.ndarray, degrees: float) -> np.ndarray:
    """Turned about the middle, as large as before; what was outside is grey."""
    h, w = pixels.shape
    y, x = np.mgrid[:h, :w] - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    a = np.deg2rad(degrees)
    y, x = y * np.cos(a) - x * np.sin(a) + (h - 1) / 2, y * np.sin(a) + x * np.cos(a) + (w - 1) / 2
    y0, x0 = np.clip(np.floor(y).astype(int), 0, h - 2), np.clip(np.floor(x).astype(int), 0, w - 2)
    fy, fx, p = y - y0, x - x0, pixels.astype(float)
    out = (p[y0, x0] * (1 - fx) + p[y0, x0 + 1] * fx) * (1 - fy) + (p[y0 + 1, x0] * (1 - fx) + p[y0 + 1, x0 + 1] * fx) * fy
    return np.where((y < 0) | (x < 0) | (y > h - 1) | (x > w - 1), 128, out)


#: How the pictures of the query set are edited, in turn.
EDITS: tuple[Callable[[np.ndarray], np.ndarray], ...] = (
    _cropped,
    lambda p: np.rot90(_cropped(p)),
    lambda p: resize(p.astype(np.float32), 1.25),
    lambda p: resize(p.astype(np.float32), 0.75),
    lambda p: np.rot90(p, 2) * 0.7 + 30,
    lambda p: p[: p.shape[0] * 2 // 3, p.shape[1] // 3 :] * 1.1,
)


def edited(pixels: np.ndarray, number: int) -> np.ndarray:
    return np.clip(np.rint(EDITS[number % len(EDITS)](pixels)), 0, 255).astype(np.uint8)


def _pictures(pages: DataFrame, change: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PICTURES):
                batch = whole.slice(at, PICTURES)
                rows = [(k, i, x.as_py()) for k, (i, x) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1), strict=True)) if x.is_valid]
                data: list[bytes | None] = [None] * len(batch)
                for (k, i, _), pixels in zip(rows, _rendered([x.encode("utf-8", "replace") for _, _, x in rows]), strict=True):
                    data[k] = to_pgm(change(i, pixels))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["id", "image"])

    return pages.select(F.col("page_id").alias("id"), "html").mapInArrow(run, "id long, image binary")


def op6_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited copies of the pictures of all pages whose id is divisible by 50, searched in the pictures of all pages: every page with its class, its component and the number of its links.

    The pairs themselves are many (about as many of all pairs are linked at any size) and are what `find_copies` returns.
    """
    pages = C.table(spark, sf_dir, "pages")
    ids = pages.select(F.col("page_id").alias("id"))
    found = count_copies(ids, _pictures(pages, lambda i, x: x), _pictures(pages.where("page_id % 50 = 0"), lambda i, x: edited(x, i // 50)))
    return found.withColumnRenamed("member", "page_id")
