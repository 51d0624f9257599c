"""N-gram Jaccard join, size-aware: subsets of small (light) sets, inverted lists of large (heavy) ones.

Documents are sets of word shingles. Equal sets are found by a 128-bit digest and stand for each other from then on. A
first pass counts all shingles in a table of fixed size; by these counts, rare before common, every set is ordered the
same way. Two similar sets then share a shingle among the first n - least(n) + 1 of each (n: its size, least(n): the
least size of a similar one), so these are the entries of the inverted lists, one list for a shingle. What many
documents share stands last in the order and hardly ever in a list. A pair is a candidate where the places of the
shared shingle leave room for the overlap that similarity needs.

A light set lists its fixed-size subsets instead: two light sets that need an overlap of c share a subset of exactly c
shingles. The boundary between light and heavy is the one of least cost, from the number of small sets of each size and
the measured lengths of the lists that they would scan. Light sets that may be similar to heavy ones are in both.

A list's members are first compared with its first member of about their size only; members that this leaves in
different components are compared among each other, in blocks. Candidates pass a sketch whose distance never exceeds
the number of differing shingles, and every link is verified on the sets of 64-bit shingle hashes: no link is lost, and
none is made up but by equal hashes of different shingles of two documents. Lists of shingles that the counts
show to be very common are split by a hash of the document, so that no list is one task.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C
from vesselflow.llm.components import components

U = np.uint64
#: Counters of the shingle counts: a fixed 2 MB, whatever the input. Any counts give an order that is right.
SLOTS = 1 << 18
#: Sets of more shingles are heavy, whatever the costs.
MOST_LIGHT = 24
COUNTERS = 128
LIST_BLOCK = 2048
#: Bytes of a text that are split into words at once, and documents that are handled at once.
CHUNK = 1 << 20
DOCS = 500
#: Words whose hashes a process remembers.
REMEMBERED = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class _WordHashes(dict):
    """64-bit hash of a word; those of short words are remembered."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word, seed=0x5EED)
        if len(word) <= 32:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = h
        return h


_hashes = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of the text, A-Z lower-cased; long texts are split in pieces that end between words."""
    data, out, at = text.encode("utf-8", "replace").lower(), [], 0
    while at < len(data):
        to = at + CHUNK
        while to < len(data) and not data[to : to + 1].isspace():
            to += 1
        some = data[at:to].split()
        out.append(np.fromiter(map(_hashes.__getitem__, some), dtype=U, count=len(some)))
        at = to
    return out[0] if len(out) == 1 else np.concatenate([np.empty(0, dtype=U), *out])


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's k-word shingles; fewer words are one shingle, no words none."""
    h = word_hashes(text) if text else np.empty(0, dtype=U)
    if not len(h):
        return h
    width = min(k, len(h))
    n = len(h) - width + 1
    x = np.full(n, width, dtype=U)
    for i in range(width):
        x = mix(x * U(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(x)


@functools.lru_cache(maxsize=256)
def _choices(n: int, c: int) -> np.ndarray:
    """Places of all subsets of c of n."""
    return np.array(list(itertools.combinations(range(n), c)), dtype=np.int64).reshape(-1, c)


@dataclass(frozen=True)
class Rule:
    """Similar: den * intersection >= num * union, of sets of k-word shingles. Lists are split into parts of about `part` documents."""

    k: int = 3
    num: int = 90
    den: int = 100
    part: int = 20_000

    def overlap(self, n, m):
        """Least intersection of similar sets of n and m shingles."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def overlap_column(self, n: Column, m: Column) -> Column:
        return F.ceil(self.num * (n + m) / (self.num + self.den))

    def least(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def most(self, n: int) -> int:
        return self.den * n // self.num

    def prefix(self, n: int) -> int:
        """Shingles of a set of n among whose first ones two similar sets, in one order, share one."""
        return n - self.least(n) + 1

    def alone(self, n: int) -> bool:
        """Whether only equal sets are similar to one of n shingles."""
        return self.least(n) == n == self.most(n)

    def subset_sizes(self, n: int, boundary: int) -> list[int]:
        """Sizes of the subsets that a set of n lists to meet all similar, not equal sets up to the boundary."""
        sizes = {self.overlap(n, m) for m in range(self.least(n), min(self.most(n), boundary) + 1)}
        return sorted(c for c in sizes if c < n or (c == n and self.most(n) > n))

    def n_subsets(self, n: int, boundary: int) -> int:
        return sum(len(_choices(n, c)) for c in self.subset_sizes(n, boundary))

    @functools.cached_property
    def starts(self) -> list[int]:
        """First sizes of the size classes, growing by half; similar sets are in one class or in neighbours."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(max(out[-1] + 1, out[-1] * 3 // 2))
        return out

    def class_of(self, n: int) -> int:
        return int(np.searchsorted(self.starts, n, "right")) - 1


def choose_boundary(measured: dict[int, tuple[int, float]], rule: Rule) -> int:
    """The boundary of least cost. measured: size -> (number of sets, length of the lists that these would scan)."""

    def cost(x: int) -> float:
        out = 0.0
        for n, (docs, scan) in measured.items():
            if n <= x:
                out += docs * rule.n_subsets(n, x)
            if n > x or rule.most(n) > x:
                out += scan
        return out

    return min(range(MOST_LIGHT + 1), key=cost)


def _texts(batch: pa.RecordBatch):
    return zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)


def _long(x) -> pa.Array:
    return pa.array(np.asarray(x, dtype=U).view(np.int64), pa.int64())


def _lists(sets: list[np.ndarray | None]) -> pa.Array:
    """A list column; None is null."""
    ends = np.cumsum([0, *(0 if s is None else len(s) for s in sets)])
    offsets = pa.array([int(e) for e in ends], pa.int32(), mask=np.array([*(s is None for s in sets), False]))
    return pa.ListArray.from_arrays(offsets, _long(np.concatenate([np.empty(0, dtype=U), *(s for s in sets if s is not None)])))


def _sketch(s: np.ndarray) -> bytes:
    return np.minimum(np.bincount((s & U(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS), 255).astype(np.uint8).tobytes()


def _slots(s: np.ndarray) -> np.ndarray:
    return (s >> U(40)).astype(np.int64) & (SLOTS - 1)


def describe(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows with slot null: doc_id, n, s1, s2 (digest of the set), sketch, small (a small set's shingles). Others: slot, count of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS):
                rows = [(doc, shingles(text, rule.k)) for doc, text in _texts(whole.slice(at, DOCS))]
                sets = [s for _, s in rows]
                counts += np.bincount(_slots(np.concatenate(sets)), minlength=SLOTS)
                none = pa.nulls(len(rows), pa.int64())
                s1, s2 = _long([int(mix(s).sum(dtype=U)) for s in sets]), _long([int(mix(s * U(3) + U(1)).sum(dtype=U)) for s in sets])
                small = _lists([s if doc is not None and 0 < len(s) <= MOST_LIGHT else None for doc, s in rows])
                ids, n = pa.array([d for d, _ in rows], pa.int64()), pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, ids, n, s1, s2, pa.array(map(_sketch, sets), pa.binary()), small], names)
        slot = np.flatnonzero(counts)
        none = pa.nulls(len(slot), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot]), none, none, none, none, pa.nulls(len(slot), pa.binary()), pa.nulls(len(slot), pa.list_(pa.int64()))], names)

    names = ["slot", "count", "doc_id", "n", "s1", "s2", "sketch", "small"]
    return docs.select("doc_id", "text").mapInArrow(run, "slot long, count long, doc_id long, n long, s1 long, s2 long, sketch binary, small array<long>")


def shingle_counts(described: DataFrame) -> np.ndarray:
    """Count by slot; SLOTS numbers, whatever the input."""
    # As Arrow columns: rows of Python objects, and those that the JVM makes of them, take many times the driver's memory.
    got = described.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("count").alias("count")).toArrow()
    out = np.zeros(SLOTS, dtype=np.int64)
    out[got["slot"].to_numpy()] = got["count"].to_numpy()
    return out


def beyond_chance(counts: np.ndarray) -> np.ndarray:
    """What a slot's count exceeds the middle one by, 1 at least: about the length of the list of a common shingle in it."""
    return np.maximum(1, counts - int(np.median(counts)))


def measure(small: DataFrame, counts, rule: Rule) -> dict[int, tuple[int, float]]:
    """size -> (number of small sets, sum of the lengths of the lists that they scan)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = beyond_chance(counts.value)
        docs, scan = np.zeros(MOST_LIGHT + 1, dtype=np.int64), np.zeros(MOST_LIGHT + 1)
        for batch in batches:
            for s in batch.column(0):
                own = np.sort(length[_slots(s.values.to_numpy().view(U))])
                docs[len(own)] += 1
                scan[len(own)] += own[: rule.prefix(len(own))].sum()
        n = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(docs[n]), pa.array(scan[n])], ["n", "docs", "scan"])

    found = small.select("small").mapInArrow(run, "n long, docs long, scan double").groupBy("n").agg(F.sum("docs"), F.sum("scan")).collect()
    return {n: (docs, scan) for n, docs, scan in found}


ENTRY = "key long, part long, cls int, id long, n long, at long"


def _entries(key: np.ndarray, length: np.ndarray, doc: int, n: int, at: np.ndarray, rule: Rule) -> tuple[np.ndarray, ...]:
    parts = 1 + length // rule.part
    part = np.where(parts > 1, int(mix(np.array([doc], dtype=np.int64).view(U))[0] >> U(1)) % parts, -1)
    return key.view(np.int64), part, np.full(len(key), rule.class_of(n), dtype=np.int32), np.full(len(key), doc), np.full(len(key), n), at


def heavy_entries(docs: DataFrame, known: Bitmap, counts, boundary: int, rule: Rule) -> DataFrame:
    """Entries of the inverted lists: key, part (-1: the list is whole), cls, id, n, at (place of the shingle in the set's order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, out, total = counts.value, [], 0
        length = beyond_chance(count)
        for whole in batches:
            for doc, text in _texts(known.filter(whole)):
                s = shingles(text, rule.k) if doc is not None else ()
                n = len(s)
                if not n or rule.alone(n) or rule.most(n) <= boundary:
                    continue
                slot, p = _slots(s), rule.prefix(n)
                order = np.lexsort((s, count[slot]))[:p]
                out.append(_entries(s[order], length[slot[order]], doc, n, np.arange(p), rule))
                total += p
                if total > 50_000:
                    yield _batch(out)
                    out, total = [], 0
        if out:
            yield _batch(out)

    return known.slot(docs.select("doc_id", "text"), "doc_id").mapInArrow(run, ENTRY)


def light_entries(small: DataFrame, counts, boundary: int, rule: Rule) -> DataFrame:
    """Entries of the subsets of small sets, like those of the lists; subsets have no place (0), and keys of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, out, total = beyond_chance(counts.value), [], 0
        for batch in batches:
            for doc, s in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = s.values.to_numpy().view(U)
                n, own, v = len(s), length[_slots(s)], mix(s + U(0x1234567))
                for c in rule.subset_sizes(n, boundary):
                    some = _choices(n, c)
                    key = mix(v[some].sum(axis=1, dtype=U) ^ U(c << 56))
                    out.append(_entries(key, own[some].min(axis=1), doc, n, np.zeros(len(some), dtype=np.int64), rule))
                    total += len(some)
                if total > 50_000:
                    yield _batch(out)
                    out, total = [], 0
        if out:
            yield _batch(out)

    return small.where(F.col("n") <= boundary).select("doc_id", "small").mapInArrow(run, ENTRY)


def _batch(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], ["key", "part", "cls", "id", "n", "at"])


def shared_lists(entries: DataFrame) -> DataFrame:
    """The entries of lists of two and more (or of parts of lists), each with its head: the first member of its size class.

    A head has the head of the class before, where that is the next smaller one. Lists are streamed in sorted order.
    settled: the list is whole and has two members, which the head compares (known of lists within a batch only).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sent = None, False  # head of the last list's last class, and whether it has been sent
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            cols = [table.column(i).to_numpy() for i in range(6)]
            key, part, cls, id_, n, at = cols
            new_list = np.ones(len(key), dtype=bool)
            new_list[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            new_class = new_list.copy()
            new_class[1:] |= cls[1:] != cls[:-1]
            place = np.arange(len(key))
            head = np.maximum.accumulate(np.where(new_class, place, 0))
            last = head[-1]
            shared = ~new_list | (part >= 0)
            shared[:-1] |= ~new_list[1:]
            before = np.concatenate([[0], head[:-1]])
            step = new_class & ~new_list
            step[1:] &= cls[1:] == cls[before[1:]] + 1
            to = np.where(step, before, head)
            go = shared.copy()
            if held is not None:
                go[0] &= not sent
            begins = np.flatnonzero(new_list)
            two = np.diff(np.append(begins, len(key))) == 2
            two[-1] = False  # it may go on
            two[0] &= not sent
            settled = np.repeat(two, np.diff(np.append(begins, len(key)))) & (part < 0)
            some = np.flatnonzero(go)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*(c[some] for c in cols), id_[to[some]], n[to[some]], at[to[some]], settled[some])], [*batch.schema.names, "h_id", "h_n", "h_at", "settled"])
            sent = bool(shared[last]) or (held is not None and last == 0 and sent)
            held = pa.RecordBatch.from_arrays([pa.array(c[last : last + 1]) for c in cols], schema=batch.schema)

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(parts, "key", "part").sortWithinPartitions("key", "part", "cls", "id").mapInArrow(run, f"{ENTRY}, h_id long, h_n long, h_at long, settled boolean")


class Bitmap:
    """A bitmap over hashes of ids, on every executor; other ids may share a bit. Too many ids for one get none (see map_bits)."""

    def __init__(self, words, bits: int | None) -> None:
        self.words, self.bits = words, bits

    @classmethod
    def of(cls, ids: DataFrame, name: str) -> Bitmap:
        """ids is read twice: a staged table."""
        bits = C.map_bits(ids.count())
        if bits is None:
            return cls(None, None)
        slot = F.pmod(F.xxhash64(name), F.lit(bits))
        word = ids.select(F.shiftright(slot, 5).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(32)).cast("int")).alias("b"))
        got = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        out = np.zeros(bits >> 5, dtype=np.uint32)
        out[got["w"].to_numpy()] = got["b"].to_numpy()
        return cls(ids.sparkSession.sparkContext.broadcast(out), bits)

    def slot(self, rows: DataFrame, name: str) -> DataFrame:
        """rows with the slot of the id as the last column."""
        return rows.withColumn("_slot", F.pmod(F.xxhash64(name), F.lit(self.bits or 1)).cast("int"))

    def filter(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The rows of a batch, with the slot as the last column, whose id may be in the map."""
        if self.bits is None:
            return batch
        slot = batch.column(batch.num_columns - 1).to_numpy()
        return batch.take(pa.array(np.flatnonzero((self.words.value[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1)))


def sets_of(docs: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """id, s (array of hashes) of the documents in `ids` (staged): their texts are read again, no text is shuffled."""
    known = Bitmap.of(ids, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            some = known.filter(whole)
            for at in range(0, some.num_rows, DOCS):
                rows = [(doc, shingles(text, rule.k)) for doc, text in _texts(some.slice(at, DOCS)) if doc is not None]
                rows = [(doc, s) for doc, s in rows if len(s)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), _lists([s for _, s in rows])], ["id", "s"])

    found = known.slot(docs.select("doc_id", "text"), "doc_id").mapInArrow(run, "id long, s array<long>")
    return C.stage(found.join(ids, "id", "left_semi"))


def _sketches_allow(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether sets of n and m shingles with these sketches may be similar. Counters hold 255 at most, which hides differences only."""
    differ = np.abs(a.astype(np.int16) - b).sum(axis=1, dtype=np.int64)
    return differ <= n + m - 2 * rule.overlap(n, m)


def likely(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sketches (id, n, sketch) allow a link; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, COUNTERS) for c in ("x", "y"))
                some = pa.array(np.flatnonzero(_sketches_allow(n, m, x, y, rule)))
                yield batch.select(["a", "b"]).take(some)

    x = sketches.select(F.col("id").alias("a"), "n", F.col("sketch").alias("x"))
    y = sketches.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    met = pairs.join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")
    return C.stage(met.distinct())


def verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets are similar; staged. Only the sets of documents in pairs are made."""
    ids = C.stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    sets = sets_of(docs, ids, rule)
    a, b = sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    out = C.stage(pairs.join(a, "a").join(b, "b").where(rule.den * both >= rule.num * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct())
    C.drop(sets)
    return out


def other_pairs(members: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of one list, of different components, that may be linked. members: key, part, id, n, at, component.

    Whole lists of two have been settled by their head. A list of more than LIST_BLOCK members is split: every two of
    its blocks meet once.
    """
    tests = members.groupBy("key").agg(F.count("*").alias("c"), F.max("part").alias("p"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    # Staged, so that no aggregate stands between the join and its shuffles: Spark can then split the rows of a long list.
    tests = C.stage(tests.where("lo <> hi AND (c > 2 OR p >= 0)").select("key", "c"))
    open_ = members.join(tests, "key")
    n_blocks = F.ceil(F.col("c") / LIST_BLOCK)
    own = F.pmod(F.xxhash64("id"), n_blocks)
    open_ = open_.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)))
    open_ = open_.select("key", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"), "own", "id", "n", "at", "component")
    open_ = open_.join(sketches, ["id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None
        for batch in batches:
            g = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((g[1:] != g[:-1]).any(axis=1)) + 1
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(g)]):
                if hi > lo:
                    if group is not None and (g[lo] != group).any():
                        yield from close(held)
                        held = []
                    group = g[lo]
                    held.append(batch.slice(lo, hi - lo))
        yield from close(held)

    def close(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sum(b.num_rows for b in held) < 2:
            return
        t = pa.Table.from_batches(held)
        x, y, own, id_, at, comp, n = (t.column(c).to_numpy() for c in ("x", "y", "own", "id", "at", "component", "n"))
        sk = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, COUNTERS)
        for i in range(1, len(id_)):
            need = rule.overlap(n[:i], n[i])
            ok = (np.minimum(n[:i] - at[:i], n[i] - at[i]) >= need) & (comp[:i] != comp[i])
            if x[0] != y[0]:
                ok &= own[:i] != own[i]
            j = np.flatnonzero(ok)
            j = j[_sketches_allow(n[j], n[i], sk[j], sk[i], rule)] if len(j) else j
            if len(j):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(id_[j], id_[i])), pa.array(np.minimum(id_[j], id_[i]))], ["a", "b"])

    spark = members.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = open_.select("key", "x", "y", "own", "id", "at", "component", "n", "sketch").repartition(parts, "key", "x", "y").sortWithinPartitions("key", "x", "y")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def similar_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text; other columns are ignored).

    The result is a table in the shared folder; what it was made from is deleted.

    Texts without words (null, empty, blank) have the empty set, are linked with nothing and are their own component.
    Rows of one doc_id count as one document with several texts. A null doc_id is in no component (null).
    """
    with C.scratch(docs.sparkSession):
        return C.stage(_similar_documents(docs, rule), keep=True)


def _similar_documents(docs: DataFrame, rule: Rule) -> DataFrame:
    spark = docs.sparkSession
    everything = C.stage(describe(docs, rule))
    counts = spark.sparkContext.broadcast(shingle_counts(everything))
    described = everything.where("slot IS NULL")
    known = described.where("n > 0 AND doc_id IS NOT NULL")
    class_of = C.stage(known.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")))
    mine = known.select("doc_id", "n", "s1", "s2").join(class_of, ["n", "s1", "s2"]).select(F.col("doc_id").alias("id"), "rep").distinct()

    # A document stands for its set by the set's least document; one with several texts stands for itself and links them.
    same = C.stage(mine.groupBy("id").agg(F.collect_set("rep").alias("reps")))
    several = same.where(F.size("reps") > 1).select(F.col("id").alias("a"), F.explode("reps").alias("b")).where("a <> b")
    several = C.stage(several.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    same = same.select("id", F.when(F.size("reps") > 1, F.col("id")).otherwise(F.get("reps", F.lit(0))).alias("rep"))
    reps = C.stage(same.select(F.col("rep").alias("doc_id")).unionByName(class_of.select(F.col("rep").alias("doc_id"))).distinct())

    small = known.where("small IS NOT NULL").join(reps, "doc_id", "left_semi").select("doc_id", "n", "small")
    boundary = choose_boundary(measure(small, counts, rule), rule)
    firsts = Bitmap.of(reps, "doc_id")
    entries = heavy_entries(docs, firsts, counts, boundary, rule).unionByName(light_entries(small, counts, boundary, rule))
    lists = C.stage(shared_lists(entries))

    # Some ids are not their sets' least ones, as they share a bit with one; these have no sketch and link nothing. Where
    # there is no bitmap, there are too many of them to carry on.
    members = lists.where("NOT settled")
    members = members if firsts.bits else members.join(reps, members["id"] == reps["doc_id"], "left_semi")
    room = F.least(F.col("n") - F.col("at"), F.col("h_n") - F.col("h_at"))
    fits = rule.overlap_column(F.col("n"), F.col("h_n")) <= room
    first = lists.where("id <> h_id").where(fits).select(F.col("id").alias("a"), F.col("h_id").alias("b")).distinct()
    # The parts of a list meet by their heads.
    heads = lists.where("part >= 0").groupBy("key", "cls", "part").agg(F.min("id").alias("id"))
    heads = heads.join(heads.groupBy("key", "cls").agg(F.min("id").alias("b")), ["key", "cls"]).where("id <> b").select(F.col("id").alias("a"), "b")
    first = first.unionByName(heads)
    first = first.join(same.select(F.col("id").alias("a"), F.col("rep").alias("ra")), "a").join(same.select(F.col("id").alias("b"), F.col("rep").alias("rb")), "b")
    first = C.stage(first.where("ra <> rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct())
    sketches = C.stage(described.where("n > 0").select(F.col("doc_id").alias("id"), "n", "sketch").join(reps, F.col("id") == reps["doc_id"], "left_semi").distinct())

    links = C.stage(verified(likely(first, sketches, rule), docs, rule).unionByName(several))
    labelled = members.join(components(links), "id", "left").select("key", "part", "id", "n", "at", F.coalesce("component", "id").alias("component"))
    rest = C.stage(other_pairs(labelled, sketches, rule).join(first, ["a", "b"], "left_anti"))
    C.drop(lists)
    final = components(links.unionByName(verified(rest, docs, rule)))
    out = described.select("doc_id", F.col("n").alias("n_shingles"), "s1", "s2").join(class_of.withColumnRenamed("n", "n_shingles"), ["n_shingles", "s1", "s2"], "left")
    out = out.join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(C.table(spark, sf_dir, "documents"), Rule(3, 90, 100))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least doc_id. Shingles of five words, 0.8."""
    found = similar_documents(docs, Rule(5, 80, 100))
    dropped = C.stage(found.where("component_id <> doc_id").select("doc_id").distinct())
    return C.without(docs, dropped, "doc_id").select(*docs.columns)
