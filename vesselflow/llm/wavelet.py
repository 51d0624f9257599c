"""Token files: a wavelet matrix per shard, in one compressed file that is read in place.

A shard holds the token ids of consecutive documents. Its wavelet matrix has one plane of bits per bit of the ids, most
significant first; after each plane the ids with a 0 there go before those with a 1, both in their order. With ranks (how
many ones come before a place) and selects (where the k-th one is) of the planes, a token can be read, counted within any
span, and all its places found, without the other tokens being decoded. Planes are cut into chunks that are compressed on
their own; a directory has each chunk's place in the file and the ones before it, so a lookup reads one chunk per plane.

Shards are written by Spark tasks over documents sorted by id. A task gives each file a name of its own, and the manifest
(the rows that the tasks which have succeeded return) says which files count; files of lost tasks are in no manifest.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vesselflow.llm import _common as C

END = 2
VOCABULARY = "byte_bpe_50k.json"
#: Ids after which a shard is closed (a document is never cut), and bits of a chunk.
SHARD, CHUNK = 1 << 22, 1 << 17
MAGIC = b"VFWM0001"
#: Chunks of text that a task remembers the ids of, their greatest length, and bytes of text encoded at once.
KNOWN, LONGEST, SLICE = 1 << 19, 48, 1 << 22
#: The vocabulary's character for each byte; and whether a byte is (of) a letter, a digit, or else, where `_is_word` is true.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHARACTERS = np.zeros(256, dtype="<u4")
_CHARACTERS[_PRINTED] = _PRINTED
_CHARACTERS[np.setdiff1d(np.arange(256), _PRINTED)] = 256 + np.arange(256 - len(_PRINTED))
_KIND = np.array([1 if chr(b).isalpha() or b > 127 else 2 if chr(b).isdigit() else 3 for b in range(256)], dtype=np.uint8)
#: Bytes that a word has none of after its space: white space and controls, the apostrophe, and what begins no letter from U+00C0 to U+023F.
_STRANGE = np.array([b <= 32 or b in (39, 127) or 0xC0 <= b < 0xC3 or b > 0xC8 for b in range(256)])
#: Marks that stand behind words and begin a token there.
_MARK = np.isin(np.arange(256), list(b"!),.:;?"))
MANIFEST = "part int, shard int, path string, n_tokens long, n_docs long, n_bytes long"


def cut(text: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where a token begins whatever the rest: at a lone space or line end between visible characters, after that line end, and at a mark between a letter and white space, so that words are the same with and without one.

    No token has white space after another character, and runs of white space don't reach here, so the ids of the parts
    are those of the whole. Visible are ASCII from ! to ~ and the letters from U+00C0 to U+023F.
    """
    ascii_, lead, tail = (text > 32) & (text < 127), (text >= 0xC3) & (text <= 0xC8), (text & 0xC0) == 0x80
    ends, begins = ascii_[:-2].copy(), ascii_[2:] | lead[2:]
    ends[1:] |= tail[1:-2] & lead[:-3]
    between = ends & begins
    space, line = text[1:-1] == 32, text[1:-1] == 10
    mark = np.zeros(len(text), dtype=bool)
    mark[1:-1] = between & (space | line)
    mark[2:] |= between & line
    letter = ((text[:-2] | 32) >= 97) & ((text[:-2] | 32) <= 122)
    mark[1:-1] |= letter & _MARK[text[1:-1]] & ((text[2:] == 32) | (text[2:] == 10))
    return np.flatnonzero(mark)


def _octets(texts: pa.Array) -> np.ndarray:
    """All bytes of strings."""
    ends = texts.buffers()[1]
    at = np.frombuffer(ends, dtype="<i8")[texts.offset :] if ends else [0, 0]
    return np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[len(texts)]] if len(texts) else np.zeros(0, dtype=np.uint8)


def _lists(ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(ends.astype(np.int64)), pa.array(ids))


def _is_word(chunks: pa.Array) -> np.ndarray:
    """Which chunks (none empty) are one space and then visible characters without apostrophe.

    In a run of such chunks each begins with a token that begins with a space, and no other token does. With no
    contractions a piece ends where letters, digits and other characters meet. The signs U+00D7 and U+00F7, which lie
    among the letters and are none, make no word.
    """
    text, n = _octets(chunks), pc.binary_length(chunks).to_numpy()
    if not len(n):
        return np.zeros(0, dtype=bool)
    strange = _STRANGE[text]
    strange[1:] |= (text[:-1] == 0xC3) & ((text[1:] == 0x97) | (text[1:] == 0xB7))
    start = np.cumsum(n) - n
    return (text[start] == 32) & (np.add.reduceat(strange, start, dtype=np.int64) == 1) & (n > 1)


class Encoder:
    """Ids of texts by a tokenizers file, and the end id.

    Texts are cut where a token must begin; the distinct chunks of many texts are encoded once and remembered, and the
    texts' ids are put together from theirs by Arrow, as the library alone takes several times the CPU. A word's pieces
    are plain from its characters, so words go to the library's model already cut, without the search for pieces.
    """

    def __init__(self, path: str, end: int = END) -> None:
        # Spark has a task for each core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(tokens.values()) + 1, dtype=bool)
        self.spaced[[i for t, i in tokens.items() if t.startswith("\u0120")]] = True
        self._forget()

    def _forget(self) -> None:
        """Remembered chunks and their ids."""
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_list(pa.uint32()))

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of chunks of which `_is_word` is true: the library's model gets letters, digits and other characters apart."""
        text = _octets(words)
        space, kind = text == 32, _KIND[text]
        piece = space.copy()
        piece[1:] |= (kind[1:] != kind[:-1]) & ~space[:-1]
        cut = np.full(len(text) + int(np.count_nonzero(piece)), 10, dtype="<u4")
        cut[np.arange(len(text)) + np.cumsum(piece)] = _CHARACTERS[text]
        # The fast call gives the same ids and spares the places in the text.
        (together,) = self.pieces.encode_batch_fast([cut.tobytes().decode("utf-32-le")], add_special_tokens=False)
        ids = np.array(together.ids, dtype="<u4")
        return _lists(np.append(np.flatnonzero(self.spaced[ids]), len(ids)), ids)

    def _new(self, chunks: pa.Array) -> pa.Array:
        """Ids of each of distinct chunks."""
        word = _is_word(chunks)
        for t in self.added:
            word &= ~pc.match_substring(chunks, t).to_numpy(zero_copy_only=False)
        got = [e.ids for e in self.tokenizer.encode_batch_fast(chunks.filter(pa.array(~word)).to_pylist(), add_special_tokens=False)]
        rest = _lists(np.cumsum([0, *map(len, got)]), np.array([i for ids in got for i in ids], dtype="<u4"))
        if not word.any():
            return rest
        place = np.empty(len(chunks), dtype=np.int64)
        place[word], place[~word] = np.arange(len(chunks) - len(rest)), np.arange(len(chunks) - len(rest), len(chunks))
        return pa.concat_arrays([self._words(chunks.filter(pa.array(word))), rest]).take(pa.array(place))

    def _encode(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Lists of ids, and which of them is that of each of distinct chunks."""
        if len(self.known) + len(chunks) > KNOWN:
            self._forget()
        at = pc.index_in(chunks, value_set=self.known)
        fresh = at.is_null()
        new = chunks.filter(fresh)
        which = at.fill_null(0).to_numpy().astype(np.int64)
        which[fresh.to_numpy(zero_copy_only=False)] = np.arange(len(self.known), len(self.known) + len(new))
        found = self._new(new)
        ids = pa.concat_arrays([self.ids, found])
        short = pc.less_equal(pc.binary_length(new), LONGEST)
        self.known, self.ids = pa.concat_arrays([self.known, new.filter(short)]), pa.concat_arrays([self.ids, found.filter(short)])
        return ids, which

    def batch(self, texts: Sequence[str | None] | pa.Array) -> list[np.ndarray]:
        """Ids of each text, with the end id; about SLICE bytes of text at a time."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([(t or "").encode("utf-8", "replace") for t in texts], pa.large_binary())
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(texts.buffers()[1] or bytes(8), dtype="<i8")[texts.offset :][: len(texts) + 1]
        out: list[np.ndarray] = []
        lo = 0
        while lo < len(texts):
            hi = min(len(texts), max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE))))
            out += self._slice(np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo])
            lo = hi
        return out

    def _slice(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        mark = np.zeros(len(data) + 1, dtype=bool)
        mark[cut(data) if len(data) > 2 else []] = mark[starts] = True
        places = np.flatnonzero(mark)
        chunks = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        ids, which = self._encode(chunks.dictionary)
        laid = ids.take(pa.array(which[chunks.indices.to_numpy()]))
        # The texts' places among the chunks, then among the ids.
        of = laid.offsets.to_numpy()[np.searchsorted(places, starts)]
        ids = laid.values.to_numpy()
        return [np.append(ids[a:b], np.uint32(self.end)) for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True)]

    def __call__(self, text: str | None) -> np.ndarray:
        return self.batch([text])[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str, end: int = END) -> Encoder:
    return Encoder(path, end)


def pack(ids: np.ndarray, docs: Sequence[tuple[int | None, int]]) -> bytes:
    """The file of a shard. docs: (doc_id, number of ids) of each document, whose sum is the number of ids."""
    n = len(ids)
    levels = max(1, int(ids.max(initial=0)).bit_length())
    directory, payload, zeros, at, now = [], [], [], 0, ids.astype(np.uint16 if levels <= 16 else np.uint32)
    for level in range(levels - 1, -1, -1):
        bits = (now & (1 << level)) != 0
        plane = np.packbits(bits, bitorder="little")
        ones = 0
        for start in range(0, n, CHUNK):
            raw = plane[start // 8 : (start + CHUNK) // 8].tobytes()
            data = zlib.compress(raw, 1)
            data = data if len(data) < len(raw) else raw
            directory.append((ones, at, len(data)))
            payload.append(data)
            at += len(data)
            ones += int(np.count_nonzero(bits[start : start + CHUNK]))
        zeros.append(n - ones)
        now = np.concatenate([now.compress(~bits), now.compress(bits)])
    known = np.array([d is not None for d, _ in docs], dtype=np.uint8)
    index = zlib.compress(known.tobytes() + np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes() + np.array([k for _, k in docs], dtype="<i8").tobytes())
    table = zlib.compress(np.array(directory, dtype="<i8").tobytes())
    header = json.dumps({"n": n, "levels": levels, "zeros": zeros, "docs": len(docs), "chunk": CHUNK, "table": len(table), "index": len(index)}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, table, index, *payload])


class Shard:
    """A shard's file (bytes, or any buffer such as a memory map), read in place."""

    def __init__(self, data) -> None:
        self.data = memoryview(data)
        if bytes(self.data[:8]) != MAGIC:
            raise ValueError("no token file")
        (size,) = struct.unpack("<I", self.data[8:12])
        head = json.loads(bytes(self.data[12 : 12 + size]))
        self.n, self.levels, self.zeros, self.chunk = head["n"], head["levels"], head["zeros"], head["chunk"]
        at = 12 + size
        self.table = np.frombuffer(zlib.decompress(self.data[at : at + head["table"]]), dtype="<i8").reshape(self.levels, -1, 3)
        at += head["table"]
        index = zlib.decompress(self.data[at : at + head["index"]])
        self.payload, k = at + head["index"], head["docs"]
        known = np.frombuffer(index, dtype=np.uint8, count=k)
        ids = np.frombuffer(index, dtype="<i8", offset=k, count=k).tolist()
        self.doc_ids = [i if h else None for i, h in zip(ids, known, strict=True)]
        self.lengths = np.frombuffer(index, dtype="<i8", offset=9 * k, count=k)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._bits = functools.lru_cache(maxsize=64)(self._read)

    def _read(self, level: int, chunk: int) -> np.ndarray:
        """Bytes of one chunk of a plane."""
        _, at, size = self.table[level, chunk].tolist()
        raw = self.data[self.payload + at : self.payload + at + size]
        full = -(-min(self.chunk, self.n - chunk * self.chunk) // 8)
        return np.frombuffer(raw if size == full else zlib.decompress(raw), dtype=np.uint8)

    def _plane(self, level: int) -> np.ndarray:
        whole = [np.unpackbits(self._read(level, c), bitorder="little")[: self.chunk] for c in range(self.table.shape[1])]
        return np.concatenate(whole)[: self.n].astype(bool) if whole else np.zeros(0, dtype=bool)

    def ones(self, level: int, at: int) -> int:
        """Ones of a plane before a place."""
        chunk, bit = divmod(at, self.chunk)
        if chunk == self.table.shape[1]:
            return self.n - self.zeros[level]
        octets, rest = divmod(bit, 8)
        data = self._bits(level, chunk)
        n = int(self.table[level, chunk, 0]) + int(np.bitwise_count(data[:octets]).sum())
        return n + (int(data[octets]) & ((1 << rest) - 1)).bit_count() if rest else n

    def nth(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of a kind in a plane: the chunk by its directory, the byte by running counts."""
        starts = np.arange(self.table.shape[1]) * self.chunk
        before = self.table[level, :, 0] if bit else starts - self.table[level, :, 0]
        chunk = int(np.searchsorted(before, k, side="right")) - 1
        data = self._bits(level, chunk)
        data = data if bit else ~data
        counts = np.cumsum(np.bitwise_count(data), dtype=np.int64)
        k -= int(before[chunk])
        octet = int(np.searchsorted(counts, k, side="right"))
        k -= int(counts[octet - 1]) if octet else 0
        return chunk * self.chunk + 8 * octet + int(np.flatnonzero(np.unpackbits(data[octet : octet + 1], bitorder="little"))[k])

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        token = 0
        for level in range(self.levels):
            ones = self.ones(level, at)
            bit = self.ones(level, at + 1) - ones
            token = token << 1 | bit
            at = self.zeros[level] + ones if bit else at - ones
        return token

    def _span(self, token: int, start: int, stop: int) -> tuple[int, int]:
        """Where the occurrences of an id within a span lie after the last plane."""
        if token < 0 or token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self.ones(level, start), self.ones(level, stop)
            start, stop = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.levels - 1 - level) & 1 else (start - a, stop - b)
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id within a span."""
        a, b = self._span(token, start, self.n if stop is None else stop)
        return b - a

    def places(self, token: int, start: int = 0, stop: int | None = None) -> list[int]:
        """Places of all occurrences of an id within a span, found from the last plane upwards."""
        a, b = self._span(token, start, self.n if stop is None else stop)
        out = []
        for at in range(a, b):
            for level in range(self.levels - 1, -1, -1):
                bit = token >> (self.levels - 1 - level) & 1
                at = self.nth(level, bit, at - self.zeros[level] if bit else at)
            out.append(at)
        return out

    def tokens(self) -> np.ndarray:
        """All ids, plane by plane from the last."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        now = np.zeros(self.n, dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            bits = self._plane(level)
            out = np.empty_like(now)
            out[np.flatnonzero(~bits)] = now[: self.zeros[level]]
            out[np.flatnonzero(bits)] = now[self.zeros[level] :] | kind(1 << (self.levels - 1 - level))
            now = out
        return now.astype("<u4")

    def document(self, k: int) -> np.ndarray:
        """Ids of the shard's k-th document, place by place."""
        start = int(self.starts[k])
        return np.array([self.access(i) for i in range(start, start + int(self.lengths[k]))], dtype="<u4")


def _put(folder: str, name: str, data: bytes) -> str:
    """Write a file to the shared folder, of whatever store pyarrow knows; it has its name only once it is whole."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/.{name}") as out:
        out.write(data)
    store.move(f"{root}/.{name}", f"{root}/{name}")
    return f"{folder}/{name}"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end: int = END, shard: int = SHARD) -> DataFrame:
    """Write `docs` (doc_id, text) as token files in `folder` (a URI all executors share), in ascending doc_id; returns the staged manifest.

    Null ids come first; rows of one id come in the order of their texts' hashes, so that an id with very many rows is
    dealt out too. Null texts count as empty: a document of the end id alone. Very long texts make a shard of their own.
    No documents make no files. Other columns of `docs` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, k, held, index, size = encoder(tokenizer, end), TaskContext.get().partitionId(), 0, [], [], 0

        def close() -> pa.RecordBatch:
            data = pack(np.concatenate(held), index)
            path = _put(folder, f"part-{part:06d}-{k:06d}-{uuid.uuid4().hex}.wm", data)
            row = {"part": part, "shard": k, "path": path, "n_tokens": size, "n_docs": len(index), "n_bytes": len(data)}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("n_tokens", "n_docs", "n_bytes"))]))

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode.batch(batch.column(1)), strict=True):
                if held and size + len(ids) > shard:
                    yield close()
                    k, held, index, size = k + 1, [], [], 0
                held.append(ids)
                index.append((doc, len(ids)))
                size += len(ids)
        if held:
            yield close()

    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), "text")
    rows = rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
    return C.stage(rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MANIFEST), keep=True)


def starts(manifest: DataFrame) -> DataFrame:
    """The manifest with `base`: the ids of all shards before. Shards are added up within their part first."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("of_parts"))
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    return manifest.withColumn("inner", inner).join(parts, "part").withColumn("base", F.col("of_parts") + F.col("inner")).drop("of_parts", "inner")


def _each_shard(manifest: DataFrame, visit, schema: str) -> DataFrame:
    """`visit(shard, base)` -> frame, over the files that the manifest names, by Spark's reader of whole files."""
    spark = manifest.sparkSession
    folders = [r["folder"] for r in manifest.select(F.regexp_replace("path", "/[^/]+$", "").alias("folder")).distinct().collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folders).select(name("path").alias("name"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data, base in zip(pdf["content"], pdf["base"], strict=True):
                yield visit(Shard(data), int(base))

    known = starts(manifest).select(name("path").alias("name"), "base")
    # Files stay where they are read; the names of all shards are far smaller than their contents.
    return files.join(known, "name").select("content", "base").mapInPandas(run, schema)


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of each document, from the files."""

    def visit(shard: Shard, base: int) -> pd.DataFrame:
        ids, at = shard.tokens(), shard.starts.tolist()
        crc = [zlib.crc32(ids[a : a + k].tobytes()) for a, k in zip(at, shard.lengths.tolist(), strict=True)]
        return pd.DataFrame({"doc_id": pd.Series(shard.doc_ids, dtype="Int64"), "start": shard.starts + base, "n_tokens": shard.lengths, "ids_crc32": crc})

    return _each_shard(manifest, visit, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start and the ids of each document, from the files."""

    def visit(shard: Shard, base: int) -> pd.DataFrame:
        ids = shard.tokens()
        rows = [ids[a : a + k] for a, k in zip(shard.starts.tolist(), shard.lengths.tolist(), strict=True)]
        return pd.DataFrame({"doc_id": pd.Series(shard.doc_ids, dtype="Int64"), "start": shard.starts + base, "ids": rows})

    return _each_shard(manifest, visit, "doc_id long, start long, ids array<int>")


def count_tokens(manifest: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """token, n: occurrences of each of some ids in all files, by ranks alone."""
    wanted = sorted(set(tokens))
    visit = lambda shard, base: pd.DataFrame({"token": wanted, "n": [shard.count(t) for t in wanted]})
    return _each_shard(manifest, visit, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(manifest: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """token, doc_id, place (within its document) of every occurrence of some ids, by selects: the rest isn't decoded."""
    wanted = sorted(set(tokens))

    def visit(shard: Shard, base: int) -> pd.DataFrame:
        found = [(t, p) for t in wanted for p in shard.places(t)]
        at = np.array([p for _, p in found], dtype=np.int64)
        doc = np.searchsorted(shard.starts, at, side="right") - 1
        ids = pd.Series([shard.doc_ids[d] for d in doc], dtype="Int64")
        return pd.DataFrame({"token": [t for t, _ in found], "doc_id": ids, "place": at - shard.starts[doc] if len(at) else at}).astype({"token": "int64"})

    return _each_shard(manifest, visit, "token long, doc_id long, place long")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the files, reads them back and deletes them again; `write_shards` keeps them."""
    import public_tokenizers

    folder = f"{C.shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    try:
        manifest = write_shards(C.table(spark, sf_dir, "documents"), folder, str(public_tokenizers.path(VOCABULARY)))
        out = C.stage(read_documents(manifest), keep=True)
        C.drop(manifest)
        return out
    finally:
        C._delete(spark, folder)
