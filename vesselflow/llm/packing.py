"""Best-fit packing of token sequences under several capacities at once.

A bin has three residual capacities: tokens, documents and attention cost (the sum of squared lengths). Pieces are
placed in falling length; of the open bins that can take a piece under every constraint, the one is chosen whose
residual, after placing, has the least weighted norm (each capacity as a share of its whole). Pieces that fill a bin
need no search. Blocks of pieces are packed side by side, each in one task of bounded size; bins that a block leaves
with room are unpacked again and meet those of other blocks in the next round, until all that is left is one block.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

SEQUENCE = 2048
MAX_DOCS = 2048
MAX_COST = SEQUENCE * SEQUENCE
#: Weights of tokens, documents and attention cost in the norm.
WEIGHTS = (1.0, 0.01, 0.01)
BLOCK = 2048
FULL = 0.97
END = 0
VOCABULARY = "byte_bpe_50k"


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """The vocabulary's ranks under tiktoken, which gives the ids of the tokenizers file of the same name, several times faster.

    `\\s+(?!\\S)` only matters where two white-space characters meet; without it the pattern needs no backtracking.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    make = lambda name, pattern: tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    plain = make("single", public_tokenizers.PATTERN.replace(r"\s+(?!\S)|", ""))
    return plain, make("runs", public_tokenizers.PATTERN), re.compile(r"\s\s")


def encode(text: str | None, path: str) -> np.ndarray:
    """Ids of the text and the end id."""
    plain, runs, double = _encoder(path)
    if not text:
        return np.array([END], dtype="<u4")
    text = text.encode("utf-8", "replace").decode("utf-8")
    ids = (runs if double.search(text) else plain).encode_to_numpy(text, allowed_special="all")
    return np.append(ids, np.uint32(END)).astype("<u4")


def pieces_of(n: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences at the end, what is left over first."""
    first = n % size or min(n, size)
    return [(0, first), *((at, size) for at in range(first, n, size))]


def pack_block(lengths: np.ndarray, size: int, max_docs: int, max_cost: float, weights=WEIGHTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece of one block, and each bin's tokens."""
    order = np.argsort(-lengths, kind="stable")
    whole = np.array([size, max_docs, max_cost], dtype=float)
    scale = np.sqrt(np.array(weights)) / whole
    left = np.empty((len(lengths), 3))
    live = np.empty(len(lengths), dtype=np.int64)  # rows of `left` that are still open
    n_live = n_bins = 0
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    least = lengths.min(initial=1)
    for i in order:
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        after = left[live[:n_live]] - need
        fits = np.flatnonzero((after >= 0).all(axis=1))
        if len(fits):
            norm = ((after[fits] * scale) ** 2).sum(axis=1)
            k = fits[np.argmin(norm)]
            b = live[k]
        else:
            b, k = n_bins, n_live
            left[b] = whole
            live[n_live] = b
            n_bins, n_live = n_bins + 1, n_live + 1
        bins[i], offsets[i] = b, size - left[b, 0]
        left[b] -= need
        if left[b, 0] < least or left[b, 1] < 1:  # nothing can join
            n_live -= 1
            live[k] = live[n_live]
    return bins, offsets, (size - left[:n_bins, 0]).astype(np.int64)


def tokenise(docs: DataFrame, path: str, size: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. Null and empty texts are one piece, the end id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = encode(text, path)
                rows += [(doc, k, at, n, zlib.crc32(ids[at : at + n].tobytes())) for k, (at, n) in enumerate(pieces_of(len(ids), size))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, size: int = SEQUENCE, max_docs: int = MAX_DOCS, max_cost: float = MAX_COST, block: int = BLOCK) -> DataFrame:
    """`pieces` (with `length` and an identifying doc_id, piece) with sequence_id and offset added.

    Every piece must fit an empty bin. Rows with the same doc_id and piece are separate pieces. An empty table gives
    an empty result. Columns named sequence_id and offset are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    level, number = C.fresh(pieces, "fill"), C.fresh(pieces, "_block")
    n = pieces.where(F.col("length") < size).count()
    # A piece that fills a bin has a negative id; others have round, block and bin in theirs.
    full = pieces.where(F.col("length") == size).withColumn("sequence_id", -F.monotonically_increasing_id() - 1).withColumn("offset", F.lit(0).cast("long"))
    rest, done, rounds = pieces.where(F.col("length") < size), [full], 0
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long, `{level}` long"

    def run(rounds: int):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
            bins, offsets, fill = pack_block(pdf["length"].to_numpy(), size, max_docs, max_cost)
            base = (rounds << 58) + (int(pdf[number].iat[0]) << 24)
            return pdf.drop(columns=number).assign(**{"sequence_id": bins + base, "offset": offsets, level: fill[bins]})

        return one

    while True:
        n_blocks = max(1, -(-n // block))
        dealt = rest.withColumn(number, F.pmod(F.xxhash64("doc_id", "piece", F.lit(rounds)), F.lit(n_blocks)))
        packed = C.stage(dealt.groupBy(number).applyInPandas(run(rounds), schema))
        if n_blocks == 1 or rounds == 7:
            done.append(packed.drop(level))
            break
        roomy = F.col(level) < F.lit(int(FULL * size))
        left = packed.where(roomy).count()
        if left in (0, n):
            done.append(packed.drop(level))
            break
        done.append(packed.where(~roomy).drop(level))
        rest, n, rounds = packed.where(roomy).select(*pieces.columns), left, rounds + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def tokenizer_path(name: str = f"{VOCABULARY}.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = C.stage(tokenise(C.table(spark, sf_dir, "documents"), tokenizer_path()))
    return pack(pieces)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(C.stage(tokenise(docs, tokenizer_path())))
