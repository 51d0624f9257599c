"""Shared helpers of the training-data operators: tables, staging and word columns."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space and the ASCII controls tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where unset, a temporary folder if Spark runs in this process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='vesselflow-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


class _Scratches(threading.local):
    """Paths of the tables staged within each open `scratch` of a thread."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scratches = _Scratches()


def stage(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write to a new table in the shared folder and read it back: lineage is cut, sizes are known to the planner.

    Within a `scratch` the table goes when that ends; one that is kept goes when the scratch around that ends, if any.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    if len(_scratches.open) > keep:
        _scratches.open[-1 - keep].append(path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what is staged inside when it ends; results must be staged with keep=True before that."""
    _scratches.open.append([])
    try:
        yield
    finally:
        for name in _scratches.open.pop():
            _delete(spark, name)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(staged: DataFrame) -> None:
    """Delete a table that `stage` has returned and that nothing will read again, before its `scratch` ends."""
    _delete(staged.sparkSession, staged._staged)


def words(text: Column | str) -> Column:
    """Array of the text's words; null and blank texts have none."""
    col = F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(col != "", F.split(col, SPACE)).otherwise(F.array().cast("array<string>"))


def n_words(text: Column | str) -> Column:
    """Number of words; null and blank texts have none."""
    col = F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(col != "", F.size(F.split(col, SPACE))).otherwise(0).cast("long")


def count_chars(text: Column, kind: str) -> Column:
    """How many characters of `text` are in the regular-expression class `kind`."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", "")).cast("long")


#: A map has this many bits for each key, as a power of two, up to the largest map (16 MB); more keys get no map.
BITS_PER_KEY = 16
MOST_BITS = 1 << 27


def map_bits(n: int) -> int | None:
    """Bits of a map of n keys, or None where the largest map would be so full that it keeps most other keys."""
    bits = 1 << max(12, (n * BITS_PER_KEY - 1).bit_length())
    return min(bits, MOST_BITS) if n * 4 <= MOST_BITS else None


def fresh(rows: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as make it a column that `rows` doesn't have."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _mapped(rows: DataFrame, wanted: DataFrame, key: Sequence[str]) -> DataFrame | None:
    """`rows` with one more column, the last: whether a bitmap of bounded size, which is broadcast, has the key; None where it would be too full."""
    bits = map_bits(wanted.count())
    if bits is None:
        return None
    slot = F.pmod(F.xxhash64(*key), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot, F.lit(64)).cast("int"))
    m, b, held = (fresh(rows, name) for name in ("_m", "_b", "_in"))
    words = wanted.select(F.shiftright(slot, 6).alias(m), bit.alias(b)).groupBy(m).agg(F.bit_or(b).alias(b))
    got = rows.withColumn(m, F.shiftright(slot, 6)).join(F.broadcast(words), m, "left")
    return got.select(*(F.col(f"`{c}`") for c in rows.columns), F.coalesce(F.col(b).bitwiseAND(bit) != 0, F.lit(False)).alias(held))


def maybe_in(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """`rows` without most of those whose key is not in `wanted`.

    It spares the rows that a join would shuffle for nothing; the join itself must follow. `wanted` is read twice, so it
    should be a staged table. Beyond 2**25 keys the bitmap would keep nearly all rows, so they go on unfiltered.
    """
    got = _mapped(rows, wanted, key)
    return rows if got is None else got.where(F.col(got.columns[-1])).drop(got.columns[-1])


def without(rows: DataFrame, gone: DataFrame, *key: str) -> DataFrame:
    """`rows` whose key is not in `gone` (staged): only those that share a bit of the bitmap with a key are shuffled."""
    got = _mapped(rows, gone, key)
    if got is None:
        return rows.join(gone, list(key), "left_anti")
    held = got.columns[-1]
    unsure = got.where(F.col(held)).drop(held).join(gone, list(key), "left_anti")
    return got.where(~F.col(held)).drop(held).unionByName(unsure.select(*(F.col(f"`{c}`") for c in rows.columns)))
