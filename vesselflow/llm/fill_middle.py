"""Fill-in-middle: texts cut at two hashed places and put in another order, for training models to fill gaps.

An Arrow-batched pandas UDF does all of it. The units of a text (code points, words, lines: a regular expression) are
found by `finditer` from left to right, and only the offsets of their ends are kept, in a compact array; the two cuts are
two lookups in it. Seeds come from a hash of the document's id, so any run on any cluster cuts alike.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

#: Marks of prefix, suffix and middle; percentages of documents cut, and of these with the suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT, SUFFIX_FIRST = 90, 20
SEED = 1
CODE_POINT = "."
_SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"


def seeds(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits from the id; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else int(doc_id)}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(text: str, unit: regex.Pattern) -> array:
    """Offsets at which the units of a text end, four bytes each (eight for texts that need them)."""
    return array("I" if len(text) < 1 << 32 else "Q", (m.end() for m in unit.finditer(text)))


def transform(doc_id: int | None, text: str | None, unit: regex.Pattern, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    ends = unit_ends(text, unit)
    n = len(ends)
    a, b, c, d = seeds(doc_id, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or c % 100 >= cut:
        return n, "plain", None, None, text
    first, second = sorted((a % (n + 1), b % (n + 1)))
    i, j = (ends[k - 1] if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if d % 100 < suffix_first:
        return n, "spm", i, j - i, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", i, j - i, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that an output comes from. No mark can begin within a part and end outside it, as a part holds no mark and no mark overlaps another."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output.removeprefix(first).split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return two + middle + one if form == "spm" else one + middle + two


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fill_in_middle(docs: DataFrame, unit: str = CODE_POINT, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST, with_output: bool = True) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output, output_sha256, restored_sha256 of each document.

    unit: pattern of a unit; what stands between units goes with the unit after it, what stands after the last is
    suffix. Null texts count as empty ones, which stay plain; so do texts with a mark in them. Rows with one id are cut by
    the same numbers; null ids count as empty. restored_sha256 is of the text rebuilt from the output and its form.
    with_output=False leaves the output column out and its texts in the tasks. Other columns of `docs` are not read.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        pattern = regex.compile(unit, regex.DOTALL)
        for ids, texts in batches:
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                n, form, i, j, out = transform(None if doc_id is None else int(doc_id), text, pattern, seed, cut, suffix_first)
                rows.append((n, form, i, j, out if with_output else None, _sha(out), _sha(restore(out, form))))
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])
            yield frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64", "n": "int64"})

    udf = F.pandas_udf(run, _SCHEMA)
    # Ids go as text: pandas would make floats of longs where some are null.
    got = docs.select("doc_id", udf(F.col("doc_id").cast("string"), F.col("text")).alias("_f")).select("doc_id", "_f.*")
    return got if with_output else got.drop("output")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(C.table(spark, sf_dir, "documents"), with_output=False)


_U = "CAST(('0x' || substr(h, {at}, 8)) AS UBIGINT)"
SQL = {
    "op13_fill_in_middle": f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    k AS (SELECT *, CAST(least({_U.format(at=1)} % (n + 1), {_U.format(at=9)} % (n + 1)) AS BIGINT) AS a, CAST(greatest({_U.format(at=1)} % (n + 1), {_U.format(at=9)} % (n + 1)) AS BIGINT) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_U.format(at=17)} % 100 >= 90 THEN 'plain' WHEN {_U.format(at=25)} % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM k)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
}
