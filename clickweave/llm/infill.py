"""Fill-in-middle transformation with cuts at line ends.

A text is cut at two unit ends (a unit is a line with its line feed) into
prefix, middle and suffix, and written in one of two orders with markers:

    psm: <P>prefix<S>suffix<M>middle        spm: <S>suffix<P>prefix<M>middle

The ends of the units are kept as a compressed set of code point offsets, in
the manner of roaring bitmaps: offsets with the same upper 16 bits share a
container, which is, whatever is smallest, a sorted array of the lower bits
(few of them), a bitmap of 65,536 bits (many), or a list of runs (neighbours,
such as the ends of empty lines). The containers' cumulative cardinalities
answer "the k-th end" with a binary search for the container and a select inside
it: an index, a search over the bitmap's cumulative word counts, or one over the
runs' cumulative lengths. So a text of n units needs at most 2 bytes a unit or 8
KB a container, and both cuts are found without the list of units.

The draws are four 32-bit numbers of SHA-256(seed + ":" + id): two for the cuts,
one for the rate, one for the order, so reruns agree and rows can be computed
anywhere. A text that holds a marker stays plain: it could not be rebuilt.
Neither a piece nor a seam can hold one then, since "<" stands only at a
marker's start, so ``restore`` is exact.

Defined results: a null text is an empty one, which stays plain; a null id
draws as the empty string; equal rows are transformed alike; very long texts
are read whole, in slices of ``SLICE`` code points; an empty table gives an
empty result; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.common import read_table, releasing, ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 100    # percent of the texts that are transformed
SPM = 50      # percent of these in suffix-prefix-middle order
SEED = "7"
CONTAINER = 1 << 16
SLICE = CONTAINER * 16


class ArrayContainer:
    """Sorted lower 16 bits: 2 bytes an offset."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.low)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """65,536 bits as 64-bit words, with the counts of set bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(CONTAINER, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words)
        self.upto = np.cumsum(counts, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, side="right"))
        word = int(self.words[at])
        for _ in range(k - int(self.upto[at - 1] if at else 0)):
            word &= word - 1  # drop the lowest set bit
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Starts of runs of neighbouring offsets, with the counts up to each."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.upto = np.cumsum(lengths, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.upto[-1])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.starts[at]) + k - int(self.upto[at - 1] if at else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted offsets below 65,536 (at least one):
    4 bytes a run, 2 bytes an offset, or 8 KB."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(low), CONTAINER // 8):
        return RunContainer(low[first], np.diff(np.append(first, len(low))))
    return ArrayContainer(low) if 2 * len(low) < CONTAINER // 8 else BitmapContainer(low)


class BoundarySet:
    """A growing set of offsets; ``add`` takes them in ascending order."""

    def __init__(self):
        self.keys: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        self.upto: list[int] = []
        self._open: list[np.ndarray] = []  # of the last key, not yet packed

    def add(self, offsets: np.ndarray) -> None:
        keys = offsets >> 16
        for at in np.flatnonzero(np.diff(keys, prepend=-1)).tolist():
            key = int(keys[at])
            part = offsets[at:at + int(np.searchsorted(keys[at:], key, side="right"))] & (CONTAINER - 1)
            if not self.keys or self.keys[-1] != key:
                self.seal()
                self.keys.append(key)
            self._open.append(part)

    def seal(self) -> BoundarySet:
        if self._open:
            self.containers.append(container(np.concatenate(self._open)))
            self.upto.append((self.upto[-1] if self.upto else 0) + len(self.containers[-1]))
            self._open = []
        return self

    def __len__(self) -> int:
        return self.upto[-1] if self.upto else 0

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.upto, k, side="right"))
        return (self.keys[at] << 16) + self.containers[at].select(k - (self.upto[at - 1] if at else 0))


def line_ends(text: str) -> BoundarySet:
    """Offsets behind each line feed, and the end of a last line without one."""
    ends = BoundarySet()
    for start in range(0, len(text), SLICE):
        codes = np.frombuffer(text[start:start + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends.add(np.flatnonzero(codes == 10) + (start + 1))
    if text and text[-1] != "\n":
        ends.add(np.array([len(text)]))
    return ends.seal()


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


_MARKER = re.compile("|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))))


def rearrange(doc_id: int | None, text: str | None, rate: int = RATE, spm: int = SPM,
              seed: str = SEED) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars and the output of one text."""
    text = text or ""
    ends = line_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or _MARKER.search(text):
        return n, "plain", None, None, text
    a, b = (ends.select(k - 1) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])


def transform(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: str = SEED) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and the text to train
    on, ``output`` (columns of these names are replaced)."""
    ship(docs.sparkSession)
    kept = docs.select(*[c for c in docs.columns if c not in RESULT.names])
    ids, texts = kept.columns.index("doc_id"), kept.columns.index("text")
    schema = T.StructType([*kept.schema.fields, *RESULT.fields])
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [rearrange(i, t, rate, spm, seed)
                    for i, t in zip(batch.column(ids).to_pylist(), batch.column(texts).to_pylist(), strict=True)]
            new = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return kept.mapInArrow(releasing(run), schema)


def restore(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The original text, from the output and its form alone."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, _MARKER.pattern, -1)
    prefix, suffix = (F.when(form == "spm", part[i]).otherwise(part[3 - i]) for i in (2, 1))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, part[3], suffix))


def op12_infill(spark, sf_dir):
    """Every document cut at line ends, with its output's and rebuilt text's digests."""
    done = transform(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha256 = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       sha256(F.col("output")).alias("output_sha256"), sha256(restore()).alias("restored_sha256"))


OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines FROM documents),
h AS (SELECT *, len(lines) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                       OR h3 % 100 >= {RATE} THEN 'plain'
                     WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
             least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
p AS (SELECT *, array_to_string(lines[1:a], '') AS pre, array_to_string(lines[a + 1:b], '') AS mid,
             array_to_string(lines[b + 1:], '') AS suf FROM f),
o AS (SELECT *, CASE form WHEN 'plain' THEN text
                          WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
                          ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END AS output FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM o
"""
