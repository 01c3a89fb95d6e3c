"""Remove long passages that an earlier document already holds, byte by byte.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a
document with a smaller id. Texts are UTF-8 bytes, matches never cross
documents, and strings are judged on the input.

A suffix array of the whole corpus would have to move every suffix through a
shuffle. Here the array is split by content instead:

1. *Anchors.* The anchor of a ``LENGTH``-byte string is the smallest hash among
   its ``GRAM``-byte grams, so equal strings have equal anchors wherever they
   stand. Consecutive strings with one anchor form a region (its bytes reach
   to the end of its last string). Only (anchor, hash of the region's bytes,
   document, position) is shuffled, packed in arrays; within a map batch,
   regions equal to one of a smaller document are settled at once, so that a
   passage shared by very many documents reaches the next step about once for
   each batch.
2. *Equal regions.* Per anchor, equal regions are one entry with all its
   occurrences; all but those of the smallest document are covered.
3. *Common-prefix interval tree.* Anchors with two or more different regions
   go on: their regions' bytes are brought together (those of an anchor with
   very many regions in parts, by the hash of the strings) and sorted as an
   enhanced suffix array (all suffixes that start a string, with their common-prefix
   lengths). A stack scan yields its intervals of depth ``LENGTH`` or more;
   those whose occurrences differ in the byte to the left are maximal repeats,
   and each is given out with all its occurrences. All that are not in the
   smallest document of a group are covered.

Every string of ``LENGTH`` bytes that two documents share has one anchor, thus
lies in regions of one group, thus in a maximal repeat with the same
occurrences: the result is exact (regions are taken as equal by 98 bits of
hash; all other matches by their bytes).

Defined results: null text is an empty one; a row without an id is smaller and
greater than no other, so it neither loses nor takes; rows that share an id
never remove from each other, and each is returned; an empty table gives an
empty result; other columns are ignored (``cut`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import read_table, release, releasing, ship
from clickweave.llm.minhash import CHUNK, _mix, _power

LENGTH = 50
GRAM = 20
LONGEST = 64                 # strings in a region at most
BUCKET_BYTES = 8 << 20       # text whose anchors meet in one task
BUCKETS = 100_000
SHARD_REGIONS = 2_000        # different regions of one anchor that are scanned together
PART_BYTES = 4 << 20         # text whose equal regions are settled before the shuffle
_U = np.uint64
_ANCHOR_BASE = 0x9E3779B97F4A7C15
_ANCHOR_MASK, _REGION_MASK = _U((1 << 40) - 1), _U((1 << 48) - 1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - have:]) if have < width else out


def regions(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, start, strings, anchor, hash) of every region, by text and
    start. Very long texts are cut into overlapping parts: no string is lost,
    a region may be cut in two."""
    out, group, size = [], [], 0
    step = 2 * CHUNK
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), step):
            part = text[at:at + step + LENGTH - 1] if len(text) > step else text
            if group and size + len(part) > CHUNK:
                out.append(_regions(group))
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        out.append(_regions(group))
    if not out:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _regions(group: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(t for _, _, t in group), dtype=np.uint8)
    n, strings = len(data), len(data) - LENGTH + 1
    power, inverse = _power(n, _ANCHOR_BASE)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * power[:n], out=total[1:])
    grams = _mix((total[GRAM:] - total[:-GRAM]) * inverse[:n - GRAM + 1])
    anchor = _sliding_min(grams, LENGTH - GRAM + 1)
    valid = np.ones(n, dtype=bool)
    lengths = np.array([len(t) for _, _, t in group])
    first = np.cumsum(lengths) - lengths
    for end in first + lengths:
        valid[end - LENGTH + 1:end] = False
    valid = valid[:strings]
    new = np.ones(strings, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    new &= valid
    start = np.flatnonzero(new)
    stop = np.minimum(np.append(start[1:], strings), (first + lengths)[np.searchsorted(first, start, side="right") - 1] - LENGTH + 1)
    long = np.flatnonzero(stop - start > LONGEST)
    if len(long):  # periodic text: one anchor over a long stretch
        more = [np.arange(start[k], stop[k], LONGEST) for k in long]
        ends = [np.append(m[1:], stop[k]) for m, k in zip(more, long, strict=True)]
        keep = np.ones(len(start), dtype=bool)
        keep[long] = False
        start, stop = np.concatenate([start[keep], *more]), np.concatenate([stop[keep], *ends])
        order = np.argsort(start)
        start, stop = start[order], stop[order]
    whole = _mix((total[stop + LENGTH - 1] - total[start]) * inverse[start] + (stop - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    of = np.searchsorted(first, start, side="right") - 1
    text = np.array([i for i, _, _ in group])[of]
    at = np.array([a for _, a, _ in group])[of]
    return text, start - first[of] + at, stop - start, anchor[start], whole


# -- packed arrays: little-endian byte planes, so that high bytes compress ----
def _planes(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


_PARTS = (("anchor", 5), ("region", 6), ("start", 5), ("strings", 1))


def _pack(doc: np.ndarray, copy: np.ndarray, anchor, region, start, strings) -> bytes:
    """Entries in document order; the documents as a table with counts."""
    same = np.concatenate(([True], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])))
    rows = np.flatnonzero(same)
    counts = np.diff(np.append(rows, len(doc)))
    head = np.array([len(doc), len(rows)], dtype="<i8").tobytes()
    ids = doc[rows]
    table = _planes(np.diff(ids, prepend=ids.dtype.type(0)).view(np.uint64), 8) + _planes(copy[rows], 4) + _planes(counts, 4)
    return head + table + b"".join(_planes(v, w) for v, (_, w) in zip((anchor, region, start, strings), _PARTS, strict=True))


def _unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    n, m = np.frombuffer(blob, dtype="<i8", count=2)
    at = 16
    out = []
    for size, width in ((m, 8), (m, 4), (m, 4), *((n, w) for _, w in _PARTS)):
        out.append(_unplanes(blob[at:at + size * width], int(size), width))
        at += size * width
    doc = np.cumsum(out[0].view(np.int64))
    return np.repeat(doc, out[2].astype(np.int64)), np.repeat(out[1], out[2].astype(np.int64)), *out[3:]


def _settle(doc, anchor, region) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by anchor and region; in that order, flags of the entries whose
    region a smaller document holds, and of the first entry of each region."""
    key = (anchor << _U(32)) | ((region >> _U(8)) & _U(0xFFFFFFFF))
    order = np.argsort(key)
    for order in (order, None):
        if order is None:  # the short keys of different regions agree
            order = np.lexsort((region, anchor))
        a, r, d, k = anchor[order], region[order], doc[order], key[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
        if not (new[1:] & (k[1:] == k[:-1])).any():
            break
    first = np.flatnonzero(new)
    if not len(first):
        return order, np.empty(0, bool), new
    least = np.repeat(np.minimum.reduceat(d, first), np.diff(np.append(first, len(d))))
    return order, d > least, new


def _find_anchors(buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary()), ("doc_id", pa.int64()), ("copy", pa.int32()),
                        ("start", pa.int64()), ("stop", pa.int64())])

    def settle(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = part.column("doc_id").to_numpy(zero_copy_only=False)
        copies = part.column("copy").to_numpy(zero_copy_only=False).astype(np.int64)
        text, start, strings, anchor, region = regions([t.encode() for t in part.column("text").to_pylist()])
        if not len(text):
            return
        doc, copy = ids[text], copies[text]
        bucket = ((anchor >> _U(40)) % _U(buckets)).astype(np.int64)
        anchor, region = anchor & _ANCHOR_MASK, region & _REGION_MASK
        order, covered, _ = _settle(doc, anchor, region)
        known, send = order[covered], order[~covered]
        send = send[np.lexsort((start[send], copy[send], doc[send], bucket[send]))]
        groups = np.split(send, np.flatnonzero(np.diff(bucket[send])) + 1)
        yield _rows(schema, bucket=[int(bucket[g[0]]) for g in groups],
                    blob=[_pack(*(x[g] for x in (doc, copy, anchor, region, start, strings))) for g in groups])
        if len(known):
            d, c, a, b = _merged(doc[known], copy[known], start[known], start[known] + strings[known] + LENGTH - 1)
            yield _rows(schema, bucket=(d % buckets).astype(np.int32), doc_id=d, copy=c.astype(np.int32), start=a, stop=b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.nbytes
            if size >= PART_BYTES:
                yield from settle(pa.concat_batches(waiting))
                waiting, size = [], 0
        if waiting:
            yield from settle(pa.concat_batches(waiting))

    return run


def _rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _merged(doc, copy, start, stop) -> tuple[np.ndarray, ...]:
    """Overlapping and touching spans of a document as one."""
    if not len(doc):
        return doc, copy, start, stop
    order = np.lexsort((start, copy, doc))
    doc, copy, start, stop = (x[order] for x in (doc, copy, start, stop))
    row = np.concatenate(([True], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])))
    # running maximum of the stops within a row, by shifting each row's range
    number = np.cumsum(row)
    reach = np.maximum.accumulate(stop + number * (1 << 40)) - number * (1 << 40)
    new = row.copy()
    new[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return doc[first], copy[first], start[first], reach[last]


_SPANS = "anchor long, parts int, doc_id long, copy int, start long, stop long"


def _match_regions(pdf: pd.DataFrame, together: int) -> pd.DataFrame:
    """Per bucket: spans covered by equal regions, and (with an anchor) the
    regions whose bytes are asked for, as they differ from others with the
    same anchor. Spans settled before are passed on."""
    bucket = int(pdf["bucket"].iloc[0])
    done = pdf[pdf["blob"].isna()]
    out = [pd.DataFrame({"anchor": pd.array([None] * len(done), "Int64"), "parts": 1, **{
        c: done[c].astype("int64") for c in ("doc_id", "copy", "start", "stop")}})]
    parts = [_unpack(b) for b in pdf["blob"].dropna()]
    if parts:
        doc, copy, anchor, region, start, strings = (np.concatenate(x) for x in zip(*parts, strict=True))
        copy, start, strings = copy.astype(np.int64), start.astype(np.int64), strings.astype(np.int64)
        order, covered, new = _settle(doc, anchor, region)
        a = anchor[order]
        number = np.cumsum(np.concatenate(([True], a[1:] != a[:-1]))) - 1
        regions_of = np.bincount(number, weights=new)[number]
        different = regions_of > 1
        known, ask = order[covered], order[~covered & different]
        d, c, s, e = _merged(doc[known], copy[known], start[known], start[known] + strings[known] + LENGTH - 1)
        out.append(pd.DataFrame({"anchor": pd.array([None] * len(d), "Int64"), "parts": 1, "doc_id": d, "copy": c, "start": s, "stop": e}))
        full = anchor[ask] | (_U(bucket & 0x7FFFFF) << _U(40))
        chunks = np.ceil(regions_of[~covered & different] / together).astype(np.int64)
        out.append(pd.DataFrame({"anchor": pd.array(full.astype(np.int64), "Int64"), "parts": chunks, "doc_id": doc[ask], "copy": copy[ask],
                                 "start": start[ask], "stop": start[ask] + strings[ask] + LENGTH - 1}))
    release()
    return pd.concat(out)


def _string_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of each data[at:at + length]."""
    power, inverse = _power(len(data), _ANCHOR_BASE)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * power[:len(data)], out=total[1:])
    return _mix((total[at + length] - total[at]) * inverse[at])


def _cut_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes asked for, from rows (doc_id, copy, text, items). Regions of
    an anchor with very many are dealt to several parts by the hash of their
    strings: equal strings meet, and no part grows with the anchor."""
    schema = pa.schema([("anchor", pa.int64()), ("parts", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()), ("copy", pa.int32()),
                        ("start", pa.int64()), ("bytes", pa.binary())])
    for batch in batches:
        out: list[list] = [[] for _ in schema]
        for doc, copy, text, items in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "copy", "text", "items")], strict=True):
            data = text.encode()
            for x in items:
                if x["anchor"] is None or x["copy"] != copy:
                    continue
                region, parts = data[x["start"]:x["stop"]], x["parts"]
                meets = [0]
                if parts > 1:
                    strings = _string_hashes(np.frombuffer(region, np.uint8), np.arange(len(region) - LENGTH + 1), LENGTH)
                    meets = np.unique(strings % _U(parts)).tolist()
                for part in meets:
                    for column, value in zip(out, (x["anchor"], parts, part, doc, copy, x["start"], region), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)


# -- the enhanced suffix array ------------------------------------------------
def _shared(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which strings, by their hashes, two documents hold."""
    if not len(h):
        return np.empty(0, bool)
    order = np.argsort(h)
    first = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
    d = doc[order]
    several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
    out = np.zeros(len(h), dtype=bool)
    out[order] = np.repeat(several, np.diff(np.append(first, len(h))))
    return out


def suffixes(parts: list[bytes], docs: np.ndarray, length: int = LENGTH, dealt: np.ndarray | None = None,
             share: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Enhanced suffix array of the parts' suffixes of ``length`` bytes or more
    whose first ``length`` bytes two documents hold: (part, place in the part,
    common prefix with the suffix before, left byte or -1). Of a part that is
    dealt out to several shares, only the suffixes of this share."""
    lengths = np.array([len(p) for p in parts])
    count = np.maximum(lengths - length + 1, 0)
    part = np.repeat(np.arange(len(parts)), count)
    if not len(part):
        return part, part, part, part
    place = np.arange(len(part)) - np.repeat(np.cumsum(count) - count, count)
    words = -(-int(lengths.max()) // 8)
    data = np.frombuffer(b"".join(parts) + bytes(8 * words + 8), dtype=np.uint8)
    at = (np.cumsum(lengths) - lengths)[part] + place
    h = _string_hashes(data, at, length)
    if dealt is not None and (dealt > 1).any():
        own = h % dealt[part].astype(np.uint64) == share[part].astype(np.uint64)
        part, place, at, h = part[own], place[own], at[own], h[own]
    keep = _shared(h, docs[part])
    part, place, at = part[keep], place[keep], at[keep]
    rest = lengths[part] - place
    keys = []
    for w in range(0, 8 * words, 8):
        block = data[at[:, None] + np.arange(w, w + 8)]
        block[np.arange(w, w + 8)[None, :] >= rest[:, None]] = 0
        keys.append(block.view(">u8").reshape(-1).astype(np.uint64))
    order = np.lexsort((rest, *keys[::-1]))
    common = np.zeros(len(order), dtype=np.int64)
    going = np.ones(max(len(order) - 1, 0), dtype=bool)
    for k in keys:
        x = k[order][1:] ^ k[order][:-1]
        same = sum(((x >> _U(8 * b)) == 0).astype(np.int64) for b in range(8))
        common[1:] += np.where(going, same, 0)
        going &= x == 0
    rest = rest[order]
    common[1:] = np.minimum(common[1:], np.minimum(rest[1:], rest[:-1]))
    left = np.where(place > 0, data[np.maximum(at - 1, 0)].astype(np.int64), -1)[order]
    return part[order], place[order], common, left


def maximal_repeats(common: np.ndarray, left: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """Stack scan of the common-prefix lengths: (depth, first, last) of every
    interval of depth ``length`` or more whose suffixes differ in their left
    byte (a missing one differs from all)."""
    changes = np.concatenate(([0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0)))).tolist() if len(left) else []
    lcp = common.tolist()
    deep = np.flatnonzero(common >= length)
    runs = np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1) if len(deep) else []
    for run in runs:
        stack: list[tuple[int, int]] = []  # depth, first suffix
        for i in [*run.tolist(), run[-1] + 1]:
            depth = lcp[i] if i <= run[-1] else 0
            first = i - 1
            while stack and stack[-1][0] > depth:
                top, first = stack.pop()
                if changes[i - 1] > changes[first]:
                    yield top, first, i - 1
            if depth >= length and (not stack or stack[-1][0] < depth):
                stack.append((depth, first))


def _scan(pdf: pd.DataFrame) -> pd.DataFrame:
    """Spans covered by the maximal repeats of one shard's regions."""
    docs, copies, starts = (pdf[c].to_numpy() for c in ("doc_id", "copy", "start"))
    part, place, common, left = suffixes(list(pdf["bytes"]), docs, LENGTH, pdf["parts"].to_numpy(), pdf["part"].to_numpy())
    doc = docs[part]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for depth, first, last in maximal_repeats(common, left):
        group = np.arange(first, last + 1)
        later = group[doc[first:last + 1] > doc[first:last + 1].min()]
        if len(later):
            found.append((later, np.full(len(later), depth)))
    if not found:
        return pd.DataFrame({"doc_id": np.empty(0, np.int64), "copy": np.empty(0, np.int32), "start": np.empty(0, np.int64), "stop": np.empty(0, np.int64)})
    rows, depth = (np.concatenate(x) for x in zip(*found, strict=True))
    begin = starts[part[rows]] + place[rows]
    d, c, s, e = _merged(doc[rows], copies[part[rows]].astype(np.int64), begin, begin + depth)
    release()
    return pd.DataFrame({"doc_id": d, "copy": c.astype(np.int32), "start": s, "stop": e})


def _base(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, text, rest): rows that share an id are numbered; rest
    holds the other columns. Every later step reads this one exchange."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    w = Window.partitionBy("doc_id").orderBy("text")
    return (docs.where("doc_id IS NOT NULL")
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                    F.struct(*others).alias("rest") if others else F.lit(0).alias("rest"))
            .select("doc_id", F.row_number().over(w).alias("copy"), "text", "rest"))


def spans(docs: DataFrame) -> DataFrame:
    """Rows of ``_base`` with items (spans of equal regions; requests have an
    anchor) and scanned (spans of the maximal repeats)."""
    ship(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(BUCKETS, max(8, size // BUCKET_BYTES)))
    base = _base(docs)
    found = base.mapInArrow(releasing(_find_anchors(buckets)), "bucket int, blob binary, doc_id long, copy int, start long, stop long")
    together = SHARD_REGIONS
    equal = found.groupBy("bucket").applyInPandas(lambda pdf: _match_regions(pdf, together), _SPANS)
    items = equal.groupBy("doc_id").agg(F.collect_list(F.struct("copy", "anchor", "parts", "start", "stop")).alias("items"))
    asked = items.where(F.exists("items", lambda x: x["anchor"].isNotNull()))
    cut = (asked.join(base, "doc_id").select("doc_id", "copy", "text", "rest", "items")
           .mapInArrow(releasing(_cut_bytes), "anchor long, parts int, part int, doc_id long, copy int, start long, bytes binary"))
    scanned = (cut.withColumn("shard", F.pmod(F.xxhash64("anchor", "part"), F.lit(buckets)))
               .groupBy("shard").applyInPandas(_scan, "doc_id long, copy int, start long, stop long")
               .groupBy("doc_id").agg(F.collect_list(F.struct("copy", "start", "stop")).alias("scanned")))
    return base.join(items, "doc_id", "left").join(scanned, "doc_id", "left")


def _row_spans(copy: int, items: list | None, scanned: list | None) -> list[tuple[int, int]]:
    """Disjoint spans of one row, in order."""
    every = sorted((x["start"], x["stop"]) for found in (items, scanned) for x in found or []
                   if x["copy"] == copy and x.get("anchor") is None)
    out: list[tuple[int, int]] = []
    for a, b in every:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _kept(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for span in removed for x in span], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _whole_characters(data: bytes, removed: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans narrowed to whole UTF-8 characters."""
    inner = lambda i: i < len(data) and data[i] & 0xC0 == 0x80
    out = []
    for a, b in removed:
        while a < b and inner(a):
            a += 1
        while b > a and inner(b):
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _columns(batch: pa.RecordBatch):
    return zip(*[batch.column(c).to_pylist() for c in ("copy", "text", "items", "scanned")], strict=True)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (the spans)."""
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "removed array<struct<start: long, stop: long>>")
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for copy, text, items, scanned in _columns(batch):
                data, removed = text.encode(), _row_spans(copy, items, scanned)
                for column, value in zip(out, (
                        len(data), sum(b - a for a, b in removed), len(removed), hashlib.sha256(_kept(data, removed)).hexdigest(),
                        [{"start": a, "stop": b} for a, b in removed]), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string()), pa.array(out[4], span)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    text = F.coalesce("text", F.lit(""))
    zero = F.lit(0).cast("long")
    without_id = docs.where("doc_id IS NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"),
        F.array().cast("array<struct<start: long, stop: long>>").alias("removed"))
    return spans(docs).mapInArrow(releasing(run), schema).unionByName(without_id)


def cut(docs: DataFrame) -> DataFrame:
    """The documents without the removed bytes, all columns kept; a character
    that a span covers only in part stays. n_chars, if there, counts the new
    text. A null text stays null."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for copy, text, items, scanned in _columns(batch):
                data = text.encode()
                texts.append(_kept(data, _whole_characters(data, _row_spans(copy, items, scanned))).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("rest")],
                                             ["doc_id", "text", "rest"])

    nulls = docs.where("text IS NULL OR doc_id IS NULL")
    texts = docs.where("text IS NOT NULL")
    found = spans(texts)
    rest = found.schema["rest"].dataType.simpleString()
    names = {c: F.col("rest").getField(c) for c in others}
    if "n_chars" in names:
        names["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    done = found.mapInArrow(releasing(run), f"doc_id long, text string, rest {rest}")
    return done.select(*[(names[c] if c in names else F.col(c).cast(docs.schema[c].dataType)).alias(c) for c in docs.columns]
                       ).unionByName(nulls)


def op10_repeats(spark, sf_dir):
    """What every document keeps once earlier documents' passages are gone."""
    return report(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
