"""Pack tokenised documents into sequences by best-two-fit.

Tokens: ids of a public byte-level BPE vocabulary (its file is a parameter),
then ``END``. A document longer than ``CAPACITY`` is cut into full pieces, the
first of which may be shorter.

Packing needs only the lengths, and there are ``CAPACITY`` of them at most:
Spark counts the pieces of each length, and the plan is made on that bounded
histogram. A bin starts with the longest length left and is filled greedily;
then, while it helps, its smallest document is replaced by the two unpacked
lengths that fill the widened gap most tightly. The bin is used as often as
the counts allow, so the plan's size depends on the capacity, not on the
corpus. Every piece then gets its number among the pieces of its length (in
``SALTS`` slices, so that a frequent length is spread) and looks up its place.

Tokenising: texts are cut into pre-tokens for a whole batch at once in numpy
(the vocabulary's published split pattern, as rules on character classes), and
each distinct pre-token is given to the tokenizer once and remembered, up to a
bound. Texts with characters outside ``_plain`` (where Unicode tables of
different versions could disagree), or that hold the content of one of the
vocabulary's added tokens, go to the tokenizer whole.

Defined results: null text is an empty one (a piece of one id, END); repeated
rows are packed once each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, prefix_sums, read_table, releasing, ship

CAPACITY = 1024
END = 2
SALTS = 128
VOCABULARY = "byte_bpe_50k.json"
CHUNK = 1 << 18          # code points that are split at once
REMEMBERED = 200_000     # pre-tokens a Python worker keeps
_OTHER, _LETTER, _NUMBER, _SPACE, _STRANGE = range(5)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _classes() -> np.ndarray:
    """Class of each code point; _STRANGE where the fast split isn't used."""
    table = np.full(0x110000, _STRANGE, dtype=np.uint8)
    plain = [*range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x370, 0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]
    for c in plain:
        kind = unicodedata.category(chr(c))
        if kind != "Cn":
            table[c] = {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = _SPACE
    return table


class Splitter:
    """Texts -> token ids, remembering pre-tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = _classes()
        odd = np.uint64(0x9E3779B97F4A7C15)
        inverse = np.uint64(pow(int(odd), -1, 1 << 64))
        self.power = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(2 * CHUNK, odd))))
        self.inverse = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(2 * CHUNK, inverse))))
        self.ids_of = self._single()
        self.forget()

    def _single(self):
        """ids of one pre-token: tiktoken over the tokenizer's own vocabulary
        (many times faster on single words) if both agree, else the tokenizer."""
        slow = lambda word: self.tokenizer.encode(word, add_special_tokens=False).ids
        import tiktoken

        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = set(self.added)
        ranks = {bytes(byte[c] for c in word): i for word, i in self.tokenizer.get_vocab().items() if word not in special}
        fast = tiktoken.Encoding("pretokens", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        trial = ["thattionble", " retitioning", "%%%", " êeaux", "\n\n", "'ll", " 2024", "naïveté", "----", " Überraschung", "  "]
        return fast if all(fast(w) == slow(w) for w in trial) else slow

    def forget(self) -> None:
        self.entry: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 20, dtype=np.uint32)
        self.first = np.zeros(1 << 18, dtype=np.int64)
        self.size = np.zeros(1 << 18, dtype=np.int64)
        self.used = 0
        self.entries = 0

    def remember(self, ids: list[int]) -> int:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        if self.entries == len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.first[self.entries], self.size[self.entries] = self.used, len(ids)
        self.used += len(ids)
        self.entries += 1
        return self.entries - 1

    def starts(self, codes: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Flags of the positions at which a pre-token starts; ``begins``: of
        the texts' first characters."""
        n = len(codes)
        space = kinds == _SPACE
        changed = np.ones(n, dtype=bool)
        changed[1:] = kinds[1:] != kinds[:-1]
        changed |= begins
        after_blank = np.zeros(n, dtype=bool)
        after_blank[1:] = codes[:-1] == 0x20
        after_blank &= ~begins
        # the last blank before a word stands alone or leads the word
        lead = np.zeros(n, dtype=bool)
        lead[:-1] = space[:-1] & ~space[1:] & ~begins[1:]
        out = np.where(space, changed | lead, changed & ~after_blank)
        quotes = np.flatnonzero((codes == 0x27) & out)
        if len(quotes):
            ends = np.append(np.flatnonzero(begins)[1:], n)
            end = ends[np.searchsorted(ends, quotes, side="right")]
            at = lambda k: np.where(quotes + k < end, codes[np.minimum(quotes + k, n - 1)], 0)
            a, b = at(1), at(2)
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            hit = one | two
            out[quotes[hit] + 1] = False
            nxt = quotes[hit] + np.where(one[hit], 2, 3)
            nxt = nxt[nxt < end[hit]]
            out[nxt[kinds[nxt] == _LETTER]] = True
        return out

    def _distinct(self, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One pre-token of each content, and for every one its number among
        these. A polynomial hash groups them; equal hashes are compared by
        their characters, and where they differ all are told apart by content."""
        total = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.power[:len(codes)], out=total[1:])
        h = (total[stop] - total[start]) * self.inverse[start]
        h ^= (stop - start).astype(np.uint64) << np.uint64(48)
        _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        like = at[inverse]
        sizes = stop - start
        same = len(codes) == 0 or (np.array_equal(sizes, sizes[like]) and np.array_equal(
            codes, codes[np.repeat(start[like] - start, sizes) + np.arange(len(codes))]))
        if not same:
            number: dict[bytes, int] = {}
            inverse = np.array([number.setdefault(codes[i:j].tobytes(), len(number))
                                for i, j in zip(start.tolist(), stop.tolist(), strict=True)])
            at = np.unique(inverse, return_index=True)[1]
        return at, inverse

    def _chunk(self, texts: list[str]) -> list[np.ndarray]:
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(lengths) - lengths
        begins = np.zeros(len(codes) + 1, dtype=bool)
        begins[first] = True
        begins = begins[:-1]
        kinds = self.classes[codes]
        flags = self.starts(codes, kinds, begins) if len(codes) else begins
        start = np.flatnonzero(flags)
        stop = np.append(start[1:], len(codes))
        at, inverse = self._distinct(codes, start, stop)
        if self.entries + len(at) > REMEMBERED:
            self.forget()
        found = np.zeros(len(at), dtype=np.int64)
        for k, (i, j) in enumerate(zip(start[at].tolist(), stop[at].tolist(), strict=True)):
            key = codes[i:j].tobytes()
            entry = self.entry.get(key, -1)
            if entry < 0:
                entry = self.entry[key] = self.remember(self.ids_of(key.decode("utf-32-le")))
            found[k] = entry
        rows = found[inverse]
        sizes = self.size[rows]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.first[rows] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        # ids of a text end where the next text's first pre-token starts
        bound = np.concatenate(([0], ends))[np.searchsorted(start, np.append(first, len(codes)))]
        out = [ids[bound[i]:bound[i + 1]] for i in range(len(texts))]
        for i in np.unique(np.searchsorted(first, np.flatnonzero(kinds == _STRANGE), side="right") - 1):
            out[i] = None
        return out

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """ids of each text, in order."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            if waiting and size + len(text) > CHUNK:
                yield from map(self._checked, waiting, self._chunk(waiting))
                waiting, size = [], 0
            if len(text) <= CHUNK:
                waiting.append(text)
                size += len(text)
            else:  # in parts, cut where a pre-token starts for certain
                done = [self._chunk([p])[0] if len(p) <= 2 * CHUNK else None for p in _parts(text)]
                yield self._checked(text, None if any(x is None for x in done) else np.concatenate(done))
        yield from map(self._checked, waiting, self._chunk(waiting))

    def _checked(self, text: str, ids: np.ndarray | None) -> np.ndarray:
        if ids is None or any(content in text for content in self.added):
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return ids


def _parts(text: str, size: int = CHUNK) -> Iterator[str]:
    cut = re.compile(r"[A-Za-z](?= [A-Za-z])")
    at = 0
    while len(text) - at > size:
        found = None
        for found in cut.finditer(text, at + size - 4096, at + size):
            pass
        if found is None:
            found = cut.search(text, at + size)
        if found is None or found.end() - at > 2 * size:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:]


_splitters: dict[str, Splitter] = {}


def splitter(path: str) -> Splitter:
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    vocabulary = path or vocabulary_path()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = splitter(vocabulary)
        for batch in batches:
            rows: list[int] = []
            out: list[list] = [[], [], [], []]
            kept: list[np.ndarray] = []
            for i, ids in enumerate(tokens.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                n = len(ids)
                count = -(-n // capacity)
                at = 0
                for piece in range(count):
                    stop = n - (count - 1 - piece) * capacity
                    rows.append(i)
                    for column, value in zip(out, (piece, at, stop - at, zlib.crc32(ids[at:stop].tobytes())), strict=True):
                        column.append(value)
                    if with_ids:
                        kept.append(ids[at:stop].astype(np.int32))
                    at = stop
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32()),
                       pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(releasing(run), schema)


def best_two_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """``counts[l]``: pieces of length l. Returns bins (lengths, how often)."""
    left = counts.astype(np.int64).copy()
    values = np.arange(capacity + 1)
    bins = []

    def below(free: np.ndarray) -> np.ndarray:
        """For each room the longest free length that fits (0: none)."""
        return np.maximum.accumulate(np.where(free > 0, values, 0))

    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        free, chosen, gap = left.copy(), [longest], capacity - longest
        free[longest] -= 1
        while gap:
            fits = int(below(free)[gap])
            if not fits:
                break
            take = min(int(free[fits]), gap // fits)
            chosen += [fits] * take
            free[fits] -= take
            gap -= fits * take
        while gap:
            small = min(chosen)
            room = gap + small
            if room < 2:
                break
            best = below(free)
            a = np.flatnonzero(free[:room] > 0)
            if not len(a):
                break
            b = best[room - a]
            # two of one length need two free documents
            twice = (b == a) & (free[a] < 2)
            if twice.any():
                single = free.copy()
                for i in np.flatnonzero(twice):
                    single[a[i]] = 0
                    b[i] = below(single)[room - a[i]]
                    single[a[i]] = free[a[i]]
            total = np.where(b > 0, a + b, 0)
            k = int(np.argmax(total))
            if total[k] <= small:
                break
            chosen.remove(small)
            free[small] += 1
            for x in (int(a[k]), int(b[k])):
                chosen.append(x)
                free[x] -= 1
            gap = room - int(total[k])
        lengths, need = np.unique(chosen, return_counts=True)
        times = int((left[lengths] // need).min())
        left[lengths] -= need * times
        bins.append((sorted(chosen, reverse=True), times))
    return bins


def places(bins: list[tuple[list[int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first number), the sequence of that number, and
    the offset: number i of a length goes to sequence + (i - first number)."""
    used: dict[int, int] = {}
    keys, sequence, offset, base = [], [], [], 0
    for lengths, times in bins:
        at = 0
        for length in lengths:
            keys.append((length << 44) + used.get(length, 0))
            sequence.append(base)
            offset.append(at)
            used[length] = used.get(length, 0) + times
            at += length
        base += times
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    return tuple(np.array(x, dtype=np.int64)[order] for x in (keys, sequence, offset))


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with a length."""
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    slices = checkpointed(salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")))
    histogram = slices.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in histogram:
        counts[r["length"]] = r["n"]
    keys, sequence, offset = places(best_two_fit(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        key = (length.to_numpy() << 44) + number.to_numpy()
        at = np.searchsorted(keys, key, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + (key - keys[at]), "offset": offset[at]})

    slices = prefix_sums(slices, ["length"], "_salt", "_n", "_before")
    w = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (salted.join(slices.select("length", "_salt", "_before"), ["length", "_salt"])
                .withColumn("_place", look_up("length", F.col("_before") + F.row_number().over(w) - 1)))
    return numbered.select(*found.columns, F.col("_place.sequence_id").alias("sequence_id"),
                           F.col("_place.offset").alias("offset"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END,
         with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    return place(checkpointed(pieces(docs, path, capacity, end, with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids of rows from ``pack(with_ids=True)``; a sequence holds
    ``capacity`` ids at most."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))


def op6_packing(spark, sf_dir):
    """All documents in sequences of at most 1024 tokens."""
    return pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
