"""Small documents with every awkward case, and brute-force versions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies int, bucket int, d string"
WORDS = "the quick brown fox jumps over the lazy dog while many small birds sing in old green trees near a river".split()


def prose(seed: int, words: int) -> str:
    x, out = seed * 2654435761 % 2**32, []
    for _ in range(words):
        x = (x * 1664525 + 1013904223) % 2**32
        out.append(WORDS[(x >> 16) % len(WORDS)] + str((x >> 8) % 97))
    return " ".join(out)


def awkward() -> list[tuple]:
    base = prose(1, 120)
    texts = [
        (0, base), (1, base), (2, base + " tail"), (3, None), (4, ""), (5, " \t\n"), (6, "one two"), (7, "ONE two"),
        (8, prose(2, 60) + "\n" + prose(3, 40)), (9, prose(4, 30) + " " + prose(3, 40)), (10, "123 456 --- !!!"),
        (11, prose(5, 9000)), (12, "x" * 3000), (13, "x" * 3000 + "y"), (14, "é" * 80 + prose(6, 30)),
        (15, "é" * 80 + prose(7, 30)), (16, prose(8, 50)), (16, prose(8, 50)), (16, prose(9, 50)), (None, prose(8, 50)),
        (None, None), (17, "Released under the MIT License.\n" + prose(10, 20)), (18, prose(1, 118) + " other end"),
    ]
    return [(i, t, ("en", "fr", None)[k % 3], ("a", "b", None, "ß")[k % 4] if k % 5 else "a", None if t is None else len(t), k, k, k, "x")
            for k, (i, t) in enumerate(texts)]


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def shingles(text: str | None, width: int) -> list[bytes]:
    w = [x.lower() for x in words(text)]  # bytes.lower knows A-Z only
    return [b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def repeats(rows: list[tuple[int, str | None]], length: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    first: dict[bytes, int] = {}
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1) if i is not None else ():
            s = data[p:p + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1) if i is not None else ():
            if first[data[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for p, g in enumerate(gone) if g and not (p and gone[p - 1]))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def jaccard_classes(rows: list[tuple[int, str]], threshold: float) -> dict[int, int]:
    sets = {i: frozenset(shingles(t, 5)) for i, t in rows}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    groups = Groups()
    empty = [i for i, s in sets.items() if not s]
    for i in empty:
        groups.join(i, min(empty))
    for i, s in sets.items():
        groups.find(i)
        for j in {j for x in s for j in holders[x]}:
            common = len(s & sets[j])
            if common >= threshold * (len(s) + len(sets[j]) - common):
                groups.join(i, j)
    return {i: groups.find(i) for i in sets}


def licences(files: list[tuple], templates, needs_all, threshold: float) -> list[tuple]:
    """(key, licence, score) by scoring every unit of every file."""
    def terms(text):
        return set(re.findall(r"[a-z0-9]+(?:[.][0-9]+)*", text.lower()))

    def statements(text):
        return re.sub(r"([^ \n][.!?]) +([A-Z])", r"\1\n\2", text).split("\n")

    have = [terms(t or "") for _, t in files]
    log = lambda n: math.log((1 + len(files)) / (1 + n)) + 1
    vectors = [(name, terms(t), needs_all(t)) for name, t in templates]
    idf = {t: log(sum(t in h for h in have)) for _, v, _ in vectors for t in v}
    out = []
    for key, text in files:
        best = []
        paragraphs = re.split(r"\n(?:[^A-Za-z0-9\n]*\n)+", text or "")
        joined = [s for p in paragraphs for s in statements(re.sub(r"\n[^A-Za-z0-9\n]*", " ", p))]
        for unit in {*statements(text or ""), *paragraphs, *joined}:
            mine = terms(unit)
            square = sum(idf.get(t, log(0)) ** 2 for t in mine)
            for name, v, whole in vectors:
                dot = sum(idf[t] ** 2 for t in mine & v)
                score = dot and round(dot / math.sqrt(square * sum(idf[t] ** 2 for t in v)), 6)
                if score >= threshold and (not whole or v <= mine):
                    best.append((-score, name))
        if best:
            out.append((key, min(best)[1], -min(best)[0]))
    return sorted(out)


def languages(learned: list[tuple[str, str]], texts: list, smoothing: float = 0.5) -> list[tuple[str, float]]:
    """(language, posterior) of each text, scored word by word from plain counts
    over all (text, lang) rows; for vocabularies that no limit cuts."""
    def words(text):
        return re.findall(r"[^\W\d_]+", text.lower())

    def grams(word, n):
        marked = f"<{word}>"
        return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)

    langs = sorted({lang for _, lang in learned})
    counts = {lang: [Counter() for _ in range(6)] for lang in langs}  # 0: words, n: n-grams
    for text, lang in learned:
        counts[lang][0].update(words(text))
    for lang in langs:
        for word, times in counts[lang][0].items():
            for n in range(1, 6):
                for g in grams(word, n):
                    counts[lang][n][g] += times
    kinds = [set().union(*(counts[lang][n] for lang in langs)) for n in range(6)]
    totals = {lang: [sum(c.values()) for c in counts[lang]] for lang in langs}

    def log(lang, n, item):
        return math.log((counts[lang][n][item] + smoothing) / (totals[lang][n] + smoothing * len(kinds[n])))

    def word_score(word):
        if word in kinds[0]:
            return [log(lang, 0, word) for lang in langs]
        for n in range(5, 0, -1):
            known = [g for g in grams(word, n) if g in kinds[n]]
            if known:
                return [sum(log(lang, n, g) for g in known) / len(known) for lang in langs]
        return [0.0] * len(langs)

    share = [math.log(sum(x == lang for _, x in learned) / len(learned)) for lang in langs]
    cache: dict[str, list[float]] = {}
    out = []
    for text in texts:
        found = [w for w in words(text or "") if any(map(str.isalpha, w))]
        if not found:
            out.append(("und", 0.0))
            continue
        total = list(share)
        for w in found:
            if w not in cache:
                cache[w] = word_score(w)
            total = [a + b for a, b in zip(total, cache[w], strict=True)]
        best = max(total)
        out.append((langs[total.index(best)], 1 / sum(math.exp(t - best) for t in total)))
    return out
