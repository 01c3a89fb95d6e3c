"""The operators against brute force, on awkward rows and on whole small
tables; nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import textwrap

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import SF001
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers as H  # noqa: E402

from clickweave.llm import (  # noqa: E402
    common, language, licences, minhash, mixing, neighbours, packing, repeats, sharding, simhash, url_filter)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(H.awkward(), H.SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], H.SCHEMA)


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


# -- 1 ------------------------------------------------------------------------
def slow_fingerprint(text):
    import xxhash

    h = [xxhash.xxh64_intdigest(s, 42) for s in H.shingles(text, 4)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def test_simhash_fingerprints_and_components(docs):
    found = rows_of(simhash.near_duplicates(docs), "doc_id", "fp", "component_id")
    texts = H.awkward()
    want = ordered([(r[0], slow_fingerprint(r[1])) for r in texts])
    assert ordered([(i, fp % 2**64) for i, fp, _ in found]) == want
    nodes = sorted({fp for _, fp in want})
    groups = H.Groups()
    for a in nodes:
        for b in nodes:
            if (a ^ b).bit_count() <= 4:
                groups.join(a, b)
    low = {}
    for i, fp in want:
        if i is not None:
            low[groups.find(fp)] = min(i, low.get(groups.find(fp), i))
    assert all(c == low.get(groups.find(fp % 2**64)) for _, fp, c in found)


def test_simhash_links_are_complete_over_many_shards(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 700, dtype=np.uint64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) for x in base[:300] for _ in range(3)]
    values = sorted({int(x) for x in base} | set(near) | {0, 1, 2**64 - 1})
    monkeypatch.setattr(simhash, "LEAF", 16)
    monkeypatch.setattr(simhash, "SHARD_ROWS", 64)  # chunks meet pairwise
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    edges = [(a % 2**64, b % 2**64) for a, b in rows_of(simhash.link(df), "a", "b")]
    assert all((a ^ b).bit_count() <= 64 for a, b in edges)
    got, want = H.Groups(), H.Groups()
    for v in values:
        got.find(v), want.find(v)
    for a, b in edges:
        got.join(a, b)
    array = np.array(values, dtype=np.uint64)
    for v in values:
        for w in array[np.bitwise_count(array ^ np.uint64(v)) <= 4]:
            want.join(v, int(w))
    assert {v: got.find(v) for v in values} == {v: want.find(v) for v in values}


def test_vantage_tree_routes_every_close_pair_to_a_common_leaf():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 16, 600, dtype=np.uint64)
    tree = simhash.Tree(values[:300], 5, 3)
    rows, leaf, home = tree.route(values, 1)
    assert tree.leaves > 8 and home.sum() == len(values)
    at = {}
    for r, f, h in zip(rows, leaf, home, strict=True):
        at.setdefault(int(f), []).append((int(r), bool(h)))
    met = {frozenset((a, b)) for group in at.values() for a, x in group for b, y in group if a < b and (x or y)}
    for a in range(len(values)):
        for b in np.flatnonzero(np.bitwise_count(values ^ values[a]) <= 1):
            assert a >= b or frozenset((a, int(b))) in met


def test_keep_one_keeps_one_of_each_group(docs):
    kept = rows_of(simhash.keep_one(docs), "doc_id", "text", "d")
    groups = {r[0] for r in rows_of(simhash.near_duplicates(docs), "root")}
    assert len(kept) == len(groups)
    assert (0, H.awkward()[0][1], "x") in kept and not any(i == 1 for i, _, _ in kept)


# -- 2 ------------------------------------------------------------------------
def test_minhash_of_edited_texts(docs):
    usable = sorted(((r[0], r[1] or "") for r in H.awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = {}
    for r in minhash.compare_edited(docs).collect():
        got.setdefault((r.doc_id, r.edited_sha256), []).append(r)
    assert sum(map(len, got.values())) == len(usable)
    for (i, text), (_, after) in zip(usable, usable[1:] + usable[:1], strict=True):
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        r = got[i, hashlib.sha256(edited.encode()).hexdigest()].pop()
        a, b = set(H.shingles(text, 5)), set(H.shingles(edited, 5))
        true = len(a & b) / len(a | b) if a | b else 1.0
        assert r.n_chars == len(text) and abs(r.near_edited - true) < 0.25 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)


def test_minhash_slices_do_not_matter(spark, docs):
    one = ordered(rows_of(minhash.compare_edited(docs), "doc_id", "edited_sha256", "near_next"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert ordered(rows_of(minhash.compare_edited(docs), "doc_id", "edited_sha256", "near_next")) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_minhash_query_against_single_texts(spark):
    """The registered query over a whole table: every text, its edited form and
    its successor, hashed one by one."""
    from clickweave.llm import queries

    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())
    p = minhash.Permutations()
    one = lambda text: p.signatures([text.encode()])[0]
    got = {r.doc_id: r for r in queries.QUERIES["op2_minhash"](spark, SF001).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        a, b, c = one(text), one(edited), one(after)
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (minhash.written(a), minhash.written(b))
        assert (r.near_edited, r.near_next) == (minhash.likeness(a, b), minhash.likeness(a, c))


def test_fingerprints_of_an_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == simhash.keep_one(empty).count() == 0
    assert minhash.compare_edited(empty).count() == minhash.near_duplicates(empty).count() == 0


def test_minhash_estimates_without_bias():
    p = minhash.Permutations()
    off = []
    for k in range(60):
        a, b = H.prose(k, 150), H.prose(k, 100) + " " + H.prose(k + 1000, 50)
        x, y = set(H.shingles(a, 5)), set(H.shingles(b, 5))
        s, t = p.signatures([a.encode(), b.encode()])
        off.append(minhash.likeness(s, t) - len(x & y) / len(x | y))
    assert abs(np.mean(off)) < 0.03 and np.abs(off).max() < 0.2
    assert (p.signatures([b"One  two\n"])[0] == p.signatures([b"one two"])[0]).all()


def test_minhash_near_duplicates_by_exact_jaccard(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    found = minhash.near_duplicates(spark.read.parquet(f"{SF001}/documents.parquet"))
    want = H.jaccard_classes(rows, 0.8)
    assert dict(rows_of(found, "doc_id", "class_id")) == want


# -- 3 ------------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    found = language.identify(table).withColumn("out", language.held_out())
    held = found.where("out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.95
    assert found.where("score < 0 OR score > 1").count() == 0


def test_language_equals_a_plain_scorer(spark):
    """The registered query over a whole table against counts in dictionaries."""
    import zlib

    from clickweave.llm import queries

    rows = {r.doc_id: (r.text, r.lang) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in rows}
    learned = [rows[i] for i in rows if not out[i] and None not in rows[i]]
    want = dict(zip(rows, H.languages(learned, [t for t, _ in rows.values()]), strict=True))
    got = {r.doc_id: r for r in queries.QUERIES["op3_language"](spark, SF001).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert (r.held_out, r.lang_pred) == (out[i], want[i][0]) and abs(r.score - want[i][1]) < 1e-3


def test_language_awkward_rows(docs, empty):
    found = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    for (_, text), (lang, score) in found.items():
        none = text is None or not any(map(str.isalpha, text))
        assert (lang == "und") == none and (score == 0.0) == none and lang in ("en", "fr", "und")
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns
    assert kept.where("text IS NULL OR text = '123 456 --- !!!' OR trim(text) = ''").count() == 0
    assert language.identify(empty).count() == 0
    assert {r.lang_pred for r in language.identify(docs, train=empty).collect()} == {"und"}


def test_language_backs_off_to_shorter_grams():
    log = lambda *p: np.log(np.array(p))
    grams = {n: ({}, np.zeros((0, 2))) for n in language.ORDERS}
    grams[3] = ({"cde": 0}, log(0.9, 0.1)[None])
    grams[1] = ({"z": 0}, log(0.2, 0.8)[None])
    s = language.Scorer({"langs": ["a", "b"], "prior": log(0.5, 0.5), "words": ({"known": 0}, log(0.1, 0.9)[None]), "grams": grams})
    assert s.predict("known")[0] == "b" and s.predict("abcdef")[0] == "a" and s.predict("zz")[0] == "b"
    assert s.predict("qq") == ("a", 0.5)  # nothing known: the first of equals


def test_language_learns_every_language_and_long_words(spark):
    """300 languages of one word each, and words of 60 letters or more."""
    letters = "abcdefghijklmnopqrst"
    name = lambda i: letters[i % 20] + letters[i // 20 % 20] + letters[i // 400]
    word = lambda i: name(i) * (25 if i % 3 else 2)
    rows = [(10 * i + j, f"{word(i)} {word(i)}", f"lang{i:03d}") for i in range(300) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model["langs"]) == 300 and max(map(len, model["words"][0])) <= language.SPELT_OUT
    found = language.identify(docs.drop("lang"), train=docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() == len(rows)


def test_language_keeps_counts_below_the_cut(spark, monkeypatch):
    """A word that one language names is counted in the other as well, though
    it is below the cut there; long texts are scored in parts."""
    monkeypatch.setattr(language, "WORDS", 2)
    monkeypatch.setattr(language, "PART", 3)
    rows = [(1, "the the the die", "en"), (2, "die die die die the", "de")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    row, scores = model["words"]
    assert sorted(row) == ["die", "the"]
    want = {"the": [1, 3], "die": [4, 1]}  # of 5 (de) and 4 (en) words
    for w, counts in want.items():
        assert np.allclose(scores[row[w]], [math.log((n + 0.5) / (all_ + 1)) for n, all_ in zip(counts, (5, 4), strict=True)], atol=1e-5)
    s = language.Scorer(model)
    assert s.predict("die " * 40)[0] == "de" and s.predict("the " * 40)[0] == "en"


# -- 4 ------------------------------------------------------------------------
def test_licences_are_scored_and_inherited(spark):
    filler = H.prose(3, 40)
    files = [
        (1, "app/LICENSE", "Licensed under the Apache License, Version 2.0."),
        (2, "app/src/main.c", filler), (3, "app/vendor/COPYING", "Released under the MIT License.\n" + filler),
        (4, "app/vendor/lib/x.c", filler), (5, "other/y.c", filler), (6, None, None), (7, "app/src/own.c",
         filler + "\nThis work is licensed under the GNU General Public License, version 3.\n" + filler),
        (8, "apple/z.c", filler), (9, "app/src/main.c", filler), (2, "app/src/main.c", filler), (10, "root.c", ""),
        (11, "app/vendor/NOTICE.md", "Licensed under CC BY-NC 4.0, more or less."),
    ]
    df = spark.createDataFrame([(*f, "x") for f in files], "doc_id long, path string, text string, key string")
    got = {(r.doc_id): (r.licence, r.how, r.from_dir) for r in licences.scan(df).collect()}
    assert licences.scan(df).count() == len(files)
    assert got[1] == ("Apache-2.0", "own", None) and got[2] == ("Apache-2.0", "inherited", "app")
    assert got[4] == ("MIT", "inherited", "app/vendor") and got[7] == ("GPL-3.0", "own", None)
    assert got[5] == got[6] == got[8] == got[10] == (None, "none", None)
    assert licences.scan(df.limit(0)).count() == 0


def test_licences_of_repeated_rows_score_as_one(spark):
    files = [(1, "a/LICENSE", "MIT License"), (1, "a/LICENSE", "MIT License"), (2, "a/x.c", "int x;")] + [
        (3, "b/LICENSE", "Released under the MIT License.")] * 3
    files += [(i, f"c/{i}.c", H.prose(i, 20)) for i in range(10, 40)]
    rows = licences.scan(spark.createDataFrame(files, "doc_id long, path string, text string"), licences.NOTICES).collect()
    got = {r.doc_id: (r.licence, r.own_score) for r in rows}
    assert len(rows) == len(files)
    assert got[1] == got[2] == (None, None) and got[3] == ("MIT", 1.0)


def test_licence_files_headers_and_spdx_lines_are_found(spark):
    passages, titles = dict(licences.PASSAGES), dict(licences.TITLES)

    def wrapped(text, mark, width=60):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    mit = "MIT License\n\nCopyright (c) 2024 A. Person\n\n" + wrapped(passages["MIT"], "") + "\n\n" + H.prose(1, 60)
    files = {
        "mit/LICENSE": (mit, "MIT"), "mit/x.c": (H.prose(2, 30), "MIT"),
        "mit2/LICENSE": (wrapped(passages["MIT"], "") + "\n\nThe above copyright notice", "MIT"),
        "apache/LICENSE": ("   Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\n" + H.prose(3, 90), "Apache-2.0"),
        "gpl/COPYING": (titles["GPL-3.0"].replace(" Version", "\n   Version") + "\n\n" + H.prose(4, 40), "GPL-3.0"),
        "src/gpl.c": ("/*\n * This file is part of X.\n *\n" + wrapped(passages["GPL-3.0"], " * ") + "\n *\n */\nint x;", "GPL-3.0"),
        "src/gpl2.py": ("# X, a tool\n#\n" + wrapped(passages["GPL-2.0"], "# ", 45) + "\n\nimport os", "GPL-2.0"),
        "src/lesser.c": (wrapped(passages["LGPL-3.0"], "// "), "LGPL-3.0"),
        "src/mpl.js": (wrapped(passages["MPL-2.0"], "// ", 70) + "\nlet x", "MPL-2.0"),
        "src/a.go": ("// SPDX-License-Identifier: MIT\npackage a", "MIT"),
        "src/b.go": ("// SPDX-License-Identifier: Apache-2.0\npackage b", "Apache-2.0"),
        "src/c.go": ("// SPDX-License-Identifier: AGPL-3.0-or-later\npackage c", "AGPL-3.0"),
        "src/d.go": ("// SPDX-License-Identifier: CC-BY-NC-4.0", "CC-BY-NC-4.0"),
        "src/e.go": ("// SPDX-License-Identifier: ISC\npackage e", None),
        "src/f.txt": ("We talked about a licence of the free press, version 3 of it, and software.", None),
        "src/de.txt": ("Wir gehen\nmit\ndem Hund.", None), "src/g.txt": (H.prose(5, 400), None), "src/h.txt": (None, None), "src/i.txt": ("\n\n \n", None),
        # a wrapped notice in the middle of a paragraph
        "src/j.txt": (H.prose(6, 20) + ". Licensed under\nthe Apache License,\nVersion 2.0. " + "Then " + H.prose(7, 20), "Apache-2.0"),
    }
    plain = [(100 + i, f"other/{i}.c", H.prose(i, 25)) for i in range(60)]
    rows = [(i, p, t) for i, (p, (t, _)) in enumerate(files.items())] + plain
    got = {r.path: r.licence for r in licences.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {p: got[p] for p in files} == {p: want for p, (_, want) in files.items()}
    assert not any(got[p] for _, p, _ in plain)


def test_files_far_from_all_templates_lose_nothing(spark):
    """The tests before the cut into units keep every file that scores."""
    table = spark.read.parquet(f"{SF001}/documents.parquet").select(F.col("doc_id").alias("key"), "text")
    texts = [(10**6 + i, t[: len(t) * 3 // 4]) for i, (_, t) in enumerate(licences.TEMPLATES)]
    files = table.unionByName(spark.createDataFrame(texts, "key long, text string"))
    got = sorted(map(tuple, licences.own_licences(files).collect()))
    slow = H.licences([tuple(r) for r in files.collect()], licences.TEMPLATES, licences.needs_all, 0.7)
    assert [g[:2] for g in got] == [w[:2] for w in slow] and len(got) > 20
    assert all(abs(g[2] - w[2]) < 2e-6 for g, w in zip(got, slow, strict=True))


# -- 5 ------------------------------------------------------------------------
def test_url_filter_is_as_of_the_fetch(spark):
    entries = spark.createDataFrame([
        ("Bad.com", "2024-02-01", "block"), ("bad.com", "2024-04-01", "allow"), ("good.bad.com", "2024-02-10", "allow"),
        ("x.org/a", "2024-01-01", "block"), ("x.org/a/b", "2024-01-01", "allow"), (None, "2024-01-01", "block"),
        ("bad.com", "2024-04-01", "allow"), ("t.net", "2024-03-01", "allow"), ("t.net", "2024-03-01", "block")],
        "pattern string, listed_on string, action string").withColumn("listed_on", F.col("listed_on").cast("date"))
    captures = [
        (1, "http://bad.com/", "2024-01-31", True), (2, "http://bad.com/", "2024-02-01", False), (3, "https://sub.BAD.com:80/x?y", "2024-03-31", False),
        (4, "http://bad.com/", "2024-04-01", True), (5, "http://good.bad.com/", "2024-03-01", True), (6, "http://notbad.com/", "2024-03-01", True),
        (7, "http://x.org/a", "2024-03-01", False), (8, "http://x.org/a/b/c", "2024-03-01", True), (9, "http://x.org/ab", "2024-03-01", True),
        (10, None, "2024-03-01", True), (11, "no url", "2024-03-01", True), (12, "http://bad.com/", None, True), (13, "http://t.net", "2024-03-01", False),
        (2, "http://bad.com/", "2024-02-01", False)]
    df = spark.createDataFrame([(*c, 1) for c in captures], "page_id long, url string, fetched_on string, want boolean, key int"
                               ).withColumn("fetched_on", F.col("fetched_on").cast("date"))
    got = ordered(rows_of(url_filter.judge(df, entries), "page_id", "kept"))
    assert got == ordered([(c[0], c[3]) for c in captures])
    assert url_filter.judge(df.limit(0), entries).count() == 0
    assert url_filter.judge(df, entries.limit(0)).where("NOT kept").count() == 0


# -- 6 ------------------------------------------------------------------------
def test_packing_round_trip(docs, empty):
    import zlib

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    t.encode_special_tokens = True
    packed = packing.pack(docs, with_ids=True).collect()
    by_text = {}
    for r in packed:
        assert r.length == len(r.ids) <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        by_text.setdefault(r.doc_id, []).append(r)
    for i in {r[0] for r in H.awkward()}:
        want = []
        for r in H.awkward():
            if r[0] == i:
                ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]
                n = -(-len(ids) // 1024)
                starts = [0, *range(len(ids) - (n - 1) * 1024, len(ids), 1024)][:n]
                want += [(p, s, tuple(ids[s:e])) for p, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True))]
        assert sorted((r.piece, r.start, tuple(r.ids)) for r in by_text[i]) == sorted(want)
    bins = {}
    for r in packed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack(empty).count() == 0


def test_splitter_equals_the_tokenizer():
    import random

    s = packing.splitter(packing.vocabulary_path())
    r = random.Random(3)
    alphabet = "ab's tred' \n\n\t  'll've1 2é9ß!?.,<|endoftext|>— 中x ​\x1c"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts += ["", "'", "  ", "a  ", "'s's", " 's", "don't''re'll x", "word " * 300_000, "x" * 50_000]
    for text, ids in zip(texts, s.encode(texts), strict=True):
        assert ids.tolist() == s.tokenizer.encode(text, add_special_tokens=False).ids, text[:80]


def test_splitter_keeps_added_tokens():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "a <|endoftext| > b", "no token", "<|endoftext|>" + "word " * 100_000]
    got = [ids.tolist() for ids in packing.splitter(packing.vocabulary_path()).encode(texts)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert got[0] == [64, 220, 50256, 275]


def test_best_two_fit_uses_all_and_wastes_little():
    r = np.random.default_rng(2)
    counts = np.zeros(1025, dtype=np.int64)
    for x in r.integers(1, 1025, 5000):
        counts[x] += 1
    bins = packing.best_two_fit(counts)
    used = np.zeros_like(counts)
    for lengths, times in bins:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] += times
    assert (used == counts).all()
    assert sum(t for _, t in bins) <= 1.02 * (counts * np.arange(1025)).sum() / 1024
    # the smallest (3) is replaced by two (2 + 4) that fill the bin of 10
    c = np.zeros(11, dtype=np.int64)
    c[[4, 3, 2]] = [2, 1, 1]
    assert packing.best_two_fit(c, 10)[0][0] in ([4, 4, 2], [4, 3, 2])


# -- 7 ------------------------------------------------------------------------
def test_shards_by_rows(docs, empty):
    found = sharding.shard(docs).collect()
    counts = [0] * 24
    for r in found:
        counts[r.shard] += 1
    assert len(found) == len(H.awkward()) and max(counts) - min(counts) <= 1
    for s in range(24):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    import zlib

    want = ordered([(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in H.awkward()])
    assert ordered([(r.doc_id, r.size, r.text_crc32) for r in found]) == want
    assert sharding.shard(empty).count() == 0


def test_hilbert_curve_visits_every_cell_once_and_steps_by_one():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = sharding.hilbert_index(grid, 3)
    assert sorted(index.tolist()) == list(range(512))
    path = grid[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_curve_prunes_shards_in_every_dimension(spark):
    table = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("").alias("text"), F.concat(F.lit("s"), F.col("id") * 7 % 40).alias("source"),
        (F.col("id") * 13 % 101).alias("lang"))
    ranges = sharding.manifest(sharding.shard(table, dims=("source", "lang")), ("source", "lang")).collect()
    hit = sum(r.min_source <= "s17" <= r.max_source and r.min_lang <= 50 <= r.max_lang for r in ranges)
    assert len(ranges) == 24 and hit <= 8


def test_curve_prunes_behind_a_common_prefix(spark):
    table = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("").alias("text"), (F.col("id") * 13 % 101).alias("lang"),
        F.concat(F.lit("https://common_crawl_"), F.lpad((F.col("id") * 7 % 40).cast("string"), 2, "0")).alias("source"))
    dims = ("source", "lang")
    plain = table.withColumn("source", F.substring("source", -2, 2))
    one, other = ({(r.shard, r.min_lang, r.max_lang, r.min_source[-2:], r.max_source[-2:])
                   for r in sharding.manifest(sharding.shard(t, dims=dims), dims).collect()} for t in (table, plain))
    assert one == other
    assert sum(low <= "17" <= high for _, _, _, low, high in one) <= 8


def test_string_bounds_are_the_weighted_quantiles(spark):
    r = np.random.default_rng(3)
    values = [None] * 50 + ["hot"] * 700 + [f"ß{x:03d}" for x in r.integers(0, 400, 900)] + ["z" * 5000, "😀", ""]
    held = sorted(v.encode() for v in values if v is not None)
    want = sorted({held[-(-i * len(held) // 64) - 1] for i in range(1, 64)})
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert sharding._string_bounds(df, "s", 64) == want
    assert sharding._string_bounds(df.where("s IS NULL"), "s", 64) == []
    cells = sharding._cells(pd.Series([None, "", "hot", "😀"]), want, 63)
    assert cells[0] == 0 and (np.diff(cells) > 0).all() and cells[-1] == 63
    assert sharding._cells(pd.Series([None, None], dtype=object), want, 63).tolist() == [0, 0]


def test_written_shards_keep_all_rows_and_columns(spark, docs, empty, scratch):
    for frame in (docs.withColumnsRenamed({"d": "shard", "bucket": "slot", "copies": "curve"}), docs, empty):
        path = f"{scratch}/{len(frame.columns)}-{frame.columns[-1]}-{frame.isEmpty()}"
        report = sharding.write_shards(frame, path, shards=5)
        if frame is empty:
            assert report.count() == 0
            continue
        back = spark.read.parquet(path)
        column, = set(back.columns) - set(frame.columns)
        assert column == ("shard_" if "shard" in frame.columns else "shard")
        names = frame.columns
        assert ordered(rows_of(back, *names)) == ordered(rows_of(frame, *names))
        sizes = {r.shard: r.rows for r in report.collect()}
        assert sizes == {r[0]: r[1] for r in back.groupBy(column).count().collect()}
        assert max(sizes.values()) - min(sizes.values()) <= 1


# -- 8 ------------------------------------------------------------------------
def brute_neighbours(vectors, queries, k):
    out = {}
    for q in queries:
        score = {i: math.fsum(a * b for a, b in zip(v, vectors[q], strict=True)) for i, v in vectors.items() if i != q}
        out[q] = sorted(score, key=lambda i: (-score[i], i))[:k]
    return out


def test_neighbours_recall_and_ties(spark):
    r = np.random.default_rng(9)
    centre = r.standard_normal((30, 24))
    data = {i: (centre[i % 30] + 0.3 * r.standard_normal(24)).astype(np.float32).tolist() for i in range(3000)}
    for i in range(0, 3000, 3):
        data[i] = data[0]  # a third of all rows share a vector
    rows = [(i, v) for i, v in data.items()] + [(3000, None), (3020, []), (3040, [0.0] * 24), (3060, [float("nan")] * 24), (3080, [None] * 24),
                                               (3100, [1.0]), (None, data[1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    found = {}
    for q, rank, i, s in rows_of(neighbours.nearest(df, F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score"):
        found.setdefault(q, {})[rank] = (i, s)
    want = brute_neighbours(data, [i for i in data if i % 20 == 0], 20)
    assert set(found) == set(want)
    hits = sum(len({i for i, _ in found[q].values()} & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [found[0][n][0] for n in range(1, 21)] == list(range(3, 63, 3))  # ties to the smaller id
    assert all(sorted(x) == list(range(1, 21)) for x in found.values())


def test_neighbours_recall_with_many_cells(spark, monkeypatch):
    """The path of large tables: queries visit further cells."""
    monkeypatch.setattr(neighbours, "CELL", 64)
    table = spark.read.parquet(f"{SF001}/embeddings.parquet".replace("sf0.001", "sf0.01")).select("vec_id", "embedding")
    data = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in table.collect()}
    got: dict[int, set] = {}
    for q, i in rows_of(neighbours.nearest(table, F.col("vec_id") % 20 == 0), "query_id", "vec_id"):
        got.setdefault(q, set()).add(i)
    asked = [i for i in data if i % 20 == 0]
    assert len(data) > 4 * neighbours.CELL and set(got) == set(asked)
    ids = np.array(sorted(data))
    matrix = np.stack([data[i] for i in ids])
    hits = 0
    for q in asked:
        scores = np.where(ids == q, -np.inf, matrix @ data[q])
        hits += len(got[q] & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(asked)


def test_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 0.0]), (20, [0.5, 0.5])], "vec_id long, embedding array<float>")
    got = ordered(rows_of(neighbours.nearest(df, F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score"))
    assert got == [(0, 1, 1, 3.0), (0, 2, 20, 1.5), (20, 1, 0, 1.5), (20, 2, 1, 1.5)]
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_of_repeated_rows_and_ids(spark):
    r = np.random.default_rng(12)
    data = {i: r.integers(-9, 10, 6).astype(float).tolist() for i in range(200)}
    rows = list(data.items()) + [(0, data[0])] * 24 + [(7, data[7])] * 3
    several = [(20, r.integers(-9, 10, 6).astype(float).tolist()) for _ in range(25)]  # one id, 26 vectors
    df = spark.createDataFrame(rows + several, "vec_id long, embedding array<float>")
    found = {}
    for q, rank, i, s in rows_of(neighbours.nearest(df, F.col("vec_id").isin(0, 7, 40)), "query_id", "rank", "vec_id", "score"):
        found.setdefault(q, []).append((rank, i, s))
    entries = {(i, tuple(v)) for i, v in rows + several}
    for q in (0, 7, 40):
        score = sorted((-sum(a * b for a, b in zip(v, data[q], strict=True)), i) for i, v in entries if i != q)[:20]
        assert [(i, -s) for s, i in score] == [(i, s) for _, i, s in sorted(found[q])]
    own = rows_of(neighbours.nearest(df, F.col("vec_id") == 20), "query_id", "rank", "vec_id")
    assert len(own) == 26 * 20 and all(i != 20 for _, _, i in own)


def test_chi_square():
    assert abs(float(neighbours.chi_square(15.507, 8)) - 0.95) < 1e-4
    assert abs(neighbours.chi_square_bound(0.99) - 20.090) < 1e-2


# -- 9 ------------------------------------------------------------------------
def test_targets_by_repeated_resharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 300, "e": 0, None: 40}
    got = {r.source: (r.weight, r.target) for r in mixing.targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = ["a", "b", "c", "d", "e", None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped = dict.fromkeys(names, 0.0), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        over = [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * sizes[s]]
        if not over:
            break
        capped |= set(over)
    for s in names:
        target[s] = 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free)
        assert got[s][0] == weight[s] and abs(got[s][1] - target[s]) < 1e-6


def test_mix_meets_targets(docs, empty):
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert sum(r.n_rows for r in rows) == len(H.awkward())
    assert all(0 <= r.copies <= 3 for r in rows)
    table = docs.sparkSession.read.parquet(f"{SF001}/documents.parquet")
    per = (mixing.mix(table).groupBy("source").agg(F.max("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("taken"),
                                                  F.max("size").alias("m"))).collect()
    assert all(abs(r.t - r.taken) <= r.m for r in per)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies * r.n_rows for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.apply_mix(empty).count() == 0


def greedy_mix(rows, target, seed=mixing.SEED):
    """copies by doc_id of a source's distinct rows (doc_id, size)."""
    e = target / sum(size for _, size in rows)
    whole, p = int(e), e - int(e)
    order = []
    for i, size in rows:
        u = (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        order.append(((u / (1 - u)) / (p / (1 - p)), i, size))
    rest, out = target - whole * sum(size for _, size in rows), dict.fromkeys([i for i, _ in rows], whole)
    for _, i, size in sorted(order):
        if 0 < size <= rest:
            rest -= size
            out[i] += 1
    left = [(abs(rest - size), rank, i) for rank, i, size in order if size and out[i] == whole]
    if left and min(left)[0] < rest:
        out[min(left)[2]] += 1
    return out


def test_mix_passes_over_documents_that_do_not_fit(spark):
    """One document of 5,000 words among many short ones, a target of 2,000:
    the order goes on behind what does not fit."""
    r = np.random.default_rng(7)
    sizes = {f"a{s}": [5000, 0, 700, *r.integers(1, 20, 500)] for s in range(8)} | {"b": [1000] * 80}
    rows = {s: [(1000 * k + i, int(x)) for i, x in enumerate(v)] for k, (s, v) in enumerate(sizes.items())}
    df = spark.createDataFrame([(i, "w " * n, s) for s, v in rows.items() for i, n in v], "doc_id long, text string, source string")
    mixed = mixing.mix(df, weights=(1,) * 8 + (72,)).collect()
    for s, v in rows.items():
        mine = [x for x in mixed if x.source == s]
        target = mine[0].target
        assert {x.doc_id: x.copies for x in mine} == greedy_mix(v, target)
        assert s == "b" or abs(target - sum(x.size * x.copies for x in mine)) <= 0.005 * target


def test_mix_prefers_documents_by_weight(spark):
    df = spark.createDataFrame([(i, "w " * 10, "ab"[i % 2], float(1 + 8 * (i % 4 < 2))) for i in range(4000)], "doc_id long, text string, source string, w double")
    got = {r.w: r.c for r in mixing.mix(df.drop("w").join(df.select("doc_id", "w"), "doc_id"), weights=(1, 3), doc_weight="w")
           .join(df.select("doc_id", "w"), "doc_id").where("source = 'a'").groupBy("w").agg(F.avg("copies").alias("c")).collect()}
    assert got[9.0] > 3 * got[1.0]


# -- 10 -----------------------------------------------------------------------
def test_repeats_on_awkward_rows(docs, empty):
    got = ordered(rows_of(repeats.report(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert got == ordered(H.repeats([(r[0], r[1]) for r in H.awkward()]))
    assert repeats.report(empty).count() == 0


@pytest.mark.parametrize("together", [2_000, 5])
def test_repeats_on_edited_copies(spark, monkeypatch, together):
    """Many copies, each with its own edits: overlapping matches with several
    documents, shifted passages and periodic text; also with anchors whose
    regions are dealt to several parts."""
    monkeypatch.setattr(repeats, "SHARD_REGIONS", together)
    r = np.random.default_rng(4)
    base = H.prose(11, 60)
    rows = []
    for i in range(60):
        text = list(base)
        for p in r.integers(0, len(text), r.integers(0, 6)):
            text[p] = "#"
        a, b = sorted(r.integers(0, len(text), 2))
        rows.append((int(i * 7 % 60), "".join(text[a:b]) + "ab" * int(r.integers(0, 60)) + "".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ordered(rows_of(repeats.report(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert got == ordered(H.repeats(rows))


def test_maximal_repeats_have_all_occurrences():
    parts = [b"xxabcdefyy", b"zzabcdefww", b"qabcdeq", b"xxabcdefyy"]
    part, place, common_, left = repeats.suffixes(parts, np.arange(4), 4)
    found = {}
    for depth, first, last in repeats.maximal_repeats(common_, left, 4):
        text = parts[part[first]][place[first]:place[first] + depth]
        found[text] = {int(p) for p in part[first:last + 1]}
    assert found[b"abcde"] == {0, 1, 2, 3} and found[b"abcdef"] == {0, 1, 3} and found[b"xxabcdefyy"] == {0, 3}
    assert b"bcde" not in found and b"bcdef" not in found  # always after the same byte


def test_cut_keeps_whole_characters_and_columns(docs):
    out = repeats.cut(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("length(text) <> n_chars").count() == 0
    assert dict(rows_of(out.where("doc_id = 1"), "doc_id", "text"))[1] == ""
    text = dict(rows_of(out.where("doc_id = 15"), "doc_id", "text"))[15]
    assert text.encode().decode() == text and len(text) < len(dict((r[0], r[1]) for r in H.awkward())[15])


# -- helpers ------------------------------------------------------------------
def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1001), (1003, 1001), (5000, 5000)]
    got = dict(rows_of(common.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000, 1003: 1000}


def test_global_index(spark):
    df, n = common.global_index(spark.range(1000).withColumn("k", F.col("id") * 37 % 1000), ["k"])
    assert n == 1000 and df.where("index <> k").count() == 0
