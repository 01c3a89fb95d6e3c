"""Quality votes, fill-in-middle and the divergence audit against brute force,
and what this round mended: per-row copies, hashes, tokens."""

from __future__ import annotations

import hashlib
import os
import random
import re
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF01
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers as H  # noqa: E402

from clickweave.llm import divergence, infill, minhash, mixing, packing, quality  # noqa: E402
from clickweave.llm.common import read_table  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(H.awkward(), H.SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], H.SCHEMA)


def sql_on(rows, sql, path):
    """A query's SQL twin over hand-written documents."""
    import pandas as pd

    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in H.SCHEMA.split(", ")]).astype({"doc_id": "Int64"})
    con.register("frame", frame)
    con.execute("CREATE TABLE documents AS SELECT * FROM frame")
    cur = con.execute(sql)
    return [c[0] for c in cur.description], cur.fetchall()


def same(df, columns, rows):
    got = sorted(map(str, [tuple(r) for r in df.select(*columns).collect()]))
    assert got == sorted(map(str, rows))


# -- 11 -----------------------------------------------------------------------
def test_quality_on_held_out_labels(spark):
    rows = quality.op11_quality(spark, SF01).join(read_table(spark, SF01, "labels"), "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert len(good) > 40 and len(bad) > 5
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert all(r.predicted == 1 for r in rows if r.quality == 1)  # clean documents stay
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_votes_equal_a_naive_vote():
    r = np.random.default_rng(1)
    vectors = np.array([quality.directed(v) for v in r.standard_normal((300, quality.DIMS))])
    vectors[7] = vectors[8]  # ties vote together
    model = {"vectors": vectors, "labels": r.integers(0, 2, 300).astype(float), "mean": 0.5}
    block = np.array([quality.directed(v) for v in r.standard_normal((40, quality.DIMS))] + [np.zeros(quality.DIMS, np.float32), vectors[7]])
    got = quality.vote(block, model)
    for x, score in zip(block, got, strict=True):
        if not x.any():
            assert score == 0.5
            continue
        cosine = np.round(np.array([float((x * v).sum()) for v in vectors]), 5)
        near = [i for i in range(300) if cosine[i] >= sorted(cosine)[-quality.NEIGHBOURS] - 1e-9]
        w = ((1 + cosine[near]) / 2) ** quality.POWER
        want = (sum(w * model["labels"][near]) + quality.PRIOR * 0.5) / (sum(w) + quality.PRIOR)
        assert abs(score - want) < 2e-3
    assert np.array_equal(got[:5], np.concatenate([quality.vote(block[i:i + 1], model) for i in range(5)]))


def test_subspace_spans_the_leading_directions():
    r = np.random.default_rng(2)
    basis = r.standard_normal((4, 60))
    rows = [(np.arange(60), r.standard_normal(4) * [9, 5, 3, 2] @ basis) for _ in range(80)]
    space = quality.subspace(rows, dims=8)
    kept = space[:60].astype(np.float64)
    dense = np.array([w for _, w in rows])
    assert np.abs(dense - dense @ kept @ kept.T).max() < 1e-2 and np.abs(kept[:, 4:]).max() < 1e-6


def test_quality_of_awkward_rows(spark, docs, empty):
    ids = [r[0] for r in H.awkward() if r[0] is not None]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids] + [(1, 0, 0), (2, None, 0), (None, 1, 0), (3, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score(docs.withColumn("score", F.lit("x")), quality.fit(docs, labels))
    assert rows.columns == [*H.SCHEMA.replace(",", "").split()[::2], "score", "predicted"]
    got = rows.collect()
    assert len(got) == len(H.awkward()) and all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text, r.score) == r.score  # equal texts, equal scores
    assert by_text[None] == by_text[""] == by_text[" \t\n"]
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(empty, quality.fit(empty, labels)).count() == 0
    long = quality.Reader().read("Abc !! " * 200_000)  # several parts
    assert long[1].sum() == pytest.approx(400_000, abs=3)


def plain_reading(text):
    """Places, counts and style of a text, term by term; None where ``text`` has no term."""
    terms = re.findall(r"[^\W\d_]+|\d+|[^\w\s]+|_+", text or "")
    at, style = Counter(), np.zeros(quality.STYLES)
    for t in terms:
        letters, digits = t[0].isalpha(), t[0].isdigit()
        at[quality.place("0" * min(len(t), 8) if digits else t.lower())] += 1
        style[36 + min(len(t), 12) if letters else 3 if digits else 5 + zlib.crc32(t.encode()) % 32] += 1
        style[0] += len(t) > 1 and t.isupper()
    if not terms:
        return [], [], style
    style[1] = sum(a == b for a, b in zip(terms, terms[1:], strict=False))
    style /= len(terms)
    lines = text.split("\n")
    style[2] = 1 - len(set(lines)) / len(lines)
    style[4] = sum(c in " \t\n" for c in text) / len(text)
    return sorted(at), [at[x] for x in sorted(at)], quality.STYLE * np.sqrt(style)


def test_quality_reader_equals_a_plain_one(monkeypatch):
    r = random.Random(4)
    texts = [r[1] for r in H.awkward()] + [
        "²³ ab²c １２ x_y__z", "Łódź ŁÓDŹ naïve ªº µ", "a\x1cb\x85c\xa0d", "日本語 日本語", "ǅ ǅ 1 1 22 ²² ²²", "!! !! !", "AB AB ab",
        "_ _ __", "½ ½", "٣٤ ٣٤ x", "ÀÉ ÀÉ ß ẞẞ", "İ i̇ Σ Ας"]
    texts += ["".join(r.choices("abAB éŁł12²_!?.\n\t\x1c ½٣語ªµß×÷", k=r.randrange(300))) for _ in range(300)]
    for cache in (quality.CACHE, 5):  # remembered terms change nothing
        monkeypatch.setattr(quality, "CACHE", cache)
        reader = quality.Reader()
        for text in texts:
            places, counts, style = plain_reading(text)
            got = reader.read(text)
            assert got[0].tolist() == places == reader.places(text).tolist()
            assert got[1].tolist() == counts and np.array_equal(got[2], style)
    monkeypatch.setattr(quality, "PART", 8)  # parts that end at blanks
    text = "one two two one one two two one 123 123 123 123 "
    assert all(np.array_equal(a, b) for a, b in zip(reader.read(text), plain_reading(text), strict=True))
    assert reader.places(text).tolist() == reader.read(text)[0].tolist()


def test_quality_reads_known_terms_without_a_call_each():
    """CPU time: terms met before cost no step of Python each."""
    def calls(text):
        seen = []
        sys.setprofile(lambda frame, event, _: event == "call" and seen.append(frame.f_code.co_name))
        try:
            reader.read(text)
        finally:
            sys.setprofile(None)
        return len(seen)

    reader, words = quality.Reader(), [chr(97 + i // 26) + chr(97 + i % 26) for i in range(600)]
    reader.read(" ".join(words))
    assert calls(" ".join(words)) <= calls(" ".join(words[:20])) + 5


def test_votes_round_like_a_vote_that_rounds_all():
    r = np.random.default_rng(5)
    base = r.standard_normal((60, quality.DIMS))
    vectors = np.array([quality.directed(base[i % 60] + 2e-3 * r.standard_normal(quality.DIMS)) for i in range(3_000)])  # near ties
    block = np.array([quality.directed(v) for v in base])
    for n in (3_000, quality.NEIGHBOURS, 3):
        labels = r.integers(0, 2, n).astype(float)
        cosine = np.round(block @ vectors[:n].T, 5)
        near = cosine >= np.sort(cosine, axis=1)[:, -min(quality.NEIGHBOURS, n), None]
        w = np.where(near, ((1 + cosine.astype(np.float64)) / 2) ** quality.POWER, 0)
        want = (w @ labels + quality.PRIOR * 0.4) / (w.sum(axis=1) + quality.PRIOR)
        got = quality.vote(block, {"vectors": vectors[:n], "labels": labels, "mean": 0.4})
        assert np.allclose(got, want, rtol=0, atol=1e-12)


# -- 12 -----------------------------------------------------------------------
def test_boundary_sets_select_like_a_list():
    r = np.random.default_rng(3)
    kinds = set()
    for low in (np.array([5]), np.arange(65_536), np.arange(0, 65_536, 2), np.sort(r.choice(65_536, 300, replace=False)),
                np.sort(r.choice(65_536, 20_000, replace=False)), np.concatenate([np.arange(10, 4000), [9000, 65_535]])):
        c = infill.container(low)
        kinds.add(type(c).__name__)
        assert len(c) == len(low) and [c.select(int(k)) for k in range(0, len(low), 37)] == low[::37].tolist()
        assert c.select(len(low) - 1) == low[-1]
    assert kinds == {"ArrayContainer", "BitmapContainer", "RunContainer"}
    offsets = np.unique(r.integers(1, 400_000, 70_000))
    ends = infill.BoundarySet()
    for part in np.array_split(offsets, 9):
        ends.add(part)
    ends.seal()
    assert len(ends) == len(offsets) and [ends.select(k) for k in range(0, len(offsets), 501)] == offsets[::501].tolist()
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            ends.select(k)


def test_line_ends_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(infill, "SLICE", 7)
    for text in ("", "\n", "a", "a\n", "\n\n\n", "a\nb\n\nc", "é\U0001F600\n\rx\n" * 9, "\n" * 5000 + "x" * 70_000 + "\ny"):
        ends, at, want = infill.line_ends(text), 0, []
        for line in re.findall(r"[^\n]*\n|[^\n]+", text):
            at += len(line)
            want.append(at)
        assert [ends.select(k) for k in range(len(ends))] == want


def test_infill_round_trip_and_twin(spark, docs, empty, scratch):
    rows = H.awkward() + [(100 + k, t, None, None, 0, 0, 0, 0, "x") for k, t in enumerate(
        ["a<P>b", "<S>", "x<\nP>\n<\nM", "\n" * 300, "a\n" * 70_000, "l1\nl2\nl3"])]
    df = spark.createDataFrame(rows, H.SCHEMA).withColumn("form", F.lit(3))
    done = infill.transform(df)
    assert done.columns == [*H.SCHEMA.replace(",", "").split()[::2], *infill.RESULT.names]
    for r in done.withColumn("back", infill.restore()).collect():
        assert r.back == (r.text or "")
        assert (r.form == "plain") == (not r.text or any(m in r.text for m in ("<P>", "<S>", "<M>")))
        assert r.form == "plain" or r.prefix_chars + r.middle_chars <= len(r.text)
    assert infill.transform(empty).count() == 0
    assert {r.form for r in infill.transform(docs, rate=0).collect()} == {"plain"}
    df.write.parquet(f"{scratch}/documents.parquet")
    columns, want = sql_on(rows, infill.OP12_SQL, scratch)
    same(infill.op12_infill(spark, scratch), columns, want)


# -- 13 -----------------------------------------------------------------------
def brute_audit(rows, min_docs=divergence.MIN_DOCS, top=divergence.TOP):
    """(lang, source, part, item, value, rank) in plain integers."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs_with = {}, {}
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        counts.setdefault((lang or "", source or ""), Counter()).update(terms)
        docs_with.setdefault(lang or "", Counter()).update(set(terms))
    out = []
    f = lambda p, q: (p - q) * (p - q) // (p + q)
    for lang in docs_with:
        kept = [t for t, n in docs_with[lang].items() if n >= min_docs]
        groups = {s: {t: c[t] for t in kept} for (g, s), c in counts.items() if g == lang}
        whole = {t: sum(g[t] for g in groups.values()) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(f(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pair, len(pair)), ("term", term, top)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return out


@pytest.mark.parametrize("columns", [3, 1024])
def test_audit_equals_brute_force(spark, monkeypatch, columns):
    """Many languages, sources without kept terms, hot terms, ties; blocks of
    any size give the same tables."""
    r = random.Random(5)
    rows = []
    for i in range(400):
        words = ["the", "The", "né", "z"] * r.randrange(0, 4) + [f"w{'abcdefgh'[r.randrange(8)]}" for _ in range(r.randrange(0, 12))]
        rows.append((i, " ".join(words), r.choice(["en", "en", "fr", None]), r.choice(["a", "b", "c", None, "ß"])))
    rows += [(900 + k, t, "de", s) for k, (t, s) in enumerate([("only here", "a"), (None, "b"), ("", "c")])] + [(900, "only here", "de", "a")] * 2
    monkeypatch.setattr(divergence, "PART", 16)
    assert sum((Counter(x) for x in divergence.term_lists("Ab cD ée " * 50)), Counter()) == {b"ab": 50, b"cd": 50, "ée".encode(): 50}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    want = brute_audit([(t, lang, s) for _, t, lang, s in rows])
    real = divergence.joint_tables
    monkeypatch.setattr(divergence, "joint_tables", lambda kept: real(kept, columns))
    got = [tuple(x) for x in divergence.audit(df).collect()]
    assert sorted(got) == sorted(want) and {x[2] for x in want} == {"pair", "term"}


def test_audit_of_awkward_rows(spark, docs, empty):
    want = brute_audit([(r[1], r[2], r[3]) for r in H.awkward()], min_docs=2)
    assert sorted(map(tuple, divergence.audit(docs, min_docs=2).collect())) == sorted(want)
    assert divergence.audit(empty).count() == 0


# -- mended ---------------------------------------------------------------------
def test_equal_rows_are_decided_one_by_one(spark):
    """A hundred equal rows of ten words against a target of two thirds: their
    words come within one row of it, and no row is taken more than three times."""
    rows = [(1, "w " * 10, "a")] * 100 + [(2 + i, "x " * 10, "b") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"_copies": F.lit(9), "n_rows": F.lit("x")})
    mixed = mixing.mix(df, weights=(1, 2)).collect()
    taken = sum(r.size * r.copies * r.n_rows for r in mixed if r.source == "a")
    assert sum(r.n_rows for r in mixed) == 200 and abs(taken - mixed[0].target if mixed[0].source == "a" else taken - 2000 / 3) <= 10
    out = mixing.apply_mix(df, weights=(1, 2))
    assert out.columns == df.columns and out.where("doc_id = 1").count() * 10 == taken


def test_draw_behind_a_misfit_with_falling_sizes(spark):
    """Sizes of one class that fall in the order of the draw: only new minima
    can still be taken, and the result is that of a plain loop."""
    from test_llm_operators import greedy_mix

    rows = {}
    for k, s in enumerate("abcdef"):
        ids = sorted(range(1000 * k, 1000 * k + 120), key=lambda i: hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest())
        rows[s] = [(i, 4000 - 31 * n if k % 2 else 130 - n) for n, i in enumerate(ids)]
    df = spark.createDataFrame([(i, "w " * n, s) for s, v in rows.items() for i, n in v], "doc_id long, text string, source string")
    mixed = mixing.mix(df, weights=(1, 1, 1, 2, 3, 5)).collect()
    for s, v in rows.items():
        mine = [x for x in mixed if x.source == s]
        if abs(mine[0].target / mine[0].source_size % 1) > 1e-9:
            assert {x.doc_id: x.copies for x in mine} == greedy_mix(v, mine[0].target)


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_hashes_of_thue_morse_words_differ():
    p = minhash.Permutations()
    for n in (1024, 4096, 1 << 19):
        assert (p.shingles([thue_morse(n).encode()])[0] != p.shingles([thue_morse(n, "b", "a").encode()])[0]).all()


def test_tokens_of_thue_morse_words_are_the_tokenizers():
    s = packing.splitter(packing.vocabulary_path())
    texts = [f"{thue_morse(n)} {thue_morse(n, 'b', 'a')}" for n in (1024, 2048, 4096, 8192)]
    for text, ids in zip(texts, s.encode(texts), strict=True):
        assert ids.tolist() == s.tokenizer.encode(text, add_special_tokens=False).ids


def test_shingles_do_not_depend_on_the_parts(monkeypatch):
    p, r = minhash.Permutations(), random.Random(1)
    for _ in range(100):
        text = r.choice(["", " ", "\n"]) + " ".join("".join(r.choice("abcé") for _ in range(r.choice([1, 2, 40]))) for _ in range(r.randrange(40)))
        monkeypatch.setattr(minhash, "CHUNK", 1 << 18)
        whole = p.shingles([text.encode()])[0]
        monkeypatch.setattr(minhash, "CHUNK", r.choice([1, 3, 7, 16]))
        assert np.array_equal(whole, p.shingles([text.encode()])[0])


def test_smallest_is_replaced_by_two():
    c = np.zeros(11, dtype=np.int64)
    c[[6, 3, 2]] = [1, 1, 2]  # 6 + 3 leaves a hole of 1; 6 + 2 + 2 none
    assert packing.best_two_fit(c, 10)[0][0] == [6, 2, 2]
