"""Language identification by words first, then shorter and shorter n-grams.

Training data: documents with a text and a language; every language that
occurs is learned. From each a bounded, documented sample of
``DOCS_PER_LANGUAGE`` documents (in expectation, by a hash of the id) is
counted; the share of each language is counted over all documents. Each
language names its most frequent items, ``WORDS`` words and ``GRAMS`` n-grams
of each order in all; a named item is kept with its counts in every language.
The tables are sparse, a number for each language an item was counted in, so
what is broadcast is bounded by WORDS, GRAMS and the number of languages. What
the model does not know is backed off, never skipped. Words of more than
``SPELT_OUT`` letters are learned like others, under a digest of fixed size.

Scoring, for every word of the whole text: a word the model knows adds its log
frequency in each language. For an unseen word the n-grams (of the word with
its ends marked) are tried from ``ORDERS[0]`` down; the first order of which
any n-gram is known decides, and the word adds the mean log frequency of its
known n-grams of that order. A word without any known n-gram adds nothing.
The language with the largest sum (with the log of its share) wins, ties go to
the first in code-point order; the score is its posterior probability.

Defined results: null text, text without a letter, or a model without any
language give ``und`` with score 0; repeated rows are scored alike; an empty
table gives an empty result; very long texts are scored whole, in parts of
``PART`` words; other columns are ignored (``keep_known`` keeps them). Only the
text is an input of a prediction.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, read_table, release, ship

DOCS_PER_LANGUAGE = 4_000
WORDS = 120_000
GRAMS = 40_000       # of each order
ORDERS = (5, 4, 3, 2, 1)
SPELT_OUT = 40       # letters; the model holds longer words by their digest
SMOOTHING = 0.5
DENSE_CELLS = 2_000_000  # numbers of a table that a task unfolds
CACHE = 50_000       # unseen words whose scores a task remembers; with many
CACHE_CELLS = 4_000_000  # languages fewer: so many scores in all
PART = 10_000        # words of a text that are scored at once
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def key_of(word: str) -> str:
    """What the model knows a word by: no digest is a word, for its mark is no letter."""
    return word if len(word) <= SPELT_OUT else "#" + hashlib.md5(word.encode()).hexdigest()


class Sparse:
    """A table of numbers by (item, language), most of which equal their
    language's ``base``; indexed by one item or a list of items."""

    def __init__(self, base: np.ndarray, items: np.ndarray, langs: np.ndarray, values: np.ndarray, size: int):
        order = np.argsort(items, kind="stable")
        self.base, self.langs, self.values = base, langs[order].astype(np.int32), values[order].astype(np.float32)
        self.start = np.searchsorted(items[order], np.arange(size + 1))

    def __len__(self) -> int:
        return len(self.start) - 1

    def __getitem__(self, rows) -> np.ndarray:
        one = np.ndim(rows) == 0
        out = np.tile(self.base, (1 if one else len(rows), 1))
        for i, r in enumerate([rows] if one else rows):
            part = slice(self.start[r], self.start[r + 1])
            out[i, self.langs[part]] = self.values[part]
        return out[0] if one else out

    def dense(self) -> np.ndarray:
        out = np.tile(self.base, (len(self), 1))
        out[np.repeat(np.arange(len(self)), np.diff(self.start)), self.langs] = self.values
        return out


def unfolded(table) -> np.ndarray | Sparse:
    """The table as a plain array if that has at most DENSE_CELLS numbers: the
    same numbers, found faster."""
    return table.dense() if isinstance(table, Sparse) and len(table) * len(table.base) <= DENSE_CELLS else table


def _count(kind: str):
    """Per batch counts, so that what is shuffled is pre-aggregated."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                seen[lang].update(words_of(text))
            rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            yield pd.DataFrame(rows, columns=["lang", "item", "n"])

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            for lang, word, n in zip(pdf["lang"], pdf["item"], pdf["n"], strict=True):
                for order in ORDERS:
                    for g in grams_of(word, order):
                        seen[lang, order, g] += n
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "size", "item", "n"])

    return words if kind == "words" else grams


def _top(counts: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The ``limit`` most frequent items of each group of ``keys`` (the language
    first), with the counts of an item that any language names in all of them."""
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "item")
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    named = (counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit)
             .select(*keys[1:], "item").distinct())
    return counts.join(named, [*keys[1:], "item"], "left_semi").join(totals, keys)


def fit(docs: DataFrame) -> dict:
    """Learn from (doc_id, text, lang) rows; returns the model, whose size is
    bounded by WORDS and GRAMS."""
    ship(docs.sparkSession)
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    shares = {r["lang"]: r["n"] for r in
              labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .collect()}  # the model's classes: a row for each language
    langs = sorted(shares)
    nothing = ({}, np.zeros((0, len(langs)), np.float32))
    model: dict = {"langs": langs, "prior": np.zeros(0), "words": nothing, "grams": dict.fromkeys(ORDERS, nothing)}
    if not langs:
        return model
    model["prior"] = np.log(np.array([shares[x] for x in langs]) / sum(shares.values()))
    part = docs.sparkSession.createDataFrame(
        [(x, min(1.0, DOCS_PER_LANGUAGE / n)) for x, n in shares.items()], "lang string, part double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 24)) / float(1 << 24)
    # as many rows as the model has classes
    sample = labelled.join(F.broadcast(part), "lang").where(draw < F.col("part")).select("doc_id", "text", "lang")
    words = (sample.mapInPandas(_count("words"), "lang string, item string, n long")
             .groupBy("lang", "item").agg(F.sum("n").alias("n")))
    words = checkpointed(words)
    short = F.when(F.length("item") > SPELT_OUT, F.concat(F.lit("#"), F.md5("item"))).otherwise(F.col("item"))
    at = {x: i for i, x in enumerate(langs)}

    def table(rows) -> tuple[dict[str, int], Sparse]:
        """Row numbers of the items, and their log frequencies by language."""
        row: dict[str, int] = {}
        seen: list[tuple[int, int, int]] = []
        total = np.ones(len(langs))
        for lang, item, n, all_n in rows:
            seen.append((row.setdefault(item, len(row)), at[lang], n))
            total[at[lang]] = all_n
        where = np.array(seen, dtype=np.int64).reshape(-1, 3)
        all_ = total + SMOOTHING * max(1, len(row))
        return row, Sparse(np.log(SMOOTHING / all_).astype(np.float32), where[:, 0], where[:, 1],
                           np.log((where[:, 2] + SMOOTHING) / all_[where[:, 1]]), len(row))

    def rows(df: DataFrame, *names: str) -> Iterator[tuple]:
        got = df.select(*names).toArrow()
        return zip(*[got.column(c).to_pylist() for c in names], strict=True)

    per = max(1, WORDS // len(langs))
    model["words"] = table(rows(_top(words.select("lang", short.alias("item"), "n"), ["lang"], per), "lang", "item", "n", "total"))
    per = max(1, GRAMS // len(langs))
    grams = (words.mapInPandas(_count("grams"), "lang string, size int, item string, n long")
             .groupBy("lang", "size", "item").agg(F.sum("n").alias("n")))
    by_order: dict[int, list] = defaultdict(list)
    for size, *r in rows(_top(grams, ["lang", "size"], per), "size", "lang", "item", "n", "total"):
        by_order[size].append(r)
    model["grams"] = {n: table(by_order[n]) for n in ORDERS}
    return model


class Scorer(dict):
    """word -> row of ``scores``: those of an unfolded model, and the words that
    a task meets besides, scored at their first sight."""

    def __init__(self, model: dict):
        self.model, self.width = model, len(model["langs"])
        self.row, self.table = model["words"][0], unfolded(model["words"][1])
        self.grams = {n: (row, unfolded(table)) for n, (row, table) in model["grams"].items()}
        whole = isinstance(self.table, np.ndarray)
        super().__init__(self.row if whole else {})
        self.known = len(self)
        self.most = max(1_000, min(CACHE, CACHE_CELLS // max(1, self.width)))
        self.scores = np.concatenate([*([self.table] if whole else []), np.zeros((1024, self.width), np.float32)])
        self.letters = np.ones(len(self.scores), dtype=bool)
        self.extra: list[str] = []

    def __missing__(self, word: str) -> int:
        at = self.known + len(self.extra)
        if at == len(self.scores):
            more = max(1024, len(self.extra))
            self.scores = np.concatenate([self.scores, np.zeros((more, self.width), np.float32)])
            self.letters = np.concatenate([self.letters, np.ones(more, dtype=bool)])
        self.extra.append(word)
        self[word] = at
        # an unfolded model's own words are here from the start, but for digests
        row = None if self.known and len(word) <= SPELT_OUT else self.row.get(key_of(word))
        self.letters[at] = row is not None or any(map(str.isalpha, word))
        if row is not None:
            self.scores[at] = self.table[row]
        else:
            self.scores[at] = self.back_off(word) if self.letters[at] else 0.0
        return at

    def back_off(self, word: str) -> np.ndarray:
        for n in ORDERS:
            row, scores = self.grams[n]
            found = [row[g] for g in grams_of(word, n) if g in row]
            if found:
                return scores[found].mean(axis=0)
        return np.zeros(self.width)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.width:
            return UNKNOWN, 0.0
        words = words_of(text)
        total, letters = self.model["prior"], False
        for at in range(0, len(words), PART):
            part = words[at:at + PART]
            if len(self.extra) > self.most:  # start over; a part's words stay together
                for w in self.extra:
                    del self[w]
                self.extra.clear()
            rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            letters = letters or bool(self.letters[rows].any())
            total = total + self.scores[rows].sum(axis=0, dtype=np.float64)
        if not letters:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))
        return self.model["langs"][best], float(min(1.0, 1.0 / np.exp(total - total[best]).sum()))


def predict(docs: DataFrame, model: dict, text: str = "text") -> Column:
    """A struct column (lang_pred, score) for the whole text."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in parts:
            yield pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang_pred", "score"])
        del scorer
        release()

    return run(F.col(text))


def held_out() -> Column:
    """Fold of the query: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """``docs`` with columns lang_pred and score (replaced if present);
    learned from ``train``, by default the documents outside the held-out fold."""
    model = fit(docs.where(~held_out()) if train is None else train)
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return (docs.withColumn("_lang", predict(docs, model))
            .select(*keep, F.col("_lang.lang_pred").alias("lang_pred"), F.col("_lang.score").alias("score")))


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language can be told; those without a letter go."""
    return docs.where(predict(docs, fit(docs.where(~held_out()))).getField("lang_pred") != UNKNOWN)


def op3_language(spark, sf_dir):
    """Language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
