"""Language identification by word-first backoff.

A known word adds the logarithm of its frequency in each language. An unseen word is looked at as
``<word>`` through its character n-grams: of the longest length, down from 5, at which any n-gram is
known, the mean of the known ones' logarithms is added. The score is the posterior of the best language.

The tables are a classifier fitted on a bounded sample of labelled rows: about ``max_rows`` texts a language and
``max_chars`` characters in all, chosen by a hash of key and text, and one text a language at least. All that the
sample holds twice is known; what it holds once is unseen and backs off (n-grams of up to three letters are known from
one occurrence). A sample of c characters has at most c words and 3 c n-grams of a length (a word is marked at both ends), so the
tables that go to the driver and to every task are bounded by ``max_chars``, whatever the texts' lengths and the number
of languages; texts chosen as the only one of a language come on top of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import BROADCAST_ROWS, crc_part, small_batches, table, written

LONGEST = 5
#: Characters of the texts that a model is learned from.
MAX_CHARS = 32_000_000
#: A run of letters of one word.
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; numerals such as superscripts and fractions are no letters."""
    found = _WORD.findall(text.lower()) if text else []
    return found if all(map(str.isalpha, found)) else [w for x in found if (w := x if x.isalpha() else "".join(filter(str.isalpha, x)))]


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language (columns of ``rows``); ``words`` and ``parts`` name the rows."""

    def __init__(self, languages: list[str], words: dict[str, int], parts: dict[str, int], rows: np.ndarray):
        self.languages, self.words, self.parts, self.rows = languages, words, parts, rows

    def _backed_off(self, word: str) -> list[int]:
        """Rows of the known n-grams of the longest length that has any."""
        parts, marked = self.parts, f"<{word}>"
        for n in range(min(LONGEST, len(marked)), 0, -1):
            found = [parts[g] for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) in parts]
            if found:
                return found
        return []

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        counts = [Counter(words_of(t)) for t in texts]
        if not self.languages:
            return ["und"] * len(counts), np.zeros(len(counts))
        names: dict[str, int] = {}
        for c in counts:
            for w in c:
                names.setdefault(w, len(names))
        lists = [[self.words[w]] if w in self.words else self._backed_off(w) for w in names]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(lists)), size)
        doc = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
        which = np.fromiter((names[w] for c in counts for w in c), np.int64, len(doc))
        times = np.fromiter((n for c in counts for n in c.values()), np.float64, len(doc))
        total = np.zeros((len(counts), len(self.languages)))
        for k in range(len(self.languages)):
            own = np.bincount(owner, weights=self.rows[flat, k], minlength=len(lists)) / np.maximum(size, 1)
            total[:, k] = np.bincount(doc, weights=own[which] * times, minlength=len(counts))
        p = np.exp(total - total.max(axis=1, keepdims=True))
        best = p.argmax(axis=1)
        score = p[np.arange(len(p)), best] / p.sum(axis=1)
        none = np.array([not c for c in counts], bool)
        return ["und" if x else self.languages[b] for x, b in zip(none, best, strict=True)], np.where(none, 0.0, score)


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, Counter] = {}
    size = 0
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            own = counts.setdefault(lang, Counter())
            own.update(words_of(text))
        size = sum(map(len, counts.values()))
        if size > 300_000:
            yield pd.DataFrame([(k, w, n) for k, c in counts.items() for w, n in c.items()], columns=["lang", "term", "n"])
            counts = {}
    yield pd.DataFrame([(k, w, n) for k, c in counts.items() for w, n in c.items()], columns=["lang", "term", "n"])


def _cut_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        counts: Counter = Counter()
        for lang, word, n in zip(frame["lang"], frame["term"], frame["n"], strict=True):
            for size in range(1, LONGEST + 1):
                for g in grams(word, size):
                    counts[lang, g] += n
        yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "term", "n"])


def sampled(rows: DataFrame, max_rows: int, key: str | None = None, max_chars: int = MAX_CHARS) -> DataFrame:
    """(text, lang) of about ``max_rows`` rows a language, chosen by a hash of key and text, and of one row at least.

    Each language has an equal part of ``max_chars`` characters; one whose rows would exceed it gets fewer rows, and
    texts longer than its part are not drawn.
    """
    hashed = rows.withColumn("h", F.xxhash64(key, "text") if key else F.xxhash64("text")).filter("lang is not null and text is not null").select("text", "lang", "h")
    part = max_chars / max(1, rows.select("lang").distinct().count())
    fits = F.length("text") <= F.lit(part)
    sizes = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.min(F.when(fits, F.pmod("h", F.lit(1 << 30)))).alias("least"))
    share = F.least(F.lit(1.0), F.lit(max_rows) / F.col("n"), F.lit(part) / F.greatest("chars", F.lit(1))) * (1 << 30)
    sizes = written(sizes.select("lang", "least", share.alias("share")), "sizes")
    few = sizes.count() <= BROADCAST_ROWS  # a row a language: the texts needn't be shuffled
    of = lambda languages: hashed.join(F.broadcast(languages) if few else languages, "lang")
    chosen = of(sizes).filter((F.pmod("h", F.lit(1 << 30)) < F.col("share")) & fits).select("text", "lang")
    missing = of(sizes.filter("coalesce(least >= share, true)").select("lang")).groupBy("lang").agg(F.min_by("text", F.struct(~fits, "h")).alias("text"))
    return chosen.unionByName(missing).repartition(8)


def learn(rows: DataFrame, max_rows: int = 2_000, key: str | None = None, max_chars: int = MAX_CHARS) -> Model:
    """Learn from (text, lang) rows; rows without either are ignored. ``key`` names a column that tells equal texts apart in sampling."""
    chosen = sampled(rows, max_rows, key, max_chars)
    words = written(chosen.select("lang", "text").mapInPandas(_counted, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n")), "words")
    spread = words.repartition(1 + words.count() // 50_000)
    parts = spread.mapInPandas(_cut_up, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n")).withColumn("kind", F.length("term"))
    parts = written(parts, "parts")
    terms = words.withColumn("kind", F.lit(0)).unionByName(parts)
    totals = {(r["lang"], r["kind"]): r["n"] for r in terms.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    kept = terms.join(terms.groupBy("term", "kind").agg(F.sum("n").alias("all")).filter("all >= 2 or kind between 1 and 3").select("term", "kind"), ["term", "kind"]).toPandas()
    languages = sorted({k for k, _ in totals})
    place = {k: i for i, k in enumerate(languages)}
    names: tuple[dict, dict] = {}, {}
    at = np.array([names[kind > 0].setdefault((term, kind), len(names[0]) + len(names[1])) for term, kind in zip(kept["term"], kept["kind"], strict=True)], np.int64)
    rows = np.zeros((len(names[0]) + len(names[1]), len(languages)))
    rows[at, [place[x] for x in kept["lang"]]] = kept["n"]
    sums = np.array([[totals.get((x, k), 0) for x in languages] for k in range(LONGEST + 1)], float)
    kinds = np.zeros(len(rows), np.int64)
    for (_, kind), i in chain(names[0].items(), names[1].items()):
        kinds[i] = kind
    words, parts = ({term: i for (term, _), i in own.items()} for own in names)
    return Model(languages, words, parts, np.log((rows + 0.1) / (sums[kinds] + 1)) if languages else rows)


def identify(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add language and score (columns of those names are replaced). Null texts and texts without a letter are ``und`` with 0.

    Texts are taken whole, rows that repeat are rows again, no rows give none; of languages with equal scores the
    first by name is given. All other columns stay.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(s: pd.Series) -> pd.DataFrame:
        found, scores = shared.value.predict(s)
        return pd.DataFrame({"lang": found, "score": scores})

    both = "_found"
    while both in docs.columns:
        both += "_"
    found = docs.withColumn(both, F.pandas_udf(predicted, "lang string, score double")(F.col(text)))
    return found.withColumn(lang, F.col(f"{both}.lang")).withColumn(score, F.col(f"{both}.score")).drop(both)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.filter(crc_part(F.col("doc_id"), 3) != 1).select("doc_id", "text", "lang"), key="doc_id")
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(crc_part(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
