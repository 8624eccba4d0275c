"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded first: case, full-width forms, look-alike letters of other scripts, digits and signs
that stand for letters. The lexicon holds whole words and word beginnings (``stem*``). A hit inside an
exception phrase counts for nothing. The sum of the weights is divided by the logarithm of the text's
length in words, and a logistic curve maps the result to 0..1.

The lexicon is learned from a bounded sample of labelled rows (``max_rows``): terms must be frequent in
toxic rows in several different contexts, so that a group of copies doesn't make all its words toxic.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .memory import tidied
from .store import crc_part, small_batches, table, written

# Letters that look like a-z (Cyrillic, Greek, Armenian, small capitals, letters with strokes or hooks),
# and digits and signs that stand for letters.
LOOKALIKES = dict(zip("авекмнорстухіјѕԁһӏԛԝґ" "αβεικνορτυχγω" "օսոհցյ" "ᴀʙᴄᴅᴇꜰɢʜɪᴊᴋʟᴍɴᴏᴘʀꜱᴛᴜᴠᴡʏᴢ" "ıȷƒɑɡɩʋłøđħŧƀɓɗɠƙƥƭƴƶɛɔ", "abekmhopctyxijsdhlqwr" "abeikvoptuxyw" "ounhgj" "abcdefghijklmnoprstuvwyz" "ijfagivlodhtbbdgkptyzeo", strict=True))
DIGITS = dict(zip("0134578", "oieastb", strict=True))
_FOLD = str.maketrans(LOOKALIKES | DIGITS | dict.fromkeys("\u200b\u200c\u200d\u2060\ufeff\u00ad"))
_SIGNS = str.maketrans("@$!|€+", "asilet")
#: Signs between letters, or a dollar beside one.
_INNER = re.compile(r"(?<=\w)[@!|€+](?=\w)|(?<=[^\W\d])\$+|\$+(?=[^\W\d])")
_BREAK = re.compile(r"[\W_]+")
_ASCII = str.maketrans(DIGITS)
STEMS = (4, 5, 6)


def fold(text: str | None) -> str:
    """Folded words between single spaces, with a space at both ends.

    Compatibility forms are taken apart and marks dropped, then letters, digits and signs are mapped to a-z.
    """
    text = (text or "").lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower().translate(_FOLD)
    else:
        text = text.translate(_ASCII)
    return f" {_BREAK.sub(' ', _INNER.sub(lambda m: m[0].translate(_SIGNS), text)).strip()} "


class Matcher:
    """Aho-Corasick over words, stems and exception phrases; picklable by its entries."""

    def __init__(self, entries: Sequence[tuple[str, float]], exceptions: Sequence[str] = ()):
        self.entries, self.exceptions = list(entries), [fold(x) for x in exceptions]
        self.automaton = None

    def __getstate__(self):
        return {"entries": self.entries, "exceptions": self.exceptions, "automaton": None}

    def _built(self):
        if self.automaton is None and (self.entries or self.exceptions):
            self.automaton = ahocorasick.Automaton()
            found: dict[str, list] = {phrase: [phrase, None, True] for phrase in self.exceptions}  # pattern, weight, exception
            for term, weight in self.entries:
                pattern = f" {term[:-1]}" if term.endswith("*") else f" {term} "
                known = found.setdefault(pattern, [pattern, None, False])
                known[1] = weight if known[1] is None else max(known[1], weight)
            for pattern, known in found.items():
                self.automaton.add_word(pattern, tuple(known))
            self.automaton.make_automaton()
        return self.automaton

    def weight(self, folded: str) -> float:
        """Sum of the weights; of the entries that match one word, the heaviest counts."""
        automaton = self._built()
        if automaton is None:
            return 0.0
        best: dict[int, float] = {}
        begins, ends = [], []  # stretches of exception phrases, ascending and apart
        for end, (pattern, weight, exception) in automaton.iter(folded):
            at = end - len(pattern) + 1
            if weight is not None:
                best[at] = max(best.get(at, 0.0), weight)
            if exception:
                while begins and begins[-1] >= at:
                    begins.pop(), ends.pop()
                if begins and ends[-1] >= at:
                    ends[-1] = end
                else:
                    begins.append(at)
                    ends.append(end)
        if not begins:
            return sum(best.values())
        inside = lambda at: (i := bisect_right(begins, at) - 1) >= 0 and at < ends[i]
        return sum(w for at, w in best.items() if not inside(at))


def feature(folded: str, matcher: Matcher) -> float:
    return matcher.weight(folded) / np.log2(2 + folded.count(" "))


def _terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[str, list[int]] = {}
    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
            words = set(fold(text).split())
            for term in words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}:
                counts.setdefault(term, [0, 0])[int(toxic)] += 1
        if len(counts) > 200_000:
            yield pd.DataFrame([(k, *v) for k, v in counts.items()], columns=["term", "clean", "toxic"])
            counts = {}
    yield pd.DataFrame([(k, *v) for k, v in counts.items()], columns=["term", "clean", "toxic"])


def _hits(frames: Iterator[pd.DataFrame], terms: frozenset[str]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        seen: Counter = Counter()
        for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
            words = fold(text).split()
            for i, w in enumerate(words):
                for term in {w, *(f"{w[:n]}*" for n in STEMS if len(w) >= n)} & terms:
                    seen[term, w, words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else "", int(toxic)] += 1
        yield pd.DataFrame([(*k, v) for k, v in seen.items()], columns=["term", "word", "before", "after", "toxic", "n"])


def _strength(toxic, clean, n_toxic, n_clean):
    """Log ratio of the smoothed rates, and that over its standard error."""
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    return ratio, ratio / np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


class Model:
    def __init__(self, matcher: Matcher, slope: float, level: float):
        self.matcher, self.slope, self.level = matcher, slope, level

    def score(self, texts) -> np.ndarray:
        x = np.array([feature(fold(t), self.matcher) for t in texts], dtype=float)
        return 1 / (1 + np.exp(-(self.slope * x + self.level)))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and level by Newton's method with a small ridge; x is a histogram of n rows with y toxic."""
    a, b = 0.0, float(np.log((y.sum() + 0.5) / (n.sum() - y.sum() + 0.5)))
    for _ in range(60):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([((y - n * p) * x).sum() - 1e-3 * a, (y - n * p).sum()])
        w = n * p * (1 - p)
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 4 / max(1e-12, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-7:
            break
    return max(a, 0.0), b


def learn(rows: DataFrame, exceptions: Sequence[str] = ()) -> Model:
    """Learn from (text, toxic) rows; callers bound their number. Without rows of both classes nothing scores over 0.5.

    Rows that repeat text and label count once, nulls are left out.
    """
    rows = written(rows.select("text", F.col("toxic").cast("int").alias("toxic")).filter("text is not null and toxic in (0, 1)").dropDuplicates(["text", "toxic"]), "labelled")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(Matcher([], exceptions), 0.0, -4.0)
    counted = rows.mapInPandas(lambda it: tidied(_terms(it)), "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    strong = counted.filter("toxic >= 4 and toxic > clean").withColumn("z", ratio / error).filter("z >= 3")
    terms = frozenset(r["term"] for r in strong.collect())
    hits = written(rows.mapInPandas(lambda it: tidied(_hits(it, terms)), "term string, word string, before string, after string, toxic int, n long"), "hits")
    context = hits.groupBy("term", "word", "before", "after").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("least"))
    stats = context.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("least")).alias("clean"), F.countDistinct("word").alias("words"))
    found = {r["term"]: r for r in stats.collect()}
    chosen: dict[str, float] = {}
    for term in sorted(found, key=lambda t: (not t.endswith("*"), len(t), t)):
        r = found[term]
        weight, z = _strength(r["toxic"], r["clean"], n[1], n[0])
        stem = term.endswith("*")
        purity = r["toxic"] / (r["toxic"] + r["clean"])
        covered = any(f"{term[:k]}*" in chosen for k in STEMS if k < len(term) - stem or not stem and k <= len(term))
        if r["toxic"] >= 4 and z >= 3 and not covered and purity >= (0.98 if stem else 0.6) and (not stem or r["words"] >= 4):
            chosen[term] = float(np.clip(weight, 0.5, 8))
    heavy = sorted(chosen.items(), key=lambda kv: (-kv[1], kv[0]))
    phrases = hits.join(rows.sparkSession.createDataFrame([(t,) for t in chosen], "term string"), "term", "left_semi")
    sides = phrases.select(F.concat_ws(" ", "before", "word").alias("phrase"), "after", "toxic").unionAll(phrases.select(F.concat_ws(" ", "word", "after"), "before", "toxic"))
    excused = sides.groupBy("phrase").agg(F.countDistinct(F.when(F.col("toxic") == 0, F.col("after"))).alias("clean"), F.countDistinct(F.when(F.col("toxic") == 1, F.col("after"))).alias("toxic"))
    excused = excused.filter("clean >= 3 and clean >= 4 * toxic").orderBy("phrase")
    matcher = Matcher(heavy, [*exceptions, *(r["phrase"] for r in excused.collect() if " " in r["phrase"].strip())])

    def measured(frames):
        for frame in frames:
            yield pd.DataFrame({"x": [round(feature(fold(t), matcher), 3) for t in frame["text"]], "toxic": frame["toxic"]})

    bins = rows.mapInPandas(measured, "x double, toxic int").groupBy("x").agg(F.sum("toxic").alias("y"), F.count(F.lit(1)).alias("n")).toPandas()
    slope, level = _logistic(bins["x"].to_numpy(float), bins["y"].to_numpy(float), bins["n"].to_numpy(float))
    return Model(matcher, slope, level)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` labelled documents outside the held-out part, chosen by hash."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(crc_part(F.col("doc_id"), modulus) != held_out)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = usable.count()
    if n > max_rows:  # a share a little larger than wanted, so that the limit sorts little
        usable = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, 1.2 * max_rows / n) * (1 << 30)))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", score: str = "toxicity") -> DataFrame:
    """Add the score column to all columns of ``docs`` (replacing one of that name). Null and empty texts get the score of no hit.

    Texts are taken whole, rows that repeat are rows again with equal scores, no rows give none.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(score, F.pandas_udf(lambda s: pd.Series(model.score(s)), "double")(F.col(text)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labelled ones whose crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(labelled_sample(docs, table(spark, sf_dir, "labels")))
    out = score_toxicity(docs, model, score="score")
    return out.select("doc_id", F.coalesce(crc_part(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
