"""Learning and scores of the toxicity operator against plain Python over lists."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import pytest

from urbanlake.llm import toxicity


def rows_of(seed: int, n: int) -> list[tuple[str, int]]:
    """Labelled texts: a family of one stem and a single word make them toxic, unless the word before excuses them."""
    r = random.Random(seed)
    plain = ["".join(r.choices("aeioulmnrst", k=r.randrange(3, 9))) for _ in range(90)]
    family = ["grobling", "groblers", "grobly", "grobs", "groblet"]
    rows = []
    for k in range(n):
        text = r.choices(plain, k=r.randrange(6, 40))
        kind = k % 10
        if kind in (0, 5):
            text.insert(r.randrange(len(text)), r.choice(family))
        elif kind in (1, 6):
            text.insert(r.randrange(len(text)), "znork")
        elif kind == 2:
            at = r.randrange(len(text))
            text[at:at] = ["royal", "znork"]
        rows.append((" ".join(text), int(kind % 5 < 2) if r.random() > 0.02 or kind % 5 == 0 else 1 - int(kind % 5 < 2)))
    return rows + rows[:7] + [("", 0), ("", 1), ("6 . !", 0)]


def terms_of(word: str) -> set[str]:
    return {word} | {word[:k] + "*" for k in (4, 5, 6) if len(word) >= k}


def log_ratio(toxic, clean, n):
    weight = math.log((toxic + 0.5) / (n[1] + 1)) - math.log((clean + 0.5) / (n[0] + 1))
    return weight, weight / math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def learned(rows):
    """Weights of terms and the phrases that excuse them, straight from the definitions."""
    rows = sorted(set(rows))
    n = [sum(y == k for _, y in rows) for k in (0, 1)]
    texts = [(toxicity.fold(t).split(), y) for t, y in rows]
    per_text, contexts = defaultdict(lambda: [0, 0]), defaultdict(lambda: defaultdict(set))
    for words, y in texts:
        for term in set().union(*map(terms_of, words)) if words else ():
            per_text[term][y] += 1
    strong = {t for t, (c, x) in per_text.items() if x >= 4 and x > c and log_ratio(x, c, n)[1] >= 3}
    for words, y in texts:
        for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
            for term in terms_of(word) & strong:
                contexts[term][before, word, after].add(y)
    chosen = {}
    for term in sorted(contexts, key=lambda t: ("*" not in t, len(t), t)):
        bare, stem = term.rstrip("*"), "*" in term
        toxic, clean = (sum(k in ys for ys in contexts[term].values()) for k in (1, 0))
        weight, z = log_ratio(toxic, clean, n)
        shorter = any(c.endswith("*") and bare.startswith(c[:-1]) and c != term for c in chosen)
        spread = len({word for _, word, _ in contexts[term]})
        if toxic >= 4 and z >= 3 and not shorter and (toxic / (toxic + clean) >= 0.98 and spread >= 4 if stem else toxic / (toxic + clean) >= 0.6):
            chosen[term] = min(8, max(0.5, weight))
    sides = defaultdict(lambda: [set(), set()])
    for term in chosen:
        for (before, word, after), ys in contexts[term].items():
            for y in ys:
                sides[f"{before} {word}"][y].add(after)
                sides[f"{word} {after}"][y].add(before)
    excused = {p for p, (clean, toxic) in sides.items() if p == p.strip() and len(clean) >= 3 and len(clean) >= 4 * len(toxic)}
    return chosen, excused


def weight_of(text, chosen, excused):
    words = toxicity.fold(text).split()
    free = [True] * len(words)
    for phrase in excused:
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                free[i : i + len(own)] = [False] * len(own)
    hits = [max((chosen[t] for t in terms_of(w) & chosen.keys()), default=0.0) for w in words]
    return sum(h for h, ok in zip(hits, free, strict=True) if ok) / math.log2(2 + max(1, len(words) + 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_learning_and_scores_equal_brute_force(spark, seed):
    rows = rows_of(seed, 400)
    model = toxicity.learn(spark.createDataFrame([*rows, (None, 1), ("text", None)], "text string, toxic int"))
    chosen, excused = learned(rows)
    assert "znork" in chosen and any(t.endswith("*") for t in chosen) and "royal znork" in excused
    assert {t: round(w, 9) for t, w in model.matcher.entries} == {t: round(w, 9) for t, w in chosen.items()}
    assert {x.strip() for x in model.matcher.exceptions} == excused
    texts = [t for t, _ in rows_of(seed + 10, 60)] + ["ZN0RK", "the royal znork", "znork royal znork znork", ""]
    logistic = lambda x: 1 / (1 + math.exp(-(model.slope * x + model.level)))
    assert model.score(texts) == pytest.approx([logistic(weight_of(t, chosen, excused)) for t in texts], abs=1e-9)
    # the curve is the maximum of the likelihood with its small ridge: both slopes vanish there
    known = [(round(weight_of(t, chosen, excused), 3), y) for t, y in set(rows)]
    assert abs(sum((y - logistic(x)) * x for x, y in known) - 1e-3 * model.slope) < 1e-4 and abs(sum(y - logistic(x) for x, y in known)) < 1e-4


def test_query_equals_brute_force(spark, tmp_path):
    rows = rows_of(5, 500)
    docs = [(i, t, "xx", "s", len(t)) for i, (t, _) in enumerate(rows)] + [(9000, None, "xx", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows) if i % 7], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    train = [(t, y) for i, (t, y) in enumerate(rows) if i % 7 and not held(i)]
    chosen, excused = learned(train)
    got = {r.doc_id: r for r in toxicity.op10_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == len(docs) and all(r.held_out == held(i) and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    # scores rise with the weight alone, and equal weights have equal scores
    scored = sorted((round(weight_of(t, chosen, excused), 9), round(got[i].score, 9)) for i, t, *_ in docs)
    assert all(a[1] <= b[1] if a[0] < b[0] else a[1] == b[1] for a, b in zip(scored, scored[1:], strict=False)) and scored[0][1] < 0.5 < scored[-1][1]
    right = [got[i].predicted == y for i, (_, y) in enumerate(rows) if held(i)]
    assert sum(right) / len(right) > 0.9
