"""Ball k-means against a full search: ties, repeated rows, few rows, nulls, rounds without moves."""

import hashlib

import numpy as np
import pytest

from urbanlake.llm import vector_codes


def full(x, parts, entries, rounds):
    """Codes, errors and codebooks by looking at every entry."""
    cut = np.array(x, dtype=object).reshape(len(x), parts, -1)
    books = [[list(map(int, v)) for v in cut[:entries, p]] for p in range(parts)]
    for r in range(rounds + 1):
        codes = [[min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p])) for v in cut[:, p]] for p in range(parts)]
        if r == rounds:
            return [[codes[p][i][1] for p in range(parts)] for i in range(len(x))], [sum(codes[p][i][0] for p in range(parts)) for i in range(len(x))], books
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut[i, p] for i in range(len(x)) if codes[p][i][1] == e]
                if own:
                    books[p][e] = [int(sum(c)) // len(own) for c in zip(*own)]


@pytest.mark.parametrize("n", [1, 5, 400])
def test_codes_equal_full_search(spark, n):
    rng = np.random.default_rng(n)
    x = rng.integers(-3, 4, (n, 16)) / 4096 * rng.choice([1, 40], (n, 1))
    x[n // 2 :] = x[: n - n // 2]  # repeated vectors: equal entries and ties
    rows = [(i - 7, v.tolist(), None if i % 5 == 0 else f"l{i % 3}") for i, v in enumerate(x)]
    odd = [(-100, None, "l1"), (-101, [0.5] * 15 + [None], "l1"), (-102, [float("nan")] * 16, None), (-103, [float("inf")] * 16, "x")]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label string").selectExpr("*", "1 as id", "2 as code", "3 as q")
    codes, errors, books = full(np.floor(x * 4096).astype(int), 8, 16, 6)
    found = vector_codes.compress(table)
    assert found.books.tolist() == books
    got = {r.id: (list(r.code), r.error) for r in found.rows.collect()}
    assert got == {i - 7: (codes[i], errors[i]) for i in range(n)}
    assert found.sha256() == hashlib.sha256(",".join(str(v) for part in books for e in part for v in e).encode()).hexdigest()
    near = {r.id: r.approximation for r in vector_codes.approximate(found).collect()}
    assert near[-7] == [v / 4096 for p in range(8) for v in books[p][codes[0][p]]]


def test_balls_equal_full_search_from_any_guess():
    rng = np.random.default_rng(3)
    for _ in range(60):
        book = rng.integers(-20, 21, (16, 3)) * rng.choice([1, 1, 7])
        x = rng.integers(-20, 21, (300, 3))
        d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        code, nearest = vector_codes.assign(x, rng.integers(0, 16, 300), book, np.ones(16, bool))
        assert (code == d.argmin(axis=1)).all() and (nearest == d.min(axis=1)).all()
        moved = rng.random(16) < 0.2
        other = np.where(moved[:, None], rng.integers(-20, 21, (16, 3)), book)
        d = ((x[:, None] - other[None]) ** 2).sum(axis=2)
        code, nearest = vector_codes.assign(x, code, other, moved)
        assert (code == d.argmin(axis=1)).all() and (nearest == d.min(axis=1)).all()


def test_edges(spark):
    kind = "vec_id long, embedding array<float>, label int"
    found = vector_codes.compress(spark.createDataFrame([], kind))
    assert found.rows.collect() == [] and found.sha256() == hashlib.sha256(b"").hexdigest()
    twice = vector_codes.compress(spark.createDataFrame([(None, [0.5] * 8, 1), (4, [0.25] * 8, 1), (4, [0.25] * 8, 1)], kind))
    assert twice.books[0].tolist() == [[1024], [1024], [2048]]
    assert sorted((r.id or 0, r.code.hex(), r.error) for r in twice.rows.collect()) == [(0, "02" * 8, 0), (4, "00" * 8, 0), (4, "00" * 8, 0)]
    for wrong in ([(1, [0.5] * 9, 1)], [(1, [0.5] * 8, 1), (2, [0.5] * 16, 1)]):
        with pytest.raises(ValueError, match="length"):
            vector_codes.compress(spark.createDataFrame(wrong, kind))
