"""Product codes of vectors: codebooks by ball k-means in whole numbers.

A vector's components are scaled and floored, and cut into equal parts; every part position has a codebook.
In each round a part starts from the entry it had. An entry's parts are a ball; its radius, the farthest part,
decides which entries are neighbours: those whose half distance is within the ball. Parts nearer than half the
distance to the nearest neighbour are the stable core and keep their entry without another look. The rest lie in
rings between the half distances of one neighbour and the next, and a part of the t-th ring is compared with
the first t neighbours only. Where an entry has not moved, only neighbours that have are looked at. All bounds
are compared as squares of whole numbers, so the codes equal those of a full search, ties included.

Spark holds a row per vector with its codes. A round is one pass over the rows, in blocks of numpy arrays: each
task adds up its parts by entry, those sums (a number for each entry and component) are added up over the
cluster, and the new codebooks go out with the next pass. Every round's rows are a written table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import BROADCAST_ROWS, drop, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows of a block of numpy arrays.
BLOCK = 1 << 13
#: The largest scaled component: squared distances of 512 of them fit in 64 bits.
MOST = 1 << 26


@dataclass
class Codes:
    """Rows with their codes, and the codebooks (part, entry, position)."""

    rows: DataFrame
    books: np.ndarray

    def sha256(self) -> str:
        """Of all components as decimals, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def assign(x: np.ndarray, old: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (ties to the lower index) and squared distance, from the entries that the parts had.

    ``moved`` says which entries differ from those that gave the old codes; all are true if the codes are a guess.
    """
    between = ((book[:, None] - book[None]) ** 2).sum(axis=2)
    code, nearest = old.copy(), np.zeros(len(x), np.int64)
    for i in range(len(book)):
        ball = np.flatnonzero(old == i)
        if not len(ball):
            continue
        own = _squares(x[ball] - book[i])
        order = np.argsort(-own)
        ball, own = ball[order], own[order]
        low, choice = own.copy(), np.full(len(ball), i, np.int64)
        near = [j for j in np.argsort(between[i], kind="stable").tolist() if j != i and between[i, j] <= 4 * own[0] and (moved[i] or moved[j])]
        for j in near:
            ring = int(np.searchsorted(-4 * own, -between[i, j], side="right"))  # parts at or beyond the half distance
            d = _squares(x[ball[:ring]] - book[j])
            better = (d < low[:ring]) | (d == low[:ring]) & (j < choice[:ring])
            low[:ring][better] = d[better]
            choice[:ring][better] = j
        code[ball], nearest[ball] = choice, low
    return code, nearest


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def whole_numbers(column: pa.Array, length: int, scale: int) -> np.ndarray:
    """(rows, length) floors of scaled components; other lengths and components beyond ``MOST`` are errors."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(x) != len(column) * length or (np.diff(column.offsets.to_numpy()) != length).any():
        raise ValueError(f"vectors differ in length (the least id has {length} components)")
    if len(x) and np.abs(x).max() > MOST:
        raise ValueError(f"components beyond {MOST} after scaling: their squared distances don't fit in 64 bits")
    return x.astype(np.int64).reshape(len(column), length)


def _pass(batches: Iterator[pa.RecordBatch], first: bool, books: np.ndarray, moved: np.ndarray, scale: int) -> Iterator[pa.RecordBatch]:
    """Rows with their new codes and errors; at the end the task's sums and counts by part, entry and position."""
    parts, entries, width = books.shape
    sums, counts, like = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64), None
    for batch in _blocks(batches):
        id_, label, vector = (batch.column(i) for i in range(3))
        like = (id_.type, label.type)
        if first:
            x, old = whole_numbers(vector, parts * width, scale), np.zeros((batch.num_rows, parts), np.int64)
        else:
            x = np.frombuffer(b"".join(vector.to_pylist()), np.int32).astype(np.int64).reshape(batch.num_rows, parts * width)
            old = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).astype(np.int64).reshape(batch.num_rows, parts)
        code, error = np.empty_like(old), np.zeros(batch.num_rows, np.int64)
        for p in range(parts):
            part = x[:, p * width : (p + 1) * width]
            code[:, p], d = assign(part, old[:, p], books[p], moved[p])
            error += d
            counts[p] += np.bincount(code[:, p], minlength=entries)
            order = np.argsort(code[:, p], kind="stable")
            there, starts = np.unique(code[order, p], return_index=True)
            sums[p, there] += np.add.reduceat(part[order], starts, axis=0)
        packed = [r.tobytes() for r in x.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([id_, label, pa.array(packed, pa.binary()), pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary()), pa.array(error), pa.nulls(len(error), pa.list_(pa.int64()))], names=NAMES)
    if like:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, like[0]), pa.nulls(1, like[1]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([np.concatenate((sums.ravel(), counts.ravel()))], pa.list_(pa.int64()))], names=NAMES)


NAMES = ["id", "label", "q", "code", "error", "sums"]


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """(id, label, q, code, error) of every vector, and the codebooks.

    ``q`` are the scaled components (32 bits each), ``code`` has a byte for each part, ``error`` is the squared
    distance to what the code stands for. Vectors that are null or hold null or non-finite components are left
    out. Codebooks start as the parts of the least ids (null last, equal ids by vector); fewer vectors than
    entries give shorter ones, none give no rows. Repeated rows and equal entries count as they are. All lengths
    must be the same multiple of ``parts``; other columns are ignored.
    """
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.filter(fine).select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    length = len(seeds[0].vector) if seeds else 0
    if entries > 256:
        raise ValueError("a part's code is one byte")
    if length % parts or any(len(r.vector) != length for r in seeds):
        raise ValueError(f"vectors need one length that {parts} divides")
    x = whole_numbers(pa.array([r.vector for r in seeds], pa.list_(pa.float64())), length, scale)
    books = np.ascontiguousarray(x.reshape(len(seeds), parts, length // parts).transpose(1, 0, 2))
    moved = np.ones(books.shape[:2], bool)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"id {kinds['id']}, label {kinds['label']}, q binary, code binary, error long, sums array<long>"
    state = None
    for r in range(rounds + 1):
        source = rows if state is None else state.filter("sums is null").select("id", "label", "q", "code")
        last, state = state, written(source.mapInArrow(lambda it, first=state is None, books=books, moved=moved: _pass(it, first, books, moved, scale), schema), "codes")
        if last is not None:
            drop(last)
        if r == rounds or not seeds:
            break
        total = np.zeros(books.size + books.shape[0] * books.shape[1], np.int64)
        for pos, sum_ in state.filter("sums is not null").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col")).collect():
            total[pos] = sum_
        sums, counts = total[: books.size].reshape(books.shape), total[books.size :].reshape(books.shape[:2])
        new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        moved, books = (new != books).any(axis=2), new
    return Codes(state.filter("sums is null").drop("sums"), books)


def approximate(codes: Codes, vector: str = "approximation", scale: int = SCALE) -> DataFrame:
    """The rows with the vectors that their codes stand for (array<double>), from the codebooks as a literal."""
    books = F.array(*(F.array(*(F.array(*(F.lit(float(v) / scale) for v in entry)) for entry in part)) for part in codes.books.tolist()))
    at = F.transform(F.sequence(F.lit(1), F.lit(len(codes.books))), lambda p: F.conv(F.hex(F.substring("code", p, F.lit(1))), 16, 10).cast("int"))
    return codes.rows.withColumn(vector, F.flatten(F.zip_with(books, at, lambda part, i: F.element_at(part, i + 1))))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings, with the errors of their labels (null labels together) and the codebooks' digest.

    Null vectors and those with null or non-finite components are left out; an empty table gives no rows; a null
    id is an id like others; repeated rows stay repeated; other columns are ignored.
    """
    codes = compress(table(spark, sf_dir, "embeddings"))
    of_label = written(codes.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    of_label = F.broadcast(of_label) if of_label.count() <= BROADCAST_ROWS else of_label
    found = codes.rows.join(of_label, F.col("label").eqNullSafe(F.col("of")), "left")
    return found.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


def _oracle() -> str:
    """Full search in SQL: a table of codes and one of entries for each round."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} as materialized (
    select s, p, arg_min(e, (d, e)) as e, min(d) as d
    from (select x.s, x.p, b.e, list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from x join b{r} b using (p)) group by s, p)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} as (
    select p, e, list((c - ((c % n) + n) % n) // n order by i) as part
    from (select p, e, i, sum(c)::bigint as c, count(*) as n from (select a.p, a.e, unnest(x.part) as c, unnest(range(len(x.part))) as i from a{r} a join x using (s, p)) group by p, e, i) group by p, e),
b{r + 1} as materialized (select b.p, b.e, coalesce(m.part, b.part) as part from b{r} b left join m{r} m using (p, e))""")
    return f"""
with v as materialized (
    select row_number() over (order by vec_id nulls last, embedding) as s, vec_id, label, list_transform(embedding, lambda y: floor({SCALE} * y::double)::bigint) as q
    from embeddings where embedding is not null and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0),
x as materialized (select s, p, q[p * (len(q) // {PARTS}) + 1 : (p + 1) * (len(q) // {PARTS})] as part from v, (select unnest(range({PARTS})) as p)),
b0 as materialized (select p, s - 1 as e, part from x where s <= {ENTRIES}),{",".join(steps)},
c as (select s, string_agg(printf('%02x', e::int), '' order by p) as code, sum(d)::bigint as error from a{ROUNDS} group by s),
h as (select sha256(string_agg(array_to_string(part, ','), ',' order by p, e)) as codebooks_sha256 from b{ROUNDS})
select v.vec_id, c.code, c.error, sum(c.error) over (partition by v.label)::bigint as label_error, h.codebooks_sha256 from v join c using (s), h
"""


ORACLE_OP12 = _oracle()
