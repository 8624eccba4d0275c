"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations.

A vector is padded to a power of two, and turned by three rounds of random signs and Walsh-Hadamard
transforms. Its hash is the nearest vertex of the cross-polytope: the largest coordinate and its sign.
``parts`` of these make a code; their number grows with the largest label, so buckets keep their size.
In every table a vector is stored in the bucket of its code and also probes the bucket of the next best
code when that is nearly as close. Candidates are pairs of one bucket of which one is stored there.
Longer codes meet less often, so the number of tables grows with ``parts`` and the vectors' length: random
pairs at the threshold itself are hashed, and there are as many tables as keep their miss rate under ``MISS``.

Equal vectors of a label are one class first. Within a bucket, similarities are computed in blocks; a
pair that several tables find is counted in the first of them only, and instead of pairs a block gives
each vector's number of links and the links of a spanning forest. A bucket of more than ``BLOCK`` vectors
is dealt out as pairs of its blocks, so it is spread over tasks and no vector is left out.

Vectors travel as 16-bit integers with a bound of their rounding error. The few pairs whose similarity
is closer to the threshold than their bound are looked up and computed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .store import drop, small_batches, table, written

TABLES, BLOCK, NEAR = 5, 2048, 0.75
#: Vectors that a bucket of evenly spread vectors should hold at most.
BUCKET_ROWS = 400
#: Share of the pairs at the threshold that all tables together may miss.
MISS = 0.001


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def codes(x: np.ndarray, tables: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, tables) of stored codes and of probed codes (equal to the stored one if none is near)."""
    size = 1 << max(1, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    stored, probed = np.zeros((len(x), tables), np.int64), np.zeros((len(x), tables), np.int64)
    row = np.arange(len(x))
    for t in range(tables):
        best, other = np.zeros(len(x), np.int64), np.zeros((parts, len(x)), np.int64)
        ratio, place = np.full((parts, len(x)), -1.0), []
        for p in range(parts):
            signs = np.random.default_rng(1000 * t + p).choice([-1.0, 1.0], (3, size))
            y = x
            for s in signs:
                y = hadamard(y * s)
            size_of = np.abs(y)
            first = size_of.argmax(axis=1)
            top = size_of[row, first]
            size_of[row, first] = -1
            second = size_of.argmax(axis=1)
            ratio[p] = size_of[row, second] / np.maximum(top, 1e-300)
            place.append(2 * first + (y[row, first] < 0))
            other[p] = 2 * second + (y[row, second] < 0)
        for p in range(parts):
            best = best * 2 * size + place[p]
        swap = ratio.argmax(axis=0)
        probe = np.zeros(len(x), np.int64)
        for p in range(parts):
            probe = probe * 2 * size + np.where(swap == p, other[p], place[p])
        stored[:, t], probed[:, t] = best, np.where(ratio.max(axis=0) >= NEAR, probe, best)
    return stored, probed


@cache
def tables_for(bits: int, parts: int, least: float) -> int:
    """Tables that keep the miss rate of pairs at cosine ``least`` under ``MISS`` (three standard errors to the safe side)."""
    g, length, pairs, tried = np.random.default_rng(17), 1 << bits, 1000, 4
    x, y = g.normal(size=(2, pairs, length))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(axis=1)[:, None] * x
    y /= np.maximum(np.linalg.norm(y, axis=1), 1e-300)[:, None]
    (px, qx), (py, qy) = codes(x, tried, parts), codes(least * x + np.sqrt(max(0.0, 1 - least * least)) * y, tried, parts)
    missed = 1 - ((px == py) | (px == qy) | (qx == py)).mean()
    missed = min(0.99, missed + 3 * np.sqrt(missed * (1 - missed) / (pairs * tried)))
    return max(TABLES, int(np.ceil(np.log(MISS) / np.log(max(missed, 1e-9)))))


def _unit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Usable vectors: their bytes, unit vectors in 16 bits with scale and error, and all else they need."""
    for frame in frames:
        raw = [None if v is None else np.asarray(v, dtype=np.float64) for v in frame["v"]]
        ok = [v is not None and len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any()) for v in raw]
        rows = []
        for v, i, label in zip(raw, frame["id"], frame["label"], strict=True):
            if not ok[len(rows)]:
                rows.append(None)
                continue
            u = v / np.abs(v).max()
            u /= np.linalg.norm(u)
            scale = np.abs(u).max() / 32767
            q = np.round(u / scale).astype(np.int16)
            rows.append((i, label, v.tobytes(), q.tobytes(), scale, float(np.linalg.norm(u - q * scale)) + 1e-12))
        yield pd.DataFrame([r for r in rows if r], columns=["id", "label", "exact", "q", "scale", "error"])


def _coded(frames: Iterator[pd.DataFrame], parts: int, by_bits: dict[int, int]) -> Iterator[pd.DataFrame]:
    """Add the vectors' length, their stored and probed codes of all tables, and all of these as bytes, table by table.

    The bytes take four a code where that holds every code, else eight.
    """
    for frame in frames:
        for length, own in frame.groupby(frame["q"].map(len)):
            x = np.frombuffer(b"".join(own["q"]), np.int16).reshape(len(own), -1) * own["scale"].to_numpy()[:, None]
            bits = max(1, int(x.shape[1] - 1).bit_length())
            stored, probed = codes(x, by_bits[bits], parts)
            pairs = np.stack((stored, probed), axis=2).astype(np.uint32 if (bits + 1) * parts <= 32 else np.int64)
            where = [pairs[i].tobytes() for i in range(len(own))]
            yield own.assign(length=length, stored=list(stored), probed=list(probed), codes=where)


def _block_links(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links between the vectors of one bucket (side 0), or between two of its blocks (sides 0 and 1).

    Rows: (id, links, root) of linked vectors, and (id, null, other) for pairs to be looked up.
    """
    t = int(frame["t"].iloc[0])

    def part(own):
        x = np.frombuffer(b"".join(own["q"]), np.int16).reshape(len(own), -1) * own["scale"].to_numpy()[:, None]
        wide = len(own) and len(own["codes"].iloc[0]) > 8 * (t + 1)
        c = np.frombuffer(b"".join(own["codes"]), np.int64 if wide else np.uint32).reshape(len(own), t + 1, 2)
        return x, c, own["error"].to_numpy(), own["id"].to_numpy(np.int64), own["n"].to_numpy(np.int64), own["stored"].to_numpy(bool)

    left = part(frame[frame["side"] == 0])
    right = part(frame[frame["side"] == 1]) if (frame["side"] == 1).any() else None
    if right is None and bool((frame["cross"]).any()):
        right = tuple(x[:0] for x in left)
    ids = np.unique(frame["id"].to_numpy(np.int64))
    parent, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    doubtful = []

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    y, cy, ey, iy, ny, sy = left if right is None else right
    for a in range(0, len(left[0]), 256):
        x, cx, ex, ix, nx, sx = (v[a : a + 256] for v in left)
        cosine, slack = x @ y.T, ex[:, None] + ey[None, :] + 1e-9
        maybe = cosine >= least - slack
        i, j = np.nonzero(maybe)
        keep = (sx[i] | sy[j]) & (ix[i] != iy[j])
        if right is None:
            keep &= ix[i] < iy[j]
        i, j = i[keep], j[keep]
        # not where an earlier table has found the pair already, and once where it meets twice in this one
        px, qx, py, qy = cx[i, :, 0], cx[i, :, 1], cy[j, :, 0], cy[j, :, 1]
        met = (px == py) | (px == qy) | (qx == py)
        twice = ~(sx[i] & sy[j]) & ((px[:, t] == py[:, t]) | (px[:, t] == qy[:, t]) & (qx[:, t] == py[:, t]) & (sx[i] == (ix[i] < iy[j])))
        fresh = ~met[:, :t].any(axis=1) & ~twice
        i, j = i[fresh], j[fresh]
        sure = cosine[i, j] >= least + slack[i, j]
        doubtful.append(np.stack((ix[i[~sure]], iy[j[~sure]]), axis=1))
        i, j = i[sure], j[sure]
        pi, pj = np.searchsorted(ids, ix[i]), np.searchsorted(ids, iy[j])
        np.add.at(links, pi, ny[j])
        np.add.at(links, pj, nx[i])
        # a forest is enough: skip links inside a tree
        for u, v in np.unique(np.stack((pi, pj), axis=1), axis=0).tolist() if len(pi) < 4096 else _forest(pi, pj, len(ids)):
            ru, rv = root(u), root(v)
            if ru != rv:
                parent[max(ru, rv)] = min(ru, rv)
    doubtful = np.concatenate(doubtful) if doubtful else np.zeros((0, 2), np.int64)
    roots = np.array([root(i) for i in range(len(ids))], np.int64)
    some = links > 0
    return pd.DataFrame({"id": np.concatenate((ids[some], doubtful[:, 0])), "links": pd.array([*links[some], *[None] * len(doubtful)], dtype="Int64"), "other": np.concatenate((ids[roots[some]], doubtful[:, 1]))})


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list:
    """Links (member, smallest label) of the components of many links, by vectorised label spreading."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(n))
    return list(zip(own.tolist(), label[own].tolist(), strict=True))


def _exact(frames: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    for frame in frames:
        keep = []
        for x, y in zip(frame["va"], frame["vb"], strict=True):
            a, b = np.frombuffer(x, np.float64), np.frombuffer(y, np.float64)
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            keep.append(len(a) == len(b) and float(a @ b) / float(np.sqrt(a @ a) * np.sqrt(b @ b)) >= least)
        yield frame.loc[keep, ["a", "b", "na", "nb"]]


def linked_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93) -> DataFrame:
    """Link vectors of one non-null label with cosine >= ``least``.

    Returns (vec_id, n_links, component_id, kept). Null, empty and zero vectors, vectors with null or
    non-finite components and null labels link with nothing; vectors of different lengths don't link.
    Rows with a null id are left out of linking; rows that repeat an id and its vector count as one, with other
    vectors the id has the most links that any has. Vectors of any length are taken whole; no rows give none. Other columns
    are ignored, whatever their names. Ids are whole numbers, or texts of them; any other id is an error under ANSI mode.
    """
    small_batches(rows.sparkSession, 2000)
    base = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    usable = base.filter("id is not null and label is not null and v is not null").filter(~F.exists("v", lambda c: c.isNull()))
    units = usable.mapInPandas(_unit, "id long, label string, exact binary, q binary, scale double, error double")
    units = written(units.withColumn("same", F.sha2("exact", 256)).dropDuplicates(["id", "label", "same"]), "units")
    equal = units.groupBy("label", "same").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    equal = written(equal.filter("n > 1"), "equal")
    named = units.join(equal, ["label", "same"], "left").withColumns({"rep": F.coalesce("rep", "id"), "n": F.coalesce("n", F.lit(1))})
    member = written(named.select("id", "rep", "n"), "members")
    reps = written(named.filter("id = rep").drop("same", "rep"), "reps")
    drop(units, equal)
    largest = reps.groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.max(F.length("q")).alias("b")).agg(F.max("m"), F.max("b")).first()
    vertices, parts = max(4, largest[1] or 4), 1
    while (largest[0] or 0) / vertices**parts > BUCKET_ROWS and parts < 4:
        parts += 1
    by_bits = {r[0]: tables_for(r[0], parts, least) for r in reps.select(F.length(F.bin(F.expr("length(q) div 2 - 1")))).distinct().collect()}
    kept = "label string, id long, n long, q binary, scale double, error double, length int, stored array<long>, probed array<long>, codes binary"
    coded = written(reps.select("label", "id", "n", "q", "scale", "error").mapInPandas(lambda it: _coded(it, parts, by_bits), kept), "coded")

    def entries(*columns: str) -> DataFrame:
        """A row for every table and stored code, and one for every probed code that differs; ``codes`` are those up to this table."""
        own = coded.select("*", F.posexplode(F.arrays_zip("stored", "probed")).alias("t", "code"))
        own = own.withColumn("codes", F.expr("substring(codes, 1, (t + 1) * int(length(codes) div size(stored)))")).select("label", "length", "t", "code", *columns)
        both = F.explode(F.array(F.struct(F.col("code.stored").alias("code"), F.lit(True).alias("stored")), F.struct(F.col("code.probed").alias("code"), F.lit(False).alias("stored"))))
        found = own.withColumn("at", both).filter("at.stored or code.stored <> code.probed")
        return found.select("label", "length", "t", "at.code", "at.stored", *columns)

    bucket = ["label", "length", "t", "code"]
    large = written(entries().groupBy(*bucket).count().filter(F.col("count") > BLOCK).select(*bucket, F.ceil(F.col("count") / BLOCK).cast("int").alias("k")), "large")
    dealt = entries("id", "n", "q", "scale", "error", "codes").join(large, bucket, "left").withColumn("own", F.when(F.col("k").isNotNull(), F.pmod(F.xxhash64("id"), F.col("k")).cast("int")).otherwise(0))
    others = F.when(F.col("k").isNotNull(), F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array(F.lit(0)))
    dealt = dealt.withColumn("with", F.explode(others)).select("*", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"))
    dealt = dealt.withColumn("side", (F.col("own") != F.col("i")).cast("int")).withColumn("cross", F.col("i") != F.col("j")).drop("own", "with", "k")
    found = written(dealt.groupBy(*bucket, "i", "j").applyInPandas(lambda f: _block_links(f, least), "id long, links long, other long"), "found")
    pairs = found.filter("links is null").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    exact = reps.select("id", "exact", "n")
    pairs = pairs.join(exact.toDF("a", "va", "na"), "a").join(exact.toDF("b", "vb", "nb"), "b").mapInPandas(lambda it: _exact(it, least), "a long, b long, na long, nb long")
    pairs = written(pairs, "pairs")
    drop(coded, large, reps)
    counts = found.filter("links is not null").select("id", "links").unionAll(pairs.select("a", "nb")).unionAll(pairs.select("b", "na")).groupBy("id").agg(F.sum("links").alias("links"))
    linked = components(found.filter("links is not null").select("id", "other").unionAll(pairs.select("a", "b")), "id", "other")
    info = member.join(counts.withColumnRenamed("id", "rep"), "rep", "left").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    info = info.select("id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    info = info.groupBy("id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    out = base.select("id").join(info, "id", "left").select(F.col("id").alias(vec_id), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(vec_id) == F.col("component_id"), F.lit(True)))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings of equal labels at cosine 0.93 or more."""
    return linked_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_OP5 = """
with recursive v as (select vec_id, label, embedding::double[] as x from embeddings),
u as (select * from v where label is not null and len(x) > 0 and len(list_filter(x, lambda y: y is null or not isfinite(y))) = 0 and len(list_filter(x, lambda y: y <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.93),
r as (select a as s, b as t from l union select r.s, l.b from r join l on l.a = r.t),
n as (select a as vec_id, count(*) as n from l group by a),
m as (select s as vec_id, min(t) as least from r group by s)
select v.vec_id, coalesce(n.n, 0)::bigint as n_links, least(v.vec_id, coalesce(m.least, v.vec_id)) as component_id, v.vec_id <= coalesce(m.least, v.vec_id) as kept
from v left join n using (vec_id) left join m using (vec_id)
"""
