"""Near-duplicate documents: MinHash bands, odd-sketch filter, exact confirmation on full sets.

1. Each document becomes its set of distinct word shingles (64-bit hashes). Equal sets form one class,
   whose smallest document stands for it; from here on only these representatives travel.
2. Band keys of a representative are hashes of ``rows`` of its MinHash values each. In every bucket the
   members are linked to the bucket's smallest member; those that a confirmed link already joins to it
   need no further comparison, so a bucket of copies costs as many pairs as it has members. Twice more,
   the smallest member of another component leads the members outside of it.
3. Bucket members of different components that are left are then all compared by sketch, in blocks, so no
   candidate pair of different components is left out.
4. A candidate pair's odd sketches (parity bitmaps of the MinHash samples) estimate its similarity from
   the population count of their XOR; pairs far below the threshold go. A parity bitmap of the whole set
   bounds the difference of two sets from below, so pairs that differ in more than the threshold allows
   go without loss. The others are confirmed by intersecting the full sets.

With 32 bands of 8 rows a pair at similarity 0.85 is missed with probability 4e-5 (at 0.9: 1e-8).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .memory import give_back, tidied
from .store import drop, semi, small_batches, table, written
from .words import Words, canonical, mix, sequence_hash, slices

BANDS, ROWS, SKETCH_BITS = 32, 8, 1024
LEADER_ROUNDS, BLOCK = 2, 1024
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_SHIFTS = mix(np.arange(5001, 5001 + BANDS * ROWS, dtype=np.uint64)).astype(np.uint32)
_SET = "id long, n_shingles long, low long, high long, bands array<long>, sketch binary, parity binary"


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    for lo, hi in slices(texts):
        words = Words(texts[lo:hi])
        at, h = words.windows(size)
        doc = words.doc[at]
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, bool)
        doc, h = doc[new], h[new]
        cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            n = words.counts[i]
            if 0 < n < size:
                mine = words.hash[words.first[i] : words.first[i + 1]]
                yield sequence_hash([mine[j : j + 1] for j in range(n)])
            else:
                yield h[cuts[i] : cuts[i + 1]]


def _min_hash(hashes: np.ndarray) -> np.ndarray:
    low = np.full(len(_FACTORS), np.iinfo(np.uint32).max, np.uint32)
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    y = hashes.astype(np.uint32)
    for i in range(0, len(x), 512):
        block = x[i : i + 512, None] * _FACTORS + _SHIFTS
        block ^= block >> np.uint32(15)
        block *= np.uint32(0x2C1B3C6D)
        block += y[i : i + 512, None]
        block ^= block >> np.uint32(13)
        block *= np.uint32(0x297A2D39)
        np.minimum(low, block.min(axis=0), out=low)
    return low


def _parity(members: np.ndarray) -> bytes:
    place = mix(members) % np.uint64(SKETCH_BITS)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def _odd_sketch(low: np.ndarray) -> bytes:
    return _parity(low.astype(np.uint64) + (np.arange(len(low), dtype=np.uint64) << np.uint64(32)))


def _bits(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def _near_enough(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Parity bitmaps of whole sets differ in no more bits than the sets in members: true wherever the threshold can hold."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) * (100 + percent) <= sizes * (100 - percent)


def _describe(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    band = np.arange(BANDS, dtype=np.uint64)
    for frame in frames:
        rows = []
        for doc, hashes in zip(frame["id"], shingle_sets([canonical(t, lower=True) for t in frame["text"]], size), strict=True):
            if not len(hashes):
                rows.append((doc, 0, None, None, None, None, None))
                continue
            low, n = _min_hash(hashes), np.uint64(len(hashes))
            keys = sequence_hash([band, *low.reshape(BANDS, ROWS).T.astype(np.uint64)])
            both = [int(mix(np.atleast_1d(np.bitwise_xor.reduce(mix(hashes + np.uint64(s))) + n)).view(np.int64)[0]) for s in (3, 11)]
            rows.append((doc, len(hashes), *both, keys.view(np.int64), _odd_sketch(low), _parity(hashes)))
        yield pd.DataFrame(rows, columns=["id", "n_shingles", "low", "high", "bands", "sketch", "parity"]).astype({"n_shingles": "int64", "low": "Int64", "high": "Int64"})


def _likely(frames: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Pairs whose odd sketches estimate a similarity that may reach the threshold."""
    samples = BANDS * ROWS
    for frame in frames:
        if not len(frame):
            continue
        odd = np.bitwise_count(_bits(frame["sa"]) ^ _bits(frame["sb"])).sum(axis=1).astype(float)
        differ = -SKETCH_BITS / 2 * np.log(np.maximum(1e-9, 1 - 2 * odd / SKETCH_BITS))
        near = _near_enough(_bits(frame["pa"]), _bits(frame["pb"]), (frame["na"] + frame["nb"]).to_numpy(), percent)
        yield frame.loc[near & (1 - differ / (2 * samples) >= percent / 100 - 0.15), ["a", "b"]]


def _sets(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"id": frame["id"], "hashes": [h.tobytes() for h in shingle_sets([canonical(t, lower=True) for t in frame["text"]], size)]})


def _confirmed(frames: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        keep = []
        for x, y in zip(frame["ha"], frame["hb"], strict=True):
            p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= percent * (len(p) + len(q) - both))
        yield frame.loc[keep, ["a", "b"]]


def _links(pairs: DataFrame, reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of representatives whose full sets are similar enough."""
    sketch = [reps.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}"), F.col("parity").alias(f"p{c}"), F.col("n_shingles").alias(f"n{c}")) for c in "ab"]
    likely = written(pairs.join(sketch[0], "a").join(sketch[1], "b").mapInPandas(lambda it: tidied(_likely(it, percent)), "a long, b long").distinct(), "likely")
    wanted = written(likely.select(F.col("a").alias("id")).unionAll(likely.select("b")).distinct(), "wanted")
    sets = written(semi(docs, wanted, "id").mapInPandas(lambda it: tidied(_sets(it, size)), "id long, hashes binary"), "sets")
    full = likely.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a").join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b")
    links = written(full.mapInPandas(lambda it: tidied(_confirmed(it, percent)), "a long, b long").distinct(), "links")
    drop(likely, wanted, sets)
    return links


def _placed(shared: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket members with the component that the links so far give them."""
    joined = components(links, "a", "b").select(F.col("node").alias("id"), F.col("component").alias("own"))
    placed = written(shared.select("key", "id").join(joined, "id", "left").select("key", "id", F.coalesce("own", "id").alias("own")), "placed")
    drop(joined)
    return placed


def _compared(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Likely pairs of different components in one bucket, or between two of its blocks."""
    left, right = frame[frame["side"] == 0], frame[frame["side"] == (1 if frame["cross"].any() else 0)]
    pick = lambda f: (*(f[c].to_numpy(np.int64) for c in ("id", "own", "n_shingles")), _bits(f["sketch"]), _bits(f["parity"]), np.array(f["bands"].tolist(), np.int64).reshape(len(f), BANDS))
    (i, p, n, x, s, u), (j, q, m, y, t, v) = pick(left), pick(right)
    key = int(frame["key"].iloc[0])
    out = [np.zeros((0, 2), np.int64)]
    limit = SKETCH_BITS / 2 * (1 - np.exp(-4 * BANDS * ROWS * (1.08 - percent / 100) / SKETCH_BITS))
    for at in range(0, len(i), 64):
        odd = np.bitwise_count(x[at : at + 64, None] ^ y[None]).sum(axis=2, dtype=np.int32) if len(y) else np.zeros((len(x[at : at + 64]), 0))
        a, b = np.nonzero((odd <= limit) & (p[at : at + 64, None] != q[None]))
        near = _near_enough(s[at : at + 64][a], t[b], n[at : at + 64][a] + m[b], percent)
        a, b = a[near], b[near]
        same = u[at : at + 64][a] == v[b]  # a pair counts in the first bucket that it shares
        fresh = v[b, same.argmax(axis=1)] == key
        a, b = a[fresh], b[fresh]
        both = np.stack((i[at : at + 64][a], j[b]), axis=1)
        out.append(both if frame["cross"].any() else both[both[:, 0] < both[:, 1]])
    both = np.sort(np.concatenate(out), axis=1)
    del left, right, x, y, s, t, u, v, out
    give_back()
    return pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})


def _left_pairs(placed: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of bucket members that are still in different components and whose sketches are close.

    Comparing is done in blocks of bit maps; a large bucket is dealt out as pairs of its blocks.
    """
    apart = placed.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k")).filter("low < high")
    rows = placed.join(apart.select("key", "k"), "key").join(reps.select("id", "n_shingles", "sketch", "parity", "bands"), "id")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("k")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("key", "id", "own", "n_shingles", "sketch", "parity", "bands", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "mine")
    rows = rows.withColumns({"side": (F.col("mine") != F.col("i")).cast("int"), "cross": F.col("i") != F.col("j")}).drop("mine")
    return rows.groupBy("key", "i", "j").applyInPandas(lambda f: _compared(f, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 85) -> DataFrame:
    """Link documents whose shingle sets have 100 * intersection >= percent * union; percent is 85 or more
    for the stated recall (at 80 a pair at the threshold is missed with probability 0.003).

    Returns (doc_id, n_shingles, component_id, kept): component_id is the smallest doc_id reachable over
    links, kept marks it. Null, empty and wordless texts have an empty set and are linked with nothing.
    A row with a null id keeps its size, has a null component and is kept. Rows that repeat an id count
    as one document with the links of each of its texts; all carry its component. Texts of any length are
    taken whole, no rows give none. Other columns are ignored. Ids are whole numbers, or texts of them; any
    other id is an error under ANSI mode.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    described = written(rows.mapInPandas(lambda it: tidied(_describe(it, size)), _SET), "described")
    sizes = written(described.select("id", "n_shingles"), "sizes")
    usable, own = described.filter("id is not null and n_shingles > 0"), ["low", "high", "n_shingles"]
    equal = written(usable.groupBy(own).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "equal")
    named = usable.join(equal, own, "left").withColumn("rep", F.coalesce("rep", "id"))
    member = written(named.filter("id <> rep").select("id", "rep").distinct(), "members")
    reps = written(named.filter("id = rep").drop("rep"), "reps")
    several = written(usable.select("id", *own).distinct().groupBy("id").count().filter("count > 1").select("id"), "several")
    same = written(semi(named, several, "id").select(F.col("id").alias("a"), F.col("rep").alias("b")), "same")
    drop(described, equal, several)
    entries = reps.select("id", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).filter("leader < last").select("key", "leader")
    buckets = written(buckets, "buckets")
    shared = written(entries.join(buckets, "key"), "shared")
    texts = rows.filter("id is not null")
    links = _links(shared.filter("id > leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), reps, texts, size, percent)
    placed = _placed(shared, links)
    drop(shared, buckets)
    for _ in range(LEADER_ROUNDS):  # the smallest member of another component leads next
        apart = placed.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low < high").select("key", "low")
        apart = written(placed.join(apart, "key"), "apart")
        leader = apart.filter("own > low").groupBy("key").agg(F.min(F.struct("own", "id")).alias("led"))
        pairs = apart.join(leader, "key").filter("own <> led.own").select(F.least("id", "led.id").alias("a"), F.greatest("id", "led.id").alias("b"))
        more = _links(pairs.distinct(), reps, texts, size, percent)
        last, links = (links, placed, apart, more), written(links.unionAll(more), "links")
        placed = _placed(placed, links)
        drop(*last)
    second = _links(_left_pairs(placed, reps, percent), reps, texts, size, percent)
    drop(placed, reps)
    linked = components(links.unionAll(second).unionAll(same), "a", "b")
    drop(links, second, same)
    linked = linked.withColumnRenamed("node", "rep")
    ids = member.join(linked, "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    ids = ids.unionAll(linked.select("rep", "component")).groupBy("id").agg(F.min("component").alias("component"))
    out = sizes.join(ids, "id", "left").select(F.col("id").alias(doc_id), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(True)))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of all documents: three-word shingles, similarity 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_OP6 = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then []::varchar[] when len(ws) < 3 then [array_to_string(ws, ' ')] else list_distinct(list_transform(range(1, len(ws) - 1), lambda p: array_to_string(ws[p:p+2], ' '))) end as sh from w),
k as (select doc_id, len(sh) as n, list_sort(list_transform(sh, lambda x: hash(x))) as hs from s),
c as (select hs, any_value(n) as n, min(doc_id) as rep from k where n > 0 group by hs),
e as (select rep, n, unnest(hs) as h from c),
f as (select h from e group by h having count(*) > 1),
j as (select x.rep as a, y.rep as b, x.n as na, y.n as nb, count(*) as common from e x join f using (h) join e y using (h) where x.rep < y.rep and 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) group by all),
l as (select a, b from j where 100 * common >= 85 * (na + nb - common)),
d as (select a as u, b as v from l union select b, a from l),
r as (select u, v from d union select r.u, d.v from r join d on r.v = d.u),
m as (select u as rep, min(v) as least from r group by u)
select k.doc_id, k.n::bigint as n_shingles, coalesce(least(m.least, c.rep), c.rep, k.doc_id) as component_id, k.doc_id = coalesce(least(m.least, c.rep), c.rep, k.doc_id) as kept
from k left join c on k.hs = c.hs and k.n > 0 left join m using (rep)
"""
