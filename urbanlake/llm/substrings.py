"""Substring dedup by super-k-mer partitioning.

Every window of ``k`` words has a minimiser: the smallest hash of its runs of ``m`` words. Consecutive
windows with the same minimiser form a super-k-mer, a run of words that travels as one packed string to
the bucket of that minimiser, so equal windows always meet. In the bucket the distinct strings are cut
into windows again, the windows are sorted, and each run of equal windows gives the smallest document
that holds it.

Windows are counted by minimiser first. Those of a minimiser with more than ``HEAVY`` windows are dealt by a
longer minimiser as well, and where that is still too many by their own hash, so no bucket is bound to hold
all windows of a frequent pair of words.

Within a map batch equal strings (a passage that many documents share) are packed once, with the list of
places they came from, before anything is shuffled; a place takes 16 bytes before compression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .memory import give_back, tidied
from .store import semi, small_batches, table, written
from .words import Words, canonical, mix, sequence_hash, slices

#: Bytes of packed strings that a bucket should hold.
BUCKET_BYTES = 8 << 20
#: Bytes of packed strings that a map task gathers before it ships them.
GATHER_BYTES = 16 << 20
#: Windows of one minimiser beyond which they are dealt out further.
HEAVY = 1_000_000
#: A place is a word's number in its text, and above these bits the number of the text among those of its id.
PART = 40


def _minimisers(words: Words, at: np.ndarray, k: int, m: int) -> np.ndarray:
    """Smallest hash of the runs of ``m`` words in each window of ``k`` words that begins at ``at``."""
    runs = sequence_hash([words.hash[j : len(words.hash) - m + 1 + j] for j in range(m)], 7)
    width, low, step = k - m + 1, runs, 1
    while step < width:  # sliding minimum by doubling
        jump = min(step, width - step)
        low = np.minimum(low[: len(low) - jump], low[jump:])
        step += jump
    return low[at]


def _window_keys(words: Words, k: int, m: int, heavy: Sequence[np.ndarray]):
    """First word, key by which it is dealt and level of every window; ``heavy`` has the heavy keys of each level."""
    at, own = words.windows(k)
    if not len(at):
        return at, np.zeros(0, np.uint64), at
    key, level = _minimisers(words, at, k, m), np.zeros(len(at), np.int64)
    for deeper, keys in enumerate(heavy, 1):
        more = (level == deeper - 1) & np.isin(key, keys)
        if more.any():
            key = np.where(more, sequence_hash([key, _minimisers(words, at, k, (k + m) // 2) if deeper == 1 else own], deeper), key)
            level[more] = deeper
    return at, key, level


def _super_kmers(words: Words, k: int, m: int, heavy: Sequence[np.ndarray] = ()):
    """First word, number of windows and key of every super-k-mer."""
    at, key, _ = _window_keys(words, k, m, heavy)
    if not len(at):
        return at, at, key
    begin = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1))))
    return at[begin], np.diff(np.concatenate((begin, [len(at)]))), key[begin]


def _key_counts(frames: Iterator[pd.DataFrame], k: int, m: int, heavy: Sequence[np.ndarray]) -> Iterator[pd.DataFrame]:
    """(key, n): number of windows of each key of the deepest level."""
    for frame in frames:
        texts = [canonical(t) for t in frame["text"]]
        for lo, hi in slices(texts):
            _, key, level = _window_keys(Words(texts[lo:hi]), k, m, heavy)
            keys, n = np.unique(key[level == len(heavy)], return_counts=True)
            yield pd.DataFrame({"key": keys.view(np.int64), "n": n})


def _heavy_keys(rows: DataFrame, k: int, m: int, least: int) -> list[np.ndarray]:
    """Of minimisers, then of longer minimisers: the keys with more than ``least`` windows."""
    heavy: list[np.ndarray] = []
    for _ in range(2):
        counts = rows.select("text").mapInPandas(lambda it, known=tuple(heavy): _key_counts(it, k, m, known), "key long, n long")
        found = counts.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > least).select("key").toPandas()
        if not len(found):
            break
        heavy.append(np.sort(found["key"].to_numpy(np.int64).view(np.uint64)))
    return heavy


def _pack(frames: Iterator[pd.DataFrame], k: int, m: int, buckets: int, heavy: Sequence[np.ndarray] = ()) -> Iterator[pd.DataFrame]:
    gathered, size = [], 0
    for frame in frames:
        texts = [canonical(t) for t in frame["text"]]
        ids, part = frame["id"].to_numpy(dtype=np.int64), frame["part"].to_numpy(dtype=np.int64)
        for lo, hi in slices(texts):
            words = Words(texts[lo:hi])
            first, n, low = _super_kmers(words, k, m, heavy)
            if not len(first):
                continue
            doc = words.doc[first]
            left, right = words.start[first], words.end[first + n + k - 2]
            strings = [words.data[a:b] for a, b in zip(left.tolist(), right.tolist(), strict=True)]
            gathered.append((mix(low) % np.uint64(buckets), strings, ids[lo:hi][doc], first - words.first[doc] + (part[lo:hi][doc] << PART)))
            size += int((right - left).sum())
            if size > GATHER_BYTES:
                yield _blocks(gathered)
                gathered, size = [], 0
    if gathered:
        yield _blocks(gathered)


def _blocks(gathered: list) -> pd.DataFrame:
    """One row per bucket: its distinct strings, and number of string, document and place of each super-k-mer."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    bucket, docs, places = (np.concatenate([g[i] for g in gathered]) for i in (0, 2, 3))
    strings = [s for g in gathered for s in g[1]]
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
    rows = []
    for a, b in zip(cut, [*cut[1:], len(order)], strict=True):
        mine, seen = order[a:b], {}
        which = np.fromiter((seen.setdefault(strings[i], len(seen)) for i in mine.tolist()), dtype=np.int32, count=b - a)
        rows.append((int(bucket[mine[0]]), squeeze(b"\n".join(seen)), squeeze(which.tobytes()), squeeze(docs[mine].tobytes()), squeeze(places[mine].tobytes())))
    return pd.DataFrame(rows, columns=["bucket", "strings", "which", "docs", "places"])


def _count(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The runs of covered words of one bucket: (id, start, stop) in word numbers."""
    expand = zstandard.ZstdDecompressor().decompress
    known: dict[bytes, int] = {}
    which, docs, places = [], [], []
    for strings, w, d, p in zip(frame["strings"], frame["which"], frame["docs"], frame["places"], strict=True):
        numbers = np.fromiter((known.setdefault(s, len(known)) for s in expand(strings).split(b"\n")), dtype=np.int64)
        which.append(numbers[np.frombuffer(expand(w), dtype=np.int32)])
        docs.append(np.frombuffer(expand(d), dtype=np.int64))
        places.append(np.frombuffer(expand(p), dtype=np.int64))
    which, docs, places = np.concatenate(which), np.concatenate(docs), np.concatenate(places)
    least = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(least, which, docs)
    texts, parts = list(known), []
    del known
    for lo, hi in slices(texts):
        words = Words(texts[lo:hi])
        at, low = words.windows(k, 1)
        parts.append((low, sequence_hash([words.hash[at + j] for j in range(k)], 2), words.doc[at] + lo))
    low, high, string = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((high, low))
    same = np.concatenate(([True], (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])))
    group = np.cumsum(same) - 1
    first = np.minimum.reduceat(least[string[order]], np.flatnonzero(same))
    smallest = np.empty(len(low), np.int64)
    smallest[order] = first[group]
    counts = np.bincount(string, minlength=len(texts))  # every string has a window
    begin = np.cumsum(counts) - counts
    # the places whose string has a window that starts in a smaller document
    keep = np.flatnonzero(np.minimum.reduceat(smallest, begin)[which] < docs)
    n = counts[which[keep]]
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    dup = smallest[np.repeat(begin[which[keep]], n) + offset] < np.repeat(docs[keep], n)
    ids, at = np.repeat(docs[keep], n)[dup], (np.repeat(places[keep], n) + offset)[dup]
    order = np.lexsort((at, ids))
    ids, at = ids[order], at[order]
    if not len(ids):
        return pd.DataFrame({"id": ids, "start": at, "stop": at})
    new = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (at[1:] > at[:-1] + k))))
    return pd.DataFrame({"id": ids[new], "start": at[new], "stop": at[np.concatenate((new[1:], [len(at)])) - 1] + k})


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counted(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    runs = _count(frame, k)
    give_back()
    return runs


def _without(text: str, gone: np.ndarray) -> str:
    """The text without the words that are marked, and without the white space after them; all else stays as it is."""
    spans = [m.span() for m in _WORD.finditer(text)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    out, at = [], 0
    for first, stop in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        ends = stop == len(spans)
        out.append(text[at : spans[first - 1][1] if ends and first else spans[first][0]])
        at = len(text) if ends else spans[stop][0]
    return "".join(out) + text[at:]


def _cut(frames: Iterator[pd.DataFrame], normalise: bool) -> Iterator[pd.DataFrame]:
    for frame in frames:
        n_words, n_removed, kept = [], [], []
        for text, runs in zip(frame.pop("_text"), frame.pop("_runs"), strict=True):
            words = canonical(text).split()
            gone = np.zeros(len(words), bool)
            for run in runs if runs is not None else ():
                gone[run["start"] : run["stop"]] = True
            n_words.append(len(words))
            n_removed.append(int(gone.sum()))
            if not normalise:
                kept.append(_without(text, gone) if n_removed[-1] else text)
            else:
                kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words).decode("utf-8", "replace"))
        yield frame.assign(n_words=n_words, n_removed=n_removed, kept_text=pd.Series(kept, dtype=object, index=frame.index))


def _numbers(rows: DataFrame) -> DataFrame | None:
    """(id, _hash, part) of ids that several of the rows (id, text) have: numbers of an id's different texts; None where ids are unique."""
    twice = written(rows.groupBy("id").count().filter("count > 1").select("id"), "twice")
    if twice.isEmpty():
        return None
    texts = semi(rows.select("id", F.xxhash64("text").alias("_hash")), twice, "id").distinct()
    return written(texts.withColumn("part", F.row_number().over(Window.partitionBy("id").orderBy("_hash")).cast("long") - 1), "numbers")


def _numbered(rows: DataFrame, numbers: DataFrame | None, text: str) -> DataFrame:
    """Add ``part``: the number of the row's text among those of its id."""
    if numbers is None:
        return rows.withColumn("part", F.lit(0).cast("long"))
    found = rows.withColumn("_hash", F.xxhash64(text)).join(numbers, ["id", "_hash"], "left").drop("_hash")
    return found.withColumn("part", F.coalesce("part", F.lit(0).cast("long")))


def repeated_runs(rows: DataFrame, k: int = 13, m: int = 2, most: int = HEAVY) -> DataFrame:
    """(id, part, start, stop) from (id, text, part): runs of words covered by windows that also start in a document with a smaller id."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, 3 * size // BUCKET_BYTES)
    heavy = _heavy_keys(rows, k, m, most) if size // 2 > most else []  # a word takes two bytes at least
    packed = rows.mapInPandas(lambda it: tidied(_pack(it, k, m, buckets, heavy)), "bucket long, strings binary, which binary, docs binary, places binary")
    runs = packed.groupBy("bucket").applyInPandas(lambda frame: _counted(frame, k), "id long, start long, stop long")
    own = F.shiftright("start", PART).alias("part")
    return runs.select("id", own, *(F.col(c).bitwiseAND((1 << PART) - 1).alias(c) for c in ("start", "stop")))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 13, m: int = 2, carry: Sequence[str] = (), normalise: bool = True) -> DataFrame:
    """Remove each word covered by a window of ``k`` words that also starts in a document with a smaller id.

    Returns (doc_id, the columns of ``carry``, n_words, n_removed, kept_text); kept words are joined by one
    space (with ``normalise=False`` the white space between kept words stays as it is, and so does null). Windows are
    judged on the input. Null and empty texts have no words; texts under ``k`` words lose none; a row with
    a null id loses none and counts for none; rows that repeat one id are texts of one document, each with its
    own words. Texts are taken whole, no rows give none. Other columns are ignored, whatever their names.
    Ids are whole numbers, or texts of them; any other id is an error under ANSI mode.
    """
    small_batches(docs.sparkSession)
    usable = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null and text is not null")
    numbers = _numbers(usable)
    runs = repeated_runs(_numbered(usable, numbers, "text"), k, m).groupBy("id", "part").agg(F.collect_list(F.struct("start", "stop")).alias("_runs"))
    rows = docs.select(F.col(doc_id), F.col(text).alias("_text"), *carry)
    whole = rows.select(F.col(doc_id).cast("long").alias("id"), F.struct("*").alias("_row"))
    joined = _numbered(whole, numbers, "_row._text").join(runs, ["id", "part"], "left").select("_row.*", "_runs")
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_words long, n_removed long, kept_text string"])
    return joined.mapInPandas(lambda it: tidied(_cut(it, normalise)), schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that no window of a smaller document covers."""
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_OP9 = r"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
g as (select doc_id, unnest(range(1, len(ws) - 11)) as p, ws from w where len(ws) >= 13),
h as (select doc_id, p, md5(array_to_string(ws[p:p+12], ' ')) as key from g),
f as (select key, min(doc_id) as least from h group by key),
c as (select distinct doc_id, unnest(range(p, p + 13)) as q from h join f using (key) where least < doc_id),
r as (select doc_id, list(q) as qs from c group by doc_id),
o as (select w.doc_id, ws, coalesce(qs, []) as qs from w left join r using (doc_id))
select doc_id, len(ws)::bigint as n_words, len(qs)::bigint as n_removed,
  sha256(array_to_string(list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda z: not list_contains(qs, z[2])), lambda z: z[1]), ' ')) as kept_sha256
from o
"""
