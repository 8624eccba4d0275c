"""Byte-level BPE of whole texts, by overlapping chunks.

Long texts are cut into chunks that overlap, and the chunks are dealt out and pre-tokenised in parallel, each
from its own first character. A text's chunks then meet in order and are stitched: matching depends only on
what follows, so from a boundary that both chunks have the pre-tokens are the same, and the earlier chunk's
pre-tokens hold up to there, the later one's from there. A boundary near a chunk's cut end isn't trusted, as
its match may have looked further. Where the overlap has no common boundary (one pre-token spans it), the chunks
are joined and pre-tokenised again from the last boundary that holds. Texts of one chunk need no stitching.

Every pre-token is then encoded by itself: its bytes are merged by rank, the lowest first, the leftmost of equal
ones. Workers remember pre-tokens, a bounded number of them. Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .memory import tidied
from .store import small_batches, table, written

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: Characters of a chunk without its overlap, and of the overlap.
CHUNK, OVERLAP = 1 << 15, 1 << 10
#: Characters before a cut end in which a boundary isn't trusted; a contraction looks at three.
MARGIN = 4
#: Pre-tokens that a worker remembers in each of two generations, and the longest of them in characters.
REMEMBERED, SHORT = 1 << 18, 64


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: neighbours whose union has the lowest rank are merged, the leftmost of equal ones, until none has."""
    if piece in ranks:
        return [ranks[piece]]
    return _merged_words(piece, ranks) if len(piece) <= 4 * SHORT else _merged_runs(piece, ranks)


def _merged_words(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Short pieces: a list of parts, and of the ranks of neighbours, of which the minimum is looked for at each step."""
    none, parts = len(ranks) << 1, [piece[i : i + 1] for i in range(len(piece))]
    unions = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
    while unions and (low := min(unions)) != none:
        i = unions.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del unions[i]
        if i:
            unions[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(unions):
            unions[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merged_runs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Long pieces: linked parts, and a heap of neighbours by rank and place."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))

    def union(i: int) -> tuple[int, int, int, int] | None:
        j = after[i]
        rank = ranks.get(piece[i : end[j]]) if j < n else None
        return None if rank is None else (rank, i, end[i], end[j])

    heap = [x for i in range(n) if (x := union(i))]
    heapify(heap)
    while heap:
        _, i, middle, last = heappop(heap)
        j = after[i]
        if end[i] != middle or j >= n or end[j] != last:  # one of the two has been merged meanwhile
            continue
        end[i], after[i], end[j] = last, after[j], -1
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (x := union(k)):
                heappush(heap, x)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Vocabulary(dict):
    """Packed ids of pre-tokens; those that are not known yet are merged."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.pattern = regex.compile(pattern)
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", merged(piece.encode(), self.ranks)).tobytes()
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:  # pieces that are met again move to the new generation
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def ends(self, text: str) -> np.ndarray:
        return np.cumsum(np.fromiter(map(len, self.split(text)), np.int64))


@cache
def _vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(ranks, pattern)


class Stitcher:
    """Takes the chunks of one text in order and keeps the ids of the pre-tokens that hold."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.ids, self.held = vocabulary, [], None

    def add(self, start: int, chunk: str, ends: np.ndarray) -> None:
        """A chunk's first character in the text, its characters and the ends of its pre-tokens."""
        if self.held is None:
            self.start, self.held, self.ends, self.late, self.retry = start, chunk, ends.tolist(), [], 0
            return
        known = {start, *(ends[: bisect_right(ends, OVERLAP)] + start).tolist()}
        trusted = bisect_right(self.ends, len(self.held) - MARGIN)
        if not self.late:
            for k in range(bisect_left(self.ends, start - self.start), trusted):
                at = self.start + self.ends[k]
                if at in known:  # resynchronised: what follows is the later chunk's
                    self._keep(k + 1)
                    self.held, self.start = chunk[at - start :], at
                    self.ends = (ends[np.searchsorted(ends, at - start, "right") :] - (at - start)).tolist()
                    return
            self._keep(trusted)
            cut = self.ends[trusted - 1] if trusted else 0
            self.held, self.start, self.ends = self.held[cut:], self.start + cut, []
            self.retry = 2 * len(self.held)
        self.late.append(chunk[self.start + len(self.held) + sum(map(len, self.late)) - start :])
        if len(self.held) + sum(map(len, self.late)) >= self.retry:  # else wait, so that a long pre-token isn't matched again at each chunk
            self._join()

    def _keep(self, pieces: int) -> None:
        begin = 0
        for end in self.ends[:pieces]:
            self.ids.append(self.vocabulary[self.held[begin:end]])
            begin = end

    def _join(self) -> None:
        self.held, self.late = "".join((self.held, *self.late)), []
        self.ends = self.vocabulary.ends(self.held).tolist()

    def finish(self) -> bytes:
        if self.held is not None:
            if self.late:
                self._join()
            self._keep(len(self.ends))
        return b"".join(self.ids)


def _lists(packed: list[bytes]) -> pa.Array:
    counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), np.int32), pa.int32()))


def encode_bytes(docs: DataFrame, text: str = "text", ids: str = "ids", ranks_path: str = RANKS, pattern: str = PATTERN, chunk: int = CHUNK) -> DataFrame:
    """All columns but the text, with the ids (array<int>) of the whole text instead; a column of that name is replaced.

    Null and empty texts have no ids. Very long texts are read by several tasks. Repeated rows are encoded as they
    are; no rows give none. Special tokens' strings are ordinary text.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(ranks_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    rest = [f for f in docs.schema.fields if f.name not in (text, ids)]
    names = [f.name for f in rest]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    prefix = columns + ", " if columns else ""
    tag = "_"
    while any(n.startswith(tag) for n in (*names, ids)):
        tag += "_"
    row, number, part, ends = (tag + x for x in ("row", "number", "part", "ends"))
    docs = docs.select(*(F.col(f"`{n}`") for n in names), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(part))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model.value, pattern)
        for batch in batches:
            found = [vocabulary.encode(vocabulary.split(t)) for t in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], _lists(found)], names=[*names, ids])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks; the other columns go with the first one."""
        for batch in batches:
            for i in range(batch.num_rows):
                t = batch.column(len(names))[i].as_py()
                begins = range(0, len(t), chunk)
                first = pa.array([i] + [None] * (len(begins) - 1), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(first) for c in batch.columns[: len(names)]), pa.array([batch.column(len(names) + 1)[i].as_py()] * len(begins)), pa.array(range(len(begins)), pa.int32()), pa.array([t[b : b + chunk + OVERLAP] for b in begins])],
                    names=[*names, row, number, part],
                )

    def pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model.value, pattern)
        for batch in batches:
            found = [vocabulary.ends(t).astype(np.int32).tobytes() for t in batch.column(len(names) + 2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*names, row, number, part, ends])

    def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, first, now = _vocabulary(model.value, pattern), None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*first.columns[: len(names)], _lists([now.finish()])], names=[*names, ids])

        for batch in batches:
            for i in range(batch.num_rows):
                k = batch.column(len(names) + 1)[i].as_py()
                if k == 0:
                    if now is not None:
                        yield done()
                    first, now = batch.slice(i, 1), Stitcher(vocabulary)
                now.add(k * chunk, batch.column(len(names) + 2)[i].as_py(), np.frombuffer(batch.column(len(names) + 3)[i].as_py(), np.int32).astype(np.int64))
        if now is not None:
            yield done()

    out = f"{prefix}`{ids}` array<int>"
    short = docs.filter(F.length(part) <= chunk).mapInArrow(lambda it: tidied(whole(it)), out)
    long = written(docs.filter(F.length(part) > chunk).withColumn(row, F.monotonically_increasing_id()), "long")  # written, so a row keeps its number
    pieces = f"{prefix}`{row}` long, `{number}` int, `{part}` string"
    dealt = long.mapInArrow(cut, pieces).repartition(row, number).mapInArrow(pre_tokens, f"{pieces}, `{ends}` binary")
    met = dealt.repartition(row).sortWithinPartitions(row, number).mapInArrow(lambda it: tidied(stitched(it)), out)
    return short.unionAll(met)


def decode_bytes(rows: DataFrame, ids: str = "ids", decoded: str = "decoded", ranks_path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """Add the raw bytes that the ids stand for (null for null ids; ids outside the vocabulary fail)."""
    with open(ranks_path, "rb") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())

    def joined(column: pd.Series) -> pd.Series:
        known = _vocabulary(model.value, pattern).bytes
        return pd.Series([None if x is None else b"".join(map(known.__getitem__, x.tolist())) for x in column], dtype=object)

    return rows.withColumn(decoded, F.pandas_udf(joined, "binary")(F.col(f"`{ids}`")))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents' whole texts, decoded again; digests of both.

    Null and empty texts have no ids and the digests of nothing; null ids of documents, repeated rows and very long
    texts are as others; an empty table gives no rows; other columns are ignored.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decode_bytes(encode_bytes(docs))
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
