"""Language-model scores by deleted interpolation of n-grams.

P(w | h) = l_n c(h w)/c(h) + ... + l_1 c(w)/N + l_0/(V+1), with the counts of the training documents. The
weights depend on the frequency bucket of the contexts (the binary logarithms of their counts) and are
learned by expectation-maximisation on held-out counts: each training token is held out of the counts that
predict it.

Counting and scoring are one exchange. Documents are read in blocks of about ``BLOCK_TOKENS`` tokens. A block
asks for each of its distinct n-grams once (sorted 56-bit hashes, with its own training count), the bucket of
a hash range adds up what all blocks bring and answers each, and the block puts the answers back on its
tokens. An n-gram that is everywhere costs one entry per block, so no bucket is hot, nothing is capped and no
table of counts is sent to all tasks. The counted blocks are written once; weights and scores read them
without another shuffle, and each document's score is made where its block is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import crc_part, table, written
from .words import Words, canonical, mix, slices

ORDER = 2
BLOCK_TOKENS, BUCKET_BYTES = 1 << 20, 8 << 20
END, SPARE = np.uint64(0x5D0C0E0D), np.uint64(8)
STEP = 4  # bins of the logarithm of a probability per factor of two
_ROW = "block long, bucket long, part int, a binary, b binary, ids binary, sizes binary, train binary"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _shrink(x: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _grow(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _sorted_in(x: np.ndarray) -> bytes:
    """Ascending hashes as differences."""
    return _shrink(np.diff(x, prepend=np.uint64(0)))


def _sorted_out(blob: bytes) -> np.ndarray:
    return np.cumsum(_grow(blob, np.uint64), dtype=np.uint64)


def _blocks(frames: Iterator[pd.DataFrame]):
    """Word hashes with an end after each text, tokens of each text, and the rows, in blocks."""
    held, size = [], 0
    for frame in frames:
        texts = [canonical(t, lower=True) for t in frame["text"]]
        for lo, hi in slices(texts):
            words = Words(texts[lo:hi])
            n = hi - lo
            out = np.full(len(words.hash) + n, END, np.uint64)
            out[np.arange(len(words.hash)) + words.doc] = words.hash
            held.append((out, words.counts + 1, frame.iloc[lo:hi][["id", "train"]]))
            size += len(out)
            if size >= BLOCK_TOKENS:
                yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), pd.concat([x[2] for x in held])
                held, size = [], 0
    if held:
        yield np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]), pd.concat([x[2] for x in held])


def _firsts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)


def _grams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """Hash of the n-gram that ends at each token, for each length; texts begin with as many starts as needed."""
    gram = tokens
    yield gram
    first = _firsts(sizes)
    for n in range(1, order):
        before = np.concatenate((gram[:1], gram[:-1]))
        before[first] = mix(np.array([n], np.uint64))  # a history of starts
        gram = mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(tokens + np.uint64(n)))
        yield gram


def _ask(frames: Iterator[pd.DataFrame], buckets: int, order: int) -> Iterator[pd.DataFrame]:
    """Each block's own row, and a row for every bucket that holds n-grams of the block."""
    for number, (tokens, sizes, rows) in enumerate(_blocks(frames)):
        block = (TaskContext.get().partitionId() << 32) + number
        train = rows["train"].to_numpy(bool)
        weight = np.repeat(train, sizes)
        words, at = np.unique(tokens, return_inverse=True)
        often = np.argsort(-np.bincount(at), kind="stable")  # frequent words get small numbers
        number_of = np.empty(len(words), np.uint32)
        number_of[often] = np.arange(len(words))
        ids = rows["id"]
        whole = np.concatenate((ids.fillna(0).to_numpy(np.int64), ids.isna().to_numpy(np.int64)))
        out = [(block, -1 - block, 0, _shrink(words[often]), _shrink(number_of[at]), _shrink(whole), _shrink(sizes.astype(np.int64)), _shrink(train.astype(np.uint8)))]
        for n, gram in enumerate(_grams(tokens, sizes, order), 1):
            keys, at = np.unique(gram >> SPARE, return_inverse=True)
            count = np.bincount(at, weights=weight).astype(np.int64)
            bucket = ((keys >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cut = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]))
            out += [(block, int(bucket[i]), n, _sorted_in(keys[i:j]), _shrink(count[i:j]), None, None, None) for i, j in pairwise(cut)]
        yield pd.DataFrame(out, columns=_NAMES)


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket: for each block's row the counts over all blocks; and the bucket's own sums, as block -1 - bucket."""
    bucket = int(frame["bucket"].iloc[0])
    if bucket < 0:
        return frame
    out = []
    for n, rows in frame.groupby("part"):
        keys = [_sorted_out(x) for x in rows["a"]]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([_grow(x, np.int64) for x in rows["b"]])).astype(np.int64)
        if n == 1:
            end = np.concatenate(keys) == END >> SPARE
            sums = np.array([total.sum(), np.count_nonzero(total), total[at[end]].max(initial=0)], np.int64)
            out.append((-1 - bucket, bucket, 0, _shrink(sums), None, None, None, None))
        own = np.split(total[at], np.cumsum([len(k) for k in keys])[:-1])
        out += [(block, bucket, n, _shrink(x), None, None, None, None) for block, x in zip(rows["block"], own, strict=True)]
    return pd.DataFrame(out, columns=_NAMES)


_COUNTED = "block long, total long, distinct long, texts long, ids binary, sizes binary, train binary, counts array<binary>"


def _put_back(frame: pd.DataFrame, order: int) -> pd.DataFrame:
    """Of a block: the counts of the n-grams that end at each of its tokens."""
    names = [x.split()[0] for x in _COUNTED.split(", ")]
    block = int(frame["block"].iloc[0])
    if block < 0:
        return pd.DataFrame([(block, *map(int, _grow(frame["a"].iloc[0], np.int64)), None, None, None, None)], columns=names)
    own = frame[frame["bucket"] < 0].iloc[0]
    tokens = _grow(own["a"], np.uint64)[_grow(own["b"], np.uint32)]
    rest = frame[frame["bucket"] >= 0].sort_values("bucket")
    counts = []
    for n, gram in enumerate(_grams(tokens, _grow(own["sizes"], np.int64), order), 1):
        answer = np.concatenate([_grow(x, np.int64) for x in rest.loc[rest["part"] == n, "a"]])
        counts.append(_shrink(answer[np.unique(gram >> SPARE, return_inverse=True)[1]]))
    return pd.DataFrame([(block, None, None, None, own["ids"], own["sizes"], own["train"], counts)], columns=names)


class Model:
    """Totals of the training tokens and the mixture weights by context bucket."""

    def __init__(self, total: int, distinct: int, texts: int, order: int):
        self.total, self.distinct, self.texts, self.order = total, distinct, texts, order
        self.weights: dict[int, np.ndarray] = {}
        self.default = np.array([0.1, *(0.9 / order for _ in range(order))])

    def contexts(self, counts: list[np.ndarray], sizes: np.ndarray) -> list[np.ndarray]:
        """Counts of each token's context, for each length; the shortest is the empty one."""
        out = [np.full(len(counts[0]), self.total, np.int64)]
        for c in counts[:-1]:
            before = np.concatenate((c[:1], c[:-1]))
            before[_firsts(sizes)] = self.texts
            out.append(before)
        return out

    def bucket(self, contexts: list[np.ndarray]) -> np.ndarray:
        """The binary logarithms of the context counts, as one number."""
        out = np.zeros(len(contexts[0]), np.int64)
        for c in contexts[1:]:
            out = out * 64 + np.log2(c + 1).astype(np.int64)
        return out

    def log_p(self, counts: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        keys, at = np.unique(self.bucket(contexts), return_inverse=True)
        weights = np.stack([self.weights.get(int(k), self.default) for k in keys])[at]
        for n, h in enumerate(contexts[1:], 2):
            weights[h == 0, n] = 0  # an unseen context has no estimates: what is left shares its weight
        weights = weights / weights.sum(axis=1, keepdims=True)
        p = weights[:, 0] / (self.distinct + 1)
        for n, (c, h) in enumerate(zip(counts, contexts, strict=True), 1):
            p = p + weights[:, n] * c / np.maximum(h, 1)
        return np.log10(p)

    def histogram(self, counts: list[np.ndarray], contexts: list[np.ndarray], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Held-out tokens by context bucket and by bins of their estimates; each is left out of its own counts."""
        key = self.bucket([c[train] for c in contexts])
        for c, h in zip(counts, contexts, strict=True):
            with np.errstate(divide="ignore"):
                p = np.log2((c[train] - 1) / np.maximum(1, h[train] - 1))
            key = key * 512 + np.maximum(-511, np.floor(STEP * p)).astype(np.int64) + 511
        keys, n = np.unique(key, return_counts=True)
        return keys, n

    def learn_weights(self, keys: np.ndarray, n: np.ndarray) -> None:
        """Expectation-maximisation over the binned held-out tokens of each context bucket."""
        parts, rest = [np.full(len(keys), 1 / (self.distinct + 1))], keys.copy()
        for _ in range(self.order):
            b = rest % 512 - 511
            parts.insert(1, np.where(b > -511, 2.0 ** ((b + 0.5) / STEP), 0))
            rest = rest // 512
        p = np.stack(parts, axis=1)
        for seen in range(self.order):  # contexts of so many words have been seen, longer ones have not
            zeros = 64 ** (self.order - 1 - seen)
            bucket = rest // zeros * zeros
            for k in np.unique(bucket):
                mine = bucket == k
                self.weights[int(k)] = np.append(self._mixed(p[mine, : seen + 2], n[mine].astype(float)), np.zeros(self.order - 1 - seen))

    def _mixed(self, p: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Mixture weights of the estimates ``p`` for ``n`` held-out tokens each."""
        own = self.default[: p.shape[1]] / self.default[: p.shape[1]].sum()
        for _ in range(200):
            share = p * own
            share = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) + 1e-3
            new = share / share.sum()
            done, own = np.abs(new - own).max() < 1e-7, new
            if done:
                break
        return own


def _opened(row, model: Model):
    """Tokens of each text, training flags of tokens, counts and context counts of a counted block."""
    sizes = _grow(row.sizes, np.int64)
    counts = [_grow(x, np.int64) for x in row.counts]
    return sizes, np.repeat(_grow(row.train, np.uint8).astype(bool), sizes), counts, model.contexts(counts, sizes)


def _held_out(frames: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            _, train, counts, contexts = _opened(row, model)
            keys, n = model.histogram(counts, contexts, train)
            yield pd.DataFrame({"k": keys, "n": n})


def _scored(frames: Iterator[pd.DataFrame], model: Model) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for row in frame.itertuples():
            sizes, _, counts, contexts = _opened(row, model)
            first, ids = _firsts(sizes), _grow(row.ids, np.int64).reshape(2, -1)
            add = lambda x: np.add.reduceat(x, first)  # noqa: B023, E731  every text has an end, so none is empty
            base = np.log10((counts[0] + 1) / (model.total + model.distinct + 1))
            yield pd.DataFrame({"id": pd.array(ids[0], dtype="Int64"), "n_tokens": sizes, "n_known": add((counts[0] > 0).astype(np.int64)), "base_score": add(base), "score": add(model.log_p(counts, contexts))}).assign(id=lambda f: f["id"].mask(ids[1] > 0))  # noqa: B023


def score_texts(docs: DataFrame, train, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Scores of all documents by a model of those that the condition ``train`` (a Column) marks.

    Returns a row per row: (doc_id, n_tokens, n_known, train_tokens, base_score, score). Null and empty texts
    are an end alone. A null condition is no training row; a null id stays null; rows that repeat an id or a
    text count and are scored one by one. Texts of any length stay whole (a text longer than a block is one
    block). No rows give none; without training rows every token is unknown. Other columns are ignored.
    ``order`` is the length of the longest n-gram. Ids are whole numbers, or texts of them; any other id is an
    error under ANSI mode.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    buckets = 1 + int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES
    asked = rows.mapInPandas(lambda it: _ask(it, buckets, order), _ROW)
    answered = asked.groupBy("bucket").applyInPandas(_answer, _ROW)
    counted = written(answered.groupBy("block").applyInPandas(lambda f: _put_back(f, order), _COUNTED), "counted")
    sums = counted.filter("block < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct")), F.coalesce(F.max("texts"), F.lit(0)).alias("texts")).first()
    model = Model(sums["total"], sums["distinct"], sums["texts"], order)
    blocks = counted.filter("block >= 0").select("ids", "sizes", "train", "counts")
    bins = blocks.mapInPandas(lambda it: _held_out(it, model), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).orderBy("k").toPandas()
    model.learn_weights(bins["k"].to_numpy(np.int64), bins["n"].to_numpy(np.int64))
    out = blocks.mapInPandas(lambda it: _scored(it, model), "id long, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("id").alias(doc_id), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram scores of all documents, learned from those whose crc32(doc_id) mod 7 is not 2."""
    out = score_texts(table(spark, sf_dir, "documents"), crc_part(F.col("doc_id"), 7) != 2)
    return out.select("doc_id", F.coalesce(crc_part(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
