"""Prefix tries of conversations, by truncation peeling.

A conversation is a path: the 16-byte digests of its turns, one after the other, and the words of each turn.
Paths are sorted over the cluster by range, so the members of every node stand side by side, and a hot first
turn is spread over as many tasks as its conversations need. Equal paths are one row before that.

A task peels slices of neighbouring paths. It descends from the slice's maximum depth: at depth d the
conversations that end there are merged with the surviving nodes, which are the deeper ones without their last
turn; those with equal paths are one node, whose aggregates are final as its children have been peeled before.
Only nodes on the slice's first and last path can have members in other slices. They stay open: their partial
aggregates by depth survive, two rows a slice, and are peeled in the same way until one slice is left.
So a task holds a slice of bounded size, and no level of the trie is a job of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import BROADCAST_ROWS, table, written

#: Bytes of a turn in a path.
TURN = 16
#: Paths and bytes of a slice; a longer path is a slice of its own.
SLICE_ROWS, SLICE_BYTES = 1 << 15, 1 << 24
#: Surviving paths that the last slice may hold.
LAST_ROWS = 512
#: Conversation ids of one block of equal paths.
BLOCK = 1 << 16
NONE, MOST = hashlib.sha256(b"").hexdigest(), np.iinfo(np.int64).max
#: A survivor's partial aggregates at one depth: members, smallest member, children, leaves and saved tokens of closed children.
PARTIAL = np.dtype([("depth", "i8"), ("n", "i8"), ("least", "i8"), ("kids", "i8"), ("leaves", "i8"), ("saved", "i8"), ("ends", "S64")])
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PEELED = NODE + ", key binary, parent_key binary, path binary, words array<int>, part binary"


def conversation_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", family: Column | None = None) -> DataFrame:
    """(family, conv_id, path, words): a row per conversation, ordered by turn (null first, equal turns by digest).

    Null roles and texts are empty; rows without an id belong to no conversation. Repeated rows are turns of their
    own. A conversation's turns meet in one row, 20 bytes each; conversations of one ``family`` (an expression on
    the id, or the id itself) meet in one task.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.substring(F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256), 1, 2 * TURN)
    words = F.regexp_count(text_, F.lit("[^\\x20\\x09-\\x0D]+"))
    rows = turns.filter(F.col(conv_id).isNotNull()).select((F.col(conv_id) if family is None else family).alias("family"), F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), words.alias("words")).alias("t"))
    found = rows.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return found.select("family", "conv_id", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.words").alias("words"))


def with_family_heads(paths: DataFrame, heads: Column, most: int) -> DataFrame:
    """Each conversation's first ``heads`` turns (``most`` at most) are replaced by those of its family's own conversation.

    The family is the id of that conversation; where it has fewer turns all of them are taken, none if it is absent.
    """
    own = F.col("conv_id") == F.col("family")
    family = Window.partitionBy("family")
    lead = F.max(F.when(own, F.struct(F.substring("path", 1, TURN * most).alias("path"), F.slice("words", 1, most).alias("words")))).over(family)
    led = paths.withColumns({"lead": lead, "h": heads.cast("int")})
    path = F.concat(F.coalesce(F.expr(f"substring(lead.path, 1, {TURN} * h)"), F.unhex(F.lit(""))), F.expr(f"substring(path, {TURN} * h + 1)"))
    words = F.concat(F.coalesce(F.expr("slice(lead.words, 1, h)"), F.array().cast("array<int>")), F.expr("slice(words, h + 1, greatest(size(words), 1))"))
    return led.select("conv_id", path.alias("path"), words.alias("words"))


def _depth(a: bytes, b: bytes) -> int:
    """Turns that two paths share."""
    most, n = min(len(a), len(b)) // TURN, 0
    while n < most and a[n * TURN : (n + 1) * TURN] == b[n * TURN : (n + 1) * TURN]:
        n += 1
    return n


class Slice:
    """Neighbouring paths, all different and in order, with partial aggregates at some of their depths."""

    def __init__(self, most: int, least: int = 1) -> None:
        self.most, self.least = most, least
        self.paths: list[bytes] = []
        self.words: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, path: bytes, words: np.ndarray, part: np.ndarray) -> None:
        self.paths.append(path)
        self.words.append(words)
        self.parts.append(part)
        self.bytes += len(path) + part.nbytes

    @property
    def full(self) -> bool:
        return len(self.paths) >= self.least and (len(self.paths) >= self.most or self.bytes >= SLICE_BYTES)

    def keys(self, row: int) -> list[bytes]:
        """A name for the node at each depth of a path."""
        h, path = hashlib.blake2b(digest_size=16), self.paths[row]
        out = [h.digest()]
        for d in range(len(path) // TURN):
            h.update(path[d * TURN : (d + 1) * TURN])
            out.append(h.digest())
        return out

    def peel(self, whole: bool, named: bool) -> Iterator[pa.RecordBatch]:
        """Closed nodes, then survivors. ``whole``: nothing stays open. ``named``: other tables may hold children of these nodes."""
        paths, rows = self.paths, len(self.paths)
        shared = np.array([-1, *(_depth(a, b) for a, b in zip(paths, paths[1:], strict=False))], np.int64)
        last = np.array([len(p) // TURN for p in paths], np.int64)
        first_word = np.concatenate(([0], np.cumsum(last)))
        words = np.concatenate([w.astype(np.int64) for w in self.words]) if rows else np.zeros(0, np.int64)
        part = np.concatenate(self.parts)
        part_row = np.repeat(np.arange(rows), [len(p) for p in self.parts])
        order = np.argsort(-part["depth"], kind="stable")
        part, part_row = part[order], part_row[order]
        depths = np.arange(int(last.max(initial=0)), -1, -1)
        begin, end = np.searchsorted(-part["depth"], -depths, "left"), np.searchsorted(-part["depth"], -depths, "right")
        names = {r: self.keys(r) for r in (range(rows) if named else {0, rows - 1})}
        spine = {0: [], rows - 1: []}
        at, kids_of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        stats, ends, open_ = np.zeros((4, 0), np.int64), np.zeros(0, "S64"), np.zeros(0, bool)  # of survivors: members, least, leaves, saved
        for k, d in enumerate(depths.tolist()):
            new, rows_of = part[begin[k] : end[k]], part_row[begin[k] : end[k]]
            # Merge survivors without their last turn with what ends here; open ones leave their figures to the survivors' rows.
            closed = ~open_
            pos = np.concatenate((at, rows_of))
            n = np.concatenate((np.where(closed, stats[0], 0), new["n"]))
            least = np.concatenate((np.where(closed, stats[1], MOST), new["least"]))
            kids = np.concatenate((closed.astype(np.int64), new["kids"]))
            leaves = np.concatenate((np.where(closed, stats[2], 0), new["leaves"]))
            saved = np.concatenate((np.where(closed, stats[3], 0), new["saved"]))
            ended = np.concatenate((np.zeros(len(at), "S64"), new["ends"]))
            order = np.argsort(pos, kind="stable")
            sorted_ = pos[order]
            starts = np.flatnonzero((shared[sorted_] < d) & np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
            group = np.empty(len(pos), np.int64)
            group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(pos))))
            total = [np.add.reduceat(x[order], starts) for x in (n, kids, leaves, saved)]
            low = np.minimum.reduceat(least[order], starts)
            over = np.zeros(len(starts), "S64")
            has = ended != b""
            over[group[has]] = ended[has]  # a path ends in one row
            here = sorted_[starts]
            still = np.zeros(len(starts), bool)
            if not whole:
                still |= here == 0
                still[-1] |= last[-1] >= d
            # Children whose parent is known now.
            if closed.any():
                parent = group[: len(at)]
                yield from self._nodes(d + 1, at, stats, kids_of, ends, closed, np.where(still[parent], MOST, low[parent]), here[parent], names, named)
            for g in np.flatnonzero(still).tolist():
                row = 0 if here[g] == 0 else rows - 1
                spine[row].append((d, total[0][g], low[g], total[1][g], total[2][g], total[3][g], over[g]))
            own = words[first_word[here] + d - 1] if d else np.zeros(len(here), np.int64)
            at, open_, kids_of, ends = here, still, total[1], over
            stats = np.stack((total[0], low, np.where(total[1] == 0, 1, total[2]), total[3] + (total[0] - 1) * own))
        if rows and not open_.all():
            yield from self._nodes(0, at, stats, kids_of, ends, ~open_, np.full(len(at), MOST), at, names, named)
        for row in sorted(spine) if not whole else ():
            if spine[row]:
                left = np.array(spine[row], PARTIAL)
                yield _batch(path=[paths[row]], words=[self.words[row]], part=[left.tobytes()])

    def _nodes(self, depth: int, at: np.ndarray, stats: np.ndarray, kids: np.ndarray, ends: np.ndarray, closed: np.ndarray, parent: np.ndarray, parent_at: np.ndarray, names: dict, named: bool) -> Iterator[pa.RecordBatch]:
        """Rows of closed nodes; a parent that is open has a name instead of an id."""
        at, parent, parent_at, ends = at[closed], parent[closed], parent_at[closed], ends[closed]
        stats, kids = stats[:, closed], kids[closed]
        unknown = (parent == MOST) & (depth > 0)
        # An open parent holds the slice's first or last row, so one of their paths has its name.
        keys = [names[0 if p == 0 else max(names)][depth - 1] if u else None for p, u in zip(parent_at.tolist(), unknown.tolist(), strict=True)]
        yield _batch(
            conv_id=stats[1], depth=np.full(len(at), depth), parent_conv_id=pa.array(parent, mask=parent == MOST), n_convs=stats[0], n_children=kids, n_leaves=stats[2], saved_tokens=stats[3],
            ends_sha256=[e.decode() or NONE for e in ends.tolist()], parent_key=keys, key=[names[r][depth] for r in at.tolist()] if named else None,
        )


FIELDS = pa.schema([
    *((n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()),
    ("key", pa.binary()), ("parent_key", pa.binary()), ("path", pa.binary()), ("words", pa.list_(pa.int32())), ("part", pa.binary()),
])


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if columns.get(f.name) is None else pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name] for f in FIELDS], schema=FIELDS)


def _first(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted (path, block, ids, words) rows: equal paths become one, their ids are hashed as they come."""
    slice_, now = Slice(most), None

    def end() -> None:
        path, words, n, least, h = now
        slice_.add(path, words, np.array([(len(path) // TURN, n, least, 0, 0, 0, h.hexdigest().encode())], PARTIAL))

    for batch in batches:
        for path, ids, words in zip(*(batch.column(batch.schema.names.index(c)) for c in ("path", "ids", "words")), strict=True):
            path, ids = path.as_py(), ids.values.to_numpy()
            if now is None or now[0] != path:
                if now is not None:
                    end()
                    if slice_.full:
                        yield from slice_.peel(False, False)
                        slice_ = Slice(most)
                now = [path, words.values.to_numpy(), 0, int(ids[0]), hashlib.sha256()]
            elif now[2]:
                now[4].update(b",")
            now[2] += len(ids)
            now[4].update(",".join(map(str, ids.tolist())).encode())
    if now is not None:
        end()
        yield from slice_.peel(False, False)


def _again(batches: Iterator[pa.RecordBatch], whole: bool, most: int) -> Iterator[pa.RecordBatch]:
    """Sorted survivors; ``whole``: they are all that is left, else eight at least become two."""
    slice_ = Slice(most, 8)
    for batch in batches:
        for path, words, part in zip(*(batch.column(batch.schema.names.index(c)) for c in ("path", "words", "part")), strict=True):
            slice_.add(path.as_py(), words.values.to_numpy(), np.frombuffer(part.as_py(), PARTIAL))
            if slice_.full and not whole:
                yield from slice_.peel(False, True)
                slice_ = Slice(most, 8)
    if slice_.paths:
        yield from slice_.peel(whole, True)


def prefix_trie(paths: DataFrame, slice_rows: int = SLICE_ROWS, last_rows: int = LAST_ROWS) -> DataFrame:
    """A row per distinct prefix of the paths (conv_id long, path binary, words array<int>).

    Gives the smallest member and the depth, which name the node; its parent's smallest member (root: null), the
    numbers of members, children and leaves below, the saved tokens, and the SHA-256 of the ids that end there.
    The root is there if any conversation is, also one without turns; without rows there are no nodes. Equal paths
    are members of the same nodes. Rows without an id are left out; an id that comes twice is two members.
    """
    block = F.floor(F.col("conv_id") / BLOCK)
    rows = paths.filter("conv_id is not null").groupBy("path", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"), F.any_value("words").alias("words"))
    found = [written(rows.repartitionByRange("path").sortWithinPartitions("path", "block").mapInArrow(lambda it: _first(it, slice_rows), PEELED), "trie")]
    while True:
        left = found[-1].filter("path is not null").select("path", "words", "part")
        n = left.count()
        if not n:
            break
        whole = n <= last_rows
        left = left.coalesce(1) if whole else left.repartitionByRange(-(-n // last_rows), "path")
        found.append(written(left.sortWithinPartitions("path").mapInArrow(lambda it, whole=whole: _again(it, whole, slice_rows), PEELED), "trie"))
        if whole:
            break
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionAll(more)
    nodes = nodes.filter("path is null").drop("path", "words", "part")
    known = nodes.filter("parent_key is null").drop("key", "parent_key")
    named = nodes.filter("key is not null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    others = nodes.filter("parent_key is not null").join(named, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent"))
    return known.unionByName(others.select(known.columns))


def node_turns(nodes: DataFrame, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Nodes with the role and text of their last turn (null at the root), from the conversations that the trie was made of."""
    digest = F.sha2(F.concat(F.length(F.coalesce(F.col(role), F.lit(""))).cast("string"), F.lit(":"), F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))), 256)
    depth = F.row_number().over(Window.partitionBy(conv_id).orderBy(F.col(turn).asc_nulls_first(), F.substring(digest, 1, 2 * TURN)))
    last = turns.select(F.col(conv_id).alias("conv_id"), depth.cast("long").alias("depth"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    return nodes.join(last, ["conv_id", "depth"], "left")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each led by the first turns of the conversation that begins its twenty.

    Empty table: no rows. Null ids are no conversations, null roles and texts are empty, equal turn numbers are
    ordered by digest, repeated rows are turns of their own; other columns are ignored.
    """
    turns = table(spark, sf_dir, "conversations").withColumn("conv_id", F.col("conv_id").cast("long"))
    paths = conversation_paths(turns, family=F.col("conv_id") - F.col("conv_id") % 20)
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie(with_family_heads(paths, heads, 3))


ORACLE_OP11 = """
with t as (
    select conv_id, d.digest, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as words,
        row_number() over (partition by conv_id order by turn nulls first, d.digest) as pos
    from conversations, lateral (select substr(sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) as digest) d
    where conv_id is not null),
c as (
    select conv_id, conv_id - conv_id % 20 as base, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 4 as h
    from (select conv_id, count(*) as n from t group by conv_id)),
r as (
    select c.conv_id, t.pos as d, t.digest, t.words from c join t on t.conv_id = c.base and t.pos <= c.h
    union all
    select c.conv_id, t.pos - c.h + least(c.h, coalesce(b.n, 0)), t.digest, t.words from c join t using (conv_id) left join c b on b.conv_id = c.base where t.pos > c.h),
p as (
    select conv_id, d, string_agg(digest, '') over (partition by conv_id order by d) as path, words from r
    union all select conv_id, 0, '', 0 from c),
n as (select path, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words from p group by path, d),
e as (
    select path, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends
    from (select conv_id, arg_max(path, d) as path from p group by conv_id) group by path),
k as (select substr(path, 1, 32 * (d - 1)) as path, count(*) as kids from n where d > 0 group by 1),
s as (
    select substr(n.path, 1, 32 * u.up) as path, sum(case when k.kids is null then 1 else 0 end) as leaves, sum((n.n_convs - 1) * n.words) as saved
    from n left join k using (path), lateral (select unnest(range(0, n.d + 1)) as up) u group by 1)
select n.conv_id, n.d::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.kids, 0)::bigint as n_children, s.leaves::bigint as n_leaves,
    s.saved::bigint as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
from n join s using (path) left join k using (path) left join e using (path) left join n u on n.d > 0 and u.path = substr(n.path, 1, 32 * (n.d - 1))
"""
