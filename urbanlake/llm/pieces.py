"""SentencePiece encoding and decoding with weighted finite-state transducers.

Three transducers are compiled from a model file:

* the normaliser: a trie of the character map's rules (the longest rule at a place is its only arc, a character
  without a rule is copied, user-defined pieces pass unchanged), then two states that turn runs of spaces into one
  U+2581 each and drop those at the ends;
* the pieces: a trie whose accepting arcs return to the root, give a piece and weigh minus its score;
* the byte fallback: at the root, a character that no piece covers gives its UTF-8 bytes' ids.

The normaliser is a function, so its composition with an input is one path. That path is composed lazily with
pieces and fallback, and the tropical-semiring shortest path (sum of weights along a path, minimum over paths)
through the composed machine, found by Dijkstra's search from state to state, is the encoding. Byte-pair models
compose a fourth machine: its state is the piece read last, and an arc from piece a to piece b weighs infinity
unless the model's own merges of the text ab give (a, b), else nothing. A sequence of which every neighbouring
pair is allowed is the one that greedy merging gives, so one path is finite and it is the model's encoding. All
finite weights there are equal, so the search's queue is a stack.

Where the composed machine is sure to be back at the root (before a U+2581, around characters that no longer
piece holds, between characters of two classes that no piece mixes) the path is cut, and paths over equal stretches
are remembered.

Decoding is the inverse transducer: ids to pieces or raw bytes, U+2581 to spaces, without the prefix.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .memory import tidied
from .store import small_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Piece types and model types of the model file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITY = float("inf")
#: Encoded chunks that a worker remembers in each of two generations, and answers on neighbours.
REMEMBER, NEIGHBOURS = 125_000, 500_000
#: Characters of a chunk that may be remembered.
SHORT = 64


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol-buffer message."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    at = 0
    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(tag & 7)
            n = number() if n is None else n
            yield tag >> 3, data[at : at + n]
            at += n


def character_map(blob: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double-array trie of byte strings, and the texts that they become."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, texts = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64), blob[4 + size :]
    offset = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
    labels, rules = np.arange(1, 256), {}
    todo = [(int(offset(units[0])), b"")]
    while todo:
        base, key = todo.pop()
        at = base ^ labels
        at = at[at < len(units)]
        for place in at[(units[at] & 0x800000FF) == (at ^ base)].tolist():
            unit, own = int(units[place]), key + bytes([place ^ base])
            below = place ^ offset(unit)
            if unit >> 8 & 1:
                begin = int(units[below]) & 0x7FFFFFFF
                rules[own.decode("utf-8")] = texts[begin : texts.index(b"\0", begin)].decode("utf-8")
            todo.append((below, own))
    return rules


def compiled(entries: dict[str, object]) -> dict:
    """A trie: a state is a dict from characters to states, with what is accepted there under the empty string."""
    root: dict = {}
    for text, accepted in entries.items():
        state = root
        for char in text:
            state = state.setdefault(char, {})
        state[""] = accepted
    return root


def accepting(root: dict, text: str, at: int) -> Iterator[tuple[int, object]]:
    """End and acceptance of every entry of a trie that ``text`` has at a place, shortest first."""
    state = root
    for end in range(at, len(text)):
        state = state.get(text[end])
        if state is None:
            return
        if "" in state:
            yield end + 1, state[""]


def shortest_path(text: str, arcs) -> list[tuple[int, ...]]:
    """Outputs along the lightest path through a machine that reads ``text``, by Dijkstra's search.

    ``arcs(text, place)`` gives lists of (end, (name, output, weight)), the arc that is to be tried first at the end
    and none lighter before it; an arc is taken up when the one after it has been. Of equally light places the
    furthest in the text comes first.
    """
    heap: list = []
    done, order, size = set(), 0, len(text)
    weight, at, node = 0.0, 0, ((), None)  # the start
    while at < size:
        rest, before, base = arcs(text, at), node, weight
        while True:
            if rest:
                end, (_, output, more) = rest.pop()
                order += 1
                heappush(heap, (base + more, -end, order, output, before, base, rest))
            weight, at, _, output, before, base, rest = heappop(heap)
            if at not in done:
                break
        if rest:
            end, (_, more_output, more) = rest.pop()
            order += 1
            heappush(heap, (base + more, -end, order, more_output, before, base, rest))
        done.add(at)
        at, node = -at, (output, before)
    path = []
    while node[1] is not None:
        path.append(node[0])
        node = node[1]
    return path[::-1]


def finite_path(text: str, ahead, allowed, finite) -> list[tuple[int, ...]]:
    """Outputs along a path through a machine whose arcs weigh nothing or infinity: the search with a stack for its queue.

    ``ahead(text, place)`` gives arcs (length, name, output), the one that is to be tried first at the front. A state is
    a place and the name of the arc that led there; of neighbouring arcs a and b ``allowed[a][b]`` says whether they
    are finite, or where it is missing ``finite(a, b)``. A state that no finite path leads on from is not tried again.
    """
    size, name, at, path, dead = len(text), "", 0, [], set()
    while at < size:
        known = allowed[name]
        for arc in ahead(text, at):
            after = arc[1]
            good = known.get(after)
            if (finite(name, after) if good is None else good) and not (dead and (at + arc[0], after) in dead):
                path.append(arc)
                at += arc[0]
                name = after
                break
        else:  # back to the state before
            dead.add((at, name))
            at -= path.pop()[0]
            name = path[-1][1] if path else ""
    return [arc[2] for arc in path]


def _side_by_side(pieces: Iterable[str], most: int = 8) -> list[set[str]]:
    """Classes of the pieces' characters, the largest first: those of one piece are in one class. Small ones beyond ``most`` are one."""
    of: dict[str, set[str]] = {}
    for piece in pieces:
        into = max((of.get(c, set()) for c in piece), key=len, default=set())
        for char in piece:
            own = of.get(char, {char})
            if own is not into:
                into |= own
                of.update(dict.fromkeys(own, into))
    found = sorted({id(x): x for x in of.values()}.values(), key=len, reverse=True)
    return [*found[: most - 1], set().union(*found[most - 1 :])] if len(found) > most else found


class Met(dict):
    """Packed ids of chunks; the path over those that are not known yet is searched."""

    def __init__(self, path: Callable[[str], bytes]) -> None:
        self.path = path
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.path(chunk)
        if len(chunk) <= SHORT:
            if len(self) >= REMEMBER:  # chunks that are met again move to the new generation
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids


class Transducer:
    """A compiled model; ``encode`` and ``decode`` are its two directions."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        self.kind, self.byte_fallback, self.prefix, self.squeeze, rules = UNIGRAM, False, True, True, b""
        for field, value in _fields(model):
            if field == 1:
                own = dict(_fields(value))
                self.pieces.append(own.get(1, b"").decode("utf-8"))
                self.scores.append(struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0])
                self.types.append(own.get(3, NORMAL))
            elif field == 2:
                own = dict(_fields(value))
                self.kind, self.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
            elif field == 3:
                own = dict(_fields(value))
                rules, self.prefix, self.squeeze = own.get(2, b""), bool(own.get(3, 1)), bool(own.get(4, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("word and character models are not supported")
        typed = list(zip(self.pieces, self.types, strict=True))
        self.ids = {p: i for i, (p, t) in enumerate(typed) if t in (NORMAL, USER)}
        self.user = [p for p, t in typed if t == USER]
        self.unknown = self.types.index(UNKNOWN) if UNKNOWN in self.types else 0
        self.byte_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(typed) if t == BYTE}
        self.raw = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.encode("utf-8") for p, t in typed]
        # the transducers
        normal = [self.scores[i] for i, t in enumerate(self.types) if t == NORMAL] or [0.0]
        weight = {p: -(len(p.encode()) * max(normal) - 0.1) if self.types[i] == USER else -self.scores[i] for p, i in self.ids.items()}
        self.far = 10 - min(normal)
        arc = {p: (len(p), p, (i,), weight[p]) for p, i in self.ids.items()}
        self.lexicon = compiled({p: self.ordered(p[0], [arc[q] for q in (p[:n] for n in range(1, len(p) + 1)) if q in arc]) for p in arc})
        self.longest = max(map(len, arc), default=1)
        todo = [(self.lexicon, None)]
        while todo:  # a state that accepts nothing gives what the one above gives
            state, above = todo.pop()
            above = state.setdefault("", above)
            todo += ((below, above) for char, below in state.items() if char)
        table = character_map(rules)
        self.rules = compiled(table | {p: p for p in self.user})
        self.spaced = any(" " in x and x != " " for x in (*table, *self.user))
        # where paths can be cut
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        classes = _side_by_side(p.lstrip(SPACE) for p in self.ids if len(p) > 1)
        inside = "".join(map(re.escape, chain.from_iterable(classes)))
        runs = "|".join(f"[{''.join(map(re.escape, sorted(x)))}]+" for x in classes)
        self.chunk = re.compile(r"(?s).+" if crossing else f"{SPACE}*(?:{runs})|{SPACE}+|[^{SPACE}{inside}]" if runs else f"{SPACE}+|[^{SPACE}]")
        self.apart = re.compile(f"({'|'.join(map(re.escape, sorted(self.user, key=len, reverse=True)))})") if self.user and self.kind == BPE else None
        self.memory = Met(self.path)
        self.asked = 0
        self.rewritten: dict[str, str] = {}
        self.allowed: defaultdict[str, dict[str, bool]] = defaultdict(dict)

    def rewrite(self, text: str) -> str:
        """The character map's path over a text: the longest rule at each place, else the character itself."""
        out, at = [], 0
        while at < len(text):
            end, to = at + 1, text[at]
            for end, to in accepting(self.rules, text, at):  # noqa: B007  the last is the longest
                pass
            out.append(to)
            at = end
        return "".join(out)

    def normal(self, text: str) -> str:
        """The normaliser's path over a text."""
        if self.rules:
            if self.spaced:
                text = self.rewrite(text)
            else:
                known = self.rewritten
                words = text.split(" ")
                for word in set(words):
                    if word not in known:
                        known[word] = self.rewrite(word)
                text = (known[" "] if " " in known else known.setdefault(" ", self.rewrite(" "))).join(map(known.__getitem__, words))
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        if not text:
            return ""
        text = (" " * self.prefix + text).replace(" ", SPACE)
        return text.rstrip(SPACE) if self.squeeze else text

    def fallback(self, char: str) -> tuple[int, ...]:
        data = char.encode("utf-8", "replace")
        return tuple(self.byte_ids[b] for b in data) if self.byte_fallback and all(b in self.byte_ids for b in data) else (self.unknown,)

    def ordered(self, char: str, arcs: Iterable[tuple] = ()) -> list[tuple]:
        """Arcs (length, name, output, weight) from the root, with byte fallback if no piece is the character alone: the lightest (of equals the longest) first."""
        arcs = [*arcs]
        if not arcs or arcs[0][0] > 1:
            arcs.insert(0, (1, char, self.fallback(char), self.far))
        return sorted(arcs, key=lambda arc: (arc[3] if self.kind == UNIGRAM else 0.0, -arc[0]))

    def ahead(self, text: str, at: int) -> list[tuple]:
        """``ordered`` arcs that leave the root at a place: the last state of the lexicon has them all."""
        state = self.lexicon
        for char in text[at : at + self.longest]:
            below = state.get(char)
            if below is None:
                break
            state = below
        return state[""] or self.ordered(text[at])

    def arcs(self, text: str, at: int) -> list[tuple]:
        """The same with ends, the first last."""
        return [(at + n, (name, output, weight)) for n, name, output, weight in reversed(self.ahead(text, at))]

    def _merged(self, text: str) -> list[str]:
        """Greedy merges of a short text: the best-scored neighbouring pair first, the leftmost of equals."""
        parts, ids, scores = list(text), self.ids, self.scores
        while len(parts) > 1:
            best, where, left = -INFINITY, -1, parts[0]
            for i in range(1, len(parts)):
                right = parts[i]
                k = ids.get(left + right)
                if k is not None and scores[k] > best:
                    best, where = scores[k], i
                left = right
            if where < 0:
                break
            parts[where - 1 : where + 1] = [parts[where - 1] + parts[where]]
        return parts

    def finite(self, a: str, b: str) -> bool:
        """Whether the merging machine's arc from piece a to piece b is finite; remembered in the row of ``a``."""
        self.asked += 1
        known = self.allowed[a][b] = self._merged(a + b) == ([a, b] if a else [b])
        return known

    def path(self, chunk: str) -> bytes:
        """Ids along the lightest path over a chunk, which begins and ends at the root."""
        if self.apart and chunk in self.user:
            found = [(self.ids[chunk],)]
        else:
            found = finite_path(chunk, self.ahead, self.allowed, self.finite) if self.kind == BPE else shortest_path(chunk, self.arcs)
        return array("i", chain.from_iterable(found)).tobytes()

    def encode(self, text: str) -> array:
        if len(self.rewritten) > REMEMBER:
            self.rewritten.clear()
        if self.asked > NEIGHBOURS:
            self.allowed.clear()
            self.asked = 0
        text = self.normal(text)
        chunks = self.chunk.findall(text) if self.apart is None else [y for i, x in enumerate(self.apart.split(text)) for y in ([x] if i % 2 else self.chunk.findall(x))]
        ids = array("i", b"".join(map(self.memory.__getitem__, chunks)))
        if not self.byte_fallback and self.unknown in ids:  # a run of unknown characters is one
            ids = array("i", [x for i, x in enumerate(ids) if x != self.unknown or not i or ids[i - 1] != x])
        return ids

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def _compiled(model: bytes) -> Transducer:
    return Transducer(model)


def encode_pieces(docs: DataFrame, text: str = "text", model_path: str = MODEL, ids: str = "ids", n_tokens: str = "n_tokens", round_trip: str = "round_trip") -> DataFrame:
    """Add ids (array<int>), their number and whether decoding them gives the text back.

    Null texts get null ids, zero tokens and a true round trip; empty texts get no ids. Texts with U+2581
    decode to spaces there. Texts are taken whole, rows that repeat are rows again, no rows give none. Columns of
    the same names are replaced; all others stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    kept = docs.drop(ids, n_tokens, round_trip)
    fields = [*kept.schema.fields]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{ids}` array<int>", f"`{n_tokens}` long", f"`{round_trip}` boolean"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _compiled(model.value)
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            found = [machine.encode(t) if t is not None else array("i") for t in texts]
            same = [t is None or machine.decode(x) == t for t, x in zip(texts, found, strict=True)]
            counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            values = np.frombuffer(b"".join(x.tobytes() for x in found), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values, pa.int32()), mask=pa.array([t is None for t in texts]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(counts), pa.array(same)], names=[*batch.schema.names, ids, n_tokens, round_trip])

    return kept.mapInArrow(lambda it: tidied(encoded(it)), schema)


def decode_pieces(rows: DataFrame, ids: str = "ids", text: str = "decoded", model_path: str = MODEL) -> DataFrame:
    """Add the text that the ids stand for (null for null ids; ids outside the model fail)."""
    import pandas as pd

    with open(model_path, "rb") as file:
        model = rows.sparkSession.sparkContext.broadcast(file.read())
    return rows.withColumn(text, F.pandas_udf(lambda s: pd.Series([None if x is None else _compiled(model.value).decode(x) for x in s], dtype=object), "string")(F.col(ids)))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the pieces of all documents, their number and the round trip."""
    return encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
