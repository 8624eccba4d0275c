"""The transducers against the library: byte-pair and unigram models put together by hand, character maps, user pieces."""

import random

import pytest

from urbanlake.llm import pieces

spm = pytest.importorskip("sentencepiece")
pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
LETTERS = "abcdeé漢"
TEXT = LETTERS + "  fFｆﬁ①\t\n 　ＡÅÅ.,😀▁0"


def made(kind, seed, rules, fallback, user=(), prefix=True, squeeze=True):
    """A model file: random pieces and scores; pieces of byte-pair models are made by merging two others."""
    r = random.Random(seed)
    m = pb2.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = kind, fallback
    if rules:
        m.normalizer_spec.CopyFrom(pb2.ModelProto.FromString(spm.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()).normalizer_spec)
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces, m.normalizer_spec.escape_whitespaces = prefix, squeeze, True
    add = lambda piece, score, kind: m.pieces.add(piece=piece, score=score, type=kind)
    add("<unk>", 0, pieces.UNKNOWN)
    add("<s>", 0, pieces.CONTROL)
    for p in user:
        add(p, 0, pieces.USER)
    if fallback:
        for b in range(256):
            add(f"<0x{b:02X}>", 0, pieces.BYTE)
    known = list(LETTERS[:-1] + "fiA1.▁")
    for _ in range(60):
        x = r.choice(known) + r.choice(known)
        if len(x) < 7 and "▁" not in x[1:] and x not in known and x not in user:
            known.append(x)
    for i, x in enumerate(known):
        add(x, round(-r.random() * 9, 3) - len(x) % 3 if kind == pieces.UNIGRAM else float(-i), pieces.NORMAL)
    return m.SerializeToString()


@pytest.mark.parametrize("kind", [pieces.BPE, pieces.UNIGRAM])
@pytest.mark.parametrize("rules", [False, True])
@pytest.mark.parametrize("fallback", [False, True])
def test_made_models_equal_the_library(kind, rules, fallback):
    r = random.Random(kind * 10 + rules * 2 + fallback)
    for seed in range(3):
        model = made(kind, seed, rules, fallback, user=("bad", "ce", "①") if seed == 1 else (), prefix=seed != 2, squeeze=seed != 2)
        machine, library = pieces.Transducer(model), spm.SentencePieceProcessor(model_proto=model)
        for _ in range(150):
            text = "".join(r.choice(TEXT) for _ in range(r.randrange(60)))
            got, want = list(machine.encode(text)), library.encode(text)
            if kind == pieces.UNIGRAM and got != want:  # equally light paths: the library's choice hangs on its 32-bit sums
                assert machine.decode(got) == machine.decode(want) and abs(sum(machine.scores[i] for i in got) - sum(machine.scores[i] for i in want)) < 1e-4
                continue
            assert got == want, (seed, text, library.encode(text, out_type=str), [machine.pieces[i] for i in got])


def test_unknown_model_kinds_are_refused():
    with pytest.raises(ValueError, match="not supported"):
        pieces.Transducer(made(3, 0, False, False))


def test_shortest_path_equals_brute_force():
    r = random.Random(1)
    for _ in range(200):
        names = {"".join(r.choice("ab") for _ in range(r.randrange(1, 4))): r.randrange(1, 9) for _ in range(6)} | {"a": 5, "b": 4}
        text = "".join(r.choice("ab") for _ in range(r.randrange(9)))

        def arcs(text, at, names=names):
            return sorted(((at + len(n), (n, (n,), w)) for n, w in names.items() if text.startswith(n, at)), key=lambda x: -x[1][2])

        best = [0.0]
        for end in range(1, len(text) + 1):
            best.append(min(best[end - len(n)] + w for n, w in names.items() if len(n) <= end and text[end - len(n) : end] == n))
        path = pieces.shortest_path(text, arcs)
        assert "".join(n for (n,) in path) == text and sum(names[n] for (n,) in path) == best[-1]


def test_marks_are_cut_off_and_neighbours_outlive_a_generation(monkeypatch):
    """A word is searched once whatever marks follow it; a new generation of chunks asks for no neighbours again."""
    with open(pieces.MODEL, "rb") as file:
        model = file.read()
    machine, library, asked = pieces.Transducer(model), spm.SentencePieceProcessor(model_file=pieces.MODEL), []
    merged = machine._merged
    monkeypatch.setattr(machine, "_merged", lambda text: asked.append(text) or merged(text))
    monkeypatch.setattr(pieces, "REMEMBER", 5)
    text = "thingble. thingble, (thingble) thingble! города, города 数据获取。"
    assert list(machine.encode("thingble. thingble, thingble!")) == library.encode("thingble. thingble, thingble!")
    assert set(machine.memory) == {"▁thingble", ".", ",", "!"}
    for _ in range(3):
        for word in (text, *text.split()):
            assert list(machine.encode(word)) == library.encode(word)
            assert len(machine.memory) <= 5 and len(machine.memory.older) <= 5
    assert len(asked) == machine.asked == sum(map(len, machine.allowed.values()))


def test_finite_path_leaves_dead_ends():
    """The furthest arc first; a state that no finite path leads on from is tried once."""
    names, forbidden, asked = ("a", "aa", "aaa", "b"), {("aaa", "aa"), ("aaa", "a"), ("aa", "aa"), ("a", "aaa"), ("aa", "b"), ("aaa", "b")}, []

    def finite(a, b):
        asked.append((a, b))
        known[a][b] = (a, b) not in forbidden
        return known[a][b]

    def ahead(text, at):
        return [(len(n), n, (n,)) for n in sorted(names, key=len, reverse=True) if text.startswith(n, at)]

    known = pieces.defaultdict(dict)
    assert pieces.finite_path("aaaab", ahead, known, finite) == [("aa",), ("a",), ("a",), ("b",)]
    assert len(asked) == len(set(asked)) and pieces.finite_path("", ahead, known, finite) == []


def test_whole_documents_equal_the_library(spark):
    library = spm.SentencePieceProcessor(model_file=pieces.MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = pieces.encode_pieces(docs.unionAll(docs.limit(3))).collect()
    assert len(rows) == docs.count() + 3
    for row in rows:
        assert row.ids == (None if row.text is None else library.encode(row.text)) and row.n_tokens == len(row.ids or ())
        assert row.text is None or row.round_trip == (library.decode(row.ids) == row.text)
