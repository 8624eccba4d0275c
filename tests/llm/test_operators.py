"""Each operator on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlake.llm import decontaminate, embeddings, graph, language_id, language_model, near_dup, pieces, substrings, toxicity, warc, wrappers

R = random.Random(5)
VOCAB = [f"w{i}" for i in range(400)]


def words(n):
    return [R.choice(VOCAB) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    base, passage = words(120), words(40)
    near = [*base[:60], "changed", *base[61:]]
    rows = [(1, base), (2, base), (3, near), (4, words(90)), (5, words(20) + passage + words(20)), (6, words(5) + passage), (7, ["a", "b"]), (8, ["a", "b"]), (9, words(4000))]
    return [(i, " ".join(t)) for i, t in rows] + [(10, ""), (11, None), (12, " \n "), (1, " ".join(base)), (None, " ".join(base))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    names = "doc_id long, text string, id long, key string, words string, bucket int, host string"
    return spark.createDataFrame([(i, t, 0, "k", "w", 1, "h") for i, t in texts], names)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (7, 7), (5, None)], "a long, b long")
    assert dict(map(tuple, graph.components(e, "a", "b").collect())) == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}


def test_near_duplicates(docs, empty, texts):
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs).collect()}
    assert [got[i].component_id for i in (1, 2, 3, 4, 7, 8, 10, 11)] == [1, 1, 1, 4, 7, 7, 10, 11]
    assert got[7].n_shingles == 1 and got[10].n_shingles == 0 and got[None].kept
    t = dict(texts)[9].split()
    assert got[9].n_shingles == len({tuple(t[i : i + 3]) for i in range(len(t) - 2)})
    assert near_dup.near_duplicates(empty).count() == 0


def test_remove_repeats(docs, empty, texts):
    own = {i: (t or "").split() for i, t in texts if i is not None}
    first = {}
    for i in sorted(own):
        for p in range(len(own[i]) - 12):
            first.setdefault(tuple(own[i][p : p + 13]), i)
    want = {}
    for i, t in own.items():
        gone = {q for p in range(len(t) - 12) if first[tuple(t[p : p + 13])] < i for q in range(p, p + 13)}
        want[i] = (len(t), len(gone), " ".join(w for q, w in enumerate(t) if q not in gone))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substrings.remove_repeats(docs).collect() if r.doc_id is not None}
    assert got == want and want[6][1] == 40
    assert substrings.remove_repeats(empty).count() == 0


def test_heavy_minimisers_are_dealt_out(docs):
    rows = docs.select(F.col("doc_id").alias("id"), "text").filter("id > 1 and text is not null").withColumn("part", F.lit(0).cast("long"))
    want = sorted(map(tuple, substrings.repeated_runs(rows).collect()))
    covered = lambda runs: {(i, q) for i, _, a, b in runs for q in range(a, b)}
    for most in (20, 0):
        assert covered(map(tuple, substrings.repeated_runs(rows, most=most).collect())) == covered(want)
    pairs = substrings.Words([" ".join(f"q{i}" for i in range(20000)).encode()]).hash
    low = int(substrings.sequence_hash([pairs[:-1], pairs[1:]], 7).argmin())  # a pair that is nearly always the minimiser
    many = substrings.Words([" ".join([*words(6), f"q{low}", f"q{low + 1}", *words(6)]).encode() for _ in range(3000)])
    at, key, _ = substrings._window_keys(many, 13, 2, [])
    keys, count = np.unique(key, return_counts=True)
    _, n, dealt = substrings._super_kmers(many, 13, 2, [keys[[count.argmax()]]])
    assert n.sum() == len(at) and count.max() > 5000 > 500 > np.bincount(np.unique(dealt, return_inverse=True)[1], weights=n).max()


def test_decontaminate_finds_every_allowed_number_of_substitutions(spark):
    """Planted windows of all lengths from 5 tokens with every number of replaced tokens that 80 percent allow, and one more."""
    r, items, texts, held = random.Random(2), [], [], {}
    fresh = lambda n: [f"w{r.randrange(6000)}" for _ in range(n)]
    for n in range(3, 24):
        w = min(16, n)
        for k in range(w - math.ceil(0.8 * w) + 2):
            for _ in range(25):
                item, at = fresh(n), r.randrange(n - w + 1)
                part = item[at : at + w]
                for j in r.sample(range(w), k):
                    part[j] = "other" + part[j]
                held[len(items)] = n >= 5 and k <= w - math.ceil(0.8 * w)
                texts.append((len(items), " ".join(fresh(r.randrange(20)) + part + ["end"] + fresh(r.randrange(20)))))
                items.append((len(items), " ".join(item)))
    got = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r["items"] for r in got} == {i: [i] for i, ok in held.items() if ok}


def test_decontaminate(spark, docs, empty, monkeypatch):
    t = {r.doc_id: r.text for r in docs.collect() if r.text}
    item = t[5].split()[20:60]
    for k in (7, 15, 29):
        item[k] = "other"
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(words(40))), (3, "too short"), (None, t[4]), (5, None)], "item_id long, text string")
    found = lambda b: {r.doc_id: r["items"] for r in decontaminate.contaminated(docs, b).collect()}
    assert found(bench) == {5: [1], 6: [1]}
    short = bench.unionAll(spark.createDataFrame([(7, " ".join(t[4].split()[3:10])), (8, " ".join(t[5].split()[:5])), (9, "a b"), (10, " ".join(t[4].split()[3:9]) + " other")], bench.schema))
    want = {4: [7, 10], 5: [1, 8], 6: [1]}  # item 10 has six of seven tokens
    assert found(short) == want
    monkeypatch.setattr(decontaminate, "MAX_SEEDS", 0)  # seeds are shuffled
    assert found(short) == want
    assert decontaminate.contaminated(empty, bench).count() == 0 == decontaminate.contaminated(docs, bench.limit(0)).count()


def test_decontaminate_with_a_large_benchmark_shuffles_few_seeds_and_no_hit_carries_a_text(spark, monkeypatch):
    """Texts of 3,000 words, of which some hold an item; items of one text under 30 ids, null and repeated document ids."""
    r = random.Random(5)
    fresh = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    items = [" ".join(fresh(40)) for _ in range(20)]
    bench = spark.createDataFrame([(i + 100 * k, x) for k in range(30) for i, x in enumerate(items)], "item_id long, text string")
    texts = [(k if k % 7 else None, " ".join(fresh(1500) + (items[k].split()[5:30] if k < 20 else []) + fresh(1500))) for k in range(40)] + [(1, items[2] + " end"), (1, items[2] + " end"), (50, ""), (51, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    of = lambda *at: sorted(i + 100 * k for k in range(30) for i in at)
    want = {k: of(k) for k in range(20) if k % 7} | {None: of(0, 7, 14), 1: of(1, 2)}
    found = lambda: {x.doc_id: x["items"] for x in decontaminate.contaminated(docs, bench).collect()}

    def stages():
        context, jvm = spark.sparkContext, spark.sparkContext._gateway
        context._jsc.sc().listenerBus().waitUntilEmpty()
        listed = context._jsc.sc().statusStore().stageList(None, False, False, jvm.new_array(jvm.jvm.double, 0), jvm.jvm.java.util.ArrayList())
        return {x.stageId(): (x.shuffleWriteRecords(), x.shuffleWriteBytes()) for x in (listed.apply(i) for i in range(listed.size()))}

    assert found() == want
    monkeypatch.setattr(decontaminate, "MAX_SEEDS", 0)
    before = max(stages())
    assert found() == want
    rows, size = map(sum, zip(*(x for k, x in stages().items() if k > before), strict=True))
    assert rows < 120_000 and size < 3e6  # the texts have 120,000 tokens, four seeds each


def test_sentencepiece_matches_the_library():
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    with open(pieces.MODEL, "rb") as f:
        machine = pieces.Transducer(f.read())
    for _ in range(400):
        s = "".join(R.choice("abcdefghe tion  ing▁é漢.,!?\n\t😀0123") for _ in range(R.randint(0, 120)))
        ids = list(machine.encode(s))
        assert ids == sp.encode(s) and machine.decode(ids) == sp.decode(ids)


def test_encode_pieces(docs, empty):
    rows = pieces.encode_pieces(docs.select("doc_id", "text", F.lit("x").alias("ids"))).collect()
    assert all(r.round_trip for r in rows) and {r.n_tokens for r in rows if not r.text} == {0}
    back = pieces.decode_pieces(pieces.encode_pieces(docs.select("text"))).collect()
    assert all(r.decoded == r.text for r in back)
    assert pieces.encode_pieces(empty).count() == 0


def test_language_model(docs, empty, texts):
    got = {r.doc_id: r for r in language_model.score_texts(docs, F.col("doc_id") != 4).collect()}
    train = [(t or "").lower().split() + [""] for i, t in texts if i not in (4, None)]
    counts = {}
    for t in train:
        for w in t:
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    own = dict(texts)[4].split() + [""]
    assert got[4].train_tokens == total and got[4].n_tokens == len(own) and got[4].n_known == sum(w in counts for w in own)
    assert math.isclose(got[4].base_score, sum(math.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in own), rel_tol=1e-9)
    assert got[10].n_tokens == 1 and all(r.score < 0 for r in got.values())
    assert language_model.score_texts(empty, F.col("doc_id") > 0).count() == 0


def test_embeddings(spark):
    g = np.random.default_rng(3)
    base = g.normal(size=(40, 16))
    v = np.concatenate((base, base[:20] + 0.1 * g.normal(size=(20, 16)), base[:3]))
    rows = [(i, [float(z) for z in x], i % 2) for i, x in enumerate(v)] + [(100, None, 0), (101, [0.0] * 16, 0), (102, [float("nan")] * 16, 0), (103, [1.0] * 16, None), (104, [None] * 16, 1), (105, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    u = v / np.linalg.norm(v, axis=1)[:, None]
    link = (u @ u.T >= 0.93) & (np.arange(len(v))[:, None] % 2 == np.arange(len(v)) % 2) & ~np.eye(len(v), dtype=bool)
    got = {r.vec_id: r for r in embeddings.linked_vectors(df).collect()}
    assert [got[i].n_links for i in range(len(v))] == link.sum(axis=1).tolist()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(100, 106))
    assert embeddings.linked_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("parts, pairs", [(2, 250), (3, 100), (4, 30)])
def test_embeddings_with_long_codes(spark, monkeypatch, parts, pairs):
    monkeypatch.setattr(embeddings, "BUCKET_ROWS", 2 * pairs / 128**parts * 1.01)
    g = np.random.default_rng(parts)
    x, y = g.normal(size=(2, pairs, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(axis=1)[:, None] * x
    y = 0.9301 * x + math.sqrt(1 - 0.9301**2) * y / np.linalg.norm(y, axis=1)[:, None]
    v = np.concatenate((x, y))
    df = spark.createDataFrame([(i, z.tolist(), 0) for i, z in enumerate(v)], "vec_id long, embedding array<double>, label int")
    want = (v @ v.T >= 0.93).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embeddings.linked_vectors(df).collect()}
    assert want.sum() >= 2 * pairs and all(got[i] <= n for i, n in enumerate(want))
    assert want.sum() - sum(got.values()) <= 2 * embeddings.MISS * want.sum()


def test_toxicity(spark):
    rows = [(" ".join(words(30) + (["idiot"] if k % 3 == 0 else []) + words(30)), int(k % 3 == 0)) for k in range(120)]
    model = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"), exceptions=["blessed idiot"])
    low, high, folded, excused, none = model.score(["a calm text", "you 1DI0T idiot", "an іdiоt there", "a blessed idiot", None])
    assert high > 0.5 > low and folded > 0.5 > excused and none == low
    assert toxicity.learn(spark.createDataFrame([], "text string, toxic int")).score(["idiot"])[0] < 0.5


def test_language_id(spark):
    say = {"aa": "the and of to in", "bb": "der die und das ist"}
    rows = [(" ".join(R.choices(v.split(), k=20)), k) for k, v in say.items() for _ in range(30)]
    df = spark.createDataFrame([*rows, (None, "aa"), ("text", None)], "text string, lang string")
    model = language_id.learn(df)
    assert model.predict(["the of", "und dass istt", "123 !", None])[0] == ["aa", "bb", "und", "und"]
    assert language_id.identify(df.limit(0), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>H</header><nav><ul><li><a href=/a>a</a></ul></nav>
<div class="cookie-notice">Cookies</div><aside>Side</aside>%s<form><label>Mail</label><input></form><div id="comments"><p>A comment</div><footer>&copy; F</footer></body></html>"""


def test_pages(spark):
    body = "<h1>Ti&amp;tle %d</h1><p><b>One  \n two<br>three<p>Four %d</p><div class=ad>Buy</div><ul><li>x<li>y</ul>"
    rows = [(k, "http://h/x", PAGE % f"<article>{body % (k, k)}</article>") for k in range(5)] + [(9, None, None), (10, "http://h/y", ""), (11, "bad url", "<p>broken <b"), (12, "http://g/", PAGE % ("<div class=content>" + body % (12, 12) + "</div>"))]
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = lambda k: f"Ti&tle {k}\n\nOne two three\n\nFour {k}\n\nx\n\ny"
    assert [got[k] for k in (0, 4, 9, 10, 11, 12)] == [want(0), want(4), "", "", "broken", want(12)]


def test_pages_with_teasers(spark):
    say = lambda k: " ".join(f"long{k}x{i}" for i in range(60))
    body = "<div class=content><h1>Head %d</h1><p>%s</p><p>End %d</p></div><section>Same on all</section><article><a href=/t>Teaser %d</a></article><article><a href=/s>Short %d</a></article>"
    rows = [(k, "http://t/x", PAGE % (body % (k, say(k), k, k, k))) for k in range(4)]
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Head {k}\n\n{say(k)}\n\nEnd {k}" for k in range(4)}
    pair = [x for x in wrappers.parse("<h2>a</h2><p>b</p>" * 3).items]
    model = wrappers.align(wrappers.parse("<h2>a</h2><p>b</p>" * 2).items, wrappers.parse("<h2>a</h2><p>b</p>" * 4).items)
    assert [x.key for x in wrappers.matched(pair, model)] == ["h2", "p"] * 3


def test_copies_of_a_page_make_no_constants(spark):
    rows = [(k, "http://c/x", "<div><h1>T</h1><div class=content>text</div></div>") for k in range(4)]
    other = [(10 + k, "http://d/x", f"<section>Same</section><div><h1>T{k}</h1><p>text</div>") for k in range(3)]
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(rows + other, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(4)] == ["T\n\ntext"] * 4 and [got[10 + k] for k in range(3)] == [f"T{k}" for k in range(3)]


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/\n", "same"), (2, "http://b", "same"), (3, None, ""), (4, "u", None), (5, "u", "é" * 30000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_pages(df, f"file://{tmp_path}/w")
    got = {r.record_id: r for r in warc.read_warc(spark, f"file://{tmp_path}/w").collect()}
    assert [got[f"urn:page:{i}"].record_type for i in range(1, 6)] == ["revisit", "response", "revisit", "response", "response"]
    assert got["urn:page:1"].refers_to == "urn:page:2" and got["urn:page:1"].payload_length == 4 and bytes(got["urn:page:5"].payload).decode() == "é" * 30000
    assert got["urn:page:5"].payload_digest == warc.sha1_base32(("é" * 30000).encode()) and all(r.payload_ok is not False for r in got.values())
    few = warc.read_warc(spark, f"file://{tmp_path}/w", payload=False).filter("record_type = 'revisit'").collect()
    assert sorted(r.record_id for r in few) == ["urn:page:1", "urn:page:3"] and all(r.payload is None for r in few)
    plain = warc.record({"record_id": "x", "record_type": "response", "target_uri": None, "date": "d", "payload_digest": None, "refers_to": None, "payload_length": None, "payload": b"abc"})
    (tmp_path / "p.warc").write_bytes(plain * 2)
    assert [bytes(r.payload) for r in warc.read_warc(spark, f"file://{tmp_path}/p.warc").collect()] == [b"abc", b"abc"]


def test_hashes_of_words():
    from urbanlake.llm.words import Words, canonical

    w = Words([canonical("a b  a"), b"", canonical("B a", lower=True)])
    assert w.counts.tolist() == [3, 0, 2] and w.hash[0] == w.hash[2] == w.hash[4] and w.hash[1] == w.hash[3] != w.hash[0]
    assert re.fullmatch(r"[0-9a-f]{64}", hashlib.sha256(w.data).hexdigest())
