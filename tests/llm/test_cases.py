"""Cases that once went wrong: repeated ids, hashes of texts as samples, numerals, look-alikes, dealt buckets."""

import math
import random

import numpy as np
import pytest

from urbanlake.llm import embeddings, language_id, near_dup, substrings, toxicity, warc

R = random.Random(11)
VOCAB = [f"v{i}" for i in range(900)]


def words(n):
    return [R.choice(VOCAB) for _ in range(n)]


def test_repeats_of_one_id_with_two_texts(spark):
    a, b, c = words(30), words(30), words(30)
    rows = [(1, " ".join(a)), (2, " ".join(b)), (2, " ".join(c)), (2, " ".join(c)), (3, " ".join(b[:20])), (3, " ".join(words(5) + a)), (None, " ".join(a)), (2, None)]
    docs = spark.createDataFrame([(*r, 7, 0) for r in rows], "doc_id long, text string, id int, part int")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substrings.remove_repeats(docs).collect())
    assert got == sorted([(1, 30, 0), (2, 30, 0), (2, 30, 0), (2, 30, 0), (2, 0, 0), (3, 20, 20), (3, 35, 30), (0, 30, 0)])


def test_near_copies_of_one_id_with_two_texts(spark):
    a, b = words(80), words(80)
    rows = [(5, a), (7, b), (9, a), (9, b), (9, b), (11, words(60)), (12, [*b[:40], "x", *b[41:]])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert got == {(5, 5, True), (7, 5, False), (9, 5, False), (11, 11, True), (12, 5, False)}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies_equal_brute_force(spark, percent):
    rows = []
    for _ in range(40):
        base = words(R.randrange(40, 150))
        for _ in range(R.randrange(1, 6)):
            rows.append([w if R.random() > R.choice((0, 0.01, 0.03)) else "new" + w for w in base])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in rows]
    least = list(range(len(rows)))
    changed = True
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, size=5, percent=percent).collect()}
    assert got == {i: (len(sets[i]), least[i]) for i in range(len(rows))} and len(links) > 40


def test_languages_of_repeated_texts_are_learned(spark):
    german, english = "der die und das ist nicht", "the and of to in is"
    rows = [(i, german, "de") for i in range(3000)] + [(5000 + i, " ".join(R.choices(english.split(), k=12)), "en") for i in range(400)] + [(9, "uno dos tres", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs, max_rows=100, key="doc_id")
    assert model.languages == ["de", "en", "es"] and model.predict([german, english, "dos tres"])[0] == ["de", "en", "es"]
    same = spark.createDataFrame([(1, german, "de")] * 3000, "doc_id long, text string, lang string")
    assert language_id.learn(same, max_rows=1, key="doc_id").languages == ["de"]


def test_characters_of_the_sample_are_bounded(spark):
    rows = [(i, f"eins zwei drei {i:04d}", "de") for i in range(2000)] + [(5000 + i, "one two " * (1 + 5000 * (i == 3)), "en") for i in range(50)] + [(9000, "uno " * 9000, "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for limit in (300, 6000, 60_000):
        got = [(r.text, r.lang) for r in language_id.sampled(docs, 10_000, "doc_id", limit).collect()]
        chars = {x: sum(len(t) for t, y in got if y == x) for x in ("de", "en", "es")}
        assert 0 < chars["de"] < 1.5 * limit / 3 and 0 < chars["en"] < 1.5 * limit / 3 and chars["es"] == 36_000  # its only text
    assert language_id.learn(docs, key="doc_id", max_chars=6000).predict(["zwei drei", "two one", "uno"])[0] == ["de", "en", "es"]


def test_language_scores_equal_brute_force(spark):
    rows = [(" ".join(R.choices(VOCAB[k * 20 : k * 20 + 60], k=30)), f"l{k}") for k in range(3) for _ in range(12)]
    model = language_id.learn(spark.createDataFrame(rows, "text string, lang string"))
    counts = {}
    for text, lang in rows:
        for w in text.split():
            w = "".join(c for c in w if c.isalpha())
            for n in range(6):
                for g in [w] if n == 0 else language_id.grams(w, n):
                    counts.setdefault((n, g), {}).setdefault(lang, 0)
                    counts[n, g][lang] += 1
    sums = {(n, lang): sum(c.get(lang, 0) for (m, _), c in counts.items() if m == n) for n in range(6) for lang in model.languages}
    known = {k for k, c in counts.items() if sum(c.values()) >= 2 or 1 <= k[0] <= 3}

    def score(word):
        if (0, word) in known:
            found = [(0, word)]
        else:
            found = next((f for n in range(5, 0, -1) if (f := [(n, g) for g in language_id.grams(word, n) if (n, g) in known])), [])
        return [sum(math.log((counts[k].get(x, 0) + 0.1) / (sums[k[0], x] + 1)) for k in found) / max(1, len(found)) for x in model.languages]

    for text in ("v", "vv zz", "Vz v v", "q"):
        total = np.sum([score(w) for w in language_id.words_of(text)], axis=0)
        p = np.exp(total - total.max())
        lang, got = model.predict([text])
        assert lang[0] == model.languages[int(p.argmax())] and math.isclose(got[0], p.max() / p.sum(), rel_tol=1e-9)


def test_numerals_are_no_letters(spark):
    model = language_id.Model(["aa"], {"x": 0}, {}, np.zeros((1, 1)))
    assert model.predict(["½ ² Ⅷ ①", "x²", "12_3", ""])[0] == ["und", "aa", "und", "und"]
    docs = spark.createDataFrame([(1, "x", "a", 0.5), (1, "x", "a", 0.5), (2, None, "b", 1.0)], "doc_id long, text string, lang_pred string, score double")
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()) == [(1, "aa", 1.0), (1, "aa", 1.0), (2, "und", 0.0)]


@pytest.mark.parametrize("text", ["ƒuck", "fųck", "FＵck", "ꜰᴜᴄᴋ", "fu​ck", "fυсk"])
def test_look_alikes_fold(text):
    assert toxicity.fold(text) == " fuck "
    assert toxicity.fold("ıd!ot 1d10t $hit a$$") == " idiot idiot shit ass " and toxicity.fold("") == "  " == toxicity.fold(None)


def test_weights_equal_brute_force():
    r = random.Random(4)
    terms = {f"{a}{b}": r.random() + 0.5 for a in "abc" for b in "ab"} | {"a*": 0.3, "ca*": 4.0}
    exceptions = ["ab ba", "ba ab ab", "ca cc"]
    matcher = toxicity.Matcher(list(terms.items()), exceptions)
    for _ in range(300):
        own = [r.choice("abc") + r.choice("abc") for _ in range(r.randrange(12))]
        excused = set()
        for x in exceptions:
            n = len(x.split())
            excused |= {i + k for i in range(len(own) - n + 1) if own[i : i + n] == x.split() for k in range(n)}
        want = sum(max([terms.get(w, 0.0), *(v for t, v in terms.items() if t.endswith("*") and w.startswith(t[:-1]))]) for i, w in enumerate(own) if i not in excused)
        assert math.isclose(matcher.weight(toxicity.fold(" ".join(own))), want, abs_tol=1e-9)


def test_toxicity_of_repeated_rows_and_clashing_columns(spark):
    rows = [(k, " ".join(words(20) + (["idiot"] if k % 3 == 0 else []) + words(20)), int(k % 3 == 0)) for k in range(120)]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows] + [(None, None, 1, "x", 1.0), (3, "", None, "x", 1.0)], "doc_id long, text string, toxic int, _found string, toxicity double")
    sample = toxicity.labelled_sample(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert 60 < sample.count() < 120
    model = toxicity.learn(sample)
    out = toxicity.score_toxicity(docs, model)
    assert out.columns == docs.columns and out.count() == 122
    assert all((r.toxicity >= 0.5) == (r.toxic == 1) for r in out.filter("doc_id is not null and toxic is not null").collect())
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_components_and_dealt_buckets_of_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # buckets are dealt out
    g = np.random.default_rng(9)
    centres = g.normal(size=(6, 32))
    v = np.concatenate([c + g.normal(size=(40, 32)) * s for c, s in zip(centres, (0.1, 0.2, 0.25, 0.3, 0.5, 0.0), strict=True)])
    rows = [(int(i), v[i].tolist(), "x", 1, "y") for i in g.permutation(len(v))]
    got = {r.vec_id: r for r in embeddings.linked_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, t int, code string")).collect()}
    u = v / np.linalg.norm(v, axis=1)[:, None]
    link = (u @ u.T >= 0.93) & ~np.eye(len(v), dtype=bool)
    least = np.arange(len(v))
    for _ in range(len(v)):
        least = np.minimum(least, np.where(link, least[None, :], len(v)).min(axis=1))
    found, want = sum(r.n_links for r in got.values()), int(link.sum())
    assert want >= found >= want - 2 * math.ceil(embeddings.MISS * want)
    assert [got[i].component_id for i in range(len(v))] == least.tolist() and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert len({r.component_id for r in got.values()}) < len(v) - 100


def test_an_exception_that_equals_a_term_wins():
    matcher = toxicity.Matcher([("hello", 2.0), ("bad", 1.0), ("bad", 3.0)], ["hello"])
    assert matcher.weight(toxicity.fold("hello")) == 0.0 and matcher.weight(toxicity.fold("hello bad")) == 3.0


def test_a_column_named_like_the_helpers_stays(spark):
    rows = spark.createDataFrame([(1, "der die das", "de", 7, 8)], "doc_id long, text string, lang string, _found int, _found_ int")
    got = language_id.identify(rows, language_id.learn(rows.select("doc_id", "text", "lang"), key="doc_id")).collect()
    assert [(r._found, r._found_, r.lang_pred) for r in got] == [(7, 8, "de")]


def test_embeddings_of_null_and_repeated_ids(spark):
    a, b, c = [1.0, 0.0, 0.1, 0.0], [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, a), (2, b), (2, b), (3, c), (None, a), (None, c), (4, c), (4, a)]
    df = spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<double>, label string, id string, n int")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id or 0, r.kept) for r in embeddings.linked_vectors(df).collect())
    # 1, 2 and 4's second vector link; 3 and 4's first vector link; id 4 has the most links that one of its vectors has
    assert got == [(0, 0, 0, True)] * 2 + [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 1, 3, True), (4, 2, 1, False), (4, 2, 1, False)]


def test_warc_of_null_ids_equal_rows_and_clashing_columns(spark, tmp_path):
    rows = [(1, "http://a", "same"), (1, "http://a", "same"), (None, "http://b", "same"), (None, "http://c", "own"), (2, None, None), (3, "u" * 5000, "x" * 3_000_000), (4, "http://d", "sam")]
    df = spark.createDataFrame([(*r, "s", 9, "o", b"p") for r in rows], "page_id long, url string, html string, sha string, payload_length int, owner string, payload binary")
    warc.write_pages(df, f"file://{tmp_path}/w")
    got = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_length, r.payload_ok) for r in warc.read_warc(spark, f"file://{tmp_path}/w").collect())
    assert got == sorted([
        ("urn:page:1", "response", "", 4, True), ("urn:page:1", "response", "", 4, True), ("urn:page:null", "revisit", "urn:page:1", 4, None), ("urn:page:null", "response", "", 3, True),
        ("urn:page:2", "response", "", 0, True), ("urn:page:3", "response", "", 3_000_000, True), ("urn:page:4", "response", "", 3, True),
    ], key=lambda r: r[:4])
    long = [r.target_uri for r in warc.read_warc(spark, f"file://{tmp_path}/w").filter("record_id = 'urn:page:3'").collect()]
    assert long == ["u" * 5000]


def test_warc_of_an_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_pages(none, f"file://{tmp_path}/w")
    assert warc.read_warc(spark, f"file://{tmp_path}/w").count() == 0
