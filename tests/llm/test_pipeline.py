"""Every stage of the pipeline against brute force on a small table with null and repeated ids, empty and long texts."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from urbanlake.llm import pieces, store

spm = pytest.importorskip("sentencepiece")
R = random.Random(21)
VOCAB = [f"u{i}" for i in range(2000)]


def words(n):
    return [R.choice(VOCAB) for _ in range(n)]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Rows of documents by kind, and the folder of the tables."""
    rows, base, passage = [], words(120), words(30)
    say = lambda t: " ".join(t)
    toxic = [say([*words(8), "idiot", *words(9), "moron", *words(7)]) for _ in range(60)]
    clean = [say(words(R.randrange(20, 60))) for _ in range(140)]
    rows += [(i, t) for i, t in enumerate(toxic + clean, 100)]
    rows += [(900, say(base)), (901, say(base)), (902, say([*base[:50], "x", *base[51:]])), (903, say([*base[:60], *words(60)]))]
    rows += [(910, "Intro here\n\n" + say(passage) + "\nEnd  of it\n"), (911, say(words(9)) + "\n\n" + say(passage) + "\n\nlast  line"), (912, say(passage[:12]))]
    item = words(25)
    rows += [(920, say([*words(10), *item, *words(5)])), (921, say([*item[:10], "other", *item[11:]])), (922, say(item[:9]))]
    rows += [(930, say(words(5000))), (931, ""), (932, None), (933, " \n\t "), (None, say(base)), (None, None), (940, "one text"), (940, "one text"), (940, "other text")]
    docs = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 160)) for i in range(100, 300, 2)] + [(None, 1, 1), (930, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, say(item)), (None, say(base)), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), folder, rows


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


def test_toxicity_stage(spark, made):
    docs, folder, rows = made
    got = corpus_pipeline.toxic_out(spark, docs, folder)
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert pairs(got) == ordered((i, t) for i, t in rows if "idiot" not in (t or ""))


def test_near_copies_stage(spark, made):
    docs, folder, rows = made
    shingles = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)} - {()} for i, w in ((i, (t or "").split()) for i, t in rows if i not in (None, 940))}
    gone = {j for i in shingles for j in shingles if i < j and shingles[i] and shingles[j] and len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])}
    got = pairs(corpus_pipeline.near_copies_out(spark, docs, folder))
    own = [t for i, t in got if i == 940]
    assert gone == {901, 902} and len(own) == 1 and own[0] in ("one text", "other text")
    assert ordered(x for x in got if x[0] != 940) == ordered((i, t) for i, t in rows if i not in gone and i != 940)


def test_repeats_stage(spark, made):
    docs, folder, rows = made
    first = {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None and t), key=lambda x: x[0]):
        w = t.split()
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    got = {i: t for i, t in pairs(corpus_pipeline.repeats_out(spark, docs, folder)) if i not in (None, 940)}
    for i, t in rows:
        if i not in (None, 940):
            w = (t or "").split()
            gone = {q for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for q in range(k, k + 13)}
            assert (got[i] or "").split() == [x for q, x in enumerate(w) if q not in gone] and (gone or got[i] == t)
    assert got[911].endswith("\n\nlast  line") and len(got[911].split()) == 11 and got[901] == ""
    assert len(got) == len({i for i, _ in rows}) - 2
    lengths = {r.doc_id: (r.n_chars, r.text) for r in corpus_pipeline.repeats_out(spark, docs, folder).collect()}
    assert all(n == len(t or "") for n, t in lengths.values())


def test_benchmark_stage(spark, made):
    docs, folder, rows = made
    assert pairs(corpus_pipeline.benchmark_out(spark, docs, folder)) == ordered(x for x in rows if x[0] not in (920, 921))


def test_pieces_stage(spark, made):
    docs, folder, rows = made
    library = spm.SentencePieceProcessor(model_file=pieces.MODEL)
    got = corpus_pipeline.encoded(spark, docs, folder).collect()
    assert len(got) == len(rows) and all(r.ids == (None if r.text is None else library.encode(r.text)) for r in got)


def test_run_leaves_the_results_of_stages_only(spark, made, tmp_path, monkeypatch):
    docs, folder, rows = made
    monkeypatch.setattr(store, "shared_dir", lambda _: f"file://{tmp_path}")
    out = corpus_pipeline.run(spark, folder)
    names = [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()]
    assert sorted(names) == sorted(name for name, _ in corpus_pipeline.STAGES)
    want = docs
    for _, stage in corpus_pipeline.STAGES:
        want = store.written(stage(spark, want, folder), "again")
    assert pairs(out) == pairs(want) and out.filter(F.col("doc_id").isin(901, 902, 920)).count() == 0


def test_empty_documents(spark, made, tmp_path):
    docs, folder, _ = made
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
