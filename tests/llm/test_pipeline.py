"""The pipeline's stages against what each operator's brute force says about the stage's input."""

from collections import Counter

import corpus_pipeline as C
from emberlog.llm import quality_classifier
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_packing import check
from tests.llm.test_repeats import brute_words
from tests.llm.test_simhash import brute as near


def kept(df):
    return sorted((tuple(r) for r in df.select(*C.COLUMNS).collect()), key=repr)


def test_every_stage_on_its_own_input(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for i, (name, stage) in enumerate(C.STAGES):
        path = f"{tmp_path}/{i}"
        stage(spark, docs, sf).write.parquet(path)
        out = spark.read.parquet(path)
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        if i < 4:
            assert tuple(out.columns) == C.COLUMNS
        if i == 0:
            model = quality_classifier.trained(docs, spark.read.parquet(f"{sf}/labels.parquet"))
            scores = {r.doc_id: r.score for r in quality_classifier.scored(docs, model).collect()}
            assert kept(out) == [r for r in kept(docs) if scores[r[0]] >= 0.7] and out.count() < len(rows)
        if i == 1:
            stay = {k for k, _, component in near(rows) if k == component}
            assert kept(out) == [r for r in kept(docs) if r[0] in stay] and out.count() < len(rows)
        if i == 2:
            want = {k: (text, n) for k, text, _, n, _ in brute_words(rows, 35)}
            got = {r.doc_id: r for r in out.collect()}
            assert {k: r.text for k, r in got.items()} == {k: t for k, (t, _) in want.items()}
            assert all(r.n_chars == len(r.text) for k, r in got.items() if want[k][1])
            before = {r.doc_id: r for r in docs.collect()}
            assert all(tuple(r) == tuple(before[k]) for k, r in got.items() if not want[k][1])
            assert sum("\n" in r.text for k, r in got.items() if not want[k][1]) > 50
        if i == 3:
            clean = {k for k, _, n, _ in contaminated(rows, bench) if not n}
            assert kept(out) == [r for r in kept(docs) if r[0] in clean] and out.count() < len(rows)
        if i == 4:
            check(out.collect(), rows, 1024)
        docs = out


def odd(spark):
    rows = [(1, None, "en", None, 0), (1, None, "en", None, 0), (None, "", None, "s", None), (None, "word " * 60, "fr", "s", 300),
            (2, "word " * 60, "fr", "s", 300), (3, "x", None, None, 1), (3, "x", None, None, 1), (3, "y z " * 50, None, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_odd_rows_through_every_stage(spark):
    sf = "/root/testdata/sf0.001"
    for _, stage in C.STAGES:
        for docs in (odd(spark), odd(spark).limit(0)):
            stage(spark, docs.selectExpr("*", "1 AS score", "2 AS found", "3 AS chunk", "4 AS root"), sf).collect()


def test_what_the_stages_do_with_odd_rows(spark):
    """Nulls, empty texts, repeated rows: stage by stage, on rows of its own."""
    docs = odd(spark)
    cut = sorted(((r.doc_id, r.text, r.n_chars) for r in C.cut_repeated_passages(spark, docs, "").collect()), key=repr)
    assert cut == sorted([(1, None, 0), (1, None, 0), (None, "", None), (None, "", 0), (2, "", 0), (3, "x", 1), (3, "x", 1), (3, "", 0)], key=repr)
    clean = C.drop_contaminated(spark, docs, "/root/testdata/sf0.001")
    assert kept(clean) == kept(docs)
    good = C.keep_quality(spark, docs, "/root/testdata/sf0.001")
    assert Counter(kept(good)) - Counter(kept(docs)) == Counter()
    packed = C.pack(spark, docs, "").collect()
    assert Counter((r.doc_id, r.length) for r in packed if r.doc_id in (1, None)) == Counter(
        {(1, 1): 2, (None, 1): 1, **Counter((None, r.length) for r in packed if r.doc_id is None and r.length > 1)})


def test_one_row_of_each_component(spark):
    got = Counter((r.doc_id, (r.text or "")[:3]) for r in C.keep_one_of_near_duplicates(spark, odd(spark), "").collect())
    assert got == Counter({(1, ""): 1, (2, "wor"): 1, (3, "x"): 1, (3, "y z"): 1})


def test_run_gives_the_packed_rest(spark):
    out = C.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
