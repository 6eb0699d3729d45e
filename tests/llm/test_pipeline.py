import corpus_pipeline
from layerhouse.llm import language, quality, simhash
from layerhouse.llm.common import saved
from tests.llm.conftest import SF
from tests.llm.test_decontaminate import brute, rows
from tests.llm.test_simhash import brute_groups
from tests.llm.test_tokens import check_packing, library  # noqa: F401


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "language ID", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]


def test_each_stage_on_its_own_input(spark, documents, library):  # noqa: F811
    """Every stage against a plain version, on the rows that the stage before has kept."""
    docs = saved(documents, "input")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, saved(stage(spark, docs, SF), "stage")
        kept[name] = (before, docs)
        if name != "best-fit packing":
            assert docs.columns == documents.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    before, after = kept["quality classifier"]
    assert ids(after) == ids(quality.judge(before, quality.fit(before)).filter("keep"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in ids(before) if labels.get(i) == 1]
    assert len(set(good) & set(ids(after))) >= 0.98 * len(good)

    before, after = kept["language ID"]
    assert ids(after) == ids(language.identify(before).filter("lang_pred <> 'und' AND score >= 0.5"))

    before, after = kept["SimHash near-dedup"]
    assert ids(after) == sorted({c for _, _, c in brute_groups(rows(before, "doc_id", "text"))})

    before, after = kept["benchmark decontamination"]
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    assert ids(after) == sorted(r[0] for r in brute(rows(before, "doc_id", "text"), items) if not r[-1])
    assert 0 < len(ids(after)) < len(ids(before))

    before, after = kept["best-fit packing"]
    check_packing(library, rows(before, "doc_id", "text"), after.collect(), 1024)


def test_run_gives_the_last_stage(spark, tmp_path):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 100


def test_odd_and_no_documents(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        held = docs
        for _, stage in corpus_pipeline.STAGES:
            held = saved(stage(spark, held, SF), "odd")
        assert held.count() <= 2 * docs.count() + 500


def test_dedup_keeps_the_rows_of_a_corpus_without_copies(spark, documents):
    single = simhash.deduplicate(documents)
    assert simhash.deduplicate(saved(single, "once")).count() == single.count()


def test_columns_with_odd_names_pass_all_stages(spark, documents):
    docs = documents.limit(60).selectExpr("*", "1 as `a.b`", "'x' as `my col`", "named_struct('c.d', 2) as `s``t`", "3 as `_row`")
    for name, stage in corpus_pipeline.STAGES:
        held = saved(stage(spark, docs, SF), "odd")
        if name != "best-fit packing":
            assert held.columns == docs.columns
            assert all(r["a.b"] == 1 and r["my col"] == "x" and r["s`t"]["c.d"] == 2 for r in held.collect())
