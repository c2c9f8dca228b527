from __future__ import annotations

import hashlib

import pytest
from test_native import plain_mix
from test_pairs import brute

import corpus_pipeline
from sentrylake.llm import mixing, ngram_join, quality, queries, stages, toxicity


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit_model(docs, labels), quality.fit_model(docs, labels)


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_classifier", "ngram_jaccard_join", "source_mixing", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_equals_a_plain_version(spark, sf_dir, models):
    """Row by row on the driver: the models' scores, all pairs, one global sort, the tokenizer's library."""
    import re

    import sentencepiece

    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = [r for r, found in zip(rows, models[0].score_many([r["text"] for r in rows])) if found[0] < 0.3]
    rows = [r for r in rows if models[1].score(r["text"]) >= 0.3]
    classes = brute([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if classes[r["doc_id"]][0] == r["doc_id"]]
    sized = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in rows]
    copies = plain_mix(sized)[1]
    library = sentencepiece.SentencePieceProcessor(model_proto=queries.piece_model(spark))
    wanted = []
    for r, key in zip(rows, sized):
        ids = [*library.encode(r["text"] or ""), 2]
        wanted += [(r["doc_id"], ids, len(ids), hashlib.sha256((r["text"] or "").encode()).hexdigest())] * copies[key]
    got = [(r["doc_id"], list(r["ids"]), r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf_dir).collect()]
    assert sorted(got) == sorted(wanted) and got


ODD = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, None), (None, "a b c d e f g", "en", "s", 13, "y"), (3, "word " * 30_000, "en", None, 150_000, "z"), (4, "one two three four five six", "en", "s", 27, "z"), (4, "one two three four five six", "en", "s", 27, "z")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, {0} string"


@pytest.mark.parametrize("stage", range(5))
@pytest.mark.parametrize("extra", ["label", "size", "rep", "score", "c", "k", "row", "key"])
def test_stages_take_odd_rows_and_clashing_columns(spark, sf_dir, stage, extra):
    name, function = corpus_pipeline.STAGES[stage]
    docs = spark.createDataFrame(ODD, SCHEMA.format(extra))
    out = function(spark, docs, sf_dir)
    if stage < 4:
        assert out.columns == docs.columns
        known = {tuple(r) for r in docs.collect()}
        assert all(tuple(r) in known for r in out.collect())
    else:
        assert out.count() == len(ODD)
    assert function(spark, docs.limit(0), sf_dir).count() == 0


def test_stages_keep_clean_rows(spark, sf_dir, models):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = {d for d, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    kept = {r["doc_id"] for r in stages.drop_poor(spark, stages.drop_toxic(spark, docs, sf_dir), sf_dir).collect()}
    assert len(clean & kept) >= 0.95 * len(clean)


def test_nothing_is_written_outside_the_shared_folder(spark, sf_dir, tmp_path):
    from sentrylake.llm.common import discard, materialize, shared_folder

    kept = materialize(spark.range(3), "x")
    assert all(shared_folder(spark).removeprefix("file:") in f for f in kept.inputFiles()) and kept.count() == 3
    discard(kept)
    assert "localCheckpoint" not in "".join(open(m.__file__).read() for m in (mixing, ngram_join, toxicity, quality, stages, queries))
