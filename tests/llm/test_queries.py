"""Registration, SQL comparisons and the pipeline."""

import pytest
from docs_fixture import make_docs  # noqa: F401

import __spark_entry__ as E
import corpus_pipeline as P
from creditpath.llm import ctw, quality, url_filters
from creditpath.llm import queries as Q
from oracle import compare, duck

SF = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    names = E.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert set(Q.ORACLES) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_sql(spark, name):
    ok, message = compare(Q.QUERIES[name](spark, SF), Q.ORACLES[name], duck(SF))
    assert ok, message


def test_stages(spark, make_docs, tmp_path):
    """Each stage acts on what the one before kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        if k + 1 < len(P.STAGES):
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / str(k)))
            out = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(out)
        docs = out
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in seen]
    for a, b in zip(ids, ids[1:]):
        assert b <= a
    judged = Q.op3_quality_rules(spark, SF)
    assert ids[0] == {r.doc_id for r in judged.where("kept").collect()}
    assert ids[1] == ids[0]  # all of these have a clear language
    texts = {r.doc_id: r.text for r in seen[3].collect()}
    before = {r.doc_id: r.text for r in seen[2].collect()}
    changed = [i for i in texts if texts[i] != before[i]]
    assert changed and all("[" in texts[i] for i in changed)
    assert ids[4] == ids[3]


def test_groups_keep_one(spark, make_docs):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(1, base), (2, base), (3, base + " more"), (4, "quite another text with several words"), (2, base), (None, base), (4, "and a third one under the same number")]
    kept = P.keep_one_of_group(spark, make_docs(rows).drop("kept", "score", "__words", "_row", "root"), SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1), (False, 4), (False, 4), (True, 0)]


def test_language_stage_drops_texts_without_letters(spark, make_docs):
    rows = [(i, "some plain words here " * 5, "en") for i in range(5)] + [(9, "12345 67", "en"), (10, None, "en")]
    kept = P.keep_known_language(spark, make_docs(rows), SF).collect()
    assert {r.doc_id for r in kept} == set(range(5))


def test_one_of_a_group_without_ids_stays(spark, make_docs):
    words = [f"w{i}" for i in range(200)]
    base, near, other = " ".join(words), " ".join([*words[:199], "new"]), " ".join(reversed(words))
    named = " ".join(f"n{i}" for i in range(60))
    rows = [(None, base), (None, base), (None, near), (None, near), (None, other), (None, other), (3, named), (None, named), (None, ""), (None, "")]
    kept = P.keep_one_of_group(spark, make_docs(rows).drop("kept", "score", "__words", "_row", "root"), SF).collect()
    got = sorted((r.doc_id or 0, r.text) for r in kept)
    assert got in [sorted([(0, x), (0, other), (0, named), (3, named), (0, ""), (0, "")]) for x in (base, near)]


@pytest.mark.parametrize("k", range(5))
def test_stages_on_an_empty_table(spark, make_docs, k):
    docs = make_docs([]).drop("kept", "score", "__words", "_row", "root")
    out = P.STAGES[k][1](spark, docs, SF)
    assert out.collect() == [] and (k == 4 or out.columns == docs.columns)


def test_stages_on_null_and_repeated_rows(spark, make_docs):
    long = " ".join(f"some plain words number {i} stand here" for i in range(20)) + " write to jane (at) river dot com now"
    rows = [(1, long, "en"), (1, long, "en"), (None, long, "en"), (2, None, "en"), (3, "", "en"), (4, "12 34", "en")]
    docs = make_docs(rows).drop("kept", "score", "__words", "_row", "root")
    kept = P.keep_quality(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0) for r in kept) in ([], [0, 1, 1])
    assert sorted((r.doc_id or 0) for r in P.keep_known_language(spark, docs, SF).collect()) == [0, 1, 1]
    redacted = {(r.doc_id, r.text) for r in P.redact_personal_data(spark, docs, SF).collect()}
    assert {(2, None), (3, ""), (4, "12 34")} < redacted and {len(t or "") for _, t in redacted} == {0, 5, len(long) - len("jane (at) river dot com") + 7}
    pieces = P.pack_sequences(spark, docs, SF)
    assert sorted(r.doc_id or 0 for r in pieces.where("start + length = doc_tokens").collect()) == [0, 1, 1, 2, 3, 4]


def test_columns_of_clashing_names_stay(spark):
    names = ["__words", "__HASHES", "__keys", "__allow", "_n", "__n_words", "__words_aside"]
    docs = spark.createDataFrame([(1, "a b c " * 30, "http://x.net/es/", *names)], ["doc_id", "text", "url", *names])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        quality.judge_documents(docs, labels), url_filters.judge_urls(docs), ctw.score_documents(docs, docs.select("text")),
    ):
        (row,) = out.collect()
        assert [row[n] for n in names] == names
    assert row.n_tokens == 91
