"""Empty tables, long texts, null ids and nested fits of the earlier operators and the pipeline."""

import time

import numpy as np
import pytest

import corpus_pipeline
from paritas.llm import chat, decontamination, line_quality, queries
from paritas.llm.common import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def emptied(spark, tmp_path_factory):
    """The tables of a directory, without rows."""
    path = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "benchmark", "pages", "conversations", "embeddings"):
        read(spark, SF, t).limit(0).write.parquet(f"{path}/{t}.parquet")
    return path


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "op4_chat"])
def test_empty_tables_give_no_rows(spark, emptied, name):
    assert queries.QUERIES[name](spark, emptied).collect() == []


def test_empty_tables_give_the_probe_conversation_only(spark, emptied):
    assert [r.conv_id for r in queries.op4_chat(spark, emptied).collect()] == [-1]


def test_pipeline_on_empty_tables(spark, emptied):
    assert corpus_pipeline.run(spark, emptied).collect() == []


def test_long_texts_are_cut_in_linear_time(spark):
    said = "x😀y " * 700_000
    turns = spark.createDataFrame([(1, 0, "user", said), (1, 1, "assistant", None)], "conv_id long, turn long, role string, text string")
    start = time.time()
    log = chat.log_of(turns).collect()
    assert time.time() - start < 30
    assert "".join(r.text for r in sorted((r for r in log if r.kind == "delta"), key=lambda r: r.seq)) == said
    assert max(len(r.text) for r in log) == 512


def test_items_without_an_id_match_nothing(spark):
    text = "one two three four five six seven eight nine ten. eleven twelve thirteen fourteen."
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (0, text)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.search(docs, items).collect()] == [(5, 0)]
    assert decontamination.search(docs, items.filter("item_id IS NULL")).collect() == []


def test_line_scores_equal_a_plain_field(spark):
    """Features of neighbours, all state sequences written out, and the length-weighted mean."""
    rng = np.random.default_rng(2)
    field = line_quality.Field(rng.normal(size=line_quality.N_FEATURES), rng.normal(size=(2, 2)))
    texts = ["One line.", "Two lines\nHERE!!", "a\n\nb b b\nFour 4 |", "", "x\nx\nx"]
    want = []
    for t in texts:
        own, lengths = line_quality.line_features(t)
        n = len(own)
        zero = np.zeros(own.shape[1])
        emit = [float(np.r_[own[i], own[i - 1] if i else zero, own[i + 1] if i + 1 < n else zero, 1.0] @ field.state) for i in range(n)]
        total, good = 0.0, np.zeros(n)
        for states in np.ndindex(*(2,) * n):
            w = np.exp(sum(e for e, s in zip(emit, states) if s) + sum(field.pair[a, b] for a, b in zip(states, states[1:])))
            total += w
            good += w * np.array(states)
        want.append(float((good / total) @ lengths / lengths.sum()))
    assert np.allclose(line_quality.score_texts(texts, field), want)


def test_stages_keep_columns_of_any_name(spark):
    """Columns named like the stages' own helpers pass through, and one row of each group stays."""
    text = "Some plain words stand here in a line. And more of them follow until the end of it, as they do. "
    rows = [(1, text * 2, 7, "n", "t", 0.1), (2, text * 2, 8, "n", "t", 0.2), (2, "Other words are said in this one, and none of them stand in the first text.", 9, None, "t", 0.3), (None, text * 2, 1, "", "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _quality int, _node string, _text string, score double")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns and sorted(r._quality for r in kept.collect()) == [1, 7, 9]
    stage = corpus_pipeline.quality(spark, docs, SF)
    assert stage.columns == docs.columns and set(stage.collect()) <= set(docs.collect())
    assert corpus_pipeline.decontaminate(spark, docs, SF).columns == docs.columns
