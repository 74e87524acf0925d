"""The stages over small documents with every oddity, and the registered queries."""

import pytest
from llm_texts import prose

import corpus_pipeline
from linguamart.llm import common, neardup, ranking, repeats
from linguamart.llm.queries import QUERIES


@pytest.fixture
def folder(spark, frame, odd_rows, tmp_path):
    good = [(1000 + i, ". ".join(prose(12, 7 * i + k).capitalize() for k in range(6)) + ".") for i in range(60)]
    bad = [(2000 + i, " ".join(w + "###" for w in prose(60, i).upper().split())) for i in range(30)]
    copies = [(3000, good[0][1]), (3001, good[1][1] + " More")]
    passage = prose(60, 77)
    shared = [(4000 + i, f"{prose(30, 900 + i)}. {passage}. {prose(30, 950 + i)}.") for i in range(3)]
    item = prose(30, 888)
    leaked = [(5000, f"{prose(40, 990)}. {item} {prose(20, 991)}.")]
    frame(odd_rows + good + bad + copies + shared + leaked).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, folder):
    docs = common.table(spark, folder, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.saved(stage(spark, docs, folder), name)
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {1000 + i for i in range(60)}
    assert good <= set(seen["quality"]) and not any(2000 <= (i or 0) < 2030 for i in seen["quality"])
    assert good <= set(seen["near_duplicates"]) and not {3000, 3001} & set(seen["near_duplicates"])
    assert {4000, 4001, 4002} <= set(seen["substrings"]) and not any(prose(60, 77) in seen["substrings"][i] for i in (4000, 4001, 4002))
    assert good <= set(seen["decontaminate"]) and 5000 in seen["substrings"] and 5000 not in seen["decontaminate"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.collect()} == set(seen["decontaminate"])


def test_near_duplicates_from_four_fifths(spark, frame):
    """Six words of 300 changed: 266 of 326 shingles are common, 0.816."""
    words = prose(300, 41).split()
    for k in range(6):
        words[20 + 45 * k] = f"new{k}"
    docs = frame([(1, prose(300, 41)), (2, " ".join(words)), (3, prose(300, 42))])
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, None).collect()} == {1, 3}


def test_threshold_follows_from_share():
    assert (neardup.least_common(85), neardup.width(85)) == (89, 8)
    assert (neardup.least_common(80), neardup.width(80)) == (80, 5)


def test_stages_of_nothing(spark, folder):
    docs = common.table(spark, folder, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.saved(stage(spark, docs, folder), name)
        assert docs.count() == 0


def test_registered():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_texts_move_once(spark, frame, odd_rows, monkeypatch):
    """The stages give the operators all columns but the text, which comes back as it was."""
    kept = []
    for module, name in ((ranking, "score_documents"), (repeats, "remove_repeats")):
        def seen(docs, *a, real=getattr(module, name), keep=(), **b):
            kept.extend(docs.select(*keep).columns)
            return real(docs, *a, keep=keep, **b)

        monkeypatch.setattr(module, name, seen)
    docs = frame([r for r in odd_rows if r[0] not in (6, 7, 8)])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    for stage in (corpus_pipeline.quality, corpus_pipeline.substrings):
        out = stage(spark, docs, None)
        assert out.schema == docs.schema
        assert {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()} >= {(1, None, None), (2, "", 0), (3, " \t\n ", 4), (10, "a\x00b c\x1cd", 7)}
    assert kept and "text" not in kept
