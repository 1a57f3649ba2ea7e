"""The pipeline's stages, each on what the one before kept."""

import json
import re

import pytest

import corpus_pipeline
from quern.llm.common import written


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    clean = "The rain in the north fell on the old town and the people of the river went home {0}. " * 6
    german = "Der Regen im Norden fiel auf die alte Stadt und die Leute vom Fluss gingen heim {0}. " * 6
    words = [f"word{i}" for i in range(200)]
    rows = [(i, clean.format(f"{i} apple{i}"), "en") for i in range(40)]
    rows += [(100 + i, german.format(f"{i} birne{i}"), "de") for i in range(40)]
    rows += [(200, " ".join(words), "en"), (201, " ".join([*words[:-1], "other"]), "en")]
    rows += [(300, rows[0][1], "en"), (301, None, "en"), (302, "123 456", None), (303, "", "de"), (None, clean.format("null id"), "en")]
    rows += [(400, "The key of the old house is password=abcdef0123456789 and the people know it", "en")]
    df = spark.createDataFrame([(i, t, lang, "s" if (i or 0) % 2 else None, len(t or ""), 1) for i, t, lang in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, mark int")
    df.write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages_keep_clean_documents(spark, made):
    docs = spark.read.parquet(f"{made}/documents.parquet")
    names = docs.columns
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, made), "pipeline-test")
        at[name] = docs
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in at.items()}
    clean = {*range(40), *range(100, 140), 200, None, 400}
    assert ids["language ID"] == clean | {201, 300}
    assert ids["line dedup"] == clean | {201}
    assert ids["n-gram Jaccard join"] == clean == ids["secret scans"] == ids["packing"]
    assert all(at[name].columns == names for name, _ in corpus_pipeline.STAGES[:-1])
    text = at["secret scans"].where("doc_id = 400").first()
    assert "[SECRET]" in text.text and text.n_chars == len(text.text)
    whole = sorted(json.dumps(r.asDict(), default=str) for r in corpus_pipeline.run(spark, made).collect())
    assert len(whole) == at["packing"].count() and re.search("sequence_id", whole[0])
