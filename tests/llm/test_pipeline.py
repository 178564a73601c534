"""The corpus pipeline, stage by stage against brute force."""

import re

import public_tokenizers
import pytest
from llm_support import SF, docs, documents  # noqa: F401
from test_jaccard import brute as groups_of
from test_native import runs as runs_of
from test_secrets import brute as secrets_of
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from gradeloom.llm import toxicity as tox

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and returns, written and read again in between."""
    table, out = documents(spark), []
    for name, stage in pipeline.STAGES:
        made = stage(spark, table, SF)
        path = str(tmp_path_factory.mktemp("stage") / name)
        made.write.parquet(path)
        after = spark.read.parquet(path)
        out.append((table, after))
        table = after
    return dict(zip([n for n, _ in pipeline.STAGES], out, strict=True))


def texts(table):
    return {r.doc_id: r.text for r in table.collect()}


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "near_copies", "decontamination", "secrets", "packing"]
    assert all(after.columns == COLUMNS for name, (_, after) in stages.items() if name != "packing")


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r.doc_id: r.score for r in tox.score(before, tox.fit(before, labels), ["doc_id"]).collect()}
    assert set(texts(after)) == {d for d, s in scores.items() if s < tox.LEAST_SCORE}


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_copies"]
    groups = groups_of(texts(before))
    assert set(texts(after)) == {d for d, (_, c) in groups.items() if c == d}
    assert len(groups) > after.count()


def test_documents_with_items_go(spark, stages):
    before, after = stages["decontamination"]
    items = [s for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if (s := runs_of(r.text))]
    dirty = {d for d, t in texts(before).items() if any(100 * len(s & runs_of(t)) >= 75 * len(s) for s in items)}
    assert set(texts(after)) == set(texts(before)) - dirty


def test_secrets_are_replaced(stages):
    before, after = stages["secrets"]
    old, new = texts(before), texts(after)
    assert set(old) == set(new)
    for d, text in new.items():
        assert not secrets_of(text)
        if not secrets_of(old[d]) and pipeline.REDACTED not in text:
            assert text == old[d]
        clean = re.escape(text).replace(re.escape(pipeline.REDACTED), ".+?")
        assert re.fullmatch(clean, old[d], re.S)
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_all_that_is_left_is_packed(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(before).items()}
    got = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_run_applies_all_stages(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, pipeline.run(spark, SF).collect())) == sorted(map(key, stages["packing"][1].collect()))


def test_odd_documents_pass(spark, docs, tmp_path):  # noqa: F811
    table = docs([None, "", "x " * 9000, "password=abcdefgh", "password=abcdefgh"]).select(*COLUMNS)
    odd = table.unionAll(table.limit(2)).unionAll(table.selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars").limit(1))
    for rows in (odd, table.limit(0)):
        for name, stage in pipeline.STAGES:
            rows = stage(spark, rows, SF)
            rows.write.mode("overwrite").parquet(str(tmp_path / name))
            rows = spark.read.parquet(str(tmp_path / name))


def test_run_writes_and_rereads_each_stage(spark, monkeypatch):
    read = []
    def stage(s, table, _):
        read.append(table.inputFiles())
        return table.where("doc_id % 2 = 0") if len(read) == 1 else table.limit(5)
    monkeypatch.setattr(pipeline, "STAGES", [("first", stage), ("second", stage)])
    out = pipeline.run(spark, SF)
    assert out.count() == 5 and all("/second/" in f for f in out.inputFiles())
    assert all(f.startswith(f"file://{SF}") for f in read[0]) and read[1] and all("/first/" in f for f in read[1])
    assert pipeline.run(spark, SF).inputFiles() != out.inputFiles()
