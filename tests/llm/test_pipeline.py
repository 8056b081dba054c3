import re
from collections import Counter

import corpus_pipeline
from samples import AWKWARD, docs
from test_near_text import brute
from test_packing import check
from test_pii import plain as pii_spans
from test_words import plain as base_counts

from driftloom.llm import catalog

DIR = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_stage_against_a_plain_version(spark):
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs_ = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}

    good = stages["quality rules"](spark, docs_, DIR).cache()
    assert good.columns == docs_.columns
    kept = {r.doc_id: r.text for r in good.collect()}
    for r in docs_.collect():
        n = base_counts(r.text or "")
        if n[0] < 10 or 100 * n[4] > 20 * n[0]:
            assert r.doc_id not in kept
        elif labels.get(r.doc_id) == 1:
            assert r.doc_id in kept

    single = stages["MinHash near-dedup"](spark, good, DIR).cache()
    want = [i for i, (_, c) in brute(list(kept.items()), 80).items() if i == c]
    assert single.columns == docs_.columns
    assert sorted(r.doc_id for r in single.collect()) == sorted(want)

    masked = stages["PII"](spark, single, DIR).cache()
    texts = {r.doc_id: r for r in masked.collect()}
    assert masked.columns == docs_.columns and set(texts) == set(want)
    for i in want:
        if not pii_spans(kept[i]) and not re.search("[0-9]{3}", kept[i]):
            assert texts[i].text == kept[i]
        assert pii_spans(texts[i].text) == []
        assert texts[i].n_chars == len(texts[i].text)

    mixed = stages["mixing"](spark, masked, DIR).cache()
    times = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs_.columns and set(times) <= set(want) and max(times.values()) <= 3
    assert all(r.text == texts[r.doc_id].text for r in mixed.collect())

    packed = stages["packing"](spark, mixed.dropDuplicates(["doc_id"]), DIR)
    tokenizer = Tokenizer.from_file(catalog.tokenizer_path())
    check(packed.collect(), {i: [*tokenizer.encode(texts[i].text, add_special_tokens=False).ids, 1] for i in times})


def test_run_is_the_stages_one_after_another(spark):
    docs_ = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs_ = stage(spark, docs_, "/root/testdata/sf0.001")
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(docs_.select(columns)) == rows_of(run.select(columns))


def test_awkward_rows_pass_through_every_stage(spark):
    table = docs(spark, [*AWKWARD, *[(100 + i, f"words of number {i} " * (i + 3), None) for i in range(20)]], clash=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, DIR)
        assert out.count() >= 0, name
        assert stage(spark, table.limit(0), DIR).count() == 0, name
