import numpy as np
from samples import AWKWARD, docs
from test_words import plain

from driftloom.llm import quality


def grams(text):
    """(order, bytes) of all n-grams; every byte up to the blank counts as a blank."""
    data = bytes(32 if b <= 32 else b for b in text.encode())
    return [(n, data[i : i + n]) for n in quality.ORDERS for i in range(len(data) - n + 1)]


def bucket(n, gram):
    code = 0
    for b in gram:
        code = (code * 257 + b + 1) % 2**32
    return quality.ORDERS.index(n) * (1 << quality.BUCKET_BITS) + ((code * 2654435761 % 2**32) >> (32 - quality.BUCKET_BITS))


def brute(rows, good):
    size = 1 << quality.BUCKET_BITS
    raw, target = np.zeros(3 * size), np.zeros(3 * size)
    for i, text in rows:
        for g in grams(text or ""):
            raw[bucket(*g)] += 1
            target[bucket(*g)] += i in good
    table = np.zeros(3 * size)
    for k in range(3):
        s = slice(k * size, (k + 1) * size)
        table[s] = np.log((target[s] + 1) / (target[s].sum() + size)) - np.log((raw[s] + 1) / (raw[s].sum() + size))
    return [float(np.mean([table[bucket(*g)] for g in grams(text)])) if text else 0.0 for _, text in rows]


def test_scores_and_verdicts_against_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    good = set(range(0, 60, 3))
    got = {r.doc_id: r for r in quality.judge_quality(table, spark.createDataFrame([(i,) for i in good], "doc_id long"), keep_columns=False).collect()}
    for (i, text), llr in zip(rows, brute(rows, good)):
        counts = plain(text or "")
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        r = got[i]
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed] == [*counts, failed]
        assert abs(r.llr - llr) < 1e-9
        assert r.kept == (not failed and r.llr >= quality.THRESHOLD)


def test_labelled_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = quality.judge_quality(table, labels.where("quality = 1"), keep_columns=False).join(labels, "doc_id")
    good, bad = judged.where("quality = 1 and not base_failed"), judged.where("quality = 0")
    assert good.where("not kept").count() == 0
    assert bad.where("kept").count() <= 0.02 * bad.count()


def test_scores_do_not_depend_on_the_texts_beside(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    pick = lambda df: sorted((r.doc_id, r.llr.hex(), r.kept) for r in quality.judge_quality(df, good, keep_columns=False).collect())
    once = pick(table.repartition(3, "source"))
    assert once == pick(table.repartition(11)) == pick(table.orderBy("n_chars").coalesce(1))
    alone = quality.judge_quality(table, good, keep_columns=False).where("doc_id = 5").first()
    assert (5, alone.llr.hex(), alone.kept) in once


def test_awkward_rows(spark):
    trusted = spark.createDataFrame([(7,), (None,)], "doc_id long")
    table = docs(spark, AWKWARD, clash=True)
    out = quality.judge_quality(table, trusted)
    assert len(set(out.columns)) == len(out.columns) and set(table.columns) <= set(out.columns)
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    assert all(r.n_words == 0 and r.base_failed and not r.kept and r.llr == 0 for r in rows if r.doc_id in (1, 2))
    nobody = quality.judge_quality(docs(spark, AWKWARD), spark.createDataFrame([], "doc_id long")).collect()
    assert all(r.llr == 0 for r in nobody)
    assert quality.judge_quality(docs(spark, []), trusted).count() == 0
