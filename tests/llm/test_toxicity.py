import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import AWKWARD, docs

from driftloom.llm import toxicity

WORDS = st.text("abc", min_size=1, max_size=11)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.sets(WORDS, min_size=1, max_size=8), st.sets(st.text("abc", min_size=4, max_size=4), max_size=2), WORDS)
def test_automaton_against_edit_distance(words, stems, word):
    terms = {w: 1.0 for w in words} | {s + "*": 1.0 for s in stems}
    covered = lambda t: any(t[:n] in stems for n in toxicity.STEMS)
    found = [(0, t) for t in terms if t.endswith("*") and word.startswith(t[:-1])]
    for t in words:
        d = distance(t, word)
        if d <= (0 if covered(t) else toxicity.Lexicon.edits(t)):
            found.append((d, t))
    got = toxicity.Lexicon(terms).match(word)
    assert got == ((min(found)[1], min(found)[0]) if found else None)


def test_misspellings_and_quotation():
    scorer = toxicity.Scorer(toxicity.Lexicon({"scoundrel": 5.0, "vile*": 4.0}))
    plain = scorer.features("you are a scoundrel and vilest of all")
    spelled = scorer.features("you are a scoundrl of all")
    quoted = scorer.features('she wrote "scoundrel" on the board')
    assert plain[0] > 0 and plain[2] == 0
    assert spelled[1] > 0 and spelled[0] == 0
    assert quoted[2] > 0 and quoted[0] == 0
    assert scorer.features("") == scorer.features("a fine day") == [0.0] * toxicity.FEATURES


def test_every_word_of_a_token_counts():
    scorer = toxicity.Scorer(toxicity.Lexicon({"scoundrel": 5.0, "vile*": 4.0}))
    assert scorer.features("you scoundrel,vilest,scoundrel now") == scorer.features("you scoundrel, vilest, scoundrel now")
    assert scorer.features("scoundrel" + "-scoundrel" * 30) == scorer.features("scoundrel " * 31)
    mixed = scorer.features("a 'scoundrel',so it was read to them there by one or two others—vilest")
    assert mixed[2] > 0 and mixed[0] > 0
    assert scorer.features("don't be a scoundrel, don't")[2] == 0


def test_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(table, labels).collect()}
    assert len(rows) == table.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    seen = [(rows[r.doc_id].score, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    toxic, clean = np.array([s for s, t in seen if t]), np.array([s for s, t in seen if not t])
    # some documents of this table are marked toxic without a toxic word in them
    assert (toxic[:, None] > clean).mean() + (toxic[:, None] == clean).mean() / 2 > 0.95
    assert (clean < 0.5).mean() > 0.99
    assert (toxic >= 0.5).mean() > 0.9


def test_held_out_labels_do_not_matter(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert key(toxicity.score_toxicity(table, labels)) == key(toxicity.score_toxicity(table.repartition(3), turned))


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 1), (6, None), (7, 5)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs(spark, AWKWARD, clash=True), labels).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r.score == 0 and r.predicted == 0 for r in rows if r.doc_id in (1, 2, 3))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_toxicity(docs(spark, AWKWARD), none).where("score = 0").count() == len(AWKWARD)
    assert toxicity.score_toxicity(docs(spark, []), none).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.sets(WORDS, min_size=1, max_size=8), st.sets(st.text("abc", min_size=4, max_size=4), max_size=2), WORDS)
def test_every_term_has_its_edits_in_scoring(words, stems, word):
    terms = {w: 1.0 for w in words} | {s + "*": 1.0 for s in stems}
    found = [(0, t) for t in terms if t.endswith("*") and word.startswith(t[:-1])]
    found += [(d, t) for t in words if (d := distance(t, word)) <= toxicity.Lexicon.edits(t)]
    got = toxicity.Lexicon(terms, under_stems=True).match(word)
    assert got == ((min(found)[1], min(found)[0]) if found else None)


def test_learned_word_misspelled_within_its_stem(spark):
    rng = np.random.default_rng(3)
    prose = lambda: " ".join(f"w{n}" for n in rng.integers(0, 4000, 40))
    turned = ["clown"[:i] + c + "clown"[i + 1 :] for i in range(4) for c in "abdefghijkmpqrstuvxy"]  # too rare each to be learned
    rows, known = [], []
    for i in range(300):
        word = ("", "clown", "", turned[i // 4])[i % 4]
        rows.append((i, f"{prose()} {word} {prose()}"))
        known.append((i, i % 2))
    rows += [(1001, f"{prose()} zlown {prose()}"), (1002, prose())]
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    terms, _ = toxicity.learn(docs(spark, rows), labels)
    assert "clown" in terms and "clow*" in terms
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs(spark, rows), labels).collect()}
    assert got[1001] >= 0.5 > got[1002]
