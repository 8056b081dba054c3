from pyspark.sql import functions as F

from driftloom.llm import catalog, chat

SCHEMA = "pair_id long, chosen boolean, conv_id long, turn long, role string, text string, a string, n_common string"


def made(spark, rows):
    return {r.pair_id: r for r in chat.format_preferences(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)).collect()}


def show(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_common_turns_are_rendered_once(spark):
    shared = [("system", "be kind"), ("user", "hi")]
    a = [*shared, ("assistant", "hello"), ("user", "bye")]
    b = [*shared, ("assistant", "what")]
    rows = [(7, True, 14, i, *t) for i, t in enumerate(a)] + [(7, False, 15, i, *t) for i, t in enumerate(b)]
    r = made(spark, reversed(rows))[7]
    assert (r.chosen_id, r.rejected_id, r.n_common) == (14, 15, 2)
    assert r.prompt == "".join(show(*t) for t in shared)
    assert r.chosen == show("assistant", "hello") + show("user", "bye")
    assert [(s.text, s.train) for s in r.chosen_segments] == [(show("assistant", "hello"), True), (show("user", "bye"), False)]
    assert r.rejected == show("assistant", "what")


def test_awkward_rows(spark):
    rows = [
        (1, True, 2, 0, "user", None), (1, False, 3, 0, "user", ""),  # nulls are empty; all turns are common
        (2, True, 4, 0, None, "x"),  # one side only
        (3, True, 6, 0, "user", "q"), (3, True, 6, 0, "user", "q"), (3, True, 6, None, "system", "s"), (3, False, 7, 0, "user", "q"),
        (None, True, 8, 0, "user", "x"), (4, None, 9, 0, "user", "x"),
        (5, True, 10, 0, "user", "z" * 500_000), (5, False, 11, 0, "user", "z" * 500_000 + "y"),
    ]
    got = made(spark, rows)
    assert sorted(got) == [1, 2, 3, 5]
    assert (got[1].n_common, got[1].chosen, got[1].rejected, got[1].prompt) == (1, "", "", show("user", ""))
    assert (got[2].n_common, got[2].rejected_id, got[2].rejected, got[2].rejected_segments, got[2].chosen) == (0, None, None, None, show("", "x"))
    assert (got[3].n_common, got[3].chosen) == (0, show("system", "s") + show("user", "q"))
    assert got[5].n_common == 0 and len(got[5].chosen) > 500_000
    assert chat.format_preferences(spark.createDataFrame([], SCHEMA)).count() == 0


TURNS = "conv_id long, turn long, role string, text string, chosen string, t string"


def paired(spark, rows):
    return chat.answer_pairs(spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS))


def test_pairs_share_their_turns_up_to_the_last_answer(spark):
    talk = [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "good"), ("user", "bye")]
    rows = [(2, i, *t) for i, t in enumerate(talk)]
    rows += [(3, 0, "user", "other"), (3, 1, "assistant", "bad")]
    rows += [(4, 0, "user", "q"), (5, 0, "assistant", "a")]  # no own answer: the other one follows
    rows += [(6, 0, "user", "q"), (6, 1, "assistant", "a"), (7, 0, "user", "no answer"), (9, 4, "assistant", "alone"), (None, 0, "user", "x")]
    rows += [(10, 0, "user", "q"), (10, 1, "assistant", "same"), (11, 1, "assistant", "same")]
    rows += [(12, 0, "assistant", None), (13, None, "assistant", "n"), (13, None, "assistant", "n")]
    pairs = paired(spark, rows)
    got = {r.pair_id: r for r in chat.format_preferences(pairs).withColumn("mask", chat.spans(F.col("chosen_segments"))).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    r = got[1]
    assert (r.chosen_id, r.rejected_id, r.n_common) == (2, 3, 4)
    assert r.prompt == "".join(show(*t) for t in talk[:4])
    assert r.chosen == show("assistant", "good") + show("user", "bye") and r.rejected == show("assistant", "bad")
    assert [r.chosen[a:b] for a, b in r["mask"]] == [show("assistant", "good")]
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == (show("user", "q"), "", show("assistant", "a"))
    assert (got[3].rejected_id, got[3].rejected, got[3].n_common) == (None, None, 0)
    assert (got[4].chosen, got[4].rejected) == (None, show("assistant", "alone"))
    assert (got[5].n_common, got[5].chosen, got[5].rejected) == (2, "", "")
    assert (got[6].chosen, got[6].rejected) == (show("assistant", ""), show("assistant", "n"))
    assert paired(spark, []).count() == 0


def test_whole_table_shares_prompts(spark):
    made = catalog.op3_preferences(spark, "/root/testdata/sf0.1")
    assert made.where("n_common > 0 and rejected_mask <> ''").count() > 0.8 * made.count()


def test_no_python_runs(spark):
    plan = chat.format_preferences(paired(spark, []))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
