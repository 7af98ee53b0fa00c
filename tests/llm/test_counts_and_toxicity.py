"""Rollups against recounting, the classifier chain on held-out rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from freightloom.llm import toxicity as tox
from freightloom.llm.token_counts import Rollup, deltas

CHANGES = "source string, lang string, tokenizer string, op string, n_tokens long, old_tokens long, n_docs string"


def totals_of(rollup):
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}


def recount(batches):
    docs, tokens = Counter(), Counter()
    for batch in batches:
        for *key, op, n, old, _ in batch:
            n, old = n or 0, old or 0
            docs[tuple(key)] += {"insert": 1, "delete": -1, "revise": 0}[op]
            tokens[tuple(key)] += {"insert": n, "delete": -n, "revise": n - old}[op]
    return {k: (docs[k], tokens[k]) for k in docs if docs[k] or tokens[k]}


def test_rollup(spark, tmp_path):
    dice = random.Random(3)
    rollup, done = Rollup(spark, str(tmp_path / "r")), []
    assert totals_of(rollup) == {}
    for b in range(4):
        rows = [
            (dice.choice(["a", "a", "b", None]), dice.choice(["x", "y"]), dice.choice(["t1", "t2"]), dice.choice(["insert", "insert", "delete", "revise"]),
             dice.choice([None, 5, 17]), dice.choice([None, 3]), "clash")
            for _ in range(50)
        ]
        changes = spark.createDataFrame(rows + rows[:3], CHANGES)
        done.append(rows + rows[:3])
        assert rollup.commit(f"batch/{b} ü", changes) and not rollup.commit(f"batch/{b} ü", changes)
        assert totals_of(rollup) == recount(done)
        if b == 1:
            rollup.compact()
            assert totals_of(rollup) == recount(done) and not rollup.commit("batch/0 ü", changes)
    rollup.compact()
    rollup.compact()
    assert totals_of(Rollup(spark, str(tmp_path / "r"))) == recount(done)


def test_batch_that_was_not_finished_does_not_count(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    changes = spark.createDataFrame([("a", "x", "t", "insert", 4, None, None)], CHANGES)
    rollup.commit("one", changes)
    deltas(changes).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(str(tmp_path / "r/deltas/id=two"))
    assert totals_of(rollup) == {("a", "x", "t"): (1, 4)} and rollup.batches() == ["one"]
    assert rollup.commit("two", changes) and totals_of(rollup) == {("a", "x", "t"): (2, 8)}
    assert rollup.commit("empty", changes.limit(0)) and totals_of(rollup) == {("a", "x", "t"): (2, 8)}


def test_unknown_change_is_an_error(spark):
    with pytest.raises(PySparkException, match="unknown change"):
        deltas(spark.createDataFrame([("a", "x", "t", "upsert", 4, None, None)], CHANGES)).collect()


INSULTS = ["oaf", "cur", "knave"]


def corpus(spark, n=900, seed=1):
    dice = random.Random(seed)
    rows, truth = [], []
    for i in range(n):
        words = dice.choices([f"w{k}" for k in range(200)], k=dice.choice((5, 40, 400)))
        junk, toxic = dice.random() < 0.2, dice.random() < 0.2
        if junk:
            words += ["zzz"] * 3
        if toxic:
            words.insert(dice.randrange(len(words)), dice.choice(INSULTS).upper() + "!")
        dice.shuffle(words)
        rows.append((i, " ".join(words), "c"))
        truth.append((i, int(junk), int(toxic if dice.random() > 0.03 else not toxic), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, low_quality string")
    return docs, spark.createDataFrame([t[:3] for t in truth], "doc_id long, low_quality int, toxic int"), {t[0]: t[3] for t in truth}


def test_chain_on_held_out_rows(spark):
    docs, labels, truth = corpus(spark)
    chain = tox.train(docs, labels.filter("doc_id < 600"), ("low_quality", "toxic"))
    got = {r["doc_id"]: r["toxic"] for r in tox.judge(docs.drop("low_quality"), chain).collect()}
    held = [i for i in truth if i >= 600]
    assert sum(got[i] == truth[i] for i in held) / len(held) >= 0.97
    left = tox.drop_toxic(docs, chain)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, bad in got.items() if not bad}


def test_later_models_see_out_of_fold_probabilities(spark):
    docs, labels, _ = corpus(spark, 400)
    chain = tox.train(docs, labels, ("low_quality", "toxic"))
    first, second = chain.models
    assert len(first.before) == 0 and len(second.before) == 1
    again = tox.train(docs.repartition(5), labels.repartition(3), ("low_quality", "toxic"))
    assert again.vocabulary == chain.vocabulary
    assert all((a.words == b.words).all() and (a.before == b.before).all() for a, b in zip(again.models, chain.models))


def test_probabilities_of_a_memorised_category_do_not_leak_into_the_next():
    """A first category of pure chance is fitted from words that name their rows; out of fold it must tell nothing."""
    dice = np.random.default_rng(1)
    chance = dice.integers(0, 2, 200).astype(float)
    rows = tox.Rows([np.array([i]) for i in range(200)])
    none = np.zeros((200, 0))
    seen = tox.fit(rows, none, chance, 200, penalty=1e-6, rounds=400)
    assert np.corrcoef(seen.predict(rows.dot(seen.words), none), chance)[0, 1] > 0.9
    fold = np.arange(200) % 2
    unseen = np.zeros(200)
    for f in (0, 1):
        model = tox.fit(rows.pick(fold != f), none[fold != f], chance[fold != f], 200, penalty=1e-6, rounds=400)
        unseen[fold == f] = model.predict(rows.pick(fold == f).dot(model.words), none[fold == f])
    assert unseen[fold == 0].std() < 1e-9 > unseen[fold == 1].std()


def test_fit_against_the_conditions_of_the_optimum():
    dice = np.random.default_rng(2)
    lists = [np.flatnonzero(dice.random(12) < 0.3) for _ in range(300)]
    rows, truth = tox.Rows(lists), np.array([float((0 in x) or (3 in x and dice.random() < 0.5)) for x in lists])
    before = dice.random((300, 1))
    model = tox.fit(rows, before, truth, 12, penalty=0.01, rounds=4000)
    gap = (model.predict(rows.dot(model.words), before) - truth) / 300
    slope = rows.back(gap, 12)
    assert abs(gap.sum()) < 1e-5 and abs(gap @ before[:, 0]) < 1e-5
    assert np.all(np.abs(slope[model.words == 0]) <= 0.01 + 1e-5)
    on = model.words != 0
    assert on.any() and np.allclose(slope[on], -0.01 * np.sign(model.words[on]), atol=1e-5)


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (1, "oaf"), (None, "w1 oaf"), (3, "w2 " * 50_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, none.unionByName(spark.createDataFrame([(77, 1), (1, None)], "doc_id long, toxic int"))):
        assert tox.judge(docs, tox.train(docs, labels, ("toxic",))).filter("NOT toxic").count() == 5
    one = spark.createDataFrame([(1, 0), (3, 0)], "doc_id long, toxic int")
    assert tox.drop_toxic(docs, tox.train(docs, one, ("toxic",))).count() == 5
    big, labels, _ = corpus(spark, 300)
    chain = tox.train(big, labels, ("toxic",))
    found = tox.judge(docs, chain).select("doc_id", "text", F.col("toxic")).collect()
    assert len(found) == 5 and [r["toxic"] for r in found if r["text"] in (None, "")] == [False, False]
    assert tox.judge(docs.limit(0), chain).count() == 0
