import math

import numpy as np

from rowtide.llm import toxicity


def test_features_are_the_distinct_n_grams(monkeypatch):
    features = toxicity.Features()
    text = "abcabcabc ÄB"
    grams = {text.lower()[i : i + n] for n in (3, 4, 5) for i in range(len(text) - n + 1)}
    found = features.of(text)
    assert len(set(found.tolist())) == len(found) == len(grams)
    assert set(found.tolist()) == {int(features.of(g)[-1]) for g in grams}
    assert len(features.of(None)) == len(features.of("ab")) == 0
    long = "".join(np.random.default_rng(1).choice(list("abcdef "), 3000))
    whole = set(features.of(long).tolist())
    monkeypatch.setattr(toxicity, "STRETCH", 70)
    assert set(features.of(long).tolist()) == whole


def test_weights_follow_the_ratios():
    features = toxicity.Features()
    texts = ["you are an idiot", "what an idiot he is", "a lovely day", "the day was lovely", "an apple a day", "idiot day"]
    toxic = np.array([True, True, False, False, False, True])
    model = toxicity.train([features.of(t) for t in texts], toxic)
    assert [model.score(features.of(t)) >= 0.5 for t in texts] == toxic.tolist()
    counts = {label: 1 + sum(int(features.of("idiot")[0]) in features.of(t) for t, y in zip(texts, toxic) if y == label)
              for label in (True, False)}
    assert counts == {True: 4, False: 1} and model.weights[features.of("idiot")[0]] > 0


def test_fit_and_score_against_brute_force(monkeypatch):
    """Counts, ratios, three steps of the regression and the scores, feature by feature."""
    monkeypatch.setattr(toxicity, "ROUNDS", 3)
    of = toxicity.Features().of
    texts = ["you idiot", "idiot idiot", "a nice day", "nice idea, nice day", "", "day of an idiot", "ab"]
    toxic = [True, True, False, False, False, True, False]
    sets = [set(of(t).tolist()) for t in texts]
    every = set().union(*sets)
    counts = {y: {f: 1 + sum(f in s for s, t in zip(sets, toxic) if t == y) for f in every} for y in (True, False)}
    spare = (1 << toxicity.BITS) - len(every)  # features nobody has count one each
    total = {y: sum(c.values()) + spare for y, c in counts.items()}
    ratio = {f: math.log(counts[True][f] / total[True]) - math.log(counts[False][f] / total[False]) for f in every}
    scale = [10 / math.sqrt(max(1, len(s))) for s in sets]
    share = sum(toxic) / len(toxic)
    balance = [(0.5 / share if t else 0.5 / (1 - share)) / len(toxic) for t in toxic]
    weight, past, bias, past_bias = dict.fromkeys(every, 0.0), dict.fromkeys(every, 1e-8), 0.0, 1e-8
    for _ in range(3):
        chance = [1 / (1 + math.exp(-(bias + c * sum(weight[f] * ratio[f] for f in s)))) for s, c in zip(sets, scale)]
        error = [(p - t) * b for p, t, b in zip(chance, toxic, balance)]
        for f in every:
            slope = ratio[f] * sum(e * c for s, e, c in zip(sets, error, scale) if f in s) + toxicity.PENALTY * weight[f]
            past[f] += slope**2
            weight[f] -= toxicity.STEP * slope / math.sqrt(past[f])
        past_bias += sum(error) ** 2
        bias -= toxicity.STEP * sum(error) / math.sqrt(past_bias)
    model = toxicity.train([of(t) for t in texts], np.array(toxic))
    assert abs(model.bias - bias) < 1e-9
    assert all(abs(model.weights[f] - weight[f] * ratio[f]) < 1e-6 for f in every)
    for text in [*texts, "an idiot on a nice day", "something else"]:
        present = set(of(text).tolist())
        margin = bias + 10 / math.sqrt(max(1, len(present))) * sum(weight[f] * ratio[f] for f in present if f in every)
        assert abs(model.score(of(text)) - 1 / (1 + math.exp(-margin))) < 1e-5


def test_each_class_has_its_own_budget(spark):
    """Many long clean texts do not take the room of the few toxic ones."""
    docs = [(i, f"lovely day number {i} " + "and so on " * 30) for i in range(40)] + [(100 + i, f"you idiot {i}") for i in range(3)]
    labels = [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(3)]
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(*given, features_per_class=400)
    of = toxicity.Features().of
    assert model.score(of("what an idiot")) > 0.5 > model.score(of("lovely day"))


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, toxic string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))


def test_odd_rows(spark):
    docs, labels = frames(
        spark,
        [(1, "an idiot", "x", 1.0), (2, "a day", "x", 1.0), (3, None, None, None), (4, "", None, None),
         (None, "idiot", None, None), (2, "a day", None, None), (5, "idiot " * 400_000, None, None)],
        [(1, 1, None), (2, 0, None), (2, None, 1), (None, 1, 1), (99, 1, 1), (1, 0, 0)],
    )
    got = [tuple(r) for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()]
    assert len(got) == 7 and all(0 <= s <= 1 for _, s in got)
    by_id = dict(got)
    assert by_id[1] > 0.5 > by_id[2] and by_id[3] == by_id[4] and by_id[None] > 0.5 and by_id[5] > 0.5


def test_missing_classes(spark):
    docs, labels = frames(spark, [(1, "a", "", 0.0)], [(1, 1, 0)])
    for used, answer in ((labels, 1.0), (labels.filter("false"), 0.0), (labels.selectExpr("doc_id", "0 as toxic"), 0.0)):
        assert [round(r["score"], 6) for r in toxicity.score(docs, toxicity.fit(docs, used)).collect()] == [answer]
    assert toxicity.score(docs.filter("false"), toxicity.fit(docs, labels)).collect() == []


def test_held_out_accuracy(spark):
    from rowtide.llm.queries import op2_toxicity

    sf = "/root/testdata/sf0.1"
    found = op2_toxicity(spark, sf).filter("held_out")
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    toxic = np.array([r["toxic"] for r in rows], bool)
    predicted = np.array([r["predicted"] for r in rows], bool)
    # a tenth of the toxic English texts here has no mark of it, and few of the others are there to learn from
    assert (predicted & toxic).sum() / toxic.sum() > 0.65
    assert (predicted & ~toxic).sum() / (~toxic).sum() < 0.02
