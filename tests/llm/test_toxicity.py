from __future__ import annotations

import math

import numpy as np

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import toxicity


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, toxic int").selectExpr("*", "'x' as text", "1 as quality")


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(1)
    y = (rng.random(6000) < 0.3).astype(int)
    right = [0.95, 0.8, 0.7]
    votes = np.column_stack([np.where(rng.random(6000) < p, 2 * y - 1, 1 - 2 * y) * (rng.random(6000) < 0.7) for p in right])
    votes = np.column_stack([votes, votes[:, 1]]).astype(float)  # a voter that repeats another
    model = toxicity.LabelModel(votes, y, np.ones(len(y)))
    for n, p in enumerate(right):
        assert abs(model.rates[1][2][n] / (model.rates[1][2][n] + model.rates[1][0][n]) - p) < 0.05
    assert model.correlation[1, 3] > 0.95 and abs(model.correlation[0, 2]) < 0.1
    assert abs(model.weight[1] - 0.5) < 0.05 and model.weight[0] == 1.0
    assert abs(model.prior - 0.3) < 0.03


def test_label_model_like_plain_expectation_maximisation():
    """Document by document and voter by voter, with documents that have no label."""
    rng = np.random.default_rng(5)
    truth = (rng.random(200) < 0.4).astype(int)
    votes = np.column_stack([np.where(rng.random(200) < p, 2 * truth - 1, 1 - 2 * truth) * (rng.random(200) < 0.8)
                             for p in (0.9, 0.75, 0.65)]).astype(float)
    y = np.where(rng.random(200) < 0.5, truth, -1)
    share = np.where(y < 0, 0.7, np.where(y == 1, 1.0, 2.0))
    model = toxicity.LabelModel(votes, y, share, rounds=4)
    told = [0.0 if label < 0 else (1 if label else -1) * math.log(0.98 / 0.02) for label in y]
    belief = [1 / (1 + math.exp(-t)) for t in told]
    weights = [0.0 if label < 0 else w for label, w in zip(y, share)]
    for _ in range(5):
        rate = {}
        for toxic in (0, 1):
            part = [w * (b if toxic else 1 - b) for w, b in zip(weights, belief)]
            for n in range(3):
                for vote in (-1, 0, 1):
                    rate[toxic, n, vote] = (sum(p for p, v in zip(part, votes[:, n]) if v == vote) + 0.5) / (sum(part) + 1.5)
        prior = sum(w * b for w, b in zip(weights, belief)) / sum(weights)
        means = {toxic: [rate[toxic, n, 1] - rate[toxic, n, -1] for n in range(3)] for toxic in (0, 1)}
        left = [[votes[d, n] - belief[d] * means[1][n] - (1 - belief[d]) * means[0][n] for n in range(3)] for d in range(200)]
        both = lambda a, b: sum(w * row[a] * row[b] for w, row in zip(weights, left)) / sum(weights)
        alike = [[1.0 if a == b else both(a, b) / math.sqrt(both(a, a) * both(b, b)) for b in range(3)] for a in range(3)]
        say = [1 / sum(c for c in (alike[a][b] for a in range(3)) if c > 0.2) for b in range(3)]
        belief = [1 / (1 + math.exp(-(math.log(prior / (1 - prior)) + t + sum(
            say[n] * math.log(rate[1, n, v] / rate[0, n, v]) for n, v in enumerate(row) if v)))) for row, t in zip(votes, told)]
        weights = list(share)
    assert np.allclose(model.belief, belief, atol=1e-6)
    hidden = y < 0
    assert ((model.belief[hidden] > 0.5) == (truth[hidden] == 1)).mean() > 0.75


def test_unlabelled_documents_enter_the_estimate(spark):
    """A seed list that no labelled document speaks to gets its rate from unlabelled ones, where other voters go along with it."""
    rows = [(n, ("you stupid scum " if n % 2 else "a calm garden day ") + f"w{n}", "en", "s") for n in range(80)]
    rows += [(1000 + n, ("stupid scum trottel " if n % 2 else "a calm day ") + f"w{n}", "en", "s") for n in range(200)]
    docs, marks = documents(spark, rows), labels(spark, [(n, n % 2) for n in range(80)])
    lists = list(toxicity.SEEDS)

    def odds(model) -> float:
        place = len(model.labels.weight) - 1 - sum(bool(vote) for _, _, vote in toxicity.FORMS) - len(lists) + lists.index("de")
        return model.labels.rates[1][2][place] / model.labels.rates[0][2][place]

    assert odds(toxicity.learn(docs, marks)) > 3 * odds(toxicity.learn(docs.where("doc_id < 1000"), marks))


def test_finder_finds_words_and_beginnings():
    finder = toxicity.Finder(["scum", "idi*", "idiot"])
    assert finder("SCUM! idiot") == {0, 1, 2}
    assert finder("scummy idi") == {1}
    assert finder("") == set() and toxicity.Finder([])("scum") == set()
    assert toxicity.terms_of("Abcd a") == {"abcd", "a", "abc*"}


def test_held_out_accuracy(spark):
    docs, marks = (spark.read.parquet(f"{GIVEN}/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    found = toxicity.rate(docs, toxicity.learn(docs, marks)).join(marks, "doc_id").where("held_out").collect()
    assert len(found) > 700
    assert sum(row.predicted == row.toxic for row in found) >= 0.95 * len(found)
    assert sum(row.predicted for row in found if not row.toxic) <= 0.01 * len(found)


def test_rows(spark):
    texts = [("you are stupid scum today", 1), ("a nice day in the garden", 0)]
    docs = [(n, texts[n % 2][0] + f" {n}", "en", "s") for n in range(60)]
    model = toxicity.learn(documents(spark, docs), labels(spark, [(n, texts[n % 2][1]) for n in range(60)] + [(None, 1), (3, None)]))
    found = {row.doc_id: row for row in toxicity.rate(documents(spark, [*ODD, (99, "Stupid!! SCUM", "x", "y")]), model).collect()}
    assert found[99].predicted == 1
    assert all(0 <= row.score <= 1 for row in found.values())
    assert found[1].score == found[2].score and found[1].predicted == 0
    assert toxicity.rate(documents(spark, []), model).collect() == []


def test_without_labels(spark):
    docs = documents(spark, ODD)
    for marks, score in (([], 0.0), ([(4, 0)], 0.01), ([(4, 1)], 0.99)):
        model = toxicity.learn(docs, labels(spark, marks))
        assert {row.score for row in toxicity.rate(docs, model).collect()} == {score}
