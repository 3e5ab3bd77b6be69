from __future__ import annotations

import numpy as np

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import quality


def test_passages_hold_the_whole_text():
    texts = ["", None, "a b", " ".join(["word"] * 100), " ".join(f"w{n}" for n in range(5000)), "\n"]
    x, number = quality.passages(texts)
    assert number.tolist() == [1, 1, 1, 3, 105, 1]
    assert (x[0] == 0).all() and (x[1] == 0).all()
    per = np.expm1(x[:, len(quality.GROUPS) + 6] * 5)
    ends = np.cumsum(number)
    assert [round(per[end - n:end].sum()) for end, n in zip(ends, number)] == [0, 0, 2, 100, 5000, 0]


def test_features_by_hand():
    x, _ = quality.passages(["AB ab 12 | ab ab"])
    size = len("AB ab 12 | ab ab")
    groups = len(quality.GROUPS)
    assert np.allclose(x[0, [0, 1, 2, 4]], [2 / size, 6 / size, 2 / size, 1 / size])
    assert np.isclose(x[0, groups + 3], 1 / 6)  # one word equal to the one before it
    assert np.isclose(x[0, groups + 4], 4 / 6)  # AB, ab, 12 and the bar are different


def test_gradients():
    rng = np.random.default_rng(0)
    model = quality.Model(np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    x, number = rng.normal(size=(9, quality.FEATURES)), np.array([2, 3, 4])
    y, share = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss() -> float:
        score = model.forward(x, number)["score"]
        return -(y * np.log(score) + (1 - y) * np.log(1 - score)).sum()

    for name, slope in model.gradients(x, number, y, share).items():
        flat = model.p[name].reshape(-1)
        for at in (0, len(flat) - 1):
            kept = flat[at]
            flat[at] = kept + 1e-5
            up = loss()
            flat[at] = kept - 1e-5
            down = loss()
            flat[at] = kept
            assert abs((up - down) / 2e-5 - slope.reshape(-1)[at]) < 1e-4, name


def test_scores_like_a_plain_forward_pass():
    """Each document on its own, passage by passage, as the gated attention is written down."""
    texts = ["one passage only", " ".join(f"w{n % 50}" for n in range(700)) + " | $$$", ""]
    x, number = quality.passages(texts)
    model = quality.Model(x.mean(0), np.maximum(x.std(0), 1e-3))
    start = 0
    for score, count in zip(model.score(texts), number):
        encoded, gates = [], []
        for row in (x[start:start + count] - model.mean) / model.spread:
            h = np.tanh(row @ model.p["e"] + model.p["eb"])
            gate = np.tanh(h @ model.p["v"]) / (1 + np.exp(-(h @ model.p["u"])))
            encoded.append(h)
            gates.append(gate @ model.p["w"])
        weight = np.exp(gates) / np.exp(gates).sum()
        z = sum(w * h for w, h in zip(weight, encoded))
        assert abs(1 / (1 + np.exp(-(z @ model.p["c"] + model.p["cb"][0]))) - score) < 1e-9
        start += count


def test_attention_finds_the_bad_passage():
    """Good and bad documents differ in one passage of many only."""
    good = " ".join(f"word{n}" for n in range(900))
    bad = good[:3000] + " ".join(["$$$ ###"] * 60) + good[3000:]
    texts, y = [good[n:] for n in range(40)] + [bad[n:] for n in range(40)], np.repeat([1.0, 0.0], 40)
    x, number = quality.passages(texts)
    model = quality.Model(x.mean(0), np.maximum(x.std(0), 1e-3))
    model.fit((x - model.mean) / model.spread, number, y, np.ones(80))
    assert ((model.score(texts) >= 0.5) == (y == 1)).all()


def test_held_out_accuracy(spark):
    docs, marks = (spark.read.parquet(f"{GIVEN}/sf0.01/{name}.parquet") for name in ("documents", "labels"))
    found = quality.rate(docs, quality.learn(docs, marks)).join(marks, "doc_id").where("held_out").collect()
    assert sum(row.predicted == row.quality for row in found) >= 0.95 * len(found)


def test_rows(spark):
    marks = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (8, 1), (-3, 1), (None, 1), (9, None)], "doc_id bigint, quality int")
    docs = documents(spark, ODD)
    model = quality.learn(docs, marks)
    found = quality.rate(docs, model).collect()
    assert len(found) == len(ODD) and all(0 <= row.score <= 1 for row in found)
    by_id = {row.doc_id: row for row in found}
    assert by_id[1].score == by_id[2].score == by_id[10].score
    assert by_id[None].held_out is False
    assert quality.rate(documents(spark, []), model).collect() == []
    for rows, score in (([], 0.5), ([(4, 1)], 0.99), ([(4, 0)], 0.01)):
        one = quality.learn(docs, spark.createDataFrame(rows, "doc_id bigint, quality int"))
        assert {row.score for row in quality.rate(docs, one).collect()} == {score}


def test_passages_of_long_texts_stay_short():
    x, number = quality.passages([" ".join(f"w{n}" for n in range(50_000)), "a b"])
    per = np.expm1(x[:, len(quality.GROUPS) + 6] * 5)
    assert number.tolist() == [1042, 1] and per[:1042].max() < 49 and round(per.sum()) == 50_002


def test_a_bad_passage_in_a_long_text(spark):
    """Of 20,000 words 60 are junk: one in ten of 600 words in good texts, one passage in bad ones; long passages are alike."""
    rows = []
    for doc in range(60):
        words = [f"word{(n * 7 + doc) % 9_973}" for n in range(20_000)]
        junk = [("$$$", "###")[n % 2] for n in range(60)]
        near = words[10_010:10_550]
        spread = [word for n in range(60) for word in (junk[n], *near[9 * n:9 * n + 9])]
        for bad, part in enumerate((spread, near[:270] + junk + near[270:])):
            rows.append((2 * doc + bad, " ".join(words[:10_010] + part + words[10_610:]), "en", "s"))
    marks = spark.createDataFrame([(row[0], 1 - row[0] % 2) for row in rows], "doc_id bigint, quality int")
    model = quality.learn(documents(spark, rows), marks, held_remainder=-1)
    score = model.score([row[1] for row in rows])
    assert ((score >= 0.5) == np.array([row[0] % 2 == 0 for row in rows])).all()
