from __future__ import annotations

import zlib

import numpy as np

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import language


def vector(text: str) -> np.ndarray:
    parts = language.stretches(text)
    return language.bits(parts[0]) if parts else np.zeros(language.PLACES, dtype=np.uint8)


def test_kernel_counts_shared_places():
    one, two = vector("the cat sat"), vector("the cat ran")
    shared = int((one & two).sum())
    found = language.kernel(one[None].astype(np.float32), two[None].astype(np.float32))[0, 0]
    assert abs(found - shared / np.sqrt(one.sum() * two.sum())) < 1e-6
    assert (vector("A  b!") == vector("a b")).all()
    assert language.stretches("123 !?") == []
    assert 0 < vector("a").sum() <= 6


def plain_kernel(one: set, two: set) -> float:
    return len(one & two) / (len(one) * len(two)) ** 0.5


def test_scores_like_ridge_regression_over_sets():
    """The model against kernel ridge regression written out with sets of places, where all texts are landmarks."""
    texts = [("the house and the garden", "en"), ("a house in the wood", "en"), ("das haus und der garten", "de"),
             ("ein haus im wald", "de"), ("la maison et le jardin", "fr"), ("une maison dans la foret", "fr")]
    model = language.Model(np.stack([vector(text) for text, _ in texts]), [lang for _, lang in texts])
    sets = [set(np.flatnonzero(vector(text))) for text, _ in texts]
    k = np.array([[plain_kernel(a, b) for b in sets] for a in sets])
    names = sorted({lang for _, lang in texts})
    y = np.array([[1.0 if lang == name else -1.0 for name in names] for _, lang in texts])
    # The centred problem: weights alpha with (k_c + ridge) alpha = y_c, ridge as the model's weights make it.
    n = len(texts)
    centre = np.eye(n) - np.ones((n, n)) / n
    alpha = np.linalg.solve(centre @ k @ centre + language.RIDGE * np.eye(n), centre @ y)
    for text in ("the garden", "der wald", "le jardin et la maison"):
        own = np.array([plain_kernel(set(np.flatnonzero(vector(text))), other) for other in sets])
        value = 4 * ((own - k.mean(0)) @ centre @ alpha + y.mean(0))
        power = np.exp(value - value.max())
        found = model.predict([text])
        assert found[0] == [names[int(value.argmax())]]
        assert abs(found[1][0] - (power / power.sum()).max()) < 1e-3


def test_many_languages(spark):
    """Three hundred languages are all learned, each from its own words."""
    def text(lang: int, n: int) -> str:
        rng = np.random.default_rng(1000 * lang + n)
        letters = np.random.default_rng(lang).permutation(list("abcdefghijklmnopqrstuvwxyz"))
        words = ["".join(letters[np.random.default_rng(lang * 50 + w).integers(0, 9, 5)]) for w in range(12)]
        return " ".join(rng.choice(words, 40))

    rows = [(10 * lang + n, text(lang, n), f"l{lang:03d}", "s") for lang in range(300) for n in range(10)]
    model = language.learn(documents(spark, rows))
    assert len(model.names) == 300
    names, _ = model.predict([text(lang, 77) for lang in range(300)])
    assert sum(name == f"l{lang:03d}" for lang, name in enumerate(names)) >= 295


def test_long_and_noisy_texts(spark):
    """Length does not drown the signal, nor do thousands of random words beside it."""
    docs = spark.read.parquet(f"{GIVEN}/sf0.1/documents.parquet")
    model = language.learn(docs)
    rng = np.random.default_rng(4)
    noise = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(4000))
    for lang in ("en", "fr", "es", "de"):
        clean = [row.text for row in docs.where(f"lang = '{lang}' and length(text) between 1500 and 6000").limit(300).collect()]
        whole = " ".join(clean * 3)
        assert len(whole) > 2_000_000
        names, scores = model.predict([whole, f"{clean[0]} {clean[1]} {clean[2]} {noise}"])
        assert names == [lang, lang] and scores[0] > 0.9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.01/documents.parquet")
    found = language.identify(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [row for row in found if row.held_out]
    assert len(found) == docs.count() and 200 < len(held) < 300
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in found)
    assert sum(row.lang == row.lang_pred for row in held) >= 0.98 * len(held)
    assert all(0 <= row.score <= 1 for row in found)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.001/documents.parquet")
    spoiled = docs.selectExpr("doc_id", "text", "source", "n_chars",
                              "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'wrong', lang) as lang")
    one, two = (language.identify(docs, language.learn(t)).orderBy("doc_id").collect() for t in (docs, spoiled))
    assert one == two


def test_rows(spark):
    model = language.learn(documents(spark, [(n, text, lang, "s") for n in range(0, 80, 2) for text, lang in [
        ("the house and the garden", "en"), ("das haus und der garten", "de")]]))
    found = language.identify(documents(spark, ODD), model).collect()
    assert len(found) == len(ODD)
    by_id = {row.doc_id: row for row in found}
    assert by_id[1].lang_pred == by_id[2].lang_pred == by_id[7].lang_pred == "und" and by_id[1].score == 0
    assert by_id[None].held_out is False and by_id[None].lang_pred == "en"
    assert language.identify(documents(spark, []), model).collect() == []


def test_nothing_to_learn_from(spark):
    model = language.learn(documents(spark, [(2, None, "en", "s"), (3, "text", None, "s")]))
    assert {row.lang_pred for row in language.identify(documents(spark, ODD), model).collect()} == {"und"}
    single = language.learn(documents(spark, [(n, "one language only", "en", "s") for n in range(8)]))
    assert {row.lang_pred for row in language.identify(documents(spark, [(1, "words", "x", "s")]), single).collect()} == {"en"}
