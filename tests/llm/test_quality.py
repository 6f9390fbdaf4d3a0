import random
import re

import numpy as np
import pytest

from kinfold.llm import quality

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, p_toxic string, extra int"


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in "bdgkl" for b in "aeiou" for c in "mnrst"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 120))]
        good, toxic = rng.random() > 0.3, rng.random() < 0.25
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(("vilest", "dreck"))
        text = " ".join(w) + "." if good else " ".join(x + rng.choice(("!!", "$$$", "%%%")) for x in w).upper()
        rows.append((i, text, "en", f"s{i % 3}", len(text), "old", 1))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, FIELDS)
    fit = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    model = quality.train(docs, fit)
    got = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    assert set(quality.scored(docs, model).columns) == {"doc_id", "text", "lang", "source", "n_chars", "extra", "p_quality", "p_toxic", "accepted"}
    held = [x for x in labels if x[0] % 3 == 0]
    assert np.mean([(got[i].p_quality >= 0.5) == bool(q) for i, q, _ in held]) > 0.97
    assert np.mean([(got[i].p_toxic >= 0.5) == bool(t) for i, _, t in held]) > 0.95
    assert np.mean([got[i].accepted == bool(q and not t) for i, q, t in held]) > 0.93


def test_brute_force_scores(spark):
    rows, labels = corpus(300, 2)
    docs = spark.createDataFrame(rows, FIELDS)
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    views = quality.Views()
    for r in quality.scored(docs.limit(20), model).collect():
        data = np.frombuffer(r.text.encode(), np.uint8)
        ends = np.array([0, len(data)])
        content, meta = views.content(data, ends), views.metadata(data, ends, [r.lang], [r.source], [r.n_chars])
        m = model.quality
        a = m.content.weights[content[1]].astype(float).sum() + m.content.bias
        b = m.metadata.weights[meta[1]].astype(float).sum() + m.metadata.bias
        z = m.mix[0] * np.clip(a, -30, 30) + m.mix[1] * np.clip(b, -30, 30) + m.mix[2]
        assert abs(r.p_quality - 1 / (1 + np.exp(-z))) < 1e-9


def test_awkward(spark, docs, rows, no_docs):
    some, labels = corpus(200, 3)
    model = quality.train(spark.createDataFrame(some, FIELDS), spark.createDataFrame([*labels, (1, None, 1), (None, 1, 1), (5, 0, 1), (5, 1, 0), (99999, 1, 0)], "doc_id long, quality int, toxic int"))
    got = quality.scored(docs, model)
    assert got.count() == len(rows) and got.filter("p_quality is null or accepted is null").count() == 0
    assert quality.scored(no_docs, model).count() == 0
    bare = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert quality.scored(bare, model).count() == 2


def test_without_labels(spark, docs, rows, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for model in (quality.train(docs, none), quality.train(no_docs, none), quality.train(docs, spark.createDataFrame([(i, 1, 0) for i in range(30, 60)], "doc_id long, quality int, toxic int"))):
        assert quality.scored(docs, model).filter("accepted and p_quality is null").count() == len(rows)


class Plain:
    """The training again, without arrays of features or Spark: sets of names, dense matrices, plain loops."""

    def __init__(self, rows, labels, rounds=quality.ROUNDS, sure=quality.SURE):
        self.rows = {r[0]: (self.content(r[1]), self.metadata(*r[1:5])) for r in rows}
        self.models = {}
        known = sorted((i, q, t) for i, q, t in labels if i in self.rows)
        pool = [i for i in self.rows if i not in {k[0] for k in known}]
        for column, target in ((1, "quality"), (2, "toxic")):
            held, kept = known[::5], [k for n, k in enumerate(known) if n % 5]
            extra = [{}, {}]
            for turn in range(rounds + 1):
                views = [self.fit([(self.rows[k[0]][v], k[column]) for k in kept] + [(self.rows[i][v], extra[v][i]) for i in sorted(extra[v])]) for v in (0, 1)]
                if turn < rounds:
                    told = [{i: 1 / (1 + np.exp(-self.margin(views[v], self.rows[i][v]))) for i in pool} for v in (0, 1)]
                    for v in (0, 1):
                        extra[1 - v].update({i: 0 for i, p in told[v].items() if 1 - p >= sure})
                        extra[1 - v].update({i: 1 for i, p in told[v].items() if p >= sure})
            x = np.array([[self.margin(views[v], self.rows[k[0]][v]) for v in (0, 1)] for k in held])
            self.models[target] = views, self.calibrate(x, np.array([k[column] for k in held], float))

    def probability(self, target, i):
        views, (a, b, c) = self.models[target]
        x, y = (np.clip(self.margin(views[v], self.rows[i][v]), -30, 30) for v in (0, 1))
        return 1 / (1 + np.exp(-(a * x + b * y + c)))

    @staticmethod
    def content(text):
        return {(1, w) for w in re.findall(r"[0-9a-z]+", text.lower())} | {(2, w) for w in re.findall(r"[!-/:-@\[-`{-~]+", text)}

    @staticmethod
    def metadata(text, lang, source, n_chars):
        n, words, lines = max(len(text), 1), len(text.split()), text.count("\n") + 1
        log, share = lambda x: int(2 * np.log2(x + 1.0)), lambda x: int(16 * np.sqrt(x / n))
        count = lambda pattern: len(re.findall(pattern, text))
        values = [log(n_chars), log(words), log(lines), log(n / lines), share(count("[A-Z]")), share(count(r"[!-/:-@\[-`{-~]")), share(count("[0-9]")), n // max(words, 1), lang, source]
        return set(enumerate(values))

    @staticmethod
    def margin(model, names):
        return sum(model[0].get(x, 0.0) for x in names) + model[1]

    @staticmethod
    def fit(pairs, steps=80, ridge=1e-4, rate=0.15, least=2.5):
        y = np.array([label for _, label in pairs], float)
        every = sorted({x for names, _ in pairs for x in names}, key=str)
        has = np.array([[x in names for x in every] for names, _ in pairs], float)
        prior = min(max(y.mean(), 0.01), 0.99)
        seen = has.sum(0)
        away = abs(has.T @ y - prior * seen) / np.sqrt(prior * (1 - prior) * seen + 0.5)
        has, scale, every = has[:, away >= least], away[away >= least] / 5, [x for x, a in zip(every, away, strict=True) if a >= least]
        w, b = np.zeros(len(every)), np.log(prior / (1 - prior))
        m, v, m0, v0 = np.zeros(len(every)), np.zeros(len(every)), 0.0, 0.0
        for t in range(1, steps + 1):
            error = (1 / (1 + np.exp(-(has @ (scale * w) + b))) - y) / len(y)
            g, g0 = (has.T @ error) * scale + ridge * w, error.sum()
            m, v, m0, v0 = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2, 0.9 * m0 + 0.1 * g0, 0.99 * v0 + 0.01 * g0**2
            w, b = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9), b - rate * (m0 / (1 - 0.9**t)) / (np.sqrt(v0 / (1 - 0.99**t)) + 1e-9)
        return dict(zip(every, scale * w, strict=True)), b

    @staticmethod
    def calibrate(x, y):
        """Projected gradient descent on the same loss."""
        z = np.column_stack([np.clip(x, -30, 30), np.ones(len(x))])
        w = np.zeros(3)
        rate = 1 / (0.25 * np.linalg.norm(z, 2) ** 2 + 0.1)
        for _ in range(60000):
            w -= rate * (z.T @ (1 / (1 + np.exp(-z @ w)) - y) + 0.1 * w)
            w[:2] = np.maximum(w[:2], 0)
        return w


def test_training_against_a_plain_version(spark):
    rows, labels = corpus(240, 7)
    labels = labels[:150]
    model = quality.train(spark.createDataFrame(rows, FIELDS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), max_handed=10_000)
    plain = Plain(rows, labels)
    for r in quality.scored(spark.createDataFrame(rows, FIELDS), model).collect():
        assert abs(r.p_quality - plain.probability("quality", r.doc_id)) < 2e-3
        assert abs(r.p_toxic - plain.probability("toxic", r.doc_id)) < 2e-3


@pytest.mark.parametrize("signs", [(1, 1), (1, -1), (-1, 1), (-1, -1)])
def test_calibration_of_views_of_either_sign(signs):
    rng = np.random.default_rng(4)
    y = (rng.random(200) < 0.15).astype(float)
    x = np.column_stack([s * (4 * y - 2) + rng.normal(0, 1, 200) for s in signs])
    w = quality.calibrated(x, y)
    assert (w[:2] >= 0).all() and [w[i] > 0 for i in (0, 1)] == [s > 0 for s in signs]
    assert np.isfinite(w).all() and w[2] < 0


def test_the_views_teach_each_other():
    """A word that only unlabelled documents have becomes known by the metadata that comes with it."""
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    content, meta = [np.array([v]) for v in y * 4 + rng.integers(0, 4, 400)], [np.array([v]) for v in y * 4 + rng.integers(0, 4, 400)]
    flat = lambda some: (np.array([len(x) for x in some]), np.concatenate(some))
    fit = quality.CoFit((flat(content), flat(meta)), y)
    assert fit.trainable
    before = fit.fit()[0].margins(np.array([1]), np.array([99]))[0]
    for i in range(60):
        fit.hand(0, i, np.array([99, 4]), 1)
    assert fit.fit()[0].margins(np.array([1]), np.array([99]))[0] > before + 0.5


def test_handed_documents_are_unlabelled_and_bounded(spark):
    rows, labels = corpus(300, 5)
    docs = spark.createDataFrame(rows, FIELDS)
    known = spark.createDataFrame([(i,) for i in range(100)], "doc_id long")
    # Any document with a feature that the model has is sure to be 1, any other sure to be 0.
    all_sure = quality.Linear(np.full(1 << quality.CONTENT_BITS, 9.0, np.float32), -4.0)
    slots = quality._sure(quality.features(docs), known, [(all_sure, all_sure), None], 0.97, 30)
    assert {s for s, _ in slots} == {1, 3} and all(i >= 100 for _, i in slots) and len(slots) == 60
    every = quality._sure(quality.features(docs), known, [(all_sure, all_sure), None], 0.97, 10_000)
    assert {i for s, i in every if s == 1} == set(range(100, 300)) and set(slots) <= set(every)


def test_dotted_names(spark):
    some, labels = corpus(200, 3)
    model = quality.train(spark.createDataFrame(some, FIELDS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    df = spark.createDataFrame([(1, "a b", 2)], "doc_id long, text string, `a.b` int")
    assert quality.scored(df, model).columns == ["doc_id", "text", "a.b", "p_quality", "p_toxic", "accepted"]
    assert quality.scored(df, model).count() == 1
