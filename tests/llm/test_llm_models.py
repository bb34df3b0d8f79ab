"""Classifiers and language model: held-out accuracy, identities, brute force."""

import dataclasses
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from pagetally.llm import labelled, maxent, quality_fm, toxicity
from pagetally.llm.labelled import Rows

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=2400, seed=1):
    """Every tenth text insults, by words that share their beginning; every seventh is junk."""
    rnd, docs, labels = random.Random(seed), [], []
    for i in range(n):
        own = prose(rnd, rnd.randrange(10, 80)).split()
        toxic, junk = int(i % 10 == 0), int(i % 7 == 0)
        if toxic:
            own[rnd.randrange(len(own))] = f"vile{rnd.choice('abcdefgh')}{rnd.choice('xyz')},"
        if junk:
            own = [w + "###" for w in own]
        docs.append((i, " ".join(own), "en", "s", None))
        labels.append((i, 1 - junk, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n long")
    marked = spark.createDataFrame(labels[:1600] + [(5, None, None), (10**6, 1, 1), (0, 0, 0)], LABELS)
    return frame, marked, {i: (q, t) for i, q, t in labels}


# --- sparse rows -----------------------------------------------------------------------------


def test_sparse_rows_equal_dense_ones():
    rng = np.random.default_rng(1)
    dense = rng.normal(size=(12, 30)) * (rng.random((12, 30)) < 0.2)
    rows = Rows.of([(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense])
    w = rng.normal(size=30)
    assert np.allclose(rows.dot(w), dense @ w)
    assert np.allclose(rows.take(np.array([3, 0, 3])).dot(w), dense[[3, 0, 3]] @ w)
    some = np.array([2, 5, 29])
    assert np.allclose(rows.columns(some).dot(w[some]), dense[:, some] @ w[some])
    assert len(Rows.of([])) == 0 and Rows.of([]).dot(w).size == 0


def test_sample_is_bounded_and_the_same_each_time(learnt):
    frame, marked, _ = learnt
    twice = frame.unionByName(frame)
    a, b = (labelled.sample(f, marked, ["toxic"], toxicity.features, 100) for f in (frame, twice.repartition(7)))
    assert len(a[0]) <= 100 and np.array_equal(a[1], b[1]) and np.array_equal(a[0].index, b[0].index)


# --- toxicity --------------------------------------------------------------------------------


def test_toxic_texts_are_found_among_unseen_ones(learnt):
    frame, marked, truth = learnt
    chain = toxicity.fit_labels(frame, marked)
    rows = [r for r in toxicity.score(frame, chain).collect() if r.doc_id >= 1600]
    found = {r.doc_id for r in rows if r.rejected}
    toxic = {r.doc_id for r in rows if truth[r.doc_id][1]}
    assert len(found & toxic) >= 0.9 * len(toxic) and not found - toxic
    junk = sum((r.p_junk > 0.5) == (truth[r.doc_id][0] == 0) for r in rows)
    assert junk >= 0.97 * len(rows)
    left = {r.doc_id for r in toxicity.accepted(frame, chain).collect()}
    assert left == {r.doc_id for r in toxicity.score(frame, chain).collect() if not r.rejected}


def test_limit_bears_few_wrong_labels():
    """Forty positive rows, one of them unmarked, wherever it ranks; and no good model at all."""
    for at in range(40):
        p, y = np.linspace(0.99, 0.01, 2000), np.zeros(2000)
        y[:40] = 1
        y[at] = 0
        found = toxicity.limit(p, y, 0.995)
        assert (p >= found).sum() == (40 if at < 39 else 39)
    p, y = np.linspace(0.99, 0.01, 2000), np.zeros(2000)
    y[1::4] = 1  # a quarter, spread out: not even twice the share
    assert 0 < (p >= toxicity.limit(p, y, 0.995)).sum() <= 2000
    assert toxicity.limit(p, np.zeros(2000), 0.995) == 2.0 == toxicity.limit(p[:0], y[:0], 0.995)
    y = (p > 0.7).astype(float)  # many positive rows: one in two hundred may be wrong, not more
    y[::50] = 0
    sure = (p >= toxicity.limit(p, y, 0.995)).sum()
    assert 50 <= sure < 300


def test_one_wrong_label_does_not_end_rejection(spark):
    docs, labels = corpus(1600, 6)
    few = [(i, q, t if i % 30 == 0 else 0) for i, q, t in labels]  # about fifty positive rows
    texts = {i: t for i, t, *_ in docs}
    clean = [(i, t if few[i][2] or "vile" not in t else prose(random.Random(i), 30), *rest) for i, t, *rest in docs]
    wrong = next(i for i, _, t in few if t)
    few[wrong] = (wrong, 1, 0)
    frame = spark.createDataFrame(clean, "doc_id long, text string, lang string, source string, n long")
    chain = toxicity.fit_labels(frame, spark.createDataFrame(few, LABELS))
    rejected = {r.doc_id for r in toxicity.score(frame, chain).collect() if r.rejected}
    toxic = {i for i, _, t in few if t}
    assert len(rejected & toxic) >= 0.9 * len(toxic) and rejected <= toxic | {wrong} and texts


def test_chain_equals_a_dense_recomputation(spark, learnt):
    """Probabilities and verdicts of a few texts, from whole weight vectors."""
    frame, marked, _ = learnt
    chain = toxicity.fit_labels(frame, marked)
    some = frame.where("doc_id < 40").unionByName(frame.limit(1).selectExpr("-1l doc_id", "'' text", "lang", "source", "n"))
    for r in toxicity.score(some, chain).collect():
        x = np.zeros(1 << toxicity.BITS)
        x[toxicity.features(r.text)[0]] = 1
        earlier = []
        for model, name in zip(chain.models, chain.categories):
            logits = [math.log(min(max(q, 1e-4), 1 - 1e-4) / (1 - min(max(q, 1e-4), 1 - 1e-4))) / 10 for q in earlier]
            z = x @ model.weights + sum(w * v for w, v in zip(model.earlier, logits)) + model.constant
            earlier.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
            assert abs(r[f"p_{name}"] - earlier[-1]) < 1e-9
        assert r.rejected == (earlier[1] >= chain.limits[1])


def test_later_models_use_earlier_probabilities():
    """The second label is the first one, hidden in the text: only the chain can know it."""
    rng = np.random.default_rng(4)
    n = 600
    first = rng.integers(0, 2, n)
    rows = Rows.of([(np.array([10 + f]), np.ones(1)) for f in first])
    chain = toxicity.fit(rows, np.column_stack((first, first)), ["a", "b"], toxicity.Settings(features=50))
    assert chain.models[1].earlier[0] > 0
    p = chain.predict(rows)
    assert p.shape == (n, 2) and ((p[:, 1] > 0.5) == first).all()


def test_later_models_learn_from_out_of_fold_probabilities(monkeypatch):
    rng = np.random.default_rng(5)
    columns = [np.unique(rng.integers(0, 300, 15)) for _ in range(200)]
    rows = Rows.of([(c, np.ones(len(c))) for c in columns])
    y = rng.integers(0, 2, (200, 2))
    seen = []
    plain = toxicity.fit_linear

    def spy(rows, y, earlier, settings):
        seen.append((len(rows), earlier.copy()))
        return plain(rows, y, earlier, settings)

    monkeypatch.setattr(toxicity, "fit_linear", spy)
    settings = toxicity.Settings(folds=4)
    chain = toxicity.fit(rows, y, ["a", "b"], settings)
    # Noise: a model knows its own rows by heart, but not those of another fold.
    held = seen[9][1][:, 0]
    own = chain.models[0].predict(rows, np.zeros((200, 0)))
    right = lambda p: ((p > 0.5) == y[:, 0]).mean()
    assert [n for n, _ in seen] == [150] * 4 + [200] + [150] * 4 + [200]
    assert right(own) > right(held) + 0.2


def test_toxicity_of_odd_documents(spark, odd, odd_rows, none, learnt):
    frame, marked, _ = learnt
    chain = toxicity.fit_labels(frame, marked)
    scored = toxicity.score(odd, chain)
    assert scored.count() == len(odd_rows) and scored.where("rejected or rejected is null").count() == 0
    assert dict(scored.dtypes)["rejected"] == "boolean" and "score" in scored.columns
    assert toxicity.accepted(odd, chain).columns == odd.columns
    assert toxicity.accepted(none, chain).count() == 0
    nothing = toxicity.fit_labels(odd, spark.createDataFrame([], LABELS))
    assert toxicity.accepted(odd, nothing).count() == len(odd_rows)


# --- factorisation machine -------------------------------------------------------------------


def test_sum_over_pairs_is_linear():
    rng = np.random.default_rng(7)
    size = 1 << quality_fm.BITS
    machine = quality_fm.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 5)))
    lists = [(np.sort(rng.choice(size, k, replace=False)), rng.normal(size=k)) for k in (0, 1, 2, 17)]
    got, _ = machine.sums(Rows.of(lists))
    for (index, value), z in zip(lists, got, strict=True):
        want = 0.3 + machine.weights[index] @ value
        for a in range(len(index)):
            for b in range(a):
                want += machine.vectors[index[a]] @ machine.vectors[index[b]] * value[a] * value[b]
        assert math.isclose(z, want, rel_tol=1e-9, abs_tol=1e-9)


def test_pairs_are_learnt():
    """The label is whether exactly one of two columns is there: no weight per column tells."""
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 2, (1500, 2))
    rows = Rows.of([(np.array([1, 2 + a, 4 + b]), np.ones(3)) for a, b in bits])
    y = (bits[:, 0] ^ bits[:, 1]).astype(float)
    machine = quality_fm.fit(rows, y, quality_fm.Settings(epochs=30))
    assert ((machine.predict(rows) > 0.5) == y).mean() > 0.97


def test_quality_of_unseen_texts(learnt):
    frame, marked, truth = learnt
    machine = quality_fm.fit_labels(frame, marked.select("doc_id", "quality"))
    rows = [r for r in quality_fm.score(frame, machine).collect() if r.doc_id >= 1600]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == truth[r.doc_id][0] for r in rows) >= 0.97 * len(rows)


def test_quality_of_odd_documents(spark, odd, odd_rows, none, learnt):
    frame, marked, _ = learnt
    machine = quality_fm.fit_labels(frame, marked)
    rows = quality_fm.score(odd, machine).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:  # nothing but the text decides
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert quality_fm.score(none, machine).count() == 0
    nothing = quality_fm.fit_labels(odd, spark.createDataFrame([], LABELS))
    assert {r.score for r in quality_fm.score(odd, nothing).collect()} == {0.5}


# --- maximum entropy -------------------------------------------------------------------------

SMALL = maxent.Shape(words=7, endings=8, classes=4, known=20, longest=6, rounds=4)


def base_scores(train, texts):
    lower = lambda t: (t or "").encode().lower().split() + [b""]
    counts = Counter(w for t in train for w in lower(t))
    n, v = sum(counts.values()), len(counts)
    return [
        (len(w), sum(x in counts for x in w), n, sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        for w in map(lower, texts)
    ]


@pytest.mark.parametrize("shape", [SMALL, maxent.Shape(rounds=2)])
def test_base_scores_equal_brute_force(odd, odd_rows, shape):
    for training in (F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False)), F.lit(False)):
        none = training is not None and str(training._jc) == "false"
        train = [] if none else [r[1] for r in odd_rows if r[0] is not None and r[0] % 3 != 1]
        rows = maxent.score(odd, training, shape).collect()
        key = lambda i, n, k, t, s: (str(i), n, k, t, round(s, 5))
        want = [key(r[0], *b) for r, b in zip(odd_rows, base_scores(train, [r[1] for r in odd_rows]), strict=True)]
        got = [key(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows]
        assert len(got) == len(want)
        for a, b in zip(sorted(got), sorted(want), strict=True):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-6)
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_no_documents_to_score(none):
    assert maxent.score(none, F.lit(True), SMALL).count() == 0


@pytest.fixture(scope="module")
def sequences(spark):
    """Two kinds of texts, with words of their own; words alternate between two sets."""
    rnd, rows = random.Random(9), []
    for i in range(400):
        kind = rnd.choice("xy")
        rows.append((i, " ".join(f"{kind}{'ab'[k % 2]}{rnd.randrange(12)}" for k in range(30))))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_model_beats_frequencies_on_unseen_texts(sequences):
    docs, _ = sequences
    shape = maxent.Shape(words=55, endings=8, classes=8, rounds=6)
    rows = maxent.score(docs, F.col("doc_id") < 300, shape).where("doc_id >= 300").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.4 * sum(r.n_tokens for r in rows)


@pytest.mark.parametrize("shape", [SMALL, maxent.Shape(words=55, endings=8, classes=8, rounds=3)])
def test_probabilities_sum_to_one(sequences, shape):
    """After any history, over all known words, an unknown one for each ending, and the unit that
    never comes."""
    docs, rows = sequences
    model, counts = maxent.fit(docs.select("text"), shape)
    model.prepare()
    words = [bytes(r.word) for r in counts.collect()]
    n = {bytes(r.word): r.n for r in counts.collect()}
    for one, two in ((shape.units - 1, shape.units - 1), (1, shape.units - 1), (3, 2), (shape.words, 5)):
        units = np.arange(shape.units)
        by_unit = model.units(units, np.full(shape.units, one), np.full(shape.units, two))
        total = 0.0
        own = set(list(model.known.place)[: shape.words])
        for w in words:
            place = model.known.place.get(w, -1)
            unit = int(model.known.unit[place]) if place >= 0 else shape.ending(w)
            total += 10 ** (by_unit[unit] + (0 if w in own else math.log10(n[w] + 0.5)))
        endings = range(shape.words, shape.words + shape.endings)
        total += sum(10 ** (by_unit[u] + math.log10(0.5)) for u in endings)
        unused = [u for u in range(len(own), shape.words)] + [shape.units - 1]
        total += sum(10 ** (by_unit[u] + model.log_mass[u]) for u in unused)
        assert math.isclose(total, 1, abs_tol=1e-4)


def test_training_equals_a_plain_recomputation(spark):
    """Weights after two steps, from loops over histories, features and outcomes."""
    rnd = random.Random(12)
    docs = spark.createDataFrame([(prose(rnd, 40, 30),) for _ in range(30)], "text string")
    known = maxent.vocabulary(maxent.word_counts(docs), SMALL)
    outcomes = maxent.outcome_counts(docs, known)
    histories = [(r.history, list(r)[1:]) for r in outcomes.collect()]
    u, c, k = SMALL.units, SMALL.classes, SMALL.smoothing
    shape = dataclasses.replace(SMALL, rounds=2)
    weights = maxent.train(outcomes, dataclasses.replace(SMALL, rounds=0)).astype(float)

    def rows_of(history):
        if history < u * u:
            one, two = divmod(history, u)
            pair = int(maxent.pair_row(SMALL, np.array([one]), np.array([two]))[0])
            return [0, 1 + one, 1 + u + two, pair]
        slot = history - u * u
        return [SMALL.slot_rows + slot % c, SMALL.slot_rows + c + slot]

    for _ in range(2):
        observed, expected = np.zeros_like(weights), np.zeros_like(weights)
        features = {}
        for history, counts in histories:
            z = [math.exp(sum(weights[r][o] for r in rows_of(history))) for o in range(c)]
            for r in rows_of(history):
                features[r] = len(rows_of(history))
                for o in range(c):
                    observed[r][o] += counts[o]
                    expected[r][o] += sum(counts) * z[o] / sum(z)
        for r, n in features.items():
            for o in range(c):
                step = (observed[r][o] - expected[r][o]) / (n * (max(observed[r][o], expected[r][o]) + k))
                weights[r][o] += step
    assert np.abs(maxent.train(outcomes, shape) - weights).max() < 1e-3


def test_gradients_do_not_depend_on_partitions(sequences):
    docs, _ = sequences
    shape = SMALL
    counts = maxent.word_counts(docs.select("text"))
    known = maxent.vocabulary(counts, shape)
    one, many = (maxent.outcome_counts(docs.select("text").repartition(k), known) for k in (1, 9))
    assert np.allclose(maxent.feature_sums(one, shape, None), maxent.feature_sums(many, shape, None))
    weights = maxent.train(one, shape)
    observed = maxent.feature_sums(one, shape, None)
    lack = [
        np.abs(observed - maxent.feature_sums(one, shape, w)).sum() for w in (np.zeros_like(weights), weights)
    ]
    assert lack[1] < 0.2 * lack[0]
