"""Co-training in Spark against the same rounds in plain Python, over all documents."""

import math
import random

import numpy as np

from reelhouse.llm import cotraining
from reelhouse.llm.cotraining import Logistic

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep string, given int"


def corpus(seed, n):
    """Good texts of one vocabulary and bad ones of another; the source tells most of them apart."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        good = draw.random() < 0.6
        mark = "ing" if good else "xyz"
        words = [draw.choice("abcdefgh") * draw.randrange(1, 4) + (mark if draw.random() < 0.4 else "er") for _ in range(40)]
        source = draw.choice(["news", "wiki"] if good == (draw.random() < 0.995) else ["spam", "feed"])
        rows.append((i, " ".join(words), draw.choice(["en", None]), source, draw.choice([None, 200 + i % 50]), good))
    return rows


def plain_model(rows, labels, rounds, growth, confidence=0.9):
    """The rounds over lists, every document scored by a loop."""
    known = {}
    views = {
        r[0]: (cotraining.text_features(r[1] or "", known), cotraining.metadata_features(*r[2:5], known)) for r in rows
    }
    ids = sorted(set(views) & set(labels))
    y = {i: float(labels[i] > 0) for i in ids}
    held = [i for c in (0.0, 1.0) for i in [j for j in ids if y[j] == c][3::4]]
    train = [i for i in ids if i not in held]
    taught = [[(i, y[i]) for i in train] for _ in range(2)]
    share = sum(y[i] for i in train) / len(train)
    steps = []

    def fitted():
        models = []
        for v in range(2):
            x = np.array([views[i][v] for i, _ in taught[v]])
            model = Logistic().fit(x, np.array([t for _, t in taught[v]]))
            model.calibrate(np.array([views[i][v] for i in held]), np.array([y[i] for i in held]))
            models.append(model)
        return models

    for _ in range(rounds):
        models = fitted()
        passed = []
        for teacher, learner, label in ((0, 1, 1), (0, 1, 0), (1, 0, 1), (1, 0, 0)):
            most = max(1, round(growth * (share if label else 1 - share)))
            sure = []
            for i in views:
                if i not in y and i not in {j for j, _ in taught[learner]}:
                    odds = float(models[teacher].odds(views[i][teacher][None])[0])
                    odds = odds if label else -odds
                    if odds >= math.log(confidence / (1 - confidence)):
                        sure.append((-odds, i))
            passed.append((learner, [(i, float(label)) for _, i in sorted(sure)[:most]]))
        for learner, new in passed:
            taught[learner] += new
        steps.append([len(new) for _, new in passed])
    text, metadata = fitted()
    prior = math.log(sum(y.values()) / (len(y) - sum(y.values())))
    scores = {}
    for i, (a, b) in views.items():
        odds = float(text.odds(a[None])[0]), float(metadata.odds(b[None])[0])
        scores[i] = 1 / (1 + math.exp(-max(-30, min(30, sum(odds) - prior))))
    return scores, steps


def test_rounds_equal_plain_python(spark):
    rows = corpus(4, 400)
    labels = {r[0]: int(r[5]) for r in rows if r[0] % 5 < 2}
    expected, steps = plain_model(rows, labels, rounds=3, growth=40)
    assert sum(map(sum, steps)) > 60  # both views taught each other
    docs = spark.createDataFrame([(*r[:5], "k", 3) for r in rows], SCHEMA).repartition(5)
    given = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    model = cotraining.learn(docs, given, rounds=3, growth=40, confidence=0.9)
    found = {r.doc_id: r for r in cotraining.score(docs, model).collect()}
    assert found.keys() == expected.keys()
    assert all(abs(found[i].score - s) < 1e-6 for i, s in expected.items())
    right = sum((found[r[0]].score >= 0.5) == r[5] for r in rows)
    assert right >= 0.97 * len(rows)


def test_every_document_without_a_label_may_teach(spark):
    """The pool has no bound: with ten times the documents the surest of all of them are passed on."""
    small = corpus(9, 120)
    labels = {r[0]: int(r[5]) for r in small[:60]}
    many = small + [(1000 + n * 120 + r[0], *r[1:]) for n in range(9) for r in corpus(100 + n, 120)]
    expected, _ = plain_model(many, labels, rounds=2, growth=300)
    docs = spark.createDataFrame([(*r[:5], "k", 3) for r in many], SCHEMA)
    given = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    found = cotraining.score(docs, cotraining.learn(docs, given, rounds=2, growth=300, confidence=0.9)).collect()
    assert all(abs(r.score - expected[r.doc_id]) < 1e-6 for r in found)


def test_one_id_that_holds_many_rows_counts_once(spark):
    rows = corpus(2, 200)
    labels = {r[0]: int(r[5]) for r in rows[:80]}
    given = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    docs = spark.createDataFrame([(*r[:5], "k", 3) for r in rows], SCHEMA)
    hot = docs.where("doc_id = 150")
    for _ in range(6):
        hot = hot.union(hot)
    nulls = docs.limit(30).selectExpr("cast(null as long) as doc_id", "text", "lang", "source", "n_chars", "keep", "given")
    scores = [
        {r.doc_id: r.score for r in cotraining.score(docs, cotraining.learn(d, given, rounds=2, confidence=0.9)).collect()}
        for d in (docs, docs.union(hot).union(nulls))
    ]
    assert all(abs(scores[0][i] - s) < 1e-9 for i, s in scores[1].items())
