import random

import numpy as np
import pytest
from fixtures import odd_pairs, prose, table

from fieldtally.llm.quality import fit, grade, keep_good, rated, train


def graded(n=300):
    pairs, labels = [], []
    for i in range(n):
        kind = i % 3
        text = prose(5000 + i, 50)
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if kind == 1:
            text = text.replace(".", " &&").replace("e", "3")
        pairs.append((i, text))
        labels.append((i, kind))
    return pairs, labels


def test_orders_the_grades(spark):
    pairs, labels = graded()
    docs, rows = table(spark, pairs), spark.createDataFrame(labels, "doc_id bigint, grade int")
    model = train(docs, rows.filter("doc_id < 200"), 3)
    assert (np.diff(model.thresholds) > 0).all()
    found = {r.doc_id: r for r in grade(docs, model).collect()}
    means = [np.mean([found[i].expected_grade for i, g in labels if i >= 200 and g == k]) for k in range(3)]
    assert means[0] + 0.3 < means[1] and means[1] + 0.3 < means[2]
    assert all(r.tails[0] >= r.tails[1] and abs(sum(r.tails) - r.expected_grade) < 1e-9 for r in found.values())
    assert np.mean([found[i].keep == (g > 0) for i, g in labels if i >= 200]) > 0.9


def test_gradient_lowers_the_loss():
    chance = random.Random(2)
    rows = [(y, np.array([y, 5]), np.array([0.8, 0.6])) for y in (chance.randint(0, 3) for _ in range(200))]
    model = fit(rows, 4, buckets=8)
    tails = np.array([model.tails(p, v) for _, p, v in rows])
    predicted = (tails > 0.5).sum(axis=1)
    assert (predicted == [r[0] for r in rows]).mean() > 0.95


def test_without_labels_everything_stays(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = keep_good(odd, none)
    assert kept.columns == odd.columns and kept.count() == len(odd_pairs())
    assert {tuple(r.tails) for r in grade(odd, train(odd, rated(none), 3)).collect()} == {(0.5, 0.5)}
    assert keep_good(nothing, none).collect() == []


@pytest.mark.parametrize("labels", [[(1, 1, 0), (6, 0, 0), (7, None, 1), (None, 1, 1), (2, 1, None)], [(1, 1, 0), (1, 0, 1), (8, 1, 1)]])
def test_odd_labels(spark, odd, labels):
    rows = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = grade(odd, train(odd, rated(rows), 3)).collect()
    assert len(found) == len(odd_pairs()) and all(np.isfinite(r.expected_grade) for r in found)
    assert keep_good(odd, rows).count() == sum(r.keep for r in found)
