import random
import zlib

import numpy as np
import pytest
from fixtures import odd_pairs, prose, table
from pyspark.sql import functions as F

from fieldtally.llm.toxicity import Index, Vocabulary, learnable, toxicity, unit


def random_rows(chance, n, terms):
    rows = []
    for _ in range(n):
        held = np.sort(np.array(chance.sample(range(terms), chance.randint(0, 6)), dtype=np.int64))
        rows.append((held, np.array([chance.randint(1, 4) for _ in held], dtype=np.int64)))
    return rows


def test_block_max_search_is_exact():
    chance = random.Random(7)
    terms, rows = 12, None
    idf = np.array([1 + chance.random() for _ in range(terms)])
    rows = random_rows(chance, 900, terms)
    labels = [chance.randint(0, 1) for _ in rows]
    index = Index.build(list(range(900)), labels, rows, idf)
    dense = np.zeros((900, terms))
    for i, (t, c) in enumerate(rows):
        dense[i, t] = unit(t, c, idf)
    for t, c in random_rows(chance, 150, terms):
        query = np.zeros(terms)
        query[t] = unit(t, c, idf)
        cosines = np.round(dense @ query, 12)
        order = [i for i in np.lexsort((np.arange(900), -cosines)) if cosines[i] > 0][:25]
        best, found = index.nearest(t, unit(t, c, idf))
        assert np.allclose(found, cosines[order]) and index.ids[best].tolist() == order


def labelled(n=400):
    chance = random.Random(1)
    pairs, labels = [], []
    for i in range(n):
        bad = chance.random() < 0.3
        words = prose(3000 + i, 40).split()
        for _ in range(3 * bad):
            words.insert(chance.randrange(len(words)), chance.choice(["grumbel", "snarkle", "blightful"]))
        pairs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return pairs, labels


def test_held_out_accuracy(spark):
    pairs, labels = labelled()
    rows = spark.createDataFrame(labels, "doc_id bigint, label int")
    found = {r.doc_id: r for r in toxicity(table(spark, pairs), rows.filter(learnable(F.col("doc_id")))).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(found) == len(pairs) and len(held) > 50
    assert np.mean([(found[i].score >= 0.3) == y for i, y in held]) > 0.95
    known = {i for i, _ in labels} - {i for i, _ in held}
    assert all(set(r.evidence) <= known for r in found.values())


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (1, 0), (3, None), (99, 1), (6, 0), (None, 1)]])
def test_odd_rows_and_labels(spark, odd, nothing, labels):
    rows = spark.createDataFrame(labels, "doc_id bigint, label int")
    found = toxicity(odd, rows).collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted((i for i, _ in odd_pairs()), key=repr)
    assert all(0 <= r.score <= 1 for r in found)
    if not labels:
        assert {r.score for r in found} == {0.0}
    assert toxicity(nothing, rows).collect() == []


def test_rare_toxic_words_and_texts_without_them_have_neighbours(spark):
    pairs = [(i, prose(5000 + i, 30)) for i in range(60)]
    pairs += [(100 + i, prose(5100 + i, 30) + " zorgulate zorgulate") for i in range(3)]  # fewer than any threshold would take
    labels = [(i, int(i >= 100)) for i, _ in pairs if i != 102]
    rows = spark.createDataFrame(labels, "doc_id bigint, label int")
    found = {r.doc_id: r for r in toxicity(table(spark, pairs), rows).collect()}
    assert set(found[102].evidence[:2]) == {100, 101}
    assert all(found[i].evidence[0] == i for i, _ in labels) and len({r.score for r in found.values()}) > 30


def test_head_and_lists_give_the_exact_neighbours():
    chance = np.random.default_rng(5)
    size, n = 3000, 700  # terms beyond the head, and as many equal vectors as neighbours
    rows = []
    for _ in range(n):
        held = np.unique((size * chance.random(90) ** 3).astype(np.int64))
        rows.append((held, chance.integers(1, 4, len(held))))
    rows += rows[:40] + [rows[0]] * 30
    idf = 1 + 3 * chance.random(size)
    index = Index.build(list(range(len(rows))), [0] * len(rows), rows, idf)
    dense = np.zeros((len(rows), size))
    for i, (t, c) in enumerate(rows):
        dense[i, t] = unit(t, c, idf)
    for i in range(0, n, 9):
        cosines = np.round(dense @ dense[i], 12)
        best, found = index.nearest(rows[i][0], unit(*rows[i], idf))
        assert np.allclose(found, np.sort(cosines)[::-1][:25]) and np.allclose(found, cosines[best]) and len(set(best)) == 25


def test_only_terms_of_the_table_are_computed_twice():
    """Each weight is in the table or in a list: the exact step reads no list again."""
    chance = np.random.default_rng(6)
    rows = [(np.unique((4000 * chance.random(80) ** 3).astype(np.int64)),) for _ in range(300)]
    rows = [(t, chance.integers(1, 4, len(t))) for (t,) in rows]
    index = Index.build(list(range(300)), [0] * 300, rows, 1 + 3 * chance.random(4000))
    assert len(index.terms) + len(index.posted) == sum(len(t) for t, _ in rows) and len(index.posted) > 0


def test_places_of_terms():
    chance = np.random.default_rng(7)
    terms = chance.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2)
    terms[:40] = np.arange(40)  # many in one range
    asked = np.concatenate([terms[::3], chance.integers(0, 2**63, 900).astype(np.uint64), np.arange(80, dtype=np.uint64)])
    known = {t: i for i, t in enumerate(np.unique(terms).tolist())}
    assert Vocabulary(terms).places(asked).tolist() == [known.get(t, -1) for t in asked.tolist()]
    assert Vocabulary(terms[:0]).places(asked).tolist() == [-1] * len(asked)
