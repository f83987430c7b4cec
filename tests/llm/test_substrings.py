import random

import numpy as np
from fixtures import odd_pairs, prose, shingle_set, table, words_of

from fieldtally.llm import substrings
from fieldtally.llm.decontaminate import stretch
from fieldtally.llm.substrings import compact_windows, repeated_passages, sliding_least


def test_windows_partition_all_subsequences():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, width = int(rng.integers(5, 40)), int(rng.integers(1, 6))
        keys = rng.permutation(n).astype(np.uint64)
        least = sliding_least(keys, width)
        assert least.tolist() == [int(keys[i : i + width].min()) for i in range(n - width + 1)]
        centres = np.unique(np.array([int(np.flatnonzero(keys == v)[0]) for v in least]))
        windows = compact_windows(keys, centres, np.array([0, n]))
        for i in range(n):
            for j in range(i + width - 1, n):
                holding = [c for l, c, r in windows if l <= i <= c <= j <= r]
                assert holding == [i + int(np.argmin(keys[i : j + 1]))]


def passages():
    chance, pairs = random.Random(3), odd_pairs()
    shared = [prose(9100 + k, n).split() for k, n in enumerate([60, 90, 52, 200])]
    planted = []
    for i in range(60):
        own = prose(9200 + i, 80).split()
        at = chance.randrange(80)
        passage = list(shared[i % 4]) if i % 5 else []
        if i % 7 == 0 and len(passage) > 80:
            passage[40] = "changed"
        pairs.append((2000 + i, " ".join(own[:at] + passage + own[at:])))
        if passage:
            planted.append((2000 + i, i % 4))
    pairs += [(4000 + i, prose(9400 + i, 100) + " " + " ".join(shared[0][:30])) for i in range(10)]
    return pairs, planted


def test_planted_passages_are_found(spark):
    pairs, planted = passages()
    found = repeated_passages(table(spark, pairs), filter_bits=1 << 20).collect()
    texts = {}
    for i, t in pairs:
        texts.setdefault(i, []).append(words_of(t))
    for r in found:
        alike = []
        for a in texts[r.doc_id]:
            for b in texts[r.of_doc_id]:
                x = shingle_set(" ".join(a[r.start_word : r.start_word + r.n_words]), 5)
                y = shingle_set(" ".join(b[r.of_start_word : r.of_start_word + r.of_n_words]), 5)
                alike.append(len(x & y) / max(1, len(x | y)))
        assert any(abs(s - r.similarity) < 1e-6 for s in alike) and r.similarity >= 0.8 and r.n_words >= 50
    first = {}
    for i, kind in planted:
        first.setdefault(kind, i)
    repeating = {i for i, kind in planted if first[kind] != i}
    known = {i for i, _ in odd_pairs()}
    assert repeating <= {r.doc_id for r in found}
    assert {r.doc_id for r in found} - known <= {i for i, _ in planted}
    assert {r.of_doc_id for r in found} - known <= {i for i, _ in planted}
    assert {(8, 7), (1, -5)} <= {(r.doc_id, r.of_doc_id) for r in found}


def test_empty_and_clean_tables(spark, nothing):
    assert repeated_passages(nothing, filter_bits=1 << 16).collect() == []
    assert repeated_passages(table(spark, [(i, prose(i, 200)) for i in range(20)]), filter_bits=1 << 20).collect() == []


def changed(words, *places):
    return [f"changed{p}" if p in places else w for p, w in enumerate(words)]


def test_found_passages_still_lead(spark):
    """By passage: chains 1~2~3 with 1 unlike 3."""
    pairs, expected = [], set()
    for k in range(6):
        own = prose(9700 + k, 55).split()
        texts = [own, changed(own, 18), changed(own, 18, 36)]
        ids = [10_000 + 100 * k + i for i in range(3)]
        pairs += [(i, " ".join(prose(20_000 + i, 40).split() + t + prose(30_000 + i, 40).split())) for i, t in zip(ids, texts, strict=True)]
        held = [shingle_set(" ".join(t), 5) for t in texts]
        alike = [[len(a & b) / len(a | b) for b in held] for a in held]
        assert alike[0][1] >= 0.8 and alike[1][2] >= 0.8 and alike[0][2] < 0.8
        expected |= {(ids[1], ids[0]), (ids[2], ids[1])}
    found = repeated_passages(table(spark, pairs), filter_bits=1 << 20).collect()
    assert expected <= {(r.doc_id, r.of_doc_id) for r in found}


def test_texts_that_repeat_a_line_meet_once(spark, monkeypatch):
    """Windows of one signature in a text lead together; equal texts repeat the smallest as a whole."""
    line = prose(9800, 30).split()
    own = [prose(9801 + k, 300).split() for k in range(3)]
    pairs = [(11_000 + k, " ".join(w for i in range(40) for w in line + own[k][4 * i : 4 * i + 4])) for k in range(3)]
    pairs += [(11_010, pairs[0][1]), (11_011, pairs[0][1])]
    rounds = []
    write = substrings.materialize
    monkeypatch.setattr(substrings, "materialize", lambda df, label: rounds.append(label) or write(df, label))
    found = repeated_passages(table(spark, pairs), filter_bits=1 << 20).collect()
    assert rounds.count("passages") <= 5
    words = len(pairs[0][1].split())
    assert {tuple(r)[:6] for r in found if r.doc_id > 11_002} == {(i, 0, words, 11_000, 0, words) for i in (11_010, 11_011)}


def test_stretch_is_the_longest():
    chance = random.Random(5)
    for _ in range(300):
        equal = np.array([chance.random() < 0.8 for _ in range(chance.randint(0, 30))], dtype=bool)
        share = chance.choice([0.5, 0.8, 0.9, 1.0])
        good = [(b - a, -a) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if equal[a:b].sum() * 1000 >= round(share * 1000) * (b - a)]
        size, first = max(good, default=(0, 0))
        assert stretch(equal, share) == (-first, -first + size)
