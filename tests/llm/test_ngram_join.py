import random
from collections import Counter

import pytest
from fixtures import odd_pairs, prose, shingle_set, smallest_reachable, table

from fieldtally.llm import ngram_join as ngram
from fieldtally.llm.components import components
from fieldtally.llm.ngram_join import keep_one, ngram_join, t_occurrence


def test_t_occurrence_equals_counting():
    chance = random.Random(2)
    for _ in range(1500):
        lists = [sorted(chance.sample(range(30), chance.randint(0, 20))) for _ in range(chance.randint(0, 12))]
        need, counts = chance.randint(1, 8), Counter(x for y in lists for x in y)
        found = list(t_occurrence(lists, need, chance.choice([0.01, 0.05, 0.5, 3])))
        assert sorted(found) == sorted((x, n) for x, n in counts.items() if n >= need)


def near_pairs():
    """Copies with some words changed, chains of them, and a passage that many texts share."""
    chance, pairs = random.Random(5), odd_pairs()
    common = prose(600, 20)
    for family in range(8):
        words = prose(610 + family, 150).split()
        for k in range(3 + family * 3):
            pairs.append((1000 + 100 * family + (k * 7) % 50, " ".join(words)))
            for _ in range(chance.randint(0, 2)):
                words[chance.randrange(150)] = f"w{chance.randrange(10**6)}"
            if chance.random() < 0.3:
                pairs.append((None if family == 3 else 5000 + len(pairs), " ".join(words).upper()))
    return pairs + [(7000 + i, prose(700 + i, 60) + " " + common) for i in range(30)]


def classes(pairs, size, percent):
    sets = [shingle_set(t, size) for _, t in pairs]
    links = [
        (a, b)
        for a in range(len(pairs))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return [len(s) for s in sets], links


@pytest.mark.parametrize(("size", "percent", "block"), [(4, 85, 512), (4, 85, 6), (5, 80, 4)])
def test_equals_brute_force(spark, size, percent, block):
    pairs = near_pairs()
    counts, links = classes(pairs, size, percent)
    least = smallest_reachable([i for i, _ in pairs], links)
    found = ngram_join(table(spark, pairs), size=size, percent=percent, block=block, filter_bits=1 << 20).collect()
    expected = [(i, n, c) for (i, _), n, c in zip(pairs, counts, least, strict=True)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == sorted(expected, key=repr)
    assert len({r.row for r in found}) == len(pairs)


def test_one_of_each_group_stays(spark, nothing):
    pairs = near_pairs()
    docs = table(spark, pairs)
    _, links = classes(pairs, 5, 80)
    groups = smallest_reachable(list(range(len(pairs))), links)
    members = {}
    for i, g in enumerate(groups):
        members.setdefault(g, []).append(pairs[i])
    expected = []
    for group in members.values():
        first = min({p for p in group}, key=lambda p: (p[0] is None, p[0] or 0))
        expected.append(first[0])
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {(r.doc_id is None, r.doc_id) for r in rows} == {(i is None, i) for i in expected}
    assert len({(r.doc_id, r.text) for r in rows}) == len(expected)
    assert keep_one(nothing).collect() == [] and ngram_join(nothing, filter_bits=1 << 16).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 4), (4, 5), (3, 3)] + [(0, 300 + i) for i in range(50)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = sorted({x for p in links for x in p})
    position = {n: i for i, n in enumerate(nodes)}
    least = smallest_reachable(nodes, [(position[a], position[b]) for a, b in links])
    assert found == dict(zip(nodes, least, strict=True))
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_filters_pass_the_driver_in_parts(spark, monkeypatch):
    """Before, the driver held all blocks of both filters at once, as rows and again as what it sent."""
    monkeypatch.setattr(ngram, "SENT_BYTES", 2000)
    sizes, send = [], spark.sparkContext.broadcast
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda part: sizes.append(sum(len(b) for _, _, b in part)) or send(part))
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: pytest.fail("blocks were collected"))
    rows = table(spark, near_pairs() * 2).selectExpr("doc_id", "text")
    every = ngram.repeated_filters(rows, 4, 1 << 27, 1 << 22)  # more buckets than blocks: their parts are united
    blocks = ngram.repeated_blocks(rows, 4, 1 << 27, 1 << 22)
    parts = ngram.sent_in_parts(blocks)
    assert len(parts) > 3 and max(sizes) < 2000 + (1 << 13)
    found = [x for p in parts for x in p.value]
    assert len({x[:2] for x in found}) == len(found)
    assert {(level, block): bits for level, block, bits in found} == {(level, block): bits for level, own in every.items() for block, bits in own.items()}
