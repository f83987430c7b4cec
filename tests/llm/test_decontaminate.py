import random
from itertools import combinations

import numpy as np
import pytest
from fixtures import EXTRA, odd_pairs, prose, table, words_of

from fieldtally.llm.decontaminate import MASKS, SHORT_MASKS, drop_contaminated, overlaps, stretch, trimmed


def longest(equal, identity):
    best = (0, 0)
    for i in range(len(equal)):
        for j in range(i + 1, len(equal) + 1):
            if round(equal[i:j].sum() * 1000) >= round(identity * 1000) * (j - i) and j - i > best[1] - best[0]:
                best = (i, j)
    return best


def without_unequal_ends(equal, i, j):
    at = [k for k in range(i, j) if equal[k]]
    return (at[0], at[-1] + 1) if at else (j, j)


def test_stretch_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(1500):
        equal = rng.random(rng.integers(0, 24)) < rng.choice([0.5, 0.8, 0.95])
        found = stretch(equal, 0.8)
        assert found == longest(equal, 0.8)
        assert trimmed(equal, *found) == without_unequal_ends(equal, *found)


def test_masks_hit_every_stretch():
    """The fewest unequal words, between equal ends, that hide a stretch from all masks: always more than a fifth of its length.

    By a walk over all states of the last words, so for every placement at once.
    """
    looked_at = [sum(1 << (len(m) - 1 - p) for p, c in enumerate(m) if c == "1") for m in MASKS]
    longest_mask = max(map(len, MASKS))
    keep = (1 << longest_mask) - 1
    costs = {1: 0}  # bits of the last words, 1 for equal: fewest unequal words so far
    for length in range(2, 300):
        following = {}
        for bits, cost in costs.items():
            for equal in (0, 1):
                new = (bits << 1 | equal) & keep
                if any(length >= len(m) and new & w == w for m, w in zip(MASKS, looked_at, strict=True)):
                    continue
                following[new] = min(following.get(new, 1 << 30), cost + 1 - equal)
        costs = following
        hidden = min((cost for bits, cost in costs.items() if bits & 1), default=1 << 30)
        if length >= 13:
            assert hidden > length - -(-4 * length // 5), length


def test_short_masks_hit_every_item():
    for length in (10, 11, 12):
        for unequal in combinations(range(length), length - -(-4 * length // 5)):
            hits = [s for m in SHORT_MASKS for s in range(length - len(m) + 1) if not any(m[p] == "1" and s + p in unequal for p in range(len(m)))]
            assert hits, unequal


def brute(pairs, items):
    """By document and item: the longest overlap on any diagonal. Knows no masks."""
    out = set()
    for i, t in pairs:
        text = words_of(t)
        for k, item in items:
            own, best = words_of(item), None
            if not own:
                continue
            for shift in range(-len(own) + 1, len(text)):
                lo, hi = max(0, -shift), min(len(own), len(text) - shift)
                equal = np.array([own[p] == text[p + shift] for p in range(lo, hi)], dtype=bool)
                if equal.sum() < min(8, len(own)):
                    continue
                long = longest(equal, 0.8)
                begin, end = without_unequal_ends(equal, *long)
                short = len(own) <= 13 and long[1] - long[0] == len(own) and (len(own) >= 10 or equal.all())
                if end - begin >= 13 or short:
                    row = (end - begin, -(lo + begin + shift), -(lo + begin), int(equal[begin:end].sum()))
                    best = max(row, best or row)
            if best:
                out.add((i, k, -best[1], -best[2], best[0], best[3]))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    chance = random.Random(8)
    items = [(k, prose(7000 + k, n)) for k, n in enumerate([30, 15, 11, 6, 1, 40])] + [(6, None), (7, ""), (None, prose(7100, 20)), (0, prose(7000, 30))]
    pairs = odd_pairs()
    for i in range(40):
        own, item = prose(8000 + i, 30).split(), words_of(items[i % 6][1])
        for p in range(len(item)):
            if chance.random() < 0.08:
                item[p] = "other"
        at = chance.randrange(len(own))
        pairs.append((200 + i, " ".join(own[:at] + item[: chance.choice([5, 14, 99])] + own[at:])))
    for i, k in enumerate((1, 2, 2, 2, 3)):  # unequal words at the ends and inside
        item = words_of(items[k][1])
        for p in ((0, 7), (0, 10), (0, 1), (4, 5), (0,))[i]:
            item[p] = "other"
        pairs.append((300 + i, f"{prose(8100 + i, 9)} {' '.join(item)} {prose(8200 + i, 9)}"))
    docs = table(spark, pairs)
    tests = spark.createDataFrame([(k, t, *[None] * EXTRA) for k, t in items], "item_id bigint, text string" + "".join(f", x{i} int" for i in range(EXTRA)))
    expected = brute(pairs, items)
    for block in (10_000, 300):
        found = sorted(map(tuple, overlaps(docs, tests, block_chars=block).collect()), key=repr)
        assert sorted(set(found) - set(expected), key=repr) == sorted(set(expected) - set(found), key=repr) == []
    assert len(expected) > 20 and {301, 302, 303} <= {r[0] for r in expected} and 304 not in {r[0] for r in expected}
    left = drop_contaminated(docs, tests)
    assert left.columns == docs.columns
    bad = {i for i, *_ in expected}
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((i for i, _ in pairs if i not in bad), key=repr)


@pytest.mark.parametrize("items", [[], [(1, "")], [(1, None)]])
def test_empty_sides(spark, odd, nothing, items):
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    assert overlaps(odd, tests).collect() == [] and overlaps(nothing, tests).collect() == []
    assert drop_contaminated(odd, tests).count() == len(odd_pairs())
    assert drop_contaminated(nothing, spark.createDataFrame([(1, prose(1))], "item_id bigint, text string")).collect() == []
