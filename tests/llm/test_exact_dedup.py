from collections import defaultdict
from hashlib import sha256

import pytest
from fixtures import odd_pairs, table

from fieldtally.llm.exact_dedup import exact_dedup, keep_one


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("fan_in", [2, 8])
def test_equals_brute_force(spark, largest, fan_in):
    pairs = odd_pairs() + [(100 + i, "same") for i in range(40)]
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    found = exact_dedup(table(spark, pairs).repartition(7), fan_in=fan_in, largest=largest).collect()
    assert len(found) == len(pairs)
    by_sha = {sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for sha, ids in by_sha.items():
        mine = [r for r in found if r.text_sha256 == sha]
        order = sorted(ids, key=lambda i: (i is not None, i or 0))
        keep = order[-1] if largest else order[0]
        assert {r.keep_id for r in mine} == {keep} and {r.group_size for r in mine} == {len(ids)}
        assert [r.doc_id for r in mine if r.kept] == [keep]


def test_kept_rows_have_all_columns(spark, odd):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    left = kept.collect()
    assert len(left) == len({t or "" for _, t in odd_pairs()}) == len({r.text or "" for r in left})
    assert sorted(r.doc_id for r in left if r.text and r.text.startswith(odd_pairs()[0][1])) == [1]


def test_empty_table(nothing):
    assert exact_dedup(nothing).collect() == [] and keep_one(nothing).collect() == []


def test_no_python_in_the_plan(odd):
    plan = exact_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
