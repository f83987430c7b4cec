from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from fixtures import odd_pairs, prose, table

from pyspark.sql import functions as F

from fieldtally.llm import line_dedup as line_dedup_module
from fieldtally.llm.line_dedup import STRIP, Filters, ascii_lower, line_dedup, line_report, losses, packed, unpacked


def brute(pairs, min_chars, min_docs):
    """By row: the kept text. A null id counts as smaller than any other."""
    keys = [[ascii_lower(x).strip(STRIP) for x in (t or "").split("\n")] for _, t in pairs]
    held = defaultdict(set)
    for (i, _), own in zip(pairs, keys, strict=True):
        for k in own:
            if len(k) >= min_chars:
                held[k].add((i is not None, i or 0))
    keep = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for (i, t), own in zip(pairs, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, own, strict=True) if keep.get(k, (i is not None, i or 0)) == (i is not None, i or 0)]
        out.append((i, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def pairs_with_repeats():
    line, other = prose(50, 12), prose(51, 12)
    pairs = odd_pairs()
    for k in range(20, 32):
        pairs.append((k, "\n".join([prose(k, 12), "  " + line.upper() if k % 2 else line + "\r", line, "short", other if k % 3 else prose(99 + k, 12)])))
    return [*pairs, (None, line), (33, other)]


def check(spark, pairs, **how):
    found = line_report(line_dedup(table(spark, pairs), min_chars=40, min_docs=5, **how)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(pairs, 40, 5)


def test_equals_brute_force(spark):
    check(spark, pairs_with_repeats(), filter_bits=1 << 20)


def test_a_full_filter_gives_the_same(spark):
    check(spark, pairs_with_repeats(), filter_bits=1 << 16)


@pytest.mark.parametrize("hot", [1, 5, 10**9])
def test_frequent_lines_by_broadcast(spark, monkeypatch, hot):
    """None of the lines, some of them, and all by the broadcast give the same."""
    monkeypatch.setattr(line_dedup_module, "HOT", hot)
    check(spark, pairs_with_repeats(), filter_bits=1 << 20)


def test_a_line_of_most_documents_is_dealt_by_document(spark):
    """In the join that is dealt by digest, a line of 3,000 documents has many keys; lines of five documents have one each."""
    held = spark.range(3000).selectExpr("id AS doc_id", "unhex(md5('hot')) AS digest").unionByName(
        spark.range(6000).selectExpr("id AS doc_id", "unhex(md5(cast(id div 5 as string))) AS digest")
    )
    repeated = held.groupBy("digest").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep"))
    found = losses(held, repeated)
    assert found.count() == 9000 and found.filter("keep < doc_id OR keep IS NULL").count() == 0
    assert found.filter("digest = unhex(md5('hot')) AND keep = 2999").count() == 3000
    assert "BroadcastExchange" in found._jdf.queryExecution().executedPlan().toString()


def test_empty_table(nothing):
    assert line_dedup(nothing, filter_bits=1 << 16).collect() == []


def test_blocks_and_merging():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.001, 0.4, 1.0):
        bits = np.packbits(rng.random(1 << 16) < share, bitorder="little")
        assert (unpacked(packed(bits)) == bits).all()
    one, two = Filters(), np.zeros(1 << 13, dtype=np.uint8)
    a, b = two.copy(), two.copy()
    a[0], b[0] = 3, 6
    one.merge(4, a, two)
    one.merge(4, b, two)
    assert one.blocks[4][0][0] == 7 and one.blocks[4][1][0] == 2
