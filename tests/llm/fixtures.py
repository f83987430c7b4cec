"""Small tables with everything odd in them, and plain versions of the common definitions."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, run int, sha string, label int, n int, node string, "
    "lost array<string>, keep string, digest binary, component string, hits int, terms string, ids string, parts string, f int"
)
EXTRA = 15
WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = ["".join(random.Random(i).choices("abcdefghiklmnoprstuwzéß", k=3 + i % 7)) for i in range(900)]


def prose(seed: int, words: int = 120) -> str:
    chance = random.Random(seed)
    out = [chance.choice(VOCABULARY) for _ in range(words)]
    return " ".join(w.capitalize() if i % 9 == 0 else w + ("." if i % 9 == 8 else "") for i, w in enumerate(out))


def rows(pairs):
    return [(i, t, None, None, None, *[None] * EXTRA) for i, t in pairs]


def table(spark, pairs):
    return spark.createDataFrame(rows(pairs), SCHEMA)


def odd_pairs():
    """Null ids and texts, blank and one-word texts, repeated rows, one id with two texts, a long text, edge white space."""
    long = "\n".join(prose(900 + i, 40) for i in range(120))
    return [
        (1, prose(1)),
        (1, prose(1)),
        (2, None),
        (3, ""),
        (None, prose(2)),
        (None, None),
        (4, "word"),
        (5, " \n\t\x0b\x0c\r "),
        (6, prose(3)),
        (6, prose(4)),
        (7, long),
        (8, long),
        (9, "é" * 3000),
        (10, "  a\u0085b \U0001f600\n\n\nx"),
        (-5, prose(1)),
    ]


def words_of(text):
    return [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(text or "")]


def shingle_set(text, size):
    words = words_of(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def smallest_reachable(ids, links):
    """Smallest id that links reach, for each position of ``ids``."""
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    groups = {}
    for i, value in enumerate(ids):
        groups.setdefault(root(i), []).append(value)
    least = {r: min((v for v in g if v is not None), default=None) for r, g in groups.items()}
    return [least[root(i)] for i in range(len(ids))]
