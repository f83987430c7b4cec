"""Fill-in-middle: frames, cuts and digests against plain string slices, restored texts, odd rows."""

from __future__ import annotations

from hashlib import sha256

import pytest
from fixtures import odd_pairs, prose, table
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldtally.llm import fim
from fieldtally.llm.frames import Codec, Stored

CODEC = Codec()


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by string slices."""
    text = text or ""
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab<PSM>é\U0001f600", max_size=60), st.integers(1, 7), st.data())
def test_frames_are_seekable(text, units, data):
    stored = Stored.of(CODEC, text, units)
    assert "".join(stored.stream()) == text and len(stored) == len(text)
    begin = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(begin, len(text)))
    assert "".join(stored.stream(begin, end)) == text[begin:end]
    for word in ("<P>", "a", "é\U0001f600"):
        assert stored.find(word, begin) == text.find(word, begin)
    copy = Stored(CODEC)
    copy.add("<M>")
    copy.add_part(stored, begin, end)
    assert "".join(copy.stream()) == "<M>" + text[begin:end] and len(copy) == 3 + end - begin


def test_whole_frames_are_moved_as_they_are():
    stored = Stored.of(CODEC, prose(1, 400), 100)
    opened = []

    class Counting(Codec):
        def unpack(self, frame):
            opened.append(frame)
            return super().unpack(frame)

    stored.codec = copy_codec = Counting()
    made = Stored(copy_codec)
    made.add_part(stored, 150, 1250)
    assert len(opened) == 2 and made.frames[1:-1] == stored.frames[2:12]


def pairs():
    texts = ["<P>", "a<S>b", "<M", "M><", "<<P", "P>x<S", "é\U0001f600" * 40, *(prose(i, 10 + i) for i in range(60))]
    return [*odd_pairs(), *((100 + i, t) for i, t in enumerate(texts))]


@pytest.mark.parametrize("units", [1, 7, fim.FRAME_UNITS])
def test_equals_slices(spark, units):
    docs = table(spark, pairs())
    out = fim.fill_in_middle(fim.store(docs, units))
    found = {"texts": fim.texts(out).collect(), "digests": fim.digests(out).collect(), "restored": fim.restore(out).collect()}
    expected = [(i, *plain(i, t)) for i, t in pairs()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, found["texts"]), key=key) == sorted(expected, key=key)
    sums = [(*r[:5], sha256(r[5].encode()).hexdigest(), sha256((t or "").encode()).hexdigest()) for r, (_, t) in zip(expected, pairs(), strict=True)]
    assert sorted(map(tuple, found["digests"]), key=key) == sorted(sums, key=key)
    assert sorted(((r.doc_id, r.text) for r in found["restored"]), key=key) == sorted(((i, t or "") for i, t in pairs()), key=key)
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}


def test_empty_table(spark, nothing):
    out = fim.fill_in_middle(fim.store(nothing))
    assert fim.digests(out).count() == 0 and fim.texts(out).count() == 0


def test_plan_has_no_shuffle(spark, odd):
    plan = fim.digests(fim.fill_in_middle(fim.store(odd)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
