import numpy as np
import public_tokenizers
import pytest
from fixtures import odd_pairs
from tokenizers import Tokenizer

from fieldtally.llm.bpe import codec
from fieldtally.llm.token_counts import RULES, attribute, sections, token_counts, token_report, token_spans

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_spans_are_those_of_the_library():
    library = Tokenizer.from_file(PATH)
    for _, text in odd_pairs():
        text = (text or "")[:5000]
        made = library.encode(text, add_special_tokens=False)
        starts, ends = token_spans(made.ids, text, codec(PATH, 8192))
        # the library leaves leading spaces out of a span; the ends are the same
        assert ends.tolist() == [e for _, e in made.offsets] or not text.strip()
        assert all(a <= b for a, (b, _) in zip(starts, made.offsets, strict=True))


@pytest.mark.parametrize("rule", RULES)
def test_attribution_equals_brute_force(rule):
    rng = np.random.default_rng(5)
    for _ in range(300):
        cuts = np.sort(rng.integers(0, 40, 8))
        first, stop = cuts[::2], cuts[1::2]
        ends = np.unique(rng.integers(1, 41, 15))
        starts = np.concatenate(([0], ends[:-1]))
        counts, crossing, outside = attribute(starts, ends, first, stop, rule)
        expected, crosses = np.zeros(len(first)), 0
        for s, e in zip(starts, ends, strict=True):
            over = np.maximum(0, np.minimum(stop, e) - np.maximum(first, s))
            held = np.flatnonzero(over)
            if not len(held):
                continue
            crosses += over.max() < e - s
            if rule == "start":
                expected[held[0]] += s >= first[held[0]]
            elif rule == "end":
                expected[held[-1]] += e <= stop[held[-1]]
            elif rule == "most":
                expected[int(np.argmax(over))] += 1
            else:
                expected += over / (e - s)
        assert np.allclose(counts, expected) and crossing == crosses and np.isclose(outside, len(starts) - expected.sum())


def test_sections_cover_the_document():
    text, found = sections(["en", "", "a\n\nb"], ["lang", "source", "text"], "text")
    assert text == "en\n\na\n\nb"
    assert found == [("lang", 0, 0, 3), ("source", 0, 3, 4), ("text", 0, 4, 6), ("text", 1, 6, 7), ("text", 2, 7, 8)]


def test_odd_rows(odd, nothing):
    library = Tokenizer.from_file(PATH)
    found = sorted(token_report(token_counts(odd, PATH)).collect(), key=repr)
    expected = sorted(len(library.encode("\n\n" + (t or ""), add_special_tokens=False).ids) for _, t in odd_pairs())
    assert sorted(r.n_tokens for r in found) == expected
    assert all(sum(r.section_tokens) == r.n_tokens == r.lang_tokens + r.source_tokens + r.text_tokens for r in found)
    assert token_report(token_counts(nothing, PATH)).collect() == []
    with pytest.raises(ValueError):
        token_counts(odd, PATH, rule="first")
