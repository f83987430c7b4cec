import numpy as np
import pyarrow as pa
from fixtures import odd_pairs, words_of

from fieldtally.llm.words import prefixes, runs, slices, words


def test_words_are_those_of_the_pattern():
    texts = [t for _, t in odd_pairs()]
    found = words(pa.array(texts, type=pa.string()))
    data = "".join(t or "" for t in texts).encode()
    for i, text in enumerate(texts):
        a, b = found.bounds[i : i + 2]
        got = [data[s:e].decode() for s, e in zip(found.starts[a:b], found.ends[a:b], strict=True)]
        assert [words_of(w)[0] for w in got] == words_of(text)


def test_hashes_depend_on_the_word_alone():
    found = words(pa.array(["Abc abc", "x abc", None, "abd ABC"]))
    h = found.hashes
    assert h[0] == h[1] == h[3] == h[5] and len({*h.tolist()}) == 3


def test_runs_and_short_texts():
    found = words(pa.array(["a b c d", "a b c", "a b", "", None, "b a", "a  B\tc\nd"]))
    hashes, bounds = runs(found, 3)
    assert np.diff(bounds).tolist() == [2, 1, 1, 0, 0, 1, 2]
    assert hashes[0] == hashes[2] and hashes[3] != hashes[4] and hashes[5:].tolist() == hashes[:2].tolist()


def test_prefixes():
    found = words(pa.array(["idiotic idiots idiot idio"]))
    hashes, which = prefixes(found, 5)
    assert which.tolist() == [0, 1] and hashes[0] == hashes[1]


def test_slices_hold_every_row_of_sliced_batches():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 50, "", "c"])], names=["text"]).slice(1)
    parts = list(slices(batch, "text", 20))
    assert [v for p in parts for v in p.column("text").to_pylist()] == [None, "b" * 50, "", "c"]
    assert words(batch.column("text")).bounds.tolist() == [0, 0, 1, 1, 2]
