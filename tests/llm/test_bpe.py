import random
from hashlib import sha256

import public_tokenizers
import pytest
from fixtures import odd_pairs, table
from tokenizers import Tokenizer

from fieldtally.llm.bpe import Codec, bpe_decode, bpe_encode, token_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABETS = [
    ["a", "b", "the", " ", "  ", "\n", "'s", "'", "re", "1", "23", "!!", "é", "ß", "中", "\U0001f600", " ", "Th", "\t", " word", "<|endoftext|>"],
    ["a", "b", "c", "th", "e"],
    ["!", ".", "-", "'"],
    [" ", "\n", "a", " "],
    ["1", "2", "3", " 1"],
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("leaf", [3, 16, 100])
@pytest.mark.parametrize("alphabet", range(len(ALPHABETS)))
def test_tree_concatenation_is_exact(library, leaf, alphabet):
    made, chance = Codec(PATH, leaf), random.Random(leaf)
    for _ in range(60):
        text = "".join(chance.choices(ALPHABETS[alphabet], k=chance.randint(1, 500)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert made.encode(text) == ids
        assert made.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bytes_that_are_no_text(library):
    made, chance = Codec(PATH), random.Random(3)
    for _ in range(200):
        ids = chance.choices(range(50257), k=20)
        assert made.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_odd_rows(spark, odd, library):
    found = token_digests(bpe_decode(bpe_encode(odd, PATH, leaf_chars=500), PATH)).collect()
    expected = []
    for i, text in odd_pairs():
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_null_tokens_and_empty_table(spark, nothing):
    encoded = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [r.text for r in bpe_decode(encoded, PATH).collect()] == ["", ""]
    assert token_digests(bpe_decode(bpe_encode(nothing, PATH), PATH)).collect() == []


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        Codec(public_tokenizers.path("word_bpe_49k.json"))
