import base64
import hashlib

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corvane.llm import byte_bpe
from corvane.llm.queries import rank_file

FILE, PATTERN = rank_file()
TEXTS = [
    None, "", "a", "Hello, world! 123 it's", "  \n\t x  ", "naïve Straße 日本語 👩‍👩‍👧 ́e", "a" * 20_000, "-" * 5_000,
    "word " * 8_000, "<|endoftext|>", "  x\u0085", "aaa aaaa aaaaa ababab",
]


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, FILE.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Codec(FILE, PATTERN)


def test_digests_match_the_other_library(documents, known):
    pairs = list(enumerate(TEXTS))
    found = {row.doc_id: row for row in byte_bpe.round_trip(documents(pairs), FILE, PATTERN).collect()}
    for doc, text in pairs:
        ids = known.encode_ordinary(text or "")
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("ab -\n'’é日", max_size=80))
def test_any_text_encodes_alike_and_comes_back(coder, known, text):
    ids = coder.encode(text)
    assert ids == known.encode_ordinary(text)
    assert coder.decode_bytes(ids).decode() == text


def test_every_character_is_cut_alike(coder, known):
    for code in [*range(0x3100), *range(0xFE00, 0xFFFF, 7), *range(0x10000, 0x20000, 97)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}1 {chr(code)}{chr(code)} b"
            assert coder.encode(text) == known.encode_ordinary(text), hex(code)


def test_offsets_and_decoding_of_split_characters(spark, documents):
    rows = byte_bpe.encode(documents([(1, "ab 日本👩"), (2, None)]), FILE, PATTERN)
    row = {each.doc_id: each for each in rows.collect()}
    text = "ab 日本👩"
    assert row[2].ids == [] and row[2].starts == []
    assert row[1].starts[0] == 0 and row[1].ends[-1] == len(text)
    for start, end, after in zip(row[1].starts, row[1].ends, [*row[1].starts[1:], len(text)], strict=True):
        assert start < end and after in (end, end - 1)
    cut = spark.createDataFrame([(1, row[1].ids[:-1]), (2, None)], "doc_id bigint, ids array<int>")
    back = {each.doc_id: each for each in byte_bpe.decode(cut, FILE, PATTERN).collect()}
    assert back[2].text == "" and text.encode().startswith(bytes(back[1].data))
    assert back[1].text == bytes(back[1].data).decode("utf-8", "replace")
    whole = byte_bpe.decode(rows, FILE, PATTERN)
    assert {each.doc_id: each.text for each in whole.collect()} == {1: text, 2: ""}


def test_empty_table_null_ids_and_repeats(documents):
    assert byte_bpe.round_trip(documents([]), FILE, PATTERN).count() == 0
    rows = byte_bpe.tokenised(documents([(None, "x y"), (None, "x y"), (1, "")]), FILE, PATTERN).collect()
    assert sorted((row.n_tokens, row.exact) for row in rows) == [(0, True), (2, True), (2, True)]
