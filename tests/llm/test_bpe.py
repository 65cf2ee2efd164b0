from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import clashing, documents, empty, rows
from weftline.llm import bpe

RAW = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
CODEC = bpe.Codec(bpe.parse_ranks(RAW), public_tokenizers.PATTERN)
KNOWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.bpe.ranks, special_tokens={})
TEXTS = st.text(st.one_of(st.sampled_from(" \n\t'sretvmld.!19ab"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_same_ids_as_the_public_library(text):
    assert CODEC.encode(text) == KNOWN.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["\x1c a\x1d", "a  b", "  \n\n  x", "don't we'LL I've", "a" * 500, " " * 300 + "x", "<|endoftext|>"])
def test_corner_texts(text):
    assert CODEC.encode(text) == KNOWN.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_growing_text(parts):
    grown = bpe.EncodedText(CODEC)
    for part in parts:
        grown.append(part)
    assert grown.ids() == CODEC.encode("".join(parts))


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=8), st.data())
def test_appends_and_edits_of_a_table(data, new, draw):
    table = bpe.PrefixTable(CODEC.bpe, data)
    table.append(new)
    assert table.last == CODEC.bpe.table(data + new)
    stop = draw.draw(st.integers(0, len(data)))
    start = draw.draw(st.integers(0, stop))
    table = bpe.PrefixTable(CODEC.bpe, data)
    table.replace(start, stop, new)
    assert table.last == CODEC.bpe.table(data[:start] + new + data[stop:])


def test_an_edit_recomputes_only_what_is_near():
    data = b"the quick brown fox jumps over the lazy dog " * 60
    table = bpe.PrefixTable(CODEC.bpe, data)
    assert table.replace(100, 105, b"XY") < 400
    assert table.last == CODEC.bpe.table(data[:100] + b"XY" + data[105:])


def test_documents(spark):
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.digests(clashing(documents(spark)), RAW, public_tokenizers.PATTERN).collect()}
    want = set()
    for doc_id, text, *_ in rows():
        ids = KNOWN.encode_ordinary(text or "")
        want.add((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == want
    assert bpe.digests(empty(spark), RAW, public_tokenizers.PATTERN).count() == 0
    kept = bpe.encode(clashing(documents(spark)), RAW, public_tokenizers.PATTERN, out="ids")
    assert kept.count() == len(rows()) and kept.columns.count("ids") == 1
