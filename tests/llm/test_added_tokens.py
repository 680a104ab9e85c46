"""Packing: added tokens of the JSON file are found in texts."""

import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tapestry.llm import packing

BPE = packing.ByteBPE(packing.public_path("byte_bpe_50k.tiktoken"))
JSON = Tokenizer.from_file(packing.public_path("byte_bpe_50k.json"))  # as it is read, added tokens are matched


def ids(text):
    return JSON.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "\n"]), st.text(" \n.s0é<|>", max_size=8)), max_size=9))
def test_same_ids(parts):
    text = "".join(parts)
    assert BPE.encode(text).tolist() == ids(text)


def test_pack(spark):
    text = "hello <|endoftext|> world"
    row = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)).first()
    want = [31373, 220, 50256, 995, 1]
    assert ids(text) == want[:-1]
    assert (row.start, row.length, row.doc_tokens) == (0, 5, 5) and row.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
