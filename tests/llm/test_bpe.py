"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strataloom.llm.bpe import decode, encode, round_trip, vocabulary
from strataloom.llm.queries import QUERIES

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = [
    "", " ", "   ", "\n\n a", "\n\n\n  b  ", "x    y", "  a", "　　 z", "it's we'll I'D", "<|endoftext|> a<|endoftext|>", " <|endoftext|>x", "a" * 3000,
    " " * 500 + "x", "naïve Été ß", "日本語の文章です。 次の文", "🙂🙂 🙂", "1234 56\t78\r\n\r\n9", "\x1c \x1d a", "\x85 b", "é ​ c", "a\x0bb\x0cc", "##  --==>> __init__", " x   y",
]


def both(texts):
    ids, counts = vocabulary().encode(pa.array(texts, pa.string()))
    want = [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []
    back = vocabulary().decode(ids, counts).to_pylist()
    return got, want, back, [LIBRARY.decode(w, skip_special_tokens=False) for w in want]


def test_odd_texts():
    got, want, back, text = both([*ODD, None])
    for i, t in enumerate([*ODD, None]):
        assert got[i] == want[i], repr(t)
    assert back == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t'sStaetx1!. é"), st.characters(codec="utf-8")), max_size=40), min_size=1, max_size=5))
def test_any_text(texts):
    got, want, back, text = both(texts)
    assert got == want and back == text


def test_words_of_many_shapes():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["the", "an", "é", "ü", " ", " ", "\n", ".", ",", "'s", "12", "tion", "ß", "\t", "aaaa", "×", "<|", "A"]) for _ in range(300)) for _ in range(60)]
    got, want, back, text = both(texts)
    assert got == want and back == text


def test_frames(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "c " * 5000, "y")], "doc_id bigint, text string, n_tokens string")
    coded = encode(docs)
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    assert sorted((r.doc_id or 0, r.n_tokens) for r in coded.collect()) == [(0, 0), (1, 2), (1, 2), (2, len(LIBRARY.encode("c " * 5000).ids))]
    assert sorted(r.text for r in decode(coded).collect()) == ["", "a b", "a b", "c " * 5000]
    assert round_trip(docs.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    rows = {r.doc_id: r for r in QUERIES["op6_bpe_round_trip"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = LIBRARY.encode(d.text or "", add_special_tokens=False).ids
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
