import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cinerank.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = list("abqzxjkvQZ '\"$%|.,;:-_<>=/\\~^`+*&#@!?()[]{}0123456789\t\n\r\x0b\x0c\x1c\x1d\x1f\x00\x7f") + [
    "'s", "'re", "''s", "'LL", "́", "̌", "̸", "é", "É", "İ", "ß", "Σ", " ", " ", "　", "\u0085", "中", "ก", "🙂",
    "<|endoftext|>", "<|startoftext|>", "<|endof", "the ", "qz", "ſ", "K", "Å", "‍", "﻿", "ﬁ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, text):
    e = library.encode(text, add_special_tokens=False)
    return np.array(e.ids, "<u4").tobytes(), library.decode(e.ids, skip_special_tokens=False)


def test_equals_the_library(library, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ["", " \n", "word " * 30_000]
    assert list(bpe.Encoder(PATH).encode(texts)) == [want(library, t) for t in texts]
    monkeypatch.setattr(bpe, "TABLE_SIZE", 50)
    small = bpe.Encoder(PATH)
    assert [r for i in range(0, 400, 7) for r in small.encode(texts[i:i + 7])] == [want(library, t) for t in texts[:len(range(0, 400, 7)) * 7]]


def test_cut_pairs_occur_in_no_token(library):
    cuts = bpe.Encoder(PATH).cuts
    for token in list(library.get_vocab())[::7]:
        raw = token.removesuffix("</w>")
        if raw.isascii() and not token.startswith("<|"):
            assert not any(cuts[ord(a), ord(b)] for a, b in zip(raw, raw[1:]))


def test_query_rows(spark, docs_of, library):
    rows = [(1, None), (2, ""), (3, "Hello <|endoftext|> World's"), (3, "Hello <|endoftext|> World's"), (None, "x"), (4, "\t \n")]
    got = bpe.encode_documents(docs_of(rows), PATH).collect()
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids_le), r.decoded) for r in got), key=str) == sorted(
        ((i, len(want(library, t or "")[0]) // 4, *want(library, t or "")) for i, t in rows), key=str)
    assert bpe.encode_documents(docs_of([]), PATH).count() == 0
