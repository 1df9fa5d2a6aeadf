import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from newsloom.llm import tokens
from newsloom.llm.tokens import SEPARATOR, Encoder

HARD = [None, "", " \t\n", "It's 'tis it'S 'S'll. don't!'t", "(a)b.c,d-e_f", "x́.y é, É! ≮ a≮b ≠", "ÀÉß.ß ÿ,",
        "İ İ. ﬁ.ﬁ Σς. ΑΣ.", "a b. c", "10,000.5a 7b", "日本語。x.日", "a" + SEPARATOR + "b.", "<|endoftext|> a.b <|ENDOFTEXT|>",
        "\x0b\x1c\x1d\x85.a", "퟿.\U0001f600.a", "word." * 3000, "z" * 20_000 + "."]


def random_texts(seed, n):
    r = random.Random(seed)
    signs = list("abcxyzABCÉéßøÿñ  \n\t'\"!#.,-_<>=()[]{}`~^@0129") + ["́", "̸", "'s", "'ll", "İ", "ς", "日", " ", "<|endoftext|>"]
    return ["".join(r.choices(signs, k=r.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_against_the_library(name):
    """Every id, also of a tokenizer that does not cut where the known kind does."""
    path = public_tokenizers.path(name)
    texts = HARD + random_texts(1, 3000)
    library = Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    coder = Encoder(path)
    assert (coder.mark is None) == (name != "word_bpe_49k.json")
    found = [ids.tolist() for ids in coder.encode(pa.array(texts, pa.string()))]
    assert [i for i, (a, b) in enumerate(zip(found, want)) if a != b] == []


def test_whole_documents_and_forgetting(monkeypatch):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column("text").combine_chunks()
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
    monkeypatch.setattr(tokens, "REMEMBERED", 500)
    monkeypatch.setattr(tokens, "SLICE", 1 << 15)
    coder = Encoder(path)
    for _ in range(2):
        assert [ids.tolist() for ids in coder.encode(texts)] == want
