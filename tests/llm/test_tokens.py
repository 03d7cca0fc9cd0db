import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from utterloom.llm.tokens import TokenIds

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(ids, text):
    return ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_those_of_the_whole_text():
    ids = TokenIds(PATH, limit=50)
    rng = random.Random(1)
    pool = list("ab1' \n\t.,!é  ​日’#\x1c\x85\xa0s\r_") + ["  ", "<|endoftext|>", "don't", "the", " x"]
    for _ in range(6000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(ids(text), "<u4").tolist() == plain(ids, text), repr(text)


def test_long_text_and_empty():
    ids = TokenIds(PATH)
    text = "Ordinary words, again and again.\n\n" * 3000
    assert np.frombuffer(ids(text), "<u4").tolist() == plain(ids, text)
    assert ids("") == b""


def test_special_tokens_get_their_own_ids():
    ids = TokenIds(PATH)
    got = np.frombuffer(ids("a <|endoftext|> b"), "<u4").tolist()
    assert 50256 in got and got == Tokenizer.from_file(PATH).encode("a <|endoftext|> b", add_special_tokens=False).ids
