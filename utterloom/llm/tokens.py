"""Token ids of whole texts, as the tokenizer file gives them, at the speed of a cache.

The byte-level pre-tokenizer always starts a new piece at a space that a non-space follows, so a text falls into chunks
that can be encoded one by one. Chunks repeat; their ids are kept as bytes and joined.
"""

from __future__ import annotations

import json
import re
from array import array

import tiktoken
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

END_OF_DOCUMENT = b"\x00\x00\x00\x00"
_AT = re.compile(r" (?=\S)")
#: Letters only, perhaps with one point behind: one or two pieces, whatever stands around.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([,.]?)")


def _merger(path: str):
    """Byte-pair merging by the tokenizer file's own ranks.

    The ids of the file must follow its merges, so that the merge that comes first is the token with the least id.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocabulary[a + b] != 256 + i for i, (a, b) in enumerate(pairs)):
        raise ValueError("the ids of the tokenizer do not follow its merges")
    shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
    byte = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary.items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("ranks", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


class _Irregular(Exception):
    """The chunk starts with white space: it can't be told from its neighbours by single spaces."""


class TokenIds:
    """Little-endian unsigned 32-bit ids of texts.

    ``limit`` bounds the chunks that are remembered (a cache, cleared when full; results don't depend on it). Strings
    of special tokens in a text get their own ids, as the tokenizer gives them: such texts it encodes whole.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if self.tokenizer.normalizer is not None or not isinstance(self.tokenizer.pre_tokenizer, ByteLevel):
            raise ValueError("chunks are encoded one by one, which only a byte-level pre-tokenizer allows")
        self.later, self.limit = _Chunks(self), limit
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = _merger(path)
        self.points = {p: self.encode(p) for p in ",."}

    def encode(self, chunk: str) -> bytes:
        """Pieces as the pre-tokenizer splits them, each merged by rank."""
        return b"".join([self.piece(chunk[a:b].encode()) for _, (a, b) in self.split(chunk)])

    def piece(self, piece: bytes) -> bytes:
        return array("I", self.merge(piece)).tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if len(self.later) > self.limit:
            self.later.clear()
        if any(t in text for t in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        head, *rest = text.split(" ")
        try:
            return self.encode(head) + b"".join(map(self.later.__getitem__, rest)) if head else self._slow(text)
        except _Irregular:
            return self._slow(text)

    def _slow(self, text: str) -> bytes:
        """As above where white space runs are longer than one space."""
        head, *rest = _AT.split(text)
        start = self.encode(head) if head else b""
        return start + b"".join([self.later[chunk] if not chunk[0].isspace() else self.encode(" " + chunk) for chunk in rest])


class _Chunks(dict):
    def __init__(self, ids: TokenIds):
        super().__init__()
        self.ids = ids

    def __missing__(self, chunk: str) -> bytes:
        if plain := _PLAIN.fullmatch(chunk):
            word, point = plain.groups()
            got = self.ids.piece(b" " + word.encode()) + (self.ids.points[point] if point else b"")
        elif not chunk or chunk[0].isspace():
            raise _Irregular
        else:
            got = self.ids.encode(" " + chunk)
        self[chunk] = got
        return got


_KEPT: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """One for each path and worker process, so that later tasks find the cache warm."""
    if path not in _KEPT:
        _KEPT[path] = TokenIds(path)
    return _KEPT[path]
