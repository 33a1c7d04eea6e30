"""Byte-level BPE on executors, shared by the token operators.

The vocabulary file is a path on the driver; its bytes (under 1 MB) are broadcast.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator

import regex
import tiktoken
from pyspark.sql import SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that goes with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_OF_DOCUMENT = 50256  # free in the vocabulary: no text yields it
REMEMBERED = 50_000  # pieces of texts that are cut here
WHOLE = 1 << 22  # characters given to the encoder at once
LONG_SPACE = 4096
DTYPE = "<u2"
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_SPACE)


class _Pieces(dict):
    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        out = self[piece] = self.encoding._encode_single_piece(piece)  # the pattern has cut already
        return out


class Ranks:
    """Byte-level merges by rank: the token numbers of a text.

    The encoder's own pattern search runs out of stack on very long white space, so such texts, and texts too long for one list,
    are cut by the same pattern here.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces, self.pattern = _Pieces(self.encoding), regex.compile(pattern)

    def blocks(self, text: str) -> Iterator[list[int]]:
        if len(text) <= WHOLE and not (len(text) >= LONG_SPACE and _LONG_SPACE.search(text)):
            yield self.encoding.encode_ordinary(text)
            return
        out: list[int] = []
        for m in self.pattern.finditer(text):
            out += self.pieces[m.group()]
            if len(out) > WHOLE:
                yield out
                out = []
        yield out

    def encode(self, text: str) -> list[int]:
        return [i for block in self.blocks(text) for i in block]


class Coder:
    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        self.ranks = Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}, pattern)

    def encode(self, text: str | None) -> bytes:
        """Token numbers as two bytes each."""
        return b"".join(array("H", block).tobytes() for block in self.ranks.blocks(text or ""))


_CODERS: dict[int, Coder] = {}


def coder(spark: SparkSession, path: str = VOCABULARY) -> Callable[[], Coder]:
    """A function for tasks that gives the worker's coder, built once in each worker process."""
    with open(path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())

    def get() -> Coder:
        key = hash(sent.value)
        if key not in _CODERS:
            _CODERS[key] = Coder(sent.value)
        return _CODERS[key]

    return get
