"""Byte-level BPE from a public vocabulary file.

The file (base64 token and rank a line) is read where the driver runs and sent
to the executors with the function, so it need not exist there.  A worker
builds its encoder once.

Defined cases: an empty text has no ids; a text is encoded in pieces of at most
``PIECE_CHARS`` code points, cut before a blank or line end that follows a
letter or digit, where the vocabulary's own pieces end too, so the ids are those of
the whole text.  Only where ``CUT_CHARS`` code points have no such place (a run
of white space or of one word's letters) is a run itself cut; decoding gives
the same text either way, and no run is too long for the encoder.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import tiktoken

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary splits text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECE_CHARS, CUT_CHARS = 1 << 15, 1 << 12
_CUT = re.compile(r"(?<=[^\W_])[ \n]")

_BUILT: dict[int, tiktoken.Encoding] = {}


def vocabulary(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def size(data: bytes) -> int:
    """First id that the vocabulary leaves free."""
    return 1 + max(int(line.split()[1]) for line in data.splitlines() if line)


def encoder(data: bytes) -> tiktoken.Encoding:
    key = hash(data)
    if key not in _BUILT:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        _BUILT[key] = tiktoken.Encoding("bytes", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return _BUILT[key]


def pieces(text: str) -> Iterator[str]:
    """``text`` in pieces of at most ``PIECE_CHARS`` code points."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        end = at + PIECE_CHARS
        for place in _CUT.finditer(text, end - CUT_CHARS, end):
            end = place.start()
        yield text[at:end]
        at = end
    yield text[at:]


def encode(code: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return code.encode_ordinary(text)
    return [id_ for piece in pieces(text) for id_ in code.encode_ordinary(piece)]
