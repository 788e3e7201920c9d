"""Token ids of a public byte-level BPE vocabulary, for whole texts."""

from __future__ import annotations

import re
from collections.abc import Callable

#: Chunks of text that one worker remembers; about 150 bytes each.
MEMORY = 200_000

_SPACE = re.compile(r" (?=\S)")
_WIDE = re.compile(r" \s|\s $")
_encoders: dict[str, Callable[[str], bytes]] = {}


class _Memo(dict):
    """Ids of a chunk and the space before it, as little-endian 32-bit numbers."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        ids = self.encode(" " + chunk)
        if len(chunk) < 64:
            self[chunk] = ids
        return ids


def load_encoder(path: str) -> Callable[[str], bytes]:
    """Function from text to ids, equal to those of the ``tokenizers`` library.

    The pattern of this vocabulary never lets a token reach across a space that a
    visible character follows, so a text is cut there and chunks that were seen
    before are looked up.  Their merges run in ``tiktoken`` over the vocabulary that
    the ``tokenizers`` file holds, which gives the same ids faster.  A text that
    contains a special token goes to ``tokenizers`` as it is.
    """
    if path not in _encoders:
        _encoders[path] = _load(path)
    return _encoders[path]


def _load(path: str) -> Callable[[str], bytes]:
    import numpy as np
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    special = [token.content for token in whole.get_added_tokens_decoder().values()]
    letters = _byte_letters()
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in whole.get_vocab(with_added_tokens=False).items()
        if token not in special
    }
    core = tiktoken.Encoding(
        "core", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def by_chunk(chunk: str) -> bytes:
        return np.array(core.encode_ordinary(chunk), dtype="<u4").tobytes()

    memo = _Memo(by_chunk)

    def encode(text: str) -> bytes:
        if any(token in text for token in special):
            ids = whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        first, *rest = _SPACE.split(text) if _WIDE.search(text) else text.split(" ")
        return by_chunk(first) + b"".join(map(memo.__getitem__, rest))

    return encode


def _byte_letters() -> dict[str, int]:
    """Byte of each letter that byte-level vocabulary files write for it.

    Printable Latin-1 characters stand for themselves; the other bytes, in order,
    are written as the letters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
