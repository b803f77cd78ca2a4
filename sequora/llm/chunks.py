"""Cutting text where byte-level BPE cuts it anyway, so that repeated pieces are encoded once.

Byte-level BPE first splits a text by a pattern (public_tokenizers.PATTERN). A space always
starts a new match if what stands before it is no white space, or what follows it is none. Where
a text has no space that breaks this rule, cutting before each space keeps every match whole, and
the ids of the text are those of its chunks in order. Python's white space holds all of
Unicode's, so the test errs only towards longer chunks.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

_INSIDE_RUN = re.compile(r"\s \s|\s \Z")
_SAFE_CUT = re.compile(r"(?<=\S)(?= )|(?<=.)(?= \S)", re.DOTALL)
_FIRST = "﷐"  # marks a chunk that begins a text; a code point that is no character


def pieces(text: str) -> list[str]:
    """The chunks of a text, each without its leading space, and those without one marked."""
    if _FIRST in text:
        return [_FIRST + text]
    if _INSIDE_RUN.search(text):
        return [x[1:] if x[:1] == " " else _FIRST + x for x in _SAFE_CUT.split(text)]
    found = text.split(" ")
    found[0] = _FIRST + found[0]
    return found


def chunk(piece: str) -> str:
    return piece[1:] if piece[:1] == _FIRST else " " + piece


_SIGNS = ".,;:!?#$%&*()|\"-_/+=<>[]{}"


def core(piece: str) -> str:
    """The piece without signs at its end, if a Latin letter stands before them: there a match ends in any case."""
    rest = piece.rstrip(_SIGNS)
    return rest if rest and rest[-1] < "\u0250" and rest[-1].isalpha() else piece


class ChunkIds:
    """Ids of texts as little-endian bytes; each distinct chunk is encoded once as long as it is kept.

    encode_many gets a list of distinct chunks and returns the bytes of each. The first `keep`
    chunks that come stay known; further ones are forgotten after each call.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], keep: int = 800_000):
        self.encode_many, self.keep, self.known, self.signs = encode_many, keep, {}, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        split, known = [pieces(x) for x in texts], self.known
        new = list(set(chain.from_iterable(split)).difference(known))
        cores = [core(p) for p in new]
        fresh = list(set(cores).difference(known))
        tails = list({p[len(c) :] for p, c in zip(new, cores, strict=True)}.difference(self.signs))
        known.update(zip(fresh, self.encode_many([chunk(p) for p in fresh]), strict=True))
        if len(self.signs) + len(tails) > self.keep // 8:
            self.signs, tails = {}, list({p[len(c) :] for p, c in zip(new, cores, strict=True)})
        self.signs.update(zip(tails, self.encode_many(tails), strict=True))
        signs = self.signs
        known.update([(p, known[c] + signs[p[len(c) :]]) for p, c in zip(new, cores, strict=True) if p is not c])
        find = known.__getitem__
        out = [b"".join(map(find, x)) for x in split]
        surplus = len(known) - self.keep
        if surplus > 0:
            added = dict.fromkeys(fresh) | dict.fromkeys(new)
            for p in list(added)[-surplus:]:
                del known[p]
        return out
