"""Encoding with a file of the tokenizers library inside tasks."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from sequora.llm.chunks import ChunkIds
from sequora.llm.common import limit_threads


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    limit_threads()
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    return _tokenizer(path).get_vocab_size(with_added_tokens=True)


def _cuts_at_spaces(path: str) -> bool:
    """Whether the file splits text as sequora.llm.chunks takes for granted."""
    with open(path, encoding="utf8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    return plain and not any(spec.get(k) for k in ("normalizer", "post_processor", "truncation", "padding"))


@lru_cache(maxsize=8)
def encoder(path: str, dtype: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to the bytes of their ids, kept as long as the Python worker lives."""
    t = _tokenizer(path)
    width = np.dtype(dtype).itemsize

    def each(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=dtype).tobytes() for at in range(0, len(texts), 256) for e in t.encode_batch_fast(texts[at : at + 256], add_special_tokens=False)]

    if not _cuts_at_spaces(path):
        return each
    line_feed = t.encode("\n", add_special_tokens=False).ids

    def many(chunks: list[str]) -> list[bytes]:
        """Chunks without white space at the end or a line feed are encoded as lines of one text: a line feed between them is a match of its own."""
        out: list[bytes] = [b""] * len(chunks)
        lines = [k for k, c in enumerate(chunks) if c and not c[-1].isspace() and "\n" not in c]
        alone = set(range(len(chunks))).difference(lines)
        for at in range(0, len(lines), 512):
            block = lines[at : at + 512]
            ids = np.array(t.encode_batch_fast(["\n".join([chunks[k] for k in block])], add_special_tokens=False)[0].ids, dtype)
            stop = np.flatnonzero(ids == line_feed[0])
            if len(line_feed) != 1 or len(stop) != len(block) - 1:
                alone.update(block)
                continue
            flat, begin = ids.tobytes(), 0
            for k, end in zip(block, (np.r_[stop, len(ids)] * width).tolist(), strict=True):
                out[k] = flat[begin:end]
                begin = end + width
        rest = [k for k in sorted(alone) if chunks[k]]
        for k, b in zip(rest, each([chunks[k] for k in rest]), strict=True):
            out[k] = b
        return out

    added, plain = [x.content for x in t.get_added_tokens_decoder().values()], ChunkIds(many)

    def some(texts: list[str]) -> list[bytes]:
        """Texts that hold an added token are encoded as they stand, as it may lie across chunks."""
        odd = {k for k, x in enumerate(texts) if any(a in x for a in added)}
        if not odd:
            return plain(texts)
        out = iter(plain([x for k, x in enumerate(texts) if k not in odd]))
        return [each([x])[0] if k in odd else next(out) for k, x in enumerate(texts)]

    return some
