"""Byte-level BPE ids of whole texts inside a task."""

from __future__ import annotations

import re
import sys

import numpy as np

# Texts of these characters mean the same to every version of the pre-tokeniser.
_COMMON = re.compile(r"[\t\n\r -~¡-ɏ]*")


def kept_in_process(key: str, build):
    """``build()`` once for the life of a Python worker, which serves many tasks."""
    store = sys.__dict__.setdefault("_tallymill_kept", {})
    if key not in store:
        store[key] = build()
    return store[key]


class Encoder:
    """Token ids of texts as the ``tokenizers`` library gives them.

    ``vocabulary`` is its file and ``ranks`` the same vocabulary for ``tiktoken``, which
    finds the same ids several times faster. Texts that hold a special token or an
    uncommon character, where the two libraries could differ, go to ``tokenizers``.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_file(vocabulary)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._fast = tiktoken.Encoding(
            "shared", pat_str=pattern, mergeable_ranks=table, special_tokens={}
        ).encode_ordinary
        special = self._exact.get_added_tokens_decoder()
        self._specials = [t.content for t in special.values()]
        self.sizes = np.zeros(max([*table.values(), *special]) + 1, np.int64)
        for word, rank in table.items():
            self.sizes[rank] = len(word)
        for rank, token in special.items():
            self.sizes[rank] = len(token.content.encode())

    def exact(self, text: str) -> list[int]:
        return self._exact.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        """The ids of ``text``; ``sizes[ids]`` are the bytes that each stands for."""
        usual = _COMMON.fullmatch(text) and not any(s in text for s in self._specials)
        return np.asarray(self._fast(text) if usual else self.exact(text), "<u4")


def encoder(vocabulary: str, ranks: str, pattern: str) -> Encoder:
    """The worker's encoder for these files."""
    return kept_in_process(f"encoder {vocabulary} {ranks}", lambda: Encoder(vocabulary, ranks, pattern))
