"""Ids of the word-end BPE vocabulary, as the tokenizers library gives them, at corpus speed.

That vocabulary's pattern never joins characters across white space, so the ids of a text
are those of its white-space chunks in turn. Chunks repeat: each worker keeps the ids of
those it has met (a bounded table) and sends only new ones to the library. A text with a
character outside the plain range below goes to the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa

from quern.llm.common import text_slices
from quern.llm.words import SpanTable, hashed_words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Below this code point normal form C changes nothing.
_PLAIN = 0x250


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(_PLAIN) if unicodedata.category(chr(c))[0] == kind)


_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^\\s{_class('L')}{_class('N')}]+"
)
# Bytes that may begin something outside the plain range: controls, C1 controls and the hard
# space (C2), dotted I (C4), code points from 0x250 on, a special token's opening.
_LOOK = np.zeros(256, bool)
_LOOK[[*range(0, 9), *range(0x0E, 0x20), 0x7F, 0xC2, 0xC4, *range(0xC9, 0x100), ord("<")]] = True


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a character outside the plain range, or a special token's opening."""
    look = np.flatnonzero(_LOOK[data])
    byte, after = data[look], np.append(data, 0)[look + 1]
    odd = ~np.isin(byte, [0xC2, 0xC4, 0xC9, ord("<")])
    odd |= (byte == 0xC2) & (after <= 0xA0) | (byte == 0xC4) & (after == 0xB0)
    odd |= (byte == 0xC9) & (after >= 0x90) | (byte == ord("<")) & (after == ord("|"))
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, look[odd], side="right") - 1] = True
    return out


class WordTokens:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary = model["model"]["vocab"]
        suffix = model["model"]["end_of_word_suffix"]
        self.top = top = max([*vocabulary.values(), *(t["id"] for t in model["added_tokens"])])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.ends = np.zeros(top + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # The words come already cut, so the library only needs to run its merges.
        plain = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps({**model, **plain}))
        self.letters = _byte_letters()
        self.table = SpanTable(self._learn, self.dtype)

    def _learn(self, chunks: list[bytes]):
        words: list[str] = []
        last = np.empty(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            words += _WORDS.findall(chunk.decode().lower())
            last[i] = len(words)
        parts = []
        for at in range(0, len(words), 20_000):
            spelled = " ".join(words[at : at + 20_000]).encode().decode("latin-1").translate(self.letters)
            ids = self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids
            parts.append(np.array(ids, self.dtype))
        ids = np.concatenate(parts) if parts else np.zeros(0, self.dtype)
        ends = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) != len(words) + 1:
            raise ValueError("The vocabulary does not end every word with its suffix.")
        return ids, np.diff(ends[last], prepend=0)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text, without special tokens; a null text has none."""
        out: list[np.ndarray] = []
        for a, b in text_slices(column, 4 << 20):
            out += self._slice(column.slice(a, b - a))
        return out

    def _slice(self, column: pa.Array) -> list[np.ndarray]:
        words = hashed_words(column)
        odd = odd_texts(words.data, words.offsets)
        start, end, hashes = words.start, words.end, words.hashes
        first = words.first
        if odd.any():
            keep = ~odd[np.searchsorted(first, np.arange(len(hashes)), side="right") - 1]
            start, end, hashes = start[keep], end[keep], hashes[keep]
            first = np.concatenate([[0], np.cumsum(keep)])[first]
        ids, count = self.table.gather(words.data, start, end, hashes)
        edges = np.concatenate([[0], np.cumsum(count)])[first]
        out = [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.array(self.library.encode(column[i].as_py(), add_special_tokens=False).ids, self.dtype)
        return out


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet's rule: printable bytes stay, the others follow from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in kept}
    for place, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + place)
    table.pop(0x20)  # parts the words
    return table


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per worker process."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
