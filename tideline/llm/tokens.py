"""Token ids of whole texts by a public tokenizer, each different word encoded once per Python worker.

The tokenizer drops white space and never joins text across it, so a text's ids are the ids of its
white-space separated parts in order. Texts where that needs care (special tokens, combining
marks) are encoded whole. Ids are those of the library for the same file, without special tokens added,
truncation or padding.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

#: Words kept by one worker, about 200 MB; when they are more, the table starts anew.
MOST_WORDS = 800_000


class Encoder:
    def __init__(self, path: str, most_words: int | None = None):
        from tokenizers import Tokenizer

        # A task has one core; threads of the library would each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.most_words = most_words or MOST_WORDS
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.closes_word = np.array([x.endswith("</w>") for x in names])
        (self.stop,), (self.comma,) = self._whole("."), self._whole(",")
        self._clear()

    def _clear(self) -> None:
        self.index: dict = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.filled = 0
        self.first, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _room(self, words: int, ids: int) -> None:
        while self.filled + ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.index) + words > len(self.first):
            self.first, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.length))

    def _add(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._room(len(keys), len(ids))
        at, n = self.filled, len(self.index)
        self.flat[at : at + len(ids)] = ids
        self.first[n : n + len(keys)] = at + np.cumsum(lengths) - lengths
        self.length[n : n + len(keys)] = lengths
        self.index.update(zip(keys, range(n, n + len(keys))))
        self.filled += len(ids)

    def _learn(self, missing: set) -> None:
        """Add the ids of new words; plain words go through the library in one call."""
        # A full stop or comma after a plain letter is a token of its own.
        ends = {w: w[:-1] for w in missing if type(w) is bytes and len(w) > 1 and w[-1] in b".," and 97 <= w[-2] <= 122}
        bases = (missing - ends.keys()) | {w for w in ends.values() if w not in self.index}
        plain, other = [], []
        for w in bases:
            text = w.decode() if type(w) is bytes else None
            (plain if text is not None and text.isalpha() else other).append((w, text))
        if plain:
            # Runs of words, as the library's batch call need not track where each token came from.
            runs = [" ".join([t for _, t in plain[i : i + 512]]) for i in range(0, len(plain), 512)]
            got = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
            ids = np.array(list(chain.from_iterable(x.ids for x in got)), np.uint32)
            stops = np.flatnonzero(self.closes_word[ids]) + 1
            if len(stops) == len(plain):
                self._add([w for w, _ in plain], ids, np.diff(stops, prepend=0))
            else:
                other += plain
        if other:
            got = [self._whole(t if t is not None else w[0].decode()) for w, t in other]
            self._add([w for w, _ in other], np.array([*chain.from_iterable(got)], np.uint32), np.array([len(x) for x in got]))
        if ends:
            base, base_ends = self._gather(self._find([*ends.values()]))
            length = np.diff(base_ends)
            into = np.concatenate([[0], np.cumsum(length + 1)])
            ids = np.zeros(into[-1], np.uint32)
            ids[np.arange(len(base)) + np.repeat(np.arange(len(length)), length)] = base
            ids[into[1:] - 1] = np.where([w[-1] == 46 for w in ends], self.stop, self.comma)
            self._add(list(ends), ids, length + 1)

    def _find(self, words: list) -> np.ndarray:
        """Numbers of the words; -1 for new ones."""
        return np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))

    def _gather(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words with these numbers, and where each word ends among them."""
        first, length = self.first[found], self.length[found]
        ends = np.concatenate([[0], np.cumsum(length)])
        return self.flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], length)], ends

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the UTF-8 texts, and the offsets of the texts among them."""
        words, counts = [], [0]
        for text in texts:
            if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
                words.append((text,))
            else:
                words += text.lower().split()
            counts.append(len(words))
        found = self._find(words)
        missing = {words[i] for i in np.flatnonzero(found < 0)}
        if missing:
            if len(self.index) + len(missing) > self.most_words:
                self._clear()
                missing, found[:] = set(words), -1
            self._learn(missing)
            at = np.flatnonzero(found < 0)
            found[at] = self._find([words[i] for i in at])
        ids, ends = self._gather(found)
        return ids, ends[counts]


@cache
def encoder(path: str, most_words: int | None = None) -> Encoder:
    return Encoder(path, most_words)


def forget() -> None:
    """Give back the memory of earlier stages; Python workers live on from stage to stage."""
    encoder.cache_clear()
    gc.collect()
    trim()


def trim() -> None:
    """Give freed memory back to the system, Arrow's own pool included."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library keeps what it has
        ctypes.CDLL(None).malloc_trim(0)
