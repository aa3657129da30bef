"""Token encoding and decoding with content-defined chunks, each encoded once per Python worker.

A hash rolling over ``SPAN`` bytes cuts texts where its low bits are zero, so that equal passages are cut alike
in all documents. The words a chunk holds whole are encoded when it is first met and reused
wherever it comes again. What lies across a join is encoded anew together with a word on either
side; if those words do not come out as they did inside their chunks, the join is widened by a
further word, up to whole chunks, until they do.

Sharing goes through a bounded table in each worker, not a shuffle: bringing equal chunks of all documents
together would move the whole corpus and all of its ids. What that would cost is not measured.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import tokens, words

SPAN = 16
#: Cuts come every 512 bytes on average.
CUT_BITS = 9
#: Bytes of chunks that a worker keeps; when they are more, its table starts anew.
MOST_BYTES = 32 << 20
_GEAR = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_WHITE = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: Words on either side of a join that must come out as before, at first and when that fails.
MARGINS = 1, 4, 16


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions after which a chunk ends, by the bytes before each; never within a character."""
    if len(data) <= SPAN:
        return np.zeros(0, np.int64)
    rolling, reach, factor = _GEAR[data], 1, 0x9E3779B97F4A7C15
    while reach < SPAN:
        longer = rolling.copy()
        longer[reach:] += rolling[:-reach] * np.uint64(factor)
        rolling, reach, factor = longer, 2 * reach, factor * factor % 2**64
    at = np.flatnonzero(rolling >> np.uint64(64 - CUT_BITS) == 0) + 1
    at = at[(at >= SPAN) & (at < len(data))]
    return at[data[at] & 0xC0 != 0x80]


class Chunk(NamedTuple):
    """A chunk: what stands before its first and after its last white space, and the ids between.

    Without white space it is all ``head``, and ``ids`` is None.
    """

    head: bytes
    body: bytes
    ids: np.ndarray | None
    tail: bytes


def _parts(chunk: bytes) -> tuple[bytes, bytes | None, bytes]:
    first = _WHITE.search(chunk)
    if first is None:
        return chunk, None, b""
    last = len(chunk) - 1
    while not _WHITE.match(chunk, last):
        last -= 1
    return chunk[: first.start()], chunk[first.start() : last + 1], chunk[last + 1 :]


class Codec:
    """Encodes texts chunk by chunk; ``encoded`` counts chunks encoded, ``met`` chunks met."""

    def __init__(self, path: str):
        self.encoder = tokens.encoder(path)
        self.known: dict[bytes, Chunk] = {}
        self.bytes = self.encoded = self.met = 0

    def _learn(self, chunks: dict[bytes, None]) -> None:
        new = [c for c in chunks if c not in self.known]
        if self.bytes + sum(map(len, new)) > MOST_BYTES:
            self.known, self.bytes, new = {}, 0, list(chunks)
        parts = [_parts(c) for c in new]
        ids, at = self.encoder.encode([body or b"" for _, body, _ in parts])
        for chunk, (head, body, tail), a, b in zip(new, parts, at[:-1], at[1:]):
            self.known[chunk] = Chunk(head, body or b"", None if body is None else ids[a:b].copy(), tail)
        self.bytes += sum(map(len, new))
        self.encoded += len(new)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        per_text = []
        for text in texts:
            at = [0, *cuts(np.frombuffer(text, np.uint8)).tolist(), len(text)]
            per_text.append([text[a:b] for a, b in zip(at[:-1], at[1:])])
        self.met += sum(map(len, per_text))
        self._learn(dict.fromkeys(c for chunks in per_text for c in chunks))
        found = [self._runs([self.known[c] for c in chunks]) for chunks in per_text]
        joins = self._joined([join for _, own in found for join in own])
        out, n = [], 0
        for text, (runs, own) in zip(texts, found):
            middles, n = joins[n : n + len(own)], n + len(own)
            if any(m is None for m in middles):  # no margin sufficed
                out.append(self.encoder.encode([text])[0])
                continue
            pieces = [x for pair in zip(middles, runs) for x in pair] + middles[len(runs) :]
            out.append(np.concatenate(pieces) if pieces else np.zeros(0, np.uint32))
        return out

    @staticmethod
    def _runs(chunks: list[Chunk]) -> tuple[list[np.ndarray], list[tuple]]:
        """Ids of the chunks with white space, and the joins before, between and after them."""
        runs, joins, open_text, before = [], [], b"", None
        for chunk in chunks:
            open_text += chunk.head
            if chunk.ids is None:
                continue
            joins.append((before, open_text, chunk))
            runs.append(chunk.ids)
            open_text, before = chunk.tail, chunk
        return runs, [*joins, (before, open_text, None)]

    def _joined(self, joins: list[tuple]) -> list[np.ndarray | None]:
        """Ids of the text across each join, once the words around it agree with their chunks."""
        out: list[np.ndarray | None] = [None if text else np.zeros(0, np.uint32) for _, text, _ in joins]
        open_joins = [i for i, ids in enumerate(out) if ids is None]
        for margin in MARGINS:
            if not open_joins:
                break
            left, right = [], []
            for i in open_joins:
                before, _, after = joins[i]
                left.append(b" ".join(before.body.split()[-margin:]) if before else b"")
                right.append(b" ".join(after.body.split()[:margin]) if after else b"")
            middle = [b" ".join((a, joins[i][1], b)) for i, a, b in zip(open_joins, left, right)]
            (ids, at), (_, left_at), (_, right_at) = (self.encoder.encode(x) for x in (middle, left, right))
            missed = []
            spans = zip(open_joins, at[:-1], at[1:], np.diff(left_at), np.diff(right_at))
            for i, a, b, n, m in spans:
                before, _, after = joins[i]
                agrees = a + n <= b - m
                agrees = agrees and (not n or np.array_equal(ids[a : a + n], before.ids[-n:]))
                agrees = agrees and (not m or np.array_equal(ids[b - m : b], after.ids[:m]))
                if agrees:
                    out[i] = ids[a + n : b - m]
                else:
                    missed.append(i)
            open_joins = missed
        return out


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        decode = coder.encoder.tokenizer.decode
        for batch in batches:
            rows, (data, offsets) = batch.column(0), words.utf8(batch.column(1))
            for lo, hi in words.slices(offsets):
                found = coder.encode([data[a:b].tobytes() for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])])
                columns = [
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()),
                    pa.array([decode(x.tolist(), skip_special_tokens=False) for x in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([rows.slice(lo, hi - lo), *columns], names=["id", "n_tokens", "ids", "decoded"])

    return run


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids, decoded`` for every row: its ids as little-endian unsigned 32-bit numbers and the
    text the library decodes from them, special tokens included.

    A null or empty text has no ids and decodes to the empty text. Repeated rows give equal results; an
    empty table gives an empty result; other columns are not read. ``tokenizer`` is the path of a
    tokenizer file on every executor.
    """
    words.small_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens bigint, ids binary, decoded string"
    return rows.mapInArrow(_digests(tokenizer), schema).withColumnRenamed("id", id_col)
