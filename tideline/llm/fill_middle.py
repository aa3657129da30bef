"""Fill-in-middle examples: texts cut into prefix, middle and suffix at unit boundaries.

The bytes of a slice of texts become one wavelet matrix over character classes, which tell word
characters, blanks, line breaks and UTF-8 continuation bytes apart, and the first of a run from
those inside it. Ranks of single classes add up to whatever is to be counted: units before a place,
gaps before a place, code points between two places. Both cuts of all texts of the slice are found
together by bisection on those sums, so no text is ever split into a list of its units.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import words

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")

WORD_BEGIN, WORD_INSIDE, BLANK_BEGIN, BLANK_INSIDE, BREAK_BEGIN, BREAK_INSIDE, CONTINUATION = range(7)
_CLASS_BITS = 3


class WaveletMatrix:
    """Symbols of a few bits; occurrences of any symbol before any place in one step a bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for shift in range(bits - 1, -1, -1):
            bit = ((symbols >> shift) & 1).astype(bool)
            packed = np.zeros((len(bit) // 64 + 1) * 8, np.uint8)
            filled = np.packbits(bit, bitorder="little")
            packed[: len(filled)] = filled
            packed = packed.view("<u8")
            ones = np.zeros(len(packed), np.int64)
            np.cumsum(np.bitwise_count(packed[:-1]), out=ones[1:])
            zeros = len(bit) - int(np.count_nonzero(bit))
            self.levels.append((packed, ones, zeros))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` among the first ``at`` symbols, for every entry of ``at``."""
        at = np.append(at, 0)  # the last entry finds where the symbol's own run begins
        for shift, (packed, ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            before = ones[at >> 6] + np.bitwise_count(packed[at >> 6] & below)
            at = zeros + before if symbol >> shift & 1 else at - before
        return at[:-1] - at[-1]

    def count(self, symbols: Sequence[int], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many of several symbols lie from ``start`` to before ``end``."""
        return sum(self.rank(s, end) - self.rank(s, start) for s in symbols)

    def reach(self, symbols: Sequence[int], start: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Least place up to ``end`` with ``wanted`` of the symbols between ``start`` and it; ``end`` if there is none."""
        base = sum(self.rank(s, start) for s in symbols)
        low, high = start.copy(), end.copy()
        while (open_ := low < high).any():
            middle = (low + high) >> 1
            enough = sum(self.rank(s, middle) for s in symbols) - base >= wanted
            high = np.where(open_ & enough, middle, high)
            low = np.where(open_ & ~enough, middle + 1, low)
        return low


def classes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Class of every byte; runs end at blanks, at line breaks and where a text ends."""
    blank = words._SPACE[data]
    begins = np.ones(len(data), bool)
    begins[1:] = blank[1:] != blank[:-1]
    heads = offsets[:-1]
    begins[heads[heads < len(data)]] = True
    found = np.where(blank, np.where(data == 10, BREAK_BEGIN, BLANK_BEGIN), WORD_BEGIN) + ~begins
    return np.where(data & 0xC0 == 0x80, CONTINUATION, found).astype(np.uint8)


class Units:
    """Units of a slice of texts: words with the blanks before them, or lines with their line break."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str):
        self.unit, self.matrix = unit, WaveletMatrix(classes(data, offsets), _CLASS_BITS)
        self.start, self.end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
        filled = self.end > self.start
        last, second = np.where(filled, self.end - 1, self.end), np.where(filled, self.start + 1, self.start)
        if unit == "word":
            blanks = (BLANK_BEGIN, BLANK_INSIDE, BREAK_BEGIN, BREAK_INSIDE)
            self.ends = (BLANK_BEGIN, BREAK_BEGIN)
            self.unit_count = self.matrix.count((WORD_BEGIN,), self.start, self.end)
            self.unit_count += self.matrix.count(blanks, last, self.end)  # blanks at the end are a unit
            self.skipped = self.matrix.count(blanks, self.start, second)  # the gap before the first word ends none
        elif unit == "line":
            self.ends = (BREAK_BEGIN, BREAK_INSIDE)
            breaks = self.matrix.count(self.ends, self.start, self.end)
            self.unit_count = breaks + filled - self.matrix.count(self.ends, last, self.end)
            self.skipped = np.zeros(len(self.start), np.int64)
        else:
            raise ValueError(f"no such unit: {unit}")

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Place after the first ``units`` units of each text."""
        wanted = units + self.skipped
        place = self.matrix.reach(self.ends, self.start, self.end, wanted)
        if self.unit == "word":  # a word ends before the blank that shows it
            reached = self.matrix.count(self.ends, self.start, place) >= wanted
            place = np.where(reached, place - 1, place)
        return np.where(units == 0, self.start, place)

    def chars(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        return end - start - self.matrix.count((CONTINUATION,), start, end)


def _examples(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
        for batch in batches:
            *kept, text, form, first, second = batch.columns
            data, offsets = words.utf8(text)
            for lo, hi in words.slices(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                units = Units(part, at, unit)
                draws = [np.asarray(c.slice(lo, hi - lo)).astype(np.int64) % (units.unit_count + 1) for c in (first, second)]
                left, right = units.cut(np.minimum(*draws)), units.cut(np.maximum(*draws))
                forms = form.slice(lo, hi - lo).to_pylist()
                out, whole = [], part.tobytes()
                for a, b, c, d, f in zip(at[:-1], left, right, at[1:], forms):
                    prefix, middle, suffix = whole[a:b], whole[b:c], whole[c:d]
                    if f == "psm":
                        out.append(b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle)))
                    elif f == "spm":
                        out.append(b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle)))
                    else:
                        out.append(whole[a:d])
                plain = np.array([f == "plain" for f in forms], bool)
                lengths = [units.chars(units.start, left), units.chars(left, right)]
                made = [
                    pa.array(units.unit_count, pa.int64()),
                    pa.array(forms, pa.string()),
                    *[pa.array(n, pa.int64(), mask=plain) for n in lengths],
                    pa.array(out, pa.binary()).cast(pa.string()),
                ]
                names = [*batch.schema.names[: len(kept)], *RESULTS]
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in kept], *made], names=names)

    return run


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = "42",
    percent: int = 50,
    spm_percent: int = 80,
    unit: str = "word",
) -> DataFrame:
    """Rows of ``df`` with ``n, form, prefix_chars, middle_chars, output`` in place of their text.

    ``n`` counts the units of the text (``word`` or ``line``). Four numbers are drawn from the SHA-256
    of seed and id: two say after how many units the cuts lie, one whether the text is transformed
    (``percent`` of them), one whether suffix (``spm``) or prefix (``psm``) comes first. Empty texts and
    those holding one of the marks stay ``plain``, and their two lengths are null.

    A null text counts as empty. A null id draws as an empty one; rows repeated under one id get the same
    cuts. Columns of ``df`` named like a result are replaced. An empty table gives an empty result. Texts
    are never shuffled; a task holds one slice of 256 KB, or one text if that is longer.
    """
    words.small_batches(df.sparkSession)
    kept = [c for c in df.columns if c != text_col and c not in RESULTS]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    order = F.when(draws[3] % 100 < spm_percent, "spm").otherwise("psm")
    form = F.when((text == "") | marked | (draws[2] % 100 >= percent), "plain").otherwise(order)
    names = [f"_fim_{i}" for i in range(4)]
    columns = [c.alias(n) for c, n in zip((text, form, draws[0], draws[1]), names)]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], *columns)
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[: len(kept)])
    schema = f"{fields}n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(_examples(unit), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(output, MIDDLE, 1)
        ahead = F.substring(F.substring_index(head, second, 1), len(first) + 1, 2**31 - 1)
        return ahead, F.substring_index(head, second, -1), F.substring_index(output, MIDDLE, -1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix_first, prefix_second, _ = parts(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_second, middle, suffix_first))
        .otherwise(output)
    )
