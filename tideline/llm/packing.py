"""Packing of token sequences by shortest-pack-first over the histogram of lengths.

Documents are cut every ``capacity`` tokens; what is left of each is placed as a whole. Lengths are
placed longest first, each into the packs that hold least so far, and only counts of packs that hold
equally much are updated; so placing costs the same for any number of documents. Pieces meet their
place by an equi-join on length and rank within the length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import tokens, words
from tideline.session import written

CAPACITY = 4096
#: Ranks of one row of the placement table; longer runs are cut, so that no task expands one alone.
RUN = 50_000
#: Pieces of one length that one task ranks at most, on average.
RANKED = 20_000


def place(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs ``(length, first rank, count, first sequence, offset)`` and the number of sequences.

    Every length must be from 1 to ``capacity``. A run says that ``count`` pieces of a length, from a
    rank on, go into as many successive sequences at one offset.
    """
    packs: list[tuple[int, int, int]] = []  # (tokens held, first sequence, sequences)
    runs, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left and packs and packs[0][0] + length <= capacity:
            held, first, count = heapq.heappop(packs)
            used = min(left, count)
            runs.append((length, rank, used, first, held))
            heapq.heappush(packs, (held + length, first, used))
            if used < count:
                heapq.heappush(packs, (held, first + used, count - used))
            rank, left = rank + used, left - used
        # No pack has room, so new ones fill up one after the other.
        each = capacity // length
        for per_pack, opened in ((each, left // each), (left % each, 1)):
            if per_pack and opened:
                for slot in range(per_pack):
                    runs.append((length, rank, opened, sequences, slot * length))
                    rank += opened
                heapq.heappush(packs, (per_pack * length, sequences, opened))
                sequences += opened
    return runs, sequences


def _pieces(path: str, end_id: int, capacity: int, most_words: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.trim()
        encoder = tokens.encoder(path, most_words)
        for batch in batches:
            ids, (data, offsets) = batch.column(0), words.utf8(batch.column(1))
            for lo, hi in words.slices(offsets):
                texts = [data[a:b].tobytes() for a, b in zip(offsets[lo:hi], offsets[lo + 1 : hi + 1])]
                found, at = encoder.encode(texts)
                row, start, length, crc, total = [], [], [], [], []
                for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
                    whole = np.append(found[a:b], np.uint32(end_id)).astype("<u4")
                    for cut in range(0, len(whole), capacity):
                        part = whole[cut : cut + capacity]
                        row.append(lo + i)
                        start.append(cut)
                        length.append(len(part))
                        crc.append(zlib.crc32(part))
                        total.append(len(whole))
                columns = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), *columns], names=names)

    return run


def token_pieces(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    capacity: int = CAPACITY,
    most_words: int | None = None,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of pieces of at most ``capacity`` tokens.

    A document's tokens are those of its text (null: empty) and ``end_id``, so each has a piece.
    ``tokenizer`` is the path of a tokenizer file on every executor. ``most_words`` bounds the words a
    worker remembers (``tokens.MOST_WORDS`` unless given); fewer cost time, never tokens.
    """
    words.small_batches(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return rows.mapInArrow(_pieces(tokenizer, end_id, capacity, most_words), schema)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with ``rank``, from 0 without gaps within their length.

    Each length is dealt over parts by a hash, so that no task sorts a length alone; ranks start where
    the parts before end.
    """
    parts = max(1, -(-pieces.count() // RANKED))
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)))
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)) - 1
    ranked = pieces.withColumn("within", within).join(bases, ["length", "part"])
    return ranked.withColumn("rank", F.col("base") + F.col("within")).drop("part", "within", "base")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; sequences are gapless and hold up to ``capacity`` tokens.

    Needs the columns of :func:`token_pieces`; columns named like the results are replaced. The
    histogram, at most one count for each length, is all that the driver sees. Ties between pieces
    of a length go by ``doc_id`` and ``start``; repeated rows are pieces of their own. An empty
    table gives an empty result.
    """
    spark = pieces.sparkSession
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = histogram.pop(capacity, 0)
    runs, _ = place(histogram, capacity)
    cut = [(l, r + i, min(RUN, n - i), s + i, o) for l, r, n, s, o in runs for i in range(0, n, RUN)]
    names = ["length", "rank", "count", "sequence", "offset"]
    columns = np.array(cut, np.int64).reshape(-1, 5).T
    table = spark.createDataFrame(pa.table({n: pa.array(c) for n, c in zip(names, columns)}))
    places = table.select(
        "length", "rank", "sequence", "offset", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1)).alias("i")
    ).select("length", (F.col("rank") + F.col("i")).alias("rank"), (F.col("sequence") + F.col("i") + full).alias("sequence_id"), "offset")
    ranked = _ranked(pieces)
    whole = ranked.filter(F.col("length") == capacity).withColumn("sequence_id", F.col("rank")).withColumn("offset", F.lit(0).cast("bigint"))
    rest = ranked.filter(F.col("length") < capacity).join(places, ["length", "rank"])
    return whole.unionByName(rest).select(*pieces.columns, "sequence_id", "offset")
