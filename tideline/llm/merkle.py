"""Document fingerprints from Merkle trees over paragraphs and sections.

Lines are paragraphs. A section ends at a blank line or after a paragraph whose digest ends in three
zero bits, so an edit moves no section but its own. A node's digest covers those of its children and
the root's covers every byte: roots are equal if and only if texts are. After the root a fingerprint has a
separate flat sketch, hashes of short runs of words of the whole text. It is no part of the tree and
ignores paragraphs; it tells how much two documents share.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm import words

#: Words that are leaves of their own at the beginning, for the sake of short texts.
SINGLE_WORDS = 64
#: After them a leaf ends at words whose hash has this many low zero bits, every four words on average.
LEAF_BITS = 2
#: Bytes of text in a range of ids that one task reads in order, on average.
RANGE_BYTES = 16 << 20
#: Ranges at most; beyond that they grow. Their bounds and first ids are what every task holds.
MOST_RANGES = 100_000
#: Ids a range, on average, in the sample that the bounds are taken from.
SAMPLED = 50


class Paragraph(NamedTuple):
    section: int
    start: int
    size: int
    digest: bytes


def paragraphs(text: bytes) -> list[Paragraph]:
    """Lines of a text with the number of their section; none for an empty text."""
    out, section, start = [], 0, 0
    for line in re.findall(rb"[^\n]*\n|[^\n]+", text):
        digest = hashlib.blake2b(line, digest_size=16).digest()
        out.append(Paragraph(section, start, len(line), digest))
        start += len(line)
        section += not line.strip() or digest[-1] & 7 == 0
    return out


def sections(lines: list[Paragraph]) -> list[bytes]:
    """Digest of each section."""
    hashes = {}
    for p in lines:
        hashes.setdefault(p.section, hashlib.sha256()).update(p.digest)
    return [h.digest() for h in hashes.values()]


def root(text: bytes) -> str:
    """Digest of the whole tree as lowercase hex."""
    return hashlib.sha256(b"".join(sections(paragraphs(text)))).hexdigest()


def leaves(hashes: np.ndarray) -> np.ndarray:
    """24-bit hashes of the runs of words of one text."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint32)
    ends = hashes & np.uint64((1 << LEAF_BITS) - 1) == 0
    ends[:SINGLE_WORDS] = True
    ends[-1] = True
    starts = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    runs = np.add.reduceat(hashes * (2 * place.astype(np.uint64) + np.uint64(1)), starts)
    return (words.mix(runs) >> np.uint64(40)).astype(np.uint32)


def _of(text: str) -> tuple[str, np.ndarray]:
    """Fingerprint of a text and its runs."""
    data = text.encode()
    hashes, _, _ = words.word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    runs = leaves(hashes)
    packed = runs.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()
    return f"{root(data)}.{base64.b64encode(packed).decode()}", runs


def fingerprint(text: str | None) -> str:
    """Root of the tree and hashes of the runs; a null text counts as empty."""
    return _of(text or "")[0]


def likeness(one: str, other: str) -> float:
    """Share of the runs of two fingerprints that both have, repeats counted; 1 for equal roots."""
    runs = (np.frombuffer(base64.b64decode(x[65:]), np.uint8).reshape(-1, 3) @ [65536, 256, 1] for x in (one, other))
    return _alike((one, next(runs)), (other, next(runs)))


def _alike(one: tuple[str, np.ndarray], other: tuple[str, np.ndarray]) -> float:
    if one[0][:64] == other[0][:64]:
        return 1.0
    total = len(one[1]) + len(other[1])
    a, n = np.unique(one[1], return_counts=True)
    b, m = np.unique(other[1], return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    # The roots, which differ, count as one more run of each.
    return 2 * float(np.minimum(n[i], m[j]).sum()) / (total + 2)


_NODES = ["section", "section_digest", "paragraph", "digest", "start", "size"]


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = words.utf8(batch.column(1))
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            lines = paragraphs(data[a:b].tobytes())
            over = [x.hex() for x in sections(lines)]
            columns = [
                batch.column(0).take(pa.array([i] * len(lines), pa.int64())),
                pa.array([p.section for p in lines], pa.int32()),
                pa.array([over[p.section] for p in lines], pa.string()),
                pa.array(range(len(lines)), pa.int32()),
                pa.array([p.digest.hex() for p in lines], pa.string()),
                pa.array([p.start for p in lines], pa.int64()),
                pa.array([p.size for p in lines], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *_NODES])


def tree(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph: ``id``, its section and digests, and the bytes of the text that it covers.

    Empty and null texts have none; repeated rows have theirs twice.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        _nodes, f"id {kind}, section int, section_digest string, paragraph int, digest string, start bigint, size bigint"
    )


def edits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paragraphs of the tree ``new`` that the tree ``old`` of the same id lacks.

    Sections that both have are left out before paragraphs are compared.
    """
    moved = new.join(old.select("id", "section_digest").distinct(), ["id", "section_digest"], "left_anti")
    return moved.join(old.select("id", "digest").distinct(), ["id", "digest"], "left_anti").select("id", *_NODES)


_COMPARED = "n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each range in order with the row after them; the first guest closes its range."""
    waiting = None
    for batch in batches:
        out = {"id": [], **{c.split()[0]: [] for c in _COMPARED.split(", ")}}
        for of_range, guest, id_, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if waiting is None and guest:
                continue
            found = _of(text)
            if waiting is not None:
                _, id_before, before, mine = waiting
                half = len(before) // 2
                edited = before[: len(before) - half] + text[:half]
                new = _of(edited)
                row = (id_before, len(before), edited, mine[0], new[0], _alike(mine, new), _alike(mine, found))
                for column, value in zip(out.values(), row):
                    column.append(value)
            waiting = None if guest else (of_range, id_, text, found)
        columns = [pa.array(out["id"], batch.column(2).type), pa.array(out["n_chars"], pa.int64())]
        columns += [pa.array(out[c], pa.string()) for c in ("edited", "fingerprint", "edited_fingerprint")]
        columns += [pa.array(out[c], pa.float64()) for c in ("near_edited", "near_next")]
        yield pa.RecordBatch.from_arrays(columns, names=list(out))


def _bounds(ids: DataFrame, number: int, ranges: int) -> list:
    """Ids that cut all into ranges of about as many rows, taken from a sample; they only steer who reads what."""
    sample = ids.filter("id is not null").sample(min(1.0, SAMPLED * ranges / max(number, 1)), seed=1)
    dealt = sample.select("id", F.ntile(ranges).over(Window.orderBy("id")).alias("part"))
    return sorted({r.id for r in dealt.filter(F.col("part") < ranges).groupBy("part").agg(F.max("id").alias("id")).collect()})


def _range_of(bounds: list, spark: SparkSession):
    kept = spark.sparkContext.broadcast(bounds)

    def run(ids: pa.Array) -> pa.Array:
        cuts = pa.array(kept.value, ids.type).to_numpy(zero_copy_only=False)
        found = np.zeros(len(ids), np.int64)  # null ids come last, as the least
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        found[valid] = np.searchsorted(cuts, ids.drop_null().to_numpy(zero_copy_only=False), "left")
        return pa.array(found)

    return F.arrow_udf(run, "bigint")


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's, by descending id.

    The edit replaces the last half of the code points by as many, or all, of the first of the next text; the last
    document's next is the first. Null texts count as empty, null ids come last, equal ids go by text; a
    document alone is its own next. The ids are cut into ranges of about ``RANGE_BYTES`` of text at
    quantiles, and into larger ones for more than ``MOST_RANGES``; each range is read in order by one task, and the first row of the range after it is its
    guest, so no text moves more than once and no range depends on another. Ids may be of any type that Spark
    orders and Arrow hands to numpy; rows of one id, or without any, stay in one range, which its task sorts and streams.
    """
    words.small_batches(df.sparkSession)
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    size, number = rows.agg(F.sum(F.octet_length("text")), F.count("id")).first()
    ranges = min(int((size or 0) // RANGE_BYTES) + 1, MOST_RANGES)
    bounds = _bounds(rows.select("id"), number, ranges) if ranges > 1 else []
    range_of = _range_of(bounds, rows.sparkSession)("id") if bounds else F.lit(0).cast("bigint")
    rows = rows.withColumn("range", range_of)
    firsts = rows.groupBy("range").agg(F.max("id").alias("first"))
    order = Window.orderBy("range")  # a row for each range
    to = F.coalesce(F.lead("range").over(order), F.first("range").over(order))
    firsts = firsts.withColumn("to", to)
    # At most MOST_RANGES rows.
    guests = rows.join(F.broadcast(firsts), "range").filter(F.col("id").eqNullSafe(F.col("first")))
    guests = guests.select(F.col("to").alias("range"), F.lit(True).alias("guest"), "id", "text")
    dealt = rows.select("range", F.lit(False).alias("guest"), "id", "text").unionByName(guests)
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("range").cast("int"))
    ordered = dealt.sortWithinPartitions("range", "guest", F.desc_nulls_last("id"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    return ordered.mapInArrow(_compare, f"id {kind}, {_COMPARED}").withColumnRenamed("id", id_col)
