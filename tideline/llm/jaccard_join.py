"""Exact set-similarity join of word shingles with adaptive multi-match prefixes.

Shingles are ordered from rare to frequent by upper bounds of their document counts: two fixed-size
tables of hashed counts, of shingles and of words, summed over all documents. If two sets reach the
threshold, then for every ``l`` their prefixes of ``n - needed + l`` shingles share at least ``l``,
where ``needed`` follows from both sizes; what is posted suffices for any partner's size.
Each document picks the ``l`` whose prefix it expects to cost least, counting the postings it meets
and the pairs left to verify; a pair needs the smaller of its two ``l`` in common.

Only links between different sets and different components are looked for: equal sets are one
node, every posting list is first verified against its member that comes nearest the head of a prefix,
and pairs that these links already connect are not listed again. All others are, so components
are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import bitmaps, tokens, words
from tideline.llm.components import components
from tideline.llm.tokens import trim
from tideline.session import written

#: Sizes of the two tables of hashed counts; they bound what reaches the driver and each task.
SHINGLE_SLOTS = 1 << 20
WORD_SLOTS = 1 << 18
_BLOCK = 1 << 14
MOST_SHARED = 4


def _rows(batches) -> Iterator[tuple[list, np.ndarray, list[np.ndarray]]]:
    """Ids, word hashes and each row's span among the words, a bounded slice of rows at a time."""
    for batch in batches:
        ids, (data, offsets) = batch.column(0), words.utf8(batch.column(1))
        for lo, hi in words.slices(offsets):
            hashes, _, at = words.word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            yield ids.slice(lo, hi - lo), hashes, at


def _count_blocks(k: int):
    """Per task: counts of hashed shingles (by document) and words, as blocks of numbers."""

    def run(batches):
        tokens.forget()
        shingles, single = np.zeros(SHINGLE_SLOTS, np.uint32), np.zeros(WORD_SLOTS, np.uint32)
        seen = False
        for _, hashes, at in _rows(batches):
            seen = True
            single += np.bincount(hashes & np.uint64(WORD_SLOTS - 1), minlength=WORD_SLOTS).astype(np.uint32)
            sets = [np.unique(words.shingle_hashes(hashes[a:b], k)) for a, b in zip(at[:-1], at[1:]) if b > a]
            if sets:
                slots = np.concatenate(sets) & np.uint64(SHINGLE_SLOTS - 1)
                shingles += np.bincount(slots, minlength=SHINGLE_SLOTS).astype(np.uint32)
        if seen:
            yield _blocks(np.concatenate([shingles, single]))

    return run


def _blocks(counts: np.ndarray) -> pa.RecordBatch:
    kept = {i: b.tobytes() for i, b in enumerate(counts.reshape(-1, _BLOCK)) if b.any()}
    return pa.RecordBatch.from_arrays(
        [pa.array(kept, pa.int32()), pa.array(kept.values(), pa.binary())], names=["block", "counts"]
    )


def _add_blocks(batches):
    """Sums of the blocks that a task gets."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(counts, np.uint32 if len(counts) == 4 * _BLOCK else np.uint64)
            if block not in total:
                total[block] = np.zeros(_BLOCK, np.uint64)
            total[block] += counts
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(total, pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
            names=["block", "counts"],
        )


def hashed_counts(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Document counts of hashed shingles and counts of hashed words over all of ``texts``."""
    blocks = (SHINGLE_SLOTS + WORD_SLOTS) // _BLOCK
    schema = "block int, counts binary"
    parts = texts.mapInArrow(_count_blocks(k), schema)
    # Two steps, so that no task sums the tables of all tasks.
    parts = parts.repartition("block", F.spark_partition_id() % 16).mapInArrow(_add_blocks, schema)
    sums = parts.repartition("block").mapInArrow(_add_blocks, schema)
    counts = np.zeros((blocks, _BLOCK), np.uint64)
    for row in sums.toLocalIterator():  # at most ``blocks`` rows of 128 KB
        counts[row.block] += np.frombuffer(row.counts, np.uint64)
    counts = counts.reshape(-1)
    return counts[:SHINGLE_SLOTS], counts[SHINGLE_SLOTS:]


def _needed(n: int, percent: int) -> int:
    """Least shared shingles of a set of ``n`` with any set it can link with."""
    return -(-percent * n // 100)


def _choose(frequency: np.ndarray, n: int, percent: int) -> int:
    """The number of shared prefix shingles to ask for, by expected postings met and pairs verified."""
    spare, most = n - _needed(n, percent), min(MOST_SHARED, _needed(n, percent))
    met = np.cumsum(np.maximum(frequency - 1.0, 0.0))
    best = [met[spare + l - 1] * (1 + (0.1 + n / 1000) / l) + spare + l for l in range(1, most + 1)]
    return int(np.argmin(best)) + 1


def _prefixes(k: int, percent: int, shared):
    """Per document: set size, signature of the set, chosen ``l`` and the prefix, rare shingles first."""

    def run(batches):
        tokens.forget()
        shingle_counts, word_counts = (x.astype(np.float64) for x in shared.value)
        usual = np.median(shingle_counts), np.median(word_counts)
        shingle_counts, word_counts = np.maximum(shingle_counts - usual[0], 1), np.maximum(word_counts - usual[1], 1)
        for ids, hashes, at in _rows(batches):
            out = {"n": [], "sig": [], "asked": [], "prefix": []}
            by_word = word_counts[hashes & np.uint64(WORD_SLOTS - 1)]
            for a, b in zip(at[:-1], at[1:]):
                if b == a:
                    for name, value in zip(out, (0, None, 0, [])):
                        out[name].append(value)
                    continue
                size = min(k, b - a)
                run_ = words.shingle_hashes(hashes[a:b], k)
                least = by_word[a : b - size + 1]
                for i in range(1, size):
                    least = np.minimum(least, by_word[a + i : b - size + 1 + i])
                found, first = np.unique(run_, return_index=True)
                bound = np.minimum(least[first], shingle_counts[found & np.uint64(SHINGLE_SLOTS - 1)])
                order = (np.log2(bound) * 256).astype(np.uint64) << np.uint64(48) | found >> np.uint64(16)
                n = len(found)
                end = min(n, n - _needed(n, percent) + MOST_SHARED)
                near = np.argpartition(order, end - 1)[:end]
                near = near[np.argsort(order[near])]
                asked = _choose(bound[near], n, percent)
                out["n"].append(n)
                out["sig"].append(blake2b(found.tobytes(), digest_size=16).digest())
                out["asked"].append(asked)
                out["prefix"].append(order[near][: n - _needed(n, percent) + asked].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(out["n"], pa.int64()),
                    pa.array(out["sig"], pa.binary()),
                    pa.array(out["asked"], pa.int32()),
                    pa.array(out["prefix"], pa.list_(pa.int64())),
                ],
                names=["id", *out],
            )

    return run


def _sets(k: int):
    def run(batches):
        tokens.forget()
        for ids, hashes, at in _rows(batches):
            sets = [np.unique(words.shingle_hashes(hashes[a:b], k)).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], names=["id", "hashes"])

    return run


def _linked(percent: int):
    """Pairs whose whole sets reach the threshold."""

    def run(batches):
        tokens.forget()
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("hashes_a"), batch.column("hashes_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _within_reach(percent: int):
    """Pairs whose prefixes allow the threshold: up to the end of the shorter one all shared shingles are known."""

    def run(batches):
        tokens.forget()
        for batch in batches:
            keep = []
            for x, y, n_x, n_y in zip(*(batch.column(c) for c in ("prefix_a", "prefix_b", "n_a", "n_b"))):
                x, y = (v.values.to_numpy().view(np.uint64) for v in (x, y))
                n_x, n_y, end = n_x.as_py(), n_y.as_py(), min(x[-1], y[-1])
                # Whatever lies up to ``end`` in either set is in its prefix.
                both = len(np.intersect1d(x, y, assume_unique=True))
                rest = min(n_x - np.searchsorted(x, end, "right"), n_y - np.searchsorted(y, end, "right"))
                keep.append((both + rest) * (100 + percent) >= percent * (n_x + n_y))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows with one of the ids; all others but a few are sorted out before the shuffle."""
    rows = bitmaps.marked(rows, bitmaps.bitmap(ids), [F.col("id")], "_wanted").filter("_wanted").drop("_wanted")
    return rows.join(ids, "id", "left_semi")


def _with_both(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs with the columns of ``rows`` of both ends."""
    for x in "ab":
        pairs = pairs.join(rows.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in rows.columns[1:]]), x)
    return pairs


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of ids whose whole texts reach the threshold, by the sets of just these texts."""
    kind = _kind(texts)
    prefixes = _only(sets.select("id", "prefix", "n"), _ends(pairs))
    pairs = _with_both(pairs, prefixes).mapInArrow(_within_reach(percent), f"a {kind}, b {kind}")
    pairs = written(pairs.distinct(), "pairs")
    hashes = _only(texts, _ends(pairs)).mapInArrow(_sets(k), f"id {kind}, hashes binary")
    return _with_both(pairs, written(hashes, "hashes")).mapInArrow(_linked(percent), f"a {kind}, b {kind}").distinct()


def _kind(texts: DataFrame) -> str:
    return texts.schema["id"].dataType.simpleString()


def _candidates(matches: DataFrame, percent: int) -> DataFrame:
    """Pairs that share as many prefix shingles as the less demanding of the two asks for.

    ``matches`` has a row per pair and shared shingle, with the places in both prefixes.
    """
    found = matches.groupBy("a", "b", "n_a", "n_b").agg(
        F.count("*").alias("common"),
        F.max("place_a").alias("last_a"),
        F.max("place_b").alias("last_b"),
        F.min(F.least("asked_a", "asked_b")).alias("asked"),
    )
    # Beyond its last common prefix shingle a pair can share at most what is left of either set.
    rest = F.least(F.col("n_a") - F.col("last_a") - 1, F.col("n_b") - F.col("last_b") - 1)
    return found.filter(_enough(F.col("common") + rest, percent) & (F.col("common") >= F.col("asked"))).select("a", "b")


def _enough(shared, percent: int):
    """Whether ``shared`` shingles can make sets of ``n_a`` and ``n_b`` reach the threshold."""
    return shared * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))


def _possible(percent: int):
    """Of one shared shingle: it lies in the prefixes that this pair of sizes calls for, and the places
    leave enough to share."""
    asked = F.least("asked_a", "asked_b")
    needed = F.floor((percent * (F.col("n_a") + F.col("n_b")) + 99 + percent) / (100 + percent))
    deep = (F.col("place_a") < F.col("n_a") - needed + asked) & (F.col("place_b") < F.col("n_b") - needed + asked)
    after = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return deep & _enough(F.least("place_a", "place_b") + after, percent)


def _side(postings: DataFrame, x: str, keys: list[str]) -> DataFrame:
    """Postings as one side of a join; columns but ``keys`` get the suffix ``x``."""
    names = {"id": x, "n": f"n_{x}", "asked": f"asked_{x}", "place": f"place_{x}", "component": f"component_{x}"}
    return postings.select(*keys, *[F.col(c).alias(names[c]) for c in postings.columns if c in names and c not in keys])


def _star_links(postings: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Candidates of each posting list against its member nearest the head of its prefix."""
    heads = postings.groupBy("token").agg(F.min(F.struct("place", "n", "id", "asked")).alias("head"))
    heads = heads.join(lists, "token").select(
        "token", "posted", *[F.col(f"head.{c}").alias(x) for c, x in (("id", "b"), ("n", "n_b"), ("asked", "asked_b"), ("place", "place_b"))]
    )
    met = bitmaps.join_groups(_side(postings, "a", ["token"]), heads, ["token"], "posted", F.col("a"))
    return met.filter((F.col("a") != F.col("b")) & _possible(percent)).select("a", "b").distinct()


def open_links(postings: DataFrame, percent: int) -> DataFrame:
    """Candidates between different components; lists within one component have none."""
    groups = postings.groupBy("token", "component").agg(
        F.min("place").alias("place"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("asked").alias("asked")
    )
    groups = written(groups.join(groups.groupBy("token").count().filter("count > 1").drop("count"), "token"), "groups")
    left, right = (groups.select("token", *[F.col(c).alias(f"{c}_{x}") for c in groups.columns[1:]]) for x in "ab")
    # Some member of one may reach some member of the other: in the depth that the sizes most in favour allow.
    deep = F.lit(True)
    for x, y in ("ab", "ba"):
        needed = F.floor((percent * (F.col(f"most_{x}") + F.col(f"least_{y}")) + 99 + percent) / (100 + percent))
        deep &= F.col(f"place_{x}") < F.col(f"most_{x}") - needed + F.least("asked_a", "asked_b")
    same = left["token"] == right["token"]
    met = left.join(right, same & (F.col("component_a") < F.col("component_b")) & deep)
    met = met.select(left["token"], "component_a", "component_b")
    met = met.join(_side(postings, "a", ["token"]), ["token", "component_a"])
    met = met.join(_side(postings, "b", ["token"]), ["token", "component_b"]).filter(_possible(percent))
    return _candidates(met, percent)


def shingle_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``df``.

    Rows link when ``100 * shared >= percent * united`` of their sets of ``k``-word shingles; a row of
    fewer words has its whole sequence as one shingle. ``component_id`` is the least id reachable by
    links. Rows without words or text have no shingles and link with nothing, so their component is
    their own id. Rows that share an id are one document with several sets. Rows with a null id
    link with nothing and get a null component. An empty table gives an empty result; other columns
    of ``df`` are not read. Ids may be of any ordered type.
    """
    words.small_batches(df.sparkSession)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    spark: SparkSession = df.sparkSession
    counts = hashed_counts(texts, k)
    shared = spark.sparkContext.broadcast(tuple(np.minimum(c, 2**32 - 1).astype(np.uint32) for c in counts))
    schema = f"id {_kind(texts)}, n bigint, sig binary, asked int, prefix array<bigint>"
    documents = written(texts.mapInArrow(_prefixes(k, percent, shared), schema), "prefixes")
    shared.destroy()  # nothing reads the counts any more
    del counts
    trim()

    # Equal sets are one node, named by its least id; their prefixes are equal too.
    sets = documents.filter("n > 0 and id is not null").groupBy("sig").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "asked", "prefix")]
    )
    sets = written(sets, "sets")
    tokens = sets.select("id", "n", "asked", F.posexplode("prefix").alias("place", "token"))
    lists = written(tokens.groupBy("token").agg(F.count("*").alias("posted")).filter("posted > 1"), "lists")
    postings = bitmaps.marked(tokens, bitmaps.bitmap(lists.select("token"), 1 << 25), [F.col("token")], "often", 1 << 25)
    postings = written(postings.filter("often").drop("often"), "postings")

    links = written(_verified(written(_star_links(postings, lists, percent), "pairs"), sets, texts, k, percent), "links")
    joined = written(components(links), "components")
    postings = postings.join(joined.withColumnRenamed("node", "id"), "id", "left")
    postings = written(postings.withColumn("component", F.coalesce("component", "id")), "postings")
    more_links = written(_verified(written(open_links(postings, percent), "pairs"), sets, texts, k, percent), "links")

    # Every row of a set takes the component of the set; ids that name several sets join them.
    copies = sets.filter("copies > 1").select("sig", "copies", F.col("id").alias("named"))
    members = bitmaps.join_groups(documents.select("id", "n", "sig"), copies, ["sig"], "copies", F.col("id"))
    named = members.filter("named is not null and id != named").select(F.col("id").alias("a"), F.col("named").alias("b"))
    found = components(links.unionByName(more_links).unionByName(named))
    return (
        documents.select("id", F.col("n").alias("n_shingles"))
        .join(found.withColumnRenamed("node", "id"), "id", "left")
        .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    )


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The row with the least id of every component, with the columns of ``df``; null ids stay."""
    found = shingle_components(df, id_col, text_col, k, percent)
    return bitmaps.without(df, found.filter(f"`{id_col}` != component_id").select(f"`{id_col}`"), id_col)
