"""Prefix trie of conversations, built as a burst trie.

A conversation is the sequence of its turns' 16-byte ids, one binary value, so that a prefix is a
substring and byte order is trie order. Equal sequences are one row with a count. All rows begin in
one container under the root. A container with too many rows or turns bursts: below the prefix that
all its rows share, each next turn id heads a container of its own, and rows that end there are
kept with the node. Containers that are small enough are sorted and swept into nodes, each alone;
the nodes above them are added up from the containers' heads. Every round only deals rows of
containers that are too large, and texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm import bitmaps
from tideline.session import written

#: Bytes of a turn id.
ID = 16
#: Distinct sequences, and turns below the head, that a container holds before it bursts.
MOST_ROWS, MOST_TURNS = 256, 65_536
#: Conversation ids of one piece of a list of members.
PIECE = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart: of the SHA-256 of role and text, with the length of the role before it."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text), 256), 1, 2 * ID))


def conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, turns``: each conversation's turns as an array of ``(id, words)``, in order of ``turn``, null first.

    Null roles and texts are empty. Turns of equal number go by their ids; a repeated row is a turn of its own. Rows
    without a conversation id are left out. A conversation's ids meet in one row, 24 bytes a turn, without its texts.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")
    rows = turns.filter(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), turn_id(role, text).alias("id"), words.alias("words")
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id", "words")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def _hash_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, a sequence after the other, to one row a sequence; a list of members is never held whole."""
    columns = ("path", "words", "n", "least", "ends")
    open_, out = None, []

    def closed():
        path, words, n, least, digest = open_
        return path, words, n, least, digest.hexdigest()

    for batch in batches:
        for path, words, n, least, ids in zip(*[batch.column(c).to_pylist() for c in ("path", "words", "n", "least", "ids")]):
            if open_ is not None and open_[0] == path:
                open_[2] += n
                open_[4].update(b"," + ids.encode())
                continue
            if open_ is not None:
                out.append(closed())
            open_ = [path, words, n, least, hashlib.sha256(ids.encode())]
        yield _batch(out, columns)
        out = []
    if open_ is not None:
        yield _batch([closed()], columns)


_TYPES = {
    "path": pa.binary(), "words": pa.list_(pa.int64()), "ends": pa.string(), "is_head": pa.bool_(),
}


def _batch(rows: list[tuple], columns: tuple[str, ...]) -> pa.RecordBatch:
    values = zip(*rows) if rows else [()] * len(columns)
    arrays = [pa.array(list(v), _TYPES.get(c, pa.int64())) for c, v in zip(columns, values)]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def sequences(paths: DataFrame) -> DataFrame:
    """Distinct sequences of ``conv_id, turns``: ``path, words, n, least, ends``, with a hash of all their members.

    Members meet in pieces by ranges of ``PIECE`` ids, so that many copies of one conversation are spread; only the
    pieces' joined ids go through one task, in order, as a hash of the whole list needs.
    """
    rows = paths.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")).alias("path"),
        F.col("turns.words").alias("words"),
        F.floor(F.col("conv_id") / PIECE).alias("piece"),
    )
    pieces = rows.groupBy("path", "piece").agg(
        F.first("words").alias("words"),
        F.count("*").alias("n"),
        F.min("conv_id").alias("least"),
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
    )
    ordered = pieces.repartition("path").sortWithinPartitions("path", "piece")
    schema = "path binary, words array<bigint>, n bigint, least bigint, ends string"
    return ordered.select("path", "words", "n", "least", "ids").mapInArrow(_hash_members, schema)


def _depth(path: str = "path") -> Column:
    return F.floor(F.octet_length(path) / ID).cast("int")


def _prefix(path: str, depth: Column) -> Column:
    """The first ``depth`` turn ids of a path."""
    return F.substring(F.col(path), F.lit(1), (depth * ID).cast("int"))


def burst(rows: DataFrame, most_rows: int = MOST_ROWS, most_turns: int = MOST_TURNS) -> tuple[DataFrame, DataFrame]:
    """Sequences in containers, with the depth of their ``head``, and those that end at a node above all containers."""
    active = written(rows.withColumn("head", F.lit(0)), "trie")
    settled, ended = [], []
    while True:
        keyed = active.withColumn("key", _prefix("path", F.col("head")))
        sizes = keyed.groupBy("key").agg(
            F.count("*").alias("rows"),
            F.sum(_depth() - F.col("head")).alias("turns"),
            F.min("path").alias("lowest"),
            F.max("path").alias("highest"),
        )
        large = sizes.filter((F.col("rows") > 1) & ((F.col("rows") > most_rows) | (F.col("turns") > most_turns)))
        # What the least and the greatest path share, all share; equal prefixes are counted up to the first difference.
        shortest = F.least(_depth("lowest"), _depth("highest"))
        shared = F.size(
            F.filter(
                F.sequence(F.lit(0), shortest),
                lambda d: _prefix("lowest", d) == _prefix("highest", d),
            )
        )
        large = written(large.select("key", "rows", (shared - 1).alias("at")), "burst")
        if large.isEmpty():
            settled.append(active)
            break
        dealt = bitmaps.join_groups(keyed, large, ["key"], "rows", F.xxhash64("path")).drop("key", "rows")
        dealt = written(dealt, "trie")
        settled.append(dealt.filter("at is null").drop("at"))
        ended.append(dealt.filter(_depth() == F.col("at")).drop("at", "head"))
        active = dealt.filter(_depth() > F.col("at")).withColumn("head", F.col("at") + 1).drop("at")
    none = active.drop("head").limit(0)
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, ended, none)


_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
_SWEPT = (*_NODE, "is_head", "path", "words")


def _swept(rows: list[tuple]) -> list[tuple]:
    """Nodes of one container from its rows ``(head, path, words, n, least, ends)`` in order of path; its head comes first."""
    head = rows[0][0]
    # A node: depth, least, members, children, leaves, saved, ends, parent
    nodes = [[head, rows[0][4], 0, 0, 0, 0, NO_ENDS, -1, rows[0][2][head - 1] if head else 0]]
    open_, last = [0], b""
    for _, path, words, n, least, ends in rows:
        depth, same = len(path) // ID, head
        while same < min(depth, len(last) // ID) and path[same * ID : same * ID + ID] == last[same * ID : same * ID + ID]:
            same += 1
        del open_[same - head + 1 :]
        for d in range(same, depth):
            nodes[open_[-1]][3] += 1
            nodes.append([d + 1, least, 0, 0, 0, 0, NO_ENDS, open_[-1], words[d]])
            open_.append(len(nodes) - 1)
        for at in open_:
            nodes[at][1] = min(nodes[at][1], least)
            nodes[at][2] += n
        nodes[open_[-1]][6] = ends
        last = path
    for node in reversed(nodes):  # children come after their parents
        node[4] = node[4] or 1
        node[5] += (node[2] - 1) * node[8]
        if node[7] >= 0:
            nodes[node[7]][4] += node[4]
            nodes[node[7]][5] += node[5]
    out = []
    for i, (depth, least, n, children, leaves, saved, ends, parent, _) in enumerate(nodes):
        above = nodes[parent][1] if i else None
        first = (True, rows[0][1][: head * ID], rows[0][2][:head]) if not i else (False, None, None)
        out.append((least, depth, above, n, children, leaves, saved, ends, *first))
    return out


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, key = [], None
    for batch in batches:
        out = []
        for row in zip(*[batch.column(c).to_pylist() for c in ("head", "path", "words", "n", "least", "ends")]):
            of = row[0], row[1][: row[0] * ID]
            if held and of != key:
                out += _swept(held)
                held = []
            key = of
            held.append(row)
        yield _batch(out, _SWEPT)
    if held:
        yield _batch(_swept(held), _SWEPT)


def trie(paths: DataFrame, most_rows: int = MOST_ROWS, most_turns: int = MOST_TURNS) -> DataFrame:
    """Nodes of the prefix trie of ``conv_id, turns`` (see :func:`conversations`), one row each, the root included.

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's (root: null), ``n_convs`` counts members,
    ``n_children`` children, ``n_leaves`` childless nodes of the subtree, ``saved_tokens`` adds up (members - 1) times
    the words of the last turn over the subtree, ``ends_sha256`` is the hash of the ids, ascending, of the
    conversations that end there. Conversations without turns end at the root. Without conversations there are no nodes.
    ``most_rows`` and ``most_turns`` only say how finely the work is cut, not what comes out.
    """
    containers, ended = burst(sequences(paths), most_rows, most_turns)
    ordered = containers.withColumn("key", _prefix("path", F.col("head"))).repartition("key").sortWithinPartitions("key", "path")
    nodes = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string"
    schema = f"{nodes}, is_head boolean, path binary, words array<bigint>"
    swept = written(ordered.select("head", "path", "words", "n", "least", "ends").mapInArrow(_sweep, schema), "trie-nodes")
    heads = swept.filter("is_head")

    # Members, leaves and savings below the containers' heads go to every node above them.
    below = heads.select("path", "words", "n_convs", F.col("conv_id").alias("least"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"))
    above = below.filter(_depth() > 0).select("*", F.explode(F.sequence(F.lit(0), _depth() - 1)).alias("d"))
    at_end = ended.select("path", "words", F.col("n").alias("n_convs"), "least", F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"), "ends")
    at_end = at_end.select("*", F.explode(F.sequence(F.lit(0), _depth())).alias("d"))
    at_end = at_end.withColumn("ends", F.when(F.col("d") == _depth(), F.col("ends")))
    parts = above.unionByName(at_end).withColumn("node", _prefix("path", F.col("d")))
    upper = parts.groupBy("node").agg(
        F.sum("n_convs").alias("n_convs"),
        F.min("least").alias("conv_id"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_below"),
        F.max("ends").alias("ends"),
        F.first(F.when(F.col("d") > 0, F.try_element_at("words", F.col("d"))), ignorenulls=True).alias("words"),
    )
    upper = written(upper.withColumnRenamed("node", "path"), "trie-upper")
    own = (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))
    ways = upper.select("path", own.alias("own"), F.explode(F.sequence(F.lit(0), _depth())).alias("d"))
    ways = ways.select(_prefix("path", F.col("d")).alias("path"), "own", (F.col("d") == _depth() - 1).cast("long").alias("child"))
    ways = ways.unionByName(heads.filter(_depth() > 0).select(_prefix("path", _depth() - 1).alias("path"), F.lit(0).cast("long").alias("own"), F.lit(1).cast("long").alias("child")))
    totals = ways.groupBy("path").agg(F.sum("own").alias("saved_own"), F.sum("child").alias("n_children"))
    upper = upper.join(totals, "path").select(
        "conv_id",
        _depth().cast("long").alias("depth"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("saved_below") + F.col("saved_own")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
        "path",
    )
    upper = written(upper, "trie-upper")

    # Nodes whose parent lies above the containers learn its least member; a parent may have any number of children.
    waiting = heads.drop("parent_conv_id", "is_head", "words").unionByName(upper)
    waiting = waiting.withColumn("parent", F.when(F.col("depth") > 0, _prefix("path", _depth() - 1)))
    parents = upper.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_of_parent"))
    known = bitmaps.join_groups(waiting, parents, ["parent"], "n_of_parent", F.xxhash64("path"))
    inner = swept.filter("not is_head").select(*_NODE)
    return known.select(*_NODE).unionByName(inner).withColumnRenamed("ends", "ends_sha256")
