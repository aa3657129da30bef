"""Exact copies by progressive refinement: length, then a hash of the beginning, then the full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import bitmaps

HEAD_CHARS = 256


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD_CHARS) -> DataFrame:
    """Every row with ``keep_id``, ``group_size`` and ``kept``: the largest id of equal texts stays.

    Lengths that occur once are settled by counting lengths, beginnings that occur once among the
    rest by a hash of the first ``head`` characters; the full text is hashed only for groups that
    are left. Survivors are told from bounded bitmaps, so no text is shuffled unless the caller
    keeps the text column of rows in such groups. Large groups are salted where rows meet them.

    A null text counts as empty. Rows repeated under one id get one verdict. Null ids lose against
    any other id; a group of null ids alone keeps all its rows. An empty table gives an empty
    result. Input columns named like the three results are replaced.
    """
    names = [c for c in df.columns if c not in {"keep_id", "group_size", "kept"}]
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    length, start, full = F.octet_length(body), F.xxhash64(F.substring(body, 1, head)), F.sha2(body, 256)

    def shared(rows: DataFrame, *keys: Column) -> DataFrame:
        return rows.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).count().filter("count > 1").drop("count")

    df = df.select(*[f"`{c}`" for c in names])
    by_length = bitmaps.marked(df, bitmaps.bitmap(shared(df, length)), [length], "_xd_length")
    by_start = bitmaps.bitmap(shared(by_length.filter("_xd_length"), length, start))
    rows = bitmaps.marked(by_length, by_start, [length, start], "_xd_start")
    alone = rows.filter("not (_xd_length and _xd_start)").withColumns(
        {"keep_id": F.col(f"`{id_col}`"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    )
    left = rows.filter("_xd_length and _xd_start").withColumns({"_xd_n": length, "_xd_head": start, "_xd_full": full})
    keys = ["_xd_n", "_xd_head", "_xd_full"]
    groups = left.groupBy(*keys).agg(F.max(f"`{id_col}`").alias("keep_id"), F.count("*").alias("group_size"))
    left = bitmaps.join_groups(left, groups, keys, "group_size", F.col(f"`{id_col}`")).withColumn("kept", F.col(f"`{id_col}`").eqNullSafe(F.col("keep_id")))
    wanted = [*[f"`{c}`" for c in names], "keep_id", "group_size", "kept"]
    return alone.select(*wanted).unionByName(left.select(*wanted))


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``df``; rows repeated under one id stay as they are."""
    return exact_groups(df, id_col, text_col).filter("kept").select(*[f"`{c}`" for c in df.columns])
