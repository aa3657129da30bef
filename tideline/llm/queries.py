"""The operators of this folder as queries over the given tables, and their DuckDB counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.llm import chunk_codec, conversation_trie, fill_middle, kmeans_tree, language_id, merkle, mincut_html, packing, pii, reply_trees
from tideline.llm.exact_dedup import exact_groups
from tideline.llm.fuzzy_lines import line_groups
from tideline.llm.jaccard_join import shingle_components

QUERIES = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stands in for the secret that a caller brings.
KEY = "key of the test queries"


@query
def op7_mincut_html(spark, sf):
    found = mincut_html.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_fuzzy_lines(spark, sf):
    return line_groups(table(spark, sf, "documents"))


@query
def op9_pii(spark, sf):
    return pii.pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), KEY)


@query
def op10_exact_dedup(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    body = F.coalesce("text", F.lit(""))
    return exact_groups(documents.withColumn("text_sha256", F.sha2(body, 256))).drop("text")


@query
def op1_language_id(spark, sf):
    documents = table(spark, sf, "documents")
    named = language_id.identify(documents.select("doc_id", "text"), language_id.learn(documents))
    return named.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")




@query
def op2_merkle(spark, sf):
    compared = merkle.compare_with_next(table(spark, sf, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def chained(turns):
    """Each turn a reply to the one before it in its conversation; turns of equal number go by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn("node", F.row_number().over(order))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return turns.select(F.col("conv_id").alias("tree"), "node", parent.alias("parent"), "role", "text")


@query
def op6_chat(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    planted = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = turns.unionByName(spark.createDataFrame(planted, turns.schema))
    out = reply_trees.conversations(chained(turns))
    back, spoken = reply_trees.parsed(F.col("formatted")), reply_trees.under_loss(F.col("formatted"), F.col("loss"))
    out = out.withColumns({"back": back, "spoken": spoken})
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("spoken").cast("long").alias("loss_chars"),
        F.sha2("spoken", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op3_packing(spark, sf):
    return packing.pack(packing.token_pieces(table(spark, sf, "documents"), TOKENIZER))


@query
def op5_bpe(spark, sf):
    coded = chunk_codec.encode_decode(table(spark, sf, "documents"), TOKENIZER)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op4_jaccard_join(spark, sf):
    return shingle_components(table(spark, sf, "documents"), k=3, percent=90)


@query
def op12_kmeans_tree(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return kmeans_tree.neighbours(vectors, vectors.filter("vec_id % 100 = 0"))


@query
def op13_fill_middle(spark, sf):
    made = fill_middle.fill_in_middle(table(spark, sf, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def rebuilt(paths):
    """Each conversation ``c`` with its first ``crc32(c) % 4`` turns taken from conversation ``c - c % 20``."""
    heads = paths.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("lead"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    both = paths.withColumns({"base": F.expr("conv_id - conv_id % 20"), "h": taken}).join(heads, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    lead = F.slice(F.coalesce("lead", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return both.select("conv_id", F.concat(lead, own).alias("turns"))


@query
def op11_conversation_trie(spark, sf):
    return conversation_trie.trie(rebuilt(conversation_trie.conversations(table(spark, sf, "conversations"))))


ORACLES = {
    "op11_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ),
        drawn AS (
            SELECT *, xor(CAST(4294967295 AS BIGINT), list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
                lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)),
                CAST(4294967295 AS BIGINT))) AS crc
            FROM turns
        ),
        rebuilt AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.crc % 4], a.turns[a.crc % 4 + 1:]) AS turns
            FROM drawn a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % 20
        ),
        prefixes AS (
            SELECT conv_id, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
        ),
        keyed AS (
            SELECT conv_id, total, depth, md5(CAST(to_json(turns[1:depth]) AS VARCHAR)) AS key,
                   CASE WHEN depth > 0 THEN md5(CAST(to_json(turns[1:depth - 1]) AS VARCHAR)) END AS parent,
                   CASE WHEN depth > 0 THEN len(regexp_extract_all(turns[depth].t, '[^ 	-
]+')) ELSE 0 END AS words
            FROM prefixes
        ),
        nodes AS (
            SELECT depth, key, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = total), '')) AS ends_sha256
            FROM keyed GROUP BY depth, key
        ),
        sized AS (
            SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.parent = n.key AND c.depth = n.depth + 1) AS n_children
            FROM nodes n LEFT JOIN nodes p ON p.key = n.parent AND p.depth = n.depth - 1
        ),
        below AS (
            SELECT DISTINCT a.depth, a.key, b.depth AS d, b.key AS k
            FROM keyed a JOIN keyed b ON a.conv_id = b.conv_id AND b.depth >= a.depth
        ),
        added AS (
            SELECT b.depth, b.key, sum((s.n_convs - 1) * s.words) AS saved_tokens, count(*) FILTER (s.n_children = 0) AS n_leaves
            FROM below b JOIN sized s ON s.depth = b.d AND s.key = b.k GROUP BY b.depth, b.key
        )
        SELECT s.conv_id, s.depth, s.parent_conv_id, s.n_convs, s.n_children, a.n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens,
               s.ends_sha256
        FROM sized s JOIN added a ON s.depth = a.depth AND s.key = a.key
    """,
    "op13_fill_middle": r"""
        WITH units AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS digest,
                   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS parts
            FROM documents
        ),
        drawn AS (
            SELECT *, len(parts) AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
                   ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4
            FROM units
        ),
        cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                        THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ),
        pieces AS (
            SELECT *, array_to_string(parts[1:a], '') AS prefix, array_to_string(parts[a + 1:b], '') AS middle,
                   array_to_string(parts[b + 1:], '') AS suffix
            FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM pieces
    """,
    "op6_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        marked AS (
            SELECT *, len(regexp_extract_all(text,
                '[<\[]\\*(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|/?s>|/?INST\]|/?SYS>>)')) AS marks
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(12 + length(role) + 1 + length(text) + marks + 10 + 1) AS BIGINT) AS formatted_chars
        FROM marked GROUP BY conv_id
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
