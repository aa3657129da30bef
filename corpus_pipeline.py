"""The corpus pipeline: each stage reads what the one before it has written.

Documents keep their columns up to the last stage, which returns the packed pieces. A null or empty
text, or one without a letter, leaves at the first stage; an empty table gives an empty result.
"""

from pyspark.sql import functions as F

from tideline.llm import jaccard_join, language_id, packing, pii, queries
from tideline.llm.exact_dedup import drop_copies
from tideline.session import written

#: Least probability of the likeliest language; texts of mixed languages stay.
LEAST_SCORE = 0.3
#: Words that a Python worker of the last stage remembers: workers there still hold what earlier stages needed.
MOST_WORDS = 40_000


def identified(spark, docs, sf_dir):
    """Documents that are in one of the learned languages; without labelled rows all with a letter stay."""
    model = language_id.learn(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    named = language_id.identify(docs, model)
    kept = named.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def without_copies(spark, docs, sf_dir):
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def without_near_copies(spark, docs, sf_dir):
    """Of documents linked by 80 % of their five-word shingles the one with the least id."""
    return jaccard_join.one_per_component(docs, k=5, percent=80)


def pseudonymous(spark, docs, sf_dir):
    """Texts with personal data replaced; their ``n_chars`` is that of the new text."""
    new = pii.pseudonymise(docs, queries.KEY)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        new = new.withColumn("n_chars", F.when(F.col("n_replaced") > 0, length).otherwise(F.col("n_chars")))
    return new.select(*[f"`{c}`" for c in docs.columns])


def packed(spark, docs, sf_dir):
    """Token pieces of the documents and their places in sequences."""
    return packing.pack(packing.token_pieces(docs, queries.TOKENIZER, most_words=MOST_WORDS))


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("pii", pseudonymous),
    ("packing", packed),
]

#: A trained network, shingle hashes and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
