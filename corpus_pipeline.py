"""The corpus pipeline: what is toxic, repeated or secret goes, and the rest is packed.

Every stage but the last returns the columns of its documents. A stage of no rows passes none on;
null texts count as empty, null ids stay null, further columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm.ngram_join import similar_documents
from tidefeed.llm.packing import pack_documents
from tidefeed.llm.secret_scan import redacted, secrets
from tidefeed.llm.shared import row_id, same_row, staged, table
from tidefeed.llm.suffix_dedup import without_repeats
from tidefeed.llm.toxicity import toxicity


#: U+FFFD, and three noncharacters, which no text has, in its place.
REPLACEMENT, ASIDE = "\ufffd", "\uffff\ufffe\uffff"


def _with_text(docs: DataFrame, joined: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with another text, and its length where there is a column for it."""
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(text.alias("text"))
        elif name == "n_chars":
            columns.append(F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(docs[name])
    return joined.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of a half or more go. Rows of one id and text share their fate."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    toxic = scored.where("predicted = 1").select("doc_id", "version").distinct()
    return docs.join(toxic, same_row(docs, toxic), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that reach each other by links the one with the smallest id stays.

    Of repeated rows of one id and text one stays; rows without words all stay.
    """
    found = staged(similar_documents(docs), "similar")
    first = found.where("`group` IS NOT NULL").groupBy("group").agg(
        F.min(F.struct(row_id(), "version")).alias("first")
    )
    stay = F.struct(row_id(), "version")
    keep = staged(
        found.join(first, "group", "left")
        .where(F.col("group").isNull() | (stay == F.col("first")))
        .select("doc_id", "version", "n_shingles", "rows"),
        "kept",
    )
    once = keep.where("`rows` = 1 OR n_shingles = 0")
    kept = docs.join(once, same_row(docs, once), "left_semi")
    often = keep.where("`rows` > 1 AND n_shingles > 0")
    if not often.isEmpty():
        repeated = docs.join(often, same_row(docs, often), "left_semi")
        kept = kept.unionByName(repeated.dropDuplicates(["doc_id", "text"]))
    return kept


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that an earlier document has are cut out; characters that a cut leaves
    incomplete go with them, and documents of which nothing is left go too."""
    cut = without_repeats(docs).where("size(starts) > 0").select(
        "doc_id", "version", F.col("kept").alias("rest")
    )
    cut = staged(cut, "cut").dropDuplicates(["doc_id", "version"])
    joined = docs.join(cut, same_row(docs, cut), "left")
    # what a cut left incomplete becomes U+FFFD and goes; those of the text itself stand aside
    aside = F.replace(cut["rest"].cast("string"), F.lit(REPLACEMENT), F.lit(ASIDE))
    whole = F.replace(F.make_valid_utf8(aside), F.lit(REPLACEMENT), F.lit(""))
    rest = F.replace(whole, F.lit(ASIDE), F.lit(REPLACEMENT))
    left = joined.where(cut["rest"].isNull() | (F.octet_length(cut["rest"]) > 0))
    return _with_text(docs, left, F.when(cut["rest"].isNotNull(), rest).otherwise(docs["text"]))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced by a mark; all documents stay."""
    found = secrets(docs).where("size(spans) > 0").select("doc_id", "version", "spans")
    found = staged(found, "spans").dropDuplicates(["doc_id", "version"])
    joined = docs.join(found, same_row(docs, found), "left")
    masked = redacted(docs["text"].cast("string"), found["spans"])
    return _with_text(
        docs, joined, F.when(found["spans"].isNotNull(), masked).otherwise(docs["text"])
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its sequence and its place there."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Labels are learnt, tokens come from a vocabulary: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
