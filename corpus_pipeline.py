"""Corpus pipeline: language ID, quality rules, near-duplicate removal, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and reread as the next stage's ``docs``. All but the last return the columns
of ``documents``. Null texts are rejected by the first stage (no letter), so
later stages see texts only; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rigcast.llm import jaccard, langid, packing, quality_rules
from rigcast.llm.common import add_columns, stage


def language(spark, docs, sf_dir):
    """Documents in a known language: texts without a letter, null and empty texts go.
    Where no row teaches a language, all texts with a letter stay."""
    model = langid.fit(langid.training_rows(docs, "doc_id", "text", "lang"))
    if not model.langs:
        return add_columns(docs, "text", "letter boolean", langid.letters).where("letter").select("row.*")
    return langid.predict(docs, model).where(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def quality(spark, docs, sf_dir):
    """Documents that the base rule and the weak-supervision posterior keep; empty
    texts have no words and go. Ids play no part, so null and repeated ones pass."""
    voted = stage(quality_rules.rule_votes(docs), "votes")
    return quality_rules.judge(voted, quality_rules.posteriors(voted)).where("kept").select("row.*")


def near_duplicates(spark, docs, sf_dir):
    """One row of each component of similar texts: the one with the smallest id, of
    these the one with the smallest text. Rows that repeat an id with other texts
    are judged each by its text; rows that repeat an id and its text are one
    document; rows without an id link with nothing and stay, once for each text."""
    # components of rows, not of ids: an id can have several texts
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = stage(jaccard.jaccard_components(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("_row")).alias("_row"), "text"), "_row")
                  .where("component_id is not null").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("comp")), "found")
    later = found.where("comp <> _row")
    members = later.union(later.select(F.col("comp").alias("_row"), "comp").distinct())
    named = stage(members.join(rows.select("_row", "doc_id"), "_row"), "members")
    least = stage(named.groupBy("comp", "doc_id").agg(F.count(F.lit(1)).alias("c"), F.min("_row").alias("_row"))
                  .groupBy("comp").agg(F.min(F.struct("doc_id", "c", "_row")).alias("m")).select("comp", "m.*"), "least")
    keep = least.where("c = 1").select("_row")
    if least.where("c > 1").limit(1).count():             # the smallest id repeated: its smallest text
        texts = named.join(least.where("c > 1").select("comp", "doc_id"), ["comp", "doc_id"], "left_semi").join(rows.select("_row", "text"), "_row")
        keep = keep.union(texts.groupBy("comp").agg(F.min(F.struct("text", "_row")).alias("m")).select("m._row"))
    # rows that repeat an id and its text: the first of them stays; only ids and digests are shuffled
    same = rows.groupBy("doc_id", F.md5("text").alias("digest"), F.length("text").alias("size")).agg(F.min("_row").alias("first"), F.count(F.lit(1)).alias("c"))
    twice = stage(same.where("c > 1"), "twice")
    repeats = rows.select("_row", "doc_id", F.md5("text").alias("digest"), F.length("text").alias("size")).alias("r").join(
        twice.alias("t"), F.expr("r.doc_id <=> t.doc_id and r.digest <=> t.digest and r.size <=> t.size and r._row > t.first"), "left_semi").select("_row")
    gone = stage(named.select("_row").join(keep, "_row", "left_anti").union(repeats).distinct(), "gone")
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def pack(spark, docs, sf_dir):
    """Pieces of the documents, packed into sequences of 4096 ids. Null and empty
    texts are their closing id; null and repeated ids are documents of their own."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language), ("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("packing", pack)]
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "documents")
    return STAGES[-1][1](spark, docs, sf_dir)
