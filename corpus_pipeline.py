"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.llm import common, decontam, neardup, packing, quality, secrets


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    common.arrow_rows(spark, 256)
    model = quality.learn(docs, common.table(spark, sf_dir, "labels"))
    score, predicted = common.fresh(docs.columns, "score", "predicted")
    return quality.scored(docs, model, into=(score, predicted)).where(F.col(predicted) == 1).drop(score, predicted)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id; rows without words belong to no group and stay.

    A row is known by its doc_id and its text, so that other texts of that doc_id, or of none, have a fate of their own.
    """
    columns = common.quoted(docs.columns)
    doc, text_a, text_b, n, a, b, whole = common.fresh(docs.columns, "id", "text_a", "text_b", "n", "a", "b", "row")
    scratch, key = common.Scratch(spark, "kept"), [doc, text_a, text_b]
    first = scratch.keep(neardup.first_rows(docs).toDF(*key, n), "kept")
    worded = docs.where(neardup.has_words()).select("*", *neardup.text_hashes(a, b))

    def met(some: DataFrame) -> DataFrame:
        same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(a) == F.col(text_a)) & (F.col(b) == F.col(text_b))
        return worded.join(some, same)

    out = docs.where(~neardup.has_words()).union(met(first.where(F.col(n) == 1)).select(*columns))
    again = first.where(F.col(n) > 1)
    if again.limit(1).count():  # rows equal in doc_id and text: the smallest by their other columns
        out = out.union(met(again).groupBy(*key).agg(F.min(F.struct(*columns)).alias(whole)).select(f"{whole}.*"))
    return out


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, which is a matter of their text alone."""
    key = common.fresh([*docs.columns, "item_id", "item_shingles", "shared", "containment"], "text_a", "text_b")
    hashed = docs.select("*", *neardup.text_hashes(*key))
    leaks = decontam.contaminated(hashed, common.table(spark, sf_dir, "benchmark"), keys=tuple(key)).select(*key).distinct()
    found = common.Scratch(spark, "leaks").keep(leaks, "leaks")
    return hashed.join(found, key, "left_anti").select(*common.quoted(docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked, and n_chars, where there is one, as the text then is."""
    spans, masked = common.fresh(docs.columns, "spans", "masked")
    found = secrets.scan(docs, into=spans)
    found = found.select("*", secrets.masked(F.col("text"), F.col(spans)).alias(masked))
    changed = {"text": F.col(masked)}
    if "n_chars" in docs.columns:
        length = F.length(masked).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars"))
    return found.select(*[changed[c].alias(c) if c in changed else q for c, q in zip(docs.columns, common.quoted(docs.columns))])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in training sequences."""
    common.arrow_rows(spark, 1000)
    return packing.pack(docs)


STAGES = [("quality", good), ("near_duplicates", unlike), ("decontamination", unleaked), ("secrets", without_secrets), ("packing", packed)]

#: A learned model, a graph walk and a vocabulary: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    scratch = common.Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
