"""A corpus cleaned in five stages, each an operator of larkspur.llm on all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns the columns of `documents`; the last one adds
token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.bpe import encoded
from larkspur.llm.decontaminate import decontaminated
from larkspur.llm.jaccard import BROADCAST_IDS, Rule, jaccard_components
from larkspur.llm.queries import tokenizer_path
from larkspur.llm.secrets import redacted
from larkspur.llm.tables import bounded_batches, materialize, table
from larkspur.llm.toxicity import fit_machine, scored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    machine = fit_machine(docs, table(spark, sf_dir, "labels"))
    return scored(docs, machine, score_col="__score").where("__score < 0.5").drop("__score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id stays.

    Rows that share an id or have none, and are equal in text, count once too.
    """
    bounded_batches(spark)
    parts = jaccard_components(docs, rule=Rule(width=5, num=80, den=100))
    gone = materialize(parts.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    small = gone.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if small else gone, "doc_id", "left_anti").select(docs.columns)
    shared = materialize(parts.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("of")), "shared")
    if shared.isEmpty():
        return kept
    same = F.col("doc_id").eqNullSafe(F.col("of"))
    of_one, others = (kept.join(shared, same, how).select(docs.columns) for how in ("left_semi", "left_anti"))
    return others.union(of_one.dropDuplicates(["doc_id", "text"]))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by marks and n_chars follows."""
    bounded_batches(spark)
    out = redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with ids and n_tokens."""
    bounded_batches(spark)
    kept = tuple(c for c in docs.columns if c not in ("ids", "decoded", "n_tokens"))
    rows = encoded(docs, tokenizer_path(), keep=kept).drop("decoded")
    return rows.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]

#: SQL has no factorization machine, tiles, alignment or BPE; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
