"""The corpus pipeline: documents pass five stages, each over all that its predecessor kept.

Each stage calls one operator of the subpackage and lets its decision take effect. All but the last
return the columns of the documents they were given, whatever these are called; the last returns what
the encoder made of each text. Empty tables pass as empty tables.

- language: texts that are null, empty or without letters, or whose best language has a posterior
  below MIN_LANGUAGE_SCORE, go. The languages are learned from the stage's own rows.
- toxicity: texts that the nearest labelled examples call toxic go. A text that no example is near
  stays, so a table without labels, or none of the stage's rows labelled, rejects nothing.
- near duplicates: of each group linked by a similarity of 0.8 on five-word shingles the row with the
  smallest id stays, one row if several share id and text. Rows that share an id but have unrelated
  texts are of different groups. Texts without words, null ones and rows with a null id have no group
  and stay.
- decontamination: documents of which benchmark windows cover a twentieth or more go.
- encoding: every row gets its ids and the text they decode to, as digests, and their number.

Every stage bounds the bytes of the batches that the session's Python workers get: the workers and the
executor's buffers live on from stage to stage, and each would keep the room of the largest batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourledger.llm.arrow import bound_batches, to_learn_from
from hourledger.llm.bpe import encode_decode
from hourledger.llm.decontaminate import contamination
from hourledger.llm.languages import UNKNOWN, fit_languages, identify
from hourledger.llm.ngram_join import near_groups
from hourledger.llm.queries import table, tokenizer_path
from hourledger.llm.staging import scratch, staged
from hourledger.llm.toxicity import fit_toxicity, score_toxicity
from hourledger.operators.reduced import join_reduced

MIN_LANGUAGE_SCORE = 0.5
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
#: Stands before the names of the columns that a stage adds for itself.
OWN = "__stage_"


def keep_readable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_languages(docs.where(to_learn_from("doc_id", 3, 1)))
    judged = identify(docs, model, carry=docs.columns, prefix=OWN)
    return judged.where((F.col(f"{OWN}lang_pred") != UNKNOWN) & (F.col(f"{OWN}score") >= MIN_LANGUAGE_SCORE)).select(docs.columns)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(to_learn_from("doc_id", 5, 0))
    judged = score_toxicity(docs, fit_toxicity(docs, labels), carry=docs.columns, prefix=OWN)
    # A score without evidence is the prior, which says nothing of the text.
    caught = (F.col(f"{OWN}predicted") == 1) & (F.size(f"{OWN}evidence") > 0)
    return judged.where(~F.coalesce(caught, F.lit(False))).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A row is told by its id and its text, so that an unrelated text under the same id is another row.
    row, most = f"{OWN}row", f"{OWN}action"
    named = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id", "text").alias(row))
    groups = near_groups(named, SHINGLE_WORDS, SIMILARITY_PERCENT, id_col=row).where("n_shingles > 0")
    members = groups.groupBy(row).agg(F.first("component_id").alias("component"), F.count("*").alias("copies"))
    members = join_reduced(named.select(row, "doc_id").distinct(), members, [row], "inner")
    first = members.groupBy("component").agg(F.min(F.struct("doc_id", row)).alias("first"))
    judged = join_reduced(members, first, ["component"])
    action = F.when(F.col(row) != F.col(f"first.{row}"), F.lit("goes")).when(F.col("copies") > 1, F.lit("is one"))
    judged = judged.select(row, action.alias(most)).where(F.col(most).isNotNull())
    marked = join_reduced(docs.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))), judged, [row])
    kept = staged(marked.where(F.col(most).isNull() | (F.col(most) != "goes")), "kept")
    # Repeated rows differ in other columns at most: one of them stays.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    repeated = kept.where(F.col(most) == "is one").groupBy("doc_id", "text").agg(F.first(F.struct(F.lit(0).alias(row), *others)).alias(row))
    repeated = repeated.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"{row}.{c}") for c in docs.columns])
    return kept.where(F.col(most).isNull()).select(docs.columns).unionByName(repeated)


def keep_clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = contamination(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns, prefix=OWN)
    return judged.where(~F.col(f"{OWN}contaminated")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, tokenizer_path("word_bpe_49k.json"), digest=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_bounded_batches(stage: Stage) -> Stage:
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return bounded


STAGES: list[tuple[str, Stage]] = [
    ("language", in_bounded_batches(keep_readable)),
    ("toxicity", in_bounded_batches(keep_civil)),
    ("near_duplicates", in_bounded_batches(keep_one_of_each_group)),
    ("decontamination", in_bounded_batches(keep_clean_of_benchmarks)),
    ("encoding", in_bounded_batches(encode)),
]

#: Naive Bayes, nearest examples and merges are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "corpus")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
