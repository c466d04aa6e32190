"""Driver queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourledger.llm.alignment import align_tokens
from hourledger.llm.arrow import held_out, to_learn_from
from hourledger.llm.bpe import encode_decode
from hourledger.llm.chat import conversation_digests, format_conversations, text_part
from hourledger.llm.decontaminate import contamination
from hourledger.llm.languages import fit_languages, identify
from hourledger.llm.lm import fit_lm, score_lm
from hourledger.llm.ngram_join import near_groups
from hourledger.llm.staging import scratch
from hourledger.llm.token_counts import count_tokens
from hourledger.llm.topk import top_k
from hourledger.llm.toxicity import fit_toxicity, score_toxicity
from hourledger.llm.url_filter import filter_urls
from hourledger.llm.warc import read_warc, resolve_revisits, write_warc
from hourledger.llm.whitening import whiten


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_lm(docs, fit_lm(docs.where(to_learn_from("doc_id", 10, 0))))
    return scored.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.where(to_learn_from("doc_id", 3, 1)))
    return identify(docs, model).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), digest=True)


#: A conversation whose texts look like the template.
TRICK = r"\### Assistant: </turn> ok"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trick = spark.createDataFrame([(-7, 0, "user", TRICK), (-7, 1, "assistant", TRICK)], rows.schema)
    messages = rows.unionAll(trick).withColumn("parts", F.array(text_part(F.col("text"))))
    return conversation_digests(format_conversations(messages))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), k=3, percent=90)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = fit_toxicity(docs, labels.where(to_learn_from("doc_id", 5, 0)))
    return score_toxicity(docs, index).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted", "evidence")


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is the quality of the document of the same number."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return filter_urls(table(spark, sf_dir, "pages"), labels, RULES)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), digest=True)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    records = read_warc(spark, folder, write_warc(table(spark, sf_dir, "pages"), folder))
    page = lambda c: F.col(c).cast("long")
    return resolve_revisits(records).select(page("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_score, op2_token_counts, op3_decontamination, op4_ngram_join, op5_url_filter, op6_language_id, op7_toxicity, op8_top_k, op9_bpe, op10_chat_format, op11_token_alignment, op12_whitening, op13_warc)
}

ORACLES: dict[str, str] = {
    "op3_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), iw AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, s, s + least(len(w), 13) - 1) AS win
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 11, 2))) AS s FROM b WHERE len(w) > 0)
        ), dw AS (
            SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS win
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
        ), hit AS (
            SELECT dw.doc_id, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win
        ), places AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id
        ), names AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)
    """,
    "op8_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op10_chat_format": r"""
        WITH m AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), e AS (
            SELECT *, length(regexp_replace(role, '[\\#<:\n]', 'xx', 'g')) + length(regexp_replace(text, '[\\#<:\n]', 'xx', 'g')) + 15 AS n FROM m
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(n) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op13_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS h FROM pages
        ), d AS (
            SELECT page_id, strlen(h) AS n, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS top FROM p
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS BIGINT), 1)), '') AS payload_digest,
            CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> top THEN top END AS refers_to
        FROM d
    """,
}
