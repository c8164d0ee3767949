"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged, staging_folder
from . import language, repair
from .alignment import align, with_link_counts
from .bpe import encode_decode
from .chat import format_chats, read_chats
from .common import id_text_crc
from .extraction import extract
from .lm import score
from .packing import pack
from .quality import COUNTS, quality
from .runs import find_runs
from .sharding import shard
from .simhash import near_duplicates
from .topk import top_k

PLANTED_CHAT = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents", "doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, distance=4)


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard(table(spark, sf_dir, "documents", "doc_id", "text"), 16)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    return placed.select("doc_id", "size", crc, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.learn(docs.where(id_text_crc("doc_id") % 4 != 2))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (id_text_crc("doc_id") % 4 == 2).alias("held_out"), "lang_pred", "score")


def op5_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_folder(spark)
    repair.write(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return repair.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_url_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).withColumn("n_chars", F.char_length("text").cast("long"))


def op7_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return found.select("doc_id", *COUNTS, "base_failed", "kept", "ratio")


def op8_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = score(docs, id_text_crc("doc_id") % 5 != 1)
    return found.select("doc_id", (id_text_crc("doc_id") % 5 == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"))
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten repeats some of its words to its end."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.floor(number / 10).alias("g"), F.when(number % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("w"))
    chosen = chosen.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rest = F.col("n") - F.col("a")
    chosen = chosen.withColumn("p", (1 + F.floor(rest / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest)
    words = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), repeated), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, words).otherwise(F.col("text")).alias("text"))


def op11_dyadic_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_planted_periods(table(spark, sf_dir, "documents", "doc_id", "text")))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.withColumn("best", best)
    length = -F.col("best.shorter")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.shorter) div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_schema_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_CHAT).alias("text"))
    records = rows.unionByName(planted).select("conv_id", F.to_variant_object(F.struct("turn", "role", "text")).alias("record"))
    found = read_chats(format_chats(records))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_fragment_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents", "doc_id", "text"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    found = with_link_counts(staged(aligned.withColumn("groups", digest), compression="zstd"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_curve_packing": op1_curve_packing,
    "op2_simhash_gray": op2_simhash_gray,
    "op3_sampled_splitters": op3_sampled_splitters,
    "op4_language_bitmask": op4_language_bitmask,
    "op5_repair_ids": op5_repair_ids,
    "op6_url_differencing": op6_url_differencing,
    "op7_target_ratio": op7_target_ratio,
    "op8_norm_buckets": op8_norm_buckets,
    "op9_deleted_interpolation": op9_deleted_interpolation,
    "op10_speculative_bpe": op10_speculative_bpe,
    "op11_dyadic_squares": op11_dyadic_squares,
    "op12_schema_fingerprints": op12_schema_fingerprints,
    "op13_fragment_monoid": op13_fragment_monoid,
}

ORACLES: dict[str, str] = {
    "op8_norm_buckets": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), p AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    # formatted: 14 characters of marks a turn, and one for each character that is broken by a backslash
    "op12_schema_fingerprints": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), s AS (
            SELECT *, role || text AS joined,
                list_sum(list_transform(regexp_extract_all(role, '#+'), lambda x: greatest(length(x) - 2, 0))) AS role_marks,
                list_sum(list_transform(regexp_extract_all(text, '#+'), lambda x: greatest(length(x) - 2, 0))) AS text_marks,
                length(role) + length(text) + 14 + length(joined) - length(replace(joined, '\', '')) + length(role) - length(replace(role, chr(10), ''))
                + (length(role) - length(replace(role, '</turn>', ''))) // 7 + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS chars
            FROM r
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars + coalesce(role_marks, 0) + coalesce(text_marks, 0)) AS BIGINT) AS formatted_chars
        FROM s GROUP BY conv_id
    """,
}
