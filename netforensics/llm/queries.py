"""Registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    best_position, bpe_codec, kneser_ney, merkle, minhash_join, packing, quality_rules, suffix_dedup, token_counts, warc, weak_quality, whitening, window_dedup,
)
from .common import documents, shared_folder, tokenizer_path


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(documents(spark, sf_dir, "doc_id", "text"))


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())


def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir, "doc_id", "text", "source"))


def weak_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(documents(spark, sf_dir, "doc_id", "text"))


def best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir, "doc_id", "text"), tokenizer_path())


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    captures = warc.with_revisits(pages, "page_id", "html")
    written = warc.write(captures, shared_folder(spark, "warc"), "page_id", "url", "html").collect()  # one row per archive
    paths = spark.createDataFrame(written, "path string, records long, bytes long").repartition(max(1, len(written)))
    rows = warc.transactions(warc.read(paths, with_payload=False))
    return rows.select(
        warc.note("metadata", "capture-key").cast("long").alias("page_id"),
        "response.payload_bytes",
        "response.payload_digest",
        F.col("response.kind").alias("record_type"),
        warc.note("metadata", "refers-to-key").cast("long").alias("refers_to"),
    )


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return kneser_ney.score(docs, kneser_ney.train(docs))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), width=4)


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_report(documents(spark, sf_dir, "doc_id", "text"))


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("seen")


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.digests(documents(spark, sf_dir, "doc_id", "text"))


REGISTRY = {
    "op1_suffix_dedup": repeats,
    "op2_bpe": bpe,
    "op3_token_counts": counts,
    "op4_host_rules": host_rules,
    "op5_weak_classifier": weak_classifier,
    "op6_minhash_join": near_duplicates,
    "op7_best_fit": best_fit,
    "op8_warc": archives,
    "op9_kneser_ney": language_model,
    "op10_merkle": edits,
    "op11_best_position": ranked_search,
    "op12_qdwh_whitening": whitened,
    "op13_window_dedup": repeated_windows,
}

SQL: dict[str, str] = {
    "op8_warc": """
        with d as (select page_id, coalesce(html, '') as html from pages),
        p as (select page_id, strlen(html) as payload_bytes, sha256(html) as payload_digest,
                     min(page_id) over (partition by sha256(html)) as head from d)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and head <> page_id then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and head <> page_id then head end as refers_to
        from p
    """,
    "op11_best_position": r"""
        with words as (
            select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
        tf as (select doc_id, term, count(*) as tf from words group by all),
        sizes as (select doc_id, sum(tf)::bigint as n from tf group by all),
        total as (select count(*) as docs, sum(n)::bigint as terms from sizes),
        df as (select term, count(*) as df from tf group by all),
        asked as (
            select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
        item as (select item_id, term, count(*) as times from asked group by all),
        weighted as (
            select item_id, term, times * floor(1000 * ln((2.0 * docs + 2) / (2.0 * df + 1)))::bigint as w
            from item join df using (term) cross join total),
        scored as (
            select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
            from weighted join tf using (term) join sizes using (doc_id) cross join total group by all),
        ranked as (
            select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
            from scored where score > 0)
        select item_id, rank, doc_id, score from ranked where rank <= 20
    """,
    "op13_window_dedup": r"""
        with words as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        starts as (select doc_id, w, unnest(range(1, len(w) - 33)) as s from words),
        windows as (select doc_id, s, hash(array_to_string(w[s : s + 34], ' ')) as h, array_to_string(w[s : s + 34], ' ') as t from starts),
        twice as (select t from windows group by t having count(*) > 1),
        gone as (select distinct doc_id, unnest(range(s, s + 35)) as place from windows semi join twice using (t)),
        lost as (select doc_id, list(place) as places from gone group by doc_id)
        select doc_id, len(w)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
               sha256(array_to_string(case when places is null then w else
                   [x for x, i in w if not list_contains(places, i)] end, ' ')) as kept_sha256
        from words left join lost using (doc_id)
    """,
}
