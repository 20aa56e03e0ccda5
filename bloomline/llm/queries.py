"""Registered queries of the pipeline operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from bloomline.llm import (
    decontamination, licenses, lm_scoring, packing, periodic_runs, prefix_trie, quality_classifier, quality_rules, simhash, substring_dedup,
    suffix_dedup, token_counts, url_filters,
)
from bloomline.llm.shipping import ship
from bloomline.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Url rules (host, path, verdict), and hosts of the plain list that no rule names.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
LISTED_HOSTS = [f"{name}.example.{end}" for name in ("cheap-pills", "spam-farm", "casino-win") for end in ("com", "net", "org")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"))


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_license_scan", licenses.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def url_rules(spark: SparkSession) -> DataFrame:
    rows = [(*r, True) for r in URL_RULES] + [(h, "/", "block", False) for h in LISTED_HOSTS]
    return spark.createDataFrame(rows, "host string, path string, verdict string, named boolean")


def url_sql() -> str:
    ordered = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda host, path: f"((host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '{path}'))"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in ordered)
    verdict = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in ordered)
    listed = " OR ".join(fits(h, "/") for h in LISTED_HOSTS)
    return f"""
WITH parts AS (SELECT page_id,
  coalesce(translate(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)', 1), '{licenses.UPPER}', '{licenses.LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '(?s)\\A.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, CASE {rule} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict FROM ruled"""


@query("op7_url_filter", url_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), url_rules(spark))


@query("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "n_words", "source_id", "class_id")


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontamination.items_digest(F.col("items")).alias("items_sha256"),
                        "contaminated")


@query("op11_prefix_trie", prefix_trie.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(prefix_trie.encode_turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.shared_sequences(turns)).drop("key")


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.looped(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), periodic_runs.strongest(F.col("runs")).alias("best"),
                        periodic_runs.runs_text(F.col("runs")).alias("lines"), "collapsed").select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op13_suffix_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
