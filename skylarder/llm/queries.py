"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylarder.llm import (
    best_fit,
    compact_windows,
    exact_dedup,
    filter_audit,
    html_templates,
    item_search,
    learned_partitions,
    line_dedup,
    log_bilinear,
    order_minhash,
    piece_codec,
    token_scan,
    toxicity,
)
from skylarder.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"), keep="largest")


@query
def op6_best_fit_packing(spark, sf):
    return best_fit.pack(best_fit.cut(table(spark, sf, "documents")))


@query
def op9_toxicity(spark, sf):
    return toxicity.scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op10_learned_partitions(spark, sf):
    return learned_partitions.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op5_log_bilinear(spark, sf):
    return log_bilinear.scores(table(spark, sf, "documents"))


@query
def op2_html_templates(spark, sf):
    return html_templates.extract(table(spark, sf, "pages"))


@query
def op7_order_minhash(spark, sf):
    return order_minhash.groups(table(spark, sf, "documents"))


@query
def op8_compact_windows(spark, sf):
    return compact_windows.repeats(table(spark, sf, "documents"))


@query
def op3_token_counts(spark, sf):
    return token_scan.counts(table(spark, sf, "documents"))


@query
def op4_piece_codec(spark, sf):
    return piece_codec.summary(table(spark, sf, "documents"))


@query
def op11_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op12_item_search(spark, sf):
    return item_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op13_line_dedup(spark, sf):
    return line_dedup.report(table(spark, sf, "documents"))
