"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from warnindex.llm import oracles
from warnindex.llm.common import held_out, table


def op1_warc_archives(spark, d):
    from warnindex.llm import warc

    manifest = warc.write_archives(table(spark, d, "pages"), warc.archive_folder(spark))
    return warc.read_archives(spark, manifest, with_payload=False).drop("url")


def op2_toxicity_ftrl(spark, d):
    from warnindex.llm import toxicity

    docs = table(spark, d, "documents").select("doc_id", "text")
    weights = toxicity.train(docs, table(spark, d, "labels"))
    s = toxicity.score(docs, weights)
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_quality_knn(spark, d):
    from warnindex.llm import quality

    docs = table(spark, d, "documents").select("doc_id", "text")
    s = quality.score(docs, quality.fit(docs, table(spark, d, "labels")))
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_embedding_near_dedup(spark, d):
    from warnindex.llm.embedding_dedup import near_duplicates

    return near_duplicates(table(spark, d, "embeddings"))[0]


def op5_mixing_budgets(spark, d):
    from warnindex.llm import mixing

    return mixing.copies(mixing.with_domain(table(spark, d, "documents")))


def op6_chat_format(spark, d):
    from warnindex.llm import chat

    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_chats(turns.unionByName(extra)))


def op7_secret_scan(spark, d):
    from warnindex.llm.secrets import scan, spans_text

    s = scan(table(spark, d, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long")
    return s.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(spans_text(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.array_sort(F.concat("base_spans", "entropy_spans"))).alias("spans"),
    )


def op8_benchmark_decontamination(spark, d):
    from warnindex.llm.decontaminate import find_leaks

    return find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op10_html_site_style_tree(spark, d):
    from warnindex.llm.html_extract import extract

    t = extract(table(spark, d, "pages").select("page_id", "url", "html"))
    return t.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_simhash_near_dedup(spark, d):
    from warnindex.llm.simhash_dedup import fingerprint_hex, simhash_components

    c = simhash_components(table(spark, d, "documents"), shingle=4, max_bits=4)
    return c.select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op11_hard_negatives(spark, d):
    from warnindex.llm.hard_negatives import hard_negatives

    v = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(v.filter(finite).select("vec_id", shifted.alias("label"), F.transform("e", lambda x: F.floor(x * 256.0)).alias("x"), (F.col("vec_id") % 50 == 0).alias("anchor")))


def op12_license_scan(spark, d):
    from warnindex.llm.licenses import license_links

    s = license_links(table(spark, d, "documents").select("doc_id", "text"))
    base, labels = F.filter("links", lambda x: x["phrase"]), lambda c: F.array_join(F.array_sort(F.array_distinct(c["label"])), ",")
    return s.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base["first"]).alias("first_word"), F.array_max(base["first"]).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("links")).alias("labels"), F.coalesce(F.array_max(F.col("links")["containment"]), F.lit(0.0)).alias("score"),
    )


def op13_phrase_collocations(spark, d):
    from warnindex.llm.collocations import collocations

    return collocations(table(spark, d, "documents").select("lang", "text"))


QUERIES = {
    "op1_warc_archives": op1_warc_archives,
    "op2_toxicity_ftrl": op2_toxicity_ftrl,
    "op3_quality_knn": op3_quality_knn,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_mixing_budgets": op5_mixing_budgets,
    "op6_chat_format": op6_chat_format,
    "op7_secret_scan": op7_secret_scan,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op10_html_site_style_tree": op10_html_site_style_tree,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_scan": op12_license_scan,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op1_warc_archives": oracles.WARC,
    "op4_embedding_near_dedup": oracles.EMBEDDINGS,
    "op5_mixing_budgets": oracles.MIX,
    "op6_chat_format": oracles.CHAT,
    "op7_secret_scan": oracles.SECRETS,
    "op11_hard_negatives": oracles.NEGATIVES,
    "op12_license_scan": oracles.LICENSES,
    "op13_phrase_collocations": oracles.COLLOCATIONS,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
