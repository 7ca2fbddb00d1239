"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.llm import decontaminate, hidden_markov, line_dedup, mixing, near_dup, periodic_runs, quality_classifier, quality_rules, secrets, source_divergence, suffix_dedup, toxicity, warc
from almenara.llm.arrays import PIECE, column_bytes, document_blocks, join_words, words_of
from almenara.llm.samples import split_code
from almenara.llm.tables import text_bytes
from almenara.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back, revisits resolved."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", text_bytes("html").alias("payload"))
    marked = warc.mark_revisits(pages, "page_id", "payload")
    named = marked.select(
        warc.record_name("page_id").alias("record"),
        "url",
        "payload",
        F.when(F.col("_refers_to").isNotNull(), warc.record_name("_refers_to")).alias("refers"),
    )
    path = warc.write_warc(named, scratch_folder(spark, "warc"), "record", "url", "payload", "refers")
    records = warc.resolve_revisits(warc.read_warc(spark, path, payloads=False))
    kind = pages.schema["page_id"].dataType
    return records.select(
        warc.id_of(F.col("record_id")).cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.id_of(F.col("refers_to")).cast(kind).alias("refers_to"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    labels = _table(spark, sf_dir, "labels").where(split_code("doc_id", 3) != 1)
    scores = quality_classifier.quality_scores(_table(spark, sf_dir, "documents"), labels)
    return scores.select(
        F.col("_id").alias("doc_id"),
        (split_code("_id", 3) == 1).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate string of every document with its score; values as digests."""
    scanned = secrets.scan_secrets(_table(spark, sf_dir, "documents"))
    return scanned.select(
        F.col("_id").alias("doc_id"),
        F.col("_nth").alias("nth"),
        F.sha2("_value", 256).alias("value_sha256"),
        F.length("_value").alias("n_chars"),
        F.col("_score").alias("score"),
        F.col("_secret").alias("is_secret"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    leaks = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return leaks.select(
        F.col("_id").alias("doc_id"),
        F.col("_item").alias("item_id"),
        F.round("_cosine", 3).alias("cosine"),
        F.col("_share").alias("lcs_share"),
        F.col("_answer").alias("answer_share"),
        F.col("_word").alias("first_word"),
    )


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on 4-word shingles."""
    found = near_dup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=4)
    kept = F.col("_id").eqNullSafe(F.col("_component"))
    return found.select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"), kept.alias("kept"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition counts and verdict of every document."""
    judged = quality_rules.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col(f"_quality.{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated strings of 400 bytes."""
    cut = suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents"), with_bytes=False)
    return cut.select(F.col("_id").alias("doc_id"), F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_kept_sha256").alias("kept_sha256"), (F.col("_n_removed") > 0).alias("has_repeats"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(split_code("doc_id", 5) != 0)
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        (split_code("doc_id", 5) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        F.size("_offending").alias("n_offending"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a smaller id holds too."""
    done = line_dedup.line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.col("_kept_sha256").alias("kept_sha256"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of each source of each language from the others, and the terms that it holds more than the language."""
    found = source_divergence.source_divergence(_table(spark, sf_dir, "documents"))
    return found.select([F.col(f"_{n}").alias(n) for n in ("lang", "source", "part", "item", "value", "rank")])


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` with words joined by one blank; a tenth of the documents repeats words to its end.

    With h the crc32 of the id and g = h // 10, where h % 10 = 0 each of the n
    words i >= a = g % n becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """
    code = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", code.alias("_code"), text_bytes("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch["_text"])
            codes = batch["_code"].to_numpy()
            for first, last in document_blocks(offsets, PIECE):
                part, cuts = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
                starts, ends = words_of(part, cuts)
                edges = np.searchsorted(starts, cuts)
                n, code = np.diff(edges), codes[first:last]
                g = code // 10
                a = np.where(code % 10 == 0, g % np.maximum(n, 1), n)
                p = 1 + (n - a) // (3 + g % 8)
                at = np.arange(len(starts))
                a, p = np.repeat(edges[:-1] + a, n), np.repeat(p, n)
                text, cuts = join_words(part, starts, ends, np.where(at >= a, a + (at - a) % p, at), edges)
                texts = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(text)])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, last - first), texts], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text binary")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words of every document, and its text without the repeats."""
    found = periodic_runs.periodic_runs(repeat_tails(_table(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # runs come by start and period, so the first of equal ones stays
    best = F.reduce("_runs", none, lambda x, y: F.when(x.isNull() | (y.length * x.period > x.length * y.period), y).otherwise(x))
    listed = F.array_join(F.transform("_runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        F.col("_id").alias("doc_id"),
        F.size("_runs").cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.call_function("div", F.col("_best.length") * 1000, F.col("_best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("_collapsed", 256).alias("collapsed_sha256"),
    )


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learned from six sevenths of them."""
    scored = hidden_markov.language_scores(_table(spark, sf_dir, "documents"), split_code("doc_id", 7) != 2)
    names = {"_id": "doc_id", "_n_tokens": "n_tokens", "_n_known": "n_known", "_train_tokens": "train_tokens", "_base": "base_score", "_score": "score"}
    return scored.select((~F.col("_learn")).alias("held_out"), *(F.col(a).alias(b) for a, b in names.items()))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_near_dup": op5_near_dup,
    "op6_quality_rules": op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_mix_sources": op10_mix_sources,
    "op11_source_divergence": op11_source_divergence,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lm_score": op13_lm_score,
}
