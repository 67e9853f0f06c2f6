"""The registered queries of this subpackage: each applies one operator with its
production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm import (bpe_tree, edit_counts, edit_embedding, exact_dedup, filter_audit, license_diagonal, minhash_bayes,
                           packing, quality_sketch, substring_dedup, toxicity, warc_derivative, whitening)
from scorewell.llm.common import read


def _tokenizer(name: str) -> str:
    """Place of a public tokenizer file (installed alike on driver and executors)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, with their offending sentences' number and the worst one's
    place; rows whose id hash leaves 2 are held out of training."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~toxicity.held_out(F.col("doc_id")))
    out = toxicity.score(docs, model, spans=True)
    worst = F.get("sentences", F.lit(0))
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                      F.size("sentences").alias("n_offending"), worst["first"].alias("worst_first_byte"), worst["end"].alias("worst_end_byte"))


def _with_edits(docs: DataFrame) -> DataFrame:
    """Stand-in input: three edits per document (replace, insert, append)."""
    n = F.char_length(F.coalesce("text", F.lit("")))
    edit = lambda start, size, new: F.struct(
        start.cast("bigint").alias("start"), F.lit(size).cast("bigint").alias("n_delete"), new.alias("insert"))
    return docs.select("doc_id", "text", F.array(
        edit(F.floor(n / 3), 9, F.concat(F.lit(" "), F.coalesce("lang", F.lit("")), F.lit(" edited "))),
        edit(F.floor(2 * n / 3), 0, F.substring("text", 1, 40)),
        edit(n, 4, F.concat(F.lit("\n"), F.coalesce("source", F.lit(""))))).alias("edits"))


def op2_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after three edits each."""
    path = _tokenizer("byte_bpe_50k.json")
    trees = edit_counts.build_trees(_with_edits(read(spark, sf_dir, "documents")), path, edits="edits")
    return edit_counts.apply_edits(trees, path)


def _responses(pages: DataFrame) -> DataFrame:
    """Stand-in input: pages as WARC response records."""
    h = F.md5(F.concat_ws("|", F.col("page_id").cast("string"), F.col("url")))
    part = lambda a, n: F.substring(h, a, n)
    body = F.coalesce("html", F.lit(""))
    return pages.select(
        "page_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") % 10_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                 F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body).alias("http"))


def op10_warc_derivative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages."""
    return warc_derivative.derivatives(_responses(read(spark, sf_dir, "pages")), keep=["page_id"])


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 35 words removed from all documents."""
    return substring_dedup.dedup(read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return bpe_tree.encode_documents(read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), with_ids=False)


def op6_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on 2-word shingles."""
    return minhash_bayes.near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80).drop("th")


def op7_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edit_embedding.edited_fingerprints(read(spark, sf_dir, "documents"))


def op8_quality_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adaptive quality rules over all documents."""
    out = quality_sketch.quality_filter(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op9_license_diagonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return license_diagonal.license_scan(read(spark, sf_dir, "documents")).drop("spans")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sound embeddings projected on the first eight whitened components."""
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("bigint"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of five filters over all documents, per source."""
    return filter_audit.audit_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal without blanks, and the one that stays."""
    return exact_dedup.groups(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity_mil": op1_toxicity_mil,
    "op2_edit_token_counts": op2_edit_token_counts,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_bpe_tree": op5_bpe_tree,
    "op6_minhash_bayes": op6_minhash_bayes,
    "op7_edit_embedding": op7_edit_embedding,
    "op8_quality_sketch": op8_quality_sketch,
    "op9_license_diagonal": op9_license_diagonal,
    "op10_warc_derivative": op10_warc_derivative,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_filter_audit": op12_filter_audit,
    "op13_exact_dedup": op13_exact_dedup,
}

#: DuckDB SQL of the queries that SQL can express over whole tables
ORACLE: dict[str, str] = {
    "op3_suffix_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d),
s AS (SELECT r, i, word, CASE WHEN count(*) OVER win = 35 THEN string_agg(word, ' ') OVER win END AS passage FROM w
      WINDOW win AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
p AS (SELECT passage FROM s WHERE passage IS NOT NULL GROUP BY passage HAVING count(*) > 1),
c AS (SELECT r, i, word, max(CASE WHEN p.passage IS NOT NULL THEN 1 ELSE 0 END)
             OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
      FROM s LEFT JOIN p USING (passage)),
k AS (SELECT r, sum(gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '') AS kept FROM c GROUP BY r)
SELECT doc_id, len(ws) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)""",
    "op12_filter_audit": r"""
WITH l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS low FROM t),
f AS (SELECT w.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
        [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
         100 * len(regexp_extract_all(body, '[A-Z]')) > 5 * length(body), regexp_matches(body, '[#$%&*|]'),
         coalesce(coalesce(w.doc_id <> low, low IS NOT NULL), false)] AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic
      FROM f GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS line FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT part, array_to_string(list_transform(line, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, x.i AS step, line[x.i] AS letter,
        n, n_good, n_toxic, fails[line[x.i]] AS bad,
        list_bool_or(list_transform(list_slice(line, 1, x.i - 1), lambda k: fails[k])) IS NOT DISTINCT FROM true AS gone,
        len(list_filter(fails, lambda k: k)) AS n_bad
      FROM m, o, x),
r AS (SELECT part, filter_order, step, letter,
        coalesce(sum(n) FILTER (WHERE NOT bad AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE bad AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (WHERE bad AND gone), 0) AS redundant, coalesce(sum(n) FILTER (WHERE bad AND n_bad = 1), 0) AS unique_fails,
        coalesce(sum(n_good) FILTER (WHERE bad AND NOT gone), 0) AS good_lost,
        coalesce(sum(n_toxic) FILTER (WHERE bad AND NOT gone), 0) AS toxic_lost
      FROM s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r""",
    "op13_exact_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, length(coalesce(text, '')) AS n_chars,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body FROM documents),
g AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size FROM d
      WINDOW w AS (PARTITION BY body ORDER BY n_chars DESC, doc_id ASC NULLS LAST, rn))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM g""",
}
