"""One registered query for each operator of this subpackage."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .registry import ORACLES, QUERIES, register, table


def dated_list(hosts):
    """A list derived from the pages' own hosts: each domain blocked and allowed
    again, its ``/de`` pages blocked, half the hosts with entries of their own,
    on days taken from a digest."""
    from functools import reduce

    def day(c, at):
        return F.conv(F.substring(F.md5(F.encode(F.col(c), "UTF-8")), at, 2), 16, 10).cast("int") % 30

    d = hosts.select("d").distinct()
    own = hosts.filter(day("host", 5) % 2 == 0)
    parts = [d.select(F.col("d").alias("rule"), F.lit("block").alias("action"), day("d", 1).alias("day")),
             d.select("d", F.lit("allow"), day("d", 3)),
             d.select(F.concat("d", F.lit("/de")), F.lit("block"), day("d", 7)),
             own.select("host", F.lit("allow"), day("host", 1)), own.select("host", F.lit("block"), day("host", 3))]
    return reduce(lambda a, b: a.union(b), parts).select(
        "rule", "action", F.timestamp_add("DAY", "day", F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("since"))


@register("op5_url_lists", O.URL_VERDICTS)
def op5_url_lists(spark, sf_dir):
    """Operator 5: every page, fetched at the time of the event of its number,
    against a dated list derived from the pages' hosts."""
    from .url_lists import filter_captures, host_of

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("page_id"), F.col("ts").cast("timestamp").alias("fetched_at"))
    hosts = (pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
             .withColumn("d", F.substring_index("host", ".", -3)))
    out, p = filter_captures(pages.join(events, "page_id", "left"), dated_list(hosts))
    return out.select("page_id", F.col(f"{p}host").alias("host"), F.col(f"{p}verdict").alias("verdict"),
                      F.col(f"{p}rule").alias("rule"))


@register("op6_hilbert_shards")
def op6_hilbert_shards(spark, sf_dir):
    """Operator 6: all documents into 40 shards along source, language, size and id."""
    from .shards import hilbert_shards

    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = hilbert_shards(docs, ["source", "lang", "size", "doc_id"], 40, ["text_crc32", "doc_id", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@register(
    "op7_near_duplicates",
    O.SHINGLE_COMPONENTS + """
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, m.low) AS component_id,
  d.doc_id = least(d.doc_id, m.low) AS kept
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a) m USING (doc_id)
""")
def op7_near_duplicates(spark, sf_dir):
    """Operator 7 over all documents: set size, component and the kept one."""
    from .near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), "n_shingles", "component_id",
        (F.col("key") == F.col("component_id")).alias("kept"))


@register("op1_sentence_pieces")
def op1_sentence_pieces(spark, sf_dir):
    """Operator 1: all documents encoded and decoded again; tested against the
    SentencePiece library."""
    from .pieces import decode, encode, load_pieces, same_text

    pieces = load_pieces()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decode(encode(docs, pieces), pieces)
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"),
                      F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), same_text().alias("round_trip"))


@register("op2_language")
def op2_language(spark, sf_dir):
    """Operator 2: learned on the rows that are not held out, predicted for all."""
    from .language import fit, held_out, predict

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    out = predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register("op3_chat", O.MAXIMAL_CHATS)
def op3_chat(spark, sf_dir):
    """Operator 3: all conversations; the digest of each rendered segment."""
    from .chat import chat_segments

    return chat_segments(table(spark, sf_dir, "conversations")).select(
        "conv_id", "segment", "n_turns", "copies", F.sha2("chat", 256).alias("chat_sha256"))


@register("op4_secrets")
def op4_secrets(spark, sf_dir):
    """Operator 4 over all documents; tested against a plain statement of the contract."""
    from .secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


@register(
    "op8_benchmark_windows",
    O.BENCHMARK_WINDOWS + """
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(word.n, 0)::BIGINT AS n_hit,
  coalesce(item.n, 0)::BIGINT AS n_items, sha256(coalesce(item.items, '')) AS items_sha256,
  coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
""")
def op8_benchmark_windows(spark, sf_dir):
    """Operator 8: every document against every window of the benchmark."""
    from .decontaminate import covered, find_benchmark

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, p = find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_words, n_hit = F.col(f"{p}n_words"), covered(f"{p}spans")
    return out.select(
        "doc_id", n_words.alias("n_words"), n_hit.alias("n_hit"),
        F.size(f"{p}items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", f"{p}items"), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"))


@register("op9_fuzzy_lines")
def op9_fuzzy_lines(spark, sf_dir):
    """Operator 9 over all documents: the lines that go and the text that stays."""
    from .lines import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    before = F.size(F.split("text", "\n"))
    out, p = dedup_lines(docs, min_words=1, links="grams")
    gone = F.size(f"{p}removed")
    return out.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(
            F.when((gone > 0) & (F.col("text") == ""), gone).otherwise(before + gone)).cast("bigint").alias("n_lines"),
        gone.cast("bigint").alias("n_removed"), F.concat_ws(",", F.transform(f"{p}removed", lambda x: x.cast("string")))
        .alias("removed"), F.sha2(F.col("text"), 256).alias("text_sha256"))


@register(
    "op10_top_vectors",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 10
""")
def op10_top_vectors(spark, sf_dir):
    """Operator 10: the 10 best of every hundredth vector against all vectors."""
    from .metric_tree import quantised, top_k

    return top_k(quantised(table(spark, sf_dir, "embeddings")))


@register("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    """Operator 11: all documents encoded by both tokenizers and aligned; tested against
    the tokenizers' own ids and sets of common ends."""
    from .align import align_documents, load_tokenizers

    out = align_documents(table(spark, sf_dir, "documents"), load_tokenizers(), ["doc_id"], groups="sha256")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.col("groups").alias("groups_sha256"))


@register("op12_spelling_variants", O.SPELLING_VARIANTS)
def op12_spelling_variants(spark, sf_dir):
    """Operator 12: the words of all documents, one in 97 (document, word) pairs misspelled."""
    from .variants import spelling_variants, word_counts

    words = word_counts(table(spark, sf_dir, "documents"), drop=97, min_chars=5, min_count=3)
    return spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@register("op13_fingerprints")
def op13_fingerprints(spark, sf_dir):
    """Operator 13: every document, its edited text and the document after it."""
    from .fingerprints import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
