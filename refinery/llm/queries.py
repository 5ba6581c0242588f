"""The operators of this subpackage as queries over the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm import (
    alignment, bpe, decontaminate, itq, line_dedup, preferences, prefix_trie, quality, simhash, surrogates, token_counts, token_files, warc,
)
from refinery.llm.common import read_table, stored
from refinery.sinks.staging import new_folder

#: The key of the surrogates in the registered query; users keep one of their own secret.
SURROGATE_KEY = "registered query"
CONTEXT = 1_024


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.crc32(doc_id.cast("string")) % 4 == 2


def op1_itq_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.embedding_groups(read_table(spark, sf_dir, "embeddings"))


def op2_simhash_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op3_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preferences.swapped_answers(read_table(spark, sf_dir, "conversations"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return preferences.format_preferences(chosen, rejected, keep_unanswered=True).select(
        F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", "rejected",
        shown("chosen_spans").alias("chosen_spans"), shown("rejected_spans").alias("rejected_spans"),
    )


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_personal_data(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op6_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"doc": "doc_id", "item": "item_id"})


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(read_table(spark, sf_dir, "documents"), prefixes=True)
    kept = token_counts.fitting_prefix(counted, CONTEXT)
    return kept.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT).alias("over_limit"), "n_chars_kept", "prefix_tokens")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path)
    return token_files.read_token_files(spark, path, ids=False)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality.classify(docs, labels, held_out)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokenizers(read_table(spark, sf_dir, "documents"))[0]


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_itq_near_vectors, op2_simhash_near_documents, op3_preference_pairs, op4_bpe_round_trip, op5_surrogates,
        op6_benchmark_windows, op7_token_counts, op8_line_dedup, op9_token_files, op10_quality,
        op11_tokenizer_alignment, op12_prefix_trie, op13_warc,
    )
}

ORACLE_SQL = {
    "op3_preference_pairs": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
        ),
        answers AS (
            SELECT conv_id, turn AS last_turn, text AS answer FROM (
                SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS k
                FROM t WHERE role = 'assistant'
            ) WHERE k = 1
        ),
        c0 AS (SELECT conv_id, turn, role, text FROM t JOIN answers USING (conv_id) WHERE turn <= last_turn),
        r0 AS (
            SELECT conv_id, turn, role, text FROM t JOIN answers USING (conv_id) WHERE turn < last_turn
            UNION ALL
            SELECT a.conv_id, a.last_turn, 'assistant', b.answer
            FROM answers a JOIN answers b ON b.conv_id = xor(a.conv_id, 1)
        ),
        c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM c0),
        r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos FROM r0),
        chosen_keys AS (SELECT DISTINCT conv_id FROM c),
        met AS (
            SELECT conv_id, pos, coalesce(c.role = r.role AND c.text = r.text, false) AS same
            FROM c FULL JOIN r USING (conv_id, pos)
        ),
        cut AS (
            SELECT conv_id, coalesce(min(pos) FILTER (NOT same) - 1, max(pos)) AS n
            FROM met WHERE conv_id IN (FROM chosen_keys) GROUP BY conv_id
        ),
        shown AS (
            SELECT conv_id, side, pos, role, '<|' || role || '|>' || chr(10) AS head,
                   text || '<|end|>' || chr(10) AS body
            FROM (SELECT 'c' AS side, * FROM c UNION ALL SELECT 'r' AS side, * FROM r)
        ),
        placed AS (
            SELECT s.*, n, coalesce(sum(length(head) + length(body)) OVER (
                PARTITION BY s.conv_id, side, pos > n ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins
            FROM shown s JOIN cut USING (conv_id)
        )
        SELECT conv_id, n AS n_prompt_turns,
            coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (side = 'c' AND pos <= n), '') AS prompt,
            coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (side = 'c' AND pos > n), '') AS chosen,
            coalesce(string_agg(head || body, '' ORDER BY pos) FILTER (side = 'r' AND pos > n), '') AS rejected,
            coalesce(string_agg(CAST(begins AS VARCHAR) || '-' || CAST(begins + length(body) AS VARCHAR), ',' ORDER BY pos)
                FILTER (side = 'c' AND pos > n AND role = 'assistant'), '') AS chosen_spans,
            coalesce(string_agg(CAST(begins AS VARCHAR) || '-' || CAST(begins + length(body) AS VARCHAR), ',' ORDER BY pos)
                FILTER (side = 'r' AND pos > n AND role = 'assistant'), '') AS rejected_spans
        FROM placed GROUP BY conv_id, n
    """,
    "op12_prefix_trie": """
        WITH RECURSIVE crc_steps(n, k, c) AS (
            SELECT n, 0, n FROM range(256) AS r(n)
            UNION ALL
            SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8
        ),
        crc AS (SELECT list(c ORDER BY n) AS tab FROM crc_steps WHERE k = 8),
        t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        own AS (SELECT conv_id, list(struct_pack(r := role, x := text) ORDER BY pos) AS turns FROM t GROUP BY conv_id),
        cut AS (
            SELECT conv_id, turns, xor(list_reduce(
                list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                lambda a, b: xor(a >> 8, tab[CAST((xor(a, b) & 255) + 1 AS BIGINT)])), 4294967295) % 6 AS h
            FROM own, crc
        ),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns[1:h], []), c.turns[h + 1:]) AS turns
            FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
        ),
        members AS (
            SELECT conv_id, depth, turns[1:depth] AS node, len(turns) = depth AS ends
            FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
        ),
        nodes AS (
            SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
                CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * length(node[depth].x) END AS saved
            FROM members GROUP BY depth, node
        ),
        linked AS (
            SELECT n.*, p.conv_id AS parent_conv_id, p.node AS above
            FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
        ),
        kids AS (SELECT above, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
        counted AS (
            SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l LEFT JOIN kids k ON k.depth = l.depth AND k.above = l.node
        )
        SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
            count(*) FILTER (b.n_children = 0) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens, a.ends_sha256
        FROM counted a JOIN counted b ON b.depth >= a.depth AND b.node[1:a.depth] = a.node
        GROUP BY a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256
    """,
    # Five hexadecimal digits are four of base 32.
    "op13_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS kept FROM pages
        )
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
            list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(((CAST('0x' || substr(sha1(html), CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> kept THEN kept END AS refers_to
        FROM p
    """,
}


def run_stages(spark: SparkSession, stages, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each stage's rows, written and read again for the next one."""
    for name, stage in stages:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
