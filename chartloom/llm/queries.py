"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import (
    bpe,
    chat,
    fingerprints,
    html,
    linear,
    packing,
    pii,
    quality,
    search,
    simhash,
    suffix,
    toxicity,
    trie,
    vectors,
)

PROBE = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = [
        F.struct(F.lit(-7).cast("long"), F.lit(i).cast("long"), F.lit(role), F.lit(PROBE))
        for i, role in enumerate(("user", "assistant"))
    ]
    probe = spark.range(1).select(F.inline(F.array(*turns)).alias(*rows.columns))
    return chat.chat_digest(chat.format_chats(chat.rows_as_events(rows.unionByName(probe))))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(_table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode(docs, path, stored=True, decoded=True).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return linear.report(toxicity.score(docs, model), toxicity.THRESHOLD)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return linear.report(quality.score(docs, model), quality.THRESHOLD)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(_table(spark, sf_dir, "documents"), stored=True).select(
        "doc_id",
        "n_bytes",
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0)).alias(
            "n_removed"
        ),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.detect(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_html": op2_html,
    "op3_bpe": op3_bpe,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_vectors": op7_vectors,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_search": op12_search,
    "op13_pii": op13_pii,
}


def _escaped(text: str) -> str:
    """DuckDB SQL for a text with its control strings broken."""
    out = f"replace({text}, '\\', '\\\\')"
    for word in chat.CONTROL:
        out = f"replace({out}, '{word}', '{word[0]}\\{word[1:]}')"
    return out


ORACLES: dict[str, str] = {
    "op1_chat_formatting": f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{PROBE}'
    UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
        AS loss_sha256,
    sum(length({_escaped("role")}) + length({_escaped("text")}) + 8)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
""",
    # CRC-32 bit by bit: at every eighth step the next digit is mixed in.
    "op11_prefix_trie": """
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), coded AS (
    SELECT conv_id, turns, xor(list_reduce(range(8 * length(conv_id::VARCHAR)), lambda acc, i:
        (CASE WHEN (CASE WHEN i % 8 = 0 THEN xor(acc, ascii(substr(conv_id::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT)
                ELSE acc END) & 1 = 1
            THEN xor((CASE WHEN i % 8 = 0 THEN xor(acc, ascii(substr(conv_id::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT)
                ELSE acc END) >> 1, 3988292384)
            ELSE (CASE WHEN i % 8 = 0 THEN xor(acc, ascii(substr(conv_id::VARCHAR, (i // 8 + 1)::INT, 1))::BIGINT)
                ELSE acc END) >> 1 END), 4294967295::BIGINT), 4294967295) % 6 AS h
    FROM own
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM coded c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), members AS (
    SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
    SELECT depth, turns[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(n = depth) AS leaf,
        string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth) AS ends
    FROM members GROUP BY 1, 2
), above AS (
    SELECT prefix[1:d] AS top, leaf, depth = d + 1 AS child,
        (n_convs - 1) * coalesce(length(prefix[depth].text), 0) AS saved
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM nodes)
), totals AS (
    SELECT top, count(*) FILTER (child) AS n_children, count(*) FILTER (leaf) AS n_leaves,
        sum(saved)::BIGINT AS saved_tokens
    FROM above GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, t.n_children, t.n_leaves, t.saved_tokens,
    sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN totals t ON t.top = n.prefix
    LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
""",
    "op12_search": r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), asked AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ) GROUP BY ALL
), lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1
), corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM lengths
), tf AS (
    SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, corpus GROUP BY term, docs
), worth AS (
    SELECT doc_id, term,
        w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // all_terms))) AS worth
    FROM tf JOIN weights USING (term) JOIN lengths USING (doc_id), corpus
), scored AS (
    SELECT item_id, doc_id, sum(repeats * worth)::BIGINT AS score FROM asked JOIN worth USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 20
""",
}
