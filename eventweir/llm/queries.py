"""The registered queries of this subpackage: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table, text_or_empty


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find

    return find(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_tree import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=35)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import format_chats, loss_text, read_back

    said = "\\### Assistant: </turn> ok"
    ids = spark.range(2)
    extra = ids.select(F.lit(-7).cast("bigint").alias("conv_id"), ids["id"].alias("turn"), F.when(ids["id"] == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(turns)
    read = chats.select("conv_id", "formatted", "attachments", read_back(F.col("formatted")).alias("turns"), loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_documents

    return identify_documents(table(spark, sf_dir, "documents")).select("doc_id", "lang", F.round("posterior", 6).alias("posterior"), "text_lang", "accepted")


def llm_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify_pages

    return identify_pages(table(spark, sf_dir, "pages")).select("page_id", "lang", F.round("posterior", 6).alias("posterior"), "text_lang", "accepted")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .unigram import encode

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .token_files import token_file_digests

    return token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_sort import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=200)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate

    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_substring_dedup, op3_chat_formatting, op4_language_id, llm_language_id_pages, op5_sentencepiece, op6_token_files, op7_simhash, op8_suffix_dedup, op9_exact_dedup, op10_decontamination)}


_ESC = r"replace(replace(replace({}, '\', '\s'), '<', '\l'), '>', '\g')"

ORACLES = {
    "op3_chat_formatting": rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum(length({_ESC.format('role')}) + length({_ESC.format('text')}) + 21) AS n FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, n::BIGINT AS formatted_chars FROM g""",
    "op2_substring_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
x AS (SELECT r, s, md5(array_to_string(w[s + 1:s + 35], ' ')) AS h FROM (SELECT r, w, unnest(range(0, len(w) - 34)) AS s FROM d)),
t AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY h) AS n FROM x) WHERE n > 1),
i AS (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s) AS k FROM (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 35 THEN 0 ELSE 1 END AS new FROM t)),
g AS (SELECT r, min(s) AS a, max(s) + 35 AS b FROM i GROUP BY r, k),
p AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM g),
c AS (SELECT r, sum(b - a) AS gone, max(b) AS last, list(before ORDER BY a) AS froms, list(a ORDER BY a) AS tos FROM p GROUP BY r),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(gone, 0) AS gone, CASE WHEN gone IS NULL THEN w ELSE flatten(list_transform(range(1, len(froms) + 1), lambda q: w[froms[q] + 1:tos[q]])) || w[last + 1:] END AS kept FROM d LEFT JOIN c USING (r))
SELECT doc_id, n::BIGINT AS n_words, gone::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""",
    "op8_suffix_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS w FROM documents),
x AS (SELECT r, s, md5(substr(w, 2 * s + 1, 400)) AS h FROM (SELECT r, w, unnest(range(0, length(w) // 2 - 199)) AS s FROM d)),
t AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY h) AS n FROM x) WHERE n > 1),
i AS (SELECT r, s, sum(new) OVER (PARTITION BY r ORDER BY s) AS k FROM (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 200 THEN 0 ELSE 1 END AS new FROM t)),
g AS (SELECT r, min(s) AS a, max(s) + 200 AS b FROM i GROUP BY r, k),
p AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM g),
c AS (SELECT p.r, count(*) AS spans, sum(b - a) AS gone, string_agg(substr(w, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || any_value(substr(w, 2 * last + 1)) AS kept FROM p JOIN (SELECT r, max(b) AS last FROM p GROUP BY r) USING (r) JOIN d USING (r) GROUP BY p.r)
SELECT doc_id, (length(w) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, w))) AS kept_sha256 FROM d LEFT JOIN c USING (r)""",
    "op9_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)""",
    "op10_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS x FROM (SELECT item, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT doc_id, m, s, array_to_string(w[s:s + m - 1], ' ') AS x FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, ms WHERE len(w) >= m)),
h AS (SELECT dw.doc_id, dw.s, dw.m, bw.item FROM dw JOIN bw ON dw.x = bw.x AND dw.m = bw.m),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT doc_id, s, m FROM h)) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(i.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    return {k: v.strip() for k, v in ORACLES.items()}
