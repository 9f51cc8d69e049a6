"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retrocohort.llm.chat import Template, format_chats, read_chats
from retrocohort.llm.chat_repair import audits, damaged, repair
from retrocohort.llm.decontaminate import find_leaks
from retrocohort.llm.html_text import extract_pages
from retrocohort.llm.line_dedup import drop_repeated_blocks
from retrocohort.llm.mixing import mixture
from retrocohort.llm.near_dedup import NearDuplicates, near_duplicates
from retrocohort.llm.pii import Surrogates, replace_personal_data
from retrocohort.llm.quality import BASE, ledger, mask, passes
from retrocohort.llm.sharding import assign
from retrocohort.llm.texts import table
from retrocohort.llm.token_alignment import linked_documents
from retrocohort.llm.token_store import read_token_files, write_token_files
from retrocohort.llm.toxicity import toxicity
from retrocohort.staging import stage_path

#: A conversation whose texts hold control strings.
CONTROL_CHAT = """SELECT * FROM VALUES
    (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')
    AS t(conv_id, turn, role, text)"""


#: For the registered query alone, so that its result can be compared; elsewhere keys are secret.
SURROGATE_KEY = "surrogates"


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = read_chats(format_chats(rows.unionByName(spark.sql(CONTROL_CHAT))))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
        F.col("first_error").cast("long").alias("first_error"),
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents")).drop("source")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = stage_path(spark, "token_files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("failed")
    return ledger(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (failed.bitwiseAND(F.lit(mask(BASE))) != 0).alias("base_failed"),
        passes(failed).alias("kept"),
        "failed",
    )


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_blocks(table(spark, sf_dir, "documents"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDuplicates(shingle=3, percent=85))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), Surrogates(SURROGATE_KEY))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return linked_documents(table(spark, sf_dir, "documents"), *paths)


def structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return audits(repair(damaged(conversations)), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": chat_formatting,
    "op2_html_extraction": html_extraction,
    "op3_benchmark_leaks": benchmark_leaks,
    "op4_source_mixture": source_mixture,
    "op5_token_files": token_files,
    "op6_quality_rules": quality_rules,
    "op7_sharding": sharding,
    "op8_line_dedup": line_dedup,
    "op9_near_dedup": near_dedup,
    "op10_personal_data": personal_data,
    "op11_toxicity": toxic_documents,
    "op12_token_alignment": token_alignment,
    "op13_structure_repair": structure_repair,
}

_WORD = r"[^\x20\x09-\x0D]+"

# Control strings broken one after the other; none can arise from breaking another.
_ESCAPED = "replace({}, chr(92), chr(92) || chr(92))"
for _control in Template().controls:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}' || chr(92) || '{_control[1:]}')"

ORACLES: dict[str, str] = {
    "op1_chat_formatting": f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
    SELECT *, lag(role, 1, '') OVER same AS state, row_number() OVER same - 1 AS n,
        length({_ESCAPED.format('text')}) + CASE role
            WHEN 'system' THEN length('[SYS]  [/SYS].') WHEN 'user' THEN length('[INST]  [/INST] ')
            WHEN 'assistant' THEN length('[ANS]  </s>')
            ELSE length('[TURN] [TEXT]  [/TURN].') + length({_ESCAPED.format('role')}) END AS chars
    FROM turns WINDOW same AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(chars))::BIGINT AS formatted_chars,
    coalesce(
        min(n) FILTER (state || '>' || role NOT IN
            ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')),
        CASE WHEN arg_max(role, n) <> 'assistant' THEN count(*) END)::BIGINT AS first_error
FROM marked GROUP BY conv_id""",
    "op4_source_mixture": f"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS symbols
    FROM documents
), keyed AS (
    SELECT doc_id, source, size::BIGINT AS size,
        -ln((('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, ''))[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
            / ((1 + size)::DOUBLE / (1 + size + coalesce(symbols, 0))) AS key
    FROM sized
), ranked AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM keyed GROUP BY source
), remaining AS (
    SELECT *, 2 * source_size AS cap,
        sum(source_size) OVER () * 150 / 100.0::DOUBLE
            - coalesce(sum(2 * source_size) OVER (
                ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS words_left,
        sum(weight) OVER (
            ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
            AS weight_left
    FROM ranked
), planned AS (
    SELECT source, source_size, CASE WHEN cap * weight_left <= words_left * weight THEN cap::DOUBLE
        ELSE weight * max_by(words_left / weight_left, weight_left)
            FILTER (NOT cap * weight_left <= words_left * weight) OVER () END AS target
    FROM remaining
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM planned
), running AS (
    SELECT k.*, b.source_size, b.target, b.epochs, round(b.target - b.epochs * b.source_size)::BIGINT AS budget,
        coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
    (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken
FROM running""",
    "op6_quality_rules": f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
    FROM documents
), windows AS (
    SELECT row, unnest(generate_series(1, len(words) - 7)) AS i, words FROM texts WHERE len(words) >= 8
), repeated AS (
    SELECT row, i, count(*) OVER (PARTITION BY row, array_to_string(words[i:i + 7], ' ')) AS n FROM windows
), covered AS (
    SELECT row, sum(least(8, coalesce(following - i, 8))) AS n
    FROM (SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS following FROM repeated WHERE n > 1) GROUP BY row
), measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
    FROM texts LEFT JOIN covered c USING (row)
), failing AS (
    SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
        + 4 * (100 * n_symbols > 30 * n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
        + 16 * (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT)::BIGINT AS failed
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed
FROM failing""",
}
