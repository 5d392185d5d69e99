"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from salescast.llm import bpe, chaining, chat, exact, hmm, lattice, mixing, periodic, quality, simhash, spelling, toxicity, warc
from salescast.llm.common import WORD

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op6_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.windows(given.union(extra)))


def op7_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.runs(table(spark, sf_dir, "documents"), plant=True)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pareto_mix": op1_pareto_mix,
    "op2_simhash": op2_simhash,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_bpe": op4_bpe,
    "op5_hmm": op5_hmm,
    "op6_chat_windows": op6_chat_windows,
    "op7_lattice": op7_lattice,
    "op8_toxicity": op8_toxicity,
    "op9_chaining": op9_chaining,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling": op12_spelling,
    "op13_warc": op13_warc,
}



def _escaped(x: str) -> str:
    """SQL for the length of an escaped text: a backslash for each backslash and for each control string."""
    marks = ("\\", "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    return f"(length({x}) + " + " + ".join(f"(length({x}) - length(replace({x}, '{m}', ''))) // {len(m)}" for m in marks) + ")"


ORACLE: dict[str, str] = {
    "op6_chat_windows": f"""
        WITH turns AS (
          SELECT conv_id AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
            len(regexp_extract_all(coalesce(text, ''), '{WORD}')) + {chat.EXTRA} AS n
          FROM (SELECT conv_id, turn, role, text FROM conversations
                UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
                UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        summed AS (
          SELECT *, sum(n) OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) - n AS before,
            row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS place FROM turns),
        systems AS (SELECT conv, arg_min({{'turn': turn, 'text': text, 'n': n}}, place) AS s FROM summed WHERE role = 'system' GROUP BY conv),
        placed AS (
          SELECT t.*, s, greatest(({chat.BUDGET} - {chat.HISTORY} - coalesce(s.n, 0)) // 2, 64) AS stretch,
            before // greatest(({chat.BUDGET} - {chat.HISTORY} - coalesce(s.n, 0)) // 2, 64) AS span
          FROM summed t LEFT JOIN systems y ON t.conv = y.conv),
        ended AS (SELECT *, max(before + n) OVER (PARTITION BY conv, span) AS stop FROM placed),
        shown AS (
          SELECT conv, span, role, turn, text, s FROM placed
          UNION ALL
          SELECT conv, stop // stretch, role, turn, text, s FROM ended e
          WHERE stop - before <= {chat.HISTORY} AND stop // stretch > span
            AND EXISTS (SELECT 1 FROM placed p WHERE p.conv = e.conv AND p.span = e.stop // e.stretch)),
        windows AS (
          SELECT conv, span, sum({len(chat.TURN) + 1 + len(chat.END)} + {_escaped('role')} + length(role) - length(replace(role, chr(10), ''))
              + {_escaped('text')}) + any_value(CASE WHEN s IS NULL THEN 0 ELSE {len(chat.TURN) + 7 + len(chat.END)} + {_escaped('s.text')} END)
              * (CASE WHEN bool_or(role = 'system' AND turn = s.turn AND text = s.text) THEN 0 ELSE 1 END) AS chars
          FROM shown GROUP BY conv, span)
        SELECT t.conv AS conv_id, count(*) AS n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
          CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
          CAST(any_value(w.chars) AS BIGINT) AS formatted_chars, any_value(w.n) AS n_windows
        FROM summed t JOIN (SELECT conv, sum(chars) AS chars, count(*) AS n FROM windows GROUP BY conv) w ON t.conv = w.conv
        GROUP BY t.conv""",
    "op7_lattice": f"""
        WITH RECURSIVE vectors AS (
          SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        usable AS (
          SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM vectors
          WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {lattice.COSINE}),
        reach AS (
          SELECT vec_id, vec_id AS other FROM vectors
          UNION SELECT vec_id, b FROM reach JOIN links ON other = a),
        lowest AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM lowest""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_spelling": f"""
        WITH RECURSIVE crc AS (
          SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
        runs AS (
          SELECT run, hex(encode(doc_id || ':' || run)) AS x, count(*) AS n
          FROM (SELECT doc_id, unnest(regexp_extract_all(
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[{spelling.LETTERS}]+')) AS run FROM documents)
          WHERE length(run) >= {spelling.LENGTH} GROUP BY ALL),
        hashed AS (
          SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
            lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
          FROM runs, crc),
        words AS (
          SELECT CASE WHEN h % {spelling.EVERY} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
            CAST(sum(n) AS BIGINT) AS n
          FROM hashed GROUP BY 1 HAVING length(word) >= {spelling.LENGTH} AND sum(n) >= {spelling.OCCURRENCES}),
        cut AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM words, LATERAL (SELECT unnest(range(length(word))) AS i)),
        near AS (
          SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
          UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.d = w.word
          UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.d = w.word),
        best AS (
          SELECT near.word, count(*) AS n_near, arg_min({{'word': other, 'n': o.n}}, {{'n': -o.n, 'word': other}}) AS b
          FROM near JOIN words o ON other = o.word GROUP BY near.word),
        known AS (
          SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= {spelling.TIMES} * n THEN b END AS b
          FROM words w LEFT JOIN best ON w.word = best.word),
        ways AS (
          SELECT word, word AS root, 0 AS steps FROM known
          UNION ALL SELECT ways.word, k.b.word, steps + 1 FROM ways JOIN known k ON root = k.word WHERE k.b IS NOT NULL)
        SELECT k.word, k.b.word AS form, r.root, k.n, k.n_near, k.b.n AS form_n
        FROM known k JOIN (SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word) r ON k.word = r.word""",
    "op13_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
          translate({" || ".join(f"to_base(CAST('0x' || substr(hex, {i}, 10) AS BIGINT), 32, 8)" for i in (1, 11, 21, 31))},
            '{warc.DIGITS}', '{warc.BASE32}') AS payload_digest,
          CASE WHEN page_id = min(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> min(page_id) OVER same THEN min(page_id) OVER same END AS refers_to
        FROM p WINDOW same AS (PARTITION BY payload)""",
}
