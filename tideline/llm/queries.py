"""The registered query of each corpus operator, over its whole table, and the SQL it is compared with where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import format_report
from .common import table
from .decontamination import contamination_report
from .exact_dedup import exact_dedup
from .hmm_scoring import score_report
from .html_extraction import extraction_report
from .jaccard_join import jaccard_classes
from .language_id import language_report
from .line_dedup import line_report
from .merge_dropout import codec_report
from .sharding import shard_report


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    turns = [F.struct(F.lit(-1), F.lit(i), F.lit(role), F.lit(control)) for i, role in enumerate(("user", "assistant"))]
    own = spark.range(1).select(F.inline(F.array(*turns))).toDF(*rows.columns)
    return format_report(rows.unionAll(own.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])))


def op3_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction_report(table(spark, sf_dir, "pages"))


def op6_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_report(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_report(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_external_shuffle": op3_external_shuffle,
    "op4_decontamination": op4_decontamination,
    "op5_html_extraction": op5_html_extraction,
    "op6_hmm_scoring": op6_hmm_scoring,
    "op7_line_dedup": op7_line_dedup,
    "op8_merge_dropout": op8_merge_dropout,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
}

ORACLE = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
        ), r AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
            FROM d WINDOW w AS (PARTITION BY body ORDER BY n DESC, doc_id)
        )
        SELECT doc_id, keep_id, group_size, keep_id = doc_id AS kept, sha256(body) AS text_sha256 FROM r
    """,
    "op4_decontamination": r"""
        WITH b0 AS (
            SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), b AS (
            SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b0 WHERE len(w) > 0)
        ), d AS (
            SELECT doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), g AS (
            SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k
        ), m AS (
            SELECT doc_id, g.i, g.k, item FROM g JOIN b ON b.k = g.k AND b.win = array_to_string(g.w[g.i : g.i + g.k - 1], ' ')
        ), p AS (
            SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS pos FROM m) GROUP BY doc_id
        ), s AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN s USING (doc_id)
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), t AS (
            SELECT array_to_string(w, ' ') AS body, any_value(w) AS w, min(doc_id) AS rep, count(*) AS copies FROM w WHERE len(w) > 0 GROUP BY 1
        ), g AS (
            SELECT DISTINCT rep, array_to_string(w[i : i + 4], ' ') AS gram FROM (SELECT rep, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM t)
        ), n AS (SELECT rep, count(*) AS n FROM g GROUP BY rep), l AS (
            SELECT x.rep AS a, y.rep AS b FROM g x JOIN g y ON x.gram = y.gram AND x.rep <> y.rep JOIN n p ON p.rep = x.rep JOIN n q ON q.rep = y.rep
            GROUP BY x.rep, y.rep, p.n, q.n HAVING count(*) >= 0.8 * (p.n + q.n - count(*)) - 1e-9
        ), c AS (
            SELECT rep AS id, rep AS label FROM t UNION SELECT l.b, c.label FROM c JOIN l ON l.a = c.id WHERE c.label < l.b
        ), k AS (SELECT id, min(label) AS class_id FROM c GROUP BY id), s AS (
            SELECT l.a, count(*) AS n_texts, sum(t.copies)::BIGINT AS stands FROM l JOIN t ON t.rep = l.b GROUP BY l.a
        )
        SELECT w.doc_id, coalesce(k.class_id, w.doc_id) AS class_id, coalesce(t.rep, w.doc_id) AS copy_of,
            coalesce(s.stands, 0) + coalesce(t.copies, 1) - 1 AS n_links, coalesce(s.n_texts, 0) AS n_texts
        FROM w LEFT JOIN t ON len(w.w) > 0 AND t.body = array_to_string(w.w, ' ') LEFT JOIN k ON k.id = t.rep LEFT JOIN s ON s.a = t.rep
    """,
    "op2_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), e AS (
            SELECT *, length(text) + length(text) - length(replace(text, '~', ''))
                + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
                + length(role) + 12 + 1 + 10 + 1 AS chars
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op7_line_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS site, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (
            SELECT doc_id, site, i, lines[i] AS line, trim(lines[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS body
            FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)
        ), b AS (SELECT body FROM l WHERE body <> '' GROUP BY body HAVING count(DISTINCT site) >= 10),
        c AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (b.body IS NULL) AS clean, count(b.body) AS n_removed, count(*) AS n_lines
            FROM l LEFT JOIN b USING (body) GROUP BY doc_id
        )
        SELECT doc_id, n_lines, n_removed, length(coalesce(clean, '')) AS clean_chars, sha256(coalesce(clean, '')) AS clean_sha256 FROM c
    """,
}
