"""The corpus queries with their production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bit_sliced import top_k
from tidemark.llm.bpe import encode_texts
from tidemark.llm.fm_index import digest, find_phrases
from tidemark.llm.html_text import extract_text
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.passages import repeated_passages
from tidemark.llm.resampling import resample
from tidemark.llm.simhash import near_copies
from tidemark.llm.tool_calls import calls_of_turns, link_calls
from tidemark.llm.toxicity import score_texts, train
from tidemark.llm.url_rules import HostRule, judge_urls
from tidemark.llm.whitening import whiten
from tidemark.llm.word_bpe import encode_words

HOST_RULES = (
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
)
BLOCK_GLOBS = ("*casino*", "*-pills*", "*-bets.*", "*ads-*", "*track.*")

#: What the arguments of a call made of a turn must look like.
TURN_SCHEMAS = {
    role: {
        "type": "object",
        "required": ["turn", "text"],
        "additionalProperties": False,
        "properties": {"turn": {"type": "integer", "minimum": 0}, "text": {"type": "string", "minLength": 1, "maxLength": longest}},
    }
    for role, longest in (("system", 4000), ("user", 2000))
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)
    return found.select(F.col("query_id"), "rank", "vec_id", "score")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(find_phrases(docs, table(spark, sf_dir, "benchmark"), size=10))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs, train(docs, table(spark, sf_dir, "labels")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    first = F.transform("dropped", lambda d: F.concat_ws(":", d["line"], d["by_doc"], d["by_line"]))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"), F.array_join(first, ",").alias("dropped_for"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = calls_of_turns(table(spark, sf_dir, "conversations"))
    linked = link_calls(calls, results, TURN_SCHEMAS)
    return linked.select("conv_id", "call_id", "level", "n_results", "valid", "errors", "status", F.sha2("canonical", 256).alias("canonical_sha256"), F.length("canonical").cast("long").alias("n_chars"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), HOST_RULES, BLOCK_GLOBS)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), radius=4, words=4)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=25, least_words=20, buckets=10_000, seed=7)


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_words(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=16, scale=64.0)


QUERIES = {
    "op1_passages": op1_passages,
    "op2_top_k": op2_top_k,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_bpe": op6_bpe,
    "op7_tool_calls": op7_tool_calls,
    "op8_html_text": op8_html_text,
    "op9_url_rules": op9_url_rules,
    "op10_simhash": op10_simhash,
    "op11_resampling": op11_resampling,
    "op12_word_bpe": op12_word_bpe,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op2_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
        SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5""",
    "op3_decontamination": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        wins AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
            FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS r(i) WHERE len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM wins),
        places AS (
            SELECT rid, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
            FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS r(i)),
        hits AS (SELECT rid, i, size, item_id FROM places JOIN wins USING (size, phrase)),
        hit_words AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS r(p) GROUP BY rid),
        hit_items AS (
            SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
            FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)""",
    "op5_line_dedup": r"""
        WITH parts AS (
            SELECT doc_id, CAST(i AS INT) - 1 AS line, lines[i] AS raw, trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS r(i)),
        occ AS (SELECT *, row_number() OVER (ORDER BY doc_id, line) AS pos FROM parts WHERE body <> ''),
        cls AS (SELECT body, min(pos) AS first, regexp_split_to_array(body, '\s+') AS w FROM occ GROUP BY body),
        -- one edit leaves the first or the last unit of both as it is
        long AS (SELECT first, w, len(w) AS n FROM cls WHERE len(w) >= 7),
        ends AS (SELECT *, unnest([{'side': 0, 'word': w[1]}, {'side': 1, 'word': w[n]}]) AS e FROM long),
        word_pairs AS (SELECT DISTINCT a.first AS x, b.first AS y, a.w AS v, b.w AS u
            FROM ends a JOIN ends b ON a.e = b.e AND b.first < a.first AND abs(a.n - b.n) <= 1 AND greatest(a.n, b.n) >= 8),
        short AS (SELECT first, body, length(body) AS n FROM cls WHERE len(w) < 8),
        tips AS (SELECT *, unnest([{'side': 0, 'c': body[1:1]}, {'side': 1, 'c': body[n:n]}]) AS e FROM short),
        char_pairs AS (SELECT DISTINCT a.first AS x, b.first AS y, a.body AS v, b.body AS u
            FROM tips a JOIN tips b ON a.e = b.e AND b.first < a.first AND abs(a.n - b.n) <= 1 AND greatest(a.n, b.n) >= 16),
        near AS (SELECT x, min(y) AS y FROM (
            SELECT x, y FROM word_pairs WHERE CASE
                WHEN len(v) = len(u) THEN len(list_filter(range(1, len(v) + 1), lambda i: v[i] <> u[i])) <= 1
                WHEN len(v) > len(u) THEN len(list_filter(range(1, len(v) + 1), lambda i: list_concat(v[1:i - 1], v[i + 1:len(v)]) = u)) > 0
                ELSE len(list_filter(range(1, len(u) + 1), lambda i: list_concat(u[1:i - 1], u[i + 1:len(u)]) = v)) > 0 END
            UNION ALL
            SELECT x, y FROM char_pairs WHERE CASE
                WHEN length(v) = length(u) THEN len(list_filter(range(1, length(v) + 1), lambda i: v[i:i] <> u[i:i])) <= 1
                WHEN length(v) > length(u) THEN len(list_filter(range(1, length(v) + 1), lambda i: v[1:i - 1] || v[i + 1:length(v)] = u)) > 0
                ELSE len(list_filter(range(1, length(u) + 1), lambda i: u[1:i - 1] || u[i + 1:length(u)] = v)) > 0 END) GROUP BY x),
        fate AS (
            SELECT occ.doc_id, occ.line, least(near.y, CASE WHEN cls.first < occ.pos THEN cls.first END) AS by_pos
            FROM occ JOIN cls USING (body) LEFT JOIN near ON near.x = cls.first),
        gone AS (SELECT fate.doc_id, fate.line, o.doc_id AS by_doc, o.line AS by_line FROM fate JOIN occ o ON o.pos = fate.by_pos),
        lists AS (
            SELECT doc_id, count(*) AS n_dropped, string_agg(line || ':' || by_doc || ':' || by_line, ',' ORDER BY line) AS dropped_for
            FROM gone GROUP BY doc_id),
        texts AS (
            SELECT parts.doc_id, count(*) FILTER (body <> '') AS n_lines,
                   sha256(coalesce(string_agg(raw, chr(10) ORDER BY parts.line) FILTER (gone.line IS NULL), '')) AS text_sha256
            FROM parts LEFT JOIN gone ON gone.doc_id = parts.doc_id AND gone.line = parts.line GROUP BY parts.doc_id)
        SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
               text_sha256, coalesce(dropped_for, '') AS dropped_for
        FROM documents d LEFT JOIN texts USING (doc_id) LEFT JOIN lists USING (doc_id)""",
    "op7_tool_calls": r"""
        WITH calls AS (
            SELECT conv_id, turn, role, text, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
            FROM conversations WHERE role <> 'assistant'),
        leveled AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level FROM calls),
        results AS (SELECT conv_id, turn - 1 AS turn, text AS result FROM conversations WHERE role = 'assistant'),
        linked AS (
            SELECT conv_id, turn, role, text, level, result, l.role IS NOT NULL AS called, r.result IS NOT NULL AS answered,
                   CASE WHEN role = 'system' THEN 4000 ELSE 2000 END AS longest
            FROM leveled l FULL JOIN results r USING (conv_id, turn)),
        wrote AS (
            SELECT *, '{' || CASE WHEN called THEN '"arguments":{"text":' || to_json(text) || ',"turn":' || turn || '},' ELSE '' END
                   || '"id":"' || conv_id || ':' || turn || '"' || CASE WHEN called THEN ',"name":"' || role || '"' ELSE '' END
                   || CASE WHEN answered THEN ',"result":' || to_json(result) ELSE '' END || '}' AS canonical
            FROM linked)
        SELECT conv_id, conv_id || ':' || turn AS call_id, CAST(level AS BIGINT) AS level, CAST(answered AS BIGINT) AS n_results,
               called AND length(text) BETWEEN 1 AND longest AS valid,
               CASE WHEN NOT called THEN '' WHEN length(text) < 1 THEN '$.text: too short' WHEN length(text) > longest THEN '$.text: too long' ELSE '' END AS errors,
               CASE WHEN NOT called THEN 'orphan' WHEN answered THEN 'linked' ELSE 'unanswered' END AS status,
               sha256(canonical) AS canonical_sha256, CAST(length(canonical) AS BIGINT) AS n_chars
        FROM wrote""",
    "op9_url_rules": r"""
        WITH parts AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        ruled AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM parts)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN host LIKE '%casino%' OR host LIKE '%-pills%' OR host LIKE '%-bets.%' OR host LIKE '%ads-%' OR host LIKE '%track.%' THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled""",
    "op11_resampling": r"""
        WITH bits AS (
            SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
            FROM range(256) AS r(i)),
        crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM bits),
        texts AS MATERIALIZED (
            SELECT 1 AS side, row_number() OVER () AS rid, doc_id, text FROM documents
            UNION ALL SELECT 2, row_number() OVER (), NULL, text FROM benchmark),
        words AS MATERIALIZED (
            SELECT side, rid, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts),
        features AS MATERIALIZED (
            SELECT side, rid, f, count(*) AS n
            FROM words, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS u(f) GROUP BY ALL),
        bytes AS (
            SELECT f, list_transform(range(1, octet_length(encode(f)) + 1), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT)) AS b
            FROM (SELECT DISTINCT f FROM features)),
        hashed AS MATERIALIZED (
            SELECT f, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)])), 4294967295) % 10000 AS bucket
            FROM bytes, crc_table),
        sums AS (SELECT bucket, sum(n) FILTER (side = 1) AS s, sum(n) FILTER (side = 2) AS t FROM features JOIN hashed USING (f) GROUP BY bucket),
        every AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM sums),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
            FROM sums, every),
        weights AS (
            SELECT rid, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
            FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE side = 1 GROUP BY rid),
        scored AS (
            SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
            FROM words LEFT JOIN weights USING (rid) WHERE side = 1),
        ranks AS (
            SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
        SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
        FROM scored LEFT JOIN ranks USING (rid)""",
}
