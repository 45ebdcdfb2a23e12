"""The queries that apply the operators to whole tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    byte_bpe, conversation_trie, decontaminate, hmm_lm, html_text, jaccard_join, license_scan, periodic_runs, pii, quality_rules, token_records,
    url_filter, warc_zip,
)
from creditloom.llm.texts import blank_words, table

WORD = r"[^ \x09-\x0D]+"


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, folder, "documents").select("doc_id", "text"), BYTE_RANKS, public_tokenizers.PATTERN)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.report(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link(table(spark, folder, "documents").select("doc_id", "text")).drop("digest")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents").select("doc_id", "text"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))


def op9_hmm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return hmm_lm.train_and_score(table(spark, folder, "documents").select("doc_id", "text"))


def op10_token_records(spark: SparkSession, folder: str) -> DataFrame:
    # this model turns white space into single blanks and splits at them before it merges
    manifest = token_records.write(table(spark, folder, "documents").select("doc_id", "text"), WORD_MODEL, by_word=True)
    return token_records.read(manifest)


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_chars")


def periodic_texts(documents: DataFrame) -> DataFrame:
    """The documents of the run query: a tenth of them repeat a block of their own words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = documents.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, blank_words(F.coalesce("text", F.lit("")))).alias("w"))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    placed = words.select("*", n.alias("n"), F.when(n > 0, g % n).alias("a"), g.alias("g"))
    block = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    sized = placed.select("*", block.alias("p"))
    a, p, rest = F.col("a").cast("int"), F.col("p").cast("int"), (F.col("n") - F.col("a")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil(rest / p).cast("int")))
    rebuilt = F.array_join(F.concat(F.slice("w", F.lit(1), a), F.slice(tail, F.lit(1), rest)), " ")
    return sized.select("doc_id", F.when(F.col("n") > 0, rebuilt).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.find(periodic_texts(table(spark, folder, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def rebuilt_conversations(sessions: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first one of its hundred."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    heads = sessions.where(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 5).alias("_head"))
    paired = sessions.join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("_base"), "left")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    taken = F.when(F.col("_head").isNotNull(), F.slice("_head", F.lit(1), h)).otherwise(F.slice("turns", 1, 0))
    return paired.select("conv_id", F.concat(taken, own).alias("turns"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    sessions = conversation_trie.sessions(table(spark, folder, "conversations"))
    return conversation_trie.build(rebuilt_conversations(sessions)).drop("key", "parent_key")


def op13_warc_zip(spark: SparkSession, folder: str) -> DataFrame:
    return warc_zip.read(warc_zip.write(table(spark, folder, "pages"))).drop("url")


def _quality_sql(rules: quality_rules.Rules = quality_rules.RULES, documents: str = "documents") -> str:
    """CTEs up to ``judged``: every document (rid, doc_id, t) with its figures, verdict and clean text."""
    def count(pattern: str, text: str = "l") -> str:
        return f"(length({text}) - length(regexp_replace({text}, {_sql(pattern)}, '', 'g')))"

    solid = "length(regexp_replace(l, '[ \\x09-\\x0D]+', '', 'g'))"
    n_words = f"len(regexp_extract_all(l, '{WORD}'))"
    bars = count(quality_rules.BARS)
    return f"""
    d AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM {documents}),
    w AS (SELECT rid, regexp_extract_all(t, '{WORD}') AS ws FROM d),
    u AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
    g AS (SELECT rid, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
    f AS (SELECT rid, i FROM g WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) >= 2),
    rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM f, (VALUES (0), (1), (2)) AS s(k) GROUP BY rid),
    ls AS (SELECT rid, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
    lj AS (
        SELECT rid, i, l, {n_words} AS n,
            {n_words} > 0 AND (
                ({n_words} < {rules.unmarked_words} AND NOT regexp_matches(rtrim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_sql(quality_rules.TERMINAL)}))
                OR {count(quality_rules.SYMBOLS)} * 100 > {solid} * {rules.max_symbol_percent}
                OR (len(string_split_regex(l, {_sql(quality_rules.SHOUT)})) - 1) * 100 > {n_words} * {rules.max_shout_percent}
                OR ({bars} >= {rules.min_bars} AND {bars} * {rules.words_per_bar} >= {n_words})
                OR ({n_words} < {rules.boilerplate_words} AND regexp_matches(lower(l), {_sql(quality_rules.BOILERPLATE)}))
            ) AS bad
        FROM ls),
    lc AS (
        SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines,
            coalesce(sum({solid}) FILTER (bad), 0) AS n_lost_chars, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT bad), '') AS clean_text
        FROM lj GROUP BY rid),
    judged AS (
        SELECT d.*, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, {count(quality_rules.SYMBOLS, 't')} AS n_symbols,
            n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lost_chars, clean_text,
            len(ws) < {rules.min_words} OR coalesce(n_repeat_words, 0) * 100 > len(ws) * {rules.max_repeat_percent} AS base_failed,
            NOT base_failed AND n_lost_chars * 100 <= word_chars * {rules.max_lost_percent} AS kept
        FROM d JOIN w USING (rid) JOIN lc USING (rid) LEFT JOIN rep USING (rid))"""


_NORMAL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _ascii_lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(name: str, table_name: str, key: str) -> str:
    """CTE of every word (rid, i, x) with the nine that follow it in its text."""
    leads = ", ".join(f"lead(x, {k}) OVER o AS x{k}" for k in range(1, 10))
    return f"""
    {name}0 AS (SELECT row_number() OVER () AS rid, {key}, regexp_extract_all({_ascii_lower("coalesce(text, '')")}, '{_NORMAL}') AS ws FROM {table_name}),
    {name}1 AS (SELECT rid, {key}, len(ws) AS len, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM {name}0),
    {name} AS (SELECT rid, {key}, len, i, x, {leads} FROM {name}1 WINDOW o AS (PARTITION BY rid ORDER BY i))"""


def _gram_sql(size: int) -> str:
    return " || ' ' || ".join(["x", *(f"x{k}" for k in range(1, size))])


_DECONTAMINATION = f"""
    WITH {_words_sql("d", "documents", "doc_id")}, {_words_sql("b", "benchmark", "item_id")},
    bw AS ({" UNION ".join(f"SELECT item_id, {n} AS n, {_gram_sql(n)} AS g FROM b WHERE least(len, 10) = {n} AND i + {n} - 1 <= len" for n in range(1, 11))}),
    h AS ({" UNION ALL ".join(f"SELECT rid, n, i, item_id FROM d JOIN bw ON n = {n} AND {_gram_sql(n)} = g" for n in range(1, 11))}),
    p AS (SELECT DISTINCT rid, unnest(range(i, i + n)) AS at FROM (SELECT DISTINCT rid, i, n FROM h)),
    hit AS (SELECT rid, count(*) AS n_hit FROM p GROUP BY rid),
    it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h) GROUP BY rid)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM d0 LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)"""

_RULES = ", ".join(f"({_sql(rule.partition('/')[0])}, {_sql('/' + rule.partition('/')[2])}, {_sql(rule)}, {_sql(verdict)})" for rule, verdict in URL_RULES.items())
_URLS = f"""
    WITH u AS (
        SELECT row_number() OVER () AS rid, page_id,
            CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    s AS (SELECT rid, page_id, {_ascii_lower("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    r AS (SELECT * FROM (VALUES {_RULES}) AS v(rule_host, rule_path, rule, verdict)),
    m AS (
        SELECT rid, rule, r.verdict FROM s JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC) = 1)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN m USING (rid)"""

_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"


def _crc_sql(text: str) -> str:
    """CRC-32 of a text of digits; ``crc.t`` must be at hand."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {codes}), lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])))"


_RUNS = f"""
    WITH crc AS (SELECT {_CRC_TABLE} AS t),
    d0 AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w, {_crc_sql("doc_id::VARCHAR")} AS h FROM documents, crc),
    d1 AS (SELECT rid, doc_id, w, len(w) AS n, h, h // 10 AS g FROM d0),
    d2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM d1),
    d3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM d2),
    d AS (SELECT rid, doc_id, n, list_transform(range(n), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) AS w FROM d3),
    u AS (SELECT rid, n, unnest(w) AS x, unnest(range(n)) AS i FROM d),
    m AS (SELECT u.rid, u.i, v.i - u.i AS q FROM u JOIN u AS v ON u.rid = v.rid AND u.x = v.x AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
    s AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM m),
    c AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT * FROM c WHERE NOT EXISTS (
        SELECT 1 FROM c AS o WHERE o.rid = c.rid AND o.q < c.q AND o.start <= c.start AND o.start + o.length >= c.start + c.length)),
    b AS (SELECT rid, start, length, q FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length::DOUBLE / q DESC, start, q) = 1),
    l AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM r GROUP BY rid),
    gone AS (SELECT DISTINCT rid, unnest(range(start + q, start + length)) AS i FROM r),
    k AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS kept FROM u ANTI JOIN gone USING (rid, i) GROUP BY rid)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, q AS period, (1000 * length) // q AS exponent_milli,
        sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN b USING (rid) LEFT JOIN l USING (rid) LEFT JOIN k USING (rid)"""

_TRIE = f"""
    WITH crc AS (SELECT {_CRC_TABLE} AS t),
    own AS (
        SELECT conv_id AS c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
    cut AS (SELECT c, own.t, {_crc_sql("c::VARCHAR")} % 6 AS h FROM own, crc),
    reb AS (SELECT o.c, list_concat(coalesce(b.t[1:o.h], []), o.t[o.h + 1:]) AS t FROM cut AS o LEFT JOIN own AS b ON b.c = o.c - o.c % 100),
    pre AS (SELECT c, len(t) AS n, d, t[1:d] AS p FROM (SELECT c, t, unnest(range(len(t) + 1)) AS d FROM reb)),
    node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends FROM pre GROUP BY p, d),
    kid AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
    own_figures AS (
        SELECT node.p, node.d, (n_children IS NULL)::BIGINT AS leaf, CASE WHEN node.d = 0 THEN 0 ELSE (n_convs - 1) * length(node.p[node.d].x) END AS saved
        FROM node LEFT JOIN kid ON kid.p = node.p AND kid.d = node.d),
    sub AS (
        SELECT p[1:e] AS p, e AS d, sum(leaf) AS n_leaves, sum(saved) AS saved
        FROM (SELECT p, leaf, saved, unnest(range(d + 1)) AS e FROM own_figures) GROUP BY 1, 2)
    SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
        saved::BIGINT AS saved_tokens, sha256(coalesce(node.ends, '')) AS ends_sha256
    FROM node JOIN sub ON sub.p = node.p AND sub.d = node.d LEFT JOIN kid ON kid.p = node.p AND kid.d = node.d
    LEFT JOIN node AS up ON up.d = node.d - 1 AND up.p = node.p[1:node.d - 1]"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_WARC = f"""
    WITH p AS (SELECT row_number() OVER (ORDER BY page_id, url) AS rid, page_id, coalesce(html, '') AS h FROM pages),
    g AS (SELECT *, sha1(h) AS s, last_value(page_id) OVER same AS top, last_value(rid) OVER same AS top_rid FROM p
        WINDOW same AS (PARTITION BY h ORDER BY rid ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT page_id, strlen(h) AS payload_bytes,
        array_to_string(list_transform(range(32), lambda k:
            substr('{_BASE32}', 1 + ((('0x' || substr(s, 1 + 5 * (k // 4), 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '') AS payload_digest,
        CASE WHEN rid = top_rid THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN rid <> top_rid THEN top END AS refers_to
    FROM g"""

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_filter": op5_url_filter,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_pii": op7_pii,
    "op8_license_scan": op8_license_scan,
    "op9_hmm_scoring": op9_hmm_scoring,
    "op10_token_records": op10_token_records,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_warc_zip": op13_warc_zip,
}

ORACLES = {
    "op3_decontamination": _DECONTAMINATION,
    "op4_quality_rules": f"""WITH {_quality_sql()}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lost_chars::BIGINT AS n_lost_chars FROM judged""",
    "op5_url_filter": _URLS,
    "op11_periodic_runs": _RUNS,
    "op12_conversation_trie": _TRIE,
    "op13_warc_zip": _WARC,
}
