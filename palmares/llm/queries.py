"""The registered queries of the operators: each over its whole tables, with production parameters, and SQL twins where SQL has the means."""

from __future__ import annotations

import logging
import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, chunk_dedup, decontam, language, licenses, packing, pii, prefix_trie, quality, simhash, toxicity, vector_dedup, whitening

log = logging.getLogger(__name__)

#: Key of the surrogates, set under this name. Without it local sessions use the sample key, and an application on a cluster draws a secret of its own.
KEY_SETTING, SAMPLE_KEY = "spark.palmares.pii.key", "sample-key"
#: The drawn secret of each application; kept in this process alone, so the next application has other surrogates.
_DRAWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pii_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_SETTING, None)
    if key or spark.sparkContext.master.startswith("local"):
        return key or SAMPLE_KEY
    app = spark.sparkContext.applicationId
    if app not in _DRAWN:
        log.warning("%s is not set: surrogates hold for this application alone", KEY_SETTING)
        _DRAWN[app] = secrets.token_hex(32)
    return _DRAWN[app]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("row_hash")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("stratum")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, declared=docs["lang"], address=docs["source"], host=docs["source"]).drop("row_hash", "declared", "suffix")


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of ``op4`` over pages, which have all its evidence: markup, address suffix and host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    shown = pages.withColumn("text", language.page_text(F.col("html")))
    found = language.identify(
        shown, doc_id="page_id", declared=language.markup_language(F.col("html")), address=F.col("url"), host=language.host_of(F.col("url")))
    return found.select(F.col("doc_id").alias("page_id"), F.col("declared").alias("markup"), "suffix", "language", "probability", "kept", "reason")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{marks}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    formatted = chat.format_chats(chat.records_of(rows.unionByName(own)))
    read = formatted.select("conv_id", "formatted", chat.parse_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


OP5_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
spelled AS (
  SELECT conv_id, turn, role, text,
    9 + 7 + 7 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS chars
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM spelled GROUP BY conv_id
"""


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_hash")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, pii_key(spark), count="n_entities")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    fit = whitening.fit_whitening(rows, k=4)
    explained = F.array(*[F.lit(float(x)) for x in (fit.explained if fit else ())]).cast("array<double>")
    by_component = whitening.whitened(rows, fit).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return by_component.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(fit.n if fit else 0).cast("long").alias("n"), F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"), F.lit(fit.identity_error if fit else 0.0).alias("identity_error"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


OP12_SQL = """
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS v,
    coalesce(len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0, FALSE) AS takes_part
  FROM embeddings),
links AS (
  SELECT a.row AS a, b.row AS b FROM vectors a JOIN vectors b ON a.row <> b.row AND a.takes_part AND b.takes_part AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  WITH RECURSIVE r(row, other) AS (SELECT row, row FROM vectors UNION SELECT r.row, l.b FROM r JOIN links l ON r.other = l.a) SELECT * FROM r),
named AS (SELECT r.row, min(v.vec_id) AS component_id FROM reach r JOIN vectors v ON v.row = r.other GROUP BY r.row),
counted AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, FALSE) AS kept
FROM vectors JOIN named USING (row) LEFT JOIN counted USING (row)
"""


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("digest")


OP13_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: ord(ch))),
    lambda crc, byte: list_reduce(list_concat([xor(CAST(crc AS BIGINT), CAST(byte AS BIGINT))], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, t.role, t.text, t.k AS place, 0 AS part FROM convs c JOIN turns t ON t.conv_id = c.base AND t.k <= c.h
  UNION ALL SELECT c.conv_id, t.role, t.text, t.k, 1 FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h),
steps AS (
  SELECT conv_id, row_number() OVER w AS depth, list([role, text]) OVER w AS path, strlen(text) AS n_bytes FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
lasts AS (SELECT conv_id, max(depth) AS depth FROM steps GROUP BY conv_id),
nodes AS (
  SELECT path, s.depth, min(s.conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes,
    sha256(coalesce(string_agg(CAST(s.conv_id AS VARCHAR), ',' ORDER BY s.conv_id) FILTER (WHERE l.depth = s.depth), '')) AS ends_sha256
  FROM steps s JOIN lasts l USING (conv_id) GROUP BY path, s.depth),
family AS (SELECT n.path, p.conv_id AS parent_conv_id FROM nodes n JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]),
below AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN below USING (path)),
trees AS (
  SELECT t.path, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.n_bytes) AS saved_tokens
  FROM whole t JOIN whole u ON u.depth >= t.depth AND u.path[:t.depth] = t.path GROUP BY t.path)
SELECT conv_id, depth, parent_conv_id, n_convs, CAST(n_children AS BIGINT) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM whole JOIN trees USING (path) LEFT JOIN family USING (path)
"""


def _op3_sql() -> str:
    """The twin of op3: the same rules in SQL, with binomial tails by the logarithm of the gamma function."""
    values = {
        "symbol_share": "n_symbols / nullif(word_chars, 0)", "dup_line_share": "n_dup_lines / nullif(n_lines, 0)", "repeat_share": "n_repeat_words / nullif(n_words, 0)",
        "long_word_mean": "word_chars / nullif(n_words, 0)", "short_word_mean": "word_chars / nullif(n_words, 0)", "few_words": "CAST(n_words AS DOUBLE)"}
    rules = ", ".join(f"('{r}', {sign}, {c:.6f})" for r, (sign, cs) in quality.RULES.items() for c in cs)
    case = " ".join(f"WHEN '{r}' THEN {v}" for r, v in values.items())
    tests = sum(len(c) for _, c in quality.RULES.values())
    share = quality.RISK / len(quality.RULES)
    order = " ".join(f"WHEN '{r}' THEN {k}" for k, r in enumerate(quality.RULES))
    return rf"""
WITH cut AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, row_number() OVER () AS row FROM documents),
places AS (SELECT row, ws, unnest(range(1, len(ws) - 3)) AS i FROM cut WHERE len(ws) > 5),
windows AS (SELECT row, i, array_to_string(ws[i:i + 4], ' ') AS w FROM places),
twice AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1),
repeated AS (SELECT row, CAST(sum(g) AS BIGINT) AS n FROM (SELECT row, least(5, coalesce(lead(i) OVER (PARTITION BY row ORDER BY i) - i, 5)) AS g FROM twice) GROUP BY row),
lines AS (SELECT row, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM cut),
m AS (
  SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines, row
  FROM cut JOIN lines USING (row) LEFT JOIN repeated USING (row)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
rules(rule, sign, cutoff) AS (VALUES {rules}),
good AS (SELECT * FROM base WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1)),
tried AS (
  SELECT coalesce(lang, '~') AS stratum, rule, sign, cutoff, count(*) AS n, count(*) FILTER (WHERE sign * (CASE rule {case} END) > sign * cutoff) AS failed
  FROM good, rules GROUP BY coalesce(lang, '~'), rule, sign, cutoff),
proven AS (
  SELECT stratum, rule, sign, cutoff FROM tried WHERE failed <= n * {share!r} AND
    list_sum(list_transform(range(0, CAST(failed AS BIGINT) + 1), lambda j: exp(lgamma(n + 1.0) - (CASE WHEN j = 0 THEN 0.0 ELSE lgamma(j + 1.0) END) - lgamma(n - j + 1.0) + j * ln({share!r}) + (n - j) * ln(1 - {share!r})))) <= {quality.CHANCE!r} / {tests}),
limits AS (SELECT stratum, rule, sign, min(sign * cutoff) * sign AS cutoff FROM proven GROUP BY stratum, rule, sign),
bad AS (
  SELECT row, string_agg(rule, ',' ORDER BY CASE rule {order} END) AS failed_rules FROM base JOIN limits ON coalesce(lang, '~') = stratum
  WHERE sign * (CASE rule {case} END) > sign * cutoff GROUP BY row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules IS NULL AS kept, coalesce(failed_rules, '') AS failed_rules
FROM base LEFT JOIN bad USING (row)
"""


def queries() -> dict:
    """All queries of the subpackage, ``pipeline`` included."""
    import corpus_pipeline

    found = (
        op1_toxicity, op2_substring_dedup, op3_quality_rules, op4_language_id, op5_chat_formatting, op6_best_fit_packing,
        op7_license_scan, op8_simhash_near_dedup, op9_benchmark_decontamination, op10_pii_surrogates,
        op11_embedding_whitening, op12_embedding_near_dedup, op13_conversation_prefix_trie, pages_language_id)
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": _op3_sql(), "op5_chat_formatting": OP5_SQL, "op12_embedding_near_dedup": OP12_SQL, "op13_conversation_prefix_trie": OP13_SQL}
