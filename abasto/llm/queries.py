"""The operators over their whole tables, as registered queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abasto.llm import (
    op01_decontaminate,
    op02_substrings,
    op03_html,
    op04_sharding,
    op05_packing,
    op06_secrets,
    op07_covertree,
    op08_jaccard,
    op09_token_files,
)
from abasto.llm import op10_quality as quality
from abasto.llm import op11_alignment as alignment
from abasto.llm import op12_filter_audit as filter_audit
from abasto.llm import op13_quality_rules as quality_rules
from abasto.llm.common import staging_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


SHARDS = [f"shard-{number:03d}" for number in range(256)]


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return op01_decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op2_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = op02_substrings.dedup(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_html(spark: SparkSession, folder: str) -> DataFrame:
    return op03_html.extract(table(spark, folder, "pages"))


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents are written shard by shard; the rows are those of the files."""
    docs, target = table(spark, folder, "documents"), staging_folder(spark)
    op04_sharding.write_shards(docs, "doc_id", SHARDS, target)
    return op04_sharding.read_shards(spark, target, docs.schema).select("doc_id", "slot", "shard")


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return op05_packing.pack(table(spark, folder, "documents"))


@query
def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return op06_secrets.scan(table(spark, folder, "documents"))


@query
def op7_covertree(spark: SparkSession, folder: str) -> DataFrame:
    return op07_covertree.join(table(spark, folder, "embeddings"))


@query
def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return op08_jaccard.join(table(spark, folder, "documents"))


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return op09_token_files.round_trip(table(spark, folder, "documents"))


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


@query
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_WORDS = r"regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op2_substrings"] = f"""
WITH split AS (SELECT doc_id, {_WORDS.format(text="text")} AS words FROM documents),
windows AS (SELECT doc_id, unnest(range(len(words) - 19)) AS place, words FROM split WHERE len(words) >= 20),
named AS (SELECT doc_id, place, array_to_string(words[place + 1 : place + 20], ' ') AS window_text FROM windows),
later AS (SELECT doc_id, place FROM named
          QUALIFY row_number() OVER (PARTITION BY window_text ORDER BY doc_id, place) > 1),
gone AS (SELECT DISTINCT doc_id, place + step AS place FROM later CROSS JOIN range(20) steps(step)),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM split),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS rest FROM placed ANTI JOIN gone USING (doc_id, place)
         GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256 FROM split LEFT JOIN kept USING (doc_id)"""

_REACHED = """
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reached r JOIN edges e ON r.b = e.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op8_jaccard"] = f"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS words FROM documents),
starts AS (SELECT doc_id, unnest(range(greatest(len(words) - 4, 1))) AS place, words FROM split WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[place + 1 : place + 5], ' ') AS shingle FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y USING (shingle)
           WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
{_REACHED}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = d.doc_id"""

ORACLES["op7_covertree"] = f"""
WITH RECURSIVE given AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (SELECT * FROM given WHERE label IS NOT NULL AND len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0
           AND len([x for x in v if x <> 0]) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id
              AND len(x.v) = len(y.v)
          WHERE list_dot_product(x.v, y.v) / sqrt(list_dot_product(x.v, x.v) * list_dot_product(y.v, y.v)) >= 0.93),
{_REACHED},
degrees AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id <= coalesce(b, vec_id) AS kept
FROM given LEFT JOIN least ON least.a = vec_id LEFT JOIN degrees ON degrees.a = vec_id"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op12_filter_audit"] = f"""
WITH given AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
split AS (SELECT *, {_WORDS.format(text="t")} AS words FROM given),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels
          WHERE doc_id IS NOT NULL GROUP BY doc_id),
firsts AS (SELECT t, min(doc_id) AS first_id FROM given GROUP BY t),
judged AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                  list_concat(CASE WHEN len(words) < 50 THEN ['A'] ELSE [] END,
                              CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN ['B'] ELSE [] END,
                              CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN ['C'] ELSE [] END,
                              CASE WHEN regexp_matches(t, '[#$%&*|]') THEN ['D'] ELSE [] END,
                              CASE WHEN doc_id > first_id THEN ['E'] ELSE [] END) AS fails
           FROM split JOIN firsts USING (t) LEFT JOIN known USING (doc_id)),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, s AS step, o[s] AS f, o[1 : s - 1] AS before FROM orders, range(1, 6) r(s)),
results AS (
    SELECT part, o, step, f,
           coalesce(sum(n) FILTER (NOT list_contains(fails, f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (list_contains(fails, f) AND list_has_any(fails, before)), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = [f]), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (list_contains(fails, f) AND NOT list_has_any(fails, before)), 0)::BIGINT AS toxic_lost
    FROM counted, steps GROUP BY part, o, step, f)
SELECT part, array_to_string(o, '') AS filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM results"""


def _shares(rules: list[quality_rules.Rule]) -> str:
    """SQL that is true where a row breaks none of the rules."""
    tests = []
    for rule in rules:
        value, whole = (rule.measure, "1") if rule.of is None else (f"100 * {rule.measure}", rule.of)
        bounds = [f"{value} >= {rule.low} * {whole}"] * (rule.low is not None)
        bounds += [f"{value} <= {rule.high} * {whole}"] * (rule.high is not None)
        tests.append(f"({' AND '.join(bounds)})" if rule.of is None else f"({whole} = 0 OR {' AND '.join(bounds)})")
    return " AND ".join(tests)


_STOP_WORDS = ", ".join(sorted({f"'{word}'" for words in quality_rules.STOP_WORDS.values() for word in words.split()}))

ORACLES["op13_quality_rules"] = f"""
WITH given AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, {_WORDS.format(text="t")} AS words,
                 [x FOR x IN string_split(t, chr(10)) IF translate(x, {_BLANKS}, '') <> ''] AS lines FROM given),
starts AS (SELECT r, unnest(range(len(words) - 2)) AS place, words FROM split WHERE len(words) > 2),
windows AS (SELECT r, place, words[place + 1 : place + 3] AS w FROM starts),
twice AS (SELECT r, place FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (SELECT r, count(DISTINCT place + step) AS n FROM twice, range(3) s(step) GROUP BY r),
measured AS (
    SELECT r, doc_id, len(words) AS n_words, coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
           len([x FOR x IN words IF regexp_matches(x, '\\p{{L}}')]) AS n_letter_words,
           len([x FOR x IN words IF lower(trim(x, '.,;:!?()"' || chr(39))) IN ({_STOP_WORDS})]) AS n_stop_words,
           len([x FOR x IN lines IF regexp_matches(ltrim(x), '^[-*•]')]) AS n_bullet_lines,
           len([x FOR x IN lines IF regexp_matches(rtrim(x), '([.][.][.]|…)$')]) AS n_cut_lines
    FROM split LEFT JOIN covered USING (r)),
judged AS (SELECT *, NOT ({_shares(quality_rules.BASE)}) AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_shares(quality_rules.RULES)} AS kept FROM judged"""
