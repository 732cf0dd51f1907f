"""Queries of the subpackage: each applies its operator, with production
parameters, to its whole table. ``ORACLE`` holds DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aggrex.llm import (bpe, decontaminate, embeddings, hard_negatives, paragraphs, phrases, pii, quality,
                        quality_rules, simhash, token_files, toxicity, url_lists)

QUERIES = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_toxicity_severity")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


# The list and the fetch dates are derived from the pages: every host is listed for a while, some again
# later; parent domains and path prefixes of some pages too. The digits of md5 spread the dates.
URL_EVENTS = """
WITH u AS (SELECT page_id, url, {host} AS host, {path} AS path FROM pages WHERE url IS NOT NULL),
h AS (SELECT DISTINCT host FROM u WHERE host <> ''),
e AS (
  SELECT 'host' AS kind, host AS entry, 'adult' AS category FROM h
  UNION ALL SELECT DISTINCT 'domain', substr(host, instr(host, '.') + 1), 'malware' FROM h
  UNION ALL SELECT DISTINCT 'prefix', concat(host, path), 'spam' FROM u
    WHERE host <> '' AND substr(md5(url), 1, 1) IN ('0', '1')),
d AS (SELECT kind, entry, category, {h1} AS a, {h2} AS b, {h3} AS c FROM e)
SELECT kind, entry, category, 'add' AS action, {day_a} AS event_date FROM d
UNION ALL SELECT kind, entry, category, 'remove', {day_b} FROM d
UNION ALL SELECT kind, entry, 'other', 'add', {day_c} FROM d WHERE c % 2 = 0
"""


def _digits(spark_sql: bool) -> dict[str, str]:
    def number(at):
        text = f"substr(md5(concat(kind, entry)), {at}, 4)"
        return f"CAST(conv({text}, 16, 10) AS INT)" if spark_sql else f"CAST(('0x' || {text}) AS INT)"

    def day(days):
        start = "DATE '2023-01-01'"
        return f"date_add({start}, {days})" if spark_sql else f"CAST({start} + CAST({days} AS INT) AS DATE)"

    def part(n):
        q = r"'^https?://([^/?#]+)([^?#]*)'"
        return f"regexp_extract(url, {'r' if spark_sql else ''}{q}, {n})"

    return {"h1": number(1), "h2": number(5), "h3": number(9), "day_a": day("a % 500"),
            "day_b": day("a % 500 + 20 + b % 300"), "day_c": day("a % 500 + 350 + b % 200 + c % 90"),
            "host": f"lower({part(1)})", "path": part(2)}


def _capture_date(spark_sql: bool) -> str:
    return ("date_add(DATE '2023-01-01', CAST(page_id % 730 AS INT))" if spark_sql
            else "CAST(DATE '2023-01-01' + CAST(page_id % 730 AS INT) AS DATE)")


# host with user and port, and path, of http(s) URLs.
URL_PARTS = r"^(?i:https?)://([^/?#\s]+)([^?#\s]*)"

URL_ORACLE = f"""
WITH events AS ({URL_EVENTS.format(**_digits(False))}),
days AS (SELECT kind, lower(regexp_extract(entry, '^[^/]*')) || substr(entry, length(regexp_extract(entry, '^[^/]*')) + 1)
    AS entry, event_date, max(CAST(action = 'add' AS INT)) AS on_list,
    min(category) FILTER (action = 'add') AS category FROM events GROUP BY ALL),
spans AS (SELECT *, coalesce(lead(event_date) OVER (PARTITION BY kind, entry ORDER BY event_date),
    DATE '9999-12-31') AS valid_to FROM days),
live AS (SELECT * FROM spans WHERE on_list = 1),
parts AS (SELECT page_id, {_capture_date(False)} AS day, regexp_extract(url, '{URL_PARTS}', 1) AS rest,
    regexp_extract(url, '{URL_PARTS}', 2) AS path FROM pages),
captures AS (SELECT page_id, day, regexp_replace(regexp_replace(lower(rest), '^.*@', ''), ':[0-9]*$|\\.$', '') AS host,
    CASE WHEN path = '' THEN '/' ELSE path END AS path FROM parts),
hits AS (SELECT c.page_id, l.category, l.event_date FROM captures c JOIN live l
    ON c.host <> '' AND l.event_date <= c.day AND c.day < l.valid_to AND CASE l.kind
      WHEN 'host' THEN c.host = l.entry
      WHEN 'domain' THEN c.host = l.entry OR ends_with(c.host, '.' || l.entry)
      ELSE c.host || c.path = l.entry
        OR (ends_with(l.entry, '/') AND starts_with(c.host || c.path, l.entry)) END),
g AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
    min(event_date) AS first_listed FROM hits GROUP BY page_id)
SELECT p.page_id, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries, coalesce(categories, '') AS categories,
    coalesce(CAST(first_listed AS VARCHAR), '') AS first_listed FROM (SELECT DISTINCT page_id FROM pages) p LEFT JOIN g ON p.page_id IS NOT DISTINCT FROM g.page_id
"""


@query("op2_url_list_asof", URL_ORACLE)
def op2(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = spark.sql(URL_EVENTS.format(**_digits(True)).replace("FROM pages", "FROM {pages}"), pages=pages)
    captures = pages.withColumn("fetch_date", F.expr(_capture_date(True)))
    found = url_lists.filter_captures(captures, url_lists.validity_intervals(events))
    return found.withColumn("first_listed", F.coalesce(F.col("first_listed").cast("string"), F.lit("")))


@query("op3_benchmark_matches")
def op3(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _pii_oracle() -> str:
    def found(place, kind):
        return (f"SELECT rid, {place} AS place, '{kind}' AS kind, unnest(regexp_extract_all(t, '{pii.PLAIN[kind]}')) AS v,"
                f" unnest(list_slice(string_split_regex(t, '{pii.PLAIN[kind]}'), 1,"
                f" len(regexp_extract_all(t, '{pii.PLAIN[kind]}')))) AS gap,"
                f" generate_subscripts(regexp_extract_all(t, '{pii.PLAIN[kind]}'), 1) AS i FROM d")

    kinds = " UNION ALL ".join(found(p, k) for p, k in enumerate(pii.KINDS))
    bases = " ".join(f"WHEN '{k}' THEN {round(pii.SCORES[k] * 100)}" for k in pii.KINDS)
    raised = " OR ".join(f"kind = '{k}' AND regexp_matches(around, '(^|[^a-z])({pii.RAISES[k]})')" for k in pii.KINDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
raw AS ({kinds}),
placed AS (SELECT *, CAST(sum(length(gap) + length(v)) OVER (PARTITION BY rid, kind ORDER BY i) AS BIGINT) AS e,
    regexp_replace(v, '[^0-9]', '', 'g') AS digits, replace(v, ' ', '') AS plain FROM raw),
luhn AS (SELECT *, e - length(v) AS s, CASE WHEN kind = 'card' AND length(digits) BETWEEN 14 AND 19 THEN
      list_sum(list_transform(string_split(reverse(digits), ''),
        lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT)
          ELSE CAST(c AS INT) * 2 - CASE WHEN CAST(c AS INT) > 4 THEN 9 ELSE 0 END END)) END AS checksum,
    CASE WHEN kind = 'iban' AND length(plain) BETWEEN 15 AND 34 THEN list_reduce(list_prepend(0,
      list_transform(string_split(substr(plain, 5) || substr(plain, 1, 4), ''),
        lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
      lambda a, x: CASE WHEN x < 10 THEN (a * 10 + x) % 97 ELSE (a * 100 + x) % 97 END) END AS rest FROM placed),
ok AS (SELECT l.*, lower(concat(substr(t, greatest(s - {pii.CONTEXT}, 0) + 1, s - greatest(s - {pii.CONTEXT}, 0)), ' ',
      substr(t, e + 1, {pii.CONTEXT}))) AS around
    FROM luhn l JOIN d USING (rid) WHERE CASE kind
      WHEN 'email' THEN true
      WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'), lambda p:
        length(ltrim(p, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(p, '0') AS INT), 0) <= 255))
      WHEN 'card' THEN coalesce(checksum % 10 = 0, false)
      WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
      WHEN 'iban' THEN coalesce(rest = 1, false)
      ELSE NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$') END),
rated AS (SELECT *, least(100, greatest(0, CASE kind {bases} END + CASE WHEN {raised} THEN 25 ELSE 0 END
    - CASE WHEN regexp_matches(around, '(^|[^a-z])({pii.LOWERS})') THEN 25 ELSE 0 END)) AS score FROM ok),
kept AS (SELECT * FROM rated WHERE place < 4 OR score >= {round(pii.ADDED_SCORE * 100)}),
g AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in pii.BASE)},
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < 4), '') AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans,
    count(*) FILTER (place >= 4) AS n_added, string_agg(score, ',' ORDER BY s, place) AS scores
    FROM kept GROUP BY rid)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.BASE)}, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_added, 0) AS n_added, coalesce(scores, '') AS scores
FROM d LEFT JOIN g USING (rid)
"""


@query("op4_pii_spans", _pii_oracle())
def op4(spark, sf_dir):
    return pii.pii_report(table(spark, sf_dir, "documents"))


@query("op5_embedding_groups", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL)) = 0
    AND len(list_filter(x, lambda c: NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    AND list_cosine_similarity(a.x, b.x) >= 0.9),
r(id, other) AS (SELECT a, b FROM l UNION SELECT r.id, l.b FROM r JOIN l ON r.other = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links,
    least(v.vec_id, coalesce((SELECT min(other) FROM r WHERE r.id = v.vec_id), v.vec_id)) AS component_id,
    least(v.vec_id, coalesce((SELECT min(other) FROM r WHERE r.id = v.vec_id), v.vec_id)) = v.vec_id AS kept
FROM v
""")
def op5(spark, sf_dir):
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op6_simhash_groups")
def op6(spark, sf_dir):
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_token_files")
def op7(spark, sf_dir):
    return token_files.write_and_read_back(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query("op8_repeated_paragraphs")
def op8(spark, sf_dir):
    """Every document with its classes of repeated paragraphs and passages, and the runs it loses."""
    return paragraphs.repeated_report(table(spark, sf_dir, "documents"))


@query("op9_compression_quality")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@query("op10_bpe_round_trip")
def op10(spark, sf_dir):
    return bpe.bpe_encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query("op11_hard_negatives", """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda c: floor(256 * c)) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL)) = 0
    AND len(list_filter(embedding, lambda c: NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
p AS (SELECT anchor_id, id, score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INT) AS rank, n.id AS negative_id,
    p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score
    AND 100 * n.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= 5
""")
def op11(spark, sf_dir):
    """Labels of ids divisible by 7 count as the next label, anchors are the ids divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(vectors)


@query("op12_phrases", r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
f AS (SELECT lang, ws[i:i + k - 1] AS x, count(*) AS a FROM s, (VALUES (1), (2), (3), (4)) t(k)
    WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM s GROUP BY lang),
c AS (SELECT * FROM f WHERE len(x) > 1),
cuts AS (SELECT lang, x, a, unnest(range(1, len(x))) AS k FROM c),
scored AS (SELECT q.*, l.a AS l, r.a AS r, CAST(2000000::HUGEINT * q.a // (l.a + r.a) AS BIGINT) AS score FROM cuts q
    JOIN f l ON l.lang = q.lang AND l.x = q.x[1:k] JOIN f r ON r.lang = q.lang AND r.x = q.x[k + 1:]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, k) = 1),
inside AS (SELECT lang, a AS longer, x[j:j + m - 1] AS x FROM (SELECT lang, a, x, m, unnest(range(1, len(x) - m + 2)) AS j
    FROM c, (VALUES (2), (3)) t(m) WHERE m < len(x))),
kept AS (SELECT * FROM lowest q WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = q.lang AND i.x = q.x
    AND 100::HUGEINT * i.longer >= 80::HUGEINT * q.a)),
ranked AS (SELECT lang, array_to_string(x, ' ') AS phrase, a, l, r, score, row_number() OVER (PARTITION BY lang
    ORDER BY score DESC, a DESC, array_to_string(x, ' ')) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""")
def op12(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _rules_oracle() -> str:
    white = quality_rules.WHITE[1:-1]
    rates = {"symbol_rate": "n_symbols * 1000 // n_words", "word_size": "word_chars * 100 // n_words",
             "stutter_rate": "n_stutters * 1000 // n_words",
             "dup_line_rate": "n_dup_lines * 1000 // greatest(n_lines, 1)",
             "repeat_rate": "n_repeat_words * 1000 // n_words"}
    judged = quality_rules.JUDGED
    values = " UNION ALL ".join(f"SELECT rid, lang, source, '{m}' AS measure, {sql} AS v, {judged[m][0]} AS least,"
                                f" {judged[m][1]} AS two_sided FROM ok" for m, sql in rates.items())

    def quartiles(by):
        keys = "".join(f"{b}, " for b in by)
        return (f"SELECT {keys}measure, max(total) AS total, min(bin) FILTER (4 * upto >= total) AS q1,"
                f" min(bin) FILTER (4 * upto >= 3 * total) AS q3 FROM (SELECT {keys}measure, bin,"
                f" sum(count(*)) OVER (PARTITION BY {keys}measure ORDER BY bin) AS upto,"
                f" sum(count(*)) OVER (PARTITION BY {keys}measure) AS total FROM b GROUP BY {keys}measure, bin)"
                f" GROUP BY {keys}measure")

    def chosen(q):
        return (f"CASE WHEN own.total >= {quality_rules.LEAST_GROUP} THEN own.{q}"
                f" WHEN language.total >= {quality_rules.LEAST_GROUP} THEN language.{q} ELSE every.{q} END")

    failed = ", ".join(f"max(measure) FILTER (measure = '{m}' AND beyond)" for m in judged)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^{white}]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{white}]')) AS lines FROM d),
wins AS (SELECT rid, i, words[i:i + 7] AS win FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM wins) WHERE c > 1),
covered AS (SELECT rid, sum(least(8, coalesce(following - i, 8))) AS n FROM (
    SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following FROM again) GROUP BY rid),
m AS (SELECT rid, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '{quality_rules.SYMBOLS}', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(words, lambda x, i: i > 1 AND x = words[i - 1])) AS n_stutters,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN covered USING (rid)),
ok AS (SELECT * FROM m WHERE NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)),
x AS ({values}),
b AS (SELECT *, v - v % (1 << greatest(length(bin(v)) - 6, 0)) AS bin FROM x),
own AS ({quartiles(["lang", "source"])}), language AS ({quartiles(["lang"])}), every AS ({quartiles([])}),
q AS (SELECT own.lang, own.source, own.measure, {chosen("q1")} AS q1, {chosen("q3")} AS q3 FROM own
    JOIN language ON own.measure = language.measure AND own.lang IS NOT DISTINCT FROM language.lang
    JOIN every ON own.measure = every.measure),
f AS (SELECT rid, x.measure, v > q3 + 3 * greatest(q3 - q1, least) OR (two_sided AND v < q1 - 3 * greatest(q3 - q1, least))
    AS beyond FROM x JOIN q ON x.measure = q.measure AND x.lang IS NOT DISTINCT FROM q.lang
    AND x.source IS NOT DISTINCT FROM q.source),
g AS (SELECT rid, concat_ws(',', {failed}) AS failed FROM f GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, g.rid IS NULL AS base_failed,
    coalesce(failed = '', false) AS kept, coalesce(failed, '') AS failed FROM m LEFT JOIN g USING (rid)
"""


@query("op13_quality_rules", _rules_oracle())
def op13(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))
