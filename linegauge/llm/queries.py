"""One query per operator over its whole table, with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm import (centroids, decontaminate, licenses, mixing, mixlm, periodic, pii, quality, secrets, sharding, simhash, urlfilter,
                           warc)
from linegauge.llm.common import documents, stored
from linegauge.session import scratch_path

SHARDS = 24

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sql_words(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP2_SQL = f"""
WITH d AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {sql_words('text')} AS w FROM benchmark),
bw AS (SELECT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS win
       FROM (SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s
             FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
             FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, s, k, item_id FROM dw JOIN bw USING (k, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_secrets")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf))
    base = F.col("base")
    return found.select("doc_id", *[secrets.count_kind(base, k).alias(f"n_{k}") for k in secrets.STRONG],
                        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


@query("op2_decontaminate", OP2_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf), documents(spark, sf, "benchmark"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def sql_uniform(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {mixing.HEX_DIGITS}) AS BIGINT) / {float(16 ** mixing.HEX_DIGITS)!r}"


OP3_SQL = f"""
WITH sizes AS (SELECT source, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY source),
rates AS (SELECT source, pow(chars, {mixing.FLATTEN}) / (SELECT sum(pow(chars, {mixing.FLATTEN})) FROM sizes)
                 * (SELECT sum(chars) FROM sizes) / chars AS rate FROM sizes),
steps AS (SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
          FROM (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 10 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k FROM rates)),
drawn AS (SELECT d.*, {sql_uniform(f"'{mixing.SEED}:' || doc_id")} AS u FROM documents d),
counts AS (SELECT doc_id, count(*) AS n FROM drawn JOIN steps ON drawn.source = steps.source AND cdf <= u GROUP BY doc_id)
SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy
FROM documents JOIN counts USING (doc_id)
"""


@query("op3_mix_sources", OP3_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_TEMPLATES = [(n, text, label, n < len(licenses.PHRASES)) for n, (text, label) in
              enumerate([*licenses.PHRASES.items(), *licenses.NOTICES.items()])]
OP4_SQL = f"""
WITH t(template, body, label, is_phrase) AS (VALUES {_values(_TEMPLATES)}),
tw AS (SELECT template, label, is_phrase, string_split(body, ' ') AS w, len(string_split(body, ' ')) - 1 AS pairs FROM t),
tp AS (SELECT template, label, is_phrase, pairs, i, w[i + 1] || ' ' || w[i + 2] AS pair
       FROM (SELECT *, unnest(range(0, pairs)) AS i FROM tw)),
d AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
dp AS (SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] AS pair
       FROM (SELECT doc_id, w, unnest(range(0, len(w) - 1)) AS i FROM d WHERE len(w) > 1)),
v AS (SELECT doc_id, template, label, is_phrase, pairs, dp.i - tp.i AS diagonal, tp.i AS spot FROM dp JOIN tp USING (pair)),
base AS (SELECT doc_id, label, diagonal FROM v WHERE is_phrase
         GROUP BY doc_id, template, label, pairs, diagonal HAVING count(DISTINCT spot) = pairs),
diagonals AS (SELECT DISTINCT doc_id, template, label, pairs, diagonal FROM v WHERE NOT is_phrase),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {licenses.SLACK} THEN 0 ELSE 1 END AS step
          FROM diagonals WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
spans AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM steps),
notices AS (SELECT doc_id, label, count(DISTINCT spot) / pairs AS cover
            FROM spans JOIN v USING (doc_id, template, label, pairs, diagonal) GROUP BY doc_id, template, label, pairs, span),
b AS (SELECT doc_id, count(*) AS n, min(diagonal) AS lo, max(diagonal) AS hi,
             array_to_string(list_sort(list(DISTINCT label)), ',') AS labels FROM base GROUP BY doc_id),
a AS (SELECT doc_id, coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (ok)), ','), '') AS labels, max(cover) AS score
      FROM (SELECT doc_id, label, 1.0 AS cover, true AS ok FROM base
            UNION ALL SELECT doc_id, label, cover, cover >= {licenses.COVER} FROM notices) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word,
       CAST(hi AS BIGINT) AS last_word, coalesce(b.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id)
"""


@query("op4_licenses", OP4_SQL)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf))


_RULES = sorted(((h + p, v, h, p) for v, h, p in urlfilter.RULES), key=lambda r: -len(r[0]))
OP5_SQL = f"""
WITH u AS (SELECT page_id, position('://' IN coalesce(url, '')) AS mark, url FROM pages),
r AS (SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM u),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (SELECT *, CASE {" ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{r}'" for r, _, h, p in _RULES)}
                END AS rule,
             len(list_intersect(string_split(host, '.'), {list(urlfilter.LISTED_LABELS)!r})) > 0 AS listed FROM p)
SELECT page_id, host, path, rule,
       CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v, _, _ in _RULES)} WHEN listed THEN 'block' ELSE 'allow' END AS verdict,
       listed
FROM j
"""


@query("op5_url_filter", OP5_SQL)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    pages = documents(spark, sf, "pages")
    block_list = stored(urlfilter.hosts_with_labels(pages), "block-list")
    return urlfilter.judge(pages, block_list)


@query("op6_quality")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.quality(documents(spark, sf), documents(spark, sf, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query("op7_shards")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs, path = documents(spark, sf), scratch_path(spark, "slot-map")
    sharding.plan_by_chars(docs, SHARDS, path)
    return sharding.shard_documents(docs, SHARDS, path)


OP8_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first_id FROM p WHERE n >= {warc.MIN_REVISIT} GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest
"""


@query("op8_warc", OP8_SQL)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(documents(spark, sf, "pages"), scratch_path(spark, "warc"))


@query("op9_simhash")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf))


@query("op10_language_model")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return mixlm.score(documents(spark, sf))


@query("op11_personal_data")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.extract(documents(spark, sf))
    base = F.col("base")
    return found.select("doc_id", *[pii.count_kind(base, k).alias(f"n_{k}") for k in pii.STRICT],
                        F.sha2(pii.span_text(base).cast("binary"), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def _op12_rounds() -> str:
    """Assignment a<n> and centroids c<n + 1> of every round."""
    out = []
    for n in range(centroids.ROUNDS + 1):
        out.append(f"""a{n} AS MATERIALIZED (
    SELECT r, min(CAST(list_inner_product(v.f, v.f) - 2 * list_inner_product(v.f, c.f) + list_inner_product(c.f, c.f) AS BIGINT)
                  * {centroids.CLUSTERS} + c.c) AS best FROM v, c{n} c GROUP BY r)""")
        if n < centroids.ROUNDS:
            out.append(f"""s{n} AS (
    SELECT c, d, count(*) AS n, CAST(sum(CAST(f[d] AS BIGINT)) AS BIGINT) AS s
    FROM (SELECT best % {centroids.CLUSTERS} AS c, f, unnest(range(1, {centroids.DIMENSIONS + 1})) AS d FROM a{n} JOIN v USING (r)) GROUP BY c, d),
c{n + 1} AS MATERIALIZED (
    SELECT c{n}.c, coalesce(m.f, c{n}.f) AS f
    FROM c{n} LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY d) AS f FROM s{n} GROUP BY c) m ON m.c = c{n}.c)""")
    return ",\n".join(out)


OP12_SQL = f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * CAST(x AS DOUBLE))) AS f
    FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS}
         AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMENSIONS}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, f) - 1 AS c, f
    FROM (SELECT sha256('{centroids.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, f FROM v ORDER BY h, f LIMIT {centroids.CLUSTERS})),
{_op12_rounds()},
d AS (SELECT vec_id, best % {centroids.CLUSTERS} AS c, best // {centroids.CLUSTERS} AS distance FROM a{centroids.ROUNDS} JOIN v USING (r))
SELECT vec_id, CAST(d.c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY d.c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(e.f, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM d JOIN c{centroids.ROUNDS} e ON e.c = d.c
"""


@query("op12_centroid_clusters", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.with_centroid_digests(*centroids.cluster(documents(spark, sf, "embeddings")))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic.periodic_runs(documents(spark, sf), repeat_tails=True)
    line = lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "start", "length", "period",
                        F.expr("(1000 * length) div period").alias("exponent_milli"),
                        digest(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))
