"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sealframe.llm import quality_rules as rules
from sealframe.llm.classifier import measured, scored, trained
from sealframe.llm.collocations import collocations
from sealframe.llm.html_text import main_text
from sealframe.llm.id_files import read_ids, write_ids
from sealframe.llm.mixing import mix
from sealframe.llm.negatives import hard_negatives
from sealframe.llm.ngram_join import jaccard_classes
from sealframe.llm.packing import pack_documents
from sealframe.llm.passages import repeated_passages
from sealframe.llm.shared import kept, read, with_package
from sealframe.llm.topk import top_k
from sealframe.llm.url_filter import filter_urls, rule_table
from sealframe.llm.warc import read_pages, write_pages
from sealframe.session import shared_folder


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("tie")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    risk = rules.Risk()
    measured = kept(rules.measures(read(spark, sf_dir, "documents"), ["doc_id", "lang"]))
    cutoffs = rules.calibrate(rules.labelled_rows(measured, read(spark, sf_dir, "labels")), risk)
    return rules.verdicts(measured, cutoffs, risk).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/ids"
    write_ids(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), corpus_pipeline.END_ID)
    return read_ids(spark, path)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"), corpus_pipeline.WEIGHTS, corpus_pipeline.SEED)


_SOURCE_MIX = """
    WITH docs AS (SELECT *, coalesce(length(text), 0) + 1 AS size,
                         CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN source ELSE '' END AS g,
                         coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) AS name,
                         coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS plain FROM documents),
    weights(g, share) AS (VALUES ('src0', 0.2::DOUBLE), ('src1', 0.1::DOUBLE), ('src2', 0.1::DOUBLE), ('src3', 0.02::DOUBLE),
                                 ('', 1 - (0.2::DOUBLE + 0.1 + 0.1 + 0.02))),
    rates AS (SELECT g, share * (SELECT CAST(sum(size) AS DOUBLE) FROM docs) / CAST(sum(size) AS DOUBLE) AS rate
              FROM docs JOIN weights USING (g) GROUP BY g, share),
    steps AS (SELECT g, CAST(k AS INTEGER) AS k, sum(exp(-rate + k * ln(rate) - CASE WHEN k < 2 THEN 0 ELSE lgamma(k + 1) END))
                     OVER (PARTITION BY g ORDER BY k) AS p
              FROM (SELECT g, rate, unnest(range(CAST(rate + 20 * sqrt(rate) + 100 AS BIGINT))) AS k FROM rates WHERE rate > 0)),
    drawn AS (SELECT d.*, CAST('0x' || substr(md5('17:' || name), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u FROM docs d),
    counted AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.plain,
                       (SELECT count(*) FROM steps s WHERE s.g = d.g AND s.p <= d.u) AS n FROM drawn d)
    SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
           CAST('0x' || substr(md5('17s:' || plain || ':' || copy), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS place
    FROM (SELECT *, unnest(range(n)) AS copy FROM counted)"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), corpus_pipeline.END_ID)


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 50 == 0)


_TOP_K = """
    WITH points AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                    FROM embeddings
                    WHERE vec_id IS NOT NULL AND len(embedding) > 0
                      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
               FROM points q JOIN points c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


_NGRAM_JACCARD = r"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    grams AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS x
              FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
    sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
    pairs AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM grams a JOIN grams b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes s ON s.r = a JOIN sizes t ON t.r = b WHERE 100 * k >= 75 * (s.n + t.n - k)),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach(r, s) AS (SELECT r, r FROM d UNION SELECT reach.r, ways.b FROM reach JOIN ways ON reach.s = ways.a)
    SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(e.doc_id) AS component_id
    FROM d JOIN reach USING (r) JOIN d e ON e.r = reach.s LEFT JOIN sizes ON sizes.r = d.r GROUP BY d.r, d.doc_id"""


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


_URL_FILTERS = r"""
    WITH rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
            ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    parts AS (SELECT row_number() OVER () AS i, page_id,
                     coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                     coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
    hits AS (SELECT i, r.host || r.path AS rule, verdict,
                    row_number() OVER (PARTITION BY i ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, verdict DESC) AS n
             FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN hits USING (i)
    WHERE coalesce(n, 1) = 1"""


def _quality_rules_sql() -> str:
    """The same measures over unnested words, and exact binomial sums for the cutoffs."""
    risk = rules.Risk()
    tests = (len(risk.strata) + 1) * len(rules.RULES) * len(risk.ladder)
    strata, ladder = ", ".join(f"'{s}'" for s in risk.strata), ", ".join(f"({c})" for c in risk.ladder)
    rate, doubt = risk.share / len(rules.RULES), risk.doubt / tests
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
                FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) AS v(j) GROUP BY r),
    lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS again
              FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    measured AS (SELECT d.r, doc_id, CASE WHEN lang IN ({strata}) THEN lang ELSE 'other' END AS stratum, CAST(len(w) AS BIGINT) AS n_words,
                        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                        coalesce(lines.again, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines
                 FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
    based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured),
    valued AS (SELECT r, doc_id, stratum, base_failed, unnest([
                   {{'rule': 'symbols', 'v': 1000 * n_symbols / CAST(greatest(word_chars, 1) AS DOUBLE)}},
                   {{'rule': 'repeats', 'v': 1000 * n_repeat_words / CAST(greatest(n_words, 1) AS DOUBLE)}},
                   {{'rule': 'lines', 'v': 1000 * n_dup_lines / CAST(greatest(n_lines, 1) AS DOUBLE)}}]) AS m FROM based),
    good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
    counts AS (SELECT stratum, m.rule AS rule, cutoff, count(*) AS n, count(CASE WHEN m.v > cutoff THEN 1 END) AS k
               FROM valued JOIN good USING (doc_id), (VALUES {ladder}) AS l(cutoff) WHERE NOT base_failed GROUP BY ALL),
    passed AS (SELECT stratum, rule, cutoff FROM counts, unnest(range(k + 1)) AS u(j) GROUP BY stratum, rule, cutoff, n, k
               HAVING k < n * {rate!r}::DOUBLE AND sum(exp(CASE WHEN j = 0 THEN 0 ELSE lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) END
                          + j * ln({rate!r}::DOUBLE) + (n - j) * ln(1 - {rate!r}::DOUBLE))) <= {doubt!r}::DOUBLE),
    cutoffs AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM passed GROUP BY stratum, rule),
    rejected AS (SELECT DISTINCT r FROM valued JOIN cutoffs ON valued.stratum = cutoffs.stratum AND m.rule = cutoffs.rule AND m.v > cutoff)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND r NOT IN (SELECT r FROM rejected) AS kept FROM based"""


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = kept(measured(read(spark, sf_dir, "documents")))
    return scored(stats, trained(stats, read(spark, sf_dir, "labels")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, label)


_HARD_NEGATIVES = """
    WITH p AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.r AS a, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
                 CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda x: x[1] * x[2])), 0) AS BIGINT) AS score
          FROM p a JOIN p c ON a.vec_id % 100 = 0 AND a.r <> c.r AND len(a.v) = len(c.v)),
    positives AS (SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) AS slot
                  FROM s WHERE same QUALIFY slot <= 5)
    SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, slot ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN s ON p.a = s.a AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10"""


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


_COLLOCATIONS = r"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w
               FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?
-
]')) AS piece FROM d)),
    counts AS (SELECT lang, w[i:i + k - 1] AS g, k, count(*) AS f
               FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS s(k) WHERE len(w) >= k) GROUP BY ALL),
    totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
    often AS (SELECT * FROM counts WHERE f >= 100),
    within AS (SELECT lang, g[i:j] AS g, max(f) AS f FROM (SELECT lang, g, k, f, i, unnest(range(i + 1, k + 1)) AS j FROM (
                   SELECT lang, g, k, f, unnest(range(1, k)) AS i FROM often WHERE k > 2)) WHERE j - i + 1 < k GROUP BY ALL),
    kept AS (SELECT o.* FROM often o LEFT JOIN within w ON w.lang = o.lang AND w.g = o.g WHERE k > 1 AND 100 * coalesce(w.f, 0) < 100 * o.f),
    cuts AS (SELECT lang, g, k, f, unnest(range(1, k)) AS c FROM kept),
    scored AS (SELECT x.lang, array_to_string(x.g, ' ') AS phrase, x.f AS a, p.f AS l, q.f AS r, n, c,
                      CAST(1000 * CAST(x.f AS HUGEINT) * n // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
               FROM cuts x JOIN often p ON p.lang = x.lang AND p.g = x.g[1:c] JOIN often q ON q.lang = x.lang AND q.g = x.g[c + 1:] JOIN totals t ON t.lang = x.lang),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM lowest QUALIFY rank <= 2000"""


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archive"
    write_pages(read(spark, sf_dir, "pages"), path)
    return read_pages(spark, path)


_WARC = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS x FROM pages),
    digits AS (SELECT *, CAST(strlen(payload) AS BIGINT) AS payload_bytes, list_transform(range(32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(x, 1 + 10 * CAST(i // 8 AS INTEGER), 10) AS BIGINT)
                          >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER), 1)) AS b FROM p),
    ranked AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS first_id FROM digits
               WINDOW w AS (PARTITION BY payload ORDER BY page_id NULLS LAST))
    SELECT page_id, payload_bytes, array_to_string(b, '') AS payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN k > 1 THEN first_id END AS refers_to FROM ranked"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_token_ids": op1_token_ids,
        "op2_source_mix": op2_source_mix,
        "op3_packing": op3_packing,
        "op4_exact_top_k": op4_exact_top_k,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_url_filters": op6_url_filters,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_quality_rules": op8_quality_rules,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_html_text": op10_html_text,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_collocations": op12_collocations,
        "op13_warc": op13_warc,
        "pipeline": corpus_pipeline.run,
    }
    return {name: with_package(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    found = {
        "op2_source_mix": _SOURCE_MIX,
        "op4_exact_top_k": _TOP_K,
        "op5_ngram_jaccard": _NGRAM_JACCARD,
        "op6_url_filters": _URL_FILTERS,
        "op8_quality_rules": _quality_rules_sql(),
        "op11_hard_negatives": _HARD_NEGATIVES,
        "op12_collocations": _COLLOCATIONS,
        "op13_warc": _WARC,
    }
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
