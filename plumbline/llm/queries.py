"""Thin queries over the operators, with production parameters, and SQL where it can say
the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    byte_bpe,
    chat_format,
    jaccard_join,
    licenses,
    near_vectors,
    packing,
    periodic_runs,
    quality_rules,
    suffix_family,
    token_alignment,
    token_counts,
    toxicity,
    url_filter,
)
from plumbline.llm.common import Column, let, load, words_of

# Quality rules --------------------------------------------------------------------------


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(load(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(entries)


SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL_MEASURES = rf"""
    d AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_WORDS} AS w FROM documents),
    windows AS (
        SELECT doc_id, unnest(range(len(w) - 2)) AS i,
            unnest(list_transform(range(len(w) - 2), lambda k: w[k + 1] || ' ' || w[k + 2] || ' ' || w[k + 3])) AS x
        FROM d WHERE len(w) >= 3),
    found AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, x) >= 2),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n
        FROM found, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
        list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS word_chars,
        len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(lines.n, 0)::BIGINT AS n_lines, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: x = upper(x) AND x <> lower(x)))::BIGINT AS n_loud_words
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)),
    l AS (SELECT doc_id, n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols, n_lines,
        n_dup_lines, n_repeat_words, n_loud_words, (
            CASE WHEN n_words < 50 THEN 1 ELSE 0 END
            + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
            + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
            + CASE WHEN 10 * n_loud_words > 4 * n_words THEN 16 ELSE 0 END
            + CASE WHEN coalesce(word_chars, 0) < 2 * n_words THEN 32 ELSE 0 END
            + CASE WHEN coalesce(word_chars, 0) > 12 * n_words THEN 64 ELSE 0 END)::INT AS fail_bits
        FROM m)"""

SQL_OP7 = f"""
    WITH {SQL_MEASURES}
    SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits & 23 = 0 AS kept FROM l"""


# Near-duplicate texts, toxicity, packing ------------------------------------------------


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(load(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return packing.pack_tokens(load(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


# Tokens ---------------------------------------------------------------------------------


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    counted = token_counts.prefix_counts(load(spark, sf_dir, "documents"), model)
    return token_counts.with_totals(counted)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(load(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = byte_bpe.decode(encoded, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.ids_text(F.col("ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align_corpus(load(spark, sf_dir, "documents"), a, b)


# Periodic runs ---------------------------------------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in every tenth document by the hash h of its id the words from
    place a on repeat with period p, both given by h and the number of words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rewritten(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        again = lambda i: F.get(words, (a + (i - a) % p).cast("int"))
        return F.transform(words, lambda word, i: F.when(i < a, word).otherwise(again(i)))

    planted = F.array_join(let(words_of(F.coalesce("text", F.lit(""))), rewritten), " ")
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run (ties: first start, then period) and digests of all runs and of the rest."""
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), -r["start"], -r["period"], r.alias("run")))
    best = F.array_max(ranked)["run"]
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs.find_runs(with_planted_runs(load(spark, sf_dir, "documents"))))


# Repeated passages -----------------------------------------------------------------------


def op13_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_family.remove_repeats(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        suffix_family.removed_bytes(F.col("starts"), F.col("ends")).alias("n_removed"),
        F.when(F.col("starts").isNull(), 0).otherwise(F.size("starts")).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# Vectors, chats -------------------------------------------------------------------------


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.vector_links(load(spark, sf_dir, "embeddings"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(load(spark, sf_dir, "conversations"))


SQL_OP1 = """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    linked AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
        WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a),
    n AS (SELECT a, count(*) AS n FROM linked GROUP BY a),
    c AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.c AS component_id, vec_id = c.c AS kept,
        min(vec_id) OVER (PARTITION BY v.e) AS class_id,
        (coalesce(n.n, 0) - count(*) OVER (PARTITION BY v.e) + 1)::BIGINT AS n_class_links
    FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""

# Licences -------------------------------------------------------------------------------


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(load(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
    )


def _sql_op4() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    names = " ".join(f"WHEN {quote(s)} THEN {quote(n)}" for s, n in licenses.KNOWN.items())
    known = ", ".join(map(quote, licenses.KNOWN))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def ids(pattern: str) -> str:
        cut = f"string_split(regexp_replace(t, '{pattern}', chr(1), 'g'), chr(1))"
        clean = f"list_transform({cut}, lambda s: trim(regexp_replace(s, '{licenses.OTHER}', ' ', 'g')))"
        return f"list_transform(list_filter({clean}, lambda s: s IN ({known})), lambda s: CASE s {names} END)"

    chain = "SELECT doc_id, ids, list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '') AS l, []::VARCHAR[] AS f FROM i"
    for name, sequence in licenses.RULES:
        marks = "".join(f"<{part}>" for part in sequence)
        chain = (
            f"SELECT doc_id, ids, replace(l, '{marks}', '|') AS l, "
            f"CASE WHEN contains(l, '{marks}') THEN list_append(f, '{name}') ELSE f END AS f FROM ({chain})"
        )
    return f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') AS t FROM documents),
        s AS (SELECT doc_id, {ids(licenses.END)} AS a, {ids(chr(92) + "n")} AS b FROM d),
        i AS (SELECT doc_id, CASE WHEN len(b) > len(a) THEN b ELSE a END AS ids FROM s)
        SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ' ') AS sentence_ids,
            array_to_string(list_sort(list_distinct(f)), ',') AS licences FROM ({chain})"""


SQL_OP4 = _sql_op4()

# Pages ----------------------------------------------------------------------------------


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_pages(load(spark, sf_dir, "pages"))


def _sql_op6() -> str:
    rest = "regexp_extract(coalesce({0}, ''), '(?s)^.*?://(.*)$', 1)"
    low = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = low.format(f"regexp_extract({rest.format('url')}, '^[^/?#]*', 0)")
    path = f"regexp_extract({rest.format('url')}, '^[^/?#]*([^?#]*)', 1)"
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, rules)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, rules)) + " END"
    link = url_filter.LINK.replace("'", "''")
    units, damping = url_filter.UNITS, url_filter.DAMPING
    rounds = "m0 AS (SELECT kind, host, seed AS mass FROM seeds)"
    for k in range(url_filter.ROUNDS):
        rounds += f""",
        m{k + 1} AS (SELECT kind, host, sum(mass)::BIGINT AS mass FROM (
            SELECT s.kind, s.b AS host, floor({damping}::DOUBLE * m.mass * s.links / s.total)::BIGINT AS mass
            FROM shares s JOIN m{k} m ON m.kind = s.kind AND m.host = s.a
            UNION ALL SELECT kind, host, floor((1 - {damping}::DOUBLE) * seed)::BIGINT FROM seeds
                WHERE (SELECT count(*) FROM shares) > 0
            UNION ALL SELECT kind, host, seed FROM seeds WHERE (SELECT count(*) FROM shares) = 0)
            GROUP BY kind, host)"""
    return f"""
        WITH p AS (SELECT page_id, html, url, {host} AS host, {path} AS path FROM pages),
        j AS (SELECT *, {rule} AS rule, {verdict} AS v FROM p),
        e AS (SELECT host AS src, {low.format("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst
            FROM p WHERE url IS NOT NULL),
        edges AS (SELECT src, dst, count(*) AS links FROM e WHERE src <> dst AND src <> '' GROUP BY src, dst),
        both_ways AS (SELECT 'trust' AS kind, src AS a, dst AS b, links FROM edges
            UNION ALL SELECT 'distrust', dst, src, links FROM edges),
        shares AS (SELECT *, sum(links) OVER (PARTITION BY kind, a) AS total FROM both_ways),
        h AS (SELECT host, max(v = 'allow') AS t, max(rule = 'net/') AS b FROM j WHERE rule IS NOT NULL GROUP BY host),
        seeds AS (SELECT 'trust' AS kind, host, {units}::BIGINT AS seed FROM h WHERE t
            UNION ALL SELECT 'distrust', host, {units}::BIGINT FROM h WHERE b AND NOT t),
        {rounds},
        g AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN mass ELSE 0 END) AS t,
            sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END) AS d FROM m{url_filter.ROUNDS} GROUP BY host)
        SELECT page_id, j.host, path, rule, coalesce(v, CASE WHEN coalesce(d, 0) >= {int(url_filter.DISTRUST * units)}
            AND coalesce(d, 0) > coalesce(t, 0) THEN 'block' ELSE 'allow' END) AS verdict,
            coalesce(t, 0) / {units} AS trust, coalesce(d, 0) / {units} AS distrust
        FROM j LEFT JOIN g ON g.host = j.host"""


SQL_OP6 = _sql_op6()
