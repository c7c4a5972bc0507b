"""The operators as named queries over whole tables, and SQL twins where SQL can
say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chats, collocations, language, lines, minhash, negatives, packing, quality, scoring, segments, suffixes, toxicity, vectors
from .common import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def byte_bpe() -> dict[str, str]:
    """The public byte-level vocabulary, for both libraries that read it."""
    import public_tokenizers

    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), **byte_bpe())


@query("op2_counterfactual_toxicity")
def counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query(
    "op8_line_windows",
    r"""
    WITH docs AS (
      SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
    ), held AS (
      SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k
      FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM docs)
      WHERE NOT regexp_full_match(line, '\s*')
    ), spans AS (
      SELECT doc_id, k, i AS i1, line AS l1,
             lead(i, 1) OVER w AS i2, lead(line, 1) OVER w AS l2,
             lead(i, 2) OVER w AS i3, lead(line, 2) OVER w AS l3
      FROM held WINDOW w AS (PARTITION BY doc_id ORDER BY k)
    ), later AS (
      SELECT * FROM spans WHERE i3 IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, k) > 1
    ), gone AS (
      SELECT doc_id, i1 AS i FROM later UNION SELECT doc_id, i2 FROM later
      UNION SELECT doc_id, i3 FROM later
    ), counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
    rest AS (
      SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text
      FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM docs)
      ANTI JOIN gone USING (doc_id, i)
      GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(coalesce(len(lines), 0) AS INTEGER) AS n_lines,
           CAST(coalesce(n, 0) AS INTEGER) AS n_removed,
           CASE WHEN n IS NULL THEN d.text ELSE coalesce(r.text, '') END AS text
    FROM docs d LEFT JOIN counts USING (doc_id) LEFT JOIN rest r USING (doc_id)
    """,
)
def line_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.without_repeats(read(spark, folder, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_removed", F.col("kept").alias("text"))


@query("op4_prob_minhash")
def prob_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.classified(read(spark, folder, "documents"))


@query("op3_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = suffixes.cut_repeats(read(spark, folder, "documents").select("doc_id", "text"))
    sha = F.sha2(F.coalesce("kept", F.lit("").cast("binary")), 256)
    # What is left itself too: by contract, n_bytes is the size of what went in.
    return left.select("row.doc_id", "n_bytes", "n_removed", "n_spans", sha.alias("kept_sha256"), suffixes.kept_text().alias("text"))


@query(
    "op6_snapshot_collapse",
    r"""
    WITH turns AS (
      SELECT *, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns
      FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)
    ), paths AS (
      SELECT *, string_agg(md5(coalesce('r' || role, '')) || md5(coalesce('t' || text, '')), '')
        OVER (PARTITION BY conv_id ORDER BY position) AS path
      FROM turns
    ), kept AS (
      SELECT min(conv_id) AS conv_id FROM paths WHERE position = n_turns
        AND path NOT IN (SELECT path FROM paths WHERE position < n_turns)
      GROUP BY path
    )
    SELECT conv_id, position, n_turns,
           '<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '')
             || '<|end|>' || chr(10) AS rendered
    FROM turns SEMI JOIN kept USING (conv_id)
    """,
)
def snapshot_collapse(spark: SparkSession, folder: str) -> DataFrame:
    return chats.rendered(read(spark, folder, "conversations"))


@query(
    "op9_host_rules",
    r"""
    WITH held AS (
      SELECT doc_id, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
      FROM documents
    ), grams AS (
      SELECT doc_id, unnest(generate_series(1, len(words) - 4)) AS i, words FROM held WHERE len(words) >= 5
    ), spelt AS (
      SELECT doc_id, i, words[i : i + 4] AS gram FROM grams
    ), twice AS (
      SELECT doc_id, i FROM spelt QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
    ), covered AS (
      SELECT doc_id, sum(least(5, coalesce(next - i, 5))) AS n
      FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM twice)
      GROUP BY doc_id
    ), lines AS (
      SELECT doc_id, count(*) - count(DISTINCT line) AS n
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM held)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
    ), measured AS (
      SELECT h.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
      FROM held h LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)
    ), judged AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
    ), hosts AS (
      SELECT source, count(*) AS n,
             count(*) FILTER (base_failed OR 10 * n_symbols > n_words
               OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS f
      FROM judged WHERE source IS NOT NULL GROUP BY source
    ), prior AS (
      SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS v FROM hosts
    ), strength AS (
      SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 2.0), 1000.0) ELSE 1000.0 END AS s
      FROM prior
    ), rates AS (
      SELECT source, (f + m * s) / (n + s) AS rate FROM hosts, strength
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(rate, 0) <= 0.5 AS kept
    FROM judged LEFT JOIN rates USING (source)
    """,
)
def host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read(spark, folder, "documents")).drop("host_rate")


@query("op10_p_stable_vectors")
def p_stable_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(read(spark, folder, "embeddings"))


@query("op5_attention_scores")
def attention_scores(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_texts(read(spark, folder, "documents"), byte_bpe())


@query("op7_gumbel_segmentations")
def gumbel_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return segments.segmentations(read(spark, folder, "documents"), model)


@query(
    "op11_stripe_collocations",
    r"""
    WITH pieces AS (
      SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS words
      FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
      )
    ), places AS (
      SELECT lang, words, unnest(generate_series(1, len(words))) AS i FROM pieces WHERE len(words) > 0
    ), sizes AS (
      SELECT lang, count(*) AS n FROM places GROUP BY lang
    ), phrases AS (
      SELECT lang, array_to_string(words[i : i + k - 1], ' ') AS phrase, k, count(*) AS f
      FROM places, (VALUES (1), (2), (3), (4)) AS lengths(k)
      WHERE i + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 30
    ), candidates AS (
      SELECT lang, phrase, string_split(phrase, ' ') AS words, k, f AS a FROM phrases WHERE k >= 2
    ), inner_phrases AS (
      SELECT lang, k, words, a, i, m
      FROM candidates, (VALUES (1), (2), (3)) AS starts(i), (VALUES (2), (3)) AS lengths(m)
      WHERE m < k AND i + m - 1 <= k
    ), around AS (
      SELECT lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, max(a) AS longer
      FROM inner_phrases GROUP BY ALL
    ), alone AS (
      SELECT c.* FROM candidates c LEFT JOIN around o USING (lang, phrase)
      WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT
    ), cuts AS (
      SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, 2000000 * a::HUGEINT // (l.f::HUGEINT + r.f) AS score
      FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM alone) c
      JOIN phrases l ON l.lang = c.lang AND l.phrase = array_to_string(words[1 : cut], ' ')
      JOIN phrases r ON r.lang = c.lang AND r.phrase = array_to_string(words[cut + 1 :], ' ')
    ), scored AS (
      SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
    )
    SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
    """,
)
def stripe_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"))


@query("op12_ppm_language")
def ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(read(spark, folder, "documents"))


@query(
    "op13_coordinate_negatives",
    """
    WITH given AS (
      SELECT row_number() OVER () AS row, vec_id AS id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * x::DOUBLE) FOR x IN embedding] AS vector
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
      SELECT a.row AS anchor, a.id AS anchor_id, a.label AS of, b.row, b.id, b.label,
             CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
      FROM given a JOIN given b ON a.row <> b.row AND len(a.vector) = len(b.vector)
      WHERE a.id % 100 = 0
    ), positives AS (
      SELECT anchor, id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place
      FROM scored WHERE of = label QUALIFY place <= 5
    )
    SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor, place ORDER BY score DESC, id) AS INTEGER) AS rank
    FROM scored JOIN positives USING (anchor)
    WHERE of <> label AND 30 * positive_score::HUGEINT <= 100 * score::HUGEINT
      AND 100 * score::HUGEINT <= 90 * positive_score::HUGEINT
    QUALIFY rank <= 10
    """,
)
def coordinate_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, folder, "embeddings"), anchors=F.col("id") % 100 == 0, label=moved)
