"""The corpus queries, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    chat, decontaminate, exact, langid, linerules, lm, neardup, negatives, packing, phrases, quality, simple8b,
    warczip,
)
from footfall.llm.common import id_remainder, prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def corpus_query(key: str, oracle: str | None = None):
    def add(fn):
        QUERIES[key] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if oracle:
            ORACLES[key] = oracle
        return fn

    return add




def words_sql(text: str, word: str) -> str:
    """DuckDB: the words of a text, A-Z lower-cased."""
    return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{word}')"


TEST_WORDS = words_sql("coalesce(text, '')", r"[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+")
END_ID = 2
SEQUENCE = 1024


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@corpus_query(
    "op1_decontaminate",
    f"""
    WITH items AS (
      SELECT DISTINCT item_id, {TEST_WORDS} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS p
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
    docs AS (
      SELECT row_number() OVER () AS r, doc_id, {TEST_WORDS} AS w FROM documents),
    places AS (
      SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS p
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
    hits AS (SELECT r, i, p.n, item_id FROM places p JOIN windows v ON v.n = p.n AND v.p = p.p),
    words AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM hits) GROUP BY r),
    found AS (
      SELECT r, count(DISTINCT item_id::VARCHAR) AS n_items,
        string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)""",
)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@corpus_query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    return langid.train_and_identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


CONTROL_PROBE = "</s>[INST] ok [/INST]"


@corpus_query(
    "op3_chat_format",
    rf"""
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{CONTROL_PROBE}'
      UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_PROBE}'),
    sized AS (
      SELECT *, length(role || text) + length(regexp_replace(role || text, '[^<\[|\\]', '', 'g'))
                + length('<||>' || chr(10) || '<|end|>' || chr(10)) AS chars FROM rows)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
        AS loss_sha256,
      sum(chars)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id""",
)
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_PROBE).alias("text"),
    )
    out = chat.render(chat.fold(chat.streamed(rows.unionByName(probe))))
    back = out.select(
        "conv_id",
        chat.turns_of(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@corpus_query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), tokenizer_file(), END_ID, SEQUENCE)
    return packing.pack(pieces, SEQUENCE)


PLAIN_WORDS = words_sql("coalesce(text, '')", r"[^\x20\x09-\x0D]+")


@corpus_query(
    "op5_minhash_near_dedup",
    f"""
    WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN_WORDS} AS w FROM documents),
    shingles AS (
      SELECT DISTINCT r, CASE WHEN len(w) < 5 THEN w ELSE w[i : i + 4] END AS s
      FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
    sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
    common AS (
      SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
    links AS (
      SELECT x, y FROM common JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach(r, q) AS (SELECT r, r FROM docs UNION SELECT reach.r, ways.y FROM reach JOIN ways ON ways.x = reach.q),
    low AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.q GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
    FROM docs JOIN low USING (r) LEFT JOIN sizes USING (r)""",
)
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


@corpus_query("op6_token_files")
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = simple8b.write_ids(table(spark, sf_dir, "documents"), tokenizer_file(), END_ID)
    return simple8b.read_ids(files)


@corpus_query(
    "op7_warc_packages",
    """
    WITH hashed AS (
      SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
    SELECT page_id, strlen(body) AS payload_bytes,
      array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)), '')
        AS payload_digest,
      CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
    FROM hashed""",
)
def op7_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warczip.write_packages(table(spark, sf_dir, "pages"))
    return warczip.read_packages(packages).drop("url")


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.Model:
    return quality.train(docs, table(spark, sf_dir, "labels"), id_remainder(F.col("doc_id"), 5) != 0)


@corpus_query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@corpus_query("op9_lm_scores")
def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    scored = lm.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@corpus_query(
    "op10_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      coalesce(doc_id = max(doc_id) OVER same, false) AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_groups(table(spark, sf_dir, "documents"))


@corpus_query(
    "op11_phrases",
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    grams AS (
      SELECT lang, g, count(*) AS n
      FROM (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS g
            FROM words, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k)
      GROUP BY 1, 2),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
    candidates AS (SELECT lang, g, n AS a FROM grams WHERE len(g) > 1 AND n >= 10),
    cuts AS (
      SELECT c.lang, c.g, a, k, x.n AS l, y.n AS r,
        ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
      FROM (SELECT *, unnest(range(1, len(g))) AS k FROM candidates) c
      JOIN grams x ON x.lang = c.lang AND x.g = c.g[1 : k]
      JOIN grams y ON y.lang = c.lang AND y.g = c.g[k + 1 : len(c.g)]),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
    longer AS (
      SELECT lang, g[i : i + 1] AS g, max(a) AS longest
      FROM (SELECT *, unnest([1, 2]) AS i FROM candidates WHERE len(g) = 3) GROUP BY 1, 2),
    ranked AS (
      SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, array_to_string(c.g, ' ')) AS rank,
        array_to_string(c.g, ' ') AS phrase, a, l, r, t.n, score
      FROM lowest c JOIN totals t ON t.lang = c.lang LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g
      WHERE longest IS NULL OR longest * 100 < a * 50)
    SELECT * FROM ranked WHERE rank <= 2000""",
)
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


CASED_WORDS = r"[^\x{20}\x{09}-\x{0D}]+"


@corpus_query(
    "op12_line_rules",
    f"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '{CASED_WORDS}') AS w FROM documents),
    windows AS (
      SELECT r, i, array_to_string(w[i : i + 7], ' ') AS p
      FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)),
    twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, p) > 1),
    repeats AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS x FROM twice) GROUP BY r),
    lines AS (
      SELECT r, source, md5(t) AS body, line, len(regexp_extract_all(line, '{CASED_WORDS}')) AS words,
        trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
      FROM (SELECT r, source, t, unnest(string_split(t, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{CASED_WORDS}')),
    dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r),
    hosts AS (SELECT source, count(DISTINCT t) AS docs FROM docs GROUP BY source),
    held AS (SELECT source, norm, count(DISTINCT body) AS n FROM lines GROUP BY 1, 2),
    often AS (
      SELECT held.source, norm FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
      WHERE n > 10 AND n * 100 > docs * 5),
    lost AS (
      SELECT r, sum(words) AS n FROM lines JOIN often
      ON lines.norm = often.norm AND lines.source IS NOT DISTINCT FROM often.source GROUP BY r),
    numbers AS (
      SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dups.n, 0)::BIGINT AS n_dup_lines,
        coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, len(w) - coalesce(lost.n, 0)::BIGINT AS left_words
      FROM docs LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
      NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND left_words >= 5 AND 100 * left_words >= 30 * n_words
        AS kept
    FROM numbers""",
)
def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linerules.line_verdicts(table(spark, sf_dir, "documents")).drop("removed", "left_words")


@corpus_query(
    "op13_hard_negatives",
    """
    WITH rows AS (
      SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
      SELECT a.r, a.vec_id AS anchor_id, b.r AS other, b.vec_id, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS s
      FROM rows a JOIN rows b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY r ORDER BY s DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id,
      (row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.s DESC, n.vec_id))::INT AS rank,
      n.vec_id AS negative_id, p.s AS positive_score, n.s AS negative_score
    FROM positives p JOIN pairs n ON n.r = p.r AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s
    QUALIFY rank <= 10""",
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.select("vec_id", flipped.alias("label"), whole.alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)
