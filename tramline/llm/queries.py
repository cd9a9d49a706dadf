"""The operators over the whole given tables, as registered queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import (
    bpe_trie,
    html_template,
    language_id,
    line_winnowing,
    minhash_postings,
    negative_joins,
    paragraph_sketch,
    phrase_subtrees,
    pii_crf,
    positional_index,
    quality_nbsvm,
    simhash_anchors,
    tool_calls,
)
from tramline.llm.tables import read_table


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    encoded = bpe_trie.encode_documents(read_table(spark, folder, "documents"))
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    documents = read_table(spark, folder, "documents")
    model = quality_nbsvm.fit(documents, read_table(spark, folder, "labels"))
    scored = documents.select(
        "doc_id",
        F.coalesce(quality_nbsvm.held_out(), F.lit(False)).alias("held_out"),
        quality_nbsvm.score(model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= quality_nbsvm.THRESHOLD).cast("int"))


# What a question and an answer of a conversation look like as a tool call.
ASK_SCHEMA = {
    "type": "object",
    "required": ["n_chars", "question"],
    "additionalProperties": False,
    "properties": {
        "n_chars": {"type": "integer", "minimum": 1, "maximum": 1000},
        "question": {"type": "string", "minLength": 1},
    },
}


def op3_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as linked tool calls.

    Every turn of a user is a call, every turn of the assistant the result of the turn before
    it, and every system turn a result that nobody asked for; a call depends on the call two turns
    before.
    """
    turns = read_table(spark, folder, "conversations")
    name = F.concat(F.lit("t"), F.col("turn"))
    calls = turns.filter("role = 'user'").select(
        "conv_id",
        name.alias("call_id"),
        "turn",
        F.lit("ask").alias("name"),
        F.to_json(
            F.struct(F.col("text").alias("question"), F.length("text").alias("n_chars"))
        ).alias("arguments"),
        F.array(F.concat(F.lit("t"), F.col("turn") - 2)).alias("depends_on"),
    )
    results = turns.filter("role <> 'user'").select(
        "conv_id",
        F.concat(F.lit("t"), F.col("turn") - (F.col("role") != "system").cast("int")).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    return tool_calls.link_calls(calls, results, {"ask": ASK_SCHEMA})


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = html_template.extract(read_table(spark, folder, "pages"))
    text = F.coalesce("text", F.lit(""))
    return found.withColumns({"text": text, "n_chars": F.length(text).cast("long")})


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    documents = read_table(spark, folder, "documents")
    return language_id.predict(documents, language_id.fit(documents))


def op6_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return paragraph_sketch.fingerprints(read_table(spark, folder, "documents"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    documents = read_table(spark, folder, "documents")
    found = pii_crf.personal_data(documents, pii_crf.fit(documents))

    def listed(spans: str) -> Column:
        texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(texts, ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in pii_crf.KINDS),
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without its repeated runs of lines."""
    return line_winnowing.dedup_lines(read_table(spark, folder, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and class of every document."""
    return simhash_anchors.near_duplicates(read_table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """What of the benchmark every document repeats."""
    found = positional_index.contamination(
        read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the shingle set and class of every document."""
    return minhash_postings.near_duplicates(read_table(spark, folder, "documents"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of every language whose words occur together most."""
    return phrase_subtrees.mine(read_table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its positives."""
    embeddings = read_table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & negative_joins.usable("embedding")
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.alias("label"),
        negative_joins.scaled("embedding", 256).alias("vector"),
    )
    return negative_joins.mine(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_quality": op2_quality,
        "op3_tool_calls": op3_tool_calls,
        "op4_html_extraction": op4_html_extraction,
        "op5_language_id": op5_language_id,
        "op6_document_fingerprints": op6_document_fingerprints,
        "op7_line_dedup": op7_line_dedup,
        "op8_simhash_near_dedup": op8_simhash_near_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_pii": op10_pii,
        "op11_minhash_near_dedup": op11_minhash_near_dedup,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_hard_negatives": op13_hard_negatives,
    }


TOOL_CALLS_SQL = r"""
WITH calls AS (
    SELECT conv_id, turn, text, 't' || turn AS call_id,
           turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run
    FROM conversations WHERE role = 'user'
), levels AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS level
    FROM calls
), results AS (
    SELECT conv_id, 't' || (turn - CASE WHEN role = 'system' THEN 0 ELSE 1 END) AS call_id,
           min(turn) AS first_turn,
           string_agg(to_json(text)::VARCHAR, ',' ORDER BY turn) AS contents
    FROM conversations WHERE role <> 'user' GROUP BY 1, 2
), checked AS (
    SELECT *, '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE
             '"n_chars":' || length(text) || ',"question":' || to_json(text)::VARCHAR END
             || '},"name":"ask"}' AS call,
           CASE WHEN text IS NULL THEN '"$.n_chars: missing","$.question: missing"'
                WHEN text = '' THEN '"$.question: below minLength","$.n_chars: below minimum"'
                WHEN length(text) > 1000 THEN '"$.n_chars: above maximum"' END AS problems
    FROM levels
)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
       CAST(coalesce(c.level, 0) AS INTEGER) AS level,
       CAST(coalesce(c.turn, r.first_turn) AS BIGINT) AS turn,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'pending'
            ELSE 'answered' END AS status,
       c.problems IS NULL AS valid,
       '{' || coalesce('"call":' || c.call || ',', '')
         || '"id":"' || coalesce(c.call_id, r.call_id) || '",'
         || coalesce('"problems":[' || c.problems || '],', '')
         || coalesce('"results":[' || r.contents || '],', '')
         || '"status":"' || CASE WHEN c.call_id IS NULL THEN 'orphan'
              WHEN r.call_id IS NULL THEN 'pending' ELSE 'answered' END || '"}' AS message
FROM checked c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
"""

LINE_DEDUP_SQL = r"""
WITH lines AS (
    SELECT doc_id, i - 1 AS line_no, string_split(text, chr(10))[i] AS line
    FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), words AS (
    SELECT *, len(regexp_extract_all(line, '[^\x09-\x0D\x20]+')) AS words FROM lines
), counted AS (
    SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) AS through
    FROM words WHERE words > 0
), spans AS (
    SELECT a.doc_id, a.line_no AS anchor, 'ahead' AS side, b.line_no, b.line, b.words
    FROM counted a JOIN counted b
      ON a.doc_id = b.doc_id AND b.line_no >= a.line_no
     AND b.through - b.words - (a.through - a.words) < 50
    UNION ALL
    SELECT a.doc_id, a.line_no, 'behind', b.line_no, b.line, b.words
    FROM counted a JOIN counted b
      ON a.doc_id = b.doc_id AND b.line_no <= a.line_no AND b.through > a.through - 50
), runs AS (
    SELECT doc_id, min(line_no) AS first, max(line_no) AS last,
           string_agg(line, chr(10) ORDER BY line_no) AS content
    FROM spans GROUP BY doc_id, anchor, side HAVING sum(words) >= 50
), earliest AS (
    SELECT content, min((doc_id, first, last)) AS source FROM runs GROUP BY content
), later AS (
    SELECT doc_id, first, last FROM runs JOIN earliest USING (content)
    WHERE (doc_id, first) > (source[1], source[2])
      AND NOT (doc_id = source[1] AND first <= source[3])
), deleted AS (
    SELECT DISTINCT doc_id, line_no
    FROM later, unnest(range(first, last + 1)) AS u(line_no)
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(d.doc_id) AS n_deleted,
           coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no)
                    FILTER (WHERE d.doc_id IS NULL), '') AS text
    FROM lines l LEFT JOIN deleted d USING (doc_id, line_no) GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text,
       CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(k.n_deleted, 0) AS BIGINT) AS n_deleted
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

DECONTAMINATION_SQL = r"""
WITH tokens AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(13, len(words)) AS size,
           array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS phrase
    FROM items, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS u(i)
    WHERE len(words) > 0
), sizes AS (
    SELECT DISTINCT size FROM windows
), places AS (
    SELECT doc_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
    FROM tokens, sizes, unnest(range(1, len(words) - size + 2)) AS u(i)
), matches AS (
    SELECT p.doc_id, p.i, p.size, w.item_id
    FROM places p JOIN windows w ON p.phrase = w.phrase AND p.size = w.size
), hits AS (
    SELECT doc_id, count(DISTINCT spot) AS n_hit
    FROM matches, unnest(range(i, i + size)) AS u(spot) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM matches)
    GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words,
       CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(n.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(t.words) AS contaminated
FROM tokens t LEFT JOIN hits h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

MINHASH_SQL = r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS shingle
    FROM tokens, unnest(range(1, greatest(1, len(words) - 3) + 1)) AS u(i)
    WHERE len(words) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
    WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM tokens
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), named AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM named LEFT JOIN sizes USING (doc_id)
"""

COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
    FROM documents, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS u(piece)
), phrases AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS f
    FROM pieces, unnest(range(1, 6)) AS s(size), unnest(range(1, len(words) - size + 2)) AS u(i)
    GROUP BY lang, size, phrase
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE size = 1 GROUP BY lang
), frequent AS (
    SELECT * FROM phrases WHERE f >= 100
), cuts AS (
    SELECT c.lang, c.phrase, c.size, c.f AS a, k, x.f AS l, y.f AS r, n,
           (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
    FROM frequent c, unnest(range(1, c.size)) AS u(k), totals t, frequent x, frequent y
    WHERE c.size > 1 AND t.lang = c.lang AND x.lang = c.lang AND y.lang = c.lang
      AND x.phrase = array_to_string(string_split(c.phrase, ' ')[1 : k], ' ')
      AND y.phrase = array_to_string(string_split(c.phrase, ' ')[k + 1 : c.size], ' ')
), lowest AS (
    SELECT lang, phrase, size, a, n, l, r, score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
    SELECT DISTINCT b.lang, array_to_string(string_split(b.phrase, ' ')[i : i + m - 1], ' ') AS phrase, b.a
    FROM lowest b, unnest(range(2, b.size)) AS s(m), unnest(range(1, b.size - m + 2)) AS u(i)
), apart AS (
    SELECT * FROM lowest c WHERE NOT EXISTS (
        SELECT 1 FROM held h WHERE h.lang = c.lang AND h.phrase = c.phrase AND h.a >= c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM apart QUALIFY rank <= 2000
"""

NEGATIVES_SQL = r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
           CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                               ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT alike
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_tool_calls": TOOL_CALLS_SQL,
        "op7_line_dedup": LINE_DEDUP_SQL,
        "op9_decontamination": DECONTAMINATION_SQL,
        "op11_minhash_near_dedup": MINHASH_SQL,
        "op12_phrase_collocations": COLLOCATIONS_SQL,
        "op13_hard_negatives": NEGATIVES_SQL,
    }
