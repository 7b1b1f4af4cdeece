"""Registered queries of this package and the oracles that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, context_tree, fingerprint, infill, jaccard, lines, minhash, mixing, pseudonyms, repeats, repetition, vector_codes

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted-sampling fingerprints of all texts and their edited texts."""
    return fingerprint.compare_with_edits(table(spark, sf_dir, "documents"))


WORDS_SQL = r"""w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents)"""

OP2_SQL = f"""
WITH RECURSIVE {WORDS_SQL},
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE shared >= 0.8 * (a.size + b.size - shared) - 1e-9),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.reached)
SELECT doc_id, min(reached) AS class_id, (SELECT count(*) FROM l WHERE l.x = r.doc_id) AS n_links FROM r GROUP BY doc_id
"""


@query("op2_ngram_jaccard_join", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


SPREAD = lines.Spread()

OP3_SQL = f"""
WITH l AS (
  SELECT doc_id, source, p.i AS pos, trim(regexp_replace(string_split(text, chr(10))[p.i], '[\t\r\f\x0B]', ' ', 'g')) AS body
  FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i) p),
b AS (SELECT body FROM l WHERE body <> '' GROUP BY body HAVING count(DISTINCT coalesce('s' || source, 'n')) >= {SPREAD.sites}),
h AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS FIRST, pos) AS n FROM l JOIN b USING (body)),
k AS (SELECT doc_id, pos FROM h WHERE n > 1),
t AS (
  SELECT l.doc_id, string_agg(string_split(d.text, chr(10))[l.pos], chr(10) ORDER BY l.pos) AS kept
  FROM l JOIN documents d USING (doc_id) WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = l.doc_id AND k.pos = l.pos) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce((SELECT count(*) FROM k WHERE k.doc_id = d.doc_id), 0) AS removed_lines,
  md5(coalesce(t.kept, '')) AS text_md5
FROM documents d LEFT JOIN t USING (doc_id)
"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed from every document, and a digest of its remaining text."""
    out = lines.remove_boilerplate(table(spark, sf_dir, "documents"), SPREAD)
    return out.select("doc_id", "removed_lines", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, shares and verdicts of all texts."""
    return repetition.repetition_report(table(spark, sf_dir, "documents"))


OP5_SQL = f"""
WITH {WORDS_SQL},
g AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
t AS (SELECT doc_id, i FROM g JOIN (SELECT h FROM g GROUP BY h HAVING count(*) > 1) USING (h)),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS places FROM t, (SELECT unnest(range(35)) AS k) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(coalesce(places, [])) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""


@query("op5_substring_dedup", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every text because their window repeats."""
    out = repeats.repeated_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# a fixed key, so that reruns agree; a deployment passes its own
PSEUDONYM_KEY = "claimlens"


@query("op6_pseudonyms")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts with their personal values replaced."""
    return pseudonyms.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def vocabulary() -> bytes:
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read()


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of all texts, encoded and decoded."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, vocabulary(), public_tokenizers.PATTERN, with_ids=False)


@query("op8_context_tree")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all texts by a model of those whose id does not fall into the held-out seventh."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return context_tree.score_documents(docs, held_out).drop("n_bytes")


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by the mix."""
    return mixing.mix_documents(table(spark, sf_dir, "documents")).drop("source", "copies")


OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, len(regexp_extract_all(text, '\\|</?s>|<\||\[/?INST\]')) + 2 * len(regexp_extract_all(text, '<</?SYS>>'))
    + len(regexp_extract_all(text, '(^|[^<])</?SYS>>')) AS added FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(role) + length(text) + added)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op10_chat_format", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their rendered form."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2, numPartitions=1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digest(chat.format_conversations(chat.conversation_events(rows.unionByName(odd))))


def op11_sql(rule: vector_codes.Codes) -> str:
    """Every round spelt out: assignments by the least (distance, entry), then floors of the means."""
    steps = []
    for r in range(rule.rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT p.row, p.part, min({{'d': list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.entry}}) AS best
  FROM p JOIN b{r} b USING (part) GROUP BY ALL),""")
        if r < rule.rounds:
            steps.append(f"""
m{r} AS (
  SELECT part, entry, list(total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END ORDER BY i) AS v FROM (
    SELECT part, best.e AS entry, i, sum(v[i])::BIGINT AS total, count(*) AS n
    FROM a{r} JOIN p USING (row, part), LATERAL (SELECT unnest(range(1, len(v) + 1)) AS i) GROUP BY ALL) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (part, entry)),""")
    last = rule.rounds
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS row, vec_id, label, x FROM (
    SELECT vec_id, label, list_transform(embedding, lambda c: floor({rule.scale} * c::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)),
p AS MATERIALIZED (
  SELECT row, part, x[(len(x) // {rule.parts}) * part + 1 : (len(x) // {rule.parts}) * (part + 1)] AS v
  FROM k, (SELECT unnest(range({rule.parts})) AS part)),
b0 AS (SELECT part, row AS entry, v FROM p WHERE row < {rule.entries}),{"".join(steps)}
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last}),
c AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{last} GROUP BY row),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM c JOIN k USING (row) GROUP BY label)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM c JOIN k USING (row) JOIN l ON k.label IS NOT DISTINCT FROM l.label, h
"""


CODES = vector_codes.Codes()


@query("op11_vector_codes", op11_sql(CODES))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all usable vectors."""
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"), CODES)


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
g AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number(array_to_string(ws[i : i + 1], ' ')) AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.size + b.size - shared)),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.reached),
m AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op12_minhash", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document, and whether it stays."""
    return minhash.near_components(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (
  SELECT *, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
    ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || text[1:a] || '<S>' || text[b + 1:] || '<M>' || text[a + 1:b]
    ELSE '<S>' || text[b + 1:] || '<P>' || text[1:a] || '<M>' || text[a + 1:b] END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM f
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all rearranged texts and of the texts rebuilt from them."""
    out = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(), 256).alias("restored_sha256"),
    )
