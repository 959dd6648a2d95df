"""Queries of the operators on training text, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.alignment import align_tokens
from tidegate.llm.chat_format import AS, CONTROL, MARKS, ROLE, chat_digests, format_chats
from tidegate.llm.common import read_table, small_batches
from tidegate.llm.decontaminate import contained_items
from tidegate.llm.html_extract import extract
from tidegate.llm.licenses import CUE, LONG_RULES, OPENING, PATTERN, SENTENCES, SHORT_RULES, licenses
from tidegate.llm.merkle import leaf_hash, merkle_manifest
from tidegate.llm.mixing import mix
from tidegate.llm.near_vectors import near_vectors
from tidegate.llm.ngram_join import similar_documents
from tidegate.llm.secret_scan import scan
from tidegate.llm.suffix_dedup import suffix_dedup
from tidegate.llm.token_counts import token_counts
from tidegate.llm.toxicity import toxicity, train

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return build(spark, sf_dir)

        LLM_QUERIES[build.__name__] = run
        if sql is not None:
            LLM_ORACLES[build.__name__] = sql
        return run

    return register


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read_table(spark, sf_dir, "documents"))


@query()
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"))


NGRAM_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s FROM texts),
classes AS MATERIALIZED (SELECT min(doc_id) AS class, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
parts AS MATERIALIZED (SELECT class, n, unnest(s) AS shingle FROM classes),
links AS MATERIALIZED (
  SELECT a.class AS a, b.class AS b FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.class < b.class
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT class, class FROM classes UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
least_of AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON c.s = s.s LEFT JOIN least_of l ON l.a = c.class"""


@query(NGRAM_SQL)
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"), words=3, similarity=90)


@query()
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _license_sql() -> str:
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items()) + "}"
    steps = []
    for k, (_, sequence) in enumerate(LONG_RULES):
        part = "".join(f",{s}," for s in sequence)
        steps.append(f"r{k + 1} AS (SELECT *, contains(rest{k}, '{part}') AS has{k}, replace(rest{k}, '{part}', '|') AS rest{k + 1} FROM r{k})")
    last = len(LONG_RULES)
    names = [f"CASE WHEN has{k} THEN '{name}' END" for k, (name, _) in enumerate(LONG_RULES)]
    names += [f"CASE WHEN contains(rest{last}, ',{one},') THEN '{name}' END" for name, (one,) in SHORT_RULES]
    return f"""
WITH hits AS (
  SELECT doc_id, CASE WHEN regexp_matches(lower(coalesce(text, '')), '{CUE}') THEN list_transform(regexp_extract_all(
    '  ' || lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', '  ', 'g')) || '  ', '{PATTERN}'),
    lambda h: trim(replace(h, '  ', ' '))) ELSE [] END AS hits FROM documents),
ids AS (
  SELECT doc_id, list_filter(list_transform(hits, lambda h: coalesce(
    {known}[h], {known}[regexp_replace(h, '^{OPENING}', 'under ')])), lambda i: i IS NOT NULL) AS ids FROM hits),
r0 AS (SELECT doc_id, coalesce(list_aggregate(ids, 'string_agg', ','), '') AS sentences,
  ',' || replace(coalesce(list_aggregate(ids, 'string_agg', ','), ''), ',', ',,') || ',' AS rest0 FROM ids),
{", ".join(steps)},
named AS (SELECT doc_id, sentences, list_filter([{", ".join(names)}], lambda n: n IS NOT NULL) AS names FROM r{last}),
firsts AS (SELECT doc_id, sentences, list_filter(names, lambda n, i: list_position(names, n) = i) AS found FROM named)
SELECT doc_id, sentences, coalesce(list_aggregate(found, 'string_agg', ','), '') AS licenses, CAST(len(found) AS INTEGER) AS n_licenses
FROM firsts"""


@query(_license_sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(read_table(spark, sf_dir, "documents"))


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity(docs, model).withColumn("n_offending", F.size("offending")).drop("offending")


@query()
def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


@query()
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents")).drop("found")


@query()
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


# A conversation that says the template's own marks.
MARKED_CHAT = [(-1, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
_FRAMES = " ".join(
    f"WHEN '{role}' THEN {len(opening) + len(closing) + 3}" for role, (opening, closing) in MARKS.items())
_CONTROL_COUNT = "len(regexp_extract_all({}, '" + CONTROL + "'))"
CHAT_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {", ".join(map(str, MARKED_CHAT))}) AS marked(conv_id, turn, role, text)),
sized AS (
  SELECT *, length(text) + {_CONTROL_COUNT.format("text")} + CASE role {_FRAMES}
    ELSE length(role) + {_CONTROL_COUNT.format("role")} + {len("".join(ROLE + AS)) + 5} END AS chars FROM said)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


@query(CHAT_SQL)
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(MARKED_CHAT, "conv_id long, turn long, role string, text string")
    return chat_digests(format_chats(conversations.unionByName(marked)))


def _merkle_sql(levels: int = 24, top_levels: int = 10) -> str:
    """Level by level, for up to 2 ** levels rows of a language and 2 ** top_levels languages."""
    def value(text: str) -> str:
        return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"

    def leaf(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(value, ("id", "source", "lang", n_chars, "text"))) + ")"

    steps = [
        # The unsigned CRC-32 of the decimal id, bit by bit.
        f"""rows AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("chars")} AS leaf,
    CASE WHEN xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(substr(id, i, 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384) ELSE d // 2 END)), 4294967295) % 7 = 0
      THEN {leaf("more")} ELSE {leaf("chars")} END AS claimed
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS id, CAST(n_chars AS VARCHAR) AS chars, CAST(n_chars + 1 AS VARCHAR) AS more FROM documents))""",
        """a0 AS MATERIALIZED (SELECT doc_id, claimed, leaf AS h, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY tree) AS n FROM rows)""",
    ]

    def climb(name: str, count: int) -> None:
        for k in range(count):
            steps.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, pos // 2 AS pos, (max(n) + 1) // 2 AS n,
  CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {name}{k} GROUP BY tree, pos // 2)""")

    def fold(name: str, tree: str, count: int) -> None:
        for k in range(count):
            steps.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT p.doc_id, p.leaf, p.tree, p.pos // 2 AS pos, (p.n + 1) // 2 AS n, p.proof || coalesce(s.h, '') AS proof,
  CASE WHEN p.n = 1 THEN p.cur WHEN p.pos % 2 = 0 THEN sha256(p.cur || coalesce(s.h, '')) ELSE sha256(s.h || p.cur) END AS cur
  FROM {name}{k} p LEFT JOIN {tree}{k} s ON s.tree = p.tree AND s.pos = p.pos + 1 - 2 * (p.pos % 2))""")

    climb("a", levels)
    steps.append(f"""t0 AS MATERIALIZED (SELECT 'all' AS tree, tree AS of, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM a{levels})""")
    climb("t", top_levels)
    steps.append("f0 AS MATERIALIZED (SELECT doc_id, h AS leaf, tree, pos, n, '' AS proof, claimed AS cur FROM a0)")
    fold("f", "a", levels)
    steps.append(f"""g0 AS MATERIALIZED (SELECT f.doc_id, f.leaf, 'all' AS tree, t.pos, t.n, f.proof, f.cur FROM f{levels} f JOIN t0 t ON t.of = f.tree)""")
    fold("g", "t", top_levels)
    return "WITH " + ",\n".join(steps) + f"""
SELECT g.doc_id, g.leaf, a.h AS subroot, t.h AS root, sha256(g.proof) AS proof_sha256, g.cur AS folded_root, g.cur = t.h AS verified
FROM g{top_levels} g JOIN f0 f ON f.doc_id IS NOT DISTINCT FROM g.doc_id AND f.leaf = g.leaf JOIN a{levels} a ON a.tree = f.tree CROSS JOIN t{top_levels} t"""


@query(_merkle_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fields(n_chars: Column) -> list[Column]:
        return [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]

    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    manifest = merkle_manifest(
        read_table(spark, sf_dir, "documents"), leaf_hash(fields(F.col("n_chars"))),
        F.when(tampered, leaf_hash(fields(F.col("n_chars") + 1))))
    return manifest.folded().withColumnRenamed("id", "doc_id").withColumn(
        "verified", F.col("folded_root") == F.col("root"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = align_tokens(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))
    return documents


LLM_QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
