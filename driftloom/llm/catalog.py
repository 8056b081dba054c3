"""Queries over the operators of this package, with production parameters and whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import alignment, chat, collocations, html_text, mixing, near_text, near_vectors, packing, pii, quality, token_files, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    """The vocabulary file; ``PACKING_TOKENIZER`` names another place."""
    if path := os.environ.get("PACKING_TOKENIZER"):
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def vocabulary_path(name: str) -> str:
    """Another vocabulary file; ``TOKENIZER_DIR`` names the folder where executors find them."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)).alias(name) for k, name in enumerate(pii.KINDS)]
    counts = [(F.size("base") - n).cast("long").alias(f"n_{name}") for n, name in zip(counts, pii.KINDS)]
    digest = F.sha2(pii.span_text(F.col("base")).cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair k: conversation 2k, and the same with the last answer of conversation 2k + 1 in place of its own; masks as start:end of trained parts."""
    made = chat.format_preferences(chat.answer_pairs(table(spark, sf_dir, "conversations")))
    mask = lambda c: F.array_join(F.transform(chat.spans(F.col(c)), lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return made.select(
        "pair_id", "chosen_id", "rejected_id", "n_common", "prompt", "chosen", "rejected",
        mask("chosen_segments").alias("chosen_mask"), mask("rejected_segments").alias("rejected_mask"),
    )


ORACLES["op3_preferences"] = """
WITH base AS (
    SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 AS odd, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), answers AS (
    SELECT pair_id, odd, turn, text FROM base WHERE role = 'assistant'
    QUALIFY row_number() OVER (PARTITION BY pair_id, odd ORDER BY turn DESC NULLS LAST, text DESC) = 1
), ends AS (
    SELECT pair_id, o.pair_id IS NOT NULL AS answered, o.turn AS own_turn, o.text AS own_text, a.text AS other_text, a.turn AS other_turn,
           (SELECT max(turn) FROM base WHERE odd = 0 AND base.pair_id = a.pair_id) AS last_turn
    FROM (SELECT * FROM answers WHERE odd = 1) a LEFT JOIN (SELECT * FROM answers WHERE odd = 0) o USING (pair_id)
), turns AS (
    SELECT pair_id, 0 AS side, pair_id * 2 AS conv_id, turn, role, text FROM base WHERE odd = 0
    UNION ALL
    SELECT pair_id, 1, pair_id * 2 + 1, turn, role, text FROM base JOIN ends USING (pair_id)
    WHERE odd = 0 AND (NOT answered OR turn < own_turn OR (turn = own_turn AND (role < 'assistant' OR (role = 'assistant' AND text < own_text))))
    UNION ALL
    SELECT pair_id, 1, pair_id * 2 + 1, CASE WHEN answered THEN own_turn ELSE coalesce(last_turn + 1, other_turn) END, 'assistant', other_text FROM ends
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS pos,
           '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown
    FROM (SELECT DISTINCT * FROM turns)
), met AS (
    SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, coalesce(a.pos, b.pos) AS pos,
           coalesce(a.role = b.role AND a.text = b.text, false) AS same
    FROM (SELECT * FROM placed WHERE side = 0) a FULL JOIN (SELECT * FROM placed WHERE side = 1) b ON a.pair_id = b.pair_id AND a.pos = b.pos
), common AS (
    SELECT pair_id, coalesce(min(pos) FILTER (NOT same) - 1, count(*)) AS n_common FROM met GROUP BY 1
), rest AS (
    SELECT *, sum(CASE WHEN pos > n_common THEN length(shown) ELSE 0 END) OVER (PARTITION BY pair_id, side ORDER BY pos) AS ends_at
    FROM placed JOIN common USING (pair_id)
), marked AS (
    SELECT *, pos > n_common AS own, pos > n_common AND role = 'assistant' AS train, (ends_at - length(shown)) || ':' || ends_at AS span FROM rest
)
SELECT pair_id, min(conv_id) FILTER (side = 0) AS chosen_id, min(conv_id) FILTER (side = 1) AS rejected_id, n_common,
       coalesce(string_agg(shown, '' ORDER BY pos) FILTER (side = 0 AND NOT own), '') AS prompt,
       CASE WHEN count(*) FILTER (side = 0) > 0 THEN coalesce(string_agg(shown, '' ORDER BY pos) FILTER (side = 0 AND own), '') END AS chosen,
       CASE WHEN count(*) FILTER (side = 1) > 0 THEN coalesce(string_agg(shown, '' ORDER BY pos) FILTER (side = 1 AND own), '') END AS rejected,
       CASE WHEN count(*) FILTER (side = 0) > 0 THEN coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = 0 AND train), '') END AS chosen_mask,
       CASE WHEN count(*) FILTER (side = 1) > 0 THEN coalesce(string_agg(span, ',' ORDER BY pos) FILTER (side = 1 AND train), '') END AS rejected_mask
FROM marked GROUP BY pair_id, n_common
"""


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents"), trusted(spark, sf_dir), keep_columns=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents that people found good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, sf_dir, "documents"), over=85, under=100)


@query
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _form_owners() -> dict[str, tuple[str, bool]]:
    """Each form of the vocabulary with its stem: shorter stems go before longer ones, strict ones before all."""
    owners: dict[str, tuple[str, bool]] = {}
    for stems, strict in ((urls.STRICT, True), (urls.SOFT, False)):
        for stem in sorted(stems, key=len):
            for ending in urls.ENDINGS:
                owners.setdefault(stem + ending, (stem, strict))
    return owners


def _terms(strict: bool) -> str:
    """How many different stems have a form in the url."""
    forms: dict[str, list[str]] = {}
    for form, (stem, is_strict) in _form_owners().items():
        if is_strict == strict:
            forms.setdefault(stem, []).append(form)
    inside = ", ".join(f"'{'|'.join(f)}'" for f in forms.values())
    return f"len(list_filter([{inside}], lambda w: regexp_matches(low, '(^|[^a-z0-9])(' || w || ')($|[^a-z0-9])')))"


def _rule_cases(what: int) -> str:
    longest_first = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[what]}'" for h, p, v in longest_first
    )
    return f"CASE {cases} END"


ORACLES["op10_urls"] = f"""
WITH split AS (
    SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
)
SELECT page_id, host, path, {_rule_cases(0)} AS rule,
       coalesce({_rule_cases(1)}, CASE WHEN {_terms(True)} > 0 OR {_terms(False)} >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict
FROM split
"""


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces
), grams AS (
    SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
    FROM words, range(1, 5) AS t(m) WHERE len(ws) >= m
), f AS (
    SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), often AS MATERIALIZED (
    SELECT lang, m, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE a >= 30
), cand AS (
    SELECT * FROM often WHERE m >= 2
), parts AS MATERIALIZED (
    SELECT lang, phrase, m, a, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
), heads AS MATERIALIZED (
    SELECT parts.*, o.a AS l FROM parts JOIN often o ON o.lang = parts.lang AND o.phrase = parts.head
), cuts AS MATERIALIZED (
    SELECT heads.*, o.a AS r, (2000000::HUGEINT * heads.a) // (l + o.a) AS score
    FROM heads JOIN often o ON o.lang = heads.lang AND o.phrase = heads.tail
), scored AS (
    SELECT lang, phrase, a, l, r, score::BIGINT AS score FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), within AS (
    SELECT lang, array_to_string(ws[i:i + w - 1], ' ') AS phrase, max(a) AS longest
    FROM (SELECT *, unnest(range(1, m - w + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS w FROM cand)) GROUP BY ALL
), kept AS (
    SELECT s.* FROM scored s LEFT JOIN within w ON w.lang = s.lang AND w.phrase = s.phrase WHERE coalesce(100 * longest < 80 * a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A: the byte-level vocabulary of 50 257 ids; B: the piece model of 32 000."""
    both = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    return alignment.link_counts(table(spark, sf_dir, "documents"), *both)


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token files of all documents to the shared folder and reads them back."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary_path("byte_bpe_50k.json"))
    return token_files.checksums(spark, path).withColumnRenamed("id", "doc_id")
