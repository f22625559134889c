"""The operators as named queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from retailmill.llm import (
    decontaminate, fill_middle, hard_negatives, jaccard, licenses, merkle, packing, pii, preference, sentencepiece_chunks,
    token_count, token_files, toxicity,
)
from retailmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), BYTES)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii(table(spark, sf_dir, "documents"))


def op3_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_pairs(preference.cut_reply_pairs(table(spark, sf_dir, "conversations")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_chunks.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), exact=True)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_back(token_files.write(table(spark, sf_dir, "documents"), BYTES))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(spark, sf_dir, "documents"), WORDS)


LLM_QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_pii, op3_preference_pairs, op4_decontaminate, op5_sentencepiece, op6_ngram_jaccard,
        op7_toxicity, op8_merkle_fingerprints, op9_license_scan, op10_token_files, op11_fill_middle,
        op12_hard_negatives, op13_packing,
    )
}

ROLES = """
    SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, s.side, side_no,
           max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS last_reply
    FROM conversations, (VALUES ('chosen', 0), ('rejected', 1)) AS s(side, side_no)
"""

PREFERENCES = f"""
WITH sided AS ({ROLES}),
cut AS (
    SELECT conv_id, turn, role, side,
           CASE WHEN side = 'rejected' AND role = 'assistant' AND turn = last_reply
                THEN left(text, length(text) // 2) ELSE text END AS text
    FROM sided
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn NULLS FIRST, role, text) AS k FROM cut
),
alike AS (
    SELECT c.conv_id, c.k, coalesce(c.role = r.role AND c.text = r.text, false) AS same
    FROM (SELECT * FROM ranked WHERE side = 'chosen') c
    JOIN (SELECT * FROM ranked WHERE side = 'rejected') r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND c.k = r.k
),
prefix AS (
    SELECT conv_id, coalesce(min(CASE WHEN NOT same THEN k END) - 1, count(*)) AS n FROM alike GROUP BY conv_id
),
shown AS (
    SELECT ranked.conv_id, side, k, n, role, '<|' || role || '|>' || chr(10) AS head,
           replace(text, '<|', '< |') || '<|end|>' || chr(10) AS body
    FROM ranked JOIN prefix ON ranked.conv_id IS NOT DISTINCT FROM prefix.conv_id
),
placed AS (
    SELECT *, coalesce(sum(length(head) + length(body)) OVER (
        PARTITION BY conv_id, side, k > n ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
    FROM shown
)
SELECT conv_id AS pair_id, any_value(n) AS n_prompt_turns,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE side = 'chosen' AND k <= n), '') AS prompt,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE side = 'chosen' AND k > n), '') AS chosen,
       coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE side = 'rejected' AND k > n), '') AS rejected,
       coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(body)), ',' ORDER BY k)
           FILTER (WHERE side = 'chosen' AND k > n AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(body)), ',' ORDER BY k)
           FILTER (WHERE side = 'rejected' AND k > n AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id
"""


def _seeds(source: str, key: str) -> str:
    """SQL for every seed of a table of word lists: the words that count, as text."""
    one = " UNION ALL ".join(
        f"SELECT {key}, p, {m} || ' ' || " + " || ' ' || ".join(f"w[p + {k + 1}]" for k in mask) + " AS seed FROM seeded"
        for m, mask in enumerate(decontaminate.MASKS)
    )
    return (
        f"WITH seeded AS (SELECT {key}, w, unnest(range(0, len(w) - {decontaminate.SPAN - 1})) AS p FROM {source} "
        f"WHERE len(w) >= {decontaminate.SPAN}) {one}"
    )


WORD_LIST = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
LEAKS = f"""
WITH d AS (SELECT doc_id, {WORD_LIST} AS w FROM documents),
b AS (SELECT item_id, {WORD_LIST} AS w FROM benchmark),
ds AS ({_seeds("d", "doc_id")}),
bs AS ({_seeds("b", "item_id")}),
hit AS (SELECT DISTINCT doc_id, item_id, ds.p AS i, bs.p AS j FROM ds JOIN bs USING (seed)),
compared AS (
    SELECT doc_id, item_id, i, j, unnest(range(-least(i, j, 6), least(len(d.w) - i, len(b.w) - j, 18))) AS k, d.w AS x, b.w AS y
    FROM hit JOIN d USING (doc_id) JOIN b USING (item_id)
),
verified AS (
    SELECT doc_id, item_id, i, j, sum(CASE WHEN x[i + k + 1] = y[j + k + 1] THEN 1 ELSE 0 END) AS n_equal, count(*) AS n,
           sum(CASE WHEN k BETWEEN 0 AND 11 AND x[i + k + 1] = y[j + k + 1] THEN 1 ELSE 0 END) AS own
    FROM compared GROUP BY ALL
),
short AS (SELECT item_id, len(w) AS n, array_to_string(w, ' ') AS t FROM b WHERE len(w) BETWEEN 5 AND 11),
found AS (
    SELECT doc_id, item_id, i, n_equal FROM verified WHERE n_equal >= 10 AND n_equal >= 0.6 * n OR own >= 11
    UNION ALL
    SELECT doc_id, item_id, i, n FROM short
    JOIN (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d WHERE EXISTS (SELECT 1 FROM short)) ON array_to_string(w[i + 1:i + n], ' ') = t
)
SELECT doc_id, item_id, count(DISTINCT i) AS n_hits, CAST(max(n_equal) AS BIGINT) AS best_equal, min(i) AS first_word
FROM found GROUP BY doc_id, item_id
"""

SHINGLES = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[k:k + 4], ' ') ELSE array_to_string(w, ' ') END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
link AS (
    SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach(v, r) AS (SELECT a, a FROM link UNION SELECT v, b FROM reach JOIN link ON a = r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(least_id, doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT v, min(r) AS least_id FROM reach GROUP BY v) ON v = doc_id
"""

FILL_MIDDLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || doc_id) AS h
    FROM documents
),
h AS (
    SELECT doc_id, t, u, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a,
           CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b, CAST('0x' || h[17:24] AS BIGINT) % 100 AS drawn,
           CAST('0x' || h[25:32] AS BIGINT) % 100 AS side
    FROM d
),
f AS (
    SELECT doc_id, t, n, array_to_string(u[1:least(a, b)], '') AS p,
           array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR drawn >= 100 THEN 'plain'
                WHEN side < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM h
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""

HARD_NEGATIVES = """
WITH e AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r AS other, b.vec_id AS other_id, a.label = b.label AS alike,
           CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
    FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 100 = 0
),
positive AS (
    SELECT * FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST) <= 5
),
negative AS (
    SELECT p.anchor, p.other, p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
           p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.other_id NULLS LAST) AS rank
    FROM positive p JOIN scored n ON p.anchor = n.anchor AND NOT n.alike
    WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 10
"""

LLM_ORACLE: dict[str, str] = {
    "op3_preference_pairs": PREFERENCES,
    "op4_decontaminate": LEAKS,
    "op6_ngram_jaccard": SHINGLES,
    "op11_fill_middle": FILL_MIDDLE,
    "op12_hard_negatives": HARD_NEGATIVES,
}
