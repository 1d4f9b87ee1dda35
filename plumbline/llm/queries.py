"""Registered queries of this subpackage and their SQL, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.chat_rotation import rotated
from plumbline.llm.collocations import collocations
from plumbline.llm.common import table
from plumbline.llm.decontamination import contaminated
from plumbline.llm.exact_dedup import exact_groups
from plumbline.llm.hard_negatives import hard_negatives
from plumbline.llm.lm_scoring import lm_scores
from plumbline.llm.ngram_join import near_groups
from plumbline.llm.packing import pack_documents
from plumbline.llm.repeated_spans import without_repeats
from plumbline.llm.token_counts import token_counts
from plumbline.llm.toxicity import toxicity
from plumbline.llm.url_trust import judged
from plumbline.llm.warc import read_archive, write_archive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@registered
def op1_lm_scoring(spark, sf_dir):
    """log10 probability of every document by context mixing, and by counts of words."""
    return lm_scores(table(spark, sf_dir, "documents"))


@registered
def op2_warc_dictionary_writer(spark, sf_dir):
    """Every page archived, then read back from the archives."""
    folder, manifest = write_archive(table(spark, sf_dir, "pages"))
    return read_archive(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op2_warc_dictionary_writer"] = """
    SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
           CASE WHEN refers THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN refers THEN last END AS refers_to
    FROM (SELECT *, payload_bytes >= 1000 AND page_id <> last AS refers
          FROM (SELECT page_id, body, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
                       max(page_id) OVER (PARTITION BY body) AS last
                FROM (SELECT page_id, coalesce(html, '') AS body FROM pages)))
"""


@registered
def op3_ngram_jaccard_join(spark, sf_dir):
    """The group of documents linked by equal 4-word shingles, at 0.85 or more."""
    return near_groups(table(spark, sf_dir, "documents"), size=4, share=85)


@registered
def op4_best_fit_packing(spark, sf_dir):
    """Every document in sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), with_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@registered
def op5_perspective_rotation(spark, sf_dir):
    """Every conversation from each participant's side; spans as text."""
    spans = F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return rotated(table(spark, sf_dir, "conversations")).withColumn("spans", F.array_join(spans, ","))


ORACLE["op5_perspective_rotation"] = """
    WITH t AS (
        SELECT conv_id, role, floor(nth / 64)::BIGINT AS chunk, nth, body
        FROM (SELECT conv_id, coalesce(replace(role, '<|im_', '<| im_'), 'unknown') AS role,
                     coalesce(replace(text, '<|im_', '<| im_'), '') AS body,
                     row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS nth
              FROM conversations)),
    s AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
    x AS (
        SELECT conv_id, perspective, chunk, nth, role = perspective AS own,
               '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
                                      ELSE 'user name=' || role END || chr(10) AS head,
               body || '<|im_end|>' || chr(10) AS body
        FROM t JOIN s USING (conv_id)),
    y AS (
        SELECT *, CAST(sum(length(head) + length(body)) OVER w AS BIGINT) - length(body) AS start,
               CAST(sum(length(head) + length(body)) OVER w AS BIGINT) - 1 AS stop
        FROM x WINDOW w AS (PARTITION BY conv_id, perspective, chunk ORDER BY nth))
    SELECT conv_id, perspective, chunk, count(*) AS n_turns, string_agg(head || body, '' ORDER BY nth) AS rendered,
           coalesce(string_agg(start || '-' || stop, ',' ORDER BY nth) FILTER (own), '') AS spans
    FROM y GROUP BY conv_id, perspective, chunk
"""


@registered
def op6_benchmark_decontamination(spark, sf_dir):
    """Documents that hold a test item, with the items."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op7_token_counts(spark, sf_dir):
    """Tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"))


#: Fixed by the contract of the query.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@registered
def op8_url_trust(spark, sf_dir):
    """The verdict on every page's url."""
    return judged(table(spark, sf_dir, "pages"), URL_RULES)


@registered
def op9_exact_dedup(spark, sf_dir):
    """The group of equal texts of every document."""
    return exact_groups(table(spark, sf_dir, "documents"))


@registered
def op10_toxicity(spark, sf_dir):
    """Every document's toxicity, learned from labels outside the held-out rows."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op9_exact_dedup"] = r"""
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
    FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
          FROM documents)
    WINDOW g AS (PARTITION BY body)
"""


@registered
def op13_collocations(spark, sf_dir):
    """The phrases of every language whose words stand together more often than chance."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_collocations"] = r"""
    WITH t AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM t),
    g AS (SELECT lang, k, words[i:i + k - 1] AS phrase
          FROM (SELECT lang, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i
                FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k))),
    totals AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
    cuts AS (SELECT lang, k, phrase, f AS a, unnest(generate_series(1, k - 1)) AS cut FROM f WHERE k > 1),
    scores AS (
        SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, n,
               (1000 * c.a::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
        FROM cuts c JOIN totals USING (lang)
        JOIN f x ON x.lang = c.lang AND x.phrase = c.phrase[1:cut]
        JOIN f y ON y.lang = c.lang AND y.phrase = c.phrase[cut + 1:]),
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    part AS (
        SELECT lang, phrase[i:i + s - 1] AS phrase, max(f) AS longer
        FROM (SELECT lang, phrase, f, s, unnest(generate_series(1, k - s + 1)) AS i
              FROM (SELECT lang, phrase, k, f, unnest(generate_series(2, k - 1)) AS s FROM f WHERE k > 2))
        GROUP BY ALL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank,
           array_to_string(phrase, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
    FROM best LEFT JOIN part USING (lang, phrase)
    WHERE longer IS NULL OR 100 * longer < 100 * a
    QUALIFY rank <= 2000
"""


@registered
def op11_hard_negatives(spark, sf_dir):
    """Rows of other labels that lie nearly as close to an anchor as its positives."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLE["op11_hard_negatives"] = """
    WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
               list_inner_product(a.v, b.v)::BIGINT AS score
        FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER w AS rank, other AS negative_id, positive_score,
           score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
    QUALIFY rank <= 3
"""


@registered
def op12_repeated_spans(spark, sf_dir):
    """What is left of every document without the strings of 200 bytes that stand more than once."""
    return without_repeats(table(spark, sf_dir, "documents"), 200).drop("kept")
