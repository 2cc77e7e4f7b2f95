"""The corpus operators as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.llm import (
    divergence, embeddings, extendible, licenses, merkle, minhash, mixing, quality, secrets, sentencepieces, sharding, toxicity, warc,
)
from rillwork.plans.registry import Query, Tables
from rillwork.session import shared_path

MODEL = "piece_bpe_32k.model"


def encoded(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Ids of every whole text, decoded again, as digests."""
    path = public_tokenizers.path(MODEL)
    back = sentencepieces.encode_and_decode(docs.select("doc_id", "text"), path)
    return back.select("doc_id", *sentencepieces.digests(back), *(["ids"] if with_ids else []))


def op1_toxicity(t: Tables) -> DataFrame:
    labels = t.labels.withColumn("low_quality", 1 - F.col("quality"))
    names = ("low_quality", "toxic")
    chain = toxicity.train(t.documents, labels, names, "doc_id", "text")
    return toxicity.score(t.documents.select("doc_id", "text"), chain, keep_text=False)


def op2_sentencepiece(t: Tables) -> DataFrame:
    return encoded(t.documents)


def op3_embedding_dedup(t: Tables) -> DataFrame:
    return embeddings.near_vectors(t.embeddings)


def op4_quality_rules(t: Tables) -> DataFrame:
    return quality.rules(t.documents)


def op5_minhash_dedup(t: Tables) -> DataFrame:
    return minhash.near_texts(t.documents, size=2)


def op6_secret_scans(t: Tables) -> DataFrame:
    return secrets.report(t.documents)


def op7_sharding(t: Tables) -> DataFrame:
    return sharding.shard(t.documents, shared_path(t.spark, "slot-map"), 40)


def op8_warc(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "bundles")
    warc.write_bundles(t.pages, path)
    back = warc.read_bundles(t.spark.read.schema(warc.BUNDLES).parquet(path))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_license_scans(t: Tables) -> DataFrame:
    return licenses.report(t.documents)


def op10_source_mixing(t: Tables) -> DataFrame:
    return mixing.mixed(t.documents)


def op11_merkle_manifest(t: Tables) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.verify(t.documents, {"n_chars": F.col("n_chars") + 1}, tampered)


def op12_source_divergence(t: Tables) -> DataFrame:
    return divergence.audit(t.documents)


def op13_exact_dedup(t: Tables) -> DataFrame:
    return extendible.groups(t.documents)


def _merkle_sql(levels: int = 24, top_levels: int = 10) -> str:
    """Level by level, for up to 2 ** levels documents of a language and 2 ** top_levels languages."""

    def leaf(n_chars: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")]
        return f"sha256({' || '.join(parts)})"

    def tree(name: str, key: str, depth: int) -> list[str]:
        return [
            f"""{name}{k + 1} AS MATERIALIZED (
  SELECT {key}, pos // 2 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d,
    (any_value(n) + 1) // 2 AS n FROM {name}{k} GROUP BY {key}, pos // 2)"""
            for k in range(depth)
        ]

    def paths(name: str, nodes: str, key: str, depth: int) -> list[str]:
        return [
            f"""{name}{k + 1} AS MATERIALIZED (
  SELECT p.* REPLACE (p.pos // 2 AS pos, p.proof || coalesce(s.d, '') AS proof, (p.n + 1) // 2 AS n,
    CASE WHEN p.n = 1 THEN p.folded WHEN s.d IS NULL THEN sha256(p.folded) WHEN p.pos % 2 = 0 THEN sha256(p.folded || s.d)
      ELSE sha256(s.d || p.folded) END AS folded)
  FROM {name}{k} p LEFT JOIN {nodes}{k} s ON s.{key} = p.{key} AND s.pos = xor(p.pos, 1))"""
            for k in range(depth)
        ]

    crc = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
    steps = [
        f"""docs AS MATERIALIZED (
  SELECT doc_id, {leaf("n_chars")} AS leaf, {leaf("n_chars + 1")} AS altered, {crc} % 7 = 0 AS tampered,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM documents)""",
        "a0 AS (SELECT tree, pos, leaf AS d, n FROM docs)",
        *tree("a", "tree", levels),
        f"b0 AS (SELECT 0 AS one, tree AS pos, d, count(*) OVER () AS n FROM a{levels})",
        *tree("b", "one", top_levels),
        """p0 AS (SELECT doc_id, leaf, tree, pos, n, '' AS proof,
    CASE WHEN coalesce(tampered, false) THEN altered ELSE leaf END AS folded FROM docs)""",
        *paths("p", "a", "tree", levels),
        f"""q0 AS (SELECT p.doc_id, p.leaf, s.d AS subroot, 0 AS one, b.pos, b.n, p.proof, p.folded
  FROM p{levels} p JOIN a{levels} s USING (tree) JOIN b0 b ON b.pos = p.tree)""",
        *paths("q", "b", "one", top_levels),
    ]
    return f"""WITH {", ".join(steps)}
SELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.d AS verified
FROM q{top_levels}, b{top_levels} r"""


REACHED = """
reached(id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.id, l.b FROM reached r JOIN links l ON l.a = r.other
)"""

SQL = {
    "op3_embedding_dedup": f"""
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
    ON x.label = y.label AND x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.93
),
{REACHED}
SELECT e.vec_id,
  (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  least(e.vec_id, coalesce((SELECT min(other) FROM reached r WHERE r.id = e.vec_id), e.vec_id)) AS component_id,
  e.vec_id <= coalesce((SELECT min(other) FROM reached r WHERE r.id = e.vec_id), e.vec_id) AS kept
FROM embeddings e
""",
    "op5_minhash_dedup": f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM cut
),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
rare AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY f, g) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS f FROM flat)),
prefix AS (SELECT * FROM rare WHERE place <= n - CAST(ceil(0.8 * n - 1e-9) AS BIGINT) + 1),
pairs AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM prefix x JOIN prefix y ON x.g = y.g AND x.doc_id < y.doc_id
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
),
measured AS (
  SELECT a, b, len(list_intersect(x.s, y.s)) AS shared, len(x.s) + len(y.s) AS total
  FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
),
one_way AS (SELECT a, b FROM measured WHERE 100 * shared >= 80 * (total - shared)),
links AS (SELECT a, b FROM one_way UNION ALL SELECT b, a FROM one_way),
{REACHED}
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
  least(s.doc_id, coalesce(m.other, s.doc_id)) AS component_id, s.doc_id <= coalesce(m.other, s.doc_id) AS kept
FROM sets s LEFT JOIN (SELECT id, min(other) AS other FROM reached GROUP BY id) m ON m.id = s.doc_id
""",
    "op8_warc": """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
),
firsts AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM sized
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts
""",
    "op11_merkle_manifest": _merkle_sql(),
    "op12_source_divergence": """
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
flat AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM flat GROUP BY ALL HAVING count(DISTINCT row) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT f.lang, f.source, f.term, count(*) AS n FROM flat f JOIN kept k USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM found GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
    1 + 1000000000 * (coalesce(f.n, 0) + 2)::HUGEINT // (coalesce(t.total, 0) + 2 * l.v)::HUGEINT AS p,
    1 + 1000000000 * (k.n + 2)::HUGEINT // (l.total + 2 * l.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t USING (lang, source) LEFT JOIN found f USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(p.value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op13_exact_dedup": """
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS s FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(s) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY s)
""",
}


def llm_queries() -> dict[str, Query]:
    """Every query of this subpackage, by name."""
    found: list[Callable[[Tables], DataFrame]] = [
        op1_toxicity, op2_sentencepiece, op3_embedding_dedup, op4_quality_rules, op5_minhash_dedup,
        op6_secret_scans, op7_sharding, op8_warc, op9_license_scans, op10_source_mixing, op11_merkle_manifest, op12_source_divergence, op13_exact_dedup,
    ]
    return {f.__name__: Query(f, SQL.get(f.__name__)) for f in found}


def pipeline(run: Callable[[SparkSession, str], DataFrame], sql: str | None) -> dict[str, Query]:
    """The corpus pipeline as a registered query."""
    return {"pipeline": Query(lambda t: run(t.spark, t.folder), sql)}
