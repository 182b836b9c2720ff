"""Registered queries of the training-data operators, one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TOKENIZER, ship_package, table
from .conversations import prefix_nodes
from .decontam import decontaminate
from .html import main_texts
from .jaccard import jaccard_components
from .language import identify
from .language_model import score_texts
from .packing import pack_documents
from .quality import score_quality
from .rules import quality_rules
from .simhash import simhash_components
from .suffix import remove_repeats
from .toxicity import score_toxicity
from .vector_codes import compress_vectors


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_distribution_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    cleaned = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return main_texts(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return score_texts(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    coded, books = compress_vectors(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.sha2(F.lit(books.text() if books else ""), 256).alias("codebooks_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return prefix_nodes(table(spark, sf_dir, "conversations"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_best_fit_packing,
        op3_distribution_rules,
        op4_suffix_dedup,
        op5_html_extraction,
        op6_jaccard_join,
        op7_language_id,
        op8_decontamination,
        op9_toxicity,
        op10_language_model,
        op11_vector_codes,
        op12_prefix_trie,
        op13_simhash_dedup,
    )
}
_ITEM_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"



def _vector_codes_sql() -> str:
    """Codebooks learnt in two rounds and a final assignment, as one query over (vector, part, component) rows."""
    steps = []
    for k in range(3):
        steps.append(f"""near{k} AS (SELECT vec_id, p, e, d FROM (
            SELECT vec_id, p, e, d, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS r
            FROM (SELECT v.vec_id, v.p, b.e, sum((v.x - b.x) * (v.x - b.x)) AS d FROM cell v JOIN book{k} b USING (p, j) GROUP BY ALL)) WHERE r = 1)""")
        if k < 2:
            steps.append(f"""mean{k} AS (SELECT p, e, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM near{k} JOIN cell USING (vec_id, p) GROUP BY ALL),
            book{k + 1} AS (SELECT p, e, j, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN mean{k} m USING (p, e, j))""")
    return f"""
    WITH kept AS (SELECT vec_id, label, embedding FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cell AS (SELECT vec_id, (i - 1) // w AS p, (i - 1) % w AS j, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
             FROM (SELECT vec_id, embedding, len(embedding) // 16 AS w, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
    book0 AS (SELECT p, e, j, x FROM cell JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id) WHERE e < 64),
    {", ".join(steps)},
    coded AS (SELECT vec_id, string_agg(lower(format('{{:02x}}', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY vec_id),
    books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) AS s FROM book2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id) CROSS JOIN books"""


ORACLE: dict[str, str] = {
    # texts as hex digits, in overlapping blocks of 256 windows, as taking a part from far inside a long text is slow
    "op4_suffix_dedup": """
    WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    block AS (SELECT rid, j, x[512 * j + 1 : 512 * j + 910] AS y
              FROM (SELECT rid, x, unnest(range((len(x) // 2 - 200) // 256 + 1)) AS j FROM doc WHERE len(x) >= 400)),
    place AS (SELECT rid, 256 * j + i AS k, y[2 * i - 1 : 2 * i + 398] AS s
              FROM (SELECT rid, j, y, unnest(range(1, len(y) // 2 - 198)) AS i FROM block)),
    found AS (SELECT rid, k FROM (SELECT rid, k, count(*) OVER (PARTITION BY s) AS c FROM place) WHERE c > 1),
    step AS (SELECT rid, k, CASE WHEN k - lag(k) OVER (PARTITION BY rid ORDER BY k) <= 200 THEN 0 ELSE 1 END AS fresh FROM found),
    run AS (SELECT rid, min(k) AS a, max(k) + 200 AS z
            FROM (SELECT rid, k, sum(fresh) OVER (PARTITION BY rid ORDER BY k) AS r FROM step) GROUP BY rid, r),
    gap AS (SELECT rid, z, x[2 * z - 1 : 2 * coalesce(lead(a) OVER (PARTITION BY rid ORDER BY a), len(x) // 2 + 1) - 2] AS piece
            FROM (SELECT rid, a, z FROM run UNION ALL SELECT rid, 0, 1 FROM doc) JOIN doc USING (rid)),
    left_over AS (SELECT rid, string_agg(piece, '' ORDER BY z) AS kept FROM gap GROUP BY rid),
    cut AS (SELECT rid, sum(z - a) AS n_removed, count(*) AS n_spans FROM run GROUP BY rid)
    SELECT doc_id, len(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(kept)) AS kept_sha256
    FROM doc JOIN left_over USING (rid) LEFT JOIN cut USING (rid)""",
    "op6_jaccard_join": f"""
    WITH RECURSIVE doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    shingle AS (SELECT DISTINCT rid, CASE WHEN len(w) >= 5 THEN w[k : k + 4] ELSE w END AS s
                FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS k FROM doc WHERE len(w) > 0)),
    size AS (SELECT rid, count(*) AS n FROM shingle GROUP BY rid),
    common AS (SELECT x.rid AS a, y.rid AS b, count(*) AS c FROM shingle x JOIN shingle y USING (s) WHERE x.rid <> y.rid GROUP BY 1, 2),
    link AS (SELECT a, b FROM common JOIN size x ON x.rid = a JOIN size y ON y.rid = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    reach(a, b) AS (SELECT rid, rid FROM doc UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
    least_id AS (SELECT reach.a AS rid, min(doc.doc_id) AS component_id FROM reach JOIN doc ON doc.rid = reach.b GROUP BY 1)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM doc JOIN least_id USING (rid) LEFT JOIN size USING (rid)""",
    "op8_decontamination": f"""
    WITH item AS (SELECT CAST(item_id AS VARCHAR) AS id, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
    win AS (SELECT DISTINCT id, w[k : k + least(len(w), 10) - 1] AS g, least(len(w), 10) AS n
            FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM item WHERE len(w) > 0)),
    doc AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
    place AS (SELECT rid, k, n, w[k : k + n - 1] AS g
              FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc CROSS JOIN (SELECT DISTINCT n FROM win))),
    found AS (SELECT rid, k, place.n AS n, id FROM place JOIN win USING (g)),
    hit AS (SELECT rid, count(DISTINCT x) AS h FROM (SELECT rid, unnest(range(k, k + n)) AS x FROM found) GROUP BY rid),
    met AS (SELECT rid, count(*) AS c, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT rid, id FROM found) GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h, 0) AS n_hit, coalesce(c, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(h, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit USING (rid) LEFT JOIN met USING (rid)""",
    # components one by one: learning rounds are steps of the same shape, written out twice
    "op11_vector_codes": _vector_codes_sql(),
    "op12_prefix_trie": """
    WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, strlen(coalesce(text, '')) AS n_bytes,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                              sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
                   FROM conversations WHERE conv_id IS NOT NULL),
    -- crc32 bit by bit: each byte is followed by seven zeros, as every element is one step
    checksum AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, flatten([[CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(conv_id AS VARCHAR), '')])),
                     lambda r, b: CASE WHEN xor(r, b) % 2 = 1 THEN xor(xor(r, b) // 2, 3988292384) ELSE xor(r, b) // 2 END), 4294967295) % 9 AS h
                 FROM (SELECT DISTINCT conv_id FROM turns)),
    built AS (SELECT own.conv_id, 0 AS part, pos, role, text, n_bytes
              FROM checksum own JOIN turns lead ON lead.conv_id = own.conv_id - own.conv_id % 5 AND lead.pos <= own.h
              UNION ALL
              SELECT conv_id, 1, pos, role, text, n_bytes FROM turns JOIN checksum USING (conv_id) WHERE pos > h),
    whole AS (SELECT conv_id, list({r: role, t: text, b: n_bytes} ORDER BY part, pos) AS turns FROM built GROUP BY conv_id
              UNION ALL SELECT conv_id, [] FROM checksum ANTI JOIN built USING (conv_id)),
    prefix AS (SELECT conv_id, len(turns) AS length, depth, turns[1 : depth] AS path
               FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM whole)),
    node AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = depth), '')) AS ends_sha256
             FROM prefix GROUP BY path, depth),
    child AS (SELECT path[1 : depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
    weight AS (SELECT node.path, child.n IS NULL AS leaf, (n_convs - 1) * coalesce(node.path[node.depth].b, 0) AS saved FROM node LEFT JOIN child ON child.path = node.path),
    below AS (SELECT path[1 : d] AS path, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved
              FROM (SELECT path, leaf, saved, unnest(range(len(path) + 1)) AS d FROM weight) GROUP BY 1)
    SELECT node.conv_id, node.depth, above.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children, below.n_leaves,
           CAST(below.saved AS BIGINT) AS saved_tokens, node.ends_sha256
    FROM node JOIN below ON below.path = node.path LEFT JOIN child ON child.path = node.path
    LEFT JOIN node above ON above.path = node.path[1 : node.depth - 1] AND above.depth = node.depth - 1""",
}
