"""Full-text search over a text column.

Tokens are maximal runs of letters, digits and underscore after lower-casing, so a
search is whole-word and case-insensitive. For a fixed query every term is counted
per document with an array expression -- no explode, no shuffle -- and the document
frequencies come from one global aggregate (one row, broadcast back).

Relevance (fixed formula): ``sum over query terms of tf * idf^2`` with
``idf = log10(N / df)``, N = documents in the corpus, df = documents holding the term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import col

# Fixed value: what separates tokens.
TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def tokens(text: str | Column) -> Column:
    parts = F.split(F.lower(col(text)), TOKEN_SPLIT)
    return F.filter(parts, lambda t: t != F.lit(""))


def term_count(text: str | Column, term: str) -> Column:
    """Occurrences of ``term`` as a whole token: not preceded or followed by a token character.

    Same count as splitting into tokens and comparing, without building the token array.
    """
    t = term.lower()
    if not t or not all(ch.isalnum() or ch == "_" for ch in t):
        raise ValueError("a search term is one token: letters, digits or underscore")
    pattern = r"(?<![\p{L}\p{N}_])" + t + r"(?![\p{L}\p{N}_])"
    return F.regexp_count(F.lower(col(text)), F.lit(pattern))


def search(df: DataFrame, text_col: str, terms: Sequence[str], digits: int = 6) -> DataFrame:
    """X1 + X2: rows holding at least one term, with per-term counts and relevance."""
    from ..session import cut_lineage
    terms = [t.lower() for t in terms]
    # per-document counts are narrow (no text): pin them once, so the corpus statistics and
    # the matching rows do not each scan and tokenise the whole corpus
    keep = [c for c in df.columns if c != text_col]
    counted = cut_lineage(df.select(*keep, *[term_count(text_col, t).alias(f"tf_{i}") for i, t in enumerate(terms)]))
    stats = counted.agg(F.count(F.lit(1)).alias("_N"),
                        *[F.count_if(F.col(f"tf_{i}") > 0).alias(f"df_{i}") for i in range(len(terms))])
    j = counted.where(F.greatest(*[F.col(f"tf_{i}") for i in range(len(terms))], F.lit(0)) > 0) \
        .crossJoin(F.broadcast(stats))
    rel = None
    for i in range(len(terms)):
        idf = F.log10(F.try_divide(F.col("_N"), F.col(f"df_{i}")))
        part = F.coalesce(F.col(f"tf_{i}") * idf * idf, F.lit(0.0))  # a term that no document has adds nothing
        rel = part if rel is None else rel + part
    out = j.withColumn("relevance", F.round(rel, digits)).drop("_N", *[f"df_{i}" for i in range(len(terms))])
    return out


def document_frequencies(df: DataFrame, doc_col: str, text_col: str) -> DataFrame:
    """X2 index side: (token, term_count, doc_count) over the whole corpus."""
    exploded = df.select(doc_col, F.explode(tokens(text_col)).alias("token"))
    per_doc = exploded.groupBy("token", doc_col).agg(F.count(F.lit(1)).alias("_tf"))
    return per_doc.groupBy("token").agg(F.sum("_tf").alias("term_count"), F.count(F.lit(1)).alias("doc_count"))
