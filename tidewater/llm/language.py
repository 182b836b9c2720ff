"""Language identification by Bayesian fusion of four kinds of evidence about a page.

* Text: multinomial likelihood of hashed byte trigrams under models counted, per language, over all labelled
  documents. Trigrams of a text are not independent, so the log likelihood ratio is divided by ``TEMPER`` and bounded by ``TEXT_BOUND``.
* Markup: the language declared by ``<html lang>`` or a content-language meta element.
* Address: the address suffix, i.e. the top-level domain, and a two-letter path or host label such as /fr/.
* Host: how the other pages of the host read, smoothed towards its domain, that towards its top-level domain, and that
  towards all pages (``STRENGTH`` pseudo-pages at each level).

The reliability of markup and address, P(declared | language), and the priors are learnt from all pages by grouped sums of the
text posteriors, so no hand-set trust in either is needed. Sums are combined within tasks before the shuffle; a host with a
third of all pages is one row after that. Languages are all those of the documents; a model has 128 KB.

Defined cases: a null or empty page has no text evidence, a null address no host (one group of its own); without labelled
documents the language is null; pages whose evidence is even get the language first by name; repeated rows give repeated results
(each counts towards its host); other columns are ignored.
"""

from __future__ import annotations

import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import Workspace
from .html import extract

TRIGRAMS = 1 << 14
TEMPER = 4.0
TEXT_BOUND = 30.0
STRENGTH = 5.0
_HTML_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_META_LANG = re.compile(r"<meta\b[^>]*?http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*?content\s*=\s*[\"']?([A-Za-z-]+)", re.I)


def trigrams(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every byte trigram with A-Z as a-z and runs of white space and digits taken as they are."""
    data = chunk.data.astype(np.int64)
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    if len(data) < 3:
        none = np.zeros(0, np.int64)
        return none, none
    code = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    doc = np.repeat(np.arange(chunk.n), np.diff(chunk.offsets))
    inside = doc[2:] == doc[:-2]
    return doc[:-2][inside], (K.mix64(code[inside].astype(K.U64)) % K.U64(TRIGRAMS)).astype(np.int64)


class TextModels:
    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.log = counts + 0.5
        for row in self.log:  # a language at a time: the table exists twice at most
            row[:] = np.log(row / row.sum())

    def evidence(self, chunk: K.Chunk) -> np.ndarray:
        """Bounded log likelihoods relative to the best language, one row per text."""
        doc, gram = trigrams(chunk)
        total = np.stack([np.bincount(doc, row[gram], minlength=chunk.n) for row in self.log], 1)
        return np.maximum((total - total.max(1, keepdims=True)) / TEMPER, -TEXT_BOUND)


def text_models(documents: DataFrame) -> TextModels | None:
    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array([x or "" for x in batch.column(1).to_pylist()], object)
            for chunk in K.chunks(batch.column(0)):
                doc, gram = trigrams(chunk)
                own = langs[chunk.first : chunk.first + chunk.n]
                for lang in set(own) - {""}:
                    totals[lang] = totals.get(lang, 0) + np.bincount(gram[(own == lang)[doc]], minlength=TRIGRAMS)
        for lang, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.record_batch([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some].astype(np.int64))], names=["lang", "gram", "n"])

    slim = documents.select(F.col("text").cast("string").alias("text"), F.lower(F.col("lang").cast("string")).alias("lang"))
    counts = slim.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # one row of at most TRIGRAMS counts per language
    rows = counts.groupBy("lang").agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts")).toArrow()
    if not len(rows):
        return None
    languages = rows.column("lang").to_pylist()
    order = sorted(range(len(languages)), key=languages.__getitem__)
    table = np.zeros((len(languages), TRIGRAMS))
    for place, i in enumerate(order):
        table[place, rows.column("grams")[i].values.to_numpy()] = rows.column("counts")[i].values.to_numpy()
    return TextModels([languages[i] for i in order], table)


def declared_language(html: str | None) -> str | None:
    found = _HTML_LANG.search(html or "") or _META_LANG.search(html or "")
    return found[1].split("-")[0].lower() if found else None


def address(url: str | None) -> tuple[str, str, str, str]:
    """Host, domain (last two labels), top-level domain, and the suffix evidence: top-level domain with a language-like label."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").lower().rstrip(".")
    except ValueError:
        return "", "", "", ""
    labels = host.split(".") if host else []
    top = labels[-1] if labels else ""
    marks = [x for x in [labels[0] if len(labels) > 2 else "", *parts.path.lower().split("/")] if re.fullmatch(r"[a-z]{2}", x)]
    return host, ".".join(labels[-2:]), top, f"{top}/{marks[0] if marks else ''}"


_PAGE = "page_id long, url string, declared string, host string, domain string, top string, suffix string, evidence array<double>"


def _page_evidence(pages: DataFrame, models: TextModels) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(models)

    def each(batches):
        models = shared.value
        for batch in batches:
            html = batch.column(2).to_pylist()
            texts = pa.array([extract(x) for x in html], pa.string())
            evidence = np.concatenate([models.evidence(c) for c in K.chunks(texts)]) if len(texts) else np.zeros((0, len(models.languages)))
            where = [address(u) for u in batch.column(1).to_pylist()]
            columns = [pa.array([w[i] for w in where], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([declared_language(x) for x in html], pa.string()), *columns, pa.array(list(evidence), pa.list_(pa.float64()))], names=["page_id", "url", "declared", "host", "domain", "top", "suffix", "evidence"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(each, _PAGE)


def _normal(array):
    """exp of an array of logs, made to sum to one."""
    top = F.array_max(array)
    powers = F.transform(array, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, y: a + y))


def identify(pages: DataFrame, documents: DataFrame, work: Workspace | None = None) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``lang``, ``probability``, ``text_lang``, ``declared``."""
    spark = pages.sparkSession
    models = text_models(documents)
    if models is None:
        nothing = F.lit(None).cast("string")
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), nothing.alias("lang"), F.lit(None).cast("double").alias("probability"), nothing.alias("text_lang"), nothing.alias("declared"))
    work = work or Workspace(spark, "language")
    k = len(models.languages)
    rows = work.write(_page_evidence(pages, models).withColumn("posterior", _normal(F.col("evidence"))), "evidence")
    sums = [F.sum(F.col("posterior")[i]).alias(f"s{i}") for i in range(k)]
    total = F.aggregate(F.array(*(F.col(f"s{i}") for i in range(k))), F.lit(0.0), lambda a, x: a + x).alias("total")

    def level(keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(*sums)

    # priors from all pages down to the host; each level leans on the one above
    everything = rows.agg(*sums).first()
    n = sum(everything[f"s{i}"] or 0.0 for i in range(k))
    root = [((everything[f"s{i}"] or 0.0) + 1) / (n + k) for i in range(k)]
    prior = None
    for keys in (["top"], ["top", "domain"], ["top", "domain", "host"]):
        counted = level(keys)
        above = F.array(*(F.lit(x) for x in root)) if prior is None else F.col("above")
        if prior is not None:
            counted = counted.join(prior, keys[:-1])
        counted = counted.select("*", total)
        lean = F.array(*((F.col(f"s{i}") + STRENGTH * above[i]) / (F.col("total") + STRENGTH) for i in range(k)))
        last = keys[-1] == "host"
        prior = counted.select(*keys, lean.alias("above"), *([F.array(*(F.col(f"s{i}") for i in range(k))).alias("own"), above.alias("upper")] if last else []))
    prior = prior.select("host", "own", "upper")
    # reliability: P(declared | language) and P(suffix | language), add-one smoothed over the values met
    likelihoods = {}
    for name in ("declared", "suffix"):
        by_value = rows.where(F.col(name).isNotNull()).groupBy(name).agg(*sums)
        size = by_value.agg(F.count("*").alias("values"), *(F.sum(f"s{i}").alias(f"t{i}") for i in range(k))).first()
        log = F.array(*(F.log((F.col(f"s{i}") + 1) / F.lit((size[f"t{i}"] or 0.0) + size["values"] + 1)) for i in range(k)))
        likelihoods[name] = by_value.select(name, log.alias(f"log_{name}"))
    joined = rows.join(prior, "host").join(likelihoods["declared"], "declared", "left").join(likelihoods["suffix"], "suffix", "left")
    # the page's own posterior is taken out of its host's sum: evidence counts once
    others = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.greatest(F.col("own")[i] - F.col("posterior")[i], F.lit(0.0)))
    joined = joined.withColumn("others", others).withColumn("n_others", F.aggregate("others", F.lit(0.0), lambda a, x: a + x))
    share = lambda i: F.log((F.col("others")[i] + STRENGTH * F.col("upper")[i]) / (F.col("n_others") + STRENGTH))
    zero = F.lit(0.0)
    fused = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.col("evidence")[i] + share(i) + F.coalesce(F.col("log_declared")[i], zero) + F.coalesce(F.col("log_suffix")[i], zero))
    names = F.array(*(F.lit(x) for x in models.languages))
    best = lambda array: names[(F.array_position(array, F.array_max(array)) - 1).cast("int")]
    final = joined.withColumn("fused", _normal(fused))
    return final.select("page_id", "url", best(F.col("fused")).alias("lang"), F.array_max("fused").alias("probability"), best(F.col("evidence")).alias("text_lang"), "declared")
