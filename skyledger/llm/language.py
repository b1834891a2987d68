"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied per row: the text's likelihood under byte
trigram models, the declared markup language, the address suffix, and the prior
of the host. The languages are the labels, and trigram counts come from all
labelled documents. In every language ``UNSEEN`` of the probability is spread over
all trigrams alike, so one that was seen nowhere speaks for none of them. What is
in no language has a class of its own, "und", with a model that is ``UNIFORM``
nearly uniform and otherwise the mean of the languages; it takes part in all that
follows. How a declaration
or a suffix speaks for a language, and how languages are spread over hosts, is
counted over all rows by grouped sums of the text posteriors; host priors are
smoothed towards their domain and domains towards the whole. Only tables whose
size is set by the number of languages reach the driver.

A row is rejected ("und") when its text has no trigram, "und" is likeliest or no
language reaches ``SURE``. A label "und" or an empty one is no label. Null texts are empty, hence rejected; a missing declaration, suffix or
host is a value of its own. Ties go to the language first in the list. Repeated
rows count one by one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import joined_bytes, staged, steps

#: Folders of an address that name a language, where no model says which do.
LANGUAGES = ("de", "en", "es", "fr")
NONE = "und"
BUCKETS = 8192
#: Overlapping trigrams repeat what their neighbours say, so each counts for less.
WEIGHT = 0.3
SMOOTHING = 20.0
SURE = 0.5
UNSEEN = 0.05
UNIFORM = 0.9

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


class Model(NamedTuple):
    """Log likelihood of each trigram bucket (columns) in each language and, last, in none (rows)."""

    languages: tuple[str, ...]
    likelihood: np.ndarray


def trigram_buckets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each trigram that stands in one text, and where each text's begin."""
    low = _LOWER[data]
    if len(low) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(len(starts), dtype=np.int64)
    code = low[:-2] | (low[1:-1] << np.uint32(8)) | (low[2:] << np.uint32(16))
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(19)).astype(np.int64)
    n = np.maximum(np.diff(starts) - 2, 0)
    begin = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], n) + np.repeat(starts[:-1], n)
    return bucket[at], begin


def model_of(languages: Sequence[str], counts: np.ndarray) -> Model:
    """The model of trigram counts per language (rows)."""
    each = (1 - UNSEEN) * counts / np.maximum(counts.sum(axis=1, keepdims=True), 1) + UNSEEN / BUCKETS
    mean = each.mean(axis=0) if len(languages) else np.full(BUCKETS, 1 / BUCKETS)
    return Model(tuple(languages), np.log(np.vstack([each, (1 - UNIFORM) * mean + UNIFORM / BUCKETS])))


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """The model of all labelled rows; its languages are the labels."""
    labels = docs.select(F.col(label).alias("label")).where(~F.col("label").isin("", NONE)).distinct().collect()
    languages = sorted(r["label"] for r in labels)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for step in steps(batches, "text"):
            data, starts = joined_bytes(step.column("text"))
            buckets, begin = trigram_buckets(data, starts)
            row = np.array([languages.index(x) for x in step.column("label").to_pylist()])
            each = np.repeat(row, np.diff(begin))
            counts += np.bincount(each * BUCKETS + buckets, minlength=counts.size).reshape(counts.shape)
        k, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(b), pa.array(counts[k, b])], ["k", "b", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(label).alias("label")).where(F.col("label").isin(*languages))
    totals = rows.mapInArrow(count, "k long, b long, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(languages), BUCKETS))
    counts[totals["k"].to_numpy(dtype=int), totals["b"].to_numpy(dtype=int)] = totals["n"].to_numpy(dtype=float)
    return model_of(languages, counts)


def text_evidence(rows: DataFrame, model: np.ndarray, carried: Sequence[str]) -> DataFrame:
    """The ``carried`` columns with ``grams`` and ``evidence`` (log likelihoods, the best at 0) in place of ``text``, unless it is one of them."""
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            data, starts = joined_bytes(step.column("text"))
            buckets, begin = trigram_buckets(data, starts)
            sums = np.zeros((step.num_rows, len(model)))
            some = np.flatnonzero(np.diff(begin))
            if len(some):
                for k, likelihood in enumerate(model):
                    sums[some, k] = np.add.reduceat(likelihood[buckets], begin[some])
            sums = WEIGHT * (sums - sums.max(axis=1, keepdims=True))
            evidence = pa.ListArray.from_arrays(
                pa.array(np.arange(step.num_rows + 1, dtype=np.int32) * len(model)), pa.array(sums.ravel()))
            yield pa.RecordBatch.from_arrays(
                [step.column(c) for c in carried] + [pa.array(np.diff(begin)), evidence], [*carried, "grams", "evidence"])

    return rows.select(*dict.fromkeys([*carried, "text"])).mapInArrow(score, ", ".join([*kinds, "grams long", "evidence array<double>"]))


def _softmax(scores: list[Column]) -> list[Column]:
    total = sum((F.exp(s) for s in scores[1:]), F.exp(scores[0]))
    return [F.exp(s) / total for s in scores]


def _counted(rows: DataFrame, by: Sequence[str], k: int, prefix: str) -> DataFrame:
    """The grouped sums of the text posteriors; combined before they are shuffled, and stored."""
    return staged(rows.groupBy(*by).agg(
        F.count("*").alias(f"{prefix}n"), *[F.sum(f"p{i}").alias(f"{prefix}{i}") for i in range(k)]), "language-counts")


def identify(
    rows: DataFrame, model: Model, row: str = "row", text: str = "text",
    declared: str | None = "declared", suffix: str | None = "suffix", host: str | None = "host", domain: str | None = "domain",
) -> DataFrame:
    """``row``, ``text_lang``, ``declared``, ``suffix``, ``host``, ``lang``, ``confidence``, ``rejected``."""
    told = staged(_text_posteriors(rows, model, [row], text, declared, suffix, host, domain), "language-text")
    return _fused(told, told, model).withColumnRenamed(row, "row").select(
        "row", "text_lang", "declared", "suffix", "host", "lang", "confidence", "rejected")


EVIDENCE = ("declared", "suffix", "host", "domain")


def _text_posteriors(
    rows: DataFrame, model: Model, carried: Sequence[str], text: str, declared: str | None, suffix: str | None,
    host: str | None, domain: str | None,
) -> DataFrame:
    """The ``carried`` columns, the evidence beside the text, and what the text alone says."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c else F.lit("")
    flat = rows.select(*[F.col(c) for c in carried if c != "text"], known(declared).alias("declared"), known(suffix).alias("suffix"),
                       known(host).alias("host"), known(domain).alias("domain"), F.col(text).alias("text"))
    told = text_evidence(flat, model.likelihood, [*carried, *EVIDENCE])
    scores = [F.get("evidence", i) for i in range(len(model.languages) + 1)]
    return told.select("*", *[p.alias(f"p{i}") for i, p in enumerate(_softmax(scores))])


def _fused(told: DataFrame, judged: DataFrame, model: Model) -> DataFrame:
    """``judged`` with its language, from its own evidence and what is counted over ``told``; both as ``_text_posteriors`` gives them."""
    classes = (*model.languages, NONE)
    n = len(classes)
    totals = told.agg(F.count("*").alias("n"), *[F.sum(f"p{i}").alias(f"p{i}") for i in range(n)]).head()
    share = [((totals[f"p{i}"] or 0.0) + 1.0) / ((totals["n"] or 0) + n) for i in range(n)]
    mass = [(totals[f"p{i}"] or 0.0) + SMOOTHING for i in range(n)]
    domains = _counted(told, ["domain"], n, "d")
    hosts = _counted(told, ["domain", "host"], n, "h")
    smooth = lambda p, i, up: (F.col(f"{p}{i}") + SMOOTHING * up) / (F.col(f"{p}n") + SMOOTHING)
    priors = staged(hosts.join(domains, "domain").select(
        "domain", "host", *[smooth("h", i, smooth("d", i, F.lit(share[i]))).alias(f"prior{i}") for i in range(n)]), "language-priors")

    def speaks(column: str, prefix: str) -> DataFrame:
        """P(value | language): an unseen pairing gets the value's overall share of the smoothing mass."""
        whole = max(totals["n"] or 0, 1)
        return _counted(told, [column], n, prefix).select(column, *[
            ((F.col(f"{prefix}{i}") + SMOOTHING * F.col(f"{prefix}n") / whole) / mass[i]).alias(f"{prefix}{i}") for i in range(n)])

    fused = judged.join(priors, ["domain", "host"]).join(
        staged(speaks("declared", "m"), "language-declared"), "declared").join(
        staged(speaks("suffix", "s"), "language-suffix"), "suffix")
    posterior = _softmax([
        F.log(f"prior{i}") + F.log(f"m{i}") + F.log(f"s{i}") + F.get("evidence", i) for i in range(n)])
    names = F.array(*[F.lit(x) for x in classes])
    best = lambda values: F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))
    fused = fused.withColumn("posterior", F.array(*posterior))
    confidence = F.array_max("posterior")
    rejected = (F.col("grams") == 0) | (confidence < SURE) | (best(F.col("posterior")) == NONE)
    given = [c for c in judged.columns if c not in ("grams", "evidence") and not c.startswith("p")]
    return fused.select(
        *given, F.when(F.col("grams") > 0, best(F.array(*[F.col(f"p{i}") for i in range(n)]))).alias("text_lang"),
        F.when(rejected, F.lit("und")).otherwise(best(F.col("posterior"))).alias("lang"),
        confidence.alias("confidence"), rejected.alias("rejected"))


def page_rows(pages: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """Pages as rows for ``identify``: visible text, declared language, address suffix, host and domain."""
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    folder = F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/([a-z]{2})(?:[/?#]|$)", 1)
    end = F.regexp_extract(host, r"\.([a-z]+)$", 1)
    return pages.select(
        F.col("page_id").alias("row"), text.alias("text"),
        F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2})", 1)).alias("declared"),
        F.when(folder.isin(*languages), folder).otherwise(end).alias("suffix"),
        host.alias("host"), F.regexp_replace(host, r"^[^.]+\.(?=[^.]+\.)", "").alias("domain"))


def accepted(docs: DataFrame, text: str = "text", declared: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` whose language is found, with all their columns; the model comes from their own labels.

    Texts are scored twice: for the counts, and again when the rows are judged, with all their columns
    beside them. So nothing has to be looked up by row, and no text is shuffled or copied.
    """
    rest = [c for c in docs.columns if c != text]
    flat = docs.select(
        F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(text).alias("text"),
        F.col(declared).alias("declared"), F.col(source).alias("host"))
    model = train(flat, "text", "declared")
    evidence = ("text", "declared", None, "host", None)
    told = staged(_text_posteriors(flat, model, [], *evidence), "language-text")
    judged = _fused(told, _text_posteriors(flat, model, ["rest", "text"], *evidence), model).where("NOT rejected")
    return judged.select(*[F.col("text").alias(c) if c == text else F.col(f"rest.`{c}`") for c in docs.columns])
