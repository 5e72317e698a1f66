"""Language of texts by Bayesian fusion of the text, declared language, address and host."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyport.llm.registry import query
from tallyport.llm.tables import table, written
from tallyport.llm.url_filter import host_of, path_of

# Labelled texts of a language that the model is fitted on, and languages at most.
TRAIN_TEXTS, MAX_LANGUAGES = 300, 64
# Three bytes are one gram; grams are told apart by 16 bits.
GRAMS = 1 << 16
# A long text counts as this many independent grams.
EVIDENCE = 60.0
# Pseudo-counts: of a declared value, and of the wider prior in the narrower one.
ALPHA, KAPPA = 1.0, 8.0
# A text is rejected if no language reaches this probability.
LEAST = 0.5

_SPACE = np.arange(256, dtype=np.uint8)
_SPACE[:65] = _SPACE[91:97] = _SPACE[123:128] = 32
_SPACE[65:91] += 32
_TAGS = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]+;", re.I | re.S)
_LANG = re.compile(rb"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]{2,3})\b", re.I)


def visible(html: bytes) -> bytes:
    """The text of a page without scripts, styles, comments, tags and entities."""
    return _TAGS.sub(b" ", html)


def declared_in(html: bytes) -> str | None:
    found = _LANG.search(html)
    return found[1].lower().decode() if found else None


def grams(text: bytes) -> np.ndarray:
    """The numbers of all grams of a text; bytes that are no letters count as a space, once in a row."""
    data = _SPACE[np.frombuffer(b" " + text + b" ", np.uint8)]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 32) | (data[:-1] != 32)
    data = data[keep].astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64)
    mix = data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA77) ^ data[2:] * np.uint32(0xC2B2AE3D)
    return ((mix ^ (mix >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(16)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sums[lang] = sums.get(lang, 0) + np.bincount(grams(text.as_buffer().to_pybytes()), minlength=GRAMS)
    for lang, counts in sums.items():
        full = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array([lang] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(counts[full], pa.int64())],
            names=["lang", "gram", "n"],
        )


class Model:
    """Log-likelihoods of grams for each language, fitted on labelled texts."""

    def __init__(self, languages: list[str], tables: np.ndarray):
        self.languages, self.tables = languages, tables

    @classmethod
    def fitted(cls, labelled: DataFrame, lang_col: str, text_col: str, key_col: str, texts: int = TRAIN_TEXTS) -> Model:
        """Fits on at most `texts` whole texts of each of the `MAX_LANGUAGES` most frequent labels.

        Which ones is decided by a hash of key and text. Rows with a null label or text take no part.
        """
        rows = labelled.select(
            F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(key_col).alias("key")
        ).where("lang is not null and text is not null")
        common = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
        languages = sorted(r.lang for r in common.collect())
        hashed = rows.where(F.col("lang").isin(languages)).withColumn("h", F.xxhash64("key", "text"))
        order = Window.partitionBy("lang").orderBy("h")
        chosen = hashed.select("lang", "h").withColumn("place", F.row_number().over(order)).where(F.col("place") <= texts)
        last = F.broadcast(chosen.groupBy(F.col("lang").alias("l")).agg(F.max("h").alias("last")))  # a row for each language
        sample = hashed.join(last, (F.col("lang") == F.col("l")) & (F.col("h") <= F.col("last"))).dropDuplicates(["lang", "h"])
        counts = sample.select("lang", "text").mapInArrow(_counted, "lang string, gram int, n long")
        tables = np.full((max(1, len(languages)), GRAMS), 0.5)
        # languages * GRAMS rows at most, as columns of numbers
        found = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
        which = pc.index_in(found["lang"], pa.array(languages, pa.string())).to_numpy()
        tables[which, found["gram"].to_numpy()] += found["n"].to_numpy()
        tables = np.log(tables / tables.sum(axis=1, keepdims=True))
        return cls(languages, tables.astype(np.float32))

    def scores(self, text: bytes) -> np.ndarray | None:
        """Log-likelihood of a text in each language, tempered; None without any letter."""
        found = grams(text)
        if not len(found):
            return None
        weight = min(1.0, EVIDENCE / len(found))
        return np.array([row[found].sum(dtype=np.float64) for row in self.tables]) * weight


def _scored(batches: Iterator[pa.RecordBatch], sent, pages: bool) -> Iterator[pa.RecordBatch]:
    model = Model(*sent.value)
    for batch in batches:
        scores, declared = [], []
        for text in batch.column(batch.num_columns - 1):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            if pages:
                declared.append(declared_in(raw))
                raw = visible(raw)
            found = model.scores(raw)
            scores.append(None if found is None else found.tolist())
        stated = pa.array(declared, pa.string()) if pages else batch.column(1)
        yield pa.record_batch(
            [batch.column(0), stated, *batch.columns[2:-1], pa.array(scores, pa.list_(pa.float64()))],
            names=["key", "declared", "suffix", "host", "scores"],
        )


def _normalised(rows: DataFrame, logs: str, out: str) -> DataFrame:
    """Adds `out`: probabilities from an array of log values. Columns of arrays keep the plan short for any number of languages."""
    powers = rows.withColumn("__top", F.array_max(logs)).withColumn("__powers", F.transform(logs, lambda x: F.exp(x - F.col("__top"))))
    total = powers.withColumn("__total", _total("__powers"))
    return total.withColumn(out, F.transform("__powers", lambda p: p / F.col("__total"))).drop("__top", "__powers", "__total")


def _total(values: str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _columns(name: str, n: int) -> list[Column]:
    return [F.col(name)[k] for k in range(n)]


def fused(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Posterior of each row of (key, declared, suffix, host, scores): adds lang, p and text_lang.

    First the text alone gives each row probabilities (all equal without letters). Their sums,
    by grouped aggregation, say how often each language comes with a declared value, an
    address suffix, a host, a domain (the last two labels of the host) and at all. The prior
    of a row is that of its host without the row itself, smoothed by that of its domain, which is
    smoothed by the whole. Prior, likelihood of declared value and suffix, and likelihood of the
    text are multiplied. A missing declared value, suffix or host says nothing.
    """
    n = len(languages)
    if not n:
        empty = F.lit(None).cast("string")
        return evidence.select("key", "declared", "host", empty.alias("lang"), F.lit(0.0).alias("p"), empty.alias("text_lang"))
    flat = F.array(*[F.lit(1.0 / n)] * n)
    domain = F.substring_index("host", ".", -2)
    scored = _normalised(evidence, "scores", "alone").withColumns({"alone": F.coalesce("alone", flat), "domain": domain})
    rows = written(scored, "evidence")
    sums = [F.sum(c).alias(f"s{k}") for k, c in enumerate(_columns("alone", n))]
    whole = rows.agg(*sums).first()  # one row
    masses = [whole[k] or 0.0 for k in range(n)]
    overall = [(m + ALPHA) / (sum(masses) + ALPHA * n) for m in masses]

    def likelihoods(name: str) -> DataFrame:
        by_value = rows.where(F.col(name).isNotNull()).groupBy(name).agg(*sums)
        # unseen values share one more pseudo-count
        return by_value.select(
            F.col(name).alias(f"__{name}"),
            F.array(*[F.log((F.col(f"s{k}") + ALPHA) / (masses[k] + ALPHA * (n + 1))) for k in range(n)]).alias(f"{name}_log"),
        )

    by_host = rows.where("host is not null").groupBy("host", "domain").agg(*sums)
    by_domain = by_host.groupBy("domain").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(n)])
    held = by_domain.select(F.col("domain").alias("__d"), F.array(*[F.col(f"s{k}") for k in range(n)]).alias("__s")).withColumn("__size", _total("__s"))
    domain_prior = held.select(
        "__d", F.array(*[(F.col("__s")[k] + KAPPA * overall[k]) / (F.col("__size") + KAPPA) for k in range(n)]).alias("wider")
    )
    hosts = by_host.join(domain_prior, F.col("domain") == F.col("__d")).select(
        F.col("host").alias("__host"), F.array(*[F.col(f"s{k}") for k in range(n)]).alias("seen"), "wider"
    )
    joined = (
        rows.join(hosts, F.col("host") == F.col("__host"), "left")
        .join(likelihoods("declared"), F.col("declared") == F.col("__declared"), "left")
        .join(likelihoods("suffix"), F.col("suffix") == F.col("__suffix"), "left")
    )
    seen, wider = _columns("seen", n), _columns("wider", n)
    others = F.col("__others")
    logs = []
    for k in range(n):
        prior = F.coalesce((F.greatest(seen[k] - F.col("alone")[k], F.lit(0.0)) + KAPPA * wider[k]) / (others + KAPPA), F.lit(overall[k]))
        log = F.log(prior) + F.coalesce(F.col("declared_log")[k], F.lit(0.0)) + F.coalesce(F.col("suffix_log")[k], F.lit(0.0))
        logs.append(log + F.coalesce(F.col("scores")[k], F.lit(0.0)))
    summed = joined.withColumn("__others", _total("seen") - 1).withColumn("__logs", F.array(*logs))
    names = F.array(*[F.lit(name) for name in languages])
    best = lambda ps: F.array_max(F.zip_with(ps, names, lambda p, lang: F.struct(p.alias("p"), lang.alias("lang"))))
    final = _normalised(summed, "__logs", "__p").withColumns({"__best": best("__p"), "__text": best("alone")})
    return final.select(
        "key", "declared", "host",
        F.col("__best.lang").alias("lang"), F.col("__best.p").alias("p"),
        F.when(F.col("scores").isNotNull(), F.col("__text.lang")).alias("text_lang"),
    )


EVIDENCE_SCHEMA = "key long, declared string, suffix string, host string, scores array<double>"


def identified_pages(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (key, declared, host, lang, p, text_lang) for every page.

    The suffix of an address is its host's last label, with the first part of the path if that
    has two letters. Null url or html, or html without letters, leave the other evidence; rows
    may repeat; other columns are not read.
    """
    url = F.col(url_col).cast("string")
    part = F.regexp_extract(path_of(url), "^/([A-Za-z]{2})(/|$)", 1)
    host = F.when(host_of(url) != "", host_of(url))
    rows = pages.select(
        F.col(id_col).cast("long").alias("key"),
        F.lit(None).cast("string").alias("declared"),
        F.concat_ws("/", F.substring_index(host, ".", -1), F.when(part != "", part)).alias("suffix"),
        host.alias("host"),
        F.col(html_col).cast("string").alias("text"),
    ).withColumn("suffix", F.when(F.col("host").isNotNull(), F.col("suffix")))
    sent = pages.sparkSession.sparkContext.broadcast((model.languages, model.tables))
    return fused(rows.mapInArrow(lambda it: _scored(it, sent, True), EVIDENCE_SCHEMA), model.languages)


def identified_texts(
    docs: DataFrame, model: Model, key: Column, text_col: str = "text", declared_col: str | None = "lang", host_col: str | None = "source"
) -> DataFrame:
    """The same for plain texts: a column may stand for the declared language, another one for the host."""
    absent = F.lit(None).cast("string")
    rows = docs.select(
        key.cast("long").alias("key"),
        (F.col(declared_col).cast("string") if declared_col else absent).alias("declared"),
        absent.alias("suffix"),
        (F.col(host_col).cast("string") if host_col else absent).alias("host"),
        F.col(text_col).cast("string").alias("text"),
    )
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.tables))
    return fused(rows.mapInArrow(lambda it: _scored(it, sent, False), EVIDENCE_SCHEMA), model.languages)


def rejected(found: DataFrame, least: float = LEAST) -> DataFrame:
    """Rows without a letter in their text, or in which no language is likely enough."""
    return found.where(F.col("text_lang").isNull() | (F.col("p") < least))


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    """The language of every page; the text model is fitted on labelled documents."""
    docs = table(spark, sf_dir, "documents")
    model = Model.fitted(docs, "lang", "text", "doc_id")
    found = identified_pages(table(spark, sf_dir, "pages"), model)
    return found.select(F.col("key").alias("page_id"), "host", "declared", "text_lang", "lang", F.round("p", 6).alias("p"))
