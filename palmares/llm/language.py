"""Language ID by Bayesian fusion of text, declared language, address suffix and host.

Every source of evidence gives a likelihood or prior for each language; their logarithms are added. The text model counts
byte trigrams of a bounded sample of labelled rows, in two halves: a row is read by the model of the other half, so its own label
has no part in its text's evidence and can count beside it. The reliability of declarations and suffixes, and the habits of hosts,
come from grouped counts over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, small, written

#: Most labelled rows the text models are fitted on, drawn by a hash of the id, and most languages they tell apart (of more
#: declared values the most frequent: declarations are noisy, and a model needs rows).
FIT_ROWS = 16_000
FIT_TASKS = 32
LANGUAGES = 256
#: Trigram buckets; bytes of text after which more of it adds no further weight (trigrams of a text depend on each other).
BUCKETS = 1 << 15
WEIGHT = 400
#: Rows that the habits of all hosts count as, beside the host's own; share of doubt in any declaration.
HOST_ROWS = 50.0
DOUBT = 0.02
#: A row is rejected if its best language is less sure than this, or if it reads unlike every language.
SURE = 0.6
STRANGE = 6.0
_PIECE = 1 << 20


def trigrams(text: bytes) -> np.ndarray:
    """Bucket of each byte trigram of a text in lower case, blanks as one; a blank stands at both ends."""
    data = np.frombuffer(b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().split()) + b" ", dtype=np.uint8)
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    code = data.astype(np.uint32)
    mixed = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    return ((mixed * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


@dataclass
class TextModel:
    """For each half of the rows: log-probabilities (languages x buckets) learnt from the other half; and how the mean of a text's
    own language spreads, (mean, deviation) by language."""

    languages: list[str]
    logp: np.ndarray
    usual: np.ndarray

    def means(self, text: bytes | None, half: int) -> tuple[int, np.ndarray]:
        """(trigrams, mean log-probability by language) of a whole text."""
        sums, n = np.zeros(len(self.languages)), 0
        for a in range(0, len(text or b""), _PIECE):
            grams = trigrams(text[a : a + _PIECE])
            n += len(grams)
            sums += self.logp[half][:, grams].sum(axis=1)
        return n, sums / n if n else sums


def half_of(doc_id: Column) -> Column:
    """0 or 1 by a hash of the id; 0 for null."""
    return F.coalesce(F.pmod(F.xxhash64(doc_id, F.lit(5)), F.lit(2)), F.lit(0)).cast("int")


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> TextModel:
    """A model from rows (doc_id, text, lang): at most ``fit_rows`` of them, and the LANGUAGES most frequent languages.

    Trigrams are counted on the executors; one count vector a language, half and task is summed by group.
    """
    top = labelled.where("lang is not null and lang <> ''").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    names = sorted(r["lang"] for r in top)
    if not names:
        return TextModel([], np.zeros((2, 0, BUCKETS), dtype=np.float32), np.zeros((0, 2)))
    n = sum(r["count"] for r in top)
    drawn = labelled.where(F.col("lang").isin(names))
    if n > fit_rows:
        drawn = drawn.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * fit_rows / n))
    drawn = drawn.select("lang", half_of(F.col("doc_id")).alias("half"), F.col("text").cast("binary").alias("text"))
    # the sample is bounded: a few tasks count it, each of which gives a vector a language and half
    drawn = written(drawn.repartition(FIT_TASKS), "language-rows")

    def rows(b: pa.RecordBatch):
        return zip(*(b.column(k).to_pylist() for k in range(3)))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for b in it:
            for lang, half, text in rows(b):
                if text:
                    c = np.bincount(trigrams(text), minlength=BUCKETS)
                    # a long text counts as one of WEIGHT trigrams times ten at most
                    sums[lang, half] = sums.get((lang, half), 0) + c * min(1.0, 10 * WEIGHT / max(1, c.sum()))
        for (lang, half), c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array([half] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.float64))], names=["lang", "half", "b", "n"])

    summed = drawn.mapInArrow(count, "lang string, half int, b int, n double").groupBy("lang", "half", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((2, len(names), BUCKETS), 0.2)
    place = {name: k for k, name in enumerate(names)}
    who = np.array([place[x] for x in summed.column("lang").to_pylist()], dtype=np.int64)
    # the counts of a half serve the rows of the other one
    np.add.at(table, (1 - summed.column("half").to_numpy(), who, summed.column("b").to_numpy()), summed.column("n").to_numpy())
    model = TextModel(names, np.log(table / table.sum(axis=2, keepdims=True)).astype(np.float32), np.zeros((len(names), 2)))
    sent = drawn.sparkSession.sparkContext.broadcast(model)

    def own(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in it:
            keep = [(lang, *m.means(t, half)) for lang, half, t in rows(b)]
            keep = [(lang, float(v[m.languages.index(lang)])) for lang, n, v in keep if n >= 30]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in keep], pa.string()), pa.array([x for _, x in keep], pa.float64())], names=["lang", "v"])

    for r in drawn.mapInArrow(own, "lang string, v double").groupBy("lang").agg(F.avg("v").alias("m"), F.stddev("v").alias("s")).collect():
        model.usual[place[r["lang"]]] = (r["m"], max(r["s"] or 0.0, 0.05))
    return model


def text_evidence(docs: DataFrame, model: TextModel) -> DataFrame:
    """``docs`` (any columns beside binary ``text``, which goes, and ``half``) with n_grams, ll (tempered log-likelihoods) and strange.

    A likelihood counts as that of WEIGHT trigrams at most. ``strange`` is by how many deviations the text falls short of the
    language that it suits best.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in it:
            got = [m.means(t, half) for t, half in zip(b.column("text").to_pylist(), b.column("half").to_pylist())]
            low = [float(((m.usual[:, 0] - v) / m.usual[:, 1]).min()) if n and len(v) else 0.0 for n, v in got]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in rest], pa.array([n for n, _ in got], pa.int64()), pa.array([(v * min(n, WEIGHT) / 4).tolist() for n, v in got], pa.list_(pa.float64())), pa.array(low, pa.float64())],
                names=[*[f.name for f in rest], "n_grams", "ll", "strange"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return docs.mapInArrow(batches, f"{kinds}, n_grams long, ll array<double>, strange double")


def host_of(address: Column) -> Column:
    """The host of an address in lower case, without scheme, port and path."""
    return F.regexp_replace(F.lower(address), r"^[a-z][a-z0-9+.-]*://|[/?#:].*$", "")


def page_text(html: Column) -> Column:
    """What a page shows: without scripts, styles, comments and tags; character references stay as they are."""
    plain = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.btrim(F.regexp_replace(plain, r"<[^>]*>", " "))


def suffix_of(address: Column) -> Column:
    """The last label of the host of an address (``de`` of https://a.b.de/x); null without a dot."""
    return F.nullif(F.regexp_extract(host_of(address), r"\.([a-z]{2,})$", 1), F.lit(""))


def markup_language(html: Column) -> Column:
    """The main part of the first lang attribute of an html tag, in lower case; null without one."""
    found = F.regexp_extract(html, r"(?is)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    return F.nullif(F.lower(found), F.lit(""))


def _add(a: Column, b: Column) -> Column:
    return F.when(b.isNull(), a).otherwise(F.zip_with(a, b, lambda x, y: x + y))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", declared: Column | None = None, address: Column | None = None,
             host: Column | None = None, model: TextModel | None = None) -> DataFrame:
    """Rows (doc_id, row_hash, language, probability, kept, reason, declared, suffix): one per row of ``docs``.

    Evidence: the whole text; ``declared`` and the suffix of ``address`` by how often each goes with each language in the table;
    ``host`` by its rows' languages, smoothed by the habits of all hosts of its suffix and these by all rows. Missing evidence says
    nothing. Rejected are rows without letters (``empty``), with a best probability under SURE (``unsure``) and texts that fall
    far short of every language (``strange``). Null texts are empty. Without a model the text model is fitted on ``declared``.
    """
    none = F.lit(None).cast("string")
    base = docs.select(
        docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("row_hash"), (declared if declared is not None else none).alias("declared"),
        suffix_of(address if address is not None else none).alias("suffix"), F.lower(host if host is not None else none).alias("host"), docs[text].cast("binary").alias("text"),
        half_of(docs[doc_id]).alias("half"), F.coalesce(F.regexp_like(docs[text], F.lit(r"\p{L}")), F.lit(False)).alias("letters"))
    if model is None:
        model = fit(docs.select(docs[doc_id].alias("doc_id"), (declared if declared is not None else none).alias("lang"), docs[text].alias("text")))
    names, n = model.languages, len(model.languages)
    if not n:
        return base.select("doc_id", "row_hash", none.alias("language"), F.lit(0.0).alias("probability"), F.lit(False).alias("kept"), F.lit("unsure").alias("reason"), "declared", "suffix")
    seen = written(text_evidence(base, model), "evidence")
    best = F.array_position("ll", F.array_max("ll")).cast("int") - 1
    votes = [F.sum((F.col("best") == k).cast("double")) for k in range(n)]
    voted = seen.where("letters and n_grams >= 20").select("declared", "suffix", "host", best.alias("best"))
    by_host = written(voted.groupBy("host", "suffix", "declared").agg(*[v.alias(f"v{k}") for k, v in enumerate(votes)]), "votes")
    each = [F.col(f"v{k}") for k in range(n)]
    all_counts = by_host.agg(*[F.sum(c) for c in each]).first()
    counts = np.array([float(x or 0.0) for x in all_counts]) + 1.0
    overall = counts / counts.sum()

    def given(column: str) -> DataFrame:
        """log P(value | language) up to a constant: counts against what the language's share leads one to expect, with doubt."""
        sums = by_host.where(F.col(column).isNotNull()).groupBy(column).agg(*[F.sum(c).alias(f"v{k}") for k, c in enumerate(each)])
        likely = [F.log(F.lit(DOUBT) + F.col(f"v{k}") / F.lit(float(counts[k]))) for k in range(n)]
        return small(written(sums.select(F.col(column).alias(f"{column}_key"), F.array(*likely).alias(f"{column}_ll")), column))

    # hosts lean on their suffix, suffixes on all rows
    of_suffix = by_host.groupBy("suffix").agg(*[F.sum(c).alias(f"s{k}") for k, c in enumerate(each)])
    of_host = by_host.where("host is not null").groupBy("host", "suffix").agg(*[F.sum(c).alias(f"v{k}") for k, c in enumerate(each)])
    joined = of_host.join(of_suffix.withColumnRenamed("suffix", "sfx"), F.col("suffix").eqNullSafe(F.col("sfx")))
    s_all = sum((F.col(f"s{k}") for k in range(n)), F.lit(HOST_ROWS))
    v_all = sum((F.col(f"v{k}") for k in range(n)), F.lit(HOST_ROWS))
    up = [(F.col(f"s{k}") + F.lit(HOST_ROWS * float(overall[k]))) / s_all for k in range(n)]
    prior = [F.log((F.col(f"v{k}") + HOST_ROWS * u) / v_all) for k, u in enumerate(up)]
    hosts = small(written(joined.select(F.col("host").alias("h"), F.col("suffix").alias("hs"), F.array(*prior).alias("host_ll")), "hosts"))
    d, s = given("declared"), given("suffix")
    out = seen.join(d, seen["declared"] == d["declared_key"], "left").join(s, seen["suffix"] == s["suffix_key"], "left")
    out = out.join(hosts, (seen["host"] == hosts["h"]) & seen["suffix"].eqNullSafe(hosts["hs"]), "left")
    flat = F.array(*[F.lit(float(math.log(x))) for x in overall])
    fused = _add(_add(_add(F.col("ll"), F.coalesce("host_ll", flat)), F.col("declared_ll")), F.col("suffix_ll"))
    out = out.select("doc_id", "row_hash", "letters", "n_grams", "strange", fused.alias("fused"), "declared", "suffix")
    top = F.array_max("fused")
    whole = F.aggregate(F.transform("fused", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    out = out.select("*", (1 / whole).alias("probability"), F.get(F.array(*[F.lit(x) for x in names]), F.array_position("fused", top).cast("int") - 1).alias("language"))
    reason = F.when(~F.col("letters"), "empty").when(F.col("probability") < SURE, "unsure").when((F.col("strange") > STRANGE) & (F.col("n_grams") >= 30), "strange")
    return out.select("doc_id", "row_hash", F.when(F.col("letters"), F.col("language")).alias("language"), "probability", reason.isNull().alias("kept"), reason.alias("reason"), "declared", "suffix")


def accepted(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that ``identify`` keeps, with all columns; a row is told by its id and the hash of its text."""
    found = identify(docs, **how).where(~F.col("kept"))
    key, mark = free_name(docs, "gone_id"), free_name(docs, "gone_hash")
    gone = small(written(found.select(F.col("doc_id").alias(key), F.col("row_hash").alias(mark)).distinct(), "rejected"))
    return docs.join(gone, docs[how.get("doc_id", "doc_id")].eqNullSafe(gone[key]) & (F.xxhash64(docs[how.get("text", "text")]) == gone[mark]), "left_anti")
