"""Quality of documents by hierarchical empirical Bayes.

A classifier, fitted on a bounded sample of labelled rows, gives every document a log likelihood ratio from features of its
whole text. Sites (``host``) and their sections (``path``) add what their other documents show: grouped sums of the
document posteriors give beta posteriors of the share of good documents, where a section is shrunk towards its site and a
site towards the whole corpus. The strengths of both priors are estimated from the spread between sites and between
sections (method of moments), so sparse sites lean on the global prior. A document's own share is taken out of its
site's and section's sums before they judge it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm import words
from celltrace.llm.scratch import Scratch, numbered

#: Labelled rows that the classifier is fitted on, chosen by the hash of their id.
SAMPLE_ROWS = 20_000
_LIMIT = 30.0  # of log odds

_KINDS = np.full(256, 7, np.uint8)  # bytes of multi-byte characters and controls
_KINDS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 0
_KINDS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
_KINDS[[ord(c) for c in "0123456789"]] = 2
_KINDS[[ord(c) for c in "#$%&*@^~<>{}[]\\=+_`/"]] = 3
_KINDS[[ord(c) for c in "!?"]] = 4
_KINDS[ord("|")] = 5
_KINDS[[ord(c) for c in ".,;:'\"()-"]] = 6
_KINDS[[9, 10, 11, 12, 13, 32]] = 8
FEATURES = 15


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers per text: shares of byte kinds, word lengths, repeats of words and word triples."""
    out = np.zeros((len(column), FEATURES))
    for at in range(0, len(column), 512):
        raw, offsets = words.text_buffers(column.slice(at, 512))
        hashes, firsts = words.word_hashes(raw, offsets)
        for i in range(len(offsets) - 1):
            w = hashes[firsts[i] : firsts[i + 1]]
            if not len(w):
                continue
            kinds = np.bincount(_KINDS[raw[offsets[i] : offsets[i + 1]]], minlength=9)
            size = max(1, kinds[:8].sum())
            triples = words.shingles(w, 3)
            out[at + i, :8] = kinds[:8] / size
            out[at + i, 8:] = (
                np.log1p(len(w)), np.log(size / len(w)), len(np.unique(w)) / len(w), len(np.unique(triples)) / len(triples),
                (w[1:] == w[:-1]).sum() / len(w), (w[2:] == w[:-2]).sum() / len(w), kinds[8] / len(w),
            )
    return out


@dataclass
class Model:
    """Logistic model on standardised features; ``base`` is the log odds of good labels in its sample."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    base: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log likelihood ratio of good against bad; a text without words is bad."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        odds = z @ self.weights[1:] + self.weights[0] - self.base
        return np.where(x[:, 8] > 0, np.clip(odds, -_LIMIT, _LIMIT), -_LIMIT)


def fit_model(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 100) -> Model | None:
    """Newton steps on the penalised logistic likelihood, until they stop moving."""
    if len(y) == 0 or y.min() == y.max():
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.hstack([np.ones((len(x), 1)), np.clip((x - mean) / scale, -8, 8)])
    w, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], penalty)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -_LIMIT, _LIMIT)))
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (y - p) - ridge * w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    rate = y.mean()
    return Model(mean, scale, w, float(np.log(rate / (1 - rate))))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on at most ``sample_rows`` labelled ids, chosen by hash, with one row each; without labels of both kinds there is no model.

    Ids that are labelled both ways do not count. Of rows that share an id the one with the smallest hash of its text is taken,
    whatever their number, so that a run repeats.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_id"))
    known = known.agg(F.min(label).cast("double").alias("_y"), F.max(label).cast("double").alias("_z")).filter("_y = _z").drop("_z")
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    plain = docs.select(F.col(id_column).alias("_own"), F.col(text).cast("string").alias("_text"))
    rows = plain.join(F.broadcast(known), F.col("_own") == F.col("_id")).select("_id", "_y", F.xxhash64("_text").alias("_hash"), "_text")  # sample_rows ids at most
    schema = T.StructType([rows.schema["_id"], *T._parse_datatype_string("y double, hash long, x array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.small(batches):
            x = features(batch.column(3))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["_id", "y", "hash", "x"])

    one = rows.mapInArrow(run, schema).groupBy("_id").agg(F.min(F.struct("hash", "x")).alias("row"), F.first("y").alias("y"))
    found = one.orderBy("_id").select("y", "row.x").toPandas()
    return fit_model(np.array(found["x"].tolist()).reshape(-1, FEATURES), found["y"].to_numpy(float)) if len(found) else None


def with_evidence(docs: DataFrame, model: Model, text: str = "text", name: str = "evidence") -> DataFrame:
    """``docs`` with the log likelihood ratio of every whole text."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.small(batches):
            column = batch.column(place)
            column = column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.evidence(features(column)))], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def _share(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def _strength(sums: DataFrame, mean: Column, n: str, s: str) -> Column:
    """Strength of a beta prior from the spread of ``s / n`` around ``mean`` beyond binomial noise."""
    noise = F.sum(mean * (1 - mean))
    spread = F.sum(F.col(n) * (F.col(s) / F.col(n) - mean) * (F.col(s) / F.col(n) - mean))
    size = F.sum(n) - F.sum(F.col(n) * F.col(n)) / F.sum(n)
    between = F.when(size > 0, (spread - noise) / size).otherwise(0.0)
    inside = noise / F.count(F.lit(1))
    return F.least(F.lit(1e6), F.greatest(F.lit(1.0), F.coalesce(F.when(between > 0, inside / between - 1), F.lit(1e6))))


def with_posterior(scored: DataFrame, model: Model, host: str, path: str, evidence: str = "evidence") -> DataFrame:
    """``scored`` with ``host_share``, ``path_share`` and ``posterior``, the chance that the document is good.

    Null hosts and paths are sites and sections of their own.
    """
    own = _share(F.col(evidence) + F.lit(model.base))
    paths = scored.groupBy(F.col(host).alias("_h"), F.col(path).alias("_p")).agg(F.count(F.lit(1)).cast("double").alias("_pn"), F.sum(own).alias("_ps"))
    hosts = paths.groupBy(F.col("_h").alias("_hh")).agg(F.sum("_pn").alias("_hn"), F.sum("_ps").alias("_hs"))
    # one row: mean over all documents, then the strength of the prior over hosts
    world = hosts.agg(F.sum("_hn").alias("_n"), F.sum("_hs").alias("_s")).select((F.col("_s") / F.col("_n")).alias("_mean"))
    hosts = hosts.withColumn("_mean", world.scalar())
    hosts = hosts.withColumn("_k", hosts.agg(_strength(hosts, F.col("_mean"), "_hn", "_hs")).scalar())
    hosts = hosts.withColumn("_host", (F.col("_hs") + F.col("_k") * F.col("_mean")) / (F.col("_hn") + F.col("_k")))
    paths = paths.join(hosts, F.col("_h").eqNullSafe(F.col("_hh"))).drop("_hh")
    paths = paths.withColumn("_kp", paths.agg(_strength(paths, F.col("_host"), "_pn", "_ps")).scalar())
    # one row per section, written, so that the join knows its size: documents move only if that is too much to send
    paths = Scratch(scored.sparkSession).cut(paths, "sections")
    out = scored.join(paths, F.col(host).eqNullSafe(F.col("_h")) & F.col(path).eqNullSafe(F.col("_p")))
    without = (F.col("_hs") - own + F.col("_k") * F.col("_mean")) / (F.col("_hn") - 1 + F.col("_k"))
    out = out.withColumn("host_share", without)
    out = out.withColumn("path_share", (F.col("_ps") - own + F.col("_kp") * F.col("host_share")) / (F.col("_pn") - 1 + F.col("_kp")))
    prior = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.col("path_share")))
    out = out.withColumn("posterior", _share(F.col(evidence) + F.log(prior / (1 - prior))))
    return out.drop("_h", "_p", "_pn", "_ps", "_hn", "_hs", "_mean", "_k", "_host", "_kp")


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", threshold: float = 0.5, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a posterior of at least ``threshold``, with all their columns.

    Texts are read twice, for the sums and for the decision, so that no text is shuffled while the table of sections
    is small. Null texts and texts without words go. Without a model (no labels of both kinds) all rows stay.
    """
    model = train(docs, labels, id_column=id_column, text=text)
    if model is None:
        return docs
    plain, name = numbered(docs)
    scored = with_evidence(plain, model, name[text])
    judged = with_posterior(scored, model, name[host], name[path])
    return judged.filter(F.col("posterior") >= threshold).select(*plain.columns).toDF(*docs.columns)
