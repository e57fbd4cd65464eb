"""Toxicity by maximum-scoring segments of token log-odds with Dirichlet priors, calibrated by extreme-value statistics."""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpack.llm.common import LETTERS, run_hashes, runs, stage, text_chunks

#: Model parameters: doubt in standard deviations, documents of the prior.
DOUBT, PRIOR = 1.0, 4.0
#: Labelled rows the model is fitted on at most, about; with more, a seeded sample of them. This bounds the model.
LABELLED = 500_000
#: A token's score in a segment is at most this; all other tokens together draw a segment down at this rate.
MOST, OTHER = 6.0, -0.05


@dataclass
class Model:
    """Scores of tokens (by hash, sorted), extreme-value parameters of clean documents, and the logistic of the evidence."""
    hashes: np.ndarray
    scores: np.ndarray
    lam: float = 1.0
    k: float = 1.0
    weight: float = 1.0
    bias: float = 0.0
    other: float = OTHER


def _token_counts():
    schema = pa.schema([("toxic", pa.int32()), ("token", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in text_chunks(batch.column(1), 8 << 20):
                starts, ends, doc = runs(data, offsets, LETTERS)
                h = run_hashes(data, starts, ends)
                bounds = np.searchsorted(doc, np.arange(hi - lo + 1)).tolist()
                # a document counts once for each of its tokens
                own = [np.unique(h[a:b]) for a, b in zip(bounds, bounds[1:])]
                for value in (0, 1):
                    mine = [t for t, k in zip(own, toxic[lo:hi]) if k == value]
                    tokens, n = np.unique(np.concatenate(mine) if mine else h[:0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tokens), value, np.int32)), pa.array(tokens.view(np.int64)), pa.array(n)], schema=schema)
    return run


def learn_tokens(labelled: DataFrame, toxic: str = "toxic", text: str = "text") -> Model:
    """Log-odds that a document with a token is toxic, with a Dirichlet prior from the documents of both kinds.

    Tokens are runs of letters, A-Z lower-cased; documents with a token are counted over all labelled rows and summed before
    the shuffle. The prior adds PRIOR documents to each token, toxic in the share of all labelled ones; the score is
    the log-odds of the two counts less DOUBT standard deviations, so a token seen seldom, or in both kinds, has none.
    All tokens with a score above 0 are the model. They stand in several toxic documents each, so they are fewer than the words
    of the labelled toxic texts, which LABELLED bounds.
    """
    rows = labelled.select(F.col(toxic).cast("int").alias("toxic"), F.col(text).alias("text"))
    kinds = {r["toxic"]: float(r["n"]) for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = kinds.get(1, 0.0), kinds.get(0, 0.0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    counted = rows.mapInArrow(_token_counts(), "toxic int, token long, n long")
    one = counted.groupBy("token").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"),
                                       F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0"))
    toxic_docs, other_docs = F.col("y1") + PRIOR * n1 / (n1 + n0), F.col("y0") + PRIOR * n0 / (n1 + n0)
    score = F.log(toxic_docs / other_docs) - DOUBT * F.sqrt(1 / toxic_docs + 1 / other_docs)
    best = one.filter("y1 > 0").select("token", score.alias("score")).filter("score > 0").toArrow()
    hashes = best.column("token").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Model(hashes[order], np.minimum(best.column("score").to_numpy()[order], MOST))


def segments(scores: np.ndarray, places: np.ndarray, other: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first token, past), in one scan.

    scores, places: the tokens with a score of their own; every token between them scores `other` (< 0). Candidates are kept
    with the running sums before and after them; a new one joins back to the last candidate that began lower, if
    it ends higher.
    """
    left, right, first, past = [], [], [], []
    total, before = 0.0, -1
    for s, p in zip(scores.tolist(), places.tolist()):
        total += other * (p - before - 1)
        before = p
        if s > 0:
            lo, hi, start = total, total + s, p
            while True:
                j = len(left) - 1
                while j >= 0 and left[j] >= lo:
                    j -= 1
                if j < 0 or right[j] >= hi:
                    break
                lo, start = left[j], first[j]
                del left[j:], right[j:], first[j:], past[j:]
            left.append(lo)
            right.append(hi)
            first.append(start)
            past.append(p + 1)
        total += s
    return [(r - lo, f, e) for lo, r, f, e in zip(left, right, first, past)]


def _best(model: Model, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[float, int, int]], list[tuple[int, int]]]]:
    """Per document: tokens, segments, and each segment's byte span."""
    starts, ends, doc = runs(data, offsets, LETTERS)
    h = run_hashes(data, starts, ends)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    at = np.minimum(np.searchsorted(model.hashes, h), max(0, len(model.hashes) - 1))
    known = np.flatnonzero(model.hashes[at] == h) if len(model.hashes) else np.zeros(0, np.int64)
    cut = np.searchsorted(known, bounds)
    for d in range(len(offsets) - 1):
        mine = known[cut[d]: cut[d + 1]]
        found = segments(model.scores[at[mine]], mine - bounds[d], model.other)
        spans = [(int(starts[bounds[d] + f] - offsets[d]), int(ends[bounds[d] + e - 1] - offsets[d])) for _, f, e in found]
        yield int(bounds[d + 1] - bounds[d]), found, spans


def _maxima(model: Model):
    schema = pa.schema([("toxic", pa.int32()), ("tokens", pa.int64()), ("most", pa.float64())])

    def run(batches):
        for batch in batches:
            n, most = [], []
            for _, _, data, offsets in text_chunks(batch.column(1)):
                for tokens, found, _ in _best(model, data, offsets):
                    n.append(tokens)
                    most.append(max((s for s, _, _ in found), default=0.0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(most, pa.float64())], schema=schema)
    return run


def evidence(model: Model, tokens, most):
    """-log of the number of segments this good that a clean document of this length has by chance (extreme-value law).

    Without a segment there is no evidence however short the document: 0 at most.
    """
    x = model.lam * most - np.log(model.k * np.maximum(tokens, 1))
    return np.where(np.asarray(most) > 0, x, np.minimum(x, 0.0))


def calibrate(model: Model, labelled: DataFrame, toxic: str = "toxic", text: str = "text") -> Model:
    """Fit the extreme-value law to the best segments of clean rows, then a logistic of the evidence to the labels.

    Clean rows: E(segments above s) = K * tokens * exp(-lambda * s); lambda from the mean excess of the best scores over
    0, K from the share of rows that have one. Both fits use sums over all labelled rows: bins of evidence by label.
    """
    rows = labelled.select(F.col(toxic).cast("int").alias("toxic"), F.col(text).alias("text"))
    best = stage(rows.mapInArrow(_maxima(model), "toxic int, tokens long, most double"))
    clean = best.filter("toxic = 0").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.sum("most").alias("s"),
                                         F.count_if(F.col("most") > 0).alias("hit")).first()
    hit, tokens = float(clean["hit"] or 0) + 1.0, float(clean["t"] or 0) + 1.0
    model.lam = hit / (float(clean["s"] or 0) + MOST / 2)
    model.k = hit / tokens
    x = F.lit(model.lam) * F.col("most") - F.log(F.lit(model.k) * F.greatest("tokens", F.lit(1)))
    x = F.when(F.col("most") > 0, x).otherwise(F.least(x, F.lit(0.0)))
    binned = best.select("toxic", F.greatest(F.lit(-16.0), F.least(F.lit(48.0), F.round(x * 2) / 2)).alias("x"))
    table = [(r["x"], r["toxic"], r["n"]) for r in binned.groupBy("x", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()]
    xs, ys, ns = (np.array([t[i] for t in table], float) for i in range(3))
    w = np.zeros(2)
    for _ in range(50):
        # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(w[0] * xs + w[1], -30, 30)))
        g = np.array([(ns * (p - ys) * xs).sum(), (ns * (p - ys)).sum()]) + 1e-3 * w
        v = ns * p * (1 - p)
        hess = np.array([[(v * xs * xs).sum(), (v * xs).sum()], [(v * xs).sum(), v.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, g)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    model.weight, model.bias = max(0.0, float(w[0])), float(w[1])
    return model


def fit(labelled: DataFrame, toxic: str = "toxic", text: str = "text") -> Model:
    """Tokens from two thirds of the rows (by a hash of the text), calibration on the rest, whose tokens the model has not seen.

    Of more than LABELLED labelled rows a sample of about that many is taken, by a hash of text and place in the stored table.
    """
    n = labelled.count()
    if n > LABELLED:
        place = F.pmod(F.xxhash64(F.col(text), F.monotonically_increasing_id()), F.lit(1 << 30))
        labelled = stage(labelled.withColumn("_place", place).filter(F.col("_place") < int(LABELLED / n * (1 << 30))).drop("_place"))
    part = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(3))
    return calibrate(learn_tokens(labelled.filter(part < 2), toxic, text), labelled.filter(part == 2), toxic, text)


def _scored(model: Model, least: float):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()),
                        ("passages", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])

    def run(batches):
        for batch in batches:
            scores, passages = [], []
            for _, _, data, offsets in text_chunks(batch.column(2)):
                for tokens, found, spans in _best(model, data, offsets):
                    most = max((s for s, _, _ in found), default=0.0)
                    x = float(np.clip(model.weight * np.clip(evidence(model, tokens, most), -16, 48) + model.bias, -30, 30))
                    scores.append(1 / (1 + math.exp(-x)))
                    passages.append([{"start": a, "end": b, "score": s} for (s, _, _), (a, b) in zip(found, spans)
                                     if evidence(model, tokens, s) > 0])
            predicted = [int(s >= least) for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()),
                                              pa.array(passages, schema.field(4).type)], schema=schema)
    return run


def score_toxicity(docs: DataFrame, model: Model, held_out: Column, key: str = "doc_id", text: str = "text", least: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from `least` on), passages (UTF-8 byte spans less likely than chance in a clean text).

    One linear scan per whole text finds all maximal segments; the best one's evidence gives the score. Null and empty texts
    have no tokens and get the score of no evidence. Repeated rows are scored each; other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(_scored(model, least), "doc_id long, held_out boolean, score double, predicted int, "
                                                  "passages array<struct<start:long,end:long,score:double>>")
