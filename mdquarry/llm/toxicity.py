"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its terms: lower-cased runs of letters, and the first 4
and 5 letters of longer ones, each hashed to one of ``2**BITS`` places. The
machine adds a weight for every term and, for every pair of terms, the product
of their factors, so that two terms may mean more together than apart.

Training (numpy, one task's worth of work on the driver) takes a bounded sample
of the labelled rows: about ``MAX_POSITIVE`` toxic and ``MAX_NEGATIVE`` other
documents, chosen by a hash of the id, with their whole texts. The weights are
learned by FTRL with an L1 penalty, and a term gets factors only when its
weight has left zero, so rare terms of long texts add no noise. Scoring covers
every row: a scan with the model (at most a few MB, bounded by ``2**BITS``)
sent to the tasks.

Edge cases: null and empty texts have no terms and score the bias alone; an id
with labels 0 and 1 counts as toxic, null labels are ignored; without any usable
label of both kinds every score is 0; equal texts score alike; columns other
than id and text never reach the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary, id_and_text, read
from .ragged import LETTER, Prefix, char_classes, flat, packs

BITS = 22
STEMS = (4, 5)
MAX_POSITIVE = 2000
MAX_NEGATIVE = 6000
FACTORS = 4
VISITS = 64000  # rows seen in training, the sample as often as that takes
THRESHOLD = 0.7


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the terms of every text, distinct within a text, in order of row and place."""
    cp, bounds = flat([t.lower() for t in texts])
    if not len(cp):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = char_classes()[cp] == LETTER
    edge = np.zeros(len(cp) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(letter & (edge[:-1] | ~np.append(False, letter[:-1])))
    end = np.flatnonzero(letter & (edge[1:] | ~np.append(letter[1:], False))) + 1
    row = np.searchsorted(bounds, start, side="right") - 1
    prefix = Prefix(cp)
    rows, places = [row], [prefix.slices(start, end)]
    for n in STEMS:
        long = end - start > n
        # a stem is another term than the same letters as a whole word
        rows.append(row[long])
        places.append(prefix.slices(start[long], start[long] + n) * np.uint64(0x9E3779B97F4A7C15))
    place = (np.concatenate(places) >> np.uint64(64 - BITS)).astype(np.int64)
    both = np.unique(np.concatenate(rows) << BITS | place)
    return both >> BITS, both & ((1 << BITS) - 1)


class Machine:
    """Bias, weights and factors of the places whose weight is not zero."""

    def __init__(self, bias: float, place: np.ndarray, weight: np.ndarray, factor: np.ndarray):
        self.bias, self.place, self.weight, self.factor = bias, place, weight, factor

    def index(self) -> np.ndarray:
        at = np.full(1 << BITS, -1, np.int32)
        at[self.place] = np.arange(len(self.place))
        return at

    def scores(self, n: int, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probabilities of ``n`` texts from their (row, number of the term in the model)."""
        z = self.bias + np.bincount(row, self.weight[at], n)
        for f in range(self.factor.shape[1]):
            v = self.factor[at, f]
            z += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(places: list[np.ndarray], labels: np.ndarray, factors: int = FACTORS, visits: int = VISITS,
        alpha: float = 5.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.01, seed: int = 7) -> Machine:
    """Learns from texts given as arrays of distinct places."""
    none = np.zeros(0, np.int64)
    if not len(labels) or labels.min() == labels.max():
        return Machine(-35.0, none, none.astype(float), np.zeros((0, factors)))
    rng = np.random.default_rng(seed)
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    slot = np.full(1 << BITS, -1, np.int32)  # where a place's factors are, once its weight has left zero
    v, vn, born = np.zeros((1024, factors)), np.full((1024, factors), 1e-2), 0
    bias, bias_n = 0.0, 1.0

    def weights(f):
        zf = z[f]
        return np.where(np.abs(zf) <= l1, 0.0, -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2))

    for _ in range(max(1, round(visits / len(places)))):
        for i in rng.permutation(len(places)):
            f = places[i]
            w = weights(f)
            on = f[w != 0]
            fresh = on[slot[on] < 0]
            if len(fresh):
                while born + len(fresh) > len(v):
                    v, vn = np.concatenate([v, np.zeros_like(v)]), np.concatenate([vn, np.full_like(vn, 1e-2)])
                slot[fresh] = np.arange(born, born + len(fresh))
                v[born:born + len(fresh)] = rng.normal(0, 0.1, (len(fresh), factors))
                born += len(fresh)
            at = slot[on]
            vf = v[at]
            total = vf.sum(0)
            score = bias + w.sum() + 0.5 * float((total * total - (vf * vf).sum(0)).sum())
            g = 1 / (1 + np.exp(-np.clip(score, -35, 35))) - labels[i]
            bias_n += g * g
            bias -= alpha * g / np.sqrt(bias_n)
            more = np.sqrt(n[f] + g * g)
            z[f] += g - (more - np.sqrt(n[f])) / alpha * w
            n[f] += g * g
            if len(on):
                gv = g * (total - vf) + 1e-4 * vf
                vn[at] += gv * gv
                v[at] -= 0.1 * gv / np.sqrt(vn[at])
    live = np.flatnonzero(slot >= 0)
    w = weights(live)
    live, w = live[w != 0], w[w != 0]
    return Machine(bias, live, w, v[slot[live]])


def sample(docs: DataFrame, labels: DataFrame, allowed=None) -> DataFrame:
    """doc_id, toxic, text of about ``MAX_POSITIVE`` and ``MAX_NEGATIVE`` labelled documents."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    if allowed is not None:
        known = known.where(allowed)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, MAX_POSITIVE / max(1, n.get(1, 0)))).otherwise(
        min(1.0, MAX_NEGATIVE / max(1, n.get(0, 0))))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    # about MAX_POSITIVE + MAX_NEGATIVE rows of two numbers: small enough to broadcast
    drawn_ids = F.broadcast(known.where(drawn < share))
    return id_and_text(docs).join(drawn_ids, "doc_id").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"), F.min("text").alias("text"))


def learn(docs: DataFrame, labels: DataFrame, allowed=None) -> Machine:
    """Trains on the labelled sample; ``allowed`` is a condition on doc_id for rows that may be learned from."""
    def run(batches):
        for b in batches:
            toxic = b.column(1)
            for first, texts in packs(b.column(2).to_pylist()):
                row, place = terms(texts)
                off = np.searchsorted(row, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), toxic.slice(first, len(texts)),
                     binary(place.astype("<i4"), off)], ["doc_id", "toxic", "terms"])

    s = sample(docs, labels, allowed)
    t = s.schema["doc_id"].dataType.simpleString()
    rows = s.mapInArrow(run, f"doc_id {t}, toxic int, terms binary").collect()
    rows.sort(key=lambda r: (str(r["doc_id"]), bytes(r["terms"])))
    return fit([np.frombuffer(r["terms"], "<i4") for r in rows],
               np.array([r["toxic"] for r in rows], float))


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id, score of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.place, model.weight, model.factor))

    def run(batches):
        m = Machine(*sent.value)
        index = m.index()
        for b in batches:
            texts = b.column(1).to_pylist()
            out = np.zeros(len(texts))
            for first, some in packs(texts):
                row, place = terms(some)
                at = index[place]
                on = at >= 0
                out[first:first + len(some)] = m.scores(len(some), row[on], at[on])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["doc_id", "score"])

    d = id_and_text(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def held_out() -> F.Column:
    """Rows that labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn(docs, read(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_harmless(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns.

    ``learn_from`` holds the labelled texts (``docs`` itself by default). The
    score is computed beside the row, so repeated ids and null ids keep their
    own verdict.
    """
    model = learn(docs if learn_from is None else learn_from, labels, ~held_out())
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.place, model.weight, model.factor))
    at_text = docs.columns.index("text")

    def run(batches):
        m = Machine(*sent.value)
        index = m.index()
        for b in batches:
            for first, some in packs(b.column(at_text).to_pylist()):
                row, place = terms(some)
                at = index[place]
                on = at >= 0
                fine = m.scores(len(some), row[on], at[on]) < threshold
                yield b.slice(first, len(some)).filter(pa.array(fine))

    return docs.mapInArrow(run, docs.schema)
