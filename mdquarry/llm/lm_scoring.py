"""Pseudo-likelihood of documents by a bidirectional window network.

A network predicts a word from the two words on each side of it: the context
words' vectors (one table for each place) are added and squashed to a hidden
layer, which gives the probability of the word's class and of the word within
its class (classes are runs of about sqrt(V) words of similar frequency). The
pseudo-likelihood of a document is the sum over all of its words of the log
probability of the word given both sides.

Everything comes from the whole corpus:

* word counts of all documents (added up in the tasks, then by a shuffle) give
  the vocabulary, the frequency classes and the starting biases; other words
  share ``RARE`` hashed places, each word of a place equally likely;
* training is data-parallel and learns to predict every word of all documents
  once: a hash of the word's surroundings deals the words out to ``ROUNDS``
  rounds. In each round every task starts from the same weights and learns the
  round's words of its documents; the weights of the tasks are then averaged row
  by row, each by how often it was touched. What a task returns is bounded by the
  network, what all return grows with the corpus.

Edge cases: a null or empty text has no words, pll 0 and no mean; repeated rows
count as often as they occur; an empty table gives an empty result; texts of any
length are scored whole; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary, id_and_text, keep, read, unpack
from .ragged import KeyTable, mix, word_rows

VOCABULARY = 8192
RARE = 256
WIDTH = 16
SIDE = 2
ROUNDS = 2
BATCH = 8192
BLOCK = 512  # rows of a softmax at a time: what fits into a core's cache
RATE = 0.3
FLUSH = 1 << 20
PACK = 1 << 18  # words whose surroundings are held at a time
_PLACES = [o for o in range(-SIDE, SIDE + 1) if o]


def count_words(docs: DataFrame) -> DataFrame:
    """word (hash), n: how often every word occurs in all texts."""
    def run(batches):
        table, counts = KeyTable(16), np.zeros(1 << 16, np.int64)
        words = np.zeros(1 << 16, np.uint64)

        def out():
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[:table.n].view(np.int64)), pa.array(counts[:table.n])], ["word", "n"])

        for b in batches:
            for _, h, _, _, _ in word_rows(b.column(0).to_pylist()):
                if table.n > FLUSH:
                    yield from out()
                    table, counts = KeyTable(16), np.zeros(1 << 16, np.int64)
                    words = np.zeros(1 << 16, np.uint64)
                ids, new = table.number(h)
                while table.n > len(counts):
                    counts, words = (np.concatenate([x, np.zeros_like(x)]) for x in (counts, words))
                words[ids[new]] = h[new]
                got = np.bincount(ids)
                counts[:len(got)] += got
        if table.n:
            yield from out()

    each = id_and_text(docs).select("text").mapInArrow(run, "word long, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n"))


class Words:
    """Words by frequency: the vocabulary and the places of rare words, with class sizes."""

    def __init__(self, word: np.ndarray, n: np.ndarray, rare_n: np.ndarray, rare_types: np.ndarray):
        count = np.concatenate([n, rare_n]).astype(float)
        order = np.argsort(-count, kind="stable")
        self.id_of = np.empty(len(count), np.int64)
        self.id_of[order] = np.arange(len(count))
        self.word, self.n_words = word, len(word)
        self.count = count[order]
        self.spread = np.zeros(len(count))  # log of the number of words at a place
        self.spread[self.id_of[len(word):]] = np.log(np.maximum(rare_types, 1))
        self.size = max(1, int(np.ceil(np.sqrt(len(count)))))
        self.classes = -(-len(count) // self.size)

    def __len__(self) -> int:
        return len(self.count)

    def table(self) -> KeyTable:
        t = KeyTable()
        t.put(self.word.view(np.uint64), np.arange(self.n_words))
        return t

    def ids(self, table: KeyTable, h: np.ndarray) -> np.ndarray:
        at = table.find(h).astype(np.int64)
        return self.id_of[np.where(at < 0, self.n_words + (h % np.uint64(RARE)).astype(np.int64), at)]


def vocabulary(counts: DataFrame, size: int = VOCABULARY) -> Words:
    """The most frequent words, and what the places of the other ones hold: at most ``size + RARE`` rows here."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(size).collect()
    word = np.array([r["word"] for r in top], np.int64)
    n = np.array([r["n"] for r in top], np.int64)
    # % of the unsigned hash: RARE is a power of two
    place = F.col("word").bitwiseAND(F.lit(RARE - 1))
    rare_n, rare_types = np.zeros(RARE, np.int64), np.zeros(RARE, np.int64)
    for r in counts.groupBy(place.alias("place")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect():
        rare_n[r["place"]], rare_types[r["place"]] = r["n"], r["types"]
    np.subtract.at(rare_n, word & (RARE - 1), n)
    np.subtract.at(rare_types, word & (RARE - 1), 1)
    return Words(word, n, rare_n, rare_types)


class Network:
    """Rows of weights, each with a bias at its end: context tables, classes, words of classes."""

    def __init__(self, words: Words, seed: int = 11):
        rng = np.random.default_rng(seed)
        v, c, s = len(words), words.classes, words.size
        self.shape = (len(_PLACES) * (v + 1), c, c * s)
        rows = rng.normal(0, 0.1, (sum(self.shape), WIDTH + 1)).astype(np.float32)
        rows[:self.shape[0], WIDTH] = 0
        mass = np.full(c * s, 1e-3)
        mass[:v] = words.count + 0.5
        rows[self.shape[0]:self.shape[0] + c, WIDTH] = np.log(mass.reshape(c, s).sum(1) / mass.sum())
        rows[self.shape[0] + c:, WIDTH] = np.log(mass.reshape(c, s) / mass.reshape(c, s).sum(1, keepdims=True)).reshape(-1)
        self.rows = rows
        self._views(words)

    def _views(self, words: Words) -> None:
        self.words, (e, c, _) = words, self.shape
        self.context = self.rows[:e]
        self.class_rows = self.rows[e:e + c]
        self.word_rows = self.rows[e + c:].reshape(c, words.size, WIDTH + 1)

    def state(self) -> dict:
        """Plain arrays, as they are sent to the tasks."""
        return {"shape": self.shape, "rows": self.rows, "words": vars(self.words)}

    @classmethod
    def of_state(cls, state: dict) -> "Network":
        net, words = object.__new__(cls), object.__new__(Words)
        vars(words).update(state["words"])
        net.shape, net.rows = state["shape"], state["rows"]
        net._views(words)
        return net

    def with_rows(self, rows: np.ndarray) -> "Network":
        other = object.__new__(Network)
        other.shape, other.rows = self.shape, np.array(rows, np.float32)
        other._views(self.words)
        return other

    def hidden(self, around: np.ndarray) -> np.ndarray:
        """Hidden layer of places from the ids around them (one column for each place of the window), and a 1."""
        one = np.ones((len(around), WIDTH + 1), np.float32)
        h = np.zeros((len(around), WIDTH), np.float32)
        for k in range(len(_PLACES)):
            h += self.context.take(around[:, k] + k * (len(self.words) + 1), axis=0)[:, :WIDTH]
        np.tanh(h, out=one[:, :WIDTH])
        return one


def _order(ids: np.ndarray) -> np.ndarray:
    """Stable order of small numbers: those of 16 bits are sorted by their digits."""
    return np.argsort(ids.astype(np.uint16) if len(ids) and ids.max() < 1 << 16 else ids, kind="stable")


SAFE = 60.0  # scores of at most this size have exponentials, and sums of them, within the range of float32


def _bounded(net: Network) -> bool:
    """Whether no score can leave the safe range: the hidden layer lies between -1 and 1."""
    return float(np.abs(net.rows[net.shape[0]:]).sum(axis=1).max()) <= SAFE


def _scores(rows: np.ndarray, one: np.ndarray, bounded: bool) -> np.ndarray:
    """Scores of the rows, less the greatest where they might leave the range; ``one`` is the hidden layer and a 1."""
    z = one @ rows.T
    if not bounded:
        z -= z.max(axis=1, keepdims=True)
    return z


def _softmax(rows: np.ndarray, one: np.ndarray, bounded: bool) -> np.ndarray:
    out = np.empty((len(one), len(rows)), np.float32)
    ones = np.ones((len(rows), 1), np.float32)
    for at in range(0, len(one), BLOCK):
        p = _scores(rows, one[at:at + BLOCK], bounded)
        np.exp(p, out=p)
        np.divide(p, p @ ones, out=out[at:at + BLOCK])
    return out


def around(ids: np.ndarray, off: np.ndarray, outside: int) -> np.ndarray:
    """Ids at the places of the window around every word; ``outside`` beyond the ends of its document."""
    n = np.diff(off)
    slot = np.arange(len(ids)) + SIDE * np.repeat(np.arange(1, len(n) + 1), n)
    padded = np.full(len(ids) + SIDE * (len(n) + 1), outside, np.int64)
    padded[slot] = ids
    return np.stack([padded[slot + o] for o in _PLACES], axis=1)


def _log_of(rows: np.ndarray, one: np.ndarray, pick: np.ndarray, bounded: bool) -> np.ndarray:
    """Log of the softmax at one place of each row."""
    out, ones = np.empty(len(one), np.float32), np.ones(len(rows), np.float32)
    for at in range(0, len(one), BLOCK):
        z = _scores(rows, one[at:at + BLOCK], bounded)
        got = z[np.arange(len(z)), pick[at:at + BLOCK]]
        np.exp(z, out=z)
        out[at:at + BLOCK] = got - np.log(z @ ones)
    return out


def log_probabilities(net: Network, ids: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Log probability of every word given the words around it."""
    out = np.zeros(len(ids))
    size, bounded = net.words.size, _bounded(net)
    for at in range(0, len(ids), 4 * BATCH):
        target = ids[at:at + 4 * BATCH]
        one = net.hidden(context[at:at + 4 * BATCH])
        kind, place = target // size, target % size
        score = _log_of(net.class_rows, one, kind, bounded).astype(float)
        order = _order(kind)
        cuts = np.flatnonzero(np.diff(kind[order])) + 1
        for part in np.split(order, cuts):
            score[part] += _log_of(net.word_rows[kind[part[0]]], one.take(part, axis=0), place[part], bounded)
        out[at:at + 4 * BATCH] = score - net.words.spread[target]
    return out


def _learn(net: Network, squares: np.ndarray, touched: np.ndarray, target: np.ndarray, context: np.ndarray) -> None:
    """One step of AdaGrad on a batch of words."""
    size, e, c = net.words.size, net.shape[0], net.words.classes
    one, bounded = net.hidden(context), _bounded(net)
    h = one[:, :WIDTH]
    kind, place = target // size, target % size
    p = _softmax(net.class_rows, one, bounded)
    p[np.arange(len(target)), kind] -= 1
    back = p @ net.class_rows[:, :WIDTH]
    # every class and word of a class has its place here; no step where the gradient is 0
    grads = np.zeros((len(net.rows) - e, WIDTH + 1), np.float32)
    grads[:c] = p.T @ one
    touched[e:e + c] += len(target)
    order = _order(kind)
    for part in np.split(order, np.flatnonzero(np.diff(kind[order])) + 1):
        k = kind[part[0]]
        mine = one.take(part, axis=0)
        p = _softmax(net.word_rows[k], mine, bounded)
        p[np.arange(len(part)), place[part]] -= 1
        back[part] += p @ net.word_rows[k][:, :WIDTH]
        at = c + k * size
        grads[at:at + size] = p.T @ mine
        touched[e + at:e + at + size] += len(part)
    back *= 1 - h * h
    for j in range(len(_PLACES)):
        ids = context[:, j]
        order = _order(ids)
        ordered = ids[order]
        first = np.flatnonzero(np.append(True, np.diff(ordered) > 0))
        g = np.add.reduceat(back.take(order, axis=0), first, axis=0)
        mine = j * (len(net.words) + 1) + ordered[first]
        touched[mine] += np.diff(np.append(first, len(ids)))
        wide = np.zeros((len(first), WIDTH + 1), np.float32)
        wide[:, :WIDTH] = g
        seen = squares.take(mine, axis=0)
        seen += wide * wide
        squares[mine] = seen
        net.rows[mine] -= RATE * wide / np.sqrt(seen + 1e-6)
    squares[e:] += grads * grads
    net.rows[e:] -= RATE * grads / np.sqrt(squares[e:] + 1e-6)


def _of_round(ids: np.ndarray, context: np.ndarray, turn: int, rounds: int = ROUNDS) -> np.ndarray:
    """Places that a round learns: a hash of the words in the window, so the choice doesn't depend on the task."""
    h = ids.astype(np.uint64)
    for k in range(context.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + context[:, k].astype(np.uint64))
    return np.flatnonzero((h % np.uint64(rounds)).astype(np.int64) == turn)


def encode(docs: DataFrame, words: Words | None) -> DataFrame:
    """doc_id, ids: the ids of every text's words, written by the tasks once for all later passes."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(words) if words else None)

    def run(batches):
        known, table = None, None
        if sent.value:
            known = object.__new__(Words)
            vars(known).update(sent.value)
            table = known.table()
        kind = np.uint16 if known is None or len(known) <= 1 << 16 else np.uint32
        for b in batches:
            for first, h, _, _, off in word_rows(b.column(1).to_pylist()):
                ids = known.ids(table, h) if len(h) else h
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(off) - 1), binary(ids.astype(kind), off)], ["doc_id", "ids"])

    d = id_and_text(docs)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids binary")


def _packs(column: pa.Array, words: Words | None):
    """(first row, ids, offsets) of runs of rows with about ``PACK`` words, a longer row alone."""
    kind = np.dtype(np.uint16 if words is None or len(words) <= 1 << 16 else np.uint32)
    size = np.asarray(pa.compute.binary_length(column)).astype(np.int64) // kind.itemsize
    turn = (np.cumsum(size) - size) // PACK
    cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1), len(size)]
    for first, last in zip(cuts, cuts[1:]):
        if last > first:
            ids, off = unpack(column.slice(first, last - first), kind)
            yield first, ids.astype(np.int64), off


def _round(docs: DataFrame, net: Network, turn: int, rounds: int) -> Network:
    """One round of training over all encoded documents."""
    sent = docs.sparkSession.sparkContext.broadcast(net.state())
    names = [f"v{i}" for i in range(WIDTH + 1)]

    def run(batches):
        base = Network.of_state(sent.value)
        mine = base.with_rows(base.rows)
        squares, touched = np.full(base.rows.shape, 0.1, np.float32), np.zeros(len(base.rows), np.int64)
        wait: list[tuple[np.ndarray, np.ndarray]] = []

        def learn(least):
            n = sum(len(t) for t, _ in wait)
            if n < least or not n:
                return
            target, context = (np.concatenate(x) for x in zip(*wait))
            wait.clear()
            whole = n // BATCH * BATCH if least > 1 else n
            for at in range(0, whole, BATCH):
                _learn(mine, squares, touched, target[at:at + BATCH][:whole - at], context[at:at + BATCH][:whole - at])
            if whole < n:
                wait.append((target[whole:], context[whole:]))

        for b in batches:
            for _, ids, off in _packs(b.column(0), base.words):
                context = around(ids, off, len(base.words))
                at = _of_round(ids, context, turn, rounds)
                wait.append((ids[at], context[at]))
                learn(BATCH)
        learn(1)
        row = np.flatnonzero(touched)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row.astype(np.int32)), pa.array(touched[row]),
             *(pa.array(mine.rows[row, i]) for i in range(WIDTH + 1))], ["row", "n", *names])

    got = docs.select("ids").mapInArrow(
        run, "row int, n long, " + ", ".join(f"{c} float" for c in names))
    mean = got.groupBy("row").agg(*(
        (F.sum(F.col(c).cast("double") * F.col("n")) / F.sum("n")).cast("float").alias(c) for c in names))
    # one row for each row of the network
    table = mean.toArrow()
    rows = net.rows.copy()
    at = table.column("row").to_numpy()
    for i, c in enumerate(names):
        rows[at, i] = table.column(c).to_numpy()
    return net.with_rows(rows)


def _train(docs: DataFrame, words: Words, rounds: int) -> Network:
    """A network trained on encoded documents."""
    net = Network(words)
    for turn in range(rounds):
        net = _round(docs, net, turn, rounds)
    return net


def train(docs: DataFrame, size: int = VOCABULARY, rounds: int = ROUNDS) -> Network | None:
    """A network trained on all documents, or nothing if they hold no word."""
    words = vocabulary(keep(count_words(docs), "words"), size)
    return _train(keep(encode(docs, words), "ids"), words, rounds) if words.n_words else None


def _score(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, n_tokens, pll, mean_pll of every row of encoded documents."""
    sent = docs.sparkSession.sparkContext.broadcast(net.state() if net else None)

    def run(batches):
        model = Network.of_state(sent.value) if sent.value else None
        for b in batches:
            for first, ids, off in _packs(b.column(1), model.words if model else None):
                total = np.zeros(len(ids) + 1)
                if len(ids):
                    np.cumsum(log_probabilities(model, ids, around(ids, off, len(model.words))), out=total[1:])
                n = np.diff(off)
                pll = np.where(n > 0, total[off[1:]] - total[off[:-1]], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(n)), pa.array(n), pa.array(pll),
                     pa.array(pll / np.maximum(n, 1), mask=n == 0)], ["doc_id", "n_tokens", "pll", "mean_pll"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, pll double, "
                                "mean_pll double")


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, n_tokens, pll, mean_pll of every row."""
    return _score(encode(docs, net.words if net else None), net)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    words = vocabulary(keep(count_words(docs), "words"))
    # the texts are cut into words twice: to count them, and to write their ids for training and scores
    encoded = keep(encode(docs, words), "ids")
    return _score(encoded, _train(encoded, words, ROUNDS) if words.n_words else None)
