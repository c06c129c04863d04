"""The window network: exact scores, training that pays off on unseen texts, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mdquarry.llm import lm_scoring as lm
from mdquarry.llm.ragged import words

from .conftest import ODD_TEXTS

DATA = "/root/testdata/sf0.1"


def _words(seed=0, n=60):
    rng = np.random.default_rng(seed)
    h = rng.integers(1, 2**62, n).astype(np.int64)
    return lm.Words(h, np.sort(rng.integers(1, 1000, n))[::-1], rng.integers(0, 5, lm.RARE), rng.integers(0, 5, lm.RARE))


def test_probabilities_add_up_and_equal_a_plain_softmax():
    w = _words()
    net = lm.Network(w)
    rng = np.random.default_rng(1)
    context = rng.integers(0, len(w) + 1, (5, 4))
    total = np.zeros(5)
    for i in range(len(w)):
        total += np.exp(lm.log_probabilities(net, np.full(5, i), context) + w.spread[i])
    # the last class may have unused places, with next to no mass
    assert np.allclose(total, 1, atol=1e-2)
    ids = rng.integers(0, len(w), 5)
    for i, row, got in zip(ids, context, lm.log_probabilities(net, ids, context)):
        h = np.tanh(sum(net.context[k * (len(w) + 1) + c, :lm.WIDTH] for k, c in enumerate(row)))
        z = net.class_rows[:, :-1] @ h + net.class_rows[:, -1]
        y = net.word_rows[i // w.size][:, :-1] @ h + net.word_rows[i // w.size][:, -1]
        want = z[i // w.size] - np.log(np.exp(z).sum()) + y[i % w.size] - np.log(np.exp(y).sum()) - w.spread[i]
        assert abs(got - want) < 1e-4


def test_gradient_lowers_the_loss():
    w = _words(2)
    net = lm.Network(w)
    rng = np.random.default_rng(3)
    context = rng.integers(0, len(w), (400, 4))
    target = (context[:, 1] * 7 + 3) % len(w)
    squares, touched = np.full(net.rows.shape, 0.1, np.float32), np.zeros(len(net.rows), np.int64)
    before = lm.log_probabilities(net, target, context).mean()
    for _ in range(60):
        lm._learn(net, squares, touched, target, context)
    assert lm.log_probabilities(net, target, context).mean() > before + 1


def test_windows_stop_at_the_ends_of_a_document():
    ids, off = np.array([5, 6, 7, 8]), np.array([0, 1, 1, 4])
    assert lm.around(ids, off, 9).tolist() == [[9, 9, 9, 9], [9, 9, 7, 8], [9, 6, 8, 9], [6, 7, 9, 9]]


def test_counts_are_those_of_all_texts(spark, docs_of):
    texts = ["a b a", "b c", None, "", "a"]
    got = {r.word: r.n for r in lm.count_words(docs_of(list(enumerate(texts)))).collect()}
    h, *_ = words(["a b c"])
    assert got == dict(zip(h.view(np.int64).tolist(), [3, 2, 1]))


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(8, "doc_id")
    learn = docs.where("doc_id % 5 <> 0")
    vocabulary = lm.vocabulary(lm.count_words(learn))
    return docs.where("doc_id % 5 = 0"), lm.Network(vocabulary), lm.train(learn)


def test_training_helps_on_unseen_documents(trained):
    unseen, start, net = trained

    def mean(model, docs):
        r = lm.score(docs, model).agg(F.sum("pll") / F.sum("n_tokens")).first()
        return r[0]
    assert mean(net, unseen) > mean(start, unseen) + 0.15
    mixed = unseen.withColumn("text", F.array_join(F.shuffle(F.split("text", r"\s+"), 5), " "))
    assert mean(net, unseen) > mean(net, mixed)


def test_scores_do_not_depend_on_neighbours_in_a_batch(spark, trained, docs_of):
    _, _, net = trained
    rows = [*enumerate(ODD_TEXTS), (20, "the of and that"), (20, "the of and that"), (None, "the of and that")]
    together = lm.score(docs_of(rows), net).collect()
    assert len(together) == len(rows)
    alone = lm.score(docs_of([(1, "the of and that")]), net).first()
    for r in together:
        if r.doc_id in (20, None):
            assert abs(r.pll - alone.pll) < 1e-6 and r.n_tokens == 4
        if r.n_tokens == 0:
            assert r.pll == 0 and r.mean_pll is None


def test_tables_without_words(spark, docs_of, tmp_path):
    for i, rows in enumerate(([], [(1, None), (2, " ")])):
        docs_of(rows).write.parquet(f"{tmp_path}/{i}/documents.parquet")
        got = lm.op10_lm_scoring(spark, f"{tmp_path}/{i}").collect()
        assert [(r.n_tokens, r.pll) for r in got] == [(0, 0.0)] * len(rows)


def test_the_rounds_learn_every_word_once(docs_of, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 400))) for i in range(4)]
    seen = []
    round_ = lm._round

    def spied(docs, net, *turn):
        after = round_(docs, net, *turn)
        seen.append((np.abs(after.context - net.context) > 0).any(axis=1))
        return after

    monkeypatch.setattr(lm, "_round", spied)
    net = lm.train(docs_of(rows))
    h, _, _, off = words([t for _, t in rows])
    ids = net.words.ids(net.words.table(), h)
    around = lm.around(ids, off, len(net.words))
    moved = np.any(seen, axis=0)
    # the words that stand next to any place are learned from
    assert all(moved[k * (len(net.words) + 1) + around[:, k]].all() for k in range(around.shape[1]))
    places = np.concatenate([lm._of_round(ids, around, t) for t in range(lm.ROUNDS)])
    assert sorted(places.tolist()) == list(range(len(ids)))


@pytest.mark.parametrize("wide", [0.5, 50.0])
def test_probabilities_agree_with_a_plain_softmax_in_and_out_of_the_safe_range(wide):
    rng = np.random.default_rng(3)
    words = lm.Words(np.arange(1, 50, dtype=np.int64), np.arange(50, 1, -1), np.full(lm.RARE, 2), np.ones(lm.RARE, np.int64))
    net = lm.Network(words)
    net.rows[:] = rng.normal(0, wide, net.rows.shape)
    assert lm._bounded(net) == (wide < 1)
    ids = rng.integers(0, len(words), 1500)
    context = lm.around(ids, np.array([0, len(ids)]), len(words))
    h = net.hidden(context).astype(float)
    assert (h[:, -1] == 1).all()

    def log_softmax(rows):
        z = np.einsum("ij,...kj->i...k" if rows.ndim > 2 else "ij,kj->ik", h, rows.astype(float))
        z -= z.max(axis=-1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))

    kind, place, at = ids // words.size, ids % words.size, np.arange(len(ids))
    plain = log_softmax(net.class_rows)[at, kind] + log_softmax(net.word_rows)[at, kind, place] - words.spread[ids]
    assert np.allclose(lm.log_probabilities(net, ids, context), plain, rtol=1e-3, atol=1e-3)


def test_encoded_texts_are_read_back_in_packs_without_a_lost_word(docs_of, monkeypatch):
    monkeypatch.setattr(lm, "PACK", 3)
    texts = ["the of and that", "", "the", None, "and of the that the of unseen"]
    docs = docs_of([(i, t) for i, t in enumerate(texts)])
    w = lm.vocabulary(lm.count_words(docs))
    rows = lm.encode(docs, w).toArrow()
    table = w.table()
    got = {}
    for first, ids, off in lm._packs(rows.column("ids").combine_chunks(), w):
        for i in range(len(off) - 1):
            got[rows.column("doc_id")[first + i].as_py()] = ids[off[i]:off[i + 1]].tolist()
    for i, t in enumerate(texts):
        h = words([t or ""])[0]
        assert got[i] == (w.ids(table, h).tolist() if len(h) else [])
