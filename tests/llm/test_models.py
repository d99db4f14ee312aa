"""Trained operators: gradients, held-out accuracy, odd rows."""

from __future__ import annotations

import numpy as np

from tripleframe.llm import langid, pages, toxicity
from tripleframe.llm.common import remainder, table

from .helpers import SMALL


def test_recurrent_gradients_match_differences():
    rng = np.random.default_rng(0)
    n = 3
    layer = langid.Layer(rng.normal(0, 0.5, (3 * n, 257)).astype(np.float32), rng.normal(0, 0.5, (3 * n, n)).astype(np.float32))
    x = rng.integers(0, 5, (6, 4)).astype(np.int16)
    weight = rng.normal(size=(6, n, 4)).astype(np.float32)

    def loss():
        return float((np.stack(list(layer.states(x))).astype(float) * weight).sum())

    kept: list = []
    list(layer.states(x, kept))
    grads = layer.gradients(x, kept, list(weight))
    for values, grad in zip((layer.table, layer.recurrent), grads, strict=True):
        for at in [(0, 1), (4, 2), (8, 0)]:
            old = values[at]
            step = np.float32(1e-2)
            values[at] = old + step
            up = loss()
            values[at] = old - step
            down = loss()
            values[at] = old
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-2 * max(1, abs(grad[at]))


def test_language_of_held_out_documents(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    held = remainder(docs.doc_id, 4) == 2
    net = langid.fit(docs.where(~held))
    found = langid.predict(docs.where(held), net).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 - !"), (4, "the and of " * 4000)], "doc_id int, text string").selectExpr("*", "'x' AS score")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd, net).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == "en" and 0 < got[4][1] <= 1
    assert langid.predict(odd.where("1 = 0"), net).collect() == []
    assert langid.fit(docs.where("1 = 0")) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_windows_cover_every_byte():
    rng = np.random.default_rng(1)
    net = langid.train([b"aaaa", b"bbbb"], ["x", "y"], steps=30)
    texts = [b"", b"a" * 5, b"b" * 300, bytes(rng.integers(97, 99, 1000).astype(np.uint8))]
    p = net.documents(texts)
    assert np.allclose(p.sum(1), [0, 1, 1, 1], atol=1e-4)
    assert p[1].argmax() == 0 and p[2].argmax() == 1


def test_toxicity_of_held_out_documents(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    held = remainder(labels.doc_id, 3) == 1
    machine = toxicity.fit(docs, labels.where(~held))
    scored = toxicity.score(docs.select("doc_id", "text"), machine).join(labels, "doc_id").select("doc_id", "toxic", "score").collect()
    toxic = [r["score"] for r in scored if r["toxic"] == 1]
    clean = [r["score"] for r in scored if r["toxic"] == 0]
    # Area under the curve, and few clean documents above the cut; 33 toxic rows are learned from.
    assert np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean]) >= 0.88
    assert np.mean([s >= toxicity.CUT for s in clean]) <= 0.05
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string").selectExpr("*", "'x' AS score")
    assert len({r["score"] for r in toxicity.score(odd, machine).collect()}) == 1
    assert {r["score"] for r in toxicity.score(odd, toxicity.fit(docs, labels.where("1 = 0"))).collect()} == {0.5}


def test_terms_of_a_text():
    terms = toxicity.Terms()
    plain, dense = set(terms("Abcdef other words of a text").tolist()), set(terms("abcdexx abcdeyy of").tolist())
    assert len(plain) == len({"abcdef", "other", "words", "of", "a", "text"}) + 3 + 2 + 2 + 1
    shared = next(iter(terms._of("abcdexx")[1]))
    assert toxicity._dense(shared, 1) in dense and toxicity._dense(shared, 1) not in plain
    assert set(toxicity.Terms(np.array([toxicity._dense(shared, 2)]))("abcdexx abcdeyy of").tolist()) >= {toxicity._dense(shared, 2)}
    assert len(terms("")) == 0


def test_pairs_of_terms_are_learned():
    rng = np.random.default_rng(2)
    docs, toxic = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        docs.append(np.array(sorted({10 * a, 20 * b, 30 + int(rng.integers(5))} - {0})))
        toxic.append(int(a and b))
    machine = toxicity.train(docs, np.array(toxic), epochs=60)
    linear = toxicity.Machine(machine.bias, machine.terms, machine.weights, np.zeros_like(machine.latent))
    both, one, other = ([np.array(d)] for d in ([10, 20], [10], [20]))
    gain = machine.logits(both) - linear.logits(both)
    assert gain > 0 and machine.logits(both) > 0 > max(machine.logits(one), machine.logits(other))


def test_logits_are_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = toxicity.Machine(0.3, np.arange(6, dtype=np.int32), rng.normal(size=6), rng.normal(size=(6, 4)))
    d = np.array([0, 2, 3, 5, 9], dtype=np.int32)
    known = [t for t in d if t < 6]
    want = 0.3 + sum(m.weights[t] for t in known) + sum(m.latent[a] @ m.latent[b] for i, a in enumerate(known) for b in known[:i])
    assert np.isclose(m.logits([d])[0], want)


def test_marginals_against_enumeration():
    import itertools

    rng = np.random.default_rng(4)
    tree = pages.parse("<div><p>a b c</p><ul><li>one<li>two</ul></div><footer>z</footer>")
    batch = pages.Batch([tree], {})
    model = pages.TreeModel(rng.normal(size=len(pages.NUMERIC) + pages.HASHED), rng.normal(size=(2, 2, 2)))
    unary = np.bincount(batch.node, model.weights[batch.feature] * batch.value, batch.size)
    total, on = 0.0, np.zeros(batch.size)
    for y in itertools.product((0, 1), repeat=batch.size):
        score = sum(u for u, v in zip(unary, y, strict=True) if v) + sum(model.joint[batch.kind[i], y[p], y[i]] for i, p in enumerate(batch.parent) if p >= 0)
        total += np.exp(score)
        on += np.exp(score) * np.array(y)
    assert np.allclose(model.marginals(batch)[0], on / total)


def test_main_text(spark):
    crawl = table(spark, SMALL, "pages")
    model = pages.fit(crawl)
    rng = np.random.default_rng(9)
    wrong = blocks = 0
    for r in crawl.orderBy("page_id").limit(60).collect():
        inside, others = pages._article(pages.parse(r["html"]))
        tree, y = pages.labelled(pages.variant(inside, others, rng))
        guess = model.marginals(pages.Batch([tree], {}))[0] >= 0.5
        is_text = np.array([t is not None for t in tree.text])
        wrong += ((guess != y) & is_text).sum()
        blocks += is_text.sum()
    assert wrong <= 0.03 * blocks
    page = (
        "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><article><h1>A &amp; B</h1><p>One  two,\nthree<br>four. It goes on, and on."
        "<p>Five <b>six</b>, seven. It ends here.<script>x()</script></article><div class='comments'><p>Nice read!</p></div><footer>&copy; x</footer>"
    )
    df = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, page), (5, "<div>" * 3000), (6, "<a <b <!-- x")], "page_id int, html string").selectExpr("*", "'x' AS text")
    got = {r["page_id"]: r["text"] for r in pages.extract(df, model).collect()}
    assert got[1] == got[4] == "A & B\n\nOne two, three four. It goes on, and on.\n\nFive six, seven. It ends here."
    assert got[2] == got[3] == got[5] == ""
    assert pages.extract(df.where("1 = 0"), model).collect() == []
