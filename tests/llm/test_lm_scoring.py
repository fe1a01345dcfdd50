import math
import random

import numpy as np
import pytest

from rastercube.llm import lm_scoring as lm


def texts(n, seed):
    """A language in which a word's neighbours tell it."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at, words = rng.randrange(50), []
        for _ in range(60):
            words.append(f"t{at}")
            at = (at * 3 + rng.choice([1, 1, 1, 2])) % 50
        out.append(" ".join(words))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def prepared(spark, rows):
    df = frame(spark, rows)
    counts = lm.token_counts(df.select("text"))
    known = lm.vocabulary(counts)
    return counts, known, lm.encode(df, known)


def plain_scores(known, weights, train, asked):
    """Score and number of words by plain loops over words, classes and counts, from the texts alone."""
    n = {}
    for _, t in train:
        for w in (t or "").lower().encode().split():
            n[w] = n.get(w, 0) + 1
    classes = known.side ** 2
    own = sorted(n, key=lambda w: (-n[w], w))[: known.own]
    kind = {w: i for i, w in enumerate(own)}
    of = lambda w: kind[w] if w in kind else len(own) + lm.mark(w) % (classes - len(own))
    share = {}
    for w in n:
        k, m = share.get(of(w), (0, 0))
        share[of(w)] = (k + n[w], m + 1)
    net = {k: v.astype(float) for k, v in lm.views(weights, known.side).items()}
    out = []
    for i, t in asked:
        words, total = (t or "").lower().encode().split(), 0.0
        for j, w in enumerate(words):
            hidden = np.zeros(lm.WIDTH)
            for k, o in enumerate(lm.OFFSETS):
                c = of(words[j + o]) if 0 <= j + o < len(words) else classes
                hidden += net["embed"][k * (classes + 1) + c]
            hidden = np.tanh(hidden)
            a, b = divmod(of(w), known.side)
            for x, at in ((hidden @ net["out_a"] + net["bias_a"], a), (hidden @ net["out_b"] + net["bias_b"][a], b)):
                total += x[at] - math.log(sum(math.exp(v) for v in x))
            if w not in kind:
                k, m = share.get(of(w), (0, 0))
                total += math.log((n.get(w, 0) + lm.UNSEEN) / (k + lm.UNSEEN * (m + 1)))
        out.append((i, len(words), total))
    return out


def test_held_out_texts_beat_shuffled_ones(spark):
    counts, known, encoded = prepared(spark, list(enumerate(texts(600, 1))))
    weights = lm.fit(encoded, known, rounds=3, rate=0.1)
    held = texts(40, 2)
    mixed = [" ".join(random.Random(i).sample(t.split(), 60)) for i, t in enumerate(held)]
    asked = lm.encode(frame(spark, list(enumerate(held + mixed))), known)
    got = {r.doc_id: r.mean_log_likelihood for r in lm.scores(asked, known, weights, counts).collect()}
    good, bad = np.mean([got[i] for i in range(40)]), np.mean([got[i] for i in range(40, 80)])
    assert good > -2.5 and good > bad + 0.7
    assert np.mean([got[i] > got[40 + i] for i in range(40)]) > 0.9


def test_gradient_and_norm():
    side = 9
    flat = lm.start(1, side) * 3
    found = [np.array(x, np.int64) for x in ([3, 5, 80, 0, 5, 7, 44], [], [1, 2])]
    classes, position, doc = lm.sequence(found, side * side)
    assert classes[position].tolist() == [3, 5, 80, 0, 5, 7, 44, 1, 2] and doc.tolist() == [0] * 7 + [2] * 2
    net = lm.views(flat, side)
    # the two softmaxes give a distribution over all classes
    p = 0.0
    for c in range(side * side):
        changed = classes.copy()
        changed[position[3]] = c
        p += np.exp(lm.forward(net, changed, position[3:4])[-1][0])
    assert abs(p - 1) < 1e-3
    before = lm.forward(net, classes, position)[-1].sum()
    squares = np.zeros_like(flat)
    for _ in range(30):
        lm.train(flat, squares, side, classes, position, 0.05)
    assert lm.forward(lm.views(flat, side), classes, position)[-1].sum() > before + 5


def test_rows(docs, rows, no_docs):
    got = lm.pseudo_likelihood(docs).collect()
    assert sorted((repr(r.doc_id), r.n_tokens) for r in got) == sorted((repr(r[0]), len((r[1] or "").encode().split())) for r in rows)
    for r in got:
        assert (r.mean_log_likelihood is None) == (r.n_tokens == 0) and r.log_likelihood <= 0
    assert lm.pseudo_likelihood(no_docs).count() == 0


@pytest.mark.parametrize("head", [lm.HEAD, 40, 1])
def test_scores_by_plain_loops(spark, monkeypatch, head):
    """Whole scores, with the tokens known to the tasks or joined, of seen and unseen words."""
    rng = random.Random(5)
    train = [(i, " ".join(f"w{min(int(rng.expovariate(0.03)), 199)}" for _ in range(rng.randrange(60)))) for i in range(60)]
    train += [(60, None), (61, "The the THE"), (62, "The the THE")]
    monkeypatch.setattr(lm, "HEAD", head)
    counts, known, encoded = prepared(spark, train)
    assert len(known.head) <= head and known.own <= known.side ** 2 // 2
    weights = lm.fit(encoded, known)
    asked = train + [(70, "w0 neverseen w1 the"), (71, "")]
    got = lm.scores(lm.encode(frame(spark, asked).repartition(3), known), known, weights, counts).collect()
    want = plain_scores(known, weights, train, asked)
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((i, n) for i, n, _ in want)
    score = {i: s for i, _, s in want}
    for r in got:
        assert abs(r.log_likelihood - score[r.doc_id]) < 0.02


def test_partitions_do_not_change_scores(spark):
    rows = list(enumerate(texts(80, 3) + ["junk words once"] * 3)) + [(None, "a b"), (None, "a b"), (5, None)]
    found = [sorted(map(repr, lm.pseudo_likelihood(frame(spark, rows).repartition(n)).collect())) for n in (1, 4, 9)]
    assert found[0] == found[1] == found[2]


def test_classes_grow_with_the_corpus(spark):
    """Frequent tokens are classes of their own, and more of them in a larger corpus."""
    def known(words):
        rows = [(f"t{i}".encode(), lm.mark(f"t{i}".encode()), max(1, words // ((i + 1) * 10))) for i in range(3000)]
        return lm.vocabulary(spark.createDataFrame(rows, "token binary, mark long, n long"))
    small, large, huge = known(10**5), known(10**8), known(10**13)
    assert small.side < large.side < huge.side
    assert small.own < large.own < huge.own and huge.own > 2000
    for v in (small, large, huge):
        assert v.head[0] == b"t0" and len(set(v.classes()[: v.own])) == v.own
        assert (v.classes()[v.own:] >= v.own).all() and (v.classes() < v.side ** 2).all()
        assert (v.share[: v.own] == 0).all() and (v.share[v.own:] <= 0).all()


def test_every_word_is_a_target_once(spark):
    """The rounds share out all places; every frequent token's own output has learnt."""
    size = [0, 1, 3, 50, 700, 1]
    salt = np.array([lm.mark(b"%d" % n) for n in size])
    doc = np.repeat(np.arange(len(size)), size)
    for rounds in (1, 2, 5):
        assert (sum(lm.targets(salt, doc, rounds, k).astype(int) for k in range(rounds)) == 1).all()
        # in whichever order the texts are read
        first = lm.targets(salt, doc, rounds, 0)
        turned = lm.targets(salt[::-1], (len(size) - 1 - doc)[::-1], rounds, 0)
        assert (np.bincount(doc, first) == np.bincount(doc[::-1], turned)).all()
    _, known, encoded = prepared(spark, [(i, f"r{i}") for i in range(32)])
    assert known.own == 32
    learnt = lm.views(lm.fit(encoded, known), known.side)["bias_b"]
    used = learnt[: math.ceil(32 / known.side)].ravel()[:32]
    assert (used > 0).all()
