import re
from collections import defaultdict

import numpy as np

from rastercube.llm import mixing


def plain_targets(size, weights, total):
    target, free = {}, dict(size)
    while free:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * size[s]
            del free[s]
    return target


def check(rows, got):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    order = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    target = plain_targets(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(size.values()))
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
    for s in size:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6


def test_accounts(docs, rows):
    got = mixing.mix(docs).accounts().collect()
    assert len(got) == len(rows)
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted(
        (repr(r[0]), len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows)
    check([r for r in rows], got)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(3)).accounts().collect()))


def test_documents_are_taken_as_often_as_accounted(docs):
    for words, least in ((50_000_000, 1), (500, 8), (50_000_000, 400)):  # one shard, many, more than draws
        mix = mixing.mix(docs, shard_words=words, least_shards=least)
        want = defaultdict(int)
        for r in mix.accounts().collect():
            want[r.doc_id, r.size] += r.copies
        out = mix.documents()
        assert out.columns == docs.columns
        have = defaultdict(int)
        for r in out.collect():
            have[r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))] += 1
        assert {k: v for k, v in want.items() if v} == dict(have)


def test_shards_hold_what_the_tree_dealt(docs):
    """Each draw is one shard's, a shard has a run of every source's permutation, and its documents are those of its blocks."""
    mix = mixing.mix(docs, least_shards=6)
    draws, plan = mix.draws.collect(), {r.s: r for r in mix.sources.collect()}
    assert len({(r.s, r["pass"], r.block) for r in draws}) == len(draws)
    at = {}
    for r in sorted(draws, key=lambda r: (r.s, r["pass"] * plan[r.s].blocks + r.block)):
        assert r.shard >= at.get(r.s, 0)  # runs of the permutation, in the shards' order
        at[r.s] = r.shard
    assert sum(len(set(r.shard for r in draws if r.s == s)) > 1 for s in plan) > 1
    shard_of = {(r.s, r.block, r["pass"]): r.shard for r in draws}
    s_of = {p.source: s for s, p in plan.items()}
    blocks = {(r.s, r.key, r.mark): r.block for r in mix.placed(mix.narrow).collect()}
    seen = defaultdict(list)
    for r in mix.narrow.collect():
        s = s_of[r.named]
        seen[repr(r.doc_id), r.size, s].append(blocks[s, r.key, r.mark])
    for r in mix.accounts().collect():
        assert len(r.shards) == len(r.positions) == r.copies
        options = seen[repr(r.doc_id), r.size, s_of[r.source]]
        assert any(all(shard_of.get((s_of[r.source], b, p)) == k for p, k in enumerate(r.shards)) for b in options)


def test_documents_without_an_id_are_spread(spark):
    rows = [(None, f"words of text {i} here", "a") for i in range(300)] + [(i, "b c", "b") for i in range(50)]
    mix = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    sizes = mix.placed(mix.narrow).where("source = 'a'").groupBy("block").count().collect()
    assert max(r["count"] for r in sizes) < 15
    check([(r[0], r[1], None, r[2]) for r in rows], mix.accounts().collect())


def test_the_step_permutes():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 12, 30030, 64):
        step = mixing._step(n, rng)
        assert len({i * step % n for i in range(n)}) == n


def test_tree_meets_quotas_and_capacities():
    quota = np.array([700, 0, 31, 5, 1000])
    for shards in (1, 2, 7, 16):
        leaves = [mixing.split_quotas(quota, shards, k, 3) for k in range(shards)]
        at = np.zeros(5, int)
        for k, (first, number) in enumerate(leaves):
            assert (first == at).all() and (number >= 0).all()
            at = at + number
            total = int(quota.sum())
            assert number.sum() == total * (k + 1) // shards - total * k // shards
        assert (at == quota).all()


def test_empty(no_docs):
    mix = mixing.mix(no_docs)
    assert mix.accounts().count() == 0 and mix.documents().count() == 0
