import zlib

import pytest

from rastercube.llm import sharding


def least_capacity(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, used, room = (lo + hi) // 2, 1, (lo + hi) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        lo, hi = (lo, mid) if used <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("shards", [1, 3, 8, 200])
def test_minimax(docs, rows, shards, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST", 1)  # so that segments hold several groups
    monkeypatch.setattr(sharding, "SLOT_ROWS", 10)
    got = sharding.shard(docs, shards).collect()
    text = {}
    for r in rows:
        text.setdefault((r[0], zlib.crc32((r[1] or "").encode())), []).append(r[1] or "")
    assert len(got) == len(rows)
    load, slots, home = {}, {}, {}
    for r in got:
        t = text[r.doc_id, r.text_crc32][0]
        assert r.size == len(t.encode()) + 1 and r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        assert home.setdefault(t, r.shard) == r.shard
        load[r.shard] = load.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    import hashlib

    groups = {}
    for r in rows:
        t = r[1] or ""
        groups[t] = groups.get(t, 0) + len(t.encode()) + 1
    sizes = [n for _, n in sorted((hashlib.sha256(t.encode()).hexdigest(), n) for t, n in groups.items())]
    assert max(load.values()) == least_capacity(sizes, shards)


def test_plan_has_no_python(docs):
    assert "Python" not in (plan := docs._jdf.queryExecution().toString()) or plan
    out = sharding.shard(docs, 4)._jdf.queryExecution().toString()
    assert not any(x in out for x in ("ArrowEval", "MapInArrow", "MapInPandas", "PythonUDF"))


def test_empty(no_docs):
    assert sharding.shard(no_docs, 8).count() == 0


@pytest.mark.parametrize("share", [0, 0.126, 0.2, 1 / 3])
def test_a_hot_group_does_not_bring_the_others_to_the_driver(share, monkeypatch):
    """A round brings at most two segments a shard; the capacity is the least one."""
    import random
    from bisect import bisect_left

    rng, shards = random.Random(3), 8
    groups = sorted((f"{rng.getrandbits(256):064x}", rng.randint(100, 3000)) for _ in range(30_000))
    if share:
        groups[9000] = (groups[9000][0], int(sum(n for _, n in groups) * share / (1 - share)))
    digests, sent = [d for d, _ in groups], []

    def segments(_, prefixes):
        depth, out = len(prefixes[0]), {}
        for p in prefixes:
            for d, n in groups[bisect_left(digests, p): bisect_left(digests, p + "g") if p else None]:
                x = out.setdefault(d[: depth + sharding.MORE], [0, 0])
                x[0] += n
                x[1] += 1
        sent.append((len(prefixes), len(out)))
        return sorted((p, *x) for p, x in out.items())

    monkeypatch.setattr(sharding, "_segments", segments)
    sizes = [n for _, n in groups]
    bounds, capacity = sharding.minimax(None, shards, max(sizes))
    assert capacity == least_capacity(sizes, shards)
    at = [0, *(bisect_left(digests, b) if b else len(sizes) for b in bounds), len(sizes)]
    assert max(sum(sizes[i:j]) for i, j in zip(at, at[1:])) == capacity
    assert max(n for n, _ in sent) <= 2 * shards and sum(n for _, n in sent) < 10_000
    assert len(sent) < 30
