import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rastercube.llm import substring


def plain(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out


@pytest.mark.parametrize("window", [35, 3, 1])
def test_against_all_windows(docs, rows, window):
    got = substring.remove_repeats(docs, window=window).collect()
    want = [(r[0], *p) for r, p in zip(rows, plain([r[1] for r in rows], window))]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)


def test_small_alphabets_and_overlaps(spark, monkeypatch):
    rng = random.Random(11)
    base = [rng.choice("abc") for _ in range(300)]
    texts = []
    for i in range(60):
        a = rng.randrange(250)
        text = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))] + base[a: a + rng.randint(1, 90)]
        texts.append(" ".join(text + ["r"] * rng.choice([0, 0, 20, 60]) + [rng.choice("abcxyz") for _ in range(10)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for window in (12, 35):
        want = sorted((i, *p) for i, p in enumerate(plain(texts, window)))
        assert sorted(tuple(r) for r in substring.remove_repeats(df, window=window).collect()) == want


def test_hot_phrases_and_passages_over_many_chunks(spark):
    """A phrase in every text, passages of several contexts and copies: combined over a task's chunks, nothing lost."""
    rng = random.Random(3)
    text = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(40)) for _ in range(n)]
    phrase, passages = text(14), [text(45) for _ in range(3)]
    texts = []
    for i in range(900):
        parts = text(rng.randint(0, 25)) + phrase + text(rng.randint(0, 25))
        if i % 3 == 0:
            parts += passages[rng.choice([0, 0, 0, 1])] + text(rng.randint(0, 9))
        texts.append(" ".join(parts) if i % 10 else " ".join(passages[2][:40] + phrase))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((i, *p) for i, p in enumerate(plain(texts, 35)))
    for chunk_words in (1, substring.CHUNK_WORDS):
        got = substring.remove_repeats(df, window=35, chunk_words=chunk_words).collect()
        assert sorted(tuple(r) for r in got) == want


def test_a_task_sends_a_hot_key_once():
    rng = np.random.default_rng(8)
    n, sent, told = 2000, substring.Sent(), substring.Sent()
    met, hot = Counter(), np.uint64(77)
    for chunk in range(20):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = substring.mix64(a, 5)
        a[::2] = hot  # one anchor in half the rows, with contexts of its own
        b[1::4], a[1::4] = 5, 6  # one context in a quarter of them
        at = np.arange(n)
        out = substring._hits(a, b, np.full(n, chunk), at * 40, at * 40, sent, told).to_pydict()
        met.update(x for x in out["a"] if x in (6, 77))
        assert sum(out["sure"]) == n // 4 and sum(out["several"]) == n // 2
    assert met == {6: 1, 77: 1}


def test_keys_that_are_forgotten_are_sent_again():
    sent, keys = substring.Sent(4), np.arange(10, dtype=np.uint64)
    sent.add(keys[:3], keys[:3])
    assert sent.has(keys[:5], keys[:5]).tolist() == [True, True, True, False, False]
    sent.add(keys[3:6], keys[3:6])
    assert sent.has(keys[:3], keys[:3]).all() and sent.keys.shape[1] == 4
    assert not sent.has(keys[:3], keys[1:4]).any()


def test_a_symbol_follows_from_the_words_that_fix_it():
    rng = np.random.default_rng(4)
    for alphabet in (2, 5, 50):
        words = substring.mix64(rng.integers(0, alphabet, 400).astype(np.uint64))
        halves = [rng.random(substring.GROUPS) < 0.5 for _ in range(3)]
        name, lo, hi = substring.recompress(words, halves)
        assert (np.diff(lo) >= 0).all() and (np.diff(hi) >= 0).all()
        for shift in (0, 7, 31):
            other = np.concatenate((rng.integers(0, 9, shift).astype(np.uint64), words[100:300], words[:50]))
            symbols = set(zip(*(x.tolist() for x in substring.recompress(other, halves))))
            for s, a, b in zip(name.tolist(), lo.tolist(), hi.tolist()):
                if a >= 100 and b < 300:
                    assert (s, a - 100 + shift, b - 100 + shift) in symbols


def test_halves_part_a_quarter_of_the_pairs():
    rng = np.random.default_rng(2)
    for density in (0.001, 0.05, 1):
        count = rng.integers(0, 1000, (substring.GROUPS, substring.GROUPS)) * (rng.random((substring.GROUPS,) * 2) < density)
        left = substring.split_groups(count)
        apart = count.sum() - np.trace(count)
        assert 4 * count[left][:, ~left].sum() >= apart
    left = substring.split_groups(np.zeros((substring.GROUPS,) * 2, np.int64))
    assert left.sum() == substring.GROUPS // 2


def test_rounds_are_counted_over_all_texts(spark):
    """However the texts are partitioned, a round's pairs take at least a fifth of the symbols away."""
    rng = random.Random(9)
    texts = [" ".join(f"w{int(rng.expovariate(0.05))}" for _ in range(400)) for _ in range(60)]
    ends = [(t,) for t in texts]
    frame = spark.createDataFrame(ends, "text string")
    whole = substring.pairings(frame.repartition(1), 3)
    assert len(whole) == 3 and all(h.dtype == bool and len(h) == substring.GROUPS for h in whole)
    names = substring._SYMBOLS([t.encode() for t in texts])
    for halves in [whole] + [substring.pairings(frame.repartition(n), 3) for n in (2, 7)]:
        name = names
        for r in range(3):
            before, _ = substring._runs(name, r)
            name = substring._pairs(before, r, halves[r])[0]
            assert len(name) <= 0.8 * len(before)
        assert (name == substring.recompress(names, halves)[0]).all()


def test_symbols_are_those_of_the_words():
    """One for each word, the same wherever it stands, in blocks of any size; other words have others."""
    rng = random.Random(6)
    words = [rng.randbytes(rng.choice([1, 2, 9, 300])).translate(None, b" \t\n\x0b\x0c\r") or b"x" for _ in range(500)]
    texts = [b"", b" \n", b"\x0b".join(words), b"  " + b"\t ".join(words[::-1]) + b"\r", b"\xc2\xa0\x1c one"]
    for block in (1, 50, 1 << 20):
        found = substring._SYMBOLS(texts, block)
        flat = [w for t in texts for w in t.split()]
        assert len(found) == len(flat)
        assert len(set(zip(flat, found.tolist()))) == len(set(flat)) == len(set(found.tolist()))
    assert len(substring._SYMBOLS([])) == 0


@pytest.mark.parametrize("half", [0, 1])
def test_words_that_share_half_a_name_are_told_apart(monkeypatch, half):
    """Two words whose names agree in 64 of 128 bits: no window with them is taken for equal, by context or one by one."""
    names = substring.WordNames()
    x, y = bytearray(names[b"x"]), bytearray(names[b"y"])
    y[8 * half: 8 * half + 8] = x[8 * half: 8 * half + 8]
    names[b"y"] = bytes(y)
    monkeypatch.setattr(substring, "_NAMES", names)
    rng = random.Random(1)
    words = [f"w{rng.randrange(1000)}" for _ in range(80)]
    texts = [" ".join(words[:40] + [w] + words[40:]) for w in "xy"]
    halves = [np.arange(substring.GROUPS) % 2 == 0] * 3
    spans = pa.array([[{"first": 0, "last": 46, "done": False, "compare": True}]] * 2)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([0, 1]), pa.array(texts), spans],
                                       names=["row", "doc_id", "text", "spans"])
    with_word = set(range(6, 41))
    for out in (substring._anchors(iter([batch]), 35, halves, 1 << 20), substring._candidates(iter([batch]), 35, 1 << 20)):
        rows = [r for b in out for r in b.to_pylist()]
        met = Counter((r["a"], r["b"]) for r in rows)
        seen = set()
        for r in rows:
            if with_word & set(range(r["first"], r["last"] + 1)):
                assert not r["sure"] and met[r["a"], r["b"]] == 1
            seen |= {(r["row"], i) for i in range(r["first"], r["last"] + 1)}
        assert len(seen) == 2 * 47
    assert sum(r["last"] - r["first"] + 1 for r in rows if r["sure"]) >= 12


def test_empty(no_docs):
    assert substring.remove_repeats(no_docs).count() == 0
