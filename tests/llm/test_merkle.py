import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rastercube.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves):
    """The root over (leaf digest) lists and for each leaf its siblings, as (before, after) from the leaf up."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(paths):
            run = level[at[i] // 8 * 8: at[i] // 8 * 8 + 8]
            p.append(("".join(run[:at[i] % 8]), "".join(run[at[i] % 8 + 1:])))
        level, at = [digest(*level[i:i + 8]) for i in range(0, len(level), 8)], [a // 8 for a in at]
    return level[0], paths


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) for rows of doc_id, text, lang, source, n_chars."""
    def leaf(r, text):
        return digest(*(encoded(v) for v in (r[0], r[3], r[2], r[4], text)))

    def tampered(r):
        if r[0] is None or r[1] is None or zlib.crc32(str(r[0]).encode()) % 3:
            return r[1]
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1])
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for x in langs:
        mine = sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        made[x] = (mine, *plain_tree([leaf(r, r[1]) for r in mine]))
    root, tops = plain_tree([made[x][1] for x in langs])
    out = []
    for x, top in zip(langs, tops):
        mine, sub, paths = made[x]
        for r, path in zip(mine, paths):
            at = leaf(r, tampered(r))
            for before, after in path + top:
                at = digest(before, at, after)
            proof = digest(*(b + a for b, a in path + top))
            out.append((r[0], leaf(r, r[1]), sub, root, proof, at, at == root))
    return sorted(out, key=repr)


def test_against_plain_trees(docs, rows):
    got = merkle.verified_leaves(docs)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


@pytest.mark.parametrize("sizes", [(1,), (8, 1), (9, 64, 65), (1,) * 10 + (520,)])
def test_shapes_of_trees(spark, sizes):
    rows = [(i * 100 + lang if lang % 2 else -i, f"Text {i} Of {lang}", f"l{lang}" if lang else None, "s", None)
            for lang, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = merkle.verified_leaves(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_some_requests_descend_alone(docs, rows):
    made = merkle.Manifest(docs)
    asked = made.leaves.where("rank % 5 = 2").select("tree", "rank", "doc_id")
    got = made.proofs(asked).withColumn("root", merkle.fold(F.col("found"), F.col("path"))).collect()
    assert len(got) == asked.count() > 5
    want = {(r[0], r[1]): r[4] for r in plain(rows)}
    assert {r.root for r in got} == {made.root}
    for r in got:
        siblings = [s.before + s.after for s in reversed(r.path)]
        assert digest(*siblings) == want[r.doc_id, r.found]


def test_equal_content_is_one_record(spark):
    docs = spark.createDataFrame([(1, "same", "en", "s", 4)] * 64, "doc_id long, text string, lang string, source string, n_chars long")
    made = merkle.Manifest(docs)
    assert [x.count() for x in made.levels] == [64, 8, 1]
    assert merkle.records(made.levels[1]).count() == 1
    assert made.proofs().count() == 64


def test_rerun_on_other_partitions(docs):
    assert merkle.Manifest(docs).root == merkle.Manifest(docs.repartition(3)).root


def test_empty(no_docs):
    got = merkle.verified_leaves(no_docs)
    assert got.collect() == []
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
