"""A Merkle manifest of a data set: digest-to-children records, and proofs by descent from the root."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import checked, settle
from rastercube.llm.ranking import ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, BITS = 8, 3


def field(value: Column) -> Column:
    """A value as the manifest hashes it: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    return F.sha2(F.concat(*[field(replaced.get(c, F.col(c))) for c in FIELDS]), 256)


def tree_key(value: Column) -> Column:
    """A key that is never null: a null value's comes first, the others are in the order of their bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def build(leaves: DataFrame) -> list[DataFrame]:
    """The nodes of trees over ``(tree, rank, digest)``, ranks from 0 without gaps: a table a level, leaves first.

    A level has (tree, rank, digest, n, children): ``children`` are the digests
    of up to eight consecutive nodes of the level below (null for leaves), the
    digest is that of their hex digests one after another, and ``n`` is the
    number of the tree's nodes in this level; 1 marks its root.  Each level has
    a node for every run of eight, so it is an eighth of the last; a run is the
    only group that is gathered.
    """
    sizes = settle(leaves.groupBy("tree").agg(F.count("*").alias("n")))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    levels = [leaves.select("tree", "rank", "digest").join(checked(sizes), "tree").withColumn(
        "children", F.lit(None).cast("array<string>"))]
    while largest > 1:
        below = levels[-1].where("n > 1").withColumn("up", F.shiftright("rank", BITS))
        runs = below.groupBy("tree", "up").agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run"), F.first("n").alias("n"))
        nodes = runs.select("tree", F.col("up").alias("rank"), F.sha2(F.array_join("run.digest", ""), 256).alias("digest"),
                            F.shiftright(F.col("n") + FANOUT - 1, BITS).alias("n"), F.col("run.digest").alias("children"))
        levels.append(settle(nodes))
        largest = (largest + FANOUT - 1) >> BITS
    return levels


def records(level: DataFrame) -> DataFrame:
    """Digest-to-children records of a level's nodes; equal content is stored once."""
    return settle(level.groupBy("digest").agg(F.any_value("children").alias("children")))


def _segment(children: Column, digit: Column) -> Column:
    """What stands before and after the selected child."""
    before, after = F.slice(children, F.lit(1), digit), F.slice(children, digit + 2, F.lit(FANOUT))
    return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))


def descend(levels: list[DataFrame], starts: DataFrame, requests: DataFrame, every: bool = False) -> DataFrame:
    """``requests`` with ``found`` (the leaf's digest), ``path`` (from the root down) and ``subroot``.

    ``requests`` has (tree, rank, ...); ``every`` says that it has all leaves,
    so that no node need be left out.  ``starts`` has (tree, path, subroot, at)
    for each tree, ``at`` being its root's digest.  Requests descend together:
    those that agree in the rank's upper octal digits are one row until they
    part.  At each level the record of the node's digest is looked up, the next
    digit chooses a child, and the others join the path as one segment.  The
    last step is taken where the requests of a run meet their run, so paths are
    moved once for each run, not for each leaf.
    """
    state = None
    for k in range(len(levels) - 1, 0, -1):
        tops = levels[k].where("n = 1").select("tree")
        new = starts.join(tops, "tree", "left_semi").select("tree", F.lit(0).cast("long").alias("prefix"), "at", "path", "subroot")
        state = settle(new if state is None else state.unionByName(new))
        found = state.join(records(levels[k]), state["at"] == F.col("digest")).select(
            "tree", "prefix", "path", "subroot", "children")
        if k == 1:
            break
        kids = found.select("*", F.posexplode("children").alias("i", "child")).withColumn(
            "next", F.shiftleft("prefix", BITS) + F.col("i"))
        if not every:
            wanted = requests.select("tree", F.shiftright("rank", BITS * (k - 1)).alias("next")).distinct()
            kids = kids.join(wanted, ["tree", "next"], "left_semi")
        state = kids.select("tree", F.col("next").alias("prefix"), F.col("child").alias("at"),
                            F.concat("path", F.array(_segment(F.col("children"), F.col("i")))).alias("path"), "subroot")
    # a lone leaf is its tree's root and has nothing to descend through
    lone = starts.join(levels[0].where("n = 1").select("tree"), "tree", "left_semi").select(
        "tree", F.lit(0).cast("long").alias("prefix"), "path", "subroot", F.array("at").alias("children"))
    lone = lone.withColumn("lone", F.lit(True))
    runs = lone if len(levels) == 1 else lone.unionByName(found.withColumn("lone", F.lit(False)))
    batches = requests.groupBy("tree", F.shiftright("rank", BITS).alias("prefix")).agg(
        F.collect_list(F.struct(*[c for c in requests.columns if c != "tree"])).alias("batch"))
    met = settle(runs).join(batches, ["tree", "prefix"]).select("*", F.explode("batch").alias("r"))
    digit = F.col("r.rank").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    segment = F.array(_segment(F.col("children"), digit))
    return met.select("tree", "r.*", F.element_at("children", digit + 1).alias("found"),
                      F.when(F.col("lone"), F.col("path")).otherwise(F.concat("path", segment)).alias("path"), "subroot")


def siblings(path: Column) -> Column:
    """The path's digests, level by level from the leaf, left to right in each."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["before"], s["after"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(F.reverse(path), leaf, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


def tamper(doc_id: Column, text: Column) -> Column:
    """The text after the tampering: A-Z lower-cased where 3 divides the CRC-32 of the decimal doc_id."""
    upper = "".join(map(chr, range(65, 91)))
    hit = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 0
    return F.when(hit, F.translate(text, upper, upper.lower())).otherwise(text)


class Manifest:
    """Trees over the rows of ``docs``, one for each ``lang``, and one over their roots.

    A leaf is the digest of doc_id, source, lang, n_chars and text; leaves
    ascend by doc_id (null first; rows of one doc_id by digest, so that the
    manifest does not depend on the order of the input).  Null fields, empty
    and very long texts and repeated rows are hashed like others; an empty
    table has no root.  Other columns are left out.  ``checks`` are further
    columns, computed in the same scan and kept with the leaf.
    """

    def __init__(self, docs: DataFrame, **checks: Column):
        rows = docs.select(tree_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                           leaf_digest().alias("digest"), *[c.alias(name) for name, c in checks.items()])
        self.leaves = settle(ranked(settle(rows), "tree", ["doc_id", "digest"]))
        self.levels = build(self.leaves)
        roots = reduce(DataFrame.unionByName, [x.where("n = 1").select("tree", "digest") for x in self.levels])
        self.ranks = settle(ranked(settle(roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")),
                                   "tree", ["of"]))
        self.top_levels = build(self.ranks)
        end = self.top_levels[-1].where("n = 1").select("digest").first()
        self.root: str | None = end and end.digest

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """``requests`` (tree, rank, ...), by default all leaves, with ``found``, ``path`` (from the root) and ``subroot``."""
        path = F.array().cast("array<struct<before:string,after:string>>")
        none = F.lit(None).cast("string").alias("subroot")
        start = self.ranks.where("rank = 0").select("tree", path.alias("path"), none, F.lit(self.root).alias("at"))
        langs = self.ranks.select("tree", "rank", "of")
        if requests is not None:
            langs = langs.join(requests.select(F.col("tree").alias("of")), "of", "left_semi").select("tree", "rank", "of")
        starts = settle(descend(self.top_levels, start, langs, every=requests is None).select(
            F.col("of").alias("tree"), "path", F.col("found").alias("subroot"), F.col("found").alias("at")))
        return descend(self.levels, starts, self.leaves if requests is None else requests, every=requests is None)


def verified_leaves(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The manifest is built from ``docs`` as it is; then each leaf is computed
    from the tampered row and folded with the proof's siblings.  An empty table
    gives no rows; see :class:`Manifest` for the other cases.
    """
    made = Manifest(docs, now=leaf_digest(text=tamper(F.col("doc_id"), F.col("text"))))
    proven = made.proofs().select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(made.root).cast("string").alias("root"),
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), fold(F.col("now"), F.col("path")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32_sql(text: str) -> str:
    """The CRC-32 of ASCII text in DuckDB, which has none: half a byte at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    halves = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, 0]))"
    step = f"xor(xor(x, y) >> 4, {table}[(xor(x, y) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}), lambda x, y: {step}), 4294967295)"


def _levels_sql(name: str, levels: int) -> str:
    """``{name}0`` to ``{name}{levels}`` from ``{name}0`` (tree, rank, digest, n), and each one's siblings."""
    run = "PARTITION BY tree, rank // 8 ORDER BY rank ROWS BETWEEN"
    out = []
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
            SELECT tree, rank // 8 AS rank, (max(n) + 7) // 8 AS n,
                   CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY rank)) END AS digest
            FROM {name}{k} GROUP BY tree, rank // 8)""")
        out.append(f"""{name}s{k} AS (
            SELECT tree, rank, n, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
                   coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
            FROM {name}{k})""")
    return ", ".join(out)


def _fold_sql(step: str, name: str, levels: int) -> str:
    """``{step}{levels}`` from ``{step}0`` (tree, rank, node, proof, ...): every level's siblings taken up."""
    return ", ".join(f"""{step}{k + 1} AS (
            SELECT d.* REPLACE (d.rank // 8 AS rank, d.proof || s.b || s.a AS proof,
                                CASE WHEN s.n = 1 THEN d.node ELSE sha256(s.b || d.node || s.a) END AS node)
            FROM {step}{k} d JOIN {name}s{k} s ON d.tree = s.tree AND d.rank = s.rank)""" for k in range(levels))


def oracle_sql(levels: int = 8, top_levels: int = 4) -> str:
    """:func:`verified_leaves` in DuckDB SQL, for trees of at most 8 ** ``levels`` leaves."""
    def encoded(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(encoded(text if c == "text" else c) for c in FIELDS) + ")"

    upper = "".join(map(chr, range(65, 91)))
    hit = f"{_crc32_sql('doc_id::VARCHAR')} % 3 = 0"
    low = f"(CASE WHEN {hit} THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END)"
    return f"""
        WITH docs AS (SELECT coalesce('=' || lang, '') AS tree, doc_id, {leaf('text')} AS leaf, {leaf(low)} AS now FROM documents),
        d AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,
                     count(*) OVER (PARTITION BY tree) AS n FROM docs),
        l0 AS (SELECT tree, rank, leaf AS digest, n FROM d), {_levels_sql('l', levels)},
        t AS (SELECT tree AS lang, digest FROM l{levels}),
        t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY lang) - 1 AS rank, digest, count(*) OVER () AS n FROM t),
        {_levels_sql('t', top_levels)},
        p0 AS (SELECT tree, rank, doc_id, leaf, now AS node, '' AS proof FROM d), {_fold_sql('p', 'l', levels)},
        q AS (SELECT lang, digest, row_number() OVER (ORDER BY lang) - 1 AS rank FROM t),
        f0 AS (SELECT '' AS tree, q.rank AS rank, doc_id, leaf, node, proof, digest AS subroot
               FROM p{levels} p JOIN q ON p.tree = q.lang), {_fold_sql('f', 't', top_levels)}
        SELECT doc_id, leaf, subroot, r.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.digest AS verified
        FROM f{top_levels}, t{top_levels} r"""
