"""Merkle manifest of a dataset, and proofs of its rows by one multiproof per block of leaves."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_order, written

ARITY = 3
HEIGHT = 7                      # levels a task grows at a time
BLOCK = ARITY ** HEIGHT         # leaves of a block: 2,187
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = 0                         # the tree over the sources' roots; source k has tree k + 1

_NODES = "tree long, level int, idx long, width long, digest binary"


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields (binary); a field given by name stands for the row's own."""
    parts = [_field(changed.get(c, F.col(c))) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _joined(digests: list[bytes]) -> bytes:
    """Digest of digests, which count as their hex text."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def widths(n: int) -> list[int]:
    """Nodes of each level of a tree of ``n`` leaves, leaves first, up to the one that remains."""
    out = [n]
    while out[-1] > 1:
        out.append(-(-out[-1] // ARITY))
    return out


def _grow(base: int):
    """Up to HEIGHT levels above one block of nodes of level ``base``."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, width, lo = table["tree"][0].as_py(), table["width"][0].as_py(), table["idx"][0].as_py()
        nodes, out = table["digest"].to_pylist(), []
        for level in range(base + 1, base + HEIGHT + 1):
            if width == 1:
                break
            nodes = [_joined(nodes[i: i + ARITY]) for i in range(0, len(nodes), ARITY)]
            width, lo = -(-width // ARITY), lo // ARITY
            out += [(tree, level, lo + k, width, d) for k, d in enumerate(nodes)]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                        names=["tree", "level", "idx", "width", "digest"])
    return run


def _grown(level0: DataFrame, name: str) -> list[DataFrame]:
    """All levels above the nodes (tree, level 0, idx, width, digest), as written tables."""
    widest = level0.agg(F.max("width")).first()[0] or 0
    out, base, now = [], 0, level0
    while widest > 1:
        rows = now.where("width > 1").withColumn("block", F.expr(f"idx div {BLOCK}"))
        grown = written(rows.groupBy("tree", "block").applyInArrow(_grow(base), _NODES), f"{name}-{base}")
        out.append(grown)
        base, widest = base + HEIGHT, -(-widest // BLOCK)
        now = grown.where(F.col("level") == base)
    return out


@dataclass
class Manifest:
    leaves: DataFrame       # tree, idx, width, and the columns of the slim table
    nodes: DataFrame        # tree, level, idx, width, digest: all levels of all trees
    n_sources: int
    root: bytes | None      # None: no rows


def build(slim: DataFrame) -> Manifest:
    """The trees over ``slim`` (source, doc_id, leaf, and columns to carry along).

    Rows get their place by a range sort over source and doc_id, so a source with a third of all
    rows is spread over many tasks; each task then grows the subtree of one block of leaves, and
    rounds repeat on what remains.  The number of rounds is the logarithm to base 2,187 of the
    largest source.

    A null source comes first, then sources by their UTF-8 bytes; null doc_ids come first in their
    source, rows that share a doc_id go by their leaf.  An empty table has no root.
    """
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = in_order(slim, order, "merkle-order")
    runs = written(placed.groupBy("_part", "source").agg(F.min("position").alias("start"), F.count("*").alias("n")), "merkle-runs")
    sources = runs.groupBy("source").agg(F.min("start").alias("begin"), F.sum("n").alias("width"))
    named = in_order(sources, [F.col("source").asc_nulls_first()], "merkle-sources")
    named = named.select(F.col("source").alias("_source"), "begin", "width", (F.col("position") + 1).alias("tree"))
    # joined by part and source: a part is bounded, however large its source is
    at = (runs.join(named, F.col("source").eqNullSafe(F.col("_source")))
          .select(F.col("_part").alias("_at"), "_source", "begin", "width", "tree"))
    leaves = (placed.join(at, (F.col("_part") == F.col("_at")) & F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("idx", F.col("position") - F.col("begin"))
              .drop("_part", "_at", "_source", "begin", "position"))
    leaves = written(leaves, "merkle-leaves")
    level0 = leaves.select("tree", F.lit(0).alias("level"), "idx", "width", F.col("leaf").alias("digest"))
    parts = [level0, *_grown(level0, "merkle-grown")]
    subroots = parts[0].where("width = 1")
    for p in parts[1:]:
        subroots = subroots.unionByName(p.where("width = 1"))
    n_sources = named.count()
    tops = written(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), (F.col("tree") - 1).alias("idx"),
                                   F.lit(n_sources).cast("long").alias("width"), "digest"), "merkle-top")
    parts += [tops, *_grown(tops, "merkle-top-grown")]
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    root = nodes.where(F.col("tree") == TOP).where("width = 1").select("digest").first()
    return Manifest(leaves, nodes, n_sources, bytes(root[0]) if root else None)


def climb(indices: list[int], n: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Coordinates (level, idx) that the paths of leaves ``indices`` of a tree of ``n`` leaves need and
    can't derive from each other, and the derivable nodes of every level."""
    missing, levels, known = [], [], sorted(set(indices))
    for level, width in enumerate(widths(n)):
        levels.append(known)
        if width == 1:
            break
        held, parents = set(known), list(dict.fromkeys(i // ARITY for i in known))
        missing += [(level, i) for p in parents for i in range(p * ARITY, min(p * ARITY + ARITY, width)) if i not in held]
        known = parents
    return missing, levels


def _needs(n_sources: int):
    """The union of node coordinates that the leaves of one block need from elsewhere."""
    def run(table: pa.Table) -> pa.Table:
        tree, block = table["tree"][0].as_py(), table["block"][0].as_py()
        own, _ = climb(table["idx"].to_pylist(), table["width"][0].as_py())
        top, _ = climb([tree - 1], n_sources)
        rows = [(tree, block, tree, level, i) for level, i in own] + [(tree, block, TOP, level, i) for level, i in top]
        cols = zip(*rows) if rows else [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                        names=["tree", "block", "of", "level", "idx"])
    return run


def _prove(n_sources: int, root: bytes):
    """Proofs of a block's leaves from the leaves themselves and the nodes fetched for the block."""
    def derived(known: dict, levels: list[list[int]], n: int) -> None:
        for level, width in enumerate(widths(n)[:-1]):
            for p in levels[level + 1]:
                known[level + 1, p] = _joined([known[level, i] for i in range(p * ARITY, min(p * ARITY + ARITY, width))])

    def path(known: dict, i: int, n: int) -> list[tuple[list[bytes], int]]:
        """Per level: the run's nodes in order and the place of the leaf's own among them."""
        out = []
        for level, width in enumerate(widths(n)[:-1]):
            lo = i // ARITY * ARITY
            out.append(([known[level, k] for k in range(lo, min(lo + ARITY, width))], i - lo))
            i //= ARITY
        return out

    def run(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        tree, width = leaves["tree"][0].as_py(), leaves["width"][0].as_py()
        own, top = {}, {}
        for of, level, i, d in zip(*[fetched[c].to_pylist() for c in ("of", "level", "idx", "digest")]):
            (top if of == TOP else own)[level, i] = d
        idx, leaf, claimed = (leaves[c].to_pylist() for c in ("idx", "leaf", "claimed"))
        own |= {(0, i): d for i, d in zip(idx, leaf)}
        derived(own, climb(idx, width)[1], width)
        subroot = own[len(widths(width)) - 1, 0]
        top[0, tree - 1] = subroot
        derived(top, climb([tree - 1], n_sources)[1], n_sources)
        above = path(top, tree - 1, n_sources)
        out = []
        for i, d, c in zip(idx, leaf, claimed):
            runs = path(own, i, width) + above
            proof = _joined([s for nodes, k in runs for j, s in enumerate(nodes) if j != k])
            now = d if c is None else c
            if now == d:
                now = top[len(widths(n_sources)) - 1, 0]     # the shared interiors are its folding
            else:
                for nodes, k in runs:
                    now = _joined([*nodes[:k], now, *nodes[k + 1:]])
            out.append((d.hex(), subroot.hex(), root.hex(), proof.hex(), now.hex(), now == root))
        cols = [leaves["doc_id"].combine_chunks()] + [pa.array(c) for c in zip(*out)]
        return pa.table(cols, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of ``wanted``, rows of ``manifest.leaves`` (all by default), against the manifest's root.

    Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.  The leaves of a block
    first work out together which nodes they lack; each is fetched once per block by a join, the
    inner nodes they share are derived there, and every leaf's own proof is read off.  ``claimed``
    (null: the leaf itself) is the digest that the proof is folded from.
    """
    rows = (manifest.leaves if wanted is None else wanted).withColumn("block", F.expr(f"idx div {BLOCK}"))
    if manifest.root is None:
        fields = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        of_id = dict(manifest.leaves.dtypes)["doc_id"]
        return manifest.leaves.sparkSession.createDataFrame([], f"doc_id {of_id}, {fields}")
    needs = written(rows.select("tree", "block", "idx", "width").groupBy("tree", "block").applyInArrow(
        _needs(manifest.n_sources), "tree long, block long, of long, level int, idx long"), "merkle-needs")
    stored = manifest.nodes.select(F.col("tree").alias("of"), "level", "idx", "digest")
    fetched = needs.join(stored, ["of", "level", "idx"])
    slim = rows.select("tree", "block", "idx", "width", "doc_id", "leaf", "claimed")
    of_id = dict(slim.dtypes)["doc_id"]
    return slim.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(
        _prove(manifest.n_sources, manifest.root),
        f"doc_id {of_id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def leaves_of(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """The slim table of ``docs``: source, doc_id, leaf, claimed; texts are read once and go no further.

    A null field counts as absent, an empty one does not.  Other columns are not read.
    """
    none = F.lit(None).cast("binary")
    return written(docs.select("source", "doc_id", leaf_digest().alias("leaf"), (none if claimed is None else claimed).alias("claimed")),
                   "merkle-slim")


def op11_merkle_multiproof(spark, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)) & F.col("text").contains("\n")
    tampered = F.when(hit, leaf_digest(text=F.replace("text", F.lit("\n"), F.lit(""))))
    return prove(build(leaves_of(docs, tampered)))


OP11_SQL = r"""
WITH RECURSIVE f AS (
  SELECT doc_id, source, text, CAST(doc_id AS VARCHAR) AS i, 
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM documents),
crc AS (
  SELECT DISTINCT i, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 8 * len(i) + 1),
    lambda k: CASE WHEN k % 8 = 1 THEN 256 + CAST(ascii(i[(k - 1) // 8 + 1]) AS BIGINT) ELSE 0 END)),
    lambda c, b: CASE WHEN xor(c, b & 255) & 1 = 1 THEN xor(xor(c, b & 255) >> 1, 3988292384) ELSE xor(c, b & 255) >> 1 END), 4294967295) AS crc
  FROM f),
l AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS width,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc.crc % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
              ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
  FROM f LEFT JOIN crc USING (i)),
src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) AS tree, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM l)),
own AS (
  SELECT tree, 0 AS level, idx, width, leaf AS digest FROM l JOIN src ON l.source IS NOT DISTINCT FROM src.source
  UNION ALL
  SELECT tree, level + 1, idx // 3, (width + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM own WHERE width > 1
  GROUP BY tree, level, idx // 3, width),
top AS (
  SELECT 0 AS level, tree - 1 AS idx, n AS width, digest FROM own JOIN src USING (tree) WHERE width = 1
  UNION ALL
  SELECT level + 1, idx // 3, (width + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE width > 1
  GROUP BY level, idx // 3, width),
nodes AS (
  SELECT tree, level, idx, width, digest FROM own
  UNION ALL SELECT 0, level, idx, width, digest FROM top),
h AS (SELECT tree, max(level) AS height FROM own GROUP BY tree),
fold AS (
  SELECT doc_id, tree AS own_tree, tree, 0 AS level, idx, width, claimed AS now, '' AS siblings
  FROM l JOIN src ON l.source IS NOT DISTINCT FROM src.source
  UNION ALL
  SELECT doc_id, own_tree, tree, level, idx, width, now, siblings FROM (
    SELECT f.doc_id, f.own_tree, f.tree, f.level + 1 AS level, f.idx // 3 AS idx, (f.width + 2) // 3 AS width,
           sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.now ELSE n.digest END, '' ORDER BY n.idx)) AS now,
           f.siblings || coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx <> f.idx), '') AS siblings
    FROM fold f JOIN nodes n ON n.tree = f.tree AND n.level = f.level AND n.idx // 3 = f.idx // 3
    WHERE f.width > 1 GROUP BY f.doc_id, f.own_tree, f.tree, f.level, f.idx, f.width, f.siblings, f.now
    UNION ALL
    SELECT f.doc_id, f.own_tree, 0, 0, f.own_tree - 1, src.n, f.now, f.siblings
    FROM fold f JOIN src ON src.tree = f.own_tree WHERE f.width = 1 AND f.tree > 0)),
ends AS (SELECT doc_id, now, siblings FROM fold WHERE tree = 0 AND width = 1),
subroot AS (SELECT tree, digest AS subroot FROM own WHERE width = 1),
root AS (SELECT digest AS root FROM top WHERE width = 1)
SELECT l.doc_id, l.leaf, subroot, root, sha256(siblings) AS proof_sha256, now AS folded_root, now = root AS verified
FROM l JOIN src ON l.source IS NOT DISTINCT FROM src.source JOIN subroot USING (tree) JOIN ends USING (doc_id), root
"""
