"""A Merkle manifest of a dataset, with a proof and a tamper check per row.

Leaves are hashed in the JVM, sorted by (source, id) and numbered inside their
source.  A tree joins three consecutive nodes per level; every round of
:func:`climb` takes blocks of consecutive nodes, seven levels at a time, so a tree of any size takes a handful of shuffles of digests and a block is
one bounded group, however many rows a source holds.  The roots of the sources are
the leaves of one more such tree.

Inside a block the parents are hashed with SHA-256 objects, and a copy of the
state *before each child slot* is kept.  A changed leaf is folded by resuming the
copy of its own slot with the replacement and the siblings to the right; nothing
to the left is hashed again.  Above the block, the states before the slot are made
once per block from the siblings to the left, and each row resumes a copy of them.

Defined results: a null in a field is hashed as ``-``; a null id sorts first and
is not tampered with; a null source is a source of its own, before the others;
rows alike in id stand in the order of their leaf digests; repeated rows are
leaves of their own; the proof of a row without any siblings is the hash of
nothing; an empty table gives no rows.  Only the named fields are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import add_row_id
from .common import join_null_safe, load, stored

#: Children of a node; levels that one round joins, so a block has ARITY ** LEVELS nodes.
ARITY, LEVELS = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = ("subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def leaves(docs: DataFrame, tampered: "Column | None" = None, fields=FIELDS, text: str = "text") -> DataFrame:
    """(id, source, leaf, tampered): digests of every row; ``tampered`` is the
    text put in place of the own one (null: as it was), and its digest is null
    where nothing changes.  The id is the first field, the source the second."""
    cols = [F.col(f) for f in fields]
    other = [tampered if f == text else c for f, c in zip(fields, cols)]
    changed = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf(other))
    return docs.select(F.col(fields[0]).alias("id"), F.col(fields[1]).cast("string").alias("source"),
                       leaf(cols).alias("leaf"), changed.alias("tampered"))


def levels_of(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Block:
    """The subtree over consecutive nodes: the digests of each level, and for
    each child the state of its parent's hash before the child's slot."""

    def __init__(self, digests: list[str], levels: int):
        self.rows, self.states = [digests], []
        for _ in range(levels):
            above, states, state = [], [], None
            for k, digest in enumerate(self.rows[-1]):
                if k % ARITY == 0:
                    if state is not None:
                        above.append(state.hexdigest())
                    state = hashlib.sha256()
                states.append(state.copy())
                state.update(digest.encode())
            above.append(state.hexdigest())
            self.states.append(states)
            self.rows.append(above)

    @property
    def root(self) -> str:
        return self.rows[-1][0]

    def siblings(self, k: int) -> Iterator[tuple[list[str], list[str]]]:
        """Level by level, the siblings to the left and to the right."""
        for row in self.rows[:-1]:
            first = k - k % ARITY
            yield row[first:k], row[k + 1:first + ARITY]
            k //= ARITY

    def fold(self, k: int, digest: str) -> str:
        """The root with ``digest`` in slot ``k``: resumed states only."""
        for row, states in zip(self.rows, self.states):
            state = states[k].copy()
            state.update("".join([digest, *row[k + 1:k - k % ARITY + ARITY]]).encode())
            digest, k = state.hexdigest(), k // ARITY
        return digest


def _block(table: pa.Table, digest: str, levels: int) -> tuple[pa.Table, Block]:
    table = table.sort_by("pos")
    return table, Block(table[digest].to_pylist(), min(levels, levels_of(table["n"][0].as_py())))


def _of_block(levels: int) -> Column:
    return F.expr(f"pos div {ARITY ** levels}").alias("block")


def _written(path: list[tuple[list[str], list[str]]]) -> str:
    return ";".join(f"{','.join(left)}|{','.join(right)}" for left, right in path)


def _read(path: str) -> list[tuple[list[str], list[str]]]:
    sides = lambda s: s.split(",") if s else []
    return [tuple(map(sides, level.split("|"))) for level in path.split(";")] if path else []


def climb(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One round: nodes (tree, n, pos, digest) -> the roots of their blocks as
    nodes of the next round; ``n`` counts the nodes of the tree."""

    size = ARITY ** levels

    def up(table: pa.Table) -> pa.Table:
        table, block = _block(table, "digest", levels)
        tree, n, pos = (table[c][0].as_py() for c in ("tree", "n", "pos"))
        return pa.table({"tree": [tree], "n": [-(-n // size)], "pos": [pos // size], "digest": [block.root]})

    return nodes.groupBy("tree", _of_block(levels)) \
                .applyInArrow(up, "tree long, n long, pos long, digest string")


def rounds(nodes: DataFrame, most: int, tag: str, levels: int = LEVELS) -> list[DataFrame]:
    """The tables of all rounds, the first the given one, the last with one
    node per tree; ``most`` is the size of the largest tree."""
    tables = [nodes]
    while most > 1:
        tables.append(stored(climb(tables[-1].select("tree", "n", "pos", "digest"), levels), tag))
        most = -(-most // ARITY ** levels)
    return tables


def descend(nodes: DataFrame, paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Paths (tree, pos, path, subroot, root) of the blocks -> those of the
    nodes in them; a path lists the siblings of each level up to the root."""

    def down(table: pa.Table, above: pa.Table) -> pa.Table:
        table, block = _block(table, "digest", levels)
        rest, subroot, root = (above[c][0].as_py() for c in ("path", "subroot", "root"))
        own = [_written(list(block.siblings(k))) for k in range(len(table))]
        return pa.table({"tree": table["tree"], "pos": table["pos"], "path": [";".join(filter(None, (p, rest))) for p in own],
                         "subroot": pa.array([subroot] * len(own), pa.string()), "root": pa.array([root] * len(own), pa.string())})

    return nodes.groupBy("tree", _of_block(levels)) \
                .cogroup(paths.groupBy("tree", F.col("pos").alias("block"))) \
                .applyInArrow(down, "tree long, pos long, path string, subroot string, root string")


def fold(nodes: DataFrame, paths: DataFrame, id_type: str, levels: int = LEVELS) -> DataFrame:
    """Leaves (tree, n, pos, id, leaf, tampered) with the paths of their blocks
    -> per leaf its proof, and the root folded from the tampered leaf (else the
    own one) and the siblings as they were."""

    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        table, block = _block(table, "leaf", levels)
        subroot, root = above["subroot"][0].as_py(), above["root"][0].as_py()
        path = _read(above["path"][0].as_py())
        rest = "".join(d for level in path for side in level for d in side).encode()
        states = [(hashlib.sha256("".join(left).encode()), "".join(right)) for left, right in path]
        proof, folded = [], []
        for k, (own, other) in enumerate(zip(table["leaf"].to_pylist(), table["tampered"].to_pylist())):
            siblings = "".join(d for level in block.siblings(k) for side in level for d in side)
            proof.append(hashlib.sha256(siblings.encode() + rest).hexdigest())
            digest = block.fold(k, own if other is None else other)
            for before, right in states:
                state = before.copy()
                state.update((digest + right).encode())
                digest = state.hexdigest()
            folded.append(digest)
        size = len(table)
        return pa.table({"id": table["id"], "leaf": table["leaf"], "subroot": [subroot] * size, "root": [root] * size,
                         "proof_sha256": proof, "folded_root": folded, "verified": [d == root for d in folded]})

    return nodes.groupBy("tree", _of_block(levels)) \
                .cogroup(paths.groupBy("tree", F.col("pos").alias("block"))) \
                .applyInArrow(proofs, f"id {id_type}, leaf string, {PROOF}")


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Leaves as from :func:`leaves` -> (id, leaf, subroot, root, proof_sha256,
    folded_root, verified) per row."""
    # rows alike are told apart by their turn, so a hot one is no single range
    rows = stored(rows.withColumn("turn", F.monotonically_increasing_id()), "merkle-leaves")
    placed = add_row_id(rows, ["source", "id", "leaf", "turn"], name="at")
    sources = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("base"))
    sources = stored(add_row_id(sources, ["base"], name="tree"), "merkle-sources")
    n_sources, most = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    nodes = stored(join_null_safe(placed, sources, ["source"])
                   .select("tree", "n", (F.col("at") - F.col("base")).alias("pos"), "id", "leaf", "tampered"), "merkle-nodes")
    trees = rounds(nodes.withColumnRenamed("leaf", "digest"), most, "merkle-round", levels)
    tops = trees[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(n_sources).cast("long").alias("n"),
                            F.col("tree").alias("pos"), "digest")
    above = rounds(tops, n_sources, "merkle-top", levels)
    paths = above[-1].select("tree", "pos", F.lit("").alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    for table in above[-2::-1]:
        paths = descend(table, paths, levels)
    paths = paths.drop("subroot").join(tops.select("pos", F.col("digest").alias("subroot")), "pos") \
                 .select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
    for table in trees[-2:0:-1]:
        paths = descend(table, paths, levels)
    return fold(nodes, stored(paths, "merkle-paths"), rows.schema["id"].dataType.simpleString(), levels)


def op13_merkle(spark, sf_dir: str, levels: int = LEVELS) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    # only texts that the tampering changes are hashed again
    tampered = F.when(even & F.contains("text", F.lit("\n")), F.replace("text", F.lit("\n"), F.lit("")))
    return manifest(leaves(docs, tampered), levels).withColumnRenamed("id", "doc_id")


def oracle_sql(levels: int = 16, top: int = 10) -> str:
    """The same by plain joins, a query per level: trees of up to 3^levels rows a
    source and 3^top sources."""
    value = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    digest = lambda text: "sha256(" + " || ".join(value(text if f == "text" else f) for f in FIELDS) + ")"
    parts = [f"""turned AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS c FROM range(256) r(i)))""",
             f"""leaf AS MATERIALIZED (SELECT doc_id, source, {digest('text')} AS leaf, CASE WHEN xor(4294967295, list_reduce(list_concat([4294967295],
   list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
   lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]))) % 2 = 0 THEN {digest("replace(text, chr(10), '')")} END AS tampered FROM documents, turned)""",
             """f0 AS MATERIALIZED (SELECT *, coalesce(tampered, leaf) AS folded, '' AS proof, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaf)""",
             "l0 AS MATERIALIZED (SELECT tree, pos, n, leaf AS digest FROM f0)"]

    def tree(rows: str, nodes: str, k: int, keep: str) -> list[str]:
        left, right = (" || ".join(f"CASE WHEN {s}.pos {side} f.pos THEN {s}.digest ELSE '' END" for s in "abc") for side in "<>")
        joins = " ".join(f"LEFT JOIN {nodes}{k} {s} ON {s}.tree = f.tree AND {s}.pos = f.pos // 3 * 3 + {i}" for i, s in enumerate("abc"))
        return [f"""{nodes}{k + 1} AS MATERIALIZED (SELECT tree, pos // 3 AS pos, (n + 2) // 3 AS n,
  CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest FROM {nodes}{k} GROUP BY tree, pos // 3, n)""",
                f"""{rows}{k + 1} AS MATERIALIZED (SELECT {keep}, f.tree, f.pos // 3 AS pos, (f.n + 2) // 3 AS n,
  CASE WHEN f.n = 1 THEN folded ELSE sha256({left} || folded || {right}) END AS folded,
  CASE WHEN f.n = 1 THEN proof ELSE proof || {left} || {right} END AS proof FROM {rows}{k} f {joins})"""]

    for k in range(levels):
        parts += tree("f", "l", k, "doc_id, leaf")
    parts += [f"t0 AS MATERIALIZED (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, digest FROM l{levels})",
              f"""g0 AS MATERIALIZED (SELECT doc_id, leaf, folded, proof, s.digest AS subroot, 0 AS tree, s.pos, s.n
  FROM f{levels} f JOIN t0 s ON s.pos = f.tree)"""]
    for k in range(top):
        parts += tree("g", "t", k, "doc_id, leaf, subroot")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM g{top}, (SELECT digest FROM t{top})""")
