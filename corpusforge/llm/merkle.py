"""Merkle dataset manifest with proofs (operator 12): a SHA midstate tree.

1. A leaf is the SHA-256 of a document's fields; the leaves of a group ascend by key.  Every
   ``arity`` consecutive nodes have one parent, the hash of their hex digests; the last run may be
   shorter, and a group ends with one node, its subroot.  Subroots in order of their group (null
   first) are the leaves of one more tree with the same rule, which ends with the root.
2. A tree is built in blocks of ``arity ** k`` consecutive nodes (``BLOCK`` at most): one task reads
   a block sorted, whatever the group's size, and yields the top ``k`` levels above; the tops are
   the nodes of the next round, so the rounds are the logarithm of the largest group to that base.
3. Going down, every block gets its path: the siblings left and right of it on each level above,
   and the tops (subroot and root).  The path travels as one more row of the block's stream.
4. In a block the parents keep a copy of their hash state before each child slot.  To fold a leaf,
   the matching state is resumed with the replacement and the right siblings alone: what is left of
   the slot is never hashed again.  The states of the path above are made once a block.

Digests are lower-case hex in all inputs of a hash.  Defined cases: null fields are ``-``; a null
key comes first and is never replaced by a rule on it; rows of one key are ordered by leaf; a null
group is a group of its own; a lone leaf is its subroot, and a lone subroot the root, with an empty
proof; an empty table gives an empty result; only the named fields are read, so extra columns and
their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import materialise, positions

BLOCK = 4096
_SIBLINGS = "array<struct<left:string,right:string>>"


def encode_field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encode_field(c) for c in fields]), 256)


def block_size(arity: int) -> tuple[int, int]:
    """Largest power of ``arity`` up to :data:`BLOCK` (at least ``arity``) and its exponent."""
    if arity < 2:
        raise ValueError("arity must be at least 2")
    k = 1
    while arity ** (k + 1) <= BLOCK:
        k += 1
    return arity ** k, k


class Parent:
    """A parent's children and the hash states before each of their slots."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[str]):
        self.children, self.states = children, []
        h = sha256()
        for c in children:
            self.states.append(h.copy())
            h.update(c.encode())
        self.digest = h.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        """The digest with ``replacement`` in ``slot``."""
        h = self.states[slot].copy()
        h.update(replacement.encode())
        for c in self.children[slot + 1:]:
            h.update(c.encode())
        return h.hexdigest()

    def siblings(self, slot: int) -> tuple[str, str]:
        return "".join(self.children[:slot]), "".join(self.children[slot + 1:])


def build(digests: list[str], arity: int, levels: int, sole: bool) -> list[list[Parent]]:
    """Parents by level, from the lowest: ``levels`` of them, or up to one node where ``sole``."""
    out: list[list[Parent]] = []
    while len(out) < levels and not (sole and len(digests) == 1):
        out.append([Parent(digests[i:i + arity]) for i in range(0, len(digests), arity)])
        digests = [p.digest for p in out[-1]]
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int):
    """``(group, block number, path row or None, node rows)`` of a stream sorted by group, block and
    place; rows are dictionaries.  A group whose first block isn't full has no other one."""
    def rows():
        for batch in batches:
            yield from batch.to_pylist()
    for (group, block), members in groupby(rows(), key=lambda r: (r["g"], r["b"])):
        nodes = list(members)                                   # one block
        path = nodes.pop(0) if nodes[0]["pos"] < 0 else None
        if nodes:
            yield group, block, path, nodes, block == 0 and len(nodes) < size


def _dealt(nodes: DataFrame, size: int, paths: DataFrame | None = None) -> DataFrame:
    """Nodes, and the path of their block in front of them, in blocks."""
    rows = nodes.withColumn("b", F.expr(f"pos div {size}"))
    if paths is not None:
        rows = rows.unionByName(paths.select("g", F.col("pos").alias("b"), F.lit(-1).cast("long").alias("pos"),
                                             "path", "tops"), allowMissingColumns=True)
    return rows.repartition("g", "b").sortWithinPartitions("g", "b", "pos")


def _tops(nodes: DataFrame, arity: int) -> DataFrame:
    """``(g, pos, digest)``: the tops of the blocks of ``nodes(g, pos, digest)``."""
    size, k = block_size(arity)

    def run(batches):
        out = []
        for g, b, _, rows, sole in _blocks(batches, size):
            levels = build([r["digest"] for r in rows], arity, k, sole)
            out.append({"g": g, "pos": b, "digest": levels[-1][0].digest if levels else rows[0]["digest"]})
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=schema)
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("digest", pa.string())])
    return _dealt(nodes.select("g", "pos", "digest"), size).mapInArrow(run, "g string, pos long, digest string")


def _in_block(levels: list[list[Parent]], at: int, arity: int):
    """``(parent, slot)`` of the node ``at``, by level."""
    for parents in levels:
        at, slot = divmod(at, arity)
        yield parents[at], slot


def _descend(nodes: DataFrame, paths: DataFrame, arity: int) -> DataFrame:
    """``(g, pos, path, tops)`` of every node, given those of the blocks' tops."""
    size, k = block_size(arity)
    kinds = pa.schema([("g", pa.string()), ("pos", pa.int64()),
                       ("path", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
                       ("tops", pa.list_(pa.string()))])

    def run(batches):
        for g, _, path, rows, sole in _blocks(batches, size):
            levels = build([r["digest"] for r in rows], arity, k, sole)
            out = []
            for i, r in enumerate(rows):
                own = [dict(zip(("left", "right"), p.siblings(s))) for p, s in _in_block(levels, i, arity)]
                out.append({"g": g, "pos": r["pos"], "path": own + path["path"], "tops": path["tops"]})
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
    return _dealt(nodes.select("g", "pos", "digest"), size, paths).mapInArrow(
        run, f"g string, pos long, path {_SIBLINGS}, tops array<string>")


def _rounds(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """The leaves and the tops of every round; the last has one node a group."""
    levels = [leaves]
    while True:
        levels.append(materialise(_tops(levels[-1], arity)))
        if levels[-1].where("pos > 0").isEmpty():
            return levels


def _block_paths(levels: list[DataFrame], top: DataFrame, arity: int) -> DataFrame:
    """Paths of the leaves' blocks, given those of the groups' last nodes."""
    paths = top
    for i in range(len(levels) - 2, 0, -1):
        paths = materialise(_descend(levels[i], paths, arity))
    return paths


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "lang", arity: int = 2,
             replace: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """One row a document: ``key``, ``leaf``, ``subroot``, ``root``, ``proof`` (array of the siblings'
    digests, level by level to the root, left to right), ``replaced`` (the leaf was recomputed from
    the values of ``replace``), ``folded_root`` and ``verified``.

    ``replace`` gives new values for some fields, for the rows of ``where``: their leaf is recomputed
    from them and folded up to the root with the original siblings, as every other row's leaf is.
    """
    size, k = block_size(arity)
    new = replace or {}
    own = leaf_hash([F.col(f"`{c}`") for c in fields])
    other = leaf_hash([new.get(c, F.col(f"`{c}`")) for c in fields])
    change = F.lit(False) if where is None else F.coalesce(where, F.lit(False))
    hashed = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{group}`").cast("string").alias("g"),
                         own.alias("digest"), F.when(change, other).alias("other"))
    # written: the sort samples its keys, the texts are hashed once
    leaves = positions(materialise(hashed), ["g"], [F.col("k").asc_nulls_first(), F.col("digest").asc()])
    leaves = materialise(leaves)
    levels = _rounds(leaves, arity)

    groups = positions(levels[-1].select(F.lit("").alias("g"), F.col("g").alias("lang"), "digest"), ["g"],
                       [F.col("lang").asc_nulls_first()])
    groups = materialise(groups)
    upper = _rounds(groups.select("g", "pos", "digest"), arity)
    none = F.array().cast(_SIBLINGS)
    top = upper[-1].select("g", "pos", none.alias("path"), F.array("digest").alias("tops"))
    by_group = _descend(upper[0], _block_paths(upper, top, arity), arity).select("pos", "path", "tops")
    top = materialise(groups.join(by_group, "pos").select(
        F.col("lang").alias("g"), F.lit(0).cast("long").alias("pos"), "path",
        F.concat(F.array("digest"), "tops").alias("tops")))
    paths = _block_paths(levels, top, arity)

    kinds = pa.schema([(key, pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                       ("proof", pa.list_(pa.string())), ("replaced", pa.bool_()), ("folded_root", pa.string()),
                       ("verified", pa.bool_())])

    def run(batches):
        for _, _, path, rows, sole in _blocks(batches, size):
            built = build([r["digest"] for r in rows], arity, k, sole)
            above, tail = [], []
            for step in path["path"]:
                h = sha256(step["left"].encode())
                above.append((h, step["right"].encode()))
                tail += _digests(step["left"]) + _digests(step["right"])
            subroot, root = path["tops"]
            out = []
            for i, r in enumerate(rows):
                value, proof = r["other"] or r["digest"], []
                for parent, slot in _in_block(built, i, arity):
                    value = parent.fold(slot, value)
                    proof += parent.children[:slot] + parent.children[slot + 1:]
                for state, right in above:
                    h = state.copy()
                    h.update(value.encode())
                    h.update(right)
                    value = h.hexdigest()
                out.append({key: r["k"], "leaf": r["digest"], "subroot": subroot, "root": root, "proof": proof + tail,
                            "replaced": r["other"] is not None, "folded_root": value, "verified": value == root})
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_pylist(out, schema=kinds)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=kinds)
    return _dealt(leaves, size, paths).mapInArrow(
        run, f"`{key}` long, leaf string, subroot string, root string, proof array<string>, replaced boolean, "
             "folded_root string, verified boolean")


def _digests(joined: str) -> list[str]:
    return [joined[i:i + 64] for i in range(0, len(joined), 64)]


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` under the tampering rule: where 7 divides the CRC-32 of the
    decimal id, one is added to ``n_chars``."""
    more = (F.col("n_chars").cast("decimal(20,0)") + F.lit(1)).cast("string")
    rule = (F.crc32(F.col("doc_id").cast("long").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull()
    return manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], replace={"n_chars": more}, where=rule)
