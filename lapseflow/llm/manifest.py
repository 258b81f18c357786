"""A Merkle manifest of a dataset whose parents retain SHA-256 midstates.

Every row is a leaf. Per source, leaves in order of their ids are hashed in runs of three, level by level,
up to the source's subroot, and the subroots likewise up to the root. A parent keeps a copy of its
hash state before each child slot: to prove another leaf, folding resumes the state of the leaf's slot
and feeds it the replacement and the siblings to its right only, never those before it.

Spark numbers the leaves of each source by a range partitioning, and gathers them in blocks of
complete subtrees, which bound what a task holds however many rows a source has. The tops of the
blocks are the nodes of the next round. On the way back each block gets the path above it, so that
proofs and folds of all leaves are made block by block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lapseflow.llm.labelled import remainder
from lapseflow.llm.registry import query, table
from lapseflow.operators.joins import is_small
from lapseflow.session import stored

#: Children of a parent.
RUN = 3
#: Levels of a block: it holds at most RUN ** LEVELS nodes.
LEVELS = 6
#: What a leaf commits to, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256, as lowercase hex, of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(
        F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256
    )


def tree_name(column: str) -> Column:
    """A name for each value of a column, null included, in the order null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


class Subtree:
    """Levels of parents above some nodes; each parent retains its hash state before every child.

    ``levels``: that many, or as many as it takes to one node. Digests are hex, as bytes.
    """

    def __init__(self, digests: list[bytes], levels: int | None) -> None:
        self.levels: list[tuple[list[bytes], list]] = []
        while len(self.levels) < levels if levels is not None else len(digests) > 1:
            states, above = [], []
            for low in range(0, len(digests), RUN):
                state = sha256()
                for child in digests[low : low + RUN]:
                    states.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.levels.append((digests, states))
            digests = above
        self.top = digests[0]

    def fold(self, at: int, digest: bytes) -> bytes:
        """The top if node ``at`` were ``digest``."""
        for digests, states in self.levels:
            state = states[at].copy()
            state.update(digest)
            for right in digests[at + 1 : at - at % RUN + RUN]:
                state.update(right)
            digest = state.hexdigest().encode()
            at //= RUN
        return digest

    def path(self, at: int) -> list[tuple[bytes, bytes]]:
        """The siblings left and right of node ``at``, level by level."""
        found = []
        for digests, _ in self.levels:
            low = at - at % RUN
            found.append((b"".join(digests[low:at]), b"".join(digests[at + 1 : low + RUN])))
            at //= RUN
        return found


def _levels(block: int, nodes: int, depth: int) -> int | None:
    # A block that isn't full is the last one of its tree; as the first one it is the whole tree.
    return None if block == 0 and nodes < RUN**depth else depth


def _blocks(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[int, Subtree, dict[str, list]]]:
    """Row, subtree and the items' columns of each block of a batch."""
    numbers = batch.column("block").to_pylist()
    items = batch.column("items")
    for i, number in enumerate(numbers):
        own = items[i].values
        found = {f.name: own.field(k).to_pylist() for k, f in enumerate(own.type)}
        yield i, Subtree([d.hex().encode() for d in found["digest"]], _levels(number, len(own), depth)), found


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Nodes of any number of trees with their ``position`` in the ``tree``, from 0.

    One shuffle by ranges. Each range counts on its own; only the tree it begins with may have begun
    before, so the numbers to add are at most one per range. Rows equal in all of ``order``
    are spread over ranges as well.
    """
    by = ["tree", *order, "_tie"]
    dealt = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, position = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            places = []
            for name in batch.column("tree").to_pylist():
                position = position + 1 if name == tree else 0
                tree = name
                places.append(position)
            columns = [*batch.columns, pa.array([part] * len(batch), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "position"])

    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    counted = stored(dealt.mapInArrow(count, f"{layout}, part int, position bigint"), "numbered")
    sizes = counted.groupBy("tree", "part").agg((F.max("position") + 1).alias("n"))
    before = F.sum("n").over(W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    # At most one row per range.
    offsets = sizes.select("tree", "part", before.alias("offset")).where("offset > 0")
    shifted = (F.col("position") + F.coalesce("offset", F.lit(0))).alias("position")
    return counted.join(F.broadcast(offsets), ["tree", "part"], "left").select(*nodes.columns, shifted)


def _raised(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes (tree, position, digest and more) in blocks (tree, block, items, top)."""
    items = F.struct("position", *[c for c in nodes.columns if c not in ("tree", "position")])
    block = F.expr(f"position div {RUN**depth}").alias("block")
    blocks = nodes.groupBy("tree", block).agg(F.sort_array(F.collect_list(items)).alias("items"))

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [bytes.fromhex(s.top.decode()) for _, s, _ in _blocks(batch, depth)]
            yield batch.append_column("top", pa.array(tops, pa.binary()))

    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema)
    return stored(blocks.mapInArrow(top, f"{layout}, top binary"), "blocks")


def climbed(nodes: DataFrame, depth: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, from the leaves up, and the top (tree, digest) of each tree."""
    rounds = []
    while True:
        rounds.append(_raised(nodes, depth))
        nodes = rounds[-1].select("tree", F.col("block").alias("position"), F.col("top").alias("digest"))
        if nodes.where("position > 0").isEmpty():
            return rounds, nodes.select("tree", "digest")


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    # Blocks are wide and paths narrow: the blocks stay if the paths are measured as small.
    return blocks.join(F.broadcast(paths) if is_small(paths) else paths, ["tree", "block"])


def _paths(subtree: Subtree, n: int, above: list[dict]) -> pa.Array:
    """The paths from a block's nodes to the root, as Spark's arrays of structs."""
    own = [[{"left": a.decode(), "right": b.decode()} for a, b in subtree.path(k)] + above for k in range(n)]
    return pa.array(own, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))


def lowered(rounds: list[DataFrame], paths: DataFrame, depth: int = LEVELS) -> DataFrame:
    """The lowest blocks with the path above each; ``paths`` (tree, path, more) are above the trees' tops."""
    more = [c for c in paths.columns if c not in ("tree", "path")]
    paths = paths.select("tree", F.lit(0).cast("bigint").alias("block"), "path", *more)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = batch.column("path").to_pylist()
            for i, subtree, items in _blocks(batch, depth):
                n = len(items["position"])
                same = [batch.column(c).take(pa.array([i] * n)) for c in ("tree", *more)]
                columns = [same[0], pa.array(items["position"], pa.int64()), _paths(subtree, n, above[i]), *same[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "block", "path", *more])

    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in paths.schema)
    for blocks in rounds[:0:-1]:
        paths = stored(_with_paths(blocks, paths).mapInArrow(descend, layout), "paths")
    return _with_paths(rounds[0], paths)


def proven(leaves: DataFrame, depth: int = LEVELS) -> DataFrame:
    """Proofs of all leaves, and the roots that their replacements fold to.

    ``leaves``: tree (not null), key, digest, and ``replacement`` (null: the leaf itself), digests as
    binary. Within a tree they stand by key, null first, then by digest. Returns key, leaf, subroot, root,
    proof_sha256, folded_root and verified, one row per leaf; an empty table gives an empty one.
    """
    rounds, tops = climbed(numbered(leaves, ["key", "digest"]), depth)
    named = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    above, roots = climbed(numbered(named, ["name"]), depth)
    root = roots.first()
    # The path of a tree's top ends at the root.
    start = roots.select("tree", F.array().cast(_PATH).alias("path"))
    top_blocks = lowered(above, start, depth)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = batch.column("path").to_pylist()
            for i, subtree, items in _blocks(batch, depth):
                digests = [x.hex() for x in items["digest"]]
                columns = [pa.array(items["name"], pa.string()), _paths(subtree, len(digests), above[i]), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "path", "subroot"])

    paths = stored(top_blocks.mapInArrow(name, f"tree string, path {_PATH}, subroot string"), "paths")
    key = leaves.schema["key"].dataType.simpleString()
    found = lowered(rounds, paths, depth).mapInArrow(
        partial(_prove, depth=depth), f"key {key}, leaf string, subroot string, proof_sha256 string, folded_root string"
    )
    known = F.lit(root["digest"].hex() if root else None).cast("string")
    return found.select(
        "key", "leaf", "subroot", known.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == known).alias("verified")
    )


def _prove(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        subroots = batch.column("subroot").to_pylist()
        paths = batch.column("path").to_pylist()
        key_kind = batch.schema.field("items").type.value_type.field("key").type
        for i, subtree, items in _blocks(batch, depth):
            # Above the block all leaves share their siblings: one retained state per level.
            upper = [(sha256(p["left"].encode()), p["right"].encode()) for p in paths[i]]
            shared = "".join(p["left"] + p["right"] for p in paths[i]).encode()
            proofs, folds = [], []
            for k, (digest, replacement) in enumerate(zip(items["digest"], items["replacement"], strict=True)):
                proof = sha256(b"".join(a + b for a, b in subtree.path(k)))
                proof.update(shared)
                proofs.append(proof.hexdigest())
                folded = subtree.fold(k, (replacement or digest).hex().encode())
                for left, right in upper:
                    state = left.copy()
                    state.update(folded)
                    state.update(right)
                    folded = state.hexdigest().encode()
                folds.append(folded.decode())
            n = len(proofs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items["key"], key_kind), pa.array([d.hex() for d in items["digest"]]), pa.array([subroots[i]] * n, pa.string()), pa.array(proofs), pa.array(folds)],
                names=["key", "leaf", "subroot", "proof_sha256", "folded_root"],
            )


def merkle_manifest(
    docs: DataFrame,
    replaced: dict[str, Column] | None = None,
    tree: str = "source",
    key: str = "doc_id",
    fields: Sequence[str] = FIELDS,
    depth: int = LEVELS,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``replaced``: what some of the fields are taken to be when the proof is checked; without, every
    row verifies. ``depth``: levels of a block. A null in any field is part of the leaf; a null ``tree`` is a tree of its own and
    stands first. Rows with a null key come first in their tree, rows that share a key in the order of their
    leaves, equal rows in any order: each has a place and a proof of its own. Empty texts and very
    long ones are hashed whole, in the JVM; other columns don't matter. An empty table gives an empty result.
    """
    other = replaced or {}
    leaf = leaf_digest([F.col(c) for c in fields])
    seen = leaf_digest([other.get(c, F.col(c)) for c in fields])
    leaves = docs.select(
        tree_name(tree).alias("tree"),
        F.col(key).alias("key"),
        F.unhex(leaf).alias("digest"),
        (F.unhex(F.when(_differs(other), seen)) if other else F.lit(None).cast("binary")).alias("replacement"),
    )
    return proven(stored(leaves, "leaves"), depth).withColumnRenamed("key", key)


def _differs(other: dict[str, Column]) -> Column:
    """Whether any replaced field has another value, so that the others' texts aren't hashed twice."""
    found = F.lit(False)
    for name, value in other.items():
        found = found | ~F.col(name).eqNullSafe(value)
    return found


#: CRC-32 of a text of digits, step by step over its characters.
_CRC = """
xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc_table.steps[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""


def _record(text: str) -> str:
    values = [f"CAST({c} AS VARCHAR)" for c in FIELDS[:-1]] + [text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"


_SQL = f"""
WITH RECURSIVE
crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS steps
),
leaves AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_record("text")} AS leaf,
           CASE WHEN doc_id IS NOT NULL AND {_CRC} % 2 = 0 THEN {_record("replace(text, chr(10), '')")} ELSE {_record("text")} END AS seen
    FROM documents, crc_table
),
placed AS (
    SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS id,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
),
nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS digest, n FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3, n
),
subroots AS (
    SELECT tree, digest AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
),
tops AS (
    SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY level, pos // 3, n
),
runs AS (SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, pos // 3 AS run, list(digest ORDER BY pos) AS digests FROM tops WHERE n > 1 GROUP BY ALL),
folds AS (
    SELECT id, tree, 0 AS level, pos, seen AS digest, '' AS proof FROM placed
    UNION ALL
    SELECT id, f.tree, f.level + 1, pos // 3,
           sha256(array_to_string(digests[1:pos % 3], '') || digest || array_to_string(digests[pos % 3 + 2:], '')),
           proof || array_to_string(digests[1:pos % 3], '') || array_to_string(digests[pos % 3 + 2:], '')
    FROM folds f JOIN runs r ON r.tree = f.tree AND r.level = f.level AND r.run = f.pos // 3
),
top_folds AS (
    SELECT id, 0 AS level, s.pos, f.digest, proof FROM folds f JOIN subroots s ON s.tree = f.tree AND s.height = f.level
    UNION ALL
    SELECT id, f.level + 1, pos // 3,
           sha256(array_to_string(digests[1:pos % 3], '') || digest || array_to_string(digests[pos % 3 + 2:], '')),
           proof || array_to_string(digests[1:pos % 3], '') || array_to_string(digests[pos % 3 + 2:], '')
    FROM top_folds f JOIN top_runs r ON r.level = f.level AND r.run = f.pos // 3
),
root AS (SELECT digest AS root, level AS height FROM tops WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.digest AS folded_root, f.digest = root AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN top_folds f ON f.id = p.id JOIN root ON root.height = f.level
"""


@query("op12_manifest", sql=_SQL)
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's proof, and the root its text without line breaks would give, for half of the ids."""
    docs = table(spark, folder, "documents")
    cut = F.when(remainder("doc_id", 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle_manifest(docs, {"text": cut})
