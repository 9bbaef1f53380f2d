"""Merkle manifest of a table by time-forward processing.

Every row is a leaf. The leaves of a group (a source) are in order of their id, and runs of
``FANOUT`` consecutive nodes become their parent until one node, the subroot, remains; the
subroots of all groups make one more tree in the same way.

Each node has a label: the place of the last leaf below it, then its level. In label order
children come before their parent, so a node sends its digest forward, to the label of its
parent, and a priority queue ordered by label hands a parent all its children's digests when its
turn comes. The queue is external: inside a block of ``FANOUT ** BLOCK_LEVELS`` leaves it is a
heap that never holds more than the open runs of each level, and a message that leaves its block
is a row of a written table, which Spark's sort brings in label order to the tier of blocks
above. So no task ever has more than a block of a hot group.

The reversed sweep goes through the tiers and labels backwards: a parent sends each child the
proof suffix that begins with the child's siblings, until every leaf has its whole proof.

Equal ids are ordered by digest, NULL ids and groups come first, and repeated rows are leaves of
their own. A NULL column is ``-`` in the digest, an empty text ``0:``. A text of any length is
hashed whole in the JVM and never leaves it. An empty table has no leaf, no root and no row.
Columns that are not named as fields count for nothing, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.session import saved

FANOUT = 3
#: Levels of a block: 3 ** 8 = 6561 leaves.
BLOCK_LEVELS = 8
#: Rows that one task puts in order.
SLOT_ROWS = 500_000
#: Rows in one Arrow batch of the output.
BATCH = 2_000


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(name: str, kind: str) -> Column:
    """``-`` for NULL, otherwise the number of UTF-8 bytes, a colon and the value."""
    value = F.col(name) if kind == "string" else F.col(name).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_digest(df: DataFrame, columns: Sequence[str], **instead: Column) -> Column:
    """Digest of a row's fields; ``instead`` has columns to take in place of stored ones."""
    kinds = dict(df.dtypes)
    parts = []
    for c in columns:
        if c in instead:
            value = instead[c]
            size = F.octet_length(value).cast("string")
            parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
        else:
            parts.append(field(c, kinds[c]))
    return F.sha2(F.concat(*parts), 256)


def placed(rows: DataFrame, group: str, order: Sequence[str], slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Add ``idx``, the place of a row in its group, and ``n``, the rows of the group.

    Range partitioning deals a hot group out to as many slots as it needs; rows that agree in
    the group and all of ``order`` are interchangeable and are dealt out too.
    """
    spark = rows.sparkSession
    stored = saved(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // slot_rows))
    by = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    dealt = saved(
        stored.repartitionByRange(slots, *by).withColumn("_slot", F.spark_partition_id()), "slots"
    )
    own = dealt.groupBy(group, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(own.select(
        F.col(group).alias("_group"), F.col("_slot").alias("_s"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"),
    ), "slot-starts")
    inside = Window.partitionBy("_slot", group).orderBy(*by[1:])
    numbered = dealt.withColumn("_at", F.row_number().over(inside) - 1)
    found = (F.col("_slot") == F.col("_s")) & F.col(group).eqNullSafe(F.col("_group"))
    return numbered.join(starts, found).withColumn("idx", F.col("_at") + F.col("_start")).drop(
        "_tie", "_slot", "_at", "_s", "_start", "_group"
    )


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


class Block:
    """The nodes of one block: some consecutive leaves and what stands above them in the block."""

    def __init__(self, leaves: int, levels: int):
        self.last, self.levels = leaves - 1, levels
        #: Digests of the children of each inner node, by label.
        self.children: dict[tuple[int, int], list[str]] = {}
        self.queue: list[tuple[tuple[int, int], int, str]] = []
        self.root: str | None = None

    def label(self, level: int, at: int) -> tuple[int, int]:
        return min((at + 1) * FANOUT ** level - 1, self.last), level

    def _send(self, level: int, at: int, value: str) -> None:
        """A finished node sends its digest to its parent's label."""
        if level == self.levels:
            self.root = value
        else:
            heapq.heappush(self.queue, (self.label(level + 1, at // FANOUT), at, value))

    def leaf(self, at: int, value: str) -> None:
        """Take the next leaf, and finish every node of which it is the last."""
        self._send(0, at, value)
        queue = self.queue
        while queue and queue[0][0][0] == at:
            label, first, value = heapq.heappop(queue)
            own = [value]
            while queue and queue[0][0] == label:
                own.append(heapq.heappop(queue)[2])
            self.children[label] = own
            self._send(label[1], first // FANOUT, digest("".join(own)))

    def proofs(self) -> Iterator[tuple[int, tuple | None]]:
        """The reversed sweep: (leaf, its proof inside the block), the last leaf first.

        A proof is (digests of the run before the node, those after it, the parent's proof).
        """
        queue = [((-self.last, -self.levels), 0, None)]
        while queue:
            (_, level), at, proof = heapq.heappop(queue)
            level = -level
            if not level:
                yield at, proof
                continue
            own = self.children[self.label(level, at)]
            for i in range(len(own)):
                child = at * FANOUT + i
                last, _ = self.label(level - 1, child)
                step = ("".join(own[:i]), "".join(own[i + 1:]), proof)
                heapq.heappush(queue, ((-last, 1 - level), child, step))


def fold(value: str, proof: tuple | None) -> str:
    """The root that a digest and its proof lead to."""
    while proof is not None:
        before, after, proof = proof
        value = digest(before + value + after)
    return value


def siblings(proof: tuple | None) -> str:
    """All digests of a proof, level by level."""
    parts = []
    while proof is not None:
        before, after, proof = proof
        parts += (before, after)
    return "".join(parts)


def written(proof: tuple | None) -> str:
    """A proof as text: ``before,after`` of each level, joined by ``/``."""
    parts = []
    while proof is not None:
        before, after, proof = proof
        parts.append(f"{before},{after}")
    return "/".join(parts)


def parsed(text: str) -> tuple | None:
    proof = None
    for level in reversed(text.split("/") if text else []):
        before, _, after = level.partition(",")
        proof = (before, after, proof)
    return proof


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema(*texts: str) -> tuple[pa.Schema, str]:
    """A row's group, place and texts, as Arrow and as Spark schema."""
    fields = [("grp", "string"), ("idx", "long"), *[(c, "string") for c in texts]]
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(c, kinds[k]) for c, k in fields]), ", ".join(f"{c} {k}" for c, k in fields)


def _rise(levels: int):
    """Sorted nodes of blocks to one row per block: its place in the tier above and its digest."""
    size = FANOUT ** levels
    schema = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, block = [], None
        for group, idx, n, value in _rows(batches):
            at = idx % size
            if not at:
                block = Block(min(size, n - idx), min(levels, height(n)))
            block.leaf(at, value)
            if at == block.last:
                out.append((group, idx // size, -(-n // size), block.root))
            if len(out) == BATCH:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run, "grp string, idx long, n long, digest string"


def _sink(levels: int, columns: Sequence[str], final: bool):
    """Nodes of blocks, each block behind the row with its own proof, to rows with proofs.

    Inner tiers pass on whole proofs; the leaves get the proof's digest and the folded root.
    """
    size = FANOUT ** levels
    schema, names = _schema(*columns, "subroot", *(["proof_sha256", "folded_root"] if final else ["proof"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, block, nodes, subroot, suffix, shared, roots = [], None, [], None, None, "", {}
        for group, idx, n, value, proof, of, *rest in _rows(batches):
            if proof is not None:  # the block's own row comes first
                subroot, suffix, roots = of, parsed(proof), {}
                shared = siblings(suffix) if final else proof
                continue
            at = idx % size
            if not at:
                block, nodes = Block(min(size, n - idx), min(levels, height(n))), []
            block.leaf(at, value)
            nodes.append((idx, value, rest))
            if at < block.last:
                continue
            for leaf, own in block.proofs():
                idx, value, rest = nodes[leaf]
                if final:
                    top = fold(rest[-1] or value, own)
                    if top not in roots:
                        roots[top] = fold(top, suffix)
                    shown = digest(siblings(own) + shared), roots[top]
                else:
                    shown = ("/".join(x for x in (written(own), shared) if x),)
                out.append((group, idx, *rest, subroot, *shown))
                if len(out) == BATCH:
                    yield _batch(out, schema)
                    out = []
        yield _batch(out, schema)

    return run, names


def _by_block(nodes: DataFrame, size: int, *columns: str | Column) -> DataFrame:
    """Nodes with the blocks of a task in order of group and label."""
    dealt = nodes.withColumn("_block", F.floor(F.col("idx") / size).cast("long"))
    dealt = dealt.repartition("grp", "_block").sortWithinPartitions("grp", "_block", *columns)
    return dealt.drop("_block")


class Forest:
    """The trees of stored leaves ``grp, idx, n, digest``, tier by tier.

    ``tiers[0]`` are the leaves themselves; each further tier has one node per block of the tier
    below, and the last one the subroots only. All are stored.
    """

    def __init__(self, leaves: DataFrame, levels: int = BLOCK_LEVELS):
        self.levels, self.size = levels, FANOUT ** levels
        self.tiers = [leaves]
        most = leaves.agg(F.max("n")).first()[0] or 0
        run, schema = _rise(levels)
        while most > 1:
            nodes = _by_block(self.tiers[-1].select("grp", "idx", "n", "digest"), self.size, "idx")
            self.tiers.append(saved(nodes.mapInArrow(run, schema), "merkle-tier"))
            most = -(-most // self.size)

    def subroots(self) -> DataFrame:
        """``grp, digest`` of every tree."""
        return self.tiers[-1].select("grp", "digest")

    def proofs(self, above: DataFrame, *columns: str, final: bool = True) -> DataFrame:
        """``grp, idx``, the string ``columns``, ``subroot`` and what is known of each leaf.

        ``above`` has ``grp, subroot, proof`` of each subroot. ``final``: ``proof_sha256`` and
        ``folded_root``, in which the last one of ``columns`` is the digest to fold instead of the
        leaf's own where it is not NULL; otherwise the whole ``proof``.
        """
        above = above.select("grp", F.lit(0).cast("long").alias("idx"), "subroot", "proof")
        for tier in reversed(self.tiers[1:-1]):
            above = saved(self._sweep(tier, above, (), final=False), "proof-suffixes")
        return self._sweep(self.tiers[0], above, columns, final)

    def _sweep(self, tier: DataFrame, above: DataFrame, columns: Sequence[str], final: bool) -> DataFrame:
        def nothing(c):
            return F.lit(None).cast("string").alias(c)

        nodes = tier.select("grp", "idx", "n", "digest", nothing("proof"), nothing("subroot"), *columns)
        own = above.select(
            "grp", (F.col("idx") * self.size).alias("idx"), F.lit(0).cast("long").alias("n"),
            F.lit("").alias("digest"), "proof", "subroot", *map(nothing, columns),
        )
        both = _by_block(nodes.unionByName(own), self.size, "idx", F.col("proof").asc_nulls_last())
        run, schema = _sink(self.levels, columns, final)
        return both.mapInArrow(run, schema)


def manifest(
    rows: DataFrame, columns: Sequence[str], id_col: str, group_col: str,
    tampered: Column | None = None, instead: dict[str, Column] | None = None,
    levels: int = BLOCK_LEVELS, slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """``id, grp, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``columns`` are the fields of a leaf, in order. Where ``tampered`` holds, the leaf that is
    folded along the original siblings is that of the row with the columns of ``instead``; the
    row is ``verified`` when the folded root is the root.
    """
    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(tampered, row_digest(rows, columns, **(instead or {})))
    leaves = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"),
        row_digest(rows, columns).alias("digest"), changed.alias("changed"),
    )
    leaves = saved(placed(leaves, "grp", ["id", "digest"], slot_rows).select(
        "grp", "idx", "n", "digest", F.col("id").cast("string").alias("id"),
        F.col("digest").alias("leaf"), "changed",
    ), "merkle-leaves")
    trees = Forest(leaves, levels)
    subroots = trees.subroots().select("*", F.lit("").alias("all"))
    top = Forest(saved(placed(subroots, "all", ["grp"], slot_rows).select(
        F.col("all").alias("grp"), "idx", "n", "digest", F.col("grp").alias("source"),
        F.col("digest").alias("leaf"),
    ), "merkle-subroots"), levels)
    root = top.subroots().first()  # one digest; none for an empty table
    root = F.lit(root["digest"] if root else None).cast("string")
    start = rows.sparkSession.range(1).select(
        F.lit("").alias("grp"), root.alias("subroot"), F.lit("").alias("proof")
    )
    above = saved(top.proofs(start, "source", "leaf", final=False).select(
        F.col("source").alias("grp"), F.col("leaf").alias("subroot"), "proof"
    ), "proof-suffixes")
    return trees.proofs(above, "id", "leaf", "changed").select(
        F.col("id").cast("long").alias("id"), "grp", "leaf", "subroot", root.alias("root"),
        "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"),
    )
