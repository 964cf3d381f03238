"""Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf, the SHA-256 of its typed fields. Per group (a source) the leaves form a tree
of fanout ``FANOUT`` in the order of their key, and the groups' subroots form one more tree, whose
root names the whole dataset.

1. Leaves are numbered within their group range by range (:func:`numbering.positions`), so that a
   group with a third of all rows is spread over all tasks; digests are shuffled, never texts.
2. Partitions are aligned runs of ``FANOUT ** block_levels`` leaves of a group. A task hashes a
   partition up to its own subtree root.
3. Butterfly exchange: in round r, the partitions whose numbers differ in digit r alone (base
   ``FANOUT``) swap the roots of the subtrees that they have come to. Each of the at most
   ``FANOUT`` members of such a group hashes their parent for itself and notes the siblings. After
   log(partitions) rounds every partition holds its group's root and all its own upper proofs; no
   pass leads downward and no task sees more than ``FANOUT`` digests of a group. Where the last
   subtree of a level has fewer partitions than the others, each stands in for the positions that
   it lacks, so that its siblings hear of its root too.
4. The subroots are the leaves of the second tree, made by the same steps.
5. Each partition joins its leaves with its upper proof and writes a proof for each of them.

A proof is a list of steps from the leaf up, each the siblings' digests before and after the node,
so that ``sha256(before + node + after)`` is its parent. :func:`manifest` folds a second digest
per row (``claim``) the same way and tells whether it leads to the root.

Defined results: null fields are ``-``; rows without a key come first in their group; rows of one
key are ordered by their leaf (equal rows are leaves of their own, whichever of them is first);
a null group is a group, before all others; a lone leaf is its group's subroot, a lone subroot the
root, each with no siblings; a null claim stands for the leaf; an empty table has no root and gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import checkpointed, tidy
from logengine.operators.numbering import positions

FANOUT = 16
#: Levels that a task hashes by itself: partitions hold FANOUT ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3
#: Parts that the rows of one group are dealt into when they meet their group's proof.
SPREAD = 64

_STEPS = "array<struct<before:string,after:string>>"


def digest(*columns: Column) -> Column:
    """SHA-256 (lowercase hex) of the columns, each ``-`` if null, else its bytes, ``:``, its value."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def group_key(group: Column) -> Column:
    """A text without nulls that sorts as the group does bytewise, null first."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def _hash(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def levels_of(nodes: list[str], levels: int | None, fanout: int = FANOUT) -> list[list[str]]:
    """The leaves and the levels above them: so many, or up to a single node."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([_hash(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return out


def _beside(level: list[str], at: int, fanout: int) -> tuple[str, str]:
    first = at - at % fanout
    return "".join(level[first:at]), "".join(level[at + 1 : first + fanout])


def _levels(block: int, nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    # A first partition alone ends at its single node; with others beside it it is full.
    return levels_of(nodes, levels if block else None, fanout)


def _blocks(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(_s, _b, _n, rows, node): the partitions of each group with their rows in order, the number
    of partitions of the group and the root of the partition's own subtree."""
    size = fanout**levels
    placed = positions(leaves, ["_s"], ["_o", "leaf"], "_i", lead=1, total_col="_rows")
    cut = placed.groupBy("_s", F.expr(f"_i div {size}").alias("_b")).agg(
        F.expr(f"(max(_rows) + {size - 1}) div {size}").alias("_n"),
        F.sort_array(F.collect_list(F.struct("_i", "_o", "leaf", "claim"))).alias("rows"),
    )
    schema = cut.withColumn("node", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                leaves = batch.column("rows")[i].values.field("leaf").to_pylist()
                node = _levels(batch.column("_b")[i].as_py(), leaves, levels, fanout)[-1][0]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, pa.array([node])], [*batch.schema.names, "node"]
                )

    return checkpointed(cut.mapInArrow(tidy(run), schema))


def _exchanged(blocks: DataFrame, fanout: int) -> DataFrame:
    """(_s, _b, root, steps): what each partition has learned after all rounds."""
    nodes = blocks.select("_s", "_b", "_n", "node", F.array().cast(_STEPS).alias("steps"))
    most = blocks.agg(F.max("_n")).first()[0] or 0
    width = 1  # partitions that a node stands over
    while width < most:
        more = F.col("_n") > width
        last = F.expr(f"_n - ((_n - 1) div {width}) * {width}")  # partitions under the last node
        own = F.expr(f"_b % {width}")
        child = F.expr(f"(_b div {width}) % {fanout}")
        short = more & F.expr(f"_b div {width} = (_n - 1) div {width}") & (last < width) & (child > 0)
        heard = F.when(short, F.sequence(own, F.lit(width - 1).cast("long"), last)).otherwise(F.array(own))
        sent = nodes.select(
            "*", child.alias("_child"), F.expr(f"_b div {width * fanout}").alias("_over"), own.alias("_own"),
            F.explode(heard).alias("_at"),
        )
        member = F.struct("_child", "_b", "_n", "steps")
        swapped = sent.groupBy("_s", "_over", "_at").agg(
            F.sort_array(F.collect_list(F.struct("_child", "node"))).alias("run"),
            F.collect_list(F.when(F.col("_at") == F.col("_own"), member)).alias("members"),
        )
        each = swapped.select("_s", "run", F.explode("members").alias("m")).select("_s", "run", "m.*")

        def joined(which: Column) -> Column:
            return F.array_join(F.transform(which, lambda x: x["node"]), "")

        step = F.struct(
            joined(F.filter("run", lambda x: x["_child"] < F.col("_child"))).alias("before"),
            joined(F.filter("run", lambda x: x["_child"] > F.col("_child"))).alias("after"),
        )
        nodes = each.select(
            "_s", "_b", "_n",
            F.when(more, F.sha2(joined(F.col("run")), 256)).otherwise(F.col("run")[0]["node"]).alias("node"),
            F.when(more, F.concat("steps", F.array(step))).otherwise(F.col("steps")).alias("steps"),
        )
        width *= fanout
    return nodes.select("_s", "_b", F.col("node").alias("root"), "steps")


def _proved(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(_s, _o, leaf, claim, root, steps) of every leaf of a tree whose root is of interest itself."""
    met = blocks.drop("node").join(_exchanged(blocks, fanout), ["_s", "_b"]).select("_s", "_b", "rows", "root", "steps")
    schema = met.select("_s", F.col("rows._o")[0].alias("_o"), F.col("rows.leaf")[0].alias("leaf"), "root", "steps").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                nodes = [r["leaf"] for r in block["rows"]]
                tree = _levels(block["_b"], nodes, levels, fanout)
                made = []
                for i, r in enumerate(block["rows"]):
                    steps = [_beside(level, i // fanout**k, fanout) for k, level in enumerate(tree[:-1])]
                    steps = [{"before": a, "after": z} for a, z in steps] + block["steps"]
                    made.append({"_s": block["_s"], "_o": r["_o"], "leaf": r["leaf"], "root": block["root"], "steps": steps})
                yield pa.RecordBatch.from_pylist(made, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return met.mapInArrow(tidy(run), schema)


def manifest(
    rows: DataFrame,
    group: str = "source",
    key: str = "doc_id",
    leaf: str = "leaf",
    claim: str | None = None,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
    with_proof: bool = False,
) -> DataFrame:
    """(group, key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, with
    ``proof`` (the steps from the leaf to the root) if asked for.

    ``leaf`` is the row's digest (:func:`digest`), ``claim`` the digest that is folded with the
    row's proof (null, or no column: the leaf itself)."""
    claimed = F.col(claim) if claim else F.lit(None).cast("string")
    leaves = rows.select(
        group_key(F.col(group)).alias("_s"), F.col(key).alias("_o"), F.col(leaf).alias("leaf"), claimed.alias("claim")
    )
    blocks = _blocks(leaves, fanout, block_levels)
    lower = checkpointed(_exchanged(blocks, fanout))
    # The subroots are the leaves of the tree over the groups; their key is the group's.
    subroots = lower.where("_b = 0").select(
        F.lit("").alias("_s"), F.col("_s").alias("_o"), F.col("root").alias("leaf"), F.lit(None).cast("string").alias("claim")
    )
    upper = _proved(_blocks(subroots, fanout, block_levels), fanout, block_levels).select(
        F.col("_o").alias("_s"), F.col("root").alias("top"), F.col("steps").alias("more")
    )
    # One row per group; a group's partitions meet copies of it in SPREAD places.
    upper = upper.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    whole = lower.withColumn("_part", F.expr(f"int(_b % {SPREAD})")).join(upper, ["_s", "_part"])
    met = blocks.select("_s", "_b", "rows").join(
        whole.select("_s", "_b", F.col("root").alias("subroot"), F.col("top").alias("root"),
                     F.concat("steps", "more").alias("steps")),
        ["_s", "_b"],
    )
    return _written(met, rows, group, key, fanout, block_levels, with_proof)


def _written(
    met: DataFrame, rows: DataFrame, group: str, key: str, fanout: int, levels: int, with_proof: bool
) -> DataFrame:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    text = T.StringType()
    fields = [T.StructField("_s", text), T.StructField("_o", rows.schema[key].dataType)]
    fields += [T.StructField(n, text) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    fields += [T.StructField("verified", T.BooleanType())]
    if with_proof:
        fields.append(T.StructField("proof", T._parse_datatype_string(_STEPS)))
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block, subroot, root = (batch.column(c)[i].as_py() for c in ("_b", "subroot", "root"))
                above = [(s["before"], s["after"]) for s in batch.column("steps")[i].as_py()]
                group_rows = batch.column("rows")[i].values
                keys = group_rows.field("_o")
                leaves, claims = (group_rows.field(c).to_pylist() for c in ("leaf", "claim"))
                tree = _levels(block, leaves, levels, fanout)
                sides = [[_beside(level, j, fanout) for j in range(len(level))] for level in tree[:-1]]
                proofs, folded, kept = [], [], []
                for j, node in enumerate(leaves):
                    steps = [side[j // fanout**k] for k, side in enumerate(sides)] + above
                    proofs.append(_hash(*(x for s in steps for x in s)))
                    node = claims[j] or node
                    for before, after in steps:
                        node = _hash(before, node, after)
                    folded.append(node)
                    if with_proof:
                        kept.append([{"before": a, "after": z} for a, z in steps])
                n = len(leaves)
                columns = [[batch.column("_s")[i].as_py()] * n, keys, leaves, [subroot] * n, [root] * n, proofs, folded,
                           [f == root for f in folded], *([kept] if with_proof else [])]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)],
                    schema=arrow,
                )

    found = met.select("_b", "_s", "rows", "subroot", "root", "steps").mapInArrow(tidy(run), schema)
    name = F.when(F.col("_s") != "0", F.expr("substring(_s, 2)")).alias(group)
    return found.select(name, F.col("_o").alias(key), *schema.names[2:])


def document_leaf(text: Column | None = None) -> Column:
    """The leaf of a ``documents`` row, or of the row with another text."""
    return digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), F.col("text") if text is None else text)


def tampered(doc_id: Column) -> Column:
    """The rows that are checked with a changed text: 5 divides crc32 of the id as text."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased, nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())
