"""Merkle manifest of a dataset by butterfly exchange.

Leaves are hashed where they are.  Within a tree they are cut into aligned blocks
of ``fanout`` to the power of three, and each block hashes its own subtree.  The
blocks then exchange roots like the stages of a butterfly: in round r, the blocks
whose numbers agree but for digit r (base fanout) form a group, swap the roots of
their aligned subtrees, and each of them hashes the common ancestor.  So after the
last round every block has the root and the siblings on its way there, and
nothing has to be sent down the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from placetally.llm.common import stored
from placetally.llm.ranking import in_order

FANOUT = 16
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows of a block's head and of its leaves meet under these columns.
_KEYS = ["source", "block"]


# --- leaves ---------------------------------------------------------------------------------------------------------


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of fields in order, each with its UTF-8 length; a null field is ``-``."""
    return F.sha2(F.concat(*[_field(f) for f in fields]).cast("binary"), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(doc_id, source, leaf) of every row; other columns than ``fields`` are ignored."""
    return docs.select("doc_id", "source", leaf_digest([F.col(f) for f in fields]).alias("leaf"))


# --- trees ----------------------------------------------------------------------------------------------------------


def _height(n: int, fanout: int) -> int:
    """How often ``n`` nodes must be hashed in runs until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(digests: list[str], levels: int, fanout: int) -> list[list[str]]:
    """Nodes of a subtree, level by level, the leaves first and the nodes over the last runs at the end."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([_sha("".join(below[k:k + fanout])) for k in range(0, len(below), fanout)])
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows of one block; the rows come sorted by block."""
    group, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            own = row["source"], row["block"]
            if own != key and group:
                yield group
                group = []
            key = own
            group.append(row)
    if group:
        yield group


def _roots(batches: Iterator[pa.RecordBatch], fanout: int, most: int) -> Iterator[pa.RecordBatch]:
    """(source, block, members, digest): the root of each block's subtree."""
    schema = pa.schema([("source", pa.string()), ("block", pa.int64()), ("members", pa.int64()), ("digest", pa.string())])
    out = []
    for rows in _groups(batches):
        levels = min(most, _height(rows[0]["members"], fanout))
        root = _levels([r["leaf"] for r in rows], levels, fanout)[-1][0]
        out.append({"source": rows[0]["source"], "block": rows[0]["block"], "members": rows[0]["members"], "digest": root})
        if len(out) == 1_000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "at")


def butterfly(roots: DataFrame, fanout: int, label: str) -> DataFrame:
    """(source, block, digest, path): each block with the root of its tree and the siblings on its way there.

    ``roots`` has (source, block, blocks, digest), ``blocks`` being how many the
    tree has.  ``path`` is an array of (left, right): the digests before and after
    the own node in its run, one pair for each round.

    A group has at most ``fanout`` members.  The last subtree of a tree may have
    fewer blocks than the others; then some groups lack a member of it, and its
    blocks take turns to send the root there as well, which makes at most as many
    further rows as the tree has blocks.
    """
    state = roots.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    most = state.agg(F.max("blocks")).first()[0] or 1
    width = 1  # blocks of a subtree
    while width < most:
        node, low = F.expr(f"block div {width}"), F.expr(f"block % {width}")
        last, size = F.expr(f"(blocks - 1) div {width}"), F.expr(f"(blocks - 1) % {width} + 1")
        # the last subtree also stands in where it lacks a block
        stands = F.when(node == last, F.sequence(low, F.lit(width - 1), size)).otherwise(F.array(low))
        moving = state.filter(f"blocks > {width}").select(
            "source", "block", "blocks", "digest", "path", F.expr(f"block div {width * fanout}").alias("high"),
            (node % fanout).alias("digit"), low.alias("own"), F.explode(stands).alias("low"),
        )
        real = F.col("low") == F.col("own")
        member = F.struct(
            "digit", "digest", real.alias("real"), F.when(real, F.col("block")).alias("block"),
            F.when(real, F.col("blocks")).alias("blocks"), F.when(real, F.col("path")).alias("path"),
        )
        swapped = moving.groupBy("source", "high", "low").agg(F.sort_array(F.collect_list(member)).alias("run"))
        joined = "array_join(transform({}, x -> x.digest), '')"
        advanced = swapped.select(
            "source", F.expr(f"sha2({joined.format('run')}, 256)").alias("digest"), "run", F.explode("run").alias("one")
        ).filter("one.real").select(
            "source", "one.block", "one.blocks", "digest",
            F.expr(
                "array_append(one.path, named_struct("
                f"'left', {joined.format('filter(run, x -> x.digit < one.digit)')},"
                f" 'right', {joined.format('filter(run, x -> x.digit > one.digit)')}))"
            ).alias("path"),
        )
        state = stored(state.filter(f"blocks <= {width}").unionByName(advanced), f"{label}-round")
        width *= fanout
    return state.select("source", "block", "digest", "path")


def _with_paths(
    batches: Iterator[pa.RecordBatch], fanout: int, most: int, schema: pa.Schema, finish: Callable[[dict, list, str], dict]
) -> Iterator[pa.RecordBatch]:
    """What ``finish`` makes of each leaf, the siblings on its way up and the root; the head of a block comes first."""
    out = []
    for head, *rows in _groups(batches):
        levels = _levels([r["leaf"] for r in rows], min(most, _height(rows[0]["members"], fanout)), fanout)
        above = [(p["left"], p["right"]) for p in head["path"]]
        for at, row in enumerate(rows):
            path, own = [], at
            for nodes in levels[:-1]:
                first = own - own % fanout
                path.append(("".join(nodes[first:own]), "".join(nodes[own + 1:first + fanout])))
                own //= fanout
            out.append(finish(row, path + above, head))
            if len(out) == 2_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def _plain(row: dict, path: list[tuple[str, str]], head: dict) -> dict:
    return {
        "name": row["name"], "leaf": row["leaf"], "root": head["digest"], "path": [{"left": a, "right": b} for a, b in path]
    }


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for left, right in path:
        leaf = _sha(left + leaf + right)
    return leaf


def _verified(row: dict, path: list[tuple[str, str]], head: dict) -> dict:
    folded = fold(row["presented"] or row["leaf"], path)
    return {
        "doc_id": row["doc_id"], "leaf": row["leaf"], "subroot": head["subroot"], "root": head["root"],
        "proof_sha256": _sha("".join(a + b for a, b in path)), "folded_root": folded, "verified": folded == head["root"],
    }


def _tree(placed: DataFrame, fanout: int, label: str) -> tuple[DataFrame, DataFrame]:
    """Leaves with their block and place in it, and the butterfly's result for the blocks."""
    block = fanout ** BLOCK_LEVELS
    placed = placed.withColumns({"block": F.expr(f"position div {block}"), "at": F.expr(f"position % {block}")})
    roots = _by_block(placed.select("source", "block", "at", "members", "leaf")).mapInArrow(
        partial(_roots, fanout=fanout, most=BLOCK_LEVELS), "source string, block long, members long, digest string"
    )
    roots = stored(roots, f"{label}-roots").select(
        "source", "block", F.expr(f"(members - 1) div {block} + 1").alias("blocks"), "digest"
    )
    return placed, butterfly(roots, fanout, label)


def _finished(placed: DataFrame, heads: DataFrame, fanout: int, finish: Callable, schema: str) -> DataFrame:
    """``finish`` over the leaves of every block; a block's head is sent where its leaves are and comes first."""
    heads = heads.withColumn("at", F.lit(-1).cast("long"))
    rows = _by_block(placed.unionByName(heads, allowMissingColumns=True))
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return rows.mapInArrow(partial(_with_paths, fanout=fanout, most=BLOCK_LEVELS, schema=arrow, finish=finish), schema)


def root_paths(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(name, leaf, root, path) of one tree over (name, leaf), ordered by name, null first.

    ``path`` lists the digests left and right of the own node in its run, from
    the leaf to the root; a lone leaf is the root and has no path.
    """
    named = stored(nodes.select(F.lit(None).cast("string").alias("source"), "name", "leaf"), "merkle-names")
    placed, tops = _tree(in_order(named, "source", [F.asc_nulls_first("name"), F.asc("leaf")], "merkle-names"), fanout, "merkle-top")
    schema = "name string, leaf string, root string, path array<struct<left:string,right:string>>"
    return _finished(placed, tops, fanout, _plain, schema)


def manifest(docs: DataFrame, presented: Column | None = None, fanout: int = FANOUT, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    Each source is a tree of its own over its rows by ascending doc_id (null
    first, rows of one id by leaf); its root is the subroot, and the subroots in
    order of source (null first) are the leaves of the tree over all.
    ``presented`` is the text that is shown for checking, null where it is the
    stored one; by default all are.  ``folded_root`` is what the presented row and
    the stored siblings give, and ``verified`` says whether that is the root.

    Texts are hashed where they are; only digests are dealt out.  A block is 4,096
    digests, whatever the size of its source.  An empty table has no rows and no
    root; repeated rows are leaves of their own; other columns are ignored.
    """
    tampered = F.lit(None).cast("string")
    if presented is not None:
        shown = [presented if f == "text" else F.col(f) for f in fields]
        tampered = F.when(presented.isNotNull(), leaf_digest(shown))
    marked = stored(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"), leaf_digest([F.col(f) for f in fields]).alias("leaf"),
            tampered.alias("presented"),
        ), "merkle-leaves",
    )
    placed = in_order(marked, "source", [F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("presented")], "merkle-order")
    placed, blocks = _tree(placed, fanout, "merkle")
    tops = root_paths(blocks.filter("block = 0").select(F.col("source").alias("name"), F.col("digest").alias("leaf")), fanout)
    tops = stored(tops, "merkle-sources").select(F.col("name"), F.col("leaf").alias("subroot"), "root", F.col("path").alias("above"))
    heads = blocks.join(tops, blocks["source"].eqNullSafe(tops["name"])).select(
        "source", "block", "subroot", "root", F.concat("path", "above").alias("path")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _finished(
        placed, heads, fanout, _verified,
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def lower_cased_fifth() -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC-32 of the decimal doc_id, else null; a null text stays."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MODULUS == 0
    return F.when(chosen, F.translate("text", UPPER, UPPER.lower()))
