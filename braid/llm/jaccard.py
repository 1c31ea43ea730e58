"""N-gram Jaccard join: which texts share at least 80 of 100 of their 5-word shingles, and what hangs together by such links.

1. Texts with equal sets of shingles become one node, known by a 128-bit digest of the set.
2. A count-min sketch of all nodes' shingles (``sketch``) tells which shingles another node may have, too. A node with fewer of
   these than a link needs has no links and is done; that leaves near copies and little else.
3. Any two linked sets share one of their first elements, in an order that all sets follow: the sets' nodes meet there, in
   blocks. In a block all nodes are first tried against its most central one, of which the largest share of shingles is found
   elsewhere. What that links is one component and needs no more tries among itself; a group of near copies, however large, is
   mostly done with as many tries as it has nodes.
4. In blocks where several components are left, an R-tree over count vectors (``rtree``) finds all pairs across components whose
   bound on the overlap suffices, each in the first block that both are in. A block too large for one task is cut into a grid
   of parts, every two of which meet.
5. Every pair is verified on the whole sets before it counts. No link between components is lost.

Hashes of shingles have 64 bits. Null text and text without words have no shingles and no links. Texts of fewer than five
words have one shingle, all their words. Repeated rows have equal sets. A component's id is its least document id; a null id
counts as greater than others, and a component of null ids only has a null id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.llm import sketch
from braid.llm.components import components
from braid.llm.rolling import blocks, window_hashes
from braid.llm.rtree import Tree, count_vector, counts_of, needed
from braid.shared import discard, written

SHINGLE = 5
# Nodes of a block that one task compares with as many others.
PART_ROWS = 2_000


def shingle_sets(texts: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for block in blocks(texts):
        words = block.word_hashes(fold=True)
        counts = np.diff(block.word_at)
        # A short text's only window is as long as the text; the length joins the hash.
        sizes = np.minimum(counts, SHINGLE)
        n = np.where(counts > 0, counts - sizes + 1, 0)
        ends = np.cumsum(n)
        at = np.repeat(block.word_at[:-1] - (ends - n), n) + np.arange(ends[-1])
        size = np.repeat(sizes, n)
        hashes = window_hashes(words, at, size) ^ (size.astype(np.uint64) << np.uint64(56))
        out += [np.unique(hashes[b - k : b]) for b, k in zip(ends.tolist(), n.tolist(), strict=True)]
    return out


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _least_shared(n: int) -> int:
    """What a set of ``n`` has to share with any set it is linked with: 80 of 100 of its own, at least."""
    return -(-80 * n // 100)


def _chunked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """All columns of ``docs`` as ``row``, with its chunk, and the bytes of all texts."""
    size = sketch.text_bytes(docs, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.select("row", sketch.chunk_of(size, F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"))), size


def _members(rows: DataFrame) -> DataFrame:
    """id, chunk, n and node of every row (id, chunk, text); node is null where there are no shingles."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("chunk"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) if len(s) else None for s in sets], pa.binary())],
                names=["id", "chunk", "n", "node"],
            )

    return rows.mapInArrow(run, f"id {kind}, chunk bigint, n bigint, node binary")


def _survivors(rows: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """The nodes that may have links: node, n, shingles (sorted, 8 bytes each), counts, ``first`` (the elements under which they
    meet others) and ``alone`` (the share of shingles that no other node has)."""
    bits = sketch.cell_bits(size)
    # Each node's set is looked at in one chunk that has it.
    chosen = members.filter("node IS NOT NULL").groupBy("node").agg(F.min("chunk").alias("chunk"))
    texts = rows.select("chunk", "text").groupBy("chunk")

    def sets(table: pa.Table, nodes: set[bytes]) -> dict[bytes, np.ndarray]:
        out = {}
        for shingles in shingle_sets(table.column("text")):
            if len(shingles) and (node := _digest(shingles)) in nodes and node not in out:
                out[node] = shingles
        return out

    def sketched(table: pa.Table, nodes: pa.Table) -> pa.Table:
        found = sets(table, set(nodes.column("node").to_pylist()))
        if not found:
            return sketch.messages(iter(()))
        return sketch.messages(sketch.partial_sketch(table.column("chunk")[0].as_py(), np.concatenate(list(found.values())), bits))

    asked = texts.cogroup(chosen.groupBy("chunk")).applyInArrow(sketched, sketch.MESSAGE)
    answers = asked.groupBy("block").applyInArrow(sketch.merge_sketches, sketch.MESSAGE)
    given = answers.select("block", "chunk", "n", "data", F.lit(None).cast("binary").alias("node"))
    given = given.unionAll(chosen.select(F.lit(None).cast("bigint"), "chunk", F.lit(None).cast("bigint"), F.lit(None).cast("binary"), "node"))

    def kept(table: pa.Table, given: pa.Table) -> pa.Table:
        is_node = pc.is_valid(given.column("node"))
        found = sets(table, set(given.filter(is_node).column("node").to_pylist()))
        out = []
        if found:
            shared = sketch.estimated_repeated(np.concatenate(list(found.values())), given.filter(pc.invert(is_node)), bits)
            at = 0
            for node, shingles in found.items():
                common = shingles[shared[at : at + len(shingles)]]
                at += len(shingles)
                least = _least_shared(len(shingles))
                if len(common) >= least:
                    # All sets put what only they have first, then the rest by hash.
                    out.append((node, len(shingles), shingles, common[: len(common) - least + 1], count_vector(shingles), 1 - len(common) / len(shingles)))
        node, n, shingles, first, counts, alone = list(zip(*out, strict=True)) or [()] * 6
        return pa.table(
            {
                "node": pa.array(node, pa.binary()), "n": pa.array(n, pa.int64()), "shingles": pa.array([s.tobytes() for s in shingles], pa.binary()),
                "counts": pa.array(counts, pa.binary()), "first": pa.array([f.view(np.int64) for f in first], pa.list_(pa.int64())), "alone": pa.array(alone, pa.float64()),
            }
        )

    kind = "node binary, n bigint, shingles binary, counts binary, first array<bigint>, alone double"
    return texts.cogroup(given.groupBy("chunk")).applyInArrow(kept, kind)


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the pairs (a, b), those whose sets share enough. Bounds on counts are looked at before sets are."""
    sets = nodes.select("node", "shingles", "counts")
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set"), F.col("counts").alias(f"{side}_counts")), side)

    def run(batches):
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            keep = []
            for i in range(len(batch)):
                x, y = (counts_of(columns[f"{s}_counts"][i].as_py()) for s in "ab")
                least = int(needed(np.array([x.sum()]), np.array([y.sum()]))[0])
                if np.minimum(x, y).sum() >= least:
                    a, b = (np.frombuffer(columns[f"{s}_set"][i].as_py(), np.uint64) for s in "ab")
                    if len(np.intersect1d(a, b, assume_unique=True)) >= least:
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([columns["a"].take(pa.array(keep, pa.int64())), columns["b"].take(pa.array(keep, pa.int64()))], names=["a", "b"])

    return pairs.select("a", "b", "a_set", "b_set", "a_counts", "b_counts").mapInArrow(run, "a binary, b binary")


def _across(met: DataFrame, nodes: DataFrame, roots: DataFrame, part_rows: int) -> DataFrame:
    """Pairs of nodes of different components that meet in a block and whose bound suffices."""
    known = met.join(roots, met["node"] == roots["of"], "left").select("at", "node", F.coalesce("root", "node").alias("root"))
    open_ = known.groupBy("at").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).filter("low <> high")
    open_ = open_.select(F.col("at").alias("block"), F.ceil(F.col("size") / part_rows).alias("parts"))
    known = known.join(open_, F.col("at") == F.col("block")).withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    # Every two parts meet in one task; there is one part unless the block is too large.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    known = known.select("at", "node", "root", "part", other.alias("other"))
    known = known.select("at", "node", "root", "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))
    known = known.join(nodes.select(F.col("node").alias("of"), "counts", "first"), F.col("node") == F.col("of"))
    # Of a node's first elements, those before this block's: a pair that shares one of them has met there.
    known = known.select("at", "x", "y", "node", "root", "part", "counts", F.slice("first", F.lit(1), F.array_position("first", F.col("at")).cast("int") - 1).alias("before"))

    def run(table: pa.Table) -> pa.Table:
        names = table.column("node").to_pylist()
        points = np.stack([counts_of(c) for c in table.column("counts").to_pylist()])
        labels = np.unique(table.column("root").to_pylist(), return_inverse=True)[1]
        parts, before = table.column("part").to_numpy(), [x.values.to_numpy() for x in table.column("before")]
        crossing = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        found = []
        for a, b in Tree(points, labels).pairs():
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                if (not crossing or parts[i] != parts[j]) and not len(np.intersect1d(before[i], before[j], assume_unique=True)):
                    found.append((names[i], names[j]) if names[i] < names[j] else (names[j], names[i]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return known.groupBy("at", "x", "y").applyInArrow(run, "a binary, b binary")


def links(nodes: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """node and root of all nodes with links, from ``nodes`` as ``_survivors`` makes them."""
    met = nodes.select(F.explode("first").alias("at"), "node", "alone")
    hubs = met.groupBy("at").agg(F.min(F.struct("alone", "node"))["node"].alias("hub"), F.count("*").alias("size"))
    hubs = hubs.filter("size > 1").select(F.col("at").alias("block"), "hub")
    shared = written(met.join(hubs, F.col("at") == F.col("block")).select("at", "node", "hub"), "met")
    near = _verified(shared.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), nodes)
    near = written(near, "near")
    roots = components(near).select(F.col("node").alias("of"), "root")
    rest = written(_verified(_across(shared.select("at", "node"), nodes, roots, part_rows), nodes), "across")
    found = components(near.unionAll(rest))
    for done in (shared, near, rest):
        discard(done)
    return found


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """The chunked rows, and the members: id, chunk, n, node and root of every row."""
    rows, size = _chunked(docs, id_col, text_col)
    slim = rows.select(F.col(f"row.`{id_col}`").alias("id"), "chunk", F.col(f"row.`{text_col}`").alias("text"))
    members = written(_members(slim), "members")
    nodes = written(_survivors(slim, members, size), "survivors")
    roots = links(nodes, part_rows).select(F.col("node").alias("of"), "root")
    discard(nodes)
    return rows, members.join(roots, members["node"] == roots["of"], "left").select("id", "chunk", "n", "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``."""
    _, found = joined(docs.select(id_col, text_col), id_col, text_col, part_rows)
    least = found.filter("root IS NOT NULL").groupBy(F.col("root").alias("of")).agg(F.min("id").alias("least"))
    out = found.join(least, F.col("root") == F.col("of"), "left")
    own = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: of each component the one with the least id (then the least text),
    and all rows without shingles."""
    rows, found = joined(docs, id_col, text_col, part_rows)
    first = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), "chunk", "node")
    keep = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(first).alias("k")).select(F.col("k.chunk").alias("chunk"), F.col("k.id").alias("id"), F.col("k.node").alias("node"))
    schema = docs.schema

    def run(table: pa.Table, keep: pa.Table) -> pa.Table:
        wanted = set(zip(keep.column("id").to_pylist(), keep.column("node").to_pylist(), strict=True))
        row = table.column("row").combine_chunks() if table.num_rows else pa.array([], table.schema.field("row").type)
        texts = row.field(text_col)
        best: dict[tuple, tuple[str, int]] = {}
        out = []
        for i, (id_, shingles) in enumerate(zip(row.field(id_col).to_pylist(), shingle_sets(texts), strict=True)):
            if not len(shingles):
                out.append(i)
            elif (key := (id_, _digest(shingles))) in wanted:
                best[key] = min(best.get(key, (texts[i].as_py(), i)), (texts[i].as_py(), i))
        return pa.Table.from_struct_array(row.take(pa.array(sorted([*out, *(i for _, i in best.values())]), pa.int64())))

    return rows.groupBy("chunk").cogroup(keep.groupBy("chunk")).applyInArrow(run, T.StructType(schema.fields))
