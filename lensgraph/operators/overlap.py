"""Pairs of different texts by the set cosine of their word n-grams, exactly.

1. Grams are dealt over parts by their hash, packed in blocks, and counted: those
   of a single text meet nothing and go no further.  This takes rounds, each over
   all texts and one share of the parts, so that one share at a time is on disk.
2. What is left of each text is put in one order for all, rarest first.  A text
   that shares too few grams for any pair goes.
3. Sets with an intersection of at least a = ceil(c sqrt(n1 n2)) share one among
   the first n1 - a + 1 of the one and the first n2 - a + 1 of the other, and the
   smaller has n2 >= c^2 n1.  So a set needs n - ceil(c^2 n) + 1 grams to meet smaller
   ones, and n - ceil(c n) + 1 to be met by larger ones.  These grams are joined in
   rounds as well.
4. Pairs are confirmed on all grams that more than one text has.  Texts alike lie in
   tiles, and the pairs of two tiles go to one task with the sets they need.

A text is known by its 64-bit digest, so copies of it are one set wherever they
lie, and no text is shuffled.  A gram is its part and 48 bits, six bytes in a block;
once counted, its frequency class stands before 56 bits, so that numbers are in the
order of 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgraph.functions import grams
from lensgraph.operators.graph import cut_lineage

#: Characters of text whose grams make one part, which a task holds as a whole, and grams that wait for their blocks.
PART_CHARS = 1 << 24
BLOCK_GRAMS = 1 << 19
#: A tile of texts that are likely to be pairs has so many texts and grams at most, or about so.
TILE_TEXTS = 512
TILE_GRAMS = 1 << 19
#: Rounds in which grams are dealt, and joined, at most.  Each reads all texts, or all sets, again.
ROUNDS = 4

#: The bits of a gram under its frequency class, which has four steps for each doubling.
_GRAM = (1 << 56) - 1

_BLOCKS = "part int, nodes array<long>, sizes array<int>, counts array<int>, low array<int>, high array<smallint>"
_COUNTED = "part int, nodes array<long>, sizes array<int>, counts array<int>, grams array<long>"
_PAIRS = "part int, node_a array<long>, node_b array<long>"


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), kind))


def _flat(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)


def _blocks(part: np.ndarray, node: np.ndarray, size: np.ndarray, **values: np.ndarray) -> dict:
    """One row a part of rows in ascending order of part and node; a node is named once for its grams."""
    new = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (node[1:] != node[:-1]))))
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    heads = np.searchsorted(new, cuts)
    at = lambda x, where: np.split(x, where[1:])
    counts = np.diff(np.concatenate((new, [len(part)])))
    return {
        "part": pa.array(part[cuts].astype(np.int32)),
        "nodes": _lists(at(node[new], heads), pa.int64()),
        "sizes": _lists(at(size[new].astype(np.int32), heads), pa.int32()),
        "counts": _lists(at(counts.astype(np.int32), heads), pa.int32()),
    } | {name: _lists(at(v, cuts), pa.from_numpy_dtype(v.dtype)) for name, v in values.items()}


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(node, size), one row a gram."""
    counts = _flat(table["counts"], np.int64)
    return np.repeat(_flat(table["nodes"], np.int64), counts), np.repeat(_flat(table["sizes"], np.int64), counts)


def _dealt(k: int, parts: int, rounds: int, turn: int):
    """Blocks of the grams of each batch's texts, by the gram's part; of the parts that have their turn."""
    part_of = lambda gram: (gram >> np.uint64(48)) % np.uint64(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        waiting = 0

        def packed() -> pa.RecordBatch:
            counts = np.array([len(own) for _, own in held.values()])
            sizes = np.array([n for n, _ in held.values()])
            node, size, gram = np.repeat(np.array(list(held), dtype=np.int64), counts), np.repeat(sizes, counts), np.concatenate([own for _, own in held.values()])
            part = part_of(gram)
            order = np.lexsort((node, part))
            gram = gram[order]
            return pa.RecordBatch.from_pydict(_blocks(part[order], node[order], size[order], low=gram.astype(np.uint32).view(np.int32), high=(gram >> np.uint64(32)).astype(np.uint16).view(np.int16)))

        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for first, last, texts in grams.chunks(batch.column(1)):
                for node, own in zip(nodes[first:last], grams.gram_sets(texts, k), strict=True):
                    if int(node) not in held:
                        mine = own[part_of(own) % np.uint64(rounds) == turn] if rounds > 1 else own
                        held[int(node)] = len(own), mine
                        waiting += len(mine)
                if waiting > BLOCK_GRAMS:
                    yield packed()
                    held, waiting = {}, 0
        if waiting:
            yield packed()

    return run


def _counted(parts: int):
    """The grams of one part that more than one text has, with their frequency class, dealt over parts by the text."""

    def run(table: pa.Table) -> pa.Table:
        node, size = _unpacked(table)
        gram = _flat(table["low"], np.int32).view(np.uint32) | _flat(table["high"], np.int16).view(np.uint16).astype(np.uint64) << np.uint64(32) | np.uint64(table["part"][0].as_py() << 48)
        order = np.lexsort((node, gram))
        node, size, gram = node[order], size[order], gram[order]
        # Copies of a text in several blocks are one.
        own = np.concatenate(([True], (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])))
        node, size, gram = node[own], size[own], gram[own]
        new = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        times = np.diff(np.concatenate((new, [len(gram)])))
        texts = np.repeat(times, times)
        shared = texts > 1
        if not shared.any():
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            return pa.schema({"part": pa.int32(), "nodes": longs, "sizes": ints, "counts": ints, "grams": longs}).empty_table()
        node, size, texts = node[shared], size[shared], texts[shared]
        gram = gram[shared].view(np.int64) & _GRAM | np.floor(4 * np.log2(texts)).astype(np.int64) << 56
        part = (grams.mix(node.view(np.uint64)) >> np.uint64(32)) % np.uint64(parts)
        order = np.lexsort((node, part))
        return pa.Table.from_pydict(_blocks(part[order], node[order], size[order], grams=gram[order]))

    return run


def _by_node(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, size, gram), one row a gram, in order of node and gram."""
    node, size = _unpacked(table)
    gram = _flat(table["grams"], np.int64)
    order = np.lexsort((gram, node))
    return node[order], size[order], gram[order]


def _merged(table: pa.Table) -> pa.Table:
    """The grams of one part of the texts in one row."""
    node, size, gram = _by_node(table)
    return pa.Table.from_pydict(_blocks(np.full(len(node), table["part"][0].as_py()), node, size, grams=gram))


def _ordered(square: float):
    """(node, n, label, grams) of the texts of one part: the grams that other texts have as well, rarest first."""

    def run(table: pa.Table) -> pa.Table:
        node, size, gram = _by_node(table)
        new = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        sets = np.split(gram, new[1:])
        fit = np.flatnonzero(np.array([len(s) for s in sets]) >= np.ceil(size[new] * square))
        if not len(fit):
            return pa.schema({"node": pa.int64(), "n": pa.int32(), "label": pa.int64(), "grams": pa.list_(pa.int64())}).empty_table()
        label = np.minimum.reduceat(gram & _GRAM, new)[fit]
        return pa.Table.from_pydict({"node": pa.array(node[new][fit]), "n": pa.array(size[new][fit].astype(np.int32)), "label": pa.array(label), "grams": _lists([sets[i] for i in fit], pa.int64())})

    return run


def gram_sets(texts: DataFrame, least: float, k: int = 3) -> DataFrame:
    """(node, n, label, grams) of the texts (node long, text) that may have a set cosine of ``least`` with another.

    n is the size of the whole set, grams its members that other texts have as
    well, rarest first, label the least of their hashes; ``node`` is the text's
    digest.  Null is empty.
    """
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = min(1 << 15, -(-chars // PART_CHARS) + 1)
    rounds = min(ROUNDS, parts)

    def shared(turn: int) -> DataFrame:
        blocks = texts.mapInArrow(_dealt(k, parts, rounds, turn), _BLOCKS)
        return blocks.groupBy("part").applyInArrow(_counted(parts), _COUNTED)

    if rounds == 1:
        every = shared(0)
    else:
        every = reduce(DataFrame.union, [cut_lineage(shared(turn).groupBy("part").applyInArrow(_merged, _COUNTED)) for turn in range(rounds)])
    ordered = lambda rows: cut_lineage(rows.groupBy("part").applyInArrow(_ordered(least * least), "node long, n int, label long, grams array<long>"))
    return reduce(DataFrame.union, [ordered(every.where(F.col("part") % rounds == turn)) for turn in range(rounds)])


def _pairs(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> dict:
    """One row a part of distinct pairs."""
    order = np.lexsort((b, a, part))
    part, a, b = part[order], a[order], b[order]
    own = np.concatenate(([True], (part[1:] != part[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    part, a, b = part[own], a[own], b[own]
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    return {"part": pa.array(part[cuts].astype(np.int32)), "node_a": _lists(np.split(a, cuts[1:]), pa.int64()), "node_b": _lists(np.split(b, cuts[1:]), pa.int64())}


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (part, node_a, node_b) as rows of ``_pairs``."""
    held: list[list[np.ndarray]] = []
    waiting = 0
    packed = lambda: pa.RecordBatch.from_pydict(_pairs(*(np.concatenate(x) for x in zip(*held, strict=True))))
    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(i).to_numpy() for i in range(3)])
            waiting += batch.num_rows
        if waiting > BLOCK_GRAMS:
            yield packed()
            held, waiting = [], 0
    if waiting:
        yield packed()


def _united(table: pa.Table) -> pa.Table:
    """Rows of ``_pairs`` of one part as one."""
    a, b = _flat(table["node_a"], np.int64), _flat(table["node_b"], np.int64)
    return pa.Table.from_pydict(_pairs(np.full(len(a), table["part"][0].as_py()), a, b))


def _confirmed(square: float):
    """The pairs of one part, confirmed on the sets of that part."""

    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        nodes = sets["node"].to_numpy()
        order = np.argsort(nodes)
        sizes, names = sets["n"].to_numpy().astype(np.int64), sets["name"]
        lengths = np.concatenate([c.value_lengths().to_numpy() for c in sets["grams"].chunks] or [np.zeros(0, np.int64)]).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        local = np.unique(_flat(sets["grams"], np.int64), return_inverse=True)[1]
        a, b = (order[np.searchsorted(nodes, _flat(pairs[c], np.int64), sorter=order)] for c in ("node_a", "node_b"))
        # Pairs of several rounds are one.
        a, b = np.divmod(np.unique(a * max(1, len(nodes)) + b), max(1, len(nodes)))
        shared = np.zeros(len(a), dtype=np.int64)
        has = np.zeros(int(local.max(initial=-1)) + 1, dtype=bool)
        cuts = np.flatnonzero(np.concatenate((a[1:] != a[:-1], [True])[-len(a) :])) + 1
        for first, last in zip(np.concatenate(([0], cuts[:-1])), cuts, strict=True):
            own = local[starts[a[first]] : starts[a[first]] + lengths[a[first]]]
            has[own] = True
            for at in range(first, last, 1024):
                others = b[at : min(last, at + 1024)]
                heads = np.cumsum(lengths[others]) - lengths[others]
                where = np.arange(lengths[others].sum()) + np.repeat(starts[others] - heads, lengths[others])
                shared[at : at + len(others)] = np.add.reduceat(has[local[where]].astype(np.int64), heads)
            has[own] = False
        kept = np.flatnonzero(shared * shared >= square * sizes[a] * sizes[b])
        a, b = a[kept], b[kept]
        return pa.table({"name_a": names.take(pa.array(a)), "name_b": names.take(pa.array(b)), "n_a": pa.array(sizes[a]), "n_b": pa.array(sizes[b]), "shared": pa.array(shared[kept])})

    return run


def _tiled(sets: DataFrame) -> DataFrame:
    """``sets`` with a tile: texts of the same least gram, dealt over tiles of about TILE_TEXTS texts and TILE_GRAMS grams."""
    shares = sets.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / TILE_TEXTS), F.ceil(F.sum(F.size("grams")) / TILE_GRAMS)).alias("shares"))
    # One label in TILE_TEXTS texts or TILE_GRAMS grams has several shares at most, so these few are broadcast and no set is shuffled.
    several = sets.join(F.broadcast(shares.where("shares > 1")), "label", "left")
    return several.withColumn("tile", F.xxhash64("label", F.pmod(F.xxhash64("node"), F.coalesce("shares", F.lit(1))))).drop("label", "shares")


def set_pairs(texts: DataFrame, least: float, k: int = 3) -> DataFrame:
    """(name_a, name_b, n_a, n_b, shared) of each pair of different texts with a set cosine of ``least`` or more, in any order of the two.

    ``texts``: (node long, name, text), the node a digest of what makes texts
    different; the smallest name of a node stands for it.  n is the size of a whole set.
    Repeated rows are one, and an empty table gives none.
    """
    sets = gram_sets(texts.select("node", "text"), least, k)
    square = least * least
    longest = F.col("n") - F.ceil(F.col("n") * square) + 1
    size = sets.agg(F.sum(F.size("grams"))).first()[0] or 0
    # The pairs of two tiles are confirmed by one task, so a set goes once to each part that has pairs of it.
    parts = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TILE_GRAMS))
    # The grams of this text alone stand before all others.
    placed = _tiled(sets).withColumn("alone", F.col("n") - F.size("grams"))
    rounds = min(ROUNDS, size // BLOCK_GRAMS + 1)
    entries = placed.select("node", "n", "tile", "alone", "grams", F.posexplode(F.slice("grams", F.lit(1), F.greatest(F.lit(0), longest - F.col("alone")).cast("int"))).alias("at", "g"))
    # With the gram before: two texts that have the same one met there already.
    before = F.coalesce(F.get("grams", F.col("at") - 1), F.col("node"))
    entries = entries.select("g", "node", "n", "tile", (F.col("alone") + F.col("at") + 1).alias("place"), before.alias("before"))
    need = F.ceil(F.lit(least) * F.sqrt(F.col("n").cast("double") * F.col("s_n")) - 1e-9)
    smaller = ((F.col("s_n") < F.col("n")) | ((F.col("s_n") == F.col("n")) & (F.col("s_node") < F.col("node")))) & (F.col("s_n") >= square * F.col("n"))
    part = F.pmod(F.xxhash64(F.least("tile", "s_tile"), F.greatest("tile", "s_tile")), F.lit(parts)).cast("int")

    def met(turn: int) -> DataFrame:
        larger = entries.where(F.pmod("g", F.lit(rounds)) == turn)
        small = larger.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * least) + 1).select("g", *(F.col(c).alias(f"s_{c}") for c in ("node", "n", "tile", "place", "before")))
        meet = larger.join(small, "g").where("before != s_before").where(smaller & (F.col("place") <= F.col("n") - need + 1) & (F.col("s_place") <= F.col("s_n") - need + 1))
        packed = meet.select(part.alias("part"), F.col("node").alias("node_a"), F.col("s_node").alias("node_b")).mapInArrow(_gathered, _PAIRS)
        return cut_lineage(packed.groupBy("part").applyInArrow(_united, _PAIRS))

    wanted = reduce(DataFrame.union, [met(turn) for turn in range(rounds)])
    ends = wanted.select(F.col("part").alias("to"), F.explode(F.array_distinct(F.concat("node_a", "node_b"))).alias("node")).distinct()
    names = texts.select("node", "name").join(ends.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("name").alias("name"))
    sent = ends.join(sets.join(names, "node"), "node")
    kind = texts.schema["name"].dataType.simpleString()
    return wanted.groupBy("part").cogroup(sent.groupBy("to")).applyInArrow(_confirmed(square), f"name_a {kind}, name_b {kind}, n_a long, n_b long, shared long")
