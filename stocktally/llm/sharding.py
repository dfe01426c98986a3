"""Sharding by a k-d tree: cells are split at weighted medians along their widest metadata dimension."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stocktally.llm.common import positions, without
from stocktally.session import cut_lineage

_BITS = 10  # of a dimension's code that one pass over the data resolves
_DEPTH = 60  # bits of a code


@dataclass
class Cell:
    """shards leaves lie below it; rows with code < cut of dimension go to below[0]."""

    shards: int
    first: int
    weight: int = 0
    dimension: int | None = None
    cut: int = 0
    below: tuple[Cell, Cell] | None = None


def text_size(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 16


def codes(text: str, numbers: list[Column], doc_id: str) -> list[Column]:
    """One 60-bit code for each dimension: its value in the high bits, then a digest of the text, then one of the id.

    Rows with equal texts lie next to each other in every dimension; the digest of the id orders them among
    themselves, so that a large group can still be cut.
    """
    digest = F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long")
    tie = digest * F.lit(1 << 12) + F.pmod(F.xxhash64(F.lit(3), F.col(doc_id)), F.lit(1 << 12))
    return [F.least(F.greatest(n.cast("long"), F.lit(0)), F.lit((1 << 16) - 1)) * F.lit(1 << 44) + tie for n in numbers]


def log_scale(value: Column) -> Column:
    """0 to 65535, a step for about 0.1 %."""
    return F.floor(F.log2(value.cast("double") + 1) * 1024).cast("long")


def _leaf(cells: list[Cell], position: str = "__cell") -> Column:
    """The number of the open cell a row lies in, as one expression over the codes."""
    def walk(cell: Cell) -> Column:
        if cell.below is None:
            return F.lit(cell.first)
        return F.when(F.col(f"__d{cell.dimension}") < F.lit(cell.cut), walk(cell.below[0])).otherwise(walk(cell.below[1]))

    return walk(cells[0]).alias(position)


def _split(meta: DataFrame, root: Cell, open_cells: list[Cell], dims: int) -> None:
    """Choose dimension and cut of every open cell: all cells of a level share the passes over the data."""
    spans = {
        r["__cell"]: r for r in meta.select(_leaf([root]), *[f"__d{d}" for d in range(dims)], "__size").groupBy("__cell").agg(
            F.sum("__size").alias("weight"),
            *[f(F.shiftright(f"__d{d}", 44)).alias(f"{n}{d}") for d in range(dims) for n, f in (("lo", F.min), ("hi", F.max))],
        ).collect()  # one row per open cell
    }
    search: dict[int, list[int]] = {}  # cell -> [weight below the prefix, prefix, bits known, weight wanted]
    for cell in open_cells:
        span = spans.get(cell.first)
        width = [span[f"hi{d}"] - span[f"lo{d}"] if span else 0 for d in range(dims)]
        cell.dimension = width.index(max(width))
        cell.weight = span["weight"] if span else 0
        search[cell.first] = [0, 0, 0, cell.weight * (cell.shards // 2) // cell.shards]
    by_first = {c.first: c for c in open_cells}
    todo = set(by_first)
    while todo:
        shift = lambda c: _DEPTH - search[c][2] - _BITS
        groups = F.lit(None).cast("long")
        for c in todo:
            code = F.col(f"__d{by_first[c].dimension}")
            inside = F.lit(True) if not search[c][2] else F.shiftright(code, _DEPTH - search[c][2]) == F.lit(search[c][1])
            groups = F.when((F.col("__cell") == c) & inside, F.shiftright(code, shift(c)) % F.lit(1 << _BITS)).otherwise(groups)
        bins = (
            meta.select(_leaf([root]), *[f"__d{d}" for d in range(dims)], "__size").withColumn("__bin", groups)
            .filter(F.col("__bin").isNotNull()).groupBy("__cell", "__bin").agg(F.sum("__size").alias("w")).collect()
        )  # at most 1024 rows per open cell
        per: dict[int, list[tuple[int, int]]] = {}
        for r in bins:
            per.setdefault(r["__cell"], []).append((r["__bin"], r["w"]))
        for c in list(todo):
            below, prefix, known, wanted = search[c]
            cut, tolerance = None, by_first[c].weight // (by_first[c].shards * 200)
            for b, w in sorted(per.get(c, [])):
                if below + w > wanted:
                    cut = b
                    break
                below += w
            if cut is None:
                cut, w = 1 << _BITS, 0
            known += _BITS
            prefix = prefix * (1 << _BITS) + cut
            search[c] = [below, prefix, known, wanted]
            # Close enough on either side of the bin, or every bit is known.
            if wanted - below <= tolerance:
                by_first[c].cut = prefix << (_DEPTH - known)
            elif below + w - wanted <= tolerance:
                by_first[c].cut = (prefix + 1) << (_DEPTH - known)
            elif known >= _DEPTH or not w:
                nearer = prefix + (below + w - wanted < wanted - below)
                by_first[c].cut = nearer << (_DEPTH - known)
            else:
                continue
            todo.discard(c)
    for cell in open_cells:
        left = cell.shards // 2
        cell.below = (Cell(left, cell.first), Cell(cell.shards - left, cell.first + left))


def grow_tree(meta: DataFrame, dims: int, shards: int) -> Cell:
    root = Cell(shards, 0)
    level = [root] if shards > 1 else []
    while level:
        _split(meta, root, level, dims)
        level = [c for cell in level for c in cell.below if c.shards > 1]
    return root


def shard_documents(
    docs: DataFrame, *, shards: int | None = None, target_bytes: int = 1 << 30, numbers: list[Column] | None = None, per_bucket: int = 2_000,
) -> DataFrame:
    """docs with size, text_crc32, shard and slot. Shards are cells of a k-d tree with nearly equal bytes.

    numbers are the metadata dimensions (by default size and lines of the text on a log scale), as 16-bit values. A cell of k
    shards is cut where k // 2 shares of its bytes lie below, along the dimension with the largest spread, until a
    leaf holds the target; without `shards` their number is the sum of sizes over target_bytes, rounded up. The
    weighted medians come from histograms that are refined ten bits at a time; only they reach the driver.
    Equal texts lie side by side in every dimension, so a group is cut only where a boundary must pass through it.

    size is the UTF-8 bytes of the text plus 16; a null text has size 16 and crc32 0. Rows with the same id and text
    share a shard, or are cut nowhere; slots are gapless from 0 in each shard. An empty table gives an empty result.
    Input columns of the new names are replaced.
    """
    new = ["size", "text_crc32", "shard", "slot"]
    docs = without(docs, new).withColumn("size", text_size("text"))
    docs = docs.withColumn("text_crc32", F.coalesce(F.crc32(F.col("text")), F.lit(0)).cast("long"))
    lines = F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))), F.lit(0))
    numbers = numbers or [log_scale(F.col("size")), log_scale(lines)]
    dims = [c.alias(f"__d{i}") for i, c in enumerate(codes("text", numbers, "doc_id"))]
    meta = cut_lineage(docs.select(F.col("size").alias("__size"), *dims), "shard-meta")
    if shards is None:
        total = meta.agg(F.sum("__size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    root = grow_tree(meta, len(numbers), shards)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    placed = docs.select(*columns, *dims).select(*columns, _leaf([root], "shard"))
    return positions(placed, ["shard"], [F.col("doc_id")], ["doc_id"], "slot", per_bucket)
