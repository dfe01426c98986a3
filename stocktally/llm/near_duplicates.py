"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact comparison of shingle sets decides."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stocktally.llm.common import Words, join_small, mix64, with_columns, word_hashes
from stocktally.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
_STEP = 3  # levels by which a crowded prefix grows
_CELLS = 4_000_000  # of one dense block of set memberships


def depth_for(trees: int, deepest: int, threshold: float, recall: float) -> int:
    """How far matched prefixes are shortened: from the deepest level down until pairs at the threshold share a
    prefix in one of the trees with the target probability."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def trees_for(depth: int, threshold: float, recall: float) -> int:
    """How many trees give pairs at the threshold a common prefix of this depth with the target probability."""
    missed = 1 - threshold**depth
    return 1 if missed <= 0 else max(1, math.ceil(math.log(max(1 - recall, 1e-12)) / math.log(missed)))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each text; a shorter text is one n-gram, an empty one none."""
    words = Words(texts)
    if not len(words.ids):
        return [np.zeros(0, np.uint64)] * len(texts)
    token = mix64(word_hashes(words.distinct))[words.ids]
    n = len(token)
    rolled = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        rolled[: n - k] = rolled[: n - k] * np.uint64(0x9E3779B97F4A7C15) + token[k:]
    rolled = mix64(rolled)
    out = []
    for start, length in zip(words.starts.tolist(), words.lengths.tolist(), strict=True):
        if length >= size:
            out.append(np.unique(rolled[start : start + length - size + 1]))
        elif length:
            code = np.uint64(length)
            with np.errstate(over="ignore"):
                for t in token[start : start + length]:
                    code = code * np.uint64(0x9E3779B97F4A7C15) + t
            out.append(mix64(np.array([code], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(s: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    with np.errstate(over="ignore"):
        return np.array([s.sum(dtype=np.uint64), mix64(s ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64).tobytes()


def sketches(docs: DataFrame, size: int, trees: int, depth: int, seed: int, keep: list[str] = ["doc_id", "__x", "__y"]) -> DataFrame:
    """(kept columns, __class, __n, __nodes): key and size of the shingle set, and the trie node reached in each tree."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salts = rng.integers(0, 1 << 63, trees * depth, dtype=np.uint64)
    chunk = max(64, _CELLS // 10 // (trees * depth))

    def compute(texts):
        keys, sizes, nodes = [], [], []
        for s in shingle_sets(texts, size):
            keys.append(set_key(s))
            sizes.append(len(s))
            if not len(s):
                nodes.append([])
                continue
            lows = np.full(trees * depth, np.iinfo(np.uint64).max, np.uint64)
            for a in range(0, len(s), chunk):
                lows = np.minimum(lows, ((s[a : a + chunk, None] ^ salts) * factors).min(axis=0))
            prefix = mix64(np.arange(trees, dtype=np.uint64) + np.uint64(1))
            for level in lows.reshape(trees, depth).T:
                prefix = mix64(prefix ^ mix64(level))
            nodes.append(prefix.view(np.int64))
        return [keys, sizes, nodes]

    return with_columns(docs, "text", "__class binary, __n long, __nodes array<long>", compute, keep=keep)


def forest(
    classes: DataFrame, rows: DataFrame, *, shingle: int, threshold: float, trees: int, depth: int, deepest: int, crowd: int, seed: int
) -> DataFrame:
    """(__class, __head, __depth): ties between classes that share a prefix, and the depth to which it was shortened.

    The target recall allows prefixes of `depth` in the given trees. Where a node holds more than `crowd` classes, its
    classes are crowded and keep longer prefixes, up to `deepest`, in as many more trees as give the same recall. Two
    classes meet at the first depth at which one of them is not crowded. The hash functions of a depth are its own, so
    that a crowd found at one depth says nothing about matches at the next: a pair at the threshold is missed with the
    sum of the depths' probabilities at most. Longer prefixes are made of the texts (`rows`: row key, text) of crowded
    classes only. Nodes are counted before they are joined, and a node of any size becomes a star.
    """
    missed = (1 - threshold**depth) ** trees
    members = classes.select("__class", F.explode("__nodes").alias("__node"))
    texts, found = None, []
    while True:
        nodes = cut_lineage(
            members.groupBy("__node").agg(F.min("__class").alias("__head"), F.count(F.lit(1)).alias("__m")).filter(F.col("__m") > 1), "nodes"
        )
        full = nodes.filter(F.col("__m") > crowd).select("__node")
        if depth >= deepest or full.isEmpty():
            found.append(_stars(members, nodes, depth))
            return reduce(DataFrame.unionByName, found)
        crowded = cut_lineage(join_small(members, full, "__node", "left_semi").select("__class").distinct(), "crowded")
        # A star's head is not crowded: crowded classes meet each other here only through one that is not.
        shared = join_small(members, nodes.filter(F.col("__m") <= crowd).select("__node"), "__node", "left_semi")
        heads = join_small(shared, crowded, "__class", "left_anti").groupBy("__node").agg(F.min("__class").alias("__head"))
        found.append(_stars(shared, heads, depth))
        if texts is None:
            shown = join_small(classes, crowded, "__class", "left_semi").select("__class", "__shown.*")
            texts = cut_lineage(join_small(rows, shown, ["__x", "__y"], "inner").select("__class", "text"), "crowd")
        else:
            texts = join_small(texts, crowded, "__class", "left_semi")
        depth, seed = min(depth + _STEP, deepest), seed + 1
        longer = sketches(texts, shingle, trees_for(depth, threshold, 1 - missed), depth, seed, keep=[])
        longer = cut_lineage(longer.select("__class", "__nodes").dropDuplicates(["__class"]), "longer")  # equal rows show one class
        members = longer.select("__class", F.explode("__nodes").alias("__node"))


def _stars(members: DataFrame, heads: DataFrame, depth: int) -> DataFrame:
    """Stars of the nodes, contracted: a class is tied to the smallest head of its nodes, and that head to the others.

    The classes of a large group share few smallest heads, so that a class costs about one row, however many trees it is in.
    """
    joined = join_small(members, heads.select("__node", "__head"), "__node", "inner")
    met = joined.groupBy("__class").agg(F.collect_set("__head").alias("__heads")).withColumn("__least", F.array_min("__heads"))
    ties = met.select("__class", F.col("__least").alias("__head"))
    ties = ties.unionByName(met.select(F.explode("__heads").alias("__class"), F.col("__least").alias("__head")).distinct())
    return ties.filter(F.col("__class") != F.col("__head")).select("__class", "__head", F.lit(depth).alias("__depth")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the smallest node of each connected component, by neighbour minima and pointer jumping.

    Each round is written to the shared folder, so that an executor's loss costs one round. The number of rounds
    grows with the logarithm of the longest chain.
    """
    pairs = edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
    both = pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = cut_lineage(both.unionByName(both.select("src", F.col("src").alias("dst"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy("src").agg(F.min("dst").alias("label")).withColumnRenamed("src", "node"), "labels")
    while True:
        step = both.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(
            F.min("label").alias("near"), F.max(F.when(F.col("src") == F.col("dst"), F.col("label"))).alias("own")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        step = step.join(jump, F.col("near") == F.col("via"), "left").select(
            F.col("src").alias("node"), F.least("near", F.coalesce("beyond", "near")).alias("label"), "own"
        )
        step = cut_lineage(step, "labels")
        labels = step.select("node", "label")
        if step.filter(F.col("label") != F.col("own")).isEmpty():
            return labels


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of one bounded block of sets."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    column = (np.cumsum(common) - 1)[at]
    hit = common[at]
    owner, column = owner[hit], column[hit]
    width = max(1, _CELLS // n)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for a in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        member = np.zeros((n, min(width, int(common.sum()) - a)), np.float32)
        member[owner[lo:hi], column[lo:hi] - a] = 1
        out += member @ member.T
    return out


def _verify(size: int, threshold: float):
    """Over rows sorted by (__comp, __i, __j): links of each class within a block, or between two blocks."""
    names = ["__class", "__links", "__class_links", "__root"]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def block(i: int, j: int, rows: list[tuple]):
        """rows: (class, copies, block, text); a class twice is one class."""
        sets = shingle_sets([r[3] for r in rows], size)
        keep, seen = [], set()
        for at, (row, s) in enumerate(zip(rows, sets, strict=True)):
            if row[0] not in seen and set_key(s) == row[0]:
                seen.add(row[0])
                keep.append(at)
        rows, sets = [rows[at] for at in keep], [sets[at] for at in keep]
        if len(rows) < 2:
            return []
        inter = overlaps(sets).astype(np.float64)
        n = np.array([len(s) for s in sets], np.float64)
        linked = inter >= threshold * (n[:, None] + n[None, :] - inter) - 1e-9
        np.fill_diagonal(linked, False)
        if i != j:
            side = np.array([r[2] == i for r in rows])
            linked &= side[:, None] != side[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        if not len(some):
            return []
        copies = np.array([r[1] for r in rows], np.int64)
        order = np.array(sorted(range(len(rows)), key=lambda x: rows[x][0]))
        label = np.empty(len(rows), np.int64)
        label[order] = np.arange(len(rows))
        while True:
            near = np.minimum(label, np.where(linked, label[None, :], len(rows)).min(axis=1))
            if (near == label).all():
                break
            label = near
        return [(rows[x][0], int(copies[linked[x]].sum()), int(linked[x].sum()), rows[order[label[x]]][0]) for x in some]

    def run(batches):
        key, held, out = None, [], []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in range(7)], strict=True):
                if row[:3] != key:
                    if key is not None and len(held) > 1:
                        out += block(key[1], key[2], held)
                    key, held = row[:3], []
                held.append(row[3:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
        if key is not None and len(held) > 1:
            out += block(key[1], key[2], held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


def near_duplicates(
    docs: DataFrame, *, shingle: int = SHINGLE, threshold: float = THRESHOLD, trees: int = 20, deepest: int = 14, recall: float = 0.999,
    block: int = 64, crowd: int = 256, seed: int = 0,
) -> DataFrame:
    """One row per document: doc_id, class_id, copy_of, n_copies, n_links, n_shingles.

    Texts with equal sets of `shingle`-word shingles form one class of copies (copy_of: its smallest id). Signatures
    of the classes enter `trees` prefix tries; prefixes are shortened to the depth at which a pair at the threshold
    meets in some tree with probability `recall`; classes in nodes of more than `crowd` classes keep longer prefixes,
    up to `deepest`, in more trees for the same recall (see `forest`). Candidates that hang together are compared exactly,
    in blocks of about `block` classes against one another, so that a group of any size is spread over tasks and no
    pair is ever a row. class_id is the smallest id of the documents linked, directly or through others, with
    Jaccard similarity at or above the threshold; n_links counts all other documents that reach it, copies included.

    A text of fewer words than a shingle is one shingle. Null and empty texts have no shingles, class and links of
    their own. Repeated rows are copies of each other, and rows of one id with different texts are documents of their
    own. Rows without an id are linked like others; they are never the smallest id, and class_id and copy_of are null
    where no row of the group or class has one. Texts of any length are compared whole. An empty table gives an empty
    result. Other columns are ignored.
    """
    marked = _marked(docs, shingle, threshold, trees, deepest, recall, block, crowd, seed)
    return marked.select(
        "doc_id",
        F.coalesce("__group", "__first", "doc_id").alias("class_id"),
        F.coalesce("__first", "doc_id").alias("copy_of"),
        F.coalesce("__copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("__copies", F.lit(1)) - 1 + F.coalesce("__links", F.lit(0))).alias("n_links"),
        F.col("__n").alias("n_shingles"),
    )


def _row_key() -> list:
    """128 bits of id and text."""
    return [F.xxhash64(F.lit(s), F.col("doc_id"), F.col("text")).alias(n) for s, n in ((31, "__x"), (37, "__y"))]


def _marked(docs: DataFrame, shingle: int, threshold: float, trees: int, deepest: int, recall: float, block: int, crowd: int, seed: int) -> DataFrame:
    """One row per document: doc_id, row key, class, its size, and where there are copies or links: class facts, label of the group."""
    depth = depth_for(trees, deepest, threshold, recall)
    plain = docs.select("doc_id", "text")
    sketched = cut_lineage(sketches(plain.select("doc_id", "text", *_row_key()), shingle, trees, depth, seed), "sketches")
    classes = cut_lineage(
        sketched.filter(F.col("__n") > 0).groupBy("__class").agg(
            F.min("doc_id").alias("__first"), F.count(F.lit(1)).alias("__copies"), F.first("__nodes").alias("__nodes"),
            F.min(F.struct("__x", "__y")).alias("__shown"),  # the row whose text stands for the class
        ), "classes",
    )
    rows = plain.filter(F.col("text").isNotNull()).select(*_row_key(), "text")
    found = forest(
        classes, rows, shingle=shingle, threshold=threshold, trees=trees, depth=depth, deepest=deepest, crowd=crowd, seed=seed
    )
    edges = cut_lineage(found.select("__class", "__head").distinct(), "candidates")
    groups = components(edges, "__class", "__head").select(F.col("node").alias("__class"), F.col("label").alias("__comp"))
    sizes = groups.groupBy("__comp").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("__blocks"))
    candidates = cut_lineage(
        join_small(groups, sizes, "__comp", "inner")
        .join(classes.select("__class", "__copies", F.col("__shown.__x").alias("__x"), F.col("__shown.__y").alias("__y")), "__class")
        .withColumn("__block", F.pmod(F.xxhash64("__class"), F.col("__blocks")).cast("int")), "members",
    )
    texts = join_small(rows, candidates, ["__x", "__y"], "inner")
    # Rows equal in id and text show the same class more than once.
    texts = texts.drop("__x", "__y").dropDuplicates(["__class"])
    other = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    dealt = (
        texts.withColumn("__other", other)
        .withColumns({"__i": F.least("__block", "__other"), "__j": F.greatest("__block", "__other")})
        .select("__comp", "__i", "__j", "__class", "__copies", "__block", "text")
        .repartition("__comp", "__i", "__j").sortWithinPartitions("__comp", "__i", "__j")
    )
    verified = cut_lineage(dealt.mapInArrow(_verify(shingle, threshold), "__class binary, __links long, __class_links long, __root binary"), "verified")
    linked = verified.groupBy("__class").agg(F.sum("__links").alias("__links"))
    roots = components(verified.select("__class", "__root"), "__class", "__root")
    firsts = classes.select("__class", "__first", "__copies")
    grouped = roots.select(F.col("node").alias("__class"), F.col("label").alias("__label")).join(firsts, "__class")
    # One row per group, stored: the join is a broadcast, or one that can be split where a group is large.
    named = grouped.groupBy("__label").agg(F.min("__first").alias("__group"))
    grouped = join_small(grouped, named, "__label", "inner").select("__class", "__group", "__label")
    info = (
        firsts.join(linked, "__class", "left").join(grouped, "__class", "left")
        .filter((F.col("__copies") > 1) | F.col("__links").isNotNull())
        .select("__class", "__first", "__copies", "__links", "__group", F.coalesce("__label", "__class").alias("__label"))
    )
    return join_small(sketched.drop("__nodes"), info, "__class")


def keep_one(
    docs: DataFrame, *, shingle: int = SHINGLE, threshold: float = THRESHOLD, trees: int = 20, deepest: int = 14, recall: float = 0.999, block: int = 64,
    crowd: int = 256, seed: int = 0,
) -> DataFrame:
    """docs with one row of each group of near duplicates: the one with the smallest id, of equal ids one.

    Rows go one by one, not by their id: a row that is like no other stays, whatever other rows share its id. Rows
    without an id stay only where their whole group has none. Null and empty texts are like no other and stay. Only
    digests of the rows that go are joined with the texts.
    """
    marked = cut_lineage(
        _marked(docs, shingle, threshold, trees, deepest, recall, block, crowd, seed).filter(F.col("__label").isNotNull()).select("doc_id", "__x", "__y", "__label"), "marked"
    )
    none = F.col("doc_id").isNull()
    best = marked.groupBy("__label").agg(F.min(F.struct(none.alias("none"), F.col("doc_id"), "__x", "__y")).alias("__best"))
    judged = join_small(marked, best, "__label", "inner").withColumn("__stays", (F.col("__x") == F.col("__best.__x")) & (F.col("__y") == F.col("__best.__y")))
    keys = judged.groupBy("__x", "__y").agg(F.max("__stays").alias("__stays"), F.count(F.lit(1)).alias("__times"))
    gone = keys.filter(~F.col("__stays")).select("__x", "__y")
    again = keys.filter(F.col("__stays") & (F.col("__times") > 1)).select("__x", "__y")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), *_row_key())
    kept = join_small(rows, gone, ["__x", "__y"], "left_anti")
    again = cut_lineage(again, "again")
    if not again.isEmpty():  # equal rows: one of them
        twice = join_small(kept, again, ["__x", "__y"], "left_semi").dropDuplicates(["__x", "__y"])
        kept = join_small(kept, again, ["__x", "__y"], "left_anti").unionByName(twice)
    return kept.select(*[F.col(f"__row.`{c}`").alias(c) for c in names])
