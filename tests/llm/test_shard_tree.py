"""Shards against a second k-d tree, which sorts whole cells in one process."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from stocktally.llm.sharding import shard_documents


def step(value):
    return min(math.floor(math.log2(value + 1) * 1024), (1 << 16) - 1)


def forced(rows, shards, first=0):
    """{row: shard}: a cell is cut at the border between codes whose bytes below are nearest to the wanted share."""
    if shards == 1 or not rows:
        return {r["row"]: first for r in rows}
    spread = [max(r["at"][d][0] for r in rows) - min(r["at"][d][0] for r in rows) for d in range(2)]
    widest = spread.index(max(spread))
    left = shards // 2
    wanted = sum(r["size"] for r in rows) * left // shards
    sums = {}
    for r in rows:
        sums[r["at"][widest]] = sums.get(r["at"][widest], 0) + r["size"]
    below, best, cut = 0, wanted, None
    for code in sorted(sums):
        below += sums[code]
        if abs(below - wanted) < best:
            best, cut = abs(below - wanted), code
    lower = [r for r in rows if cut is not None and r["at"][widest] <= cut]
    upper = [r for r in rows if cut is None or r["at"][widest] > cut]
    return forced(lower, left, first) | forced(upper, shards - left, first + left)


def sample(kind):
    rng = random.Random(11)
    words = ["stock", "of", "grain", "größe", "", "a\nb", "line\n\n"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(0, 12)))
    data = [(i, text() + "\n" * rng.randint(0, 5)) for i in range(240)]
    if kind == "hot":  # one text holds more than a third of all rows
        data += [(1000 + i, "the same text in all of these") for i in range(160)]
    elif kind == "odd":  # nulls, empty and long texts, repeated rows, rows without an id
        data += [(i, None) for i in range(300, 330)] + [(i, "") for i in range(330, 350)] + data[:20]
        data += [(None, f"without an id {i}") for i in range(12)] + [(400, "long " * 300), (401, "\n" * 900)]
    return data


@pytest.mark.parametrize("kind, shards, every", [("plain", 3, 5), ("hot", 3, 5), ("hot", 13, 1), ("odd", 13, 1), ("plain", 40, 1)])
def test_shards_are_those_of_a_second_tree(spark, kind, shards, every):
    data = [(i, *row) for i, row in enumerate(sample(kind)[::every])]
    docs = spark.createDataFrame(data, "row long, doc_id long, text string").repartition(4)
    ties = {r["row"]: r["tie"] for r in docs.select("row", F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4096)).alias("tie")).collect()}
    rows = []
    for row, _, text in data:
        size = len((text or "").encode()) + 16
        tie = (zlib.crc32((text or "").encode()), ties[row])
        rows.append({"row": row, "size": size, "at": [(step(size), *tie), (step((text or "").count("\n")), *tie)]})
    # A cut may miss by this much; below the smallest size it cannot fall on another border.
    assert sum(r["size"] for r in rows) // (shards * 200) < 8
    got = {r["row"]: r for r in shard_documents(docs, shards=shards).collect()}
    want = forced(rows, shards)
    assert {k: r["shard"] for k, r in got.items()} == want
    assert all(got[r["row"]]["size"] == r["size"] and got[r["row"]]["text_crc32"] == r["at"][0][1] for r in rows)
