"""Cross-tokenizer alignment: merge-path pieces over the token ends of two tokenizers, and corpus counts of linked ids."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stocktally.llm.common import BROADCAST_ROWS, Shared, with_columns, without
from stocktally.session import cut_lineage

WORK = 1 << 15  # ends of one merge-path piece
_BATCH = 1 << 20  # bytes of text encoded at a time
# Fixed value: how byte-level files without a pattern of their own cut a text before merging.
BYTE_LEVEL_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_TEXT, _LONG_RUN = 10_000, 2_000  # characters; the faster encoder is quadratic in a run that nothing cuts


@dataclass
class ByteBpe:
    """A byte-level BPE file of the tokenizers library, as text. Special tokens in texts are plain text."""

    text: str
    prefix: str = " "  # put before each text

    @classmethod
    def read(cls, path: str, prefix: str = " ") -> ByteBpe:
        with open(path, encoding="utf-8") as f:  # in the driver; executors get the content
            return cls(f.read(), prefix)

    def open(self) -> Side:
        """Encode with the file's own library, or where its entries rank its merges, with a faster one that gives the same ids."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(self.text)
        model.encode_special_tokens = True
        letters = byte_letters()
        stands = [b""] * model.get_vocab_size()
        special = {i for i, t in model.get_added_tokens_decoder().items() if t.special}
        for entry, i in model.get_vocab().items():
            if i not in special and all(c in letters for c in entry):
                stands[i] = bytes(letters[c] for c in entry)
        encode = getattr(model, "encode_batch_fast", model.encode_batch)
        slow = lambda texts: [e.ids for e in encode([self.prefix + t for t in texts], add_special_tokens=False)]
        if not self._ranked():
            return Side(slow, stands)
        import tiktoken

        ranks = {s: i for i, s in enumerate(stands) if s}
        fast = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def one(t: str) -> list[int]:
            if len(t) > _LONG_TEXT and (max(map(len, t.split()), default=0) > _LONG_RUN or re.search(rf"\s{{{_LONG_RUN}}}", t)):
                return slow([t])[0]
            return fast(self.prefix + t)

        return Side(lambda texts: [one(t) for t in texts], stands)

    def _ranked(self) -> bool:
        """Whether texts are cut by BYTE_LEVEL_CUT and nothing else, and the entries are single bytes, then merges in order."""
        file = json.loads(self.text)
        cut, model = file.get("pre_tokenizer") or {}, file["model"]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not file.get("normalizer")
        if not plain or model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix")):
            return False
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        single = [e for e, i in model["vocab"].items() if i < 256]
        return set(single) == set(byte_letters()) and all(model["vocab"].get(m) == 256 + k for k, m in enumerate(merges))


@dataclass
class PieceModel:
    """A piece model file, as bytes. The model puts its blank before each text itself."""

    model: bytes

    @classmethod
    def read(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls(f.read())

    def open(self) -> Side:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        stands = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                stands.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                stands.append(b"")  # no bytes of a text: such a text does not come back and gets no tokens
            else:
                stands.append(piece.replace("▁", " ").encode())
        return Side(lambda texts: model.encode(texts, num_threads=1), stands)


class Side:
    """An opened tokenizer: ids of texts, and the bytes that each id stands for."""

    def __init__(self, encode, stands: list[bytes]):
        self.encode, self.stands = encode, stands
        self.sizes = np.array([len(s) for s in stands], np.int64)


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level entries: itself if it prints, else the next letter from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in prints)
    return {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(others)}


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal d: how many of the first d values of the merge of two sorted arrays come from a (a first if equal)."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        first = np.zeros(len(mid), bool)
        first[open_] = a[mid[open_]] <= b[diagonals[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & first, mid + 1, low), np.where(open_ & ~first, mid, high)
    return low


def piece_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values that both strictly rising arrays of one piece hold."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    i = np.flatnonzero(b[at] == a)
    return i, at[i]


def links(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) with a[i] == b[j] in two strictly rising arrays of ends.

    Diagonals cut their merge into pieces of `work` values that know nothing of each other. An equal pair that a
    diagonal parts lies last in one piece and first in the next, and is stitched there.
    """
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total)
    i = merge_path(a, b, diagonals)
    j = diagonals - i
    found = []
    for k in range(len(diagonals) - 1):
        if k and i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]:
            found.append((i[k : k + 1] - 1, j[k : k + 1]))
        x, y = piece_links(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]])
        found.append((x + i[k], y + j[k]))
    return (np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])) if found else (diagonals[:0], diagonals[:0])


class Aligner:
    """Both tokenizers, opened once for each worker."""

    def __init__(self, sides: tuple):
        self.a, self.b, self.prefix = sides[0].open(), sides[1].open(), sides[0].prefix
        # Text of each id by what follows it: A in a group, A at its end, B in a group, B at its end.
        self.text = [f"{i}{c}".encode() for i in range(len(self.a.stands)) for c in ",|"]
        self.text += [f"{i}{c}".encode() for i in range(len(self.b.stands)) for c in ",;"]

    def tokens(self, texts: list[str | None]) -> list[list[np.ndarray]]:
        """For each side the ids of each text; none for texts that do not come back from both."""
        some = [k for k, t in enumerate(texts) if t]
        out = [[np.zeros(0, np.int64)] * len(texts) for _ in range(2)]
        plain = [texts[k] for k in some]
        found = [side.encode(plain) for side in (self.a, self.b)] if plain else [[], []]
        for k, *ids in zip(some, *found, strict=True):
            want = (self.prefix + texts[k]).encode()
            if all(b"".join(map(s.stands.__getitem__, x)) == want for s, x in zip((self.a, self.b), ids, strict=True)):
                for side in range(2):
                    out[side][k] = np.array(ids[side], np.int64)
        return out

    def align(self, texts: list[str | None], work: int = WORK, digest: bool = True) -> list:
        """n_a, n_b, n_groups, n_links, the groups, and each text's distinct linked ids with their counts."""
        n = len(texts)
        per_a, per_b = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in p], np.int64) for p in (per_a, per_b))
        ids_a, ids_b = np.concatenate(per_a), np.concatenate(per_b)
        # Ends count on over the texts of a batch; each text's end is one of both.
        i, j = links(np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b]), work)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[i] = last_b[j] = 1
        # In writing, a group's A ids come before its B ids.
        before_a, before_b = np.concatenate([[0], j + 1]), i + 1
        place_a = np.arange(len(ids_a)) + before_a[np.cumsum(last_a) - last_a]
        place_b = np.arange(len(ids_b)) + (before_b[np.cumsum(last_b) - last_b] if len(ids_b) else 0)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[place_a] = 2 * ids_a + last_a
        codes[place_b] = 2 * len(self.a.stands) + 2 * ids_b + last_b
        ends = np.cumsum(n_a + n_b)
        groups = []
        for start, end in zip((ends - n_a - n_b).tolist(), ends.tolist(), strict=True):
            text = b"".join(map(self.text.__getitem__, codes[start:end].tolist()))[:-1]
            groups.append((hashlib.sha256(text).hexdigest() if digest else text.decode()) if end > start else "")
        doc = np.repeat(np.arange(n), n_a)[i]
        n_links = np.bincount(doc, minlength=n)
        found, times = np.unique((doc << 48) | (ids_a[i] << 24) | ids_b[j], return_counts=True)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(found >> 48, minlength=n))]).astype(np.int32))
        low = (1 << 24) - 1
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v.astype(np.int32))) for v in (found >> 24 & low, found & low, times)]
        return [n_a, n_b, n_links, n_links, groups, *lists]


def align_tokenizers(docs: DataFrame, a: ByteBpe, b: PieceModel, *, digest: bool = False, work: int = WORK, keep: list[str] | None = None) -> DataFrame:
    """The kept columns of docs (all by default) with n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    a and b give the bytes of a text with one blank in front. Where ends of both meet, groups end. groups is
    `a1,a2|b1;a3|b2,b3`, ids in order, or with digest=True the SHA-256 of that (as groups_sha256). A link is a token of
    a and one of b that end together; n_best counts those whose pair of ids has its b id's largest number of links in
    the whole table, ties included, and count_sum adds up the pairs' numbers over the links.

    Ends are merged in pieces of `work` ends, so the work of a piece does not depend on how long a text is. Distinct
    pairs of a text are counted in its task, pairs of the table in one aggregate. The most frequent pairs, at most
    BROADCAST_ROWS, meet the texts in a broadcast; all others in an adaptive shuffle join.

    Null and empty texts, and texts that a or b do not give back byte for byte, have no tokens: zeros and an empty
    string. Rows are aligned and counted one by one, also repeated ones and ones without an id. A text is encoded as
    a whole, whatever its length. An empty table gives an empty result. Input columns of the new names are replaced.
    """
    shared = Shared(docs.sparkSession, (a, b))
    name = "groups_sha256" if digest else "groups"
    new = ["n_a", "n_b", "n_groups", "n_links", name]
    schema = ", ".join(f"{c} long" for c in new[:4]) + f", {name} string, __a array<int>, __b array<int>, __m array<int>"
    kept = without(docs, ["__row", "n_best", "count_sum", *[c for c in docs.columns if keep is not None and c not in {*keep, "text"}]])
    aligned = with_columns(kept, "text", schema, lambda texts: shared.kept(Aligner).align(texts, work, digest), keep=keep, most=_BATCH)
    aligned = cut_lineage(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned")
    linked = aligned.select("__row", F.inline(F.arrays_zip("__a", "__b", "__m")))
    pairs = linked.groupBy("__a", "__b").agg(F.sum("__m").alias("__n"))
    pairs = cut_lineage(pairs, "pairs")
    best = pairs.groupBy("__b").agg(F.max("__n").alias("__most"))
    pairs = cut_lineage(pairs.join(best, "__b").select("__a", "__b", "__n", (F.col("__n") == F.col("__most")).cast("int").alias("__best")), "pairs")
    count, best_sum = F.sum(F.col("__m") * F.col("__n")).alias("count_sum"), F.sum(F.col("__m").cast("long") * F.col("__best")).alias("n_best")
    if pairs.count() <= BROADCAST_ROWS:
        sums = linked.join(F.broadcast(pairs), ["__a", "__b"]).groupBy("__row").agg(count, best_sum)
    else:
        often = cut_lineage(pairs.orderBy(F.desc("__n"), "__a", "__b").limit(BROADCAST_ROWS), "often")
        seldom = pairs.join(F.broadcast(often.select("__a", "__b")), ["__a", "__b"], "left_anti")
        other = linked.join(F.broadcast(often.select("__a", "__b")), ["__a", "__b"], "left_anti").join(seldom, ["__a", "__b"])
        parts = [x.groupBy("__row").agg(count, best_sum) for x in (linked.join(F.broadcast(often), ["__a", "__b"]), other)]
        sums = parts[0].unionByName(parts[1]).groupBy("__row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    out = aligned.drop("__a", "__b", "__m").join(sums, "__row", "left")
    names = [c for c in aligned.columns if c not in {"__a", "__b", "__m", "__row"}]
    return out.select(*[F.col(f"`{c}`") for c in names], *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")])
