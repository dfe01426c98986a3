"""SentencePiece encoding and decoding by a streaming Viterbi search."""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stocktally.llm.common import Shared, with_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_BLANK = "▁"
_CACHED = 100_000  # segments of one of two generations that a worker remembers
_KNOWN_PAIRS = 300_000


@dataclass
class Vocabulary:
    """Pieces that text can become, their scores, and the ids of single bytes for other characters."""

    pieces: dict[str, int]
    scores: dict[str, float]
    bytes_of: list[bytes]  # what an id stands for; a blank is a space
    byte_ids: list[int] | None
    unknown: int
    merges: bool  # scores rank merges of neighbours, else they are log probabilities
    longest: int = 0
    cuts: bool = True  # no piece has a blank after another character

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.cuts = not any(_BLANK in p.lstrip(_BLANK) for p in self.pieces)


def load(path: str = MODEL, merges: bool = True) -> Vocabulary:
    """Read a model file, in the driver. Its texts get one blank in front and are otherwise taken as they are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, scores, stands, byte_ids = {}, {}, [], {}
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            stands.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            stands.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
        else:
            pieces[piece] = i
            scores[piece] = model.get_score(i)
            stands.append(piece.replace(_BLANK, " ").encode())
    return Vocabulary(pieces, scores, stands, [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None, model.unk_id(), merges)


class Encoder:
    """Streaming Viterbi over the pieces of a vocabulary.

    For each position the search keeps the last piece of the one best path that ends there. With merge ranks a path is
    good if merging any two neighbouring pieces' characters gives these two pieces again; exactly one path to each
    position is, and it is what merging the whole prefix gives. With log probabilities the best sum wins.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs: dict[str | None, dict[str, bool]] = {}  # by the left piece
        self.known_pairs = 0
        self.histories: dict[str, tuple | None] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.trie: dict[str, list] = {}  # a letter: the piece that ends here or None, and what may follow
        for piece in vocabulary.pieces:
            node = [None, self.trie]
            for letter in piece:
                node = node[1].setdefault(letter, [None, {}])
            node[0] = piece
        self.matcher = None  # of all pieces that end at a position, longest first
        if vocabulary.pieces:
            import ahocorasick

            self.matcher = ahocorasick.Automaton()
            for piece in vocabulary.pieces:
                self.matcher.add_word(piece, (piece, len(piece)))
            self.matcher.make_automaton()
        self.floor = min(vocabulary.scores.values(), default=0.0) - 10  # of a character without a piece
        # No piece reaches over these borders: before a run of blanks, around a line end, and between a Latin letter
        # and such signs as no piece has after one.
        letter = "[A-Za-zÀ-ɏ]"
        after = {y for p in vocabulary.pieces for x, y in zip(p, p[1:], strict=False) if re.match(letter, x)}
        signs = "".join(c for c in ".,;:!?…" if c not in after)
        line = "" if any("\n" in p for p in vocabulary.pieces) else "\n"
        word = rf"{_BLANK}*{letter}++(?=[{signs}])|" if signs else ""
        self.cut = re.compile(rf"{word}{_BLANK}*[^{_BLANK}{line}]+|{_BLANK}+" + ("|\n" if line else "")) if vocabulary.cuts else None

    def history(self, piece: str):
        """How merging builds a piece, best score first and leftmost among equals: the score of each step and the
        first and last symbol before each step and at the end. None if merging does not give the piece."""
        known = self.histories.get(piece, 0)
        if known != 0:
            return known
        symbols, scores, steps = list(piece), self.v.scores, []
        firsts, lasts = [symbols[0]], [symbols[-1]]
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = scores.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            steps.append(best)
            firsts.append(symbols[0])
            lasts.append(symbols[-1])
        made = (steps, firsts, lasts) if len(symbols) == 1 else None
        self.histories[piece] = made
        return made

    def fits(self, before: str | None, piece: str) -> bool:
        """Whether merging both pieces' characters together gives the two again.

        Each side merges as it does alone, the better step first, until a merge across the border comes first.
        """
        row = self.pairs.get(before)
        if row is None:
            row = self.pairs[before] = {}
        known = row.get(piece)
        if known is None:
            right = self.history(piece)
            if right is None or before not in self.v.pieces:  # also at the beginning
                known = right is not None
            else:
                known = self._apart(self.history(before), right)
            if self.known_pairs > _KNOWN_PAIRS:
                self.pairs.clear()
                self.known_pairs = 0
                row = self.pairs[before] = {}
            self.known_pairs += 1
            row[piece] = known
        return known

    def _apart(self, left, right) -> bool:
        (l_steps, _, l_ends), (r_steps, r_ends, _) = left, right
        scores, i, j = self.v.scores, 0, 0
        while True:
            across = scores.get(l_ends[i] + r_ends[j])
            l_next = l_steps[i] if i < len(l_steps) else None
            r_next = r_steps[j] if j < len(r_steps) else None
            if across is not None and (l_next is None or across > l_next) and (r_next is None or across >= r_next):
                return False
            if l_next is None and r_next is None:
                return True
            if r_next is None or (l_next is not None and l_next >= r_next):
                i += 1
            else:
                j += 1

    def stream(self, text: str):
        """Yield the pieces of a text. Only positions after the last boundary that all paths share are kept.

        Paths grow from each position, left to right, by every piece that begins there; by the time a position is
        reached, all pieces that end at it have been seen.
        """
        scores, longest, merges = self.v.scores, self.v.longest, self.v.merges
        fits, size = self.fits, len(text)
        last: dict[int, str | None] = {0: None}  # of the best path to a position
        best = {0: 0.0}
        done = 0
        for start in range(size):
            if start not in last:  # no piece ends here: a character without a piece
                last[start] = text[start - 1]
                best[start] = best[start - 1] + self.floor
            before, so_far = last[start], best[start]
            follow = self.trie
            for end in range(start + 1, min(start + longest, size) + 1):
                node = follow.get(text[end - 1])
                if node is None:
                    break
                piece, follow = node
                if piece is not None:
                    if not merges:
                        if end not in best or so_far + scores[piece] > best[end]:
                            last[end], best[end] = piece, so_far + scores[piece]
                    elif end not in last and fits(before, piece):
                        last[end], best[end] = piece, 0.0
            if start - done > 4 * longest:
                # A path that can still grow ends after `start`, or at it.
                shared = None
                for live in range(start, min(start + longest, size) + 1):
                    if live in last:
                        bounds, at = {live}, live
                        while at > done:
                            at -= len(last[at])
                            bounds.add(at)
                        shared = bounds if shared is None else shared & bounds
                until = min(max(shared), start)
                yield from self._path(last, done, until)
                for at in range(done, until):
                    last.pop(at, None)
                    best.pop(at, None)
                done = until
        if size and size not in last:
            last[size] = text[size - 1]
        yield from self._path(last, done, size)

    def within(self, text: str) -> list[str]:
        """The pieces of a stretch that is shorter than the window, by merge ranks: stream() without a moving window.

        Here paths reach a position from all pieces that end there, longest first; by then all positions before are settled.
        """
        pairs, fits, size = self.pairs, self.fits, len(text)
        last: list[str | None] = [None] * (size + 1)
        nothing: dict[str, bool] = {}
        for end, (piece, length) in self.matcher.iter(text) if self.matcher else ():
            end += 1
            if last[end] is None:
                start = end - length
                before = last[start]
                if before is None and start:  # no piece ends there: a character without a piece
                    before = last[start] = text[start - 1]
                known = pairs.get(before, nothing).get(piece)
                if fits(before, piece) if known is None else known:
                    last[end] = piece
        out, at = [], size
        while at > 0:
            piece = last[at]
            if piece is None:
                piece = text[at - 1]
            out.append(piece)
            at -= len(piece)
        out.reverse()
        return out

    @staticmethod
    def _path(last: dict[int, str | None], done: int, at: int):
        out = []
        while at > done:
            out.append(last[at])
            at -= len(last[at])
        return reversed(out)

    def ids(self, text: str) -> list[int]:
        out, before = [], False
        for piece in self.within(text) if self.v.merges and len(text) <= 4 * self.v.longest else self.stream(text):
            i = self.v.pieces.get(piece)
            if i is not None:
                out.append(i)
            elif self.v.byte_ids is not None:
                out += [self.v.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not before:  # neighbouring unknown characters are one unknown piece
                out.append(self.v.unknown)
            before = i is None
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        text = _BLANK + text.replace(" ", _BLANK)
        if self.cut is None:
            return np.array(self.ids(text), np.int32)
        segments = self.cut.findall(text)
        cells = list(map(self.young.get, segments))
        for at, cell in enumerate(cells):
            if cell is None:
                cells[at] = self._segment(segments[at])
        return np.frombuffer(b"".join(cells), np.int32)

    def _segment(self, segment: str) -> bytes:
        cell = self.young.get(segment) or self.old.get(segment)
        if cell is None:
            cell = array("i", self.ids(segment)).tobytes()
        if len(segment) <= 64:
            if len(self.young) >= _CACHED:
                self.old, self.young = self.young, {}
            self.young[segment] = cell
        return cell


def text_of(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of ids; the blank in front goes."""
    raw = b"".join(map(vocabulary.bytes_of.__getitem__, ids))
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def encode_pieces(docs: DataFrame, *, vocabulary: Vocabulary | None = None, path: str = MODEL, verify: bool = False, keep: list[str] | None = None) -> DataFrame:
    """docs with ids, n_ids and, if asked for, round_trip (decoding gives the text again).

    The ids are those of the model's own library. Between blanks and line ends, which no piece reaches over, all
    paths meet; a worker remembers the ids of a bounded number of distinct stretches, from one task to the next. A stretch of any
    length is searched in a window that ends at the last boundary shared by all paths.

    A null text has null ids, n_ids 0 and a null round_trip; an empty text has no ids. Characters without a piece
    become their UTF-8 bytes. A text that holds U+2581 itself decodes to spaces there. Copies get the same ids.
    An empty table gives an empty result. Input columns of the new names are replaced.
    """
    shared = Shared(docs.sparkSession, vocabulary or load(path))

    def compute(texts):
        encoder = shared.kept(Encoder)
        cells = [encoder.encode(t) if t else np.zeros(0, np.int32) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int32)
        null = pa.array([t is None for t in texts])
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(cells)), mask=null)
        out = [ids, np.diff(offsets).astype(np.int64)]
        if verify:
            out.append([None if t is None else text_of(shared.value, c.tolist()) == t for t, c in zip(texts, cells, strict=True)])
        return out

    schema = "ids array<int>, n_ids long" + (", round_trip boolean" if verify else "")
    return with_columns(docs, "text", schema, compute, keep=keep)


def decode_pieces(df: DataFrame, *, ids: str = "ids", out: str = "decoded", vocabulary: Vocabulary | None = None, path: str = MODEL) -> DataFrame:
    """df with the text of its ids. Null ids give null; ids that are null or outside the vocabulary give nothing."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from stocktally.llm.common import without

    shared = Shared(df.sparkSession, vocabulary or load(path))
    kept = without(df, [out])
    names = kept.columns
    source = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{ids}`").cast("array<int>").alias("__ids"))

    def run(batches):
        v = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [None if c is None else text_of(v, [i for i in c if i is not None and 0 <= i < len(v.bytes_of)]) for c in part.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(names))], pa.array(texts, pa.string())], [*names, out])

    return source.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.StringType())]))
