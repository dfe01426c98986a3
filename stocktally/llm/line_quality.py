"""Quality rules, line first: drop bad lines, then documents that lose too much text."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from stocktally.llm.common import Words, mix64, with_columns

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """A line with words is removed if one of the rules holds; lines without words are neither kept nor lost."""

    window: int = 8
    min_words: int = 20
    max_repeat_percent: int = 30
    #: Punctuation: a line ends like a sentence, and less than this share of its words carries an exclamation mark.
    line_end: str = r"[.!?:;,\"')\]”»’…]$"
    max_exclaim_percent: int = 50
    #: Navigation: so many separators, and one for so many words.
    separators: str = r"[|»›•·>]"
    min_separators: int = 3
    words_per_separator: int = 4
    #: Boilerplate: the line holds one of these, in any case.
    boilerplate: tuple[str, ...] = (
        "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie", "subscribe now", "subscribe to",
        "sign up", "log in", "click here", "share this", "enable javascript",
    )
    #: A document that loses more of its words than this goes.
    max_lost_percent: int = 50


def repeated_words(words: Words, window: int) -> np.ndarray:
    """Per text: words that lie in a window of `window` words found twice or more in the text.

    Windows are compared by 64-bit hashes and then word by word. If two different windows share a hash, pairs of
    halves are ranked instead, which needs no hashes.
    """
    n, ids = len(words.ids), words.ids
    hit = np.zeros(n, bool)
    last = n - window + 1
    if last > 0:
        inside = words.docs[:last] == words.docs[window - 1 :]
        at = np.flatnonzero(inside)
        code = mix64(ids.astype(np.uint64) + np.uint64(1))
        h = mix64(words.docs[:last].astype(np.uint64) + np.uint64(77))
        for k in range(window):
            h = h * np.uint64(0x9E3779B97F4A7C15) + code[k : k + last]
        order = at[np.argsort(h[at], kind="stable")]
        same = h[order[1:]] == h[order[:-1]]
        first = order[np.flatnonzero(same)]
        second = order[np.flatnonzero(same) + 1]
        true = words.docs[first] == words.docs[second]
        for k in range(window):
            true &= ids[first + k] == ids[second + k]
        if not true.all():
            rank = ids
            reach = 1
            while reach < window:
                step = min(reach, window - reach)
                rank = np.unique(rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:], return_inverse=True)[1].astype(np.int64)
                reach += step
            _, group, sizes = np.unique(rank[at] * (len(words.lengths) + 1) + words.docs[at], return_inverse=True, return_counts=True)
            starts = at[sizes[group] > 1]
        else:
            starts = np.concatenate([first, second])
        edge = np.zeros(n + 1, np.int64)
        mark = np.zeros(n, bool)
        mark[starts] = True
        starts = np.flatnonzero(mark)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        hit = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.docs[hit], minlength=len(words.lengths))


def clean_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs with clean_text, counts of each rule and the verdict.

    New columns: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_punctuation, lost_navigation,
    lost_boilerplate (words of lines removed, by the first rule that holds in the order navigation, boilerplate,
    punctuation), base_failed, kept, clean_text. Null and empty texts have zero counts, clean_text "", base_failed
    true and kept false. Repeated rows are judged alike, each by itself. Input columns of these names are replaced.
    One pass without a shuffle.
    """
    end, separator, phrases = re.compile(rules.line_end), re.compile(rules.separators), rules.boilerplate

    def failing(line: str, n: int, suspect: bool) -> int:
        seps = len(separator.findall(line))
        if seps >= rules.min_separators and seps * rules.words_per_separator >= n:
            return 1
        if suspect and any(p in line.lower() for p in phrases):
            return 2
        if not end.search(line.rstrip(" \t\n\x0b\x0c\r")) or 100 * line.count("!") > rules.max_exclaim_percent * n:
            return 0
        return -1

    def compute(texts):
        words = Words(texts)
        repeats = repeated_words(words, rules.window)
        out = [[] for _ in range(7)]
        for t in texts:
            t = t or ""
            raw = t.encode("utf-8", "surrogatepass")
            low = t.lower()
            suspect = any(p in low for p in phrases)
            seen, dups, lost, good = set(), 0, [0, 0, 0], []
            for line, raw_line in zip(t.split("\n"), raw.split(b"\n"), strict=True):
                n = len(raw_line.split())
                if not n:
                    continue
                dups += line in seen
                seen.add(line)
                rule = failing(line, n, suspect)
                if rule < 0:
                    good.append(line)
                else:
                    lost[rule] += n
            spaces = len(raw) - len(raw.translate(None, _SPACE))
            row = (len(t) - spaces, len(raw) - len(raw.translate(None, _SYMBOLS)), dups, *lost, "\n".join(good))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        n = words.lengths
        failed = (n < rules.min_words) | (100 * repeats > rules.max_repeat_percent * n)
        lost = sum(np.array(out[i], np.int64) for i in (3, 4, 5))
        kept = ~failed & (100 * lost <= rules.max_lost_percent * n)
        return [n, out[0], out[1], out[2], repeats, out[3], out[4], out[5], failed, kept, out[6]]

    schema = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lost_punctuation long, "
        "lost_navigation long, lost_boilerplate long, base_failed boolean, kept boolean, clean_text string"
    )
    return with_columns(docs, text, schema, compute, keep=keep)
