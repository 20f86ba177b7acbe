r"""Quality rules by suffix-array repetition.

The suffix array of each text's words is built by prefix doubling, for a whole Arrow batch at once:
the first sort keys are (text, word), so suffixes of different texts never share a group, and each
round sorts only suffixes that are still tied. Longest common prefixes of neighbours come from the
ranks kept per round. A suffix lies in an LCP interval of depth max(lcp left, lcp right), which is its
longest repeated prefix; the union of these prefixes is the union of the maximal repeats' spans.

Words are runs of ``[^\x20\x09-\x0D]``. Null and empty texts have no words and fail the base rule.
Repeated rows give repeated results. Extra columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import scan

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_fraction double, longest_repeat long"
)
_SYMBOL = np.zeros(256, np.int8)
_SYMBOL[list(b"#*$%&|<>")] = 1


def longest_repeats(keys: np.ndarray) -> np.ndarray:
    """For each position the length of the longest prefix that also begins elsewhere.

    ``keys`` names the symbols; symbols of different texts must differ. The sequence of one text must be contiguous.
    """
    n = len(keys)
    place = np.int32 if n < 2**31 - 2 else np.int64
    out = np.zeros(n, place)
    if n < 2:
        return out
    order = np.argsort(keys).astype(place)
    k = keys[order]
    first = np.ones(n, bool)
    np.not_equal(k[1:], k[:-1], out=first[1:])
    del k
    rank = np.empty(n + 1, place)
    rank[order] = _last(first)
    rank[n] = -1
    live = order[_in_groups(first)]  # suffixes that are tied, in order of rank
    del order, first
    tied = live
    # ranks by the first h symbols, for h = 1, 4, 16, ...: a step of the search below is tried up to three times
    levels, h, nth = [(1, rank.copy())], 1, 0
    while len(live):
        old = rank[live]
        key = old.astype(np.int64) * (n + 2)
        key += rank[np.minimum(live.astype(np.int64) + h, n)]
        by = np.argsort(key, kind="stable")
        live, key, old = live[by], key[by], old[by]
        del by
        new, group = np.ones(len(live), bool), np.ones(len(live), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        np.not_equal(old[1:], old[:-1], out=group[1:])
        del key
        # a refined group's rank: the old group's first rank plus the place within that group
        old += _last(new)
        old -= _last(group)
        rank[live] = old
        del old, group
        live = live[_in_groups(new)]
        h, nth = h * 2, nth + 1
        if nth % 2 == 0 and len(live):
            levels.append((h, rank.copy()))
    tied = tied[np.argsort(rank[tied])]
    first = levels[0][1]
    same = first[tied[:-1]] == first[tied[1:]]
    i, j = tied[:-1][same], tied[1:][same]
    del tied, same
    lcp = np.zeros(len(i), place)
    for h, rank in reversed(levels):
        for _ in range(3):
            step = (rank[i + lcp] == rank[j + lcp]).astype(place)
            step *= h
            lcp += step
            if not step.any():
                break
    np.maximum.at(out, i, lcp)
    np.maximum.at(out, j, lcp)
    return out


def _last(marks: np.ndarray) -> np.ndarray:
    """For each place the last mark up to it; the first place is marked."""
    at = np.flatnonzero(marks).astype(np.int32 if len(marks) < 2**31 else np.int64)
    return np.repeat(at, np.diff(np.append(at, len(marks))))


def _in_groups(first: np.ndarray) -> np.ndarray:
    """Which places lie in groups of more than one; ``first`` marks where groups begin."""
    out = ~first
    out[:-1] |= ~first[1:]
    return out


def coverage(repeat: np.ndarray, least: int) -> np.ndarray:
    """Whether each position lies in a repeated span of at least ``least`` symbols."""
    p = np.flatnonzero(repeat >= least)
    edge = np.bincount(p, minlength=len(repeat) + 1) - np.bincount(p + repeat[p], minlength=len(repeat) + 1)
    return np.cumsum(edge[: len(repeat)]) > 0


def _duplicate_lines(data: np.ndarray, offs: np.ndarray, sums: np.ndarray, starts: np.ndarray) -> np.ndarray:
    cut = np.flatnonzero(data == 10)
    rows = len(offs) - 1
    # lines begin at each text's start and after each \n; a line never reaches into the next text
    begin = np.concatenate([offs[:-1], cut + 1])
    text = np.concatenate([np.arange(rows), np.searchsorted(offs, cut, "right") - 1])
    by = np.lexsort((begin, text))
    begin, text = begin[by], text[by]
    end = np.empty_like(begin)
    end[:-1] = begin[1:] - 1
    end[-1:] = offs[-1:]
    last = np.ones(len(begin), bool)
    last[:-1] = text[1:] != text[:-1]
    end[last] = offs[text[last] + 1]
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, text = begin[worded], end[worded], text[worded]
    key = scan.mix(scan.span_hash(sums, begin, end) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(key, return_index=True)
    again = np.ones(len(key), np.int64)
    again[at] = 0
    return np.bincount(text, weights=again, minlength=rows).astype(np.int64)


def measure(data: np.ndarray, offs: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """The counts of each text of a buffer."""
    starts, ends, bounds = scan.words(data, offs, scan.NONSPACE)
    sums = scan.prefix_sums(data)
    h = scan.span_hash(sums, starts, ends)
    text = scan.owner(bounds)
    repeat = longest_repeats(scan.mix(h + (text + 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    point = (data & 0xC0) != 0x80
    n = np.diff(bounds)
    longest = np.zeros(len(n), np.int64)
    if len(repeat):
        np.maximum.at(longest, text, repeat)
    return {
        "n_words": n,
        "word_chars": scan.per_text(point & scan.NONSPACE[data], offs),
        "n_symbols": scan.per_text(_SYMBOL[data], offs),
        "n_dup_lines": _duplicate_lines(data, offs, sums, starts),
        "n_repeat_words": scan.per_text(coverage(repeat, 5), bounds),
        "covered": scan.per_text(coverage(repeat, least), bounds),
        "longest_repeat": longest,
    }


def repetition_quality(
    docs: DataFrame, min_repeat: int = 8, max_covered: float = 0.15, max_longest: int = 60
) -> DataFrame:
    """One row per document with its base counts and whether it is kept.

    A document fails when fewer than 10 words or over 20 % of words in repeated 5-word windows (base rule), when
    over ``max_covered`` of its words lie in repeats of at least ``min_repeat`` words, or when its longest
    repeated substring exceeds ``max_longest`` words. Null text: no words, base_failed. Null doc_id stays null.
    A narrow map: no shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(1)
        parts = [measure(*scan.texts(column, lo, hi), min_repeat) for lo, hi in scan.slices(column)]
        v = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        n = v["n_words"]
        base = (n < 10) | (100 * v["n_repeat_words"] > 20 * n)
        fraction = v["covered"] / np.maximum(n, 1)
        kept = ~base & (fraction <= max_covered) & (v["longest_repeat"] <= max_longest)
        columns = [v[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        arrays = [batch.column(0), *map(pa.array, columns), pa.array(base), pa.array(kept), pa.array(fraction), pa.array(v["longest_repeat"])]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return scan.map_arrow(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), run, SCHEMA)
