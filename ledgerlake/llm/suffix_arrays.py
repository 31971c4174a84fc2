"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

The usual scheme: a suffix is smaller (S) or larger (L) than the next one; an S suffix after an L one is leftmost-smaller
(LMS). LMS substrings are sorted by induction and named, their order as suffixes comes from the same procedure on the
string of names, and the order of all others is induced from it.

The induction goes by runs, not by single places: an L suffix is ordered by the L symbols up to the next S suffix, then
by that one's rank, and the same holds for S suffixes and the next L one. Runs are about two symbols long; a pass over all
runs that have a place so far in places one symbol of each by a counting sort. The work is linear in the sum of squares
of run lengths, and a run never crosses the end of a text, so with texts of bounded length it is linear.

Texts are one string with a 0 behind each. The k-th end counts as smaller than the next one, so no order and no
common prefix reaches beyond a text's end.
"""

from __future__ import annotations

import numpy as np


def _stable_order(codes: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers; two counting sorts where they are wider than 16 bits."""
    if codes.dtype == np.uint16:
        return np.argsort(codes, kind="stable")
    low = np.argsort(codes.astype(np.uint16), kind="stable")
    return low[np.argsort((codes >> 16).astype(np.uint16)[low], kind="stable")]


def _narrow(values: np.ndarray, most: int) -> np.ndarray:
    return values.astype(np.uint16 if most < 1 << 16 else np.int32)


def _induced(places: np.ndarray, depth: np.ndarray, codes: np.ndarray, by_end: np.ndarray) -> np.ndarray:
    """`places` in the order of the codes along their runs (`depth` symbols each), then of the rank of the run's end."""
    most = int(depth.max(initial=0))
    order = np.zeros(0, places.dtype)
    by_depth = np.argsort(depth.astype(np.uint16), kind="stable") if most < 1 << 16 else np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[by_depth], np.arange(most + 2))
    for d in range(most, -1, -1):
        # runs that end here join those that go on, which are in order by the rest; then the symbol at this depth decides
        ending = places[by_depth[cuts[d] : cuts[d + 1]]]
        if len(ending):
            ending = ending[_stable_order(by_end[ending + d])]
            order = np.concatenate([ending, order]) if len(order) else ending
        order = order[_stable_order(codes[order + d])]
    return order


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a string of whole numbers, 0 being the ends of texts; the string ends with one."""
    n = len(symbols)
    if n <= 1:
        return np.arange(n, dtype=np.int32)
    at = np.arange(n, dtype=np.int32)
    is_end = symbols == 0
    # a suffix is smaller if the next different symbol is greater; an end is smaller than all
    last = np.flatnonzero(np.append(symbols[1:] != symbols[:-1], True))
    smaller = np.repeat(np.append(symbols[last[:-1] + 1] > symbols[last[:-1]], True), np.diff(last, prepend=-1))
    smaller |= is_end
    turns = np.empty(n, dtype=bool)
    turns[0], turns[1:] = True, smaller[1:] != smaller[:-1]
    lms = smaller & turns
    lms[0] = False
    lms |= is_end  # an end begins a piece of its own, also where texts are empty
    codes = _narrow(symbols.astype(np.int32) * 2 + smaller, 2 * int(symbols.max()) + 1)

    # how far the run of a suffix's kind goes: L runs end at an S suffix, S runs at an L one or at an end
    begins = np.flatnonzero(turns | lms)
    ends = np.append(begins[1:], n)
    depth = np.repeat(ends.astype(np.int32), ends - begins) - at
    larger = at[~smaller]
    inner = at[smaller & ~is_end]  # S suffixes but for the ends
    depth_larger, depth_inner = depth[larger], depth[inner]
    where, n_ends = at[lms], int(is_end.sum())
    ends_lms = is_end[where]

    rank = np.zeros(n, np.int32)
    rank_l = np.zeros(n, np.int32)

    # 1. sort LMS substrings, of which an S run, an L run and the symbol behind are all there is: the L runs first, by
    # that symbol, then the LMS places by their S runs and the order of the L runs behind
    rank[is_end] = np.arange(n_ends, dtype=np.int32)
    rank[where[~ends_lms]] = n_ends + symbols[where[~ends_lms]]
    l_starts = larger[turns[larger]]
    by_l = _induced(l_starts, depth[l_starts], codes, rank)
    rank_l[by_l] = np.arange(len(by_l), dtype=np.int32)
    s_starts = where[~ends_lms]
    order = np.concatenate([at[is_end], _induced(s_starts, depth[s_starts], codes, rank_l)])

    # 2. name them: equal ones, symbol by symbol up to the next LMS place, get one name
    nth = np.cumsum(lms) - 1
    length = np.append(np.diff(where), 1).astype(np.int32)
    a, b = order[:-1], order[1:]
    la, lb = length[nth[a]], length[nth[b]]
    same = (la == lb) & ~is_end[a] & ~is_end[b]
    left = np.flatnonzero(same)
    pa, pb, to_go = a[left], b[left], la[left]
    while len(left):
        equal = codes[pa] == codes[pb]
        same[left[~equal]] = False
        # the last symbol is the next LMS place, whose own text end tells ends apart
        on = np.flatnonzero(equal & (to_go > 0))
        left, pa, pb, to_go = left[on], pa[on] + 1, pb[on] + 1, to_go[on] - 1
    # substrings that end at ends of texts are the same up to there; the ends' own names tell them apart
    names = np.zeros(len(order), np.int32)
    names[1:] = np.cumsum(~same)
    if int(names[-1]) + 1 < len(order):
        # 3. the order of LMS suffixes, from the string of names; ends keep their order among themselves
        string = np.zeros(len(where), np.int32)
        string[nth[order]] = names
        final = _names_order(string, is_end[where])
        order = where[final]
    rank[order] = np.arange(len(order), dtype=np.int32)
    # 4. induce all from it
    by_l = _induced(larger, depth_larger, codes, rank)
    rank_l[by_l] = np.arange(len(by_l), dtype=np.int32)
    rest = np.concatenate([by_l, _induced(inner, depth_inner, codes, rank_l)])
    return np.concatenate([at[is_end], rest[_stable_order(codes[rest])]])


def _names_order(string: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of names, where `ends` are ends of texts."""
    # names count from the ends up, so what isn't an end is greater than zero
    return suffix_array(np.where(ends, 0, string + 1 - int(ends.sum())).astype(np.int32))


def permuted_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place, how many symbols it has in common with the suffix before it in the order, up to a text's end.

    Where the symbols before both agree, the value is one less than that of the place before; only the others are
    compared, symbol by symbol."""
    n = len(symbols)
    before = np.full(n, -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, dtype=bool)
    at = np.flatnonzero(before[1:] > 0) + 1
    ahead = symbols[at - 1]
    follows[at] = (ahead == symbols[before[at] - 1]) & (ahead != 0)
    common = np.zeros(n, dtype=np.int32)
    left = np.flatnonzero((before >= 0) & ~follows)
    to_end = np.flatnonzero(symbols == 0).astype(np.int32)
    to_end = np.repeat(to_end, np.diff(to_end, prepend=-1)) - np.arange(n, dtype=np.int32)
    other = before[left]
    common[left] = _common(symbols, left, other, np.minimum(to_end[left], to_end[other]))
    start = np.maximum.accumulate(np.where(follows, 0, np.arange(n, dtype=np.int32)))
    return common[start] - (np.arange(n, dtype=np.int32) - start)


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many symbols, `most` at most, are equal from places a and b on; eight at a time where symbols fit a byte."""
    out = np.zeros(len(a), dtype=np.int32)
    left, k = np.arange(len(a)), 8 if int(symbols.max(initial=0)) < 256 else 1
    if k == 8:
        held = np.zeros(len(symbols) + 16, np.uint8)
        held[: len(symbols)] = symbols
        words = np.empty(len(symbols) + 8, np.uint64)
        for r in range(8):
            words[r::8] = np.frombuffer(held[r : r + 8 * len(words[r::8])].tobytes(), "<u8")
    else:
        words = symbols
    while len(left):
        x = words[a] ^ words[b]
        full = x == 0
        if k == 8:
            part = np.flatnonzero(~full)
            # the lowest byte that differs ends the common part
            low = x[part] & (~x[part] + np.uint64(1))
            out[left[part]] += (np.log2(low.astype(np.float64)).astype(np.int32)) >> 3
        on = np.flatnonzero(full)
        out[left[on]] += k
        on = on[out[left[on]] < most[left[on]]]
        left, a, b = left[on], a[on] + k, b[on] + k
    return np.minimum(out, most)
