"""Re-Pair on numpy arrays: frequent id pairs become nonterminals, round by round."""

from __future__ import annotations

import numpy as np

#: Pairs are replaced until none occurs so often. A round replaces together all pairs that occur at least
#: a SHARE-th as often as the most frequent one, instead of one pair at a time. Where matches overlap, the
#: pair that is more frequent, then the one of the lesser hash, is taken: equal passages are cut alike wherever
#: they stand, and their copies go on to share rules.
LEAST_COUNT, SHARE = 4, 4


_NONE = np.iinfo(np.int32).max


def _order(first: np.ndarray, second: np.ndarray, top: int) -> np.ndarray:
    """A stable order of pairs."""
    if top > 1 << 16:
        return np.argsort(_codes(first, second), kind="stable")
    # Numbers of two bytes are sorted in one pass each.
    order = np.argsort(second.astype(np.uint16), kind="stable")
    return order.take(np.argsort(first.astype(np.uint16).take(order), kind="stable"))


def _codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    code = first.astype(np.int64)
    code <<= 32
    code |= second
    return code


def _maybe_frequent(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """False for most of the pairs that occur less than LEAST_COUNT times, for no others: counts by hash, which is
    faster than sorting."""
    bits = max(1, min(2 * len(first) - 1, 1 << 20).bit_length())
    slot = first.astype(np.uint32) * np.uint32(0x9E3779B1) + second.astype(np.uint32) * np.uint32(0x85EBCA77)
    slot = ((slot ^ (slot >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - bits)).astype(np.int64)
    return (np.bincount(slot) >= LEAST_COUNT).take(slot, mode="wrap") if len(slot) else np.zeros(0, bool)


def _frequent(first: np.ndarray, second: np.ndarray, at: np.ndarray, top: int):
    """Of the pairs that begin at ``at`` those that occur LEAST_COUNT times: (places, codes, counts), the places
    pair by pair."""
    order = _order(first, second, top)
    code = _codes(first.take(order), second.take(order))
    order = order.astype(np.int32)
    starts = np.flatnonzero(np.concatenate([[len(code) > 0], code[1:] != code[:-1]])[: len(code)]).astype(np.int32)
    counts = np.diff(starts, append=np.int32(len(code)))
    often = counts >= LEAST_COUNT
    at = at.take(order.compress(np.repeat(often, counts)))
    return at, code.take(starts.compress(often)), counts.compress(often)


def _scattered(codes: np.ndarray) -> np.ndarray:
    """An order of the pairs that has nothing to do with their symbols' numbers."""
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _winners(rank: np.ndarray, mine: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which of the matches at ``at``, of ranks ``mine``, are replaced where they overlap. A run of one pair
    (``aaaa``) wins as a whole over its neighbours if its rank is less, and gives every second of its matches, from
    the left."""
    left, right = rank.take(before.take(at, mode="wrap"), mode="wrap"), rank.take(after.take(at, mode="wrap"), mode="wrap")
    wins = (left > mine) & (right > mine)
    runs = np.flatnonzero((left == mine) | (right == mine))
    if len(runs):
        runs = runs[np.argsort(at[runs])]
        place, own = at[runs], mine[runs]
        opens = np.concatenate([[True], (after[place[:-1]] != place[1:]) | (own[1:] != own[:-1])])
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(runs)) - 1
        whole = (left[runs[first]] > own[first]) & (right[runs[last]] > own[first])
        length = last - first + 1
        nth = np.arange(len(runs)) - np.repeat(first, length)
        wins[runs] = np.repeat(whole, length) & (nth % 2 == 0)
    return wins


def compress(ids: np.ndarray, base: int, rounds: int | None = None):
    """(symbols, rules, lengths): rules[k] is the pair that symbol base + k stands for, lengths[k] the
    number of ids it expands to. Ids must be below ``base``. ``rounds`` limits the rounds.

    Symbols are linked to their neighbours, and pairs keep their counts and places from round to round. A
    replacement makes new pairs only with the new symbol, so only these are sorted and counted."""
    n = len(ids)  # take() is faster with mode="wrap"; only the place -1 needs it
    # Place n lies behind the last symbol; the first one's left neighbour, -1, is the place after that.
    symbols = np.full(n + 2, -1, np.int32)
    symbols[:n] = ids
    before, after = np.arange(-1, n + 1, dtype=np.int32), np.arange(1, n + 3, dtype=np.int32)
    rank = np.full(n + 2, _NONE, np.int32)
    # The pair that begins at each place, 0 if it is rare: a rare pair stays so until one of its symbols is replaced.
    number = np.zeros(n + 2, np.int32)
    codes, counts, begins = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(2, np.int64)
    where = np.zeros(0, np.int32)  # the places of pair k: where[begins[k] : begins[k + 1]], some outdated
    rules, lengths, top = [], np.zeros(0, np.int64), base
    at = np.arange(max(n - 1, 0))
    first, second = symbols[: len(at)], symbols[1 : len(at) + 1]
    while rounds != 0:
        rounds = rounds and rounds - 1
        at, code, often = _frequent(first, second, at, top)
        number[at] = np.repeat(np.arange(len(counts), len(counts) + len(code), dtype=np.int32), often)
        filled = int(begins[-1])
        if filled + len(at) > len(where):
            where = np.concatenate([where[:filled], np.empty(len(at) + len(where) // 2, np.int32)])
        where[filled : filled + len(at)] = at
        codes, counts = np.concatenate([codes, code]), np.concatenate([counts, often])
        begins = np.concatenate([begins, filled + np.cumsum(often)])
        most = int(counts.max())
        if most < LEAST_COUNT:
            break
        chosen = np.flatnonzero(counts >= max(LEAST_COUNT, most // SHARE))
        chosen = chosen[np.lexsort((_scattered(codes[chosen]), -counts[chosen]))]
        size = begins[chosen + 1] - begins[chosen]
        if size.sum() * 6 > n:  # one pass over all places is faster
            place = np.full(len(counts), _NONE, np.int32)
            place[chosen] = np.arange(len(chosen), dtype=np.int32)
            at = np.flatnonzero((place < _NONE).take(number[:n], mode="wrap"))
            mine = place.take(number.take(at, mode="wrap"), mode="wrap")
        else:
            ends = np.cumsum(size)
            at = where.take(np.repeat(begins[chosen] - (ends - size), size) + np.arange(ends[-1])).astype(np.int64)
            mine = np.repeat(np.arange(len(chosen), dtype=np.int32), size)
            still = number.take(at, mode="wrap") == chosen.take(mine, mode="wrap")
            at, mine = at.compress(still), mine.compress(still)
        rank[at] = mine
        wins = _winners(rank, mine, at, before, after)
        rank[at] = _NONE
        at, mine = at.compress(wins), mine.compress(wins)
        # Pairs that were left no place make no rule.
        won = np.bincount(mine, minlength=len(chosen))
        used = won > 0
        pair = codes[chosen[used]]
        pair = np.stack([pair >> 32, pair & 0xFFFFFFFF], 1)
        rules.append(pair)
        lengths = np.concatenate([lengths, _length(pair, lengths, base)])
        symbols[at] = (top - 1 + np.cumsum(used, dtype=np.int32)).take(mine, mode="wrap")
        counts[chosen] -= won
        gone = after.take(at, mode="wrap").astype(np.int64)
        then = after.take(gone, mode="wrap").astype(np.int64)
        after[at], before[then], symbols[gone] = then, at, -1
        lost = number.take(gone, mode="wrap")
        number[at] = number[gone] = 0
        left = before.take(at, mode="wrap").astype(np.int64)
        left = left.compress((left >= 0) & (symbols.take(left, mode="wrap") < top))  # others have a new symbol and are in ``at``
        lost = np.concatenate([lost, number.take(left, mode="wrap")])
        number[left] = 0
        counts -= np.bincount(lost, minlength=len(counts))
        counts[0] = 0
        at = np.concatenate([at.compress(then < n), left])
        first, second = symbols.take(at, mode="wrap"), symbols.take(after.take(at, mode="wrap"), mode="wrap")
        maybe = _maybe_frequent(first, second)
        at, first, second = at.compress(maybe), first.compress(maybe), second.compress(maybe)
        top += len(pair)
    symbols = symbols[:n]
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return symbols.compress(symbols >= 0), table, lengths


def _length(pair: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    of = np.r_[1, lengths]
    return of[np.maximum(pair - base + 1, 0)].sum(1)


def _expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rules' expansions, end to end, and where each begins and ends."""
    out = base + np.arange(len(rules), dtype=np.int32)
    owner = np.arange(len(rules))
    while len(inner := np.flatnonzero(out >= base)):
        counts = np.ones(len(out), np.int64)
        counts[inner] = 2
        pair = rules[out[inner] - base]
        out, owner = np.repeat(out, counts), np.repeat(owner, counts)
        first = inner + np.arange(len(inner))
        out[first], out[first + 1] = pair[:, 0], pair[:, 1]
    return out, np.r_[0, np.cumsum(np.bincount(owner, minlength=len(rules)))]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    symbols = np.asarray(symbols, np.int32)
    flat, bounds = _expansions(rules, base)
    if not len(rules) or not len(symbols):
        return symbols
    # One table: the base ids, then the expansions.
    table = np.r_[np.arange(base, dtype=np.int32), flat]
    begin = np.r_[np.arange(base), base + bounds[:-1]].astype(np.int32).take(symbols)
    size = np.r_[np.ones(base), np.diff(bounds)].astype(np.int32).take(symbols)
    ends = np.cumsum(size, dtype=np.int32)
    where = np.repeat(begin - (ends - size), size)
    where += np.arange(len(where), dtype=np.int32)
    return table.take(where)


def slice_ids(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, start: int, stop: int):
    """ids[start:stop], expanding only the symbols that cover the range."""
    size = np.r_[1, lengths][np.maximum(np.asarray(symbols, np.int64) - base + 1, 0)]
    ends = np.cumsum(size)
    stop = min(stop, int(ends[-1]) if len(ends) else 0)
    if start >= stop:
        return np.zeros(0, np.int64)
    a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
    lead = start - int(ends[a] - size[a])
    out = np.array(symbols[a : b + 1], np.int32)
    while len(inner := np.flatnonzero(out >= base)):
        pair = rules[out[inner] - base]
        out = np.insert(out, inner + 1, pair[:, 1])
        out[inner + np.arange(len(inner))] = pair[:, 0]
    return out[lead : lead + stop - start]
