"""Boundaries of byte-level BPE pre-tokens without regular expressions.

The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``. Each code point becomes a
symbol: its class, for white space whether something else follows, for an apostrophe how long a contraction it could
start. A symbol is a function from states to states; such functions compose associatively. The few functions that
composition can reach are numbered once, with a table of their products, so the state before each code point is a
prefix scan over small integers: in blocks side by side, then over the blocks, then back into them. Whether a
pre-token begins at a code point depends on the state before it and its symbol.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable, Sequence

import numpy as np

from roadweave.llm.lookup import home

# White space of Unicode's White_Space property.
WHITE_SPACE = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# The pattern's contractions after the apostrophe.
SHORT, LONG = "stmd", ("re", "ve", "ll")

PLANES_WITH_LETTERS = 0x40000  # later planes have no letters in any version of Unicode

LETTER, NUMBER, OTHER, SPACE = range(4)
# symbols: the classes, an apostrophe before a contraction of one or two letters, white space by what follows, and
# the start of a document
L, N, O, A1, A2, RUN, PREFIX, LAST, START = range(9)
# states: what the code point before belongs to
FRESH, IN_L, IN_N, IN_O, IN_SPACE, PENDING, ONE_MORE, TWO_MORE = range(8)
BLOCK = 256


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """next[symbol, state] and begins[symbol, state]."""
    go, begins = np.zeros((9, 8), dtype=np.uint8), np.ones((9, 8), dtype=bool)
    for symbol, state in ((L, IN_L), (N, IN_N), (O, IN_O), (RUN, IN_SPACE), (PREFIX, PENDING), (LAST, FRESH), (START, FRESH)):
        go[symbol] = state
    for symbol, state in ((L, IN_L), (N, IN_N), (O, IN_O), (A1, IN_O), (A2, IN_O)):
        begins[symbol, [state, PENDING]] = False
    go[A1], go[A2] = ONE_MORE, TWO_MORE
    go[[A1, A2], IN_O] = IN_O  # an apostrophe after other signs, or after a space, belongs to them
    go[[A1, A2], PENDING] = IN_O
    begins[RUN, IN_SPACE] = False
    begins[L, [ONE_MORE, TWO_MORE]] = False
    go[L, ONE_MORE], go[L, TWO_MORE] = FRESH, ONE_MORE
    return go, begins


@functools.cache
def known() -> np.ndarray:
    """Which code points Python's Unicode tables have assigned."""
    return np.array([unicodedata.category(chr(code)) != "Cn" for code in range(sys.maxunicode + 1)])


def _newer() -> dict[int, list[int]]:
    """Letters and numbers that tiktoken's Unicode tables have and Python's don't.

    Found by asking: under a vocabulary that joins a character's last byte to a following "a" (or "1"), the two join
    only if the pattern takes them for one run of letters (numbers).
    """
    try:
        import tiktoken
    except ModuleNotFoundError:
        return {}
    codes = np.flatnonzero(~known()[:PLANES_WITH_LETTERS]).tolist()
    out = {}
    for kind, mate, pattern in ((LETTER, "a", r"\p{L}+|\P{L}"), (NUMBER, "1", r"\p{N}+|\P{N}")):
        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {bytes([b]) + mate.encode(): 256 + b - 0x80 for b in range(0x80, 0xC0)}
        asked = tiktoken.Encoding("asked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        ids = asked.encode_ordinary("\n".join(chr(code) + mate for code in codes))
        last = [k for k, after in zip(ids, [*ids[1:], 10]) if after == 10]
        out[kind] = [code for code, k in zip(codes, last) if k >= 256]
    return out


@functools.cache
def _tables() -> tuple[np.ndarray, ...]:
    """Class of each code point; number of each symbol's function; products; functions at FRESH; begins; functions."""
    classes = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    first = {"L": LETTER, "N": NUMBER}
    for code in np.flatnonzero(known()).tolist():
        kind = first.get(unicodedata.category(chr(code))[0])
        if kind is not None:
            classes[code] = kind
    for kind, codes in _newer().items():
        classes[codes] = kind
    classes[WHITE_SPACE] = SPACE
    go, begins = _transitions()
    functions = [tuple(range(8))]
    number = {functions[0]: 0}
    for f in functions:  # grows until closed: every reachable function after one more symbol
        for symbol in range(9):
            after = tuple(int(go[symbol, s]) for s in f)
            if after not in number:
                number[after] = len(functions)
                functions.append(after)
    table = np.array(functions, dtype=np.uint8)
    products = np.zeros((len(functions), len(functions)), dtype=np.uint8)
    for i, f in enumerate(functions):
        for j, g in enumerate(functions):
            products[i, j] = number[tuple(g[s] for s in f)]
    of_symbol = np.array([number[tuple(int(x) for x in go[s])] for s in range(9)], dtype=products.dtype)
    return classes, of_symbol, products, table[:, FRESH].copy(), begins, table


def symbols(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Symbol of each code point of documents laid end to end; ``starts`` are their first positions (none empty).

    What a document's first code point is, is not lost: boundaries at ``starts`` are set apart.
    """
    classes = _tables()[0][points]
    n = len(points)
    out = classes.copy()
    last = np.zeros(n, dtype=bool)  # last code point of its document
    last[starts[1:] - 1] = True
    last[-1] = True
    space = np.flatnonzero(classes == SPACE)
    follows = np.append(classes[1:], SPACE)[space] != SPACE
    follows &= ~last[space]
    out[space] = np.where(follows, np.where(points[space] == 0x20, PREFIX, LAST), RUN)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, dtype=points.dtype)])
        one, two = padded[quote + 1], padded[quote + 2]
        has_one = ~last[quote]
        has_two = has_one & ~np.append(last, [True, True])[quote + 1]
        short = has_one & np.isin(one, [ord(c) for c in SHORT])
        long = np.zeros(len(quote), dtype=bool)
        for a, b in LONG:
            long |= has_two & (one == ord(a)) & (two == ord(b))
        out[quote[short]] = A1
        out[quote[long]] = A2
    return out


def states_before(functions: np.ndarray) -> np.ndarray:
    """The state before each position, from the numbers of the functions applied in order, FRESH at first."""
    _, _, products, at_fresh, _, _ = _tables()
    n, many = len(functions), len(products)
    flat = products.reshape(-1)
    width = -(-n // BLOCK)
    padded = np.zeros(width * BLOCK, dtype=np.uint8)
    padded[:n] = functions
    lanes = np.ascontiguousarray(padded.reshape(width, BLOCK).T)  # row k: the k-th position of every block
    run = np.zeros(width, dtype=np.uint8)
    for k in range(BLOCK):
        run = flat[run.astype(np.int16) * many + lanes[k]]
    before, ahead = 0, np.zeros(width, dtype=np.uint8)
    for i, whole in enumerate(run.tolist()):
        ahead[i] = before
        before = int(products[before, whole])
    # the state at the start of each block is known now, so a second pass carries states alone
    steps = _steps()
    states = np.empty((BLOCK, width), dtype=np.uint8)
    state = at_fresh[ahead]
    for k in range(BLOCK):
        states[k] = state
        state = steps[lanes[k].astype(np.int16) * 8 + state]
    return np.ascontiguousarray(states.T).reshape(-1)[:n]


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions at which pre-tokens begin, for documents laid end to end; ``starts`` among them."""
    if not len(points):
        return np.zeros(0, dtype=np.int64)
    of_symbol, begins = _tables()[1], _tables()[4]
    marks = symbols(points, starts)
    functions = of_symbol[marks]
    # a document starts FRESH: its first function is applied as if to that state, whatever came before
    fresh = _constants()
    functions[starts] = fresh[marks[starts]]
    before = states_before(functions)
    before[starts] = FRESH
    out = begins.reshape(-1)[marks * np.uint8(8) + before]
    out[starts] = True
    return np.flatnonzero(out)


@functools.cache
def _steps() -> np.ndarray:
    """State after a function, by 8 * its number + the state before."""
    return np.ascontiguousarray(_tables()[5]).reshape(-1)


@functools.cache
def _constants() -> np.ndarray:
    """Number of the function START followed by each symbol."""
    _, of_symbol, products, *_ = _tables()
    return products[of_symbol[START], of_symbol]


def cuts(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts as bytes end to end, where pre-tokens begin in them, and how many pre-tokens each text has."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    joined = "".join(texts)
    data = joined.encode("utf-8")
    ascii_only = len(data) == len(joined)
    points = np.frombuffer(data, dtype=np.uint8) if ascii_only else np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[lengths > 0]
    at = boundaries(points, starts)
    counts = np.searchsorted(at, ends) - np.searchsorted(at, ends - lengths)
    if not ascii_only:
        # bytes before a code point: one each, and one more past each of three marks
        more = (points >= 0x80).view(np.int8) + (points >= 0x800).view(np.int8) + (points >= 0x10000).view(np.int8)
        at = at + (np.cumsum(more, dtype=np.int64) - more)[at]
    return data, at, counts


def pieces(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """The pre-tokens of all texts as bytes, in order, and how many each text has."""
    data, at, counts = cuts(texts)
    begin = at.tolist()
    return [data[a:b] for a, b in zip(begin, [*begin[1:], len(data)])], counts


class Coder:
    """Ids of the pre-tokens of whole runs of texts, from what is remembered of pre-tokens seen before.

    A pre-token of up to sixteen bytes is looked up by these bytes, as two numbers, and its length, in a table with open
    addressing, for all of a run at once; longer ones in a dictionary. Those not known are encoded together by
    ``encode``, which gives the ids of many end to end and how many each has. Memory is bounded: past ``limit``
    pre-tokens all is forgotten before the next run, which changes no result.
    """

    WIDTH = 16

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = 500_000) -> None:
        self.encode, self.limit = encode, limit
        half = [(1 << 8 * k) - 1 for k in range(9)]
        self.low_masks = np.array([half[min(k, 8)] for k in range(17)], dtype=np.uint64)
        self.high_masks = np.array([half[max(k - 8, 0)] for k in range(17)], dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self._room(10)
        self.longer: dict[bytes, int] = {}
        self.short = 0  # how many the table holds
        self.pool = np.zeros(0, dtype=np.int32)
        self.offsets, self.counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def _room(self, bits: int) -> None:
        self.bits, size = bits, 1 << bits
        self.low, self.high = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64)
        self.sizes, self.rows = np.zeros(size, dtype=np.uint8), np.full(size, -1, dtype=np.int32)

    def _home(self, low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return home(low ^ (high * np.uint64(0x94D049BB133111EB)) ^ (sizes.astype(np.uint64) << np.uint64(58)), self.bits)

    def _other(self, at: np.ndarray, low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return (self.low[at] != low) | (self.high[at] != high) | (self.sizes[at] != sizes)

    def _find(self, low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        at = self._home(low, high, sizes)
        out = self.rows[at]
        left = np.flatnonzero((out >= 0) & self._other(at, low, high, sizes))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            row = self.rows[at]
            out[left] = row
            more = (row >= 0) & self._other(at, low[left], high[left], sizes[left])
            left, at = left[more], at[more]
        return out

    def _put(self, low: np.ndarray, high: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
        """New pre-tokens into the table, which grows to stay half empty."""
        if 2 * (self.short + len(low)) > len(self.rows):
            held = self.rows >= 0
            old = self.low[held], self.high[held], self.sizes[held], self.rows[held]
            low, high, sizes, rows = (np.concatenate(x) for x in zip(old, (low, high, sizes, rows)))
            self.short = 0
            self._room(int(np.ceil(np.log2(3 * len(low)))))
        self.short += len(low)
        at = self._home(low, high, sizes)
        while len(low):
            free = np.flatnonzero(self.rows[at] < 0)
            spot, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.low[spot], self.high[spot], self.sizes[spot], self.rows[spot] = low[won], high[won], sizes[won], rows[won]
            stay = np.ones(len(low), dtype=bool)
            stay[won] = False
            low, high, sizes, rows, at = low[stay], high[stay], sizes[stay], rows[stay], (at[stay] + 1) & ((1 << self.bits) - 1)

    def _learn(self, pieces_: list[bytes]) -> int:
        """Rows for new pre-tokens, one after the other; the first of them."""
        first = len(self.offsets)
        ids, counts = self.encode(pieces_)
        self.offsets = np.concatenate([self.offsets, len(self.pool) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
        return first

    def code(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each text has."""
        if len(self.offsets) > self.limit:
            self._forget()
        data, at, counts = cuts(texts)
        length = np.diff(at, append=len(data))
        rows = np.empty(len(at), dtype=np.int32)
        is_short = length <= self.WIDTH
        chosen = np.flatnonzero(is_short)
        start = at[chosen]
        sizes = length[chosen].astype(np.uint8)
        eight = np.ndarray((len(data) + 9,), dtype="<u8", buffer=data + bytes(self.WIDTH), strides=(1,))
        low, high = eight[start] & self.low_masks[sizes], eight[start + 8] & self.high_masks[sizes]
        found = self._find(low, high, sizes)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = np.lexsort((sizes[new], high[new], low[new]))
            l, h, z = low[new][order], high[new][order], sizes[new][order]
            differs = np.append(True, (l[1:] != l[:-1]) | (h[1:] != h[:-1]) | (z[1:] != z[:-1]))
            l, h, z = l[differs], h[differs], z[differs]
            where = start[new][order][differs]
            first = self._learn([data[a : a + n] for a, n in zip(where.tolist(), z.tolist())])
            self._put(l, h, z, np.arange(first, first + len(l), dtype=np.int32))
            found[new] = self._find(low[new], high[new], sizes[new])
        rows[chosen] = found
        long = np.flatnonzero(~is_short)
        begin = at[long]
        slices = [data[a:b] for a, b in zip(begin.tolist(), (begin + length[long]).tolist())]
        unknown = list({p for p in slices if p not in self.longer})
        if unknown:
            first = self._learn(unknown)
            self.longer.update(zip(unknown, range(first, first + len(unknown))))
        rows[long] = np.fromiter(map(self.longer.__getitem__, slices), dtype=np.int32, count=len(slices))
        count = self.counts[rows]
        ends = np.cumsum(count, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.arange(total) + np.repeat(self.offsets[rows] - (ends - count), count)]
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if len(self.pool) > 16 * self.limit:  # very long pre-tokens
            self._forget()
        return ids, np.diff(borders)
