"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, exact decoding.

Pre-tokenisation uses no regular expression on the texts. Code points become classes by one table look-up, classes with
one or two characters of look-ahead become symbols, and each symbol is a transition function of a small automaton. The
functions that can arise by composition form a finite monoid, so a prefix scan over element numbers with a product table
gives the state before every character; composition is associative, hence blocks are scanned side by side and then joined.

The class table is asked of the tokenizer library itself, so that letters, numbers and white space are what it takes them for.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np

#: Classes of code points; a separator stands between the texts of a batch.
LETTER, NUMBER, OTHER, BLANK, WHITE, SEPARATOR = range(6)
END_OF_TEXT = 0x110000
#: Symbols: what a character does to the automaton, look-ahead included. GLUE is a blank before a non-white character, LONE
#: another white character there; SHORT and LONG are apostrophes with one or two letters of a contraction behind them.
S_LETTER, S_NUMBER, S_OTHER, S_GLUE, S_LONE, S_WHITE, S_SHORT, S_LONG, S_SEPARATOR = range(9)
#: States: what the piece that is open consists of; LEFT1 and LEFT2: so many characters of a contraction are to come.
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, GLUED, IN_WHITE, LEFT1, LEFT2 = range(8)
#: The contractions that the pattern of this vocabulary splits off (fixed values).
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this character."""
    if symbol == S_SEPARATOR:
        return NONE, True
    if state == LEFT2:
        return LEFT1, False
    if state == LEFT1:
        return NONE, False
    if symbol in (S_LETTER, S_NUMBER, S_OTHER):
        run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}[symbol]
        return run, state not in (run, GLUED)
    if symbol in (S_SHORT, S_LONG):
        return (IN_OTHERS, False) if state in (IN_OTHERS, GLUED) else (LEFT1 if symbol == S_SHORT else LEFT2, True)
    if symbol == S_WHITE:
        return IN_WHITE, state != IN_WHITE
    return (GLUED if symbol == S_GLUE else NONE), True


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """starts[state, symbol], product[f, g] (flat) and apply[f, state]; the first nine elements are the symbols' functions, then identity."""
    of_symbol = [tuple(_step(s, x)[0] for s in range(8)) for x in range(9)]
    elements = list(dict.fromkeys([*of_symbol])) if len(set(of_symbol)) == 9 else of_symbol
    elements.append(tuple(range(8)))
    number = {f: i for i, f in reversed(list(enumerate(elements)))}
    todo = list(elements)
    while todo:
        f = todo.pop()
        for g in of_symbol:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(elements)
                elements.append(h)
                todo.append(h)
    table = np.array(elements, dtype=np.uint8)
    product = np.array([[number[tuple(g[s] for s in f)] for g in map(tuple, table.tolist())] for f in map(tuple, table.tolist())], dtype=np.uint16)
    starts = np.array([[_step(s, x)[1] for x in range(9)] for s in range(8)])
    return starts, product, table


def _states_before(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol, by a two-level scan over composed functions."""
    starts, product, table = automaton()
    width, identity = len(product), 9
    flat = product.ravel()
    n = len(symbols)
    block = 16 if n < 4096 else 64 if n < 262_144 else 256
    columns = -(-n // block)
    grid = np.full(columns * block, identity, dtype=np.intp)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(columns, block).T)
    before = np.empty((block, columns), dtype=np.uint16)
    acc = np.full(columns, identity, dtype=np.intp)
    for t in range(block):
        before[t] = acc
        acc *= width
        acc += grid[t]
        acc = flat[acc].astype(np.intp)
    if columns > 32:
        entry = _entries(acc)
    else:
        entry, state = np.empty(columns, dtype=np.intp), NONE
        for k, f in enumerate(acc):
            entry[k] = state
            state = table[f, state]
    return np.ascontiguousarray(table.ravel()[before.astype(np.intp) * 8 + entry].T).ravel()[:n]


def _entries(totals: np.ndarray) -> np.ndarray:
    """The state at the start of each block from the blocks' composed functions."""
    _, product, table = automaton()
    block = 64
    columns = -(-len(totals) // block)
    grid = np.full(columns * block, 9, dtype=np.intp)
    grid[: len(totals)] = totals
    grid = grid.reshape(columns, block)
    acc, before = np.full(columns, 9, dtype=np.intp), np.empty((columns, block), dtype=np.intp)
    for t in range(block):
        before[:, t] = acc
        acc = product[acc, grid[:, t]].astype(np.intp)
    state, entry = NONE, np.empty(columns, dtype=np.intp)
    for k, f in enumerate(acc.tolist()):
        entry[k] = state
        state = table[f, state]
    return table[before, entry[:, None]].ravel()[: len(totals)].astype(np.intp)


def _code_points() -> str:
    return "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))


def _table(letters: Iterable[int], numbers: Iterable[int], whites: Iterable[int]) -> np.ndarray:
    out = np.full(END_OF_TEXT + 1, OTHER, dtype=np.uint8)
    out[list(letters)], out[list(numbers)], out[list(whites)] = LETTER, NUMBER, WHITE
    out[0x20], out[END_OF_TEXT] = BLANK, SEPARATOR
    return out


@functools.cache
def classes_of_tiktoken() -> np.ndarray:
    import tiktoken

    bytes_only = {bytes([i]): i for i in range(256)}

    def matched(pattern: str) -> list[int]:
        ids = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=bytes_only, special_tokens={}).encode_ordinary(_code_points())
        return [ord(c) for c in bytes(ids).decode()]

    return _table(matched(r"\p{L}"), matched(r"\p{N}"), matched(r"\s"))


@functools.cache
def classes_of_tokenizers() -> np.ndarray:
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    def matched(pattern: str) -> list[int]:
        return [ord(c) for piece, _ in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(_code_points()) for c in piece]

    return _table(matched(r"\p{L}"), matched(r"\p{N}"), matched(r"\s"))


def piece_starts(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where pieces start in code points that end in END_OF_TEXT; each END_OF_TEXT is a piece of its own."""
    kinds = classes[points]
    after = np.empty_like(kinds)
    after[:-1], after[-1] = kinds[1:], SEPARATOR
    symbols = np.array([S_LETTER, S_NUMBER, S_OTHER, S_WHITE, S_WHITE, S_SEPARATOR], dtype=np.uint8)[kinds]
    solid = after <= OTHER
    symbols[(kinds == BLANK) & solid] = S_GLUE
    symbols[(kinds == WHITE) & solid] = S_LONE
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        padded = np.concatenate([points, np.full(2, END_OF_TEXT, dtype=points.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        symbols[marks[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = S_SHORT
        for a, b in LONG_ENDINGS:
            symbols[marks[(one == ord(a)) & (two == ord(b))]] = S_LONG
    starts, _, _ = automaton()
    return np.flatnonzero(starts.ravel()[_states_before(symbols).astype(np.intp) * 9 + symbols])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Pair merging: always the pair of lowest rank, the leftmost of equals. A heap keeps long pieces n log n."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    if n <= 24:
        parts = [piece[i : i + 1] for i in range(n)]
        none = len(ranks) + 1
        pairs = [ranks.get(piece[i : i + 2], none) for i in range(n - 1)]
        while pairs and (best := min(pairs)) != none:
            i = pairs.index(best)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]
    ends, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        if ends[i] == 0 or (j := right[i]) >= n or ends[j] != end:
            continue
        ends[i], ends[j] = end, 0
        right[i] = k = right[j]
        if k < n:
            left[k] = i
            if (r := ranks.get(piece[i : ends[k]])) is not None:
                heapq.heappush(heap, (r, i, ends[k]))
        if (h := left[i]) >= 0 and (r := ranks.get(piece[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    return [ranks[piece[i : ends[i]]] for i in range(n) if ends[i]]


def _compiled_merge(ranks: dict[bytes, int]):
    """The same merge of one piece in tiktoken's compiled loop, where this version of it offers that."""
    import tiktoken

    core = tiktoken.Encoding("merge", pat_str=r"\s\S", mergeable_ranks=ranks, special_tokens={})
    return getattr(getattr(core, "_core_bpe", None), "encode_single_piece", None) or functools.partial(merge, ranks=ranks)


class Merged(dict):
    """Piece to its ids, packed as little-endian 32-bit numbers. Bounded: long pieces are not kept, a full cache starts anew."""

    def __init__(self, merge, most: int = 600_000, longest: int = 40):
        self.merge, self.most, self.longest = merge, most, longest

    def __missing__(self, piece: str) -> bytes:
        ids = self.merge(piece.encode())
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[piece] = out
        return out


class Aged(Merged):
    """Bounded by two generations: the younger one, full, becomes the older one, whose pieces come back when they are asked for."""

    def __init__(self, merge, most: int, longest: int = 40):
        super().__init__(merge, most // 2, longest)
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        out = self.older.get(piece)
        if out is None:
            return super().__missing__(piece)
        self[piece] = out
        return out


def _of_rank_file(file: str) -> tuple[dict[bytes, int], dict[str, int]]:
    with open(file, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, {}


def _of_tokenizer_file(file: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """The vocabulary writes each byte as a character: printable ones as themselves, the others from U+0100 on, in order."""
    with open(file, encoding="utf-8") as f:
        content = json.load(f)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in content["model"]["vocab"].items() if t not in special}, special


class Codec:
    """Encodes and decodes as the library does: tiktoken with a rank file, or tokenizers with its JSON file.

    own: pieces are merged by merge, and kept of them stay at most; without, by the library's compiled loop.
    """

    def __init__(self, file: str, library: str = "tiktoken", own: bool = False, kept: int = 600_000):
        self.ranks, special = (_of_rank_file if library == "tiktoken" else _of_tokenizer_file)(file)
        self.special = {k: struct.pack("<I", v) for k, v in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        self.classes = classes_of_tiktoken() if library == "tiktoken" else classes_of_tokenizers()
        self.merged = Aged(functools.partial(merge, ranks=self.ranks), kept) if own else Merged(_compiled_merge(self.ranks), kept)
        pieces = sorted(self.ranks, key=self.ranks.get)
        numbers = np.array([self.ranks[p] for p in pieces])
        self.lengths = np.zeros(numbers[-1] + 1, dtype=np.int64)
        self.lengths[numbers] = [len(p) for p in pieces]
        self.places = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def pieces(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """For each text its pieces and where they start."""
        joined = "\0".join([*texts, ""])
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).copy()
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        points[ends] = END_OF_TEXT
        starts = piece_starts(points, self.classes)
        cut = starts.tolist()
        every = [joined[a:b] for a, b in zip(cut, [*cut[1:], len(joined)])]
        at = np.searchsorted(starts, ends).tolist()
        first = offset = 0
        for last, end in zip(at, ends.tolist()):
            yield every[first:last], starts[first:last] - offset
            first, offset = last + 1, end + 1

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, np.ndarray]]:
        """For each text its packed ids and the offsets (in code points) of its pieces."""
        for pieces, starts in self.pieces(texts):
            yield b"".join(map(self.merged.__getitem__, pieces)), starts

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Packed ids only; strings of the file's special tokens become these tokens, as that library does."""
        if not self.split:
            return [b for b, _ in self.encode(texts)]
        parts = [self.split(t) if any(s in t for s in self.special) else [t] for t in texts]
        plain = iter([b for b, _ in self.encode([p for own in parts for p in own[::2]])])
        return [b"".join(self.special[p] if i % 2 else next(plain) for i, p in enumerate(own)) for own in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        return self.bytes[np.repeat(self.places[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()


@functools.cache
def codec(file: str, library: str = "tiktoken", own: bool = False, kept: int = 600_000) -> Codec:
    """One codec for each process and file, so that its cache serves all tasks of a worker."""
    return Codec(file, library, own, kept)


def in_runs(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Stretches of a batch of so many characters at most, or one text."""
    return runs_of([len(t) for t in texts], most)


def runs_of(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, n in enumerate(sizes):
        if i > first and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield first, len(sizes)
