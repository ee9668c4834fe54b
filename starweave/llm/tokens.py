"""Token ids of many texts with the tokenizers library, a chunk at a time.

A byte-level BPE tokenizer first cuts a text into pieces and merges inside a
piece only.  Before a single space that stands between two characters which
are not white space there is always such a cut, so a text falls into chunks
(a space and what follows it) whose ids do not depend on their neighbours.
The usual byte-level pattern also cuts between a letter and a mark, and before a
single line feed; there chunks end, too, if the tokenizer has that pattern.
The library therefore encodes each distinct chunk once per task; the ids of a
text are the ids of its chunks, one after another.  Results equal encoding
the whole text (tested), at a fraction of the time, since words repeat.

Chunks are found and looked up by numpy over the bytes of many texts at once.
A short chunk is its own key, two whole numbers that hold its bytes and
length, in an open-addressing table; longer ones are in a dict.
"""

from __future__ import annotations

import os

import numpy as np

from .common import mix64

# Distinct chunks remembered by a Python worker (about 70 MB); beyond, it
# forgets all but the half that was asked for most.
CACHE_CHUNKS = 300_000
JOINT = 200  # new chunks encoded as one text

SHORT = 15   # bytes of a chunk that is its own key


def _table(of) -> np.ndarray:
    """256 entries, True for the given bytes."""
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


# The ASCII part of white space, as Python and Unicode have it.
_SPACE = _table([*range(9, 14), *range(28, 33)])
_MARK = _table(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_LETTER = _table([*range(65, 91), *range(97, 123)])
# The first n bytes of a little-endian whole number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_lengths(tokenizer) -> np.ndarray:
    """Bytes of text behind each id (a byte-level token has one character a byte)."""
    vocab = tokenizer.get_vocab(with_added_tokens=False)
    out = np.zeros(max(vocab.values(), default=-1) + 2, np.int64)
    for token, i in vocab.items():
        out[i] = len(token)
    return out


def _wide_space(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Is the character that these three bytes hold white space?"""
    return (((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
            | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))


def _cuts(data: np.ndarray, off: np.ndarray, finer: bool) -> np.ndarray:
    """Where chunks start inside the rows of ``data`` (UTF-8, some zero bytes at its end)."""
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    at = np.flatnonzero((data == 32) | (data == 10) if finer else data == 32)
    at = at[~(_SPACE[data[at - 1]] | _SPACE[data[at + 1]] | edge[at] | edge[at + 1])]
    wide = np.flatnonzero((data[at - 1] >= 128) | (data[at + 1] >= 128))
    if len(wide):
        d = [data[at[wide] + k] for k in (-3, -2, -1, 1, 2, 3)]
        space = _wide_space(*d[:3]) | _wide_space(*d[3:])
        for a, b in (d[1:3], d[3:5]):
            space |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        at = np.delete(at, wide[space])
    if not finer:
        return at
    mark = np.flatnonzero(_MARK[data])
    before = data[mark - 1]
    # A letter: ASCII, or of two bytes (U+00C0 to U+027F, all letters but two).
    lead = data[mark - 2]
    letter = _LETTER[before] | ((before >= 128) & (before < 192) & (lead >= 0xC3) & (lead <= 0xC9)
                                & ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7))))
    return np.sort(np.concatenate([at, mark[letter & ~edge[mark]]]))


def _cuts_at_marks(tokenizer) -> bool:
    """Does it cut a text by the usual byte-level pattern and nothing else?"""
    from tokenizers.pre_tokenizers import ByteLevel

    cut = tokenizer.pre_tokenizer
    return (isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space
            and tokenizer.normalizer is None
            and all(t.special for t in tokenizer.get_added_tokens_decoder().values()))


def _keys(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two whole numbers that hold the bytes and the size of chunks of up to ``SHORT`` bytes."""
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    size = size.astype(np.uint64)
    low = words[start] & _FIRST[np.minimum(size, 8)]
    high = words[start + 8] & _FIRST[np.where(size > 8, size - np.uint64(8), 0)]
    return low, high | (size << np.uint64(56))


class _Numbers:
    """Numbers chunks in the order in which they are first asked for."""

    def __init__(self, room: int = 0):
        self.n = 0
        self.long: dict[bytes, int] = {}
        self.low = self.high = np.zeros(0, np.uint64)  # by number; zero: in ``long``
        self._grow(room)

    def _grow(self, room: int) -> None:
        """A table with places for ``room`` chunks or more, filled to 5/8 at most."""
        cells = 1 << max(10, (-(-room * 8 // 5) - 1).bit_length())
        self.mask = np.uint64(cells - 1)
        self.number = np.full(cells, -1, np.int32)
        self.cell_low, self.cell_high = np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)
        for name in ("low", "high"):
            old = getattr(self, name)[:self.n]
            setattr(self, name, np.concatenate([old, np.zeros(cells * 5 // 8 - len(old), np.uint64)]))
        short = np.flatnonzero(self.high[:self.n])
        self._place(self.low[short], self.high[short], short)

    def _cells(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix64(low ^ mix64(high)) & self.mask).astype(np.int64)

    def _place(self, low: np.ndarray, high: np.ndarray, numbers: np.ndarray) -> None:
        """Distinct keys with their numbers into the table."""
        cell = self._cells(low, high)
        while len(numbers):
            free = self.number[cell] < 0
            self.number[cell[free]] = numbers[free]  # of several the last one stays
            own = self.number[cell] == numbers
            self.cell_low[cell[own]], self.cell_high[cell[own]] = low[own], high[own]
            left = ~own
            low, high, numbers = low[left], high[left], numbers[left]
            cell = (cell[left] + 1) & int(self.mask)

    def keep(self, which: np.ndarray) -> "_Numbers":
        """Only the chunks of these numbers (ascending), numbered anew in this order,
        in a table with room for as many new ones: its size follows what is kept."""
        out = _Numbers(2 * len(which))
        out.n = len(which)
        out.low[:out.n], out.high[:out.n] = self.low[which], self.high[which]
        short = np.flatnonzero(out.high[:out.n])
        out._place(out.low[short], out.high[short], short)
        place = np.full(self.n, -1)
        place[which] = np.arange(out.n)
        out.long = {chunk: int(place[i]) for chunk, i in self.long.items() if place[i] >= 0}
        return out

    def ask(self, data: np.ndarray, start: np.ndarray, size: np.ndarray
            ) -> tuple[np.ndarray, list[bytes]]:
        """The number of every chunk, and the new chunks in the order of their numbers."""
        if self.n + len(start) > len(self.low):
            self._grow(self.n + len(start))
        out = np.zeros(len(start), np.int64)
        todo = np.flatnonzero(size <= SHORT)
        low, high = _keys(data, start[todo], size[todo])
        cell = self._cells(low, high)
        fresh = []
        while len(todo):
            found = self.number[cell]
            hit = (self.cell_low[cell] == low) & (self.cell_high[cell] == high) & (found >= 0)
            out[todo[hit]] = found[hit]
            step = ~hit & (found >= 0)
            free = np.flatnonzero(found < 0)
            if len(free):
                # Of several chunks that meet in a free cell one takes it; the others look again.
                self.number[cell[free]] = free
                won = free[self.number[cell[free]] == free]
                numbers = self.n + np.arange(len(won))
                self.number[cell[won]] = numbers
                self.cell_low[cell[won]], self.cell_high[cell[won]] = low[won], high[won]
                self.low[numbers], self.high[numbers] = low[won], high[won]
                out[todo[won]] = numbers
                fresh.append(todo[won])
                self.n += len(won)
                hit[won] = True
            cell = (cell + step) & int(self.mask)
            left = ~hit
            todo, low, high, cell = todo[left], low[left], high[left], cell[left]
        raw = data.tobytes()
        new = []
        for i in np.concatenate(fresh).tolist() if fresh else ():
            a = int(start[i])
            new.append(raw[a:a + int(size[i])])
        for i in np.flatnonzero(size > SHORT).tolist():
            a = int(start[i])
            chunk = raw[a:a + int(size[i])]
            number = self.long.get(chunk)
            if number is None:
                number = self.long[chunk] = self.n
                self.n += 1
                new.append(chunk)
            out[i] = number
        return out, new


class _Ids:
    """Ids of numbered chunks, flat, in the order of their numbers."""

    def __init__(self):
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 14, np.int64)  # number -> place of its first id
        self.n = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.at[self.n])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(sizes) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.flat[used:used + len(ids)] = ids
        self.at[self.n + 1:self.n + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.n += len(sizes)


class ChunkEncoder:
    """``encode(texts)`` gives the ids of all texts, flat, and row offsets."""

    def __init__(self, path: str, cache: int = CACHE_CHUNKS):
        # A task has one core: threads of the library only take it from other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.width = _byte_lengths(self.tokenizer)
        self.cache = cache
        self.finer = _cuts_at_marks(self.tokenizer)
        self._reset()

    def _reset(self) -> None:
        self.known = _Numbers()
        self.ids = _Ids()
        self.asked = np.zeros(1 << 14, np.int64)  # by number, since the last forgetting

    def _forget(self) -> None:
        known, ids, asked = self.known, self.ids, self.asked[:self.ids.n]
        keep = np.sort(np.argsort(-asked, kind="stable")[:self.cache // 2])
        keep = keep[asked[keep] > 1]
        self._reset()
        self.known = known.keep(keep)
        start, size = ids.at[keep], ids.at[keep + 1] - ids.at[keep]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        self.ids.add(ids.flat[np.arange(total) + np.repeat(start - (ends - size), size)], size)

    def _each(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        return np.array([i for x in found for i in x], np.uint32), sizes

    def _learn(self, chunks: list[str]) -> None:
        """Encode new chunks.  Runs of chunks that start with a space and end where another
        may start are encoded as one text and told apart by the bytes behind each id."""
        for at in range(0, len(chunks), 20_000):
            group = chunks[at:at + 20_000]
            odd = np.array([c[0] != " " or len(c) == 1 or " " in c[1:] or c[1:].strip() != c[1:]
                            for c in group])
            if not odd.any():
                self.ids.add(*self._joint(group))
                continue
            plain = self._joint([c for c, o in zip(group, odd) if not o])
            apart = self._each([c for c, o in zip(group, odd) if o])
            sizes = np.zeros(len(group), np.int64)
            sizes[~odd], sizes[odd] = plain[1], apart[1]
            ids = np.zeros(int(sizes.sum()), np.uint32)
            from_odd = np.repeat(odd, sizes)
            ids[~from_odd], ids[from_odd] = plain[0], apart[0]
            self.ids.add(ids, sizes)

    def _joint(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = ["".join(chunks[i:i + JOINT]) for i in range(0, len(chunks), JOINT)]
        ids = np.concatenate([np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(
            texts, add_special_tokens=False)])
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        ends = np.append(np.flatnonzero(raw == 32)[1:], len(raw))
        place = np.searchsorted(np.cumsum(self.width[ids]), ends) + 1
        return ids, np.diff(place, prepend=0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.known.n > self.cache:
            self._forget()
        rows = [(x or "").encode() for x in texts]
        off = np.cumsum([0, *map(len, rows)])
        data = np.frombuffer(b"".join([*rows, bytes(16)]), np.uint8)
        # A text starts with a chunk of its own: no cut before it, so it is encoded as it is.
        heads = off[:-1][np.diff(off) > 0]
        start = np.concatenate([heads, _cuts(data, off, self.finer)])
        order = np.argsort(start, kind="stable")
        start, first = start[order], order < len(heads)
        long = np.diff(start, append=off[-1])
        which = np.zeros(len(start), np.int64)
        which[~first], new = self.known.ask(data, start[~first], long[~first])
        counts = np.searchsorted(start, off)
        if new:
            self._learn([c.decode() for c in new])
        while len(self.asked) < self.ids.n:
            self.asked = np.concatenate([self.asked, np.zeros_like(self.asked)])
        np.add.at(self.asked, which[~first], 1)  # nothing here grows with what is remembered
        at = self.ids.at
        start_id, size = at[which], at[which + 1] - at[which]
        if len(heads):
            raw = data.tobytes()
            ids, size[first] = self._each([raw[a:a + n].decode() for a, n in zip(
                heads.tolist(), long[first].tolist())])
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(start_id - (ends - size), size)
        if len(heads):
            own = np.repeat(first, size)
            place[own] = 0
        out = self.ids.flat[place]
        if len(heads):
            out[own] = ids
        return out, np.concatenate([[0], ends])[counts]


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, cache: int = CACHE_CHUNKS) -> ChunkEncoder:
    """One encoder per Python worker, file and size of its memory."""
    if (path, cache) not in _ENCODERS:
        _ENCODERS[path, cache] = ChunkEncoder(path, cache)
    return _ENCODERS[path, cache]
