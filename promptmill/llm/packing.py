"""Best-fit packing of token pieces into sequences, improved by a swap-based local search.

Texts are cut into pieces of at most ``capacity`` tokens. Pieces are dealt at random into blocks of a
bounded number of rows; a task packs one block best fit, longest first, and then moves, exchanges
one for one or two for one between sequences that are not full, whenever that raises the sum of squared fills,
until no exchange helps. Blocks are large, so what a block's last sequence wastes is a small part.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.session import materialise

#: Pieces in a block, on average.
BLOCK = 10_000
#: Words whose ids a Python worker remembers.
_REMEMBERED = 600_000

# Words of these characters fall into runs of letters, single digits and runs of marks, each with its own ids;
# lower-casing and NFC treat their letters one by one. Apostrophes and the marks of special tokens are left out.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", re.escape("!\"#$%&()*+,-./:;=?@[\\]^_`{}~")
_PLAIN = re.compile(f"[{_LETTERS}0-9{_MARKS}]+").fullmatch
_PARTS = re.compile(f"[{_LETTERS}]+|[0-9]|[{_MARKS}]+").findall


class _PartIds(dict):
    """Ids of each run of letters or marks as little-endian bytes, found on first use."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenize = tokenizer.model.tokenize
        # The tokenizer's model reads bytes as printable characters, as byte-level models do.
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in kept]
        shown = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.shown = {i: shown[i] for i in range(256)}

    def __missing__(self, part: str) -> bytes:
        read = part if part.isascii() else part.encode().decode("latin-1").translate(self.shown)
        if len(self) >= _REMEMBERED:
            self.clear()
        ids = self[part] = np.array([t.id for t in self.tokenize(read)], "<u4").tobytes()
        return ids


class _WordIds(dict):
    """Ids of each white-space separated word as little-endian bytes, found on first use."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.part = _PartIds(self.tokenizer).__getitem__

    def __missing__(self, word: str) -> bytes:
        ids = b"".join(map(self.part, _PARTS(word.lower()))) if _PLAIN(word) else self.whole(word)
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        # str.split() also cuts at four control characters that the tokenizer's white space lacks.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, _WordIds] = {}


def _words_of(path: str) -> _WordIds:
    if path not in _loaded:
        _loaded[path] = _WordIds(path)
    return _loaded[path]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of each text's ids, closed by ``end_id``.

    The tokenizer must lower-case and drop white space, so that words have their ids
    whatever stands around them. A null or empty text is the one id ``end_id``; every row is cut on
    its own, so repeated rows give repeated pieces; other columns are ignored.
    """
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    close = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words_of(tokenizer)
        for batch in batches:
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for row, value in enumerate(batch.column("text")):
                ids = words.ids(value.as_py() or "") + close
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    part = memoryview(ids)[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    *(pa.array(values, pa.int64()) for values in (starts, lengths, sums)),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return given.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


class _Bins:
    """Bins by free space and, for the search, by the sizes they hold."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []  # sizes in each bin
        self.free: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open: list[int] = []  # free spaces that occur, sorted

    def _enter(self, b: int) -> None:
        f = self.free[b]
        if not self.by_free[f]:
            bisect.insort(self.open, f)
        self.by_free[f].append(b)

    def _leave(self, b: int) -> None:
        f = self.free[b]
        self.by_free[f].remove(b)
        if not self.by_free[f]:
            self.open.pop(bisect.bisect_left(self.open, f))

    def fit(self, size: int) -> int:
        """Put one item into the fullest bin that takes it, or a new one."""
        at = bisect.bisect_left(self.open, size)
        if at == len(self.open):
            self.items.append([])
            self.free.append(self.capacity)
            b = len(self.items) - 1
        else:
            b = self.by_free[self.open[at]][-1]
            self._leave(b)
        self.items[b].append(size)
        self.free[b] -= size
        self._enter(b)
        return b

    def exchange(self, a: int, b: int, out: list[int], back: list[int]) -> None:
        """Send ``out`` from bin a to bin b and ``back`` the other way."""
        self._leave(a)
        self._leave(b)
        for size in out:
            self.items[a].remove(size)
            self.items[b].append(size)
        for size in back:
            self.items[b].remove(size)
            self.items[a].append(size)
        gain = sum(out) - sum(back)
        self.free[a] += gain
        self.free[b] -= gain
        if self.items[a]:
            self._enter(a)
        self._enter(b)

    def improve(self, a: int, looked_at: int) -> bool:
        """Apply one exchange that sends tokens from bin a to a fuller state elsewhere."""
        fill = self.capacity - self.free[a]
        sizes = sorted(set(self.items[a]), reverse=True)
        pairs = sorted({x + y: (x, y) for i, x in enumerate(self.items[a]) for y in self.items[a][:i]}.items(), reverse=True)[:64]
        seen = 0
        for f in self.open:  # fullest bins first: filling them gains most squared fill
            if f == 0:
                continue
            for b in self.by_free[f][-4:]:
                if b == a:
                    continue
                seen += 1
                if seen > looked_at:
                    return False
                filled = self.capacity - f
                for size in sizes:  # move
                    if size <= f and filled + size > fill:
                        self.exchange(a, b, [size], [])
                        return True
                held = sorted(set(self.items[b]))
                best = (0, [], [])
                for out, total in [([s], s) for s in sizes] + [([x, y], t) for t, (x, y) in pairs]:
                    # What comes back must leave room: total - back <= f, and gain as much as can be.
                    at = bisect.bisect_left(held, total - f)
                    if at < len(held) and held[at] < total and total - held[at] > best[0]:
                        best = (total - held[at], out, [held[at]])
                if best[0] and filled + best[0] > fill:
                    self.exchange(a, b, best[1], best[2])
                    return True
        return False


class _Search:
    """All underfull bins as flat arrays of (size, bin); a size of 0 stands for what a bin sends back in a move."""

    def __init__(self, bins: _Bins):
        self.capacity = bins.capacity
        self.free = np.array(bins.free, np.int64)
        self.items = bins.items
        under = np.flatnonzero((self.free > 0) & (self.free < self.capacity)).tolist()
        self.places: dict[int, list[int]] = {}
        size, owner = [], []
        for b in under:
            self.places[b] = list(range(len(size), len(size) + len(self.items[b]) + 1))
            size += [0, *self.items[b]]
            owner += [b] * (len(self.items[b]) + 1)
        self.size, self.owner = np.array(size, np.int64), np.array(owner, np.int64)
        self.room = self.free[self.owner]

    def step(self, a: int) -> int:
        """Apply the exchange out of bin a that raises the squared fills most; the other bin, or -1 if none raises them."""
        own = self.items[a]
        sums = np.zeros(self.capacity + 1, np.int64)
        sizes, times = np.unique(np.array(own), return_counts=True)
        first, second = np.triu_indices(len(sizes), 1)
        for sent in (sizes[first] + sizes[second], 2 * sizes[times > 1], sizes):
            sums[sent] = sent
        largest = np.maximum.accumulate(sums)  # the largest sum that is no larger
        total = largest[self.size + self.room]
        ahead = self.free[a] - self.room  # how much fuller the other bin is
        gain = total - self.size
        worth = gain * (gain + ahead)
        worth[(gain <= 0) | (gain + ahead <= 0)] = 0
        worth[self.places[a]] = 0
        at = int(worth.argmax())
        if worth[at] <= 0:
            return -1
        b, back, sent = int(self.owner[at]), int(self.size[at]), int(total[at])
        out = [sent] if sent in own else next([x, sent - x] for x in own if sent - x in own and (2 * x != sent or own.count(x) > 1))
        self._move(a, b, out, [back] if back else [])
        return b

    def _move(self, a: int, b: int, out: list[int], back: list[int]) -> None:
        for source, target, sent in ((a, b, out), (b, a, back)):
            for size in sent:
                self.items[source].remove(size)
                self.items[target].append(size)
                place = next(p for p in self.places[source] if self.size[p] == size)
                self.places[source].remove(place)
                self.places[target].append(place)
                self.owner[place] = target
        gain = sum(out) - sum(back)
        self.free[a] += gain
        self.free[b] -= gain
        self.room[self.places[a]] = self.free[a]
        self.room[self.places[b]] = self.free[b]
        if not self.items[a]:  # an emptied bin takes nothing
            self.room[self.places[a]] = 0


def _settle(bins: _Bins) -> None:
    """Search until no exchange between any two bins helps; a bin is tried again whenever others have changed."""
    changed = True
    while changed:
        changed = False
        search = _Search(bins)
        for a in sorted(search.places, key=lambda b: -search.free[b]):
            while search.items[a] and search.step(a) >= 0:
                changed = True
        bins.free = search.free.tolist()


def pack_sizes(sizes: list[int], capacity: int, looked_at: int = 48) -> tuple[list[list[int]], int]:
    """Bins as lists of sizes, and how many bins best fit alone had used.

    The search first tries to dissolve the emptiest bins, looking at ``looked_at`` others for one step, and then goes on over all
    bins until no exchange helps. Every step raises the sum of squared fills, so it ends.
    """
    bins = _Bins(capacity)
    for size in sorted(sizes, reverse=True):
        bins.fit(size)
    before = len(bins.items)
    tried: set[int] = set()
    while len(tried) <= 200:
        emptiest = next((b for f in reversed(bins.open) if f for b in bins.by_free[f] if b not in tried), None)
        if emptiest is None:
            break
        while bins.items[emptiest] and bins.improve(emptiest, looked_at):
            pass
        tried.add(emptiest)
    _settle(bins)
    return [items for items in bins.items if items], before


def pack(pieces: DataFrame, *, length: str = "length", capacity: int = 2048, block: int = BLOCK) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row; no two blocks share a sequence.

    Rows are dealt to blocks by a hash of the whole row and a random number drawn once, so repeated rows do not
    meet in one task. Lengths must lie in 1 to ``capacity``. An empty table stays empty; a clashing
    column ``sequence_id`` or ``offset`` is replaced.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = materialise(pieces.select(*kept, F.rand(7).alias("_draw")))
    blocks = max(1, round(pieces.count() / block))
    dealt = pieces.withColumn("_block", F.floor(F.col("_draw") * blocks)).drop("_draw")
    schema = dealt.drop("_block").schema.add("sequence_id", "long").add("offset", "long")

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        waiting: dict[int, list[int]] = {}
        sizes = rows[length].to_numpy()
        for at in np.argsort(sizes, kind="stable").tolist():
            waiting.setdefault(int(sizes[at]), []).append(at)
        bins, _ = pack_sizes(sizes.tolist(), capacity)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for b, items in enumerate(bins):
            filled = 0
            for size in items:
                at = waiting[size].pop()
                sequence[at], offset[at] = (int(key[0]) << 32) + b, filled
                filled += size
        return rows.drop(columns="_block").assign(sequence_id=sequence, offset=offset)

    return dealt.groupBy("_block").applyInPandas(fill, schema)
