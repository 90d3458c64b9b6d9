"""Byte-level BPE by a segment tree over byte positions.

A leaf holds the rank of the pair that starts at a live position (merged with its next live neighbour), an inner
node the smallest rank below it and its leftmost place. A merge takes the root's pair, drops the right part and
updates the leaves whose pair changed, each along one path to the root. Many pieces of like lengths advance together: row
r of every array is one piece, so one numpy call does the same step of all of them. Where only a few pieces are of such
a length, as with very long ones, each has a tree of its own, whose updates stop where nothing changes above.

Null text is empty text; an empty text has no tokens. Texts of any length are encoded whole, in parts cut before
blanks; one piece (a run of letters, say) takes about 45 bytes of memory for each of its own. Equal texts have equal ids,
repeated rows are encoded one by one, and an empty table gives no rows. Only the id and text columns are read, so further
columns can't clash.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tableforge.llm import common

#: Words whose ids a task keeps, in two halves: when the newer one is full, the older one goes. Bounds memory, never results.
CACHE_CHUNKS = 700_000
#: Characters of a part of a long text; bounds memory, never results.
PART_CHARS = 1 << 20
_NONE = np.int64(1 << 40)
#: Pieces of like lengths from which on one numpy call for all of them is faster than a tree each.
TOGETHER = 24
_BETWEEN = regex.compile(r"\S[ ]\S")
_TOUCH = regex.compile(r"[ ]\s|\s[ ]")


class Ranks:
    """A rank file: token bytes by id, the pair table, and the merges."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.sizes = np.array([len(t) for t in self.tokens])
        self.places = np.cumsum(self.sizes) - self.sizes
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = sorted((ranks[t[:i]] << 20 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        self.keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.merged = np.array([r for _, r in pairs] or [0], np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of left + right, or none where that isn't a token."""
        key = left << 20 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian 32-bit numbers."""
        out = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if len(piece) > 1:
                by_size.setdefault((len(piece) - 1).bit_length(), []).append(i)
            elif piece:
                out[i] = self.single[piece[0]].astype("<u4").tobytes()
        for bits, rows in by_size.items():
            step = max(1, (1 << 19) >> bits)
            for lo in range(0, len(rows), step):
                some = rows[lo : lo + step]
                if len(some) < TOGETHER:
                    for i in some:
                        out[i] = self._merge_alone(pieces[i], 1 << bits)
                    continue
                for i, ids in zip(some, self._merge([pieces[i] for i in some], 1 << bits), strict=True):
                    out[i] = ids
        return out

    @cached_property
    def pair_ranks(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True))

    def _merge_alone(self, piece: bytes, width: int) -> bytes:
        """The merges of one piece; the arrays are those of ``_merge``."""
        n, none, pairs = len(piece), int(_NONE) * width, self.pair_ranks.get
        own = self.single[np.frombuffer(piece, np.uint8)]
        first = np.full(2 * width, none, np.int64)
        first[width : width + n - 1] = self.pair(own[:-1], own[1:]) * width + np.arange(n - 1)
        for level in range(width.bit_length() - 2, -1, -1):
            a = 1 << level
            first[a : 2 * a] = np.minimum(first[2 * a : 4 * a : 2], first[2 * a + 1 : 4 * a : 2])
        tree, ids = array("q", first.tobytes()), array("i", own.astype(np.int32).tobytes())
        following, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))

        def update(place: int, value: int) -> None:
            node = place + width
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                value = value if value < other else other
                if tree[node] == value:
                    break
                tree[node] = value

        while tree[1] < none:
            rank, left = divmod(tree[1], width)
            right = following[left]
            after, prior = following[right], before[left]
            ids[left], ids[right], following[left] = rank, -1, after
            if after < n:
                before[after] = left
                near = pairs(rank << 20 | ids[after])
                update(left, none if near is None else near * width + left)
            else:
                update(left, none)
            update(right, none)
            if prior >= 0:
                near = pairs(ids[prior] << 20 | rank)
                update(prior, none if near is None else near * width + prior)
        found = np.frombuffer(ids, np.int32)
        return found[found >= 0].astype("<u4").tobytes()

    def _merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        n, count = len(pieces), np.array([len(p) for p in pieces])
        at = np.arange(width)
        live = at < count[:, None]
        ids = np.full((n, width), -1, np.int64)
        ids[live] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        following = np.where(at + 1 < count[:, None], at + 1, width)
        before = np.broadcast_to(at - 1, (n, width)).copy()
        # A node is rank * width + position: its least value is the least rank and, of equal ranks, the leftmost place.
        tree = np.full((n, 2 * width), _NONE * width, np.int64)
        both = live[:, :-1] & live[:, 1:]
        rank = np.full((n, width), _NONE, np.int64)
        rank[:, :-1][both] = self.pair(ids[:, :-1][both], ids[:, 1:][both])
        tree[:, width:] = rank * width + at
        size = width
        while size > 1:
            half = size // 2
            tree[:, half:size] = np.minimum(tree[:, size : 2 * size : 2], tree[:, size + 1 : 2 * size : 2])
            size = half
        rows = np.arange(n)
        while True:
            best = tree[rows, 1] // width
            go = best < _NONE
            rows, best = rows[go], best[go]
            if not len(rows):
                break
            left = tree[rows, 1] % width
            right = following[rows, left]
            ids[rows, left] = best
            ids[rows, right] = -1
            after = following[rows, right]
            following[rows, left] = after
            has = after < width
            before[rows[has], after[has]] = left[has]
            changed = np.full(len(rows), _NONE, np.int64)
            changed[has] = self.pair(best[has], ids[rows[has], after[has]])
            self._update(tree, rows, left, changed, width)
            self._update(tree, rows, right, np.full(len(rows), _NONE, np.int64), width)
            prior = before[rows, left]
            has = prior >= 0
            self._update(tree, rows[has], prior[has], self.pair(ids[rows[has], prior[has]], best[has]), width)
        kept = ids >= 0
        flat, ends = ids[kept].astype("<u4").tobytes(), [0, *(4 * np.cumsum(kept.sum(1))).tolist()]
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, place: np.ndarray, rank: np.ndarray, width: int) -> None:
        flat, root, node = tree.reshape(-1), rows * (2 * width), place + width
        value = rank * width + place
        flat[root + node] = value
        while width > 1:
            value = np.minimum(value, flat[root + (node ^ 1)])
            node, width = node >> 1, width >> 1
            flat[root + node] = value


def safe_parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """A text in parts of about ``size`` characters, each but the first beginning with a blank between two characters that
    aren't white space: no match of the pattern goes over such a place."""
    at = 0
    while len(text) - at > size and (cut := _BETWEEN.search(text, at + size)):
        yield text[at : cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


def plain_blanks(text: str) -> bool:
    """Whether each blank stands alone between two words."""
    return text[0] != " " and not text[-1].isspace() and not _TOUCH.search(text)


class Encoder:
    """Texts to ids by a rank file, as little-endian 32-bit numbers. Texts with plain blanks are cut before each blank: no
    match of the pattern goes over such a cut, as none holds white space but in front, so the words' ids can be kept and
    joined. Others go whole."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.pattern = Ranks(path), regex.compile(pattern)
        self.seen: dict[str, bytes] = {}  # word -> ids of the word behind a blank
        self.older: dict[str, bytes] = {}

    def code(self, strings: list[str]) -> list[bytes]:
        cut = [[m.encode() for m in self.pattern.findall(c)] for c in strings]
        pieces = list(dict.fromkeys(p for c in cut for p in c))
        ids = dict(zip(pieces, self.ranks.encode(pieces), strict=True))
        return [ids[ps[0]] if len(ps) == 1 else b"".join(map(ids.__getitem__, ps)) for ps in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; about PART_CHARS characters, whole texts or parts of them, are handled together."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, str]] = []
        size = 0
        for k, text in enumerate(texts):
            for part in safe_parts(text):
                waiting.append((k, part))
                size += len(part)
                if size >= PART_CHARS:
                    self._add(out, waiting)
                    waiting, size = [], 0
        self._add(out, waiting)
        return [ids[0] if len(ids) == 1 else b"".join(ids) for ids in out]

    def _add(self, out: list[list[bytes]], waiting: list[tuple[int, str]]) -> None:
        for (k, _), ids in zip(waiting, self._encode([p for _, p in waiting]), strict=True):
            out[k].append(ids)

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") if t and plain_blanks(t) else None for t in texts]
        firsts = iter(self.code([t if c is None else c[0] for t, c in zip(texts, cut, strict=True)]))
        words = [c[1:] if c else [] for c in cut]
        if len(self.seen) > CACHE_CHUNKS // 2:
            self.seen, self.older = {}, self.seen
        new: set[str] = set()
        for w in words:
            new.update(filterfalse(self.seen.__contains__, w))
        fresh = list(filterfalse(self.older.__contains__, new))
        self.seen.update((w, self.older[w]) for w in new if w in self.older)
        self.seen.update(zip(fresh, self.code([" " + w for w in fresh]), strict=True))
        get = self.seen.__getitem__
        return [next(firsts) + b"".join(map(get, w)) for w in words]

    def decode(self, many: list[bytes]) -> list[bytes]:
        """The bytes of each run of ids, long ones in parts."""
        step = PART_CHARS  # a multiple of 4 bytes an id
        if max(map(len, many), default=0) > step:
            return [b"".join(x for a in range(0, max(1, len(m)), step) for x in self.decode([m[a : a + step]])) for m in many]
        ids = np.frombuffer(b"".join(many), "<u4").astype(np.int64)
        sizes = self.ranks.sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        data = self.ranks.flat[np.repeat(self.ranks.places[ids] - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.append(0, np.cumsum([len(m) // 4 for m in many]))].tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(df: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """(id, n_tokens, ids, ids_sha256, decoded_sha256) of every text; ``ids`` (4 bytes each) only if ``keep``."""
    where = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(where, pattern)
        texts = batch.column(1).fill_null("").to_pylist()
        ids = [i for lo in range(0, len(texts), 500) for i in bpe.encode(texts[lo : lo + 500])]
        back = [hashlib.sha256(d).hexdigest() for lo in range(0, len(ids), 100) for d in bpe.decode(ids[lo : lo + 100])]
        columns = [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64())]
        columns += [pa.array(ids, pa.binary())] * keep
        columns += [pa.array([hashlib.sha256(i).hexdigest() for i in ids]), pa.array(back)]
        return pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "n_tokens", *["ids"] * keep, "ids_sha256", "decoded_sha256"]
    kind = df.schema[id_col].dataType.simpleString()
    return common.map_arrow(df.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens long, {'ids binary, ' * keep}ids_sha256 string, decoded_sha256 string")


def op7_bpe_encode_decode(spark, sf_dir: str) -> DataFrame:
    return encoded(common.documents(spark, sf_dir), keep=False)
