"""The word restaurants of the Pitman-Yor model without bounds: every word is a context, every pair a dish.

Texts are read once more and leave, for each run of texts (a chunk) and each
destination, the distinct pairs of neighbours with the documents they stand in,
packed. A pair whose context is among the frequent words goes by the pair, or by
its dish if that is rare; any other goes by its context. So all that is known of
a pair comes together at one destination, hot contexts are spread over all, and
what a destination does not see itself is known of frequent words only: their
counts, tables and probabilities, which are as many as there are frequent words.

Each destination seats its pairs given the tables that the restaurants and the
one of all words had in the round before. In the end it adds up the scores of
its tokens by document. Tokens whose context and word are both rare need what
two destinations know, and are joined by the word.

A word is spelled behind the word before it, which stands behind a space.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import pitman_yor as py
from tallyfold.llm import texts, trees
from tallyfold.session import discard, materialise

#: Kinds of packed rows: pairs with documents, pairs told to the destination of a rare dish, a frequent word, a document.
PAIRS, TOLD, WORD, DOCUMENT = range(4)
CHUNK = 1 << 20
RARE = np.uint64(1 << 63)
#: Bytes up to that of the end of a text are spelled as the one behind it.
LETTERS = bytes(max(b, py.END + 1) for b in range(256))
_PACKED = "kind byte, dest int, id long, pairs binary, learned binary, times binary, docs binary, u binary, w binary"
_FIELDS = [f.split()[0] for f in _PACKED.split(", ")]
_COUNTED = "n_tokens long, n_known long, base double"


def _small(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + pa.compress(data, "zstd", asbytes=True)


def _large(data: bytes) -> bytes:
    return pa.decompress(data[4:], int.from_bytes(data[:4], "little"), "zstd", asbytes=True)


def packed(x: np.ndarray) -> bytes:
    """Numbers of up to 63 bits: planes of their bytes, lowest first, each without the numbers that ended before it."""
    x, out, sizes = x.astype(np.uint64), [], []
    while len(x):
        sizes.append(len(x))
        low = (x & np.uint64(127)).astype(np.uint8)
        x = x >> np.uint64(7)
        more = x > 0
        out.append(low | (more.astype(np.uint8) << 7))
        x = x[more]
    return b"".join(o.tobytes() for o in out)


def unpacked(data: bytes, n: int) -> tuple[np.ndarray, int]:
    """n packed numbers, and how many bytes they took."""
    raw, out, at, left = np.frombuffer(data, np.uint8), np.zeros(n, np.int64), 0, np.arange(n)
    for shift in range(0, 64, 7):
        if not len(left):
            break
        plane = raw[at : at + len(left)]
        at += len(left)
        out[left] += (plane & 127).astype(np.int64) << shift
        left = left[plane > 127]
    return out, at


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of runs, one behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(sizes.sum()) + np.repeat(starts - ends + sizes, sizes)


def _spellings(sizes: np.ndarray, flat: np.ndarray) -> bytes:
    return _small(len(sizes).to_bytes(4, "little") + packed(sizes) + flat.tobytes())


def _spelled(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of words, and their letters."""
    data = _large(data)
    sizes, at = unpacked(data[4:], int.from_bytes(data[:4], "little"))
    return sizes, np.frombuffer(data, np.uint8)[4 + at :]


def _codes(sizes: np.ndarray, flat: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return texts.hashes(flat, ends - sizes, ends) | RARE


@dataclass
class Chunk:
    """Tokens of some texts: code of the context and of the word (rare: a hash with the top bit), document, and whether learned from."""

    m: int
    dests: int
    hot: np.ndarray

    def __post_init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0
        self.names: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, u: np.ndarray, w: np.ndarray, doc: np.ndarray, learn: np.ndarray) -> None:
        self.parts.append((u, w, doc, learn))
        self.size += len(u)

    def name(self, codes: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """How rare words are spelled."""
        self.names.append((codes, low, starts, ends))

    def rows(self, first: int) -> Iterator[dict]:
        if not self.size:
            return
        u, w, doc, learn = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts.clear()
        m = np.uint64(self.m + 1)
        # rare words of the chunk, sorted, with their letters one behind the other
        codes = np.concatenate([n[0] for n in self.names]) if self.names else np.zeros(0, np.uint64)
        rare, at = np.unique(codes, return_index=True)
        size, start = np.zeros(len(rare), np.int64), np.zeros(len(rare), np.int64)
        letters, base, filled = [np.zeros(0, np.uint8)], 0, 0
        for c, low, a, b in self.names:
            mine = np.flatnonzero((at >= base) & (at < base + len(c)))
            of = at[mine] - base
            size[mine] = b[of] - a[of]
            letters.append(low[_runs(a[of], size[mine])])
            start[mine] = filled + np.cumsum(size[mine]) - size[mine]
            filled, base = filled + len(letters[-1]), base + len(c)
        flat = np.concatenate(letters)
        u_rare, w_rare = u >= m, w >= m
        ui, wi = u.astype(np.int64), w.astype(np.int64)
        for x, i, of in ((u, ui, u_rare), (w, wi, w_rare)):
            i[of] = self.m + 1 + np.searchsorted(rare, x[of])
        width = self.m + 1 + len(rare)
        key = ui * width + wi
        spread = self.hot[np.minimum(u, np.uint64(self.m)).astype(np.int64)]
        by = np.where(u_rare, u, np.where(w_rare, w, np.where(spread, u * np.uint64(0x9E3779B97F4A7C15) + w, u)))
        dest = (texts.mix(by) % np.uint64(self.dests)).astype(np.int64)
        order = np.argsort(dest * (width * width) + key)
        key, dest, doc, learn = key[order], dest[order], doc[order], learn[order]
        new = np.flatnonzero(np.append(True, (key[1:] != key[:-1])))
        times = np.diff(np.append(new, len(key)))
        n_learned = np.add.reduceat(learn.astype(np.int64), new)
        key, dest = key[new], dest[new]
        offsets = np.append(np.cumsum(times) - times, times.sum())
        both = np.flatnonzero((key // width >= int(m)) & (key % width >= int(m)))
        told = (texts.mix(rare[key[both] % width - int(m)]) % np.uint64(self.dests)).astype(np.int64)
        order = np.argsort(told, kind="stable")
        for kind, rows, to in ((PAIRS, np.arange(len(key)), dest), (TOLD, both[order], told[order])):
            cuts = np.searchsorted(to, np.arange(self.dests + 1))
            for d in np.flatnonzero(np.diff(cuts)):
                mine = rows[cuts[d] : cuts[d + 1]]
                if kind == TOLD:
                    mine = mine[np.argsort(key[mine])]
                us, ws = key[mine] // width, key[mine] % width
                ru, rw = np.unique(us[us >= int(m)]), np.unique(ws[ws >= int(m)])
                # rare words by their place in the lists of this row
                us = np.where(us >= int(m), int(m) + np.searchsorted(ru, us), us)
                ws = np.where(ws >= int(m), int(m) + np.searchsorted(rw, ws), ws)
                pair = us * (int(m) + len(rw)) + ws
                ru, rw = ru - int(m), rw - int(m)
                out = {"kind": kind, "dest": int(d), "id": first}
                out["pairs"] = _small(len(pair).to_bytes(4, "little") + packed(np.diff(pair, prepend=0)))
                out["learned"] = _small(packed(n_learned[mine]))
                if kind == PAIRS:
                    out["times"] = _small(packed(times[mine]))
                    docs_of = doc[offsets[mine[0]] : offsets[mine[-1] + 1]]
                    out["docs"] = _small((docs_of & 255).astype(np.uint8).tobytes() + (docs_of >> 8).astype(np.uint8).tobytes())
                for name, x in (("u", ru), ("w", rw)):
                    out[name] = _spellings(size[x], flat[_runs(start[x], size[x])])
                yield out


def _pack(
    words: Broadcast, dests: int, hot_from: float, kept: list[str], learn_at: int, text_at: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: packed rows of the texts, frequent words with their letters, and the documents with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, counts = words.value
        m = len(counts) - 1
        known, hot, logs = np.zeros(m, bool), counts > hot_from, np.log10(counts + 1)
        logs, found_of = np.append(logs, 0), np.append(counts > 0, False)
        task = TaskContext.get().partitionId()
        first = task << 33

        def table(rows: list[dict], documents: list | None = None) -> pa.RecordBatch:
            n = len(documents[0]) if documents else len(rows)
            types = {"kind": pa.int8(), "dest": pa.int32(), "id": pa.int64()}
            columns = [pa.array([r.get(f) for r in rows], types.get(f, pa.binary())) for f in _FIELDS]
            more = [*schema, pa.int64(), pa.int64(), pa.float64()]
            if documents:
                ids = first + np.arange(n)
                columns = [pa.array(np.full(n, DOCUMENT, np.int8)), pa.array((ids % dests).astype(np.int32)), pa.array(ids)]
                columns += [pa.nulls(n, pa.binary()) for _ in _FIELDS[3:]]
            columns += documents or [pa.nulls(n, kind) for kind in more]
            return pa.RecordBatch.from_arrays(columns, names=names)

        names = [*_FIELDS, *kept, *(c.split()[0] for c in _COUNTED.split(", "))]
        for whole in batches:
            schema = [whole.schema.field(i).type for i in range(len(kept))]
            for at in range(0, whole.num_rows, 1 << 16):
                batch = whole.slice(at, 1 << 16)
                n = batch.num_rows
                learn_of = batch.column(learn_at).to_numpy(zero_copy_only=False).astype(bool)
                n_tokens, n_known, base = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                chunk, carried = Chunk(m, dests, hot), {}
                met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for block, last in py._pieces(batch.column(text_at)):
                    found = texts.words(block)
                    low = texts.LOWER[block.data]
                    keys = texts.hashes(low, found.starts, found.ends)
                    ids = index.find(keys).astype(np.int64)
                    codes = np.where(ids >= 0, ids.astype(np.uint64), keys | RARE)
                    tokens, before, piece = py._tokens(block, last, found, codes.view(np.int64), carried, m)
                    row = block.rows[piece]
                    chunk.add(np.where(before == -2, m, before).view(np.uint64), tokens.view(np.uint64), row.astype(np.uint16), learn_of[row])
                    dish = np.where(tokens >= 0, tokens, m + 1)
                    n_tokens += np.bincount(row, minlength=n)
                    n_known += np.bincount(row, found_of[dish], n).astype(np.int64)
                    base += np.bincount(row, logs[dish], n)
                    others = np.flatnonzero(ids < 0)
                    new, i = np.unique(codes[others], return_index=True)
                    chunk.name(new, low, found.starts[others[i]], found.ends[others[i]])
                    new, i = np.unique(ids, return_index=True)
                    fresh = (new >= 0) & ~known[np.maximum(new, 0)] if m else new < -1
                    if fresh.any():
                        new, i = new[fresh], i[fresh]
                        known[new] = True
                        size = found.ends[i] - found.starts[i]
                        met.append((new, size, low[_runs(found.starts[i], size)]))
                    if chunk.size >= CHUNK:
                        yield table(list(chunk.rows(first)))
                        # the last word of a text that goes on may be rare, and is a context yet
                        names_left = chunk.names[-1:]
                        chunk = Chunk(m, dests, hot)
                        chunk.names = names_left
                yield table(list(chunk.rows(first)))
                if met:
                    new, size, letters = (np.concatenate(x) for x in zip(*met, strict=True))
                    yield table([{"kind": WORD, "dest": task % dests, "pairs": packed(new), "w": _spellings(size, letters)}])
                yield table([], [*(batch.column(i) for i in range(len(kept))), *map(pa.array, (n_tokens, n_known, base))])
                first += n

    return run


def _words_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (id, word) of packed frequent words."""
    for batch in batches:
        for ids, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sizes, flat = _spelled(words)
            ids, _ = unpacked(ids, len(sizes))
            offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets.buffers()[1], pa.py_buffer(flat.tobytes())])
            yield pa.record_batch({"id": pa.array(ids), "word": column})


def _store(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of words one behind the other, where each starts, and its size."""
    size = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size, size


def _behind(tails: np.ndarray) -> np.ndarray:
    """The four bytes before a word, by the last three of the word before it."""
    return (tails.astype(np.uint64) << np.uint64(8)) | np.uint64(32)


def _tails(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The last three letters of words, the last one lowest; the space before a shorter word is one of them."""
    out = np.zeros(len(sizes), np.uint32)
    for back in range(3):
        some = sizes > back
        out[some] |= flat[(starts + sizes - 1 - back)[some]].astype(np.uint32) << np.uint32(8 * back)
        out[sizes == back] |= np.uint32(32 << 8 * back)
    return out


@dataclass
class Round:
    """What the frequent words' restaurants hold: a row for each (the start and the end of a text last), a column for each sample.

    tables: in the restaurant behind the word; dish: what the restaurant of all words serves of it; share: with its spelling.
    """

    tables: np.ndarray
    dish: np.ndarray
    share: np.ndarray
    escape: np.ndarray
    room: np.ndarray
    all_tables: np.ndarray
    first: bool = False


@dataclass
class Known:
    """What all tasks know: the frequent words' counts, letters and four last bytes, and the byte restaurants."""

    tree: trees.Tree
    counts: np.ndarray
    flat: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    behind: np.ndarray

    @cached_property
    def recent(self) -> trees.Recent:
        """Kept from one destination to the next in the same task process."""
        return trees.Recent(self.tree)

    @property
    def m(self) -> int:
        return len(self.counts) - 1


class Place:
    """All pairs that came to one destination."""

    def __init__(self, known: Known, table: pa.Table):
        self.known, m = known, known.m
        rows = sorted((r for r in table.to_pylist() if r["kind"] in (PAIRS, TOLD)), key=lambda r: (r["kind"], r["id"]))
        del table
        self.rows = [r for r in rows if r["kind"] == PAIRS]
        spelled = [(_spelled(r["u"]), _spelled(r["w"])) for r in rows]
        lists = [(_codes(*u), _codes(*w)) for u, w in spelled]
        none = [np.zeros(0, np.uint64)]
        self.u, at_u = np.unique(np.concatenate(none + [u for u, _ in lists]), return_index=True)
        self.w, at_w = np.unique(np.concatenate(none + [w for _, w in lists]), return_index=True)
        self.width = m + 1 + len(self.w)
        empty = [np.zeros(0, np.int64)]
        sizes, flat = (np.concatenate(x + [u[i] for u, _ in spelled]) for i, x in enumerate((empty, [np.zeros(0, np.uint8)])))
        flat, starts = np.where(flat <= py.END, np.uint8(2), flat), np.cumsum(sizes) - sizes
        self.behind = np.concatenate([known.behind, _behind(_tails(flat, starts, sizes)[at_u])])
        keys, learned, part = [], [], []
        for r, (u, w) in zip(rows, lists, strict=True):
            data = _large(r["pairs"])
            n = int.from_bytes(data[:4], "little")
            pair = np.cumsum(unpacked(data[4:], n)[0])
            us, ws = pair // (m + 1 + len(w)), pair % (m + 1 + len(w))
            us, ws = (np.append(np.arange(m + 1), m + 1 + np.searchsorted(x, y))[z] for x, y, z in ((self.u, u, us), (self.w, w, ws)))
            keys.append(us * self.width + ws)
            learned.append(unpacked(_large(r["learned"]), n)[0].astype(np.int32))
            part.append(r["kind"] == PAIRS)
        sizes, flat = (np.concatenate(x + [w[i] for _, w in spelled]) for i, x in enumerate((empty, [np.zeros(0, np.uint8)])))
        flat, starts = np.where(flat <= py.END, np.uint8(2), flat), np.cumsum(sizes) - sizes
        # as in the store of the frequent words, a space closes each
        size = sizes[at_w]
        out = np.full(size.sum() + len(size), 32, np.uint8)
        begin = np.cumsum(size + 1) - size - 1
        out[_runs(begin, size)] = flat[_runs(starts[at_w], size)]
        self.flat = np.concatenate([known.flat, out])
        self.starts = np.concatenate([known.starts, len(known.flat) + begin])
        self.sizes = np.concatenate([known.sizes, size + 1])
        self.cuts = np.cumsum([0] + [len(k) for k, p in zip(keys, part, strict=True) if p])
        keys_of = lambda kind: np.concatenate(empty + [k for k, p in zip(keys, part, strict=True) if p == kind])
        n_of = lambda kind: np.concatenate(empty + [n for n, p in zip(learned, part, strict=True) if p == kind])
        told, of = np.unique(keys_of(False), return_inverse=True)
        n_told = np.bincount(of, n_of(False), len(told))
        paired, n_paired = keys_of(True), n_of(True)
        keys.clear(), learned.clear()
        key, self.pair_of = np.unique(paired, return_inverse=True)
        self.n = np.bincount(self.pair_of, n_paired, len(key))
        self.us, self.ws = (key // self.width).astype(np.int32), (key % self.width).astype(np.int32)
        self.pair_of = self.pair_of.astype(np.int32)
        self.both = (self.us > m) & (self.ws > m)
        # what is known here of rare dishes: pairs of frequent contexts, and those it was told of
        self.mine = np.flatnonzero((self.us <= m) & (self.ws > m))
        rare = len(self.w)
        dish, told = self.ws[self.mine] - m - 1, told % self.width - m - 1
        self.here = np.zeros(rare, bool)
        self.here[dish] = self.here[told] = True
        self.told = np.bincount(told, n_told > 0, rare)
        self.n_rare = np.bincount(dish, self.n[self.mine], rare) + np.bincount(told, n_told, rare)
        self.kinds = np.bincount(dish, self.n[self.mine] > 0, rare) + self.told

    def letters(self, behind: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Log probabilities of words as they are spelled behind four bytes, a row for each sample."""
        out = [np.zeros((self.known.tree.models, 0), np.float32)]
        for a in range(0, len(words), 1 << 16):
            w, context = words[a : a + (1 << 16)], behind[a : a + (1 << 16)]
            size = self.sizes[w]
            offsets = np.concatenate([[0], np.cumsum(size + 4)])
            data = np.zeros(offsets[-1], np.uint8)
            for back in range(4):
                data[offsets[:-1] + 3 - back] = (context >> np.uint64(8 * back)) & np.uint64(255)
            data[_runs(offsets[:-1] + 4, size)] = self.flat[_runs(self.starts[w], size)]
            out.append(py._letters(self.known.recent, texts.Block(data, offsets, np.arange(len(w)), np.full(len(w), 4))).astype(np.float32))
        return np.concatenate(out, axis=1)

    def seated(self, before: Round, dest: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """By sample: tables of the pairs; customers and tables of the rare words here in the restaurant of all words."""
        m, d, strength = self.known.m, py.DISCOUNT[py.AFTER_WORD], py.STRENGTH[py.AFTER_WORD]
        all_d, all_strength = py.DISCOUNT[py.ALL_WORDS], py.STRENGTH[py.ALL_WORDS]
        spelled = np.zeros((len(before.room), len(self.w)))
        here = np.flatnonzero(self.here)
        spelled[:, here] = np.exp(self.letters(np.full(len(here), 32, np.uint64), m + 1 + here).astype(float))
        found: tuple[list, list, list] = ([], [], [])
        ones = np.minimum(self.n, 1)
        rare_ones = np.bincount(self.us, ones, m + 1 + len(self.u))[m + 1 :]
        several = np.flatnonzero((self.n > 1) & ~self.both)
        for s, room in enumerate(before.room):
            rng = np.random.default_rng([11, s, dest])
            came = np.maximum((self.n_rare if before.first else self.kinds) - all_d, 0) / room
            share = np.append(before.share[:, s], came + before.escape[s] * spelled[s])
            t, some, tables = ones.copy(), several, np.append(before.tables[:, s], rare_ones)
            for _ in range(2):
                us, p = self.us[some], np.maximum(share[self.ws[some]], 1e-300)
                t[some] = py.seat(self.n[some], (strength + d * np.maximum(tables[us] - t[some], 0)) * p, p, d, rng)
                # a rare context is whole here, so that its own tables count in a second sweep
                some = some[us > m]
                tables[m + 1 :] += np.bincount(self.us[some], t[some] - 1, len(tables))[m + 1 :]
            customers = np.bincount(self.ws[self.mine] - m - 1, t[self.mine], len(self.w)) + self.told
            weight = all_strength + all_d * max(before.all_tables[s] - 1, 0)
            found[0].append(t)
            found[1].append(customers)
            p = np.maximum(spelled[s], 1e-300)
            found[2].append(py.seat(customers, weight * p, p, all_d, rng))
        return found

    def sums(self, before: Round, dest: int) -> pa.Table:
        """(what, id, x0, x1, ...): tables behind frequent words, customers of frequent words, customers and tables of rare ones."""
        m = self.known.m
        t, customers, tables = self.seated(before, dest)
        more, ones = np.flatnonzero(self.n > 1), np.minimum(self.n, 1)
        behind, dish = (
            np.stack([np.bincount(of[more], x[more] - 1, size) for x in t], axis=1)[: m + 1] + np.bincount(of, ones, size)[: m + 1, None]
            for of, size in ((self.us, m + 1 + len(self.u)), (self.ws, self.width))
        )
        rest = np.array([[x.sum() for x in customers], [x.sum() for x in tables]])
        what, ids, values = [], [], []
        for kind, x in enumerate((behind, dish, rest)):
            some = np.flatnonzero(x.any(axis=1))
            what.append(np.full(len(some), kind, np.int8))
            ids.append(some)
            values.append(x[some])
        values = np.concatenate(values)
        columns = {"what": np.concatenate(what), "id": np.concatenate(ids).astype(np.int64)}
        return pa.table(columns | {f"x{s}": np.ascontiguousarray(values[:, s]) for s in range(values.shape[1])})

    def scores(self, before: Round, after: Round, dest: int) -> pa.Table:
        """(what, row, word, n, x0, x1, ...).

        0: the known rare tokens n of a document, the score of tokens, and the base of rare ones; 1: a token that is rare behind a rare word:
        what its context serves, leaves to all words, and the logs of what is left to spell it; 2: a rare word, its
        count, and what the restaurant of all words serves of it.
        """
        known, m = self.known, self.known.m
        samples = len(after.room)
        t, customers, tables = self.seated(before, dest)
        d, strength = py.DISCOUNT[py.AFTER_WORD], py.STRENGTH[py.AFTER_WORD]
        rare_of = lambda x: np.bincount(self.us, x, m + 1 + len(self.u))[m + 1 :]
        room = strength + np.append(known.counts, rare_of(self.n))
        left_of = [(strength + d * np.append(after.tables[:, s], rare_of(t[s]))) / room for s in range(samples)]
        rare = [(customers[s] - py.DISCOUNT[py.ALL_WORDS] * tables[s]) / after.room[s] for s in range(samples)]
        dish = [np.append(after.dish[:, s], rare[s]) for s in range(samples)]
        # each word is spelled once behind the same four bytes
        behind_of, at = np.unique(self.behind, return_inverse=True)
        spellings, of = np.unique(at[self.us] * self.width + self.ws, return_inverse=True)
        letters, of = self.letters(behind_of[spellings // self.width], spellings % self.width), of.astype(np.int32)
        logs, twice = np.empty(len(self.n)), [np.zeros((2 * samples + 1, 0))]
        for a in range(0, len(logs), 1 << 18):
            part = slice(a, a + (1 << 18))
            us, ws = self.us[part], self.ws[part]
            own = sum(self.n[part] - d * t[s][part] for s in range(samples)) / samples / room[us]
            lefts = np.stack([left_of[s][us] for s in range(samples)])
            served = sum(lefts[s] * dish[s][ws] for s in range(samples)) / samples
            spelt = np.log(lefts * after.escape[:, None]) + letters[:, of[part]]
            logs[part] = _log_mean(own + served, spelt)
            twice.append(np.concatenate([own[None], lefts, spelt])[:, self.both[part]])
        twice, place = np.concatenate(twice, axis=1), np.cumsum(self.both) - 1
        # the frequent words were counted when their texts were read
        logs[self.both], n_words = 0, np.append(np.zeros(m + 1), self.n_rare)[self.ws]
        n_words[self.both] = 0
        base, seen = np.log10(n_words + 1), n_words > 0
        parts: list[tuple] = []
        for i, row in enumerate(self.rows):
            first, pair = row["id"], self.pair_of[self.cuts[i] : self.cuts[i + 1]]
            pair = np.repeat(pair, unpacked(_large(row["times"]), len(pair))[0])
            docs = np.frombuffer(_large(row["docs"]), np.uint8).reshape(2, -1).astype(np.int64)
            docs = docs[0] + (docs[1] << 8)
            sums = [np.bincount(docs, x[pair]) for x in (logs / np.log(10), base, seen)]
            at = np.flatnonzero(np.bincount(docs))
            zero = [np.zeros(len(at))] * (2 * samples - 1)
            # in single precision, which takes half the room in the shuffle
            sums[0] = sums[0].astype(np.float32).astype(float)
            parts.append((0, first + at, np.zeros(len(at), np.int64), sums[2][at].astype(np.int64), [sums[0][at], sums[1][at], *zero]))
            two = np.flatnonzero(self.both[pair])
            pair, docs = pair[two], docs[two]
            word = self.w[np.maximum(self.ws[pair] - m - 1, 0)].view(np.int64) if len(two) else np.zeros(0, np.int64)
            parts.append((1, first + docs, word, np.zeros(len(two), np.int64), list(twice[:, place[pair]])))
        told = np.flatnonzero(self.here)
        x = [*(v[told] for v in rare), *[np.zeros(len(told))] * (samples + 1)]
        parts.append((2, np.zeros(len(told), np.int64), self.w[told].view(np.int64), self.n_rare[told].astype(np.int64), x))
        what = np.concatenate([np.full(len(p[1]), p[0], np.int8) for p in parts])
        columns = {name: np.concatenate([p[i] for p in parts]).astype(np.int64) for i, name in ((1, "row"), (2, "word"), (3, "n"))}
        values = {f"x{i}": np.concatenate([p[4][i] for p in parts]).astype(float) for i in range(2 * samples + 1)}
        return pa.table({"what": what} | columns | values)


def _log_mean(served: np.ndarray, spelt: np.ndarray) -> np.ndarray:
    """The log of what is served and the mean of what is spelled; a long word is spelled too seldom for anything but its log."""
    most = spelt.max(axis=0)
    with np.errstate(divide="ignore"):
        return np.logaddexp(np.log(served), most + np.log(np.exp(spelt - most).mean(axis=0)))


def _sums(known: Broadcast, before: Broadcast) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return Place(known.value, table).sums(before.value, key[0].as_py())

    return run


def _scores(known: Broadcast, before: Broadcast, after: Broadcast) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return Place(known.value, table).scores(before.value, after.value, key[0].as_py())

    return run


def score(
    df: DataFrame,
    learn: Column,
    text: str = "text",
    frequent: int = 1 << 17,
    nodes: int = 200_000,
    samples: int = 3,
    tasks: int = 24,
    per_dest: int = 1 << 21,
) -> DataFrame:
    """The frame without its text, with n_tokens, n_known, train_tokens, base_score and score; learned from the rows that `learn` marks.

    Results do not depend on `frequent` but for their random draws: it parts the words that every task knows from
    those known at their destination. `nodes` bounds the dishes of the byte restaurants of each length.
    """
    spark = df.sparkSession.sparkContext
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in df.columns if c not in added and c != text]
    slim = df.where(learn).select(F.col(text).alias("text"))
    tree, gathered, n_texts, n_tokens, types = py.counted(slim, nodes, samples, 3, tasks)
    keys, n_words = py.frequent_words(gathered, frequent)
    discard(gathered)
    m, counts = len(keys), np.append(n_words, n_texts).astype(float)
    dests = int(max(tasks, n_tokens // per_dest))
    names = [f"k{i}" for i in range(len(kept))]
    columns = [F.col(c).alias(k) for c, k in zip(kept, names, strict=True)]
    source = df.select(*columns, F.coalesce(learn, F.lit(False)).alias("l"), F.col(text).alias("t"))
    kinds = ", ".join([_PACKED, *(f"`{k}` {source.schema[k].dataType.simpleString()}" for k in names), _COUNTED])
    index = spark.broadcast((trees.Index(keys), counts))
    rows = source.mapInArrow(_pack(index, dests, n_tokens / dests / 8, names, len(kept), len(kept) + 1), kinds)
    rows = rows.repartition(dests, "dest").persist(StorageLevel.DISK_ONLY)
    words = rows.where(f"kind = {WORD}").select("pairs", "w").mapInArrow(_words_met, "id long, word binary")
    words = words.groupBy("id").agg(F.first("word").alias("word")).toArrow().to_pydict()
    letters = [b"?"] * m
    for i, w in zip(words["id"], words["word"], strict=True):
        letters[i] = w.translate(LETTERS)
    flat, starts, sizes = _store([*(w + b" " for w in letters), bytes([py.END])])
    behind = _behind(_tails(*_store(letters)) if m else np.zeros(0, np.uint32))
    known = Known(tree, counts, flat, starts, sizes, np.append(behind, np.uint64(0)))
    # before the first round every customer has a table of its own, and is a customer of all words
    place = Place(known, pa.table({f: pa.array([], pa.int8()) for f in ("kind", "id")}))
    spelled = np.exp(place.letters(np.full(m + 1, 32, np.uint64), np.arange(m + 1)).astype(float)).T
    room = np.full(samples, py.STRENGTH[py.ALL_WORDS] + n_tokens)
    d, strength = py.DISCOUNT[py.ALL_WORDS], py.STRENGTH[py.ALL_WORDS]
    escape = (strength + d * types) / room
    dish = np.repeat(np.maximum(counts - d, 0)[:, None], samples, axis=1) / room
    tables = np.repeat(counts[:, None], samples, axis=1)
    now = Round(tables, dish, dish + escape * spelled, escape, room, np.full(samples, float(types)), True)
    told = spark.broadcast(known)
    xs = ", ".join(f"x{s} double" for s in range(samples))
    packed_rows = rows.select(*_FIELDS).where(f"kind in ({PAIRS}, {TOLD})")
    for _ in range(2):
        before = spark.broadcast(now)
        got = packed_rows.drop("docs", "times").groupBy("dest").applyInArrow(_sums(told, before), f"what byte, id long, {xs}")
        got = got.groupBy("what", "id").agg(*[F.sum(f"x{s}").alias(f"x{s}") for s in range(samples)]).toArrow()
        what, at = got.column("what").to_numpy(), got.column("id").to_numpy()
        x = np.stack([got.column(f"x{s}").to_numpy() for s in range(samples)], axis=1)
        behind, dishes, rest = np.zeros((m + 1, samples)), np.zeros((m + 1, samples)), np.zeros((2, samples))
        for kind, into in enumerate((behind, dishes, rest)):
            into[at[what == kind]] = x[what == kind]
        now = _all_words(behind, dishes, rest, spelled)
    values = [f"x{i}" for i in range(2 * samples + 1)]
    kinds = "what byte, row long, word long, n long, " + ", ".join(f"{v} double" for v in values)
    found = packed_rows.groupBy("dest").applyInArrow(_scores(told, before, spark.broadcast(now)), kinds)
    found = materialise(found, "lm-found")
    documents = materialise(rows.where(f"kind = {DOCUMENT}").select("id", *names, "n_tokens", "n_known", "base"), "lm-documents")
    rows.unpersist()
    served = found.where("what = 2").select("word", F.col("n").alias("count"), *[F.col(f"x{s}").alias(f"p{s}") for s in range(samples)])
    two = found.where("what = 1").select("row", "word", *values).join(served, "word")
    spelt = [F.col(f"x{1 + samples + s}") for s in range(samples)]
    most = F.greatest(*spelt, F.lit(-1e300))
    unseen = most + F.ln(sum((F.exp(x - most) for x in spelt), F.lit(0.0)) / samples)
    below = sum((F.col(f"x{1 + s}") * F.col(f"p{s}") for s in range(samples)), F.lit(0.0)) / samples
    seen = F.ln(F.greatest(F.col("x0") + below, F.lit(1e-300)))
    high, low = F.greatest(seen, unseen), F.least(seen, unseen)
    log = F.when(seen < -690, unseen).otherwise(high + F.log1p(F.exp(low - high))) / float(np.log(10))
    two = two.select("row", (F.col("count") > 0).cast("long").alias("n"), log.alias("x0"), F.log10(F.col("count") + 1).alias("x1"))
    parts = found.where("what = 0").select("row", "n", "x0", "x1").unionByName(two)
    by_row = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n", "x0", "x1")])
    return documents.join(by_row, F.col("id") == F.col("row")).select(
        *[F.col(k).alias(c) for c, k in zip(kept, names, strict=True)],
        "n_tokens",
        (F.col("n_known") + F.col("n")).alias("n_known"),
        F.lit(int(n_tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("x1") - F.col("n_tokens") * float(np.log10(n_tokens + types + 1))).alias("base_score"),
        F.col("x0").alias("score"),
    )


def _all_words(behind: np.ndarray, customers: np.ndarray, rest: np.ndarray, spelled: np.ndarray) -> Round:
    """The restaurant of all words, seated given the tables it was sent; rest has the customers and tables of rare words."""
    m, samples = customers.shape[0] - 1, customers.shape[1]
    d, strength = py.DISCOUNT[py.ALL_WORDS], py.STRENGTH[py.ALL_WORDS]
    dish, escapes, rooms, totals = [], [], [], []
    for s in range(samples):
        only = np.zeros(m + 1, np.int64)
        n = customers[:, s]
        level = py.Level(py.ALL_WORDS, np.arange(m + 1), only[:1], only, n, n, np.minimum(n, 1))
        level.elsewhere = (float(rest[0, s]), float(rest[1, s]))
        py.gibbs([level], spelled[:, s], 3, np.random.default_rng([8, s]))
        escapes.append(float(py.predict([level], spelled[:, s])[1][0][0]))
        rooms.append(strength + n.sum() + rest[0, s])
        totals.append(level.tables.sum() + rest[1, s])
        dish.append((n - d * level.tables) / rooms[-1])
    dish, escapes = np.stack(dish, axis=1), np.array(escapes)
    return Round(behind, dish, dish + escapes * spelled, escapes, np.array(rooms), np.array(totals))
