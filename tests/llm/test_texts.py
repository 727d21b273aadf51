import numpy as np
import pyarrow as pa
import pytest

from tallyfold.llm import texts, trees

COLUMN = pa.array(["ab cd", None, "", "  é e\tf ", "long " * 100, "x" * 300, "end"])


@pytest.mark.parametrize("limit", [16, 64, 1 << 20])
def test_blocks_hold_every_byte_and_word_once(limit):
    want = [(t or "").encode() for t in COLUMN.to_pylist()]
    got, words = [b""] * len(want), [[] for _ in want]
    for block in texts.blocks(COLUMN, limit):
        found = texts.words(block)
        for i, row in enumerate(block.rows):
            got[row] += block.data[block.offsets[i] : block.offsets[i + 1]].tobytes()
        for a, b, piece in zip(found.starts, found.ends, found.piece):
            words[block.rows[piece]].append(block.data[a:b].tobytes())
    assert got == want
    assert words == [t.split() for t in want]


def test_leads_repeat_what_came_before():
    text = bytes(range(97, 123)) * 10
    seen = b""
    for block in texts.blocks(pa.array([text.decode()]), 50, lead=4):
        own = trees.own(block)
        assert block.data[~own].tobytes() == seen[len(seen) - block.lead[0] :]
        seen += block.data[own].tobytes()
    assert seen == text


def test_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(b"abc--abc-abd", np.uint8)
    h = texts.hashes(data, np.array([0, 5, 9, 0]), np.array([3, 8, 12, 0]))
    assert h[0] == h[1] != h[2] and h[3] not in h[:3]


def test_grams_stop_at_the_start_of_a_text():
    block = next(texts.blocks(pa.array(["abc", "d", "", "ef"])))
    want = []
    for t in ("abc", "d", "ef"):
        for i in range(len(t)):
            key = 0
            for j, c in enumerate(t[max(0, i - 2) : i + 1][::-1]):
                key |= ord(c) << 8 * j
            want.append(key)
    assert trees.grams(block, 2).tolist() == want


def test_index_finds_all_keys_and_no_others():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 60, 5000, dtype=np.uint64))
    index = trees.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 60, 5000, dtype=np.uint64), keys)
    assert (index.find(others) == -1).all()
    assert trees.Index(keys[:0]).find(keys).max() == -1


def _plain_ppm(samples, order, text, interpolate):
    """Code length by dictionaries, one byte after the other."""
    counts = {}
    for t in samples:
        for i, b in enumerate(t):
            for k in range(order + 1):
                context = (b"\0" * k + t[:i])[len(t[:i]) :] if k else b""
                counts.setdefault((k, context), {}).setdefault(b, 0)
                counts[k, context][b] += 1

    def p(k, past, b):
        if k < 0:
            return 1 / 256
        seen = counts.get((k, (b"\0" * k + past)[len(past) :] if k else b""))
        if seen is None:
            return p(k - 1, past, b)
        n, kinds = sum(seen.values()), len(seen)
        own, escape = seen.get(b, 0) / (n + kinds), kinds / (n + kinds)
        if interpolate:
            return own + escape * p(k - 1, past, b)
        return own if own else escape * p(k - 1, past, b)

    return sum(np.log(p(order, text[:i], b)) for i, b in enumerate(text))


@pytest.mark.parametrize("interpolate", [False, True])
def test_trees_agree_with_plain_code_lengths(interpolate):
    samples = [[b"the cat sat on the mat", b"a theta"], [b"der hund", b"die katze hat hunger"]]
    batch = pa.record_batch({"t": pa.array([t.decode() for s in samples for t in s]), "m": pa.array([0, 0, 1, 1])})
    count = trees.counted(lambda b: (b.column(0), b.column(1).to_numpy()), 3)
    rows = pa.Table.from_batches(list(count(iter([batch]))))
    keys, at = np.unique(rows.column("gram").to_numpy().astype(np.uint64), return_inverse=True)
    n = np.zeros((len(keys), 2), np.int64)
    np.add.at(n, (at, rows.column("model").to_numpy()), rows.column("n").to_numpy())
    tree = trees.fit(keys, n, 3, interpolate)
    for text in (b"the hat", b"die matte", b"\xc3\xa9 zz", b"t"):
        block = next(texts.blocks(pa.array([text.decode()])))
        got = tree.log_probs(trees.grams(block, 3)).sum(axis=0)
        want = [_plain_ppm(s, 3, text, interpolate) for s in samples]
        assert got == pytest.approx(want, rel=1e-5)
