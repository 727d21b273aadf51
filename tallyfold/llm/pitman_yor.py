"""Language-model scoring by a hierarchical Pitman-Yor model of words, spelled out in bytes.

Every token of a training text is a customer in the restaurant of the token
before it. The tables of that restaurant are customers in the one of all words,
whose base distribution spells words: a word is its bytes and one space, the end
of a text is the byte 0x01, and each byte is a customer in the restaurant of the
four bytes before it, whose tables are customers in the one with the oldest byte
dropped, down to the empty context. So known and unknown words alike have a
probability, and those of all texts sum to one.

Seating is sampled by blocked Gibbs: a block is all customers of a restaurant
who have the same dish; they leave and are seated again one after the other,
given the other tables and the parent's predictive probabilities. Restaurants
with long contexts are seated in parallel tasks, given their parents' current
predictions; the parents are then seated anew, given the tables they were sent.
Several seatings are kept, and the probabilities they predict are averaged.

Counts come from all training texts, and every word has its dish in the
restaurant of all words. The `frequent` words are in the memory of the tasks; the
others are a stored table, seated in parallel given the tables of all, and joined
with the texts by their hash when these are scored. What is bounded by parameters
is the context: `contexts` words have a restaurant, and `nodes` bounds the dishes
of word and of byte contexts. Customers beyond that sit down in the parent
restaurant at once; a word restaurant leaves its parent the mass of those it has
passed on. word_pairs has the model whose word contexts have no such bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import texts, trees
from tallyfold.session import discard, materialise

ORDER = 4
#: Levels of the word restaurants; byte restaurants are numbered by the length of their context.
ALL_WORDS, AFTER_WORD = ORDER + 1, ORDER + 2
#: Discount and strength by level.
DISCOUNT = (0.2, 0.4, 0.5, 0.6, 0.7, 0.6, 0.75)
STRENGTH = (1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 2.0)
END = 1


def _pieces(column: pa.Array) -> Iterator[tuple[texts.Block, np.ndarray]]:
    """Blocks of the texts, and which pieces end a text."""
    _, offsets = texts.utf8(column)
    length = np.diff(offsets)
    done = np.zeros(len(length), np.int64)
    for block in texts.blocks(column, texts.BLOCK // 4):
        done[block.rows] += np.diff(block.offsets)
        yield block, done[block.rows] == length[block.rows]


def _spelled(column: pa.Array) -> Iterator[tuple[texts.Block, texts.Block, np.ndarray]]:
    """Blocks of the texts, the same with tokens spelled out, and which pieces end a text.

    Every word is followed by one space and every text by an end byte.

    White space before the first word has no token. The pieces of a long text
    repeat the last bytes of the one before as lead, and only its last piece has
    the end.
    """
    tails: dict[int, np.ndarray] = {}
    for block, last in _pieces(column):
        data = texts.LOWER[block.data]
        data[data <= END] = 2
        space = texts.SPACE[block.data]
        data[space] = 32
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        some = block.nonempty()
        first = block.offsets[:-1][some]
        keep[first] = ~space[first]
        # a text that ends in a word gets the space behind it too
        ends = block.offsets[1:][some] - 1
        open_word = np.zeros(len(block.rows), bool)
        open_word[some] = ~space[ends]
        kept = np.concatenate([[0], np.cumsum(keep)])
        here = kept[block.offsets[1:]] - kept[block.offsets[:-1]]
        lead = np.zeros(len(block.rows), np.int64)
        if tails:
            lead[:] = [len(tails.get(int(r), ())) for r in block.rows]
        extra = (open_word & last).astype(np.int64) + last
        out_offsets = np.concatenate([[0], np.cumsum(lead + here + extra)])
        out = np.full(out_offsets[-1], END, np.uint8)
        at = np.arange(kept[-1]) + np.repeat(out_offsets[:-1] + lead - kept[block.offsets[:-1]], here)
        out[at] = data[keep]
        spaced = np.flatnonzero(open_word & last)
        out[out_offsets[spaced] + lead[spaced] + here[spaced]] = 32
        for i in np.flatnonzero(lead):
            out[out_offsets[i] : out_offsets[i] + lead[i]] = tails.pop(int(block.rows[i]))
        for i in np.flatnonzero(~last):
            tails[int(block.rows[i])] = out[max(out_offsets[i], out_offsets[i + 1] - ORDER) : out_offsets[i + 1]].copy()
        yield block, texts.Block(out, out_offsets, block.rows, lead), last


def _tokens(
    block: texts.Block, last: np.ndarray, found: texts.Words, ids: np.ndarray, carried: dict[int, int], n_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of a block, ends included, the token before each, and their pieces.

    A frequent word is its number, the end of a text n_words, any other word -1;
    before the first token of a text stands -2. carried has the last token of a
    text of which this block is a later piece.
    """
    pieces = len(block.rows)
    size = found.per_piece(pieces) + last
    offsets = np.concatenate([[0], np.cumsum(size)])
    tokens = np.full(offsets[-1], n_words)
    tokens[np.arange(len(ids)) + (np.cumsum(last) - last)[found.piece]] = ids
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    some = np.flatnonzero(size)
    before[offsets[some]] = -2
    for piece in some if carried else ():
        before[offsets[piece]] = carried.pop(int(block.rows[piece]), -2)
    for piece in some[~last[some]]:
        carried[int(block.rows[piece])] = int(tokens[offsets[piece + 1] - 1])
    return tokens, before, np.repeat(np.arange(pieces), size)


def context_of(before: np.ndarray, contexts: int) -> np.ndarray:
    """The number of the restaurant behind a token: `contexts` at the start of a text, -1 if there is none."""
    return np.where(before == -2, contexts, np.where(before < contexts, before, -1))


def pair_of(tokens: np.ndarray, before: np.ndarray, n_words: int, contexts: int) -> np.ndarray:
    """The number of restaurant and dish of each token, -1 if either has none; the end of a text is dish `contexts`."""
    at = context_of(before, contexts)
    dish = np.where(tokens == n_words, contexts, np.where(tokens < contexts, tokens, -1))
    return np.where((at >= 0) & (dish >= 0), at * (contexts + 1) + dish, -1)


def _gather(held: list[tuple[np.ndarray, np.ndarray]], kind: int) -> pa.RecordBatch:
    keys, n = trees.merged(np.concatenate([k for k, _ in held]), np.concatenate([n for _, n in held]))
    return pa.record_batch(
        {"kind": pa.array(np.full(len(keys), kind, np.int8)), "key": pa.array(keys.astype(np.int64)), "n": pa.array(n)}
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): grams as kind 0 and word hashes as kind 1, counted within each task."""
    held: tuple[list, list] = ([], [])
    size = 0
    for batch in batches:
        for block, spelled, _ in _spelled(batch.column(0)):
            found = texts.words(block)
            for kind, keys in (
                (0, trees.grams(spelled, ORDER)[trees.own(spelled) if spelled.lead.any() else slice(None)]),
                (1, texts.hashes(texts.LOWER[block.data], found.starts, found.ends)),
            ):
                distinct, n = np.unique(keys, return_counts=True)
                held[kind].append((distinct, n.astype(np.int64)))
                size += len(distinct)
            if size > 1 << 21:
                yield from (_gather(part, kind) for kind, part in enumerate(held) if part)
                held, size = ([], []), 0
    yield from (_gather(part, kind) for kind, part in enumerate(held) if part)


def seat(customers: np.ndarray, weight: np.ndarray, share: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that the customers of each block take, seated one after the other.

    weight is (strength + discount * other tables) * parent's probability, share
    the parent's probability. With t tables and i customers seated, the next one
    opens a table with odds weight + discount * t * share to i - discount * t.
    Beyond 32 customers they come in groups of a sixteenth of those seated, in
    which the odds stay as they are.
    """
    order = np.argsort(-customers, kind="stable")
    n, weight, share = customers[order], weight[order], share[order]
    tables = np.minimum(n, 1).astype(np.float64)
    seated = 1
    while True:
        active = int(np.searchsorted(-n, -seated, "left"))
        if not active:
            break
        group = max(1, seated // 16)
        t = tables[:active]
        open_ = weight[:active] + discount * t * share[:active]
        p = np.clip(open_ / (open_ + np.maximum(seated - discount * t, 1e-9)), 0, 1)
        if group == 1:
            t += rng.random(active) < p
        else:
            t += rng.binomial(np.minimum(group, n[:active] - seated).astype(np.int64), p)
        seated += group
    out = np.empty(len(n))
    out[order] = tables
    return out


@dataclass
class Level:
    """Restaurants with contexts of one length: a row for each dish."""

    length: int
    grams: np.ndarray
    contexts: np.ndarray
    of: np.ndarray
    direct: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    parent: np.ndarray | None = None
    #: Customers of each context who were passed on to its parent.
    passed: np.ndarray | float = 0.0
    #: Customers and tables of dishes that are seated elsewhere.
    elsewhere: tuple[float, float] = (0.0, 0.0)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        m, (customers, tables) = len(self.contexts), self.elsewhere
        return np.bincount(self.of, self.customers, m) + customers, np.bincount(self.of, self.tables, m) + tables


def levels_of(keys: np.ndarray, lengths: np.ndarray, n: np.ndarray, shortest: int, longest: int) -> list[Level]:
    """The levels, shortest first; each holds all suffixes of the one above it. One table for each dish to begin with."""
    out: list[Level] = []
    above = np.zeros(0, np.uint64)
    for k in range(longest, shortest - 1, -1):
        mine = lengths == k
        grams = np.unique(np.concatenate([trees.suffix(above, k), trees.suffix(keys[mine], k)]))
        direct = np.zeros(len(grams))
        np.add.at(direct, np.searchsorted(grams, trees.suffix(keys[mine], k)), n[mine])
        customers = direct.copy()
        if out:
            out[-1].parent = np.searchsorted(grams, trees.suffix(above, k))
            customers += np.bincount(out[-1].parent, out[-1].tables, len(grams))
        contexts, of = np.unique(grams >> np.uint64(8), return_inverse=True)
        out.append(Level(k, grams, contexts, of, direct, customers, np.minimum(customers, 1)))
        above = grams
    return out[::-1]


def predict(levels: list[Level], base: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By level, the predictive probability of each row and the weight each context leaves its parent.

    base has the parent's probability of each row of the shortest level.
    """
    probs, escapes = [], []
    for i, level in enumerate(levels):
        d, strength = DISCOUNT[level.length], STRENGTH[level.length]
        customers, tables = level.totals()
        room = strength + customers + level.passed
        escape = (strength + d * tables + level.passed) / room
        below = probs[-1][level.parent] if i else base
        own = (level.customers - d * level.tables) / room[level.of]
        probs.append(own + escape[level.of] * below)
        escapes.append(escape)
    return probs, escapes


def gibbs(levels: list[Level], base: np.ndarray, sweeps: int, rng: np.random.Generator) -> None:
    """Sweeps over all blocks, longest contexts first."""
    for _ in range(sweeps):
        probs, _ = predict(levels, base)
        for i in range(len(levels) - 1, -1, -1):
            level = levels[i]
            d, strength = DISCOUNT[level.length], STRENGTH[level.length]
            share = probs[i - 1][level.parent] if i else base
            weight = (strength + d * level.totals()[1] + level.passed)[level.of] - d * level.tables
            level.tables = seat(level.customers, weight * share, share, d, rng)
            if i:
                below = levels[i - 1]
                below.customers = below.direct + np.bincount(level.parent, level.tables, len(below.grams))
                below.tables = np.clip(below.tables, np.minimum(below.customers, 1), below.customers)


@dataclass
class Model:
    """Averaged seatings, a column for each kept sample, and counts of the training tokens.

    Word i has row i of `own`, the end of a text the last row, and the first
    `contexts` words have a restaurant, as has the start of a text (the last).
    """

    tree: trees.Tree
    words: trees.Index
    word_counts: np.ndarray
    own: np.ndarray
    escape: np.ndarray
    contexts: int
    pairs: trees.Index
    pair_own: np.ndarray
    pair_escape: np.ndarray
    texts: int
    tokens: int
    types: int


SHORT = 2


def _customers(grams: DataFrame, nodes: int) -> DataFrame:
    """(gram, length, n): customers by the length of the context at whose restaurant they sit down."""
    out = grams.withColumn("length", F.lit(ORDER))
    context = F.shiftright("gram", 8)
    for length in range(ORDER, 1, -1):
        bits = F.floor(F.log2(F.sum("n"))).cast("int").alias("bits")
        visits = out.where(F.col("length") == length).groupBy(context.alias("context")).agg(bits, F.count("*").alias("rows"))
        by_bits = {r["bits"]: r["total"] for r in visits.groupBy("bits").agg(F.sum("rows").alias("total")).collect()}
        left, least = sum(by_bits.values()), 0
        while left > nodes:
            left -= by_bits.get(least, 0)
            least += 1
        if not least:
            break
        small = visits.where(F.col("bits") < least).select("context", F.lit(True).alias("small"))
        moved = out.withColumn("context", F.when(F.col("length") == length, context)).join(small, "context", "left")
        keep = F.col("small").isNull()
        out = moved.select(
            F.when(keep, F.col("gram")).otherwise(F.col("gram").bitwiseAND((1 << 8 * length) - 1)).alias("gram"),
            F.when(keep, F.col("length")).otherwise(length - 1).alias("length"),
            "n",
        )
        out = materialise(out.groupBy("gram", "length").agg(F.sum("n").alias("n")), "lm-shorter")
    return out


def _seatings(rows: DataFrame, short: tuple[np.ndarray, np.ndarray], samples: int, sweeps: int, tasks: int) -> DataFrame:
    """(length, gram, customers, tables) of the long contexts, with an entry for each sample."""
    sent = rows.sparkSession.sparkContext.broadcast(short)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).sort_by([("length", "ascending"), ("gram", "ascending")])
        grams, lengths = table.column("gram").to_numpy().astype(np.uint64), table.column("length").to_numpy()
        n = table.column("n").to_numpy().astype(np.float64)
        keys, p = sent.value
        found = []
        for sample in range(samples):
            levels = levels_of(grams, lengths, n, SHORT + 1, ORDER)
            base = p[np.searchsorted(keys, trees.suffix(levels[0].grams, SHORT))]
            gibbs(levels, base, sweeps, np.random.default_rng([sample, task]))
            found.append(levels)
        for same in zip(*found, strict=True):
            size = len(same[0].grams)
            by_sample = lambda x: pa.FixedSizeListArray.from_arrays(
                pa.array(np.stack([getattr(level, x) for level in same], axis=1).ravel()), samples
            ).cast(pa.list_(pa.float64()))
            yield pa.record_batch(
                {
                    "length": pa.array(np.full(size, same[0].length, np.int32)),
                    "gram": pa.array(same[0].grams.astype(np.int64)),
                    "customers": by_sample("customers"),
                    "tables": by_sample("tables"),
                }
            )

    ends_alike = F.shiftright("gram", 8).bitwiseAND((1 << 8 * (SHORT + 1)) - 1)
    long = rows.where(F.col("length") > SHORT).repartition(tasks, ends_alike)
    return long.mapInArrow(run, "length int, gram long, customers array<double>, tables array<double>")


def _column(table: pa.Table, name: str, samples: int) -> np.ndarray:
    return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, samples)


def _spelling(grams: DataFrame, nodes: int, samples: int, sweeps: int, tasks: int) -> trees.Tree:
    """The byte restaurants, seated, as a tree with a column for each sample."""
    rows = _customers(grams, nodes)
    short_gram = F.col("gram").bitwiseAND((1 << 8 * (SHORT + 1)) - 1).alias("gram")
    dishes = rows.where(F.col("length") > SHORT).select(F.col("gram").bitwiseAND((1 << 8 * (SHORT + 2)) - 1).alias("gram"))
    sent = dishes.distinct().groupBy(short_gram).count()
    sent = sent.select("gram", F.lit(SHORT).alias("length"), F.col("count").alias("n")).toArrow()
    direct = rows.where(F.col("length") <= SHORT).toArrow()
    column = lambda name, kind: np.concatenate([t.column(name).to_numpy().astype(kind) for t in (direct, sent)])
    rng = np.random.default_rng(0)
    short = levels_of(column("gram", np.uint64), column("length", np.int64), column("n", float), 0, SHORT)
    uniform = np.full(len(short[0].grams), 1 / 256)
    gibbs(short, uniform, sweeps, rng)
    before = (short[-1].grams, predict(short, uniform)[0][-1])

    seated = _seatings(rows, before, samples, sweeps, tasks).toArrow()
    length, gram = seated.column("length").to_numpy(), seated.column("gram").to_numpy().astype(np.uint64)
    customers, tables = (_column(seated, x, samples) for x in ("customers", "tables"))
    first = length == SHORT + 1
    keys = np.concatenate([direct.column("gram").to_numpy().astype(np.uint64), trees.suffix(gram[first], SHORT)])
    lengths = np.concatenate([direct.column("length").to_numpy(), np.full(first.sum(), SHORT)])
    found = []
    for sample in range(samples):
        n = np.concatenate([direct.column("n").to_numpy(), tables[first, sample]]).astype(float)
        levels = levels_of(keys, lengths, n, 0, SHORT)
        uniform = np.full(len(levels[0].grams), 1 / 256)
        gibbs(levels, uniform, sweeps, rng)
        for k in range(SHORT + 1, ORDER + 1):
            mine = np.flatnonzero(length == k)
            mine = mine[np.argsort(gram[mine])]
            contexts, of = np.unique(gram[mine] >> np.uint64(8), return_inverse=True)
            level = Level(k, gram[mine], contexts, of, np.zeros(0), customers[mine, sample], tables[mine, sample])
            level.parent = np.searchsorted(levels[-1].grams, trees.suffix(gram[mine], k - 1))
            levels.append(level)
        found.append((levels, *predict(levels, uniform)))
    tree = trees.Tree(samples)
    for k in range(ORDER + 1):
        logs, escapes = (np.log(np.stack([f[i][k] for f in found], axis=1)) for i in (1, 2))
        tree.add(found[0][0][k].grams, logs, found[0][0][k].contexts, escapes)
    return tree


def _letters(recent: trees.Recent, spelled: texts.Block) -> np.ndarray:
    """Log probabilities of the tokens as they are spelled, a row for each sample."""
    keys, data = trees.grams(spelled, ORDER), spelled.data
    if spelled.lead.any():
        mine = trees.own(spelled)
        keys, data = keys[mine], data[mine]
    p = recent.log_probs(keys)
    closing = np.flatnonzero((data == 32) | (data == END))
    if not len(closing):
        return np.zeros((len(p), 0))
    return np.add.reduceat(p, np.append(0, closing[:-1] + 1), axis=1, dtype=np.float64)


def _apart(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> texts.Block:
    """Words as pieces of their own, each behind a space, which is lead, and with one behind it."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size + 2)])
    out = np.full(offsets[-1], 32, np.uint8)
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    letters = low[np.repeat(starts, size) + within]
    out[np.repeat(offsets[:-1] + 1, size) + within] = np.where(letters <= END, np.uint8(2), letters)
    return texts.Block(out, offsets, np.arange(len(size)), np.ones(len(size), np.int64))


def _met(
    words: Broadcast, tree: Broadcast, n_words: int, contexts: int, samples: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: (kind, key, n, s0, s1, ...), counted within each task.

    Of kind 0 are pairs of neighbours that both have restaurants; the start of a
    text and its end share the number `contexts`. Of kind 1 are the numbers of
    frequent words, each handed on once, and of kind 2 the hashes of other words;
    both have the log probabilities of their spelling.
    """

    def rows(kind: int, keys: np.ndarray, n: np.ndarray, logs: np.ndarray | None = None) -> pa.RecordBatch:
        columns = {"kind": np.full(len(keys), kind, np.int8), "key": keys.astype(np.int64), "n": n.astype(np.int64)}
        for s in range(samples):
            columns[f"s{s}"] = pa.nulls(len(keys), pa.float32()) if logs is None else logs[s].astype(np.float32)
        return pa.record_batch({name: pa.array(x) for name, x in columns.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, recent, held, size = words.value, trees.Recent(tree.value), [], 0
        known = np.zeros(n_words, bool)
        for batch in batches:
            carried: dict[int, int] = {}
            rare, n_rare, logs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros((samples, 0))]
            for block, last in _pieces(batch.column(0)):
                found = texts.words(block)
                low = texts.LOWER[block.data]
                keys = texts.hashes(low, found.starts, found.ends)
                ids = index.find(keys).astype(np.int64)
                tokens, before, _ = _tokens(block, last, found, ids, carried, n_words)
                pair = pair_of(tokens, before, n_words, contexts)
                held.append(np.unique(pair[pair >= 0], return_counts=True))
                size += len(held[-1][0])
                others = np.flatnonzero(ids < 0)
                new, at, n = np.unique(keys[others], return_index=True, return_counts=True)
                rare.append(new)
                n_rare.append(n)
                logs.append(_letters(recent, _apart(low, found.starts[others[at]], found.ends[others[at]])))
                new, at = np.unique(ids, return_index=True)
                fresh = (new >= 0) & ~known[new]
                new, at = new[fresh], at[fresh]
                if len(new):
                    known[new] = True
                    spelt = _letters(recent, _apart(low, found.starts[at], found.ends[at]))
                    yield rows(1, new, np.ones(len(new)), spelt)
            keys, at, of = np.unique(np.concatenate(rare), return_index=True, return_inverse=True)
            if len(keys):
                yield rows(2, keys, np.bincount(of, np.concatenate(n_rare)), np.concatenate(logs, axis=1)[:, at])
            if size > 1 << 22:
                yield rows(0, *trees.merged(*map(np.concatenate, zip(*held, strict=True))))
                held, size = [], 0
        if held:
            yield rows(0, *trees.merged(*map(np.concatenate, zip(*held, strict=True))))

    return run


def _after_words(
    pairs: DataFrame, passed: np.ndarray, shares: np.ndarray, contexts: int, samples: int, sweeps: int, tasks: int
) -> DataFrame:
    """(pair, customers, tables) of the restaurants of words, with an entry of tables for each sample."""
    sent = pairs.sparkSession.sparkContext.broadcast((passed, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts).sort_by("pair")
        pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy().astype(np.float64)
        behind, share = sent.value
        of_word, of = np.unique(pair // (contexts + 1), return_inverse=True)
        found = []
        for sample in range(samples):
            level = Level(AFTER_WORD, pair, of_word, of, n, n, np.minimum(n, 1), None, behind[of_word])
            gibbs([level], share[pair % (contexts + 1)], sweeps, np.random.default_rng([9, sample, task]))
            found.append(level.tables)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(np.stack(found, axis=1).ravel()), samples)
        yield pa.record_batch(
            {"pair": pa.array(pair), "customers": pa.array(n), "tables": lists.cast(pa.list_(pa.float64()))}
        )

    dealt = pairs.repartition(tasks, F.floor(F.col("pair") / (contexts + 1)))
    return dealt.mapInArrow(run, "pair long, customers double, tables array<double>")


def _seated_words(rare: DataFrame, tables: float, samples: int) -> tuple[DataFrame, np.ndarray]:
    """The rare words with their tables t0, t1, ... in the restaurant of all words, stored, and the sums of these.

    Each word is a block of its own, given the other words' tables; those of the
    rare ones are at first as many as there are words, and then what that gave.
    """
    names = [f"t{s}" for s in range(samples)]
    n_rare = float(rare.count())
    others, seated, first = np.full(samples, tables + n_rare), rare, True
    d, strength = DISCOUNT[ALL_WORDS], STRENGTH[ALL_WORDS]
    for _ in range(2):

        def run(batches: Iterator[pa.RecordBatch], others: np.ndarray = others) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([7, TaskContext.get().partitionId()])
            for batch in batches:
                n = batch.column(1).to_numpy().astype(float)
                found = []
                for s in range(samples):
                    share = np.exp(batch.column(2 + s).to_numpy().astype(float))
                    found.append(seat(n, (strength + d * (others[s] - 1)) * share, share, d, rng))
                yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names=[*batch.schema.names, *names])

        schema = texts.extended(rare.schema, **dict.fromkeys(names, "double"))
        seated = rare.mapInArrow(run, schema).select("key", "n", *names)
        if first:
            first = False
        else:
            seated = materialise(seated, "lm-seated-words")
        sums = seated.agg(*[F.coalesce(F.sum(t), F.lit(0.0)) for t in names]).first()
        others = tables + np.array(sums, float)
    return seated, others - tables


def _most(table: DataFrame, column: str, bound: int) -> int:
    """The least number of quarter octaves such that `bound` rows at most have a count of that size or more."""
    size = F.floor(F.log2(column) * 4).cast("int").alias("size")
    least, left = 0, 0
    for r in sorted(table.groupBy(size).count().collect(), key=lambda r: -r["size"]):
        left += r["count"]
        if left > bound:
            return r["size"] + 1
        least = r["size"]
    return least


def counted(slim: DataFrame, nodes: int, samples: int, sweeps: int, tasks: int) -> tuple[trees.Tree, DataFrame, int, int, int]:
    """The byte restaurants of texts; (key, n) of their words, stored; and how many texts, tokens and different tokens there are."""
    counts = slim.mapInArrow(_counts, "kind byte, key long, n long")
    counts = materialise(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")
    n_texts = slim.count()
    vocabulary = counts.where("kind = 1")
    total, kinds = vocabulary.agg(F.sum("n"), F.count("*")).first()
    tree = _spelling(counts.where("kind = 0").select(F.col("key").alias("gram"), "n"), nodes, samples, sweeps, tasks)
    return tree, counts, n_texts, (total or 0) + n_texts, kinds + (n_texts > 0)


def frequent_words(counts: DataFrame, frequent: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, by counts down."""
    vocabulary = counts.where("kind = 1").select("key", "n")
    least = _most(vocabulary, "n", frequent)
    common = vocabulary.where(F.floor(F.log2("n") * 4) >= least).toArrow().sort_by([("n", "descending"), ("key", "ascending")])
    return common.column("key").to_numpy().astype(np.uint64), common.column("n").to_numpy()


def train(
    df: DataFrame,
    text: str = "text",
    nodes: int = 200_000,
    frequent: int = 1 << 17,
    contexts: int = 1 << 12,
    samples: int = 3,
    sweeps: int = 3,
    tasks: int = 24,
) -> tuple[Model, DataFrame]:
    """The model, and the words that are not among its frequent ones: (key, n, p0, p1, ...), stored.

    n counts a word, p0 and so on are what the restaurant of all words serves of it
    itself, by sample. The model holds about 7 * nodes grams and pairs and
    `frequent` words at most; the table of the others has no bound.
    """
    slim = df.select(F.col(text).alias("text"))
    tree, counts, n_texts, n_tokens, kinds = counted(slim, nodes, samples, sweeps, tasks)
    keys, n_words = frequent_words(counts, frequent)
    words, m = trees.Index(keys), len(keys)
    discard(counts)
    contexts = min(contexts, m)

    spark = df.sparkSession.sparkContext
    names = [f"s{s}" for s in range(samples)]
    met = slim.mapInArrow(
        _met(spark.broadcast(words), spark.broadcast(tree), m, contexts, samples),
        "kind byte, key long, n long, " + ", ".join(f"{s} float" for s in names),
    )
    met = materialise(met.groupBy("kind", "key").agg(F.sum("n").alias("n"), *[F.max(s).alias(s) for s in names]), "lm-met")
    spelled = met.where("kind = 1").select("key", *names).toArrow()
    pairs = met.where("kind = 0").select(F.col("key").alias("pair"), "n")
    pairs = pairs.where(F.floor(F.log2("n") * 4) >= _most(pairs, "n", nodes))
    kept = pairs.toArrow()
    pair, n_pairs = kept.column("pair").to_numpy(), kept.column("n").to_numpy()

    shares = np.full((m + 1, samples), 1e-9)
    logs = np.stack([spelled.column(s).to_numpy() for s in names], axis=1).astype(np.float64)
    shares[spelled.column("key").to_numpy()] = np.exp(logs)
    end = texts.Block(np.array([32, END], np.uint8), np.array([0, 2]), np.array([0]), np.array([1]))
    shares[m] = np.exp(_letters(trees.Recent(tree), end)[:, 0])
    counts_of = np.append(n_words, n_texts).astype(np.float64)
    visits = np.append(n_words[:contexts], n_texts).astype(np.float64)
    passed = visits - np.bincount(pair // (contexts + 1), n_pairs, contexts + 1)
    word_of = lambda pair: np.where(pair % (contexts + 1) == contexts, m, pair % (contexts + 1))
    direct = counts_of - np.bincount(word_of(pair), n_pairs, m + 1)
    others = n_tokens - counts_of.sum()
    rare, rare_tables = _seated_words(met.where("kind = 2").select("key", "n", *names), float(m + 1), samples)

    def all_words(pair: np.ndarray, tables: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """What the restaurant of all words serves itself, and what it leaves to spelling."""
        customers = direct + np.bincount(word_of(pair), tables, m + 1)
        only = np.zeros(m + 1, np.int64)
        level = Level(ALL_WORDS, np.arange(m + 1), only[:1], only, direct, customers, np.minimum(customers, 1))
        level.elsewhere = (float(others), float(rare_tables[sample]))
        gibbs([level], shares[:, sample], sweeps, np.random.default_rng([8, sample]))
        escape = predict([level], shares[:, sample])[1][0]
        room = STRENGTH[ALL_WORDS] + customers.sum() + others
        return (customers - DISCOUNT[ALL_WORDS] * level.tables) / room, escape, room

    own, escape, _ = all_words(pair, np.ones(len(pair)), 0)
    first = own + escape * shares[:, 0]
    seated = _after_words(pairs, passed, np.append(first[:contexts], first[m]), contexts, samples, sweeps, tasks).toArrow()
    discard(met)
    pair, n_pairs = seated.column("pair").to_numpy(), seated.column("customers").to_numpy()
    tables = _column(seated, "tables", samples) if len(pair) else np.zeros((0, samples))
    owns, escapes, rooms = zip(*(all_words(pair, tables[:, s], s) for s in range(samples)), strict=True)
    escapes_of = np.concatenate(escapes)
    of = pair // (contexts + 1)
    d, strength = DISCOUNT[AFTER_WORD], STRENGTH[AFTER_WORD]
    room = strength + np.bincount(of, n_pairs, contexts + 1) + passed
    left = np.stack([strength + d * np.bincount(of, tables[:, s], contexts + 1) + passed for s in range(samples)], axis=1)
    model = Model(
        tree,
        words,
        n_words,
        np.stack(owns, axis=1),
        escapes_of,
        contexts,
        trees.Index(pair.astype(np.uint64)),
        (n_pairs[:, None] - d * tables) / room[of][:, None],
        left / room[:, None],
        n_texts,
        n_tokens,
        kinds,
    )
    served = [
        ((F.col("n") - DISCOUNT[ALL_WORDS] * F.col(f"t{s}")) / F.lit(float(rooms[s]))).alias(f"p{s}") for s in range(samples)
    ]
    return model, rare.select("key", "n", *served)


class Scorer:
    """A model as the tasks look it up: a row for each sample, and the spelling met last."""

    def __init__(self, lm: Model):
        self.lm, self.recent = lm, trees.Recent(lm.tree)
        samples = lm.own.shape[1]
        # behind the last column: a word that is not frequent has no dish, one without a restaurant leaves all
        self.own = np.concatenate([lm.own, np.zeros((1, samples))]).T.copy()
        self.left = np.concatenate([lm.pair_escape, np.ones((1, samples))]).T.copy()
        self.pair_own = lm.pair_own.T.copy()

    def log_tokens(self, spelled: texts.Block, tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The log of the averaged predictive probability of each token.

        For each token that is not frequent and by sample: what its context leaves
        to all words, and the log of what is left to spell it. Such a token is
        taken for one that was never seen.
        """
        lm = self.lm
        letters = _letters(self.recent, spelled)
        at = context_of(before, lm.contexts)
        left = self.left[:, at]
        p = self.own[:, tokens]
        p += lm.escape[:, None] * np.exp(letters)
        p *= left
        pair = pair_of(tokens, before, len(lm.word_counts), lm.contexts)
        both = np.flatnonzero(pair >= 0)
        rows = lm.pairs.find(pair[both].astype(np.uint64))
        both, rows = both[rows >= 0], rows[rows >= 0]
        p[:, both] += self.pair_own[:, rows]
        unseen = np.flatnonzero(tokens == -1)
        left = left[:, unseen]
        spelt = np.log(left * lm.escape[:, None]) + letters[:, unseen]
        # a long word's spelling is too small for a probability, but not for its log
        most = spelt.max(axis=0)
        p = p.mean(axis=0)
        p[unseen] = 1
        logs = np.log(p)
        logs[unseen] = most + np.log(np.exp(spelt - most).mean(axis=0))
        return logs, left, spelt


_SCORED = {"row": "long", "words": "long", "known": "long", "base": "double", "score": "double"}


def score(df: DataFrame, model: Model, rare: DataFrame, text: str = "text") -> DataFrame:
    """The frame with n_tokens, n_known, train_tokens, base_score and score.

    Frequent words are looked up in the tasks. The rest of a text's words are
    joined with the stored words by their hash: each is rare, so that no key is
    hot. They are scored as unseen first; those that were seen add what the
    restaurant of all words serves of them. Null texts are empty; every text has at least its end as a token.
    Columns of the result's names are replaced.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in df.columns if c not in added]
    rows = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], F.col(text).alias("_text"))
    samples = model.own.shape[1]
    names = [f"{x}{s}" for x in ("left", "spelt") for s in range(samples)]
    one = "key: long, " + ", ".join(f"{x}: float" for x in names)
    cells = ["key", *names]
    schema = texts.extended(rows.drop("_text").schema, **_SCORED, rare=f"array<struct<{one}>>")
    columns_of = schema.names
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        lm = sent.value
        scorer = Scorer(lm)
        for batch in batches:
            n = batch.num_rows
            tokens, known, base, logs = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            rare_keys, rare_rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            parts = [np.zeros((2 * samples, 0), np.float32)]
            carried: dict[int, int] = {}
            for block, spelled, last in _spelled(batch.column(len(kept))):
                found = texts.words(block)
                of = block.rows[found.piece]
                keys = texts.hashes(texts.LOWER[block.data], found.starts, found.ends)
                at = lm.words.find(keys)
                hit = at >= 0
                tokens += np.bincount(of, minlength=n)
                known += np.bincount(of[hit], minlength=n)
                base += np.bincount(of[hit], np.log10(lm.word_counts[at[hit]] + 1.0), n)
                rare_keys.append(keys[~hit])
                rare_rows.append(of[~hit])
                ids, before, piece = _tokens(block, last, found, at.astype(np.int64), carried, len(lm.word_counts))
                log, left, spelt = scorer.log_tokens(spelled, ids, before)
                logs += np.bincount(block.rows[piece], log, n)
                parts.append(np.concatenate([left, spelt]).astype(np.float32))
            of = np.concatenate(rare_rows)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
            order = np.argsort(of, kind="stable")
            values = [np.concatenate(rare_keys)[order].astype(np.int64), *np.concatenate(parts, axis=1)[:, order]]
            flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v)) for v in values], cells)
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(x) for x in (first + np.arange(n), tokens, known, base, logs / np.log(10))]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
            first += n
            yield pa.RecordBatch.from_arrays(columns, names=columns_of)

    scored = materialise(rows.mapInArrow(run, schema), "lm-scored")
    words = scored.select("row", F.inline("rare")).join(rare, "key")
    # relative to the largest of the samples, as long words are hardly ever spelled
    most = F.greatest(*[F.col(f"spelt{s}").cast("double") for s in range(samples)], F.lit(-1e300))
    unseen = sum((F.exp(F.col(f"spelt{s}") - most) for s in range(samples)), F.lit(0.0))
    seen = sum((F.col(f"left{s}") * F.col(f"p{s}") for s in range(samples)), F.lit(0.0))
    gain = F.greatest(F.ln(seen) - most - F.ln(unseen), F.lit(-700.0))
    more = F.when(gain < 30, F.log1p(F.exp(gain))).otherwise(gain) / float(np.log(10))
    sums = words.groupBy("row").agg(
        F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_base"), F.sum(more).alias("more_score")
    )
    out = scored.drop("rare").join(sums, "row", "left")
    tokens = F.col("words") + 1
    zero = F.lit(0)
    base = F.col("base") + F.coalesce("more_base", zero.cast("double")) + float(np.log10(model.texts + 1))
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)],
        tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("more", zero) + int(model.texts > 0)).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (base - tokens * float(np.log10(model.tokens + model.types + 1))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", zero.cast("double"))).alias("score"),
    )
