"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions.  For each of the 255 decision points there is a
tree over the preceding bytes, `DEPTH` deep.  A node of the tree holds how often 0
and 1 came after its context and estimates by Krichevsky and Trofimov; weighting
mixes, at every node, its own estimate with the product of its children's
(one half each), which sums over all tree shapes.  The weights after learning give
the mixture by which a text is coded; its code length is the score.

Texts are dealt into blocks of about `BLOCK` bytes.  A block names each of its byte strings
of DEPTH + 1 once, with how often learning texts hold it, as sorted numbers packed by
their differences; every context that was seen is in the tree.  Contexts in the order of
their nearest byte, then the next, are dealt into parts of about `CODES` such names (more
from `MANY` blocks on), so that a subtree lies in one part but for the contexts at the
parts' bounds, at most two a depth and part.  Those send their counts and the sums of
their whole children to the driver, which weighs them and gives the weights back; then
each part knows the probability of each of its strings and answers the blocks that named
them, with logs rounded to `LOG_BITS` binary places.  What moves grows with the strings
of a block, not with its bytes.  A context that was never seen predicts as the longest
one that was.

A block looks its strings up in a hash table; strings with a share of at least
`CODE_SHARE` of the learning texts, at most 1 / CODE_SHARE of them, are in a small one
of their own that is looked at first.

Text is coded as its words in A-Z lower case, one space between, one end sign.

`base_score` is the unigram score with add-0.1 smoothing.  Words with a share of at
least `WORD_SHARE` are looked up in a broadcast array, at most 1 / WORD_SHARE of
them; all others are joined by a shuffle.

Defined results: null texts are empty and coded as the end sign alone; without
learning texts N and V are 0 and every decision costs one bit; rows with null or
repeated ids are scored by their own text; extra columns are ignored; texts of
any length are coded whole; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headroom.llm.scratch import drop_stored, stored
from headroom.llm.texts import LOWER, SPACE, U, documents, flat, mix, share_of, slices, words

DEPTH = 6  # with its byte a context has to fit 64 bits
BLOCK = 32 << 20  # bytes of the texts that name their strings together, about
LOG_BITS = 36  # of the logs' 52 binary places that are sent: a share of 1e-11
COUNTED = 1 << 22  # bytes whose strings are sorted at once
CODES = 1 << 19  # byte strings of a part of the tree, about, as named by each block
MANY = 512  # blocks from which on parts grow with them, so that a block's piece of a part stays at some 1,000 strings
MOST = 16  # times that they grow at most, as a task holds a part
CODE_SHARE = 2.0**-20  # for a byte string to be looked up first
WORD_SHARE = 2.0**-21  # for a word to be looked up without a shuffle
END = 10  # code of the end sign
SMOOTH = 0.1
CODE_MASKS = [U((1 << 8 * (d + 1)) - 1) for d in range(DEPTH + 1)]
FOLD = np.where(SPACE, 32, LOWER).astype(np.uint8)


def coded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per coded byte: the byte with its DEPTH predecessors as one number, and the n + 1 offsets of the texts."""
    n = len(data)
    gap = SPACE[data]
    # A gap stays, as one space, where a word follows in the same text and one came before.
    inner = np.zeros(n, bool)
    inner[:-1] = gap[:-1] & ~gap[1:]
    inner[offsets[1:][offsets[1:] > 0] - 1] = False
    at = np.flatnonzero(inner)
    first = np.searchsorted(at, offsets)  # of each text
    led = first[:-1][(first[:-1] < first[1:]) & gap[np.minimum(offsets[:-1], max(n - 1, 0))]] if n else first[:0]
    inner[at[led]] = False  # the text begins with it
    keep = ~gap | inner
    counts = np.concatenate(([0], np.cumsum(keep)))[offsets]
    sizes = np.diff(counts)
    lead = DEPTH + 1  # zeros in front of each text and its end sign behind
    places = counts + lead * np.arange(len(counts))
    # Each text's coded bytes: from its lead's end to its end sign.
    inside = np.ones(places[-1], bool)
    inside[(places[:-1, None] + np.arange(lead - 1)).ravel()] = False
    body = inside.copy()
    body[places[1:] - 1] = False
    line = np.zeros(places[-1] + 7, np.uint8)
    line[7:][body] = FOLD[data[keep]]
    line[7:][places[1:] - 1] = END
    code = np.ndarray(places[-1], ">u8", line, 0, (1,)).astype(np.uint64)  # the eight bytes up to each
    return code[inside] & CODE_MASKS[DEPTH], np.concatenate(([0], np.cumsum(sizes + 1)))


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of their counts, and the place of each key; quick if the keys are a few sorted runs."""
    order = np.argsort(keys, kind="stable")
    line = keys[order]
    begin = np.ones(len(line), bool)
    begin[1:] = line[1:] != line[:-1]
    place = np.empty(len(line), np.int64)
    place[order] = np.cumsum(begin) - 1
    starts = np.flatnonzero(begin)
    return line[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts, place


def _merged(parts: list) -> list:
    return [_sums(*(np.concatenate(x) for x in zip(*parts)))[:2]]


def _counted(keys_of, limit: int = 4_000_000):
    """mapInArrow function: counts of keys, added up within the task before they are sent."""

    def count(batches):
        parts, held = [], 0
        for batch in batches:
            data, offsets = flat(batch.column(0))
            for a, b in slices(offsets):
                cut = offsets[a : b + 1]
                keys, counts = np.unique(keys_of(data[cut[0] : cut[-1]], cut - cut[0]), return_counts=True)
                parts.append((keys, counts))
                held += len(keys)
                if held > limit:
                    parts = _merged(parts)
                    held = len(parts[0][0])
                    if held > limit // 2:
                        yield _batch(parts.pop())
                        held = 0
        if parts:
            yield _batch(_merged(parts)[0])

    return count


def _batch(part) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), pa.array(part[1])], names=["key", "n"])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after shifting x above 8."""
    x = x.astype(float)
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) - shift


_SMALL = np.arange(1 << 12)
_HALVES, _WHOLES = log_gamma(_SMALL + 0.5), log_gamma(_SMALL + 1)


def _gamma(n: np.ndarray, small: np.ndarray, more: float) -> np.ndarray:
    """log_gamma(n + more), small numbers from a table."""
    n = n.astype(np.int64)
    out = small[np.minimum(n, len(small) - 1)]
    large = n >= len(small)
    out[large] = log_gamma(n[large] + more)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return _gamma(zeros, _HALVES, 0.5) + _gamma(ones, _HALVES, 0.5) - np.log(np.pi) - _gamma(zeros + ones, _WHOLES, 1)


def _nodes(codes: np.ndarray, bit: int) -> np.ndarray:
    """Decision point `bit` of each code: its context and the bits of its byte so far, led by a 1."""
    symbol = codes & U(255)
    return (codes >> U(8) << U(8)) | (U(1 << bit) | (symbol >> U(8 - bit)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def _decisions(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted decision points of the codes, and how often 0 and 1 came at each."""
    parts = []
    for bit in range(8):  # decision points of different bits differ
        node, back = np.unique(_nodes(codes, bit), return_inverse=True)
        one = np.bincount(back, n * ((codes >> U(7 - bit)) & U(1)).astype(bool), len(node))
        parts.append((node, np.bincount(back, n, len(node)) - one, one))
    keys, zeros, ones = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    return keys[order], zeros[order], ones[order]


def _mixed(zeros: np.ndarray, ones: np.ndarray, children: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log probability at each decision point, and the weight of its own estimate."""
    own = log_kt(zeros, ones)
    if depth == DEPTH:
        return own, np.ones(len(own))
    mixed = np.logaddexp(np.log(0.5) + own, np.log(0.5) + children)
    return mixed, np.exp(np.log(0.5) + own - mixed)


def _parents(nodes: np.ndarray, depth: int) -> np.ndarray:
    """Decision points at `depth` above those one deeper."""
    return (nodes >> U(8) & (CODE_MASKS[depth] >> U(8))) << U(8) | (nodes & U(255))


def _above(lines: np.ndarray) -> np.ndarray:
    """Turned strings or decision points without the furthest byte of their context."""
    return lines >> U(16) << U(8) | lines & U(255)


def _line(codes: np.ndarray) -> np.ndarray:
    """Codes with the nearest byte of the context in front and their own byte behind, so that contexts alike in their nearest bytes are neighbours; twice is as before."""
    return (codes >> U(8) << U(16)).byteswap() << U(8) | codes & U(255)


class Tree:
    """Weighted context trees from byte-string counts: `counts[d]` = (codes of d + 1 bytes, counts)."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        self.keys, self.ones, self.own = [], [], []
        self._weigh(counts)
        # Per depth: the strings of kept contexts with the logs, where that depth is the last one kept, and the contexts.
        self.codes = [np.sort(c) for c, _ in counts]
        self.logs = [self.log10_probability(c, d + 1).astype(np.float32) for d, c in enumerate(self.codes)]
        self.contexts = [np.unique(c >> U(8)) for c in self.codes]

    def _weigh(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        below = None
        for codes, n in reversed(counts):  # the deepest first: only two depths are held with their counts
            keys, zeros, ones = _decisions(codes, n)
            own = log_kt(zeros, ones)
            if below is None:
                mixed, weight = own, np.ones(len(own))
            else:
                at, known = _find(keys, _parents(below[0], len(counts) - len(self.keys) - 1))
                sums = [np.bincount(at[known], x[known], len(own)) if len(own) else own for x in below[1:]]
                children = sums[2] + log_kt(zeros - sums[0], ones - sums[1])
                mixed = np.logaddexp(np.log(0.5) + own, np.log(0.5) + children)
                weight = np.exp(np.log(0.5) + own - mixed)
            self.keys.insert(0, keys)
            self.own.insert(0, weight.astype(np.float32))
            self.ones.insert(0, ((ones + 0.5) / (zeros + ones + 1)).astype(np.float32))  # estimate of a 1 at each node
            below = keys, zeros, ones, mixed

    def log10_probability(self, codes: np.ndarray, depths: int | None = None) -> np.ndarray:
        """Of each code's last byte after those before it, by the contexts of the first `depths` depths."""
        out = np.zeros(len(codes))
        for bit in range(8):
            deepest = np.full(len(codes), 0.5)
            path = []
            for d in range(len(self.keys) if depths is None else depths):
                at, known = _find(self.keys[d], _nodes(codes & CODE_MASKS[d], bit))
                if not known.any():
                    break
                deepest[known] = self.ones[d][at[known]]
                path.append((known, at))
            p = deepest
            for d in range(len(path) - 2, -1, -1):
                known, at = path[d]
                more = path[d + 1][0]
                use = known & more
                weight = self.own[d][at[use]]
                p[use] = weight * self.ones[d][at[use]] + (1 - weight) * p[use]
            one = ((codes >> U(7 - bit)) & U(1)).astype(bool)
            out += np.log10(np.where(one, p, 1 - p))
        return out

    def score(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each text."""
        logs, open_ = np.zeros(len(codes)), np.arange(len(codes))
        for d in range(len(self.codes) - 1, -1, -1):
            string = codes[open_] & CODE_MASKS[d]
            at, known = _find(self.codes[d], string)
            logs[open_[known]] = self.logs[d][at[known]]
            open_, string = open_[~known], string[~known]
            _, kept = _find(self.contexts[d], string >> U(8))
            self._unseen(codes, open_[kept], logs)  # a byte that never came in a kept context
            open_ = open_[~kept]
        self._unseen(codes, open_, logs)
        return np.add.reduceat(logs, offsets[:-1])

    def _unseen(self, codes: np.ndarray, at: np.ndarray, logs: np.ndarray) -> None:
        if len(at):
            missing, back = np.unique(codes[at], return_inverse=True)
            logs[at] = self.log10_probability(missing)[back]


CODEC = pa.Codec("zstd", compression_level=1)


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 64 bits, the bytes of like weight together."""
    return CODEC.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T), asbytes=True)


def _unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    planes = np.frombuffer(CODEC.decompress(data, 8 * size), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _rounded(logs: np.ndarray) -> np.ndarray:
    """To LOG_BITS binary places, so that the rest packs to nothing."""
    rest = 52 - LOG_BITS
    return ((logs.view(np.uint64) + U(1 << rest - 1)) >> U(rest) << U(rest)).view(np.float64)


def _rows(names: str, rows: list[tuple]) -> pa.Table:
    """Rows of long columns and, from `lines` on, binary ones."""
    kinds = [pa.binary() if n in ("lines", "n", "logs") else pa.list_(pa.int64()) if n == "marks" else pa.int64() for n in names.split()]
    return pa.table([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names.split())


def _blocks(size: int):
    """mapInArrow function: (doc, held_out, text) with the number of their block of about `size` bytes in front."""

    def deal(batches):
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            ends = done + np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
            starts = np.concatenate(([done], ends))
            done = int(starts[-1])
            yield pa.RecordBatch.from_arrays([pa.array((task << 32) + starts[:-1] // size), *batch.columns], names=["block", "doc", "held_out", "text"])

    return deal


ASKED = "block long, size long, learned long, marks array<long>, lines binary, n binary"


def _asked(step: int, limit: int = 4_000_000):
    """mapInArrow function: the distinct strings of each block, in order, with their counts in learning texts; the context of every `step`-th."""

    def told(block: int, part: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        keys, counts = part  # a string that learning texts hold comes behind the same one of other texts
        begin = np.flatnonzero(np.concatenate(([True], keys[1:] >> U(1) != keys[:-1] >> U(1))))
        n = np.add.reduceat(counts * (keys & U(1)).astype(np.int64), begin)
        lines = _line(keys[begin] >> U(1))
        order = np.argsort(lines)
        lines, n = lines[order], n[order]
        marks = (lines[int(mix(np.array([block], U))[0] % U(step)) :: step] >> U(8)).astype(np.int64)
        return _rows("block size learned marks lines n", [(block, len(lines), int(n.sum()), marks, _packed(np.diff(lines, prepend=U(0))), _packed(n))]).to_batches()[0]

    def ask(batches):
        parts, held, now = [], 0, None
        for batch in batches:
            block, learn = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            data, offsets = flat(batch.column(2))
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for low, high in zip(edges[:-1], edges[1:]):
                if low < high and block[low] != now:
                    if parts:
                        yield told(now, _merged(parts)[0])
                    parts, held, now = [], 0, int(block[low])
                for a, b in slices(offsets[low : high + 1], COUNTED):
                    cut = offsets[low + a : low + b + 1]
                    code, place = coded(data[cut[0] : cut[-1]], cut - cut[0])
                    code = code << U(1) | np.repeat(learn[low + a : low + b], np.diff(place)).astype(np.uint64)
                    parts.append(np.unique(code, return_counts=True))
                    held += len(parts[-1][0])
                    if held > limit:
                        parts = _merged(parts)
                        held = len(parts[0][0])
                        if held > limit // 2:  # the block goes on in a further row
                            yield told(now, parts.pop())
                            held = 0
        if parts:
            yield told(now, _merged(parts)[0])

    return ask


DEALT = "part long, block long, size long, lines binary, n binary"


def _with_part(bounds: np.ndarray):
    def deal(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                block, size, lines, n = (batch.column(k)[row].as_py() for k in (0, 1, 4, 5))
                lines, n = np.cumsum(_unpacked(lines, size, np.uint64)), _unpacked(n, size, np.int64)
                cuts = [0, *np.searchsorted(lines, bounds << U(8)).tolist(), size]
                yield from _rows("part block size lines n", [
                    (part, block, b - a, _packed(np.diff(lines[a:b], prepend=U(0))), _packed(n[a:b])) for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]).to_batches()

    return deal


class _Part:
    """The strings of a part, and per depth what of them is told apart there, with counts."""

    def __init__(self, table: pa.Table, bounds: np.ndarray):
        self.blocks, self.sizes = table["block"].to_pylist(), table["size"].to_numpy()
        named = [np.cumsum(_unpacked(x.as_py(), size, np.uint64)) for x, size in zip(table["lines"], self.sizes)]
        counts = [_unpacked(x.as_py(), size, np.int64) for x, size in zip(table["n"], self.sizes)]
        lines, n, self.place = _sums(np.concatenate(named), np.concatenate(counts))
        self.strings, self.n, self.up = [lines], [n], []
        for _ in range(DEPTH):
            lines, back = np.unique(_above(self.strings[0]), return_inverse=True)
            self.n.insert(0, np.bincount(back, self.n[0], len(lines)).astype(np.int64))
            self.strings.insert(0, lines)
            self.up.insert(0, back)
        part = table["part"][0].as_py()
        self.ends = bounds[max(part - 1, 0) : part + 1]

    def levels(self, bit: int) -> list[tuple]:
        """Per depth the decision points before `bit`: (decision points, that of each string, place one depth up, zeros, ones, sums of their whole children, weights, whole or not)."""
        found = []
        for d, (lines, n) in enumerate(zip(self.strings, self.n)):
            begin = np.ones(len(lines), bool)
            begin[1:] = np.diff(lines >> U(8 - bit)) > 0
            starts, of = np.flatnonzero(begin), np.cumsum(begin) - 1
            one = np.add.reduceat(n * (lines >> U(7 - bit) & U(1)).astype(np.int64), starts)
            first = lines[starts]
            nodes = first >> U(8) << U(8) | U(1 << bit) | (first & U(255)) >> U(8 - bit)
            up = found[-1][1][self.up[d - 1][starts]] if d else np.zeros(len(starts), np.int64)
            whole = ~np.isin(nodes >> U(8), self.ends >> U(8 * (DEPTH - d)))  # its context doesn't reach over a bound of the part
            found.append((nodes, of, up, np.add.reduceat(n, starts) - one, one, whole))
        out, below = [], None
        for d in range(DEPTH, -1, -1):
            nodes, of, up, zeros, ones, whole = found[d]
            children = np.bincount(*below, len(nodes)) if below else np.zeros(len(nodes))
            mixed, weight = _mixed(zeros, ones, children, d)
            out.insert(0, (nodes, of, up, zeros, ones, children, weight, whole))
            below = up, mixed * whole
        return out


SHARED = "depth long, node long, zeros double, ones double, children double"


def _shared(bounds: np.ndarray):
    """applyInArrow function: what a part adds to the decision points that it shares with others."""

    def share(table: pa.Table) -> pa.Table:
        part, found = _Part(table, bounds), []
        for bit in range(8):
            for d, (nodes, _, _, zeros, ones, children, _, whole) in enumerate(part.levels(bit)):
                at = np.flatnonzero(~whole & (zeros + ones > 0))
                found.append((np.full(len(at), d), nodes[at].view(np.int64), *(x[at].astype(float) for x in (zeros, ones, children))))
        columns = (np.concatenate(x) for x in zip(*found))
        return pa.table(dict(zip(("depth", "node", "zeros", "ones", "children"), columns)))

    return share


def _joined(shared: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per depth the decision points that parts share: sorted, with estimates of a 1 and own weights."""
    depth, zeros, ones, children = (shared[c].to_numpy() for c in ("depth", "zeros", "ones", "children"))
    nodes, out, below = shared["node"].to_numpy().view(np.uint64), [], None
    for d in range(DEPTH, -1, -1):
        at = np.flatnonzero(depth == d)
        at = at[np.argsort(nodes[at])]
        keys, sums = nodes[at], children[at]
        if below is not None and len(keys):
            sums = sums + np.bincount(np.searchsorted(keys, _above(below[0])), below[1], len(keys))
        mixed, weight = _mixed(zeros[at], ones[at], sums, d)
        out.insert(0, (keys, (ones[at] + 0.5) / (zeros[at] + ones[at] + 1), weight))
        below = keys, mixed
    return out


def _probabilities(part: _Part, shared: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of the last byte of each string of a part."""
    out = np.zeros(len(part.strings[-1]))
    for bit in range(8):
        # From the root down: what shallower contexts give, the weight left, and the probability if no deeper context is known.
        given, left, value = np.zeros(1), np.ones(1), np.full(1, 0.5)
        for (nodes, of, up, zeros, ones, _, weight, whole), held in zip(part.levels(bit), shared):
            estimate, known = (ones + 0.5) / (zeros + ones + 1), zeros + ones > 0
            if len(held[0]):
                over = np.flatnonzero(~whole)
                at, known[over] = _find(held[0], nodes[over])
                estimate[over], weight[over] = held[1][at], held[2][at]
            given, left = given[up], left[up]
            value = np.where(known, given + left * estimate, value[up])
            given, left = given + left * weight * estimate, left * (1 - weight)
        one = (part.strings[-1] >> U(7 - bit) & U(1)).astype(bool)
        out += np.log10(np.where(one, value[of], 1 - value[of]))
    return out


ANSWERS = "block long, common long, size long, lines binary, logs binary"


def _answers(bounds: np.ndarray, held, least: float):
    """applyInArrow function: to each block the log10 probabilities of the strings it named, the common ones apart."""

    def answer(table: pa.Table) -> pa.Table:
        part, rows = _Part(table, bounds), []
        logs, common = _rounded(_probabilities(part, held.value)), part.n[-1] >= least
        for block, places in zip(part.blocks, np.split(part.place, np.cumsum(part.sizes)[:-1])):
            for kind in (0, 1):
                at = places[common[places] == kind]
                if len(at):
                    rows.append((block, kind, len(at), _packed(np.diff(part.strings[-1][at], prepend=U(0))), _packed(logs[at])))
        return _rows("block common size lines logs", rows)

    return answer


def _part_size(codes: int, blocks: int) -> int:
    """Strings of a part: pieces are as many as blocks times parts, which otherwise grew with the square of the input."""
    return codes * min(max(1, blocks // MANY), MOST)


def code_logs(texts: DataFrame, codes: int = CODES) -> tuple[DataFrame, DataFrame]:
    """texts (block, learn, text) -> each block's strings with their log10 probabilities after learning, and the stored table they are made from."""
    asked = stored(texts.mapInArrow(_asked(max(1, codes >> 8)), ASKED), "asked")
    total, learned, blocks = asked.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0)), F.count(F.lit(1))).first()
    many = -(-total // _part_size(codes, blocks))
    bounds = []
    if many > 1:  # a context of full length has at most 256 strings a block, so parts are of like size
        bounds = asked.select(F.explode("marks").alias("mark")).select(F.percentile_approx("mark", [k / many for k in range(1, many)], max(10_000, 20 * many))).first()[0]
    bounds = np.unique(np.array(bounds, np.int64)).view(np.uint64)
    dealt = asked.mapInArrow(_with_part(bounds), DEALT)
    shared = dealt.groupBy("part").applyInArrow(_shared(bounds), SHARED)
    shared = stored(shared.groupBy("depth", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "children")]), "shared")
    held = texts.sparkSession.sparkContext.broadcast(_joined(shared.toArrow()))
    drop_stored(shared)
    return dealt.groupBy("part").applyInArrow(_answers(bounds, held, learned * CODE_SHARE), ANSWERS), asked


class _Table:
    """Values by distinct keys: hash tables, each for the keys that found their place taken in the one before."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        while len(keys):
            shift, factor = U(64 - max(1, int(len(keys)).bit_length())), U(pow(0x9E3779B97F4A7C15, 2 * len(self.levels) + 1, 1 << 64))
            slot = (keys * factor >> shift).view(np.int64)
            last = np.zeros(1 << 64 - int(shift), np.int64)  # a free slot repeats the first key, so that what it says is right
            last[slot] = np.arange(len(keys))
            self.levels.append((factor, shift, keys[last], values[last]))
            over = last[slot] != np.arange(len(keys))
            keys, values = keys[over], values[over]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value or 0 of each key, known or not)."""
        out, known, open_ = np.zeros(len(keys)), np.zeros(len(keys), bool), None
        for factor, shift, held, values in self.levels:
            wanted = keys if open_ is None else keys[open_]
            slot = (wanted * factor >> shift).view(np.int64)
            hit = held[slot] == wanted
            if open_ is None:
                out, known, open_ = np.where(hit, values[slot], 0.0), hit, np.flatnonzero(~hit)
            else:
                at = open_[hit]
                out[at], known[at], open_ = values[slot[hit]], True, open_[~hit]
            if not len(open_):
                break
        return out, known


SCORED = "doc long, held_out boolean, tokens long, known long, logs double, score double, rare array<long>"


def _scored(held):
    """applyInArrow function of a block's texts and the answers to it."""

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        frequent = _Table(*held.value)
        lines, logs, out = ([], []), ([], []), []
        for row in answers.to_pylist():
            lines[row["common"]].append(_line(np.cumsum(_unpacked(row["lines"], row["size"], np.uint64))))
            logs[row["common"]].append(_unpacked(row["logs"], row["size"], np.float64))
        del answers
        others, common = (_Table(*_first(np.concatenate(x), np.concatenate(y))) if x else _Table(np.zeros(0, U), np.zeros(0)) for x, y in zip(lines, logs))
        del lines, logs
        data, offsets = flat(texts["text"])
        for a, b in slices(offsets):
            cut = offsets[a : b + 1]
            own, cut = data[cut[0] : cut[-1]], cut - cut[0]
            token, first = words(own, cut)
            value, known = frequent.find(token)
            before, kept, rest = (np.concatenate(([0], np.cumsum(x)))[first] for x in (value, known, ~known))
            rare = pa.ListArray.from_arrays(pa.array(rest.astype(np.int32)), pa.array(token[~known].view(np.int64)))
            code, place = coded(own, cut)
            value, known = common.find(code)
            open_ = np.flatnonzero(~known)
            value[open_] = others.find(code[open_])[0]
            columns = [pa.array(x) for x in (np.diff(first), np.diff(kept), np.diff(before), np.add.reduceat(value, place[:-1]))]
            out.append(pa.table([texts[c].slice(a, b - a) for c in ("doc", "held_out")] + columns + [rare], ["doc", "held_out", "tokens", "known", "logs", "score", "rare"]))
        return pa.concat_tables(out)

    return score


def _first(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once: a block that went on in a further row may have named a string twice."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.ones(len(keys), bool)
    begin[1:] = keys[1:] != keys[:-1]
    return keys[begin], values[order[begin]]


def scored(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", codes: int = CODES) -> DataFrame:
    """doc, held_out, n_tokens, n_known, train_tokens, base_score, score; learning from rows that are not held out."""
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("doc"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    own = stored(own.mapInArrow(_blocks(BLOCK), "block long, doc long, held_out boolean, text string"), "blocks", compression="zstd")
    learn = own.filter(~F.col("held_out")).select("text")
    count = stored(learn.mapInArrow(_counted(lambda data, offsets: words(data, offsets)[0]), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "words")
    texts = learn.count()
    seen, kinds = count.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    total, kinds = seen + texts, kinds + (texts > 0)  # with one end a text
    table = count.filter(F.col("n") >= total * WORD_SHARE).toArrow()
    held = spark.sparkContext.broadcast((table["key"].to_numpy().view(np.uint64), np.log10(table["n"].to_numpy() + SMOOTH)))
    answers, asked = code_logs(own.select("block", F.coalesce(~F.col("held_out"), F.lit(False)).alias("learn"), "text"), codes)
    both = own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_scored(held), SCORED)
    first = stored(both.withColumn("row", F.monotonically_increasing_id()), "scored")
    drop_stored(own)
    drop_stored(asked)
    rare = first.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("times"))
    joined = rare.join(count, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + SMOOTH)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("also"))
    end = float(np.log10(texts + SMOOTH))
    each = float(np.log10(total + SMOOTH * (kinds + 1)))
    return first.drop("rare").join(sums, "row", "left").select(
        "doc", "held_out", (F.col("tokens") + 1).alias("n_tokens"), (F.col("known") + F.coalesce("also", F.lit(0)) + int(texts > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", F.lit(0.0)) + end - (F.col("tokens") + 1) * each).alias("base_score"), "score")


def op6_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir), share_of("doc_id", 10) == 0).withColumnRenamed("doc", "doc_id")


QUERIES = {"op6_context_tree_weighting": op6_context_tree_weighting}
ORACLE: dict[str, str] = {}
