"""SentencePiece encoding with Gumbel top-k sampling of segmentations, and decoding.

A text's lattice has a node before every character and an edge for every piece
that matches there (byte pieces for characters without one).  Edge weights
follow the model's ranking of its pieces, ``(1 - score) ** -alpha``; the
probability of a segmentation is the product of its edges' weights over the
sum for all segmentations.

Sampling k distinct segmentations without replacement takes the k largest
Gumbel-perturbed log-probabilities, found by A* search from the top: the set of
all segmentations has a Gumbel maximum at its log mass, its arg max is a plain
forward sample, and the rest splits into one subset for each edge of that path
(same prefix, another edge there), whose maxima are Gumbels at the subsets' log
masses truncated at the parent's.  The best subset found so far gives the next
sample.  With the (k+1)-th best maximum as threshold, a sample's inclusion
probability is ``1 - exp(-exp(log_prob - threshold))``.

Random numbers come from a counter (row key, sample, place), so a row's samples
depend on its key, its text and the seed alone, not on partitions or batches.

The lattice falls apart wherever no piece holds the two characters at a
boundary (white space, most punctuation), so a worker keeps small lattices of
the units between, ``EDGES`` edges at most, and walks all units of a batch at
once.  One pass over whole texts, no shuffle.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import common

SAMPLES = 2
ALPHA = 1.0
SEED = 7
#: Lattice edges that a worker keeps; then it starts anew.
EDGES = 4_000_000
#: Units of up to so many characters are kept.
KEEP_CHARS = 64
#: Texts are walked together up to so many characters.
WALK_CHARS = 1 << 20
#: Subsets below this log mass cannot hold a maximum in double precision.
LEAST = -45.0
SPACE = "▁"


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, *counters) -> np.ndarray:
    """Numbers in (0, 1) from keys and counters."""
    x = key
    for c in counters:
        x = _mix(x ^ _mix(np.atleast_1d(c).astype(np.uint64)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _extend(h: np.ndarray, char: np.ndarray) -> np.ndarray:
    """Hash of a prefix made one character longer."""
    return _mix(h * np.uint64(0x100000001B3) + char.astype(np.uint64))


class _Numbers(dict):
    """Numbers of strings in the order of their first use; ``take`` gives the new ones."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n

    def take(self) -> list[str]:
        new, self.new = self.new, []
        return new


class Pieces:
    """Vocabulary, edge weights and lattices of a model file.

    What follows a lattice node depends on the rest of its unit only, so nodes
    are shared by all units with that ending: a node is a suffix, and its edges
    are the pieces that the suffix starts with.  New nodes of a batch are
    worked out together, piece lookups by the hash of growing prefixes and
    masses from short suffixes to long ones.
    """

    def __init__(self, path: str, alpha: float = ALPHA, edges: int = EDGES) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.byte = [0] * 256
        self.weight: dict[str, tuple[int, float]] = {}
        spelled: list[bytes] = []
        for i in range(size):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
                spelled.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                spelled.append(b"")
            else:
                self.weight[p] = (i, (1.0 - sp.get_score(i)) ** -alpha)
                spelled.append(p.replace(SPACE, " ").encode())
        self.byte_weight = (1.0 + size) ** -alpha
        self.log_weight = np.full(size, -np.inf)
        for i, w in self.weight.values():
            self.log_weight[i] = math.log(w)
        self.longest = max(map(len, self.weight))
        self.pairs = np.unique(np.array([ord(p[k]) << 32 | ord(p[k + 1]) for p in self.weight for k in range(len(p) - 1)], dtype=np.int64))
        prefixes = {p[:k]: -1 for p in self.weight for k in range(1, len(p))} | {p: i for p, (i, _) in self.weight.items()}
        hashes = np.zeros(len(prefixes), dtype=np.uint64)
        for n, x in enumerate(prefixes):
            h = np.zeros(1, dtype=np.uint64)
            for c in x:
                h = _extend(h, np.array([ord(c)]))
            hashes[n] = h[0]
        order = np.argsort(hashes)
        self.prefix_hash, self.prefix_piece = hashes[order], np.fromiter(prefixes.values(), dtype=np.int64)[order]
        self.sizes = np.array([len(b) for b in spelled])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.limit = edges
        self._clear()

    def _clear(self) -> None:
        self.suffixes: dict[int, int] = {}  # hash of a suffix to its node
        self.chunks = _Numbers()  # a chunk's units' first nodes lie in ``root``
        self.root, self.root_first = np.zeros(1 << 16, dtype=np.int32), np.zeros((1 << 16) + 1, dtype=np.int64)
        self.n_nodes = self.n_edges = 0
        self.char, self.next, self.length, self.first = (np.zeros(1 << 16, dtype=np.int32) for _ in range(4))
        self.log_mass = np.zeros(1 << 16)
        self.upto, self.q = np.zeros(1 << 18), np.zeros(1 << 18)
        self.to, self.piece = (np.zeros(1 << 18, dtype=np.int32) for _ in range(2))
        self._new: tuple = ((), (), ())  # char, next, length

    def _grow(self, names: tuple[str, ...], size: int) -> None:
        for name in names:
            a = getattr(self, name)
            if len(a) < size:
                wide = np.zeros(max(size, 2 * len(a)), dtype=a.dtype)
                wide[: len(a)] = a
                setattr(self, name, wide)

    def _nodes(self, char: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Node of every place's suffix, given where the place's unit ends; new nodes are noted for ``_build``."""
        place = np.arange(len(char))
        name = np.zeros(len(char) + 1, dtype=np.uint64)
        at = np.flatnonzero(place + 1 == end)
        while len(at):  # from the last character of all units leftwards
            name[at] = _extend(np.where(at + 1 == end[at], np.uint64(0), name[at + 1]), char[at])
            at = at[at > 0] - 1
            at = at[end[at] == end[at + 1]]
        name = name[:-1]
        once, first, again = np.unique(name, return_index=True, return_inverse=True)
        known = np.array([self.suffixes.get(x, -1) for x in once.tolist()], dtype=np.int64)
        new = np.flatnonzero(known < 0)
        known[new] = self.n_nodes + np.arange(len(new))
        node = known[again]
        where = first[new]
        inner = where + 1 < end[where]
        self._new = (char[where], np.where(inner, node[np.minimum(where + 1, len(char) - 1)], -1), end[where] - where)
        begin = np.flatnonzero(np.diff(end, prepend=-1))  # a unit's first place
        size = np.repeat(end[begin] - begin, end[begin] - begin)
        kept = new[size[where] <= KEEP_CHARS]
        self.suffixes.update(zip(once[kept].tolist(), known[kept].tolist()))
        return node

    def _build(self) -> None:
        """Edges, probabilities and masses of the noted nodes."""
        char, nxt, length = self._new
        if not len(char):
            return
        a, b = self.n_nodes, self.n_nodes + len(char)
        self._grow(("char", "next", "length", "first", "log_mass"), b)
        self.char[a:b], self.next[a:b], self.length[a:b] = char, nxt, length
        self._new = ((), (), ())
        self.n_nodes = b
        n = b - a
        piece = np.full((n, self.longest), -1, dtype=np.int32)
        target = np.full((n, self.longest), -1, dtype=np.int32)
        row, cur, h = np.arange(n), np.arange(a, b), np.zeros(n, dtype=np.uint64)
        for k in range(self.longest):
            h = _extend(h, self.char[cur])
            at = np.minimum(np.searchsorted(self.prefix_hash, h), len(self.prefix_hash) - 1)
            on = self.prefix_hash[at] == h
            row, cur, h, at = row[on], cur[on], h[on], at[on]
            cur = self.next[cur]
            piece[row, k], target[row, k] = self.prefix_piece[at], cur
            more = cur >= 0
            row, cur, h = row[more], cur[more], h[more]
        weight = np.where(piece >= 0, self.log_weight[piece], -np.inf)
        chains: list[tuple[int, bytes]] = []
        for r in np.flatnonzero(piece[:, 0] < 0).tolist():  # no piece of its own: spelled in bytes
            spelling = chr(char[r]).encode("utf-8", "surrogatepass")
            piece[r, 0], target[r, 0] = self.byte[spelling[0]], nxt[r]
            weight[r, 0] = len(spelling) * math.log(self.byte_weight)
            if len(spelling) > 1:
                chains.append((r, spelling))
        order = np.argsort(self.length[a:b], kind="stable")
        edge = np.flatnonzero(np.diff(self.length[a:b][order], prepend=-1))
        mass = self.log_mass
        for x, y in zip(edge, np.append(edge[1:], n)):
            rows = order[x:y]
            t = target[rows]
            w = weight[rows] + np.where(t >= 0, mass[t], 0.0)
            top = w.max(axis=1)
            total = top + np.log(np.exp(w - top[:, None]).sum(axis=1))
            mass[a + rows] = total
            weight[rows] = w - total[:, None]
        q = np.exp(weight)
        by = np.argsort(-q, axis=1, kind="stable")
        q, piece, target = (np.take_along_axis(m, by, axis=1) for m in (q, piece, target))
        upto = np.cumsum(q, axis=1)
        real = q > 0
        count = real.sum(axis=1)
        first = self.n_edges + np.cumsum(count) - count
        upto[np.arange(n), count - 1] = 2.0
        self.first[a:b] = first
        self._edges(upto[real], q[real], target[real], piece[real])
        for r, spelling in chains:
            e = int(first[r] + np.flatnonzero(by[r] == 0)[0])
            end, m = int(self.to[e]), len(spelling) - 1
            base = self.n_nodes
            self._grow(("char", "next", "length", "first", "log_mass"), base + m)
            self.n_nodes += m
            self.first[base : base + m] = self.n_edges + np.arange(m)
            self.to[e] = base
            self._edges(np.full(m, 2.0), np.ones(m), np.append(np.arange(base + 1, base + m), end), np.array([self.byte[x] for x in spelling[1:]]))

    def _edges(self, upto, q, to, piece) -> None:
        a, b = self.n_edges, self.n_edges + len(q)
        self._grow(("upto", "q", "to", "piece"), b)
        self.upto[a:b], self.q[a:b], self.to[a:b], self.piece[a:b] = upto, q, to, piece
        self.n_edges = b

    def _learn(self, new: list[str]) -> None:
        """Lattices of new chunks: cut into units between characters that no piece holds together."""
        if not new:
            return
        text = "".join([SPACE + w for w in new]).replace(" ", SPACE)
        char = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        stop = np.cumsum([len(w) + 1 for w in new])
        pair = char[:-1] << 32 | char[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        last = np.append(self.pairs[at] != pair, True)
        last[stop - 1] = True
        ends = np.flatnonzero(last) + 1
        begin = np.append(0, ends[:-1])
        node = self._nodes(char, np.repeat(ends, ends - begin))
        n = len(self.chunks) - len(new)
        have = int(self.root_first[n])
        self._grow(("root",), have + len(begin))
        self._grow(("root_first",), n + len(new) + 1)
        self.root[have : have + len(begin)] = node[begin]
        self.root_first[n + 1 : n + len(new) + 1] = have + np.searchsorted(begin, stop)
        self._build()

    def roots(self, texts: list[str]) -> list[np.ndarray]:
        """First nodes of each text's units."""
        if self.n_edges > self.limit or len(self.chunks) > self.limit // 4:
            self._clear()
        known, numbers = self.chunks, []
        for t in texts:
            # A space starts a chunk; runs of spaces stay together, some pieces hold several.
            words = t.replace(SPACE, " ").split(" ")
            numbers.append(np.array([known[w] for w in words] if all(words) else [known[c] for c in _chunks(words)], dtype=np.int64))
        self._learn(known.take())
        out = []
        for number in numbers:
            first = self.root_first[number]
            size = self.root_first[number + 1] - first
            out.append(self.root[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of piece ids, without the space that encoding puts first."""
        size = self.sizes[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        out = self.letters[at].tobytes()
        return out[1:] if out[:1] == b" " else out


def _chunks(words: list[str]) -> list[str]:
    """Words cut at single spaces to chunks with their leading run of spaces, but for one."""
    out, run = [], 0
    for w in words:
        if w:
            out.append(" " * run + w)
            run = 0
        else:
            run += 1
    if run:
        out.append(" " * (run - 1))
    return out


@lru_cache(maxsize=2)
def pieces(path: str, alpha: float = ALPHA) -> Pieces:
    return Pieces(path, alpha)


class _Paths:
    """Paths of several texts, edge after edge: edges, source nodes, units, and where each text begins."""

    def __init__(self, edge, node, unit, begin) -> None:
        self.edge, self.node, self.unit, self.begin = edge, node, unit, begin


class Walker:
    def __init__(self, p: Pieces) -> None:
        self.p = p
        self.first, self.upto, self.q, self.to, self.piece = p.first, p.upto, p.q, p.to, p.piece

    def forward(self, node: np.ndarray, key: np.ndarray, sample: int, place: np.ndarray):
        """Sample a path from each node: (edges, source nodes, number of edges of each start), in order."""
        n = len(node)
        steps = []
        count = np.zeros(n, dtype=np.int64)
        who, at = np.arange(n), node
        u = uniform(key, sample, place)
        step = 0
        while len(who):
            if step and step % 8 == 0:  # one number carries a few choices; then draw another
                u = uniform(key[who], sample, place[who], step)
            e = self.first[at].copy()
            look = np.flatnonzero(u >= self.upto[e])
            while len(look):
                e[look] += 1
                look = look[u[look] >= self.upto[e[look]]]
            steps.append((who, e, at))
            count[who] += 1
            top = np.minimum(self.upto[e], 1.0)
            u = np.clip((u - (top - self.q[e])) / self.q[e], 0.0, 1 - 2.0**-53)
            nxt = self.to[e]
            on = nxt >= 0
            who, at, u = who[on], nxt[on], u[on]
            step += 1
        begin = np.cumsum(count) - count
        edge, source = np.empty(count.sum(), np.int32), np.empty(count.sum(), np.int32)
        for k, (w, e, a) in enumerate(steps):
            edge[begin[w] + k] = e
            source[begin[w] + k] = a
        return edge, source, count


def _first_sample(w: Walker, roots: list[np.ndarray], key: np.ndarray) -> _Paths:
    size = np.array([len(r) for r in roots])
    doc = np.repeat(np.arange(len(roots)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    edge, node, count = w.forward(np.concatenate(roots), key[doc], 0, place)
    begin = np.searchsorted(np.repeat(doc, count), np.arange(len(roots) + 1))
    return _Paths(edge, node, np.repeat(place, count), begin)


def _subsets(w: Walker, path: tuple, key: np.ndarray, sample: int, score: float, branch: int, banned: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a path's set splits off, and the maxima of those subsets."""
    edge = path[0]
    logq = np.log(w.q[edge])
    before = np.cumsum(logq) - logq
    stop = int(np.searchsorted(-before, -LEAST, side="right"))
    place = np.arange(branch, max(stop, branch + 1))
    place = place[place < len(edge)]
    other = 1.0 - w.q[edge[place]]
    if banned and len(place):
        other[0] = 1.0 - w.q[np.array([*banned, edge[branch]])].sum()
    good = other > 1e-15
    place, other = place[good], other[good]
    phi = before[place] + np.log(other)
    e = -np.log(uniform(key, sample, 1 << 40, place))
    return place, -np.logaddexp(-score, np.log(e) - phi)


def sample_top_k(p: Pieces, texts: list[str], keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k distinct segmentations: (ids, log_prob, score, log_inclusion), best score first."""
    out: list[list] = [[] for _ in texts]
    filled = [d for d, t in enumerate(texts) if t]
    if not filled:
        return out
    roots = p.roots([texts[d] for d in filled])
    key = _mix(keys[filled])
    w = Walker(p)
    paths = _first_sample(w, roots, key)
    score = -np.log(-np.log(uniform(key, 0, 1 << 41)))
    # Per text: samples as (edges, nodes, units), their branch and banned edges; live subsets.
    trees = []
    for d in range(len(filled)):
        a, b = paths.begin[d], paths.begin[d + 1]
        path = (paths.edge[a:b], paths.node[a:b], paths.unit[a:b])
        place, best = _subsets(w, path, key[d : d + 1], 0, score[d], 0, ())
        trees.append({"samples": [(path, float(score[d]))], "meta": [(0, ())], "sets": [(place, best)]})
    for s in range(1, k + 1):
        chosen = []
        for d, tree in enumerate(trees):
            tops = [(float(b.max()), r, int(b.argmax())) for r, (_, b) in enumerate(tree["sets"]) if len(b)]
            tree["next"] = max(tops)[0] if tops else -math.inf
            if tops and tree["next"] > -math.inf and len(tree["samples"]) == s < k:
                chosen.append((d, *max(tops)))
        if s == k or not chosen:
            break
        starts, places, counts, heads = [], [], [], []
        for d, top, r, at in chosen:
            tree = trees[d]
            where, best = tree["sets"][r]
            j = int(where[at])
            best[at] = -math.inf
            (edge, node, unit), _ = tree["samples"][r]
            branch, banned = tree["meta"][r]
            out_of = ((*banned, int(edge[j])) if j == branch else (int(edge[j]),))
            new = _other_edge(w, int(node[j]), out_of, float(uniform(key[d : d + 1], s, 1 << 42)[0]))
            to, u = int(w.to[new]), int(unit[j])
            rest = roots[d][u + 1 :]
            starts.append(np.concatenate(([to], rest)) if to >= 0 else rest)
            places.append(np.arange(u if to >= 0 else u + 1, len(roots[d])))
            counts.append(len(starts[-1]))
            heads.append((d, top, j, out_of, np.append(edge[:j], new), np.append(node[:j], node[j]), np.append(unit[:j], u)))
        owner = np.repeat([h[0] for h in heads], counts)
        edge, node, count = w.forward(np.concatenate(starts).astype(np.int32), key[owner], s, np.concatenate(places))
        ends = np.cumsum(counts)
        walked = np.concatenate(([0], np.cumsum(count)))
        unit = np.repeat(np.concatenate(places), count)
        for h, e, c in zip(heads, ends, counts):
            d, top, j, out_of, pe, pn, pu = h
            a, b = walked[e - c], walked[e]
            path = (np.concatenate((pe, edge[a:b])), np.concatenate((pn, node[a:b])), np.concatenate((pu, unit[a:b])))
            trees[d]["samples"].append((path, top))
            trees[d]["meta"].append((j, out_of))
            trees[d]["sets"].append(_subsets(w, path, key[d : d + 1], s, top, j, out_of))
    for d, tree in zip(filled, trees):
        for (path, g) in tree["samples"]:
            lp = float(np.log(w.q[path[0]]).sum())
            x = lp - tree["next"]
            inclusion = 0.0 if x > 4 else (x if x < -30 else math.log(-math.expm1(-math.exp(x))))
            out[d].append((w.piece[path[0]], lp, g, inclusion))
    return out


def _other_edge(w: Walker, node: int, banned: tuple[int, ...], u: float) -> int:
    """An edge of a node by probability, banned ones left out."""
    e = int(w.first[node])
    fine = []
    while True:
        if e not in banned:
            fine.append((float(w.q[e]), e))
        if w.upto[e] == 2.0:
            break
        e += 1
    left = u * sum(q for q, _ in fine)
    for q, e in fine:
        left -= q
        if left < 0:
            return e
    return fine[-1][1]


_OUT = "doc_id long, sample int, n_pieces long, log_prob double, score double, log_inclusion double, ids_crc32 long, decodes boolean"


def segment(df: DataFrame, model: str, k: int = SAMPLES, alpha: float = ALPHA, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Up to ``k`` rows per row of ``df``: distinct sampled segmentations, best score first.

    ids_crc32 is that of the piece ids as little-endian 32-bit integers;
    ``decodes`` says that the ids spell the text again (the model itself reads
    U+2581 as a space).  A null or empty text has one segmentation, of no
    pieces; a text with fewer than ``k`` has them all, with inclusion
    probability 1.  Rows with a null id share one key; repeated rows get equal
    samples.  Extra columns are left behind.  ``with_ids`` adds ids.
    """

    def run(batches):
        lattice = pieces(model, alpha)
        for ids, tx in common.rows(batches):
            salt = np.uint64(seed * 2 + 1)
            keys = np.array([-1 if i is None else i for i in ids], dtype=np.int64).view(np.uint64) * np.uint64(2) + salt
            for a, b in _spans(tx):
                yield batch(ids[a:b], tx[a:b], sample_top_k(lattice, tx[a:b], keys[a:b], k), lattice)

    def batch(ids, tx, found, lattice):
        cols: list[list] = [[] for _ in range(9 if with_ids else 8)]
        for i, t, samples in zip(ids, tx, found):
            want = t.encode()
            for s, (piece, lp, g, inc) in enumerate(samples or [(np.zeros(0, np.int32), 0.0, 0.0, 0.0)]):
                row = (i, s, len(piece), lp, g, inc, zlib.crc32(piece.astype("<u4").tobytes()), lattice.decode(piece) == want)
                for c, v in zip(cols, (*row, piece)):
                    c.append(v)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()))
        names = [c.split()[0] for c in _OUT.split(", ")] + ["ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names[: len(cols)])

    return common.texts(df, id_col, text_col).mapInArrow(run, _OUT + (", ids array<int>" if with_ids else ""))


def _spans(tx: list[str]):
    """Slices of about WALK_CHARS characters."""
    a, size = 0, 0
    for b, t in enumerate(tx):
        size += len(t)
        if size >= WALK_CHARS:
            yield a, b + 1
            a, size = b + 1, 0
    if a < len(tx):
        yield a, len(tx)


def decode(df: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the text that piece ids spell (null for null ids; broken UTF-8 replaced)."""
    names = df.columns
    at = names.index(ids_col)

    def run(batches):
        lattice = pieces(model)
        for b in batches:
            col = [None if x is None else lattice.decode(np.array(x, dtype=np.int64)).decode("utf-8", "replace") for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(col, pa.string())], names=[*names, "decoded"])

    return df.mapInArrow(run, df.select("*", F.lit("").alias("decoded")).schema)
