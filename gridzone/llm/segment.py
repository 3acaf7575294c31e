"""SentencePiece segmentations sampled without replacement: Gumbel top-k by A* search over the lattice.

A text's lattice is cut wherever no piece can span (where no piece holds the two
characters side by side); its arcs are pieces, and forward sums of probabilities make every arc's
conditional probability exact. The search runs from the text's end. A node is a
suffix segmentation with a Gumbel-perturbed log-probability, its best completion's
value; its children's values are drawn conditional on their maximum being the node's own.
The k best leaves are k distinct segmentations, drawn without replacement with
probability proportional to theirs (Gumbel top-k). With an exact bound the A* agenda
pops a node and follows its best child to the text's start, so a pop is one walk
that leaves the siblings on its way in the agenda. Of these only as many as samples
are still due can ever be popped; the others are not kept.

Walks go through all words of a batch in lockstep in numpy. Noise is a hash of
(seed, row key, place in the search tree): a row's samples depend neither on its
neighbours nor on the task that runs it.

The inclusion score is the probability of being among the samples given the
(k+1)-th value as threshold, 1 - exp(-exp(log p - threshold)); weights
p / inclusion estimate sums over all segmentations without bias.

A BPE file carries merge ranks, not probabilities: by default a piece's
probability is 1 / (rank + ZIPF_SHIFT), normalised (Zipf's law). Files that hold log-probabilities are used
as they are with ``scores="log"``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: SentencePiece's space (fixed value).
SPACE = "\u2581"
ZIPF_SHIFT = 2.7
#: Characters sampled at a time; arcs of words remembered by a worker at most.
BATCH_CHARS, REMEMBERED_ARCS = 250_000, 6_000_000
SCHEMA = "sample int, ids binary, n_pieces long, log_prob double, perturbed double, inclusion double"


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)  # arrays wrap without a warning
    spare = np.right_shift(x, np.uint64(30))
    x ^= spare
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=spare)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=spare)
    return x


def _exponential(code: np.ndarray) -> np.ndarray:
    u = (_mix(code) >> np.uint64(11)).astype(np.float64)
    u += 0.5
    u *= 2.0**-53
    return np.negative(np.log(u, out=u), out=u)


def _gumbel(code: np.ndarray) -> np.ndarray:
    return -np.log(_exponential(code))


def _sums(x: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums within each text, and each text's sum. Text by text, so that neighbours do not change the rounding."""
    upto, whole = np.empty_like(x), np.zeros(len(start))
    for d, (a, n) in enumerate(zip(start.tolist(), size.tolist(), strict=True)):
        if n:
            np.cumsum(x[a : a + n], out=upto[a : a + n])
            whole[d] = upto[a + n - 1]
    return upto, whole


class Sampler:
    code_points = 0x110000

    def __init__(self, path: str, scores: str = "zipf"):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        own = [i for i in range(len(sp)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if scores == "zipf":
            order = sorted(own, key=lambda i: (-sp.get_score(i), i))
            total = math.log(sum(1 / (r + ZIPF_SHIFT) for r in range(1, len(own) + 1)))
            log = {i: -math.log(r + ZIPF_SHIFT) - total for r, i in enumerate(order, 1)}
        else:
            log = {i: sp.get_score(i) for i in own}
        self.pieces = {sp.id_to_piece(i): (log[i], i) for i in own}
        self._grow()
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min(log.values(), default=0.0) - 10
        surface = [sp.id_to_piece(i).replace(SPACE, " ").encode() if i in log else b"" for i in range(len(sp))]
        surface[sp.unk_id()] = " \u2047 ".encode()
        for b in range(256):
            if not sp.is_unknown(sp.piece_to_id(f"<0x{b:02X}>")):
                surface[sp.piece_to_id(f"<0x{b:02X}>")] = bytes([b])
        n = np.array([len(x) for x in surface], dtype=np.int64)
        self.surface = (n, np.cumsum(n) - n, np.frombuffer(b"".join(surface), np.uint8))
        self.prefixed = sp.normalize("a").startswith(SPACE)
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.first, self.count = np.empty(0, np.int32), np.empty(0, np.int8)
        self.arc_from, self.arc_log, self.arc_p, self.arc_symbol = np.empty(0, np.int32), np.empty(0), np.empty(0), np.empty(0, np.int32)
        self._forget()

    def _grow(self) -> None:
        """The pieces' trie as sorted edges, and the pairs of characters that stand side by side in a piece."""
        edges: dict[tuple[int, str], int] = {}
        ends, pairs = {}, set()
        for piece, (log, i) in self.pieces.items():
            node = 0
            for c in piece:
                node = edges.setdefault((node, c), len(edges) + 1)
            ends[node] = (log, i)
            pairs.update(pairwise(piece))
        key = np.array([n * self.code_points + ord(c) for n, c in edges] or [-1], dtype=np.int64)
        order = np.argsort(key)
        self.first_node = np.zeros(self.code_points, np.int32)  # 0: no piece begins so
        for (n, c), to in edges.items():
            if n == 0:
                self.first_node[ord(c)] = to
        self.edge_key, self.edge_to = key[order], np.array(list(edges.values()) or [0], dtype=np.int64)[order]
        self.node_log = np.array([ends.get(n, (0.0, 0))[0] for n in range(len(edges) + 1)])
        self.node_symbol = np.array([ends.get(n, (0.0, -1))[1] for n in range(len(edges) + 1)], dtype=np.int64)
        kinds = {c: i for i, c in enumerate(sorted({c for p in pairs for c in p}), 1)}  # 0: in no pair
        self.kind = np.zeros(self.code_points, np.int32)
        self.kind[[ord(c) for c in kinds]] = list(kinds.values())
        self.beside = np.zeros((len(kinds) + 1, len(kinds) + 1), bool)
        for a, b in pairs:
            self.beside[kinds[a], kinds[b]] = True

    def _forget(self) -> None:
        """Words remembered (as UTF-32): their nodes' first arc and number of arcs, and the arcs, entering each node in order."""
        self.words: dict[bytes, int] = {}
        self.emitted: list[tuple[int, ...]] = [(i,) for i in range(len(self.sp))]  # ids of a symbol; characters without a piece follow
        self.characters: dict[str, int] = {}
        self.flat = (np.empty(0, np.int64),) * 3
        self.nodes = self.arcs = 0  # the arrays are written over

    def _bases(self, chars: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The first node of every word of the joined texts, which begin at ``off``; each distinct word is looked up once."""
        bounds = np.append(off, len(chars)).astype(np.int64) * 4
        coded = pa.Array.from_buffers(pa.large_binary(), len(off), [None, pa.py_buffer(bounds), pa.py_buffer(chars)]).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(words)
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]

    def _room(self, nodes: int, arcs: int) -> None:
        """Room for so many more, at least doubled where it runs out."""
        for names, used, more in ((("first", "count"), self.nodes, nodes), (("arc_from", "arc_log", "arc_p", "arc_symbol"), self.arcs, arcs)):
            for name in names:
                old = getattr(self, name)
                if used + more > len(old):
                    setattr(self, name, np.concatenate([old[:used], np.empty(max(more, used), old.dtype)]))

    def _symbol(self, char: str) -> int:
        if char not in self.characters:
            self.characters[char] = len(self.emitted)
            known = all(not self.sp.is_unknown(self.bytes[b]) for b in char.encode())
            self.emitted.append(tuple(self.bytes[b] for b in char.encode()) if known else (self.sp.unk_id(),))
        return self.characters[char]

    def _emissions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all symbols: number of ids, where they begin, and the ids one after another."""
        if len(self.flat[0]) != len(self.emitted):
            n = np.array([len(i) for i in self.emitted], dtype=np.int64)
            self.flat = (n, np.cumsum(n) - n, np.array([i for ids in self.emitted for i in ids], "<u4"))
        return self.flat

    def _learn(self, words: list[bytes]) -> None:
        new = [w for w in words if w not in self.words]
        if self.arcs > REMEMBERED_ARCS:
            self._forget()
            new = words
        if not new:
            return
        length = np.fromiter(map(len, new), np.int64, len(new)) // 4
        chars = np.frombuffer(b"".join(new), "<u4").astype(np.int64)
        start = np.cumsum(length) - length
        word = np.repeat(np.arange(len(new)), length)
        found = self._arcs(chars, (start + length)[word])
        node = start + np.arange(len(new))  # of each word's first node; a word has a node more than characters
        into = [end + word[begin] for begin, end, _, _ in found]
        count = np.bincount(np.concatenate(into), minlength=len(chars) + len(new))
        first = np.cumsum(count) - count
        begin, log, symbol = np.empty(count.sum(), np.int64), np.empty(count.sum()), np.empty(count.sum(), np.int64)
        free = first.copy()
        for ends, (own, _, logs, symbols) in zip(into[::-1], found[::-1], strict=True):  # by node, then from long to short
            at = free[ends]  # pieces of one length end at different nodes
            begin[at], log[at], symbol[at] = own, logs, symbols
            free[ends] += 1
        at = word[begin]
        alpha, source = np.zeros(len(count)), begin + at
        longest_first = np.argsort(-length, kind="stable")
        reach = np.searchsorted(-length[longest_first], -np.arange(1, length.max() + 1), side="right")
        for j, m in enumerate(reach.tolist(), 1):  # all words at once, position by position
            nodes = node[longest_first[:m]] + j
            n = count[nodes]
            starts = np.cumsum(n) - n
            owner = np.repeat(np.arange(m), n)
            arcs = np.arange(len(owner)) + (first[nodes] - starts)[owner]
            x = alpha[source[arcs]] + log[arcs]
            top = np.maximum.reduceat(x, starts)
            alpha[nodes] = top + np.log(np.add.reduceat(np.exp(x - top[owner]), starts))
            log[arcs] = x - alpha[nodes][owner]
        self._room(len(count), len(log))
        own, their = slice(self.nodes, self.nodes + len(count)), slice(self.arcs, self.arcs + len(log))
        self.words.update(zip(new, (node + self.nodes).tolist(), strict=True))
        self.first[own], self.count[own] = first + self.arcs, count
        self.arc_from[their], self.arc_log[their], self.arc_p[their], self.arc_symbol[their] = begin - start[at], log, np.exp(log), symbol
        self.nodes, self.arcs = own.stop, their.stop

    def _arcs(self, chars: np.ndarray, limit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(begin, end, log, symbol) of every piece that begins at a character and ends by its ``limit``, by length; first
        those of single characters that are no piece."""
        at, state, found = np.arange(len(chars)), np.zeros(len(chars), np.int64), []
        for n in range(1, self.longest + 1):
            fits = at + n <= limit[at]
            at, state = at[fits], state[fits]
            if n == 1:
                to = self.first_node[chars[at]]
                hit = to > 0
                at, state = at[hit], to[hit].astype(np.int64)
            else:
                key = state * self.code_points + chars[at + n - 1]
                edge = np.minimum(np.searchsorted(self.edge_key, key), len(self.edge_key) - 1)
                hit = self.edge_key[edge] == key
                at, state = at[hit], self.edge_to[edge[hit]]
            full = self.node_symbol[state] >= 0
            found.append((at[full], at[full] + n, self.node_log[state[full]], self.node_symbol[state[full]]))
            if n == 1:
                bare = np.ones(len(chars), bool)
                bare[at[full]] = False
                bare = np.flatnonzero(bare)
                kinds, which = np.unique(chars[bare], return_inverse=True)
                symbols = np.array([self._symbol(chr(c)) for c in kinds], dtype=np.int64)
                found.insert(0, (bare, bare + 1, np.full(len(bare), self.unknown), symbols[which]))
            if not len(at):
                break
        return found

    def _starts(self, chars: np.ndarray, of_texts: np.ndarray) -> np.ndarray:
        """Where the words of the joined texts begin: at each text, and where no piece holds the two characters side by side."""
        kinds = self.kind[chars]
        first = np.ones(len(chars), bool)
        first[1:] = ~self.beside[kinds[:-1], kinds[1:]]
        first[of_texts] = True
        return np.flatnonzero(first)

    def _walk(self, base, pos, off, doc_start, seed, path, log):
        """Follows best children from node ``pos`` of each word (at ``off`` in the batch) to its start. Marks arcs in
        ``path`` and their logs in ``log`` where they begin; returns the siblings (state, end offset, arc, time after the best)."""
        state = np.arange(len(base))
        state = state[pos[state] > 0]
        pos = pos[state]
        out = []
        while len(state):
            node = base[state] + pos
            first, count = self.first[node].astype(np.int64), self.count[node].astype(np.int64)
            best = first.copy()
            many = np.flatnonzero(count > 1)
            if len(many):
                n = count[many]
                starts = np.cumsum(n) - n
                owner = np.repeat(np.arange(len(many)), n)
                nth = np.arange(len(owner)) - starts[owner]
                arc = first[many][owner]
                arc += nth
                who = state[many]
                end = off[who] + pos[many]
                place = seed[who] + _mix((end - doc_start[who]).astype(np.uint64))
                # Exponential times of rate p: the first to come has the largest log p + Gumbel noise, and exp(-value) is its time.
                nth = nth.view(np.uint64)
                nth *= np.uint64(0xD1B54A32D192ED03)
                nth += place[owner]
                time = _exponential(nth)
                time /= self.arc_p[arc]
                first_time = np.minimum.reduceat(time, starts)
                time -= first_time[owner]
                at = np.flatnonzero(time == 0)
                if len(at) > len(many):  # equal times: the first
                    at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
                best[many] = arc[at]
                rest = np.ones(len(arc), bool)
                rest[at] = False
                rest = np.flatnonzero(rest)
                node = owner[rest]
                out.append((who[node], end[node], arc[rest], time[rest]))
            begin = off[state] + self.arc_from[best]
            path[begin], log[begin] = best, self.arc_log[best]
            pos = self.arc_from[best].astype(np.int64)
            go = pos > 0
            state, pos = state[go], pos[go]
        return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids[bounds[i] : bounds[i + 1]], as the model's own decoder gives them for what ``sample`` emits."""
        size, at, data = self.surface
        n = size[ids]
        upto = np.concatenate([[0], np.cumsum(n)])
        joined = data[np.repeat(at[ids] - upto[:-1], n) + np.arange(upto[-1])].tobytes()
        texts = [joined[a:b].decode("utf-8", "replace") for a, b in pairwise(upto[bounds].tolist())]
        return [t.removeprefix(" ") for t in texts] if self.prefixed else texts

    def sample(self, texts: list[str], keys: np.ndarray, k: int, seed: int, decoded: bool = False) -> list[list[tuple]]:
        """For each text up to k samples (ids, pieces, log p, perturbed, inclusion, with ``decoded`` the ids' text), best
        first; ``keys`` are uint64."""
        texts = [self.sp.normalize(t) for t in texts]
        size = np.array([len(t) for t in texts], dtype=np.int64)
        start = np.cumsum(size) - size
        total, docs, whole = int(size.sum()), len(texts), "".join(texts)
        chars = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        off = self._starts(chars, start[size > 0])
        length = np.diff(off, append=total)
        base = self._bases(chars, off)
        first_word = np.searchsorted(off, start)
        doc = np.repeat(np.arange(docs), np.searchsorted(off, start + size) - first_word)
        row = _mix(keys ^ _mix(np.full(docs, seed, np.uint64)))
        value = [_gumbel(row ^ np.uint64(1))]  # of each sample; -inf where there is none
        agenda: list[list[tuple[float, int, int, int]]] = [[] for _ in range(docs)]  # (-value, path, end offset, arc)
        paths, logs, totals = [], [], []
        for e in range(k):
            path, log = np.full(total, -1, np.int64), np.zeros(total)
            if e == 0:
                state_word, pos = np.arange(len(base)), length
            else:
                value.append(np.full(docs, -np.inf))
                pick = []
                for d in range(docs):
                    if agenda[d]:
                        v, old, end, arc = heapq.heappop(agenda[d])
                        value[e][d] = -v
                        stop = start[d] + size[d]
                        path[end:stop], log[end:stop] = paths[old][end:stop], logs[old][end:stop]
                        pick.append((d, end, arc))
                if not pick:
                    break
                d, end, arc = np.array(pick, dtype=np.int64).T
                word = np.searchsorted(off, end - 1, side="right") - 1  # the arc ends in this word
                begin = off[word] + self.arc_from[arc]
                path[begin], log[begin] = arc, self.arc_log[arc]
                n = word - first_word[d] + 1
                state_word = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first_word[d], n)
                pos = length[state_word].copy()
                pos[np.cumsum(n) - 1] = self.arc_from[arc]
            own = doc[state_word]
            seeds = _mix(row + np.uint64(e + 2))[own]
            found = self._walk(base[state_word], pos, off[state_word], start[own], seeds, path, log)
            paths.append(path)
            logs.append(log)
            if found is None:
                totals.append(_sums(log, start, size)[1])
                continue
            state, end, arc, time = found
            d = own[state]
            upto, log_p = _sums(log, start, size)
            totals.append(log_p)
            with np.errstate(divide="ignore"):
                late = np.log(time) + upto[end - 1] - log_p[d]  # the earlier, the better a child; -inf: as good as its node
            for _ in range(k - e):
                best = np.full(docs, np.inf)
                np.minimum.at(best, d, late)
                at = np.flatnonzero((late == best[d]) & (late < np.inf))
                at = at[np.unique(d[at], return_index=True)[1]]
                g = value[e][d[at]]
                v = g + late[at]
                child = g - np.maximum(v, 0) - np.log1p(np.exp(-np.abs(v)))
                for i, own_doc, c in zip(at.tolist(), d[at].tolist(), child.tolist(), strict=True):
                    heapq.heappush(agenda[own_doc], (-c, e, int(end[i]), int(arc[i])))
                late[at] = np.inf
        limit = np.array([-a[0][0] if a else -np.inf for a in agenda])
        emits, emitted_at, emitted = self._emissions()
        out: list[list] = [[] for _ in range(docs)]
        for e, (path, log_p) in enumerate(zip(paths, totals, strict=True)):
            at = np.flatnonzero(path >= 0)
            symbols = self.arc_symbol[path[at]]
            n = emits[symbols]
            upto = np.concatenate([[0], np.cumsum(n)])
            ids = emitted[np.repeat(emitted_at[symbols] - upto[:-1], n) + np.arange(upto[-1])]
            in_doc = upto[np.searchsorted(at, np.append(start, total))]
            back = self.decode(ids, in_doc) if decoded else None
            for d in range(docs):
                if value[e][d] > -np.inf:
                    own = ids[in_doc[d] : in_doc[d + 1]]
                    inclusion = 1.0 if limit[d] == -np.inf else float(-np.expm1(-np.exp(log_p[d] - limit[d])))
                    out[d].append((own.tobytes(), len(own), float(log_p[d]), float(value[e][d]), inclusion, *([back[d]] if decoded else [])))
        return out


@lru_cache(maxsize=2)
def sampler(path: str, scores: str = "zipf") -> Sampler:
    """One per worker process and model."""
    return Sampler(path, scores)


def sample(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", k: int = 2, seed: int = 1, scores: str = "zipf", decoded: bool = False) -> DataFrame:
    """Up to ``k`` rows per row of ``docs``, one per distinct segmentation: id, sample (0 is the best value), ids
    (little-endian unsigned 32-bit), n_pieces, log_prob, perturbed, inclusion, and with ``decoded`` the ids' text.

    A text with fewer segmentations has them all, with inclusion 1; null and
    empty texts have the empty one. The noise depends on ``seed`` and the id alone, so
    rows that repeat an id and text repeat its samples. A null id is a key like any
    other. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = own.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = sampler(model, scores).sample
        types = [pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64()] + [pa.string()] * decoded
        names = ["id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion"] + ["decoded"] * decoded
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("key").to_numpy().view(np.uint64)
            lo = 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= BATCH_CHARS):
                    chars += len(texts[hi])
                    hi += 1
                rows = [(lo + d, e, *s) for d, found in enumerate(draw(texts[lo:hi], keys[lo:hi], k, seed, decoded)) for e, s in enumerate(found)]
                at, *columns = zip(*rows, strict=True)
                arrays = [batch.column("id").take(pa.array(at)), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                lo = hi

    return own.mapInArrow(run, f"id {kind}, {SCHEMA}" + ", decoded string" * decoded).withColumnRenamed("id", id_col)


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _decoded(sp, ids: bytes) -> str:
    return sp.decode(np.frombuffer(ids, "<u4").tolist()) if ids else ""


def decode(ids: Column, model: str) -> Column:
    """The text of little-endian unsigned 32-bit ids; null for null."""

    @F.arrow_udf("string")
    def text(packed: pa.Array) -> pa.Array:
        sp = processor(model)
        return pa.array([None if x is None else _decoded(sp, x) for x in packed.to_pylist()], pa.string())

    return text(ids)


def encode(text: Column, model: str) -> Column:
    """The model's own segmentation as little-endian unsigned 32-bit ids; null for null."""

    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        sp = processor(model)
        return pa.array([None if t is None else np.array(sp.encode(t), "<u4").tobytes() for t in texts.to_pylist()], pa.binary())

    return ids(text)
