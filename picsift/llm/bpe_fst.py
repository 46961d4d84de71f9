"""Byte-level BPE as a lazily determinised finite-state transducer.

``Vocabulary`` holds the ranks; ``Transducer`` turns the bytes of one
pre-token into token ids from left to right, one deterministic transition per
byte, and ``Utf8Decoder`` turns ids back into text as they arrive.

How the transducer follows from the merges
    Write ``last(i)`` for the last token of the encoding of the first ``i``
    bytes.  A sequence of tokens is a BPE encoding exactly when every two
    neighbours, merged on their own, stay as they are, so ``last(i)`` is the
    only token ``t`` that ends at ``i`` and whose left neighbour
    ``last(i - len(t))`` lets it stand.  Which tokens may still be used later
    depends only on the positions from which the bytes read so far begin some
    token.  The non-deterministic machine holds one such open position; a
    deterministic state is the set of them (vocabulary-tree node, last token,
    parent) with the tokens not yet written.  States and transitions are made
    the first time they are needed.

Bounded lookahead
    A token is written as soon as every open position descends from it, which
    is the case at the latest when the longest token of the vocabulary has been
    read past it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import regex

#: Unicode White_Space, the class that ``\s`` of the split pattern stands for (fixed values).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


class Vocabulary:
    """Token ids by bytes, as a rank file lists them (base64 token, rank)."""

    def __init__(self, data: bytes):
        self.ranks: dict[bytes, int] = {}
        for line in data.splitlines():
            if line.strip():
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.step: dict[int, int] = {}     # node * 256 + byte -> node; node 0 is the root
        self.token_at: list[int] = [-1]
        for token, rank in self.ranks.items():
            node = 0
            for b in token:
                key = node << 8 | b
                nxt = self.step.get(key)
                if nxt is None:
                    nxt = self.step[key] = len(self.token_at)
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = rank
        self._stands: dict[int, bool] = {}

    def forget(self) -> None:
        """Drop what ``stands`` has learned."""
        self._stands.clear()

    def merge(self, data: bytes) -> list[int]:
        """The definition: join the neighbours of lowest joint rank (leftmost
        first) until no two neighbours form a token."""
        parts = [data[i:i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def stands(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay as they are (left -1: none)."""
        key = (left + 1) << 20 | right
        known = self._stands.get(key)
        if known is None:
            a, b = self.bytes_of.get(left, b""), self.bytes_of[right]
            known = self.merge(a + b) == ([left, right] if left >= 0 else [right])
            self._stands[key] = known
        return known


class Transducer:
    """The machine runs over many pre-tokens at a time, one byte of each in a
    step, with NumPy look-ups in a hash table of the arcs made so far.

    A deterministic state is a flat row of (node, token, parent) triples in order
    of position; node -1: no token goes on from there.  Arc and end outputs are
    numbers of token tuples, number 0 being the empty one.
    """

    def __init__(self, vocab: Vocabulary, max_states: int = 300_000):
        self.vocab, self.max_states = vocab, max_states
        self._reset()

    def _reset(self) -> None:
        start = array("i", (0, -1, -1)).tobytes()
        self.states, self.number = [start], {start: 0}
        self.tuples: dict[tuple[int, ...], int] = {(): 0}
        self.out_at, self.out_len, self.out_flat = _Grown(np.int64), _Grown(np.int64), _Grown(np.int32)
        self.out_at.add([0])
        self.out_len.add([0])
        self.arc_to, self.arc_out, self.end_out = _Grown(np.int32), _Grown(np.int32), _Grown(np.int32)
        self.end_out.add([0])
        self.keys = np.full(1 << 16, -1, dtype=np.int64)
        self.arcs = np.zeros(1 << 16, dtype=np.int32)
        self.vocab.forget()

    # --- hash table of arcs -------------------------------------------------
    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)).astype(np.int64) & (len(self.keys) - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Arc numbers, -1 where there is none yet."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.arcs[slot], -1)
        rest = np.flatnonzero((there != keys) & (there >= 0))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[rest]]
            hit = there == keys[rest]
            out[rest[hit]] = self.arcs[slot[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
        return out

    def _insert(self, keys: np.ndarray, arcs: np.ndarray) -> None:
        if 2 * (self.arc_to.n) > len(self.keys):
            old = self.keys >= 0
            keys, arcs = np.concatenate([self.keys[old], keys]), np.concatenate([self.arcs[old], arcs])
            size = len(self.keys) * 2
            self.keys, self.arcs = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
        slot = self._slot(keys)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slot[rest]] < 0]
            self.keys[slot[free]] = keys[free]          # of several for one slot the last stays
            won = free[self.keys[slot[free]] == keys[free]]
            self.arcs[slot[won]] = arcs[won]
            done = np.zeros(len(keys), dtype=bool)
            done[won] = True
            rest = rest[~done[rest]]
            slot[rest] = (slot[rest] + 1) & (len(self.keys) - 1)

    def _tuple(self, tokens: tuple[int, ...]) -> int:
        number = self.tuples.get(tokens)
        if number is None:
            number = self.tuples[tokens] = self.out_at.n
            self.out_at.add([self.out_flat.n])
            self.out_len.add([len(tokens)])
            self.out_flat.add(tokens)
        return number

    # --- determinisation ----------------------------------------------------
    def _arc(self, state: int, byte: int) -> tuple[int, int]:
        """Follow one byte: (next state, output); state -1 when the byte has no reading."""
        step, token_at = self.vocab.step, self.vocab.token_at
        stands = self.vocab.stands
        row = array("i", self.states[state])
        nodes, toks, pars = row[0::3].tolist(), row[1::3].tolist(), row[2::3].tolist()
        parent = token = -1
        for i, node in enumerate(nodes):
            if node >= 0:
                node = nodes[i] = step.get(node << 8 | byte, -1)
                if node >= 0 and parent < 0:
                    t = token_at[node]
                    if t >= 0 and stands(toks[i], t):
                        parent, token = i, t
        if parent < 0:
            return -1, 0
        nodes.append(0)
        toks.append(token)
        pars.append(parent)
        # keep what is open and its ancestors
        n = len(nodes)
        keep, children = [False] * n, [0] * n
        for i in range(n - 1, -1, -1):
            if keep[i] or nodes[i] >= 0:
                keep[i] = True
                if pars[i] >= 0:
                    keep[pars[i]] = True
                    children[pars[i]] += 1
        # the first kept entry is the root of all; write while only one way leads on
        written = []
        root = keep.index(True)
        while nodes[root] < 0 and children[root] == 1:
            keep[root] = False
            root = keep.index(True, root + 1)
            written.append(toks[root])
        place, new = [-1] * n, array("i")
        for i in range(root, n):
            if keep[i]:
                place[i] = len(new) // 3
                # a closed root's token is written and its neighbours are settled
                new.extend((nodes[i], toks[i] if i != root or nodes[i] >= 0 else -2,
                            place[pars[i]] if i != root and pars[i] >= 0 else -1))
        key = new.tobytes()
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
            out, i = [], len(new) // 3 - 1
            while i > 0:
                out.append(new[3 * i + 1])
                i = new[3 * i + 2]
            self.end_out.add([self._tuple(tuple(reversed(out)))])
        return number, self._tuple(tuple(written))

    def _follow(self, keys: np.ndarray) -> np.ndarray:
        """Arc numbers, made where they were missing."""
        arcs = self._find(keys)
        if (arcs < 0).any():
            missing = np.unique(keys[arcs < 0])
            made = [self._arc(k >> 8, k & 255) for k in missing.tolist()]
            first = self.arc_to.n
            self.arc_to.add([x[0] for x in made])
            self.arc_out.add([x[1] for x in made])
            self._insert(missing, np.arange(first, first + len(made)))
            arcs = self._find(keys)
        return arcs

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, one after the other, and how many each has."""
        if len(self.states) > self.max_states:
            self._reset()
        if not pieces:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(-length, kind="stable")
        size = length[order]
        at = np.concatenate([[0], np.cumsum(length)])[:-1][order]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        state = np.zeros(len(pieces), dtype=np.int64)
        failed = np.zeros(len(pieces), dtype=bool)
        who, what = [], []
        longest = int(size[0])
        active = np.searchsorted(-size, -np.arange(longest), side="left")    # with size > step
        for p in range(longest):
            m = int(active[p])
            arcs = self._follow(state[:m] << 8 | data[at[:m] + p])
            to, out = self.arc_to.view()[arcs], self.arc_out.view()[arcs]
            if (to < 0).any():
                failed[:m] |= to < 0
                to = np.maximum(to, 0)
            state[:m] = to
            writes = np.flatnonzero(out)
            if len(writes):
                who.append(writes)
                what.append(out[writes])
        who.append(np.arange(len(pieces)))
        what.append(self.end_out.view()[state])
        who_all, what_all = np.concatenate(who), np.concatenate(what)
        who_all = order[who_all]
        back = np.argsort(who_all, kind="stable")
        who_all, what_all = who_all[back], what_all[back]
        n = self.out_len.view()[what_all]
        flat = self.out_flat.view()[_spans(self.out_at.view()[what_all], n)]
        counts = np.bincount(who_all, weights=n, minlength=len(pieces)).astype(np.int64)
        if failed.any():                      # tokens that no merge reaches: the definition decides
            lists = np.split(flat, np.cumsum(counts)[:-1])
            for i in order[failed].tolist():
                lists[i] = np.array(self.vocab.merge(pieces[i]), dtype=np.int32)
            flat = np.concatenate(lists)
            counts = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        return flat, counts


class _Grown:
    """A NumPy vector that is added to."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1024, dtype=dtype), 0

    def add(self, values) -> None:
        end = self.n + len(values)
        if end > len(self.data):
            more = np.zeros(max(end, 2 * len(self.data)), dtype=self.data.dtype)
            more[:self.n] = self.data[:self.n]
            self.data = more
        self.data[self.n:end] = values
        self.n = end

    def view(self) -> np.ndarray:
        return self.data[:self.n]


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i] + n[i] - 1, one span after the other."""
    total = int(n.sum())
    shift = np.repeat(start - (np.cumsum(n) - n), n)
    return np.arange(total, dtype=np.int64) + shift


class Codec:
    """Texts to ids and back.  ``pattern`` cuts a text into pre-tokens; each is
    encoded by itself.  The different words of a batch of texts run through the
    transducer together; memory is bounded by the batch and the machine."""

    def __init__(self, vocab: Vocabulary, pattern: str, max_states: int = 300_000):
        self.vocab = vocab
        self.machine = Transducer(vocab, max_states)
        self.split = regex.compile(pattern)
        # A run of non-space characters with the one space before it is cut the
        # same way wherever it stands, and a run of white space is one pre-token.
        self.runs = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self.is_white = re.compile(f"[{WHITE}]")

    def _pieces_of(self, runs: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of all runs, one after the other, and how many each run has.
        The runs are cut in one go with a line end after each, which is a
        pre-token by itself there; runs of white space are put in afterwards."""
        white = [i for i, r in enumerate(runs) if self.is_white.match(r[-1])]
        asked = list(runs)
        for i in white:
            asked[i] = "x"
        cut = self.split.findall("\n".join(asked) + "\n")
        ends = np.flatnonzero(np.fromiter(("\n" == p for p in cut), dtype=bool, count=len(cut)))
        n = np.diff(ends, prepend=-1) - 1
        out = [p for p in cut if p != "\n"]
        first = np.cumsum(n) - n
        for i in white:
            out[first[i]] = runs[i]
        return out, n

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found = [self.runs.findall(t) for t in texts]
        place = dict.fromkeys(chain.from_iterable(found))
        if not place:
            return [np.zeros(0, dtype=np.int32) for _ in texts]
        place = dict(zip(place, range(len(place))))
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        at_runs = np.fromiter(map(place.__getitem__, chain.from_iterable(found)), dtype=np.int64, count=int(sizes.sum()))
        del found
        pieces, per_run = self._pieces_of(list(place))
        index = dict.fromkeys(pieces)
        index = dict(zip(index, range(len(index))))
        piece_at = np.fromiter(map(index.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        ranks = self.vocab.ranks
        data = [p.encode("utf-8", "surrogatepass") for p in index]
        whole = np.fromiter((ranks.get(d, -1) for d in data), dtype=np.int64, count=len(data))
        where = np.flatnonzero(whole < 0)
        flat, n_asked = self.machine.encode([data[i] for i in where.tolist()])
        # tokens of pieces, of runs, of texts: flat rows with a start and a length each
        n = np.ones(len(data), dtype=np.int64)
        n[where] = n_asked
        known = np.flatnonzero(whole >= 0)
        start = np.zeros(len(data), dtype=np.int64)
        start[where] = np.cumsum(n_asked) - n_asked
        start[known] = len(flat) + np.arange(len(known))
        flat = np.concatenate([flat, whole[known].astype(np.int32)])
        of_runs = flat[_spans(start[piece_at], n[piece_at])]
        run_n = _sums(n[piece_at], per_run)
        run_start = np.cumsum(run_n) - run_n
        of_texts = of_runs[_spans(run_start[at_runs], run_n[at_runs])]
        text_n = _sums(run_n[at_runs], sizes)
        return np.split(of_texts, np.cumsum(text_n)[:-1])

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts of ``values`` of these sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


# Entry states of the UTF-8 machine: 0 between characters, 1-3 that many
# continuation bytes to come, 4 after E0, 5 after ED, 6 after F0, 7 after F4.
_FIRST = {**{b: 0 for b in range(0x80)}, **{b: 1 for b in range(0xC2, 0xE0)},
          **{b: 2 for b in range(0xE1, 0xF0)}, 0xE0: 4, 0xED: 5, 0xF0: 6,
          **{b: 3 for b in range(0xF1, 0xF4)}, 0xF4: 7}
_NEXT = {1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1),
         5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}


class Utf8Decoder:
    """Incremental decoding of token ids: ``feed`` returns the text that is
    certain after some ids, ``close`` what is left.  A byte that cannot go on
    becomes U+FFFD, as the text decoder of the standard library writes it.

    The arc of a (state, token) pair - state after it, text of it - is made the first
    time it is met, so a text costs one table look-up for each token.
    """

    def __init__(self, vocab: Vocabulary, max_arcs: int = 500_000):
        self.vocab, self.max_arcs = vocab, max_arcs
        self.arcs: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        self.held = b""

    def _arc(self, held: bytes, token: int) -> tuple[bytes, str]:
        data = held + self.vocab.bytes_of[token]
        state, start = 0, 0
        out: list[str] = []
        i = 0
        while i < len(data):
            b = data[i]
            if state == 0:
                start, state = i, _FIRST.get(b, -1)
                if state == 0:
                    out.append(chr(b))
                elif state < 0:
                    out.append("�")
                    state = 0
                i += 1
                continue
            low, high, then = _NEXT[state]
            if low <= b <= high:
                i += 1
                state = then
                if state == 0:
                    out.append(data[start:i].decode("utf-8"))
            else:                        # the bytes so far end in the middle of a character
                out.append("�")
                state = 0
        return (data[start:] if state else b""), "".join(out)

    def feed(self, ids: Iterable[int]) -> str:
        out, arcs, held = [], self.arcs, self.held
        for t in ids:
            arc = arcs.get((held, t))
            if arc is None:
                if len(arcs) >= self.max_arcs:
                    arcs.clear()
                arc = arcs[held, t] = self._arc(held, t)
            held = arc[0]
            out.append(arc[1])
        self.held = held
        return "".join(out)

    def close(self) -> str:
        left, self.held = self.held, b""
        return "�" if left else ""


class Decimals:
    """Ids written as decimals joined by one space, from a table of each id's text."""

    def __init__(self, vocab: Vocabulary):
        self.of = {i: b"%d " % i for i in vocab.bytes_of}

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(b"".join(map(self.of.__getitem__, ids))[:-1]).hexdigest()


def stream(decoder: Utf8Decoder, ids: list[int], block: int = 4096) -> Iterator[str]:
    """Text of ``ids``, block by block."""
    for i in range(0, len(ids), block):
        yield decoder.feed(ids[i:i + block])
    yield decoder.close()
