"""Byte-pair encoding of words by speculation: propose, check pairs, merge only what fails.

White space never reaches a token of the vocabulary, so a text is the sequence of its
white-space separated words and the ids of a word do not depend on its neighbours. Greedy
longest match proposes tokens for every new word. A proposal equals the merge result exactly
if each adjacent pair of tokens would also stand if the two were encoded alone, so one
vectorised pass walks all distinct pairs back in merge time and looks for a merge across the
boundary that would have come first. Words with a failing pair are merged step by step.
"""

from __future__ import annotations

import gc
import heapq
import json
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import regex

from .common import only, remembers

END = "</w>"
NEVER = np.int64(1) << 40
# Unicode white space, as a character class (str.isspace() takes ODD_CONTROLS besides).
SPACES = r"\t-\r \x85\xa0" + chr(0x2000) + "-" + chr(0x200A) + "".join(map(chr, (0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SEPARATORS = regex.compile(f"[{SPACES}]+")
ODD_CONTROLS = regex.compile(r"[\x1c-\x1f]")  # str.split() takes these for white space
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


BEYOND = regex.compile(f"[{chr(0x250)}-{chr(0x10FFFF)}]")
SHORT = 64  # longer pre-tokens are merged one by one


def split_words(text: str) -> list[str]:
    if ODD_CONTROLS.search(text):
        return [w for w in SEPARATORS.split(text) if w]
    return text.split()


def _byte_symbols() -> dict[int, str]:
    """The printable stand-ins of bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """Encoder of a vocabulary file in which words end with a suffix and white space is dropped."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model.get("end_of_word_suffix") != END:
            raise ValueError("a vocabulary with word ends is needed")
        library = Tokenizer.from_file(path)
        self._normalise, self._cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.tokens = np.empty(size, object)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = text
        byte_of = {c: b for b, c in _byte_symbols().items()}
        self._bytes = lambda symbols: bytes(map(byte_of.__getitem__, symbols))
        # Tokens inside a word and at its end, by the bytes they stand for.
        self.inner = {self._bytes(t): i for t, i in vocab.items() if not t.endswith(END)}
        self.final = {self._bytes(t[: -len(END)]): i for t, i in vocab.items() if t.endswith(END)}
        self.longest = max(map(len, [*self.inner, *self.final]))
        self._base = np.array([[d[bytes([b])] for b in range(256)] for d in (self.inner, self.final)], np.int64)
        self._build_trie()
        self.known: dict[bytes, list[int]] = {}
        self.pieces_kept = 200_000
        # Merge tables: rank of the merge that makes a token (-1: a single symbol) and its two parts.
        self.rank, self.left, self.right = (np.full(size, -1, np.int64) for _ in range(3))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(dict.fromkeys(tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])):
            a, b = pair
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.merges[left, right] = rank, made
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, left, right
        self._made = np.array([made for _, made in self.merges.values()], np.int64)  # by rank
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]

    def _build_trie(self) -> None:
        """Sorted (state, byte) keys with their next states, and the tokens that end in a state."""
        states: dict[bytes, int] = {b"": 0}
        for token in {**self.inner, **self.final}:
            for k in range(1, len(token) + 1):
                states.setdefault(token[:k], len(states))
        edges = sorted((states[p[:-1]] << 8 | p[-1], n) for p, n in states.items() if p)
        self._edge, self._next = (np.array(v, np.int64) for v in zip(*edges, strict=True))
        self._ends = np.full((2, len(states)), -1, np.int64)
        for k, tokens in enumerate((self.inner, self.final)):
            for token, i in tokens.items():
                self._ends[k, states[token]] = i

    # -- words to pre-tokens ------------------------------------------------------------------

    def cut(self, words: list[str]) -> list[list[bytes | int]]:
        """Pre-tokens of each word in UTF-8, special tokens as ids."""
        out: list[list[bytes | int]] = []
        find = PIECES.findall
        # Below U+0250 all characters are composed and classes and cases agree in every Unicode version.
        joined = "\n".join(words)
        plain = joined.isascii() or not BEYOND.search(joined)
        lower = (joined.lower() if plain else "\n".join(w.lower() if not BEYOND.search(w) else "" for w in words)).split("\n")
        for word, low in zip(words, lower, strict=True):
            if low.isalpha():
                out.append([low.encode()])
            elif "<|" in word and self._special:
                found, at = [], 0
                for m in self._special.finditer(word):
                    found += self._library_cut(word[at : m.start()])
                    found.append(self.special[m[0]])
                    at = m.end()
                out.append(found + self._library_cut(word[at:]))
            elif low:
                out.append([p.encode() for p in find(low)])
            else:
                out.append(self._library_cut(word))
        return out

    def _library_cut(self, text: str) -> list[bytes]:
        return [self._bytes(symbols) for symbols, _ in self._cut(self._normalise(text))] if text else []

    # -- proposals and exact merging ----------------------------------------------------------

    def propose(self, piece: bytes) -> list[int]:
        """Greedy longest match over one pre-token."""
        out, at, n = [], 0, len(piece)
        while at < n:
            rest = n - at
            if rest <= self.longest and (found := self.final.get(piece[at:])) is not None:
                out.append(found)
                break
            for length in range(min(rest - 1, self.longest), 0, -1):
                if (found := self.inner.get(piece[at : at + length])) is not None:
                    out.append(found)
                    at += length
                    break
        return out

    def propose_all(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`propose` for many pre-tokens at once, by walking the trie of the vocabulary; owner and token."""
        owner, at = np.arange(len(starts)), starts.copy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(owner):
            best, length = np.full(len(owner), -1, np.int64), np.zeros(len(owner), np.int64)
            live, state, k = np.arange(len(owner)), np.zeros(len(owner), np.int64), 0
            while len(live):
                here = at[live] + k
                keys = state << 8 | data[here]
                edge = np.minimum(np.searchsorted(self._edge, keys), len(self._edge) - 1)
                on = self._edge[edge] == keys
                live, state, here = live[on], self._next[edge[on]], here[on]
                k += 1
                last = here + 1 == stops[live]
                token = self._ends[last.astype(np.int64), state]
                hit = token >= 0
                best[live[hit]], length[live[hit]] = token[hit], k
                live, state = live[~last], state[~last]
            found.append((owner, best))
            at = at + length
            more = at < stops
            owner, at, stops = owner[more], at[more], stops[more]
        owners, tokens = (np.concatenate(v) for v in zip(*found, strict=True))
        order = np.argsort(owners, kind="stable")
        return owners[order], tokens[order]

    def merge(self, piece: bytes) -> list[int]:
        """Exact merging, lowest rank first and leftmost among equals."""
        ids = [*self._base[0, list(piece[:-1])].tolist(), int(self._base[1, piece[-1]])]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, made, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (m := merges.get((ids[k], ids[after[k]]))):
                    heapq.heappush(heap, (*m, k, ids[k], ids[after[k]]))
        return [t for t in ids if t >= 0]

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """`merge` for many short pieces at once: each round does the next merge of every piece."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        flat = self._base[0, data]
        ends = np.cumsum(lengths) - 1
        flat[ends] = self._base[1, data[ends]]
        out: list[list[int]] = [[]] * len(pieces)

        def ranks(at: np.ndarray) -> np.ndarray:
            """Of the pairs that begin at these positions; none across pieces."""
            after = np.minimum(at + 1, len(flat) - 1)
            return np.where((at + 1 < len(flat)) & (owner[at] == owner[after]), self._pair_rank(flat[at], flat[after]), NEVER)

        rank = ranks(np.arange(len(flat)))
        while len(flat):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(flat)])
            least = np.minimum.reduceat(rank, starts)
            done = least == NEVER
            if done.any():
                gone = np.repeat(done, sizes)
                tokens, first = flat[gone].tolist(), np.r_[0, np.cumsum(sizes[done])].tolist()
                for k, i in enumerate(owner[starts[done]].tolist()):
                    out[i] = tokens[first[k] : first[k + 1]]
                flat, owner, rank, least, sizes = flat[~gone], owner[~gone], rank[~gone], least[~done], sizes[~done]
                if not len(flat):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            at = at[np.r_[True, owner[at][1:] != owner[at][:-1]]]  # leftmost of each piece
            flat[at] = self._made[rank[at]]
            keep = np.ones(len(flat), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # where the merged tokens stand once their right halves are gone
            flat, owner, rank = flat[keep], owner[keep], rank[keep]
            near = np.unique(np.r_[at, np.maximum(at - 1, 0)])
            rank[near] = ranks(near)
        return out

    # -- many words -------------------------------------------------------------------------

    def _pair_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        keys = x << 32 | y
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does the boundary between them survive merging?

        Both are taken apart in reverse merge time. x_end and y_end are the ranks at which the
        symbols now at the boundary are used up inside their own token; a merge across the
        boundary before that would have destroyed the proposal. Equal ranks go left to right.
        """
        fine = np.ones(len(x), bool)
        at = np.arange(len(x))
        x, y = x.astype(np.int64), y.astype(np.int64)
        x_end, y_end = np.full(len(x), NEVER), np.full(len(x), NEVER)
        while len(at):
            rank = self._pair_rank(x, y)
            bad = (rank < x_end) & (rank <= y_end) & (rank < NEVER)
            fine[at[bad]] = False
            rank_x, rank_y = self.rank[x], self.rank[y]
            go = ~bad & ((rank_x >= 0) | (rank_y >= 0))
            at, x, y, x_end, y_end, rank_x, rank_y = (v[go] for v in (at, x, y, x_end, y_end, rank_x, rank_y))
            in_x = rank_x > rank_y
            x_end, x = np.where(in_x, rank_x, x_end), np.where(in_x, self.right[x], x)
            y_end, y = np.where(in_x, y_end, rank_y), np.where(in_x, y, self.left[y])
        return fine

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of distinct pre-tokens: propose, check all adjacent pairs, merge what fails."""
        out: list[list[int]] = [[]] * len(pieces)
        short = [i for i, p in enumerate(pieces) if len(p) <= SHORT]
        if short:
            lengths = np.fromiter((len(pieces[i]) for i in short), np.int64, len(short))
            stops = np.cumsum(lengths)
            data = np.frombuffer(b"".join([pieces[i] for i in short]), np.uint8)
            owner, flat = self.propose_all(data, stops - lengths, stops)
            bad = np.unique(owner[:-1][self._failing(owner, flat)])
            tokens, first = flat.tolist(), np.searchsorted(owner, np.arange(len(short) + 1)).tolist()
            for k, i in enumerate(short):
                out[i] = tokens[first[k] : first[k + 1]]
            redo = [short[k] for k in bad.tolist()]
            for i, ids in zip(redo, self.merge_all([pieces[i] for i in redo]) if redo else [], strict=True):
                out[i] = ids
        for i, piece in enumerate(pieces):
            if len(piece) > SHORT:
                flat = np.array(self.propose(piece), np.int64)
                out[i] = self.merge(piece) if self._failing(np.zeros(len(flat)), flat).any() else flat.tolist()
        return out

    def _failing(self, owner: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """For each token but the last: do it and its successor in the same pre-token not go together?"""
        failing = np.zeros(max(0, len(flat) - 1), bool)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        if len(inside):
            pairs, which = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
            failing[inside] = ~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[which]
        return failing

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        words = list(words)
        return dict(zip(words, self.encode_list(words), strict=True))

    def encode_list(self, words: list[str]) -> list[list[int]]:
        """Ids of each of these distinct words; lists may be shared."""
        if not words:
            return []
        cut = self.cut(words)
        if len(self.known) > self.pieces_kept:
            self.known.clear()
        known = self.known
        new = list({p for p in chain.from_iterable(cut) if p.__class__ is bytes}.difference(known))
        known.update(zip(new, self.encode_pieces(new), strict=True))
        return [
            known[ps[0]] if len(ps) == 1 and ps[0].__class__ is bytes
            else [t for p in ps for t in (known[p] if p.__class__ is bytes else (p,))]
            for ps in cut
        ]


class WordMemory(dict):
    """What a worker remembers of words it has met: word -> render(ids of the word).

    Two generations of at most `limit` words bound the memory; a forgotten word is encoded again.
    """

    def __init__(self, coder: WordBpe, render: Callable[[list[int]], object], limit: int = 200_000) -> None:
        super().__init__()
        self.coder, self.render, self.limit, self.older = coder, render, limit, {}

    def learn(self, words: set[str]) -> None:
        """Make every word of `words` present."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        # Nothing below makes cycles; collecting them meanwhile would walk the whole memory again and again.
        collecting = gc.isenabled()
        gc.disable()
        try:
            self._fill(words)
        finally:
            if collecting:
                gc.enable()

    def _fill(self, words: set[str]) -> None:
        new = words.difference(self)
        if self.older:
            known = {w: self.older[w] for w in new if w in self.older}
            self.update(known)
            new.difference_update(known)
        fresh = list(new)
        self.update(zip(fresh, map(self.render, self.coder.encode_list(fresh)), strict=True))


_MEMORIES: dict[tuple, WordMemory] = {}
remembers("word_bpe", _MEMORIES.clear)


def word_memory(path: str, kind: str, render: Callable[[WordBpe, list[int]], object], limit: int = 300_000) -> WordMemory:
    """The memory of this worker process for a vocabulary and a kind of rendering; tasks share it."""
    only("word_bpe")
    if (path, kind, limit) not in _MEMORIES:
        coder = next((m.coder for (p, *_), m in _MEMORIES.items() if p == path), None) or WordBpe(path)
        _MEMORIES.clear()
        coder.pieces_kept = limit // 2
        _MEMORIES[path, kind, limit] = WordMemory(coder, lambda ids: render(coder, ids), limit)
    return _MEMORIES[path, kind, limit]
