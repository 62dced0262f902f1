"""BPE encoding by speculation and verification, and decoding.

A greedy longest match proposes a word's tokens. The proposal is the BPE encoding exactly if no
merge would ever cross the border of two adjacent tokens; that is a property of the pair alone, so
each distinct pair is tested once, in vectorised batches. Words with a failing pair are merged
exactly. White-space separated words are found by their 64-bit hash in a table of encoded words, which each
worker keeps up to ``KEPT_WORDS``.

A null or empty text has no ids. Special tokens written in a text become their id, as in the
library's default.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .words import SPACE, claim_memory, hash_spans, release_memory, separator_table, text_runs

KEPT_WORDS = 1_500_000  # encoded words a worker remembers by hash (some 60 bytes each); beyond, it begins again
CHUNK_BYTES = 2 << 20  # bytes of text encoded together
LATIN_END = "\u024f"
END = 256  # symbol of a word's end
NEVER = np.iinfo(np.int64).max


_SPACE = separator_table(SPACE)


def gather(values: np.ndarray, begins: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the runs ``at`` of values one after the other, their lengths); run i is values[begins[i]:begins[i + 1]]."""
    lengths = begins[at + 1] - begins[at]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begins[at] - ends + lengths, lengths)], lengths


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free letter from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class WordBpe:
    """A BPE vocabulary whose words end in a marker, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.line_pattern = regex.compile(pattern + "|\n")
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.size = max(chain(self.ids.values(), self.special.values())) + 1
        self.text = [""] * self.size
        for word, i in chain(self.ids.items(), self.special.items()):
            self.text[i] = word
        self.letters = byte_letters()
        self._load_merges([tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]])
        self.library = Tokenizer.from_file(path)
        self.forget()

    def _load_merges(self, merges: list[tuple[str, str]]) -> None:
        ids, size = self.ids, self.size
        left, right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.made = np.full(size, NEVER, np.int64)  # rank of the merge that makes a token
        keys, made = [], []
        for rank, (a, b) in enumerate(merges):
            x, y, z = ids[a], ids[b], ids[a + b]
            left[z], right[z], self.made[z] = x, y, rank
            keys.append(x * size + y)
            made.append(z)
        keys, self.merged = np.array(keys, np.int64), np.array(made, np.int64)  # pair and token by rank
        ranks = np.arange(len(keys))
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], ranks[order]
        self.right_edge, self.left_edge = self._edges(right), self._edges(left)
        inner = np.flatnonzero(left >= 0)
        # a merged token can be proposed only if its own two parts meet at no earlier merge than its own
        sound = self._first_crossing(left[inner], right[inner]) == self.made[inner]
        broken = set(inner[~sound].tolist())
        for t in sorted(inner.tolist(), key=lambda t: self.made[t]):
            if left[t] in broken or right[t] in broken:
                broken.add(t)
        self._load_trie([(w, i) for w, i in ids.items() if i not in broken])

    def _load_trie(self, entries: list[tuple[str, int]]) -> None:
        """The vocabulary as a trie: edges are node * 512 + symbol, a word's end is a symbol of its own."""
        self.symbol = np.zeros(512, np.int64)
        for b, c in enumerate(self.letters):
            self.symbol[ord(c)] = b
        edges: dict[int, int] = {}
        token = [-1]
        for word, i in entries:
            ended = bool(self.end) and word.endswith(self.end)
            node = 0
            for c in [*self.symbol[[ord(x) for x in word.removesuffix(self.end)]].tolist(), *[END] * ended]:
                key = node << 9 | c
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                node = edges[key]
            token[node] = i
        self.trie_keys = np.array(sorted(edges), np.int64)
        self.trie_next = np.array([edges[k] for k in self.trie_keys.tolist()], np.int64)
        self.trie_token = np.array(token, np.int64)
        # tokens of single letters, within a word and at its end
        self.letter_ids = np.array([[self.ids[c], self.ids[c + self.end]] for c in self.letters], np.int64)

    def _edges(self, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token, the tokens that stand at that edge while it is built, and the rank that consumes each."""
        tokens, consumed = [np.arange(self.size)], [np.full(self.size, NEVER)]
        while True:
            at = tokens[-1]
            below = np.where(at >= 0, child[at], -1)
            if (below < 0).all():
                return np.stack(tokens, 1), np.stack(consumed, 1)
            consumed.append(np.where(below >= 0, self.made[at], -1))
            tokens.append(below)

    def _first_crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the first merge across the border of a and b, NEVER without one."""
        out = np.empty(len(a), np.int64)
        for low in range(0, len(a), 4096):
            x, gone_x = (t[a[low:low + 4096]][:, :, None] for t in self.right_edge)
            y, gone_y = (t[b[low:low + 4096]][:, None, :] for t in self.left_edge)
            keys = np.where((x >= 0) & (y >= 0), x * self.size + y, -1)
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)
            # equal ranks merge from the left: x must still be there strictly before, y may go at the same rank
            out[low:low + 4096] = np.where((rank < gone_x) & (rank <= gone_y), rank, NEVER).min(axis=(1, 2))
        return out

    def propose(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, word of each): longest vocabulary entries from left to right, for all words at once.

        ``symbols`` holds the words one after the other, each with END behind it.
        """
        n = len(symbols)
        length, token = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        at = np.flatnonzero(symbols != END)
        node = np.zeros(len(at), np.int64)
        depth = 0
        while len(at):
            keys = node << 9 | symbols[at + depth]
            place = np.minimum(np.searchsorted(self.trie_keys, keys), len(self.trie_keys) - 1)
            found = self.trie_keys[place] == keys
            at, node = at[found], self.trie_next[place[found]]
            depth += 1
            here = self.trie_token[node]
            # an entry must take a word's end along with its last letter
            closed = symbols[at + depth - 1] == END
            whole = (here >= 0) & (closed | (symbols[np.minimum(at + depth, n - 1)] != END))
            length[at[whole]], token[at[whole]] = depth, here[whole]
            at, node = at[~closed], node[~closed]
        words = np.arange(len(bounds) - 1)
        cursor, tokens, owners = bounds[:-1].copy(), [], []
        while len(words):
            tokens.append(token[cursor])
            owners.append(words)
            cursor = cursor + length[cursor]
            more = cursor < bounds[words + 1]
            words, cursor = words[more], cursor[more]
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], owner[order]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def merge(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, word of each) by exact merging: in every word, lowest rank first, leftmost among equals."""
        sizes = np.diff(bounds) - 1
        n, width = len(sizes), int(sizes.max())
        column = np.arange(width)
        inside = column[None, :] < sizes[:, None]
        letters = symbols[np.minimum(bounds[:-1, None] + column, len(symbols) - 1)] * inside
        at = self.letter_ids[letters, (column[None, :] == sizes[:, None] - 1).astype(np.int64)]
        after = np.where(column[None, :] + 1 < sizes[:, None], column[None, :] + 1, -1).astype(np.int32)
        before = np.broadcast_to(column - 1, (n, width)).astype(np.int32).copy()
        rank = np.full((n, width), NEVER)
        rank[:, :-1] = np.where(after[:, :-1] >= 0, self._ranks(at[:, :-1], at[:, 1:]), NEVER)
        row = np.arange(n)
        while len(row):
            i = rank[row].argmin(1)
            best = rank[row, i]
            row, i, best = row[best < NEVER], i[best < NEVER], best[best < NEVER]
            at[row, i] = self.merged[best]
            gone = after[row, i]
            inside[row, gone] = False
            rank[row, gone] = NEVER
            right = after[row, gone]
            after[row, i] = right
            there = right >= 0
            before[row[there], right[there]] = i[there]
            rank[row, i] = np.where(there, self._ranks(at[row, i], at[row, np.maximum(right, 0)]), NEVER)
            left = before[row, i]
            there = left >= 0
            rank[row[there], left[there]] = self._ranks(at[row[there], left[there]], at[row[there], i[there]])
        owner, place = np.nonzero(inside)
        return at[owner, place], owner

    def encode_symbols(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each pre-token's ids begin): propose, verify all adjacent pairs, merge the failing words."""
        count = len(bounds) - 1
        if not count:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        token, owner = self.propose(symbols, bounds)
        border = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, inverse = np.unique(token[border] * self.size + token[border + 1], return_inverse=True)
        fine = self._first_crossing(pairs // self.size, pairs % self.size) == NEVER
        failing = np.zeros(count, bool)
        failing[owner[border[~fine[inverse]]]] = True
        tokens, owners = [token[~failing[owner]]], [owner[~failing[owner]]]
        sizes = np.diff(bounds)
        for low, high in ((0, 13), (13, 25), (25, 1 << 40)):  # words of like length together
            chosen = np.flatnonzero(failing & (sizes >= low) & (sizes < high))
            for part in np.split(chosen, range(4096, len(chosen), 4096)) if high < 100 else chosen[:, None]:
                if len(part):
                    ends = np.cumsum(sizes[part])
                    taken = np.arange(int(ends[-1])) + np.repeat(bounds[part] - ends + sizes[part], sizes[part])
                    own, who = self.merge(symbols[taken], np.concatenate([[0], ends]))
                    tokens.append(own)
                    owners.append(part[who])
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(tokens)[order], np.searchsorted(owner[order], np.arange(count + 1))

    def _odd(self, raw: str) -> bool:
        """Whether a word needs the library's Unicode tables, or holds a special token."""
        return max(raw) > LATIN_END or not raw.isprintable() or ("<|" in raw and bool(self.special_pattern.search(raw)))

    def _learn_plain(self, raw: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each word's begin) of Latin words: lower-cased, composed and cut into pre-tokens all at once."""
        lowered = unicodedata.normalize("NFC", "\n".join(raw)).lower()
        index: dict[str, int] = {"\n": 0}
        codes = np.array([index.setdefault(t, len(index)) for t in self.line_pattern.findall(lowered)], np.int64)
        pieces = list(index)[1:]
        content = np.frombuffer("\0".join(pieces).encode() + b"\0", np.uint8) if pieces else np.zeros(0, np.uint8)
        symbols = np.where(content == 0, END, content.astype(np.int64))
        ids, begins = self.encode_symbols(symbols, np.concatenate([[0], np.flatnonzero(content == 0) + 1]))
        owner = np.cumsum(codes == 0)[codes > 0]
        out, lengths = gather(ids, begins, codes[codes > 0] - 1)
        sizes = np.bincount(owner, lengths, minlength=len(raw)).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(sizes)])

    def _learn_odd(self, raw: str) -> np.ndarray:
        out = []
        for part in self.special_pattern.split(raw):
            if part in self.special:
                out.append(np.array([self.special[part]]))
            elif part:
                words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                symbols = [np.append(self.symbol[[ord(c) for c in w]], END) for w, _ in words]
                out.append(self.encode_symbols(np.concatenate([np.zeros(0, np.int64), *symbols]),
                                               np.cumsum([0, *map(len, symbols)]))[0])
        return np.concatenate([np.zeros(0, np.int64), *out])

    def learn(self, keys: np.ndarray, raw: list[str]) -> None:
        """Encode words not met before and remember them by their hash."""
        odd = np.fromiter(map(self._odd, raw), bool, len(raw))
        plain = np.flatnonzero(~odd)
        ids, begins = self._learn_plain([raw[i] for i in plain]) if len(plain) else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        rest = [self._learn_odd(raw[i]) for i in np.flatnonzero(odd)]
        order = np.concatenate([plain, np.flatnonzero(odd)])
        begins = np.concatenate([begins, begins[-1] + np.cumsum([len(r) for r in rest])]) if rest else begins
        slots = len(self.begins) - 1 + np.argsort(order)
        self.begins = np.concatenate([self.begins, self.begins[-1] + begins[1:]]).astype(np.int64)
        self.ids_of = np.concatenate([self.ids_of, ids.astype(np.int32), *[r.astype(np.int32) for r in rest]])
        place = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, place, keys), np.insert(self.slots, place, slots)

    def forget(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begins, self.ids_of = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def encode_array(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, where each text's begin) for runs of about CHUNK_BYTES of texts; new words of a run are learned together."""
        claim_memory(self)
        for part in text_runs(texts, CHUNK_BYTES):
            found = hash_spans(part, _SPACE, fold=False)
            distinct, first, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
            if len(self.keys) > KEPT_WORDS:
                self.forget()
            place = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
            new = self.keys[place] != distinct if len(self.keys) else np.ones(len(distinct), bool)
            if new.any():
                content = found.content.tobytes()
                at = first[new]
                raw = [content[a:b].decode() for a, b in zip(found.first[at].tolist(), (found.first + found.length)[at].tolist())]
                self.learn(distinct[new], raw)
                place = np.searchsorted(self.keys, distinct)
            out, lengths = gather(self.ids_of, self.begins, self.slots[place][inverse])
            yield out, np.concatenate([[0], np.cumsum(lengths)])[found.bounds]

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        for ids, begins in self.encode_array(pa.array(texts, pa.string())):
            for a, b in zip(begins[:-1], begins[1:]):
                yield ids[a:b].tolist()

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_batch([text]))

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' texts joined by single spaces, as the library decodes without a decoder."""
        return " ".join(map(self.text.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One vocabulary per worker process."""
    return WordBpe(path)


def _listed(bpe: WordBpe, texts: pa.Array) -> pa.Array:
    parts, begins = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for own, at in bpe.encode_array(texts):
        parts.append(own)
        begins.append(begins[-1][-1] + at[1:])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(begins).astype(np.int32)), pa.array(np.concatenate(parts)))


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column, array<int>. A worker forgets the words it met at the end of its task."""
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield _listed(load(path), texts)
        finally:
            release_memory()
    return ids(text)


def round_trip(text: Column, path: str) -> Column:
    """struct<ids: array<int>, decoded_sha256: string>: ``encode``, and the digest of the UTF-8 text that ``decode`` makes of the ids, by
    one worker a task instead of two."""
    kind = "struct<ids:array<int>,decoded_sha256:string>"

    @F.arrow_udf(kind)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        try:
            for texts in batches:
                lists = _listed(bpe, texts)
                digests = [hashlib.sha256(bpe.decode(x.values.to_numpy().tolist()).encode()).hexdigest() for x in lists]
                yield pa.StructArray.from_arrays([lists, pa.array(digests, pa.string())], names=["ids", "decoded_sha256"])
        finally:
            release_memory()
    return both(text)


def decode(ids: Column, path: str) -> Column:
    """Text of a column of token ids; null for null."""
    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        try:
            for lists in batches:
                yield pa.array([bpe.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in lists], pa.string())
        finally:
            release_memory()
    return texts(ids)
