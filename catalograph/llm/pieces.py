"""Byte-level BPE over Arrow batches, each distinct piece of a batch encoded once.

The split pattern of these vocabularies always breaks before a single blank
that has a non-blank on both sides, and nothing across that break changes the
tokens. A text is therefore cut there; the pieces of a batch are numbered by
Arrow's dictionary encoding, new ones go through the tokenizers library, and
the ids of the whole text are gathered. Texts with other blanks around a blank
are cut by a regular expression at the same places.
"""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The pieces that a worker keeps for one vocabulary, by the bytes they take with their entries.
CACHE_BYTES = 64 << 20
_ENTRY_BYTES = 250
# A comma or a full stop after an ASCII letter is always a token of its own.
_TAILS = (ord(","), ord("."))
_BREAK = re.compile(r"(?<=\S) (?=\S)")


@functools.cache
def byte_characters() -> tuple[str, ...]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the characters from
    U+0100 on, in order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {b: chr(b) for b in own}
    for b in range(256):
        if b not in shown:
            shown[b] = chr(256 + len(shown) - len(own))
    return tuple(shown[b] for b in range(256))


def as_characters(token: bytes) -> str:
    table = byte_characters()
    return "".join(table[b] for b in token)


@functools.cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.cache
def tokenizer_of(path: str):
    """A tokenizer of the tokenizers library, from its own file or from a rank file.

    A rank file names no merges. Every way to cut a token into two tokens is a
    merge, with the rank of the whole, so that any neighbours whose union is a
    token can meet, as with ranks.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    if not path.endswith(".tiktoken"):
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return tokenizer
    ranks = read_ranks(path)
    merges = [(as_characters(token[:cut]), as_characters(token[cut:]))
              for token, _ in sorted(ranks.items(), key=lambda item: item[1])
              for cut in range(1, len(token)) if token[:cut] in ranks and token[cut:] in ranks]
    vocabulary = {as_characters(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    return tokenizer


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of values[start:start+length]."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


class _Known:
    """Pieces seen so far, with their ids in one array; over ``CACHE_BYTES`` they are forgotten before the next call."""

    def __init__(self, tokenizer, prefix: str):
        self.tokenizer, self.prefix = tokenizer, prefix
        self.sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
            self.sizes[i] = len(token)
        self.clear()

    def clear(self):
        self.row: dict[str, int] = {}
        self.bytes = 0
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.odd = np.zeros(0, bool)

    def _odd(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(
            [self.prefix + p for p in pieces], add_special_tokens=False)]
        return (np.array([i for ids in found for i in ids], np.int32),
                np.fromiter(map(len, found), np.int64, len(found)))

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of clean pieces, many in one call; a token's bytes tell whose it is."""
        groups = [" " + " ".join(pieces[i:i + 128]) for i in range(0, len(pieces), 128)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(
            groups, add_special_tokens=False)])
        token_ends = np.cumsum(self.sizes[ids])
        ends = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in pieces), np.int64, len(pieces)))
        return ids, np.diff(np.searchsorted(token_ends, ends, "right"), prepend=0)

    def rows(self, pieces: list[str]) -> np.ndarray:
        """Row of each distinct piece; new ones are encoded together."""
        if self.bytes > CACHE_BYTES:
            self.clear()
        known = self.row
        new = [p for p in pieces if p not in known]
        if new:
            self.bytes += sum(map(len, new)) + _ENTRY_BYTES * len(new)
            odd = np.fromiter((not p or p[0].isspace() or p[-1].isspace() for p in new), bool, len(new))
            ids, lengths = self._odd(new) if odd.any() or not self.prefix else self._joined(new)
            base = len(known)
            known.update(zip(new, range(base, base + len(new))))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, ids])
            self.odd = np.concatenate([self.odd, odd])
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))


class PieceEncoder:
    """Ids of whole texts, as the tokenizer would give them for each text alone."""

    def __init__(self, path: str):
        tokenizer = tokenizer_of(path)
        self.first, self.later = _Known(tokenizer, ""), _Known(tokenizer, " ")
        self.tails = np.full(256, -1, np.int32)
        for byte in _TAILS:
            self.tails[byte] = tokenizer.encode(chr(byte), add_special_tokens=False).ids[0]

    def _later(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(id of the split-off last character or -1, row of the rest) of each distinct piece."""
        _, where, data = names.buffers()
        ends = np.frombuffer(where, np.int64)[names.offset:names.offset + len(names) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        size, last = np.diff(ends), ends[1:] - 1
        tail = self.tails[data[np.maximum(last, 0)]]
        letter = data[np.maximum(last - 1, 0)] | 0x20
        tail[(size < 2) | (letter < 97) | (letter > 122)] = -1
        rest = pc.if_else(pa.array(tail >= 0), pc.utf8_rtrim(names, characters=",."), names).dictionary_encode()
        return tail, self.later.rows(strings(rest.dictionary))[rest.indices.to_numpy()]

    def _text(self, text: str) -> np.ndarray:
        first, *later = _BREAK.split(text) if text else [""]
        rows = self.first.rows([first])
        head = gather(self.first.ids, self.first.starts[rows], self.first.lengths[rows])
        if not later:
            return head
        out = [head]
        for i in range(0, len(later), 100_000):
            names = {p: k for k, p in enumerate(dict.fromkeys(later[i:i + 100_000]))}
            rows = self.later.rows(list(names))[[names[p] for p in later[i:i + 100_000]]]
            out.append(gather(self.later.ids, self.later.starts[rows], self.later.lengths[rows]))
        return np.concatenate(out)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, row offsets into them); null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        if not n:
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        numbered = cut.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        names, which = numbered.dictionary, numbered.indices.to_numpy()
        heads = which[bounds[:-1]]
        uniq, back = np.unique(heads, return_inverse=True)
        first = self.first.rows(strings(names.take(pa.array(uniq))))[back]
        tail, later = self._later(names)
        odd_rows = np.flatnonzero(np.add.reduceat(self.later.odd[later][which], bounds[:-1]))
        if len(odd_rows) == n:
            parts = [self._text(t) for t in texts.to_pylist()]
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        # one pool: the ids of first pieces stand behind those of later ones
        pool = np.concatenate([self.later.ids, self.first.ids, np.zeros(1, np.int32)])
        tails = tail[which]
        tails[bounds[:-1]] = -1
        starts = self.later.starts[later][which]
        lengths = self.later.lengths[later][which] + (tails >= 0)
        starts[bounds[:-1]] = self.first.starts[first] + len(self.later.ids)
        lengths[bounds[:-1]] = self.first.lengths[first]
        ids = gather(pool, starts, lengths)
        tailed = tails >= 0
        ids[np.cumsum(lengths)[tailed] - 1] = tails[tailed]
        counts = np.add.reduceat(lengths, bounds[:-1])
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        if len(odd_rows):
            parts = np.split(ids, offsets[1:-1])
            for k in odd_rows:
                parts[k] = self._text(texts[int(k)].as_py())
            ids = np.concatenate(parts)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return ids, offsets


@functools.cache
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def batches(texts: pa.Array, limit: int):
    """Slices of whole texts of about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, begin = np.cumsum(sizes), 0
    while begin < len(texts):
        base = ends[begin - 1] if begin else 0
        end = min(max(int(np.searchsorted(ends, base + limit, "right")), begin + 1), len(texts))
        yield texts.slice(begin, end - begin)
        begin = end
