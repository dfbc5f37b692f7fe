"""Token ids of texts by a public byte-level BPE vocabulary, each distinct piece encoded once per worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import SpanHash, Texts, ragged, texts_of

#: A worker's store of encoded pieces is emptied at this many; that costs time, never a result.
STORED = 600_000
_MARK, _LETTER, _PLAIN, _LEAD = (np.zeros(256, bool) for _ in range(4))
_MARK[list(b".,!?;:")] = True
_LETTER[65:91] = _LETTER[97:123] = True
_PLAIN[33:127] = True
_LEAD[0xC3:0xE0] = True  # two-byte characters from U+00C0 on: none is white space


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _before(x: np.ndarray, k: int = 1) -> np.ndarray:
    return np.concatenate([np.zeros(min(k, len(x)), x.dtype), x[: max(len(x) - k, 0)]])


def cuts_of(texts: Texts) -> np.ndarray:
    """Where a text may be cut so that the parts have the ids that the whole has.

    The vocabulary's pattern never joins the two sides of a single space between
    other characters, of a letter and a mark, or of a line end and its neighbours.
    White space of any other form stays inside its part.
    """
    d = texts.data
    high = (d & 0xC0) == 0x80
    after_lead = high & _before(_LEAD[d])
    latin = high & (_before(d) == 0xC3) & (d != 0x97) & (d != 0xB7)
    solid = _PLAIN[d] | after_lead  # the last byte of a character that is no white space
    opens = np.concatenate([(_PLAIN[d] | _LEAD[d])[1:], [False]]) if len(d) else _PLAIN[d]
    letter = _LETTER[d] | latin
    mark, line = _MARK[d], d == 0x0A
    cut = (d == 0x20) & _before(solid) & opens
    cut |= mark & _before(letter)
    cut |= line & _before(letter | mark)
    cut |= _LETTER[d] & _before(line & _before(letter | mark))
    # A text's neighbours in the batch are not its own.
    for near in (-1, 0, 1):
        at = texts.offsets[:-1] + near
        cut[at[(at >= 0) & (at < len(cut))]] = False
    cut = np.append(cut, False)
    cut[texts.offsets] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Encodes texts exactly as the tokenizer would text by text, to 32-bit ids.

    Each distinct piece (told apart by its 64-bit hash) is encoded once; texts with a
    special token are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)  # first id of each piece in the pool
        self.sizes = np.zeros(0, np.int64)
        self.pool: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.pooled = 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and for each piece where its ids start and how many it has."""
        words = [i for i, p in enumerate(pieces) if p[:1] == b" " and p[1:].decode().isalpha()]
        others = sorted(set(range(len(pieces))).difference(words))
        groups = [b"".join(pieces[i] for i in words[k : k + 64]).decode() for k in range(0, len(words), 64)]
        # Only the first id of such a word starts with the space.
        flat = np.concatenate([np.zeros(0, np.uint32), *self._ids(groups)])
        starts = np.zeros(len(pieces), np.int64)
        sizes = np.zeros(len(pieces), np.int64)
        starts[words] = firsts = np.flatnonzero(self.spaced[flat])
        sizes[words] = np.diff(np.append(firsts, len(flat)))
        rest = self._ids([pieces[i].decode() for i in others])
        sizes[others] = lengths = np.fromiter(map(len, rest), np.int64, len(rest))
        starts[others] = len(flat) + np.cumsum(lengths) - lengths
        return np.concatenate([flat, *rest]), starts, sizes

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        ids, starts, sizes = self._encode(pieces)
        places = self.pooled + starts
        self.pool.append(ids)
        self.pooled += len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.places = np.insert(self.places, at, places)
        self.sizes = np.insert(self.sizes, at, sizes)

    def _plain(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        starts = cuts_of(texts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts.offsets), np.int64)
        ends = np.append(starts[1:], len(texts.data))
        keys, first, which = np.unique(SpanHash(texts.data)(starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > STORED:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            raw = texts.data.tobytes()
            self._learn(keys[new], [raw[a:b] for a, b in zip(starts[first[new]], ends[first[new]], strict=True)])
            at = np.searchsorted(self.keys, keys)
        if len(self.pool) > 1:
            self.pool = [np.concatenate(self.pool)]
        counts = self.sizes[at][which]
        ids = self.pool[0][ragged(self.places[at][which], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[np.searchsorted(starts, texts.offsets)]

    def __call__(self, column: pa.Array, limit: int = 2 << 20):
        """For runs of whole texts: their rows, all their ids, and the offsets of each text. A null text is empty."""
        odd = np.zeros(len(column), bool)
        for token in self.special:
            odd |= pc.fill_null(pc.match_substring(column, token), False).to_numpy(zero_copy_only=False)
        for texts in texts_of(column, limit):
            ids, offsets = self._plain(texts)
            if odd[texts.rows].any():
                raw = texts.data.tobytes()
                parts = [
                    self._ids([raw[texts.offsets[k] : texts.offsets[k + 1]].decode()])[0] if odd[row] else ids[offsets[k] : offsets[k + 1]]
                    for k, row in enumerate(texts.rows)
                ]
                ids, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            yield texts.rows, ids, offsets


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, which lives on from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
