"""Token ids of many texts by a byte-level BPE vocabulary, a pretoken at a time.

Byte-level BPE splits a text by a fixed pattern and encodes each pretoken alone.
So pretokens are found for a whole run of texts with numpy, and each different
pretoken is encoded once, by the ranks of the same vocabulary. Texts that the
vectorised split doesn't cover (characters from U+2000 on, or a special token
written out) are encoded by the tokenizer as they are. Ids equal ``encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from tradeledger.llm.textbytes import Words, word_hashes

_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_COVERED = 0x2000
# Fixed value: the split of this kind of vocabulary.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_letter() -> dict[str, int]:
    """Vocabulary files write a byte as a printable character: itself, or U+0100 and up in turn."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _classes() -> np.ndarray:
    kinds = np.zeros(_COVERED, np.uint8)
    for code in range(_COVERED):
        kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _OTHER)
    kinds[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680]] = _SPACE
    return kinds


class ByteBpe:
    """``encode_run`` gives the ids of a run of texts. ``memory`` bounds the pretokens kept."""

    def __init__(self, path: str, memory: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        letters = _byte_of_letter()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items() if all(c in letters for c in word)}
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for word, i in ranks.items():
            self.width[i] = len(word)
        added = {t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=_PATTERN, special_tokens={}, mergeable_ranks={w: i for w, i in ranks.items() if w not in added}
        )
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds = _classes()
        self.memory = memory
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode_run(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the offsets of the texts among them."""
        text = data.tobytes().decode("utf-8")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        first = np.searchsorted(place, offsets)
        slow = np.zeros(len(offsets) - 1, bool)
        odd = np.flatnonzero(codes >= _COVERED)
        if len(odd):
            slow[np.searchsorted(first, odd, "right") - 1] = True
        for word in self.special:
            if word in text:
                for d in range(len(slow)):
                    slow[d] |= word in text[first[d] : first[d + 1]]
        starts = self._starts(codes, first)
        begin = place[starts]
        words = Words(data, begin, np.append(begin[1:], len(data)), np.searchsorted(starts, first), offsets)
        ids, bounds = self._look_up(words, slow)
        if slow.any():
            ids, bounds = self._replace(ids, bounds, text, first, np.flatnonzero(slow))
        return ids, bounds

    def _starts(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Positions of characters that begin a pretoken."""
        n = len(codes)
        kind = self.kinds[np.minimum(codes, _COVERED - 1)]
        opens = np.zeros(n + 1, bool)
        opens[first] = True
        start = opens.copy()
        start[1:n] |= kind[1:] != kind[:-1]
        # the last of several spaces stands apart; a blank joins what follows it
        last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~opens[1:n]) if n else np.zeros(0, int)
        start[last] = True
        blank = last[codes[last] == 0x20]
        start[blank + 1] = False
        # 's 't 'm 'd 're 've 'll after anything but a blank are pretokens
        marks = np.flatnonzero(codes[:-1] == 0x27) if n else np.zeros(0, int)
        for i in marks[start[marks]]:
            if opens[i + 1] or kind[i + 1] != _LETTER:
                continue
            one = chr(codes[i + 1])
            two = one + (chr(codes[i + 2]) if i + 2 < n and not opens[i + 2] else "")
            size = 1 if one in "stmd" else 2 if two in ("re", "ve", "ll") else 0
            if size:
                start[i + 1] = False
                start[i + 1 + size] = True
        return np.flatnonzero(start[:n])

    def _look_up(self, words: Words, slow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = word_hashes(words, fold=False)
        keys, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.memory:
            self._forget()
        spot = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = spot < len(self.keys)
        known[inside] = self.keys[spot[inside]] == keys[inside]
        if not known.all():
            self._learn(keys[~known], words, index[~known])
            spot = np.searchsorted(self.keys, keys)
        spot = spot[inverse]
        count = self.count[spot]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(self.at[spot] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[words.first]

    def _learn(self, keys: np.ndarray, words: Words, index: np.ndarray) -> None:
        raw = words.data.tobytes()
        new = [raw[a:b] for a, b in zip(words.start[index].tolist(), words.end[index].tolist(), strict=True)]
        # a blank and letters: strung together, the split finds them again
        strung = np.array([w[:1] == b" " and w[1:].decode().isalpha() for w in new], bool)
        chosen = np.flatnonzero(strung)
        ids = np.array(self.ranks.encode_ordinary(b"".join(new[i] for i in chosen).decode()), np.uint32)
        # no token crosses a pretoken, so byte lengths tell where each one's ids end
        upto = np.cumsum(self.width[ids])
        cuts = np.searchsorted(upto, np.cumsum([len(new[i]) for i in chosen]), "left") + 1
        count = np.zeros(len(new), np.int64)
        count[chosen] = np.diff(cuts, prepend=0)
        rest = np.flatnonzero(~strung)
        parts = [np.array(self.ranks.encode_ordinary(new[i].decode()), np.uint32) for i in rest]
        count[rest] = [len(p) for p in parts]
        order = np.concatenate([chosen, rest])
        at = np.zeros(len(new), np.int64)
        at[order] = len(self.ids) + np.cumsum(count[order]) - count[order]
        self.ids = np.concatenate([self.ids, ids, *parts])
        every = np.concatenate([self.keys, keys])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.at = np.concatenate([self.at, at])[order]
        self.count = np.concatenate([self.count, count])[order]

    def _replace(self, ids, bounds, text, first, which) -> tuple[np.ndarray, np.ndarray]:
        parts = [ids[bounds[d] : bounds[d + 1]] for d in range(len(bounds) - 1)]
        whole = [text[first[d] : first[d + 1]] for d in which]
        for d, got in zip(which, self.tokenizer.encode_batch(whole, add_special_tokens=False), strict=True):
            parts[d] = np.array(got.ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
