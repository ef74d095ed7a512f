"""Token ids of whole texts, piece by piece, for vocabularies whose pre-tokens do not depend on
their surroundings.

A text is cut where the tokenizer's own pattern always ends a pre-token: at ASCII white space,
between a letter and ASCII punctuation or a digit, and after punctuation other than an apostrophe
(which may begin a contraction). Pieces are hashed to 64 bits with A-Z folded, as the vocabulary is
lower case, and looked up in a table of fixed size; what is missing there is encoded by the
tokenizers library: pieces of letters alone many at a time, all others one by one with the whole
chain of the file. Bytes that are neither ASCII nor Latin-1 letters are never cut apart. A
vocabulary with another chain is encoded text by text.
"""

from __future__ import annotations

import json
import os

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from tablework.llm.words import SPACE, Part, words

SLOTS = 20  # bits: a million pieces are remembered at most, in 16 MB of each Python worker
POOL_IDS = 2 << 20  # ids remembered before the store starts anew, in up to 16 MB
AT_ONCE = 256  # pieces of letters in one call

# The chain that may be cut into pieces as told above.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_WORD_END = "</w>"

_ASCII = np.arange(256)
_LETTER = ((_ASCII >= 65) & (_ASCII <= 90)) | ((_ASCII >= 97) & (_ASCII <= 122))
_DIGIT = (_ASCII >= 48) & (_ASCII <= 57)
_MARK = (_ASCII > 32) & (_ASCII < 127) & ~_LETTER & ~_DIGIT
_AFTER_C3 = (_ASCII >= 0x80) & (_ASCII <= 0xBF) & (_ASCII != 0x97) & (_ASCII != 0xB7)


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to an ASCII or Latin-1 letter."""
    found = _LETTER[data]
    lead = (data[:-1] == 0xC3) & _AFTER_C3[data[1:]]
    found[:-1] |= lead
    found[1:] |= lead
    return found


def _cuts(data: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Places before which a pre-token has always ended."""
    digit, mark = _DIGIT[data], _MARK[data]
    plain = letter | digit | mark
    found = np.zeros(len(data), bool)
    a, b = slice(None, -1), slice(1, None)
    found[1:] = (letter[a] & (digit[b] | mark[b])) | (mark[a] & (data[a] != 0x27) & letter[b])
    found[1:] |= plain[a] & plain[b] & (digit[a] | digit[b])
    return found


def _by_piece(chain: dict) -> bool:
    steps = (chain.get("normalizer") or {}).get("normalizers") or []
    splits = (chain.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        [s.get("type") for s in steps] == _NORMALIZERS
        and splits[0].get("pattern") == {"Regex": _PATTERN}
        and chain["model"].get("end_of_word_suffix") == _WORD_END
    )


class TokenIds:
    """Ids under one vocabulary file. What has been looked up stays for later calls."""

    def __init__(self, path: str):
        self._whole = Tokenizer.from_file(path)
        self.size = self._whole.get_vocab_size()
        chain = json.loads(self._whole.to_str())
        self._pieces = _by_piece(chain)
        # The strings of special tokens in a text are never cut by the rule above.
        self._special = [x["content"].encode() for x in chain["added_tokens"]]
        if not self._pieces:
            return
        self._letters = Tokenizer(self._whole.model)  # the same vocabulary, held once
        self._letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self._ends = np.zeros(self.size, bool)
        for token, number in self._whole.get_vocab().items():
            self._ends[number] = token.endswith(_WORD_END)
        self._keys = np.zeros(1 << SLOTS, np.uint64)
        self._starts = np.zeros(1 << SLOTS, np.int32)
        self._counts = np.zeros(1 << SLOTS, np.int32)
        self._pool = np.zeros(1 << 16, np.uint32)
        self._used = 0

    def of(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a part one after another, and where each row begins and ends."""
        if not self._pieces or any(s in part.data.tobytes() for s in self._special):
            return self._of_texts(part)
        if self._used > POOL_IDS:
            self._keys[:] = 0
            self._used = 0
        if len(part.data) < 2:
            part = Part(part.first, np.append(part.data, np.uint8([32, 32])), part.offsets)
        letter = _letters(part.data)
        found = words(part, cuts=_cuts(part.data, letter))
        slots = (found.hashes >> np.uint64(64 - SLOTS)).astype(np.int64)
        starts, counts = self._starts[slots], self._counts[slots]
        missing = np.flatnonzero(self._keys[slots] != found.hashes)
        if len(missing):
            _, first, same = np.unique(found.hashes[missing], return_index=True, return_inverse=True)
            first = missing[first]
            at, n = self._encoded(part, found.starts[first], found.ends[first], letter)
            starts[missing], counts[missing] = at[same], n[same]
            self._keys[slots[first]] = found.hashes[first]
            self._starts[slots[first]], self._counts[slots[first]] = at, n
        to = np.cumsum(counts)
        total = int(to[-1]) if len(to) else 0
        ids = self._pool[np.repeat(starts - (to - counts), counts) + np.arange(total)]
        return ids, np.append(0, to)[found.rows]

    def _of_texts(self, part: Part) -> tuple[np.ndarray, np.ndarray]:
        texts = [part.text(i).decode() for i in range(len(part))]
        found = [x.ids for x in self._whole.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.array([i for x in found for i in x], np.uint32)
        return ids, np.cumsum([0] + [len(x) for x in found])

    def _encoded(self, part, starts, ends, letter) -> tuple[np.ndarray, np.ndarray]:
        """Encode new pieces; where their ids lie in the pool, and how many there are."""
        other = np.append(0, np.cumsum(~letter))
        plain = other[ends] == other[starts]
        counts = np.zeros(len(starts), np.int64)
        raw = part.data.tobytes()
        pieces = [raw[a:b].decode() for a, b in zip(starts[plain].tolist(), ends[plain].tolist())]
        lines = [" ".join(pieces[i : i + AT_ONCE]).lower() for i in range(0, len(pieces), AT_ONCE)]
        found = self._letters.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array([i for x in found for i in x.ids], np.uint32)
        last = np.flatnonzero(self._ends[ids])
        if len(last) != len(pieces):
            raise ValueError("a piece of letters is not one pre-token of this vocabulary")
        counts[plain] = np.diff(last, prepend=-1)
        pieces = [raw[a:b].decode() for a, b in zip(starts[~plain].tolist(), ends[~plain].tolist())]
        found = [x.ids for x in self._whole.encode_batch_fast(pieces, add_special_tokens=False)]
        counts[~plain] = [len(x) for x in found]
        at = np.zeros(len(starts), np.int64)
        at[plain] = self._kept(ids) + np.append(0, last + 1)[:-1]
        rest = self._kept(np.array([i for x in found for i in x], np.uint32))
        at[~plain] = rest + np.cumsum(counts[~plain]) - counts[~plain]
        return at, counts

    def _kept(self, ids: np.ndarray) -> int:
        """Put ids at the end of the pool; where they begin there."""
        begin, end = self._used, self._used + len(ids)
        if end > len(self._pool):
            self._pool = np.append(self._pool[:begin], np.zeros(2 * end - begin, np.uint32))
        self._pool[begin:end] = ids
        self._used = end
        return begin


_open: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The store of this Python worker; tasks that it runs one after another share it. A task has one
    core: threads of the library for all cores of the machine would only add their memory."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _open:
        _open[path] = TokenIds(path)
    return _open[path]
