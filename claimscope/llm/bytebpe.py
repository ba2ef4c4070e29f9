"""Byte-level BPE ids of many texts: each distinct chunk of text is encoded once a worker.

Texts are cut only where the tokenizer's pre-tokenizer cuts in any context:

- before white space (``[\\x20\\x09-\\x0D]``) that follows a character which is certainly none;
- after one white space other than a space that stands alone, before such a character;
- between an ASCII letter and ASCII punctuation, and behind ASCII punctuation other than an
  apostrophe before an ASCII letter.

A chunk's ids are therefore those it has within its text.  A text that contains the spelling of an
added token goes to the tokenizer whole.

What a worker has learned stays with it for later tasks; a batch looks all of its distinct chunks
up at once.
"""

from __future__ import annotations

import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .idcache import IdCache, Made, runs

#: Chunks given to the tokenizer in one call.
_CALL = 4000
#: Bytes of a long text that are encoded at once, and where the place of a cut is looked for.
STEP = 8 << 20
_BACK = 1 << 16
#: Chunks joined to one text.
_JOIN = 500

_BYTES = np.arange(256)
_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_LETTER = ((_BYTES | 0x20) >= 0x61) & ((_BYTES | 0x20) <= 0x7A) & (_BYTES < 0x80)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_PUNCT = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_LETTER & ~_DIGIT
_SOLID = (_BYTES > 0x20) & (_BYTES < 0x7F)
_APOSTROPHE = 0x27


def cuts(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where chunks begin in the joined texts that begin at ``first`` (texts of no bytes left out)."""
    n = len(raw)
    cut = np.zeros(n, bool)
    if not n:
        return cut
    space, letter, punct = _SPACE[raw], _LETTER[raw], _PUNCT[raw]
    solid = _SOLID[raw] | _ends_letter(raw)
    cut[1:] = space[1:] & solid[:-1]
    alone = np.zeros(n, bool)  # one white space, not a space, behind something solid
    alone[1:] = cut[1:] & (raw[1:] != 0x20)
    cut[1:] |= alone[:-1] & _SOLID[raw[1:]]
    cut[1:] |= letter[:-1] & punct[1:]
    cut[1:] |= punct[:-1] & (raw[:-1] != _APOSTROPHE) & letter[1:]
    cut[first] = True
    return cut


def _ends_letter(raw: np.ndarray) -> np.ndarray:
    """The last byte of a two-byte character from U+00C0 to U+024F but the signs of times and division: a letter."""
    out = np.zeros(len(raw), bool)
    lead = raw[:-1]
    out[1:] = ((lead == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)) | ((lead >= 0xC4) & (lead <= 0xC8))
    return out


class Coded(NamedTuple):
    """Ids of all texts one after the other, and their number per text."""

    ids: np.ndarray
    counts: np.ndarray


class Encoder:
    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(vocab.values()) + 1, bool)  # ids that begin with a space
        self.begins[[i for w, i in vocab.items() if w.startswith("Ġ")]] = True
        self.feeds = np.zeros(len(self.begins), bool)  # the line feed's id
        self.feeds[[i for w, i in vocab.items() if w == "Ċ"]] = True
        self.known = IdCache(self._made)

    def encode(self, texts: pa.Array) -> Coded:
        """Ids of ``texts`` (strings without nulls)."""
        data = [x.as_buffer() for x in texts.cast(pa.large_binary())]
        size = np.fromiter(map(len, data), np.int64, len(data))
        joined = b"".join(data)
        first = np.cumsum(size) - size
        raw = np.frombuffer(joined, np.uint8)
        cut = cuts(raw, first[size > 0])
        for token in self.special:  # such a text is one chunk
            at = joined.find(token)
            while at >= 0:
                t = int(np.searchsorted(first, at, side="right")) - 1
                cut[first[t] + 1:first[t] + size[t]] = False
                at = joined.find(token, int(first[t] + size[t]))
        at = np.flatnonzero(cut)
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw)).astype(np.int64)), pa.py_buffer(raw)])
        coded = chunks.dictionary_encode()
        begin, count, flat = self.known.lookup(coded.dictionary)
        codes = np.asarray(coded.indices, dtype=np.int64)
        if not len(codes):
            return Coded(flat[:0], np.zeros(len(texts), np.int64))
        total = np.concatenate([[0], np.cumsum(count[codes])])
        ends = np.searchsorted(at, np.concatenate([first, [len(raw)]]))
        return Coded(runs(flat, begin[codes], begin[codes] + count[codes]), total[ends[1:]] - total[ends[:-1]])

    def encode_long(self, text: pa.Scalar) -> np.ndarray:
        """Ids of one text, in steps of about ``STEP`` bytes that end before a space behind a solid ASCII character."""
        raw = np.frombuffer(text.cast(pa.large_binary()).as_buffer(), np.uint8)
        made, start = [np.zeros(0, np.uint32)], 0
        while start < len(raw):
            stop = len(raw)
            for back in range(start + STEP, len(raw), STEP):
                near = raw[back - min(_BACK, STEP):back]
                at = np.flatnonzero((near[1:] == 0x20) & _SOLID[near[:-1]])
                if len(at):
                    stop = back - len(near) + int(at[-1]) + 1
                    break
            some = pa.array([raw[start:stop].tobytes()], pa.large_binary()).cast(pa.large_string())
            made.append(self.encode(some).ids)
            start = stop
        return np.concatenate(made)

    def _made(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each chunk, and the ids.

        Chunks of solid characters are encoded joined: those behind a space as they are, others
        behind a line feed each, which is an id of its own there.  Every chunk's first id then shows.
        """
        spelled = chunks.cast(pa.large_string())
        behind = np.asarray(pc.match_substring_regex(spelled, r"^ [\x21-\x7E\p{L}]+$"))
        bare = np.asarray(pc.match_substring_regex(spelled, r"^[\x21-\x7E\p{L}]+$"))
        made = Made(len(chunks))
        for kind, mark, first in ((behind, "", self.begins), (bare, "\n", self.feeds)):
            at = np.flatnonzero(kind)
            lists = [at[k:k + _JOIN] for k in range(0, len(at), _JOIN)]
            joined = [mark + mark.join(spelled.take(pa.array(some)).to_pylist()) for some in lists]
            for some, got in zip(lists, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(got.ids, np.uint32)
                begin = np.flatnonzero(first[ids])
                if len(begin) != len(some) or begin[0]:
                    made.put_each(some, self._each(spelled, some))
                    continue
                size = np.diff(np.append(begin, len(ids)))
                made.put(some, size - 1 if mark else size, np.delete(ids, begin) if mark else ids)
        at = np.flatnonzero(~behind & ~bare)
        for k in range(0, len(at), _CALL):
            made.put_each(at[k:k + _CALL], self._each(spelled, at[k:k + _CALL]))
        return made.result()

    def _each(self, spelled: pa.Array, some: np.ndarray) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(spelled.take(pa.array(some)).to_pylist(), add_special_tokens=False)]


_KEPT: dict[str, Encoder] = {}


def encoder_of(tokenizer: str) -> Encoder:
    """This worker's encoder for the tokenizer file's text; it outlives a task."""
    if tokenizer not in _KEPT:
        _KEPT.clear()
        _KEPT[tokenizer] = Encoder(tokenizer)
    return _KEPT[tokenizer]
