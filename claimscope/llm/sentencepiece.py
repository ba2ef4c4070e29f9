"""SentencePiece encoding and decoding as a relational lattice.

Encoding, for the distinct words of blocks of documents:

1. Words: the text with a space in front is cut before every run of spaces, around every line feed,
   and between neighbouring characters that no piece has side by side (mostly before punctuation).
   No piece of a supported model crosses such a cut, so words are independent.
2. Explode: substrings of a word are rows: every character, and from it on what may begin a piece
   (a bit array of the beginnings of all pieces says no, or maybe).
3. Equi-join: substrings join the piece table (a fixed vocabulary, broadcast).  A single
   character without a piece is an unknown edge, as in the library.  Pieces that other pieces
   spell at a better total score are on no best path and left out of the table (``winners``).
4. Group: the edges of a word are collected.
5. Fold: Viterbi over the collected edges, for all words of an Arrow batch position by position, keeping
   each position's best score and edge; a second fold walks back.  On equal scores the longer piece
   stays.  Unknown characters become byte pieces (or the unknown id).
6. The words' ids return to their blocks, which put their documents together.

Words and ids move packed, one row per block and bucket of words.  A word is encoded once per zone
(the blocks of ``ZONE`` tasks), and a zone bounds the places collected for it, so a word that stands
in every document is no unbounded group.

The result is the library's for a unigram model.  The scores of a BPE model (the public
32k model is one) are used in the same way: the segmentation has the best total score, which
need not be the one that BPE merges reach; decoding gives the same text.

Decoding: pieces are looked up by id, byte pieces are bytes, and the space in front goes.

Edge cases: a null or empty text has no ids.  U+2581 in a text is a space, as in the library, so such a text
does not decode to itself.  Bytes that are no UTF-8 decode to U+FFFD.  A word longer than ``LONG`` bytes (a text without
spaces) is cut about every ``SPAN`` characters at places where its best segmentation has an end of a piece; such parts are
best segmented each on its own.  The places come from a pass that keeps the scores of the last positions only, so a word
costs time and memory in proportion to its length, and no row of the lattice grows with it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lists, sha256_hex, shuffle_partitions
from .words import mix, parts, texts_of

#: Text of a block, in bytes.
BLOCK_BYTES = 14 << 20
#: Tasks whose blocks are a zone.
ZONE = 4096
#: A place is task << 36 | block of the task << 24 | word of the block.
_WORD_BITS, _TASK_SHIFT = 24, 36
#: Buckets of words per shuffle partition: several, so that partitions come out alike.
SPREAD = 8
#: Bits of the array that knows the beginnings of pieces, as a power of two, and the factors of its hash.
_BEGIN_BITS, _STEP, _SPREAD_BITS = 22, 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: A reach travels as the character with this number more.
_REACH = 48
#: Places, and ids, that a task packs at a time on their way back.
_BACK_PLACES, _BACK_IDS = 1 << 19, 1 << 22
#: Pieces of a vocabulary at most: what is broadcast.
MOST_PIECES = 1 << 20
#: Bytes from which a word is cut, and characters of a part at least.
LONG, SPAN = 1024, 256
_MARK = "▁"
#: What an unknown character costs beside the smallest score, fixed in the library.
_UNKNOWN_PENALTY = 10.0


class Pieces(NamedTuple):
    """(text, id, score) of the ordinary pieces, ids of the byte pieces, unknown id, hex bytes of every id."""

    rows: list[tuple[str, int, float]]
    bytes_from: int
    unknown: int
    hexes: list[str]


def load_pieces(path: str) -> Pieces:
    """The piece table of a model file with the identity normaliser."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
        raise ValueError("only models with the identity normaliser and a space in front are supported")
    kind = pb.ModelProto.SentencePiece
    rows, hexes, bytes_from = [], [], -1
    for i, p in enumerate(model.pieces):
        text = p.piece.replace(_MARK, " ")
        if p.type == kind.BYTE:
            bytes_from = i if p.piece == "<0x00>" else bytes_from
            hexes.append(p.piece[3:5])
        elif p.type in (kind.CONTROL, kind.UNKNOWN, kind.UNUSED):
            hexes.append("" if p.type == kind.CONTROL else "20E2818720" if p.type == kind.UNKNOWN else text.encode().hex())
        else:
            if "\n" in text or " " in text.lstrip(" "):
                raise ValueError(f"piece {i} crosses a word boundary")
            rows.append((text, i, float(p.score)))
            hexes.append(text.encode().hex())
    if len(model.pieces) > MOST_PIECES:
        raise ValueError(f"more than {MOST_PIECES} pieces")
    return Pieces(rows, bytes_from, model.trainer_spec.unk_id, hexes)


class _Table(NamedTuple):
    """Pieces; (text, id) of those that can win; which byte may follow which inside such a piece; their beginnings
    as a bit array; the longest; the score by id + 1, of an unknown character by 0."""

    pieces: Pieces
    rows: list[tuple[str, int]]
    joined: np.ndarray
    begins: np.ndarray
    longest: int
    scores: np.ndarray


def winners(pieces: Pieces) -> list[tuple[str, int]]:
    """The pieces that can be on a best path: those that no other pieces spell at a better total score."""
    unknown = min(s for _, _, s in pieces.rows) - _UNKNOWN_PENALTY
    kept: dict[str, float] = {}
    for text, _, score in sorted(pieces.rows, key=lambda r: len(r[0])):
        n = len(text)
        best = [0.0] + [-np.inf] * n
        for end in range(1, n + 1):
            for start in range(1 if end == n else 0, end):
                price = kept.get(text[start:end], unknown if end - start == 1 else None)
                if price is not None and best[start] + price > best[end]:
                    best[end] = best[start] + price
        if n == 1 or best[n] <= score + 1e-6 * max(1.0, abs(score)):  # on a tie, or nearly, the piece stays
            kept[text] = score
    return [(t, i) for t, i, _ in pieces.rows if t in kept]


def _table(pieces: Pieces) -> _Table:
    rows, joined, begins = winners(pieces), np.zeros(1 << 16, bool), set()
    scores = np.full(len(pieces.hexes) + 1, min(s for _, _, s in pieces.rows) - _UNKNOWN_PENALTY)
    for _, i, score in pieces.rows:
        scores[i + 1] = score
    for text, _ in rows:
        raw = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
        joined[raw[:-1] << 8 | raw[1:]] = True
        h = ord(text[0])
        for c in text[1:]:
            h = (h * _STEP + ord(c)) & (1 << 64) - 1
            begins.add((h * _SPREAD_BITS & (1 << 64) - 1) >> (64 - _BEGIN_BITS))
    bits = np.zeros(1 << _BEGIN_BITS, np.uint8)
    bits[list(begins)] = 1
    return _Table(pieces, rows, joined, np.packbits(bits, bitorder="little"), max(len(t) for t, _ in rows), scores)


def _reaches(words: pa.Array, table: _Table) -> np.ndarray:
    """For every character, the length of the longest substring from it that may begin a piece (1 at least)."""
    size = np.asarray(pc.utf8_length(words), dtype=np.int64)
    off, raw = _buffers(words)
    chars = np.frombuffer(raw[off[0]:off[-1]].tobytes().decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(chars))
    reach = np.ones(len(chars), np.int64)
    at, h = np.arange(len(chars)), chars
    for k in range(2, table.longest + 1):
        some = left[at] >= k
        at, h = at[some], h[some]
        if not len(at):
            break
        h = h * np.uint64(_STEP) + chars[at + k - 1]
        bit = h * np.uint64(_SPREAD_BITS) >> np.uint64(64 - _BEGIN_BITS)
        maybe = (table.begins[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 != 0
        at, h = at[maybe], h[maybe]
        reach[at] = k
    return reach


class _Cutter:
    """Finds places that the best segmentation of a long word goes through."""

    def __init__(self, pieces: Pieces):
        self.score = {t: s for t, _, s in pieces.rows}
        self.longest = max(map(len, self.score))
        self.unknown = min(self.score.values()) - _UNKNOWN_PENALTY

    def places(self, word: str) -> list[int]:
        """Positions in characters, ``SPAN`` apart at least, in ascending order."""
        get, longest, unknown = self.score.get, self.longest, self.unknown
        n = len(word)
        back = np.zeros(n + 1, np.uint16 if longest < 1 << 16 else np.uint32)
        window = [0.0]  # scores of the last positions, up to the one before `end`
        for end in range(1, n + 1):
            start = end - len(window)
            top, length = -np.inf, 1
            for i, before in enumerate(window, start):  # on equal scores the longer piece stays
                price = get(word[i:end])
                if price is None:
                    if end - i > 1:
                        continue
                    price = unknown
                if before + price > top:
                    top, length = before + price, end - i
            back[end] = length
            window.append(top)
            if len(window) > longest:
                del window[0]
        ends, at = [], n
        while at > 0:
            ends.append(at)
            at -= int(back[at])
        out, last = [], 0
        for e in reversed(ends):
            if e - last >= SPAN and n - e >= SPAN:
                out.append(e)
                last = e
        return out


def _cut_long(raw: np.ndarray, at: np.ndarray, cutter: _Cutter) -> np.ndarray:
    """``at`` with further beginnings inside words of more than ``LONG`` bytes."""
    more = []
    for k in np.flatnonzero(np.diff(at, append=len(raw)) > LONG).tolist():
        word = raw[at[k]:at[k + 1] if k + 1 < len(at) else len(raw)].tobytes().decode()
        last, byte = 0, int(at[k])
        for e in cutter.places(word):
            byte += len(word[last:e].encode())
            more.append(byte)
            last = e
    return np.sort(np.concatenate([at, np.array(more, np.int64)])) if more else at


def _units(column: pa.Array, cutter: _Cutter, joined: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (the first parts with the spaces in front), and the number of words per text."""
    texts = pc.replace_substring(texts_of(column), _MARK, " ")
    empty = np.asarray(pc.equal(texts, ""))
    texts = pc.if_else(pa.array(empty), "", pc.binary_join_element_wise(" ", texts, ""))
    size = np.asarray(pc.binary_length(texts), dtype=np.int64)
    raw = np.frombuffer(b"".join(x.as_buffer() for x in texts.cast(pa.binary())), np.uint8)
    del texts
    first = np.cumsum(size) - size
    cut = np.zeros(len(raw), bool)
    for a in range(1, len(raw), 1 << 18):  # few bytes at a time: no large intermediate arrays
        x, y = raw[a - 1:a - 1 + (1 << 18)][:len(raw) - a], raw[a:a + (1 << 18)]
        cut[a:a + len(y)] = ((y == 0x20) & (x != 0x20)) | (x == 0x0A) | (y == 0x0A) | ~joined[x.astype(np.uint16) << 8 | y] & (y & 0xC0 != 0x80)
    cut[first[~empty]] = True
    at = _cut_long(raw, np.flatnonzero(cut), cutter)
    n = np.searchsorted(at, first + size) - np.searchsorted(at, first)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw))), pa.py_buffer(raw)]), n


def _blocks(batches, block_bytes: int, table):
    """(block, rows, words per text, words in order of frequency, word numbers) of every block of a task."""
    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0
    cutter, joined = _Cutter(table.value.pieces), table.value.joined
    for whole in _gathered(batches, block_bytes):
        words, n = _units(whole.column(2), cutter, joined)
        whole = whole.select([0, 1])
        coded = words.dictionary_encode()
        del words
        if number >> (_TASK_SHIFT - _WORD_BITS) or len(coded.dictionary) >> _WORD_BITS:
            raise ValueError("too many blocks in a task, or words in a block")
        codes = np.asarray(coded.indices)
        order = np.argsort(-np.bincount(codes, minlength=len(coded.dictionary)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        words, codes = coded.dictionary.take(pa.array(order)), rank[codes]
        del coded
        pa.default_memory_pool().release_unused()  # an executor's other Python workers need it
        yield task << _TASK_SHIFT | number << _WORD_BITS, whole, n, words, codes
        number += 1


def _gathered(batches, block_bytes: int):
    held, size = [], 0
    for batch in batches:
        for part in parts(batch, "text", min(block_bytes, 1 << 20)):
            held.append(part)
            size += part.nbytes
            if size >= block_bytes:
                whole, held, size = pa.Table.from_batches(held).combine_chunks().to_batches()[0], [], 0
                yield whole
                del whole
    if held and sum(b.num_rows for b in held):
        whole, held = pa.Table.from_batches(held).combine_chunks().to_batches()[0], []
        yield whole


def _planes(codes: np.ndarray) -> bytes:
    """Codes as four planes of bytes, which compress."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _codes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(4, -1).T).reshape(-1).view("<i4")


def _packed(*runs: bytes) -> bytes:
    return pa.Codec("zstd", 3).compress(b"".join(runs), asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=size, asbytes=True), np.uint8)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends and bytes of a binary column."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1], np.frombuffer(column.buffers()[2] or b"", np.uint8)


def _buckets(words: pa.Array, buckets: int) -> np.ndarray:
    """A bucket for every word, by its bytes and their places."""
    off, raw = _buffers(words)
    at = np.arange(off[0], off[-1]) - np.repeat(off[:-1], np.diff(off))
    mixed = mix((at.astype(np.uint64) << np.uint64(8) | raw[off[0]:off[-1]]) * np.uint64(_STEP))
    return (mix(np.add.reduceat(mixed, off[:-1] - off[0])) % np.uint64(buckets)).astype(np.int64)


def _emit_words(batches, block_bytes: int, table, buckets: int):
    """A row per block and bucket: numbers in the block and words, each word (but the line feed, which is
    empty) with the reaches of its characters behind it, a line feed between words."""
    for block, _, _, words, _ in _blocks(batches, block_bytes, table):
        bucket = np.concatenate([_buckets(words.slice(a, 1 << 15), buckets) for a in range(0, len(words), 1 << 15)] or [np.zeros(0, np.int64)])
        order = np.argsort(bucket, kind="stable")
        words = words.take(pa.array(order)).cast(pa.large_string())
        reach = b"".join((_reaches(words.slice(a, 1 << 15), table.value) + _REACH).astype("<u4").tobytes().decode("utf-32-le").encode()
                         for a in range(0, len(words), 1 << 15))
        size = np.asarray(pc.utf8_length(words), dtype=np.int64)
        lead = np.flatnonzero(np.frombuffer(reach, np.uint8) & 0xC0 != 0x80)  # a long reach is a character of several bytes
        ends = np.append(lead, len(reach))[np.concatenate([[0], np.cumsum(size)])]
        reaches = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(reach))
        none = pa.scalar("", pa.large_string())
        shown = pc.if_else(pc.equal(words, pa.scalar("\n", pa.large_string())), none, pc.binary_join_element_wise(words, reaches, none))
        at = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)).astype(np.int64)
        for a in range(0, len(at) - 1, 1000):
            cut = at[a:a + 1001]
            part = lists(shown.slice(cut[0], cut[-1] - cut[0]).cast(pa.string()), np.diff(cut))
            numbers = lists(pa.array(order[cut[0]:cut[-1]].astype(np.int32)), np.diff(cut))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order[cut[:-1]]].astype(np.int32)), pa.array(np.full(len(cut) - 1, block)), numbers,
                                              pc.binary_join(part, "\n")], names=["bucket", "block", "numbers", "words"])


def _emit_blocks(batches, block_bytes: int, table):
    for block, whole, n, words, codes in _blocks(batches, block_bytes, table):
        keys, h = (whole.column(k).to_pylist() for k in (0, 1))
        del whole
        one = lambda x: pa.array([x])
        yield pa.RecordBatch.from_arrays(
            [one(block), one(keys).cast(pa.list_(pa.int64())), one(h).cast(pa.list_(pa.int64())),
             pa.array([n.tolist()], pa.list_(pa.int32())), pa.array([_packed(_planes(codes))], pa.binary()),
             pa.array([len(codes)], pa.int64()), pa.array([len(words)], pa.int64())],
            names=["block", "ids", "h", "n", "codes", "n_codes", "n_words"])


def _spelled(ids: pa.Array, words: pa.Array, pieces: Pieces) -> pa.Array:
    """``ids`` with the byte pieces of unknown characters (-p is the one that ends at p), or the unknown id."""
    flat, n = ids.flatten().to_numpy(), np.asarray(pc.list_value_length(ids), dtype=np.int64)
    unknown = np.flatnonzero(flat < 0)
    if not len(unknown):
        return ids
    owner = np.repeat(np.arange(len(n)), n)[unknown]
    if pieces.bytes_from < 0:
        flat = flat.copy()
        flat[unknown] = pieces.unknown
        return lists(pa.array(flat), n)
    spelled = [word[-i - 1].encode() for word, i in zip(words.take(pa.array(owner)).to_pylist(), flat[unknown].tolist())]
    more = np.ones(len(flat), np.int64)
    more[unknown] = [len(x) for x in spelled]
    out = np.repeat(flat, more)
    out[out < 0] = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int32) + pieces.bytes_from
    np.add.at(n, owner, more[unknown] - 1)
    return lists(pa.array(out), n)


def _ids_back(batches, table):
    """Folds the lattice of the words of a task; a row per block: numbers in the block (as gaps), numbers of ids, ids."""
    held, n_places, n_ids = [], 0, 0
    for batch in batches:
        words, places, edges = batch.columns
        ids = _spelled(viterbi(edges, table.value.scores), words, table.value.pieces)
        held.append(pa.RecordBatch.from_arrays([places, ids], names=["places", "ids"]))
        n_places += len(places.flatten())
        n_ids += len(ids.flatten())
        if n_places >= _BACK_PLACES or n_ids >= _BACK_IDS:
            yield from _by_block(pa.Table.from_batches(held))
            held, n_places, n_ids = [], 0, 0
    if held:
        yield from _by_block(pa.Table.from_batches(held))


def _by_block(words: pa.Table):
    places, ids = (words.column(k).combine_chunks() for k in (0, 1))
    flat, size = ids.flatten().to_numpy(), np.asarray(pc.list_value_length(ids), dtype=np.int64)
    first = np.cumsum(size) - size
    place = places.flatten().to_numpy()
    word = np.repeat(np.arange(len(size)), np.asarray(pc.list_value_length(places), dtype=np.int64))
    order = np.argsort(place)
    place, n, first = place[order], size[word[order]], first[word[order]]
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.append(np.flatnonzero(np.diff(place >> _WORD_BITS, prepend=-1)), len(place))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        take = np.arange(ends[b] - ends[a]) + np.repeat(first[a:b] - ends[a:b] + ends[a], n[a:b])
        number = place[a:b] & ((1 << _WORD_BITS) - 1)
        out.append((int(place[a] - number[0]), b - a, len(take), _packed(_planes(np.diff(number, prepend=0)), _planes(n[a:b]), _planes(flat[take]))))
    for a in range(0, len(out), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[a:a + 1000]), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                                         names=["block", "n", "n_ids", "data"])


def lattice(words: DataFrame, table, keys: list[str]) -> DataFrame:
    """(word, places, edges) of every word; ``keys`` name a word and tell how words are dealt out.
    An edge is end << 48 | start << 32 | id + 1, with 0 for an unknown character."""
    known = words.sparkSession.createDataFrame(table.value.rows, "sub string, id int")
    # span (0, 0) carries what belongs to the word; the others are its substrings
    spans = F.expr(f"""concat(array(struct(0 as s, 0 as e)), flatten(transform(sequence(0, char_length(word) - 1),
        s -> transform(sequence(s + 1, s + ascii(substring(reaches, s + 1, 1)) - {_REACH}), e -> struct(s, e)))))""")
    rows = words.select(*keys, "word", "places", F.explode(spans).alias("p")).select(
        *keys, F.when(F.col("p.e") == 0, F.struct("word", "places")).alias("carried"), F.col("p.s").alias("s"), F.col("p.e").alias("e"),
        F.expr("substring(word, p.s + 1, p.e - p.s)").alias("sub"))
    # the piece table has MOST_PIECES rows at most
    joined = rows.join(F.broadcast(known), "sub", "left").where("id IS NOT NULL OR e - s <= 1")
    edge = F.expr("if(e > 0, shiftleft(cast(e as long), 48) | shiftleft(cast(s as long), 32) | cast(coalesce(id, -1) + 1 as long), null)")
    return (joined.groupBy(*keys).agg(F.first("carried", ignorenulls=True).alias("carried"), F.collect_list(edge).alias("edges"))
                  .select("carried.word", "carried.places", "edges"))


def viterbi(edges: pa.Array, scores: np.ndarray) -> pa.Array:
    """The ids along the best path of every word; the unknown character that ends at position p is -p."""
    n = np.asarray(pc.list_value_length(edges), dtype=np.int64)
    edge, word = edges.flatten().to_numpy(), np.repeat(np.arange(len(n)), n)
    if not len(edge):
        return lists(pa.array([], pa.int32()), n)
    order = np.argsort((edge >> 48) * len(n) + word << 16 | edge >> 32 & 0xFFFF)  # by end, word and start
    edge, word = edge[order], word[order]
    end, start, number = edge >> 48, edge >> 32 & 0xFFFF, edge & 0xFFFFFFFF
    size = np.zeros(len(n), np.int64)
    np.maximum.at(size, word, end)
    base = np.cumsum(size + 1) - (size + 1)
    best, via = np.zeros(int((size + 1).sum())), np.zeros(int((size + 1).sum()), np.int64)
    source, target, price = base[word] + start, base[word] + end, scores[number]
    at = np.append(np.flatnonzero(np.diff(end, prepend=0)), len(edge))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        value, into = best[source[a:b]] + price[a:b], target[a:b]
        first = np.flatnonzero(np.diff(into, prepend=-1))
        top = np.maximum.reduceat(value, first)
        best[into[first]] = top
        hit = np.flatnonzero(value == np.repeat(top, np.diff(np.append(first, b - a))))[::-1]
        via[into[hit]] = a + hit  # of equal ones the last stored, which starts first: the longer piece
    live, place = np.flatnonzero(size > 0), size.copy()
    words, ids = [], []
    while len(live):
        taken = via[base[live] + place[live]]
        words.append(live)
        ids.append(np.where(number[taken] > 0, number[taken] - 1, -place[live]))
        place[live] = start[taken]
        live = live[place[live] > 0]
    words, ids = np.concatenate(words[::-1]), np.concatenate(ids[::-1])
    return lists(pa.array(ids[np.argsort(words, kind="stable")].astype(np.int32)), np.bincount(words, minlength=len(n)))


def _assemble(key, words: pa.Table, blocks: pa.Table) -> pa.Table:
    """The documents of a block from the ids of its words."""
    block = blocks.to_pylist()[0] if blocks.num_rows else None
    if block is None or sum(words.column("n").to_pylist()) != block["n_words"] or blocks.num_rows != 1:
        raise RuntimeError("a block's words and documents differ: the input is not the same when read again")
    codes = _codes(_unpacked(block["codes"], 4 * block["n_codes"]))
    size, first = np.zeros(block["n_words"], np.int64), np.zeros(block["n_words"], np.int64)
    found, at = [np.zeros(0, np.int32)], 0
    for row in words.to_pylist():
        k, m = row["n"], row["n_ids"]
        raw = _unpacked(row["data"], 8 * k + 4 * m)
        w, n = np.cumsum(_codes(raw[:4 * k])), _codes(raw[4 * k:8 * k])
        size[w], first[w] = n, at + np.cumsum(n) - n
        found.append(_codes(raw[8 * k:]))
        at += m
    flat = np.concatenate(found)
    total = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(size[codes], out=total[1:])
    ids = np.empty(int(total[-1]), np.int32)
    for a in range(0, len(codes), 1 << 18):
        some = codes[a:a + (1 << 18)]
        n, begin = size[some], total[a:a + len(some)]
        ids[begin[0]:begin[-1] + n[-1]] = flat[np.arange(int(n.sum())) + np.repeat(first[some] - begin + begin[0], n)]
    begin = np.concatenate([[0], total[np.cumsum(np.array(block["n"], np.int64))]])
    n, h, keys = np.diff(begin), pa.array(block["h"], pa.int64()), pa.array(block["ids"], pa.int64())
    out, a = [], 0
    while a < len(n):  # in batches of about a megabyte of ids
        b = max(a + 1, int(np.searchsorted(begin, begin[a] + (1 << 18), side="right")) - 1)
        out.append(pa.RecordBatch.from_arrays([keys.slice(a, b - a), h.slice(a, b - a), pa.array(n[a:b]), lists(pa.array(ids[begin[a]:begin[b]]), n[a:b])],
                                              names=["id", "h", "n_tokens", "ids"]))
        a = b
    return pa.Table.from_batches(out)


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, ``h`` (hash of its text), n_tokens, ids.

    ``docs`` is read twice and must give the same rows in the same partitions (files or a
    written table do); a block that differs raises an error.
    """
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = docs.sparkSession.sparkContext.broadcast(_table(pieces))  # MOST_PIECES rows at most
    words = rows.mapInArrow(lambda b: _emit_words(b, block_bytes, table, SPREAD * n), "bucket int, block long, numbers array<int>, words string")
    blocks = rows.mapInArrow(lambda b: _emit_blocks(b, block_bytes, table), "block long, ids array<long>, h array<long>, n array<int>, "
                             "codes binary, n_codes long, n_words long")
    listed = words.repartition(n, "bucket").select("bucket", "block", "numbers", F.posexplode(F.split("words", "\n", -1)).alias("k", "shown"))
    placed = (listed.select("bucket", "shown", F.expr("block + numbers[k]").alias("place"), F.expr(f"cast(shiftright(block, {_TASK_SHIFT}) div {ZONE} as int)").alias("zone"))
                    .groupBy("shown", "zone", "bucket").agg(F.collect_list("place").alias("places")))
    half = "char_length(shown) div 2"
    parted = placed.select("bucket", "places", F.element_at("places", 1).alias("first"),  # no other word has this place
                           F.expr(f"if(shown = '', '\\n', substring(shown, 1, cast({half} as int)))").alias("word"),
                           F.expr(f"if(shown = '', '{chr(_REACH + 1)}', substring(shown, cast({half} as int) + 1))").alias("reaches"))
    back = lattice(parted, table, ["first", "bucket"]).mapInArrow(lambda b: _ids_back(b, table), "block long, n int, n_ids int, data binary")
    return (back.repartition(n, "block").groupBy("block").cogroup(blocks.repartition(n, "block").groupBy("block"))
                .applyInArrow(_assemble, "id long, h long, n_tokens long, ids array<int>")
                .withColumnRenamed("id", id_col))


def decode(ids: Column, pieces: Pieces) -> Column:
    """The text of an id array."""
    table = F.split(F.lit(",".join(pieces.hexes)), ",")
    hexes = F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), "")
    text = F.make_valid_utf8(F.unhex(hexes).cast("string"))
    return F.regexp_replace(text, "^ ", "")


def sentencepiece_report(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per document: ids, their number, hash of the decoded text, and whether it is the text."""
    pieces = load_pieces(model_path)
    got = encode(docs.select("doc_id", "text"), pieces).withColumn("decoded", decode(F.col("ids"), pieces))
    return got.select("doc_id", "n_tokens", "ids", sha256_hex(F.col("decoded")).alias("decoded_sha256"),
                      (F.xxhash64("decoded") == F.col("h")).alias("round_trip"))
