"""SentencePiece encoding and decoding by suffix-array matching (operator 3).

The new words of a batch are concatenated and indexed by a suffix array. Every piece of the
vocabulary is found by binary search as a range of it, each place in the range is an edge from the
piece's begin to its end, and the edges are relaxed in the order of their ends. For a model of
merged pairs, an edge extends a path if no merge would have joined across the two pieces; exactly
one edge does so for each end, and the path to a word's end is the model's own segmentation.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import return_memory, worker_state

#: The mark that stands for a blank in pieces.
MARK = "▁"
#: Characters indexed at a time, and characters of texts encoded together.
INDEX_CHARS, BATCH_CHARS = 250_000, 1_000_000
#: Bytes of words after which a worker starts a new memory; it keeps the one before, too.
REMEMBERED_BYTES = 48 << 20
#: A longer word is never remembered and is cut into stretches that overlap.
STRETCH, OVERLAP = 4096, 256
_RUNS = re.compile(f"{MARK}+[^{MARK}]*")
_NEVER = np.int32(1 << 30)
_BEGIN, _UNKNOWN, _NONE = -1, -2, -3


class Model(NamedTuple):
    """A vocabulary in the order in which its pieces are merged (place 0 first)."""

    pieces: list[str]
    ids: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_places: np.ndarray
    byte_ids: list[int]
    unknown_id: int
    decoded: list[bytes]


def _last_merge(piece: str, rank: dict[str, int]) -> tuple[str, str] | None:
    """The two pieces whose merge makes ``piece``; None if merges never lead to it."""
    parts = list(piece)
    while len(parts) > 2:
        best = min(range(len(parts) - 1), key=lambda i: (rank.get(parts[i] + parts[i + 1], 1 << 30), i))
        joined = parts[best] + parts[best + 1]
        if joined not in rank or joined == piece:
            return None
        parts[best : best + 2] = [joined]
    return (parts[0], parts[1]) if len(parts) == 2 and all(p in rank for p in parts) else None


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a serialized message: numbers as such, all else as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, data[at : at + size]
            at += size


def _refuse_other_models(serialized: bytes) -> None:
    """Raises unless the model merges pairs, changes no text but blanks and puts one before it."""
    parts = dict(f for f in _fields(serialized) if f[0] in (2, 3))
    trainer, normalizer = (dict(_fields(parts.get(n, b""))) for n in (2, 3))
    # Fields of the model format. Type 2 merges pairs; the flags are on where absent.
    if trainer.get(3, 1) != 2:
        raise ValueError("only models that merge pairs can be encoded")
    if normalizer.get(1, b"") not in (b"", b"identity") or normalizer.get(2, b""):
        raise ValueError("the model normalizes texts in other ways than marking blanks")
    if not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1):
        raise ValueError("the model must mark blanks, keep all of them and put one before a text")


def load_model(path: str) -> Model:
    """Reads the vocabulary and scores of a merge model; the merge order is that of the scores.

    Raises ValueError for a model of another kind or with a normalization of its own.
    """
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    _refuse_other_models(reader.serialized_model_proto())
    every = range(reader.get_piece_size())
    plain = [i for i in every if not (reader.is_byte(i) or reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i))]
    # Single characters need no merge; they come after all merged pieces.
    plain.sort(key=lambda i: (len(reader.id_to_piece(i)) == 1, -reader.get_score(i), i))
    rank = {reader.id_to_piece(i): n for n, i in enumerate(plain)}
    kept, merges = [], {}
    for i in plain:
        piece = reader.id_to_piece(i)
        if len(piece) > 1:
            merges[piece] = _last_merge(piece, rank)
        if len(piece) == 1 or merges[piece]:
            kept.append(i)
    pieces = [reader.id_to_piece(i) for i in kept]
    place = {p: n for n, p in enumerate(pieces)}
    left, right = np.arange(len(pieces), dtype=np.int32), np.arange(len(pieces), dtype=np.int32)
    pairs = {}
    for n, p in enumerate(pieces):
        if len(p) > 1:
            a, b = merges[p]
            left[n], right[n] = place[a], place[b]
            for cut in range(1, len(p)):
                x, y = place.get(p[:cut]), place.get(p[cut:])
                if x is not None and y is not None:
                    pairs[x * len(pieces) + y] = n
    keys = np.array(sorted(pairs), np.int64)
    bytes_of = {reader.id_to_piece(i): i for i in every if reader.is_byte(i)}
    decoded = []
    for i in every:
        p = reader.id_to_piece(i)
        if reader.is_byte(i):
            decoded.append(bytes([int(p[3:5], 16)]))
        elif reader.is_control(i):
            decoded.append(b"")
        else:
            decoded.append(" ⁇ ".encode() if reader.is_unknown(i) else p.replace(MARK, " ").encode())
    return Model(
        pieces, np.array([i for i in kept], np.int32), left, right, keys,
        np.array([pairs[k] for k in keys.tolist()], np.int32),
        [bytes_of[f"<0x{b:02X}>"] for b in range(256)] if len(bytes_of) == 256 else [], reader.unk_id(), decoded,
    )


def words_of(text: str) -> list[str]:
    """The text with a blank before it, blanks as marks, cut before each run of marks.

    No piece holds a mark after another character, so no piece crosses a cut.
    """
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " ":
        return [MARK + w for w in text.split(" ")]
    return _RUNS.findall(MARK + text.replace(" ", MARK))


def _order(keys: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0; short ones are sorted by their digits."""
    return np.argsort(keys.astype(np.uint16) if len(keys) and keys.max() < 65536 else keys, kind="stable")


class Encoder:
    """Encodes words by suffix-array matching and remembers them."""

    def __init__(self, model: Model):
        self.model = model
        #: Words seen lately, and those of the memory before; words move up when they are seen again.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.remembered = 0
        self.size = len(model.pieces)
        self.lengths = np.array([len(p) for p in model.pieces], np.int32)
        self.longest = int(self.lengths.max())
        # The pieces' characters (0: none left) as places in the sorted ones in use.
        grid = np.zeros((self.size, self.longest), np.int64)
        for n, p in enumerate(model.pieces):
            grid[n, : len(p)] = [ord(c) + 1 for c in p]
        self.letters, grid = np.unique(grid, return_inverse=True)
        self.grid = grid.reshape(self.size, self.longest).astype(np.int32)
        self.slots = 1 << 20
        self.known = np.full(self.slots, -1, np.int64)
        self.fits = np.zeros(self.slots, bool)
        self.decoded = np.array(model.decoded, object)

    # -- pairs of neighbouring pieces

    def _joined(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The place of the pair's merge, _NEVER if there is none."""
        key = x.astype(np.int64) * self.size + y
        at = np.minimum(np.searchsorted(self.model.pair_keys, key), len(self.model.pair_keys) - 1)
        return np.where(self.model.pair_keys[at] == key, self.model.pair_places[at], _NEVER)

    def _work_out(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges of ``a + b`` end in exactly these two pieces.

        Undoes the merges of both sides, latest first, and looks at the two pieces that met at the
        border in between: a merge across it before the undone one would have come first.
        """
        fits = np.zeros(len(a), bool)
        todo, x, y = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), _NEVER)
        left, right = self.model.left, self.model.right
        while len(todo):
            open_ = self._joined(x, y) >= limit
            todo, x, y, limit = todo[open_], x[open_], y[open_], limit[open_]
            single_x, single_y = right[x] == x, left[y] == y
            done = single_x & single_y
            fits[todo[done]] = True
            todo, x, y, limit, single_x, single_y = (v[~done] for v in (todo, x, y, limit, single_x, single_y))
            undo_x = ((x > y) | single_y) & ~single_x
            limit = np.where(undo_x, x, y + 1)
            x, y = np.where(undo_x, right[x], x), np.where(undo_x, y, left[y])
        return fits

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The same, through a table of the pairs seen before."""
        key = a.astype(np.int64) * self.size + b
        slot = (key * 0x9E3779B1 >> 12) & (self.slots - 1)
        hit = self.known[slot] == key
        if not hit.all():
            new = np.unique(key[~hit])
            value = self._work_out((new // self.size).astype(np.int32), (new % self.size).astype(np.int32))
            out = self.fits[slot]
            out[~hit] = value[np.searchsorted(new, key[~hit])]
            at = (new * 0x9E3779B1 >> 12) & (self.slots - 1)
            self.known[at], self.fits[at] = -1, False
            last = np.unique(at[::-1], return_index=True)[1]
            chosen = len(at) - 1 - last
            self.known[at[chosen]], self.fits[at[chosen]] = new[chosen], value[chosen]
            return out
        return self.fits[slot]

    # -- index, edges, paths

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and piece of every occurrence of a piece in the text of character codes (0: a cut)."""
        letters, dense = np.unique(codes, return_inverse=True)
        # The greatest number stands for "any" below, so a letter has none of it.
        kind = np.uint8 if len(letters) < 256 else np.uint16 if len(letters) < 65536 else np.uint32
        padded = np.concatenate((dense.astype(kind), np.zeros(self.longest, kind)))
        wide = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(codes)]
        table = np.ascontiguousarray(wide).astype(padded.dtype.newbyteorder(">"))
        width = table.dtype.itemsize * self.longest
        # The suffix array, to the depth of the longest piece: sorted by eight bytes after eight.
        spare = -width % 8
        raw = table.view(np.uint8).reshape(len(codes), width)
        if spare:
            raw = np.concatenate((raw, np.zeros((len(codes), spare), np.uint8)), axis=1)
        columns = np.ascontiguousarray(raw).view(">u8").astype(np.uint64)
        suffixes = np.lexsort(columns.T[::-1]).astype(np.int32)
        heads = raw[suffixes].view(f"S{width + spare}").ravel()
        # The pieces that only have letters of the text, in the text's numbers.
        at = np.minimum(np.searchsorted(letters, self.letters), len(letters) - 1)
        here = letters[at] == self.letters
        usable = np.flatnonzero((here[self.grid] | (self.grid == 0)).all(axis=1))
        codes_of, blank = at[self.grid[usable]], self.grid[usable] == 0
        low = np.where(blank, 0, codes_of).astype(table.dtype)
        high = np.where(blank, np.iinfo(padded.dtype).max, codes_of).astype(table.dtype)
        as_text = lambda t: np.concatenate((t.view(np.uint8).reshape(len(t), width), np.zeros((len(t), spare), np.uint8)), axis=1).view(f"S{width + spare}").ravel()
        begin = np.searchsorted(heads, as_text(low), "left")
        end = np.searchsorted(heads, as_text(high), "right")
        count = end - begin
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return suffixes[at], np.repeat(usable.astype(np.int32), count)

    def _relaxed(self, words: list[str], seed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(last piece of the path to each place, the words' starts, their sizes).

        With ``seed`` the paths to the first places of a single word are given.
        """
        text = "\0".join(words) + "\0"
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        sizes = np.fromiter(map(len, words), np.int32, len(words))
        starts = (np.cumsum(sizes + 1) - (sizes + 1)).astype(np.int32)
        codes[starts + sizes] = 0
        begin, piece = self._edges(codes)
        lengths = self.lengths
        end = begin + lengths[piece]
        # A character that is no piece is an edge of its own.
        covered = np.zeros(len(codes), bool)
        covered[begin[lengths[piece] == 1]] = True
        bare = np.flatnonzero(~covered & (codes != 0)).astype(np.int32)
        begin, end = np.concatenate((begin, bare)), np.concatenate((end, bare + 1))
        piece = np.concatenate((piece, np.full(len(bare), _UNKNOWN, np.int32)))
        # By place: the end's distance from the begin of its word, then the begin.
        depth = end - np.repeat(starts, sizes + 1)[end - 1]
        order = _order(depth * (self.longest + 1) + (end - begin))
        begin, end, piece, depth = begin[order], end[order], piece[order], depth[order]
        last = np.full(len(codes) + 1, _NONE, np.int32)
        last[starts] = _BEGIN
        done = 0
        if seed is not None:
            last[: len(seed)] = seed
            done = len(seed) - 1
        cuts = np.searchsorted(depth, np.arange(done + 1, depth.max(initial=0) + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            before, now = last[begin[lo:hi]], piece[lo:hi]
            fits = (before == _BEGIN) | (before == _UNKNOWN) | (now == _UNKNOWN)
            check = np.flatnonzero(~fits)
            fits[check] = self._fit(before[check], now[check])
            last[end[lo:hi][fits]] = now[fits]
        return last, starts, sizes

    def _steps(self) -> np.ndarray:
        """Characters of every piece; _UNKNOWN is the last but one."""
        return np.concatenate((self.lengths, [1, 1]))

    def _encode_new(self, words: list[str]) -> None:
        last, starts, sizes = self._relaxed(words)
        # Back from the words' ends.
        back, at, unit = [], starts + sizes, np.arange(len(words))
        step = self._steps()
        while len(at):
            token = last[at]
            back.append((unit, token, at - 1))
            at = at - step[token]
            more = at > starts[unit]
            at, unit = at[more], unit[more]
        unit = np.concatenate([b[0] for b in back])
        token = np.concatenate([b[1] for b in back])
        spot = np.concatenate([b[2] for b in back])
        order = np.argsort(spot)
        unit, token, spot = unit[order], token[order], spot[order]
        ids = np.where(token >= 0, self.model.ids[np.maximum(token, 0)], -1).astype("<i4")
        bounds = np.searchsorted(unit, np.arange(len(words) + 1))
        data, cuts = ids.tobytes(), (4 * bounds).tolist()
        new = {w: data[a:b] for w, a, b in zip(words, cuts, cuts[1:])}
        for k in np.unique(unit[ids < 0]).tolist():
            w, here = words[k], slice(bounds[k], bounds[k + 1])
            chars = (spot[here] - starts[k]).tolist()
            own = [x for i, c in zip(ids[here].tolist(), chars) for x in ([i] if i >= 0 else self._bytes(w[c]))]
            new[w] = np.array(own, "<i4").tobytes()
        self._remember(new)

    def _remember(self, new: dict[str, bytes]) -> None:
        self.words |= new
        # What a dictionary's entry, a text and a byte string take besides their characters.
        self.remembered += 250 * len(new) + 2 * sum(map(len, new)) + sum(map(len, new.values()))

    def _encode_long(self, word: str) -> bytes:
        """Ids of a word of any length, in memory of some 10 bytes a character.

        Stretches of the word are relaxed side by side, each as if a word began there. A path depends on
        the ``longest`` places before it only, so from where that many places in a row agree with the
        stretch before, a stretch's paths are the word's own. One that never agrees is relaxed again
        from the stretch before.
        """
        size, longest = len(word), self.longest
        last = np.full(size + 1, _NONE, np.int32)
        cuts = range(0, size, STRETCH)
        group = max(1, INDEX_CHARS // (STRETCH + OVERLAP))
        reached = 0
        for lo in range(0, len(cuts), group):
            here = cuts[lo : lo + group]
            found, starts, sizes = self._relaxed([word[c : c + STRETCH + OVERLAP] for c in here])
            for c, start, n in zip(here, starts.tolist(), sizes.tolist()):
                own = found[start : start + n + 1]
                if c + n <= reached:
                    continue
                if not c:
                    last[: n + 1] = own
                else:
                    same = last[c + 1 : reached + 1] == own[1 : reached - c + 1]
                    run = np.convolve(same, np.ones(longest, int), "valid") == longest
                    if run.any():
                        at = int(run.argmax()) + longest
                        last[c + at : c + n + 1] = own[at:]
                    else:
                        begin = reached - longest
                        rest = self._relaxed([word[begin : c + n]], last[begin : reached + 1])[0]
                        last[begin : c + n + 1] = rest[: c + n + 1 - begin]
                reached = c + n
        tokens, step, at = array("i"), self._steps().tolist(), size
        while at:
            token = last.item(at)
            tokens.append(token)
            at -= step[token]
        token = np.frombuffer(tokens, np.int32)[::-1]
        ids = np.where(token >= 0, self.model.ids[np.maximum(token, 0)], -1).astype("<i4")
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids.tobytes()
        spot = np.cumsum(self._steps()[token]) - 1
        out, at = [], 0
        for k, c in zip(bare.tolist(), spot[bare].tolist()):
            out += [ids[at:k].tobytes(), array("i", self._bytes(word[c])).tobytes()]
            at = k + 1
        return b"".join([*out, ids[at:].tobytes()])

    def _bytes(self, char: str) -> list[int]:
        if not self.model.byte_ids:
            return [self.model.unknown_id]
        return [self.model.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        cut = [words_of(t) for t in texts]
        if self.remembered > REMEMBERED_BYTES:
            self.words, self.older, self.remembered = {}, self.words, 0
        missing = set().union(*cut) - self.words.keys()
        known = missing & self.older.keys()
        self._remember({w: self.older[w] for w in known})
        group, size, long = [], 0, {}
        for w in missing - known:
            if len(w) > STRETCH:
                long[w] = self._encode_long(w)
                continue
            group.append(w)
            size += len(w) + 1
            if size >= INDEX_CHARS:
                self._encode_new(group)
                group, size = [], 0
        if group:
            self._encode_new(group)
        known = (self.words | long if long else self.words).__getitem__
        return [np.frombuffer(b"".join(map(known, words)), "<i4") for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the blank put before it goes."""
        return b"".join(self.decoded[ids].tolist()).decode("utf-8", "replace").removeprefix(" ")


def _encoder(sent, path: str) -> Encoder:
    kept = worker_state("piece_encoders")
    if path not in kept:
        kept[path] = Encoder(Model(*sent.value))
    return kept[path]


def encode_documents(
    df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per input row: ``key``, ``n_ids``, ``ids_crc32`` (of the ids as little-endian 32-bit
    integers), ``round_trip`` (the decoded ids give the text), ``ids`` (unless ``with_ids`` is off).

    Nulls: null and empty texts have no ids; a null key stays null. Repeated rows each give theirs.
    Empty table: no rows. Other columns are not read. A text that holds the blank's mark (U+2581)
    decodes to a blank there, as in the model's own library.

    Scale: no shuffle. A worker holds one batch of texts, one index over about INDEX_CHARS characters of
    new words and a memory of words bounded in bytes; a word longer than that is indexed in
    stretches. The vocabulary is broadcast; its size is fixed by the model.
    """
    sent = df.sparkSession.sparkContext.broadcast(tuple(load_model(model_path)))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return_memory()
        encoder = _encoder(sent, model_path)
        for keys, texts in _chunks(batches):
            ids = encoder.encode(texts)
            out = {
                "key": pd.array(keys, "Int64"),
                "n_ids": [len(x) for x in ids],
                "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids],
                "round_trip": [encoder.decode(x) == t for x, t in zip(ids, texts)],
            }
            yield pd.DataFrame(out | ({"ids": ids} if with_ids else {}))

    rows = df.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = "key bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean" + (", ids array<int>" if with_ids else "")
    return rows.mapInPandas(encode, schema).withColumnRenamed("key", key)


def decode_ids(df: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """All columns of ``df`` and ``out``: the text of the token ids; replaces a column named ``out``.

    Null ids give a null text, no ids an empty one. The blank that encoding puts before a text goes. Bytes
    that are no UTF-8 become replacement characters, an id that stands for no known character a mark
    (" \u2047 "), null ids within a list count for nothing; an id outside the vocabulary raises. No
    shuffle; a worker holds one batch.
    """
    sent = df.sparkSession.sparkContext.broadcast(load_model(model_path).decoded)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = sent.value
        for batch in batches:
            yield pd.Series([None if x is None else _text_of(table, x) for x in batch], dtype=object)

    return df.withColumn(out, decoded(F.filter(F.col(ids).cast("array<int>"), lambda i: i.isNotNull())))


def _text_of(decoded: list[bytes], ids: np.ndarray) -> str:
    if len(ids) and (min(ids) < 0 or max(ids) >= len(decoded)):
        raise ValueError("an id is outside the vocabulary")
    return b"".join([decoded[i] for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts in batches of about BATCH_CHARS characters, one text at least."""
    keys: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for k, t in zip(batch["_key"], batch["_text"]):
            keys.append(None if pd.isna(k) else int(k))
            texts.append(t)
            size += len(t)
            if size >= BATCH_CHARS:
                yield keys, texts
                keys, texts, size = [], [], 0
    if texts:
        yield keys, texts
