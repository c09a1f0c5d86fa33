"""Token ids in length-delimited binary records with an offset index (operator 8).

A record is: length (8 bytes, little-endian), masked CRC-32C of those 8 bytes, the payload, masked
CRC-32C of the payload; common readers of such record files read it. The payload is the document's
id (8 bytes), a flag byte (1: the id is null), the width of a token id in bytes, two zero bytes,
then the token ids. Beside ``NAME.rec`` lies ``NAME.idx``: per record its byte offset and the
number of tokens before it in the file, as two little-endian 64-bit integers.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.checksum import crc32c_many, masked
from barloom.llm.storage import open_store, return_memory, worker_state, write_once
from barloom.session import new_folder, written

_HEAD, _TAIL, _PREFIX = 12, 4, 12
#: Texts are encoded and records framed in batches of about this many characters.
BATCH_CHARS = 4_000_000
#: Distinct words whose ids a worker remembers.
MAX_REMEMBERED = 2_000_000
#: New words encoded as one text; the tokenizer is slower per word on longer ones.
JOINED_WORDS = 64
#: Words whose ids are gathered at a time.
GATHERED_WORDS = 1 << 15
#: Bytes of input per file, about.
FILE_BYTES = 256 << 20
#: Bytes a reading task asks the store for at a time.
READ_BYTES = 16 << 20

# A blank with white space on both sides, or at the end after white space, is no safe place to cut.
_UNSAFE = re.compile(r"\s \s|\s \Z")


class Words:
    """The ids of the words a worker remembers: a number per word, and all their ids back to back."""

    def __init__(self, dtype: str) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, self.dtype)
        self.ends = np.zeros(1 << 16, np.int64)  # of word n - 1; 0 before the first

    def add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Takes new words in, whose ids stand one after another."""
        n = len(self.number)
        ends = self.ends[n] + np.cumsum(counts)
        self.ends = _with_room(self.ends, n + 1 + len(words))
        self.ends[n + 1 : n + 1 + len(words)] = ends
        self.ids = _with_room(self.ids, int(self.ends[n]) + len(ids))
        self.ids[int(self.ends[n]) :][: len(ids)] = ids
        self.number.update(zip(words, range(n, n + len(words))))

    def joined(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered words back to back, and each one's end among them."""
        counts = self.ends[numbers + 1]
        counts -= self.ends[numbers]
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, self.dtype)
        for lo in range(0, len(numbers), GATHERED_WORDS):  # the places of some words at a time
            hi = min(lo + GATHERED_WORDS, len(numbers))
            first = int(ends[lo] - counts[lo])
            at = np.repeat(self.ends[numbers[lo:hi]] - (ends[lo:hi] - counts[lo:hi]), counts[lo:hi])
            at += np.arange(first, first + len(at))
            out[first : first + len(at)] = self.ids[at]
        return out, ends


def _with_room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    return np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


class Tokens(NamedTuple):
    """A worker's tokenizer, its memory of words, the type of an id, every token's bytes, and a pattern
    of the tokens that were added to the vocabulary, which are found in a text before it is cut."""

    tokenizer: object
    words: Words
    dtype: str
    sizes: np.ndarray
    added: re.Pattern | None


def encode_texts(texts: list[str], tokens: Tokens) -> list[bytes]:
    """Ids of every whole text as bytes.

    A blank after a non-blank always starts a new pre-token, so the words between such blanks are
    encoded on their own, each distinct one once per worker. Texts with runs of white space that
    such a cut would change, or with an added token, go to the tokenizer whole.
    """
    added = tokens.added.search if tokens.added else lambda _: None
    whole = [bool(_UNSAFE.search(t) or added(t)) for t in texts]
    out = [_ids(tokens, t).tobytes() if w else b"" for t, w in zip(texts, whole)]
    cut = [i for i, w in enumerate(whole) if not w and texts[i]]
    if not cut:
        return out
    if len(tokens.words.number) > MAX_REMEMBERED:
        tokens.words.clear()
    # Only the distinct words of a batch become Python strings.
    lists = pc.split_pattern(pa.array([texts[i] for i in cut], pa.large_string()), " ")
    found = lists.flatten().dictionary_encode()
    begins = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    # Words are remembered as they stand after a blank; a text's first word goes by a name that no
    # word can have, with a blank before it.
    firsts = [" " + texts[i].partition(" ")[0] for i in cut]
    numbers = _numbers(found.dictionary.to_numpy(zero_copy_only=False).tolist(), tokens)[found.indices.to_numpy()]
    numbers[begins[:-1]] = _numbers(firsts, tokens)
    ids, ends = tokens.words.joined(numbers)
    data, width = ids.tobytes(), ids.itemsize
    last = 0
    for i, end in zip(cut, (ends[begins[1:] - 1] * width).tolist()):
        out[i] = data[last:end]
        last = end
    return out


def _ids(tokens: Tokens, text: str) -> np.ndarray:
    return np.asarray(tokens.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, tokens.dtype)


def _numbers(words: list[str], tokens: Tokens) -> np.ndarray:
    """The words' numbers in the worker's memory; those it lacks are encoded."""
    known = list(map(tokens.words.number.get, words))
    new = [i for i, n in enumerate(known) if n is None]
    if new:
        _remember(list(dict.fromkeys([words[i] for i in new])), tokens)
        for i in new:
            known[i] = tokens.words.number[words[i]]
    return np.array(known, np.int64)


def _remember(words: list[str], tokens: Tokens) -> None:
    """Encodes new words: those without white space at their borders in groups, as one text with a blank
    before each, cut again by the bytes of its tokens; all others one by one."""
    plain = [w for w in words if w and w == w.strip()]
    groups = [plain[lo : lo + JOINED_WORDS] for lo in range(0, len(plain), JOINED_WORDS)]
    parts = [_ids(tokens, " " + " ".join(group)) for group in groups]
    if groups:
        sizes = pc.binary_length(pa.array(plain, pa.large_string())).to_numpy().astype(np.int64) + 1
        lows = np.arange(len(groups)) * JOINED_WORDS
        ids = np.concatenate(parts)
        ends = np.cumsum(tokens.sizes[ids])
        # The bytes of all tokens before a group, and where the words' last bytes are if its tokens are its bytes.
        upto = np.cumsum([len(p) for p in parts])
        after = np.concatenate([[0], ends])[np.concatenate([[0], upto])]
        group = np.arange(len(plain)) // JOINED_WORDS
        total = np.add.reduceat(sizes, lows)
        want = np.cumsum(sizes) - (np.cumsum(total) - total)[group] + after[:-1][group]
        at = np.minimum(np.searchsorted(ends, want), max(len(ends) - 1, 0))
        right = (ends[at] == want) if len(ends) else np.zeros(len(plain), bool)
        fits = np.logical_and.reduceat(right, lows) & (np.diff(after) == total)
        # A group whose tokens are no bytes of its text is left to the one by one.
        good = np.repeat(fits, [len(p) for p in parts])
        counts = np.diff(at + 1, prepend=0)
        first = np.concatenate([[0], upto[:-1]])
        counts[lows] = at[lows] + 1 - first
        tokens.words.add([w for w, ok in zip(plain, fits[group].tolist()) if ok], ids[good], counts[fits[group]])
    for w in words:
        if w not in tokens.words.number:
            ids = _ids(tokens, w[1:] if w[:1] == " " else " " + w)
            tokens.words.add([w], ids, np.array([len(ids)]))


def load_tokenizer(path: str) -> Tokens:
    """The tokenizer of a file, kept by the worker."""
    kept = worker_state("tokenizers")
    if path not in kept:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        width = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        # A token of a byte-level vocabulary is written with one character per byte.
        sizes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(tokenizer.get_vocab_size())])
        names = sorted({str(t.content) for t in tokenizer.get_added_tokens_decoder().values() if t.content})
        added = re.compile("|".join(map(re.escape, names)), re.IGNORECASE) if names else None
        kept[path] = Tokens(tokenizer, Words(width), width, sizes, added)
    return kept[path]


def frame(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The records of the payloads, back to back, and each one's offset."""
    sizes = np.array([len(p) for p in payloads], np.int64)
    lengths = np.frombuffer(sizes.astype("<u8").tobytes(), np.uint8)
    body = np.frombuffer(b"".join(payloads), np.uint8)
    head_crc = masked(crc32c_many(lengths, np.arange(len(sizes)) * 8, np.full(len(sizes), 8))).astype("<u4")
    body_crc = masked(crc32c_many(body, np.cumsum(sizes) - sizes, sizes)).astype("<u4")
    parts = []
    for p, n, h, b in zip(payloads, sizes.tolist(), head_crc, body_crc):
        parts += [struct.pack("<Q", n), h.tobytes(), p, b.tobytes()]
    ends = np.cumsum(sizes + _HEAD + _TAIL)
    return b"".join(parts), ends - (sizes + _HEAD + _TAIL)


def unframe(data: bytes, offsets: np.ndarray) -> list[bytes]:
    """The payloads of the records at the offsets; raises on a checksum that does not match."""
    raw = np.frombuffer(data, np.uint8)
    sizes = np.array([struct.unpack_from("<Q", data, o)[0] for o in offsets.tolist()], np.int64)
    if len(sizes) and ((sizes < 0).any() or (offsets + _HEAD + sizes + _TAIL > len(data)).any()):
        raise ValueError("a record runs past its file")
    for at, begin, n in ((8, 0, np.full(len(sizes), 8)), (None, _HEAD, sizes)):
        want = masked(crc32c_many(raw, offsets + begin, n))
        have = [struct.unpack_from("<I", data, o + (at if at else _HEAD + s))[0] for o, s in zip(offsets.tolist(), sizes.tolist())]
        if not np.array_equal(want, np.array(have, np.uint32)):
            raise ValueError("a record's checksum does not match")
    return [data[o + _HEAD : o + _HEAD + s] for o, s in zip(offsets.tolist(), sizes.tolist())]


def write_records(
    df: DataFrame, tokenizer_path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int = 0
) -> DataFrame:
    """Writes record and index files below ``folder`` in ascending key order; returns the manifest.

    One row per file: ``file`` (name without ending), ``part`` (place among the files),
    ``n_records``, ``n_tokens``, ``n_bytes``. Each document's ids end with ``end_id``.

    Nulls: a null text is empty (the end id alone); null keys come first. Repeated keys stay, in
    the order of their texts. Empty table: no files. Extra columns are not read.

    Scale: one range shuffle on the key; each partition becomes one file, streamed batch by batch. There
    is a file per FILE_BYTES of input, as Spark's statistics have it, and at least one per shuffle
    partition. All rows with a null key lie in the first file. Files are named by attempt, and only
    those of the manifest, which Spark commits, are ever read.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        return_memory()
        tokens_of = load_tokenizer(tokenizer_path)
        dtype = tokens_of.dtype
        end = np.asarray([end_id], dtype).tobytes()
        width = np.dtype(dtype).itemsize
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        index, count = [], {"records": 0, "tokens": 0, "bytes": 0}

        def stream(out) -> None:
            for keys, texts in _chunks(batches):
                payloads = [
                    struct.pack("<qBBH", 0 if k is None else k, k is None, width, 0) + e + end
                    for k, e in zip(keys, encode_texts(texts, tokens_of))
                ]
                data, offsets = frame(payloads)
                tokens = np.array([(len(p) - _PREFIX) // width for p in payloads], np.int64)
                before = count["tokens"] + np.cumsum(tokens) - tokens
                index.append(np.stack([offsets + count["bytes"], before], 1).astype("<i8").tobytes())
                out.write(data)
                count["records"] += len(payloads)
                count["tokens"] += int(tokens.sum())
                count["bytes"] += len(data)

        write_once(folder, f"{name}.rec", stream)
        if count["records"]:
            write_once(folder, f"{name}.idx", lambda out: out.write(b"".join(index)))
            yield pd.DataFrame(
                {"file": [name], "part": [part], "n_records": [count["records"]], "n_tokens": [count["tokens"]], "n_bytes": [count["bytes"]]}
            )

    rows = df.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(size // FILE_BYTES, 1 << 20))
    ordered = rows.repartitionByRange(parts, F.col("_key").asc_nulls_first()).sortWithinPartitions(
        F.col("_key").asc_nulls_first(), "_text"
    )
    manifest = ordered.mapInPandas(write, "file string, part int, n_records bigint, n_tokens bigint, n_bytes bigint")
    return written(manifest, "record-manifest")


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Keys (None for null) and texts in batches of about BATCH_CHARS characters, one text at least."""
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


def read_records(
    spark: SparkSession, folder: str, manifest: DataFrame, use: Callable[[list[bytes]], dict] | None = None, schema: str = ""
) -> DataFrame:
    """One row per record: ``key``, ``start`` (tokens in all files before it), ``n_tokens``, and ``ids``.

    ``use`` turns a batch of id arrays into other columns than ``ids`` (``schema`` names their
    types), so that ids need not leave the worker. Every record's two checksums are verified.

    Scale: files are cut into ranges of about READ_BYTES by their index; a task reads one range at a
    time by its bytes. Only the manifest, one row per file, is summed in one task.
    """
    span = READ_BYTES

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                store, path = open_store(f"{folder}/{row.file}.idx")
                with store.open_input_file(path) as f:
                    offsets = np.frombuffer(f.read(), "<i8").reshape(-1, 2)[:, 0]
                group = offsets // span
                first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                ends = np.r_[first[1:], len(offsets)]
                yield pd.DataFrame(
                    {"file": row.file, "base": row.base, "n_bytes": row.n_bytes, "first": first, "last": ends}
                )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                store, path = open_store(f"{folder}/{row.file}.idx")
                with store.open_input_file(path) as f:
                    more = min(16 * (int(row.last) - int(row.first) + 1), f.size() - 16 * int(row.first))
                    index = np.frombuffer(f.read_at(more, 16 * int(row.first)), "<i8").reshape(-1, 2)
                n = int(row.last) - int(row.first)
                begin = int(index[0, 0])
                stop = int(index[n, 0]) if len(index) > n else int(row.n_bytes)
                store, path = open_store(f"{folder}/{row.file}.rec")
                with store.open_input_file(path) as f:
                    payloads = unframe(f.read_at(stop - begin, begin), index[:n, 0] - begin)
                heads = [struct.unpack_from("<qBBH", p) for p in payloads]
                ids = [np.frombuffer(p, f"<u{h[2]}", offset=_PREFIX) for p, h in zip(payloads, heads)]
                yield pd.DataFrame(
                    {
                        "key": pd.array([None if h[1] else h[0] for h in heads], "Int64"),
                        "start": index[:n, 1] + int(row.base),
                        "n_tokens": [len(x) for x in ids],
                    }
                    | (use(ids) if use else {"ids": [x.astype("int32") for x in ids]})
                )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    ranges = files.repartition(parts, "file").mapInPandas(
        cut, "file string, base bigint, n_bytes bigint, first bigint, last bigint"
    )
    return ranges.repartition(parts, "file", "first").mapInPandas(
        read, f"key bigint, start bigint, n_tokens bigint, {schema if use else 'ids array<int>'}"
    )


def ids_crc32(ids: list[np.ndarray]) -> dict:
    """Unsigned CRC-32 of each document's ids as little-endian unsigned 32-bit integers."""
    return {"ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]}


def records_round_trip(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes all documents and reads them back: key, start, n_tokens, ids_crc32."""
    folder = new_folder(df.sparkSession, "records")
    manifest = write_records(df, tokenizer_path, folder, key, text)
    back = read_records(df.sparkSession, folder, manifest, ids_crc32, "ids_crc32 bigint")
    return back.withColumnRenamed("key", key)
