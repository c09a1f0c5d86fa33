"""Removal of byte strings that an earlier document holds too (operator 10).

All 50-byte suffix heads of all texts are to be sorted and equal ones found. Three steps keep what
is exchanged small without leaving any out:

1. Every window of 50 bytes has an anchor, its 20-byte part with the least hash. Equal windows have
   equal anchors, so a window whose anchor occurs in one document only is settled. Neighbouring
   windows with one anchor travel together, as a hash of their joint bytes; joint bytes equal to
   those of a smaller document settle all their windows.
2. The windows left (their anchor occurs elsewhere among other bytes: the ends of common passages)
   are sorted in every run, front-coded, and exchanged. Neighbouring windows that share the bytes
   around their anchor go to one bucket, where their overlap compresses.
3. Loser trees merge the sorted runs by their known common prefixes; neighbours with a common
   prefix of 50 bytes are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.loser_tree import front_code, merge
from barloom.llm.storage import open_store, return_memory
from barloom.session import new_folder, written

MIN_BYTES, GRAM_BYTES = 50, 20
#: Rows are stored in groups of about this many bytes; a group is a run.
RUN_BYTES = 8 << 20
#: Windows hashed at a time, and windows sorted at a time.
BLOCK, SORT = 1 << 18, 1 << 18
#: Bytes of text per bucket of the exchanges. A run sends every bucket a row, so both sizes should
#: grow with the executors' memory where the input is very large.
BUCKET_BYTES = 8 << 20
#: Step 1 goes by ranges of the anchors' keys, one after the other, so that the files of its exchange,
#: the most disk that any step takes, hold one range at a time; each range reads the texts again.
ROUNDS = 2
#: Windows whose anchor lies this far inside, and the bytes left and right of the anchor that all
#: of them hold: equal windows agree there.
_ZONES = ((22, 31, 22, 0), (15, 22, 15, 9), (8, 15, 8, 16), (0, 8, 0, 23))

#: Bits of a zone's print in the exchange: at least so many, and one more whenever the buckets double,
#: as a common anchor then meets twice as many others; so the windows that are left open by chance stay
#: a small share of all at any size.
_LEAST_PRINT, _PRINT = 16, 32
#: Bits of the number by which zones are dealt to buckets, and windows of one zone that stay together; the
#: windows of a more common one are dealt on to as many buckets as that takes.
_DEAL, _TOGETHER = 24, 1 << 14

_FLAG, _ENTRY, _OPEN, _SORTED = 0, 1, 2, 3
_BASE = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE^i and its inverse mod 2^64, i below n."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _print_bits(buckets: int) -> int:
    return min(max(_LEAST_PRINT, (buckets - 1).bit_length() + 9), _PRINT)


def _has_zone(n: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Per run of windows and zone whether it has windows there."""
    n, off = n[:, None].astype(np.int64), off[:, None].astype(np.int64)
    least, most = np.array(_ZONES)[:, :2].T
    return (off >= least) & (off - n + 1 < most)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Window hashes and anchors of a buffer of texts, block by block."""

    def __init__(self, size: int = MIN_BYTES, gram: int = GRAM_BYTES):
        if size - gram != MIN_BYTES - GRAM_BYTES:
            raise ValueError(f"size - gram must be {MIN_BYTES - GRAM_BYTES}, which the zones divide")
        self.size, self.gram = size, gram
        self.power, self.inverse = _powers(BLOCK + size + 1)

    def sums(self, part: np.ndarray) -> np.ndarray:
        terms = (part.astype(np.uint64) + np.uint64(1)) * self.power[: len(part)]
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))

    def of(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[begin]) * self.inverse[begin])

    def anchors(self, data: np.ndarray, offsets: np.ndarray, turn: int = 0, rounds: int = 1) -> dict[str, np.ndarray]:
        """Runs of windows with one anchor: ``pos``, ``n`` (windows), ``off`` (of the anchor), ``key``,
        ``joint``, ``zones``, ``doc``.

        ``joint`` is a hash of all bytes of the windows. ``zones`` has a print per zone of the bytes that its
        windows share around the anchor (0: no window there). ``key`` has 48 bits, in the upper ones.
        ``offsets`` are the texts' bounds in ``data``; no window crosses them. Of ``rounds`` equal ranges of
        keys, the runs of the one numbered ``turn`` are returned.
        """
        size, gram = self.size, self.gram
        out: dict[str, list[np.ndarray]] = {k: [] for k in ("pos", "n", "off", "key", "joint", "zones", "doc")}
        for begin in range(0, max(len(data) - size + 1, 0), BLOCK):
            part = data[begin : begin + BLOCK + size - 1]
            sums = self.sums(part)
            starts = np.arange(len(part) - gram + 1)
            least = self.of(sums, starts, starts + gram)
            grams, at, have = least, starts.astype(np.int32), 1
            want = size - gram + 1
            while have < want:
                step = min(have, want - have)
                right = least[step:] < least[:-step]
                at = np.where(right, at[step:], at[:-step])
                least = np.where(right, least[step:], least[:-step])
                have += step
            doc = np.searchsorted(offsets, np.arange(begin, begin + len(at)), "right") - 1
            whole = np.flatnonzero(np.arange(begin, begin + len(at)) + size <= offsets[doc + 1])
            if not len(whole):
                continue
            new = np.r_[True, (at[whole[1:]] != at[whole[:-1]]) | (whole[1:] != whole[:-1] + 1)]
            first = np.flatnonzero(new)
            pos, n = whole[first], np.diff(np.r_[first, len(whole)])
            anchor = at[pos]
            # Least hashes crowd at the low end; mixed once more, they deal out evenly.
            key = _mix(grams[anchor] + np.uint64(_BASE)) & ~np.uint64(0xFFFF)
            if rounds > 1:
                mine = np.flatnonzero((key >> np.uint64(32)) * np.uint64(rounds) >> np.uint64(32) == np.uint64(turn))
                pos, n, anchor, key = pos[mine], n[mine], anchor[mine], key[mine]
            off = anchor - pos
            joint = self.of(sums, pos, pos + n - 1 + size)
            joint = _mix(joint + (n * 64 + off).astype(np.uint64))
            zones, present = np.zeros((len(joint), len(_ZONES)), np.uint32), _has_zone(n, off)
            for z, (_, _, left, right) in enumerate(_ZONES):
                at_zone = np.flatnonzero(present[:, z])
                a = anchor[at_zone] - left
                zones[at_zone, z] = self.of(sums, a, a + left + gram + right) >> np.uint64(64 - _PRINT)
            found = {"pos": pos + begin, "n": n, "off": off, "key": key, "joint": joint, "zones": zones, "doc": doc[pos]}
            for k, v in found.items():
                out[k].append(v.astype(np.int32) if k in ("n", "off", "doc") else v)
        empty = {k: np.zeros(0, np.uint64) for k in ("key", "joint")} | {"zones": np.zeros((0, len(_ZONES)), np.uint32)}
        return {k: np.concatenate(v) if v else empty.get(k, np.zeros(0, np.int64)) for k, v in out.items()}


def pack(columns: dict[str, np.ndarray]) -> bytes:
    """Integer columns as compressed byte planes; a sorted ``key`` as differences."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1)
    parts = []
    for name, values in columns.items():
        values = np.ascontiguousarray(values).astype(np.uint64)
        n = len(values)
        if name == "key" and n:
            values = np.r_[values[:1], values[1:] - values[:-1]]
        data = squeeze.compress(np.ascontiguousarray(values.view(np.uint8).reshape(n, 8).T).tobytes())
        parts += [n.to_bytes(4, "little"), len(data).to_bytes(4, "little"), data]
    return b"".join(parts)


def unpack(data: bytes, names: list[str]) -> dict[str, np.ndarray]:
    import zstandard

    at, out = 0, {}
    for name in names:
        n, size = (int.from_bytes(data[at + k : at + k + 4], "little") for k in (0, 4))
        raw = zstandard.decompress(data[at + 8 : at + 8 + size], max_output_size=8 * n + 1)
        at += 8 + size
        values = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).reshape(n)
        out[name] = np.cumsum(values, dtype=np.uint64) if name == "key" else values
    return out


def _read(path: str, group: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stored run: bytes of all texts, their bounds, their keys, and where the key is null."""
    import pyarrow.parquet as pq

    store, name = open_store(path)
    with store.open_input_file(name) as f:
        table = pq.ParquetFile(f).read_row_group(group)
    keys = table.column("_key").combine_chunks()
    texts = table.column("_text").cast("large_binary").combine_chunks()
    texts = texts.chunk(0) if hasattr(texts, "chunks") and texts.num_chunks == 1 else texts
    _, bounds, body = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    null = keys.is_null().to_numpy(zero_copy_only=False)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0], keys.fill_null(_LAST).to_numpy(), null


def _groups(path: str) -> int:
    import pyarrow.parquet as pq

    store, name = open_store(path)
    with store.open_input_file(name) as f:
        return pq.ParquetFile(f).metadata.num_row_groups


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _least(new: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per row the first ``doc`` of its group, for rows sorted by group and doc."""
    return doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(new) else doc


_ROW = "bucket int, file int, grp int, kind int, data binary"
_FOUND = "file int, grp int, kind int, data binary"


def _flags(pos: np.ndarray, n: np.ndarray, size: int) -> bytes:
    """Windows as merged intervals: begins (``key``) and lengths."""
    order = np.argsort(pos, kind="stable")
    begin, end = pos[order].astype(np.int64), (pos[order] + n[order] + (size - 1)).astype(np.int64)
    reach = np.maximum.accumulate(end)
    new = np.r_[True, begin[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return pack({"key": begin[first], "length": reach[np.r_[first[1:] - 1, len(end) - 1]] - begin[first]})


def _entries(paths: list[str], buckets: int, size: int, gram: int, turn: int = 0, rounds: int = 1):
    """Step 1, per run and range of keys: anchors seen first here go to their bucket, later copies are flagged."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return_memory()
        hasher, unsent = Hasher(size, gram), np.uint32(_PRINT - _print_bits(buckets))
        for file in (f for b in batches for f in b["file"]):
            for group in range(_groups(paths[file])):
                data, offsets, keys, _ = _read(paths[file], group)
                found = hasher.anchors(data, offsets, turn, rounds)
                doc = keys[found["doc"]]
                order = np.lexsort((doc, found["joint"], found["key"]))
                key, joint, doc = found["key"][order], found["joint"][order], doc[order]
                pos, n, off, zones = (found[k][order] for k in ("pos", "n", "off", "zones"))
                del found, order
                least = _least(_starts(key, joint), doc)
                rows = []
                if (late := doc > least).any():
                    rows.append((file % buckets, file, group, _FLAG, _flags(pos[late], n[late], size)))
                key, joint, zones, doc, pos, n, off = (x[~late] for x in (key, joint, zones, doc, pos, n, off))
                bucket = (key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                has = _has_zone(n, off)
                for b in np.flatnonzero(np.diff(cuts)):
                    s = slice(cuts[b], cuts[b + 1])
                    prints = zones[s][has[s]] >> unsent
                    blob = pack(
                        {"key": key[s], "joint": joint[s], "doc": doc[s], "pos": pos[s], "shape": n[s] * 64 + off[s], "prints": prints}
                    )
                    rows.append((int(b), file, group, _ENTRY, blob))
                yield pd.DataFrame(rows, columns=["bucket", "file", "grp", "kind", "data"])

    return find


def _settle(size: int):
    """Step 1, per bucket: flags windows with equal joint bytes in a smaller document, and leaves
    open the zones that share the anchor and the bytes around it with another document."""
    names = ["key", "joint", "doc", "pos", "shape", "prints"]

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        return_memory()
        out = [(r.file, r.grp, _FLAG, r.data) for r in rows.itertuples() if r.kind == _FLAG]
        runs = [(r.file, r.grp) for r in rows.itertuples() if r.kind == _ENTRY]
        parts = [unpack(r.data, names) for r in rows.itertuples() if r.kind == _ENTRY]
        if not parts:
            return pd.DataFrame(out, columns=["file", "grp", "kind", "data"])
        run = np.repeat(np.arange(len(runs), dtype=np.int32), [len(p["key"]) for p in parts])
        key, joint, doc, pos, shape, prints = (np.concatenate([p.pop(k) for p in parts]) for k in names)
        doc, pos, shape = doc.astype(np.int64), pos.astype(np.int64), shape.astype(np.int32)
        present = _has_zone(shape >> 6, shape & 63)
        zones = np.zeros(present.shape, np.uint32)
        zones[present] = prints
        del parts, prints
        order = np.lexsort((doc, joint, key))
        key, joint, doc, pos, shape, run, zones, present = (x[order] for x in (key, joint, doc, pos, shape, run, zones, present))
        new_key, new = _starts(key), _starts(key, joint)
        least = _least(new, doc)
        late = doc > least
        n, off = shape >> 6, shape & 63

        def emit(kind: int, at: np.ndarray, begin: np.ndarray, count: np.ndarray, **more: np.ndarray) -> None:
            by_run = np.lexsort((begin, run[at]))
            at, begin, count = at[by_run], begin[by_run], count[by_run]
            more = {name: x[by_run] for name, x in more.items()}
            cuts = np.searchsorted(run[at], np.arange(len(runs) + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                s = slice(cuts[k], cuts[k + 1])
                if kind == _FLAG:
                    blob = _flags(begin[s], count[s], size)
                else:
                    blob = pack({"key": begin[s], "n": count[s], **{name: x[s] for name, x in more.items()}})
                out.append((*runs[k], kind, blob))

        at = np.flatnonzero(late)
        emit(_FLAG, at, pos[at], n[at])
        # Open: the anchor occurs with other bytes in another document ...
        begin = np.flatnonzero(new_key)
        several = np.minimum.reduceat(least, begin) < np.maximum.reduceat(least, begin)
        still = np.flatnonzero(several[np.cumsum(new_key) - 1] & ~late)
        # ... and so do the bytes that the windows of a zone share.
        for z, (least_off, most_off, _, _) in enumerate(_ZONES):
            at = still[present[still, z]]
            if not len(at):
                continue
            zone = zones[at, z]
            order = np.lexsort((zone, key[at]))
            at, zone = at[order], zone[order]
            group = _starts(key[at], zone)
            begin = np.flatnonzero(group)
            shared = np.minimum.reduceat(least[at], begin) < np.maximum.reduceat(least[at], begin)
            # Windows of the zone: the anchor's place in them falls from ``off`` by one each.
            skip = np.maximum(off[at] - most_off + 1, 0)
            count = np.minimum(n[at], off[at] - least_off + 1) - skip
            # Equal windows have equal zones, so they are dealt to one bucket.
            deal = _mix(key[at] ^ _mix(zone.astype(np.uint64) * np.uint64(len(_ZONES)) + np.uint64(z))) >> np.uint64(64 - _DEAL)
            spread = 1 + np.add.reduceat(count.astype(np.int64), begin) // _TOGETHER
            kept = shared[np.cumsum(group) - 1]
            emit(_OPEN, at[kept], (pos[at] + skip)[kept], count[kept], deal=deal[kept], spread=spread[np.cumsum(group) - 1][kept])
        return pd.DataFrame(out, columns=["file", "grp", "kind", "data"])

    return settle


def _sort_open(paths: list[str], buckets: int, size: int, gram: int):
    """Step 2, per run: the open windows as sorted, front-coded strings by bucket."""

    def sort(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        return_memory()
        squeeze = zstandard.ZstdCompressor(level=1)
        file, group = int(rows["file"].iloc[0]), int(rows["grp"].iloc[0])
        data, offsets, keys, _ = _read(paths[file], group)
        names = ["key", "n", "deal", "spread"]
        parts = [unpack(d, names) for d in rows["data"]]
        begin, n, deal, spread = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in names)
        by_place = np.argsort(begin)
        begin, n, deal, spread = (x[by_place] for x in (begin, n, deal, spread))
        pos = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at_bucket, spread = np.repeat(deal * buckets >> _DEAL, n), np.repeat(spread, n)
        if len(common := np.flatnonzero(spread > 1)):
            hasher, at = Hasher(size, gram), pos[common]
            hashes = np.zeros(len(at), np.uint64)
            for first in range(0, len(data), BLOCK):
                lo, hi = np.searchsorted(at, (first, first + BLOCK))
                if lo < hi:
                    sums = hasher.sums(data[first : first + BLOCK + size - 1])
                    hashes[lo:hi] = hasher.of(sums, at[lo:hi] - first, at[lo:hi] - first + size)
            on = (_mix(hashes) % spread[common].astype(np.uint64)).astype(np.int64)
            at_bucket[common] = (at_bucket[common] + on) % buckets
        # Windows by bucket, and by place within it.
        order = np.argsort(at_bucket, kind="stable")
        at_bucket, pos = at_bucket[order], pos[order]
        doc = keys[np.searchsorted(offsets, pos, "right") - 1]
        windows = np.lib.stride_tricks.sliding_window_view(data, size)
        # Whole buckets of about SORT windows at a time.
        ends = np.flatnonzero(np.r_[at_bucket[1:] != at_bucket[:-1], True]) + 1
        ends = ends[np.r_[ends[1:] // SORT != ends[:-1] // SORT, True]]
        out = []
        for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
            w = np.arange(start, end)
            strings = np.empty((len(w), size + 1), np.uint8)
            strings[:, :size], strings[:, size] = windows[pos[w]], 1  # the last byte keeps zero bytes from being trimmed
            # By bucket, then string, then document.
            bucket = at_bucket[w]
            order = np.lexsort((doc[w], strings.view(f"S{size + 1}").ravel(), bucket))
            w, strings, bucket = w[order], strings[order], bucket[order]
            same = np.r_[False, (strings[1:] == strings[:-1]).all(axis=1)]
            least = _least(~same, doc[w])
            late = doc[w] > least
            if late.any():
                out.append((file % buckets, file, group, _FLAG, _flags(pos[w[late]], np.ones(late.sum(), np.int64), size)))
            w, strings, bucket = w[~late], strings[~late], bucket[~late]
            new = np.flatnonzero(_starts(bucket))
            for lo, hi in zip(new.tolist(), [*new[1:].tolist(), len(bucket)]):
                common, rest = front_code(strings[lo:hi, :size])
                placed = np.sort(w[lo:hi])
                head = pack(
                    {"common": common, "place": np.searchsorted(placed, w[lo:hi]), "key": pos[placed], "doc": doc[placed]}
                )
                out.append((int(bucket[lo]), file, group, _SORTED, len(head).to_bytes(8, "little") + head + squeeze.compress(rest)))
        return pd.DataFrame(out, columns=["bucket", "file", "grp", "kind", "data"])

    return sort


def _merge_bucket(size: int):
    """Step 3, per bucket: merges the runs and flags strings that a smaller document holds."""

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        return_memory()
        out = [(r.file, r.grp, _FLAG, r.data) for r in rows.itertuples() if r.kind == _FLAG]
        runs = [r for r in rows.itertuples() if r.kind == _SORTED]
        heads, rests = [], []
        for r in runs:
            n = int.from_bytes(r.data[:8], "little")
            head = unpack(r.data[8 : 8 + n], ["common", "place", "key", "doc"])
            place = head.pop("place").astype(np.int64)
            heads.append({"common": head["common"], "doc": head["doc"][place], "pos": head["key"][place]})
            rests.append(zstandard.decompress(r.data[8 + n :], max_output_size=size * len(place) + 1))
        docs = [h["doc"].astype(np.int64).tolist() for h in heads]
        late: list[list[int]] = [[] for _ in runs]
        equal: list[tuple[int, int]] = []

        def close() -> None:
            least = min(docs[r][i] for r, i in equal)
            for r, i in equal:
                if docs[r][i] > least:
                    late[r].append(i)

        for run, place, common in merge([(h["common"].tolist(), rest) for h, rest in zip(heads, rests)], size):
            if common < size:
                if len(equal) > 1:
                    close()
                equal.clear()
            equal.append((run, place))
        if len(equal) > 1:
            close()
        for r, h, places in zip(runs, heads, late):
            if places:
                out.append((r.file, r.grp, _FLAG, _flags(h["pos"][places], np.ones(len(places), np.uint64), size)))
        return pd.DataFrame(out, columns=["file", "grp", "kind", "data"])

    return combine


def _cut(paths: list[str], content: bool):
    """Per file: every text without its flagged bytes."""

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        return_memory()
        file = int(rows["file"].iloc[0])
        flagged: dict[int, list[bytes]] = {}
        for g, d in zip(rows["grp"], rows["data"]):
            if d is not None:
                flagged.setdefault(int(g), []).append(d)
        parts = []
        for group in range(_groups(paths[file])):
            data, offsets, keys, null = _read(paths[file], group)
            edge = np.zeros(len(data) + 1, np.int32)
            for blob in flagged.get(group, []):
                spans = unpack(blob, ["key", "length"])
                np.add.at(edge, spans["key"].astype(np.int64), 1)
                np.add.at(edge, (spans["key"] + spans["length"]).astype(np.int64), -1)
            gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
            total = np.concatenate((np.zeros(1, np.int32), np.cumsum(gone, dtype=np.int32)))
            removed = total[offsets[1:]] - total[offsets[:-1]]
            out = {"begins": [], "ends": [], "sha": [], "kept": []}
            for a, b, r in zip(offsets[:-1].tolist(), offsets[1:].tolist(), removed.tolist()):
                mask = gone[a:b]
                change = np.flatnonzero(np.diff(np.r_[0, mask.view(np.int8), 0])) if r else np.zeros(0, np.int64)
                kept = (data[a:b][~mask] if r else data[a:b]).tobytes()
                out["begins"].append(change[::2])
                out["ends"].append(change[1::2])
                out["sha"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept if content else None)
            parts.append(
                pd.DataFrame(
                    {
                        "key": pd.array(keys, "Int64"),
                        "n_bytes": np.diff(offsets),
                        "n_removed": removed,
                        "n_spans": [len(x) for x in out["begins"]],
                        "kept_sha256": out["sha"],
                        "begins": out["begins"],
                        "ends": out["ends"],
                        "kept": out["kept"],
                    }
                )
            )
            parts[-1].loc[null, "key"] = pd.NA
        return pd.concat(parts) if parts else pd.DataFrame(columns=_CUT_COLUMNS)

    return cut


_CUT = (
    "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
    "begins array<bigint>, ends array<bigint>, kept binary"
)
_CUT_COLUMNS = [c.split()[0] for c in _CUT.split(", ")]


def remove_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = MIN_BYTES,
    gram: int = GRAM_BYTES,
    content: bool = False,
) -> DataFrame:
    """One row per input row: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``,
    ``begins`` and ``ends`` (removed runs in bytes of the UTF-8 text), ``kept`` (if ``content``).

    A byte goes if a string of ``size`` bytes that covers it starts in a row with a smaller key too.

    Nulls: a null text is empty; a null key is larger than every other, and null keys do not remove
    from each other. Rows with the same key do not remove from each other. Texts under ``size``
    bytes stay whole. Empty table: no rows. Other columns are not read.

    Scale: texts are stored once in the shared folder; tasks read them back by run, so texts cross
    no shuffle. What a run has itself seen in a smaller document is settled there, so a passage
    that a third of all rows share is one entry per run in the exchange. Buckets are hash ranges
    whose number follows the bytes of the input. Very long texts are hashed block by block.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "texts")
    rows = df.select(F.col(key).cast("bigint").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows.write.option("compression", "zstd").option("parquet.block.size", RUN_BYTES).parquet(folder)
    stored = spark.read.schema(rows.schema).parquet(folder)
    paths = sorted(stored.inputFiles())
    total = stored.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    files = spark.createDataFrame([(i,) for i in range(len(paths))], "file int").repartition(max(len(paths), 1), "file")
    settled = []
    for turn in range(ROUNDS):
        entries = files.mapInPandas(_entries(paths, buckets, size, gram, turn, ROUNDS), _ROW).repartition(-(-buckets // ROUNDS), "bucket")
        settled.append(written(entries.groupBy("bucket").applyInPandas(_settle(size), _FOUND), "settled"))
    first = reduce(DataFrame.unionByName, settled)
    runs = first.where(F.col("kind") == _OPEN).groupBy("file", "grp").applyInPandas(_sort_open(paths, buckets, size, gram), _ROW)
    second = runs.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_merge_bucket(size), _FOUND)
    flags = first.where(F.col("kind") == _FLAG).unionByName(second).select("file", "grp", "data")
    every = files.select("file", F.lit(None).cast("int").alias("grp"), F.lit(None).cast("binary").alias("data"))
    return flags.unionByName(every).groupBy("file").applyInPandas(_cut(paths, content), _CUT).withColumnRenamed("key", key)
