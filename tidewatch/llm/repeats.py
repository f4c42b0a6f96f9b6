"""Removal of repeated byte strings by suffix buckets that are refined with the buckets of later offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import id_and_text
from tidewatch.llm.slices import SCHEMA, SLICE_BYTES, TEXTS, Slice, bucket_of, by, cut, cut_slices, groups, pack, ragged, rows_of, unpack
from tidewatch.llm.words import mix
from tidewatch.sources.tables import Scratch

#: Bytes of a string whose repetition counts.
LENGTH = 50
#: Bytes of the grams that suffixes are first sorted by, and of those by which strings are dealt to tasks.
FIRST, GRAM = 8, 20
#: Buckets at least, more than tasks, so that these get even shares; and bytes of text whose strings share one, on average, beyond that.
LEAST_BUCKETS = 256
BUCKET_BYTES = 16 << 20
#: Bytes of pieces whose strings are sorted together, beyond what is under one key.
SORTED_BYTES = 2 << 20
#: Strings of one piece at most, so that a text without variety is cut into like pieces too.
PIECE = 64
#: Pieces under one key beyond which their strings are dealt one by one.
CROWD = 10_000
#: Bits of a key.
KEY_BITS = 48
#: Positions that are hashed together.
CHUNK = 1 << 18

#: What a row holds beside the texts of a slice: for its keys in a bucket whether others have them; for its pieces in a bucket who has their strings first.
SHARED, FOUND = TEXTS + 1, TEXTS + 2
OUT_SCHEMA = "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

#: Random values of the bytes and factors for the doubled lengths; fixed so that every task computes the same hashes.
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64)
_STEPS = np.array([xxhash.xxh64_intdigest(f"step {i}".encode()) | 1 for i in range(32)], dtype=np.uint64)
NEVER = np.iinfo(np.int64).max


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` bytes from each place on, put together from those of doubled lengths."""
    level, covered, out = _BYTES[data], 0, None
    for bit in range(length.bit_length()):
        if length >> bit & 1:
            if out is None:
                out = level
            else:
                m = len(data) - covered - (1 << bit) + 1
                out = out[:m] * _STEPS[16 + bit] + level[covered : covered + m]
            covered += 1 << bit
        if length >> bit > 1:
            level = level[: -(1 << bit)] * _STEPS[bit] + level[1 << bit :]
    return mix(out[: len(data) - length + 1])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :])


class Pieces(Slice):
    """A slice whose texts are cut into pieces."""

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces: first place and number of strings, key, document.

        A string's key is the least hash of the ``GRAM``-byte grams in it, so equal strings have equal keys wherever they are, and neighbouring strings
        mostly share one. A piece are neighbouring strings of one key. Documents without identifier have none.
        """
        inside = np.flatnonzero((self.ends - self.begins >= length) & self.has)
        first, count, key, row = [], [], [], []
        width = length - GRAM + 1
        for doc in inside.tolist():
            begin, last = int(self.begins[doc]), int(self.ends[doc]) - length + 1
            for at in range(begin, last, CHUNK):
                till = min(at + CHUNK, last)
                least = least_of(gram_hashes(self.data[at : till + length - 1], GRAM), width)
                new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
                size = np.diff(new, append=len(least))
                parts = -(-size // PIECE)
                owner, place = ragged(parts)
                first.append(at + new[owner] + place * PIECE)
                count.append(np.minimum(size[owner] - place * PIECE, PIECE))
                key.append(least[new][owner])
                row.append(np.full(len(owner), doc))
        if not first:
            return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        # The least of many hashes is small; mixed again, keys fall evenly into buckets. 48 bits tell them apart well enough: two that clash cost time only.
        return np.concatenate(first), np.concatenate(count), mix(np.concatenate(key)) >> np.uint64(64 - KEY_BITS), np.concatenate(row)


def _keys(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct keys of each slice by bucket, whether several documents of the slice have one, and about how many different pieces."""
    for _, held in groups(batches, "slice"):
        part = Pieces(held[0]["blob"])
        first, count, key, row = part.runs(length)
        if not len(key):
            continue
        # A piece is told apart by its ends and its length: enough to see a crowd.
        ends = np.zeros(len(first), np.uint64)
        for j in range(0, 16):
            ends = ends * _STEPS[0] + _BYTES[part.data[first + j]] * _STEPS[1] + _BYTES[part.data[first + count + (length - 2 - j)]]
        order = np.lexsort((ends, key))
        own, docs, ends = key[order], part.ids[row[order]], ends[order]
        names, begin = np.unique(own, return_index=True)
        least, most = np.minimum.reduceat(docs, begin), np.maximum.reduceat(docs, begin)
        other = np.concatenate([[True], (own[1:] != own[:-1]) | (ends[1:] != ends[:-1])]).astype(np.int64)
        pieces = np.minimum(np.add.reduceat(other, begin), 255).astype("u1")
        several = (least < most).astype("u1")
        name = held[0]["slice"]
        yield rows_of(
            [(name, SHARED, b, j - i, pack(np.diff(names[i:j], prepend=np.uint64(0)), several[i:j], pieces[i:j])) for b, i, j in cut(bucket_of(names, buckets, KEY_BITS))]
        )


def _meet(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """For each slice and bucket: 0 for a key of one document, 1 for one of several, 2 for a crowded one."""
    for bucket, held in groups(batches, "bucket"):
        parts = [unpack(row["blob"], "<u8", "u1", "u1") for row in held]
        keys = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
        several, pieces = (np.concatenate([x[k] for x in parts]) for k in (1, 2))
        names, at = np.unique(keys, return_inverse=True)
        shared = np.bincount(at, 1 + several.astype(np.int64), minlength=len(names)) > 1
        state = np.where(shared, 1 + (np.bincount(at, pieces, minlength=len(names)) > crowd), 0).astype("u1")[at]
        begin = 0
        for row, x in zip(held, parts, strict=True):
            end = begin + len(x[0])
            if state[begin:end].any():
                yield rows_of([(row["slice"], SHARED, bucket, end - begin, pack(state[begin:end]))])
            begin = end


def cut_pieces(part: Pieces, states: dict[int, bytes], length: int, buckets: int) -> Iterator[tuple]:
    """For each bucket in order: the distinct pieces of a slice under keys that several documents have, their keys, and where they occur.

    Occurrences are the number of the piece, the document and the first place. A crowded key's pieces are cut into single strings under keys
    of their own, so that what the strings have around them spreads one frequent passage over many buckets. The same slice and states always give the same.
    """
    first, count, key, row = part.runs(length)
    names = np.unique(key)
    state = np.zeros(len(names), "u1")
    for b, i, j in cut(bucket_of(names, buckets, KEY_BITS)):
        if b in states:
            state[i:j] = unpack(states[b], "u1")[0]
    own = state[np.searchsorted(names, key)] if len(names) else state
    crowded = own == 2
    if crowded.any():
        owner, place = ragged(count[crowded])
        single = first[crowded][owner] + place
        name = np.zeros(len(single), np.uint64)
        for j in range(length):
            name = name * _STEPS[2] + _BYTES[part.data[single + j]]
        shared = own == 1
        first, count = np.concatenate([first[shared], single]), np.concatenate([count[shared], np.ones(len(single), np.int64)])
        row = np.concatenate([row[shared], row[crowded][owner]])
        key = np.concatenate([key[shared], mix(name) >> np.uint64(64 - KEY_BITS)])
    else:
        first, count, key, row = (x[own == 1] for x in (first, count, key, row))
    if not len(first):
        return
    bucket = bucket_of(key, buckets, KEY_BITS)
    order = np.argsort(bucket, kind="stable")
    first, count, key, row = first[order], count[order], key[order], row[order]
    text = part.data.tobytes()
    for b, i, j in cut(bucket[order]):
        seen: dict[bytes, int] = {}
        begins, ends = first[i:j].tolist(), (first[i:j] + count[i:j] + (length - 1)).tolist()
        which = np.array([seen.setdefault(text[x:y], len(seen)) for x, y in zip(begins, ends, strict=True)], dtype=np.int64)
        keys = np.zeros(len(seen), np.uint64)
        keys[which] = key[i:j]
        yield b, list(seen), keys, which, row[i:j], first[i:j]


def _states(held: list[dict], kind: int) -> dict[int, bytes]:
    return {row["bucket"]: row["blob"] for row in held if row["kind"] == kind}


def _pieces(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct pieces of each slice by bucket, with the least and largest document that has each."""
    for name, held in groups(batches, "slice"):
        states = _states(held, SHARED)
        if not states:
            continue
        part = Pieces(held[0]["blob"])
        for b, pieces, keys, which, row, _ in cut_pieces(part, states, length, buckets):
            low, high = np.full(len(pieces), NEVER), np.full(len(pieces), -NEVER)
            np.minimum.at(low, which, part.ids[row])
            np.maximum.at(high, which, part.ids[row])
            sizes = np.array([len(x) - length + 1 for x in pieces], "u1")
            yield rows_of([(name, FOUND, b, len(pieces), pack(keys, sizes, low, high, np.frombuffer(b"".join(pieces), np.uint8)))])


def suffix_buckets(data: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``data`` the bucket of the ``length`` bytes that begin there, where so many follow.

    Bucket-pointer refinement. Suffixes are sorted by their first 8 bytes; a suffix's pointer is the last slot of its bucket in the suffix array.
    A bucket of more than one suffix is refined by sorting it on the pointers of the places as many bytes on as it is already sorted by, and
    its parts get pointers of their own, which the next, twice as far, refinement uses again. Settled buckets are left alone. Pointers rise with the bytes, so equal pointers mean equal strings.
    """
    grams, size = data.astype(np.uint64), 1
    while size < FIRST:
        grams = (grams[:-size] << np.uint64(8 * size)) | grams[size:]
        size *= 2
    n = len(grams)
    array = np.argsort(grams)
    ranked = grams[array]
    last = np.append(ranked[1:] != ranked[:-1], True)
    pointer = np.empty(n, np.int64)
    pointer[array] = np.flatnonzero(last)[np.cumsum(last) - last]
    covered = FIRST
    while covered < length:
        step = min(covered, length - covered)
        ends = np.flatnonzero(last)
        sizes = np.diff(ends, prepend=-1)
        slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(slots):
            break
        members = array[slots]
        ahead = np.where(members + step < n, pointer[np.minimum(members + step, n - 1)], -1)
        refined = pointer[members] * (n + 1) + ahead + 1
        order = np.argsort(refined)
        members, refined = members[order], refined[order]
        array[slots] = members
        closes = np.append(refined[1:] != refined[:-1], True)
        last[slots] = closes
        pointer[members] = slots[closes][np.cumsum(closes) - closes]
        covered += step
    return pointer


def first_documents(pieces: list[bytes], keys: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Who has each string of distinct pieces first: piece, first and last string, and document of runs of strings with one answer.

    ``low`` is the least document of each piece. A piece that is alone under its key shares no string with another one.
    """
    count = np.array([len(x) - length + 1 for x in pieces], np.int64)
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(times[at] > 1)
    owner, place = ragged(count)
    least = low[owner]
    if len(mixed):
        data = np.frombuffer(b"".join([pieces[i] for i in mixed.tolist()]), np.uint8)
        begin = np.cumsum(count[mixed] + (length - 1)) - (count[mixed] + (length - 1))
        member, inner = ragged(count[mixed])
        pointer = suffix_buckets(data, length)[begin[member] + inner]
        best = np.full(len(data), NEVER)
        np.minimum.at(best, pointer, low[mixed][member])
        start = np.cumsum(count) - count
        least[start[mixed][member] + inner] = best[pointer]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])]))
    size = np.diff(new, append=len(owner))
    return owner[new], place[new], place[new] + size - 1, least[new]


def _refine(batches: Iterator[pa.RecordBatch], length: int, sorted_bytes: int = SORTED_BYTES) -> Iterator[pa.RecordBatch]:
    """For each slice and bucket: runs of strings of its pieces that a smaller document has than the largest of the slice that has the piece.

    Equal strings have equal keys, so a bucket is worked off in parts of about ``sorted_bytes`` that end between keys: what is sorted at a time doesn't
    grow with the bucket.
    """
    for bucket, held in groups(batches, "bucket"):
        slices, columns, texts = [row["slice"] for row in held], [], []
        for row in held:
            *numbers, text = unpack(row.pop("blob"), "<u8", "u1", "<i8", "<i8", "u1")
            columns.append(numbers)
            texts.append(text.tobytes())
        until = np.cumsum([len(x[0]) for x in columns])
        source = np.repeat(np.arange(len(columns), dtype=np.int32), np.diff(until, prepend=0))
        ends = np.concatenate([np.cumsum(x[1], dtype=np.int64) + (length - 1) * np.arange(1, len(x[1]) + 1) for x in columns])
        keys, sizes, low, high = (np.concatenate(column) for column in zip(*columns, strict=True))
        del columns
        sizes = sizes.astype(np.int64) + (length - 1)
        order = np.argsort(keys, kind="stable")
        before = np.cumsum(sizes[order]) // sorted_bytes
        # The pieces of a key go with its first one.
        _, begin, times = np.unique(keys[order], return_index=True, return_counts=True)
        found = []
        for _, i, j in cut(np.repeat(before[begin], times)):
            own = order[i:j]
            names: dict[bytes, int] = {}
            at = zip(source[own].tolist(), ends[own].tolist(), sizes[own].tolist(), strict=True)
            which = np.array([names.setdefault(texts[k][y - n : y], len(names)) for k, y, n in at], np.int64)
            key, least = np.zeros(len(names), np.uint64), np.full(len(names), NEVER)
            key[which] = keys[own]
            np.minimum.at(least, which, low[own])
            owner, first, last, doc = first_documents(list(names), key, least, length)
            runs = np.bincount(owner, minlength=len(names))
            piece, place = ragged(runs[which])
            run = (np.cumsum(runs) - runs)[which][piece] + place
            use = doc[run] < high[own][piece]
            piece, run = own[piece[use]], run[use]
            found.append((piece, first[run].astype("u1"), last[run].astype("u1"), doc[run]))
        piece, first, last, doc = (np.concatenate(column) for column in zip(*found, strict=True))
        # Back in the order of the slices and their pieces.
        again = np.argsort(piece, kind="stable")
        row = np.searchsorted(until, piece[again], side="right")
        for r, i, j in cut(row):
            mine = again[i:j]
            start = until[r - 1] if r else 0
            blob = pack((piece[mine] - start).astype("<u4"), first[mine], last[mine], doc[mine])
            yield rows_of([(slices[r], FOUND, bucket, j - i, blob)])


def _remove(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The documents of each slice with the spans that are removed and what stays."""
    for _, held in groups(batches, "slice"):
        part, found = Pieces(held[0]["blob"]), _states(held, FOUND)
        n = len(part.data)
        starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b, pieces, _, which, row, first in cut_pieces(part, _states(held, SHARED), length, buckets) if found else ():
            if b not in found:
                continue
            piece, begin, last, doc = unpack(found[b], "<u4", "u1", "u1", "<i8")
            runs = np.bincount(piece, minlength=len(pieces))
            at = np.cumsum(runs) - runs
            owner, place = ragged(runs[which])
            run = at[which[owner]] + place
            use = doc[run] < part.ids[row[owner]]
            starts.append(first[owner[use]] + begin[run[use]])
            ends.append(first[owner[use]] + last[run[use]] + length)
        change = np.bincount(np.concatenate(starts), minlength=n + 1)
        change -= np.bincount(np.concatenate(ends), minlength=n + 1)
        gone = np.cumsum(change[:n]) > 0
        opens, closes = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        opens[part.begins], closes[part.ends] = True, True
        rise = np.flatnonzero(gone & (opens[:n] | ~np.concatenate([[False], gone[:-1]])))
        fall = np.flatnonzero(gone & (closes[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
        row = np.searchsorted(part.ends, rise, side="right")
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(part.ends)))]).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(rise - part.begins[row]), pa.array(fall - part.begins[row])], names=["begin", "end"])
        stays = np.concatenate([[0], np.cumsum(~gone)])
        kept = np.concatenate([[0], stays[part.ends]]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part.ids, mask=~part.has), pa.array(part.ends - part.begins),
                pa.ListArray.from_arrays(offsets, spans).cast(_SPANS),
                pa.Array.from_buffers(pa.binary(), len(part.ends), [None, pa.py_buffer(kept), pa.py_buffer(part.data[~gone].tobytes())]),
            ],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame, scratch: Scratch, length: int = LENGTH, slice_bytes: int = SLICE_BYTES, bucket_bytes: int = BUCKET_BYTES, crowd: int = CROWD
) -> DataFrame:
    """Removes every byte covered by a string of ``length`` bytes that also starts in a document with a smaller identifier.

    ``doc_id, n_bytes, spans, kept`` of every row: its UTF-8 bytes, the maximal removed runs and what stays. Matches never cross documents, overlaps
    count, and strings are judged on the input. Exact. Steps:

    1. Texts are cut into slices. Each string gets a key, the least hash of its 20-byte grams; neighbouring strings share keys. The distinct keys of
       each slice go to buckets by key, which tell the slices which of them several documents have (4 bytes a key, one for about 16 bytes of text).
    2. The pieces of text under those keys go to the same buckets, a piece once for each slice. In a bucket, distinct pieces form
       the suffix array whose buckets are refined (``suffix_buckets``) until they hold equal strings; the least document of each goes back.
    3. Each slice marks what its documents have from smaller ones.

    A bucket gets a piece once from a slice, however many copies there are, and the strings of a crowded key spread over all buckets, so
    neither large groups of copies nor frequent passages fill one task. What a task holds is one slice or one bucket beside Spark's sort.

    Null and empty texts are empty. A row without identifier is neither smaller nor larger than others: it stays whole and takes nothing from others. Rows that share an
    identifier take nothing from each other. Texts shorter than ``length`` stay. Other columns are not read. An empty table gives no rows.
    The tables behind the result live as long as ``scratch``.
    """
    if length < GRAM or length > 255 - PIECE:
        raise ValueError(f"strings may have {GRAM} to {255 - PIECE} bytes, not {length}")
    slices = scratch.store(id_and_text(docs).mapInArrow(lambda batches: cut_slices(batches, slice_bytes), SCHEMA), "slices")
    buckets = max(LEAST_BUCKETS, -(-(slices.agg(F.sum("size")).first()[0] or 0) // bucket_bytes))
    keys = slices.mapInArrow(lambda batches: _keys(batches, length, buckets), SCHEMA)
    shared = scratch.store(by(keys, "bucket").mapInArrow(lambda batches: _meet(batches, crowd), SCHEMA), "shared")
    pieces = by(slices.union(shared), "slice").mapInArrow(lambda batches: _pieces(batches, length, buckets), SCHEMA)
    found = scratch.store(by(pieces, "bucket").mapInArrow(lambda batches: _refine(batches, length), SCHEMA), "found")
    return by(slices.union(shared).union(found), "slice").mapInArrow(lambda batches: _remove(batches, length, buckets), OUT_SCHEMA)
