"""A Spark data source for BAM: files are read in parts by many tasks, written in parts with an index.

A BAM file is a row of small gzip members (BGZF blocks); a virtual offset is the byte where a block starts,
shifted by 16 bits, plus the place inside its inflated data. A partition is a range of blocks. A
task finds the first block of its range, then the first record in it; records that start in the range
are its own, the last one ends in the next. With an index, partitions are the chunks of a region, whose
virtual offsets are known.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = (
    "sample string, qname string, flag int, chrom string, start0 long, end0 long, mapq int, cigar string, mate_chrom string, "
    "mate_start0 long, insert_size int, seq string, qual string, tags array<string>, ord long"
)
#: Compressed bytes of a partition; inflated bytes that must hold whole records before a place counts as a record's start.
SPLIT_BYTES, PROOF = 32 << 20, 1 << 16
#: Parts of a whole read from which on they get longer than asked, up to SPLIT_BYTES: a task costs as much as some 100 kB.
PARTS = 1_000
#: Inflated bytes whose records are decoded at once.
DECODED = 2 << 20
# Fixed values of the format.
MAGIC, EMPTY_BLOCK = b"\x1f\x8b\x08\x04", bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
TAG_TYPES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
CONSUMES = (1, 0, 1, 1, 0, 0, 0, 1, 1)  # operations that advance on the reference
ON_READ = (1, 1, 0, 0, 1, 0, 0, 1, 1)  # and on the read
PRINTED = bytes(range(33, 127))  # characters of names
PAIRS = np.array([[ord(a), ord(b)] for a in BASES for b in BASES], np.uint8)
CODES = np.array([BASES.index(c) if (c := chr(i).upper()) in BASES else 15 for i in range(256)], np.uint8)
FIXED = np.dtype([(n, f"<{t}") for n, t in zip("ref pos name mapq bin ops flag length mate mate_pos insert".split(), "i4 i4 u1 u1 u2 u2 u2 i4 i4 i4 i4".split())])
MIN_SHIFT, BAI_DEPTH = 14, 5
FULL = 65_280  # bytes of data in a block at most


# --- blocks -------------------------------------------------------------------------------------
def block_size(data, at: int) -> int:
    """Bytes of the gzip member at ``at`` by its BC field; 0 if there is none."""
    if len(data) < at + 18 or bytes(data[at : at + 4]) != MAGIC:
        return 0
    k, end = at + 12, at + 12 + int.from_bytes(data[at + 10 : at + 12], "little")
    while k + 4 <= min(end, len(data)):
        n = int.from_bytes(data[k + 2 : k + 4], "little")
        if bytes(data[k : k + 2]) == b"BC" and n == 2:
            return int.from_bytes(data[k + 4 : k + 6], "little") + 1
        k += 4 + n
    return 0


def pack_block(data: bytes, level: int = 6) -> bytes:
    """One BGZF block of at most 65,280 bytes of data."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    if len(body) > 65_000:  # what doesn't compress is stored
        z = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = z.compress(data) + z.flush()
    head = MAGIC + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def located(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before that in a path's name."""
    if "://" not in path:
        path = posixpath.abspath(path.removeprefix("file:"))
    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: path.index(inner)] if inner in path else ""


def open_file(path: str) -> tuple[pa.NativeFile, int]:
    system, inner, _ = located(path)
    return system.open_input_file(inner), system.get_file_info(inner).size


class Blocks:
    """Inflated blocks of a file from a byte that starts one."""

    def __init__(self, file: pa.NativeFile, size: int, at: int) -> None:
        self.file, self.size, self.at, self.base, self.held = file, size, at, at, b""

    def next(self) -> tuple[int, bytes] | None:
        """(byte where the block starts, its data); None at the end of the file."""
        if self.at >= self.size:
            return None
        i = self.at - self.base
        if len(self.held) - i < 1 << 16 and self.base + len(self.held) < self.size:
            self.file.seek(self.at)
            self.base, self.held, i = self.at, self.file.read(1 << 20), 0
        n = block_size(self.held, i)
        if not n or i + n > len(self.held):
            raise ValueError("truncated or damaged BGZF file")
        data = zlib.decompress(memoryview(self.held)[i : i + n], 31)
        at, self.at = self.at, self.at + n
        return at, data


def first_block(file: pa.NativeFile, size: int, at: int) -> int:
    """The first byte from ``at`` on that starts a block; the next one must follow it. The file's size if none does."""
    if at >= size:
        return size
    file.seek(at)
    held = file.read(1 << 18)
    i = held.find(MAGIC)
    while i >= 0:
        n = block_size(held, i)
        if n and (at + i + n == size or block_size(held, i + n)):
            return at + i
        i = held.find(MAGIC, i + 1)
    if at + len(held) < size:
        raise ValueError("no BGZF block in 256 kB")
    return size


# --- records ------------------------------------------------------------------------------------
@dataclass
class Header:
    text: str
    refs: list[tuple[str, int]]
    first: int  # virtual offset of the first record

    @property
    def is_sorted(self) -> bool:
        return "\tSO:coordinate" in self.text.split("\n", 1)[0]


class Records:
    """Inflated data as a stream that knows the virtual offset of any place in it."""

    def __init__(self, blocks: Blocks, skip: int = 0) -> None:
        self.blocks, self.data, self.at, self.marks = blocks, b"", 0, []
        if skip:
            self.need(skip)
            self.at = skip

    def need(self, n: int, stop: int = 1 << 62) -> bool:
        """Whether n bytes follow; blocks from the virtual offset ``stop`` on are not read for them."""
        parts, have = [], len(self.data) - self.at
        while have < n and self.blocks.at << 16 < stop and (b := self.blocks.next()):
            self.marks.append((len(self.data) + sum(map(len, parts)), b[0]))
            parts.append(b[1])
            have += len(b[1])
        if parts:
            self.data = b"".join([self.data, *parts])
        return have >= n

    def offset(self) -> int:
        """Virtual offset of the current place; the file's end if nothing follows."""
        if not self.need(1):
            return self.blocks.size << 16
        k = bisect_right(self.marks, (self.at, 1 << 62)) - 1
        return self.marks[k][1] << 16 | (self.at - self.marks[k][0])

    def drop(self) -> None:
        """Let go of what was read."""
        if self.at < 1 << 20:
            return
        k = max(bisect_right(self.marks, (self.at, 1 << 62)) - 1, 0)
        base = self.marks[k][0]
        self.data, self.at = self.data[base:], self.at - base
        self.marks = [(s - base, b) for s, b in self.marks[k:]]

    def take(self, n: int) -> bytes:
        if not self.need(n):
            raise ValueError("truncated BAM file")
        self.at += n
        return self.data[self.at - n : self.at]

    def starts(self, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, bytes, virtual offset) of the next whole records that start before ``stop``, places without their sizes; none at the end."""
        self.drop()
        self.need(DECODED, stop)
        size, places, k = struct.Struct("<i").unpack_from, [], self.at
        while self.need(1):
            data, n = self.data, len(self.data)
            while k + 4 <= n and (end := k + 4 + size(data, k)[0]) <= n:
                if end < k + 36:
                    raise ValueError("damaged BAM record")
                places.append(k)
                k = end
            if places:
                break
            if not self.need(4) or not self.need(4 + size(self.data, k)[0]):
                raise ValueError("truncated BAM file")
        at = np.array([*places, k], np.int64)
        marks = np.array(self.marks, np.int64).reshape(-1, 2)
        block = marks[np.searchsorted(marks[:, 0], at[:-1], "right") - 1]
        offset = block[:, 1] << 16 | (at[:-1] - block[:, 0])
        few = int(np.searchsorted(offset, stop))
        self.at = int(at[few])
        return at[:few] + 4, np.diff(at)[:few] - 4, offset[:few]


def read_header(file: pa.NativeFile, size: int) -> Header:
    data = Records(Blocks(file, size, 0))
    if data.take(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    number = lambda: struct.unpack("<i", data.take(4))[0]
    text = data.take(number()).rstrip(b"\0").decode()
    refs = []
    for _ in range(number()):
        name = data.take(number())[:-1].decode()
        refs.append((name, number()))
    return Header(text, refs, data.offset())


def plausible(data: bytes, at: int, refs: Sequence[tuple[str, int]]) -> int:
    """Bytes of the record that may start here, with its size; 0 if none can, -1 if too few bytes follow."""
    if len(data) < at + 36:
        return -1
    size, ref, pos, name, _, _, ops, _, length, mate, mate_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    for r, p in ((ref, pos), (mate, mate_pos)):
        if not -1 <= r < len(refs) or p < -1 or (r >= 0 and p > refs[r][1]):
            return 0
    if name < 1 or length < 0 or size < 32 + name + 4 * ops + (length + 1) // 2 + length:
        return 0
    if len(data) < at + 36 + name + 4 * ops:
        return -1
    text = data[at + 36 : at + 36 + name]
    if text[-1] or text[:-1].translate(None, PRINTED):
        return 0
    cigar = struct.unpack_from(f"<{ops}I", data, at + 36 + name)
    if any(c & 15 > 8 for c in cigar):
        return 0
    if ops and length and sum(c >> 4 for c in cigar if ON_READ[c & 15]) != length:
        return 0
    return size + 4


def first_record(file: pa.NativeFile, size: int, at: int, header: Header) -> int:
    """Virtual offset of the first record that starts in a block from byte ``at`` on; the file's end if none does.

    A place counts if records follow it, whole and one after another, over 64 kB or to the end of the file.
    """
    if at <= header.first >> 16:
        return header.first
    block = first_block(file, size, at)
    wide, whole = 4 * PROOF, False
    while not whole:
        data = Records(Blocks(file, size, block))
        whole = not data.need(wide)
        held = data.data
        for u in range(len(held)):
            k = u
            while (n := plausible(held, k, header.refs)) > 0 and k + n <= len(held):
                k += n
                if k - u >= PROOF:
                    break
            if k > u and (k - u >= PROOF or (whole and k == len(held))):
                data.at = u
                return data.offset()
        wide *= 4
    return size << 16


def _tags(b: bytes) -> list[str]:
    at, out = 0, []
    while at + 3 <= len(b):
        name, kind = b[at : at + 2].decode(), chr(b[at + 2])
        at += 3
        if kind == "A":
            out.append(f"{name}:A:{chr(b[at])}")
            at += 1
        elif kind in "ZH":
            end = b.index(0, at)
            out.append(f"{name}:{kind}:{b[at:end].decode()}")
            at = end + 1
        elif kind == "B":
            sub, n = chr(b[at]), struct.unpack_from("<i", b, at + 1)[0]
            v = struct.unpack_from(f"<{n}{TAG_TYPES[sub]}", b, at + 5)
            out.append(",".join([f"{name}:B:{sub}", *(f"{x:g}" if sub == "f" else str(x) for x in v)]))
            at += 5 + n * struct.calcsize(TAG_TYPES[sub])
        else:
            v = struct.unpack_from(f"<{TAG_TYPES[kind]}", b, at)[0]
            out.append(f"{name}:f:{v:g}" if kind == "f" else f"{name}:i:{v}")
            at += struct.calcsize(TAG_TYPES[kind])
    return out


def _pack_tags(tags: list[str] | None) -> bytes:
    out = []
    for t in tags or ():
        name, kind, value = t.split(":", 2)
        head = name.encode()
        if kind == "A":
            out.append(head + b"A" + value.encode())
        elif kind == "i":
            v = int(value)
            out.append(head + (b"i" + struct.pack("<i", v) if v < 1 << 31 else b"I" + struct.pack("<I", v)))
        elif kind == "f":
            out.append(head + b"f" + struct.pack("<f", float(value)))
        elif kind == "B":
            sub, *rest = value.split(",")
            v = [float(x) if sub == "f" else int(x) for x in rest]
            out.append(head + b"B" + sub.encode() + struct.pack("<i", len(v)) + struct.pack(f"<{len(v)}{TAG_TYPES[sub]}", *v))
        else:
            out.append(head + kind.encode() + value.encode() + b"\0")
    return b"".join(out)


# --- many records at once -------------------------------------------------------------------------
def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all stretches, one stretch after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _arrow(kind: pa.DataType, values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of so many bytes each, one after another in ``values``."""
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _distinct(values: pa.Array) -> tuple[list, np.ndarray]:
    """Each value once, and the number of each row's value in that list."""
    if values.null_count:
        raise ValueError("a tag is null")
    d = values.dictionary_encode()
    return d.dictionary.to_pylist(), d.indices.to_numpy().astype(np.int64)


def unpack(data: bytes, at: np.ndarray, size: np.ndarray, ords: np.ndarray, sample: str, refs: Sequence[tuple[str, int]]) -> pa.RecordBatch:
    """The rows of records that start at places of ``data``."""
    b = np.frombuffer(data, np.uint8)
    f = b[at[:, None] + np.arange(FIXED.itemsize)].view(FIXED).ravel()
    name, ops, length = (f[c].astype(np.int64) for c in ("name", "ops", "length"))
    half = (length + 1) // 2
    bases = at + 32 + name + 4 * ops
    quals = bases + half
    tags = quals + length
    qname = _arrow(pa.string(), b[_spread(at + 32, name - 1)], name - 1)
    qname.validate(full=True)
    kinds, which = _distinct(_arrow(pa.binary(), b[_spread(at + 32 + name, 4 * ops)], 4 * ops))
    kinds = [np.frombuffer(k, "<u4").tolist() for k in kinds]
    span = np.array([sum((c >> 4) * CONSUMES[c & 15] for c in k) for k in kinds], np.int64)[which]
    cigar = pa.array(["".join(f"{c >> 4}{OPS[c & 15]}" for c in k) or "*" for k in kinds], pa.string()).take(pa.array(which))
    letters = PAIRS[b[_spread(bases, half)]].ravel()
    seq = _arrow(pa.string(), np.delete(letters, (np.cumsum(2 * half) - 1)[length % 2 == 1]), length)
    none = length == 0
    absent = none | (b[np.minimum(quals, len(b) - 1)] == 255)
    q = b[_spread(quals, length)]
    if (q[np.repeat(~absent, length)] > 94).any():  # beyond ASCII
        qual = pa.array(["" if no else bytes(x + 33 for x in data[i : i + n]).decode("latin1") for i, n, no in zip(quals, length, absent)], pa.string())
    else:
        qual = _arrow(pa.string(), np.where(q == 255, 9, q + 33).astype(np.uint8), length)
    lists, of = _distinct(_arrow(pa.binary(), b[_spread(tags, at + size - tags)], at + size - tags))
    names = pa.array([*(n for n, _ in refs), "*"])
    named = lambda r: names.take(pa.array(np.where(r >= 0, r, len(refs))))
    columns = [
        pa.repeat(pa.scalar(sample, pa.string()), len(at)),
        qname,
        f["flag"],
        named(f["ref"]),
        f["pos"],
        f["pos"] + span,
        f["mapq"],
        cigar,
        named(f["mate"]),
        f["mate_pos"],
        f["insert"],
        pc.if_else(pa.array(none), "*", seq),
        pc.if_else(pa.array(absent), "*", qual),
        pa.array([_tags(t) for t in lists], _LIST).take(pa.array(of)),
        ords,
    ]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(np.ascontiguousarray(c)).cast(t) for c, t in zip(columns, ARROW.types)], schema=ARROW)


def _text(rows: pa.RecordBatch, column: str) -> pa.Array:
    """A column of strings; null where there is none."""
    return rows.column(column).cast(pa.string()) if column in rows.schema.names else pa.nulls(rows.num_rows, pa.string())


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of strings, one after another; and how many each has."""
    n = len(values)
    offsets = np.frombuffer(values.buffers()[1], np.int32, n + 1, 4 * values.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], np.diff(offsets)


def _characters(values: pa.Array, errors: str = "strict") -> tuple[np.ndarray, np.ndarray]:
    """As _bytes with one byte for each character; nulls and ``*`` are empty."""
    values = pc.fill_null(values, "*")
    values = pc.if_else(pc.equal(values, "*"), "", values)
    if pc.any(pc.not_equal(pc.binary_length(values), pc.utf8_length(values))).as_py():
        values = pa.array([v.encode("latin1", errors) for v in values.to_pylist()], pa.binary())
    return _bytes(values)


def _table(pieces: list[bytes], which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the pieces by number, one after another; and how many each has."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    starts = np.cumsum(lengths) - lengths
    return np.frombuffer(b"".join(pieces), np.uint8)[_spread(starts[which], lengths[which])], lengths[which]


def _tag_bytes(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows' tags, from the column tags, or nh and md where that is null."""
    n, given = rows.num_rows, np.zeros(rows.num_rows, bool)
    texts, which, row = [], [], []

    def take(values: pa.Array, at: np.ndarray) -> None:
        own, numbers = _distinct(values)
        which.append(numbers + len(texts))
        row.append(at)
        texts.extend(own)

    if "tags" in rows.schema.names:
        lists = rows.column("tags").cast(_LIST)
        given = lists.is_valid().to_numpy(zero_copy_only=False)
        take(lists.flatten(), np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()))
    for head, column in (("NH:i:", "nh"), ("MD:Z:", "md")):
        own = _text(rows, column)
        at = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False) & ~given)
        take(pc.binary_join_element_wise(head, own.take(pa.array(at)), ""), at)
    row, which = np.concatenate(row), np.concatenate(which)
    order = np.argsort(row, kind="stable")
    data, lengths = _table([_pack_tags([t]) for t in texts], which[order])
    return data, np.bincount(row[order], lengths, n).astype(np.int64)


def _ops(cigar: str) -> list[int]:
    out, n = [], 0
    for c in "" if cigar == "*" else cigar:
        if c.isdigit():
            n = 10 * n + int(c)
        else:
            out.append(n << 4 | OPS.index(c))
            n = 0
    return out


def pack_all(rows: pa.RecordBatch, number: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Records with their sizes, one after another; for each its bytes, reference, start, and where it ends on the reference."""
    n, names = rows.num_rows, rows.schema.names
    whole = lambda c, empty: pc.fill_null(rows.column(c).cast(pa.int64()), empty).to_numpy() if c in names else np.full(n, empty, np.int64)
    kinds, which = _distinct(pc.fill_null(_text(rows, "chrom"), "*"))
    ref = np.array([-1 if k == "*" else number[k] for k in kinds], np.int64)[which]
    kinds, which = _distinct(pc.fill_null(_text(rows, "mate_chrom"), "*"))
    mate = np.array([number.get(k, -1) for k in kinds], np.int64)[which]
    start = whole("start0", -1)
    kinds, which = _distinct(pc.fill_null(_text(rows, "cigar"), "*"))
    kinds = [_ops(k) for k in kinds]
    end = start + np.array([sum((c >> 4) * CONSUMES[c & 15] for c in k) for k in kinds], np.int64)[which]
    ops, n_ops = _table([struct.pack(f"<{len(k)}I", *k) for k in kinds], which)
    name, n_name = _bytes(pc.fill_null(_text(rows, "qname"), "*"))
    seq, length = _characters(_text(rows, "seq"), "replace")
    qual, n_qual = _characters(_text(rows, "qual"))
    given = pc.not_equal(pc.fill_null(_text(rows, "qual"), "*"), "*").to_numpy(zero_copy_only=False)
    if (n_qual != length)[given].any():
        raise ValueError("a read's bases and qualities differ in number")
    if (qual < 33).any():
        raise ValueError("a quality below '!'")
    tags, n_tags = _tag_bytes(rows)
    half = (length + 1) // 2
    nibbles = np.zeros(2 * half.sum(), np.uint8)
    nibbles[_spread(2 * (np.cumsum(half) - half), length)] = CODES[seq]
    size = 37 + n_name + n_ops + half + length + n_tags
    at = np.cumsum(size) - size
    fixed = np.zeros(n, [("size", "<i4"), *((c, FIXED[c]) for c in FIXED.names)])
    values = {
        "size": size - 4, "ref": ref, "pos": start, "name": n_name + 1, "mapq": whole("mapq", 0), "ops": n_ops // 4, "flag": whole("flag", 0), "length": length,
        "mate": mate, "mate_pos": whole("mate_start0", -1), "insert": whole("insert_size", 0),
        "bin": bins_at(np.maximum(start, 0), np.maximum(np.maximum(end, start + 1), 1), BAI_DEPTH) & 0xFFFF,
    }
    for c, v in values.items():
        span = np.iinfo(fixed.dtype[c])
        if n and (v.min() < span.min or v.max() > span.max):
            raise ValueError(f"a value of {c} doesn't fit into a BAM record")
        fixed[c] = v
    out = np.zeros(size.sum(), np.uint8)
    out[at[:, None] + np.arange(36)] = fixed.view(np.uint8).reshape(n, 36)
    here = at + 36
    out[_spread(here, n_name)] = name
    here = here + n_name + 1
    out[_spread(here, n_ops)] = ops
    here = here + n_ops
    out[_spread(here, half)] = nibbles[::2] << 4 | nibbles[1::2]
    here = here + half
    out[_spread(here, np.where(given, 0, length))] = 255
    out[_spread(here, n_qual)] = qual - 33
    out[_spread(here + length, n_tags)] = tags
    return out, size, ref, start, end


def pack(row: dict, ref: int, number: dict[str, int]) -> tuple[bytes, int]:
    """A record with its size, and where it ends on the reference."""
    data, _, _, _, end = pack_all(pa.RecordBatch.from_pylist([row]), number)
    return data.tobytes(), int(end[0])


# --- index --------------------------------------------------------------------------------------
def bin_of(start: int, end: int, depth: int) -> int:
    """The smallest bin that holds [start, end)."""
    end -= 1
    shift, first = MIN_SHIFT, ((1 << 3 * depth) - 1) // 7
    for level in range(depth, 0, -1):
        if start >> shift == end >> shift:
            return first + (start >> shift)
        shift += 3
        first -= 1 << 3 * (level - 1)
    return 0


def bins_at(start: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """The smallest bin that holds [start, end), for each pair."""
    out, last = np.zeros(len(start), np.int64), end - 1
    for level in range(1, depth + 1):
        shift = MIN_SHIFT + 3 * (depth - level)
        inside = start >> shift == last >> shift
        out[inside] = ((1 << 3 * level) - 1) // 7 + (start[inside] >> shift)
    return out


def bins_of(start: int, end: int, depth: int) -> set[int]:
    """All bins that may hold records which overlap [start, end)."""
    out, first, shift = set(), 0, MIN_SHIFT + 3 * depth
    for level in range(depth + 1):
        out.update(range(first + (start >> shift), first + ((end - 1) >> shift) + 1))
        first += 1 << 3 * level
        shift -= 3
    return out


class Index:
    """Bins with their chunks, and for each 16 kb window the least virtual offset, by reference."""

    def __init__(self, n_refs: int, depth: int = BAI_DEPTH) -> None:
        self.depth = depth
        self.bins: list[dict[int, list[list[int]]]] = [{} for _ in range(n_refs)]
        self.windows: list[dict[int, int]] = [{} for _ in range(n_refs)]

    @staticmethod
    def depth_for(refs: Sequence[tuple[str, int]]) -> int:
        """Five levels, as a BAI file has, and more where a reference is longer than they hold."""
        depth, longest = BAI_DEPTH, max((n for _, n in refs), default=0)
        while longest > 1 << (MIN_SHIFT + 3 * depth):
            depth += 1
        return depth

    def add(self, ref: int, start: int, end: int, a: int, b: int) -> None:
        self.add_all(*(np.array([x], np.int64) for x in (ref, start, end, a, b)))

    def add_all(self, ref: np.ndarray, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Records that follow one another, from virtual offset a to b; those of one bin in a row are one chunk."""
        if not len(ref):
            return
        start = np.maximum(start, 0)
        end = np.maximum(end, start + 1)
        bins = bins_at(start, end, self.depth)
        begin = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]) | (ref[1:] != ref[:-1])])
        leaf = ((1 << 3 * self.depth) - 1) // 7
        first, last = (start >> MIN_SHIFT).tolist(), ((end - 1) >> MIN_SHIFT).tolist()
        for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(ref)]):
            here, k = int(ref[i]), int(bins[i])
            chunks = self.bins[here].setdefault(k, [])
            if chunks and chunks[-1][1] >> 16 >= int(a[i]) >> 16:
                chunks[-1][1] = int(b[j - 1])
            else:
                chunks.append([int(a[i]), int(b[j - 1])])
            for r in (i,) if k >= leaf else range(i, j):  # records of a smallest bin lie in one window
                for w in range(first[r], last[r] + 1):
                    self.windows[here].setdefault(w, int(a[r]))

    def chunks(self, ref: int, start: int, end: int) -> list[tuple[int, int]]:
        """Merged ranges of virtual offsets with all records that overlap [start, end)."""
        if start >= end:
            return []
        end = min(end, 1 << (MIN_SHIFT + 3 * self.depth))
        own = self.windows[ref]
        least = max((own[w] for w in own if w <= start >> MIN_SHIFT), default=0)
        wanted = bins_of(start, end, self.depth)
        found = sorted((max(a, least), b) for k, cs in self.bins[ref].items() if k in wanted for a, b in cs if b > least)
        out: list[tuple[int, int]] = []
        for a, b in found:
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def starts(self, ref: int) -> list[int]:
        """Virtual offsets at which records of the reference start, where a chunk may be split."""
        return sorted(set(self.windows[ref].values()) | {a for cs in self.bins[ref].values() for a, _ in cs})

    def to_bytes(self) -> bytes:
        """A BAI file, or the inflated bytes of a CSI file where there are more than five levels."""
        bai = self.depth == BAI_DEPTH
        out = [b"BAI\1" if bai else b"CSI\1" + struct.pack("<iii", MIN_SHIFT, self.depth, 0), struct.pack("<i", len(self.bins))]
        for bins, windows in zip(self.bins, self.windows):
            out.append(struct.pack("<i", len(bins)))
            for k, chunks in sorted(bins.items()):
                out.append(struct.pack("<I", k) if bai else struct.pack("<IQ", k, self._least(k, windows)))
                out.append(struct.pack("<i", len(chunks)))
                out += [struct.pack("<QQ", a, b) for a, b in chunks]
            if bai:
                size, last, line = max(windows, default=-1) + 1, 0, []
                for w in range(size):
                    last = windows.get(w, last)
                    line.append(last)
                out.append(struct.pack(f"<i{size}Q", size, *line))
        return b"".join(out)

    def _least(self, k: int, windows: dict[int, int]) -> int:
        """The least virtual offset of a record that overlaps a bin."""
        level, first = 0, 0
        while k >= first + (1 << 3 * level):
            first += 1 << 3 * level
            level += 1
        wide = 1 << 3 * (self.depth - level)
        at = (k - first) * wide
        return min((windows[w] for w in (range(at, at + wide) if wide < len(windows) else windows) if w in windows and at <= w < at + wide), default=0)

    @staticmethod
    def parse(data: bytes) -> Index:
        bai = data[:4] == b"BAI\1"
        if not bai and data[:4] != b"CSI\1":
            raise ValueError("neither BAI nor CSI")
        at, depth = 4, BAI_DEPTH
        if not bai:
            shift, depth, aux = struct.unpack_from("<iii", data, 4)
            if shift != MIN_SHIFT:
                raise ValueError(f"an index of windows of 2^{shift} bases")
            at = 16 + aux
        n = struct.unpack_from("<i", data, at)[0]
        at += 4
        out = Index(n, depth)
        pseudo = ((1 << 3 * (depth + 1)) - 1) // 7 + 1  # holds counts, no records
        for ref in range(n):
            n_bins = struct.unpack_from("<i", data, at)[0]
            at += 4
            for _ in range(n_bins):
                k, size = struct.unpack_from("<Ii", data, at) if bai else struct.unpack_from("<I8xi", data, at)
                at += 8 if bai else 16
                if k != pseudo:
                    v = struct.unpack_from(f"<{2 * size}Q", data, at)
                    out.bins[ref][k] = [list(c) for c in zip(v[::2], v[1::2])]
                at += 16 * size
            if bai:
                size = struct.unpack_from("<i", data, at)[0]
                line = struct.unpack_from(f"<{size}Q", data, at + 4)
                at += 4 + 8 * size
                out.windows[ref] = {w: v for w, v in enumerate(line) if v}
        return out


# --- source -------------------------------------------------------------------------------------
@dataclass
class Part(InputPartition):
    """Records that start in [first, stop): from a known virtual offset, or from the first record found at byte ``start``."""

    path: str
    start: int
    stop: int
    first: int | None = None
    ref: int | None = None


def files_of(path: str) -> list[str]:
    """BAM files of a path: a file, a folder with all below it that end in .bam, or a pattern in the last part."""
    system, inner, prefix = located(path)
    name = posixpath.basename(inner)
    if any(c in name for c in "*?["):
        found = [f for f in system.get_file_info(fs.FileSelector(posixpath.dirname(inner))) if fnmatch(f.base_name, name)]
    elif system.get_file_info(inner).type == fs.FileType.Directory:
        found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    else:
        found = [system.get_file_info(inner)]
    out = []
    for f in found:
        if f.type == fs.FileType.Directory and f.base_name.endswith(".bam") and any(c in name for c in "*?["):
            out += files_of(prefix + f.path)
        elif f.type == fs.FileType.File and f.base_name.endswith(".bam") and "/_temporary/" not in f.path:
            out.append(prefix + f.path)
    if not out:
        raise FileNotFoundError(f"no BAM file at {path}")
    return sorted(set(out))


def sample_of(path: str) -> str:
    """A file's name, or that of the folder for one of the parts that a job wrote."""
    name = posixpath.basename(path)
    return (posixpath.basename(posixpath.dirname(path)) if name.startswith("part-") else name).removesuffix(".bam")


def index_of(path: str) -> Index | None:
    """The index beside a file: x.bam.bai, x.bai, x.bam.csi or x.csi."""
    for other in (f"{path}.bai", f"{path.removesuffix('.bam')}.bai", f"{path}.csi", f"{path.removesuffix('.bam')}.csi"):
        try:
            file, size = open_file(other)
        except FileNotFoundError:
            continue
        data = file.read()
        if data[:4] == MAGIC:
            blocks, parts = Blocks(file, size, 0), []
            while b := blocks.next():
                parts.append(b[1])
            data = b"".join(parts)
        return Index.parse(data)
    return None


class BamReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths = files_of(options["path"])
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.chrom = options.get("chrom")
        self.start = int(options.get("start", 0))
        self.end = int(options["end"]) if "end" in options else None

    def partitions(self) -> list[Part]:
        out = []
        total = sum(open_file(path)[1] for path in self.paths)
        split = max(self.split, min(total // PARTS, SPLIT_BYTES))
        for path in self.paths:
            file, size = open_file(path)
            header = read_header(file, size)
            if self.chrom is None or self.chrom == "*":
                out += [Part(path, a, min(a + split, size)) for a in range(header.first >> 16, size, split)]
                continue
            ref = next((i for i, r in enumerate(header.refs) if r[0] == self.chrom), None)
            if ref is None:
                continue
            index = index_of(path)
            if index is None:
                out += [Part(path, a, min(a + split, size), None, ref) for a in range(header.first >> 16, size, split)]
                continue
            end = header.refs[ref][1] if self.end is None else min(self.end, header.refs[ref][1])
            starts = index.starts(ref)
            for a, b in index.chunks(ref, self.start, end):
                here = a
                for s in starts:
                    if here < s < b and (s >> 16) - (here >> 16) >= self.split:
                        out.append(Part(path, here, s, here, ref))
                        here = s
                out.append(Part(path, here, b, here, ref))
        return out or [Part("", 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from batches_of(*open_file(partition.path), partition, self.chrom, self.start, self.end)


def batches_of(file: pa.NativeFile, size: int, part: Part, chrom: str | None, start: int, end: int | None) -> Iterator[pa.RecordBatch]:
    """The rows of a part, of one reference and region if asked, with the virtual offset of each as ord."""
    header = read_header(file, size)
    sample = sample_of(part.path)
    known = part.first is not None
    first = part.first if known else first_record(file, size, part.start, header)
    stop = min(part.stop if known else part.stop << 16, size << 16)
    if first >= stop:
        return
    data = Records(Blocks(file, size, first >> 16), first & 0xFFFF)
    while len((found := data.starts(stop))[0]):
        at, length, ords = found
        more = True
        if part.ref is not None or chrom == "*":
            b = np.frombuffer(data.data, np.uint8)
            ref, pos = b[at[:, None] + np.arange(8)].view("<i4").T
            if part.ref is None:
                wanted = ref < 0
            else:
                after = (ref > part.ref) | (ref < 0) | ((ref == part.ref) & (end is not None) & (pos >= (end or 0)))
                wanted = (ref == part.ref) & ~after
                more = not (header.is_sorted and after.any())
                if not more:
                    wanted[int(after.argmax()) :] = False
            at, length, ords = at[wanted], length[wanted], ords[wanted]
        if len(at):
            rows = unpack(data.data, at, length, ords, sample, header.refs)
            if part.ref is not None:
                reach = np.maximum(rows.column("end0").to_numpy(), rows.column("start0").to_numpy() + 1)
                rows = rows.filter(pa.array(reach > start))
            if rows.num_rows:
                yield rows
        if not more:
            return
    at = data.offset()
    if not known and at < size << 16 and first_record(file, size, part.stop, header) != at:
        raise ValueError(f"{part.path}: the next part would not start at record {at >> 16}:{at & 0xFFFF}")


def rows_of(file: pa.NativeFile, size: int, part: Part, chrom: str | None, start: int, end: int | None) -> Iterator[tuple]:
    for b in batches_of(file, size, part, chrom, start, end):
        yield from zip(*(c.to_pylist() for c in b.columns))


class PartFile:
    """One BAM file being written, and its index."""

    def __init__(self, system: fs.FileSystem, path: str, text: str, refs: list[tuple[str, int]]) -> None:
        self.system, self.path, self.index = system, path, Index(len(refs), Index.depth_for(refs))
        self.number = {n: i for i, (n, _) in enumerate(refs)}
        self.out = system.open_output_stream(f"{path}.bam", compression=None)
        self.at, self.rows, self.held, self.begun, self.place = 0, 0, bytearray(), [], (-1, -1)
        head = b"BAM\1" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(refs))
        self.held += head + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in refs)
        self.flush()

    def add(self, rows: pa.RecordBatch) -> None:
        data, size, ref, start, end = pack_all(rows, self.number)
        order = np.r_[self.place[0], np.where(ref >= 0, ref, 1 << 31)], np.r_[self.place[1], np.where(ref >= 0, start, 0)]
        step, move = (np.diff(x) for x in order)
        if ((step < 0) | ((step == 0) & (move < 0))).any():
            raise ValueError("rows of a BAM file have to be sorted by reference and start0")
        self.place = int(order[0][-1]), int(order[1][-1])
        ends, i = np.cumsum(size), 0
        while i < len(size):
            done = int(ends[i] - size[i])
            j = int(np.searchsorted(ends, done + FULL - len(self.held), "right"))
            if j <= i and self.held:
                self.flush()
                continue
            j = max(j, i + 1)
            self.begun.append((ref[i:j], start[i:j], end[i:j], ends[i:j] - size[i:j] - done + len(self.held), size[i:j]))
            self.held += data[done : ends[j - 1]].tobytes()
            self.rows += j - i
            i = j

    def flush(self) -> None:
        """Write what is held as blocks, and index its records."""
        places = []
        for i in range(0, len(self.held), FULL):
            places.append(self.at)
            block = pack_block(bytes(self.held[i : i + FULL]))
            self.out.write(block)
            self.at += len(block)
        if self.begun:
            ref, start, end, k, n = (np.concatenate(x) for x in zip(*self.begun))
            block = np.array([*places, self.at], np.int64)
            spot = lambda k: np.where(k < len(self.held), block[np.minimum(k // FULL, len(places))] << 16 | k % FULL, self.at << 16)
            self.index.add_all(*(x[ref >= 0] for x in (ref, start, end, spot(k), spot(k + n))))
        self.held.clear()
        self.begun.clear()

    def close(self) -> str:
        """End the file; the kind of its index."""
        self.flush()
        self.out.write(EMPTY_BLOCK)
        self.out.close()
        kind, data = "bai" if self.index.depth == BAI_DEPTH else "csi", self.index.to_bytes()
        with self.system.open_output_stream(f"{self.path}.{kind}", compression=None) as out:
            out.write(data if kind == "bai" else b"".join(pack_block(data[i : i + FULL]) for i in range(0, len(data), FULL)) + EMPTY_BLOCK)
        return kind


#: Columns that are written, of those that rows have.
WRITTEN = ("sample", "qname", "flag", "chrom", "start0", "mapq", "cigar", "mate_chrom", "mate_start0", "insert_size", "seq", "qual", "tags", "nh", "md")


class BamWriter(DataSourceArrowWriter):
    """A folder of BAM files with header, end block and index, one for each task and sample.

    Rows come sorted by sample (if there is one), reference and start0. Nothing is in its place before
    the commit, which moves files; a task that is run again writes under another name.
    """

    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex[:8]
        self.refs = [(n, int(k)) for n, k in (r.rsplit(":", 1) for r in options["references"].split("\n") if r)]
        self.text = options.get("header") or "\n".join(["@HD\tVN:1.6\tSO:coordinate", *(f"@SQ\tSN:{n}\tLN:{k}" for n, k in self.refs), ""])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        context = TaskContext.get()
        system, root, _ = located(self.path)
        name, own = f"part-{context.partitionId():05d}-{self.job}", f"{root}/_temporary/{context.taskAttemptId()}"
        files, part, sample = [], None, None

        def close() -> None:
            if part is not None:
                files.append((part.path, f"{root}/{sample}.bam/{name}" if sample else f"{root}/{name}", part.close()))

        for batch in iterator:
            own_sample = _text(batch, "sample").dictionary_encode("encode").indices.to_numpy()
            begin = np.flatnonzero(np.r_[True, own_sample[1:] != own_sample[:-1]]) if len(own_sample) else []
            for i, j in zip(begin, [*begin[1:], batch.num_rows]):
                here = _text(batch, "sample")[int(i)].as_py()
                if part is None or here != sample:
                    close()
                    sample = here
                    system.create_dir(own, recursive=True)
                    part = PartFile(system, f"{own}/{len(files)}", self.text, self.refs)
                part.add(batch.slice(int(i), int(j - i)))
        close()
        return Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root, _ = located(self.path)
        if self.overwrite and system.get_file_info(root).type == fs.FileType.Directory:
            for f in system.get_file_info(fs.FileSelector(root, recursive=True)):
                if f.type == fs.FileType.File and f.base_name.startswith("part-") and "/_temporary/" not in f.path:
                    system.delete_file(f.path)
        system.create_dir(root, recursive=True)
        for temp, final, kind in [f for m in messages if m is not None for f in m.files]:
            system.create_dir(posixpath.dirname(final), recursive=True)
            system.move(f"{temp}.{kind}", f"{final}.bam.{kind}")
            system.move(f"{temp}.bam", f"{final}.bam")
        self.abort(messages)
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root, _ = located(self.path)
        if system.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary")


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, str]]


_LIST = pa.list_(pa.string())
ARROW = pa.schema(
    [(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "array<string>": _LIST}[k]) for n, k in (f.split(" ", 1) for f in SCHEMA.split(", "))]
)


class BamSource(DataSource):
    """``spark.read.format("bam")``: options chrom, start and end (0-based, half open), splitBytes.

    Filters are not pushed down: Spark 4.1 keeps what one query pushed to a Python source for every other
    use of the same frame, which would then miss rows.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BamReader:
        return BamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> BamWriter:
        return BamWriter(dict(self.options), overwrite)
