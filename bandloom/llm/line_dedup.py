"""Fuzzy line deduplication over a whole corpus by MinHash.

Lines are compared without regard to case and to the width of white space, as sets of ``SHINGLE``
characters. Two lines at a Jaccard similarity of ``LEAST`` or more are linked; of each connected
component one line is kept, the first by (doc_id, position).

* A signature has ``BANDS * ROWS`` values from one hash of each shingle (one-permutation MinHash with
  empty bins filled from full ones), so its cost does not grow with its size. Lines that agree in a
  band are candidates: at a similarity of 0.8 a pair misses all bands with a probability of 0.2 %.
* Bands travel in packets by their first bits, not as rows, and are sorted when they arrive. Candidates of a band
  are rows sorted by band. Up to ``SMALL`` lines of a band are all paired; more, the
  crowded ones, are paired with their neighbour and with a leader, both by an order that differs between
  bands; a task holds ``HELD`` rows of a band at most.
* Candidates are first compared by fields of bits, then those left are checked on their whole shingle sets, as 64-bit
  hashes, and the links joined by ``components``.
* All crowded lines then go through an exact search (``crowded_links``) for links between different
  components of these: pairs that share a shingle among the rarest of each, checked like the others. They meet in
  the memory of tasks that hold two blocks of lines each, so a pair is a row only if its fields of bits agree. Lines
  of one component need no further link, so a family of near copies does not meet itself.

Equal lines never meet as pairs: they share a 64-bit id, are counted by an aggregate that combines
before the shuffle, and enter a band once per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .components import LINKS, components
from .shared import batches_of, binary_lengths, marks_of, one_batch, scratch_tables, ship, written

SHINGLE = 6
BANDS, ROWS = 16, 5
LEAST = 0.8
SMALL = 8
BINS = BANDS * ROWS
EMPTY = np.uint32(0xFFFFFFFF)
BLOCK = 1 << 17  # code points hashed at once
CHECKED = 1 << 19  # bytes of lines of pairs that are checked at once
HELD = 500_000  # rows of one band that a task holds
PACKED, UNPACKED = 1 << 20, 1 << 17  # rows of bands that are put into packets at once, and taken out of them
BUCKET_SHIFT = 64 - 12  # the first 12 bits of a band are its bucket
PACKETS = "bucket int, band long, bands binary, ids binary"
PLACES = 1 << 20  # of the table of how often shingles occur
CELL = 1 << 23  # codes of the lines of a block; a cell holds two blocks
MET = 1 << 20  # meetings that are looked at at once


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words (the finalizer of MurmurHash3, a fixed public function)."""
    h = h ^ (h >> np.uint64(33))  # a copy, which the others change in place
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


FACTORS = mixed(np.arange(1, 1 + max(SHINGLE, ROWS), dtype=np.uint64)) | np.uint64(1)
#: Bins from which an empty bin is filled, in the order tried.
SOURCES = (mixed(np.arange(BINS * 64, dtype=np.uint64) + np.uint64(99)) % np.uint64(BINS)).astype(
    np.int64
).reshape(64, BINS)


def plain(line: str) -> str:
    """What is compared of a line; empty for a line without characters other than white space."""
    return spaced(line.lower())


def spaced(line: str) -> str:
    """The words of a line with one space between them."""
    # of all white space only the space is printable, so most lines are seen to be so already
    if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " ":
        return line
    return " ".join(line.split())


def line_id(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode()) - (1 << 63)


def shingles(line: str) -> set[str]:
    """All runs of SHINGLE characters; the line itself if it is shorter."""
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def signatures(lines: list[str]) -> np.ndarray:
    """A row of BINS values for each line."""
    sig = np.full(len(lines) * BINS, EMPTY, dtype=np.uint32)
    begin = 0
    while begin < len(lines):
        end, size = begin, 0
        while end < len(lines) and (end == begin or size + len(lines[end]) <= BLOCK):
            size += len(lines[end])
            end += 1
        if end == begin + 1:  # one line, in blocks if it is long
            line = lines[begin].ljust(SHINGLE, "\0")
            for at in range(0, len(line) - SHINGLE + 1, BLOCK):
                _fill(sig, [line[at : at + BLOCK + SHINGLE - 1]], begin)
        else:
            _fill(sig, [line.ljust(SHINGLE, "\0") for line in lines[begin:end]], begin)
        begin = end
    sig = sig.reshape(-1, BINS)
    line, empty = np.nonzero(sig == EMPTY)
    full, attempt = sig.copy(), 0
    while len(line):
        got = sig[line, SOURCES[attempt % 64, empty] if attempt < 64 else (empty + attempt) % BINS]
        full[line, empty] = got
        left = got == EMPTY
        line, empty, attempt = line[left], empty[left], attempt + 1
    return full


def hashed(points: np.ndarray) -> np.ndarray:
    """A hash of every SHINGLE = 6 code points, in three steps."""
    two = points[:-1] * FACTORS[0]
    two += points[1:]
    four = two[:-2] * FACTORS[1]
    four += two[2:]
    h = four[:-2] * FACTORS[2]
    h += two[4:]
    return h


def _fill(sig: np.ndarray, lines: list[str], first: int) -> None:
    points = np.frombuffer("".join(lines).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    lengths = np.array([len(line) for line in lines])
    h = hashed(points)
    place = np.repeat(np.arange(first, first + len(lines)) * BINS, lengths)[: len(h)]
    h ^= h >> np.uint64(32)
    h *= FACTORS[3]
    low = (h ^ (h >> np.uint64(29))).astype(np.uint32)
    ends = np.cumsum(lengths)[:-1]
    for k in range(1, SHINGLE):
        low[ends - k] = EMPTY  # starts whose shingle ends in the next line bear on nothing
    h >>= np.uint64(32)
    h *= np.uint64(BINS)
    h >>= np.uint64(32)
    place += h.view(np.int64)
    np.minimum.at(sig, place, low)


def bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each line and band."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    keys = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(sig), axis=0)
    for k in range(ROWS):
        keys = mixed(keys * FACTORS[k] + parts[:, :, k])
    return keys.view(np.int64)


def salted(band: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The ids times an odd number of the band, so that they sort otherwise in other bands."""
    return (line.view(np.uint64) * (mixed(band.view(np.uint64)) | np.uint64(1))).view(np.int64)


def unsalted(band: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The inverse of ``salted``."""
    odd = mixed(band.view(np.uint64)) | np.uint64(1)
    inverse = odd.copy()  # right in 3 bits; each step doubles them
    for _ in range(5):
        inverse *= np.uint64(2) - odd * inverse
    return (line.view(np.uint64) * inverse).view(np.int64)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line with content: its id, its document, its place there, and the line itself where the task
    has not met it lately."""
    seen: set[int] = set()
    for batch in batches_of(batches, "text", 4 << 20):
        if len(seen) > 250_000:
            seen.clear()  # a line met again is only written again
        ids, of, places, lines = [], [], [], []
        for number, text in enumerate(batch.column(2).to_numpy(zero_copy_only=False).tolist()):
            for place, line in enumerate((text or "").lower().split("\n")):
                if line := spaced(line):  # ``plain``: a line end does not bear on the case of what is beside it
                    own = line_id(line)
                    ids.append(own)
                    of.append(number)
                    places.append(place)
                    lines.append(None if own in seen else line)
                    seen.add(own)
        taken = pa.array(of, pa.int64())
        yield pa.record_batch(
            [pa.array(ids, pa.int64()), batch.column(0).take(taken), batch.column(1).take(taken),
             pa.array(places, pa.int32()), pa.array(lines, pa.string())],
            names=["id", "doc_id", "row", "place", "line"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches_of(batches, "line", 2 << 20):
        if batch.num_rows:
            keys = bands(signatures(batch.column(1).to_numpy(zero_copy_only=False).tolist())).ravel()
            held.append((keys, salted(keys, np.repeat(batch.column(0).to_numpy(), BANDS))))
        if sum(len(keys) for keys, _ in held) >= PACKED:
            yield packets(*(np.concatenate(x) for x in zip(*held)))
            held = []
    if held:
        yield packets(*(np.concatenate(x) for x in zip(*held)))


def packets(band: np.ndarray, salted_line: np.ndarray) -> pa.RecordBatch:
    """Rows of bands in packets: one for each bucket (the first bits of a band) and one for each band with more than
    SMALL rows here, which has the ``band`` beside it."""
    order = np.argsort(band)
    band, salted_line = band[order], salted_line[order]
    starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
    sizes = np.diff(np.append(starts, len(band)))
    alone = np.repeat(sizes > SMALL, sizes)
    columns: list[list] = [[], [], [], []]
    for own, key in ((~alone, band >> BUCKET_SHIFT), (alone, band)):
        key, some, lines = key[own], band[own], salted_line[own]
        bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
        first = key[bounds[:-1]]
        columns[0] += (some[bounds[:-1]] >> BUCKET_SHIFT).tolist()
        columns[1] += [None] * len(first) if own is not alone else first.tolist()
        for at, x in ((2, some), (3, lines)):
            content = x.tobytes()
            cuts = (bounds * 8).tolist()
            columns[at] += [content[a:b] for a, b in zip(cuts, cuts[1:])]
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.record_batch([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["bucket", "band", "bands", "ids"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of packets that are sorted by bucket and band, sorted by band. What a bucket has of bands with few rows in
    a packet comes first and is sorted; other bands follow each other, and their packets are passed on as they come."""
    now: int | None = None
    mixed: list[tuple[np.ndarray, np.ndarray]] = []
    ready: list[tuple[np.ndarray, np.ndarray]] = []

    def until(band: int | None) -> None:
        """Make ready the rows of the bucket up to a band, or all."""
        if mixed:
            if len(mixed) > 1:
                key, line = (np.concatenate(x) for x in zip(*mixed))
                order = np.argsort(key)
                mixed[:] = [(key[order], line[order])]
            key, line = mixed[0]
            end = len(key) if band is None else int(np.searchsorted(key, band, "right"))
            ready.append((key[:end], line[:end]))
            mixed[:] = [] if end == len(key) else [(key[end:], line[end:])]

    def rows() -> pa.RecordBatch:
        key, line = (np.concatenate(x) for x in zip(*ready))
        ready.clear()
        return pa.record_batch([key, line], names=["band", "id"])

    for batch in batches:
        for i, (bucket, band) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if bucket != now:
                until(None)
                now = bucket
            own = tuple(np.frombuffer(batch.column(j)[i].as_buffer(), "<i8") for j in (2, 3))
            if band is None:
                mixed.append(own)
            else:
                until(band)
                ready.append(own)
            if len(ready) >= 64 and sum(len(x) for x, _ in ready) >= UNPACKED:
                yield rows()
    until(None)
    if ready:
        yield rows()


def band_pairs(band: np.ndarray, line: np.ndarray, goes_on: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of lines of whole bands, and each crowded line with itself. Rows are sorted by band and line; a
    line stands once in a band. If the first band ``goes_on`` from an earlier piece, its lines are crowded."""
    if not len(band):
        return band, line
    starts = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(band)]]))
    left, right = [], []
    crowded = sizes > SMALL
    crowded[0] |= goes_on
    for size in range(2, SMALL + 1):
        group = line[starts[(sizes == size) & ~crowded][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        left.append(group[:, i].ravel())
        right.append(group[:, j].ravel())
    large = np.repeat(crowded, sizes)
    if large.any():
        leader = np.repeat(line[starts], sizes)
        later = large.copy()
        later[starts] = False
        left += [leader[later], line[np.flatnonzero(later) - 1], line[large]]
        right += [line[later], line[later], line[large]]
    return np.concatenate(left), np.concatenate(right)


def _in_order(band: np.ndarray, salted_line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows that are sorted by band, those of bands with several lines, each line once, by line."""
    same = band[1:] == band[:-1]
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    band, salted_line = band[several], salted_line[several]
    order = np.lexsort((salted_line, band))
    band, salted_line = band[order], salted_line[order]
    once = np.ones(len(band), dtype=bool)
    once[1:] = (band[1:] != band[:-1]) | (salted_line[1:] != salted_line[:-1])
    return band[once], unsalted(band[once], salted_line[once])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by band, and each crowded line with itself. The last band of a batch
    waits for the next batch; one of more than HELD rows is paired piece by piece, the pieces by their leaders."""
    band, line = np.zeros(0, np.int64), np.zeros(0, np.int64)
    goes_on = False
    for batch in batches:
        new = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
        band, line = np.concatenate([band, new[0]]), np.concatenate([line, new[1]])
        if not len(band):
            continue
        last = int(np.searchsorted(band, band[-1]))  # where the last band begins
        if len(band) - last > HELD:
            yield _ordered(*band_pairs(*_in_order(band, line), goes_on))
            band, line, goes_on = band[-1:], np.min(line[last:], keepdims=True), True
        elif last:
            yield _ordered(*band_pairs(*_in_order(band[:last], line[:last]), goes_on))
            band, line, goes_on = band[last:], line[last:], False
    if len(band):
        yield _ordered(*band_pairs(*_in_order(band, line), goes_on))


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _pairs(_unpacked(batches))


def _ordered(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])


def codes(line: str) -> np.ndarray:
    """The shingles of a line as sorted 64-bit hashes."""
    points = np.frombuffer(line.ljust(SHINGLE, "\0").encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    return np.unique(hashed(points))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.array(binary_lengths(batch.column(i)), dtype=np.int64) for i in (2, 3))
        part = np.cumsum(a + b) // CHECKED
        bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])).tolist()
        for begin, end in zip(bounds, bounds[1:]):
            pairs = batch.slice(begin, end - begin)
            src, dst = (pairs.column(i).to_numpy() for i in (0, 1))
            lines = [x for i in (2, 3) for x in pairs.column(i).to_numpy(zero_copy_only=False).tolist()]
            keep = pa.array(similar_pairs(src, dst, lines))
            yield pa.RecordBatch.from_arrays([column.filter(keep) for column in pairs.columns[:2]], names=["src", "dst"])


def similar_pairs(src: np.ndarray, dst: np.ndarray, lines: list[str]) -> np.ndarray:
    """``similar`` of the codes of each pair; ``lines`` are those of all ``src``, then of all ``dst``. Each line is coded
    once, and the codes of both lines of all pairs are sorted together, by as many bits of a code as the number of a pair
    leaves of 64: two different codes of a pair agree in these with a probability of 2**-40 at most."""
    _, first, of_pair = np.unique(np.concatenate([src, dst]), return_index=True, return_inverse=True)
    left, right = of_pair[: len(src)], of_pair[len(src) :]
    of, code = _windows([lines[i] for i in first.tolist()])
    width = np.uint64(max(len(src), len(first)).bit_length())
    own = np.uint64(64) - width
    coded = np.sort((of.astype(np.uint64) << own) | (mixed(code) >> width))
    coded = coded[np.concatenate([[True], coded[1:] != coded[:-1]])]
    size = np.bincount((coded >> own).astype(np.int64), minlength=len(first))
    start = np.cumsum(size) - size
    coded &= (np.uint64(1) << own) - np.uint64(1)
    good = np.minimum(size[left], size[right]) >= LEAST * np.maximum(size[left], size[right])
    pair = np.flatnonzero(good)

    def of_pairs(line: np.ndarray) -> np.ndarray:
        """The codes of a line for each pair, behind the number of the pair."""
        n = size[line]
        at = np.arange(n.sum()) + np.repeat(start[line] - (np.cumsum(n) - n), n)
        return (np.repeat(np.arange(len(line), dtype=np.uint64), n) << own) | coded[at]

    both = np.sort(np.concatenate([of_pairs(left[pair]), of_pairs(right[pair])]))
    shared = both[1:][both[1:] == both[:-1]]
    common = np.bincount((shared >> own).astype(np.int64), minlength=len(pair))
    good[pair] = common >= LEAST * (size[left[pair]] + size[right[pair]] - common)
    return good


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sets of codes is LEAST or more."""
    if min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return False
    both = np.sort(np.concatenate([a, b]))
    common = np.count_nonzero(both[1:] == both[:-1])
    return bool(common >= LEAST * (len(both) - common))


def _windows(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of several lines as they come, repeats included, and the number of the line of each."""
    lines = [line.ljust(SHINGLE, "\0") for line in lines]
    points = np.frombuffer("".join(lines).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    lengths = np.array([len(line) for line in lines])
    inside = np.ones(len(points), dtype=bool)
    for k in range(1, SHINGLE):
        inside[np.cumsum(lengths) - k] = False
    inside = inside[: len(points) - SHINGLE + 1]
    return np.repeat(np.arange(len(lines)), lengths)[: len(inside)][inside], hashed(points)[inside]


def _coded(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of several lines, without repeats, and the number of the line of each; sorted by both."""
    of, code = _windows(lines)
    order = np.lexsort((code, of))
    code, of = code[order], of[order]
    once = np.ones(len(code), dtype=bool)
    once[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
    return of[once], code[once]


def _place(code: np.ndarray) -> np.ndarray:
    return (mixed(code) % np.uint64(PLACES)).astype(np.int64)


def _edges() -> list[int]:
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] / LEAST)))
    return edges


#: Numbers of codes with which a class of lines begins. Two lines at LEAST or more are of one class or of neighbours.
EDGES = _edges()


def class_of(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, size, "right") - 1


def width_of(kind: int) -> int:
    """The bits of the field in which the codes of a line of this class are marked: a power of two, twice as many as
    codes at least, so that a field is never full."""
    return max(64, 1 << (2 * EDGES[kind + 1] - 1).bit_length())


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many lines of the task the shingles of a place are; behind the places, the codes of the lines of a class."""
    n = np.zeros(PLACES + len(EDGES), np.int64)
    for batch in batches_of(batches, "line", 1 << 20):
        if batch.num_rows:
            of, code = _coded(batch.column(0).to_pylist())
            size = np.bincount(of, minlength=batch.num_rows)
            n[:PLACES] += np.bincount(_place(code), minlength=PLACES)
            np.add.at(n, PLACES + class_of(size), size)
    at = np.flatnonzero(n)
    yield pa.record_batch([at, n[at]], names=["place", "n"])


def least_of(size: np.ndarray, share: float) -> np.ndarray:
    """The whole number of codes that ``share`` of ``size`` demands; never one too many by rounding."""
    return np.ceil(size * share - 1e-9).astype(np.int64)


def rarest(lines: list[str], often: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """Of each line the number of its codes, the first codes by rarity (32 bits of each), and the field of bits of all.

    Two lines at LEAST or more share one of the first ``size - ceil(LEAST * size) + 1`` by any order of all
    codes, so ``often``, which may take codes together, bears on the work only and not on what is found.
    """
    of, code = _coded(lines)
    size = np.bincount(of, minlength=len(lines))
    width = np.array([width_of(kind) for kind in range(len(EDGES) - 1)])[class_of(size)]
    begin = np.cumsum(width) - width
    bits = np.zeros(int(width.sum()), dtype=bool)
    bits[begin[of] + (mixed(code) & (width[of] - 1).astype(np.uint64)).astype(np.int64)] = True
    fields = np.packbits(bits, bitorder="little").tobytes()
    order = np.lexsort((code, often[_place(code)], of))
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    n = size - least_of(size, LEAST) + 1
    first = (mixed(code[order][at < n[of]]) >> np.uint64(32)).astype("<u4").tobytes()
    cuts, ends = (4 * np.cumsum(np.append(0, n))).tolist(), (np.append(begin, len(bits)) // 8).tolist()
    return size, [first[a:b] for a, b in zip(cuts, cuts[1:])], [fields[a:b] for a, b in zip(ends, ends[1:])]


def cells_of(kind: int, block: int, blocks: list[int]) -> list[tuple[int, int]]:
    """The cells that a block of a class meets others in, and whether it is the first there (0), the second (1) or
    both (2): one with each block of its class, and of the classes beside it."""
    found = []
    for other in range(blocks[kind]):
        a, b = sorted((block, other))
        found.append(((kind << 49) | (a << 24) | b, 2 if a == b else int(block == b)))
    for low, side in ((kind, 0), (kind - 1, 1)):
        for other in range(blocks[low + 1 - side]) if low >= 0 else ():
            a, b = (block, other) if side == 0 else (other, block)
            found.append(((kind - side << 49) | (1 << 48) | (a << 24) | b, side))
    return found


CELLS = "cell long, side int, id long, root long, size int, first binary, field binary"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines that meet in a cell, each once; rows are sorted by cell."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        cell = batch.column(0).to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]])) if len(cell) else []
        for a, b in zip(bounds, bounds[1:]):
            if cell[a] != now and held:
                yield met(one_batch(held))
                held = []
            now = cell[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield met(one_batch(held))


def met(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Pairs of lines of a cell that may be at LEAST or more and have different roots."""
    side = rows.column(1).to_numpy()
    ids, root, size = (rows.column(i).to_numpy() for i in (2, 3, 4))
    _, root = np.unique(root, return_inverse=True)
    blocks = []
    for own in (side != 1, side != 0):
        line = np.flatnonzero(own)
        n = size[line] - least_of(size[line], LEAST) + 1
        first = b"".join(rows.column(5).take(pa.array(line)).to_pylist())
        field = b"".join(rows.column(6).take(pa.array(line)).to_pylist())
        field = np.frombuffer(field, "<u8").reshape(len(line), -1 if len(line) else 1)
        of = np.repeat(np.arange(len(line)), n)
        at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        code = (np.frombuffer(first, "<u4").astype(np.uint64) << np.uint64(32)) | root[line][of].astype(np.uint64)
        order = np.argsort(code)
        blocks.append((ids[line], size[line].astype(np.int64), code[order], of[order], at[order], field))
        if (side == 2).all():
            blocks.append(blocks[0])
            break
    x, y = blocks
    pairs = [_meetings(x, y)]
    if (side != 2).any() and len(x[0]) and len(y[0]) and class_of(x[1][:1]) == class_of(y[1][:1]):
        pairs.append(_meetings(y, x))
    a, b = (np.concatenate(z) for z in zip(*pairs))
    return pa.record_batch([np.minimum(a, b), np.maximum(a, b)], names=["src", "dst"])


def _meetings(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of shorter lines of one block and of longer ones of another that share one of their first codes.

    A code is behind it the number of a root, so lines of other roots are those before and after the own root
    among the rows of a code, and lines of one root never meet. A meeting is left out if the codes behind it cannot add
    up to the similarity any more, or if the lines' fields of bits differ in more places than their codes may.
    """
    (x_id, x_size, x_code, x_of, x_at, x_field), (y_id, y_size, y_code, y_of, y_at, y_field) = x, y
    while y_field.shape[1] > x_field.shape[1]:
        half = y_field.shape[1] // 2
        y_field = y_field[:, :half] | y_field[:, half:]
    short = x_at <= (x_size - least_of(x_size, SHORTER))[x_of]
    code, of, at = x_code[short], x_of[short], x_at[short]
    low = code & np.uint64(0xFFFFFFFF00000000)
    begin, own = np.searchsorted(y_code, low), np.searchsorted(y_code, code)
    past, end = np.searchsorted(y_code, code, "right"), np.searchsorted(y_code, low | np.uint64(0xFFFFFFFF), "right")
    start, n = np.concatenate([begin, past]), np.concatenate([own - begin, end - past])
    some = np.flatnonzero(n)
    start, n, row = start[some], n[some], some % max(1, len(code))
    ends = np.cumsum(n)
    many = max(1, MET * 8 // max(8, x_field.shape[1]))  # fields that are compared at once
    found = [np.zeros(0, np.int64)]
    for lo in range(0, int(ends[-1]) if len(ends) else 0, MET):
        place = np.arange(lo, min(lo + MET, int(ends[-1])))
        of_range = np.searchsorted(ends, place, "right")
        a_row, b_row = row[of_range], start[of_range] + place - (ends - n)[of_range]
        a, b = of[a_row], y_of[b_row]
        m, k = x_size[a], y_size[b]
        keep = ((m < k) | ((m == k) & (x_id[a] < y_id[b]))) & (m >= LEAST * k - 1e-9)
        keep &= np.minimum(m - at[a_row], k - y_at[b_row]) * (1 + LEAST) >= LEAST * (m + k) - 1e-9
        a, b = a[keep], b[keep]
        for i in range(0, len(a), many):
            c, d = a[i : i + many], b[i : i + many]
            apart = np.bitwise_count(x_field[c] ^ y_field[d]).sum(axis=1, dtype=np.int64)
            near = apart * (1 + LEAST) <= (1 - LEAST) * (x_size[c] + y_size[d]) + 1e-9
            found.append(c[near] * len(y_id) + d[near])
        if sum(len(z) for z in found) > MET:
            found = [np.unique(np.concatenate(found))]
    pair = np.unique(np.concatenate(found))
    return x_id[pair // max(1, len(y_id))], y_id[pair % max(1, len(y_id))]


#: Of the shorter line of a pair so many codes fewer are needed, as all that is shared must be in both.
SHORTER = 2 * LEAST / (1 + LEAST)


def crowded_links(crowd: DataFrame) -> DataFrame:
    """``src`` and ``dst`` of all pairs of different ``root`` that may be at LEAST or more, once each.

    ``crowd`` has ``id``, ``line`` and ``root``, and no id twice. Lines are dealt by classes of size into blocks of
    some ``CELL`` codes, and every two blocks whose lines may be similar meet in a cell: a line moves once for
    each block that it meets, not once for each line. None is capped.
    """
    spark = crowd.sparkSession
    counts = crowd.select("line").mapInArrow(_often, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # some PLACES rows at most, however large the corpus is
    n = np.zeros(PLACES + len(EDGES), np.int64)
    n[table["place"].to_numpy()] = table["n"].to_numpy()
    shared = spark.sparkContext.broadcast((n[:PLACES], (-(-n[PLACES:] // CELL)).tolist()))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, blocks = shared.value
        for batch in batches_of(batches, "line", 1 << 18):
            if batch.num_rows:
                size, codes_of, field = rarest(batch.column(2).to_pylist(), often)
                kinds = class_of(size).tolist()
                salts = mixed(batch.column(0).to_numpy().view(np.uint64)).tolist()
                cells = [cells_of(kind, salt % blocks[kind], blocks) for kind, salt in zip(kinds, salts)]
                taken = pa.array(np.repeat(np.arange(len(cells)), [len(x) for x in cells]))
                flat = [y for x in cells for y in x]
                yield pa.record_batch(
                    [pa.array([x for x, _ in flat], pa.int64()), pa.array([x for _, x in flat], pa.int32()),
                     batch.column(0).take(taken), batch.column(1).take(taken), pa.array(size.astype(np.int32)).take(taken),
                     pa.array(codes_of, pa.binary()).take(taken), pa.array(field, pa.binary()).take(taken)],
                    names=["cell", "side", "id", "root", "size", "first", "field"],
                )

    rows = crowd.select("id", "root", "line").mapInArrow(first, CELLS)
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_met, LINKS)


#: The fields of bits of a line, in which its codes are marked, and the number of its codes, repeats included.
FIELDS = [f"field_{i}" for i in range(16)]
LINES = "id long, line string, codes int" + "".join(f", {x} long" for x in FIELDS)


def _with_fields(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, "line", 1 << 20):
        if batch.num_rows:
            lines = [line.ljust(SHINGLE, "\0") for line in batch.column(1).to_numpy(zero_copy_only=False).tolist()]
            points = np.frombuffer("".join(lines).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
            lengths = np.array([len(line) for line in lines])
            of = np.repeat(np.arange(len(lines)), lengths)[: len(points) - SHINGLE + 1]
            inside = of == np.repeat(np.arange(len(lines)), lengths)[SHINGLE - 1 :]
            bit = hashed(points)[inside] >> np.uint64(64 - 10)  # 1024 bits
            seen = np.zeros(len(lines) << 10, dtype=bool)
            seen[(of[inside] << 10) + bit.astype(np.int64)] = True
            fields = np.packbits(seen.reshape(len(lines), -1), axis=1, bitorder="little").view("<i8")
            yield pa.record_batch(
                [*batch.columns, pa.array((lengths - SHINGLE + 1).astype(np.int32)), *(pa.array(x.copy()) for x in fields.T)],
                names=["id", "line", "codes", *FIELDS],
            )


def _marked(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """The lines whose ``id`` is one of these, and by chance a few others; the rest never moves."""
    marks = lines.sparkSession.sparkContext.broadcast(marks_of(ids, "id"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marks.value.hit(batch.column(0).to_numpy().view(np.uint64))))

    return lines.mapInArrow(marked, lines.schema)


def _checked(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs at LEAST or more. Where fields differ in more bits than codes may, the codes need not be compared:
    a bit that only one line has is a code that only this line has. Fields move first, and lines only for the pairs
    that are left."""
    left = lines.select(F.col("id").alias("src"), F.col("codes").alias("n"), *FIELDS)
    right = lines.select(F.col("id").alias("dst"), F.col("codes").alias("m"), *(F.col(x).alias(f"{x}_b") for x in FIELDS))
    apart = F.expr(" + ".join(f"bit_count({x} ^ {x}_b)" for x in FIELDS))
    near = written(
        pairs.join(left, "src").join(right, "dst")
        .where(apart * (1 + LEAST) <= (1 - LEAST) * (F.col("n") + F.col("m")) + 1e-9)
        .select("src", "dst")
    )
    texts = _marked(lines.select("id", "line"), near.select(F.explode(F.array("src", "dst")).alias("id")))
    both = near.join(texts.toDF("src", "a"), "src").join(texts.toDF("dst", "b"), "dst")
    return both.select("src", "dst", "a", "b").mapInArrow(_similar, LINKS)


def line_components(lines: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` of the ids of different lines that are linked at a similarity of LEAST or more.

    ``lines`` has ``id`` and ``line``, a written table; a line may stand in several rows."""
    banded = lines.select("id", "line").mapInArrow(_bands, PACKETS).repartition("bucket")
    found = written(
        banded.sortWithinPartitions("bucket", "band").mapInArrow(_paired, LINKS).distinct()
    )
    wanted = written(found.select(F.explode(F.array("src", "dst")).alias("id")).distinct())
    texts = _marked(lines.select("id", "line"), wanted).join(wanted, "id", "left_semi")
    lines = written(texts.dropDuplicates(["id"]).mapInArrow(_with_fields, LINES))
    linked = written(components(_checked(found.where("src != dst"), lines)))
    crowded = found.where("src = dst").select(F.col("src").alias("id"))
    if crowded.isEmpty():
        return linked
    crowd = written(
        _marked(lines, crowded).join(crowded, "id").join(linked, F.col("id") == F.col("vertex"), "left").select(
            *lines.columns, F.coalesce("root", "id").alias("root")
        )
    )
    roots = crowd.select("id", "root")
    more = _checked(written(crowded_links(crowd)), crowd)
    between = written(
        more.join(roots.toDF("src", "a"), "src").join(roots.toDF("dst", "b"), "dst").select(
            F.col("a").alias("src"), F.col("b").alias("dst")
        )
    )
    if between.isEmpty():
        return linked
    # only roots are linked anew: the vertices of a component follow its root
    tops = written(components(between))
    moved = linked.join(tops.toDF("root", "top"), "root", "left").select("vertex", F.coalesce("top", "root").alias("root"))
    return moved.union(tops.join(linked.select("vertex"), "vertex", "left_anti").select("vertex", "root"))


def dropped_lines(docs: DataFrame, row: str = "row") -> DataFrame:
    """``row`` and ``dropped`` (positions, ascending) of documents that lose lines, as a written table.

    ``docs`` has ``doc_id``, ``text`` and ``row``, which is equal only for rows that are equal in both. All tables
    in between are removed.
    """
    spark = docs.sparkSession
    ship(spark)
    with scratch_tables(spark):
        seen = written(
            docs.select(F.col("doc_id").cast("long"), row, "text").mapInArrow(
                _occurrences, "id long, doc_id long, row long, place int, line string"
            )
        )
        linked = written(line_components(seen.where("line is not null").select("id", "line")))
        where = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "place")
        # a line that stands once and has no link is a class of one; only the others move on
        counts = seen.groupBy("id").agg(F.count("*").alias("n"))
        repeated = written(
            counts.join(linked, counts.id == linked.vertex, "left").where("n > 1 or root is not null").select(
                "id", F.coalesce("root", "id").alias("root")
            )
        )
        members = written(seen.drop("line").join(repeated, "id"))
        kept = members.groupBy("root").agg(F.min(where).alias("kept"))
        by_id = repeated.join(kept, "root").select("id", "kept")
        gone = members.join(by_id, "id").where(where != F.col("kept"))
        rows = gone.groupBy("row").agg(F.array_sort(F.collect_set("place")).alias("dropped"))
        return written(rows, lasting=True)


def without(text: str, dropped: str) -> Column:
    """The lines of a text but those at the dropped positions; the text is split once, in time with its length."""
    kept = f"array_except(sequence(0, size(lines) - 1), {dropped})"
    return F.expr(
        f"element_at(transform(array(split({text}, '\n', -1)), "
        f"lines -> array_join(transform({kept}, i -> get(lines, i)), '\n')), 1)"
    )


def dedup_lines(docs: DataFrame, *extra: Column) -> DataFrame:
    """The documents, in all their columns, without the lines that an earlier line of the corpus is
    similar to; ``text`` is what is left, joined by line ends. ``extra`` columns may use ``dropped``, the
    positions of the lines left out (null for none), and ``__doc``, the document as it was.

    Lines without content stay. A null text stays null. A document that loses all lines has an empty
    text. Rows that are equal in id and text are one document: all of them keep the same lines. A null
    ``doc_id`` comes after all others. Columns of any name stay as they are; an empty table stays empty.
    A text of any length, and a line of any length, is taken whole. Two different lines share an id with a
    probability of 2**-64.
    """
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = docs.select(F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("__doc"), row.alias("__row"))
    gone = dropped_lines(docs.select("doc_id", "text", row.alias("row")))
    joined = keyed.join(gone.withColumnRenamed("row", "__row"), "__row", "left")
    text = F.when(F.col("dropped").isNull(), F.col("__doc.text")).otherwise(without("__doc.text", "dropped"))
    return joined.select(*((text if x == "text" else F.col(f"__doc.`{x}`")).alias(x) for x in docs.columns),
                         *extra)
