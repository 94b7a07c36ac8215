"""Frequent phrases of a corpus by relational mining (SETM).

An occurrence relation of length k has an entry (place, key) wherever a phrase of k words begins that may be
frequent. It is sorted by place, and a place tells piece and position at once: neighbouring words of a piece
have neighbouring places, and between pieces one place is left out. The relation of single words is the text
itself; longer ones are written, some hundred thousand entries in a row, cut only where two neighbouring entries
have no neighbouring places, so that no later phrase is lost between rows. A task holds few of them at once.

The next length is a merge-join of the relation with itself on neighbouring places: two phrases of k words that
begin at neighbouring words overlap in all but their ends and are together a phrase of k + 1 words. These
are grouped and counted, in the task first and then by a shuffle of counts, which travel in packets by the first
bits of their keys, not as rows; the frequent groups are a table.
Before the next length is made the relation is semi-joined with its frequent groups. For this their keys
are marked in a field of bounded size, which every task gets whatever the corpus holds: an entry without its
mark goes. One that shares a mark by chance stays and costs work only, since the counts of all groups are exact.

Keys are 128-bit hashes of the language and the words, so occurrences never move: a shuffle carries counts
of distinct phrases and, at the end, the words of the frequent ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .line_dedup import mixed
from .shared import Marks, batches_of, marks_of, ship, written

LEAST, LONGEST, SHARE, FIRST, FACTOR = 100, 5, 100, 2000, 1000
BATCH, SMALL_BATCH = 8 << 20, 2 << 20  # bytes of text at once: single words are combined in larger batches
ENTRIES, COUNTED = 1 << 17, 1 << 20  # entries in a row of a relation, and counted at once
#: What ends a piece, and what stands between words.
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
KEYS = "a long, b long"
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
PACKETS = "bucket int, a binary, b binary, n binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BREAK, _SEPARATOR = np.zeros((2, 256), dtype=bool)
_BREAK[list(BREAKS)] = True
_SEPARATOR[list(BREAKS + SPACES)] = True
_ODD = mixed(np.arange(1, 5, dtype=np.uint64)) | np.uint64(1)

Keys = tuple[np.ndarray, np.ndarray]


def hashed(values: list[bytes]) -> Keys:
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, values)), ">u8").astype(np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def joined(left: Keys, right: Keys) -> Keys:
    """The keys of two overlapping phrases, or of a language and a word, together."""
    (a, b), (c, d) = left, right
    return mixed(a * _ODD[0] + c * _ODD[1] + b), mixed(b * _ODD[2] + d * _ODD[3] + c)


class Words:
    """The words of a batch of texts: their places, languages and keys; ``code`` numbers the distinct words."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self.data = _LOWER[data]
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = ~_SEPARATOR[data]
        first = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
        first[offsets] = True
        begins = inside[1:] & (first | ~inside[:-1])
        self.begin = np.flatnonzero(begins)
        self.end = np.flatnonzero(inside[:-1] & (first | ~inside[1:]))
        piece = np.cumsum(first[:-1] | _BREAK[data]) if len(data) else np.zeros(0, np.int64)
        self.place = np.arange(len(self.begin)) + piece[self.begin]
        doc = np.searchsorted(offsets, self.begin, side="right") - 1
        langs = pc.fill_null(langs, "und").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False)[doc]
        self.doc = doc
        sizes = np.concatenate([[0], np.cumsum(self.end - self.begin)])
        words = pa.Array.from_buffers(
            pa.large_binary(), len(self.begin),
            [None, pa.py_buffer(sizes.astype("<i8").tobytes()), pa.py_buffer(self.data[inside[1:-1]].tobytes())],
        ).dictionary_encode()
        self.code = words.indices.to_numpy(zero_copy_only=False)
        self.distinct = words.dictionary

    def keys(self) -> Keys:
        word, lang = hashed(self.distinct.to_pylist()), hashed([x.encode() for x in self.langs])
        return joined((lang[0][self.lang], lang[1][self.lang]), (word[0][self.code], word[1][self.code]))

    def texts(self, at: np.ndarray, length: int) -> list[str]:
        """The phrases of ``length`` words that begin at these words."""
        code = self.code[at[:, None] + np.arange(length)]
        used, code = np.unique(code, return_inverse=True)
        words = np.array([x.decode() for x in self.distinct.take(pa.array(used)).to_pylist()], dtype=object)
        return [" ".join(row) for row in words[code.reshape(-1, length)]]


def merged(place: np.ndarray, keys: Keys) -> tuple[np.ndarray, Keys]:
    """The relation of the next length: entries at neighbouring places, together."""
    hit = np.flatnonzero(place[1:] == place[:-1] + 1)
    a, b = keys
    return place[hit], joined((a[hit], b[hit]), (a[hit + 1], b[hit + 1]))


def kept(place: np.ndarray, keys: Keys, marks: Marks) -> tuple[np.ndarray, Keys]:
    """The semi-join with the marked keys."""
    hit = marks.hit(keys[0])
    return place[hit], (keys[0][hit], keys[1][hit])


def together(held: list[Keys]) -> Keys:
    return np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])


def counted(keys: Keys, n: np.ndarray | None = None) -> tuple[Keys, np.ndarray]:
    """The distinct keys, sorted, and how often each occurs: once for each place, or ``n`` times."""
    order = np.argsort(keys[0])
    a, b = keys[0][order], keys[1][order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((keys[1], keys[0]))
        a, b = keys[0][order], keys[1][order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else order
    if n is None:
        total = np.diff(np.append(first, len(a)))
    else:
        total = np.add.reduceat(n[order], first) if len(a) else n
    return (a[first], b[first]), total


def packets(keys: Keys, n: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and their counts, in a row for each bucket (the first bits of the keys)."""
    bounds = np.searchsorted(keys[0], np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS))
    used = np.flatnonzero(np.diff(np.append(bounds, len(n))))
    bounds = np.append(bounds[used], len(n))
    columns = [
        pa.Array.from_buffers(
            pa.binary(), len(used), [None, pa.py_buffer((bounds * 8).astype("<i4").tobytes()), pa.py_buffer(x.tobytes())]
        )
        for x in (*keys, n.astype("<i8", copy=False))
    ]
    return pa.record_batch([pa.array(used.astype(np.int32)), *columns], names=["bucket", "a", "b", "n"])


def sums(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Of packets sorted by bucket the keys with their sums, those of ``least`` or more. What is held of a bucket is
    summed whenever it has doubled."""
    now, held, size, most = None, [], 0, COUNTED

    def total() -> tuple[Keys, np.ndarray]:
        return counted(together([keys for keys, _ in held]), np.concatenate([n for _, n in held]))

    def frequent() -> pa.RecordBatch:
        (a, b), n = total()
        enough = n >= least
        return pa.record_batch([a[enough].view(np.int64), b[enough].view(np.int64), n[enough]], names=["a", "b", "f"])

    for batch in batches:
        for i, bucket in enumerate(batch.column(0).to_pylist()):
            if bucket != now:
                if held:
                    yield frequent()
                now, held, size, most = bucket, [], 0, COUNTED
            a, b, n = (np.frombuffer(batch.column(j)[i].as_buffer(), kind) for j, kind in ((1, "<u8"), (2, "<u8"), (3, "<i8")))
            held.append(((a, b), n))
            size += len(n)
            if size >= most:
                held = [total()]
                size = len(held[0][1])
                most = max(COUNTED, 2 * size)
    if held:
        yield frequent()


def _words(batches: Iterator[pa.RecordBatch], most_bytes: int = SMALL_BATCH) -> Iterator[Words]:
    for batch in batches_of(batches, "text", most_bytes):
        yield Words(batch.column(0), batch.column(1))


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words in _words(batches, BATCH):
        of, n = np.unique(words.lang * np.int64(len(words.distinct)) + words.code, return_counts=True)
        lang, code = (of // max(1, len(words.distinct)), of % max(1, len(words.distinct)))
        yield pa.record_batch(
            [pa.array(words.langs, pa.string()).take(pa.array(lang)),
             words.distinct.take(pa.array(code)).cast(pa.string()), pa.array(n)],
            names=["lang", "word", "n"],
        )


def _relation(place: np.ndarray, keys: Keys) -> Iterator[pa.RecordBatch]:
    """Rows of about ENTRIES entries; one ends only where the next place is no neighbour."""
    gaps = np.append(np.flatnonzero(place[1:] != place[:-1] + 1) + 1, len(place))
    cuts = gaps[np.searchsorted(gaps, np.arange(ENTRIES, len(place), ENTRIES))]
    bounds = np.unique([0, *cuts, len(place)]).tolist()
    for start, end in zip(bounds, bounds[1:]):
        columns = [[x[start:end].tobytes()] for x in (place.astype("<i8", copy=False), *keys)]
        yield pa.record_batch([pa.array(x, pa.binary()) for x in columns], names=["place", "a", "b"])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Keys]]:
    for batch in batches:
        for i in range(batch.num_rows):
            place, a, b = (np.frombuffer(batch.column(j)[i].as_buffer(), kind) for j, kind in enumerate(("<i8", "<u8", "<u8")))
            yield place, (a, b)


def _summed(rows: DataFrame, least: int) -> DataFrame:
    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sums(batches, least)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInArrow(frequent, f"{KEYS}, f long"))


def mine_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, first: int = FIRST
) -> DataFrame:
    """The ``first`` phrases of each language by their score: lang, rank, phrase, a, l, r, n, score.

    Texts in lower case (A to Z) are split at ``.,;:!?`` and line ends into pieces, and these at spaces and
    tabs into words. A phrase of 2 to ``longest`` words that occurs ``least`` times or more (``a``; overlapping
    occurrences count) is a candidate, unless a longer candidate holds its words and has at least ``share``
    hundredths of its occurrences. Cut after k words, its score is floor(1000 * a * n / (l * r)) with the
    counts l and r of both parts and n of all words of the language; the cut with the lowest counts, the first
    among equals. Order is by score, then ``a``, both descending, then by the phrase's bytes, so there are no ties.

    A null text is empty; a null language is ``und``; repeated rows count each; a word or a text of any length is
    taken whole; other columns are left out; an empty table, or one without a frequent phrase, gives no rows.
    Two different phrases share a key with a probability of 2**-128.
    """
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    words = written(
        source.mapInArrow(_single, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = words.where(F.col("f") >= least).select(F.col("word").alias("text"), "lang", "f")
    frequent = [written(common.mapInArrow(_keyed, "a long, b long, f long"))]
    marks = [spark.sparkContext.broadcast(marks_of(frequent[0]))]
    relation: DataFrame | None = None
    for k in range(2, longest + 1):
        shorter, of_text = marks[-1], relation is None

        def lengthened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Keys]]:
            entries = ((x.place, x.keys()) for x in _words(batches)) if of_text else _entries(batches)
            for place, keys in entries:
                yield merged(*kept(place, keys, shorter.value))

        def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[Keys] = []
            for _, keys in lengthened(batches):
                held.append(keys)
                if sum(len(a) for a, _ in held) >= COUNTED:
                    yield packets(*counted(together(held)))
                    held = []
            if held:
                yield packets(*counted(together(held)))

        before = source if relation is None else relation
        found = _summed(before.mapInArrow(counts, PACKETS), least)
        if found.isEmpty():
            break
        frequent.append(found)
        marks.append(spark.sparkContext.broadcast(marks_of(found)))
        if k < longest:
            longer = marks[-1]

            def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for place, keys in lengthened(batches):
                    yield from _relation(*kept(place, keys, longer.value))

            relation = written(before.mapInArrow(entries, "place binary, a binary, b binary"))
    return _ranked(spelled(source, marks, frequent), frequent, totals, share, first)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = Words(batch.column(0), batch.column(1))  # each row is one word
        a, b = words.keys()
        yield pa.record_batch([a.view(np.int64), b.view(np.int64), batch.column(2)], names=["a", "b", "f"])


def spelled(source: DataFrame, marks: list, frequent: list[DataFrame]) -> DataFrame:
    """Language and words of all frequent phrases of two words or more, with key and count ``f``."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0, np.uint64)] * len(marks)
        for words in _words(batches):
            place, keys = words.place, words.keys()
            index = words.place  # of the entries, to find the word at which each begins
            for k, own in enumerate(marks):
                if k:
                    place, keys = merged(place, keys)
                place, keys = kept(place, keys, own.value)
                if k:
                    fresh, at = np.unique(keys[0], return_index=True)
                    new = ~np.isin(fresh, seen[k], assume_unique=True)
                    at = at[new]
                    seen[k] = np.union1d(seen[k], fresh[new]) if len(seen[k]) < 1_000_000 else fresh[new]
                    begin = np.searchsorted(index, place[at])
                    langs = pa.array(words.langs, pa.string()).take(pa.array(words.lang[begin]))
                    yield pa.record_batch(
                        [pa.array(np.full(len(at), k + 1, np.int32)), pa.array(keys[0][at].view(np.int64)),
                         pa.array(keys[1][at].view(np.int64)), langs, pa.array(words.texts(begin, k + 1), pa.string())],
                        names=["k", "a", "b", "lang", "text"],
                    )

    every = frequent[0].select(F.lit(1).alias("k"), "a", "b", "f").where("false")
    for k, table in enumerate(frequent[1:], 2):
        every = every.union(table.select(F.lit(k).alias("k"), "a", "b", "f"))
    named = source.mapInArrow(phrases, f"k int, {KEYS}, lang string, text string").dropDuplicates(["k", "a", "b"])
    return written(named.join(every, ["k", "a", "b"]))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each phrase the keys of what stands before and behind each cut, and ``sub`` 1 where that is all but a word."""
    for batch in batches:
        words = Words(batch.column("text"), batch.column("lang"))
        sizes = batch.column("k").to_numpy()
        start = np.cumsum(sizes) - sizes
        relation = [words.keys()]
        while len(relation) < (sizes.max() if len(sizes) else 0):
            a, b = relation[-1]
            relation.append(joined((a[:-1], b[:-1]), (a[1:], b[1:])))
        for cut in range(1, len(relation)):
            at = np.flatnonzero(sizes > cut)
            rest = sizes[at] - cut
            right = [np.zeros(len(at), np.uint64) for _ in range(2)]
            for size in np.unique(rest).tolist():
                of = rest == size
                for half in range(2):
                    right[half][of] = relation[size - 1][half][start[at[of]] + cut]
            left = [half[start[at]] for half in relation[cut - 1]]
            rows = batch.take(pa.array(at))
            yield pa.record_batch(
                [*(rows.column(x) for x in ("k", "a", "b", "lang", "text", "f")), pa.array(np.full(len(at), cut, np.int32)),
                 *(pa.array(x.view(np.int64)) for x in (*left, *right))],
                names=["k", "a", "b", "lang", "text", "f", "cut", "la", "lb", "ra", "rb"],
            )


PARTS = "k int, a long, b long, lang string, text string, f long, cut int, la long, lb long, ra long, rb long"


def _ranked(
    phrases: DataFrame, frequent: list[DataFrame], totals: DataFrame, share: int, first: int
) -> DataFrame:
    """Candidates without those that a longer one stands for, by language and rank.

    It is enough to look at longer ones by one word: a phrase between two others occurs at least as often as the
    longer one, so it is a candidate and stands for the shorter one too."""
    columns = ["k", "a", "b", "lang", "text", "f"]
    cuts = written(phrases.select(*columns).mapInArrow(_parts, PARTS))
    every = frequent[0].select(F.lit(1).alias("k"), "a", "b", "f")
    for k, table in enumerate(frequent[1:], 2):
        every = every.union(table.select(F.lit(k).alias("k"), "a", "b", "f"))
    left = every.toDF("lk", "la", "lb", "l")
    right = every.toDF("rk", "ra", "rb", "r")
    parts = cuts.withColumn("lk", F.col("cut")).withColumn("rk", F.col("k") - F.col("cut"))
    parts = parts.join(left, ["lk", "la", "lb"]).join(right, ["rk", "ra", "rb"]).join(totals, "lang")
    scored = parts.withColumn("score", F.expr(SCORE))
    best = scored.groupBy("k", "a", "b", "lang", "text", "f", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best")
    )
    inner = cuts.where("k > 2 and cut = k - 1").select((F.col("k") - 1).alias("k"), F.col("la").alias("a"),
                                                       F.col("lb").alias("b"), "f")
    outer = cuts.where("k > 2 and cut = 1").select((F.col("k") - 1).alias("k"), F.col("ra").alias("a"),
                                                   F.col("rb").alias("b"), "f")
    longer = inner.union(outer).groupBy("k", "a", "b").agg(F.max("f").alias("often"))
    kept_ = best.join(longer, ["k", "a", "b"], "left").where(
        F.col("often").isNull()
        | (F.col("often").cast("decimal(19,0)") * 100 < F.col("f").cast("decimal(19,0)") * share)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        kept_.select("lang", F.col("text").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "n", "best.score")
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= first)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


#: Products of counts are decimals of up to 38 digits; div leaves their whole part.
SCORE = (
    f"cast(f as decimal(19,0)) * cast(n as decimal(14,0)) * {FACTOR}bd "
    "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
)
