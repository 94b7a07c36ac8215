"""Quality rules: counts of words and repeats, and the perplexity of an n-gram model of the corpus.

The model is one modified Kneser-Ney model for each language, over the characters themselves: UTF-16 units, of
which a character outside the first plane has two, numbered by the corpus' own alphabet. Nothing is taken together
but runs of white space, so the model grows with the corpus. A gram is the exact numbers of its units in 64 bits, so
the order is ``LONGEST`` (5), or 4 for an alphabet of more than 4095 units, which need over 12 bits each.
Spark finds the alphabet, counts the n-grams of the documents that pass the base rules (combined in each task before
they are shuffled), derives the continuation counts of the lower orders, the discounts and the interpolated probabilities
by aggregates and joins, and stores the model as sorted 64-bit hashes with their values. For scoring, the sorted arrays
are copied to the executors if they have ``MOST_ENTRIES`` at most; a larger model is joined by a shuffle.

A document is rejected if its log perplexity lies outside Tukey's fences of its language and length: ``FENCE``
interquartile ranges below the lower or above the upper quartile of the documents that pass the base rules
and have as many words, by powers of two. Lengths with fewer than ``ENOUGH`` documents take the fences of
the whole language. A range counts as ``LEAST_SPREAD`` bits at least, so that a corpus of equals rejects
none of them. The rule is the usual one for outliers and was not fitted to labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .line_dedup import mixed
from .shared import batches_of, scratch_tables, ship, written

ORDER, LONGEST = 4, 5
BITS = 6  # of a symbol, unless an alphabet needs more
SYMBOLS = 1 << BITS
UNITS = 1 << 16
TOP = np.uint64(1 << 63)
MOST_ENTRIES = 8_000_000  # of 16 bytes
FENCE, LEAST_SPREAD, ENOUGH = 1.5, 0.04, 50
LEAST_WORDS, MOST_REPEATED = 50, 50
NO_LANGUAGE = "und"
COUNTED = 1 << 21  # symbols counted at once
SIGNS = "#*$%&|<>"


SPACE = np.zeros(UNITS, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class Alphabet:
    """Numbers of UTF-16 units: 0 is white space, the others follow in order. ``bits`` hold any of them, and 64
    bits hold ``order`` of them, ``longest`` at most."""

    def __init__(self, units: np.ndarray, longest: int = ORDER):
        units = np.unique(units)
        units = units[~SPACE[units]]
        self.bits = max(BITS, len(units).bit_length())
        self.order = min(longest, 64 // self.bits)
        self.number = np.zeros(UNITS, dtype=np.uint16)
        self.number[units] = np.arange(1, len(units) + 1)


def units_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-16-le"), dtype="<u2")


def symbols(text: str, alphabet: Alphabet) -> np.ndarray:
    """Numbers of the units, with one 0 for each run of white space and around the text."""
    of = alphabet.number[units_of(f" {text} ")]
    return of[np.concatenate([[True], (of[1:] != 0) | (of[:-1] != 0)])]


def grams(text: str, alphabet: Alphabet | None = None) -> np.ndarray:
    """The n-grams of a text: numbers side by side, by the text's own alphabet if none is given."""
    alphabet = Alphabet(units_of(text)) if alphabet is None else alphabet
    order, of = alphabet.order, symbols(text, alphabet).astype(np.uint64)
    if len(of) < order:
        of = np.concatenate([np.zeros(order - len(of), np.uint64), of])
    out = of[: len(of) - order + 1].copy()
    for k in range(1, order):
        out <<= np.uint64(alphabet.bits)
        out |= of[k : len(of) - order + 1 + k]
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The units in a task's texts."""
    seen = np.zeros(UNITS, dtype=bool)
    for batch in batches_of(batches, "text", 2 << 20):
        seen[units_of(" ".join(x for x in batch.column(0).to_pylist() if x))] = True
    yield pa.record_batch([pa.array(np.flatnonzero(seen).astype(np.int32))], names=["unit"])


def alphabet_of(docs: DataFrame) -> Alphabet:
    """The alphabet of all texts; UTF-16 has UNITS units at most, however large the corpus is."""
    units = docs.select("text").mapInArrow(_units, "unit int").distinct().toArrow()
    return Alphabet(units["unit"].to_numpy(), LONGEST)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    words = raw.split()
    spaces = sum(map(text.count, " \t\n\r\x0b\x0c"))
    signs = sum(map(text.count, SIGNS))
    lines = [line for line in raw.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
    triples = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(triples)) < len(triples):
        seen: dict[tuple, int] = {}
        for triple in triples:
            seen[triple] = seen.get(triple, 0) + 1
        hit = np.zeros(len(words), dtype=bool)
        at = np.flatnonzero(np.fromiter((seen[t] > 1 for t in triples), bool, len(triples)))
        for k in range(3):
            hit[at + k] = True
        repeated = int(hit.sum())
    return len(words), len(text) - spaces, signs, len(lines) - len(set(lines)), repeated


def fails(n_words: int, n_repeat_words: int) -> bool:
    """The base rules."""
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def _counts(batches: Iterator[pa.RecordBatch], alphabet: Alphabet | None = None) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of those of a task's documents that pass the base rules."""
    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    counted: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def count(lang: str) -> None:
        new, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        if lang in counted:
            old, m = counted[lang]
            both, where = np.unique(np.concatenate([old, new]), return_inverse=True)
            n = np.bincount(where, np.concatenate([m, n]).astype(np.float64)).astype(np.int64)
            new = both
        counted[lang], sizes[lang] = (new, n), 0

    def rows(lang: str) -> pa.RecordBatch:
        gram, n = counted.pop(lang)
        return pa.record_batch(
            [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)],
            names=["lang", "gram", "n"],
        )

    for batch in batches_of(batches, "text", 2 << 20):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text and not fails(*base_counts(text)[::4]):
                held.setdefault(lang, []).append(own := grams(text, alphabet))
                sizes[lang] = sizes.get(lang, 0) + len(own)
                if sizes[lang] >= COUNTED:
                    count(lang)
                    if len(counted[lang][0]) >= COUNTED:  # no more grams are held than are counted at once
                        yield rows(lang)
    for lang in list(held):
        count(lang)
    for lang in list(counted):
        yield rows(lang)


def kneser_ney(counts: DataFrame, bits: int = BITS, order: int = ORDER) -> DataFrame:
    """``lang``, ``size``, ``gram``, ``logp`` (base 2) and ``backoff`` (log of the weight that the gram as
    a context leaves to shorter grams; null where it is never a context) from counts of n-grams of
    ``order`` symbols of so many ``bits``."""
    adjusted = {order: counts.select("lang", F.col("gram").cast("long"), "n")}
    for size in range(order - 1, 0, -1):  # in how many contexts one longer a gram ends
        short = F.col("gram").bitwiseAND(F.lit((1 << bits * size) - 1))
        adjusted[size] = adjusted[size + 1].groupBy("lang", short.alias("gram")).agg(F.count("*").alias("n"))
    every = None
    for size, table in adjusted.items():
        table = table.withColumn("size", F.lit(size))
        every = table if every is None else every.union(table.select(every.columns))
    every = written(every)
    n_of = lambda k: F.count(F.when(F.col("n") == k, 1)).cast("double")
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    discounts = every.groupBy("lang", "size").agg(*(n_of(k).alias(f"n{k}") for k in (1, 2, 3, 4)))
    fallback = {1: 0.5, 2: 0.75, 3: 0.9}  # where a corpus is too small to estimate discounts
    for k in (1, 2, 3):
        estimate = k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
        usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{k}") > 0) & (F.col(f"n{k + 1}") > 0)
        discounts = discounts.withColumn(
            f"d{k}", F.when(usable & (estimate > 0) & (estimate < k), estimate).otherwise(fallback[k])
        )
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = F.shiftrightunsigned("gram", bits).alias("context")
    less = every.join(F.broadcast(discounts.select("lang", "size", "d1", "d2", "d3")), ["lang", "size"]).select(
        "lang", "size", "gram", context, "n", discount.alias("d")
    )  # a row for each language and order is broadcast
    left = less.groupBy("lang", "size", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("left"))
    parts = less.join(left, ["lang", "size", "context"]).select(
        "lang", "size", "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("own"),
        (F.col("left") / F.col("total")).alias("weight"),
    )
    parts = written(parts)
    p = None
    for size in range(1, order + 1):
        own = parts.where(F.col("size") == size)
        if p is None:
            now = own.withColumn("p", F.col("own") + F.col("weight") / (1 << bits))
        else:
            short = F.col("gram").bitwiseAND(F.lit((1 << bits * (size - 1)) - 1))
            lower = p.select("lang", F.col("gram").alias("short"), F.col("p").alias("below"))
            now = own.withColumn("short", short).join(lower, ["lang", "short"]).withColumn(
                "p", F.col("own") + F.col("weight") * F.col("below")
            )
        p = written(now.select("lang", F.lit(size).alias("size"), "gram", "p"))
        every = p if size == 1 else every.unionByName(p)
    weights = left.select("lang", (F.col("size") - 1).alias("size"), F.col("context").alias("gram"),
                          F.log2(F.col("left") / F.col("total")).alias("backoff"))
    grams_ = every.join(weights, ["lang", "size", "gram"], "left").select(
        "lang", "size", "gram", F.log2("p").alias("logp"), "backoff"
    )
    nothing = weights.where(F.col("size") == 0).select(
        "lang", "size", "gram", F.lit(0.0).alias("logp"), "backoff"
    )  # the empty gram, as the context of single symbols
    return grams_.union(nothing)


def key_of(lang: int, size: int | np.ndarray, gram: np.ndarray) -> np.ndarray:
    """A 64-bit hash of language, order and gram; one to one for the grams of a language and an order."""
    of = np.atleast_1d((np.asarray(lang, np.int64) << 3) + size).view(np.uint64)
    return mixed(gram.astype(np.uint64) ^ mixed(of + np.uint64(1))).view(np.int64)


class Model:
    """Sorted keys with log probabilities and back-off weights; languages by their place in ``langs``."""

    def __init__(
        self, langs: list[str], keys: np.ndarray, logp: np.ndarray, backoff: np.ndarray, alphabet: Alphabet | None = None
    ):
        self.langs, self.keys, self.logp, self.backoff, self.alphabet = langs, keys, logp, backoff, alphabet
        self.place = {lang: i for i, lang in enumerate(langs)}
        width = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - width)
        edges = np.arange(1 << width, dtype=np.uint64) << self.shift ^ TOP  # the keys are hashes, dealt evenly
        self.first = np.searchsorted(keys, edges.view(np.int64)).astype(np.int32)
        self.padded = np.append(keys, np.iinfo(np.int64).max)

    def bits(self, lang: str, texts: list[str]) -> np.ndarray:
        """Minus the mean log probability of the n-grams of each text."""
        each = [grams(text, self.alphabet) for text in texts]
        sizes, bits = np.array([len(x) for x in each]), self.alphabet.bits
        if lang not in self.place:
            return np.full(len(texts), float(bits))
        number, left = self.place[lang], np.concatenate(each)
        log, at_of, carried = np.empty(len(left)), np.arange(len(left)), np.zeros(len(left))
        for size in range(self.alphabet.order, 0, -1):
            at, found = self._find(key_of(number, size, left))
            log[at_of[found]] = self.logp[at[found]] + carried[found]
            left, carried, at_of = left[~found], carried[~found], at_of[~found]
            if not len(left):
                break
            at, found = self._find(key_of(number, size - 1, left >> np.uint64(bits)))
            carried[found] += self.backoff[at[found]]
            left = left & np.uint64((1 << bits * (size - 1)) - 1)
        log[at_of] = carried - bits
        return -np.add.reduceat(log, np.cumsum(sizes) - sizes) / sizes

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the keys are, or would be; and whether they are there."""
        at = self.first[((keys.view(np.uint64) ^ TOP) >> self.shift).view(np.int64)]
        there = self.padded[at]
        going = np.flatnonzero(there < keys)
        while len(going):
            at[going] += 1
            there[going] = self.padded[at[going]]
            going = going[there[going] < keys[going]]
        return at, (there == keys) & (at < len(self.keys))


def collected(model: DataFrame, alphabet: Alphabet | None = None) -> Model:
    """The model as arrays sorted by the hash of a gram. The caller checks its size: an entry has 16 bytes."""
    langs = sorted(row.lang for row in model.select("lang").distinct().collect())
    place = {lang: i for i, lang in enumerate(langs)}

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([place[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            size, gram = (batch.column(i).to_numpy().astype(np.int64) for i in (1, 2))
            keys = key_of(lang, size, gram) if len(lang) else lang
            yield pa.record_batch([pa.array(keys), batch.column(3), batch.column(4)], names=["key", "logp", "backoff"])

    values = model.select("lang", "size", "gram", F.col("logp").cast("float"),
                          F.coalesce("backoff", F.lit(0.0)).cast("float").alias("backoff"))
    table = values.mapInArrow(hashes, "key long, logp float, backoff float").toArrow()
    keys, logp, backoff = (table[x].to_numpy() for x in ("key", "logp", "backoff"))
    order = np.argsort(keys, kind="stable")
    return Model(langs, keys[order], logp[order], backoff[order], alphabet)


KEYED = ("doc_id", "key", "lang")
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def scored(docs: DataFrame, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``doc_id``, ``key``, the base counts, ``base_failed``, ``lang`` and ``bits`` (the log perplexity, per
    UTF-16 unit) of every row. ``docs`` has ``doc_id``, ``key``, ``lang`` and ``text``; further columns stay."""
    spark = docs.sparkSession
    ship(spark)
    alphabet = alphabet_of(docs)
    counts = docs.select("lang", "text").mapInArrow(
        lambda batches: _counts(batches, alphabet), "lang string, gram long, n long"
    )
    counts = written(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    model = written(kneser_ney(counts, alphabet.bits, alphabet.order))
    small = model.limit(most_entries + 1).count() <= most_entries
    shared = spark.sparkContext.broadcast(collected(model, alphabet)) if small else None

    @F.arrow_udf(f"{COUNTS}, bits double")
    def score(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        batches = (pa.record_batch(list(both), names=["lang", "text"]) for both in columns)
        for batch in batches_of(batches, "text", 1 << 19):  # arrays of a dozen words for each unit of a text
            langs, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            base = np.array([base_counts(x) for x in texts], dtype=np.int64).reshape(-1, 5)
            bits = np.zeros(len(texts))
            if shared is not None:
                of = np.array(langs, dtype=object)
                for lang in set(langs):
                    at = np.flatnonzero(of == lang)
                    bits[at] = shared.value.bits(lang, [texts[i] for i in at.tolist()])
            yield pa.StructArray.from_arrays(
                [*(pa.array(x) for x in base.T.copy()), pa.array(bits)],
                names=[*(x.split()[0] for x in COUNTS.split(", ")), "bits"],
            )

    # a text goes to Python and nothing else does: the other columns wait beside it
    rows = docs.select(*(x for x in docs.columns if x != "text"), score("lang", "text").alias("__score"))
    rows = rows.select("doc_id", "key", "lang", "__score.*", *(x for x in rows.columns[:-1] if x not in KEYED))
    if shared is None:
        rows = rows.drop("bits").join(joined_bits(docs, model, alphabet), "key")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def joined_bits(docs: DataFrame, model: DataFrame, alphabet: Alphabet) -> DataFrame:
    """``key`` and ``bits`` by a shuffle, for a model too large to copy: a join for each order, in which the
    n-grams not found go on as shorter ones with the weight of their context."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, lang, text in zip(*(column.to_pylist() for column in batch.columns)):
                gram, n = np.unique(grams(text or "", alphabet), return_counts=True)
                yield pa.record_batch(
                    [pa.array([key] * len(gram), pa.int64()), pa.array([lang] * len(gram), pa.string()),
                     pa.array(gram.view(np.int64)), pa.array(n)], names=["key", "lang", "gram", "n"],
                )

    once = docs.select("key", "lang", "text").dropDuplicates(["key"])
    counts = once.mapInArrow(own, "key long, lang string, gram long, n long")
    left, parts = counts.withColumn("carried", F.lit(0.0)), None
    for size in range(alphabet.order, 0, -1):
        top = model.where(F.col("size") == size).select("lang", "gram", "logp")
        found = written(left.join(top, ["lang", "gram"], "left"))
        hit = found.where("logp is not null").select("key", "n", (F.col("logp") + F.col("carried")).alias("log"))
        parts = hit if parts is None else parts.union(hit)
        weights = model.where(F.col("size") == size - 1).select("lang", F.col("gram").alias("context"), "backoff")
        left = found.where("logp is null").withColumn("context", F.shiftrightunsigned("gram", alphabet.bits)).join(
            weights, ["lang", "context"], "left"
        ).select("key", "lang", F.col("gram").bitwiseAND(F.lit((1 << alphabet.bits * (size - 1)) - 1)).alias("gram"), "n",
                 (F.col("carried") + F.coalesce("backoff", F.lit(0.0))).alias("carried"))
    parts = parts.union(left.select("key", "n", F.col("carried") - alphabet.bits))
    return parts.groupBy("key").agg((-F.sum(F.col("n") * F.col("log")) / F.sum("n")).alias("bits"))


def judged(scores: DataFrame, fence: float = FENCE) -> DataFrame:
    """``scores`` with ``middle`` and ``spread`` (median and interquartile range of the documents compared
    with) and ``kept``: neither failed by the base rules nor outside the fences.

    What is broadcast is a row for each language and power of two of the number of words.
    """
    marked = scores.withColumn("__length", F.floor(F.log2("n_words")))
    good = marked.where("not base_failed")
    quartiles = F.percentile_approx("bits", [0.25, 0.5, 0.75], 10_000)
    whole = good.groupBy("lang").agg(quartiles.alias("__whole"))
    alike = good.groupBy("lang", "__length").agg(quartiles.alias("__own"), F.count("*").alias("n"))
    alike = alike.where(F.col("n") >= ENOUGH).drop("n")
    joined = marked.join(F.broadcast(whole), "lang", "left").join(F.broadcast(alike), ["lang", "__length"], "left")
    q = F.coalesce("__own", "__whole")
    spread = F.greatest(q[2] - q[0], F.lit(LEAST_SPREAD))
    inside = F.col("bits").between(q[0] - fence * spread, q[2] + fence * spread)
    return joined.select(
        "lang", *(x for x in scores.columns if x != "lang"), q[1].alias("middle"),
        F.when(q.isNotNull(), spread).alias("spread"),
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
    )


def quality(docs: DataFrame, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """The verdict on every row of ``docs`` (``doc_id``, ``text``, ``lang``), with ``key``, a hash of the three.

    A null or empty text has no words and fails; a null language is a language of its own. Repeated rows
    each give a row; a null ``doc_id`` stays null; an empty table gives no rows.
    """
    return _verdict(docs, most_entries)


def _verdict(docs: DataFrame, most_entries: int, *extra: Column) -> DataFrame:
    """The verdict with ``extra`` columns of ``docs``. The tables of the model are removed when all is scored."""
    text, lang = F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    doc_id = F.col("doc_id").cast("long")
    plain = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text, lang).alias("key"),
                        lang.alias("lang"), text.alias("text"), *extra)
    with scratch_tables(docs.sparkSession):
        scores = written(scored(plain, most_entries), lasting=True)
    return judged(scores)


def keep_good(docs: DataFrame, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """The rows of ``docs`` that are kept, whole, in all their columns. They stand beside their scores, so that
    no text is shuffled to meet its verdict."""
    row = F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("__doc")
    return _verdict(docs, most_entries, row).where("kept").select("__doc.*")


__all__ = ["keep_good", "kneser_ney", "quality"]
