"""Language identification of mixed text: script ranges, word scores, Viterbi.

A word (a run of letters, lower-cased) has a score for each language: the sum of log probabilities of
its n-grams of one to three characters and of the whole word, hashed into ``BUCKETS`` and counted over
the labelled documents by Spark. The script of its first letter narrows the languages to those that use
the script in ``LEAST_SHARE`` of their words. The Viterbi algorithm then labels the words of a document
so that the sum of scores, less ``SWITCH`` for each change of language, is greatest; the documents of a
batch advance through it side by side. Spans of equal labels are the languages of the text, and the
language with most letters is the document's.

The model has BUCKETS numbers for each language; its size follows from the number of languages, not from
the corpus, and it is copied to the executors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .line_dedup import mixed
from .shared import batches_of, ship

BUCKETS = 1 << 16
SMOOTHING = 0.5
SWITCH = 12.0  # in nats
LEAST_SHARE = 0.01
FAR = -1e4  # instead of the score of a language that does not use the script
LONGEST_WORD = 40
UNKNOWN = "und"
#: A letter with the letters and marks behind it: vowel signs belong to the word, numbers in circles do not.
WORD = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST_WORD - 1}}}")

#: First code points of blocks that hold one script, ascending.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Odia"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB13, "other"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFF21, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0xFFE0, "other"), (0x20000, "Han"), (0x32000, "other"),
]
STARTS = np.array([start for start, _ in SCRIPTS])
NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF = np.array([NAMES.index(name) for _, name in SCRIPTS])


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, the word of each, and the script of each word."""
    text = "".join(f"\x02{word}\x03" for word in words)
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    lengths = np.array([len(word) + 2 for word in words], dtype=np.int64)
    of = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)
    script = SCRIPT_OF[np.searchsorted(STARTS, points[ends - lengths + 1].astype(np.int64), "right") - 1]
    hashes, owner, h = [], [], np.zeros(len(points), np.uint64)
    for n in (1, 2, 3):
        h = mixed(h[: len(points) - n + 1] + points[n - 1 :] * np.uint64(2 * n + 1))
        inside = of[: len(h)] == of[n - 1 :]
        hashes.append(h[inside])
        owner.append(of[: len(h)][inside])
    whole = np.zeros(len(words), np.uint64)
    np.add.at(whole, of, mixed(points + (np.arange(len(points)) - (ends - lengths)[of]).astype(np.uint64) * np.uint64(1 << 32)))
    hashes.append(mixed(whole))
    owner.append(np.arange(len(words)))
    return (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owner), script


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task's documents; buckets from BUCKETS on count words by script."""
    total: dict[str, np.ndarray] = {}
    for batch in batches_of(batches, "text", 4 << 20):
        words: dict[str, Counter[str]] = {}
        for lang, text in zip(*(column.to_pylist() for column in batch.columns)):
            words.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
        for lang, own in words.items():
            if own:
                bucket, owner, script = features(list(own))
                n = np.fromiter(own.values(), dtype=np.float64)
                sums = total.setdefault(lang, np.zeros(BUCKETS + len(NAMES)))
                sums[:BUCKETS] += np.bincount(bucket, n[owner], BUCKETS)
                sums[BUCKETS:] += np.bincount(script, n, len(NAMES))
    for lang, sums in total.items():
        there = np.flatnonzero(sums)
        yield pa.record_batch(
            [pa.array([lang] * len(there), pa.string()), pa.array(there), pa.array(sums[there].astype(np.int64))],
            names=["lang", "bucket", "n"],
        )


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # BUCKETS x languages
    allowed: np.ndarray  # scripts x languages

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        for at in range(0, len(words), 20_000):
            bucket, owner, script = features(words[at : at + 20_000])
            for k in range(len(self.langs)):
                sums = np.bincount(owner, self.logp[bucket, k], len(script))
                out[at : at + 20_000, k] = np.where(self.allowed[script, k], sums, sums + FAR)
        return out


def learned(docs: DataFrame) -> Model:
    """A model of ``docs`` (``lang``, ``text``). Rows without a language or a letter teach nothing.

    What reaches the driver is one sum for each language and bucket.
    """
    ship(docs.sparkSession)
    rows = docs.where("lang is not null").select("lang", "text")
    counts = rows.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    ).toArrow()
    langs = sorted(set(counts["lang"].to_pylist()))
    n = np.zeros((BUCKETS + len(NAMES), len(langs)))
    place = np.array([langs.index(x) for x in counts["lang"].to_pylist()], dtype=np.int64)
    n[counts["bucket"].to_numpy(), place] = counts["n"].to_numpy()
    sums = n[:BUCKETS].sum(axis=0)
    logp = np.log((n[:BUCKETS] + SMOOTHING) / (sums + SMOOTHING * BUCKETS))
    share = n[BUCKETS:] / np.maximum(n[BUCKETS:].sum(axis=0), 1)
    allowed = share >= LEAST_SHARE
    allowed[~allowed.any(axis=1)] = True  # nobody's script: all languages are candidates
    return Model(langs, logp.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of every word. The words of sequence i follow those of sequence i - 1."""
    labels = np.zeros(len(scores), dtype=np.int16)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right").tolist()
    if not active:
        return labels
    came = np.zeros(scores.shape, dtype=np.int16)
    each = np.arange(scores.shape[1], dtype=np.int16)[None, :]
    best = scores[starts[: active[0]]].astype(np.float64)
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        before = best[: active[t]]
        top = before.argmax(axis=1)
        moved = (before[np.arange(len(top)), top] - switch)[:, None]
        stay = before >= moved
        came[at] = np.where(stay, each, top[:, None])
        best[: active[t]] = np.where(stay, before, moved) + scores[at]
    now = best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        at = starts[: active[t]] + t
        labels[at] = now[: active[t]]
        now[: active[t]] = came[at, now[: active[t]]]
    return labels


def identify(docs: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (the share of letters in spans of that language) and, on
    request, ``spans`` (start, end, lang; code points of the text, end exclusive).

    A text that is null or has no letter is ``und`` with score 0 and no spans; so is every text if the
    model knows no language. Ties go to the language first in the alphabet. Repeated rows each give a
    row; a null ``doc_id`` stays null; other columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches_of(batches, "text", 4 << 20):
            yield labelled(batch, model, with_spans)

    schema = "doc_id long, lang_pred string, score double"
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(rows, schema + ", spans array<struct<start:int,end:int,lang:string>>" * with_spans)


def labelled(batch: pa.RecordBatch, model: Model, with_spans: bool) -> pa.RecordBatch:
    texts = [text or "" for text in batch.column(1).to_pylist()]
    known: dict[str, int] = {}
    numbers, lengths, places = [], [], []
    for text in texts:
        if with_spans:
            found = [(m.start(), m.end(), m[0].lower()) for m in WORD.finditer(text)]
            places.append([(a, b) for a, b, _ in found])
            words = [word for _, _, word in found]
        else:
            words = WORD.findall(text.lower())
        numbers.extend([known.setdefault(word, len(known)) for word in words])
        lengths.append(len(words))
    n, many = np.array(lengths, dtype=np.int64), len(model.langs)
    number = np.array(numbers, dtype=np.int64)
    if not many or not len(number):
        label, letters = np.zeros(len(number), np.int16), np.zeros((len(texts), max(many, 1)))
    else:
        label = viterbi(model.scores(list(known))[number], n)
        size = np.array([len(word) for word in known], dtype=np.float64)[number]
        of = np.repeat(np.arange(len(texts)), n)
        letters = np.bincount(of * many + label, size, len(texts) * many).reshape(-1, many)
    top, total = letters.argmax(axis=1), letters.sum(axis=1)
    langs = [model.langs[k] if all_ else UNKNOWN for k, all_ in zip(top.tolist(), total.tolist())]
    score = np.where(total > 0, letters.max(axis=1) / np.maximum(total, 1), 0.0)
    columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(score)]
    names = ["doc_id", "lang_pred", "score"]
    if with_spans:
        label_of, at, spans = label.tolist(), 0, []
        for own in places:
            runs: list[dict] = []
            for (start, end), k in zip(own, label_of[at : at + len(own)]):
                if many and runs and runs[-1]["lang"] == model.langs[k]:
                    runs[-1]["end"] = end
                elif many:
                    runs.append({"start": start, "end": end, "lang": model.langs[k]})
            spans.append(runs)
            at += len(own)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        columns, names = [*columns, pa.array(spans, kind)], [*names, "spans"]
    return pa.record_batch(columns, names=names)
