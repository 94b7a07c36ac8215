"""Phrase and hard-negative mining against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandloom.llm import collocations, hard_negatives, queries

SMALL = "/root/testdata/sf0.001"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def phrases_of(rows, least, longest=5, share=100, first=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inside = (lang, words[i : i + size])
                if 100 * a >= share * f[inside]:
                    dropped.add(inside)
    out = []
    for (lang, words), a in found.items():
        if (lang, words) not in dropped:
            cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    rank, ranked = Counter(), []
    for lang, score, a, phrase, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= first:
            ranked.append((lang, rank[lang], phrase.decode(), -a, left, right, total, -score))
    return ranked


def mined(df):
    return sorted(tuple(row) for row in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_phrases_equal_brute_force(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    want = phrases_of(zip(docs.text, docs.lang), 100)
    got = mined(queries.queries()["op12_setm_phrases"](spark, SMALL))
    assert got == sorted(want) and got


@pytest.mark.parametrize("share, first, longest", [(100, 2000, 5), (70, 9, 5), (40, 2000, 3)])
def test_phrases_of_odd_texts(spark, share, first, longest):
    rng = random.Random(8)
    rows = []
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "b", "É", "é", "ab", " ", " ", "\t", ",", "\n", "\x0b", " ", "日"]) + " " * rng.randrange(2)
                       for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "", None])))
    rows += [(None, "en"), ("", "en"), ("x" * 70_000 + " y", "en"), ("a a a a a a a " * 2000, "fr")]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "text string, lang string, word int")
    got = mined(collocations.mine_phrases(docs, 5, longest, share, first))
    assert got == sorted(phrases_of(rows, 5, longest, share, first)) and got
    assert collocations.mine_phrases(docs.limit(0)).count() == 0
    assert collocations.mine_phrases(docs.where("text = ''")).count() == 0


def test_scores_pass_64_bits(spark):
    f, n, left, right = 3_999_999_999_993, 36_000_000_000_003, 4_000_000_000_011, 4_000_000_000_005
    row = spark.sql(f"SELECT {f}L AS f, {n}L AS n, {left}L AS l, {right}L AS r")
    assert row.selectExpr(f"{collocations.SCORE} AS s").first().s == 1000 * f * n // (left * right)


def test_a_full_field_of_marks_loses_nothing(spark, monkeypatch):
    """Where every bit is set, all entries stay and the counts decide alone."""
    rng = random.Random(10)
    rows = [(" ".join(rng.choice("abcdefgh") for _ in range(40)), "en") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    full = collocations.Marks(16, np.arange(2048), np.full(2048, 0xFFFFFFFF, "<u4"))
    monkeypatch.setattr(collocations, "marks_of", lambda frequent: full)
    got = mined(collocations.mine_phrases(docs, 20))
    assert got == sorted(phrases_of(rows, 20)) and got


def negatives_of(rows):
    """rows: (id or None, label, list or None, anchor); the definition, word for word."""
    whole = [
        (i, label, [math.floor(256 * x) for x in v], anchor)
        for i, label, v, anchor in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda hit: (-hit[0], math.inf if hit[1] is None else hit[1])
    score = lambda v, w: sum(a * b for a, b in zip(v, w))
    out = []
    for i, label, v, anchor in whole:
        if anchor:
            scored = [(score(v, w), j, other) for j, other, w, _ in whole]
            for s, j, _ in sorted((x for x in scored if x[2] == label and x[1] != i), key=key)[:5]:
                fit = [x for x in scored if x[2] != label and 50 * s <= 100 * x[0] <= 95 * s]
                for rank, (t, k, _) in enumerate(sorted(fit, key=key)[:3], 1):
                    out.append((i, j, rank, k, s, t))
    return out


def tuples(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(row) for row in df.select(*names).collect())


def test_negatives_equal_brute_force(spark):
    table = pd.read_parquet(f"{SMALL}/embeddings.parquet")
    rows = [(i, None if pd.isna(label) else int(label + 1) % 10 if i % 7 == 0 else int(label), v, i % 50 == 0)
            for i, label, v in zip(table.vec_id, table.label, table.embedding)]
    got = tuples(queries.queries()["op13_lemp_negatives"](spark, SMALL))
    assert got == Counter(negatives_of(rows)) and got


def test_negatives_of_odd_rows(spark):
    rng = random.Random(9)
    rows = []
    for i in range(500):
        v = [rng.choice([0.0, 0.5, -0.25, rng.gauss(0, 1) * 10 ** rng.randrange(-2, 3)]) for _ in range(rng.choice([3, 4, 4, 4, 0]))]
        rows.append((i % 400 - 3, rng.randrange(3), v, i % 50 == 0))
    rows += [(None, 1, [1.0, 2.0, 3.0, 4.0], True), (None, 1, [1.0, 2.0, 3.0, 4.0], False), (900, None, [1.0], True),
             (901, 1, None, True), (902, 1, [1.0, None], True), (903, 1, [math.nan], True), (904, 1, [math.inf], False)]
    rows += [(1000 + i, i % 2, [1.0, 1.0, 1.0, i % 3 / 4], i % 7 == 0) for i in range(60)]
    vectors = spark.createDataFrame([(*row, "x") for row in rows],
                                    "vec_id long, label int, embedding array<double>, anchor boolean, score string")
    got = tuples(hard_negatives.mine_hard_negatives(vectors, F.col("anchor")))
    assert got == Counter(negatives_of(rows)) and got
    assert hard_negatives.mine_hard_negatives(vectors.limit(0), F.col("anchor")).count() == 0
    assert hard_negatives.mine_hard_negatives(vectors, F.lit(False)).count() == 0


def test_scores_beyond_53_bits_are_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**40, 1.0], [2.0**39, 1.0]])
    assert hard_negatives.products(a, b).tolist() == [[2**80 + 3, 2**79 + 3]]


def test_coordinate_ranges_lose_no_vector():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(800, 3)) * rng.choice([1, 5], size=(800, 1))
    bucket = hard_negatives.Bucket(np.zeros(800, int), np.arange(800), vectors)
    listed = 0
    for query in rng.normal(size=(60, 3)):
        query /= np.linalg.norm(query)
        for cosine in (0.3, 0.8, 0.97, 0.999):
            rows = bucket.candidates(query, cosine)
            true = np.flatnonzero(bucket.unit @ query >= cosine)
            if rows is not None:
                listed += 1
                assert set(true) <= set(rows.tolist()) and len(rows) < 200
    assert listed > 60


def test_rows_of_a_relation_are_small_and_cut_at_gaps_only():
    rng = np.random.default_rng(4)
    place = np.cumsum(np.where(rng.random(1_000_000) < 0.05, 2, 1))
    keys = place.astype(np.uint64), place.astype(np.uint64) * np.uint64(3)
    rows = [(at, own) for batch in collocations._relation(place, keys) for at, own in collocations._entries([batch])]
    assert max(len(at) for at, _ in rows) < 150_000
    for i, whole in enumerate(collocations.merged(place, keys)[1]):
        assert np.array_equal(np.concatenate([collocations.merged(*row)[1][i] for row in rows]), whole)
    assert not list(collocations._relation(place[:0], (keys[0][:0], keys[1][:0])))


def test_counts_of_phrases_travel_in_packets(monkeypatch):
    """A task sends a row for each bucket, not for each phrase, and the sums are exact; equal first halves are no hindrance."""
    monkeypatch.setattr(collocations, "COUNTED", 50)
    rng = np.random.default_rng(1)
    many = rng.integers(0, 2**63, 100_000).astype(np.uint64)
    made = collocations.packets(*collocations.counted((many, many)))
    assert made.num_rows <= collocations.BUCKETS
    assert collocations.packets(*collocations.counted((many[:0], many[:0]))).num_rows == 0
    want, rows = Counter(), []
    for _ in range(40):
        keys = rng.integers(0, 6, 30).astype(np.uint64) * np.uint64(2**61), rng.integers(0, 3, 30).astype(np.uint64)
        want.update(zip(*(x.tolist() for x in keys)))
        rows += zip(*(x.to_pylist() for x in collocations.packets(*collocations.counted(keys)).columns))
    rows.sort(key=lambda x: x[0])
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), made.schema.types)]
    whole = pa.record_batch(columns, names=made.schema.names)
    sums = collocations.sums((whole.slice(i, 7) for i in range(0, len(rows), 7)), 66)
    got = [(np.uint64(a % 2**64), b, n) for one in sums for a, b, n in zip(*(x.to_pylist() for x in one.columns))]
    assert sorted(got) == sorted((*key, n) for key, n in want.items() if n >= 66)
