"""Best-fit packing: the search against exhaustive packing, and the pieces against the library."""

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bandloom.llm import best_fit, bin_completion, queries

JSON = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


def fewest(items, capacity):
    """Bins needed, by trying every way."""
    items = tuple(sorted(items, reverse=True))
    for k in range(len(items) + 1):
        seen = set()

        def fits(i, rooms):
            if i == len(items):
                return True
            if (i, rooms) in seen:
                return False
            seen.add((i, rooms))
            return any(
                fits(i + 1, tuple(sorted((*rooms[:j], room - items[i], *rooms[j + 1 :]))))
                for j, room in enumerate(rooms)
                if room >= items[i] and (j == 0 or rooms[j - 1] != room)
            )

        if fits(0, (capacity,) * k):
            return k


def held(plan, capacity):
    items = Counter()
    for filling, bins in plan:
        assert bins > 0 and sum(length * times for length, times in filling) <= capacity
        for length, times in filling:
            items[length] += times * bins
    return items


def test_bin_completion_is_optimal():
    rng, better = random.Random(5), 0
    for _ in range(600):
        capacity = rng.choice([10, 20, 30, 100])
        top = rng.choice([capacity, capacity * 2 // 3, capacity // 2])
        low = max(1, capacity // rng.choice([5, 8, 20]))
        counts = dict(Counter(rng.randint(low, max(low, top)) for _ in range(rng.randrange(13))))
        plan = bin_completion.pack_counts(counts, capacity, effort=10**6, ahead=10**9)
        assert held(plan, capacity) == Counter(counts)
        bins = sum(n for _, n in plan)
        assert bins == fewest(Counter(counts).elements(), capacity)
        better += bins < sum(n for _, n in bin_completion.best_fit(counts, capacity))
    assert better  # best fit alone is not optimal in all of them


def test_best_fit_of_equal_bins_is_best_fit_item_by_item():
    rng = random.Random(6)
    for _ in range(300):
        counts = {rng.randint(1, 60): rng.randint(1, 9) for _ in range(rng.randrange(9))}
        plan = bin_completion.best_fit(counts, 60)
        assert held(plan, 60) == Counter(counts)
        rooms = []
        for item in sorted(Counter(counts).elements(), reverse=True):
            fits = [room for room in rooms if room >= item]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 60) - item)
        assert sum(n for _, n in plan) == len(rooms)


def test_search_of_many_items_keeps_all_and_bounds_its_effort():
    rng = random.Random(7)
    counts = {length: rng.randrange(10**9) for length in range(700, 1400)}
    plan = bin_completion.pack_counts(counts, 2048, effort=500)
    assert held(plan, 2048) == Counter({k: n for k, n in counts.items() if n})
    with pytest.raises(ValueError):
        bin_completion.pack_counts({2049: 1}, 2048)


def check_pieces(got: pd.DataFrame, longest: int):
    """Each document from its first id to its last, each sequence from 0 without gaps; the number of sequences."""
    got = got.sort_values(["doc_id", "piece"])
    for _, doc in got.groupby("doc_id"):
        assert doc.piece.tolist() == list(range(len(doc)))
        assert doc.start.tolist() == np.concatenate([[0], np.cumsum(doc.length)[:-1]]).tolist()
        assert (doc.length[1:] == longest).all() and doc.length.iloc[0] <= longest
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert sequence.offset.tolist() == np.concatenate([[0], np.cumsum(sequence.length)[:-1]]).tolist()
        assert sequence.length.sum() <= longest
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    return got.sequence_id.nunique()


def test_query_packs_every_id_once(spark):
    got = queries.queries()["op11_bin_completion"](spark, SMALL).toPandas()
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
           for d, t in zip(docs.doc_id, docs.text)}
    assert set(got.doc_id) == set(ids)
    for row in got.itertuples():
        part = ids[row.doc_id][row.start : row.start + row.length]
        assert len(part) == row.length and zlib.crc32(part.tobytes()) == row.ids_crc32
    total = sum(map(len, ids.values()))
    assert got.length.sum() == total
    bins = check_pieces(got, 2048)
    assert bins == -(-total // 2048)  # no packing needs fewer


def test_pieces_of_odd_rows(spark):
    rows = [(i, "a b c " * (i % 50), 1) for i in range(200)] + [(200, None, 2), (201, "", 3), (202, "x y " * 9000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(7)
    got = best_fit.pack_best_fit(docs, JSON, end_id=0, longest=64).toPandas()
    assert got.columns.tolist()[-1] == "ids"
    check_pieces(got, 64)
    assert (got.ids.map(len) == got.length).all()
    assert got[got.doc_id.isin([200, 201])].length.tolist() == [1, 1]
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (None, None)], "doc_id long, text string")
    assert best_fit.pack_best_fit(nulls, JSON, with_ids=False).count() == 3
    assert best_fit.pack_best_fit(docs.limit(0), JSON).count() == 0
