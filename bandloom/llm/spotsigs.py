"""SpotSigs fingerprints: chains of content words behind common words.

A spot is a common word (an anchor) with the ``CHAIN`` content words that follow it; a text's signature
is the set of its spots, as 64-bit hashes. Boilerplate such as menus has few common words and so few
spots. A text without an anchor has the chain at each of its words, a text without a word one spot for
the whole text, so equal texts always have equal signatures and no text has none.

Two signatures are compared by their Jaccard similarity. Near pairs of a corpus are found by length classes,
since the lengths bound the similarity, and the rarest spots.

All of it is DataFrame functions. The words of a text never leave its row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written

CHAIN = 2
NEAR = 0.8
NO_WORD = r"[^\p{L}\p{N}]+"
#: Frequent words of English, French, German and Spanish, lower case.
ANCHORS = (
    "a an and are as at be by for from has have he in is it its not of on or that the this to was were which "
    "will with you au aux avec ce dans de des du elle en est et il la le les leur ne pas par pour que qui se "
    "sur un une das dem den der die ein eine für im ist mit nicht sich sie und von zu al como con del el es "
    "esta los las lo más no para por su y"
).split()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas inside ask for it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def signature(text: Column) -> Column:
    """The sorted hashes of the text's spots, without repeats."""
    words = F.filter(F.split(F.lower(text), NO_WORD), lambda w: w != "")
    return let(F.struct(text.alias("text"), words.alias("words")), _parted)


def _parted(x: Column) -> Column:
    common = lambda w: w.isin(ANCHORS)
    places = F.filter(
        F.transform(x["words"], lambda w, i: F.when(common(w), i)), lambda i: i.isNotNull()
    )
    content = F.filter(x["words"], lambda w: ~common(w))
    parts = F.struct(x["text"].alias("text"), x["words"].alias("words"),
                     places.alias("places"), content.alias("content"))
    return let(parts, _spots)


def _spots(x: Column) -> Column:
    # before the k-th anchor, at place p, stand p - k content words
    at_anchors = F.transform(
        x["places"],
        lambda p, k: F.xxhash64(
            F.get(x["words"], p), *(F.get(x["content"], p - k + j) for j in range(CHAIN))
        ),
    )
    at_words = F.transform(
        x["words"],
        lambda w, i: F.xxhash64(F.lit(""), w, *(F.get(x["words"], i + j) for j in range(1, CHAIN + 1))),
    )
    spots = F.when(F.size(x["places"]) > 0, at_anchors).when(F.size(x["words"]) > 0, at_words)
    return F.array_sort(F.array_distinct(F.coalesce(spots, F.array(F.xxhash64(x["text"])))))


def jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return shared / (F.size(a) + F.size(b) - shared)


def near_pairs(docs: DataFrame, least: float = NEAR) -> tuple[DataFrame, DataFrame]:
    """All pairs of different signatures at a Jaccard similarity of ``least`` or more, and membership.

    Gives ``src``, ``dst`` and ``similarity`` (``src`` < ``dst``, ids of signatures), and ``doc_id`` with
    ``signature_id`` of every row; texts of equal signatures are one class and never meet as pairs.

    Signatures are partitioned by length, so that similar ones are in the same class of lengths or the
    next. Of each, its rarest spots are enough to find all partners: two similar signatures share one of
    the first ``size - ceil(least * size) + 1`` (prefix filter). A meeting is dropped if the spots behind
    it cannot add up to the similarity any more; the rest is checked on whole signatures. No meeting is
    capped. A null text is empty; null ids stay; an empty table gives two empty tables.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    signed = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), signature(text).alias("spots")))
    members = signed.select("doc_id", F.xxhash64("spots").alias("signature_id"))
    classes = written(
        signed.groupBy(F.xxhash64("spots").alias("id")).agg(F.first("spots").alias("spots"))
    )
    single = classes.select("id", F.size("spots").alias("size"), F.explode("spots").alias("spot"))
    often = single.groupBy("spot").agg(F.count("*").alias("n"))
    ranked = single.join(often, "spot").groupBy("id", "size").agg(
        F.array_sort(F.collect_list(F.struct("n", "spot"))).alias("ranked")
    )  # no longer than the signature
    needed = F.ceil(F.col("size") * least - 1e-9).cast("int")
    first = ranked.select("id", "size", F.posexplode(F.slice("ranked", F.lit(1), F.col("size") - needed + 1)))
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(1 / least) + 1e-9)
    index = written(first.select("id", "size", F.col("pos").alias("at"), F.col("col.spot").alias("spot"),
                                 band.alias("band")))
    probes = index.select(
        *(F.col(x).alias(f"{x}_2") for x in ("id", "size", "at")), "spot",
        F.explode(F.array("band", F.col("band") + 1)).alias("band"),
    )
    shortest = (F.col("size_2") < F.col("size")) | ((F.col("size_2") == F.col("size")) & (F.col("id_2") < F.col("id")))
    most = F.least(F.col("size") - F.col("at"), F.col("size_2") - F.col("at_2"))
    enough = (F.col("size_2") >= least * F.col("size") - 1e-9) & (
        most * (1 + least) >= least * (F.col("size") + F.col("size_2")) - 1e-9
    )
    meetings = index.join(probes, ["spot", "band"]).where(shortest & enough)
    pairs = written(
        meetings.select(F.least("id", "id_2").alias("src"), F.greatest("id", "id_2").alias("dst")).distinct()
    )
    left = classes.select(F.col("id").alias("src"), F.col("spots").alias("a"))
    right = classes.select(F.col("id").alias("dst"), F.col("spots").alias("b"))
    compared = pairs.join(left, "src").join(right, "dst").select(
        "src", "dst", jaccard(F.col("a"), F.col("b")).alias("similarity")
    )
    return compared.where(F.col("similarity") >= least), members


def shown(spots: Column) -> Column:
    return F.array_join(F.transform(spots, lambda x: F.lower(F.hex(x))), ",")


def ranges(docs: DataFrame, many: int) -> tuple[list[int], dict[int | None, int]]:
    """Ids at which to cut the documents into about ``many`` ranges, and the ids (null too) that hold more than one
    range's share of the rows, with their number of shares. ``many`` numbers come to the driver."""
    shares = [k / many for k in range(1, many)] or [0.5]
    found = docs.agg(
        F.percentile_approx("doc_id", shares, 10_000).alias("at"), F.count("*").alias("n"),
        F.count_if(F.col("doc_id").isNull()).alias("none"),
    ).first()
    times = Counter(found.at or [])
    hot: dict[int | None, int] = {i: n + 1 for i, n in times.items() if n > 1}
    if found.none * many > found.n:
        hot[None] = found.none * many // found.n + 1
    return sorted(times), hot


def in_ranges(docs: DataFrame) -> DataFrame:
    """The documents with ``part``, the number of their range, and ``at``, their place among equal ids.

    Ranges ascend with the id. An id that holds more than a range's share is dealt to several ranges of its own, in
    an order by hash of where its rows are read, so that repeated rows of one text are dealt as well."""
    cuts, hot = ranges(docs, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = max(1, math.ceil(math.log2(len(cuts) + 1)))
    edges = [*cuts, *[cuts[-1] if cuts else 0] * (2**steps - 1 - len(cuts))]
    bounds = f"array({', '.join(f'{x}L' for x in edges)})"
    read = docs.withColumn("at", F.monotonically_increasing_id()).withColumn("below", F.lit(0))
    for step in range(steps - 1, -1, -1):
        less = f"get({bounds}, below + {2**step - 1}) < doc_id"
        read = read.withColumn("below", F.expr(f"below + IF({less}, {2**step}, 0)"))
    salt = F.lit(0)
    for doc_id, n in hot.items():
        own = F.col("doc_id").isNull() if doc_id is None else F.col("doc_id") == doc_id
        salt = F.when(own, F.pmod(F.xxhash64("at"), F.lit(n))).otherwise(salt)
    own_range = F.expr(f"IF(get({bounds}, below) = doc_id, 1, 0)") if cuts else F.lit(0)
    slot = F.when(F.col("doc_id").isNull(), -1).otherwise(F.least("below", F.lit(len(cuts))) * 2 + own_range)
    return read.select(
        (slot.cast("long") * SALTS + salt).alias("part"), "doc_id", "at", "text"
    )


SALTS = 1 << 20
ORDER = ["doc_id", "at"]


def with_next(docs: DataFrame) -> DataFrame:
    """Every document with ``next_text``, the text of the one behind it; behind the last stands the first.

    Texts move once, to their range, and are shifted there. The end of a range gets the first text of the next one,
    a row for each range."""
    placed = in_ranges(docs)
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "at")  # null ids first
    firsts = written(placed.groupBy("part").agg(F.min_by("text", order).alias("text")))
    around = Window.orderBy("part")  # of a few rows, one for each range
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = firsts.select("part", F.coalesce(F.lead("text").over(around), F.first("text").over(whole)).alias("behind"))
    inside = Window.partitionBy("part").orderBy(*ORDER)
    shifted = placed.repartition("part").withColumn("inside", F.lead("text").over(inside))
    return shifted.join(behind, "part").select(
        "doc_id", "text", F.coalesce("inside", "behind").alias("next_text")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """For every row its fingerprint, that of the edited text, and their likeness, and that of the next.

    The edited text has the last half of the code points (rounded down) replaced by the first as many, or
    all, of the next document by ``doc_id``. A null text is empty; a text of any length is taken whole. Null ids come
    first. Rows of one id, repeated rows too, are documents that follow each other in an order fixed by the input
    (where they are read). Of a single document the next is itself. Other columns are left out; an empty table
    gives none.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = with_next(docs.select(doc_id.alias("doc_id"), text.alias("text")))
    kept = F.expr("left(text, length(text) - length(text) div 2)")
    put_in = F.expr("left(next_text, cast(length(text) div 2 as int))")
    edited = both.withColumn("edited", F.concat(kept, put_in))
    signed = edited.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), signature(F.col("text")).alias("spots"),
        signature(F.col("edited")).alias("edited_spots"), signature(F.col("next_text")).alias("next_spots"),
    )
    return signed.select(
        "doc_id", "n_chars", "edited_sha256",
        shown(F.col("spots")).alias("fingerprint"), shown(F.col("edited_spots")).alias("edited_fingerprint"),
        jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )
