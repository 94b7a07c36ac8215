"""Secrets in text: patterns, and a battery of randomness tests under false-discovery control.

Everything is DataFrame functions on the row: there is no shuffle but that of a small histogram. The time for a
row is in proportion to its length and its spans.

Three patterns give spans by themselves: an assignment to a name like ``token``, an access key, a long
run of hexadecimal digits. The battery looks at every other run of at least ``SHORTEST`` characters of
the base-64 alphabets that has a digit. Its encoding is inferred (base 16, 32, 62 or 64) and its symbols
are tested for

* uniformity over the alphabet (chi-squared),
* runs of the lower and the upper half of the alphabet (Wald-Wolfowitz),
* correlation of neighbours (lag one).

A run passes if none of the three, corrected for their number, rejects randomness at ``REJECT``. Words
can pass by chance, the more easily the shorter they are. Their null hypothesis is text, whose index of
coincidence is known: under it chi-squared is far larger, by an amount that grows with the length, and
the lower tail of that distribution is the run's p-value. Within each class of lengths the
Benjamini-Hochberg procedure over all runs of the corpus sets the p-value up to which a share of
``FALSE_SHARE`` at most of the found are words. The procedure works on a histogram of log p-values, a few
hundred numbers for each class; the threshold of each class is all that returns to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The base kinds, in the order in which they are listed, and their patterns.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"  # the same spans as with any length, then 16 characters or more
HEX = r"[0-9a-f]{32,}"
KINDS = ["assign", "access", "hex", "random"]
LEAST_VALUE = 8
SHORTEST = 20
MASK = "\x01"  # stands for the characters of base spans while runs are looked for
RUN = rf"(?<![A-Za-z0-9+/_=\x01-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{{{SHORTEST},}}+(?!\x01)"
CHUNK = 256
ENCODINGS = [  # pattern, alphabet size, alphabet, index of coincidence of text written in it
    (r"^[0-9a-f]+$", 16, "0123456789abcdef", 0.2),
    (r"^[0-9A-F]+$", 16, "0123456789ABCDEF", 0.2),
    (r"^[A-Z2-7]+=*$", 32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.067),
    (r"^[A-Za-z0-9]+=*$", 62, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 0.067),
    (r"", 64, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.067),
]
LENGTHS = [32, 48, 80]  # where classes of lengths begin, after the first
REJECT = 0.001
FALSE_SHARE = 0.01
STEPS, MOST_STEPS = 10, 400  # of the histogram: tenths of a power of ten


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas inside ask for it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scanned(items: Column, state: Column, out: str, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` collects over the items (one at least) in order.

    ``step`` gives a struct of ``state`` and ``out``, an array of type ``out``, to which it appends. To append
    copies an array, so items are taken in chunks, whose results are put together once: the time is in
    proportion to the items, up to millions of them."""
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")),
        lambda k: F.slice(items, k * CHUNK + 1, F.lit(CHUNK)),
    )
    none = F.array().cast(f"array<{out}>")

    def whole_chunk(acc: Column, chunk: Column) -> Column:
        inside = F.aggregate(chunk, F.struct(acc["state"].alias("state"), none.alias("out")), step)
        return let(
            inside,
            lambda x: F.struct(x["state"].alias("state"), F.array_append(acc["out"], x["out"]).alias("out")),
        )

    begin = F.struct(state.alias("state"), F.array().cast(f"array<array<{out}>>").alias("out"))
    return F.aggregate(chunks, begin, whole_chunk, lambda acc: F.flatten(acc["out"]))


def parts_of(text: Column, pattern: str, group: int = 0) -> Column:
    """The text in order as structs of a ``gap`` and the ``hit`` behind it with its group's ``value``; the last gap
    has no hit. Matches are leftmost and do not overlap."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), values.alias("value"))


SPAN = "struct<start:int,kind:int,end:int,value:string>"


def spans_of(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """(start, kind, end, value) of the leftmost matches that do not overlap, in code points."""

    def step(acc: Column, part: Column) -> Column:
        start = acc["state"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part["value"].alias("value"))
        return F.struct(
            end.alias("state"),
            F.when(part["hit"].isNull(), acc["out"]).otherwise(F.array_append(acc["out"], span)).alias("out"),
        )

    all_of = let(parts_of(text, pattern, group), lambda parts: scanned(parts, F.lit(0), SPAN, step))
    return F.when(text.rlike(pattern), all_of).otherwise(F.array().cast(f"array<{SPAN}>"))


def masked(text: Column, pattern: str, group: int = 0, least: int = 0) -> Column:
    """The text with every character of the matches whose group has ``least`` characters replaced by MASK."""
    put = lambda x: F.when(F.length(x["value"]) >= least, F.repeat(F.lit(MASK), F.length(x["hit"]))).otherwise(x["hit"])
    filled = F.transform(
        parts_of(text, pattern, group), lambda x: F.concat(x["gap"], F.coalesce(put(x), F.lit("")))
    )
    return F.when(text.rlike(pattern), F.array_join(filled, "")).otherwise(text)


def without_base(text: Column) -> Column:
    """The text with its base spans masked: no run touches a masked character."""
    return let(
        masked(text, ASSIGN, 2, LEAST_VALUE),
        lambda x: let(masked(x, ACCESS), lambda y: masked(y, HEX)),
    )


def with_base(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``__text`` (null: empty) and ``__base``, the spans of the three patterns by start, then kind."""
    found = docs.withColumn("__text", F.coalesce(text.cast("string"), F.lit("")))
    whole = F.col("__text")
    assign = F.filter(spans_of(whole, ASSIGN, 0, 2), lambda x: F.length(x["value"]) >= LEAST_VALUE)
    base = F.concat(assign, spans_of(whole, ACCESS, 1), spans_of(whole, HEX, 2))
    return found.withColumn("__base", F.array_sort(base))


def normal_below(z: Column) -> Column:
    """The normal distribution function, to two digits of its logarithm (logistic approximation)."""
    z = F.greatest(F.least(z, F.lit(12.0)), F.lit(-12.0))
    return 1 / (1 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def _each(array: str, fields: dict[str, object]) -> Column:
    """The structs of an array with more fields; each maps to a function of the struct without the others."""
    return F.transform(array, lambda x: _extended(x, fields))


def _extended(x: Column, fields: dict) -> Column:
    # made of x as it came: made of the one just extended, each field would repeat the expressions of those before it
    made = {name: make(x) for name, make in fields.items()}
    out = x
    for name, value in made.items():
        out = out.withField(name, value)
    return out


def with_candidates(found: DataFrame) -> DataFrame:
    """``__runs``: the runs outside base spans with ``p_random``, ``p_text`` and ``length_class``."""
    runs = let(without_base(F.col("__text")), lambda text: spans_of(text, RUN, 3))
    found = found.withColumn("__runs", runs)

    def by_encoding(pick) -> object:
        def made(x: Column) -> Column:
            out = F.lit(pick(ENCODINGS[-1]))
            for encoding in reversed(ENCODINGS[:-1]):
                out = F.when(x["value"].rlike(encoding[0]), F.lit(pick(encoding))).otherwise(out)
            return out

        return made

    steps: list[dict] = [
        {
            "size": by_encoding(lambda e: float(e[1])),
            "alphabet": by_encoding(lambda e: e[2]),
            "coincidence": by_encoding(lambda e: e[3]),
        },
    ]
    # symbols as numbers from 1; url-safe alphabets are read as the ordinary one
    number = lambda x: F.transform(
        F.filter(F.split(F.translate(F.regexp_replace(x["value"], "=+$", ""), "-_", "+/"), ""), lambda c: c != ""),
        lambda c: F.instr(x["alphabet"], c).cast("double"),
    )
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    neighbours = lambda x: F.zip_with(
        F.slice(x["x"], F.lit(1), F.size(x["x"]) - 1), F.slice(x["x"], F.lit(2), F.size(x["x"]) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    steps += [
        {"x": number},
        {
            "n": lambda x: F.size(x["x"]).cast("double"),
            "squares": lambda x: add(
                F.transform(
                    F.array_distinct(x["x"]),
                    lambda d: F.pow(F.size(F.filter(x["x"], lambda v: v == d)).cast("double"), F.lit(2.0)),
                )
            ),
            "mean": lambda x: add(x["x"]) / F.size(x["x"]),
            "high": lambda x: F.size(F.filter(x["x"], lambda v: v * 2 > x["size"])).cast("double"),
            "changes": lambda x: F.size(
                F.filter(neighbours(x), lambda p: (p["a"] * 2 > x["size"]) != (p["b"] * 2 > x["size"]))
            ).cast("double"),
        },
        {
            "spread": lambda x: add(F.transform(x["x"], lambda v: (v - x["mean"]) * (v - x["mean"]))),
            "lagged": lambda x: add(
                F.transform(neighbours(x), lambda p: (p["a"] - x["mean"]) * (p["b"] - x["mean"]))
            ),
            "chi": lambda x: x["squares"] * x["size"] / x["n"] - x["n"],
            "mu": lambda x: 2 * x["high"] * (x["n"] - x["high"]) / x["n"] + 1,
        },
        {
            "uniform": lambda x: 1 - normal_below(
                (F.cbrt(F.greatest(x["chi"], F.lit(0.0)) / (x["size"] - 1)) - 1 + 2 / (9 * (x["size"] - 1)))
                / F.sqrt(2 / (9 * (x["size"] - 1)))
            ),
            "runs_z": lambda x: F.when(
                x["mu"] > 2,
                F.abs(x["changes"] + 1 - x["mu"]) / F.sqrt((x["mu"] - 1) * (x["mu"] - 2) / (x["n"] - 1)),
            ).otherwise(F.lit(12.0)),
            "serial_z": lambda x: F.when(
                x["spread"] > 0, F.abs(x["lagged"] / x["spread"]) * F.sqrt(x["n"])
            ).otherwise(F.lit(12.0)),
            "excess": lambda x: x["n"] * (x["size"] * x["coincidence"] - 1),
        },
        {
            "p_random": lambda x: 3 * F.least(
                x["uniform"], 2 * (1 - normal_below(x["runs_z"])), 2 * (1 - normal_below(x["serial_z"]))
            ),
            "p_text": lambda x: normal_below(
                (x["chi"] - (x["size"] - 1 + x["excess"])) / F.sqrt(2 * (x["size"] - 1) + 4 * x["excess"])
            ),
            "length_class": lambda x: sum((x["n"] >= n).cast("int") for n in LENGTHS),
        },
    ]
    for fields in steps:
        found = found.withColumn("__runs", _each("__runs", fields))
    slim = F.transform(
        "__runs",
        lambda x: F.struct(*(x[k].alias(k) for k in ("start", "kind", "end", "p_random", "p_text", "length_class"))),
    )
    return found.withColumn("__runs", slim)


def thresholds(candidates: DataFrame) -> dict[int, float]:
    """For each class of lengths the largest p-value to report; classes without discoveries are absent."""
    runs = candidates.select(F.explode("__runs").alias("x")).select(
        "x.length_class",
        F.when(F.col("x.p_random") < REJECT, 0)
        .otherwise(F.least(F.floor(-STEPS * F.log10("x.p_text")), F.lit(MOST_STEPS)))
        .alias("step"),
    )
    counts = runs.groupBy("length_class", "step").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("length_class")
    upper = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    smaller = F.sum("n").over(by_class.orderBy(F.desc("step")))
    good = counts.select("length_class", upper.alias("p"), smaller.alias("k"), F.sum("n").over(by_class).alias("m"))
    best = good.where(F.col("p") <= FALSE_SHARE * F.col("k") / F.col("m")).groupBy("length_class").agg(F.max("p"))
    return {row[0]: row[1] for row in best.collect()}  # a row for each of four classes


def with_spans(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``__text``, ``__base`` and ``__spans`` (start, kind, end; all spans by start, then kind)."""
    found = with_candidates(with_base(docs, text))
    most = thresholds(found)
    limit = F.lit(-1.0)
    random = F.filter(
        "__runs",
        lambda x: (x["p_random"] >= REJECT) & (x["p_text"] <= _by_class(x["length_class"], most, limit)),
    )
    plain = lambda a: F.transform(
        a, lambda x: F.struct(*(x[k].alias(k) for k in ("start", "kind", "end")))
    )
    return found.withColumn("__spans", F.array_sort(F.concat(plain("__base"), plain(random)))).drop("__runs")


def _by_class(length_class: Column, most: dict[int, float], otherwise: Column) -> Column:
    for k, p in most.items():
        otherwise = F.when(length_class == k, F.lit(p * (1 + 1e-9))).otherwise(otherwise)
    return otherwise


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kind = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"], x["end"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base_sha256`` of the listed base spans and all ``spans``.

    A null or empty text has no spans; a text of any length is searched whole. Repeated rows each give a row; a null
    ``doc_id`` stays null; other columns are left out; an empty table gives no rows.
    """
    found = with_spans(docs.select("doc_id", "text"), F.col("text"))
    count = lambda k: F.size(F.filter("__base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("__spans")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents, in all their columns, with every span of ``text`` replaced by its kind in brackets;
    overlapping spans are one. Texts without spans, null too, stay as they are."""
    row = F.struct(*(F.col(f"`{x}`") for x in docs.columns))
    found = with_spans(docs.select(row.alias("__doc")), F.col("__doc.text"))
    # four bytes a character: a piece is cut out in time with its own length
    piece = lambda wide, begin, length: F.decode(F.substring(wide, begin * 4 + 1, length * 4), "UTF-32")

    def clean(wide: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            mark = F.concat(
                piece(wide, acc["state"], x["start"] - acc["state"]),
                F.lit("["), F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), F.lit("]"),
            )
            return F.struct(
                F.greatest(acc["state"], x["end"]).alias("state"),
                F.when(x["start"] < acc["state"], acc["out"]).otherwise(F.array_append(acc["out"], mark)).alias("out"),
            )

        last = F.array_max(F.transform("__spans", lambda x: x["end"]))
        rest = piece(wide, last, F.length("__text") - last)
        return F.concat(F.array_join(scanned(F.col("__spans"), F.lit(0), "string", step), ""), rest)

    text = F.when(F.size("__spans") > 0, let(F.encode("__text", "UTF-32"), clean)).otherwise(F.col("__doc.text"))
    return found.select(*((text if x == "text" else F.col(f"__doc.`{x}`")).alias(x) for x in docs.columns))
