"""All counting metrics of a population from one scan of it.

A row becomes one entry per *measure*: a number that is cut into bands, a label, or a mark. Entries carry
the measure's position and are counted per population, measure, band, label and mark, in the scanning task
first, so the one shuffle of the scan carries a few rows per task and band however large the population is.
All metrics are worked out from these counts.

Edges are data: a small table of the measures, joined to the entries, holds them as arrays of one length, and
a few steps of halving find a number's place. The generated code depends on the logarithm of the most edges
that a measure has, not on edges, measures or metrics.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.bands import INVALID_SCORE_LABELS, inner_edges, score_cuts, validity_of
from ..functions.bands import feature_band_count, feature_edges
from ..functions.columns import Fill, equals_fill, require_columns
from ..functions.segments import SEGMENTS, TEXT_SEGMENTS, Rule, label_of, segment_value
from ..functions.sql import double, number, quoted, text
from .long_form import to_long
from .rows import POPULATION

# Status codes behind the trend names, compared with case.
STATUSES = {
    "fa": "FINAL_APPROVED",
    "ca": "COND_APPROVED",
    "d1": "DENIED_1",
    "d2": "DENIED_2",
}
RATIOS = {"ca/fa": ("ca", "fa"), "d1/fa": ("d1", "fa")}
SCORE_VALUES = ["score", "total_population", *STATUSES, *RATIOS]
SCORE, VALIDITY = "score", "validity"
NO_FILL = object()


@dataclass(frozen=True)
class Measure:
    """What a row is counted by, as SQL: ``value`` is read first, once; it is cut by the edges if ``banded``, after
    its fill has taken the place of null and NaN; ``label`` is made from it, there named ``{v}``."""

    value: str = "NULL"
    banded: bool = False
    edges: Sequence[float] = ()
    closed: str = "right"
    include_last: bool = False
    fill: object = NO_FILL
    label: str = "NULL"
    keeps_label: bool = False  # the label is a result; other labels are counted apart and then summed
    mark: str = "NULL"


@dataclass(frozen=True)
class Output:
    """One line of results: a metric's value, made from a measure as ``kind`` says, per band or ``once``."""

    measure: str
    kind: str
    metric: str
    value: str
    n_bands: int | None = None
    edges: Sequence[float] | None = None
    number: int | None = None
    label: str | None = None


def values_table(spark: SparkSession, columns: str, rows: Sequence[Sequence[str]]) -> DataFrame:
    """A small table of SQL literals, which is part of the plan; its size is that of the request."""
    lines = ", ".join(f"({', '.join(row)})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({columns})").hint("broadcast")


def doubles(values: Sequence[float] | None) -> str:
    if values is None:
        return "CAST(NULL AS ARRAY<DOUBLE>)"
    return f"CAST(array({', '.join(map(double, values))}) AS ARRAY<DOUBLE>)"


def literal(value: int | str | None) -> str:
    if value is None:
        return "NULL"
    return text(value) if isinstance(value, str) else str(value)


def tagged_counts(df: DataFrame, measures: Mapping[str, Measure]) -> DataFrame:
    """``n`` rows per population, measure (its position ``m``), ``band_no``, ``label`` and ``mark``.

    Measures are sorted so that those with labels come first: the arrays of labels and marks are then short.
    """
    ordered = list(measures.values())
    last_label = max((i for i, x in enumerate(ordered) if x.label != "NULL"), default=-1)
    # Values first, labels second: a value is read (a text parsed) once, not once per comparison.
    read = df.selectExpr(*POPULATION, *[f"{x.value} AS v{m}" for m, x in enumerate(ordered) if x.value != "NULL"],
                         *[f"{x.mark} AS mark{m}" for m, x in enumerate(ordered) if x.mark != "NULL"],
                         *["status"] * any("status" in x.label for x in ordered))
    entries = {
        "x": [f"v{m}" if x.banded else "CAST(NULL AS DOUBLE)" for m, x in enumerate(ordered)],
        "label": [
            f"CAST({x.label.replace('{v}', f'v{m}')} AS STRING)" for m, x in enumerate(ordered[: last_label + 1])
        ] or ["CAST(NULL AS STRING)"],
        "mark": [f"mark{m}" if x.mark != "NULL" else "CAST(NULL AS BOOLEAN)" for m, x in enumerate(ordered)],
    }
    arrays = read.selectExpr(*POPULATION, *[f"array({', '.join(made)}) AS {name}" for name, made in entries.items()])
    stream = arrays.selectExpr(*POPULATION, f"posexplode(arrays_zip({', '.join(entries)})) AS (m, entry)")
    stream = stream.selectExpr(*POPULATION, "m", *[f"entry.{name} AS {name}" for name in entries])

    steps = max(1, math.ceil(math.log2(max(len(x.edges) for x in ordered) + 1)))
    full = 2**steps - 1
    rows = [
        [
            str(m), doubles([*x.edges, *[math.inf] * (full - len(x.edges))]), str(len(x.edges)),
            str(x.closed == "left").lower(), str(x.include_last).lower(), str(x.fill is not NO_FILL).lower(),
            _fill_number(x.fill), str(x.keeps_label).lower(),
        ]
        for m, x in enumerate(ordered)
    ]
    names = "m, edges, n_edges, from_left, with_last, has_fill, fill, keeps_label"
    found = stream.join(values_table(df.sparkSession, names, rows), "m")
    found = found.withColumn("x", F.expr("IF(has_fill AND (x IS NULL OR isnan(x)), fill, x)"))
    found = found.withColumn("at", F.lit(0))
    for step in range(steps - 1, -1, -1):
        edge = f"get(edges, at + {2**step - 1})"
        found = found.withColumn("at", F.expr(f"at + IF({edge} < x OR (from_left AND {edge} = x), {2**step}, 0)"))
    band = (
        "CASE WHEN x IS NULL THEN NULL WHEN NOT from_left THEN least(at, n_edges) + 1 "
        "WHEN at = 0 THEN NULL WHEN at < n_edges THEN at "
        "WHEN with_last AND x = get(edges, n_edges - 1) THEN n_edges - 1 END"
    )
    return (
        found.selectExpr(*POPULATION, "m", "keeps_label", f"{band} AS band_no", "label", "mark")
        .groupBy(*POPULATION, "m", "keeps_label", "band_no", "label", "mark")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _fill_number(fill: object) -> str:
    if fill is NO_FILL or fill is None:
        return "CAST(NULL AS DOUBLE)"
    return f"try_cast({text(fill)} AS DOUBLE)" if isinstance(fill, str) else double(fill)


def _same(left: DataFrame, names: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in names])


def long_metrics(counts: DataFrame, measures: Mapping[str, Measure], outputs: Sequence[Output]) -> DataFrame:
    """The long form of all outputs, from the counts of their measures.

    Bands of a measure meet in a window; labels of a measure, which may be free text in any number, do not: each
    is a window of its own, and the totals of a measure are an aggregate that is joined back.
    """
    position = {name: m for m, name in enumerate(measures)}
    summed = [
        F.expr("sum(n) AS n"),
        F.expr("sum(IF(mark, n, 0)) AS marked"),
        *[F.expr(f"sum(IF(label = {text(code)}, n, 0)) AS {name}") for name, code in STATUSES.items()],
        *[F.expr(f"sum(IF(label = {text(name)}, n, 0)) AS v{i}") for i, name in enumerate(INVALID_SCORE_LABELS, 1)],
    ]
    kept_label = F.expr("IF(keeps_label, label, NULL)").alias("label")
    facts = counts.groupBy(*POPULATION, "m", "band_no", kept_label).agg(*summed)
    totals = counts.groupBy(*POPULATION, "m").agg(*summed)
    group = [*POPULATION, "m"]
    totals = totals.select(*[F.col(x).alias(f"of_{x}" if x in group else f"all_{x}") for x in totals.columns])
    own = f"OVER (PARTITION BY {', '.join(group)}, label)"
    ratios = {kind: f"CASE WHEN {base} = 0 THEN 0D ELSE {top} / {base} END" for kind, (top, base) in RATIOS.items()}
    wide = facts.join(totals, _same(facts, group)).selectExpr(
        *facts.columns, *[x for x in totals.columns if x.startswith("all_")],
        "round(n / all_n * 100, 4) AS pct", *[f"{ratio} AS `{kind}`" for kind, ratio in ratios.items()],
        f"row_number() {own[:-1]} ORDER BY band_no) AS nth",
    )
    wide = wide.selectExpr(
        "*", f"sum(pct) {own} AS all_pct", *[f"sum(`{kind}`) {own} AS `all_{kind}`" for kind in ratios]
    )
    kinds = {  # count, value and total of each
        "score": ("marked", "round(try_divide(marked, all_marked) * 100, 3)", "all_marked"),
        "total_population": ("marked", "marked", "all_marked"),
        **{name: (name, name, f"all_{name}") for name in STATUSES},
        **{kind: ("NULL", f"`{kind}`", f"`all_{kind}`") for kind in RATIOS},
        "share": ("n", "pct", "all_pct"),
        "rows": ("n", "n", "all_n"),
        "marks": ("all_marked", "all_marked", "all_n"),
        **{f"v{i}": (f"all_v{i}", f"all_v{i}", "all_n") for i in range(1, len(INVALID_SCORE_LABELS) + 1)},
    }
    asked = sorted({output.kind for output in outputs})
    once = [kind for kind in asked if kind == "marks" or kind[0] == "v"]
    by_kind = lambda i, cast: (
        f"CASE kind {' '.join(f'WHEN {text(kind)} THEN CAST({kinds[kind][i]} AS {cast})' for kind in asked)} END"
    )
    rows = [
        [
            str(position[x.measure]), text(x.kind), str(x.kind in once).lower(), text(x.metric), text(x.value),
            f"CAST({literal(x.n_bands)} AS INT)", doubles(x.edges), f"CAST({literal(x.number)} AS INT)",
            f"CAST({literal(x.label)} AS STRING)",
        ]
        for x in outputs
    ]
    names = "m, kind, once, metric_name, value_name, n_bands, edges, number, given_label"
    asked_for = values_table(counts.sparkSession, names, rows)
    long = wide.join(asked_for, "m").where("NOT once OR nth = 1").selectExpr(
        *POPULATION, "metric_name", "value_name", "IF(once, number, band_no) AS band_no",
        "coalesce(IF(once, given_label, label), CAST(IF(once, NULL, band_no) AS STRING)) AS band_label",
        f"{by_kind(0, 'BIGINT')} AS cnt", f"{by_kind(1, 'DOUBLE')} AS metric_value",
        f"{by_kind(2, 'DOUBLE')} AS total", "n_bands", "edges",
    )
    return to_long(long)


class Counting:
    """Collects what is to be counted, and counts it in one pass."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.measures: dict[str, Measure] = {}
        self.outputs: list[Output] = []

    def by_score(
        self, cuts: Sequence[float], wanted: Mapping[str, Sequence[str]], score: str, id_column: str,
        include_last: bool,
    ) -> Counting:
        names = {value.lower() for values in wanted.values() for value in values}
        unknown = sorted(names - set(SCORE_VALUES))
        if unknown:
            raise ValueError(f"unknown score values {unknown}; known: {SCORE_VALUES}")
        with_status = bool(names - {"score", "total_population"})
        require_columns(self.df, [*POPULATION, score, id_column, *["status"] * with_status])
        codes = ", ".join(text(code) for code in STATUSES.values())
        status = f"CASE WHEN status IN ({codes}) THEN status END" if with_status else "NULL"
        edges = score_cuts(cuts)
        self.measures[SCORE] = Measure(
            number(score), True, edges, "left", include_last, label=status, mark=f"{quoted(id_column)} IS NOT NULL"
        )
        self.outputs += [
            Output(SCORE, value.lower(), metric, value, len(edges) - 1, edges)
            for metric, values in wanted.items()
            for value in values
        ]
        return self

    def by_validity(self, score: str) -> Counting:
        require_columns(self.df, [*POPULATION, score])
        self.measures[VALIDITY] = Measure(number(score), label=validity_of("{v}"))
        self.outputs += [
            Output(VALIDITY, f"v{i}", "INVALID_SCORE", "total_population", number=i, label=label)
            for i, label in enumerate(INVALID_SCORE_LABELS, 1)
        ]
        return self

    def by_segment(
        self, names: Sequence[str], segments: Mapping[str, Sequence[Rule]],
        text_segments: Mapping[str, Sequence[str]],
    ) -> Counting:
        require_columns(self.df, [*POPULATION, *names])
        for name in names:
            label = label_of(name, "{v}", segments, text_segments)
            value = segment_value(name, text_segments)
            self.measures[f"segment {name}"] = Measure(value, label=label, keeps_label=True)
            self.outputs.append(Output(f"segment {name}", "rows", "SEGMENT_DISTRIBUTION", name))
        return self

    def by_feature(
        self, cut: Mapping[str, Sequence[str]], null_rates: Sequence[str],
        cuts: Mapping[str, Sequence[float | None] | None], fills: Mapping[str, Fill],
    ) -> Counting:
        """``cut`` has the features of CSI and of FEATURE_RANGE_DRIFT; both and the null rate share a measure."""
        kinds = {"CSI": "share", "FEATURE_RANGE_DRIFT": "rows"}
        banded = {name for names in cut.values() for name in names}
        names = list(dict.fromkeys([*(name for names in cut.values() for name in names), *null_rates]))
        require_columns(self.df, [*POPULATION, *names])
        for name in names:
            fill = fills.get(name)
            self.measures[f"feature {name}"] = Measure(
                number(name) if name in banded else "NULL",
                name in banded,
                inner_edges(cuts.get(name)) if name in banded else (),
                fill=NO_FILL if fill is None else fill,
                mark=f"{quoted(name)} IS NULL OR {equals_fill(self.df, name, fill)}" if name in null_rates else "NULL",
            )
        for metric, asked in cut.items():
            for name in asked:
                edges = feature_edges(cuts.get(name))
                bands = feature_band_count(cuts.get(name))
                self.outputs.append(Output(f"feature {name}", kinds[metric], metric, name, bands, edges))
        self.outputs += [Output(f"feature {name}", "marks", "NULL_RATE", name) for name in null_rates]
        return self

    def long(self) -> DataFrame:
        if not self.outputs:
            raise ValueError("at least one name is needed")
        labelled = {k: x for k, x in self.measures.items() if x.label != "NULL"}
        measures = labelled | {k: x for k, x in self.measures.items() if x.label == "NULL"}
        return long_metrics(tagged_counts(self.df, measures), measures, self.outputs)


def score_metrics(
    df: DataFrame,
    cuts: Sequence[float],
    wanted: Mapping[str, Sequence[str]],
    *,
    score: str = "output_value",
    id_column: str = "id",
    include_last: bool = False,
) -> DataFrame:
    """All metrics that count by score band.

    ``wanted`` maps a metric name to value names: ``score`` (share in percent), ``total_population``
    (counts), ``fa ca d1 d2`` (counts by status) and ``ca/fa d1/fa`` (ratios, 0 where there is no
    ``fa``; their total is the sum of the ratios).
    """
    return Counting(df).by_score(cuts, wanted, score, id_column, include_last).long()


def invalid_scores(df: DataFrame, score: str = "output_value") -> DataFrame:
    """Rows by score validity; every label appears, also with count 0."""
    return Counting(df).by_validity(score).long()


def segment_counts(
    df: DataFrame,
    names: Sequence[str],
    *,
    segments: Mapping[str, Sequence[Rule]] = SEGMENTS,
    text_segments: Mapping[str, Sequence[str]] = TEXT_SEGMENTS,
) -> DataFrame:
    """Rows per label of every named segment."""
    return Counting(df).by_segment(names, segments, text_segments).long()


def feature_shares(
    df: DataFrame,
    wanted: Mapping[str, Sequence[str]],
    cuts: Mapping[str, Sequence[float | None] | None],
    fills: Mapping[str, Fill] | None = None,
) -> DataFrame:
    """CSI (share in percent) and FEATURE_RANGE_DRIFT (count) by feature band.

    ``wanted`` maps each of the two metric names to the features it is asked for.
    """
    return Counting(df).by_feature(wanted, [], cuts, fills or {}).long()


def null_rates(df: DataFrame, features: Sequence[str], fills: Mapping[str, Fill]) -> DataFrame:
    """Values that are null or equal to the feature's fill."""
    return Counting(df).by_feature({}, features, {}, {name: fills[name] for name in features}).long()
