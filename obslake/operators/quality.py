"""Quality control: which rows count, and which value of each parameter to keep.

A raw row has, for each parameter, a real-time value with its flag and an adjusted value
with its flag and error. Quality control keeps the best of the two.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake import vocab
from obslake.operators.filters import Predicate, condition
from obslake.operators.standardize import conform, domain_column, drop_outside, label_source

# Flags that describe the whole row, not a parameter.
_ROW_FLAGS = ("POSITION", "JULD")


def flagged_parameters(columns: Iterable[str]) -> list[str]:
    """Names of the parameters that have a raw or an adjusted flag, in column order."""
    found: dict[str, None] = {}
    for column in columns:
        for suffix in ("_ADJUSTED_QC", "_QC"):
            if column.endswith(suffix):
                found.setdefault(column.removesuffix(suffix))
                break
    return [name for name in found if name not in _ROW_FLAGS]


def mode_column(parameter: str, profile: str) -> str:
    """PHY rows have one data mode; BGC rows have one for each parameter."""
    return "DATA_MODE" if vocab.profile_type(profile) == "PHY" else f"{parameter}_DATA_MODE"


def row_gate_filters(columns: Iterable[str], profile: str) -> list[list[Predicate]]:
    """Filters, made from the column names, that pass rows with at least one clean flag."""
    columns = list(columns)
    bgc = vocab.profile_type(profile) == "BGC"
    groups: list[list[Predicate]] = []
    for name in flagged_parameters(columns):
        alternatives: list[tuple[str, Predicate]] = [
            (f"{name}_QC", (mode_column(name, profile), "==", vocab.REALTIME_MODE)),
            (f"{name}_ADJUSTED_QC", (mode_column(name, profile), "in", list(vocab.ADJUSTED_MODES))),
        ]
        for flag, mode in alternatives:
            if flag in columns:
                clean: Predicate = (flag, "in", list(vocab.GATE_FLAGS))
                groups.append([clean, mode] if bgc else [clean])
    return groups


def _gate(columns: Iterable[str], profile: str) -> Column:
    test = condition(row_gate_filters(columns, profile))
    if test is None:
        raise ValueError("the table has no flag column of any parameter")
    return test


def row_gate(df: DataFrame, profile: str) -> DataFrame:
    """Keep rows where any parameter has a clean flag (and, for BGC, the mode that goes with it)."""
    return df.where(_gate(df.columns, profile))


def _usable(value: str, flag: str) -> Column:
    """Whether there is a value, which NaN is not, with a good flag."""
    return F.col(value).isNotNull() & ~F.isnan(value) & F.col(flag).isin(*vocab.GOOD_FLAGS)


def _adjusted_counts(parameter: str, mode: str) -> Column:
    return _usable(f"{parameter}_ADJUSTED", f"{parameter}_ADJUSTED_QC") & F.col(mode).isin(*vocab.ADJUSTED_MODES)


def _realtime_counts(parameter: str, mode: str) -> Column:
    return _usable(parameter, f"{parameter}_QC") & (F.col(mode) == vocab.REALTIME_MODE)


def has_best_value(parameter: str, mode: str) -> Column:
    """Whether ``best_value`` would give a value; may be null where a flag or mode is."""
    return _adjusted_counts(parameter, mode) | _realtime_counts(parameter, mode)


def _choice(parameter: str, mode: str) -> Column:
    """Which of its values a parameter keeps: the adjusted, else the real-time one, else null for none.

    A condition that is null because a flag or the mode is counts as not met.
    """
    realtime = F.when(_realtime_counts(parameter, mode), F.lit("R"))
    return F.when(_adjusted_counts(parameter, mode), F.lit("A")).otherwise(realtime)


def _chosen(parameter: str, choice: str) -> list[Column]:
    """Value, flag and error that go with the choice; real-time values have no error."""
    adjusted, realtime = F.col(choice) == "A", F.col(choice) == "R"

    def pick(suffix: str) -> Column:
        return F.when(adjusted, F.col(f"{parameter}_ADJUSTED{suffix}")).when(realtime, F.col(parameter + suffix))

    return [
        pick("").cast("float").alias(parameter),
        pick("_QC").cast("smallint").alias(f"{parameter}_QC"),
        F.when(adjusted, F.col(f"{parameter}_ADJUSTED_ERROR")).cast("float").alias(f"{parameter}_ERROR"),
    ]


def best_values(df: DataFrame, profile: str, parameters: Sequence[str] | None = None) -> DataFrame:
    """Replace value, flag and adjusted columns of each parameter by the best value, flag and error.

    The choice is made once per parameter and used three times. Spark keeps the two
    projections apart and so does not repeat its conditions.
    """
    names = list(parameters) if parameters is not None else flagged_parameters(df.columns)
    replaced = {
        name + suffix
        for name in names
        for suffix in ("", "_QC", "_ERROR", "_ADJUSTED", "_ADJUSTED_QC", "_ADJUSTED_ERROR")
    }
    others = [c for c in df.columns if c not in replaced]
    choices = {name: f"__choice_{name}" for name in names}
    chosen = df.withColumns({choices[name]: _choice(name, mode_column(name, profile)) for name in names})
    return chosen.select(*others, *[c for name in names for c in _chosen(name, choices[name])])


def _located() -> Column:
    return F.col("POSITION_QC").isin(*vocab.GOOD_FLAGS) & F.col("JULD_QC").isin(*vocab.GOOD_FLAGS)


def null_unless_located(df: DataFrame, parameters: Sequence[str] | None = None) -> DataFrame:
    """Null out the values, not their flags and errors, of rows without a good position and time."""
    names = list(parameters) if parameters is not None else flagged_parameters(df.columns)
    return df.withColumns({name: F.when(_located(), F.col(name)) for name in names})


def drop_empty_rows(df: DataFrame, parameters: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where every parameter is null."""
    names = list(parameters) if parameters is not None else flagged_parameters(df.columns)
    return df.where(F.coalesce(*[F.col(name) for name in names]).isNotNull())


def constant_flags(df: DataFrame, parameters: Sequence[str], flags: int | Sequence[int], profile: str) -> DataFrame:
    """Set the flag column of each parameter to one flag for all, or to one flag each."""
    known = set(vocab.lake_columns(profile))
    unknown = [f"{name}_QC" for name in parameters if f"{name}_QC" not in known]
    if unknown:
        raise ValueError(f"not in the vocabulary: {unknown}")
    if isinstance(flags, bool) or not isinstance(flags, (int, list, tuple)):
        raise ValueError("flags must be an integer or a list of integers")
    each = [flags] * len(parameters) if isinstance(flags, int) else list(flags)
    if len(each) != len(parameters):
        raise ValueError(f"{len(parameters)} parameters but {len(each)} flags")
    return df.withColumns({f"{n}_QC": F.lit(f).cast(T.ShortType()) for n, f in zip(parameters, each)})


def best_value_table(df: DataFrame, profile: str, source: str = "ARGO") -> DataFrame:
    """Raw rows to lake rows: gate, best values, position and time, no empty rows, lake columns.

    Rows without a good position or time would lose all values and then be dropped as
    empty, so here they are filtered out, which lets the scan prune on those flags. That
    some value is left is tested on the inputs, in the same filter. The table is not
    shuffled.
    """
    names = flagged_parameters(df.columns)
    any_value = reduce(operator.or_, [has_best_value(n, mode_column(n, profile)) for n in names])
    kept = df.where(_located() & _gate(df.columns, profile) & any_value)
    best = label_source(best_values(kept, profile, names), source, overwrite=False)
    modes = [c for c in best.columns if "DATA_MODE" in c]
    # Domains are applied here, after the choice of values has used the modes as they came.
    best = best.withColumns({c: domain_column(c, vocab.DATA_MODES) for c in modes})
    return conform(drop_outside(best, vocab.lake_columns(profile)), vocab.lake_schema(profile))
