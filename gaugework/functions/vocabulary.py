"""Canonical names of types, increments and aggregations, and their accepted spellings."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Names and spellings users of the data model rely on.
# ---------------------------------------------------------------------------
SIGNAL_TYPES = {
    "Static": ("static", "staticnumeric"),
    "TimeDependent": ("time", "timenumeric", "timedependent"),
    "DepthDependent": ("depth", "depthnumeric", "depthdependent"),
    "String": ("string", "staticstring"),
    "PVT": ("pvt", "pvtnumeric"),
    "StringTimeDependent": ("stringtime", "timestring", "stringtimedependent"),
    "StringDepthDependent": ("stringdepth", "depthstring", "stringdepthdependent"),
}
TIME_INCREMENTS = {
    "EverySecond": ("everysecond", "s", "sec", "second", "1s", "1sec", "1second"),
    "EveryMinute": ("everyminute", "min", "minute", "1min", "1minute"),
    "EveryFiveMinutes": ("everyfiveminute", "everyfiveminutes", "5min", "5minutes"),
    "EveryFifteenMinutes": ("everyfifteenminutes", "15min", "15minutes"),
    "Hourly": ("hourly", "h", "hr", "hour", "1h", "1hr", "1hour"),
    "Daily": ("daily", "d", "day", "1d", "1day"),
    "Monthly": ("monthly", "m", "month", "1m", "1month"),
    "Quarterly": ("quarterly", "q", "3m", "3month", "quarter"),
    "Yearly": ("yearly", "y", "year", "1y", "1year"),
}
DEPTH_INCREMENTS = {
    "TenthMeter": ("tenthmeter", ".1meter", ".1m", "0.1meter", "0.1m"),
    "EighthMeter": ("eightmeter", "eighthmeter", ".125meter", ".125m", "0.125meter", "0.125m"),
    "HalfFoot": ("halffoot", "halfft", ".5foot", ".5feet", ".5ft", "0.5foot", "0.5feet", "0.5ft"),
    "Foot": ("foot", "ft", "1foot", "1ft"),
    "HalfMeter": ("halfmeter", "halfm", ".5meter", ".5m", "0.5meter", "0.5m"),
    "Meter": ("meter", "m", "1meter", "1m"),
}
DEPTH_STEP_METRES = {
    "TenthMeter": 0.1,
    "EighthMeter": 0.125,
    "HalfFoot": 0.1524,
    "Foot": 0.3048,
    "HalfMeter": 0.5,
    "Meter": 1.0,
}
AGGREGATIONS = {
    "Sum": ("sum", "concatenate", "concat"),
    "Average": ("average", "avg", "mean"),
    "Max": ("max", "maximum", "longest", "largest", "biggest"),
    "Min": ("min", "minimum", "shortest", "smallest"),
    "First": ("first",),
    "Last": ("last",),
    "Count": ("count",),
    "NoAggregation": ("none", "no", "noaggregation", "noagg"),
    "Median": ("median",),
    "Mode": ("mode",),
    "StandardDeviation": ("standarddeviation", "std"),
    "Variance": ("variance", "var"),
    "Percentile": ("percentile",),
    "Range": ("range",),
}
MODEL_TYPES = {
    "Regression": ("regression", "reg"),
    "BinaryClassification": ("binaryclassification", "binaryclass", "binclass", "bin"),
    "MultipleClassification": (
        "multipleclassification", "multiclassification", "multipleclass", "multiclass", "multiple", "multi",
    ),
    "Clustering": ("clustering", "cluster"),
    "NaiveBayes": ("naivebayes", "bayes"),
    "NaiveBayesCategorical": ("naivebayescategorical", "bayescategorical"),
}
NORMALISATIONS = {
    "Auto": ("auto", "automatic"),
    "MinMax": ("minmax",),
    "MeanVariance": ("meanvariance", "meanvar"),
    "LogMeanVariance": ("logmeanvariance", "logmeanvar"),
    "Binning": ("binning", "bin"),
    "SupervisedBinning": ("supervisedbinning", "supervisedbin", "superbin"),
    "RobustScaling": ("robustscaling", "robust"),
    "LpNorm": ("lpnorm", "lp"),
    "GlobalContrast": ("globalcontrast", "contrast"),
}
COLUMN_TYPES = ("Numeric", "String", "DateTime", "Bool")
PARAMETER_TYPES = ("Numeric", "NumericWithUnit", "String", "List", "Dictionary", "Enumeration")
IGNORED_CHARACTERS = " _-.,"
# Headers with a fixed meaning.
ENTITY, ALIAS, TYPE, OPPORTUNITY = "Entity", "Alias", "Type", "IsOpportunity"
DATE, TIME, DEPTH = "Date", "Time", "Depth"
RESERVED_VALUE_COLUMNS = ("ID", "Entity", "Timestamp")
# ---------------------------------------------------------------------------

VOCABULARIES = {
    "signal type": SIGNAL_TYPES,
    "time increment": TIME_INCREMENTS,
    "depth increment": DEPTH_INCREMENTS,
    "aggregation": AGGREGATIONS,
    "model type": MODEL_TYPES,
    "normalisation": NORMALISATIONS,
}
NUMERIC_TYPES = {"static": "Static", "time": "TimeDependent", "depth": "DepthDependent"}
TEXT_TYPES = {"static": "String", "time": "StringTimeDependent", "depth": "StringDepthDependent"}
AXIS_OF_TYPE = {t: axis for names in (NUMERIC_TYPES, TEXT_TYPES) for axis, t in names.items()}


def _spellings(kind: str) -> dict[str, str]:
    """Spelling -> canonical name, canonical names themselves included."""
    return {s: name for name, spellings in VOCABULARIES[kind].items() for s in (*spellings, name.lower())}


def comparison_text(text: str, ignored: str = IGNORED_CHARACTERS) -> str:
    return text.translate({ord(c): None for c in ignored}).lower().strip()


def comparison_key(c: Column, ignored: str = IGNORED_CHARACTERS) -> Column:
    """The same normalisation as a column expression."""
    return F.btrim(F.lower(F.translate(c, ignored, "")), F.lit(" \t\r\n"))


def canonical(kind: str, text: str) -> str:
    """Canonical name for any accepted spelling; decimal steps may keep their dot."""
    known = _spellings(kind)
    for ignored in (IGNORED_CHARACTERS.replace(".", ""), IGNORED_CHARACTERS):
        name = known.get(comparison_text(text, ignored))
        if name:
            return name
    raise ValueError(f"unknown {kind} '{text}', expected one of {list(VOCABULARIES[kind])}")


def canonical_column(kind: str, c: Column, strict: bool = True) -> Column:
    """Canonical name per row from a constant map, so no join and no shuffle."""
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(_spellings(kind).items())])
    name = F.coalesce(
        F.try_element_at(known, comparison_key(c, IGNORED_CHARACTERS.replace(".", ""))),
        F.try_element_at(known, comparison_key(c)),
    )
    if not strict:
        return name
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.coalesce(name, F.raise_error(F.concat(F.lit(f"unknown {kind}: "), c)).cast("string"))
    )
