"""The declared table contract, its checks, coercion and request parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import to_double, to_long, whole_number
from plumbline.shared import literal_rows, melt


@dataclass(frozen=True)
class Contract:
    """Declared columns with their kinds (``int``, ``float``, ``category``) and roles, and what a request may hold."""

    columns: tuple[tuple[str, str], ...]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    form_bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict, hash=False)
    choices: Mapping[str, Sequence[str]] = field(default_factory=dict, hash=False)

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def spark_schema(self, key: str | None = None) -> T.StructType:
        fields = [T.StructField(key, T.LongType())] if key else []
        fields += [T.StructField(name, SPARK_TYPES[kind]) for name, kind in self.columns]
        return T.StructType(fields)


SPARK_TYPES = {"int": T.LongType(), "float": T.DoubleType(), "category": T.StringType()}

# The declared schema, value ranges, category lists, form bounds and messages.
VALUE_RANGES = {"age": (18, 100), "bmi": (10, 60)}
ALLOWED_VALUES = {
    "sex": ["male", "female"],
    "smoker": ["yes", "no"],
    "region": ["southwest", "southeast", "northwest", "northeast"],
}
FORM_BOUNDS = {"age": (18, 100), "bmi": (15, 50), "children": (0, 10)}
MISSING_FIELD = "Please fill all fields!"
INVALID_PREFIX = "Invalid input data: "
DRIFT_FOUND = "Data drift detected between train and test sets"
NO_DRIFT = "No data drift detected"
INSURED = Contract(
    columns=(
        ("age", "int"), ("sex", "category"), ("bmi", "float"), ("children", "int"),
        ("smoker", "category"), ("region", "category"), ("charges", "float"),
    ),
    numeric=("age", "bmi", "children", "charges"),
    categorical=("sex", "smoker", "region"),
    target="charges",
    form_bounds=FORM_BOUNDS,
    choices=ALLOWED_VALUES,
)


def normalise_nulls(df: DataFrame) -> DataFrame:
    """Turn NaN into null once, so that later operators meet only nulls."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select([
        F.when(~F.isnan(F.col(name)), F.col(name)).alias(name) if name in floats else F.col(name)
        for name in df.columns
    ])


def _require(df: DataFrame, cols: Sequence[str]) -> None:
    unknown = [name for name in cols if name not in df.columns]
    if unknown:
        raise ValueError(f"columns not found: {unknown}")


def project(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Keep the expected columns in the expected order."""
    _require(df, expected)
    return df.select(*expected)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; unlike ``DataFrame.drop`` an unknown name is an error."""
    _require(df, cols)
    return df.drop(*cols)


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features and target as two projections of the same rows."""
    _require(df, [target])
    return df.drop(target), df.select(target)


def outside(col: Column, lo: float, hi: float) -> Column:
    """``x < lo or x > hi``; a null is not outside."""
    return F.coalesce((col < F.lit(lo)) | (col > F.lit(hi)), F.lit(False))


def out_of_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.filter((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric`` or ``text`` columns."""
    wanted = {"numeric": T.NumericType, "text": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def column_count_ok(names: Sequence[str], contract: Contract) -> bool:
    return len(names) == len(contract.columns)


def missing_columns(names: Sequence[str], contract: Contract) -> dict[str, list[str]]:
    present = set(names)
    return {
        "numeric": [name for name in contract.numeric if name not in present],
        "categorical": [name for name in contract.categorical if name not in present],
    }


def type_mismatches(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """``(column, declared kind, actual type)`` for each declared column of another type."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return [
        (name, kind, actual[name].simpleString())
        for name, kind in contract.columns
        if name in actual and actual[name] != SPARK_TYPES[kind]
    ]


def check_column_count(df: DataFrame, contract: Contract) -> DataFrame:
    row = ("column_count", column_count_ok(df.columns, contract), len(contract.columns), len(df.columns))
    return literal_rows(
        df.sparkSession, "check_name string, passed boolean, expected bigint, actual bigint", [row])


def check_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per declared role column: is it there?"""
    rows = [(role, name, name in df.columns)
            for role, names in (("numeric", contract.numeric), ("categorical", contract.categorical))
            for name in names]
    return literal_rows(df.sparkSession, "role string, column_name string, present boolean", rows)


def check_types(df: DataFrame, contract: Contract) -> DataFrame:
    return literal_rows(
        df.sparkSession, "column_name string, declared string, actual string",
        type_mismatches(df, contract))


def _typed(name: str, kind: str, source: str) -> Column:
    """A declared column cast to its kind; null where a value is not of it."""
    if kind == "category":
        return F.col(name).cast("string")
    if kind == "float":
        number = to_double(F.col(name)) if source == "string" else F.col(name).try_cast("double")
        return F.when(~F.isnan(number), number)
    if source in ("tinyint", "smallint", "int", "bigint"):
        return F.col(name).cast("bigint")
    return whole_number(F.col(name).cast("string"))


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast declared columns to their types; values that do not parse become null.

    Whole numbers may be spelled ``42.0`` or ``1e2``. A fraction in a whole-number column is
    a value that does not parse: it is not cut off, and ``coercion_losses`` names it.
    """
    kinds = dict(df.dtypes)
    return df.withColumns({name: _typed(name, kind, kinds[name])
                           for name, kind in contract.columns if name in kinds})


def coercion_losses(df: DataFrame, contract: Contract, key: str) -> DataFrame:
    """``(key, column_name, value)`` of every value that ``coerce`` turns to null."""
    kinds = dict(df.dtypes)
    cells = [F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"),
                      _typed(name, kind, kinds[name]).isNull().alias("lost"))
             for name, kind in contract.columns if name in kinds and kind != "category"]
    rows = df.select(F.col(key).alias("key"), F.inline(F.array(*cells)))
    missing = F.col("value").isNull() | F.lower("value").isin("nan", "")
    return rows.filter(F.col("lost") & ~missing).drop("lost")


def judge_requests(df: DataFrame, contract: Contract = INSURED, form_bounds: bool = True) -> DataFrame:
    """Add the typed fields as ``typed_*`` and a ``reason`` that is null for a good request."""
    kinds = dict(contract.columns)
    fields = [name for name, _ in contract.columns if name != contract.target]
    typed, parsed, reason = {}, {}, None

    def reject(condition: Column, text: str) -> None:
        nonlocal reason
        condition = F.coalesce(condition, F.lit(False))
        reason = F.when(condition, F.lit(text)) if reason is None else reason.when(condition, F.lit(text))

    for name in fields:
        reject(F.col(name).isNull() | (F.col(name) == ""), MISSING_FIELD)
    for name in fields:
        if kinds[name] == "category":
            typed[name] = F.col(name)
            continue
        parse, noun = (to_long, "whole number") if kinds[name] == "int" else (to_double, "number")
        parsed[name] = parse(F.col(name)).alias(f"typed_{name}")
        typed[name] = F.col(f"typed_{name}")
        reject(typed[name].isNull(), f"{INVALID_PREFIX}{name} is not a {noun}")
    if form_bounds:
        for name, (lo, hi) in contract.form_bounds.items():
            reject(outside(typed[name], lo, hi), f"{INVALID_PREFIX}{name} is out of range")
    for name, allowed in contract.choices.items():
        reject(~F.col(name).isin(allowed), f"{INVALID_PREFIX}{name} is not a known choice")
    # Parsed once here, behind a generator: a filter on the reason would otherwise be merged
    # with the casts, and repeat them in code too long for the JVM to compile.
    cells = df.select("*", F.inline(F.array(F.struct(*parsed.values()))))
    texts = {f"typed_{name}": expr for name, expr in typed.items() if name not in parsed}
    return cells.withColumns({**texts, "reason": reason})


def accepted_requests(judged: DataFrame, contract: Contract = INSURED) -> DataFrame:
    fields = [name for name, _ in contract.columns if name != contract.target]
    rest = [name for name in judged.columns
            if name not in fields and name != "reason" and not name.startswith("typed_")]
    return judged.filter(F.col("reason").isNull()).select(
        *rest, *[F.col(f"typed_{name}").alias(name) for name in fields])


def parse_requests(
    df: DataFrame, contract: Contract = INSURED, form_bounds: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Split text requests into typed accepted rows and rejected rows with a reason."""
    judged = judge_requests(df, contract, form_bounds)
    rejected = judged.filter(F.col("reason").isNotNull()).select(*df.columns, "reason")
    return accepted_requests(judged, contract), rejected


@dataclass(frozen=True)
class Validation:
    """Outcome of the column checks; drift changes the message, never the status."""

    status: bool
    message: str
    flags: Mapping[str, bool]
    drift_detected: bool | None = None


def validate(
    train: DataFrame, test: DataFrame, contract: Contract, drift=None,
    key: str | None = None,
) -> Validation:
    """Check both samples; ``drift`` is called only when every column check passes."""
    names = {side: [c for c in df.columns if c != key] for side, df in (("train", train), ("test", test))}
    flags, problems = {}, []
    for side in ("train", "test"):
        flags[f"{side}_columns_valid"] = column_count_ok(names[side], contract)
        if not flags[f"{side}_columns_valid"]:
            problems.append(f"{side}: wrong number of columns.")
    for side in ("train", "test"):
        absent = missing_columns(names[side], contract)
        flags[f"{side}_columns_exist"] = not (absent["numeric"] or absent["categorical"])
        if not flags[f"{side}_columns_exist"]:
            problems.append(f"{side}: missing {absent['numeric'] + absent['categorical']}.")
    if problems:
        return Validation(False, " ".join(problems), flags)
    drifted = None if drift is None else bool(drift(train, test))
    if drifted:
        message = DRIFT_FOUND
    else:
        message = NO_DRIFT
    return Validation(True, message, flags, drifted)


def validation_rows(result: Validation, train: DataFrame, test: DataFrame) -> DataFrame:
    """The validation result as report rows, with the shape and the missing profile."""
    spark = train.sparkSession
    schema = "section string, column_name string, metric string, value double, text string"
    driver_rows = [("checks", None, name, float(flag), None) for name, flag in result.flags.items()]
    driver_rows.append(("checks", None, "validation_status", float(result.status), result.message))
    if result.drift_detected is not None:
        driver_rows.append(("checks", None, "drift_detected", float(result.drift_detected), None))
    report = literal_rows(spark, schema, driver_rows)
    for side, df in (("train", train), ("test", test)):
        counted = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(name).isNull()).alias(f"missing_{i}") for i, name in enumerate(df.columns)])
        nothing = F.lit(None).cast("string")
        entries = [(f"{side}_shape", nothing, "rows", F.col("rows").cast("double"), nothing),
                   (f"{side}_shape", nothing, "columns", F.lit(float(len(df.columns))),
                    F.lit(",".join(df.columns)))]
        for i, name in enumerate(df.columns):
            entries.append((f"{side}_missing", F.lit(name), "missing_count",
                            F.col(f"missing_{i}").cast("double"), nothing))
        report = report.unionByName(
            melt(counted, ["section", "column_name", "metric", "value", "text"], entries))
    return report


def require_valid(result: Validation) -> None:
    """Refuse to build features from data that failed the column checks."""
    if not result.status:
        raise ValueError(f"data validation failed: {result.message}")


