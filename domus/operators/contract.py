"""Declarative data contract: B2 check_columns, B4 not-null, B5 range, B6 isin, B7 not-future,
B8 trimmed text, B9 validate_report, B10 request_contract, B11 result_contract,
B12 split_valid_rejected, B14 null_profile.

A contract is *data*: a list of ``RuleSpec(kind, column, params)``. It is evaluated in one
pass — every rule becomes one boolean "bad" column, and all counts come out of a single
aggregate. Validation never drops rows; it reports, and raises on request.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domus import constants as C
from domus.errors import ContractError


#: Column of the names of the columns whose cells did not parse, row by row.
FAILURES = "coercion_failures"


@dataclass(frozen=True)
class RuleSpec:
    kind: str  # not_null | range | isin | not_future | trimmed_text | positive | min
    column: str
    params: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


@dataclass(frozen=True)
class ColumnSpec:
    nullable: bool = True
    lo: float | None = None
    hi: float | None = None
    isin: tuple[str, ...] | None = None
    text: bool = False  # trimmed length 1..120


@dataclass
class Contract:
    """Strict (no extra/missing columns), one rule list, evaluated in one pass."""

    columns: dict[str, ColumnSpec]
    extra_rules: list[RuleSpec] = field(default_factory=list)
    strict: bool = True

    def rules(self) -> list[RuleSpec]:
        out: list[RuleSpec] = []
        for c, s in self.columns.items():
            if not s.nullable:
                out.append(RuleSpec("not_null", c))
            if s.text:
                out.append(RuleSpec("trimmed_text", c, (1, C.TEXT_MAX_LEN)))
            if s.lo is not None or s.hi is not None:
                out.append(RuleSpec("range", c, (s.lo, s.hi)))
            if s.isin is not None:
                out.append(RuleSpec("isin", c, tuple(s.isin)))
        return out + list(self.extra_rules)

    def check_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        """B2: (missing, extra) column names; order is not enforced. Driver only, no job."""
        return check_columns(df.columns, list(self.columns), self.strict)

    def validate(self, df: DataFrame, raise_on_error: bool = False, ignore: tuple[str, ...] = ()) -> list[tuple[str, str, int]]:
        """All rule counts at once; with ``raise_on_error`` one error lists every failure.
        Cells that did not parse when the rows were loaded count as well; ``ignore`` names columns (keys) that may
        stand beside the contract's."""
        missing, extra = self.check_columns(df)
        extra = [c for c in extra if c != FAILURES and c not in ignore]
        fails: list[tuple[str, str, int]] = [("column_missing", c, 0) for c in missing]
        fails += [("column_extra", c, 0) for c in extra]
        if missing:
            if raise_on_error:
                raise ContractError(f"contract failed: {fails}", fails)
            return fails
        row = df.agg(*count_exprs(self.rules())).collect()[0]
        fails += [(r.kind, r.column, int(row[r.name])) for r in self.rules() if row[r.name]]
        fails += coercion_counts(df)
        if raise_on_error and fails:
            raise ContractError(f"contract failed: {fails}", fails)
        return fails


def coercion_counts(df: DataFrame) -> list[tuple[str, str, int]]:
    """(coercion, column, rows) for cells that did not parse, from the ``FAILURES`` column that
    ``load_snapshots(failures=True)`` adds; nothing without it."""
    if FAILURES not in df.columns:
        return []
    rows = df.select(F.explode(FAILURES).alias("c")).groupBy("c").count().orderBy("c").collect()
    return [("coercion", r["c"], int(r["count"])) for r in rows]


def check_columns(actual: list[str], expected: list[str], strict: bool = True) -> tuple[list[str], list[str]]:
    missing = [c for c in expected if c not in actual]
    extra = [c for c in actual if c not in expected] if strict else []
    return missing, extra


def bad_expr(rule: RuleSpec) -> Column:
    """True when a row violates ``rule``; null-valued columns pass every rule but not_null."""
    c = F.col(rule.column)
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "range":
        lo, hi = rule.params
        if lo is not None and hi is not None:
            return ~c.between(lo, hi)
        return (c < lo) if lo is not None else (c > hi)
    if rule.kind == "isin":
        return ~c.isin(list(rule.params))
    if rule.kind == "not_future":
        (year,) = rule.params
        return c > F.lit(year)
    if rule.kind == "trimmed_text":
        lo, hi = rule.params
        return ~F.length(F.regexp_replace(c, r"^\s+|\s+$", "")).between(lo, hi)
    if rule.kind == "positive":
        return c <= 0
    raise ValueError(f"unknown rule kind {rule.kind}")


def count_exprs(rules: list[RuleSpec]) -> list[Column]:
    return [F.coalesce(F.sum(bad_expr(r).cast("long")), F.lit(0)).alias(r.name) for r in rules]


def validate_report(df: DataFrame, rules: list[RuleSpec]) -> DataFrame:
    """Long form (rule, column, n_bad) — one aggregate, then an unpivot of one row."""
    wide = df.agg(*count_exprs(rules))
    stack = ", ".join(f"'{r.kind}', '{r.column}', `{r.name}`" for r in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, `column`, n_bad)")


def reasons_expr(rules: list[RuleSpec]) -> Column:
    """Array of violated rule names per row (empty when the row is valid)."""
    return F.array_compact(F.array(*[F.when(bad_expr(r), F.lit(r.name)) for r in rules]))


def tag_rejects(df: DataFrame, rules: list[RuleSpec]) -> DataFrame:
    """B12 in one pass: every row with its ``reject_reason`` array (empty = valid)."""
    return df.withColumn("reject_reason", reasons_expr(rules))


def split_valid_rejected(df: DataFrame, rules: list[RuleSpec]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason`` array). Narrow; no shuffle.

    Both outputs derive from one tagged frame; persist or checkpoint the input when both are
    consumed by separate actions."""
    tagged = tag_rejects(df, rules)
    valid = tagged.filter(F.size("reject_reason") == 0).drop("reject_reason")
    rejected = tagged.filter(F.size("reject_reason") > 0)
    return valid, rejected


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_null) for each column, one aggregate."""
    cols = cols or df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (`column`, n_null)")


def price_per_sqm(price: str = "price_pln", area: str = "square_meters") -> Column:
    """round(price / area, 2) with Python rounding of the exact double."""
    from domus.functions.numeric import py_round

    return py_round(F.col(price).cast("double") / F.col(area), 2)


# ---------------------------------------------------------------------------
# Ready-made contracts
# ---------------------------------------------------------------------------
def listing_contract(cities=C.CITIES, property_types=C.PROPERTY_TYPES, ownerships=C.OWNERSHIPS,
                     materials=C.BUILDING_MATERIALS, conditions=C.CONDITIONS,
                     area=(C.SQUARE_METERS_MIN, C.SQUARE_METERS_MAX),
                     as_of: dt.date | None = None, record: bool = False) -> Contract:
    """The 29-column listing contract. ``record=True`` adds the record-level rules
    (trimmed id, build year not after ``as_of``'s year)."""
    dist = ColumnSpec(nullable=True, lo=0.0)
    cols = {
        "id": ColumnSpec(nullable=False, text=record),
        "city": ColumnSpec(nullable=False, isin=tuple(cities)),
        "property_type": ColumnSpec(isin=tuple(property_types)),
        "square_meters": ColumnSpec(nullable=False, lo=area[0], hi=area[1]),
        "rooms": ColumnSpec(nullable=False, lo=C.ROOMS_MIN, hi=C.ROOMS_MAX),
        "floor": ColumnSpec(lo=C.FLOOR_MIN, hi=C.FLOOR_MAX),
        "floor_count": ColumnSpec(lo=0, hi=C.FLOOR_MAX),
        "build_year": ColumnSpec(lo=C.BUILD_YEAR_MIN),
        "latitude": ColumnSpec(nullable=False, lo=C.LATITUDE_MIN, hi=C.LATITUDE_MAX),
        "longitude": ColumnSpec(nullable=False, lo=C.LONGITUDE_MIN, hi=C.LONGITUDE_MAX),
        "centre_distance_km": ColumnSpec(nullable=False, lo=0.0),
        "poi_count": ColumnSpec(nullable=False, lo=0),
        **{c: dist for c in C.DISTANCE_COLUMNS},
        "ownership": ColumnSpec(nullable=False, isin=tuple(ownerships)),
        "building_material": ColumnSpec(isin=tuple(materials)),
        "condition": ColumnSpec(isin=tuple(conditions)),
        "has_parking": ColumnSpec(nullable=False),
        "has_balcony": ColumnSpec(nullable=False),
        "has_elevator": ColumnSpec(),
        "has_security": ColumnSpec(nullable=False),
        "has_storage": ColumnSpec(nullable=False),
        "price_pln": ColumnSpec(nullable=False, lo=C.PRICE_MIN_PLN, hi=C.PRICE_MAX_PLN),
        "snapshot_month": ColumnSpec(nullable=False),
    }
    extra = []
    if record:
        year = (as_of or dt.datetime.now(dt.timezone.utc).date()).year
        extra.append(RuleSpec("not_future", "build_year", (year,)))
    return Contract(cols, extra)


def request_contract(cities=C.CITIES, property_types=C.PROPERTY_TYPES, ownerships=C.OWNERSHIPS,
                     materials=C.BUILDING_MATERIALS, conditions=C.CONDITIONS,
                     area=(C.SQUARE_METERS_MIN, C.SQUARE_METERS_MAX),
                     as_of: dt.date | None = None) -> Contract:
    """The 26 request fields (no id, price, month)."""
    lc = listing_contract(cities, property_types, ownerships, materials, conditions, area,
                          as_of, record=True)
    cols = {c: s for c, s in lc.columns.items() if c in C.REQUEST_COLUMNS}
    return Contract(cols, lc.extra_rules)


def conform_requests(df: DataFrame) -> DataFrame:
    """B10 shape: unknown fields are rejected (error); missing optional fields default null."""
    extra = [c for c in df.columns if c not in C.REQUEST_COLUMNS]
    if extra:
        raise ContractError(f"unknown request fields: {extra}", [("column_extra", c, 0) for c in extra])
    missing_req = [c for c in C.REQUIRED_REQUEST_COLUMNS if c not in df.columns]
    if missing_req:
        raise ContractError(f"missing request fields: {missing_req}",
                            [("column_missing", c, 0) for c in missing_req])
    from domus.sources.snapshots import LISTING_TYPES

    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(LISTING_TYPES[c]).alias(c)
                       for c in C.REQUEST_COLUMNS])


def result_rules() -> list[RuleSpec]:
    """Price > 0, bounds >= 0 or null, model name/version non-empty trimmed text."""
    return [
        RuleSpec("not_null", "predicted_price"),
        RuleSpec("positive", "predicted_price"),
        RuleSpec("range", "interval_low", (0, None)),
        RuleSpec("range", "interval_high", (0, None)),
        RuleSpec("trimmed_text", "model_name", (1, C.TEXT_MAX_LEN)),
        RuleSpec("trimmed_text", "model_version", (1, C.TEXT_MAX_LEN)),
        RuleSpec("not_null", "predicted_at"),
    ]


# ---------------------------------------------------------------------------
# DuckDB twin of ``bad_expr`` (oracle side)
# ---------------------------------------------------------------------------
def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def bad_sql(rule: RuleSpec) -> str:
    c = rule.column
    if rule.kind == "not_null":
        return f"{c} IS NULL"
    if rule.kind == "range":
        lo, hi = rule.params
        if lo is not None and hi is not None:
            return f"NOT ({c} BETWEEN {lo!r} AND {hi!r})"
        return f"{c} < {lo!r}" if lo is not None else f"{c} > {hi!r}"
    if rule.kind == "isin":
        return f"NOT ({c} IN ({', '.join(_sql_lit(v) for v in rule.params)}))"
    if rule.kind == "not_future":
        return f"{c} > {rule.params[0]}"
    if rule.kind == "trimmed_text":
        lo, hi = rule.params
        bare = f"regexp_replace({c}, '^[ \\t\\n\\v\\f\\r]+|[ \\t\\n\\v\\f\\r]+$', '', 'g')"
        return f"NOT (length({bare}) BETWEEN {lo} AND {hi})"
    if rule.kind == "positive":
        return f"{c} <= 0"
    raise ValueError(rule.kind)


def report_sql(src: str, rules: list[RuleSpec]) -> str:
    parts = [f"SELECT '{r.kind}' AS rule, '{r.column}' AS \"column\", "
             f"CAST(coalesce(sum(CASE WHEN {bad_sql(r)} THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad FROM {src}"
             for r in rules]
    return "\nUNION ALL ".join(parts)


def reasons_sql(rules: list[RuleSpec]) -> str:
    """Comma-joined violated rule names (empty string when valid)."""
    items = ", ".join(f"CASE WHEN {bad_sql(r)} THEN '{r.name}' END" for r in rules)
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ',')"
