"""Rows as COPY-ready CSV lines, and back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidehaul.functions.statements import NULL_TEXT_ALONE, null_text
from tidehaul.functions.typemap import JSON_OPTIONS, is_nested, ref, sql_name, to_target

NULL_MODES = ("lossless", "merge")
# A NUL character inside JSON text: an escape whose backslash is not itself escaped.
JSON_NUL = r"(?<!\\)(?:\\\\)*\\u0000"

# Types whose text never holds a quote, comma or line break.
PLAIN = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.BinaryType,
)


def _field(value: str, data_type: T.DataType, null_mode: str, alone: bool) -> str:
    """SQL for one field of the line; ``value`` is a column in its target type."""
    null = f"r'{null_text(1 if alone else 2)}'"
    if isinstance(data_type, PLAIN):
        return f"coalesce(cast({value} AS STRING), {null})"
    special = [f"contains({value}, {c})" for c in ("'\"'", "','", "char(10)", "char(13)")]
    if alone:
        # By itself on a line this would end the data.
        special.append(f"{value} = r'\\.'")
    empty = f"WHEN {value} = '' THEN '\"\"' " if null_mode == "lossless" else f"WHEN {value} = '' THEN {null} "
    quoted = f"concat('\"', replace({value}, '\"', '\"\"'), '\"')"
    return (
        f"CASE WHEN {value} IS NULL THEN {null} WHEN {' OR '.join(special)} THEN {quoted} {empty}ELSE {value} END"
    )


def encode_copy_rows(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    carry: Sequence[str | Column] = (),
    null_mode: str = "lossless",
    line: str = "line",
) -> DataFrame:
    """One CSV ``line`` per row, next to the ``carry`` columns.

    ``columns`` are the fields of the line (by default all columns that are not
    carried). A field is quoted when it holds a quote, comma, CR or LF. With
    ``null_mode="lossless"`` an empty string is ``""`` and NULL is nothing;
    ``"merge"`` writes nothing for both, so both load as NULL. A line of one
    field has ``NULL_TEXT_ALONE`` in place of nothing, so that it is not empty.
    """
    if null_mode not in NULL_MODES:
        raise ValueError(f"null_mode must be one of {NULL_MODES}")
    carried = [c for c in carry if isinstance(c, str)]
    names = list(columns) if columns is not None else [n for n in df.columns if n not in carried]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    kept = [ref(c) if isinstance(c, str) else c for c in carry]
    # The target values get their own projection, so that a JSON value is
    # made once although the quoting rule looks at it several times.
    values = [F.expr(f"{to_target(n, kinds[n])} AS __field_{i}") for i, n in enumerate(names)]
    staged = df.select(*kept, *values)
    fields = [_field(f"__field_{i}", kinds[n], null_mode, len(names) == 1) for i, n in enumerate(names)]
    passed = [sql_name(n) for n in staged.columns if not n.startswith("__field_")]
    return staged.selectExpr(*passed, f"concat_ws(',', {', '.join(fields)}) AS {sql_name(line)}")


DATED = (T.DateType, T.TimestampType, T.TimestampNTZType)


def far_date(name: str) -> str:
    return f"year({sql_name(name)}) NOT BETWEEN 1 AND 9999"


def _holds_text(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.StringType, T.VariantType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return _holds_text(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _holds_text(data_type.keyType) or _holds_text(data_type.valueType)
    if isinstance(data_type, T.StructType):
        return any(_holds_text(f.dataType) for f in data_type.fields)
    return False


def rejected(
    schema: T.StructType,
    *,
    columns: Sequence[str] | None = None,
    not_null: Iterable[str] = (),
    check: Column | None = None,
) -> Column:
    """True for a row the target would refuse.

    Refused are NUL characters in text (also inside JSON), text that is not
    valid UTF-8, dates and times outside the years 1 to 9999 (which would print in
    a form the target does not read), the text that stands for NULL in a table
    of one column, NULL in a ``not_null`` column, and rows for which ``check``, the caller's own rule, is true.
    """
    names = schema.fieldNames() if columns is None else columns
    rules = []
    for field in (schema[n] for n in names):
        if isinstance(field.dataType, T.StringType):
            rules.append(f"contains({sql_name(field.name)}, char(0))")
            rules.append(f"NOT is_valid_utf8({sql_name(field.name)})")
            if len(names) == 1:
                rules.append(f"{sql_name(field.name)} = r'{NULL_TEXT_ALONE}'")
        elif isinstance(field.dataType, DATED):
            rules.append(far_date(field.name))
        elif (is_nested(field.dataType) or isinstance(field.dataType, T.VariantType)) and _holds_text(field.dataType):
            rules.append(f"rlike({to_target(field.name, field.dataType)}, r'{JSON_NUL}')")
    rules += [f"{sql_name(n)} IS NULL" for n in not_null]
    found = F.expr(" OR ".join(f"coalesce({rule}, false)" for rule in rules) or "false")
    return found if check is None else found | F.coalesce(check, F.lit(False))


def _open(data_type: T.DataType, text_keys: bool) -> T.DataType:
    """``data_type`` with all members nullable and, if asked, text as map keys, the only kind JSON has."""
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_open(data_type.elementType, text_keys))
    if isinstance(data_type, T.MapType):
        key = T.StringType() if text_keys else _open(data_type.keyType, text_keys)
        return T.MapType(key, _open(data_type.valueType, text_keys))
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, _open(f.dataType, text_keys)) for f in data_type.fields])
    return data_type


def from_target(name: str, data_type: T.DataType) -> Column:
    """The source value of a field's text."""
    col = sql_name(name)
    if is_nested(data_type):
        return F.from_json(F.col(col), _open(data_type, True), JSON_OPTIONS).cast(_open(data_type, False))
    if isinstance(data_type, T.BinaryType):
        return F.expr(f"unhex(substring({col}, 3))")
    if isinstance(data_type, T.TimestampType):
        return F.expr(f"cast(concat({col}, 'Z') AS TIMESTAMP)")
    if isinstance(data_type, T.VariantType):
        return F.expr(f"parse_json({col})")
    return F.expr(f"cast({col} AS {data_type.simpleString()})")


def read_back(df: DataFrame, schema: T.StructType, also: Sequence[Column] = ()) -> DataFrame:
    """Text columns, in ``schema`` order, as values of the source types, then ``also``."""
    return df.select(*[from_target(f.name, f.dataType).alias(f.name) for f in schema.fields], *also)
