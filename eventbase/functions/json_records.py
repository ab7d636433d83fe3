"""JSON bodies to typed rows, with whole-record good/bad decisions.

``from_json`` already follows the wanted rules for most values. Where it does not
(empty text for a non-text field, day counts, epoch numbers, an object where a list
is expected, unusual float spellings), the record takes a second, exact pass:

* first pass, every record: one ``from_json`` with the declared types. Dates and
  timestamps are read as VARIANT, which keeps the JSON token type, so that a number and
  a piece of text can be told apart.
* second pass, only records in which ``from_json`` met something it calls corrupt: one more
  ``from_json`` with every value but text as VARIANT, and every value is decided from its
  token type. It runs inside a ``when``, so clean records never pay for it.
* exact pass, only what that cannot tell either (a name may stand twice, an object where a
  list is expected, broken text): each object is read as text and as VARIANT side by side.

Everything is a Column expression. There is no Python per row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of the special floats, as text in a JSON string.
STRICT_SPECIAL_FLOATS = ("NaN", "Infinity", "-Infinity")
LENIENT_SPECIAL_FLOATS = {
    "nan": "NaN",
    "infinity": "Infinity",
    "inf": "Infinity",
    "-infinity": "-Infinity",
    "-inf": "-Infinity",
}

# Units an integer timestamp may be declared in, with the largest
# magnitude that still fits Spark's microsecond timestamps.
EPOCH_UNITS = {
    "s": (F.timestamp_seconds, 9_223_372_036_854),
    "ms": (F.timestamp_millis, 9_223_372_036_854_775),
    "us": (F.timestamp_micros, 9_223_372_036_854_775_807),
}

# Reasons written beside a rejected record.
BLANK = "blank"
MALFORMED = "malformed"
BAD_VALUE = "bad_value"
EMPTY_LIST = "empty_list"
# Column with the place of a record in a root list, when those are taken apart.
ELEMENT = "element"

_CORRUPT = "__unparsed"
_TEMPORAL = (T.DateType, T.TimestampType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def parse_events(
    df: DataFrame,
    schema: T.StructType,
    *,
    epoch_unit: str = "ms",
    lenient_floats: bool = False,
    explode_root_array: bool = False,
    json_options: Mapping[str, str] | None = None,
    body: str = "value",
) -> DataFrame:
    """Add ``row`` (typed struct), ``reason`` and ``bad_fields`` to each message.

    A good record has a row and a null reason. A bad one has a null row, a reason and
    the names of the top-level fields at fault; its text stays in ``body``. With ``explode_root_array``
    a list at the root gives a record per element and its place in ``element``; an empty one is rejected.
    """
    if epoch_unit not in EPOCH_UNITS:
        raise ValueError(f"epoch_unit must be one of {sorted(EPOCH_UNITS)}, not {epoch_unit!r}")
    if not schema.fields:
        raise ValueError("an event schema needs at least one field")
    steps = _steps(
        df.sparkSession.sparkContext.applicationId,
        schema.json(),
        epoch_unit,
        lenient_floats,
        tuple(sorted((json_options or {}).items())),
        body,
    )
    kept = [F.col(f"`{c}`") for c in df.columns]
    if explode_root_array:
        df = df.select(*kept, F.posexplode_outer(steps.root_elements).alias(ELEMENT, "__item"))
        whole = F.when(F.col(ELEMENT).isNull(), F.col(f"`{body}`")).otherwise(F.col("__item"))
        df = df.withColumn(body, whole).drop("__item")
        kept.append(F.col(ELEMENT))
    parsed = (
        df.withColumn("__fast", steps.first_reading)
        .withColumns(steps.parts)
        .withColumns(steps.values)
        .withColumn("__p", steps.outcome)
        .select(*kept, steps.result)
    )
    if explode_root_array:
        empty = F.when(F.col(ELEMENT).isNull(), F.lit(EMPTY_LIST)).otherwise(F.col("reason"))
        parsed = parsed.withColumn("reason", empty)
    return parsed


@dataclass(frozen=True)
class _Steps:
    """The columns that parse one schema, in the order they are added."""

    root_elements: Column
    first_reading: Column
    parts: dict[str, Column]
    values: dict[str, Column]
    outcome: Column
    result: Column


class _Staged:
    """First-pass values, with columns of their own for what is used more than once.

    Expressions named by a column are worked out once per record; repeated inside one
    large expression they would be worked out at each use.
    """

    def __init__(self, rules: _Rules):
        self.rules = rules
        self.parts: dict[str, Column] = {}
        self.values: dict[str, Column] = {}

    def fast(self, col: Column, dtype: T.DataType) -> tuple[Column, Column | None]:
        """(value, is bad) of a field read by the first pass; None when it cannot be bad."""
        if not _contains(dtype, _TEMPORAL):
            return col, None
        n = len(self.parts)
        if isinstance(dtype, T.StructType):
            fields = {f.name: self.fast(col.getField(f.name), f.dataType) for f in dtype}
            bad = F.lit(False)
            for _, field_bad in fields.values():
                bad = bad if field_bad is None else bad | field_bad
            value = F.struct(*[v.alias(name) for name, (v, _) in fields.items()])
            return F.when(col.isNotNull(), value), bad
        if isinstance(dtype, T.ArrayType):
            self.parts[f"__part{n}"] = F.transform(col, lambda x: self.rules.item(x, dtype.elementType))
            pairs = F.col(f"__part{n}")
            value = F.transform(pairs, lambda p: p.getField("v"))
            return value, F.coalesce(F.exists(pairs, lambda p: p.getField("bad")), F.lit(False))
        if isinstance(dtype, T.MapType):
            self.parts[f"__part{n}"] = F.transform_values(
                col, lambda _, x: self.rules.item(x, dtype.valueType)
            )
            pairs = F.col(f"__part{n}")
            value = F.transform_values(pairs, lambda _, p: p.getField("v"))
            bad = F.exists(F.map_values(pairs), lambda p: p.getField("bad"))
            return value, F.coalesce(bad, F.lit(False))
        self.parts[f"__kind{n}"] = F.schema_of_variant(col)
        self.parts[f"__part{n}"] = F.try_variant_get(col, "$", "string")
        kind, text, value = F.col(f"__kind{n}"), F.col(f"__part{n}"), F.col(f"__value{n}")
        self.values[f"__value{n}"] = self.rules.temporal(kind, text, dtype)
        return value, value.isNull() & ~_is_nothing(kind, text)


@lru_cache(maxsize=1024)
def _steps(
    _application: str,
    schema_json: str,
    epoch_unit: str,
    lenient_floats: bool,
    json_options: tuple[tuple[str, str], ...],
    body: str,
) -> _Steps:
    """Built once per schema and application: a stream parses by the same rules in every batch."""
    schema = T.StructType.fromJson(json.loads(schema_json))
    rules = _Rules(epoch_unit, lenient_floats, dict(json_options))
    fast = F.col("__fast")
    staged = _Staged(rules)
    converted = {f.name: staged.fast(fast.getField(f.name), f.dataType) for f in schema}

    suspect = fast.getField(_CORRUPT).isNotNull()
    # What the first pass could read for certain needs no second look.
    settled = {}
    repeats = rules.may_repeat(F.col(f"`{body}`"), schema)
    if repeats is not None:
        suspect = suspect | F.coalesce(repeats, F.lit(False))
    for f in schema:
        odd = rules.has_special(fast.getField(f.name), f.dataType)
        if odd is not None:
            suspect = suspect | F.coalesce(odd, F.lit(False))
        value, is_bad = converted[f.name]
        known = F.coalesce(rules.known(fast.getField(f.name), f.dataType), F.lit(False))
        settled[f.name] = (
            known,
            F.struct(
                value.cast(f.dataType).alias("v"),
                (F.lit(False) if is_bad is None else is_bad).alias("bad"),
            ),
        )

    no_fields = F.array().cast("array<string>")
    bad = [F.when(b, F.lit(name)) for name, (_, b) in converted.items() if b is not None]
    clean = F.struct(
        F.struct(*[v.alias(n) for n, (v, _) in converted.items()]).cast(schema).alias("row"),
        F.lit(False).alias("malformed"),
        (F.array_compact(F.array(*bad)) if bad else no_fields).alias("bad_fields"),
    )
    outcome = (
        F.when(fast.isNull(), F.lit(None))
        .when(suspect, rules.suspect_record(F.col(body), schema, settled))
        .otherwise(clean)
    )
    has_bad = F.size("__p.bad_fields") > 0
    result = F.struct(
        F.when(~F.col("__p.malformed") & ~has_bad, F.col("__p.row")).alias("row"),
        F.when(F.col("__p").isNull(), F.lit(BLANK))
        .when(F.col("__p.malformed"), F.lit(MALFORMED))
        .when(has_bad, F.lit(BAD_VALUE))
        .alias("reason"),
        F.coalesce(F.col("__p.bad_fields"), no_fields).alias("bad_fields"),
    )
    return _Steps(
        rules.root_elements(F.col(body)),
        rules.from_json(F.col(body), rules.fast_type(schema), corrupt=True),
        staged.parts,
        staged.values,
        outcome,
        # A filter on the outcome would otherwise be pushed below and parse all over again:
        # a generator is where push-down stops.
        F.inline(F.array(result)),
    )


def _is_nothing(kind: Column, text: Column) -> Column:
    """Absent, null or empty text: a null value in a good record."""
    return kind.isNull() | (kind == "VOID") | ((kind == "STRING") & (text == ""))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Name a sub-expression so that several uses of it are one evaluation."""
    return F.get(F.transform(F.array(value), use), 0)


def _names_above(dtype: T.DataType, kinds: tuple[type, ...]) -> set[str]:
    """Names of struct fields that are, or hold, a value of one of the kinds."""
    if isinstance(dtype, T.StructType):
        held = [f for f in dtype if _contains(f.dataType, kinds)]
        return {f.name for f in held}.union(*(_names_above(f.dataType, kinds) for f in held))
    if isinstance(dtype, T.ArrayType):
        return _names_above(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return _names_above(dtype.valueType, kinds)
    return set()


def _names(dtype: T.DataType) -> set[str]:
    """Names of struct fields at all levels."""
    if isinstance(dtype, T.StructType):
        return set(dtype.fieldNames()).union(*(_names(f.dataType) for f in dtype))
    if isinstance(dtype, T.ArrayType):
        return _names(dtype.elementType)
    return _names(dtype.valueType) if isinstance(dtype, T.MapType) else set()


def _contains(dtype: T.DataType, kinds: tuple[type, ...]) -> bool:
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.StructType):
        return any(_contains(f.dataType, kinds) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return _contains(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return _contains(dtype.valueType, kinds)
    return False


class _Rules:
    """The value rules for one (epoch unit, float leniency, JSON options) choice."""

    def __init__(self, epoch_unit: str, lenient_floats: bool, json_options: Mapping[str, str]):
        self.to_timestamp, self.epoch_limit = EPOCH_UNITS[epoch_unit]
        self.lenient_floats = lenient_floats
        self.has_options = bool(json_options)
        # Options are always given: without them Spark may prune the parsed schema to the
        # fields in use, and then no longer sees a bad value in the others.
        self.options = {
            **json_options,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _CORRUPT,
        }

    def from_json(self, text: Column, dtype: T.DataType, corrupt: bool = False) -> Column:
        if corrupt:
            dtype = T.StructType([*dtype.fields, T.StructField(_CORRUPT, T.StringType())])
        return F.from_json(text, dtype, self.options)

    # -- values shared by both passes ------------------------------------------------

    def temporal(self, kind: Column, text: Column, dtype: T.DataType) -> Column:
        """Value of a date or timestamp from its token type and text; null when it has none."""
        # Spark would give a time alone today's date.
        as_written = F.when(text.rlike(r"^\s*[+-]?\d{4,}-"), text.try_cast(dtype))
        if isinstance(dtype, T.DateType):
            days = F.when(text.rlike(r"^[+]?\d+$"), text.try_cast("int"))
            return F.when(kind == "STRING", F.coalesce(as_written, F.date_from_unix_date(days)))
        number = text.try_cast("bigint")
        in_range = number.between(-self.epoch_limit, self.epoch_limit)
        return F.when(kind == "STRING", as_written).when(
            kind == "BIGINT", F.when(in_range, self.to_timestamp(number))
        )

    def special_float(self, text: Column) -> Column:
        """Value of a float given as JSON text; null when the spelling is not accepted."""
        if self.lenient_floats:
            value = F.lit(None).cast("double")
            for spelling, known in LENIENT_SPECIAL_FLOATS.items():
                value = F.when(F.lower(text) == spelling, F.lit(float(known))).otherwise(value)
            return value
        return F.when(text.isin(*STRICT_SPECIAL_FLOATS), text.try_cast("double"))

    # -- first pass ------------------------------------------------------------------

    def fast_type(self, dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.StructType):
            return T.StructType([T.StructField(f.name, self.fast_type(f.dataType)) for f in dtype])
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(self.fast_type(dtype.elementType))
        if isinstance(dtype, T.MapType):
            return T.MapType(T.StringType(), self.fast_type(dtype.valueType))
        return T.VariantType() if isinstance(dtype, _TEMPORAL) else dtype

    def item(self, col: Column, dtype: T.DataType) -> Column:
        """struct<v, bad> of a list element or map value read by the first pass."""
        if not _contains(dtype, _TEMPORAL):
            return F.struct(col.alias("v"), F.lit(False).alias("bad"))
        if isinstance(dtype, T.StructType):
            return _let(
                F.struct(*[self.item(col.getField(f.name), f.dataType).alias(f.name) for f in dtype]),
                lambda fs: F.struct(
                    F.when(col.isNotNull(), self._values(fs, dtype)).alias("v"),
                    self._any_bad(fs, dtype).alias("bad"),
                ),
            )
        if isinstance(dtype, T.ArrayType):
            return _let(
                F.transform(col, lambda x: self.item(x, dtype.elementType)),
                lambda xs: F.struct(
                    F.transform(xs, lambda x: x.getField("v")).alias("v"),
                    F.coalesce(F.exists(xs, lambda x: x.getField("bad")), F.lit(False)).alias("bad"),
                ),
            )
        if isinstance(dtype, T.MapType):
            return _let(
                F.transform_values(col, lambda _, x: self.item(x, dtype.valueType)),
                lambda m: F.struct(
                    F.transform_values(m, lambda _, x: x.getField("v")).alias("v"),
                    F.coalesce(
                        F.exists(F.map_values(m), lambda x: x.getField("bad")), F.lit(False)
                    ).alias("bad"),
                ),
            )
        return _let(
            F.struct(
                F.schema_of_variant(col).alias("kind"), F.try_variant_get(col, "$", "string").alias("a")
            ),
            lambda x: _let(
                self.temporal(x.getField("kind"), x.getField("a"), dtype),
                lambda v: F.struct(
                    v.alias("v"),
                    (v.isNull() & ~_is_nothing(x.getField("kind"), x.getField("a"))).alias("bad"),
                ),
            ),
        )

    def has_special(self, col: Column, dtype: T.DataType) -> Column | None:
        """True where the value alone does not tell whether its text is acceptable.

        A NaN or infinite float may have been spelled in several ways, and empty bytes
        may come from empty text.
        """
        if not _contains(dtype, (*_FLOATING, T.BinaryType)):
            return None
        if isinstance(dtype, T.StructType):
            parts = [self.has_special(col.getField(f.name), f.dataType) for f in dtype]
            parts = [F.coalesce(p, F.lit(False)) for p in parts if p is not None]
            found = parts[0]
            for p in parts[1:]:
                found = found | p
            return found
        if isinstance(dtype, T.ArrayType):
            return F.exists(col, lambda x: self.has_special(x, dtype.elementType))
        if isinstance(dtype, T.MapType):
            return F.exists(F.map_values(col), lambda x: self.has_special(x, dtype.valueType))
        if isinstance(dtype, T.BinaryType):
            return F.octet_length(col) == 0
        return F.isnan(col) | (F.abs(col) == float("inf"))

    def known(self, col: Column, dtype: T.DataType) -> Column:
        """True where the first pass's reading of a field of a corrupt record can be relied on.

        A value it could not read is null, and so is a list or map with such a value in it.
        """
        present = col.isNotNull()
        if _contains(dtype, (T.StructType,)):
            return F.lit(False)  # a name may be repeated inside
        if isinstance(dtype, (T.ArrayType, T.MapType)):
            inner = dtype.elementType if isinstance(dtype, T.ArrayType) else dtype.valueType
            if isinstance(inner, (T.StructType, T.ArrayType, T.MapType)):
                items = col if isinstance(dtype, T.ArrayType) else F.map_values(col)
                return present & F.forall(items, lambda x: self.known(x, inner))
        odd = self.has_special(col, dtype)
        return present if odd is None else present & ~F.coalesce(odd, F.lit(False))

    def may_repeat(self, text: Column, schema: T.StructType) -> Column | None:
        """True where the name of a date or timestamp field, or of a field that holds one, stands in a text twice.

        The first pass sees the last of several values alone, and does not tell a bad date before it.
        """
        names = _names_above(schema, _TEMPORAL)
        return self._twice(text, names) if names else None

    @staticmethod
    def _twice(text: Column, names: set[str]) -> Column:
        """True where one of the names may stand in a text twice; a pattern is tried only on texts that hold one twice."""
        held = F.lit(False)
        for name in sorted(names):
            held = held | (F.octet_length(F.substring_index(text, name, 2)) < F.octet_length(text))
        each = "|".join(rf"\Q{name}\E" for name in sorted(names))
        found = F.regexp_extract_all(text, F.lit(rf"""(?<![A-Za-z0-9_])({each})["']?\s*:"""), F.lit(1))
        return F.when(held, _let(found, lambda xs: (F.size(xs) > 1) & (F.size(xs) > F.size(F.array_distinct(xs))))).otherwise(False)

    # -- exact pass ------------------------------------------------------------------

    def suspect_record(
        self, text: Column, schema: T.StructType, settled: Mapping[str, tuple[Column, Column]]
    ) -> Column:
        """A record the first pass could not read: one reading by tokens, or the exact one where that does not do."""
        exact = self.exact_record(text, schema, settled)
        if self.has_options or any(set(name) & set("\"'\\") for name in _names(schema)):
            return exact  # comments, say, or quotes may stand where names_once looks
        by_token = F.when(self.names_once(text, schema), self.from_json(text, self.token_type(schema), corrupt=True))
        return _let(
            by_token,
            lambda r: F.when(
                r.isNotNull() & r.getField(_CORRUPT).isNull(),
                _let(F.struct(*[self.by_token(r.getField(f.name), f.dataType).alias(f.name) for f in schema]),
                     lambda fs: self._record(fs, schema)),
            ).otherwise(exact),
        )

    def names_once(self, text: Column, schema: T.StructType) -> Column:
        """True where no name of the schema, at any level, can stand in a text twice."""
        return ~F.contains(text, F.lit("\\")) & ~self._twice(text, _names(schema))  # escapes may spell a name otherwise

    def token_type(self, dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.StructType):
            return T.StructType([T.StructField(f.name, self.token_type(f.dataType)) for f in dtype])
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(self.token_type(dtype.elementType))
        if isinstance(dtype, T.MapType):
            return T.MapType(T.StringType(), self.token_type(dtype.valueType))
        return dtype if isinstance(dtype, T.StringType) else T.VariantType()

    def by_token(self, col: Column, dtype: T.DataType) -> Column:
        """struct<v, bad> of a value read as ``token_type``."""
        if isinstance(dtype, T.StringType):
            return F.struct(col.alias("v"), F.lit(False).alias("bad"))
        if isinstance(dtype, T.StructType):
            return _let(
                F.struct(*[self.by_token(col.getField(f.name), f.dataType).alias(f.name) for f in dtype]),
                lambda fs: F.struct(
                    F.when(col.isNotNull(), self._values(fs, dtype)).cast(dtype).alias("v"),
                    self._any_bad(fs, dtype).alias("bad"),
                ),
            )
        if isinstance(dtype, T.ArrayType):
            return _let(
                F.transform(col, lambda x: self.by_token(x, dtype.elementType)),
                lambda xs: F.struct(
                    F.transform(xs, lambda x: x.getField("v")).cast(dtype).alias("v"),
                    F.coalesce(F.exists(xs, lambda x: x.getField("bad")), F.lit(False)).alias("bad"),
                ),
            )
        if isinstance(dtype, T.MapType):
            return _let(
                F.transform_values(col, lambda _, x: self.by_token(x, dtype.valueType)),
                lambda m: F.struct(
                    F.transform_values(m, lambda _, x: x.getField("v")).cast(dtype).alias("v"),
                    F.coalesce(
                        F.exists(F.map_values(m), lambda x: x.getField("bad")), F.lit(False)
                    ).alias("bad"),
                ),
            )
        return self.exact(F.try_variant_get(col, "$", "string"), col, dtype)

    def exact_record(
        self, text: Column, schema: T.StructType, settled: Mapping[str, tuple[Column, Column]]
    ) -> Column:
        return _let(
            self._two_readings(text, corrupt=True),
            lambda r: F.when(
                r.getField(_CORRUPT).isNotNull(),
                F.struct(
                    F.lit(None).cast(schema).alias("row"),
                    F.lit(True).alias("malformed"),
                    F.array().cast("array<string>").alias("bad_fields"),
                ),
            ).otherwise(_let(self._exact_fields(r, schema, settled), lambda fs: self._record(fs, schema))),
        )

    def _record(self, fields: Column, schema: T.StructType) -> Column:
        """Outcome of a record whose fields are decided."""
        bad = [F.when(fields.getField(n).getField("bad"), F.lit(n)) for n in schema.fieldNames()]
        return F.struct(
            self._values(fields, schema).cast(schema).alias("row"),
            F.lit(False).alias("malformed"),
            F.array_compact(F.array(*bad)).alias("bad_fields"),
        )

    def _two_readings(self, text: Column, corrupt: bool = False) -> Column:
        """An object's entries as (name, text, token), repeated names included; whether it is broken."""
        by_text = F.map_entries(self.from_json(text, T.MapType(T.StringType(), T.StringType())))
        by_token = F.map_entries(self.from_json(text, T.MapType(T.StringType(), T.VariantType())))
        entries = F.zip_with(
            by_text,
            by_token,
            lambda a, k: F.struct(
                a.getField("key").alias("n"), a.getField("value").alias("a"), k.getField("value").alias("k")
            ),
        )
        parts = [entries.alias("entries")]
        if corrupt:
            nothing = T.StructType([])
            parts.append(self.from_json(text, nothing, corrupt=True).getField(_CORRUPT).alias(_CORRUPT))
        return F.struct(*parts)

    def _exact_fields(
        self,
        readings: Column,
        schema: T.StructType,
        settled: Mapping[str, tuple[Column, Column]] | None = None,
    ) -> Column:
        """struct<v, bad> of each field: bad if any of its values is, else the last of them."""
        entries = readings.getField("entries")
        return F.struct(*[self._exact_field(entries, f, (settled or {}).get(f.name)).alias(f.name) for f in schema])

    def _exact_field(self, entries: Column, f: T.StructField, settled: tuple[Column, Column] | None) -> Column:
        nothing = F.struct(F.lit(None).cast(f.dataType).alias("v"), F.lit(False).alias("bad"))

        def last_of(found: Column) -> Column:
            decided = F.struct(
                F.element_at(found, -1).getField("v").cast(f.dataType).alias("v"),
                F.exists(found, lambda x: x.getField("bad")).alias("bad"),
            )
            return F.when(F.size(found) > 0, decided).otherwise(nothing)

        def decide(own: Column) -> Column:
            each = F.transform(own, lambda e: self.exact(e.getField("a"), e.getField("k"), f.dataType))
            found = _let(each, last_of)
            if settled is None:
                return found
            known, outcome = settled
            # Of a repeated field the first pass may have kept a value that is not the last.
            return F.when(known & (F.size(own) < 2), outcome).otherwise(found)

        return _let(F.filter(entries, lambda e: e.getField("n") == f.name), decide)

    @staticmethod
    def _any_bad(fields: Column, schema: T.StructType) -> Column:
        found = F.lit(False)
        for name in schema.fieldNames():
            found = found | fields.getField(name).getField("bad")
        return found

    @staticmethod
    def _values(fields: Column, schema: T.StructType) -> Column:
        return F.struct(*[fields.getField(n).getField("v").alias(n) for n in schema.fieldNames()])

    def exact(self, text: Column, variant: Column, dtype: T.DataType) -> Column:
        """struct<v, bad> of one value, decided from its token type."""
        if isinstance(dtype, T.StringType):
            return F.struct(text.alias("v"), F.lit(False).alias("bad"))
        return _let(
            F.struct(text.alias("a"), variant.alias("k"), F.schema_of_variant(variant).alias("kind")),
            lambda x: self._exact_token(x.getField("a"), x.getField("k"), x.getField("kind"), dtype),
        )

    def _exact_token(self, text: Column, variant: Column, kind: Column, dtype: T.DataType) -> Column:
        absent = _is_nothing(kind, text)
        nothing = F.struct(F.lit(None).cast(dtype).alias("v"), F.lit(False).alias("bad"))
        wrong = F.struct(F.lit(None).cast(dtype).alias("v"), F.lit(True).alias("bad"))
        is_object = kind.startswith("OBJECT")

        if isinstance(dtype, T.StructType):
            found = _let(
                self._two_readings(text),
                lambda r: _let(
                    self._exact_fields(r, dtype),
                    lambda fs: F.struct(
                        self._values(fs, dtype).cast(dtype).alias("v"),
                        self._any_bad(fs, dtype).alias("bad"),
                    ),
                ),
            )
            return F.when(absent, nothing).when(is_object, found).otherwise(wrong)

        if isinstance(dtype, T.ArrayType):
            # An object where a list is expected stands for a list of one.
            items = F.when(is_object, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
            found = _let(
                F.zip_with(
                    self.from_json(items, T.ArrayType(T.StringType())),
                    self.from_json(items, T.ArrayType(T.VariantType())),
                    lambda a, k: self.exact(a, k, dtype.elementType),
                ),
                lambda xs: F.struct(
                    F.transform(xs, lambda x: x.getField("v")).cast(dtype).alias("v"),
                    F.exists(xs, lambda x: x.getField("bad")).alias("bad"),
                ),
            )
            is_list = kind.startswith("ARRAY")
            return F.when(absent, nothing).when(is_list | is_object, found).otherwise(wrong)

        if isinstance(dtype, T.MapType):
            # transform_values keeps a key that occurs twice; building a new map would not.
            if isinstance(dtype.valueType, T.StringType):
                entries = F.transform_values(
                    self.from_json(text, T.MapType(T.StringType(), T.StringType())),
                    lambda _, v: F.struct(v.alias("v"), F.lit(False).alias("bad")),
                )
            else:
                entries = F.transform_values(
                    self.from_json(text, T.MapType(T.StringType(), T.VariantType())),
                    lambda _, v: self.exact(_variant_text(v), v, dtype.valueType),
                )
            found = _let(
                entries,
                lambda m: F.struct(
                    F.transform_values(m, lambda _, x: x.getField("v")).cast(dtype).alias("v"),
                    F.exists(F.map_values(m), lambda x: x.getField("bad")).alias("bad"),
                ),
            )
            return F.when(absent, nothing).when(is_object, found).otherwise(wrong)

        return F.when(absent, nothing).otherwise(
            _let(
                self._exact_scalar(text, variant, kind, dtype),
                lambda v: F.struct(v.alias("v"), v.isNull().alias("bad")),
            )
        )

    def _exact_scalar(self, text: Column, variant: Column, kind: Column, dtype: T.DataType) -> Column:
        is_text = kind == "STRING"
        is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        if isinstance(dtype, _TEMPORAL):
            return self.temporal(kind, text, dtype)
        if isinstance(dtype, T.ByteType):
            # An unsigned byte is accepted and wraps, as the JSON reader itself does.
            number = F.try_variant_get(variant, "$", "bigint")
            wrapped = F.when(number.between(128, 255), number - 256).otherwise(number)
            return F.when(kind == "BIGINT", wrapped.try_cast(dtype))
        if isinstance(dtype, _INTEGRAL):
            return F.when(kind == "BIGINT", F.try_variant_get(variant, "$", dtype.simpleString()))
        if isinstance(dtype, _FLOATING):
            number = F.try_variant_get(variant, "$", "double")
            return F.when(is_number, number).when(is_text, self.special_float(text)).cast(dtype)
        if isinstance(dtype, T.DecimalType):
            quoted = F.when(F.trim(text) == text, text.try_cast(dtype))
            number = F.try_variant_get(variant, "$", dtype.simpleString())
            return F.when(is_number, number).when(is_text, quoted)
        if isinstance(dtype, T.BooleanType):
            return F.when(kind == "BOOLEAN", F.try_variant_get(variant, "$", "boolean"))
        if isinstance(dtype, T.BinaryType):
            one_field = T.StructType([T.StructField("v", dtype)])
            again = F.to_json(F.struct(variant.alias("v")))
            return F.when(is_text, self.from_json(again, one_field).getField("v"))
        raise ValueError(f"events cannot hold values of type {dtype.simpleString()}")

    # -- root ------------------------------------------------------------------------

    def root_elements(self, body: Column) -> Column:
        """Elements of a body that is a JSON list; the body itself otherwise."""
        elements = F.zip_with(
            self.from_json(body, T.ArrayType(T.StringType())),
            self.from_json(body, T.ArrayType(T.VariantType())),
            # A text element keeps its quotes, so it is not taken for an object.
            lambda a, k: F.when(F.schema_of_variant(k) == "STRING", F.to_json(k))
            .when(F.schema_of_variant(k) == "VOID", F.lit("null"))
            .otherwise(a),
        )
        is_list = F.ltrim(body).startswith("[")
        return F.coalesce(F.when(is_list, elements), F.array(body))


def _variant_text(variant: Column) -> Column:
    return F.when(
        F.schema_of_variant(variant) == "STRING", F.try_variant_get(variant, "$", "string")
    ).otherwise(F.to_json(variant))
