"""Document shapes: attributed lines -> documents (DataFrame -> DataFrame).

Input is the attributed-line table ``path string, offset bigint, line string``
(plus optional columns).  Every shape is a projection, so it fuses into the
scan's whole-stage-codegen stage; no shape shuffles.

Pluggable builders (UDF1/UDF2): a builder is a named ``DataFrame ->
DataFrame`` function together with the schema it promises.  Built-in entries
cover every shape; users register their own with ``register_builder``, and
free-form Python logic enters through ``python_builder`` (``mapInPandas``,
Arrow batches, one call per batch, never per row).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import detect_date, event_time, iso_text, strip_scheme_host, strip_scheme_prefix

OFFSET_DOC = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("line", T.StringType()),
])
LINE_DOC = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("line", T.StringType()),
])
DATED_DOC = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("offset", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("line", T.StringType()),
])
DATED_TYPED_DOC = T.StructType([*DATED_DOC.fields, T.StructField("event_time", T.TimestampNTZType())])
MAP_DOC = T.StructType([T.StructField("doc", T.MapType(T.StringType(), T.StringType()))])
STREAM_LINE = T.StructType([T.StructField("line", T.StringType())])
STREAM_DATED_LINE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("line", T.StringType()),
])


def offset_documents(df: DataFrame) -> DataFrame:
    """DOC1 (default): path without scheme/host, offset, line."""
    return df.select(strip_scheme_host("path").alias("path"),
                     F.col("offset").cast("bigint").alias("offset"), "line")


def line_documents(df: DataFrame) -> DataFrame:
    """DOC2: path and line, no offset."""
    return df.select(strip_scheme_host("path").alias("path"), "line")


def prefix_stripped_documents(df: DataFrame) -> DataFrame:
    """DOC3: DOC1 with the weaker prefix-only path stripping (STR2)."""
    return df.select(strip_scheme_prefix("path").alias("path"),
                     F.col("offset").cast("bigint").alias("offset"), "line")


def map_document(path: Column, line: Column, offset: Column | None = None,
                 date: Column | None = None) -> Column:
    """DOC4: ``map<string,string>``; ``offset`` only if > -1, ``date`` only if not null.

    Written as a choice between fixed-shape maps rather than a filter over
    one map: higher-order functions run interpreted, while this stays in
    whole-stage codegen together with whatever computed the inputs.
    """
    base = [F.lit("path"), path, F.lit("line"), line]
    opt = []
    if offset is not None:
        opt.append((offset > -1, [F.lit("offset"), offset.cast("string")]))
    if date is not None:
        opt.append((date.isNotNull(), [F.lit("date"), date]))
    out = None
    # every subset of the optional keys, largest first
    for mask in range(2 ** len(opt) - 1, -1, -1):
        chosen = [opt[i] for i in range(len(opt)) if mask >> i & 1]
        cond = F.lit(True)
        for i, (c, _) in enumerate(opt):
            cond = cond & (c if mask >> i & 1 else ~c)
        kv = base + [x for _, pair in chosen for x in pair]
        m = F.create_map(*kv)
        out = F.when(cond, m) if out is None else out.when(cond, m)
    return out.otherwise(F.create_map(*base))


def map_documents(df: DataFrame) -> DataFrame:
    """DOC4 over attributed lines (a ``date`` column is used when present)."""
    date = F.col("date") if "date" in df.columns else None
    return df.select(map_document(strip_scheme_host("path"), F.col("line"),
                                  F.col("offset"), date).alias("doc"))


def dated_documents(df: DataFrame) -> DataFrame:
    """DOC5/DOC6: path, offset, detected date (nullable), line.

    One projection gives both shapes: JSON writers drop the null ``date`` of
    a line without a date, which is the undated document.
    """
    return df.select(strip_scheme_host("path").alias("path"),
                     F.col("offset").cast("bigint").alias("offset"),
                     detect_date(F.col("line")).alias("date"), "line")


def dated_documents_typed(df: DataFrame) -> DataFrame:
    """DOC5 plus a typed ``event_time`` column for range queries (RET7)."""
    ts = event_time(F.col("line"), bind=True)
    return df.select(strip_scheme_host("path").alias("path"),
                     F.col("offset").cast("bigint").alias("offset"),
                     iso_text(ts).alias("date"), "line", ts.alias("event_time"))


def stream_line_documents(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """DOC7: a stream message becomes ``{line}`` (after the columns ``keep``)."""
    return df.select(*keep, F.col(value_col).cast("string").alias("line"))


def stream_dated_line_documents(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """DOC6 for streams: ``{date, line}`` (after ``keep``), date null when none is found."""
    line = F.col(value_col).cast("string")
    return df.select(*keep, detect_date(line).alias("date"), line.alias("line"))


def json_source(*cols: str) -> Column:
    """DOC8: JSON object with the given fields in order (nulls dropped)."""
    return F.to_json(F.struct(*cols))


def json_documents(df: DataFrame, fields: tuple[str, ...] = ("path", "offset", "line")) -> DataFrame:
    """DOC8: one JSON text per document, field order as given."""
    return df.select(json_source(*fields).alias("source"))


def pair_text(key: Column, value: Column) -> Column:
    """DOC10: ``(key,value)``; a null key or value renders as ``null``."""
    return F.format_string("(%s,%s)", key.cast("string"), value.cast("string"))


# --- registry (UDF1 / UDF2) -------------------------------------------------

@dataclass(frozen=True)
class DocumentBuilder:
    name: str
    build: Callable[[DataFrame], DataFrame]
    schema: T.StructType


_REGISTRY: dict[str, DocumentBuilder] = {}


def register_builder(name: str, build: Callable[[DataFrame], DataFrame],
                     schema: T.StructType) -> DocumentBuilder:
    b = DocumentBuilder(name, build, schema)
    _REGISTRY[name] = b
    return b


def builder(name: str) -> DocumentBuilder:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown document builder {name!r}; known: {sorted(_REGISTRY)}") from None


def builders() -> list[str]:
    return sorted(_REGISTRY)


def python_builder(name: str, fn: Callable, schema: T.StructType | str) -> DocumentBuilder:
    """Register free Python logic: ``fn(pandas.DataFrame) -> pandas.DataFrame``.

    Runs once per Arrow batch through ``mapInPandas``; the input batch has the
    attributed-line columns.
    """
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def build(df: DataFrame) -> DataFrame:
        def run(batches):
            for pdf in batches:
                yield fn(pdf)
        return df.mapInPandas(run, st)

    return register_builder(name, build, st)


def jvm_builder(name: str, columns: dict[str, str | tuple[str, str, tuple[str, ...]]]) -> DocumentBuilder:
    """Register a builder whose columns static methods of JVM classes give, named as text: the classes are looked
    up where the lines are, on the cluster's class path, and no Python worker runs.

    ``columns``: an input column, or (class, method, input columns); a method takes strings, numbers or booleans, and its result is
    text, null if an input is.  A class or method that does not exist, or does not fit, is an error when the plan is made."""
    def build(df: DataFrame) -> DataFrame:
        out = []
        for column, how in columns.items():
            if isinstance(how, str):
                out.append(F.col(how).alias(column))
            else:
                of, method, inputs = how
                given = reduce(and_, [F.col(c).isNotNull() for c in inputs], F.lit(True))
                out.append(F.when(given, F.java_method(F.lit(of), F.lit(method), *[F.col(c) for c in inputs])).alias(column))
        return df.select(*out)

    known = {f.name: f.dataType for f in OFFSET_DOC.fields}
    schema = T.StructType([T.StructField(c, known[how] if isinstance(how, str) else T.StringType()) for c, how in columns.items()])
    return register_builder(name, build, schema)


def _same_fields(a: T.StructType, b: T.StructType) -> bool:
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def to_documents(df: DataFrame, builder_name: str = "offset") -> DataFrame:
    """Apply a registered builder and check it returns what it declared (UDF2)."""
    b = builder(builder_name)
    out = b.build(df)
    if not _same_fields(out.schema, b.schema):
        raise TypeError(f"builder {b.name!r} returned {out.schema.simpleString()}, "
                        f"declared {b.schema.simpleString()}")
    return out


register_builder("offset", offset_documents, OFFSET_DOC)
register_builder("no_offset", line_documents, LINE_DOC)
register_builder("prefix_offset", prefix_stripped_documents, OFFSET_DOC)
register_builder("map", map_documents, MAP_DOC)
register_builder("dated", dated_documents, DATED_DOC)
register_builder("dated_typed", dated_documents_typed, DATED_TYPED_DOC)
register_builder("stream_line", stream_line_documents, STREAM_LINE)
register_builder("stream_dated_line", stream_dated_line_documents, STREAM_DATED_LINE)

#: Built-in builders that read no offset: one pass over the files is enough.
WITHOUT_OFFSET = {"no_offset", "stream_line", "stream_dated_line"}
