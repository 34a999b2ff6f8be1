"""Column expressions shared by all operators.

Everything here builds a ``Column`` (JVM side, whole-stage codegen); nothing
runs Python per row. Helpers that take a DataFrame only look at its schema,
which is plan-time metadata.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException, ParseException

log = logging.getLogger(__name__)

# Java's String.trim() strips every char at or below U+0020.
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))

# The placeholder shape ``${KEY}``.
PLACEHOLDER_SPLIT = r"\$\{[^}]+\}"
PLACEHOLDER_KEY = r"\$\{([^}]+)\}"

# Period format; the source SQL's TO_CHAR 'YYYYMM'.
PERIOD_FORMAT = "yyyyMM"


def qcol(name: str) -> Column:
    """Column by exact name, safe for names holding dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def java_trim_str(s: str | None) -> str | None:
    """Driver-side twin of :func:`jtrim` for config values."""
    return None if s is None else s.strip(_JAVA_TRIM_CHARS)


def jtrim(c: Column) -> Column:
    """Trim as Java does: leading and trailing chars <= U+0020 (tabs, newlines, NUL).

    ``btrim`` with that character set: a codegen'd scan of the two ends, no regex.
    """
    return F.btrim(c, F.lit(_JAVA_TRIM_CHARS))


def as_text(c: Column) -> Column:
    """Value to string, Spark's forms (T12: no trailing ``.0`` on timestamps)."""
    return c.cast("string")


_NOTHING_TO_TRIM = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def trimmed_text(df: DataFrame, name: str) -> Column:
    """``jtrim`` of a column's text. ``btrim`` looks every end up in its character set, so only text that begins or ends
    with a byte up to 0x20 goes through it; numbers and times never do."""
    c = as_text(qcol(name))
    if isinstance(df.schema[name].dataType, _NOTHING_TO_TRIM):
        return c
    end = lambda at: F.substring(c.cast("binary"), at, 1) > F.lit(bytes([0x20]))
    return F.when(end(1) & end(-1), c).otherwise(jtrim(c))


# Date tokens of the source database's TO_CHAR and Spark's letters for them; None: Spark has none.
TO_CHAR_TOKENS = {"YYYY": "yyyy", "YY": "yy", "MM": "MM", "DDD": "DDD", "DD": "dd", "HH24": "HH", "HH12": "hh", "HH": "hh", "MI": "mm",
                  "SS": "ss", "MS": "SSS", "US": "SSSSSS", "Q": "q", "AM": "a", "PM": "a", "Y,YYY": None, "YYY": None, "IYYY": None,
                  "IW": None, "WW": None, "W": None, "J": None, "CC": None, "TZ": None, "OF": None, "FM": None, "TH": None}
# Quoted text and comments of SQL.
_QUOTED = r"""'(?:[^']|'')*' | "[^"]*" | --[^\n]* | /\*.*?\*/"""
_TO_CHAR = re.compile(_QUOTED + r" | (?P<call>\bTO_CHAR\s*\()", re.IGNORECASE | re.DOTALL | re.VERBOSE)
_ARGUMENT = re.compile(_QUOTED + r" | [(),]", re.DOTALL | re.VERBOSE)
_FORMAT = re.compile(r'"(?P<text>[^"]*)" | (?P<token>%s) | (?P<word>[A-Za-z]+) | (?P<plain>.)'
                     % "|".join(sorted(TO_CHAR_TOKENS, key=len, reverse=True)), re.IGNORECASE | re.DOTALL | re.VERBOSE)
_AT_ZONE = re.compile(r"^(?P<value>.*\S)\s+AT\s+TIME\s+ZONE\s+(?P<zone>'[^']*')$", re.IGNORECASE | re.DOTALL)


def _arguments(sql: str, at: int) -> tuple[list[str], int] | None:
    """The arguments of a call whose ``(`` ends at ``at``, and where it ends; None if it never closes."""
    depth, out, start = 0, [], at
    for m in _ARGUMENT.finditer(sql, at):
        if m[0] == "(":
            depth += 1
        elif m[0] == ")" and depth:
            depth -= 1
        elif m[0] in (",", ")") and not depth:
            out.append(sql[start:m.start()].strip())
            start = m.end()
            if m[0] == ")":
                return out, m.end()
    return None


def date_pattern(fmt: str) -> str:
    """Spark's pattern for a TO_CHAR format; raises for what Spark cannot write."""
    out, tokens = [], 0
    for m in _FORMAT.finditer(fmt):
        if m["token"]:
            letters = TO_CHAR_TOKENS[m["token"].upper()]
            if letters is None:
                raise ValueError(f"TO_CHAR format {fmt!r}: Spark has no {m['token']!r}")
            out.append(letters)
            tokens += 1
        elif m["word"]:
            raise ValueError(f"TO_CHAR format {fmt!r}: {m['word']!r} is not known")
        else:
            text = m["plain"] if m["text"] is None else m["text"]
            plain = m["text"] is None and (text.isdigit() or text in " -/:.,;_")
            out.append(text if plain else "'" + text.replace("'", "''") + "'" if text else "")
    if not tokens:
        raise ValueError(f"TO_CHAR format {fmt!r} is not one of dates")
    return "".join(out)


def translate_to_char(sql: str) -> str:
    """``TO_CHAR(x, 'YYYYMM')`` of the reports' own database as ``date_format(x, 'yyyyMM')``.

    ``x`` is any expression, other TO_CHAR calls and quoted text included; ``x AT TIME ZONE 'z'`` is the local time of an
    instant, or the instant (in UTC) of a zone-less time. Calls whose format is not a literal are left to Spark.
    """
    out, at = [], 0
    while (m := _TO_CHAR.search(sql, at)) is not None:
        call = _arguments(sql, m.end()) if m["call"] else None
        if call is None or len(call[0]) != 2 or not re.fullmatch(r"'(?:[^']|'')*'", call[0][1]):
            out.append(sql[at:m.end()])
            at = m.end()
            continue
        (value, fmt), end = call
        value = translate_to_char(value)
        if (zone := _AT_ZONE.match(value)) is not None:
            v, z = zone["value"], zone["zone"]
            value = f"if(typeof({v}) = 'timestamp_ntz', to_utc_timestamp({v}, {z}), from_utc_timestamp({v}, {z}))"
        pattern = date_pattern(fmt[1:-1].replace("''", "'")).replace("\\", "\\\\").replace("'", "\\'")
        out += [sql[at:m.start()], f"date_format({value}, '{pattern}')"]
        at = end
    return "".join(out) + sql[at:]


# What may stand around a comparison so that it is a condition of its own.
_ABOVE = re.compile(_QUOTED + r""" | (?P<lead>\b(?:WHERE|AND|OR|NOT|ON|WHEN|HAVING)\b|\()(?P<gap>\s*)
    (?P<column>[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)\s*>\s*:\#?lastSyncTimestamp\b
    (?=\s*(?:\)|;|$|--|/\*|(?:AND|OR|THEN|GROUP|ORDER|HAVING|LIMIT|UNION)\b))""", re.IGNORECASE | re.DOTALL | re.VERBOSE)


def bound_above(sql: str) -> str:
    """``column > :#lastSyncTimestamp`` with the upper bound ``column <= :asOf``."""
    return _ABOVE.sub(lambda m: m[0] if m["column"] is None else
                      f"{m['lead']}{m['gap']}({m['column']} > :lastSyncTimestamp AND {m['column']} <= :asOf)", sql)


def resolve_column(columns: Sequence[str], key: str | None) -> str | None:
    """Find a result column: exact name first, then ignoring case.

    Two columns that differ only by case are ambiguous in Spark, so they are
    rejected instead of silently picking one.
    """
    if key is None:
        return None
    if key in columns:
        return key
    hits = [c for c in columns if c.lower() == key.lower()]
    if len(hits) > 1:
        raise ValueError(f"column {key!r} is ambiguous: {hits}")
    return hits[0] if hits else None


def first_present(columns: Sequence[str], aliases: Sequence[str]) -> list[str]:
    """Resolved names of the aliases that exist, in alias order, without repeats."""
    out: list[str] = []
    for a in aliases:
        r = resolve_column(columns, a)
        if r is not None and r not in out:
            out.append(r)
    return out


def coalesce_aliases(df: DataFrame, aliases: Sequence[str]) -> Column:
    """First non-null of the alias columns that exist, as trimmed text."""
    names = first_present(df.columns, aliases)
    if not names:
        return F.lit(None).cast("string")
    return jtrim(F.coalesce(*[as_text(qcol(n)) for n in names]))


def column_or_const(df: DataFrame, key: str | None, null_key: str = "reject") -> Column:
    """A grouping key: the named column's trimmed text, else the key itself as a constant.

    ``null_key="reject"`` leaves a null column value null so the row is
    rejected; ``"name"`` falls back to the key text, as the original job did (T6).
    """
    if key is None:
        return F.lit(None).cast("string")
    name = resolve_column(df.columns, key)
    const = F.lit(java_trim_str(key))
    if name is None:
        return const
    v = trimmed_text(df, name)
    if null_key == "name":
        return F.coalesce(v, const)
    if null_key != "reject":
        raise ValueError(f"null_key must be 'reject' or 'name', got {null_key!r}")
    return v


def coc_expr(df: DataFrame, cfg: str | None, legacy_fallback: bool = False) -> Column:
    """Category option combo: column value, else constant; ``default`` means none.

    With a column named by ``cfg`` whose value is null/blank/``default`` the
    combo is dropped; ``legacy_fallback=True`` emits the config text instead (T11).
    """
    null = F.lit(None).cast("string")
    t = java_trim_str(cfg)
    if t is None or t == "":
        return null
    const = null if t.lower() == "default" else F.lit(t)
    name = resolve_column(df.columns, cfg)
    if name is None:
        return const
    cv = trimmed_text(df, name)
    good = cv.isNotNull() & (cv != "") & (F.lower(cv) != "default")
    return F.when(good, cv).otherwise(const if legacy_fallback else null)


def truthy(c: Column, dtype: T.DataType) -> Column:
    """Groovy truth: null, '', 0, false and empty arrays/maps are false."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.StringType):
        return c.isNotNull() & (c != "")
    if isinstance(dtype, T.NumericType):
        return c.isNotNull() & (c != 0)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def elvis(c: Column, dtype: T.DataType, default: Column | str) -> Column:
    """``x ?: default``."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.when(truthy(c, dtype), c).otherwise(d)


def string_value_of(c: Column) -> Column:
    """``String.valueOf(x)``: null prints as ``"null"``."""
    return F.coalesce(as_text(c), F.lit("null"))


def needs_row_struct(text: str | None) -> bool:
    return bool(text) and re.search(r"\brow\s*\.", text) is not None


def with_row_struct(df: DataFrame) -> DataFrame:
    """Expose the whole row as ``row`` for filters written as ``row.<col>``.

    Catalyst folds ``struct(...).x`` back to ``x``, so unused fields are pruned.
    """
    if "row" in df.columns:
        return df
    return df.withColumn("row", F.struct(*[qcol(c) for c in df.columns]))


def boolean_filter(df: DataFrame, text: str | None) -> Column:
    """Per-mapping row filter (F6): true keeps; false, null, non-boolean or error drops.

    The filter is a Spark SQL boolean expression over the row's columns (pass a
    frame from :func:`with_row_struct` to also allow ``row.<col>``). A blank
    filter keeps every row. A filter that does not parse or resolve, or is not
    boolean, becomes constant false with a warning (T9, T10).
    """
    if text is None or java_trim_str(text) == "":
        return F.lit(True)
    try:
        e = F.expr(text)
        dtype = df.select(e.alias("_f")).schema["_f"].dataType
    except (AnalysisException, ParseException) as err:
        log.warning("filter %r is not usable, rows dropped: %s", text, err)
        return F.lit(False)
    if not isinstance(dtype, T.BooleanType):
        log.warning("filter %r is %s, not boolean: rows dropped", text, dtype.simpleString())
        return F.lit(False)
    return F.coalesce(e, F.lit(False))


def filter_flag(i: int) -> str:
    """Name of the column that says whether mapping ``i`` keeps a row."""
    return f"_keep_{i}"


@contextmanager
def _null_on_error(spark: SparkSession) -> Iterator[None]:
    """Expressions analysed inside give null for a bad cast or division instead of failing the job.

    Spark settles this when an expression is analysed, so only the projections
    made inside are affected; the session's setting is put back.
    """
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def with_filter_flags(df: DataFrame, filters: Sequence[str | None]) -> DataFrame:
    """The rows with one boolean column for each filter (F6), all in one projection.

    A filter that fails on a row (a bad cast, a division by zero) is false for
    that row only (T10).
    """
    src = with_row_struct(df) if any(needs_row_struct(f) for f in filters) else df
    with _null_on_error(df.sparkSession):
        return src.withColumns({filter_flag(i): boolean_filter(src, f) for i, f in enumerate(filters)})


def variables_map(variables: Mapping[str, str] | None) -> Column:
    """``map<string,string>`` literal of the placeholder variables."""
    if not variables:
        return F.create_map().cast("map<string,string>")
    kv: list[Column] = []
    for k, v in variables.items():
        kv += [F.lit(str(k)), F.lit(None if v is None else str(v)).cast("string")]
    return F.create_map(*kv)


def resolve_placeholders(c: Column, variables: Mapping[str, str] | None,
                         allow_default: bool = False) -> Column:
    """Replace ``${KEY}`` by its variable; unknown keys stay verbatim.

    Inserted values are not scanned again. ``allow_default=True`` also reads
    ``${KEY:fallback}`` (T3); by default the whole ``KEY:fallback`` is the key.
    """
    m = variables_map(variables)
    parts = F.split(c, PLACEHOLDER_SPLIT, -1)
    keys = F.regexp_extract_all(c, F.lit(PLACEHOLDER_KEY), 1)

    # zip_with pairs each text piece with the key after it (null after the last
    # piece), so the key list is computed once per row, not once per element.
    def piece(p: Column, k: Column) -> Column:
        if allow_default:
            has = F.instr(k, ":") > 0
            name = F.when(has, F.substring_index(k, ":", 1)).otherwise(k)
            dflt = F.when(has, F.substr(k, F.instr(k, ":") + 1))
            found = F.coalesce(F.try_element_at(m, name), dflt)
        else:
            found = F.try_element_at(m, k)
        repl = F.when(k.isNull(), F.lit("")).otherwise(
            F.coalesce(found, F.concat(F.lit("${"), k, F.lit("}"))))
        return F.concat(p, repl)

    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.zip_with(parts, keys, piece), ""))


_BIND_RE = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/|:#([A-Za-z_][A-Za-z0-9_]*)", re.DOTALL)


def bind_style(sql: str) -> str:
    """``:#name`` (route style) to ``:name`` (Spark named parameter), outside quotes and comments."""
    return _BIND_RE.sub(lambda m: ":" + m.group(1) if m.group(1) else m.group(0), sql)
