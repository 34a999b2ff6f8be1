"""Delivery as tables: JSON sink, keyed upsert, dead letters, error parsing, checks.

The original posted each set over HTTP and parsed failures out of exception
text. Here the sets are written as JSON files, the receiver's upsert is a
keyed merge over the ``data_values`` table, and failures are rows: dead
letters, cause chains and parsed status codes (S5-S7, E1-E10, A6, A7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportflow.functions.expr import jtrim
from reportflow.operators.dvs import KEYS, counted_positions, sort_parts

VALUE_KEY = ["dataSet", "period", "orgUnit", "dataElement", "categoryOptionCombo"]

# Message texts of the failure path.
SEND_FAILED = "DHIS2 send failed"
DLQ_FORMAT = "DLQ - Failed to process message after %d redeliveries. Body: %s"
UNKNOWN_REPORT = "unknown"
DETAIL_FORMAT = "Caused by (%d): %s - %s"
CONFLICT_CODE = 409
# Labels of the detail text of a failure, in its order.
DETAIL_HEAD = "\n=== DHIS2 Error Details ===\n"
DETAIL_TYPE = "Exception Type: "
DETAIL_MESSAGE = "Exception Message: "
DETAIL_STATUS = "HTTP Status Code: "
DETAIL_URL = "Request URL: "
DETAIL_REQUEST = "\nRequest Body: "
DETAIL_RESPONSE = "Response Body: "
DETAIL_CONFLICT = ("\nNOTE: HTTP 409 (Conflict) typically means the data value already exists in DHIS2.\n"
                   "This may not be a critical error - the data is already present.\n")
DETAIL_END = "===========================\n"
# Where an import report states its status.
IMPORT_STATUS_PATTERN = r'"response":\{"responseType":"ImportReport","status":"([^"]*)"'


# ---- S5: DataValueSet JSON -------------------------------------------------

def dvs_json(sets: DataFrame, complete_date: Column | None = None) -> DataFrame:
    """One JSON object per set; a null combo is left out of its leaf (to_json drops nulls)."""
    fields = [F.col(k) for k in KEYS]
    if complete_date is not None:
        fields.append(complete_date.alias("completeDate"))
    fields.append(F.col("dataValues"))
    keep = [c for c in ("report_id", *KEYS, "chunk") if c in sets.columns]
    return sets.select(*keep, F.to_json(F.struct(*fields)).alias("json"))


def write_dvs(sets: DataFrame, path: str, mode: str = "append") -> None:
    """Write sets as JSON lines, one folder per report."""
    out = sets if "json" in sets.columns else dvs_json(sets)
    (out.select("report_id", F.col("json").alias("value")).write.mode(mode)
     .partitionBy("report_id").text(path))


def document_pieces(long: DataFrame) -> DataFrame:
    """The sets' documents in pieces of one leaf: (report_id, keys, position, text), joined in order of position the JSON of the set.

    The first piece has the document's head, the last its tail. Nothing collects a set, so it may be larger than any memory.
    """
    return _counted_pieces(long)[0]


def _counted_pieces(long: DataFrame) -> tuple[DataFrame, int]:
    key = ["report_id", *KEYS]
    leaf = F.to_json(F.struct("dataElement", "value", "categoryOptionCombo"))
    # The head is the set's JSON without leaves, but for its closing braces.
    head = F.expr("regexp_replace(to_json(named_struct('dataSet', dataSet, 'period', period, 'orgUnit', orgUnit, 'dataValues', array())), '\\\\]\\\\}$', '')")
    text = F.concat(F.when(F.col("position") == 0, head).otherwise(F.lit(",")), leaf,
                    F.when(F.col("position") == F.col("set_size") - 1, F.lit("]}")).otherwise(F.lit("")))
    placed, n = counted_positions(long, key)
    return placed.select(*key, "position", text.alias("text")), n


def write_documents(long: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Each set as a folder (report, data set, period, org unit) of text files: put together in order of their names, they are
    the set's JSON document, whatever its size. Sets that fit in memory are cheaper as rows (``dvs_json``)."""
    key = ["report_id", *KEYS]
    pieces, n = _counted_pieces(long)
    (pieces.repartitionByRange(sort_parts(n), *key, "position").sortWithinPartitions(*key, "position")
     .select(*key, F.col("text").alias("value")).write.mode(mode).partitionBy(*key).text(path))


# ---- S6: keyed upsert --------------------------------------------------------

def upsert_latest(existing: DataFrame, incoming: DataFrame,
                  key: Sequence[str] = VALUE_KEY) -> DataFrame:
    """Newest value per key wins: by load_ts, then as the sets list them (mapping, row order), then by value.

    Row order is used where both sides carry it. A grouped ``max_by`` rather than a window: Spark merges map-side, so a key
    loaded many times costs one partial row per task. Null key parts group
    together, as the receiver treats a missing combo as one cell.
    """
    both = existing.unionByName(incoming, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in key]
    order = F.struct(F.col("load_ts"), F.col("mapping_idx"),
                     *([F.col("row_order")] if "row_order" in both.columns else []), F.col("value"))
    latest = both.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_r"))
    return latest.select(*key, *[F.col("_r")[c].alias(c) for c in rest])


# ---- S7, E2, E3: dead letters -----------------------------------------------

def dead_letters(failed: DataFrame, body: Column, header_report_id: Column | None = None,
                 property_report_id: Column | None = None, redeliveries: Column | None = None,
                 failed_at: Column | None = None) -> DataFrame:
    """Failed deliveries as ``dead_letters`` rows with the failure text the state records."""
    rid = F.coalesce(*(c for c in (header_report_id, property_report_id) if c is not None),
                     F.lit(UNKNOWN_REPORT))
    n = F.coalesce(redeliveries, F.lit(0)) if redeliveries is not None else F.lit(0)
    return failed.select(
        rid.alias("report_id"), body.alias("body"),
        F.format_string(DLQ_FORMAT, n.cast("int"), body).alias("error_message"),
        n.cast("int").alias("redeliveries"),
        (failed_at if failed_at is not None else F.current_timestamp()).alias("failed_at"))


# ---- E1, E7: cause chains ----------------------------------------------------

def error_chain(causes: DataFrame, id_col: str = "failure_id") -> DataFrame:
    """``"<prefix> -> m1 -> m2 ..."`` per failure, causes by depth; a null message prints ``null``.

    ``causes``: (failure_id, depth, message). A chain is one exception's causes,
    so each group is small by nature.
    """
    return (causes.groupBy(id_col)
            .agg(F.array_sort(F.collect_list(F.struct(
                F.col("depth"), F.coalesce(F.col("message"), F.lit("null")).alias("m")))).alias("_c"))
            .select(id_col, F.concat_ws(" -> ", F.lit(SEND_FAILED),
                                        F.transform("_c", lambda x: x["m"])).alias("chain")))


def error_details(causes: DataFrame, id_col: str = "failure_id", max_depth: int = 5,
                  class_col: str | None = "class_name") -> DataFrame:
    """``Caused by (n): <class> - <message>`` lines for the first ``max_depth`` causes."""
    cls = F.col(class_col) if class_col and class_col in causes.columns else F.lit("java.lang.Exception")
    return (causes.filter(F.col("depth") < max_depth)
            .select(id_col, "depth",
                    F.format_string(DETAIL_FORMAT, F.col("depth") + 1, cls,
                                    F.coalesce(F.col("message"), F.lit("null"))).alias("line")))


def error_detail_text(failures: DataFrame, causes: DataFrame, id_col: str = "failure_id",
                      max_depth: int = 5) -> DataFrame:
    """The detail text of each failure (E7): exception, status and URL out of its message, causes in order,
    both bodies, and a note on conflicts.

    ``failures``: id, class_name, message, request_body, response_body; ``causes``: id, depth, message, class_name.
    """
    lines = (error_details(causes, id_col, max_depth).groupBy(id_col)
             .agg(F.array_sort(F.collect_list(F.struct("depth", "line"))).alias("_l"))
             .select(id_col, F.transform("_l", lambda x: F.concat(x["line"], F.lit("\n"))).alias("_lines")))
    m = F.col("message")
    code = jtrim(F.regexp_extract(m, CODE_PATTERN, 1)).try_cast("int")
    text = lambda c: F.coalesce(F.col(c), F.lit("null"))
    line = lambda label, c: F.concat(F.lit(label), c.cast("string"), F.lit("\n"))
    parts = F.array(
        F.lit(DETAIL_HEAD), line(DETAIL_TYPE, F.col("class_name")), line(DETAIL_MESSAGE, text("message")),
        line(DETAIL_STATUS, code), line(DETAIL_URL, request_url(m)), F.array_join("_lines", ""),
        line(DETAIL_REQUEST, text("request_body")), line(DETAIL_RESPONSE, text("response_body")),
        F.when(code == CONFLICT_CODE, F.lit(DETAIL_CONFLICT)), F.lit(DETAIL_END))
    return failures.join(lines, id_col, "left").select(id_col, F.array_join(parts, "").alias("detail"))


# ---- E4-E6, E8-E10: parsing outcome texts ------------------------------------

CODE_PATTERN = r"code=([^,]*),"


def status_code(message: Column) -> Column:
    """Code between ``code=`` and the next comma; none, no comma or not a number gives 0."""
    raw = F.regexp_extract(message, CODE_PATTERN, 1)
    return F.coalesce(jtrim(raw).try_cast("int"), F.lit(0))


def request_url(message: Column) -> Column:
    """Text after ``url=`` up to a comma or the end, trimmed; null without ``url=``."""
    return F.when(F.instr(message, "url=") > 0, jtrim(F.regexp_extract(message, r"url=([^,]*)", 1)))


def parse_delivery_errors(errors: DataFrame, message_col: str = "message") -> DataFrame:
    m = F.col(message_col)
    code = status_code(m)
    return errors.select("*", code.alias("status_code"), request_url(m).alias("url"),
                         (code == CONFLICT_CODE).alias("is_conflict"))


def classify_status(code: Column, body: Column | None = None) -> list[Column]:
    """HTTP outcome class: 2xx ok, 409 conflict (taken as already present), else error."""
    cls = (F.when((code >= 200) & (code < 300), F.lit("ok"))
           .when(code == CONFLICT_CODE, F.lit("ok_conflict"))
           .otherwise(F.lit("error")))
    out = [cls.alias("outcome")]
    if body is not None:
        out.append(F.coalesce(body.rlike("error|Error"), F.lit(False)).alias("mentions_error"))
    return out


def import_summary(body: Column) -> list[Column]:
    """Import summary from a response body.

    Status is the import report's status; ``total``/``created``/``updated`` are
    the *last* occurrences (an empty number counts as missing). OK or WARNING
    means imported; otherwise a positive total means processed; else failed.
    """
    def last_int(field: str) -> Column:
        found = F.regexp_extract_all(body, F.lit(f'"{field}":([0-9]*)'), 1)
        return F.try_element_at(found, F.lit(-1)).try_cast("long")
    status = F.regexp_extract(body, IMPORT_STATUS_PATTERN, 1)
    status = F.when(body.rlike(IMPORT_STATUS_PATTERN), status)
    total = last_int("total")
    outcome = (F.when(status.isin("OK", "WARNING"), F.lit("imported"))
               .when(F.coalesce(total, F.lit(0)) > 0, F.lit("processed"))
               .otherwise(F.lit("failed")))
    return [status.alias("status"), total.alias("total"), last_int("created").alias("created"),
            last_int("updated").alias("updated"), outcome.alias("outcome")]


# ---- A6, A7: counts and checks ----------------------------------------------

def run_counts(rows: DataFrame, long: DataFrame) -> DataFrame:
    """Per report: result rows, leaves and sets; ``records_synced`` counts sets.

    All three come from one grouped pass: a set is a distinct key of the long form, whatever its size.
    """
    keys = F.struct(*[F.col(k) for k in KEYS])
    none = F.lit(None).cast(T.StructType([T.StructField(k, T.StringType()) for k in KEYS]))
    both = (rows.select("report_id", F.lit(1).alias("_row"), none.alias("_key"))
            .unionByName(long.select("report_id", F.lit(0).alias("_row"), keys.alias("_key"))))
    # A partial row per key first, so that the count of sets is not a distinct over all leaves.
    per_key = both.groupBy("report_id", "_key").agg(F.sum("_row").alias("_rows"), F.count(F.lit(1)).alias("_all"))
    return (per_key.groupBy("report_id")
            .agg(F.sum("_rows").alias("result_rows"), F.sum(F.col("_all") - F.col("_rows")).alias("data_values"),
                 F.count("_key").alias("data_value_sets"))
            .withColumn("records_synced", F.col("data_value_sets")))


def verify_counts(long: DataFrame, by: str) -> DataFrame:
    """Delivered leaves and sets per ``by`` (orgUnit or period), from the long form."""
    per_key = long.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(by).agg(F.sum("_n").cast("long").alias("data_values"),
                                   F.count(F.lit(1)).alias("data_value_sets"))


def failure_events(letters: DataFrame) -> DataFrame:
    """Dead letters as FAILED run events (E3): the state then folds them like any run."""
    from reportflow.operators.state import run_event
    ts = F.col("failed_at")
    return letters.select(*run_event(F.col("report_id"), F.unix_micros(ts.cast("timestamp")), ts, "FAILED",
                                     error=F.col("error_message")))


def verify_total(values: DataFrame, data_set: str, org_units: Sequence[str] | None = None,
                 periods: Sequence[str] | None = None) -> DataFrame:
    """The delivery check over stored values (A7): how many values a data set holds for the
    asked org units and periods, and a sample (the first by key order)."""
    v = values.filter(F.col("dataSet") == data_set)
    if org_units:
        v = v.filter(F.col("orgUnit").isin(list(org_units)))
    if periods:
        v = v.filter(F.col("period").isin(list(periods)))
    first = F.min(F.struct("orgUnit", "period", "dataElement", "categoryOptionCombo", "value"))
    return v.agg(F.count(F.lit(1)).alias("total_values"), first.alias("_s")).select(
        "total_values",
        F.when(F.col("_s").isNotNull(), F.to_json(F.struct(F.col("_s.dataElement").alias("dataElement"), F.col("_s.period").alias("period"),
                           F.col("_s.orgUnit").alias("orgUnit"), F.col("_s.value").alias("value"),
                           F.col("_s.categoryOptionCombo").alias("categoryOptionCombo")))).alias("sample"))


# ---- A7: reconciliation ---------------------------------------------------------

def set_digests(values: DataFrame) -> DataFrame:
    """Per set (data set, period, org unit): number of cells and two order-free sums over hashes of their content."""
    content = [F.col("dataElement"), F.col("categoryOptionCombo").isNull(), F.col("categoryOptionCombo"), F.col("value").isNull(), F.col("value")]
    hashed = lambda salt: F.xxhash64(F.lit(salt), *content).cast("decimal(38,0)")
    return values.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum(hashed(1)).alias("sum_1"), F.sum(hashed(2)).alias("sum_2"))


def verify_differences(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """Cells that the stored values hold otherwise than sent: ``lost`` (not stored), ``added`` (never sent) or ``changed``.

    Both sides hold one row per cell. Digests of the sets are compared first; only cells of sets that differ are joined, so the
    usual check, where all agree, costs one aggregation of each side and a join of their sets.
    """
    a, b = set_digests(sent).alias("a"), set_digests(stored).alias("b")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.sum_1") == F.col("b.sum_1")) & (F.col("a.sum_2") == F.col("b.sum_2"))
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEYS]
    differ = (a.join(b, on, "full").filter(~F.coalesce(same, F.lit(False)))
              .select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEYS]))

    def cells(df: DataFrame) -> DataFrame:
        d = df.alias("v").join(differ.alias("d"), [F.col(f"v.{k}").eqNullSafe(F.col(f"d.{k}")) for k in KEYS], "left_semi")
        return d.select(*VALUE_KEY, "value", F.lit(True).alias("here"))

    s, t = cells(sent).alias("s"), cells(stored).alias("t")
    both = s.join(t, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in VALUE_KEY], "full")
    kind = (F.when(F.col("t.here").isNull(), F.lit("lost")).when(F.col("s.here").isNull(), F.lit("added"))
            .when(~F.col("s.value").eqNullSafe(F.col("t.value")), F.lit("changed")))
    return (both.select(*[F.when(F.col("s.here"), F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in VALUE_KEY],
                        kind.alias("difference"), F.col("s.value").alias("sent"), F.col("t.value").alias("stored"))
            .filter(F.col("difference").isNotNull()))


# ---- E2, E3, S7: redelivery -------------------------------------------------------

def due_letters(letters: DataFrame, ledger: DataFrame, max_attempts: int) -> DataFrame:
    """Letters still to be delivered, with the number of the next attempt.

    ``letters``: letter_id and further columns; ``ledger``: letter_id, attempt, ok: every delivery tried so far. A letter
    is done with its first success, and given up after ``max_attempts``.
    """
    tried = ledger.groupBy("letter_id").agg(F.max("attempt").alias("_last"), F.max("ok").alias("_done"))
    return (letters.join(tried, "letter_id", "left")
            .filter(~F.coalesce("_done", F.lit(False)) & (F.coalesce("_last", F.lit(0)) < max_attempts))
            .withColumn("attempt", (F.coalesce("_last", F.lit(0)) + 1).cast("int")).drop("_last", "_done"))


def redelivery_events(letters: DataFrame, ledger: DataFrame, started: Column) -> DataFrame:
    """The ledger as run events: each failed attempt FAILED with the letter's text, each success SUCCESS.

    ``letters``: letter_id, report_id, body; ``ledger``: letter_id, attempt, ok, at. ``started``: the checkpoint that a success
    confirms. Later attempts have later times, so folding the log gives FAILED until a letter gets through.
    """
    from reportflow.operators.state import run_event
    rows = ledger.join(letters, "letter_id")
    text = F.format_string(DLQ_FORMAT, F.col("attempt") - 1, F.col("body"))
    return rows.select(*run_event(F.col("report_id"), F.col("letter_id") * 1000 + F.col("attempt"), F.col("at"),
                                  F.when(F.col("ok"), F.lit("SUCCESS")).otherwise(F.lit("FAILED")),
                                  records=F.when(F.col("ok"), F.lit(1)), error=F.when(~F.col("ok"), text),
                                  checkpoint=F.when(F.col("ok"), started)))
