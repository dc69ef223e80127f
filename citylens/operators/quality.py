"""Declarative data-quality rules, dead-letter split and error report.

Every rule is a native predicate plus a native message expression; a
message's errors are one ``array<string>`` built by
``array_remove(array(coalesce(when(c1, m1), ''), ...), '')`` -- no lambda,
so the whole validator is one projection inside whole-stage codegen: no
Python per row, no shuffle.  Rules keep their declared order: the first
error is the ``error_reason``.

Mixed-topic input (one envelope stream carrying several topics) is validated
in one pass: every field any rule reads is extracted by one ``from_json``
into a union struct, and a CASE on the topic picks the rule list.  No
per-topic branch, so the source is scanned once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import is_json_object
from ..functions.scalar import number_text

# Fixed values of the validation contract.
LAT_MIN, LAT_MAX = 12.88, 13.12
LON_MIN, LON_MAX = 77.48, 77.75
AQI_MIN, AQI_MAX = 0, 500
SPEED_MAX = 120
VOLTAGE_MIN, VOLTAGE_MAX = 200, 260
PF_MIN, PF_MAX = 0.0, 1.0

# Field types per topic (what a validator reads).
FIELD_TYPES = {
    "air_quality": {"aqi": "double", "pm25": "double", "pm10": "double"},
    "bus_gps": {"lat": "double", "lon": "double", "speed_kmh": "double"},
    "traffic_signals": {"avg_wait_sec": "double", "vehicle_count": "double", "junction_id": "string"},
    "smart_meters": {"voltage": "double", "power_factor": "double", "meter_id": "string"},
}

Getter = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``when(predicate) -> message``; both built from a field getter."""
    name: str
    predicate: Callable[[Getter], Column]
    message: Callable[[Getter], Column]


def _txt(c: Column, missing: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit(missing))


def _msg(prefix: str) -> Callable[[Getter], Column]:
    return lambda g: F.lit(prefix)


# Missing values follow the validator contract: a missing lat/lon counts as 0
# (so it is out of the box), a missing speed as 0 (valid), a missing voltage
# as 230 and a missing power factor as 1.0 (both valid); a missing pm / wait /
# vehicle count is not negative.
RULES: dict[str, list[Rule]] = {
    "air_quality": [
        Rule("null_aqi", lambda g: g("aqi").isNull(), _msg("null_aqi")),
        Rule("aqi_out_of_range",
             lambda g: g("aqi").isNotNull() & ~g("aqi").between(AQI_MIN, AQI_MAX),
             lambda g: F.concat(F.lit("aqi_out_of_range:"), number_text(g("aqi")))),
        Rule("negative_pm25", lambda g: F.coalesce(g("pm25") < 0, F.lit(False)), _msg("negative_pm25")),
        Rule("negative_pm10", lambda g: F.coalesce(g("pm10") < 0, F.lit(False)), _msg("negative_pm10")),
    ],
    "bus_gps": [
        Rule("impossible_lat",
             lambda g: ~F.coalesce(g("lat"), F.lit(0.0)).between(LAT_MIN, LAT_MAX),
             lambda g: F.concat(F.lit("impossible_lat:"), _txt(g("lat"), "0"))),
        Rule("impossible_lon",
             lambda g: ~F.coalesce(g("lon"), F.lit(0.0)).between(LON_MIN, LON_MAX),
             lambda g: F.concat(F.lit("impossible_lon:"), _txt(g("lon"), "0"))),
        Rule("negative_speed", lambda g: F.coalesce(g("speed_kmh") < 0, F.lit(False)),
             lambda g: F.concat(F.lit("negative_speed:"), g("speed_kmh").cast("string"))),
        Rule("speed_too_high", lambda g: F.coalesce(g("speed_kmh") > SPEED_MAX, F.lit(False)),
             lambda g: F.concat(F.lit("speed_too_high:"), g("speed_kmh").cast("string"))),
    ],
    "traffic_signals": [
        Rule("negative_wait_sec", lambda g: F.coalesce(g("avg_wait_sec") < 0, F.lit(False)),
             _msg("negative_wait_sec")),
        Rule("negative_vehicle_count", lambda g: F.coalesce(g("vehicle_count") < 0, F.lit(False)),
             _msg("negative_vehicle_count")),
        Rule("null_junction_id", lambda g: g("junction_id").isNull(), _msg("null_junction_id")),
    ],
    "smart_meters": [
        Rule("voltage_out_of_range",
             lambda g: g("voltage").isNotNull() & ~g("voltage").between(VOLTAGE_MIN, VOLTAGE_MAX),
             lambda g: F.concat(F.lit("voltage_out_of_range:"), g("voltage").cast("string"))),
        Rule("power_factor_invalid",
             lambda g: g("power_factor").isNotNull() & ~g("power_factor").between(PF_MIN, PF_MAX),
             lambda g: F.concat(F.lit("power_factor_invalid:"), g("power_factor").cast("string"))),
        Rule("null_meter_id", lambda g: g("meter_id").isNull(), _msg("null_meter_id")),
    ],
}

PARSE_ERROR = "json_parse_error"


def error_array(topic: str, get: Getter, rules: dict[str, list[Rule]] | None = None) -> Column:
    """``array<string>`` of the rule messages that fire, in rule order."""
    rs = (rules or RULES)[topic]
    # messages are never empty, so '' marks "rule did not fire"
    slots = [F.coalesce(F.when(r.predicate(get), r.message(get)), F.lit("")) for r in rs]
    return F.array_remove(F.array(*slots), "")


def validate(df: DataFrame, topic: str, rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """Typed single-topic stream -> adds ``errors``, ``error_reason``, ``is_valid``."""
    errs = error_array(topic, lambda f: F.col(f), rules)
    return _finish(df.withColumn("errors", errs))


def validate_payloads(df: DataFrame, topic_col: str = "topic", value_col: str = "value",
                      topics: dict[str, str] | None = None,
                      rules: dict[str, list[Rule]] | None = None) -> DataFrame:
    """Validate raw JSON payloads of several topics in one projection.

    ``topics`` maps the value found in ``topic_col`` to a rule set name
    (default: identity).  Undecodable or non-object payloads get the single
    error ``json_parse_error:...``; a topic without rules gets
    ``unknown_topic:<topic>``.
    """
    rules = rules or RULES
    topics = topics or {t: t for t in rules}
    text = F.col(value_col).cast("string")
    types: dict[str, str] = {}
    for rs in set(topics.values()):
        for f, t in FIELD_TYPES[rs].items():
            if types.setdefault(f, t) != t:
                raise ValueError(f"field {f} read with two types")
    # One streaming JSON parse extracts every field any rule reads (a field
    # of the wrong type reads as missing); validity -- parses, and is an
    # object -- is a second, cheap parse plus the leading brace.
    union = ", ".join(f"{f} {t}" for f, t in sorted(types.items()))
    parsed = df.select("*", is_json_object(text).alias("__obj"), F.from_json(text, union).alias("__s"))
    is_obj = F.col("__obj")

    def getter(rule_set: str) -> Getter:
        return lambda f: F.col("__s").getField(f)

    branch = None
    for name, rule_set in topics.items():
        cond = F.col(topic_col) == F.lit(name)
        arr = error_array(rule_set, getter(rule_set), rules)
        branch = F.when(cond, arr) if branch is None else branch.when(cond, arr)
    unknown = F.array(F.concat(F.lit("unknown_topic:"), F.coalesce(F.col(topic_col), F.lit("null"))))
    branch = branch.otherwise(unknown) if branch is not None else unknown
    errors = F.when(~is_obj, F.array(F.lit(f"{PARSE_ERROR}:payload is not a JSON object"))).otherwise(branch)
    return _finish(parsed.withColumn("errors", errors).drop("__obj", "__s"))


def _finish(df: DataFrame) -> DataFrame:
    return (df.withColumn("error_reason", F.try_element_at(F.col("errors"), F.lit(1)))
              .withColumn("is_valid", F.size(F.col("errors")) == 0))


def error_type(err) -> Column:
    """The counter key of an error: the text before the first ``:``."""
    c = F.col(err) if isinstance(err, str) else err
    return F.substring_index(c, ":", 1)


def _some(errors: str) -> Column:
    """The error list, NULL when empty: explodes to the same rows."""
    return F.when(F.size(errors) > 0, F.col(errors))


def explode_errors(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per (message, error) with the error's 1-based position.

    No ``is_valid`` filter first, and the generator's input is an expression,
    not the attribute: from an attribute Catalyst infers ``size(errors) > 0``
    and pushes it below the validator with the whole rule expression written
    into it (one JSON parse per field and rule)."""
    return (df.select(*keep, F.posexplode(_some("errors")).alias("pos", "error"))
              .withColumn("error_pos", F.col("pos") + 1).drop("pos"))


def error_distribution(df: DataFrame, topic_col: str = "topic", by_type: bool = False) -> DataFrame:
    """Count of each error per topic, most frequent first.  ``by_type``
    groups by the error type instead of the full text (full texts embed the
    offending value, so their number of groups grows with the data)."""
    e = df.select(F.col(topic_col).alias("topic"), F.explode(_some("errors")).alias("error"))
    if by_type:
        e = e.withColumn("error", error_type("error"))
    return e.groupBy("topic", "error").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "topic", "error")


def dlq_summary(df: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Per topic: messages, valid, dead-lettered, DLQ rate in percent.

    Counts messages (not errors), so a message with two errors is one DLQ
    message; the rate is NULL for a topic with no messages.
    """
    return (df.groupBy(F.col(topic_col).alias("topic"))
              .agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(F.col("is_valid")).alias("valid"),
                   F.count_if(~F.col("is_valid")).alias("dlq"))
              .withColumn("dlq_rate_pct",
                          F.when(F.col("total") > 0,
                                 F.round(F.col("dlq") * 100.0 / F.col("total"), 1))))


TOTAL = "TOTAL"


def report_totals(counts: DataFrame, topics: list[str]) -> DataFrame:
    """From (topic, valid, dlq) the report's totals: a row per topic -- also
    of listed topics that sent nothing -- and one for all, with the rate of
    dead letters in percent (NULL without messages)."""
    listed = counts.sparkSession.createDataFrame([(t, 0, 0) for t in topics], "topic string, valid long, dlq long")
    per = counts.select("topic", "valid", "dlq").unionByName(listed)
    # one pass for topics and the grand total
    both = per.select(F.explode(F.array(F.col("topic"), F.lit(TOTAL))).alias("topic"), "valid", "dlq")
    rate = F.when(F.col("valid") + F.col("dlq") > 0, F.round(F.col("dlq") * 100.0 / (F.col("valid") + F.col("dlq")), 1))
    return both.groupBy("topic").agg(F.sum("valid").alias("valid"), F.sum("dlq").alias("dlq")).withColumn("dlq_rate_pct", rate)


VALID, DEAD = "(valid)", "(dead)"


def counted_as(errors: str = "errors") -> Column:
    """What a message counts as: each of its errors by type, and valid or dead once."""
    types = F.transform(errors, lambda e: error_type(e))
    return F.when(F.size(errors) > 0, F.concat(types, F.array(F.lit(DEAD)))).otherwise(F.array(F.lit(VALID)))


def windowed_counts(checked: DataFrame, ts: str = "timestamp", every: str = "5 minutes", topic_col: str = "topic") -> DataFrame:
    """(window_start, window_end, topic, error, count) of validated messages by
    event time.  On a stream with a watermark the rows of a window are final
    together, when the watermark passes its end; the state is a row per open
    window, topic and error type, whatever the messages hold."""
    e = checked.select(ts, F.col(topic_col).alias("topic"), F.explode(counted_as()).alias("error"))
    return (e.groupBy(F.window(ts, every).alias("w"), "topic", "error").agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "topic", "error", "count"))


def windowed_errors(counts: DataFrame) -> DataFrame:
    """The error distribution of each window: errors by topic and type."""
    return counts.where(~F.col("error").isin(VALID, DEAD))


def windowed_report(counts: DataFrame, topics: list[str]) -> DataFrame:
    """Per window in which a message arrived: a row for each topic -- listed
    topics that sent nothing included -- and one for all, with messages, valid,
    dead and the rate of dead letters in percent (NULL without messages).

    Listed topics come in as zero rows made from rows of the window itself
    (at most two for each of its topics), so nothing is joined."""
    counts, n = counts.where(F.col("error").isin(VALID, DEAD)), F.col("count")
    own = F.struct(F.col("topic").alias("topic"), F.when(F.col("error") == VALID, n).otherwise(0).alias("valid"),
                   F.when(F.col("error") == DEAD, n).otherwise(0).alias("dlq"))
    everyone = F.struct(F.lit(TOTAL).alias("topic"), own["valid"].alias("valid"), own["dlq"].alias("dlq"))
    listed = [F.struct(F.lit(t).alias("topic"), F.lit(0).cast("long").alias("valid"), F.lit(0).cast("long").alias("dlq")) for t in topics]
    kind = "array<struct<topic:string,valid:long,dlq:long>>"
    rows = counts.select("window_start", "window_end", F.explode(F.array(own, everyone, *listed).cast(kind)).alias("r"))
    total = F.col("valid") + F.col("dlq")
    return (rows.groupBy("window_start", "window_end", F.col("r.topic").alias("topic"))
            .agg(F.sum("r.valid").alias("valid"), F.sum("r.dlq").alias("dlq"))
            .select("window_start", "window_end", "topic", total.alias("total"), "valid", "dlq",
                    F.when(total > 0, F.round(F.col("dlq") * 100.0 / total, 1)).alias("dlq_rate_pct")))


def dlq_envelope(df: DataFrame, topic_col: str, original: Column, now: Column | None = None) -> DataFrame:
    """Dead-letter records: ``(original_topic, error_reason, all_errors,
    original_data, dlq_timestamp)`` for the invalid rows, keyed by topic."""
    now = now if now is not None else F.current_timestamp()
    rec = F.struct(F.col(topic_col).alias("original_topic"),
                   F.col("error_reason"),
                   F.col("errors").alias("all_errors"),
                   original.alias("original_data"),
                   now.alias("dlq_timestamp"))
    # A 0-or-1 element generator instead of filter(~is_valid): Catalyst would
    # push such a filter below the validator by inlining the rule expression,
    # evaluating every rule (and the JSON parse) twice per message.
    # (explode of NULL yields no row).
    one = F.when(F.size("errors") > 0, F.array(rec))
    return df.select(F.explode(one).alias("__d")).select("__d.*")
