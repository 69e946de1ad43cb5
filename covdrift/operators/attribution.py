"""Who made a coverage change: the newest log entry near it that mentions it.

The condition to meet is an OR of equalities and "text contains" tests inside a time range, which
Spark can only run as a nested loop. Here every way to match becomes a key that both sides produce
themselves, and the logs are searched with one as-of join on the key:

* an id in one of the log's key columns: the id is the key;
* a text that names the coverage table: one constant key, it ties the entry to every change near it;
* a text that contains a number: the number is the key on the change side. On the log side each
  text is cut once into its grams of ``GRAM`` characters, and only those that some number sought
  near it has are kept: a bit per gram tells, so that a gram costs the same however many numbers are
  sought (a few that are not sought are kept as well, and meet no number later). A number is then
  looked for through the one of its grams that the fewest texts near it hold: where that stands, the
  text around it is cut out as the key. A number with a gram that no text holds is in none, and is
  not looked for.

A text is cut into grams of one length whatever lengths are sought, and what is done beyond that
goes with the places of rare grams, not with log entries times changes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covdrift.functions.predicates import is_person, wall_clock
from covdrift.operators.asof import entry_bin, newest_within, searched_bins, upper_edge
from covdrift.operators.latest import latest_per
from covdrift.operators.work import staged

ID, TEXT, TABLE = "id", "text", "table"
# Fixed value: the table name looked for in logged statements.
COVERAGE_TABLE = "patient_insurance"
CHANGE_KEY = ["patient_id", "insurance_sr_id"]
#: Characters of a gram; a shorter number is its own gram.
GRAM = 4
#: Most words of 64 bits that mark the grams sought in a bin; it has one per gram up to there.
WORDS = 1024


@dataclass(frozen=True, eq=False)
class LogSource:
    """One log, and what ties its rows to a change.

    ``rows`` has ``audit_user``, ``audit_ts`` and the columns below. ``sought`` lists the values of
    a change that match: an ``ID`` equals one of ``id_columns``, a ``TEXT`` is contained in one of
    ``text_columns``, and a ``TABLE`` equals one of ``table_columns``.
    """

    name: str
    rows: DataFrame
    sought: Sequence[tuple[str, Column]]
    id_columns: Sequence[str] = ()
    text_columns: Sequence[str] = ()
    table_columns: Sequence[str] = ()


def _digits(name: str) -> Column:
    return F.col(name).cast("string")


def edit_log_source(edit_log: DataFrame, system_users: Sequence[str]) -> LogSource:
    """Edit log: an id of the change in a key column, or one of its numbers in a logged value."""
    texts = ["old_values", "new_values", "column_detail"]
    ids = ["PK_1", "PK_2", "pk_3"]
    rows = edit_log.where(is_person(F.col("modified_by"), system_users)).select(
        F.col("modified_by").alias("audit_user"),
        F.col("modified_date").alias("audit_ts"),
        *ids,
        *texts,
    )
    sought = [
        (ID, _digits("patient_id")),
        (ID, _digits("insurance_sr_id")),
        (TEXT, F.col("membership_id")),
        (TEXT, F.col("insurance_no")),
    ]
    return LogSource("edit_log", rows, sought, id_columns=ids, text_columns=texts)


def audit_trail_source(trail: DataFrame, system_users: Sequence[str]) -> LogSource:
    """Audit trail: a statement that names the coverage table, or holds a number of the change.

    Loose on purpose: the table name ties any edit of the table to every change near it, and a
    short patient id is found inside longer numbers.
    """
    statement = F.col("sql_syntax")
    rows = trail.where(is_person(F.col("user_name"), system_users)).select(
        F.col("user_name").alias("audit_user"),
        F.col("tran_date").alias("audit_ts"),
        statement.alias("statement"),
        F.when(statement.contains(COVERAGE_TABLE), COVERAGE_TABLE).alias("named_table"),
    )
    sought = [
        (TABLE, F.lit(COVERAGE_TABLE)),
        (TEXT, _digits("patient_id")),
        (TEXT, F.col("membership_id")),
        (TEXT, F.col("insurance_no")),
    ]
    return LogSource(
        "audit_trail", rows, sought, text_columns=["statement"], table_columns=["named_table"]
    )


def _match_key(log: Column, kind: Column, value: Column) -> Column:
    """Keys of different logs and kinds never meet."""
    return F.concat_ws(":", log, kind, value)


def _sought(changes: DataFrame, sources: Sequence[LogSource], minutes: int) -> DataFrame:
    """Every key each change looks for, with its kind and value."""
    known = changes.dropna(subset=[*CHANGE_KEY, "insurance_change_ts"]).withColumn(
        "edge", upper_edge("insurance_change_ts", minutes)
    )

    def of(source: LogSource) -> DataFrame:
        # A blank number matches nothing.
        pieces = [
            F.when(value != "", F.struct(F.lit(kind).alias("kind"), value.alias("value")))
            for kind, value in source.sought
        ]
        return (
            known.select(
                *CHANGE_KEY,
                F.lit(source.name).alias("log"),
                "edge",
                F.explode(F.array_distinct(F.array(*pieces))).alias("piece"),
            )
            .where(F.col("piece").isNotNull())
            .select(*CHANGE_KEY, "log", "edge", "piece.*")
            .withColumn("match_key", _match_key(F.col("log"), F.col("kind"), F.col("value")))
        )

    return reduce(DataFrame.unionByName, map(of, sources))


def _every(before: Column, middle: Column, after: Column) -> Column:
    """Pattern of all, also overlapping, stretches: ``middle`` with so many characters around it.

    A look-ahead match is empty, so the scan moves on by one character. None starts inside a
    surrogate pair.
    """
    opened = F.concat(F.lit(r"(?s)(?![\uDC00-\uDFFF])(?=(.{"), before, F.lit("}"))
    return F.concat(opened, middle, F.lit(".{"), after, F.lit("}))"))


def _value_grams() -> Column:
    """The grams of ``value`` with their places in it."""
    size = F.least(F.length("value"), F.lit(GRAM))
    places = F.sequence(F.lit(0), F.length("value") - size)
    return F.transform(
        places, lambda at: F.struct(F.substring(F.col("value"), at + 1, size).alias("gram"), at.alias("at"))
    )


def _slot(gram: Column, words: Column) -> Column:
    """The bit of a gram among ``words`` words."""
    return F.pmod(F.xxhash64(gram), words * 64)


def _marked(gram: Column, marks: Column) -> Column:
    """Whether the bit of a gram is set."""
    slot = _slot(gram, F.size(marks))
    word = F.get(marks, F.shiftright(slot, 6).cast("int"))
    return F.getbit(word, slot.bitwiseAND(63).cast("int")) == 1


def _text_grams(text: Column, sizes: Column, marks: Column) -> Column:
    """The different grams of ``text`` that are marked as sought; cut only for lengths that are."""
    none = F.array().cast("array<string>")
    found = none
    for size in range(1, GRAM + 1):
        asked = F.array_contains(sizes, size)
        cut = F.regexp_extract_all(text, F.lit(rf"(?s)(?![\uDC00-\uDFFF])(?=(.{{{size}}}))"), 1)
        found = F.concat(found, F.when(asked, cut).otherwise(none))
    return F.filter(F.array_distinct(found), lambda gram: _marked(gram, marks))


def _gram_bins(searched: DataFrame) -> DataFrame:
    """(log, bin, sizes, marks): the bins that changes search, and the grams of the numbers sought there.

    The grams are told by their lengths and by bits, so a bin has a bounded size however many
    numbers are sought in it, and its entries are tested in a time that does not grow with them.
    """
    keys = ["log", "bin"]
    values = searched.select(*keys, F.when(F.col("kind") == TEXT, F.col("value")).alias("value")).distinct()
    # A bin in which only whole values are sought has a gram of NULL.
    grams = staged(values.select(*keys, F.explode_outer(_value_grams()["gram"]).alias("gram")).distinct())
    bins = grams.groupBy(*keys).agg(
        F.collect_set(F.length("gram")).alias("sizes"),
        F.least(F.greatest(F.count("gram"), F.lit(1)), F.lit(WORDS)).alias("words"),
    )
    sized = staged(bins)
    slots = (
        grams.where("gram is not null")
        .join(sized.select(*keys, "words"), keys)
        .select(*keys, _slot(F.col("gram"), F.col("words")).alias("slot"))
        .select(
            *keys,
            F.shiftright("slot", 6).alias("word"),
            F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bits"),
        )
    )
    unset = sized.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1)).alias("word"))
    marks = (
        slots.unionByName(unset.withColumn("bits", F.lit(0).cast("long")))
        .groupBy(*keys, "word")
        .agg(F.bit_or("bits").alias("bits"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("marks"))
    )
    return sized.drop("words").join(marks, keys)


def _whole(source: LogSource, near: DataFrame) -> DataFrame:
    """(match_key, bin, audit_ts, audit_user) of values that must be equal."""
    kinds = [(ID, source.id_columns), (TABLE, source.table_columns)]
    pieces = [
        F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for kind, columns in kinds for c in columns
    ]
    keep = ["bin", "audit_ts", "audit_user"]
    rows = near.select(*keep, F.explode(F.array(*pieces)).alias("piece")).where("piece.value is not null")
    return rows.select(*keep, _match_key(F.lit(source.name), F.col("piece.kind"), F.col("piece.value")).alias("match_key"))


def _holding(source: LogSource, near: DataFrame) -> DataFrame:
    """(log, bin, audit_ts, audit_user, text, held): texts with the sought grams they hold."""
    texts = F.explode(F.array(*[F.col(c) for c in source.text_columns])).alias("text")
    keep = [F.lit(source.name).alias("log"), "bin", "audit_ts", "audit_user"]
    return (
        near.where(F.size("sizes") > 0)
        .select(*keep, "sizes", "marks", texts)
        .where("text is not null")
        .withColumn("held", _text_grams(F.col("text"), F.col("sizes"), F.col("marks")))
        .where(F.size("held") > 0)
        .drop("sizes", "marks")
    )


def _contained(searched: DataFrame, holding: DataFrame) -> DataFrame:
    """(match_key, bin, audit_ts, audit_user): sought numbers, cut out of the texts that hold them."""
    places = holding.select("log", "bin", F.explode("held").alias("gram"))
    counts = places.groupBy("log", "bin", "gram").agg(F.count("*").alias("n"))
    values = searched.where(F.col("kind") == TEXT).select("log", "bin", "value").distinct()
    grams = values.select("*", F.explode(_value_grams()).alias("g")).select("log", "bin", "value", "g.*")
    rarest = (
        grams.join(counts, ["log", "bin", "gram"], "left")
        .groupBy("log", "bin", "value")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "at")).alias("best"))
        .where("best.n > 0")
    )
    around = F.struct(F.col("best.at").alias("before"), F.length("value").alias("length"))
    shapes = rarest.groupBy("log", "bin", F.col("best.gram").alias("gram")).agg(
        F.collect_set(around).alias("shapes")
    )
    keep = ["log", "bin", "audit_ts", "audit_user"]
    found = (
        holding.select(*keep, "text", F.explode("held").alias("gram"))
        .join(shapes, ["log", "bin", "gram"])
        .select(*keep, "text", "gram", F.explode("shapes").alias("shape"))
    )
    quoted = F.concat(F.lit(r"\Q"), F.replace("gram", F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    before = F.col("shape.before")
    pattern = _every(before, quoted, F.col("shape.length") - before - F.length("gram"))
    cut = F.explode(F.array_distinct(F.regexp_extract_all("text", pattern, 1))).alias("value")
    key = _match_key(F.col("log"), F.lit(TEXT), F.col("value")).alias("match_key")
    return found.select(*keep, cut).select("bin", "audit_ts", "audit_user", key)


def match_logs(changes: DataFrame, sources: Sequence[LogSource], minutes: int) -> DataFrame:
    """Newest matching entry per change row and log, over all keys.

    ``changes`` has (patient_id, insurance_sr_id, membership_id, insurance_no,
    insurance_change_ts). Entries that are not the newest of their log cannot win later and are
    never formed.

    What is sought, the keys asked for, the bins to search and the texts that hold a sought gram
    are staged, each read several times. The joins carry no hints: Spark broadcasts bins, grams and
    keys by their size in files, so log texts are filtered where they are read as long as that fits.
    """
    sought = staged(_sought(changes, sources, minutes))
    searched = sought.withColumn("bin", F.explode(searched_bins("edge", minutes)))
    key_hash = F.xxhash64("match_key", "bin").alias("key_hash")
    # A pre-filter: keys are compared in full below, so two that share a hash do no harm.
    asked = staged(searched.select(key_hash).distinct())
    bins = staged(_gram_bins(searched))
    near = {
        source: source.rows.withColumn("bin", entry_bin("audit_ts", minutes)).join(
            bins.where(F.col("log") == source.name).drop("log"), "bin"
        )
        for source in sources
    }
    whole = [_whole(source, rows) for source, rows in near.items() if source.id_columns or source.table_columns]
    texts = [_holding(source, rows) for source, rows in near.items() if source.text_columns]
    if texts:
        whole.append(_contained(searched, staged(reduce(DataFrame.unionByName, texts))))
    entries = reduce(DataFrame.unionByName, [e.select("bin", "audit_ts", "audit_user", "match_key") for e in whole])
    wanted = entries.withColumn("key_hash", key_hash).join(asked, "key_hash", "left_semi")
    found = newest_within(sought, wanted, minutes)
    newest = (
        sought.join(found, ["match_key", "edge"])
        .groupBy(*CHANGE_KEY, "log")
        .agg(F.max(F.struct("audit_ts", "audit_user")).alias("entry"))
    )
    return newest.select(*CHANGE_KEY, "log", "entry.audit_user", "entry.audit_ts")


def latest_audit(matched: DataFrame) -> DataFrame:
    """The newest entry per change row over all logs; at one moment the highest user."""
    newest_first = [F.col("audit_ts").desc_nulls_last(), F.col("audit_user").desc_nulls_last()]
    return latest_per(matched.drop("log"), CHANGE_KEY, newest_first)


def attribute(changes: DataFrame, sources: Sequence[LogSource], minutes: int = 10) -> DataFrame:
    """(patient_id, insurance_sr_id, audit_user, audit_ts) for each change some entry matches."""
    return latest_audit(match_logs(changes, sources, minutes))


def logged_since(log: DataFrame, ts: str, as_of_ts: datetime, days: int, minutes: int) -> DataFrame:
    """Log rows that can lie near a change of the last ``days`` days; the scan skips the rest."""
    return log.where(F.col(ts) >= wall_clock(as_of_ts - timedelta(days=days, minutes=minutes)))
