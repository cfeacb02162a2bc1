"""Study archives: counters, visits and completions per course, topic, section, tag, question, ability.

Each archive is a groupBy whose partial aggregation runs before the shuffle. Archives that count
visits first order each account's rows (``timeline``), summarise them per account, then add the
accounts up, so that no group of the final key is ever ordered.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studytrail.operators.timeline import SPAN, Carry, Timeline, neighbours
from studytrail.schema import LO_STATUS, RIGHT, SECTION_END, SUBMIT, TOPIC_END, UNABLE, VIEWED, WRONG

COUNTERS = ("answers", "right", "wrong", "unable", "viewed", "viewed_right", "viewed_wrong", "viewed_unable")
LO_COUNTERS = tuple(f"lo_{s}" for s in LO_STATUS)
# Abilities are added as decimals, so that the total does not depend on the order of addition.
ABILITY = "decimal(18,9)"


@dataclass(frozen=True)
class Archive:
    """What one archive groups by and which visits it counts.

    visits: ``change`` (a new entry when the course differs from the account's previous one),
    ``closed`` (opened by a submit, closed by an ``end`` event), ``runs`` (consecutive submits of
    one tag) or None.
    """

    keys: tuple[str, ...]
    visits: str | None = None
    end: str | None = None
    answer_time: bool = True
    without: tuple[str, ...] = ()
    close_at: str = "next_visit"

    @property
    def measures(self) -> tuple[str, ...]:
        names = [*COUNTERS]
        if self.answer_time:
            names.append("answer_time")
        if self.visits:
            names.append("entries")
        if self.visits in ("closed", "runs"):
            names += ["completions", "completion_time"]
        if self.visits == "runs":
            names += ["ability_sum", *LO_COUNTERS]
        return tuple(n for n in names if n not in self.without)


TAG = ("course_id", "lesson_id", "topic_id", "section_id", "tag_code")

ARCHIVES = {
    "course": Archive(("course_id",), "change"),
    "topic": Archive(("course_id", "topic_id"), "closed", TOPIC_END),
    "section": Archive(("course_id", "topic_id", "section_id"), "closed", SECTION_END),
    "tag": Archive(TAG, "runs"),
    "question": Archive((*TAG, "question_id"), answer_time=False),
    "course_daily": Archive(("course_id", "dt"), "change", without=("viewed",)),
    "topic_daily": Archive(("course_id", "topic_id", "dt"), "closed", TOPIC_END),
    "section_daily": Archive(("course_id", "topic_id", "section_id", "dt"), "closed", SECTION_END),
    "tag_daily": Archive((*TAG, "dt"), "runs", close_at="last_submit"),
    "question_daily": Archive((*TAG, "question_id", "dt"), answer_time=False),
}
FACTORS = {
    "factor": ("course_id", "lesson_id", "topic_id", "section_id", "factor"),
    "factor_daily": ("course_id", "lesson_id", "topic_id", "stage", "factor", "dt"),
}


def is_submit() -> Column:
    return F.col("src_type") == SUBMIT


def answer_counters(when: Column | None = None) -> dict[str, Column]:
    """The eight answer counters over rows where ``when``; unknown flags count as answers only."""
    rows = F.lit(True) if when is None else when
    viewed = rows & (F.col("is_view_analyze") == VIEWED)
    flags = {"right": RIGHT, "wrong": WRONG, "unable": UNABLE}
    out = {"answers": F.count_if(rows)}
    out |= {name: F.count_if(rows & (F.col("is_right") == v)) for name, v in flags.items()}
    out["viewed"] = F.count_if(viewed)
    out |= {f"viewed_{name}": F.count_if(viewed & (F.col("is_right") == v)) for name, v in flags.items()}
    return out


def _named(cols: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in cols.items()]


def _measures(spec: Archive, when: Column | None = None) -> dict[str, Column]:
    out = answer_counters(when)
    if spec.answer_time:
        time = F.col("cost_time") if when is None else F.when(when, F.col("cost_time"))
        out["answer_time"] = F.coalesce(F.sum(time), F.lit(0)).cast("bigint")
    return out


def counts(events: DataFrame, spec: Archive) -> DataFrame:
    """An archive without visits: one groupBy."""
    return events.where(is_submit()).groupBy(*spec.keys).agg(*_named(_measures(spec)))


def timeline_of(spec: Archive) -> Timeline:
    """The timelines whose order matters to this archive."""
    day = ("dt",) if "dt" in spec.keys else ()
    if spec.visits == "change":
        return Timeline(("account_id", *day))
    if spec.visits == "closed":
        return Timeline(("account_id", *spec.keys))
    return Timeline(("account_id", *(k for k in spec.keys if k != "tag_code")))


def mark_visits(events: DataFrame, spec: Archive, line: Timeline, asked: Column | None = None) -> DataFrame:
    """Keep the rows a visit is made of and mark them:

    ``opens`` the row starts a visit, ``closes`` it (or the row after it) completes one,
    ``gap`` seconds that belong to the row's visit, ``asks`` it starts a run of one question
    (``asked``: rows known to do so), ``_asked`` ability and state of the latest such row, where the row closes.
    """
    time, marker = line.time, {"_prev_seq": line.seq}
    first = F.col("_prev_seq").isNull()
    if spec.visits == "change":
        rows = neighbours(events.where(is_submit()), line, marker | {"_prev": "course_id"})
        return rows.withColumn("opens", first | ~F.col("_prev").eqNullSafe(F.col("course_id")))
    if spec.visits == "closed":
        rows = events.where(is_submit() | (F.col("src_type") == spec.end))
        rows = neighbours(rows, line, {"_prev_type": "src_type", "_prev_time": time})
        after_submit = F.coalesce(F.col("_prev_type") == SUBMIT, F.lit(False))
        return rows.withColumns(
            {
                "opens": is_submit() & ~after_submit,
                "closes": ~is_submit() & after_submit,
                "gap": F.when(after_submit, F.col(time) - F.col("_prev_time")),
            }
        )
    # NULL counts as a value of its own in every comparison
    opens = first | ~F.col("_prev_tag").eqNullSafe(F.col("tag_code"))
    closes = F.col("_next_seq").isNotNull() & ~F.col("_next_tag").eqNullSafe(F.col("tag_code"))
    known = F.lit(False) if asked is None else F.coalesce(asked, F.lit(False))
    asks = opens | ~F.col("_prev_question").eqNullSafe(F.col("question_id")) | known
    rows = neighbours(
        events.where(is_submit()),
        line,
        marker | {"_prev_tag": "tag_code", "_prev_question": "question_id", "_prev_time": time},
        {"_next_seq": line.seq, "_next_tag": "tag_code", "_next_time": time},
        Carry("_asked", F.struct("ability", "lo_status"), asks, closes, known),
    )
    if spec.close_at == "last_submit":
        gap = F.when(~opens, F.col(time) - F.col("_prev_time"))
    else:
        gap = F.col("_next_time") - F.col(time)
    return rows.withColumns({"opens": opens, "closes": closes, "asks": asks, "gap": gap})


def _visit_totals(line: Timeline, fresh: Column, in_time: bool) -> dict[str, Column]:
    """Per account and key: a visit still open has an opening but no close, and its gaps are taken off.

    Unless the order of rows is the order of their times (``in_time``), the latest time is that of
    the last row.
    """
    opened, closed = F.count_if("opens"), F.count_if("closes")
    if in_time:
        last = F.max(F.when(is_submit(), F.col(line.time)))
        last_open = F.max(F.when(F.col("opens"), F.col(line.time)))
    else:
        last = F.max(F.when(is_submit(), line.position))[line.time]
        last_open = F.max(F.when(F.col("opens"), line.position))[line.time]
    open_gap = F.when(opened > closed, last - last_open).otherwise(F.lit(0))
    return {
        "entries": F.count_if(F.col("opens") & fresh),
        "completions": closed,
        "completion_time": (F.coalesce(F.sum("gap"), F.lit(0)) - open_gap).cast("bigint"),
    }


def archive_marked(rows: DataFrame, spec: Archive, line: Timeline, fresh: Column | None = None) -> DataFrame:
    """Aggregate rows marked by ``mark_visits``; rows that are not ``fresh`` were counted before."""
    new = F.lit(True) if fresh is None else fresh
    if spec.visits == "change":
        cols = _measures(spec, new) | {"entries": F.count_if(F.col("opens") & new)}
        return rows.groupBy(*spec.keys).agg(*_named({m: cols[m] for m in spec.measures}))
    cols = _measures(spec, is_submit() & new) | _visit_totals(line, new, fresh is None)
    if spec.visits == "runs":
        credit = F.when(F.col("closes"), F.col("_asked"))
        cols["ability_sum"] = F.coalesce(F.sum(credit["ability"].cast(ABILITY)), F.lit(0).cast(ABILITY))
        cols |= {f"lo_{s}": F.count_if(credit["lo_status"] == s) for s in LO_STATUS}
    per_account = rows.groupBy("account_id", *spec.keys).agg(*_named({m: cols[m] for m in spec.measures}))
    return add_up(per_account, spec)


def add_up(parts: DataFrame, spec: Archive) -> DataFrame:
    """Add up partial archives of one spec."""
    return parts.groupBy(*spec.keys).agg(*(F.sum(m).alias(m) for m in spec.measures))


def finish(total: DataFrame, spec: Archive) -> DataFrame:
    """The archive as read: keys without any answer have no row, abilities are doubles."""
    if spec.visits in ("closed", "runs"):
        total = total.where(F.col("answers") > 0)
    if spec.visits == "runs":
        total = total.withColumn("ability_sum", F.col("ability_sum").cast("double"))
    return total


def archive(events: DataFrame, spec: Archive | str, span: int = SPAN) -> DataFrame:
    """Compute one archive over a frame of archive events.

    ``span``: seconds of a timeline that are put in order together (see ``timeline``).
    """
    spec = ARCHIVES[spec] if isinstance(spec, str) else spec
    if spec.visits is None:
        return counts(events, spec)
    line = replace(timeline_of(spec), span=span)
    return finish(archive_marked(mark_visits(events, spec, line), spec, line), spec)


def archive_factors(events: DataFrame, keys: tuple[str, ...] | str) -> DataFrame:
    """Archive per ability factor: ``triggers`` distinct accounts, ``ability`` share of right answers.

    ``triggers`` is a distinct count and cannot be added up over days or batches; ``factor_days`` keeps what can.
    """
    keys = FACTORS[keys] if isinstance(keys, str) else keys
    return factor_totals(factor_accounts(events, keys), keys)


def factor_accounts(events: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Answer counters per key and account; these add up over batches."""
    rows = events.where(is_submit()).withColumn("factor", F.explode("factor_codes"))
    return rows.groupBy(*keys, "account_id").agg(*_named(answer_counters()))


def factor_totals(per_account: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    sums = (F.sum(c).alias(c) for c in COUNTERS)
    return factor_ability(per_account.groupBy(*keys).agg(F.count("account_id").alias("triggers"), *sums))


def factor_ability(totals: DataFrame) -> DataFrame:
    return totals.withColumn("ability", F.col("right").cast("double") / F.col("answers").cast("double"))


def factor_days(events: DataFrame, keys: tuple[str, ...] | str = "factor", day: str = "dt") -> DataFrame:
    """Daily parts of an ability archive that add up exactly, distinct accounts too: answer counters, and accounts as bitmaps.

    A row holds the accounts of one bucket of 32,768 ids (4 KB of bits), so no row and no aggregation buffer grows with the number of accounts.
    Accounts are whole numbers; text ids have to be numbered first.
    """
    keys = FACTORS[keys] if isinstance(keys, str) else keys
    account = F.col("account_id").cast("bigint")
    rows = events.where(is_submit()).withColumn("factor", F.explode("factor_codes"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(account)).alias("accounts")
    return rows.groupBy(*keys, day, F.bitmap_bucket_number(account).alias("bucket")).agg(*_named(answer_counters()), bits)


def roll_up_factors(days: DataFrame, keys: tuple[str, ...] | str = "factor") -> DataFrame:
    """The ability archive over the given days: bitmaps are united by bucket, then counted."""
    keys = FACTORS[keys] if isinstance(keys, str) else keys
    buckets = days.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("accounts").alias("accounts"), *(F.sum(c).alias(c) for c in COUNTERS))
    triggers = F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("accounts")).otherwise(F.lit(0))).alias("triggers")
    return factor_ability(buckets.groupBy(*keys).agg(triggers, *(F.sum(c).alias(c) for c in COUNTERS)))


def roll_up(daily: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Lifetime totals from a daily archive: answer counters and times add up over days.

    Entries and completions do not, since daily visits end at midnight; triggers do by ``roll_up_factors``.
    """
    additive = [c for c in (*COUNTERS, "answer_time") if c in daily.columns]
    return daily.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in additive))
