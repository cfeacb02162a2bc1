"""What a group of accounts' rows of a micro-batch add to the archives, given the visits that are open.

``Visits`` is the processor of a ``transformWithState`` keyed by group of accounts, since each key and each access to state is a call
between Python and the JVM. Its state is a map from parts of the group (and days, for daily archives) to their accounts' timelines, one
small entry each: the last course, the submit that opened a visit, or the run of one tag with the first row of its last question.
A part's entries are read and written together, and only by batches that have rows of the part. What is emitted adds up: a row for
each archive and key that the group touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from itertools import chain
from operator import itemgetter

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from studytrail.operators import archives as ar
from studytrail.schema import LO_STATUS, RIGHT, SUBMIT, UNABLE, VIEWED, WRONG

LONGS = (*ar.COUNTERS, "answer_time", "entries", "completions", "completion_time", *ar.LO_COUNTERS, "triggers")
ABILITY, EXPIRED = "ability_sum", "expired"
AT = {name: i for i, name in enumerate(LONGS)}
FLAGS = {flag: (AT[name], AT[f"viewed_{name}"]) for flag, name in {RIGHT: "right", WRONG: "wrong", UNABLE: "unable"}.items()}
ANSWERS, IS_VIEWED, ANSWER_TIME, ENTRIES = AT["answers"], AT["viewed"], AT["answer_time"], AT["entries"]
COMPLETIONS, COMPLETION_TIME, TRIGGERS = AT["completions"], AT["completion_time"], AT["triggers"]
NINTH = Decimal("0.000000001")
GROUP, PART = "_group", "_part"  # of an account
GROUPS = 512
PARTS, DAY_PARTS = 64, 1  # of a group, and of a group's day
DAY_MS = 86_400_000


def columns_of(names: Sequence[str], keys: Sequence[str]) -> tuple[str, ...]:
    """The columns of an event that these archives look at."""
    specs = [ar.ARCHIVES[n] for n in names if n in ar.ARCHIVES]
    wanted = ["account_id", *(k for k in keys if k != "factor"), "epoch_s", "seq", "src_type", "is_right", "is_view_analyze", "cost_time"]
    if any(s.visits == "runs" for s in specs):
        wanted += ["question_id", "ability", "lo_status"]
    if len(specs) < len(names):
        wanted.append("factor_codes")
    return tuple(dict.fromkeys(wanted))


def added_schema(events: T.StructType, keys: Sequence[str]) -> T.StructType:
    """archive, the key columns of all archives (null where an archive has no such key), measures, expired timelines."""
    typed = [T.StructField(k, T.StringType() if k == "factor" else events[k].dataType) for k in keys]
    longs = [T.StructField(m, T.LongType()) for m in (*LONGS, EXPIRED)]
    return T.StructType([T.StructField("archive", T.StringType()), *typed, *longs, T.StructField(ABILITY, T.DecimalType(28, 9))])


def day_of(end_ms: int) -> str:
    """The day (dt) that ends then."""
    return (date(1970, 1, 1) + timedelta(days=end_ms // DAY_MS - 1)).strftime("%Y%m%d")


def open_schema(events: T.StructType) -> T.StructType:
    """State of one part: its timelines, by archive and place."""
    where = [T.StructField(c, T.StringType()) for c in ("archive", "place")]
    named = [T.StructField(c, events[c].dataType) for c in ("course_id", "tag_code", "question_id", "ability", "lo_status")]
    times = [T.StructField(c, T.LongType()) for c in ("first_s", "last_s")]
    return T.StructType([T.StructField("timelines", T.ArrayType(T.StructType([*where, *named, *times])))])


class Visits(StatefulProcessor):
    """``names``: archives that share a cadence. ``expire``: whether a day's timelines are forgotten when the group's timer for it fires."""

    def __init__(self, names: Sequence[str], keys: Sequence[str], opened: T.StructType, expire: bool):
        self.names, self.keys, self.opened, self.expire = tuple(names), tuple(keys), opened, expire
        self.daily = "dt" in self.keys
        self.stateful = any(n in ar.FACTORS or ar.ARCHIVES[n].visits for n in names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "dt string, part int", self.opened)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = next(rows)
        at = {c: i for i, c in enumerate(first.__fields__)}
        part_at, day_at, time, seq = at[PART], at.get("dt"), at["epoch_s"], at["seq"]
        by_part: dict[tuple, list[tuple]] = {}
        for row in map(tuple, chain((first,), rows)):
            by_part.setdefault((row[day_at] if self.daily else None, row[part_at]), []).append(row)
        added = Added(at)
        for part, batch in by_part.items():
            batch.sort(key=lambda r: (r[time] is not None, r[time] or 0, r[seq] is not None, r[seq]))
            found = self.parts.getValue(part) if self.stateful else None
            before = {(t[0], t[1]): tuple(t)[2:] for t in found[0]} if found else {}
            added.lines = dict(before)
            for name in self.names:
                if name in ar.FACTORS:
                    added.factors(name, batch)
                else:
                    added.archive(name, ar.ARCHIVES[name], batch)
            if added.lines and added.lines != before:
                self.parts.updateValue(part, ([(*where, *line) for where, line in added.lines.items()],))
            elif before and not added.lines:
                self.parts.removeKey(part)
        if self.expire:
            for end in {batch[0][at["_day_end"]] for (day, _), batch in by_part.items() if day is not None}:
                self.handle.registerTimer(end)
        return added.rows(self.keys)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        day, gone = day_of(expiredTimerInfo.getExpiryTimeInMs()), 0
        for part in [tuple(k) for k in self.parts.keys() if k[0] == day]:
            gone += len(self.parts.getValue(part)[0])
            self.parts.removeKey(part)
        yield added_row(None, {}, self.keys, [0] * len(LONGS), Decimal(0), gone)


def added_row(archive: str | None, values: Mapping, keys: Sequence[str], longs: Sequence[int], ability: Decimal, expired: int = 0) -> Row:
    named = Row("archive", *keys, *LONGS, EXPIRED, ABILITY)
    return named(archive, *(values.get(k) for k in keys), *longs, expired, ability)


def picker(places: Sequence[int]) -> Callable[[tuple], tuple]:
    """These places of a row, as a tuple."""
    if len(places) == 1:
        only = places[0]
        return lambda row: (row[only],)
    return itemgetter(*places)


class Added:
    """Sums of one group of accounts and micro-batch; ``lines`` are the timelines of the part at hand.

    ``at``: places of the columns in a row.
    """

    def __init__(self, at: Mapping[str, int]):
        self.at, self.lines = at, {}
        self.sums: dict[tuple[str, tuple], list] = {}
        self.is_right, self.viewed, self.cost = at["is_right"], at["is_view_analyze"], at["cost_time"]

    def of(self, name: str, values: tuple) -> list:
        """Sums of one archive and key; the last is the ability."""
        found = self.sums.get((name, values))
        if found is None:
            found = self.sums[name, values] = [*([0] * len(LONGS)), Decimal(0)]
        return found

    def rows(self, keys: Sequence[str]) -> Iterator[Row]:
        for (name, values), sums in self.sums.items():
            own = ar.FACTORS[name] if name in ar.FACTORS else ar.ARCHIVES[name].keys
            yield added_row(name, dict(zip(own, values, strict=True)), keys, sums[:-1], sums[-1])

    def count(self, sums: list, row: tuple) -> None:
        flag, viewed = FLAGS.get(row[self.is_right]), row[self.viewed] == VIEWED
        sums[ANSWERS] += 1
        if flag:
            sums[flag[0]] += 1
        if viewed:
            sums[IS_VIEWED] += 1
            if flag:
                sums[flag[1]] += 1
        sums[ANSWER_TIME] += row[self.cost] or 0

    def archive(self, name: str, spec: ar.Archive, rows: Sequence[tuple]) -> None:
        """Counters of a key's answers, and its visits; a place is an account and what its timeline goes by."""
        src_type, values_of = self.at["src_type"], picker([self.at[k] for k in spec.keys])
        place_keys = [k for k in ar.timeline_of(spec).keys if k not in ("account_id", "dt")] if spec.visits else ()
        place_of = picker([self.at[k] for k in ("account_id", *place_keys)])
        step = {"change": self.change, "closed": self.closed, "runs": self.runs, None: None}[spec.visits]
        for row in rows:
            submit = row[src_type] == SUBMIT
            if not submit and row[src_type] != spec.end:
                continue
            sums = self.of(name, values_of(row))
            if submit:
                self.count(sums, row)
            if step:
                step(spec, name, sums, row, (name, repr(place_of(row))))

    def change(self, spec, name, sums, row, where) -> None:
        state, course = self.lines.get(where), row[self.at["course_id"]]
        if state is None or state[0] != course:
            sums[ENTRIES] += 1
            self.lines[where] = (course, None, None, None, None, None, None)

    def closed(self, spec, name, sums, row, where) -> None:
        state, at = self.lines.get(where), row[self.at["epoch_s"]]
        if row[self.at["src_type"]] == SUBMIT:
            if state is None:
                sums[ENTRIES] += 1
                self.lines[where] = (None, None, None, None, None, at, None)
        elif state is not None:
            sums[COMPLETIONS] += 1
            sums[COMPLETION_TIME] += at - state[5]
            del self.lines[where]

    def runs(self, spec, name, sums, row, where) -> None:
        state, at, tag = self.lines.get(where), row[self.at["epoch_s"]], row[self.at["tag_code"]]
        asked = (row[self.at["question_id"]], row[self.at["ability"]], row[self.at["lo_status"]])
        if state is not None and state[1] == tag:
            question, ability, status = asked if state[2] != asked[0] else state[2:5]
            self.lines[where] = (None, tag, question, ability, status, state[5], at)
            return
        if state is not None:
            credited = self.of(name, tuple(state[1] if k == "tag_code" else row[self.at[k]] for k in spec.keys))
            credited[COMPLETIONS] += 1
            credited[COMPLETION_TIME] += (state[6] if spec.close_at == "last_submit" else at) - state[5]
            if state[3] is not None:
                credited[-1] += Decimal(repr(state[3])).quantize(NINTH, ROUND_HALF_UP)
            if state[4] in LO_STATUS:
                credited[AT[f"lo_{state[4]}"]] += 1
        sums[ENTRIES] += 1
        self.lines[where] = (None, tag, *asked, at, at)

    def factors(self, name: str, rows: Sequence[tuple]) -> None:
        """Counters by ability; an account triggers it once."""
        keys, account, src_type, codes = ar.FACTORS[name], self.at["account_id"], self.at["src_type"], self.at["factor_codes"]
        day = keys.index("dt") if "dt" in keys else len(keys)
        by, split = picker([self.at[k] for k in keys if k != "factor"]), keys.index("factor")
        for row in rows:
            if row[src_type] != SUBMIT:
                continue
            others = by(row)
            for factor in row[codes] or ():
                values = (*others[:split], factor, *others[split:])
                sums = self.of(name, values)
                self.count(sums, row)
                where = (name, repr((row[account], *values[:day], *values[day + 1 :])))
                if where not in self.lines:
                    sums[TRIGGERS] += row[account] is not None
                    self.lines[where] = (None, None, None, None, None, 0, None)
