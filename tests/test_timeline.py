"""Neighbours and visits against a sequential replay, with cells of any length."""

import random

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from studytrail.operators import archives as ar
from studytrail.operators.timeline import Carry, Timeline, neighbours

SCHEMA = (
    "account_id bigint, seq bigint, epoch_s bigint, src_type string, course_id string, lesson_id string, "
    "topic_id string, section_id string, tag_code string, question_id string, is_right string, "
    "is_view_analyze string, cost_time int, ability double, lo_status string, factor_codes array<string>, "
    "stage string, dt string"
)


def make_log(n=600, seed=5, hot=0.4):
    """Random events: one account holds much of the log, times repeat, some keys are NULL."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        account = 1 if rng.random() < hot else rng.choice([2, 3, 4, None])
        t = rng.randrange(0, n // 6) if account != 1 else rng.randrange(0, 40)
        kind = rng.choices(["SUBMIT_QUESTION", "TOPIC_END", "SECTION_END"], [8, 1, 1])[0]
        pick = lambda p, k: rng.choices([f"{p}{i}" for i in range(k)] + [None], [5] * k + [1])[0]
        rows.append(
            (account, seq, t, kind, pick("c", 2), "l", pick("t", 2), pick("s", 2), pick("k", 3), pick("q", 3),
             rng.choice(["0", "1", "2", "9", None]), rng.choice(["0", "1", None]), rng.randrange(9),
             rng.randrange(100) / 100, rng.choice([*ar.LO_STATUS, None]), rng.choice([[], ["f"], ["f", "g", "f"]]),
             "1", f"2024010{1 + t // 50}")
        )
    return rows


NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def rows():
    return make_log()


@pytest.fixture(scope="module")
def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def as_dicts(rows):
    return sorted((dict(zip(NAMES, r)) for r in rows), key=lambda r: (r["epoch_s"], r["seq"]))


@pytest.mark.parametrize("span", [10_000, 20, 1])
def test_neighbours_and_carried_values(log, rows, span):
    line = Timeline(("account_id",), span=span)
    changed = F.col("ps").isNull() | ~F.col("p").eqNullSafe(F.col("tag_code"))
    carry = Carry("hit", F.struct("seq", "ability"), changed, F.lit(True), F.lit(False))
    out = neighbours(log, line, {"p": "tag_code", "ps": "seq"}, {"n": "tag_code", "ns": "seq"}, carry)
    got = {r.seq: (r.p, r.ps, r.n, r.ns, r.hit and (r.hit.seq, r.hit.ability)) for r in out.collect()}
    want, by = {}, {}
    for r in as_dicts(rows):
        by.setdefault(r["account_id"], []).append(r)
    for seq in by.values():
        hit = None
        for i, r in enumerate(seq):
            p, n = (seq[i - 1] if i else None), (seq[i + 1] if i + 1 < len(seq) else None)
            if p is None or p["tag_code"] != r["tag_code"]:
                hit = (r["seq"], r["ability"])
            want[r["seq"]] = (
                p and p["tag_code"], p["seq"] if p else None, n and n["tag_code"], n["seq"] if n else None, hit,
            )
    assert got == want


def test_plan_reads_and_shuffles_the_log_once(spark, tmp_path):
    """Also with hot accounts: the log's shuffle is shared, borders take a second small one, no job runs while building."""
    spark.createDataFrame(make_log(50), SCHEMA).write.parquet(str(tmp_path / "log"))
    events = spark.read.parquet(str(tmp_path / "log"))
    spark.sparkContext.setJobGroup("building", "no jobs")
    built = {name: ar.archive(events, name) for name in ("course", "topic", "tag")}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext._jsc.clearJobGroup()
    for name, most in (("course", 3), ("topic", 5), ("tag", 5)):
        built[name].collect()
        plan = built[name]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
        reads = [x for x in plan.splitlines() if "FileScan" in x]
        shuffles = [x for x in plan.splitlines() if " Exchange " in x and "ReusedExchange" not in x]
        assert len(reads) <= 2 and len(shuffles) <= most, (name, len(reads), len(shuffles), plan)


def replay(rows, spec):
    """Entries, completions, completion time, ability and statuses by walking the log once."""
    state, out = {}, {}

    def at(r, tag=None):
        k = tuple(tag if c == "tag_code" and tag != "same" else r[c] for c in spec.keys)
        return out.setdefault(k, {"entries": 0, "completions": 0, "completion_time": 0, "ability": 0.0, "lo": {}})

    day = ("dt",) if "dt" in spec.keys else ()
    for r in as_dicts(rows):
        t, submit = r["epoch_s"], r["src_type"] == "SUBMIT_QUESTION"
        if spec.visits == "change" and submit:
            k = (r["account_id"], *(r[d] for d in day))
            if k not in state or state[k] != r["course_id"]:
                at(r)["entries"] += 1
            state[k] = r["course_id"]
        if spec.visits == "closed":
            k = (r["account_id"], *(r[c] for c in spec.keys))
            if submit and k not in state:
                state[k] = t
                at(r)["entries"] += 1
            elif r["src_type"] == spec.end and k in state:
                a = at(r)
                a["completions"] += 1
                a["completion_time"] += t - state.pop(k)
        if spec.visits == "runs" and submit:
            k = (r["account_id"], *(r[c] for c in spec.keys if c != "tag_code"))
            s = state.get(k)
            if s is None or s["tag"] != r["tag_code"]:
                if s is not None:
                    a = at(r, s["tag"])
                    a["completions"] += 1
                    a["completion_time"] += (s["last"] if spec.close_at == "last_submit" else t) - s["start"]
                    a["ability"] += s["ability"]
                    a["lo"][s["lo"]] = a["lo"].get(s["lo"], 0) + 1
                at(r, "same")["entries"] += 1
                s = state[k] = {"tag": r["tag_code"], "start": t, "q": object()}
            if s["q"] != r["question_id"]:
                s |= {"q": r["question_id"], "ability": r["ability"], "lo": r["lo_status"]}
            s["last"] = t
    return out


@pytest.mark.parametrize("span", [10_000, 7])
@pytest.mark.parametrize(
    "name", ["course", "topic", "section", "tag", "course_daily", "topic_daily", "section_daily", "tag_daily"]
)
def test_archives_equal_replay(log, rows, name, span):
    spec = ar.ARCHIVES[name]
    want = replay(rows, spec)
    got = ar.archive(log, name, span).collect()
    submits = [r for r in as_dicts(rows) if r["src_type"] == "SUBMIT_QUESTION"]
    assert sum(r.answers for r in got) == len(submits)
    assert {tuple(r[c] for c in spec.keys) for r in got} == {tuple(r[c] for c in spec.keys) for r in submits}
    for r in got:
        w = want.get(tuple(r[c] for c in spec.keys), {"entries": 0})
        assert r.entries == w["entries"]
        if spec.visits != "change":
            assert (r.completions, r.completion_time) == (w["completions"], w["completion_time"])
        if spec.visits == "runs":
            assert r.ability_sum == pytest.approx(w["ability"])
            assert {s: r[f"lo_{s}"] for s in ar.LO_STATUS if r[f"lo_{s}"]} == {
                k: v for k, v in w["lo"].items() if k is not None
            }


def test_unknown_flags_count_as_answers_only(log, rows):
    total = ar.archive(log, "question").agg(F.sum("answers"), F.sum("right"), F.sum("viewed_wrong")).first()
    submits = [r for r in as_dicts(rows) if r["src_type"] == "SUBMIT_QUESTION"]
    assert total[0] == len(submits)
    assert total[1] == sum(r["is_right"] == "1" for r in submits)
    assert total[2] == sum(r["is_right"] == "0" and r["is_view_analyze"] == "1" for r in submits)


def test_factor_triggers_are_accounts(log):
    rows = ar.archive_factors(log.where("account_id = 1"), "factor").collect()
    assert rows and all(r.triggers == 1 for r in rows)


def test_rollup_equals_lifetime(log):
    keys = ar.ARCHIVES["topic"].keys
    daily = ar.roll_up(ar.archive(log, "topic_daily"), keys)
    want = ar.archive(log, "topic").select(*daily.columns)
    assert spark_rows(daily) == spark_rows(want)
