"""Combined conditions against counting at every minute."""
import datetime as dt
import random

import pytest

from ledgerwatch.operators import combine

T0 = dt.datetime(2024, 1, 1)
EPISODES = "policy_id string, condition_id string, series string, fired_at timestamp_ntz, episode_end timestamp_ntz"


def at(minute):
    return None if minute is None else T0 + dt.timedelta(minutes=minute)


@pytest.mark.parametrize("seed", range(2))
def test_intervals_equal_counting(spark, seed):
    rng = random.Random(seed)
    conditions = [("p", "a", 2), ("p", "b", None), ("q", "a", 1), ("q", "b", 3), ("r", "a", 1)]
    combiners = {"p": "AND", "q": "OR", "r": "AND"}
    episodes, last = [], 60
    for policy, condition, _ in conditions:
        for series in "stuv":
            t = rng.randrange(10)
            while t < last:
                end = t + rng.randint(1, 12)
                episodes.append((policy, condition, series, t, end if end < last else None))
                t = end + rng.randint(0, 9)
    df = spark.createDataFrame([(*e[:3], at(e[3]), at(e[4])) for e in episodes], EPISODES)
    cond = spark.createDataFrame(conditions, "policy_id string, condition_id string, trigger_count int")
    pol = spark.createDataFrame(list(combiners.items()), "policy_id string, combiner string")
    want = set()
    for policy, combiner in combiners.items():
        mine = [(c, n or 1) for p, c, n in conditions if p == policy]
        held = []
        for m in range(last + 1):
            met = [sum(1 for e in episodes if e[:2] == (policy, c) and e[3] <= m and (e[4] is None or m < e[4])) >= n for c, n in mine]
            held.append(all(met) if combiner == "AND" else any(met))
        start = None
        for m, h in enumerate(held):
            if h and start is None:
                start = m
            if not h and start is not None:
                want.add((policy, at(start), at(m)))
                start = None
        if start is not None:
            want.add((policy, at(start), None))
    got = [tuple(r) for r in combine.policy_intervals(df, cond, pol).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 5


def test_unknown_combiner_raises_and_no_episodes_hold_nothing(spark):
    cond = spark.createDataFrame([("p", "a", 1)], "policy_id string, condition_id string, trigger_count int")
    pol = spark.createDataFrame([("p", "XOR")], "policy_id string, combiner string")
    one = spark.createDataFrame([("p", "a", "s", at(0), at(1))], EPISODES)
    with pytest.raises(Exception, match="unknown combiner"):
        combine.policy_intervals(one, cond, pol).collect()
    assert combine.condition_intervals(spark.createDataFrame([], EPISODES), cond).collect() == []
