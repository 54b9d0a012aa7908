import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlewick.operators.gaps import differences, plain_gaps, samples, session_gaps, totals

C = 60


def frame(spark, us, k="a"):
    return spark.createDataFrame([(k, u) for u in us], "k string, us long")


def found(df):
    return sorted((r.gap_start, r.gap_end, r.missing) for r in df.collect())


def test_plain(spark):
    assert found(plain_gaps(frame(spark, [0, 60, 300]), C)) == [(120, 300, 3)]
    assert found(plain_gaps(frame(spark, [120, 180]), C, 0, 3600)) == [(0, 120, 2), (240, 3600, 56)]
    assert found(plain_gaps(frame(spark, []), C, 0, 3600)) == []
    assert found(plain_gaps(frame(spark, [0, 0, 60, 60, 110]), C)) == []


def brute(us, sessions):
    """The rules over a sorted list, one stamp at a time."""
    out = []
    for s, e in sessions:
        own = [u for u in us if s <= u < e]
        if not own:
            out.append((s, e, (e - s) // C))
            continue
        if own[0] > s and (own[0] - s) // C:
            out.append((s, own[0], (own[0] - s) // C))
        for a, b in zip(own, own[1:], strict=False):
            if b - a > C and (b - a) // C > 1:
                out.append((a + C, b, (b - a) // C - 1))
        if own[-1] + C < e and (e - own[-1] - C) // C:
            out.append((own[-1] + C, e, (e - own[-1] - C) // C))
    return sorted(out)


def test_sessions_against_brute_force(spark):
    r = random.Random(4)
    cases, want = [], {}
    sessions = [(0, 1000), (1000, 1030), (1300, 2500), (2600, 4000)]
    for k in range(60):
        us = sorted(r.choices(range(0, 4200), k=r.randrange(0, 40)))
        cases += [(str(k), u) for u in us]
        want[str(k)] = brute(us, sessions)
    stamps = spark.createDataFrame(cases, "k string, us long")
    series = spark.createDataFrame([(k,) for k in want], "k string")
    s = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(sessions)], "sid int, s long, e long")
    got = {k: [] for k in want}
    for x in session_gaps(stamps, s, series, C).collect():
        got[x.k].append((x.gap_start, x.gap_end, x.missing))
    assert {k: sorted(v) for k, v in got.items()} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3000), max_size=30))
def test_plain_gaps_fill_what_is_between(spark, us):
    gaps = found(plain_gaps(frame(spark, us), C))
    assert all(b - a >= C * m and m > 0 for a, b, m in gaps)
    once = sorted(set(us))
    assert sum(m for _, _, m in gaps) == sum(max(0, (b - a) // C - 1) for a, b in zip(once, once[1:], strict=False))


def test_totals_are_exact_beyond_the_sample(spark):
    gaps = plain_gaps(frame(spark, range(0, 10_001 * 120, 120)), C)
    t = totals(gaps).first()
    assert (t.gaps, t.missing) == (10_000, 10_000) and samples(gaps).count() == 20


def test_differences(spark):
    a, b = plain_gaps(frame(spark, [0, 300, 360]), C), plain_gaps(frame(spark, [0, 300, 600]), C)
    assert [(r.side, r.gap_start, r.gap_end, r.missing) for r in differences(a, b).collect()] == [("right", 360, 600, 4)]
