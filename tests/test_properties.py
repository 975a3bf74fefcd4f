"""Property tests: team form equals a brute-force computation on random inputs,
for both the plain window and the hot-team split path."""

from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import matches_df
from touchline.operators.form import build_team_form

TEAMS = ["1", "2", "3", "10"]


@st.composite
def match_lists(draw):
    n = draw(st.integers(min_value=1, max_value=30))
    rows = []
    for i in range(n):
        h, a = draw(st.sampled_from([(x, y) for x in TEAMS for y in TEAMS if x != y]))
        day = draw(st.integers(min_value=1, max_value=6))  # few days -> many date ties
        hs = draw(st.one_of(st.none(), st.integers(0, 3)))
        as_ = draw(st.one_of(st.none(), st.integers(0, 3)))
        status = draw(st.sampled_from(["finished", "finished", "finished", "scheduled"]))
        rows.append((str(i), "C0", datetime(2024, 1, 1) + timedelta(days=day), status, 1,
                     h, f"Team {h}", a, f"Team {a}", hs, as_, "src"))
    return rows


def _round2(x):
    return None if x is None else float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def brute_force(rows, strict, keep_unscored):
    persp = []
    for (mid, _c, ts, status, _md, h, _hn, a, _an, hs, as_, _s) in rows:
        if status != "finished":
            continue
        for team, gs, gc in ((h, hs, as_), (a, as_, hs)):
            if gs is None and not keep_unscored:
                continue
            if gs is not None and gc is not None and gs > gc:
                res, pts = "W", 3
            elif gs is not None and gc is not None and gs == gc:
                res, pts = "D", 1
            else:
                res, pts = "L", 0
            persp.append((team, ts, mid, gs, gc, res, pts))
    out = set()
    for team in {p[0] for p in persp}:
        seq = sorted([p for p in persp if p[0] == team], key=lambda p: (p[1], p[2]))
        pl = []
        for i, p in enumerate(seq):
            frame = seq[max(0, i - 4): i + 1]
            gs = [f[3] for f in frame if f[3] is not None]
            gc = [f[4] for f in frame if f[4] is not None]
            pl.append(sum(f[6] for f in frame))
            prev = pl[i - 5] if i >= 5 else None
            better = prev is None or (pl[i] > prev if strict else pl[i] >= prev)
            out.add((p[2], team, p[5], p[6], _round2(sum(gs) / len(gs) if gs else None),
                     _round2(sum(gc) / len(gc) if gc else None), pl[i],
                     "improving" if better else "declining"))
    return out


def spark_rows(df):
    return {(r.match_id, r.team_id, r.result, r.points, r.goals_scored_rolling_avg_5,
             r.goals_conceded_rolling_avg_5, r.points_last5, r.form_trend) for r in df.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=match_lists(), strict=st.booleans(), keep_unscored=st.booleans())
def test_team_form_equals_brute_force(spark, rows, strict, keep_unscored):
    m = matches_df(spark, rows)
    expect = brute_force(rows, strict, keep_unscored)
    for buckets in (1, max(1, len(rows))):  # whole teams; about two rows a bucket
        form = build_team_form(m, strict=strict, keep_unscored=keep_unscored, buckets=buckets)
        assert spark_rows(form) == expect
