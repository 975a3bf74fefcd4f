"""Kept totals equal a recomputation after late, corrected and deleted matches."""

import pytest

from tests.conftest import SF_SMALL
from tests.helpers import match, matches_df
from touchline import fixtures as fx
from touchline.operators import totals as T
from touchline.operators.form import form_rows
from touchline.operators.results import match_results
from touchline.operators.rivalry import head_to_head
from touchline.operators.standings import league_standings, standings_by_name
from touchline.session import scratch_dir

def kind_of(name):
    """What is kept, the report on it, and the plain one."""
    return {
        "standings": (T.team_totals, T.kept_standings, lambda m: league_standings(form_rows(m))),
        "by_name": (lambda: T.team_totals(("team_name",), keep_unscored=True), T.kept_standings_by_name,
                    lambda m: standings_by_name(form_rows(m, True))),
        "pairs": (T.pair_totals, T.kept_head_to_head, lambda m: head_to_head(match_results(m, keep_unscored=False))),
    }[name]


def same(got, expect):
    assert got.columns == expect.columns and got.dtypes == expect.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, expect.collect()))


@pytest.mark.parametrize("kind", ["standings", "by_name", "pairs"])
def test_kept_totals_equal_recomputation(spark, kind):
    kept, report, plain = kind_of(kind)
    kept = kept()
    before, removed, added = fx.matches_before(spark, SF_SMALL)
    path = scratch_dir(spark, "t-totals")
    T.store_totals(before, path, kept)
    same(report(T.read_totals(spark, path, kept)), plain(before))
    for _ in range(2):  # the same part twice counts once
        T.change_totals(spark, path, kept, "a", removed, added)
    after = fx.matches(spark, SF_SMALL)
    same(report(T.read_totals(spark, path, kept)), plain(after))
    T.fold(spark, path, kept)
    assert len(T._parts(spark, path)) == 1
    T.change_totals(spark, path, kept, "a", removed, added)  # repeated after it was folded
    same(report(T.read_totals(spark, path, kept)), plain(after))
    T.change_totals(spark, path, kept, "b", added, removed)  # and back
    same(report(T.read_totals(spark, path, kept)), plain(before))


def test_keys_without_rows_and_without_scores(spark):
    kept, report, plain = kind_of("by_name")
    kept = kept()
    old = matches_df(spark, [match(1, 1, "1", "2", 1, 0), match(2, 2, "3", "4", None, None), match(3, 3, None, "2", 1, 1)])
    path = scratch_dir(spark, "t-totals")
    T.store_totals(old, path, kept)
    same(report(T.read_totals(spark, path, kept)), plain(old))
    gone = old.filter("match_id = '1'")
    T.change_totals(spark, path, kept, "x", gone, gone.limit(0))
    same(report(T.read_totals(spark, path, kept)), plain(old.filter("match_id <> '1'")))
    T.change_totals(spark, path, kept, "y", old.filter("match_id <> '1'"), old.limit(0))
    assert T.read_totals(spark, path, kept).isEmpty()


def test_many_parts_are_folded(spark, monkeypatch):
    monkeypatch.setattr(T, "MOST_PARTS", 2)
    kept, report, plain = kind_of("pairs")
    kept = kept()
    rows = [match(i, 1 + i, "1", "2", i, 1) for i in range(6)]
    path = scratch_dir(spark, "t-totals")
    none = matches_df(spark, [])
    T.store_totals(matches_df(spark, rows[:1]), path, kept)
    for i in range(1, 6):
        T.change_totals(spark, path, kept, str(i), none, matches_df(spark, rows[i:i + 1]))
    assert len(T._parts(spark, path)) <= 4
    same(report(T.read_totals(spark, path, kept)), plain(matches_df(spark, rows)))
