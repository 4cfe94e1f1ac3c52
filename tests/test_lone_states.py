"""A row that is alone in its group is its state: no shuffle, the values the aggregates give."""

from stratus.operators import mart_state as S
from test_lone_groups import LONE, PAIR, _found, _plan, _rows


def test_lone_rows_are_their_states_without_a_shuffle(spark):
    rows = _rows(spark, LONE).filter("temperature IS NOT NULL")
    lone, whole = S.states(rows), S._several_states(rows, S.GROUP)
    assert "Exchange" not in _plan(lone) and lone.schema.names == whole.schema.names
    assert _found(lone) == _found(whole) and lone.count() == 5


def test_states_of_one_and_of_several_rows_together(spark):
    rows = _rows(spark, LONE + PAIR).filter("temperature IS NOT NULL")
    assert _found(S.states(rows)) == _found(S._several_states(rows, S.GROUP))
    assert [r.rows_n for r in S.states(_rows(spark, PAIR[:2])).collect()] == [2]
