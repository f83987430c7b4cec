"""Members of an ensemble are fitted two at a time, and stay in their order."""

from threading import Barrier, active_count

import pytest

from fieldtally.operators import train


def test_two_members_are_fitted_at_once_and_keep_their_order(spark, monkeypatch):
    both, rows = Barrier(2, timeout=20), spark.range(10)

    def fitted(kind):
        def fit(frame, overrides):
            both.wait()  # broken if the other member is fitted only afterwards
            return kind, frame.count(), overrides

        return fit

    monkeypatch.setattr(train, "KINDS", {kind: fitted(kind) for kind in "abcd"})
    vote = train.fit_ensemble(rows, tuple("abcd"), {"c": {"x": 1}})
    assert vote.names == ["0_a", "1_b", "2_c", "3_d"]
    assert vote.members == [("a", 10, {}), ("b", 10, {}), ("c", 10, {"x": 1}), ("d", 10, {})]


def test_a_failing_member_fails_the_ensemble_once_the_running_ones_ended(spark, monkeypatch):
    def fails(frame, overrides):
        raise ValueError("no fit")

    before, rows = active_count(), spark.range(10)
    monkeypatch.setattr(train, "KINDS", {"a": lambda frame, overrides: frame.count(), "b": fails})
    with pytest.raises(ValueError, match="no fit"):
        train.fit_ensemble(rows, ("a", "b", "a"))
    assert active_count() <= before
