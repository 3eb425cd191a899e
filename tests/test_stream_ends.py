"""Streams that end before their rows are landed are errors, not results."""

from types import SimpleNamespace

import pytest

from cdclake import workloads


class Ended:
    """A query that is over, or that goes on without landing anything."""

    def __init__(self, active: bool, error: str | None = None):
        self.isActive, self.error = active, error

    def stop(self) -> None:
        self.isActive = False

    def exception(self) -> str | None:
        return self.error


@pytest.mark.parametrize("query, landed, said", [(Ended(False), [4], "4 of 6"), (Ended(True), [2, 2], "4 of 6"), (Ended(False, "broken"), [], "broken"), (Ended(True), [4, 4], "8 of 6")])
def test_streams_that_end_early_are_errors(query, landed, said):
    """A stream that ends, or lands nothing more, before its rows are landed is no result."""
    with pytest.raises(RuntimeError, match=said):
        workloads.wait_for_rows(query, [SimpleNamespace(rows=n) for n in landed], 6, stall_s=0.5)
    assert not query.isActive
    workloads.wait_for_rows(Ended(True), [SimpleNamespace(rows=6)], 6)


def test_slow_streams_land_all_rows(monkeypatch):
    """There is no time after which a stream that still lands batches is left."""
    results, clock = [SimpleNamespace(rows=1)], [0.0]

    def sleep(_):
        clock[0] += 500
        results.append(SimpleNamespace(rows=1))

    monkeypatch.setattr(workloads, "time", SimpleNamespace(time=lambda: clock[0], sleep=sleep))
    workloads.wait_for_rows(Ended(True), results, 9)
    assert len(results) == 9
