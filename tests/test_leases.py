"""Leases exclude each other, expire, and are fenced."""

import threading

import pytest

from waybill.operators import leases
from waybill.operators.leases import LeaseLost
from waybill.session import shared_dir

T = 1_700_000_000_000


@pytest.fixture
def root(spark):
    return shared_dir(spark, "leases")


@pytest.fixture
def queue(messages):
    return messages(*[{"id": i + 1, "queue": "AB"[i % 2], "backout": i % 3} for i in range(40)])


def held(spark, lease):
    return sorted((r["queueName"], int(r["messageIdHex"], 16)) for r in lease.ids(spark).collect())


def test_claims_take_turns_and_end_when_all_is_taken(spark, root, queue):
    got = [leases.claim(queue, root, f"o{k}", ["A", "B"], T + k, batch_size=8) for k in range(4)]
    assert [g and g.fence for g in got] == [1, 2, 3, None]
    assert [len(held(spark, g)) for g in got[:3]] == [16, 16, 8]
    assert sorted(sum((held(spark, g) for g in got[:3]), [])) == sorted(("AB"[i % 2], i + 1) for i in range(40))
    assert held(spark, got[0])[:8] == [("A", i) for i in range(1, 16, 2)]
    assert leases.claim(queue, root, "other", ["C"], T) is None
    with pytest.raises(ValueError, match="positive"):
        leases.claim(queue, root, "o", ["A"], T, batch_size=0)


def test_claimers_at_once_never_get_one_message(spark, root, queue):
    got, gate = [], threading.Barrier(3)

    def work(name):
        gate.wait()
        got.append(leases.claim(queue, root, name, ["A", "B"], T, batch_size=5))

    workers = [threading.Thread(target=work, args=(f"w{k}",)) for k in range(3)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    ids = sum((held(spark, g) for g in got), [])
    assert len(ids) == 30 == len(set(ids)) and sorted(g.fence for g in got) == [1, 2, 3]
    assert leases.overlapping(leases.lease_log(spark, root, T)).count() == 0


def test_an_expired_lease_returns_with_one_more_redelivery(spark, root, queue):
    first = leases.claim(queue, root, "a", ["A"], T, lease_ms=1000, batch_size=5)
    counts = lambda lease: {r["messageIdHex"][-2:]: r["backoutCount"] for r in lease.batch(queue).collect()}
    before = counts(first)
    assert leases.leases(spark, root, T + 999).first()["outcome"] == "HELD"
    again = leases.claim(queue, root, "b", ["A"], T + 1000, lease_ms=1000, batch_size=5)
    assert counts(again) == {k: v + 1 for k, v in before.items()}
    # The first owner's clock may be slow: the entry of the second has told the time.
    for end in (leases.commit, leases.rollback, leases.renew):
        with pytest.raises(LeaseLost, match="EXPIRED"):
            end(spark, first, T + 10)
    leases.rollback(spark, again, T + 1500)
    third = leases.claim(queue, root, "c", ["A"], T + 1600, batch_size=5)
    assert counts(third) == {k: v + 2 for k, v in before.items()} and third.fence > again.fence


def test_commits_are_final_and_renewals_hold(spark, root, queue):
    first = leases.claim(queue, root, "a", ["A"], T, lease_ms=1000, batch_size=5)
    leases.renew(spark, first, T + 900, lease_ms=5000)
    second = leases.claim(queue, root, "b", ["A"], T + 2000, lease_ms=100, batch_size=5)
    assert not set(held(spark, first)) & set(held(spark, second))
    leases.commit(spark, first, T + 2000)
    leases.commit(spark, first, T + 9000)
    with pytest.raises(LeaseLost, match="COMMIT"):
        leases.rollback(spark, first, T + 2001)
    third = leases.claim(queue, root, "c", ["A"], T + 9_000_000, batch_size=100)
    assert set(held(spark, third)) == {("A", i) for i in range(1, 40, 2)} - set(held(spark, first))
    outcomes = {r["owner"]: r["outcome"] for r in leases.leases(spark, root, T + 9_000_000).collect()}
    assert outcomes == {"a": "COMMIT", "b": "EXPIRED", "c": "HELD"}


def test_a_claimer_killed_before_its_entry_holds_nothing(spark, root, queue, monkeypatch):
    monkeypatch.setattr(leases, "put_entry", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        leases.claim(queue, root, "a", ["A"], T, batch_size=5)
    monkeypatch.undo()
    lease = leases.claim(queue, root, "b", ["A"], T, batch_size=5)
    assert lease.fence == 1 and held(spark, lease)[0] == ("A", 1)
    assert {r["returned"] for r in lease.ids(spark).collect()} == {0}
