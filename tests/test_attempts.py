import collections

import pytest

from siltstone.streaming import attempts as A


def call_of(folder, dies=None):
    """Counts its calls in files; keys of 3 fail, keys of 5 fail twice, and ``dies`` kills the task."""

    def call(row):
        k = row["k"]
        with open(f"{folder}/{k}", "a") as f:
            f.write("x")
        if k == dies:
            raise KeyboardInterrupt
        if k % 3 == 0:
            raise ValueError(f"no {k}")
        with open(f"{folder}/{k}") as f:
            if k % 5 == 0 and len(f.read()) < 3:
                raise RuntimeError("busy")
        return f"{row['t']}-{k}"

    return call


def calls(folder):
    return {int(p.name): len(p.read_text()) for p in folder.iterdir()}


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(k, "a") for k in range(1, 12)] + [(None, "a"), (4, "a")], "k long, t string")


def test_attempts_are_bounded_and_results_come_once(spark, tmp_path, rows):
    seen, path = tmp_path / "seen", str(tmp_path / "work")
    seen.mkdir()
    A.attempt(rows, path, "b1", "k", call_of(seen), most=3)
    A.attempt(rows, path, "b1", "k", call_of(seen), most=3)  # the same batch: nothing is called
    assert calls(seen) == dict.fromkeys(range(1, 12), 1)
    assert A.drain(spark, rows.schema, path, "k", call_of(seen), most=3) == 2
    A.attempt(rows, path, "b2", "k", call_of(seen), most=3)
    assert calls(seen) == {k: 3 if k % 3 == 0 or k % 5 == 0 else 1 for k in range(1, 12)}
    got = {r.k: (r.ok, r.result or r.error, r.attempts) for r in A.outcome(spark, rows.schema, path, "k").collect()}
    assert got == {k: (False, f"ValueError: no {k}", 3) if k % 3 == 0 else (True, f"a-{k}", 3 if k % 5 == 0 else 1) for k in range(1, 12)}
    done = A._read(spark, f"{path}/results", A._kept(rows.schema, *A.RESULT)).where("ok").collect()
    assert max(collections.Counter(r.k for r in done).values()) == 1


def test_a_crash_between_result_and_commit(spark, tmp_path, rows, monkeypatch):
    seen, src, path, state = tmp_path / "seen", str(tmp_path / "src"), str(tmp_path / "work"), str(tmp_path / "state")
    seen.mkdir()
    rows.write.parquet(src)
    real = A.attempt

    def dying(*a):
        real(*a)
        raise RuntimeError("killed before the commit")

    monkeypatch.setattr(A, "attempt", dying)
    source = lambda: spark.readStream.schema(rows.schema).parquet(src)
    query = A.stream(source(), path, state, "k", call_of(seen))
    with pytest.raises(Exception, match="killed before the commit"):
        query.awaitTermination(60)
    assert calls(seen) == dict.fromkeys(range(1, 12), 1)
    monkeypatch.setattr(A, "attempt", real)
    A.stream(source(), path, state, "k", call_of(seen)).awaitTermination(60)
    assert calls(seen) == dict.fromkeys(range(1, 12), 1)  # the results were whole: no call is made twice
    assert A.outcome(spark, rows.schema, path, "k").where("ok").count() == 6


def test_a_crash_within_the_calls_counts(spark, tmp_path, rows):
    seen, path = tmp_path / "seen", str(tmp_path / "work")
    seen.mkdir()
    for _ in range(2):
        with pytest.raises(BaseException):
            A.attempt(rows.where("k = 7"), path, "b1", "k", call_of(seen, dies=7), most=2)
    A.attempt(rows.where("k = 7"), path, "b1", "k", call_of(seen), most=2)  # its attempts are used up
    assert calls(seen) == {7: 2}
    r = A.outcome(spark, rows.schema, path, "k").first()
    assert (r.k, r.ok, r.attempts) == (7, None, 2)
