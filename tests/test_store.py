"""The log of the runs table, the prediction sink, and what other writers and dead ones leave."""

import threading

import pytest


from gradeloom.operators import runs as U
from gradeloom.sources.activity import write_predictions


def records(spark, *names, **rest):
    return U.new_runs(spark, [{"run_id": n, "algorithm": "random_forest", "cv_scores": [0.5], **rest} for n in names])


def names(spark, path, number=None):
    return sorted((r.run_id, r.version) for r in U.load_runs(spark, path, number).collect())


def test_a_dead_writer_is_in_nobodys_way(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    U.log_runs(records(spark, "a"), path)
    # one that dies before its commit leaves data that nothing names, and perhaps a file aside
    monkeypatch.setattr(U, "put_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        U.log_runs(records(spark, "b"), path)
    monkeypatch.undo()
    (tmp_path / "runs" / "_log" / ".dead.tmp").write_text("{")
    assert names(spark, path) == [("a", 1)] and U.last_snapshot(spark, path) == 1
    U.log_runs(records(spark, "c"), path)
    assert names(spark, path) == [("a", 1), ("c", 1)]
    # one that dies in the midst of its data
    (tmp_path / "runs" / "data-dead" / "_temporary").mkdir(parents=True)
    U.log_runs(records(spark, "d"), path)
    assert names(spark, path) == [("a", 1), ("c", 1), ("d", 1)]
    folders = len(list((tmp_path / "runs").glob("data-*")))
    assert U.vacuum_runs(spark, path, keep=2) == 0  # too young
    assert U.vacuum_runs(spark, path, keep=2, older_than_hours=0) == folders - 2
    assert names(spark, path) == [("a", 1), ("c", 1), ("d", 1)] and names(spark, path, 2) == [("a", 1), ("c", 1)]


def test_of_two_commits_of_one_number_one_is_refused(spark, tmp_path):
    path = str(tmp_path / "runs")
    U.log_runs(records(spark, "a"), path)
    data = U.data_of(spark, path, 1).rsplit("/", 1)[1]
    U.put_commit(spark, path, 2, data)
    with pytest.raises(U.Conflict):
        U.put_commit(spark, path, 2, "data-other")
    assert U.data_of(spark, path, 2).endswith(data) and U.commits(spark, path) == [1, 2]
    assert not list((tmp_path / "runs" / "_log").glob(".*.tmp"))


def test_two_writers_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "runs")
    failed = []

    def write(who):
        try:
            for i in range(3):
                U.log_runs(records(spark, f"{who}{i}"), path)
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    threads = [threading.Thread(target=write, args=(w,)) for w in "xy"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and names(spark, path) == [(f"{w}{i}", 1) for w in "xy" for i in range(3)]
    assert U.commits(spark, path) == list(range(1, 7))


def test_a_change_is_worked_out_anew_for_a_faster_writers_table(spark, tmp_path):
    path = str(tmp_path / "runs")
    U.log_runs(records(spark, "a"), path)
    seen = []

    def change(old):
        if not seen:
            U.log_runs(records(spark, "fast"), path)
        seen.append(sorted(r.run_id for r in old.collect()))
        return old.unionByName(records(spark, "slow", version=1))

    U.change_runs(spark, path, change)
    assert seen == [["a"], ["a", "fast"]] and names(spark, path) == [("a", 1), ("fast", 1), ("slow", 1)]


def test_a_reader_keeps_its_table_during_a_write(spark, tmp_path):
    path = str(tmp_path / "runs")
    U.log_runs(records(spark, "a"), path)
    reading = U.load_runs(spark, path)
    U.save_runs(records(spark, "b", "c", version=1), path)
    assert [r.run_id for r in reading.collect()] == ["a"]
    assert names(spark, path) == [("b", 1), ("c", 1)] and names(spark, path, 1) == [("a", 1)]


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        U.load_runs(spark, str(tmp_path / "none"))
    assert U.last_versions(spark, str(tmp_path / "none")) == {} and U.commits(spark, str(tmp_path / "none")) == []


@pytest.mark.parametrize("format", ["json", "csv"])
def test_the_same_scoring_twice_leaves_one(spark, tmp_path, format):
    path, schema = str(tmp_path / "out"), "learner_id string, course_name string, step double, p double"
    first = spark.createDataFrame([(f"L{i}", "all", float(i % 3), 0.25) for i in range(9)], schema)
    second = first.where("step > 0").withColumn("p", first.p * 2)

    def read():
        rows = spark.read.json(path) if format == "json" else spark.read.csv(path, header=True, inferSchema=True, recursiveFileLookup=False)
        return sorted((r.scoring_id, r.learner_id, r.p) for r in rows.collect())

    write_predictions(first, path, format, scoring_id="run/1-all")
    once = read()
    write_predictions(first, path, format, scoring_id="run/1-all")
    assert read() == once and len(once) == 9
    write_predictions(second, path, format, scoring_id="run/2-all")
    assert len(read()) == 9 + second.count()
    write_predictions(second, path, format, scoring_id="run/1-all")  # fewer steps than before: no old ones stay
    assert [r[2] for r in read()] == [0.5] * 2 * second.count()
    # a job that dies while it writes leaves the rows that were there
    (tmp_path / "out" / ".writing-dead" / "step=9").mkdir(parents=True)
    (tmp_path / "out" / ".writing-dead" / "step=9" / "part-0.json").write_text('{"learner_id":"half"}')
    assert [r[2] for r in read()] == [0.5] * 2 * second.count()
