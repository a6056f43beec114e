import pytest

from siltworks.plans import state


def test_moves_are_numbered_and_read_again(spark, tmp_path):
    folder = str(tmp_path)
    run = state.Run(folder, "r1")
    with pytest.raises(ValueError, match="no state"):
        state.Run.load(folder, "r1")
    for s in ("running", "failed", "running", "waiting_for_review", "running", "completed"):
        run.move(s)
        back = state.latest(folder)
        assert (back.run_id, back.state, back.number, back.history) == ("r1", s, run.number, run.history)
    assert run.number == 6 and sorted(state.Folder(f"{folder}/r1").names()) == [f"state.{i}.json" for i in range(1, 7)]
    with pytest.raises(ValueError, match="cannot go"):
        run.move("running")
    state.Run(folder, "r2").move("running")
    assert state.latest(folder).run_id == "r2" and state.Run.load(folder, "r1").state == "completed"


def test_a_stale_driver_cannot_move_a_run(spark, tmp_path):
    first = state.Run(str(tmp_path), "r")
    first.move("running")
    stale = state.Run.load(str(tmp_path), "r")
    first.move("waiting_for_review")
    with pytest.raises(state.StaleRun):
        stale.move("failed")
    assert stale.state == "running" and state.Run.load(str(tmp_path), "r").state == "waiting_for_review"
    # A second driver that begins the same run anew is stale as well.
    with pytest.raises(state.StaleRun):
        state.Run(str(tmp_path), "r").move("running")


def test_one_of_many_drivers_wins(spark, tmp_path):
    state.Run(str(tmp_path), "r").move("running")
    drivers = [state.Run.load(str(tmp_path), "r") for _ in range(4)]
    won = []
    for k, driver in enumerate(drivers):
        try:
            driver.move("failed")
            won.append(k)
        except state.StaleRun:
            pass
    assert won == [0]


def test_a_uri_and_a_missing_folder(spark, tmp_path):
    folder = f"file://{tmp_path}/deep/er"
    run = state.Run(folder, "r")
    run.move("running")
    assert state.latest(folder).state == "running"
