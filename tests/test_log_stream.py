"""Lines of a growing log, delivered once each."""

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from tidemark.sinks import journal
from tidemark.streaming import arriving_log, deliver_log, logs

HEAD = "2023-01-10|INFO|99|trade|trade_load|"


def appear(tmp_path, name, *lines):
    """A file moved into the folder as a whole."""
    folder = tmp_path / "log"
    folder.mkdir(exist_ok=True)
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    (tmp_path / name).rename(folder / name)
    return str(folder)


def run(spark, root, tmp_path, folder, **options):
    deliver_log(arriving_log(spark, folder, files_at_once=1), root, "2023-01-10", "trade", "load",
                str(tmp_path / "checkpoint"), **options).awaitTermination()


def delivered(spark, root):
    return [row[0] for row in rows(spark.read.text(root), "value")]


def test_pieces_and_restarts(spark, root, tmp_path):
    folder = appear(tmp_path, "a", "Error one", "nothing", "NOTE and Exception two")
    run(spark, root, tmp_path, folder)
    first = [f"{HEAD}ERROR|Error one", f"{HEAD}Exception|NOTE and Exception two", f"{HEAD}NOTE|NOTE and Exception two"]
    assert delivered(spark, root) == first
    run(spark, root, tmp_path, folder)
    assert delivered(spark, root) == first
    appear(tmp_path, "b", "quiet")
    appear(tmp_path, "c", "WARN three", "Error one")
    run(spark, root, tmp_path, folder)
    assert delivered(spark, root) == sorted([*first, f"{HEAD}ERROR|Error one", f"{HEAD}WARN|WARN three"])


@pytest.mark.parametrize("when", ["before the commit", "after the commit", "after all of it"])
def test_a_batch_that_breaks_off(spark, root, tmp_path, monkeypatch, when):
    """Wherever a batch stops, its repetition neither doubles nor loses a line."""
    folder = appear(tmp_path, "a", "Error one")
    run(spark, root, tmp_path, folder)
    appear(tmp_path, "b", "WARN two", "Error three")

    def lost(*args, **kwargs):
        raise OSError("lost")

    if when == "before the commit":
        monkeypatch.setattr(journal.Replacement, "commit", lost)
    elif when == "after the commit":
        monkeypatch.setattr(journal, "finish", lost)
    else:
        real = logs.replace_partition
        monkeypatch.setattr(logs, "replace_partition", lambda *args, **kw: (real(*args, **kw), lost()))
    with pytest.raises(PySparkException, match="lost"):
        run(spark, root, tmp_path, folder)
    monkeypatch.undo()
    run(spark, root, tmp_path, folder)
    assert delivered(spark, root) == [f"{HEAD}ERROR|Error one", f"{HEAD}ERROR|Error three", f"{HEAD}WARN|WARN two"]
