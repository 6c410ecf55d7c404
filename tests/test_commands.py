"""Each command against a store, in one session."""

from tests.conftest import MILL

from regweave.__main__ import arguments, run


def call(spark, *argv):
    return run(spark, arguments(list(map(str, argv))))


def test_commands(spark, mini_archive, tmp_path, capsys):
    store = tmp_path / "store"
    assert call(spark, store, "all", mini_archive) == 0
    assert "crosswalk rows: 8" in capsys.readouterr().out
    assert call(spark, store, "qa", "--only-problems") == 0
    out = capsys.readouterr().out
    assert "0 fail, 42 ok, 11 warn" in out and "rows.facility" not in out
    call(spark, store, "query", "SELECT count(*) AS systems FROM water_system")
    assert "|5 " in capsys.readouterr().out
    call(spark, store, "lookup", MILL)
    out = capsys.readouterr().out
    assert "50309QRRYL" in out and "IA0000042" not in out
    call(spark, store, "info")
    assert "environmental_interest" in capsys.readouterr().out
    call(spark, store, "export", tmp_path / "x.csv", "--sql", "SELECT * FROM crosswalk")
    assert spark.read.csv(str(tmp_path / "x.csv"), header=True).count() == 8
    call(spark, store, "ingest", mini_archive, "--public", "--only", "contact", "organization")
    assert not (store / "raw" / "contact").exists()
    assert call(spark, tmp_path / "none", "qa") == 0
