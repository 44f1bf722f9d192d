"""Command line programs, run in-process against the test session."""
import os

import pytest

from ordwise import cli


def test_gen_sort_validate(spark, tmp_out, capsys):
    gen, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "out")
    assert cli.main(["gen", "500k", gen, "--partitions", "3"]) == 0
    assert sum(os.path.getsize(os.path.join(gen, f)) for f in os.listdir(gen)
               if f.startswith("part-")) == 500000
    assert '"records_written": 5000' in capsys.readouterr().out
    assert cli.main(["sort", gen, out, "--partitions", "4"]) == 0
    assert cli.main(["validate", out]) == 0
    text = capsys.readouterr().out
    assert "5000 rows" in text and "in order" in text and "out of order" not in text
    assert cli.main(["validate", gen]) == 1
    assert "out of order" in capsys.readouterr().out


def test_verbose_validate_and_run(spark, tmp_out, capsys):
    gen, out = os.path.join(tmp_out, "in"), os.path.join(tmp_out, "out")
    cli.main(["gen", "200k", gen, "--partitions", "2"])
    cli.main(["sort", gen, out, "--partitions", "3"])
    capsys.readouterr()
    assert cli.main(["validate", out, "--verbose", "--full-checksum"]) == 0
    text = capsys.readouterr().out
    assert text.count('"file_index"') == 3
    from ordwise.plans import pipeline
    orig = pipeline.PRESETS.copy()
    pipeline.PRESETS["TINY"] = 300000
    try:
        assert cli.main(["run", "tiny", os.path.join(tmp_out, "bench"), "--runs", "1",
                         "--partitions", "2"]) == 0
    finally:
        pipeline.PRESETS.clear()
        pipeline.PRESETS.update(orig)
    assert '"run": 1' in capsys.readouterr().out


def test_validate_detects_missing_records(spark, tmp_out, capsys):
    out = os.path.join(tmp_out, "o")
    cli.main(["gen", "100k", out, "--partitions", "2"])
    sorted_out = os.path.join(tmp_out, "s")
    cli.main(["sort", out, sorted_out, "--partitions", "2"])
    assert cli.main(["validate", sorted_out]) == 0
    victim = os.path.join(sorted_out, sorted(f for f in os.listdir(sorted_out) if f.startswith("part-"))[1])
    with open(victim, "r+b") as f:          # drop the last record of one part
        f.truncate(os.path.getsize(victim) - 100)
    with pytest.raises(Exception, match="manifest"):
        cli.main(["validate", sorted_out])


def test_unfinished_input_is_refused(spark, tmp_out):
    src = os.path.join(tmp_out, "raw")
    os.makedirs(src)
    with open(os.path.join(src, "data"), "wb") as f:
        f.write(bytes(1000))
    for args in (["sort", src, os.path.join(tmp_out, "s")], ["validate", src]):
        with pytest.raises(Exception, match="_SUCCESS"):
            cli.main(args)
    assert cli.main(["validate", src, "--unfinished"]) == 0
