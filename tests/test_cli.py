"""The command-line entry parses its three commands (no Spark needed for that)."""

import pytest

from retention.__main__ import main


@pytest.mark.parametrize("cmd", ["weekly", "train", "infer"])
def test_help_of_each_command(cmd, capsys):
    with pytest.raises(SystemExit) as e:
        main([cmd, "--help"])
    assert e.value.code == 0
    assert "--store" in capsys.readouterr().out


def test_missing_arguments_are_rejected(capsys):
    with pytest.raises(SystemExit) as e:
        main(["weekly", "--store", "x"])
    assert e.value.code == 2
