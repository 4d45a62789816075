"""Optional query groups: absent ones are silent, broken ones are not."""

import sys
import warnings

import __spark_entry__ as E


def test_an_absent_module_is_silent(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert E._optional("corpus_pipeline") is None


def test_a_broken_module_warns_and_is_left_out(tmp_path, monkeypatch):
    (tmp_path / "needs_something.py").write_text("import a_module_that_is_not_there\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert E._optional("needs_something") is None
    assert "a_module_that_is_not_there" in str(seen[0].message)


def test_other_errors_are_not_swallowed(tmp_path, monkeypatch):
    (tmp_path / "is_wrong.py").write_text("1 / 0\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    try:
        E._optional("is_wrong")
    except ZeroDivisionError:
        return
    raise AssertionError("the error was swallowed")
