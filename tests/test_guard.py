"""The optional query modules: absent is fine, broken is an error."""

import builtins

import pytest

import __spark_entry__ as E
from opslens.plans.catalogue import QUERIES


def _without(monkeypatch, name, exc):
    real = builtins.__import__

    def fake(module, *args, **kwargs):
        if module == name:
            raise exc
        return real(module, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", fake)


def test_missing_subpackage_leaves_the_other_queries(monkeypatch):
    _without(monkeypatch, "corpus_pipeline", ModuleNotFoundError("gone", name="corpus_pipeline"))
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(QUERIES)


def test_a_broken_import_is_raised(monkeypatch):
    _without(monkeypatch, "corpus_pipeline", ModuleNotFoundError("gone", name="some_other_module"))
    with pytest.raises(ModuleNotFoundError):
        E.queries()
