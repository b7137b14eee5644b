"""The driver's entry without its optional parts, and where checkpoints go."""

import sys

import pytest

import __spark_entry__ as entry
from stepwise.session import prepare


class Conf:
    def get(self, key):
        return None


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def getConf(self):
        return Conf()

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master):
        self.sparkContext = Context(master)
        self.conf = type("C", (), {"set": lambda *_: None})()


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://https://host"])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        prepare(Session(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_one_machine_gets_a_folder(master):
    assert prepare(Session(master)).sparkContext.folder


@pytest.mark.parametrize("missing", ["stepwise.llm.queries", "ahocorasick", "corpus_pipeline"])
def test_entry_without_a_part(monkeypatch, missing):
    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("stepwise.llm"):
            monkeypatch.delitem(sys.modules, name)
    import stepwise

    monkeypatch.delattr(stepwise, "llm", raising=False)
    monkeypatch.setitem(sys.modules, missing, None)
    names = entry.queries().keys()
    assert "c14_lattice_count" in names and entry.oracle_sql().keys() <= names
    assert "pipeline" not in names
    if missing != "corpus_pipeline":
        assert not any(n.startswith("op") for n in names)
