"""Intermediate tables go to the shared folder; missing parts leave the rest working."""

import subprocess
import sys

import pytest

from presswork.storage import shared_folder


class Named:
    """A session of which only its master and its settings are asked."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = {"spark.checkpoint.dir": folder} if folder else {}, self
        self.master = master


def test_shared_folder():
    assert shared_folder(Named("yarn", "hdfs://n/c/")) == "hdfs://n/c"
    assert shared_folder(Named("local[4]")) == shared_folder(Named("local"))
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://h:7077", "k8s://h"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            shared_folder(Named(master))


@pytest.mark.parametrize("missing", ["presswork.llm", "corpus_pipeline", "zstandard", "public_tokenizers"])
def test_the_rest_works_without(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; n = len(e.queries()); assert n >= 70 and len(e.oracle_sql()) > 60; print(n)"
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) >= 70
