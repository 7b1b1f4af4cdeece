import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def work(spark, tmp_path_factory):
    """The session with a shared folder for stored tables."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture()
def docs(work):
    """Makes a documents table of (doc_id, text[, source]) rows, with an extra column of a clashing name."""

    def make(rows):
        full = [(i, t, "en", s[0] if s else "a", None if t is None else len(t), 7) for i, t, *s in rows]
        return work.createDataFrame(full, SCHEMA + ", n_words int")

    return make
