"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from tidemark import session


def stand_in(master, folder=None, size="128MB"):
    values = {"spark.checkpoint.dir": folder, "size": size, "spark.sql.warehouse.dir": "file:/w/"}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: values.get(name) or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_shared_dir():
    assert session.shared_dir(stand_in("yarn", "s3a://b/c/")) == "s3a://b/c"
    with pytest.raises(ValueError):
        session.shared_dir(stand_in("yarn"))
    local = stand_in("local[2]")
    assert session.shared_dir(local) == "file:/w/_app-1"


def test_byte_setting():
    for text, size in (("128MB", 2**27), ("1g", 2**30), ("134217728b", 2**27), ("10", 10)):
        assert session.byte_setting(stand_in("local", size=text), "size") == size
