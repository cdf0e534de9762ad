import os
import sys

import pytest

_here = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_here), _here]

from feed_rows import as_file, mixed_events  # noqa: E402
from gustline.session import drop_staged, local_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    drop_staged(session)


@pytest.fixture(scope="session")
def landed(spark, tmp_path_factory):
    """One full layered run over the fixture file."""
    from gustline.plans.layered import run_layers

    folder = tmp_path_factory.mktemp("layers")
    raw = as_file(mixed_events(), folder / "raw file.csv")
    return str(folder / "data"), raw, run_layers(spark, raw, str(folder / "data"), "t1")
