"""Handing the package to workers."""

import time
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier
from types import SimpleNamespace

from monthfusion.sources.shipping import ship_package


class Context:
    """Refuses a second archive, as Spark does, and takes a while for the first."""

    applicationId = "application-of-test-shipping"

    def __init__(self):
        self.archives = []

    def addPyFile(self, path):
        if self.archives:
            raise ValueError("already registered with a different path")
        self.archives.append(path)
        time.sleep(0.2)


def test_sources_loaded_side_by_side_ship_one_archive():
    context, together = Context(), Barrier(6)
    session = SimpleNamespace(sparkContext=context)

    def ship(_):
        together.wait()
        ship_package(session)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(ship, range(6)))
    assert len(context.archives) == 1
