import time

import pytest
from conftest import rows
from test_feeds import document, land

from newsloom.plans.warehouse import Warehouse
from newsloom.streaming import landing
from newsloom.streaming.landing import stream_feed


def test_batches_and_a_failure_are_in_the_audit(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    folder = land(tmp_path / "in", [document(1), document(None)], [document(2)], [document(3)])

    def run():
        query = stream_feed(warehouse, "blogs", folder, str(tmp_path / "checkpoint"), files_per_batch=2)
        query.awaitTermination(300)
        return query

    def audited(wanted):
        for _ in range(100):  # listeners are told a little later
            found = {(r, s, st, n) for r, s, st, n in rows(
                warehouse.table("audit").select("run_id", "stage", "status", "record_count"))}
            if wanted <= found:
                return True
            time.sleep(0.3)
        return False

    assert run().exception() is None
    assert audited({
        ("blogs batch 0", "files", "Completed", 2), ("blogs batch 0", "pages", "Completed", 2),
        ("blogs batch 1", "reject", "Completed", 0),
        ("blogs batch 1", "files", "Completed", 1), ("blogs batch 1", "pages", "Completed", 1), ("blogs batch 1", "merge", "Completed", 1),
    })

    def fails(*given):
        raise RuntimeError("killed")

    land(tmp_path / "in", [document(4)])
    load_pages = landing.load_stored_pages
    monkeypatch.setattr(landing, "load_stored_pages", fails)
    with pytest.raises(Exception, match="killed"):
        run()
    assert audited({("blogs batch 2", "files", "Completed", 1), ("blogs batch 2", "end", "Failed", 0)})
    monkeypatch.setattr(landing, "load_stored_pages", load_pages)
    assert run().exception() is None
    assert audited({("blogs batch 2", "pages", "Completed", 1), ("blogs batch 2", "merge", "Completed", 1)})
    assert rows(warehouse.table("bronze").select("id")) == [("1",), ("2",), ("3",), ("4",)]
