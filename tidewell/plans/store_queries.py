"""Registered queries of tables that batches keep up to date."""

from __future__ import annotations

import uuid

from ..operators import history
from ..session import cut_lineage, work_folder
from ..sources.store import Store
from . import catalogue as base
from .catalogue import LINEAGE, SQL, query


@query("current_state_by_merges", SQL["current_state"])
def _(spark, d):
    # batch by batch: the records that a batch touches replace what the table held of them, all others stay as they were written
    t = Store(spark, f"{work_folder(spark)}/{uuid.uuid4().hex}").begin()
    versions = cut_lineage(base._versions(spark, d))
    for (n,) in sorted(versions.select("batch_no").distinct().collect()):  # one row per batch
        so_far, touched = versions.filter(f"batch_no <= {n}"), versions.filter(f"batch_no = {n}").select("rec").distinct()
        current = history.current_state(so_far.join(touched, "rec", "left_semi"), ["rec"], "v", LINEAGE, "batch_no").select("rec", "v", "batch_no", "event_type", "version_count", "first_batch")
        t.merge("current", ["rec"], current) if t.exists("current") else t.replace("current", current)
    return t.read("current")
