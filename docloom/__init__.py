"""Document-store pipelines on Spark: views, imports, keyed mutations and updates as DataFrame jobs."""

from docloom.functions.actions import action
from docloom.operators.apply import ApplyResult, apply_actions, apply_to, live_documents
from docloom.operators.composing import update_composed
from docloom.operators.existence import existence_counts, existing_keys, key_existence, missing_keys
from docloom.operators.keys import expand_keys, plan_keys
from docloom.operators.paging import assign_batches, page_rows
from docloom.operators.uniform import apply_operation
from docloom.operators.update import UpdateResult, lookup_documents, merge_actions, update_documents
from docloom.operators.views import define_view, documents_of, sample_view, scan_view, to_cells
from docloom.plans.jobs import (
    export_lines,
    import_view,
    import_view_paged,
    import_view_to_cells,
    update_job,
    update_outside,
)
from docloom.sinks.cells import load_cells, read_loaded_cells
from docloom.sinks.push import push_actions, push_resumable
from docloom.sinks.store import save_actions
from docloom.sources.buckets import create_buckets, documents_by_id, read_buckets
from docloom.sources.lines import parse_action_lines, read_lines
from docloom.sources.outside import fetch_documents
from docloom.sources.tables import read_snapshot, read_view, write_snapshot, write_view
from docloom.sources.view_store import create_view, follow, read_followed

__all__ = [name for name in dir() if not name.startswith("_")]
