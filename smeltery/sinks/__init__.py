from .tables import ensure_namespace, materialise, partitioned_writer, replace_partitions, replace_table
from .versions import commit, expose, history, publish, read_version, stage

__all__ = [
    "commit",
    "ensure_namespace",
    "expose",
    "history",
    "materialise",
    "partitioned_writer",
    "publish",
    "read_version",
    "replace_partitions",
    "replace_table",
    "stage",
]
