"""Sources and sinks."""

from tidemark.sources.io import (  # noqa: F401
    create_namespace,
    create_table,
    publish_version,
    read_latest,
    read_source,
    read_table,
    register_views,
    run_view_script,
    save_table,
    write_partitioned,
)
