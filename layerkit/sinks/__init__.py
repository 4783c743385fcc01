from layerkit.sinks.tables import (
    append_batch,
    create_layer_table,
    create_namespace,
    distribute_for_write,
    drop_table,
    list_namespaces,
    upsert_table,
    write_full,
    write_marts,
    write_messages,
)

__all__ = [
    "append_batch",
    "create_layer_table",
    "create_namespace",
    "distribute_for_write",
    "drop_table",
    "list_namespaces",
    "upsert_table",
    "write_full",
    "write_marts",
    "write_messages",
]
