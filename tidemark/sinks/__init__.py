from tidemark.sinks.exports import write_delimited, write_lines
from tidemark.sinks.journal import recover
from tidemark.sinks.partitions import replace_partition, replace_partitions
from tidemark.sinks.shared import shared_path

__all__ = [
    "recover", "replace_partition", "replace_partitions", "shared_path",
    "write_delimited", "write_lines",
]
