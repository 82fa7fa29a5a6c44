from counterfold.sinks.outputs import (
    Outputs,
    merge_results,
    read_results,
    sample_references,
    write_arrow,
    write_results,
)

__all__ = [
    "Outputs",
    "merge_results",
    "read_results",
    "sample_references",
    "write_arrow",
    "write_results",
]
