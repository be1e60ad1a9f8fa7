from .incremental import read_control, run_increment, saved_value
from .stream import start_trace_stream

__all__ = ["read_control", "run_increment", "saved_value", "start_trace_stream"]
