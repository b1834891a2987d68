from skyledger.sources.files import (
    read_flights,
    read_flights_csv,
    read_scan,
    scan_flights_csv,
    typed_flights,
    write_flights,
    write_scan,
)
from skyledger.sources.headers import file_headers
from skyledger.sources.messages import (
    decode_flights,
    decode_lines,
    read_messages,
    rejected_lines,
    replay_lines,
    wire_lines,
)
from skyledger.sources.warehouse import flights_view

__all__ = [
    "decode_flights", "decode_lines", "file_headers", "flights_view", "read_flights", "read_flights_csv", "read_messages", "read_scan",
    "rejected_lines", "replay_lines", "scan_flights_csv", "typed_flights", "wire_lines", "write_flights", "write_scan",
]
