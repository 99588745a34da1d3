"""The bench: generated tables, methods that move them, interleaved runs behind a checksum gate, and reports."""
