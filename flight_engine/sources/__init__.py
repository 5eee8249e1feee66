"""Sources: derived inputs from the driver tables, snapshot decode, message and table scans."""
