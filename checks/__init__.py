"""The registered queries: each operator over the driver tables, with its SQL oracle."""
