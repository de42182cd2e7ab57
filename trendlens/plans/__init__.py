"""Named end-to-end queries over the test tables (``queries``) and their DuckDB twins (``oracle``)."""
