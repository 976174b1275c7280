"""Named queries over the test tables (``catalog``), their DuckDB oracles
(``oracle``) and the derived dirty-text fixtures (``fixtures``)."""
