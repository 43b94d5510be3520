"""Named end-to-end queries (``registry.QUERIES``) and their SQL oracles (``oracle.ORACLE_SQL``)."""
